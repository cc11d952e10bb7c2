"""Company statistics kept up to date from changes.

The state is a multiset of values: one row for each company, field and value, with how many owner rows have it. It merges by
adding counts, so a month that comes adds rows, a month that is replaced or withdrawn takes the old ones away, and
what was added up in parts equals what is counted at once. The statistics (distinct titles, distinct prices, first and last
day, names) are read from the values whose count is over 0; none of them could be kept up from their own last result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import labels

FIELDS = {"title": "title_number", "price": "price_paid", "name": "proprietor_name", "category": "category", "country": "country_incorporated", "added": "date_proprietor_added"}
KEY = "company_reg_no"


def state(long: DataFrame, sign: int = 1) -> DataFrame:
    """company_reg_no, field, value, n of owner rows; with sign -1 what they take away."""
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(c).cast("string").alias("value")) for f, c in FIELDS.items()])
    each = long.where(F.col(KEY).isNotNull()).select(KEY, F.explode(pairs).alias("_p")).where("_p.value is not null")
    return each.groupBy(KEY, "_p.field", "_p.value").agg((F.count("*") * sign).alias("n"))


def merge(*parts: DataFrame) -> DataFrame:
    """States added up; values that nothing has any more leave."""
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every.groupBy(KEY, "field", "value").agg(F.sum("n").alias("n")).where("n <> 0")


def advance(old: DataFrame, added: DataFrame, removed: DataFrame | None = None) -> DataFrame:
    """The state after owner rows came and others went."""
    return merge(old, state(added), *([state(removed, -1)] if removed is not None else []))


def statistics(held: DataFrame) -> DataFrame:
    """The same table as analytics.company_stats(), out of a state."""
    of = lambda field: F.when(F.col("field") == field, F.col("value"))
    out = held.where("n > 0").groupBy(KEY).agg(
        F.max(of("name")).alias("company_name"), F.max(of("category")).alias("category"), F.max(of("country")).alias("country"),
        F.count_if(F.col("field") == "title").alias("property_count"), F.sum(of("price").cast("long")).alias("total_value_owned"),
        F.min(of("added").cast("date")).alias("first_seen_date"), F.max(of("added").cast("date")).alias("last_seen_date"),
    )
    return out.withColumns({"company_type": F.when(F.col("country").isNotNull(), "Overseas").otherwise("UK"), "portfolio_size": labels.portfolio_band(F.col("property_count"))})
