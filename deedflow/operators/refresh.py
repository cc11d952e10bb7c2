"""Refreshing stored matches and timelines: only titles whose rows changed are resolved again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..sources.stored import Stored
from . import resolve
from .joins import within
from .slots import unpivot


def changed_keys(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Keys whose rows, as multisets, differ between two tables with the same columns: new, gone or changed.

    Each side is a sum of row hashes and a count for each key, so rows themselves aren't joined; two different multisets
    of a key are taken as equal with a chance of about 2 ** -64."""

    def side(df: DataFrame, sign: int) -> DataFrame:
        # Hashes are halved: sums of up to 2 ** 32 rows of a key fit a decimal and don't overflow.
        h = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)])
        return df.select(*key, (h.cast("decimal(20,0)") * sign).alias("_h"), F.lit(sign).alias("_n"))

    both = side(old.select(*new.columns), -1).unionByName(side(new, 1))
    return both.groupBy(*key).agg(F.sum("_h").alias("_h"), F.sum("_n").alias("_n")).where("_h <> 0 or _n <> 0").select(*key)


def titles_of_companies(titles: DataFrame, old: DataFrame, new: DataFrame, rules: resolve.Rules = resolve.PRODUCTION) -> DataFrame:
    """Titles whose owners may match otherwise since the register changed: their number or name has the key of a company that is
    new, gone or changed, before or after."""
    cols = ["company_number", "company_name", "incorporation_date", "previous_names", *[c for c in new.columns if c == "company_status"]]
    changed = changed_keys(old.select(*cols), new.select(*cols), ["company_number"])
    rows = old.select(*cols).unionByName(new.select(*cols)).join(changed, "company_number", "left_semi")
    names = F.concat(F.array("company_name"), F.coalesce("previous_names", F.array().cast("array<string>")))
    numbers = rows.select(text.number_key(F.col("company_number")).alias("_k")).where("_k <> ''").distinct()
    keys = rows.select(F.explode(names).alias("_name")).select(rules.name_key(F.col("_name")).alias("_k")).where("_k <> ''").distinct()
    # Keys are made for different numbers and names only; a title's are shuffled as they are.
    owners = unpivot(titles)
    changed_numbers = owners.select("company_reg_no").distinct().withColumn("_nk", text.number_key(F.col("company_reg_no"))).where("_nk <> ''").join(numbers, F.col("_nk") == F.col("_k"), "left_semi")
    changed_names = owners.select("proprietor_name").distinct().withColumn("_mk", rules.name_key(F.col("proprietor_name"))).where("_mk <> ''").join(keys, F.col("_mk") == F.col("_k"), "left_semi")
    by_number = owners.select("title_number", "company_reg_no").distinct().join(changed_numbers, "company_reg_no", "left_semi").select("title_number")
    by_name = owners.select("title_number", "proprietor_name").distinct().join(changed_names, "proprietor_name", "left_semi").select("title_number")
    return by_number.union(by_name).distinct()


def refresh(store: Stored, titles: DataFrame, changed: DataFrame, build: Callable[[DataFrame], DataFrame], dealt: bool = False) -> int:
    """A new version of store, in which the titles of `changed` are built anew by build(their rows); titles that are gone leave.
    dealt: what build gives is dealt as store.dealt() does."""
    with store.kept(changed.select("title_number").distinct()) as affected:
        rows = build(within(titles, affected, ["title_number"]))
        return store.replace(affected, rows, dealt)
