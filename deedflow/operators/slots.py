"""The four proprietor slots of a title row: wide to long and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import present

SLOTS = range(1, 5)
#: Long name -> pattern of the wide columns; a column that the input lacks is null.
OWNER = {
    "proprietor_name": "proprietor_{}_name",
    "company_reg_no": "company_{}_reg_no",
    "category": "proprietorship_{}_category",
    "country_incorporated": "country_{}_incorporated",
    "address_1": "proprietor_{}_address_1",
    "address_2": "proprietor_{}_address_2",
    "address_3": "proprietor_{}_address_3",
}
MATCH = {"matched_name": "ch_matched_name_{}", "matched_number": "ch_matched_number_{}", "match_type": "ch_match_type_{}", "confidence": "ch_match_confidence_{}"}


def unpivot(wide: DataFrame, fields: dict[str, str] = OWNER, keep_blank: bool = False, keep_one: bool = False) -> DataFrame:
    """One row for each slot, in one scan; rows without an owner name go unless keep_blank. keep_one: of a row without any
    owner the first slot stays."""
    have = set(wide.columns)
    slotted = {p.format(i) for p in fields.values() for i in SLOTS}

    def one(i: int) -> Column:
        return F.struct(F.lit(i).alias("slot"), *[(F.col(p.format(i)) if p.format(i) in have else F.lit(None).cast("string")).alias(n) for n, p in fields.items()])

    rest = [c for c in wide.columns if c not in slotted]
    # Blank slots go before the rows are made.
    slots = F.array(*[one(i) for i in SLOTS])
    if not keep_blank:
        named = F.filter(slots, lambda s: present(s["proprietor_name"]))
        slots = F.when(F.size(named) > 0, named).otherwise(F.array(one(1))) if keep_one else named
    return wide.select(*rest, F.inline(slots))


def pivot(long: DataFrame, keys: list[str], fields: dict[str, str]) -> DataFrame:
    """Back to one row per key; slots that are missing are null."""
    return long.groupBy(*keys).agg(*[F.max(F.when(F.col("slot") == i, F.col(n))).alias(p.format(i)) for i in SLOTS for n, p in fields.items()])


def cross_slot_distinct(long: DataFrame, key: str = "id") -> DataFrame:
    """Of an owner named in several slots of one row, the first slot."""
    # A window shuffles rows once; joining them with their least slots would do it three times.
    first = F.min("slot").over(Window.partitionBy(key, "proprietor_name"))
    return long.where(F.col(key).isNotNull() & F.col("proprietor_name").isNotNull()).withColumn("_first", first).where("slot = _first").drop("_first")
