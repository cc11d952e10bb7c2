"""Write semantics of keyed tables, as DataFrames: the result is the table after the write.

Parquet has no keys, so each function takes the table and the new rows and returns the new table; `sources.tables`
writes it, or only the partitions it touches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def last_row(rows: DataFrame, keys: list[str], order: list[str], null_keys_repeat: bool = False) -> DataFrame:
    """The last row of each key by order. null_keys_repeat: rows with a null in their key never replace another."""
    window = Window.partitionBy(*keys).orderBy(*[F.desc_nulls_last(c) for c in order])
    if null_keys_repeat:
        whole = F.lit(True)
        for k in keys:
            whole = whole & F.col(k).isNotNull()
        # Null keys get a partition by their row's content and pass, so that they make no hot partition.
        ranked = rows.where(whole).withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")
        return ranked.unionByName(rows.where(~whole))
    return rows.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def upsert(table: DataFrame, new: DataFrame, keys: list[str], order: list[str], null_keys_repeat: bool = False) -> DataFrame:
    """New rows replace rows of their key; of new rows with one key, the last by order wins."""
    fresh = last_row(new, keys, order, null_keys_repeat)
    return table.join(fresh.select(*keys), keys, "left_anti").unionByName(fresh.select(*table.columns))


def upsert_in_one_pass(table: DataFrame, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """upsert() where the new rows are many, or costly to make: they are read once, and both sides are dealt and sorted by key once.
    (upsert() reads them twice, but leaves the table where it is if they are few.)"""
    more = [c for c in order if c not in table.columns]
    both = table.withColumn("_new", F.lit(False)).unionByName(new.select(*table.columns, *more).withColumn("_new", F.lit(True)), allowMissingColumns=True)
    window = Window.partitionBy(*keys).orderBy(F.desc("_new"), *[F.desc_nulls_last(c) for c in order])
    ranked = both.withColumns({"_rn": F.row_number().over(window), "_any": F.first("_new").over(window)})
    unkeyed = F.lit(False)
    for k in keys:
        unkeyed = unkeyed | F.col(k).isNull()
    # A row of the table with a null in its key is replaced by none.
    return ranked.where(F.when(F.col("_new"), F.col("_rn") == 1).otherwise(~F.col("_any") | unkeyed)).select(*table.columns)


def upsert_flagged(table: DataFrame, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last new row of each key with `inserted`: whether the key is new."""
    known = table.select(*keys, F.lit(True).alias("_known")).distinct()
    return last_row(new, keys, order).join(known, keys, "left").withColumn("inserted", F.col("_known").isNull()).drop("_known")


def upsert_returning(table: DataFrame, new: DataFrame, keys: list[str], order: list[str], kept: list[str]) -> DataFrame:
    """The last new row of each key as written, with `inserted`: the columns kept have the old value where the new one is null."""
    known = last_row(table, keys, order).select(*keys, F.lit(True).alias("_known"), *[F.col(c).alias(f"_o_{c}") for c in kept])
    out = last_row(new, keys, order).join(known, keys, "left").withColumns({c: F.coalesce(c, f"_o_{c}") for c in kept})
    return out.withColumn("inserted", F.col("_known").isNull()).drop("_known", *[f"_o_{c}" for c in kept])


def upsert_filling(table: DataFrame, new: DataFrame, keys: list[str], order: list[str], rules: dict[str, Callable[[Column, Column], Column]] | None = None) -> DataFrame:
    """As upsert(), but a null or empty new value keeps the old one. rules: column -> f(old, new) for others."""
    rules = rules or {}
    kinds = dict(table.dtypes)
    fresh = last_row(new, keys, order).select(*keys, F.lit(True).alias("_new"), *[F.col(c).alias(f"_n_{c}") for c in table.columns if c not in keys])
    out = table.withColumn("_old", F.lit(True)).join(fresh, keys, "full")

    def value(c: str) -> Column:
        old, now = F.col(c), F.col(f"_n_{c}")
        if c in rules:
            return F.when(F.col("_new").isNull(), old).when(F.col("_old").isNull(), now).otherwise(rules[c](old, now))
        return F.coalesce(F.nullif(now, F.lit("")) if kinds[c] == "string" else now, old)

    return out.select(*[F.col(c) if c in keys else value(c).alias(c) for c in table.columns])


def upsert_stamped(table: DataFrame, new: DataFrame, keys: list[str], order: list[str], at, stamp: str = "updated_at") -> DataFrame:
    """As upsert(), keeping a time of change in the column `stamp` of the table: rows that are new, or whose values differ from
    the table's (nulls are equal), get `at`, and rows written again as they were keep theirs.

    Rows are compared by value, so no chance of equal hashes leaves a change out; the table is joined once, with the last new
    rows."""
    kept = [c for c in table.columns if c not in keys and c != stamp]
    fresh = last_row(new, keys, order).select(*keys, F.lit(True).alias("_new"), F.struct(*kept).alias("_n"))
    old = table.select(*keys, F.col(stamp).alias("_at"), F.struct(*kept).alias("_o"), F.lit(True).alias("_old"))
    both = old.join(fresh, keys, "full")
    same = F.col("_new").isNull() | (F.col("_old").isNotNull() & F.col("_o").eqNullSafe(F.col("_n")))
    value = F.when(F.col("_new").isNull(), F.col("_o")).otherwise(F.col("_n"))
    return both.select(*keys, value.alias("_v"), F.when(same, F.col("_at")).otherwise(F.lit(at).cast(table.schema[stamp].dataType)).alias(stamp)).select(*[F.col(c) if c in keys or c == stamp else F.col(f"_v.{c}").alias(c) for c in table.columns])


def insert_new(table: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Append rows of keys that the table lacks, one of each."""
    return table.unionByName(new.dropDuplicates(keys).join(table, keys, "left_anti").select(*table.columns))


def update_from(table: DataFrame, source: DataFrame, keys: list[str], columns: dict[str, Callable[[Column, Column], Column]] | list[str]) -> DataFrame:
    """Columns of rows that the source (a row per key) has take its non-null values, or f(old, new)."""
    rules = columns if isinstance(columns, dict) else {c: (lambda old, new: F.coalesce(new, old)) for c in columns}
    side = source.select(*keys, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_s_{c}") for c in rules])
    out = table.join(side, keys, "left")
    return out.select(*[F.when(F.col("_hit"), rules[c](F.col(c), F.col(f"_s_{c}"))).otherwise(F.col(c)).alias(c) if c in rules else F.col(c) for c in table.columns])


def delete_then_insert(table: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """All rows of the keys that come go, then the new rows are added."""
    return table.join(new.select(key).distinct(), key, "left_anti").unionByName(new.select(*table.columns))


def dissolve(companies: DataFrame, as_of) -> DataFrame:
    """Companies whose status says so, without a date of dissolution, get as_of."""
    over = F.lower("company_status").rlike("dissolved|removed") & F.col("dissolution_date").isNull()
    return companies.withColumn("dissolution_date", F.when(over, F.lit(as_of)).otherwise(F.col("dissolution_date")))


def lineage(old: Column, new: Column) -> Column:
    """data_source after a scrape is merged into a row."""
    return F.when(old == "basic_file", "basic_file+overview_scrape").when(old.like("%scrape%"), old).otherwise(new)


def backfill_changes(titles: DataFrame) -> DataFrame:
    """FULL rows without a change indicator count as added on the day the owner was."""
    fill = (F.col("update_type") == "FULL") & (F.coalesce("change_indicator", F.lit("")) == "")
    return titles.withColumns({"change_date": F.when(fill, F.coalesce("change_date", "date_proprietor_added")).otherwise(F.col("change_date")), "change_indicator": F.when(fill, "A").otherwise(F.col("change_indicator"))})


def drop_deletes(titles: DataFrame, keep_deletes: bool = False) -> DataFrame:
    """Change-only rows marked as deletions."""
    return titles if keep_deletes else titles.where(~((F.col("update_type") == "COU") & F.coalesce(F.col("change_indicator") == "D", F.lit(False))))
