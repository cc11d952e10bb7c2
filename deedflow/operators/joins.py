"""Join helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPREAD = 4096


def bounded(df: DataFrame, rows: int = 10_000) -> DataFrame:
    """df, marked for broadcast if it has so many rows at most."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def _equal(a: list[str], b: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(i).eqNullSafe(F.col(j)) for i, j in zip(a, b, strict=True)])


def split_keys(rows: DataFrame, keys: DataFrame, on: list[str], most: int = 100_000) -> tuple[DataFrame, bool]:
    """(keys to join rows with, whether they are those of `keys` or all the others): the fewer ones, broadcast, if either are so few.
    Where almost all keys are given, rows needn't be shuffled to leave out the last ones."""
    other = [f"_{k}" for k in on]
    given = keys.select(*[F.col(k).alias(o) for k, o in zip(on, other, strict=True)]).distinct()
    if given.limit(most + 1).count() <= most:
        return F.broadcast(given), True
    rest = rows.select(*on).distinct().join(given, _equal(on, other), "left_anti").select(*[F.col(k).alias(o) for k, o in zip(on, other, strict=True)])
    return (F.broadcast(rest), False) if rest.limit(most + 1).count() <= most else (given, True)


def within(rows: DataFrame, keys: DataFrame, on: list[str], most: int = 100_000) -> DataFrame:
    """The rows whose key is among keys; nulls are a key like others."""
    side, given = split_keys(rows, keys, on, most)
    return rows.join(side, _equal(on, [f"_{k}" for k in on]), "left_semi" if given else "left_anti")


def without(rows: DataFrame, keys: DataFrame, on: list[str], most: int = 100_000) -> DataFrame:
    """The other rows."""
    side, given = split_keys(rows, keys, on, most)
    return rows.join(side, _equal(on, [f"_{k}" for k in on]), "left_anti" if given else "left_semi")


def spread(key: Column, rows: DataFrame) -> Column:
    """key, with null and empty values replaced by one of SPREAD values that match nothing, by a hash of the row.

    Rows without a key stay in a left join, and hashed as they are they would all meet in one task."""
    filler = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c, t in rows.dtypes if not t.startswith("map")]), F.lit(SPREAD)).cast("string"))
    return F.when(key.isNotNull() & (key != ""), key).otherwise(filler)
