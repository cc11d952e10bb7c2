"""Ownership intervals: who held a title from when to when, from whom, to whom, at what price.

Snapshots of a title become one interval for each dated change of owners (or each undated set of owners, from
its first month). Sellers, buyers, end and price at disposal come from the neighbours in order of start; a title that is
missing from the newest snapshot is taken as sold privately by then. A title's rows are one window partition, and no
join is made but a broadcast of one date.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.labels import owner_origin
from ..functions.text import present

OWNERS = [f"proprietor_{i}_name" for i in range(1, 5)]


def ownership_intervals(titles: DataFrame, as_of: date, private_sale: str = "PRIVATE SALE") -> DataFrame:
    newest = F.broadcast(titles.agg(F.max("file_month").alias("newest")))  # one row
    flat = lambda c: F.coalesce(F.col(c), F.lit(""))
    title = Window.partitionBy("title_number")
    same = Window.partitionBy("title_number", OWNERS[0], *[flat(c) for c in OWNERS[1:]])
    rows = titles.join(newest).withColumn("_last", F.max("file_month").over(title))
    rows = rows.where(present(F.col(OWNERS[0])))
    dated = F.col("date_proprietor_added").isNotNull()
    rows = rows.withColumns({
        "start": F.coalesce("date_proprietor_added", F.min("file_month").over(same)),
        "dedup_key": F.when(dated, F.concat(F.lit("DATED_"), F.col("date_proprietor_added").cast("string"))).otherwise(F.concat(F.lit("FIRST_APPEAR_"), F.col(OWNERS[0]), *[x for c in OWNERS[1:] for x in (F.lit("_"), flat(c))])),
    })
    last = Window.partitionBy("title_number", "dedup_key").orderBy(F.desc("file_month"), F.desc("id"))
    rows = rows.withColumn("_rn", F.row_number().over(last)).where("_rn = 1")
    step = title.orderBy("start", "file_month", "dedup_key")
    rows = rows.withColumns({
        "next_start": F.lead("start").over(step),
        "next_price": F.lead("price_paid").over(step),
        **{f"seller_{i}": F.lag(c).over(step) for i, c in enumerate(OWNERS, 1)},
        **{f"next_{i}": F.lead(c).over(step) for i, c in enumerate(OWNERS, 1)},
    })
    followed, gone = F.col("next_start").isNotNull(), F.col("_last") < F.col("newest")
    end = F.coalesce("next_start", F.when(gone, F.col("newest")))
    buyer = (
        F.when(followed & F.col("next_1").isNull(), private_sale)
        .when(followed & (F.col("next_1") == F.col(OWNERS[0])), F.lit(None))
        .when(~followed & gone, private_sale)
        .otherwise(F.col("next_1"))
    )
    return rows.select(
        "title_number",
        F.col("start").alias("ownership_start_date"),
        end.alias("ownership_end_date"),
        *[F.col(c).alias(f"owner_{i}") for i, c in enumerate(OWNERS, 1)],
        *[f"seller_{i}" for i in range(1, 5)],
        buyer.alias("buyer_1"),
        *[F.col(f"next_{i}").alias(f"buyer_{i}") for i in range(2, 5)],
        F.col("price_paid").alias("price_at_acquisition"),
        F.when(followed, F.col("next_price")).alias("price_at_disposal"),
        F.when(followed | gone, "Previous").otherwise("Current").alias("ownership_status"),
        F.datediff(F.coalesce("next_start", F.when(gone, F.col("newest")), F.lit(as_of)), "start").alias("ownership_duration_days"),
        owner_origin(F.col("dataset_type")).alias("ownership_type"),
        (~followed & gone).cast("int").alias("inferred_disposal_flag"),
        gone.cast("int").alias("disposal_from_company"),
    )
