"""The corpus pipeline: language ID, near duplicates, benchmark decontamination, PII, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, written as Parquet and read again as the next one's
docs. All but the last return the columns of documents; the last returns where each text's pieces lie in their bins.

- language_id drops documents whose language is rejected (no letter, or a calibrated score under the rejection
  threshold). The model learns from the labelled documents of its own input, those with crc32(doc_id) mod 3 not 1.
- near_duplicates keeps the document of smallest id of each group linked at 0.8 or more of five-word shingles; of
  repeated rows of it, one (an id with several texts stays if one of them does). Texts without words link with nothing and stay.
- decontaminate drops documents that share ten consecutive words (or all words of a shorter item) with a benchmark item.
- pii replaces personal data in the texts by pseudonyms of the same format; n_chars follows the text.
- packing packs every text whole.

Null texts are rejected by language ID. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deedflow.llm import decontaminate as decontamination
from deedflow.llm import jaccard_join, lang_id, packing, pii
from deedflow.llm.common import cut, drop_cut, small_batches, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    own = [F.col("doc_id").alias("id"), F.xxhash64("text").alias("h")]
    with small_batches(spark):
        model = lang_id.train(docs.select("doc_id", "text", "lang"), ~held)
        # Only the rejected rows' ids and text hashes are kept: a decision follows from the text, so equal rows share it.
        scored = lang_id.predict(docs.select(*own, "text"), model, ["id", "h"])
        gone = cut(scored.where("rejected").select("id", "h").distinct())
    return docs.join(jaccard_join.near(gone), F.col("doc_id").eqNullSafe(F.col("id")) & (F.xxhash64("text") == F.col("h")), "left_anti")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    found = jaccard_join.jaccard_components(docs.select("doc_id", "text"), 5, 80)
    own = F.col("component_id").eqNullSafe(F.col("doc_id"))
    ids = cut(found.groupBy(F.col("doc_id").alias("id")).agg(F.max(own).alias("stays"), F.count("*").alias("rows")).where("not stays or rows > 1"))
    same = F.col("doc_id").eqNullSafe(F.col("id"))
    kept = docs.join(jaccard_join.near(ids.where("not stays").select("id")), same, "left_anti")
    again = ids.where("stays").select("id")
    if again.isEmpty():
        return kept
    # Repeated rows: only ids that repeat are compared by text.
    again = jaccard_join.near(again)
    return kept.join(again, same, "left_anti").unionByName(kept.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"]))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    done = pii.protect(docs.select(*COLUMNS), pii.session_key(spark), counts=False)
    with small_batches(spark):
        return cut(done.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs.select("doc_id", "text", "source"))


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("pii", pii_stage),
    ("packing", packing_stage),
]
#: A stage that returns whole texts from Python returns a table that it has written, in small batches.
WRITTEN = {"pii"}
#: Trained models, keyed pseudonyms and bins can't be expressed; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        if name not in WRITTEN:
            docs = cut(docs)
        if before is not None:
            drop_cut(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
