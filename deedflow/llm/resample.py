"""Importance resampling towards a target: hashed n-gram features weigh a document, keyed Gumbel noise draws without replacement.

Features are all runs of 1 to `longest` consecutive words, repeats counted, in crc32 buckets modulo `width`. A bucket's
gain is the log ratio of its add-one shares in the target and in the documents, in whole thousandths; a document's
weight is the sum over its features, and its score the weight plus a Gumbel number made of the seed and its key. The
highest scores are drawn.

Everything is DataFrame functions. Exploded features are summed in the map side of both aggregations, so that
neither a frequent word nor a long document makes a hot key: at most `width` rows leave a task for the bucket
counts, and one a document for the weights. The gain table has `width` rows at most and is broadcast. Ranks come from
a range-partitioned sort and each partition's offset (`common.ranked`).

Defined results: null and empty texts have no features, weight 0 and, with min_words over 0, are not drawn; a null key is as
the empty string in the noise; repeated rows come back as often and take neighbouring ranks; an empty target has
t = T = 0; empty tables give no rows; extra columns are left out. Texts of any length are exploded as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, drop_cut, ranked, table
from .decontaminate import let, words_of

WIDTH, LONGEST, SEED, MIN_WORDS, PERCENT = 10_000, 1, 2024, 20, 10


def features(text: Column, longest: int = LONGEST) -> Column:
    """Runs of 1 to longest words, joined by a space."""

    def runs(w: Column, size: int) -> Column:
        some = F.transform(F.sequence(F.lit(1), F.size(w) - size + 1), lambda i: F.array_join(F.slice(w, i, F.lit(size)), " "))
        return F.when(F.size(w) >= size, some).otherwise(F.array().cast("array<string>"))

    if longest == 1:
        return words_of(text)
    return let(words_of(text), lambda w: F.concat(w, *[runs(w, size) for size in range(2, longest + 1)]))


def bucket(feature: Column, width: int = WIDTH) -> Column:
    return (F.crc32(feature) % width).cast("int")


def bucket_counts(texts: DataFrame, text: str = "text", longest: int = LONGEST, width: int = WIDTH) -> DataFrame:
    """bucket, n: features of all texts in each bucket that has any."""
    each = texts.select(F.explode(features(F.col(text), longest)).alias("_f"))
    return each.groupBy(bucket(F.col("_f"), width).alias("bucket")).agg(F.count("*").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text: str = "text", longest: int = LONGEST, width: int = WIDTH, made: list[DataFrame] | None = None) -> DataFrame:
    """bucket, gain of every bucket that the documents have features in."""
    own = bucket_counts(docs, text, longest, width).withColumnRenamed("n", "s")
    theirs = bucket_counts(target, text, longest, width).withColumnRenamed("n", "t")
    both = cut(own.join(theirs, "bucket", "full").select("bucket", F.coalesce("s", F.lit(0)).alias("s"), F.coalesce("t", F.lit(0)).alias("t")), made)
    total = both.agg(F.coalesce(F.sum("s"), F.lit(0)), F.coalesce(F.sum("t"), F.lit(0))).first()
    s, t = F.col("s").cast("double"), F.col("t").cast("double")
    ratio = (t + 1) * (F.lit(float(total[0])) + width) / ((s + 1) * (F.lit(float(total[1])) + width))
    return both.select("bucket", F.floor(F.log(ratio) * 1000).alias("gain"))


def weights(docs: DataFrame, gain: DataFrame, key: str = "doc_id", text: str = "text", longest: int = LONGEST, width: int = WIDTH) -> DataFrame:
    """key, n_features, n_words, weight of every row of docs."""
    each = docs.select(F.col(key).alias("_key"), F.xxhash64(F.col(text)).alias("_text"), F.posexplode_outer(features(F.col(text), longest)).alias("_pos", "_f"))
    # A row's first feature, or its only null, counts the row: rows that repeat are one group.
    head = (F.col("_pos") == 0) | F.col("_pos").isNull()
    each = each.select("_key", "_text", head.alias("_head"), "_f", bucket(F.col("_f"), width).alias("bucket"))
    summed = each.join(F.broadcast(gain), "bucket", "left").groupBy("_key", "_text").agg(
        F.count_if("_head").alias("_rows"), F.count("_f").alias("_n"), F.count_if(~F.contains("_f", F.lit(" "))).alias("_w"), F.coalesce(F.sum("gain"), F.lit(0)).alias("_sum")
    )
    once = [F.expr(f"{c} div _rows").alias(name) for c, name in (("_n", "n_features"), ("_w", "n_words"), ("_sum", "weight"))]
    return summed.select(F.col("_key").alias(key), *once, F.explode(F.sequence(F.lit(1).cast("long"), "_rows")).alias("_copy")).drop("_copy")


def gumbel(key: Column, seed: int = SEED) -> Column:
    """Gumbel noise in whole thousandths, made of the seed and the key."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.log(-F.log((h + 0.5) / 4294967296.0)) * -1000)


def resample(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED, longest: int = LONGEST, width: int = WIDTH) -> DataFrame:
    """key, n_features, weight, score, rank of every row: rank from 1 for the drawn ones, null for the others. percent of the rows
    with min_words words or more are drawn, highest scores first, ties to the smaller key."""
    made: list[DataFrame] = []
    try:
        gain = gains(docs.select(text), target.select(text), text, longest, width, made)
        scored = weights(docs.select(key, text), gain, key, text, longest, width).withColumn("score", F.col("weight") + gumbel(F.col(key), seed))
        scored = cut(scored.withColumn("_in", F.col("n_words") >= min_words), made)
        drawn = scored.where("_in").count() * percent // 100
        order = [F.col("_in").desc(), F.col("score").desc(), F.col(key).asc_nulls_last()]
        placed = ranked(scored, order)
    finally:
        drop_cut(*made)
    return placed.select(key, "n_features", "weight", "score", F.when(F.col("_in") & (F.col("rank") <= drawn), F.col("rank")).alias("rank"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL = r"""
WITH crc AS (
  SELECT list(c ORDER BY i) AS crcs FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT CAST(range AS BIGINT) AS i FROM range(256)))
), d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS f FROM benchmark
), e AS (SELECT doc_id, unnest(w) AS f FROM d), known AS (SELECT f, hex(encode(f)) AS h FROM (SELECT f FROM e UNION SELECT f FROM b)),
bytes AS (
  SELECT f, list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, len(h) + 1, 2), lambda i: CAST('0x' || substr(h, CAST(i AS INTEGER), 2) AS BIGINT))) AS bs FROM known
), hashed AS (
  SELECT f, xor(list_reduce(bs, lambda c, x: xor(c >> 8, crcs[CAST((xor(c, x) & 255) + 1 AS INTEGER)])), 4294967295) % 10000 AS bucket FROM bytes, crc
), own AS (SELECT bucket, count(*) AS s FROM e JOIN hashed USING (f) GROUP BY 1),
theirs AS (SELECT bucket, count(*) AS t FROM b JOIN hashed USING (f) GROUP BY 1),
sums AS (SELECT CAST((SELECT count(*) FROM e) AS DOUBLE) AS big_s, CAST((SELECT count(*) FROM b) AS DOUBLE) AS big_t),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln((CAST(coalesce(t, 0) AS DOUBLE) + 1) * (big_s + 10000) / ((CAST(s AS DOUBLE) + 1) * (big_t + 10000)))) AS BIGINT) AS gain
  FROM own LEFT JOIN theirs USING (bucket), sums
), weigh AS (SELECT doc_id, CAST(sum(gain) AS BIGINT) AS weight FROM e JOIN hashed USING (f) JOIN gain USING (bucket) GROUP BY 1),
scored AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) AS DOUBLE) + 0.5) / 4294967296))) AS BIGINT) AS score
  FROM d LEFT JOIN weigh USING (doc_id)
), r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * (SELECT count(*) FROM r) // 100 THEN rank END AS rank FROM scored LEFT JOIN r USING (doc_id)
"""
