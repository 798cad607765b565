"""Quality classifier by importance resampling: the ratio of hashed n-gram generative models for target and raw text,
sampled by Gumbel top-k (Xie et al., 2023).

1. Words and word pairs are hashed to 2**BITS features. Raw shares are counted over all documents, target shares over
   the target documents; both are added up by feature, at most 2**BITS rows a task.
2. A document's log weight is the log ratio of the two models: the sum over its features of log target share - log raw
   share. A long document's weight would be that of a short one to the power of their lengths' ratio, and length would
   decide what is drawn. So documents are drawn by the weight of a passage of PASSAGE of their features: the log weight
   tempered by PASSAGE / n_features.
3. The k documents with the largest tempered log weight + Gumbel noise are a sample without replacement by weight. The
   noise comes from a hash of id, text and seed, so a rerun task draws the same. The k-th key is found by counting keys
   in ever finer ranges, a few thousand counts a round; nothing is sorted in one place. Of ties at the k-th key, which
   only equal rows have, as many are drawn as are wanted, by their place in the written table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, grams, read, small_batches, word_hashes

BITS = 15
#: Labelled rows that the target model may be fitted on; of more, those with the smallest hashes of their ids.
TARGET_ROWS = 20_000
STEPS = 4096
#: Features of the passage by whose weight a document is drawn.
PASSAGE = 20


def features(text: str | None) -> np.ndarray:
    h = word_hashes(text)
    return (np.concatenate([grams(h, 1), grams(h, 2)]) >> np.uint64(64 - BITS)).astype(np.int64)


def _count(df: DataFrame, flag: Column) -> np.ndarray:
    """Feature counts of all rows and of those with flag: 2 x 2**BITS numbers."""
    rows = df.select("text", F.coalesce(flag, F.lit(False)).alias("flag"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << BITS), np.int64)
        for batch in batches:
            for x, flag in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                f = features(x.as_py())
                for own in counts[: 1 + flag]:
                    if len(f) < 3000:
                        np.add.at(own, f, 1)
                    else:
                        own += np.bincount(f, minlength=1 << BITS)
        at = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[0][at]), pa.array(counts[1][at])], ["feature", "raw", "target"])

    found = rows.mapInArrow(work, "feature long, raw long, target long").groupBy("feature").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    out = np.zeros((2, 1 << BITS))
    out[:, found["feature"].to_numpy(np.int64)] = found[["raw", "target"]].to_numpy(np.float64).T
    return out


def log_ratio(counts: np.ndarray, weight: float = 0.05 * (1 << BITS)) -> np.ndarray:
    """log target share - log raw share by feature; 0 where there are no target texts. The target share is mixed with
    `weight` features' worth of the raw share, so that a feature which the target happens to lack has a finite ratio."""
    raw, target = (counts[0] + 0.5) / (counts[0] + 0.5).sum(), counts[1]
    n = target.sum()
    return np.log((target + weight * raw) / (n + weight) / raw) if n else np.zeros(len(raw))


def kth_largest(keys: DataFrame, k: int) -> float:
    """The k-th largest value of column key (double, no nulls or NaN; 1 <= k <= rows): each round counts keys in STEPS
    ranges between the smallest and the largest that are left, and goes on inside one of them."""
    low, high = keys.agg(F.min("key"), F.max("key")).first()
    while low < high:
        left = keys.where(F.col("key").between(low, high))
        step = F.width_bucket("key", F.lit(low), F.lit(high), F.lit(STEPS))
        counts = left.groupBy(step.alias("step")).agg(F.count("*").alias("c"), F.min("key").alias("low"), F.max("key").alias("high"))
        for r in sorted(counts.collect(), key=lambda r: -r["step"]):
            if k <= r["c"]:
                low, high = r["low"], r["high"]
                break
            k -= r["c"]
    return low


def resample(df: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: float = 0.8, passage: int = PASSAGE, seed: int = 1) -> DataFrame:
    """For each row its id, n_features, log_weight, sample_key and selected; exactly round(keep * rows) are selected.

    target: ids of target rows (a row's repeats count once); at most TARGET_ROWS of them fit the target model. Rows of
    equal id and text have the same key. A null or empty text has no features and log weight 0. A null id is an id like
    others, but never a target. Other columns of both tables are not looked at.
    """
    docs = small_batches(df).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    ids = target.select(F.col(id_col).alias("id")).where(F.col("id").isNotNull()).distinct()
    few = ids.orderBy(F.xxhash64("id"), "id").limit(TARGET_ROWS).withColumn("flag", F.lit(True))
    ratio = log_ratio(_count(docs.join(F.broadcast(few), "id", "left"), F.col("flag")))
    shared = df.sparkSession.sparkContext.broadcast(ratio)
    kind = docs.schema["id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = shared.value
        for batch in batches:
            found = [features(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array([len(f) for f in found], pa.int64()), pa.array([float(ratio[f].sum()) for f in found], pa.float64())], ["id", "noise", "n_features", "log_weight"])

    scored = docs.select("id", F.xxhash64("id", "text", F.lit(seed)).alias("noise"), "text").mapInArrow(work, f"id {kind}, noise long, n_features long, log_weight double")
    uniform = (F.pmod("noise", F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
    tempered = F.col("log_weight") * passage / F.greatest("n_features", F.lit(1))
    scored = cut(scored.select("id", "n_features", "log_weight", (tempered - F.log(-F.log(uniform))).alias("key"), F.monotonically_increasing_id().alias("place")))
    k = round(keep * scored.count())
    limit = kth_largest(scored, k) if k else float("inf")
    chosen = F.col("key") >= limit
    extra = scored.where(chosen).count() - k
    if extra:
        ties = scored.where(F.col("key") == limit).select((-F.col("place")).cast("double").alias("key"))
        chosen = (F.col("key") > limit) | ((F.col("key") == limit) & (-F.col("place") >= kth_largest(ties, ties.count() - extra)))
    return scored.select(F.col("id").alias(id_col), "n_features", "log_weight", F.col("key").alias("sample_key"), chosen.alias("selected"))


def op6_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels").where("quality = 1 and toxic = 0"))
