"""Token counts by a digest cache: texts are joined by digest to stored counts of the same tokenizer version,
only distinct misses are encoded, and their counts are appended to the cache.

A digest stands for the exact UTF-8 bytes of a text, since byte-level tokenizers tell apart all that differ; the only
normalisation is null to empty. Copies meet before the shuffle (partial aggregation), so that a text of which a third
of all rows are copies travels once per map task; on the way back the few digests of very many rows meet their counts by
broadcast. Stored counts lie apart by tokenizer version. Appends are Spark's own commits: a lost executor repeats its task
and leaves no half rows; a digest that two runs append twice counts once when read.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, read, small_batches, table_path

CACHE = "version string, digest binary, n_tokens long"
#: Characters handed to the tokenizer at once, unless one text is longer.
PART = 1 << 20
HOT = 1000


def encode_misses(misses: DataFrame, tokenizer_json: str, version: str) -> DataFrame:
    """misses: digest, text. tokenizer_json: the tokenizer's file, a few MB whatever the corpus."""
    spec = misses.sparkSession.sparkContext.broadcast(tokenizer_json)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(spec.value)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        for batch in batches:
            texts, counts, start = batch.column(1).to_pylist(), [], 0
            while start < len(texts):
                end, size = start, 0
                while end < len(texts) and (end == start or size + len(texts[end]) <= PART):
                    size += len(texts[end])
                    end += 1
                counts += [len(x) for x in tokenizer.encode_batch_fast(texts[start:end], add_special_tokens=False)]
                start = end
            yield pa.RecordBatch.from_arrays([pa.array([version] * len(texts), pa.string()), batch.column(0), pa.array(counts, pa.int64())], ["version", "digest", "n_tokens"])

    return misses.select("digest", "text").mapInArrow(work, CACHE)


def cached(spark: SparkSession, cache_path: str, version: str) -> DataFrame | None:
    """digest, n_tokens of one tokenizer version; None where there is no cache yet."""
    try:
        table = spark.read.schema(CACHE).parquet(cache_path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return table.where(F.col("version") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(df: DataFrame, cache_path: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, n_tokens for each row of df; the cache at cache_path then holds all its texts.

    A null text counts as empty. Rows with null or equal ids each give a row. Only the two columns are looked at.
    """
    spark = small_batches(df).sparkSession
    spec = Path(tokenizer_path).read_bytes()
    version = hashlib.sha256(spec).hexdigest()
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    keyed = rows.select("id", "text", F.unhex(F.sha2("text", 256)).alias("digest"))
    distinct = keyed.groupBy("digest").agg(F.first("text").alias("text"))
    known = cached(spark, cache_path, version)
    misses = distinct if known is None else distinct.join(known, "digest", "left_anti")
    encode_misses(misses, spec.decode(), version).write.mode("append").partitionBy("version").parquet(cache_path)
    known = cached(spark, cache_path, version)
    # fewer than HOT digests have more than 1 / HOT of all rows
    hot = keyed.groupBy("digest").agg(F.count("*").alias("copies")).where(F.col("copies") > max(64, rows.count() // HOT)).select("digest")
    hot = cut(known.join(hot, "digest", "left_semi").withColumnRenamed("n_tokens", "hot_tokens"), HOT)
    wanted = keyed.select("id", F.octet_length("text").cast("long").alias("n_bytes"), "digest").join(F.broadcast(hot), "digest", "left")
    common = wanted.where("hot_tokens is not null").select("id", "n_bytes", F.col("hot_tokens").alias("n_tokens"))
    others = wanted.where("hot_tokens is null").join(known, "digest").select("id", "n_bytes", "n_tokens")
    return common.unionByName(others).withColumnRenamed("id", id_col)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counts = count_tokens(read(spark, sf_dir, "documents"), table_path(spark, "token-cache"), public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)
