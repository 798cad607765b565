"""Documents through language ID, near duplicates, decontamination, secrets and packing.

Each stage works on all that its predecessor kept and is written as Parquet in the shared folder, so a lost executor
costs no more than the stage at work. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import decontaminate, language, packing, secrets, trie_join
from quillspark.llm.common import cut, read, table_path


def _keyed(docs: DataFrame) -> DataFrame:
    """docs with row_key: a digest of the whole row, never null, so that stages judge rows and not ids."""
    whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), {"ignoreNullFields": "false"})
    return docs.withColumn("row_key", F.substring(F.unhex(F.sha2(whole, 256)), 1, 16))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language can't be told go. Rows are judged one by one; their ids, null or repeated, play no part."""
    keyed = _keyed(docs)
    rejected = cut(language.identify_documents(keyed, "row_key").where(~F.col("accepted")).select("row_key").distinct(), docs.count())
    return keyed.join(rejected, "row_key", "left_anti").select(docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows linked by near copies one with the smallest doc_id stays, a null one only where all are null.

    Rows of equal id are told apart by their contents: those of different texts that don't link stay all, those of
    linked texts become one, and so do equal rows, whatever their text.
    """
    if docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL").isEmpty():
        goes = cut(trie_join.jaccard_classes(docs).where("doc_id <> component_id").select("doc_id"), docs.count())
        return docs.join(goes, "doc_id", "left_anti").select(docs.columns)
    keyed = _keyed(docs).withColumn("row_id", F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key"))
    classes = trie_join.jaccard_classes(keyed, "row_id")
    goes = cut(classes.where("row_id <> component_id").select("row_id.row_key").distinct(), docs.count())
    kept = keyed.join(goes, "row_key", "left_anti").select(*docs.columns, "row_key")
    repeated = cut(keyed.groupBy("row_key").agg(F.count("*").alias("n")).where("n > 1").select("row_key"), docs.count())
    if repeated.isEmpty():
        return kept.select(docs.columns)
    once = kept.join(repeated, "row_key", "left_semi").dropDuplicates(["row_key"])
    return kept.join(repeated, "row_key", "left_anti").select(docs.columns).unionByName(once.select(docs.columns))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with a passage of a test item go. Rows are judged one by one; their ids, null or repeated, play no part."""
    return decontaminate.drop_leaks(docs, read(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row stays, null ids and equal rows too; its secrets are masked, and n_chars follows. Null texts stay null."""
    rest = [c for c in docs.columns if c != "text"]
    out = secrets.redact(docs.select(F.struct(*rest).alias("row"), "text"), "row", "text").select("row.*", "text")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each row goes, in tokens; rows with null or equal ids are packed each for itself."""
    import public_tokenizers

    return packing.pack_texts(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", keep_one_of_each_group),
    ("decontamination", drop_benchmark_leaks),
    ("secrets", mask_secrets),
    ("packing", pack_sequences),
]
#: SQL can't express these stages; tests/llm compares them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = table_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
