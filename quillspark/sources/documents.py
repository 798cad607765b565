"""Paginated documents as tables: pages (source_id, pdf_page, doc_id, text) and blocks (…, block_index, block)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.ordinals import numbered, ordinal


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A table of fewer files than cores, dealt to all cores: one file is often one row group, and so one task. A table
    of many files is left as it is."""
    n = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n) if len(df.inputFiles()) < n else df


def pages(docs: DataFrame, source: str = "source", order: str = "doc_id", text: str = "text", width: int = 1024) -> DataFrame:
    """One page for each row, numbered by order inside its source."""
    rows = docs.select(F.col(source).alias("source_id"), F.col(order).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return ordinal(rows, "pdf_page", ["source_id"], F.floor(F.col("doc_id") / width), "doc_id")


#: Text of a task that sources are dealt to, in bytes: its sorts and aggregates hold a multiple of that, and stay in memory.
TASK_BYTES = 4 << 20


def n_tasks(docs: DataFrame, text: str = "text") -> int:
    """How many tasks sources are dealt to: by the bytes of all texts, which one scan sums."""
    total = docs.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
    return max(docs.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_BYTES))


def pages_by_source(docs: DataFrame, tasks: int, source: str = "source", order: str = "doc_id", text: str = "text") -> DataFrame:
    """The same pages, dealt to tasks by source, which is bounded. Steps that stay inside a source move nothing after that;
    a given number of tasks isn't merged to fewer by adaptive execution, so that none of them has to spill."""
    rows = docs.select(F.col(source).alias("source_id"), F.col(order).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return numbered(rows.repartition(tasks, "source_id"), "pdf_page", ["source_id"], "doc_id")


def block_lines(text: Column) -> Column:
    """The non-blank lines of a page, cleaned."""
    return F.filter(F.transform(T.lines(text), T.clean_text), lambda x: x != "")


def blocks(pages: DataFrame) -> DataFrame:
    """The non-blank lines of each page, cleaned, numbered from 1."""
    rows = pages.select("source_id", "pdf_page", F.posexplode(block_lines(F.col("text"))).alias("pos", "block"))
    return rows.select("source_id", "pdf_page", (F.col("pos") + 1).alias("block_index"), "block")


def normalised(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with text in NFKC: once, at the source, so that all later keys are built-in functions."""
    return docs.withColumn(text, T.nfkc(F.col(text)))


def page_text(blocks: DataFrame) -> DataFrame:
    """Pages again from blocks: source_id, pdf_page, page_text."""
    parts = F.array_sort(F.collect_list(F.struct("block_index", "block")))
    return blocks.groupBy("source_id", "pdf_page").agg(F.array_join(F.transform(parts, lambda x: x["block"]), "\n").alias("page_text"))


def page_id(source: Column, page: Column) -> Column:
    return F.format_string("%s-P%04d", source, page)
