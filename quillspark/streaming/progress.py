"""Work that arrives bit by bit, as Structured Streaming: page checkpoints with resume, late transcriptions, job logs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import text as T
from ..operators.quality import review_reasons


def resumable(spark: SparkSession, source: str, schema: str, work: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, files: int = 16) -> StreamingQuery:
    """Runs work over the files that no earlier run finished, then stops: the checkpoint is the manifest of done pages."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(source)
    return work(rows).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def open_pages(pages: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """The same as a batch: pages that aren't complete, or lack the review that they need."""
    good = done.where("pdf_aware_status = 'complete' AND (NOT needs_ai_review OR full_page_status = 'complete')")
    return pages.join(good.select(*keys), keys, "left_anti")


def late_quotes(stream: DataFrame, page: str, quote: str, at: str, delay: str) -> DataFrame:
    """Transcribed chunks as they come, the first of each page and key; keys are remembered for `delay`."""
    keyed = stream.withColumn("quote_key", T.semantic_key(F.col(quote))).where("quote_key <> ''")
    return keyed.withWatermark(at, delay).dropDuplicatesWithinWatermark([page, "quote_key"])


def flagged(pages: DataFrame, text: str, low: int = 200) -> DataFrame:
    """Pages with their reasons for review: stateless, so the same for streams and tables."""
    body = F.coalesce(text, F.lit(""))
    return pages.withColumn("review_reasons", review_reasons(body, F.length(body), low)).withColumn("needs_ai_review", F.size("review_reasons") > 0)


def job_log(events: DataFrame, job: str = "user_id", at: str = "ts", kind: str = "event_type", error: str = "error") -> DataFrame:
    """Per job its steps, failures and last step; works on streams in update mode."""
    return events.groupBy(job).agg(F.count("*").alias("steps"), F.count_if(F.col(kind) == error).alias("failures"), F.max_by(kind, at).alias("last_step"), F.max(at).alias("last_at"))


def failure_messages(log: DataFrame, job: str, line: str, order: str, fallback: str = "failed") -> DataFrame:
    """Per job the message of its last diagnostic line, else fallback."""
    rows = log.withColumn("d", T.parse_diagnostic(F.col(line)))
    out = rows.groupBy(job).agg(F.max_by("d", F.when(F.col("d").isNotNull(), F.col(order))).alias("d"))
    return out.select(job, F.coalesce(F.concat("d.code", F.lit("："), "d.message", F.lit(" "), "d.action"), F.lit(fallback)).alias("message"))


def windowed(events: DataFrame, at: str = "ts", width: str = "1 hour", late: str | None = None, kind: str = "event_type") -> DataFrame:
    """Steps by tumbling window and kind; late: a watermark, for streams."""
    rows = events.withColumn(at, F.col(at).cast("timestamp"))
    rows = rows.withWatermark(at, late) if late else rows
    out = rows.groupBy(F.window(at, width).alias("w"), kind).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), kind, "n", "total")


def sessions(events: DataFrame, job: str = "user_id", at: str = "ts", gap: str = "30 minutes", late: str | None = None) -> DataFrame:
    """Runs of a job's events with no pause over gap."""
    rows = events.withColumn(at, F.col(at).cast("timestamp"))
    rows = rows.withWatermark(at, late) if late else rows
    out = rows.groupBy(F.session_window(at, gap).alias("w"), job).agg(F.count("*").alias("n"))
    return out.select(job, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")
