"""Streams give what batches give, and resume where they stopped."""

from pyspark.sql import functions as F

from quillspark.streaming import progress as P


def test_resume(spark, tmp_path):
    pages, out, mark = str(tmp_path / "pages"), str(tmp_path / "out"), str(tmp_path / "mark")
    schema = "source_id string, pdf_page int, text string"
    work = lambda df: P.flagged(df, "text")
    spark.createDataFrame([("s", 1, "x" * 300), ("s", 2, "short")], schema).coalesce(1).write.parquet(pages)
    P.resumable(spark, pages, schema, work, out, mark).awaitTermination()
    assert {(r.pdf_page, r.needs_ai_review) for r in spark.read.parquet(out).collect()} == {(1, False), (2, True)}
    spark.createDataFrame([("s", 3, "")], schema).coalesce(1).write.mode("append").parquet(pages)
    P.resumable(spark, pages, schema, work, out, mark).awaitTermination()
    assert sorted(r.pdf_page for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def test_late_quotes_once(spark, tmp_path):
    path = str(tmp_path / "q")
    rows = [("p1", "同 一", "2024-01-01 00:00:00"), ("p1", "同一", "2024-01-01 00:01:00"), ("p2", "同一", "2024-01-01 00:01:00"), ("p2", " ", "2024-01-01 00:02:00")]
    spark.createDataFrame(rows, "page string, quote string, at string").withColumn("at", F.to_timestamp("at")).write.parquet(path)
    stream = spark.readStream.schema("page string, quote string, at timestamp").parquet(path)
    q = P.late_quotes(stream, "page", "quote", "at", "1 hour").writeStream.format("memory").queryName("late").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.page for r in spark.sql("select * from late").collect()) == ["p1", "p2"]


def test_job_log_stream(spark, tmp_path):
    path = str(tmp_path / "e")
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(path)
    events = spark.read.parquet(path)
    q = P.windowed(spark.readStream.schema(events.schema).parquet(path)).writeStream.format("memory").queryName("win").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    key = lambda df: sorted((str(r.start), r.event_type, r.n) for r in df.collect())
    assert key(spark.sql("select * from win")) == key(P.windowed(events))
    assert P.sessions(events).agg(F.sum("n")).first()[0] == events.count()
