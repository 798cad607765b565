"""Page readings: cleaning, quality scores, reasons for review, the choice between two readings, and coverage checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

#: Lines that extraction leaves behind.
NOISE_LINES = (r"^<!--\s*image\s*-->$", r"^(?i)page\s+\d+\s+of\s+\d+$")


def cleaned_lines(text: Column, noise: tuple[str, ...] = NOISE_LINES) -> Column:
    """Lines without noise, and without any that repeats the last kept non-blank one; a fold over the page's lines."""
    rows = F.transform(T.lines(text), lambda x: F.regexp_replace(x, f"{T.S}+$", ""))
    if noise:
        rows = F.filter(rows, lambda x: ~T.strip(x).rlike("|".join(f"({p})" for p in noise)))
    start = F.struct(F.array().cast("array<string>").alias("kept"), F.lit("").alias("last"))

    def step(acc: Column, x: Column) -> Column:
        s = T.strip(x)
        return F.when((s != "") & (s == acc["last"]), acc).otherwise(F.struct(F.concat(acc["kept"], F.array(x)).alias("kept"), F.when(s != "", s).otherwise(acc["last"]).alias("last")))

    return F.aggregate(rows, start, step, lambda acc: acc["kept"])


def clean_page(text: Column, noise: tuple[str, ...] = NOISE_LINES) -> Column:
    return T.strip(F.regexp_replace(F.array_join(cleaned_lines(text, noise), "\n"), r"\n{3,}", "\n\n"))


def compact(s: Column) -> Column:
    return F.regexp_replace(s, f"{T.S}+", "")


def quality_score(cleaned: Column) -> Column:
    """Share of readable characters, length, structure and sentences against garbage and replacement characters; null
    for a page without any. The weights are fixed values. Half-even at three places, on decimals: binary ties may differ."""
    def score(text: Column) -> Column:
        count = lambda p: F.regexp_count(text, F.lit(p))
        sizes = F.struct(F.length(compact(text)).alias("all"), F.length(F.regexp_replace(text, f"[^0-9A-Za-z{T.CJK}]+", "")).alias("readable"))
        base = T.let(sizes, lambda n: F.when(n["all"] > 0, n["readable"] / n["all"] * 70.0 + F.least(F.lit(12.0), F.log10(F.greatest(n["readable"], F.lit(1)).cast("double")) * 4.0)))
        return (
            base + F.least(count(r"(?m)^(#{1,6}\s|[-*]\s|\|)"), F.lit(20)) * 0.25 + F.least(count("[。；：!?！？]"), F.lit(30)) * 0.15
            - count(r"[、，。,.()（）\[\]{}]{4,}") * 8.0 - count("�") * 20.0
        )

    return F.bround(T.let(cleaned, score), 3)


def review_reasons(markdown: Column, native_chars: Column, low_native: int = 200, fragment: str = r"(、\s*){3,}|([，。]\s*){4,}") -> Column:
    tests = [(native_chars < low_native, "low_native_text"), (F.length(T.strip(markdown)) < 150, "short_pdf_aware_output"), (F.contains(markdown, F.lit("�")), "replacement_character"), (markdown.rlike(fragment), "probable_fragment")]
    return F.array_compact(F.array(*[F.when(t, F.lit(n)) for t, n in tests]))


def canonical(readings: DataFrame, noise: tuple[str, ...] = NOISE_LINES) -> DataFrame:
    """readings: keys, primary, alternate (null: none), review_reasons. Adds the chosen text, its source and both scores."""
    rows = readings.withColumn("p", clean_page(F.coalesce("primary", F.lit("")), noise)).withColumn("a", clean_page(F.coalesce("alternate", F.lit("")), noise))
    rows = rows.withColumn("pdf_aware_score", quality_score(F.col("p"))).withColumn("full_page_score", quality_score(F.col("a")))
    gain = F.col("full_page_score") - F.col("pdf_aware_score")
    ratio = F.length(compact(F.col("a"))) / F.greatest(F.length(compact(F.col("p"))), F.lit(1))
    fragment = F.array_contains("review_reasons", "probable_fragment")
    better = ((gain >= 2.0) & (ratio >= 0.72)) | (fragment & (gain >= 0) & (ratio >= 0.65)) | (fragment & (gain >= 1.0))
    source = F.when(F.col("a") == "", "pdf_aware").when(F.col("p") == "", "full_page").when(better, "full_page").otherwise("pdf_aware")
    rows = rows.withColumn("canonical_source", source).withColumn("canonical_text", F.when(F.col("canonical_source") == "full_page", F.col("a")).otherwise(F.col("p")))
    return rows.drop("p", "a")


def join_readings(readings: DataFrame, keys: list[str]) -> DataFrame:
    """Long readings (keys, mode, markdown) as one row a page: primary and alternate; a missing alternate is null."""
    pick = lambda mode: F.max(F.when(F.col("mode") == mode, F.col("markdown")))
    return readings.groupBy(*keys).agg(pick("pdf_aware").alias("primary"), pick("full_page").alias("alternate")).where("primary is not null")


def needs_second_pass(pages: DataFrame) -> DataFrame:
    """The pages for which a second reading is worth its cost."""
    return pages.where(F.size("review_reasons") > 0)


def coverage(expected: DataFrame, done: DataFrame, markers: DataFrame, review: DataFrame, keys: list[str], texts: DataFrame | None = None, failures: DataFrame | None = None) -> DataFrame:
    """Per source: expected pages (source_id, page_start, page_end) without a finished page, a marker or a review marker;
    replacement characters in the texts (source_id, text) and failed pages (source_id). It passes when there is none."""
    pages = expected.select("source_id", F.explode(F.sequence("page_start", "page_end")).alias("pdf_page"))
    missing = lambda base, other, name: base.join(other.select(*keys).distinct(), keys, "left_anti").groupBy("source_id").agg(F.array_sort(F.collect_list("pdf_page")).alias(name))
    out = pages.groupBy("source_id").agg(F.count("*").alias("expected_pages"))
    wanted = pages.join(review.select(*keys).distinct(), keys, "left_semi")
    for part in (missing(pages, done, "missing_pages"), missing(pages, markers, "missing_page_markers"), missing(wanted, markers, "missing_review_page_markers")):
        out = out.join(part, "source_id", "left")
    names = ["missing_pages", "missing_page_markers", "missing_review_page_markers"]
    if texts is not None:
        out = out.join(texts.groupBy("source_id").agg(F.sum(F.regexp_count("text", F.lit("\ufffd"))).alias("replacement_characters")), "source_id", "left")
    if failures is not None:
        out = out.join(failures.groupBy("source_id").agg(F.count("*").alias("page_failures")), "source_id", "left")
    counts = ["replacement_characters", "page_failures"]
    out = out.select("source_id", "expected_pages", *[F.coalesce(n, F.array().cast("array<bigint>")).alias(n) for n in names], *[F.coalesce(F.col(n) if n in out.columns else F.lit(None), F.lit(0)).cast("long").alias(n) for n in counts])
    return out.withColumn("pass", (F.size(names[0]) == 0) & (F.size(names[1]) == 0) & (F.size(names[2]) == 0) & (F.col(counts[0]) == 0) & (F.col(counts[1]) == 0))


def reports(summary: DataFrame, failed: DataFrame) -> DataFrame:
    """One line and exit code per source: its counts (candidates.summary), or the first of its failures (source_id, ord,
    message)."""
    first = failed.groupBy("source_id").agg(F.min_by("message", "ord").alias("message"))
    count = lambda label, c: F.concat(F.lit(f" {label}="), F.col(c).cast("string"))
    line = F.concat(F.lit("PASS: candidate pack created |"), *[count(a, b) for a, b in (("pages", "page_count"), ("candidate_pages", "candidate_page_count"), ("candidates", "candidate_count"), ("unreadable", "unreadable_page_count"), ("visual_pending", "visual_pending_page_count"))])
    rows = summary.join(first, "source_id", "full")
    return rows.select("source_id", F.when(F.col("message").isNull(), line).otherwise(F.concat(F.lit("FAIL: "), "message")).alias("report"), F.when(F.col("message").isNull(), 0).otherwise(1).alias("exit_code"))


def consecutive_duplicates(blocks: DataFrame) -> DataFrame:
    """Lines that repeat the line before them on their page."""
    w = Window.partitionBy("source_id", "pdf_page").orderBy("block_index")
    return blocks.withColumn("before", F.lag("block").over(w)).where("block = before").drop("before")


def progress(pages: DataFrame, totals: DataFrame) -> DataFrame:
    """pages: source_id, pdf_aware_status, full_page_status, error. Per source: done, total, review, failures, percent."""
    out = pages.groupBy("source_id").agg(F.count_if(F.col("pdf_aware_status") == "complete").alias("done"), F.count_if(F.col("full_page_status") == "complete").alias("review"), F.count_if(F.coalesce("error", F.lit("")) != "").alias("failures"))
    out = totals.join(out, "source_id", "left").fillna(0, ["done", "review", "failures"])
    return out.select("source_id", "done", "total", "review", "failures", F.when(F.col("total") > 0, F.bround(F.col("done") * 100 / F.col("total"), 1)).otherwise(0.0).alias("percent"))
