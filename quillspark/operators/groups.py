"""Evidence groups: copies merged into records, records packed page by page, groups packed into reading batches.

A source is one document: a page's records, and a source's group sizes, are gathered to one row and folded there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .ordinals import numbered, ordinal

MAX_CANDIDATES, MAX_CHARS = 12, 4800
MAX_GROUPS, MAX_BATCH_CHARS = 12, 28_000
#: Columns of a record that its group's segments have.
SEGMENT = ("candidate_ids", "pdf_pages", "context_headings", "quote", "system_hints", "space_hints", "business_axes", "preservation_terms", "source_shape", "origin_kinds", "source_confidences", "text_quality_flags", "signal_flags")
#: Arrays of a record that are ordered distinct unions over its candidates.
UNIONS = ("system_hints", "space_hints", "matched_terms", "preservation_terms", "business_axes", "text_quality_flags", "obligation_terms", "neighbor_candidate_ids", "signal_flags")


def in_order(value: str, order: str = "serial") -> Column:
    """Aggregate: the values in order."""
    return F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("v")))), lambda x: x["v"])


def records(cands: DataFrame, unions: tuple[str, ...] = UNIONS) -> DataFrame:
    """Candidates with the same quote (white space and case aside) in one source as one record, placed by the first; with
    those of the arrays in UNIONS that are asked for."""
    keyed = cands.withColumn("key", F.lower(F.regexp_replace("chunk", f"{T.S}+", "")))
    if "origin_kind" not in keyed.columns:
        keyed = keyed.withColumn("origin_kind", F.lit("source"))
    if "confidence" not in keyed.columns:
        keyed = keyed.withColumn("confidence", F.lit("not_applicable"))
    held = F.struct("serial", "chunk", "source_shape", "candidate_id", "pdf_page", "heading", "heading_basis", "origin_kind", "confidence", *unions)
    one = lambda c, name: F.array_distinct(F.col(f"own.{c}")).alias(name)
    out = keyed.groupBy("source_id", "key").agg(F.array_sort(F.collect_list(held)).alias("own")).select(
        "source_id", "key", F.col("own")[0]["serial"].alias("ord"), F.col("own")[0]["chunk"].alias("quote"), F.col("own")[0]["source_shape"].alias("source_shape"), F.col("own.candidate_id").alias("candidate_ids"),
        one("pdf_page", "pdf_pages"), one("heading", "context_headings"), one("heading_basis", "context_heading_bases"), one("origin_kind", "origin_kinds"), one("confidence", "source_confidences"),
        *[F.array_distinct(F.flatten(f"own.{c}")).alias(c) for c in unions],
    )
    near = F.col("neighbor_candidate_ids")
    if "neighbor_candidate_ids" in unions:
        out = out.withColumn("neighbor_candidate_count", F.size(near)).withColumn("neighbor_candidate_ids", F.slice(near, 1, 12))
    return numbered(out.drop("key"), "record_no", ["source_id"], "ord")


def packed(items: Column, weights: tuple[tuple[str, int], ...]) -> Column:
    """The bins, as arrays of items: a new one begins when an item would take any weight over its limit. The fold holds
    the places where bins begin, so that an array is copied once a bin."""
    first = F.struct(F.array().cast("array<int>").alias("starts"), F.lit(0).alias("at"), *[F.lit(0).cast("long").alias(n) for n, _ in weights])

    def step(acc: Column, x: Column) -> Column:
        over = F.lit(False)
        for name, limit in weights:
            over = over | (acc[name] + x[name] > limit)
        fresh = (acc["at"] == 0) | over
        sums = [F.when(fresh, x[n].cast("long")).otherwise(acc[n] + x[n]).alias(n) for n, _ in weights]
        return F.struct(F.when(fresh, F.concat(acc["starts"], F.array(acc["at"]))).otherwise(acc["starts"]).alias("starts"), (acc["at"] + 1).alias("at"), *sums)

    starts = F.aggregate(items, first, step, lambda acc: F.concat(acc["starts"], F.array(acc["at"])))
    return T.let(starts, lambda s: F.transform(F.slice(s, 1, F.size(s) - 1), lambda a, i: F.slice(items, a + 1, F.element_at(s, i + 2) - a)))


def groups(recs: DataFrame, max_candidates: int = MAX_CANDIDATES, max_chars: int = MAX_CHARS) -> DataFrame:
    """Records packed inside runs of one first page, never split; with the records before and after as context.

    A run's records are packed as they are, each with its neighbours' texts, so records are read once and joined with nothing.
    Records that have chars in place of a quote give groups without texts."""
    rows = recs if "chars" in recs.columns else recs.withColumn("chars", F.length("quote").cast("long"))
    rows = rows.withColumn("page", F.col("pdf_pages")[0]).withColumn("cands", F.size("candidate_ids").cast("long"))
    rows = rows.withColumn("ocr", ~F.array_contains("origin_kinds", "source"))  # recognised text follows the native text
    w = Window.partitionBy("source_id").orderBy("record_no")
    context, no = F.struct("candidate_ids", *(["quote"] if "quote" in rows.columns else [])), F.col("record_no")
    rows = rows.withColumn("before", F.when(F.lag("record_no").over(w) == no - 1, F.lag(context).over(w))).withColumn("after", F.when(F.lead("record_no").over(w) == no + 1, F.lead(context).over(w)))
    segment = F.struct("record_no", *[c for c in SEGMENT if c in rows.columns])
    item = F.struct("record_no", "chars", "cands", segment.alias("segment"), "before", "after")
    runs = rows.groupBy("source_id", "ocr", "page").agg(F.array_sort(F.collect_list(item)).alias("items"))
    runs = runs.select("source_id", F.explode_outer(packed(F.col("items"), (("chars", max_chars), ("cands", max_candidates)))).alias("own"))  # outer: see T.each
    out = runs.select("source_id", F.col("own.segment").alias("segments"), F.col("own")[0]["record_no"].alias("first"), F.col("own")[0]["before"].alias("leading_context"), F.element_at("own", -1)["after"].alias("trailing_context"))
    out = numbered(out, "group_no", ["source_id"], "first")
    flat = lambda name: F.flatten(F.transform("segments", lambda s: s[name]))
    return out.select(
        "source_id", "group_no", F.format_string("EGRP-%04d", "group_no").alias("evidence_group_id"), flat("candidate_ids").alias("route_candidate_ids"), F.array_distinct(flat("pdf_pages")).alias("pdf_pages"),
        F.array_distinct(flat("context_headings")).alias("section_path"), "leading_context", "segments", "trailing_context", F.lit(None).cast("array<string>").alias("route_visual_region_ids"),
    )


def draft_groups(regions: DataFrame, after: DataFrame) -> DataFrame:
    """A group without context for each region with a draft that is neither read nor skipped, numbered after `after`."""
    rows = regions.withColumn("draft", T.clean_text(F.col("ocr_draft"))).where("draft <> '' AND status NOT IN ('read', 'skipped_non_text')")
    rows = ordinal(rows, "k", ["source_id"], F.floor(F.col("pdf_page") / 64), "pdf_page", "region_id")
    base = after.groupBy("source_id").agg(F.max("group_no").alias("n"))
    rows = rows.join(base, "source_id", "left").withColumn("group_no", F.coalesce("n", F.lit(0)) + F.col("k"))
    none = F.array().cast("array<string>")
    values = {"record_no": F.lit(0).cast("long"), "candidate_ids": none, "pdf_pages": F.array(F.col("pdf_page").cast("long")), "context_headings": F.array("context_heading"), "quote": F.col("draft"), "source_shape": F.lit("visual_ocr_draft"), "origin_kinds": F.array(F.lit("source_ocr_draft")), "source_confidences": F.array(F.coalesce("confidence", F.lit("low"))), "text_quality_flags": F.array(F.lit("低信心 OCR 草稿，僅供覆核"))}
    fields = after.schema["segments"].dataType.elementType.fields
    segment = F.struct(*[values.get(f.name, none).cast(f.dataType.simpleString()).alias(f.name) for f in fields])
    made = {"group_no": F.col("group_no"), "source_id": F.col("source_id"), "evidence_group_id": F.format_string("EGRP-%04d", "group_no"), "pdf_pages": values["pdf_pages"], "section_path": values["context_headings"], "segments": F.array(segment), "route_visual_region_ids": F.array("region_id"), "route_candidate_ids": none}
    return rows.select(*[made.get(f.name, F.lit(None)).cast(f.dataType.simpleString()).alias(f.name) for f in after.schema.fields])


def candidate_view(cands: DataFrame, regions: DataFrame | None = None) -> DataFrame:
    """Records, groups, and groups of drafts."""
    found = groups(records(cands))
    return found if regions is None else found.unionByName(draft_groups(regions, found))


def outline(grouped: DataFrame) -> DataFrame:
    """Of each group its sorted distinct pages, shapes and origins."""
    return grouped.select(
        "source_id", "evidence_group_id", F.array_sort(F.array_distinct("pdf_pages")).alias("pdf_pages"), "section_path",
        F.array_sort(F.array_distinct(F.transform("segments", lambda s: s["source_shape"]))).alias("source_shapes"), F.array_sort(F.array_distinct(F.flatten(F.transform("segments", lambda s: s["origin_kinds"])))).alias("origin_kinds"),
    )


def screening_batches(sized: DataFrame, max_groups: int = MAX_GROUPS, max_chars: int = MAX_BATCH_CHARS) -> DataFrame:
    """sized: source_id, group_no, evidence_group_id, pdf_pages, chars. Bins of at most max_groups and max_chars, in order;
    where sized has markdown, body is that of the bin's groups."""
    if max_groups < 1 or max_chars < 4000:
        raise ValueError("screening batch limits are too small")
    item = F.struct("group_no", F.col("chars").cast("long").alias("chars"), F.lit(1).cast("long").alias("one"), "evidence_group_id", "pdf_pages", *(["markdown"] if "markdown" in sized.columns else []))
    rows = sized.groupBy("source_id").agg(F.array_sort(F.collect_list(item)).alias("items"))
    rows = T.each(rows.select("source_id", packed(F.col("items"), (("one", max_groups), ("chars", max_chars))).alias("bins")), "bins", "k", "own")
    return rows.select(
        "source_id", F.format_string("SB-%03d", F.col("k") + 1).alias("batch_id"), F.col("own.evidence_group_id").alias("evidence_group_ids"),
        F.array_sort(F.array_distinct(F.flatten("own.pdf_pages"))).alias("pdf_pages"), F.aggregate("own.chars", F.lit(0).cast("long"), lambda a, x: a + x).alias("source_chars"),
        *([F.array_join("own.markdown", "\n").alias("body")] if "markdown" in sized.columns else []),
    )
