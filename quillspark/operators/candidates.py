"""From chunks to candidates, claims and evidence: hints, scores that never exclude, headings, serial ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicon as L
from ..functions import text as T
from ..sources.documents import page_id
from .ordinals import numbered

STOP_TERMS = ("PDF", "PAGE", "THE", "AND", "FOR")


def is_heading(line: Column, lex: L.Lexicon = L.DOMAIN) -> Column:
    """Whether a line can be a heading: short, no obligation, no sentence; numbered, or with a heading term."""

    def test(s: Column) -> Column:
        key = T.semantic_key(s)
        no = s.rlike(rf"^[\d{T.SPACE}./\-–—()（）%]+$") | L.has_obligation(s, key, lex) | s.rlike(T.SENTENCE_END + "$") | (F.regexp_count(s, F.lit("[，,：:]")) >= 3)
        yes = s.rlike(r"^第.{1,12}[章節篇]") | s.rlike(rf"^\d+([.\-]\d+){{1,5}}\s*[{T.CJK}A-Za-z]") | s.rlike(rf"^\d+[、.]\s*[{T.CJK}A-Za-z]{{2,}}")
        return F.length(s).between(2, 90) & ~no & (yes | L.any_term(key, lex.headings + lex.plain_headings))

    return T.let(T.clean_text(line), test)


def context_headings(blocks: DataFrame, lex: L.Lexicon = L.DOMAIN, keep: tuple[str, ...] = ()) -> DataFrame:
    """For each block the heading above it: the last one of earlier blocks of its page, else the first of the page, else
    a fallback; its basis; and the columns in keep. A page's blocks are one window: pages are small whatever the corpus."""
    heads = F.filter(T.lines(F.col("block")), lambda x: is_heading(x, lex))
    ends = T.let(heads, lambda h: F.struct(F.try_element_at(h, F.lit(1)).alias("first"), F.try_element_at(h, F.lit(-1)).alias("last")))
    rows = blocks.select("source_id", "pdf_page", "block_index", *keep, ends.alias("h")).select("source_id", "pdf_page", "block_index", *keep, "h.first", "h.last")
    w = Window.partitionBy("source_id", "pdf_page").orderBy("block_index")
    before = F.last("last", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    on_page = F.first("first", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    basis = F.when(before.isNotNull(), "preceding_heading").when(on_page.isNotNull(), "page_heading").otherwise("page_fallback")
    heading = F.coalesce(T.clean_text(before), T.clean_text(on_page), F.format_string("PDF page %d", "pdf_page"))
    return rows.select("source_id", "pdf_page", "block_index", *keep, heading.alias("heading"), basis.alias("heading_basis"))


def page_headings(blocks: DataFrame, lex: L.Lexicon = L.DOMAIN) -> DataFrame:
    """For each page its last heading, else a fallback."""
    last = F.try_element_at(F.filter(T.lines(F.col("block")), lambda x: is_heading(x, lex)), F.lit(-1))
    rows = blocks.select("source_id", "pdf_page", "block_index", last.alias("last"))
    found = rows.groupBy("source_id", "pdf_page").agg(F.max_by("last", F.when(F.col("last").isNotNull(), F.col("block_index"))).alias("h"))
    basis = F.when(F.col("h").isNotNull(), "preceding_heading").otherwise("page_fallback")
    return found.select("source_id", "pdf_page", F.coalesce(T.clean_text(F.col("h")), F.format_string("PDF page %d", "pdf_page")).alias("heading"), basis.alias("heading_basis"))


def dynamic_terms(chunks: DataFrame, lex: L.Lexicon = L.DOMAIN, top: int = 80, least: int = 2) -> DataFrame:
    """source_id, term, n: each source's own acronyms, of chunks with a system or semantic term; the `top` most frequent,
    first seen first among equals, if they occur `least` times. Counts are partial before the shuffle; the ranking is over terms."""
    key = T.semantic_key(F.col("chunk"))
    speaks = L.any_term(key, lex.semantic + [t for ts in lex.systems.values() for t in ts])
    codes = F.regexp_extract_all(F.upper("chunk"), F.lit(r"(\b[A-Z][A-Z0-9+./_-]{1,14}\b)"), F.lit(1))
    rows = chunks.where(speaks).select("source_id", F.struct("pdf_page", "block_index", "chunk_index").alias("at"), F.posexplode(codes).alias("pos", "term")).where(~F.col("term").isin(*STOP_TERMS))
    counts = rows.groupBy("source_id", "term").agg(F.count("*").alias("n"), F.min(F.struct("at", "pos")).alias("seen"))
    rank = F.row_number().over(Window.partitionBy("source_id").orderBy(F.desc("n"), "seen"))
    return counts.withColumn("rank", rank).where((F.col("rank") <= top) & (F.col("n") >= least)).select("source_id", "term", "n")


def term_pages(chunks: DataFrame, terms: DataFrame) -> DataFrame:
    """term_id, term, source_page_ids: pages whose chunks contain the term. terms has at most 80 rows a source, so it is
    gathered to one array per source and joined by source; matching is a filter inside the row."""
    keyed = terms.groupBy("source_id").agg(F.collect_list(F.struct("term", T.semantic_key(F.col("term")).alias("key"))).alias("terms"))
    rows = chunks.where(~F.col("is_navigation")).select("source_id", "pdf_page", T.semantic_key(F.col("chunk")).alias("chunk_key"))
    hits = rows.join(keyed, "source_id").select("source_id", "pdf_page", F.explode(F.filter("terms", lambda t: F.contains(F.col("chunk_key"), t["key"]))).alias("t"))
    found = hits.groupBy("source_id", F.col("t.term").alias("term")).agg(F.array_sort(F.collect_set(page_id(F.col("source_id"), F.col("pdf_page")))).alias("source_page_ids"))
    out = terms.select("source_id", "term").join(found, ["source_id", "term"], "left")
    serial = F.row_number().over(Window.partitionBy("source_id").orderBy("term"))
    return out.select("source_id", F.format_string("TERM-%04d", serial).alias("term_id"), "term", F.coalesce("source_page_ids", F.array().cast("array<string>")).alias("source_page_ids"))


def preservation_terms(text: Column, lex: L.Lexicon = L.DOMAIN, key: Column | None = None) -> Column:
    """Terms that a translation must not lose: systems' and capabilities' terms, and codes; ordered, distinct, not generic."""
    key = T.semantic_key(text) if key is None else key
    named = [t for table in (lex.systems, lex.capabilities) for ts in table.values() for t in ts]
    terms = F.concat(F.array_compact(F.array(*[F.when(T.term_present(t, text, key), F.lit(t)) for t in named])), T.latin_codes(text))
    keep = F.filter(terms, lambda t: (F.length(t) >= 2) & ~F.lower(t).isin(*lex.generic))
    return F.array_distinct(keep)


def signal_flags(text: Column, n_systems: Column, lex: L.Lexicon = L.DOMAIN, key: Column | None = None) -> Column:
    key, low = T.semantic_key(text) if key is None else key, F.lower(text)
    # fixed value: what a specification looks like
    unit = low.rlike(r"(\d+(\.\d+)?\s*(mhz|ghz|mbps|gbps|mm|cm|m|v|a|w)\b|iso\s*\d+|ieee\s*[\d.]+)")
    open_end = (F.length(text) < 120) & ~text.rlike(r"[.?!。！？；;:]」?）?\s*$")
    flags = [(L.any_term(key, lex.negations), "negation_or_exclusion"), (L.any_term(key, lex.conditions), "condition_or_exception"), (n_systems >= 2, "cross_system"), (unit, "specification_signal"), (open_end, "possible_fragment")]
    return F.array_compact(F.array(*[F.when(test, F.lit(name)) for test, name in flags]))


def ocr_flags(text: Column, confidence: Column, mean_confidence: Column, lex: L.Lexicon = L.DOMAIN) -> Column:
    s = T.clean_text(text)
    sure = F.coalesce(F.lower(confidence) == "high", F.lit(False)) | F.coalesce(mean_confidence >= 72.0, F.lit(False))
    whole = (F.length(s) >= 10) & L.has_obligation(s, T.semantic_key(s), lex) & s.rlike(r"[。！？；;：:]」?）?\s*$")
    return F.when(sure & whole, F.array().cast("array<string>")).otherwise(F.array(F.lit("ocr_fragment")))


def enriched(chunks: DataFrame, headings: DataFrame, terms: DataFrame | None = None, lex: L.Lexicon = L.DOMAIN) -> DataFrame:
    """Chunks that don't only navigate, with heading, hints and score. terms: each source's dynamic terms."""
    return hinted(chunks.where(~F.col("is_navigation")).join(headings, ["source_id", "pdf_page", "block_index"]), terms, lex)


def hinted(rows: DataFrame, terms: DataFrame | None = None, lex: L.Lexicon = L.DOMAIN, keep: tuple[str, ...] = ()) -> DataFrame:
    """rows (chunk, heading and their places) with hints and score, and the columns in keep."""
    if terms is not None:
        own = terms.groupBy("source_id").agg(F.collect_list(F.struct("term", T.semantic_key(F.col("term")).alias("key"))).alias("terms"))
        rows = rows.join(own, "source_id", "left")
        dynamic = F.transform(F.filter(F.coalesce("terms", F.array()), lambda t: F.contains(F.col("key"), t["key"])), lambda t: t["term"])
    else:
        dynamic = F.array().cast("array<string>")
    chunk, key = F.col("chunk"), F.col("key")
    rows = rows.withColumn("key", T.semantic_key(chunk)).withColumn("heading_key", T.semantic_key(F.col("heading")))
    rows = rows.select(
        "*", L.categories(key, lex.systems).alias("system_hints"), L.system_terms(key, lex).alias("system_terms"), L.matched(key, lex.semantic).alias("semantic"),
        L.categories(key, lex.capabilities).alias("business_axes"), L.obligations(chunk, key, lex).alias("obligation_terms"), L.matched(key, lex.interfaces).alias("interfaces"), dynamic.alias("dynamic"),
        L.categories(key, lex.spaces).alias("direct_spaces"), L.categories(F.col("heading_key"), lex.spaces).alias("heading_spaces"),
    )
    n = lambda c: F.size(c)
    one = lambda test: F.when(test, 1).otherwise(0)
    # fixed values: the weights of the score
    score = (
        F.least(F.lit(6), n("system_terms") * 2) + one(n("semantic") > 0) + one(n("business_axes") > 0) + one(n("business_axes") >= 2) + one(n("obligation_terms") > 0)
        + one(L.any_term(F.col("heading_key"), lex.headings)) * 2 + one((n("interfaces") > 0) & (n("semantic") > 0)) + one((n("dynamic") > 0) & ((n("semantic") > 0) | (n("obligation_terms") > 0)))
    )
    return rows.select(
        *keep, "source_id", "pdf_page", "block_index", "chunk_index", "chunk", "heading", "heading_basis", score.alias("score"), "system_hints", "business_axes", "obligation_terms",
        F.array_sort(F.array_distinct(F.concat("system_terms", "semantic", "business_axes", "interfaces", "dynamic"))).alias("matched_terms"),
        preservation_terms(chunk, lex, key).alias("preservation_terms"), signal_flags(chunk, n("system_hints"), lex, key).alias("signal_flags"),
        F.array_union("direct_spaces", "heading_spaces").alias("space_hints"),
        F.when(n("direct_spaces") > 0, "explicit").when(n("heading_spaces") > 0, "inherited").otherwise("none").alias("space_hint_basis"),
        F.when(n("system_hints") > 0, F.col("system_hints")[0]).otherwise(F.lit(lex.no_system)).alias("topic_hint"),
        F.when(n("system_hints") > 0, "inferred").otherwise("none").alias("system_hint_basis"),
        F.when(F.size(T.lines(chunk)) >= 4, "table_block").otherwise("sentence").alias("source_shape"),
        F.when(n("system_hints") >= 3, F.array(F.lit("mixed_topics"))).otherwise(F.array().cast("array<string>")).alias("text_quality_flags"),
    )


def candidates(rows: DataFrame) -> DataFrame:
    """enriched rows with serials by source (page, block, chunk), place on the page, ids, and neighbours on the page."""
    rows = rows.where(T.clean_text(F.col("chunk")) != "")
    rows = numbered(rows, "serial", ["source_id"], "pdf_page", "block_index", "chunk_index")
    return placed(identified(rows))


def identified(rows: DataFrame) -> DataFrame:
    """rows with the ids of their candidates, claims and evidence by serial, and of their pages."""
    ids = {p: F.format_string(f"{p}-%05d", "serial") for p in ("CAND", "CLM", "EV")}
    return rows.select("*", ids["CAND"].alias("candidate_id"), ids["CLM"].alias("claim_id"), ids["EV"].alias("evidence_id"), page_id(F.col("source_id"), F.col("pdf_page")).alias("page_id"))


def placed(rows: DataFrame) -> DataFrame:
    """rows with their place on the page and their neighbours there, by serial."""
    w = Window.partitionBy("source_id", "pdf_page").orderBy("serial")
    near = F.array_compact(F.array(F.lag("candidate_id").over(w), F.lead("candidate_id").over(w)))
    return rows.withColumn("sequence_on_page", F.row_number().over(w)).withColumn("neighbor_candidate_ids", near)


def claims(cands: DataFrame) -> DataFrame:
    return cands.select("source_id", "claim_id", F.col("chunk").alias("neutral_fact"), F.col("heading").alias("context_heading"), F.col("heading_basis").alias("context_heading_basis"), "system_hints", "system_hint_basis", "space_hints", "space_hint_basis", "source_shape", "text_quality_flags", F.col("business_axes").alias("business_basis_hints"), F.array("evidence_id").alias("evidence_ids"))


def evidence(cands: DataFrame) -> DataFrame:
    origin = F.col("origin_kind") if "origin_kind" in cands.columns else F.lit("source")
    return cands.select("source_id", "evidence_id", "claim_id", "pdf_page", F.col("pdf_page").cast("string").alias("printed_page"), F.col("heading").alias("section"), F.col("heading_basis").alias("section_basis"), F.col("chunk").alias("quote"), origin.alias("origin_kind"))


def page_records(pages: DataFrame, blocks: DataFrame, cands: DataFrame, heads: DataFrame, regions: DataFrame | None = None) -> DataFrame:
    """One record for each page: heading, status, reason, coverage, fingerprint and candidate ids."""
    from ..sources.documents import page_text

    keys = ["source_id", "pdf_page"]
    ids = cands.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("serial", "candidate_id"))), lambda x: x["candidate_id"]).alias("candidate_ids"))
    out = pages.select(*keys).join(page_text(blocks), keys, "left").join(ids, keys, "left").join(heads.select(*keys, "heading"), keys, "left")
    out = out.join(regions.groupBy(*keys).agg(F.array_sort(F.collect_list("region_id")).alias("visual_region_ids")), keys, "left") if regions is not None else out.withColumn("visual_region_ids", F.lit(None).cast("array<string>"))
    none = F.array().cast("array<string>")
    text, ids, seen = F.coalesce("page_text", F.lit("")), F.coalesce("candidate_ids", none), F.coalesce("visual_region_ids", none)
    visual, some, read = F.size(seen) > 0, F.size(ids) > 0, text != ""
    return out.select(
        page_id(F.col("source_id"), F.col("pdf_page")).alias("page_id"), *keys, F.coalesce("heading", F.format_string("PDF page %d", "pdf_page")).alias("section"),
        F.when(visual, "pending").when(some, "candidate").when(~read, "unreadable").otherwise("excluded").alias("status"),
        F.when(visual, "visual_text_pending").when(some, "source_reading_pack").when(~read, "no_text_layer").otherwise("no_readable_content_after_cleanup").alias("reason_code"),
        F.when(visual, "visual_pending").when(read, "native_complete").otherwise("unreadable").alias("coverage_status"),
        F.sha2(text, 256).alias("fingerprint"), ids.alias("candidate_ids"), read.alias("native_text_present"), seen.alias("visual_region_ids"),
    )


def issues(records: DataFrame) -> DataFrame:
    """A check item for each page that can't be read."""
    return records.where("status = 'unreadable'").select("source_id", F.format_string("ISSUE-UNREADABLE-%04d", "pdf_page").alias("issue_id"), F.lit("unreadable_page").alias("kind"), F.array("page_id").alias("page_ids"), F.array("pdf_page").alias("pdf_pages"), F.lit("check_item").alias("origin_kind"))


def summary(records: DataFrame, cands: DataFrame) -> DataFrame:
    """Counts by source."""
    n = cands.groupBy("source_id").agg(F.count("*").alias("candidate_count"))
    out = records.groupBy("source_id").agg(F.count("*").alias("page_count"), *[F.count_if(F.col("status") == s).alias(f"{a}_page_count") for s, a in (("candidate", "candidate"), ("unreadable", "unreadable"), ("pending", "visual_pending"))])
    return out.join(n, "source_id", "left").withColumn("candidate_count", F.coalesce("candidate_count", F.lit(0).cast("long")))
