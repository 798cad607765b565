"""Recognised text: token tables, attempts, and transcriptions that arrive late and are merged into a pack."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon as L
from ..functions import text as T
from . import candidates as C
from .chunks import chunks_of
from .ordinals import ordinal

ACCEPT = 72.0
TOKENS = "level INT, page_num INT, block_num INT, par_num INT, line_num INT, word_num INT, left INT, top INT, width INT, height INT, conf DOUBLE, text STRING"
STATUSES = ("read", "unreadable", "skipped_non_text", "pending")


def recognised(tokens: DataFrame, keys: list[str]) -> DataFrame:
    """tokens: keys, ord (arrival), TOKENS. Per keys the text, lines in order of arrival, and the mean confidence by characters."""
    rows = tokens.withColumn("token", T.strip(F.coalesce("text", F.lit("")))).where("level = 5 AND token <> '' AND conf >= 0")
    rows = rows.withColumn("w", F.greatest(F.lit(1), F.length(F.regexp_replace("token", f"{T.S}+", ""))))
    lines = rows.groupBy(*keys, "page_num", "block_num", "par_num", "line_num").agg(F.min("ord").alias("ord"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "token"))), lambda x: x["token"]), " ").alias("line"), F.sum(F.col("conf") * F.col("w")).alias("cw"), F.sum("w").alias("w"))
    out = lines.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "line"))), lambda x: x["line"]), "\n").alias("text"), (F.sum("cw") / F.nullif(F.sum("w"), F.lit(0))).alias("mean_confidence"))
    return out.withColumn("text", T.ocr_spacing(F.col("text")))


def best_attempts(attempts: DataFrame, keys: list[str]) -> DataFrame:
    """attempts: keys, attempt (1, 2), image_count, text, mean_confidence. A second attempt counts only if the first
    wasn't accepted; then accepted, usable, confidence, length decide, and among equals the first."""
    usable = T.ocr_usable(F.col("text"), F.coalesce("image_count", F.lit(0)))
    rows = attempts.withColumn("usable", usable).withColumn("accepted", usable & F.coalesce(F.col("mean_confidence") >= ACCEPT, F.lit(False)))
    rank = F.struct((F.col("accepted") & (F.col("attempt") == 1)).alias("z"), F.col("accepted").alias("a"), F.col("usable").alias("b"), F.coalesce("mean_confidence", F.lit(-1.0)).alias("c"), F.length("text").alias("d"), (-F.col("attempt")).alias("e"))
    best = rows.groupBy(*keys).agg(F.max_by(F.struct("attempt", "text", "mean_confidence", "usable", "accepted"), rank).alias("x"))
    return best.select(*keys, "x.*", F.when(F.col("x.accepted"), "read").otherwise("pending").alias("status"))


def invalid_transcriptions(records: DataFrame, regions: DataFrame, pages: DataFrame) -> DataFrame:
    """region_id, rule: what a merge must not accept."""
    known = regions.select("region_id", "page_id")
    rule = lambda df, name: df.select("region_id", F.lit(name).alias("rule"))
    note = F.length(T.clean_text(F.coalesce("review_note", F.lit(""))))
    out = rule(records.join(known, "region_id", "left_anti"), "unknown visual region")
    out = out.unionByName(rule(records.where(~F.col("status").isin(*STATUSES)), "invalid status"))
    out = out.unionByName(rule(records.where((F.col("status") == "skipped_non_text") & ((F.coalesce("engine", F.lit("")) != "model_vision") | (note < 8))), "skipped without a review note"))
    return out.unionByName(rule(records.where("status = 'read'").join(known, "region_id").join(pages.select("page_id"), "page_id", "left_anti"), "missing page"))


def merge_regions(regions: DataFrame, records: DataFrame) -> DataFrame:
    """regions with the last record of each applied (records: region_id, ord, status, text, confidence, mean_confidence,
    engine). A reading that isn't usable stays pending, with its text as a draft."""
    last = records.groupBy("region_id").agg(F.max_by(F.struct("status", "text", "confidence", "mean_confidence", "engine"), "ord").alias("r"))
    rows = regions.join(last, "region_id", "left")
    text = T.clean_text(F.coalesce("r.text", F.lit("")))
    usable = T.ocr_usable(text, F.coalesce("image_count", F.lit(0)))
    now = F.when(F.col("r").isNull(), F.col("status")).when((F.col("r.status") == "read") & ~usable, "pending").otherwise(F.col("r.status"))
    out = rows.withColumn("now", now)
    return out.select(
        "region_id", "page_id", "source_id", "pdf_page", "image_count", "context_heading", "context_heading_basis", F.col("now").alias("status"),
        F.when(F.col("r").isNull(), F.col("transcribed_text")).when(F.col("now") == "read", text).otherwise("").alias("transcribed_text"),
        F.when((F.col("now") == "pending") & (text != ""), text).otherwise(F.col("ocr_draft")).alias("ocr_draft"),
        F.when(F.col("r").isNull(), F.col("confidence")).otherwise(F.coalesce("r.confidence", F.lit("unknown"))).alias("confidence"),
        F.coalesce("r.mean_confidence", "mean_confidence").alias("mean_confidence"), F.when(F.col("r").isNull(), F.col("engine")).otherwise(F.coalesce("r.engine", F.lit("gpts_vision"))).alias("engine"),
    )


def late_chunks(regions: DataFrame, known: DataFrame, lex: L.Lexicon = L.DOMAIN) -> DataFrame:
    """Chunks of read regions whose key their page doesn't have yet (known: page_id, quote); the first of equals stays."""
    rows = regions.where("status = 'read'").select("*", F.posexplode(chunks_of(F.col("transcribed_text"), lex)).alias("pos", "chunk"))
    rows = rows.withColumn("quote_key", T.semantic_key(F.col("chunk"))).where("quote_key <> ''")
    seen = known.select("page_id", T.semantic_key(F.col("quote")).alias("quote_key")).distinct()
    rows = rows.join(seen, ["page_id", "quote_key"], "left_anti")
    first = rows.groupBy("page_id", "quote_key").agg(F.min_by(F.struct("region_id", "source_id", "pdf_page", "pos", "chunk", "context_heading", "context_heading_basis", "confidence", "mean_confidence", "engine"), F.struct("region_id", "pos")).alias("x"))
    numbered = F.when(F.col("chunk").rlike(r"^[一二三四五六七八九十百\d]+[、.]"), "list_item").otherwise("sentence")
    out = first.select("page_id", "x.*")
    return out.select(
        "source_id", "page_id", "pdf_page", "region_id", (F.col("pos") + 1).alias("chunk_index"), (F.col("pos") + 100_001).alias("block_index"), "chunk", F.col("context_heading").alias("heading"), F.col("context_heading_basis").alias("heading_basis"),
        numbered.alias("source_shape"), C.ocr_flags(F.col("chunk"), F.col("confidence"), F.col("mean_confidence"), lex).alias("text_quality_flags"), "confidence", "engine",
    )


def late_candidates(late: DataFrame, known: DataFrame, terms: DataFrame | None = None, lex: L.Lexicon = L.DOMAIN) -> DataFrame:
    """late (late_chunks) as candidates with hints and ids; serials go on after the last of the source in known. Of known
    only each source's largest serial is read."""
    own = {"source_shape": "own_shape", "text_quality_flags": "own_flags"}  # by rules for recognised text
    rows = late.where(accepted(F.col("chunk"))).withColumnsRenamed(own)
    rows = C.hinted(rows, terms, lex, ("region_id", "confidence", "engine", *own.values())).drop(*own).withColumnsRenamed({b: a for a, b in own.items()})
    rows = ordinal(rows, "k", ["source_id"], F.floor(F.col("pdf_page") / 64), "pdf_page", "region_id", "block_index")
    last = known.groupBy("source_id").agg(F.max("serial").alias("last"))
    rows = rows.join(last, "source_id", "left").withColumn("serial", F.coalesce("last", F.lit(0)) + F.col("k")).drop("last", "k")
    return C.identified(rows).withColumn("origin_kind", F.lit("source_ocr"))


def with_late(known: DataFrame, late: DataFrame) -> DataFrame:
    """known and late candidates as one table, with places and neighbours by page anew; ids stay."""
    native = known.drop("sequence_on_page", "neighbor_candidate_ids").withColumn("origin_kind", F.lit("source")).withColumn("confidence", F.lit("not_applicable"))
    return C.placed(native.unionByName(late, allowMissingColumns=True))


def pages_with(pages: DataFrame, cands: DataFrame) -> DataFrame:
    """pages with the candidate ids that they now have, in order."""
    ids = cands.groupBy("page_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("serial", "candidate_id"))), lambda x: x["candidate_id"]).alias("candidate_ids"))
    return pages.drop("candidate_ids").join(ids, "page_id", "left").withColumn("candidate_ids", F.coalesce("candidate_ids", F.array().cast("array<string>")))


def page_status(pages: DataFrame, regions: DataFrame) -> DataFrame:
    """pages (page_id, candidate_ids, native_text_present, fingerprint, …) that own regions, with status after a merge."""
    texts = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("region_id", "transcribed_text"))), lambda x: x["transcribed_text"]), "\n")
    own = regions.groupBy("page_id").agg(F.bool_or(F.col("status") == "pending").alias("open"), F.bool_or(F.col("status") == "unreadable").alias("bad"), texts.alias("texts"))
    some = F.size("candidate_ids") > 0
    pick = lambda a, b, c, d: F.when(F.col("open"), a).when(some, b).when(F.col("native_text_present"), c).otherwise(d)
    return pages.join(own, "page_id").select(
        "page_id", pick("pending", "candidate", "excluded", "unreadable").alias("status"), pick("visual_text_pending", "source_reading_pack", "no_readable_content_after_cleanup", "no_text_layer").alias("reason_code"),
        F.when(F.col("open"), "visual_pending").when(F.col("bad"), "partial_unreadable").otherwise("hybrid_complete").alias("coverage_status"),
        F.when(F.col("open"), F.col("fingerprint")).otherwise(F.sha2(F.concat_ws("\n", "fingerprint", "texts"), 256)).alias("fingerprint"),
    )


def region_issues(regions: DataFrame, pages: DataFrame) -> DataFrame:
    """One check item for each unreadable region of a page without open regions."""
    open_ = regions.where("status = 'pending'").select("page_id").distinct()
    rows = regions.where("status = 'unreadable'").join(open_, "page_id", "left_anti").join(pages.select("page_id"), "page_id", "left_semi")
    return rows.select(F.concat(F.lit("ISSUE-VISUAL-"), "region_id").alias("issue_id"), F.lit("visual_region_unreadable").alias("kind"), F.array("page_id").alias("page_ids"), F.array("pdf_page").alias("pdf_pages"), F.array("region_id").alias("visual_region_ids")).dropDuplicates(["issue_id"])


def audit(regions: DataFrame) -> DataFrame:
    """Per source: regions, resolved ones, and the ids of open ones."""
    return regions.groupBy("source_id").agg(F.count("*").alias("region_count"), F.count_if(F.col("status") != "pending").alias("resolved_region_count"), F.array_sort(F.array_compact(F.collect_list(F.when(F.col("status") == "pending", F.col("region_id"))))).alias("pending_region_ids"))


def accepted(text: Column) -> Column:
    """Hints never exclude: every readable text is kept."""
    return T.clean_text(text) != ""
