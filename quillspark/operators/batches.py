"""Page ranges, their bisection, and merging packs of ranges with new serials."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordinals import ordinal


def page_batches(sources: DataFrame, pages: int = 25) -> DataFrame:
    """sources: source_id, page_count. Fixed ranges of `pages` (5 to 30)."""
    if not 5 <= pages <= 30:
        raise ValueError("batches have 5 to 30 pages")
    rows = sources.where("page_count > 0").select("source_id", "page_count", F.explode(F.sequence(F.lit(0), ((F.col("page_count") - 1) / pages).cast("int"))).alias("k"))
    return rows.select("source_id", F.format_string("B%02d", F.col("k") + 1).alias("batch_id"), (F.col("k") * pages + 1).cast("int").alias("page_start"), F.least(F.col("page_count"), (F.col("k") + 1) * pages).cast("int").alias("page_end"), (F.col("k") * pages).cast("int").alias("page_offset"))


def bisected(batches: DataFrame, failed: DataFrame) -> DataFrame:
    """Batches with each failed one (batch_id, source_id) as its two halves A and B; one page can't be split and is marked terminal."""
    keys = ["source_id", "batch_id"]
    rows = batches.join(failed.select(*keys).distinct().withColumn("failed", F.lit(True)), keys, "left")
    middle = F.floor((F.col("page_start") + F.col("page_end")) / 2).cast("int")
    half = lambda suffix, a, b: F.struct(F.concat("batch_id", F.lit(suffix)).alias("batch_id"), a.cast("int").alias("page_start"), b.cast("int").alias("page_end"), F.lit(False).alias("terminal"))
    splits = F.col("failed") & (F.col("page_end") > F.col("page_start"))
    same = F.struct("batch_id", "page_start", "page_end", F.coalesce("failed", F.lit(False)).alias("terminal"))
    parts = F.when(splits, F.array(half("A", F.col("page_start"), middle), half("B", middle + 1, F.col("page_end")))).otherwise(F.array(same))
    return rows.select("source_id", F.explode(parts).alias("x")).select("source_id", "x.*")


def contiguous(pages: DataFrame, group: list[str], page: str, first: int | None = 1) -> DataFrame:
    """Per group whether its pages are exactly first (or its least page) to its largest, each once."""
    out = pages.groupBy(*group).agg(F.count("*").alias("n"), F.count_distinct(page).alias("d"), F.min(page).alias("lo"), F.max(page).alias("hi"))
    start = F.lit(first) if first is not None else F.col("lo")
    return out.select(*group, F.col("n").alias("page_count"), ((F.col("n") == F.col("d")) & (F.col("lo") == start) & (F.col("hi") - F.col("lo") + 1 == F.col("n"))).alias("complete"))


def incomplete_chains(cands: DataFrame, claims: DataFrame, evidence: DataFrame) -> DataFrame:
    """Candidates of any source without a claim or without evidence; a merge needs none. Ids repeat between sources and batches."""
    keys = ["source_id", "batch_ord", "claim_id"]
    return cands.join(claims.select(*keys), keys, "left_anti").unionByName(cands.join(evidence.select(*keys), keys, "left_anti")).dropDuplicates(["source_id", "batch_ord", "candidate_id"])


def blocked(batches: DataFrame, regions: DataFrame) -> DataFrame:
    """Batches (source_id, batch_id, page_start, page_end) that can't be merged yet, with their pending regions' ids."""
    own = regions.where("status = 'pending'").select(F.col("source_id").alias("s"), F.col("pdf_page").alias("p"), "region_id")
    rows = batches.join(own, (F.col("source_id") == F.col("s")) & F.col("p").between(F.col("page_start"), F.col("page_end")))
    return rows.groupBy("source_id", "batch_id").agg(F.array_sort(F.collect_list("region_id")).alias("pending_region_ids"))


def shifted(items: DataFrame, batches: DataFrame) -> DataFrame:
    """items (source_id, batch_id, pdf_page, region_id) of cut-out page ranges, with the numbers of the whole source: each
    batch's page_offset goes onto the page, and onto the page in the region's id."""
    rows = items.join(batches.select("source_id", "batch_id", "page_offset"), ["source_id", "batch_id"])
    page = (F.col("pdf_page") + F.col("page_offset")).cast("int")
    parts = [F.regexp_extract("region_id", r"^(.*-P)\d+(-\d+)$", i) for i in (1, 2)]
    region = F.when(parts[0] != "", F.concat(parts[0], F.lpad(page.cast("string"), 4, "0"), parts[1])).otherwise(F.col("region_id"))
    return rows.select(*[page.alias(c) if c == "pdf_page" else region.alias(c) if c == "region_id" else F.col(c) for c in items.columns])


def source_errors(batches: DataFrame, sources: DataFrame, keys: list[str]) -> DataFrame:
    """keys, rule: batches (source_id, source_sha256, page_start, page_end) that are not of the source that they name, or
    whose pages it hasn't. sources: source_id, sha256, page_count."""
    rows = batches.join(sources.select("source_id", F.lower("sha256").alias("sha256"), "page_count"), "source_id", "left")
    rules = [
        (F.col("page_count").isNull(), "unknown source"), (F.lower("source_sha256") != F.col("sha256"), "batch of another source"),
        (~((F.col("page_start") >= 1) & (F.col("page_start") <= F.col("page_end")) & (F.col("page_end") <= F.col("page_count"))), "pages outside the source"),
    ]
    failed = F.coalesce(*[F.when(F.coalesce(test, F.lit(True)), F.lit(name)) for test, name in rules])
    return rows.select(*keys, failed.alias("rule")).where("rule is not null")


def advanced(batches: DataFrame, outcomes: DataFrame) -> DataFrame:
    """One step of all batches (source_id, batch_id, page_start, page_end, status): pending ones take the status of their
    outcome (source_id, batch_id, ok), complete or failed; a failed range is split in two pending halves, and one page
    that fails is terminal. Other batches stay as they are."""
    keys = ["source_id", "batch_id"]
    one = outcomes.groupBy(*keys).agg(F.bool_or("ok").alias("ok"))
    rows = batches.join(one, keys, "left")
    tried = (F.col("status") == "pending") & F.col("ok").isNotNull()
    middle = F.floor((F.col("page_start") + F.col("page_end")) / 2).cast("int")
    row = lambda suffix, a, b, status: F.struct(F.concat("batch_id", F.lit(suffix)).alias("batch_id"), a.cast("int").alias("page_start"), b.cast("int").alias("page_end"), F.lit(status).alias("status") if isinstance(status, str) else status.alias("status"))
    a, b = F.col("page_start"), F.col("page_end")
    split = F.array(row("A", a, middle, "pending"), row("B", middle + 1, b, "pending"))
    parts = F.when(tried & ~F.col("ok") & (b > a), split).otherwise(F.array(row("", a, b, F.when(~tried, F.col("status")).when(F.col("ok"), "complete").otherwise("terminal"))))
    return rows.select("source_id", F.explode(parts).alias("x")).select("source_id", "x.*")


def merged(cands: DataFrame, claims: DataFrame, evidence: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Candidates, claims and evidence of batches (source_id, batch_ord, position: a candidate's place in its batch) under
    new serials, from 1 in each source.

    Old ids repeat between sources and batches, so all joins are by source, batch and id. Neighbours are mapped one by one, unknown ones dropped.
    """
    keys = ["source_id", "batch_ord"]
    numbered = ordinal(cands, "serial", ["source_id"], F.col("batch_ord") * 1_000_000 + F.floor(F.col("position") / 1024), "batch_ord", "position")
    new = {p: F.format_string(f"{p}-%05d", "serial") for p in ("CAND", "CLM", "EV")}
    ids = numbered.select(*keys, F.col("candidate_id").alias("old"), new["CAND"].alias("new"))
    near = numbered.select(*keys, "candidate_id", F.posexplode("neighbor_candidate_ids").alias("pos", "old")).join(ids, [*keys, "old"])
    near = near.groupBy(*keys, "candidate_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "new"))), lambda x: x["new"]).alias("neighbor_candidate_ids"))
    out = numbered.drop("neighbor_candidate_ids").join(near, [*keys, "candidate_id"], "left").withColumn("neighbor_candidate_ids", F.coalesce("neighbor_candidate_ids", F.array().cast("array<string>")))
    chain = numbered.select(*keys, "claim_id", "serial", new["CLM"].alias("new_claim"), new["EV"].alias("new_evidence"))
    cl = claims.join(chain, [*keys, "claim_id"]).withColumn("claim_id", F.col("new_claim")).withColumn("evidence_ids", F.array("new_evidence")).drop("new_claim", "new_evidence")
    ev = evidence.join(chain, [*keys, "claim_id"]).withColumn("claim_id", F.col("new_claim")).withColumn("evidence_id", F.col("new_evidence")).drop("new_claim", "new_evidence")
    return out.withColumn("candidate_id", new["CAND"]).withColumn("claim_id", new["CLM"]), cl, ev


def merged_terms(terms: DataFrame) -> DataFrame:
    """Terms of all batches with the union of their pages."""
    out = terms.groupBy("term").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("source_page_ids")))).alias("source_page_ids"))
    return ordinal(out, "n", [], F.substring("term", 1, 2), "term").select(F.format_string("TERM-%04d", "n").alias("term_id"), "term", "source_page_ids")


def remaining(manifest: DataFrame) -> DataFrame:
    """Of each source with open batches or regions: those batches' ids in order, and the count of pending regions."""
    open_ = manifest.where("NOT complete OR size(pending_region_ids) > 0")
    return open_.groupBy("source_id").agg(F.array_sort(F.collect_list("batch_id")).alias("batch_ids"), F.coalesce(F.sum(F.size("pending_region_ids")), F.lit(0)).alias("pending_regions"))
