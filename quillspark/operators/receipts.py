"""Gates: screening results, receipts, render payloads and page layouts, each as rows of failed rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

# The fields, statuses, markers and headers of the formats that are checked here.
PAYLOAD = (
    "project STRUCT<name:STRING,source:STRING>, requirements ARRAY<STRUCT<id:STRING,navTitle:STRING,system:STRING,`group`:STRING,space:STRING,title:STRING,source:STRING,evidence:STRING,conditions:STRING,status:STRING,review:STRING,docs:STRING>>, "
    "system_summaries ARRAY<STRUCT<system:STRING,summary:STRING>>, project_info ARRAY<STRING>, smart_building ARRAY<STRING>"
)
FIELDS = ("id", "navTitle", "system", "group", "space", "title", "source", "evidence", "conditions", "status", "review", "docs")
PAYLOAD_STATUSES = ("clear", "review", "interface")


def marker_list(text: Column, name: str) -> Column:
    return F.filter(F.transform(F.split(F.regexp_extract(text, rf"<!-- {name}:([^>]*) -->", 1), ","), T.strip), lambda x: x != "")


def count_of(text: Column, part: Column) -> Column:
    """How often part occurs in text, without overlaps."""
    return ((F.length(text) - F.length(F.replace(text, part, F.lit("")))) / F.length(part)).cast("int")


def screening_errors(batches: DataFrame, results: DataFrame, keys: list[str]) -> DataFrame:
    """batches: keys, pdf_pages, evidence_group_ids; results: keys, text. Each batch's first failed rule.

    Pages: the numbers listed, sorted, must be the distinct expected ones, so a page listed twice fails and order is free.
    Groups: the list itself.
    """
    rows = batches.join(results.select(*keys, "text"), keys, "left")
    marker = F.concat(F.lit("<!-- screened:"), "batch_id", F.lit(" -->"))
    pages = F.array_sort(F.transform(F.filter(marker_list(F.col("text"), "reviewed-pages"), lambda x: x.rlike(r"^\d+$")), lambda x: x.cast("long")))
    wanted = F.array_sort(F.array_distinct(F.transform("pdf_pages", lambda x: x.cast("long"))))
    rules = [
        (F.col("text").isNull(), "missing screening result"),
        (count_of(F.col("text"), marker) != 1, "marker missing or duplicated"),
        (pages != wanted, "reviewed page marker mismatch"),
        (marker_list(F.col("text"), "reviewed-groups") != F.col("evidence_group_ids"), "reviewed group marker mismatch"),
    ]
    return first_failure(rows, rules, keys)


def first_failure(rows: DataFrame, rules: list[tuple[Column, str]], keys: list[str]) -> DataFrame:
    """keys, rule: the first rule that fails, in order; rows without one are left out. A null test fails its rule."""
    return rows.select(*keys, F.coalesce(*[F.when(F.coalesce(test, F.lit(True)), F.lit(name)) for test, name in rules]).alias("rule")).where("rule is not null")


def total_errors(batches: DataFrame, manifest: DataFrame) -> DataFrame:
    """manifest: source_id, batch_count, covered_pdf_pages, evidence_group_count, against all batches of the source."""
    seen = batches.groupBy("source_id").agg(F.count("*").alias("n"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("pdf_pages")))).alias("pages"), F.sum(F.size("evidence_group_ids")).alias("groups"))
    rows = manifest.join(seen, "source_id", "left")
    return first_failure(rows, [(F.col("n") != F.col("batch_count"), "batch count mismatch"), (F.col("pages") != F.array_sort(F.array_distinct("covered_pdf_pages")), "page coverage mismatch"), (F.col("groups") != F.col("evidence_group_count"), "evidence-group coverage mismatch")], ["source_id"])


def package_facts(text: Column) -> Column:
    """All that receipts and gates take from a package's text, so that the text itself need not be joined with them."""
    one = lambda p: F.nullif(F.regexp_extract(text, "(?m)" + p, 1), F.lit(""))
    done, total = (F.nullif(F.regexp_extract(text, r"(?m)^- 已閱讀批次：(\d+)\s*/\s*(\d+)$", i), F.lit("")).cast("int") for i in (1, 2))
    return F.struct(
        text.isNull().alias("missing"), F.contains(text, F.lit("# 弱電來源包")).alias("header"), T.squeeze(one(r"^- 來源文件：(.+)$")).alias("name"), F.lower(one(r"^- 來源 SHA-256：`?([0-9a-fA-F]{64})`?$")).alias("sha"),
        done.alias("done"), total.alias("total"), F.regexp_extract_all(text, F.lit(r"<!--\s*screened:(SB-\d{3})\s*-->"), F.lit(1)).alias("ids"),
        F.size(F.array_distinct(F.regexp_extract_all(text, F.lit(r"\b(CAND-[A-Z0-9-]+)\b"), F.lit(1)))).alias("retained"), F.sha2(text, 256).alias("sha256"),
    )


def receipts(batches: DataFrame, packages: DataFrame, sources: DataFrame) -> DataFrame:
    """One receipt a source: what was screened, and the hash of the package's text. packages: source_id, text (or facts, its
    package_facts); sources: source_id, source_name, source_sha256, pdf_page_count, extraction_batch_count."""
    seen = batches.groupBy("source_id").agg(F.count("*").alias("screening_batch_count"), F.array_sort(F.collect_list("batch_id")).alias("screened_batch_ids"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("pdf_pages")))).alias("screened_pdf_pages"), F.sum(F.size("evidence_group_ids")).alias("screened_evidence_group_count"))
    facts = packages.select("source_id", "facts" if "facts" in packages.columns else package_facts(F.col("text")).alias("facts"))
    own = facts.select("source_id", F.col("facts.retained").alias("retained_candidate_id_count"), F.col("facts.sha256").alias("package_sha256"))
    return sources.join(seen, "source_id").join(own, "source_id").withColumn("stage", F.lit("weak_current_source_complete"))


def gate_errors(rows: DataFrame, keys: list[str]) -> DataFrame:
    """rows: keys, text (the package; or facts, its package_facts), master_file, master_sha256, and a receipt struct r (null:
    none). First failure each."""
    if "facts" not in rows.columns:
        rows = rows.withColumn("facts", package_facts(F.col("text")))
    missing, header, name, sha, done, total, ids = (F.col(f"facts.{c}") for c in ("missing", "header", "name", "sha", "done", "total", "ids"))
    base = lambda c: F.lower(F.regexp_replace(c, r"^.*[/\\]", ""))
    r = lambda c: F.col(f"r.{c}")
    needed = ("source_name", "source_sha256", "pdf_page_count", "extraction_batch_count", "screening_batch_count", "screened_batch_ids", "screened_evidence_group_count", "package_sha256", "stage")
    incomplete = F.lit(False)
    for c in needed:
        incomplete = incomplete | r(c).isNull()
    rules = [
        (F.coalesce(missing, F.lit(True)), "source package missing"), (~header, "header missing"), (name.isNull() | sha.isNull() | total.isNull(), "metadata incomplete"),
        ((total < 1) | (done != total), "not every batch was screened"), (F.size(ids) != total, "marker count"), (base(F.col("master_file")) != base(name), "master file mismatch"), (F.lower("master_sha256") != sha, "master sha mismatch"),
        (F.col("r").isNull(), "receipt missing"), (incomplete, "receipt incomplete"), (r("stage") != "weak_current_source_complete", "receipt not complete"), (base(r("source_name")) != base(name), "receipt file mismatch"), (F.lower(r("source_sha256")) != sha, "receipt sha mismatch"),
        (F.lower(r("package_sha256")) != F.col("facts.sha256"), "package hash mismatch"), ((r("screening_batch_count") != total) | (r("screened_batch_ids") != ids), "batch coverage mismatch"), ((r("pdf_page_count") < 1) | (r("extraction_batch_count") < 1), "invalid coverage"),
        (r("extraction_batch_count") < F.floor((r("pdf_page_count") + 29) / 30), "implausible extraction batches"), (r("screened_evidence_group_count") < 1, "no evidence groups"),
    ]
    return first_failure(rows, rules, keys)


def payload_errors(rows: DataFrame, keys: list[str], column: str = "payload") -> DataFrame:
    """rows: keys and a JSON payload. The first failed rule of each."""
    p = F.from_json(column, PAYLOAD)
    rows = rows.withColumn("p", p)
    blank = lambda c: F.coalesce(T.strip(c), F.lit("")) == ""
    req, sums = F.col("p.requirements"), F.col("p.system_summaries")
    any_blank = F.exists(req, lambda x: F.forall(F.array(*[blank(x[f]) for f in FIELDS]), lambda b: ~b) == F.lit(False))
    ids, systems, described = F.transform(req, lambda x: x["id"]), F.transform(req, lambda x: x["system"]), F.transform(sums, lambda x: x["system"])
    same = (F.size(F.array_except(systems, described)) == 0) & (F.size(F.array_except(described, systems)) == 0)
    rules = [
        (F.col("p").isNull(), "root must be an object"), (F.col("p.project").isNull(), "project must be an object"), (blank(F.col("p.project.name")), "project.name"), (blank(F.col("p.project.source")), "project.source"),
        (F.coalesce(F.size(req), F.lit(0)) < 1, "requirements must be a non-empty array"), (any_blank, "missing or blank field"), (F.size(F.array_distinct(ids)) != F.size(ids), "duplicate requirement id"),
        (F.exists(req, lambda x: ~x["status"].isin(*PAYLOAD_STATUSES)), "invalid status"), (sums.isNull(), "system_summaries must be an array"), (F.exists(sums, lambda x: blank(x["system"]) | blank(x["summary"])), "blank summary"),
        (F.size(F.array_distinct(described)) != F.size(described), "duplicate system summary"), (~same, "system summaries must match requirements"),
    ]
    return first_failure(rows, rules, keys)


def layout_errors(rows: DataFrame, keys: list[str], start: str, end: str, ids: list[str], version: str, tabs: str = 'class="tab-button', n_tabs: int = 4) -> DataFrame:
    """rows: keys, html, template. Every failed rule: keys, rule."""
    html = F.col("html")
    have = F.array_distinct(F.regexp_extract_all(html, F.lit(r'\bid="([^"]+)"'), F.lit(1)))
    data = F.regexp_extract(html, rf"(?s)\Q{start}\E(.*?)\Q{end}\E", 1)
    rules = [
        (T.shell(html, start, end) != T.shell(F.col("template"), start, end), "shell differs"), (~F.contains(html, F.lit(version)), "layout version missing"), (F.size(F.array_except(F.array(*[F.lit(i) for i in ids]), have)) > 0, "required ids missing"),
        (count_of(html, F.lit(tabs)) != n_tabs, "tabs"), (~(F.contains(html, F.lit('role="separator"')) & F.contains(html, F.lit('aria-orientation="vertical"'))), "separator missing"), (F.contains(html, F.lit("{{")) | F.contains(html, F.lit("}}")), "placeholders"),
        (html.rlike(r"""(?i)<(script|link)[^>]+(src|href)=["']https?://"""), "external script or stylesheet"), (F.get_json_object(data, "$").isNull(), "embedded data invalid"),
    ]
    failed = F.array_compact(F.array(*[F.when(F.coalesce(t, F.lit(True)), F.lit(n)) for t, n in rules]))
    return rows.select(*keys, F.explode(failed).alias("rule"))


def role_errors(documents: DataFrame, key: str, primary: str = "primary_requirements") -> DataFrame:
    """Packages that haven't exactly one primary document."""
    n = documents.groupBy(key).agg(F.count_if(F.col("role") == primary).alias("primaries"))
    return n.where("primaries <> 1")


def duplicates(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Ids that occur more than once, with how often."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def disagreements(req: DataFrame, texts: DataFrame, pattern: str = r"\b(REQ-M1-\d{4,})\b") -> DataFrame:
    """texts: output, text. For each output how many requirement ids it lacks, and how many it has that aren't required."""
    found = texts.select("output", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(pattern), F.lit(1)))).alias("requirement_id"))
    have = found.groupBy("output").agg(F.count("*").alias("n_found"))
    known = found.join(req.select("requirement_id"), "requirement_id", "left_semi").groupBy("output").agg(F.count("*").alias("n_known"))
    total = req.agg(F.count_distinct("requirement_id").alias("n_required"))  # one row
    out = texts.select("output").distinct().join(have, "output", "left").join(known, "output", "left").join(F.broadcast(total))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
    return out.select("output", (F.col("n_required") - zero("n_known")).alias("missing"), (zero("n_found") - zero("n_known")).alias("unknown"))


def assert_none(errors: DataFrame, what: str) -> None:
    """Raises with the first eight rows if there are any."""
    found = errors.take(8)
    if found:
        raise ValueError(f"{what} failed:\n- " + "\n- ".join(str(r.asDict()) for r in found))
