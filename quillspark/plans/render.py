"""Texts: groups, dossiers, screening packages, page documents, packages of documents, trees and HTML.

Each row renders its own part as a column; parts are joined in order per document, which is what its file holds. A file
is written per document by a partitioned text sink (sources/sinks.py), not by the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

# Markers and labels of the Markdown and HTML formats, here and below.
START, END = "<!--DATA_START-->", "<!--DATA_END-->"
POINTER = "> 內容已完整收錄於其他來源片段，依候選 ID 交叉核對。"


def joined(part: str, order: str, sep: str = "\n") -> Column:
    """Aggregate: the parts in order."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(part).alias("p")))), lambda x: x["p"]), sep)


def quote_block(s: Column) -> Column:
    return F.regexp_replace(F.array_join(F.transform(T.lines(s), lambda x: F.concat(F.lit("> "), x)), "\n"), r"(?m)^> $", ">")


def context_lines(label: str, context: Column, covered: Column) -> Column:
    """A context in full, or a pointer if all its candidates stand in segments; empty without a context."""
    ids = context["candidate_ids"]
    head = F.concat(F.lit(f"**{label}"), F.when(F.size(ids) > 0, F.concat(F.lit(" | "), F.array_join(ids, ","))).otherwise(""), F.lit("**\n"))
    body = F.when((F.size(ids) > 0) & (F.size(F.array_except(ids, covered)) == 0), F.lit(POINTER)).otherwise(quote_block(context["quote"]))
    return F.when(context.isNotNull(), F.concat(head, body, F.lit("\n\n"))).otherwise("")


def render_group(all_segments: Column | None = None) -> Column:
    """One group's Markdown. all_segments: the candidate ids of all segments of the source, if contexts may point to them."""
    pages = F.array_join("pdf_pages", ",")
    listed = lambda c, sep=",": F.array_join(c, sep)
    gid = F.col("evidence_group_id")
    head = F.concat(F.lit("## "), gid, F.lit(" | PDF "), F.coalesce(F.nullif(pages, F.lit("")), F.lit("?")), F.lit(" | "), F.coalesce(F.nullif(listed(F.transform("section_path", T.squeeze), " / "), F.lit("")), F.lit("未辨識章節")))
    mark = F.concat(F.lit("<!-- evidence_group:"), gid, F.lit(" pages:"), pages, F.lit(" candidate_ids:"), listed("route_candidate_ids"), F.lit(" -->"))

    def bullet(label: str, values: Column, sep: str) -> Column:
        return F.when(F.size(values) > 0, F.concat(F.lit(f"- {label}："), F.array_join(values, sep)))

    def segment(s: Column, i: Column) -> Column:
        title = F.coalesce(F.nullif(listed(s["candidate_ids"]), F.lit("")), F.format_string("%s-S%02d", gid, i + 1))
        own = F.coalesce(F.nullif(listed(s["pdf_pages"]), F.lit("")), F.lit("?"))
        meta = F.array_compact(F.array(
            bullet("來源脈絡", F.transform(s["context_headings"], T.squeeze), " / "), bullet("來源空間提示", s["space_hints"], "、"), bullet("文字狀態", s["text_quality_flags"], "、"), bullet("來源形式", s["origin_kinds"], "、"),
            F.when(s["source_confidences"] != F.array(F.lit("not_applicable")), bullet("辨識信心", s["source_confidences"], "、")),
        ))
        return F.concat(F.lit("### "), title, F.lit(" | PDF "), own, F.lit("\n\n"), F.array_join(meta, "\n"), F.when(F.size(meta) > 0, "\n\n").otherwise(""), quote_block(s["quote"]), F.lit("\n"))

    covered = all_segments if all_segments is not None else F.flatten(F.transform("segments", lambda s: s["candidate_ids"]))
    return F.concat(head, F.lit("\n\n"), mark, F.lit("\n\n"), context_lines("前文", F.col("leading_context"), covered), F.array_join(F.transform("segments", segment), "\n"), F.lit("\n"), context_lines("後文", F.col("trailing_context"), covered), F.lit("---\n"))


def rendered_groups(groups: DataFrame, records: DataFrame | None = None) -> DataFrame:
    """Groups with markdown and chars. A context whose record is a segment of its source is always covered, since every
    record is in one group; so the neighbours' ids need no join."""
    near = F.flatten(F.array_compact(F.array("leading_context.candidate_ids", "trailing_context.candidate_ids")))
    return groups.withColumn("markdown", render_group(near)).withColumn("chars", F.length("markdown").cast("long"))


# Version, notice and reading rules of a dossier.
DOSSIER_VERSION = "1.2"
DOSSIER_NOTICE = "> 本檔是第一階段 AI 篩選弱電來源的內部閱讀材料，不是正式需求，也不是交付成果。程式只保存可讀文字、頁碼與上下文，不判斷工程語意。"
DOSSIER_RULES = (
    "1. 逐批閱讀全部片段，依頁碼、章節、原文及前後文判斷是否與弱電業務相關。",
    "2. 以電信、資訊、電視、通訊、監視、門禁、停車、廣播、對講、感測、控制、資料與跨系統介面等業務語意判斷，不採封閉關鍵字清單。",
    "3. 只把相關原文、必要上下文、頁碼與候選 ID 寫入 weak_current_source.md；不要在此階段寫正式需求，也不得摘要或合併不同義務。",
    "4. 同一段落或設備規格表若含不同設備、規格、數量、供電／備援、介面、空間、操作或測試要求，逐項保留原文及候選 ID；上下文可以共用，獨立要求不可被系統摘要取代。",
    "5. 可讀 OCR 文字與原生文字同等採用。低信心影像須經模型覆核；已判為不可讀或非文字者不阻斷全案，疑似相關且會影響理解時列為來源待確認。",
)


def dossier(rendered: DataFrame, sources: DataFrame, regions: DataFrame | None = None, unreadable: DataFrame | None = None) -> DataFrame:
    """One dossier per source: header with counts, the reading rules, then every group in order. sources: source_id, name,
    sha256, page_count; regions: source_id, status; unreadable: source_id, pdf_page of pages that can't be read."""
    body = rendered.groupBy("source_id").agg(joined("markdown", "group_no").alias("body"), F.count("*").alias("n"), F.sum(F.size("segments")).alias("segments"))
    rows = body.join(sources, "source_id", "left")
    rows = rows.join(regions.where("status = 'pending'").groupBy("source_id").agg(F.count("*").alias("open")), "source_id", "left") if regions is not None else rows.withColumn("open", F.lit(None).cast("long"))
    bad = F.array_sort(F.collect_list(F.col("pdf_page").cast("long"))).alias("bad")
    rows = rows.join(unreadable.groupBy("source_id").agg(bad), "source_id", "left") if unreadable is not None else rows.withColumn("bad", F.lit(None).cast("array<bigint>"))
    line = lambda label, v: F.concat(F.lit(f"- {label}："), v.cast("string"))
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("unknown"))
    bad = F.coalesce("bad", F.array().cast("array<bigint>"))
    head = F.concat_ws(
        "\n", F.lit(f"# 全文來源閱讀包\n\n{DOSSIER_NOTICE}\n\n## 文件資訊\n\n- 卷宗版本：{DOSSIER_VERSION}"), line("來源文件", T.squeeze(known("name"))), line("來源 SHA-256", F.concat(F.lit("`"), T.squeeze(known("sha256")), F.lit("`"))),
        line("PDF 頁數", known("page_count")), line("證據群組", F.col("n")), line("來源片段", F.col("segments")), line("尚待人工判讀的低信心影像區", F.coalesce("open", F.lit(0))), line("無法可靠讀取頁", F.size(bad)),
        line("視覺已覆核但未形成可用文字頁", F.coalesce(F.nullif(F.array_join(bad, ","), F.lit("")), F.lit("無"))), F.lit("\n## 轉譯原則\n"), *map(F.lit, DOSSIER_RULES), F.lit("\n---\n\n"),
    )
    return rows.select("source_id", F.concat(head, F.regexp_replace("body", f"{T.S}+$", ""), F.lit("\n")).alias("text"))


def screening_sources(rendered: DataFrame, batches: DataFrame) -> DataFrame:
    """The text that a reader of each batch gets: what to mark, then its groups."""
    rows = batches.select("source_id", "batch_id", "pdf_pages", "evidence_group_ids", F.explode("evidence_group_ids").alias("evidence_group_id"))
    body = rows.join(rendered.select("source_id", "evidence_group_id", "group_no", "markdown"), ["source_id", "evidence_group_id"]).groupBy("source_id", "batch_id").agg(joined("markdown", "group_no").alias("body"))
    return screening_texts(batches.join(body, ["source_id", "batch_id"]))


def screening_mark() -> Column:
    """What a result of a batch must hold: its id, pages and groups."""
    return F.concat(F.lit("<!-- screened:"), "batch_id", F.lit(" -->\n<!-- reviewed-pages:"), F.array_join("pdf_pages", ","), F.lit(" -->\n<!-- reviewed-groups:"), F.array_join("evidence_group_ids", ","), F.lit(" -->"))


def screening_texts(batches: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The same of batches that hold their groups' body: source_id, batch_id, the columns in keep, markers, text."""
    mark = screening_mark()
    return batches.select("source_id", "batch_id", *keep, mark.alias("markers"), F.concat(F.lit("# "), "batch_id", F.lit(" | 弱電來源篩選\n\n"), mark, F.lit("\n\n---\n\n"), "body").alias("text"))


def screened_package(results: DataFrame, sources: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """results: source_id, batch_id, text. One package per source, the results in order; where columns are to be kept,
    batches has them with their batch_id."""
    kept = [F.collect_list(F.struct("batch_id", *keep)).alias("batches")] if keep else []
    body = results.groupBy("source_id").agg(joined("text", "batch_id", "\n\n---\n\n").alias("body"), F.count("*").alias("n"), *kept)
    head = F.concat(F.lit("# 弱電來源包\n\n## 文件資訊\n\n- 來源文件："), F.coalesce("name", F.lit("unknown")), F.lit("\n- 來源 SHA-256：`"), F.coalesce("sha256", F.lit("unknown")), F.lit("`\n- 已閱讀批次："), F.col("n").cast("string"), F.lit(" / "), F.col("n").cast("string"), F.lit("\n\n---\n\n"))
    return body.join(sources, "source_id", "left").select("source_id", *(["batches"] if keep else []), F.concat(head, "body", F.lit("\n")).alias("text"))


def page_header(printed: Column, page: Column, extra: Column | None = None) -> Column:
    return F.concat(F.lit("<!-- source_pdf_page: "), page.cast("string"), F.lit(" -->\n<!-- printed_page: "), F.coalesce(printed.cast("string"), F.lit("unknown")), F.lit(" -->"), F.coalesce(extra, F.lit("")) if extra is not None else F.lit(""))


def page_document(pages: DataFrame, text: str) -> DataFrame:
    """pages: source_id, pdf_page, printed_page_candidate, and text. One Markdown document per source."""
    rows = pages.withColumn("part", F.concat(page_header(F.col("printed_page_candidate"), F.col("pdf_page")), F.lit("\n\n"), F.coalesce(text, F.lit("")), F.lit("\n")))
    return rows.groupBy("source_id").agg(joined("part", "pdf_page").alias("text"), F.count("*").alias("pages"))


def package(documents: DataFrame) -> DataFrame:
    """documents: package_id, ord, document_id, role, original_name, source_total_pages, text. One package: headers and marks."""
    name = F.replace("original_name", F.lit("`"), F.lit("\\`"))
    part = F.concat(F.lit("# "), name, F.lit("\n\n- document_id: "), "document_id", F.lit("\n- role: "), "role", F.lit("\n\n<!-- document_start: "), "document_id", F.lit(" -->\n\n"), "text", F.lit("\n<!-- document_end: "), "document_id", F.lit(" -->\n"))
    rows = documents.withColumn("part", part)
    return rows.groupBy("package_id").agg(joined("part", "ord").alias("text"), F.count("*").alias("document_count"), F.sum("source_total_pages").alias("total_pages"))


def package_ids(documents: DataFrame, key: str) -> DataFrame:
    """A package's id from the roles and hashes of its documents, in order."""
    rows = documents.withColumn("one", F.concat_ws(":", "role", "source_sha256"))
    return rows.groupBy(key).agg(F.substring(F.sha2(joined("one", "ord", "|"), 256), 1, 16).alias("package_id"))


def prefixed_ids(text: Column, batch: Column) -> Column:
    """Evidence, candidate and claim ids behind their batch's name."""
    return F.regexp_replace(text, F.lit(r"\b(EG|CAND|CLM|EV)-(\d+)\b"), F.concat(batch, F.lit("-$1-$2")))


def tree_text(req: DataFrame, project: str) -> DataFrame:
    """The tree as headings and items, systems and topics by first appearance: what mind maps import."""
    topics = req.groupBy("system", "group").agg(F.min("ord").alias("o"), joined("item", "ord").alias("items")) if "item" in req.columns else req.withColumn("item", F.concat(F.lit("- "), "text")).groupBy("system", "group").agg(F.min("ord").alias("o"), joined("item", "ord").alias("items"))
    topics = topics.withColumn("part", F.concat(F.lit("#### "), "group", F.lit("\n\n"), "items", F.lit("\n")))
    systems = topics.groupBy("system").agg(F.min("o").alias("o"), joined("part", "o").alias("body")).withColumn("part", F.concat(F.lit("### "), "system", F.lit("\n\n"), "body"))
    return systems.agg(F.concat(F.lit(f"# {project}\n\n## 需求樹\n\n"), joined("part", "o")).alias("text"))


def tree_marks() -> tuple[Column, tuple[Column, Column], tuple[Column, Column]]:
    """The tree's HTML: a requirement's row, and what stands before and after the rows of a topic and the topics of a system.
    Topics and systems have n and summary, systems also o and the first o of all."""
    e = lambda c: T.html_escape(F.coalesce(F.col(c), F.lit("")))
    meta = F.concat(F.lit('<span class="row-meta tree-node level-5"><span>'), e("requirement_id"), F.lit("</span><span>"), e("space"), F.lit('</span><span class="status status-'), e("status"), F.lit('">'), e("status"), F.lit("</span></span>"))
    row = F.concat(F.lit('<button type="button" class="requirement-row" data-id="'), e("requirement_id"), F.lit('" data-system="'), e("system"), F.lit('" data-space="'), e("space"), F.lit('" data-status="'), e("status"), F.lit('"><span class="requirement-text tree-node level-4">'), e("text"), F.lit("</span>"), meta, F.lit("</button>"))
    topic = F.concat(F.lit('<section class="group-block"><div class="group-heading"><div><h3 class="tree-node level-3">'), e("group"), F.lit("</h3><p>"), e("summary"), F.lit('</p></div><span class="group-count">'), F.col("n").cast("string"), F.lit(' 筆</span></div><div class="requirement-list">'))
    shown = F.col("o") == F.col("first")
    system = F.concat(F.lit('<section class="system-block tree-system" data-system="'), e("system"), F.lit('"><button class="system-toggle" type="button" aria-expanded="'), shown.cast("string"), F.lit('" aria-controls="'), T.slug(F.col("system")), F.lit('"><span class="system-title tree-node level-2">'), e("system"), F.lit('</span><span class="system-actions"><span class="count-badge">'), F.col("n").cast("string"), F.lit(' 筆</span><span class="toggle-marker" aria-hidden="true"></span></span></button><div class="system-groups" id="'), T.slug(F.col("system")), F.lit('"'), F.when(shown, "").otherwise(" hidden"), F.lit('><p class="system-summary">'), e("summary"), F.lit("</p>"))
    return row, (topic, F.lit("</div></section>")), (system, F.lit("</div></section>"))


def tree_html(req: DataFrame, guidance: DataFrame, topic_guidance: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One section of HTML per system (of each value of keys), with its topics and requirements; the first is expanded."""
    keys = keys or []
    row, topic, system = tree_marks()
    topics = req.withColumn("row", row).groupBy(*keys, "system", "group").agg(F.min("ord").alias("o"), F.count("*").alias("n"), joined("row", "ord", "").alias("rows")).join(topic_guidance.select(*keys, "system", "group", "summary"), [*keys, "system", "group"], "left")
    block = F.concat(topic[0], "rows", topic[1])
    systems = topics.withColumn("block", block).groupBy(*keys, "system").agg(F.min("o").alias("o"), F.sum("n").alias("n"), joined("block", "o", "").alias("blocks")).join(guidance.select(*keys, "system", "summary"), [*keys, "system"], "left")
    first = systems.groupBy(*keys).agg(F.min("o").alias("first"))
    rows = systems.join(first, keys) if keys else systems.join(F.broadcast(first))  # without keys first is one row
    return rows.select(*keys, "system", "o", "n", F.concat(system[0], "blocks", system[1]).alias("html"))


def cards(items: DataFrame, parts: list[tuple[str, str]], title: str, css: str) -> DataFrame:
    """One article a row."""
    body = [F.concat(F.lit(f"<p><strong>{label}</strong>"), T.html_escape(F.coalesce(c, F.lit(""))), F.lit("</p>")) for c, label in parts]
    return items.withColumn("html", F.concat(F.lit(f'<article class="{css}"><h3>'), T.html_escape(F.col(title)), F.lit("</h3>"), *body, F.lit("</article>")))


def embedded_json(payload: Column) -> Column:
    """JSON that is safe inside a script element."""
    for a, b in (("</", "<\\/"), (" ", "\\u2028"), (" ", "\\u2029")):
        payload = F.replace(payload, F.lit(a), F.lit(b))
    return payload


def inject(template: Column, payload: Column, start: str = START, end: str = END) -> Column:
    """The template with its data replaced; raises where it has not just one pair of markers."""
    n = F.size(F.split(template, rf"\Q{start}\E")) * 10 + F.size(F.split(template, rf"\Q{end}\E"))
    a, b = F.substring_index(template, start, 1), F.substring_index(template, end, -1)
    return F.when(n == 22, F.concat(a, F.lit(start), embedded_json(payload), F.lit(end), b)).otherwise(F.raise_error(F.lit("template data markers are missing or duplicated")))


def embedded(html: Column, schema: str, start: str = START, end: str = END) -> Column:
    """The data of a rendered page."""
    return F.from_json(F.regexp_extract(html, rf"(?s)\Q{start}\E(.*?)\Q{end}\E", 1), schema)


def handoff(req: DataFrame, reviews: DataFrame) -> DataFrame:
    """Per system its requirements with source, and counts, for the next team."""
    line = F.concat(F.lit("- ["), "requirement_id", F.lit("] "), "text", F.lit("（"), F.coalesce("source", F.lit("")), F.lit("）"))
    body = req.withColumn("line", line).groupBy("system").agg(F.min("ord").alias("o"), F.count("*").alias("n"), joined("line", "ord").alias("lines"))
    n = reviews.agg(F.count("*").alias("open"))
    return body.join(F.broadcast(n)).select("system", "o", "n", "open", F.concat(F.lit("## "), "system", F.lit("\n\n"), "lines", F.lit("\n")).alias("text"))  # n: one row
