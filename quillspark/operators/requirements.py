"""Requirements: the Markdown master as tables, its validation rules, tree, guidance and filters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .ordinals import ordinal

# Section titles, labels and allowed values of the master document's format.
TREE, REVIEW, CONTEXT, SUMMARY = "需求樹", "需要人工確認", "背景與排除紀錄", "專案摘要"
LABELS = {
    "header": {"來源文件": "source_file", "來源 SHA-256": "source_sha256", "產出日期": "generated_date"},
    "system": {"系統摘要": "summary", "系統設計重點": "design_focus", "主要介面": "interfaces", "主要圖說／文件": "deliverables"},
    "topic": {"主題說明": "summary", "主題設計重點": "design_focus", "主題圖說／文件": "deliverables"},
    "REQ": {"空間": "space", "狀態": "status", "來源": "source", "原文": "quote"},
    "REV": {"影響": "impact", "建議確認": "reviewer", "來源": "source", "原文": "quote"},
    "CTX": {"理由": "reason", "來源": "source"},
}
STATUSES = ("來源明示", "跨章整合", "需人工確認")
BOILERPLATE = ("依來源規格納入", "未辨識出明示跨系統協作", "統包商應確認涵蓋範圍、供電及介面責任")
#: What a system's overview looks for in its texts.
RELATED = ("智慧建築",)
PLACEHOLDER = r"(?i)\{\{.+?\}\}|<待填|TODO"


def master_lines(docs: DataFrame, doc: str = "doc", text: str = "text") -> DataFrame:
    """One row for each non-blank line of each master, with the section, system, group and item that it stands under.

    The state machine over lines as windows inside a document: each level is the last of its kind, unless a higher
    level began since. A document is one window; documents are spread over tasks.
    """
    rows = docs.select(F.col(doc).alias("doc"), F.posexplode(F.transform(T.lines(F.col(text)), lambda x: F.regexp_replace(x, f"{T.S}+$", ""))).alias("line_no", "raw"))
    rows = rows.withColumn("line", T.strip(F.col("raw"))).where("line <> ''")
    w = Window.partitionBy("doc").orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    line = F.col("line")
    title = lambda n: T.squeeze(F.substr(line, F.lit(n)))
    rows = rows.withColumn("is_title", F.startswith(line, F.lit("# "))).withColumn("is_section", F.startswith(line, F.lit("## ")))
    rows = rows.withColumn("section", F.coalesce(F.last(F.when(F.col("is_section"), title(4)), ignorenulls=True).over(w), F.lit("")))
    in_tree = F.col("section") == TREE
    is_system, is_group = in_tree & F.startswith(line, F.lit("### ")), in_tree & F.startswith(line, F.lit("#### "))
    item = F.regexp_extract(line, r"^- \[((REQ|REV|CTX)-M1-\d{4,})\]\s+.+$", 1)
    kind = F.substring(item, 1, 3)
    fits = ((kind == "REQ") & in_tree) | ((kind == "REV") & (F.col("section") == REVIEW)) | ((kind == "CTX") & (F.col("section") == CONTEXT))
    rows = rows.withColumn("is_system", is_system & ~F.col("is_section")).withColumn("is_group", is_group & ~F.col("is_section"))
    rows = rows.withColumn("item_at", F.when(fits & (item != ""), F.struct("line_no", item.alias("id"), T.squeeze(F.regexp_extract(line, r"^- \[[A-Z]{3}-M1-\d{4,}\]\s+(.+)$", 1)).alias("text"))))
    last = lambda test, value: F.last(F.when(test, value), ignorenulls=True).over(w)
    rows = rows.withColumn("at_section", F.coalesce(last(F.col("is_section"), F.col("line_no")), F.lit(-1)))
    rows = rows.withColumn("sys", last(F.col("is_system"), F.struct("line_no", title(5).alias("t")))).withColumn("grp", last(F.col("is_group"), F.struct("line_no", title(6).alias("t"))))
    at_system = F.when(F.col("sys.line_no") > F.col("at_section"), F.col("sys.line_no")).otherwise(F.col("at_section"))
    at_group = F.when(F.col("grp.line_no") > at_system, F.col("grp.line_no"))
    rows = rows.withColumn("system", F.when(F.col("sys.line_no") > F.col("at_section"), F.col("sys.t")).otherwise("")).withColumn("group", F.when(at_group.isNotNull(), F.col("grp.t")).otherwise(""))
    rows = rows.withColumn("floor", F.coalesce(at_group, at_system)).withColumn("found", F.last("item_at", ignorenulls=True).over(w))
    rows = rows.withColumn("item", F.when(F.col("found.line_no") > F.col("floor"), F.col("found")))
    pair = lambda s, p: F.struct(T.squeeze(F.regexp_extract(s, p, 1)).alias("label"), T.squeeze(F.regexp_extract(s, p, 2)).alias("value"))
    top, inner = r"^- ([^：:]+)[：:]\s*(.*)$", r"^\s{2,}- ([^：:]+)[：:]\s*(.*)$"
    meta = F.when(F.col("item").isNotNull() & F.col("raw").rlike(inner), pair(F.col("raw"), inner)).when(F.col("item").isNull() & line.rlike(top), pair(line, top))
    return rows.withColumn("meta", F.when(F.col("item_at").isNull(), meta))


def _fields(rows: DataFrame, keys: list[str], labels: dict[str, str]) -> DataFrame:
    """The last value of each label, as columns; missing ones are empty."""
    value = lambda label: F.max_by("meta.value", F.when(F.col("meta.label") == label, F.col("line_no")))
    return rows.groupBy(*keys).agg(*[F.coalesce(F.when(F.bool_or(F.coalesce(F.col("meta.label") == label, F.lit(False))), value(label)), F.lit("")).alias(name) for label, name in labels.items()])


def parse_master(docs: DataFrame, doc: str = "doc", text: str = "text", keep: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> dict[str, DataFrame]:
    """Tables of all masters in docs: project, summary, requirements, reviews, context, system_guidance, topic_guidance.

    keep: what is done with the lines, which all tables read; shared.cut, if several of them are needed."""
    rows = keep(master_lines(docs, doc, text).select("doc", "line_no", "line", "is_title", "section", "system", "group", "item", "meta"))
    head = rows.where("section = ''")
    name = F.coalesce(F.max_by(F.when(F.col("is_title"), T.squeeze(F.split(F.substr("line", F.lit(3)), r"\|", 2)[0])), F.when(F.col("is_title"), F.col("line_no"))), F.lit("弱電需求圖譜"))
    project = rows.groupBy("doc").agg(name.alias("project_name")).join(_fields(head, ["doc"], LABELS["header"]), "doc", "left").withColumn("source_sha256", F.trim("source_sha256", F.lit("`")))
    items = rows.where("item is not null").withColumn("ord", F.col("item.line_no")).withColumn("id", F.col("item.id")).withColumn("body", F.col("item.text"))

    def kind(prefix: str, names: tuple[str, str]) -> DataFrame:
        own = items.where(F.startswith("id", F.lit(prefix)))
        keys = ["doc", "ord", "id", "body", *(["system", "group"] if prefix == "REQ" else [])]
        return _fields(own, keys, LABELS[prefix]).withColumnsRenamed({"id": names[0], "body": names[1]})

    tree = rows.where((F.col("section") == TREE) & F.col("item").isNull() & (F.col("system") != ""))
    return {
        "project": project,
        "summary": rows.where((F.col("section") == SUMMARY) & F.startswith("line", F.lit("- "))).select("doc", F.col("line_no").alias("ord"), T.squeeze(F.substr("line", F.lit(3))).alias("text")),
        "requirements": kind("REQ", ("requirement_id", "text")),
        "reviews": kind("REV", ("review_id", "question")),
        "context": kind("CTX", ("context_id", "text")),
        "system_guidance": _fields(tree.where("group = ''"), ["doc", "system"], LABELS["system"]),
        "topic_guidance": _fields(tree.where("group <> ''"), ["doc", "system", "group"], LABELS["topic"]),
    }


def text_key(s: Column) -> Column:
    """What two requirements must not share: the text's word characters in lower case."""
    return F.lower(F.regexp_replace(s, T.U + r"\W+", ""))


def validate(tables: dict[str, DataFrame], raw: DataFrame | None = None, statuses: tuple[str, ...] = STATUSES) -> DataFrame:
    """doc, rule, key: all violations of all masters. Each rule is an aggregate or a filter; joins are by system and topic."""
    req, rev, every = tables["requirements"], tables["reviews"], tables["project"].select("doc")
    found: list[DataFrame] = []

    def rule(name: str, df: DataFrame, test: Column, key: Column) -> None:
        found.append(df.where(test).select("doc", F.lit(name).alias("rule"), key.cast("string").alias("key")))

    none, empty = F.lit(""), lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    if raw is not None:
        rule("unresolved placeholders", raw, F.col("text").rlike(PLACEHOLDER), none)
    rule("no requirements", every.join(req.select("doc").distinct(), "doc", "left_anti"), F.lit(True), none)
    for df, col, name in ((req, "requirement_id", "duplicate requirement id"), (rev, "review_id", "duplicate review id")):
        rule(name, df.groupBy("doc", col).agg(F.count("*").alias("n")), F.col("n") > 1, F.col(col))
    rid = F.col("requirement_id")
    rule("missing system or group", req, empty("system") | empty("group"), rid)
    rule("missing space", req, empty("space"), rid)
    rule("invalid status", req, ~F.coalesce(F.col("status").isin(*statuses), F.lit(False)), rid)
    rule("missing page source", req, empty("source") | (F.size(T.pdf_pages(F.col("source"))) == 0), rid)
    rule("missing quote", req, F.length(F.coalesce("quote", none)) < 4, rid)
    rule("boilerplate", req, F.col("text").rlike("|".join(BOILERPLATE)), rid)
    again = F.row_number().over(Window.partitionBy("doc", "text_key").orderBy("ord"))
    rule("duplicate text", req.withColumn("text_key", text_key(F.col("text"))).withColumn("again", again), F.col("again") > 1, rid)
    systems = req.groupBy("doc", "system").agg(F.count("*").alias("n"), F.count_distinct("group").alias("n_groups")).join(tables["system_guidance"], ["doc", "system"], "left")
    topics = req.select("doc", "system", "group").distinct().join(tables["topic_guidance"], ["doc", "system", "group"], "left")
    short = lambda c, n: F.length(F.coalesce(F.col(c), F.lit(""))) < n
    system, topic = F.col("system"), F.concat_ws(" / ", "system", "group")
    for df, key, c, n, name in ((systems, system, "summary", 12, "short system summary"), (systems, system, "design_focus", 12, "short system design focus"), (systems, system, "deliverables", 4, "short system deliverables"), (topics, topic, "summary", 8, "short topic summary"), (topics, topic, "design_focus", 8, "short topic design focus")):
        rule(name, df, short(c, n), key)
    rule("private topics", systems, (F.col("n") >= 5) & (F.col("n_groups") == F.col("n")), system)
    whole = req.groupBy("doc").agg(F.count("*").alias("n"), F.count_distinct("system", "group").alias("topics"))
    rule("fragmented tree", whole, (F.col("n") >= 20) & (F.col("topics") > F.greatest(F.lit(12), F.ceil(F.col("n") * 0.75))), none)
    rule("incomplete review", rev, empty("impact") | empty("reviewer") | empty("source") | empty("quote"), F.col("review_id"))
    out = found[0]
    for df in found[1:]:
        out = out.unionByName(df)
    return out


def details(req: DataFrame, systems: DataFrame, topics: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Requirements with guidance: the topic's design focus, else the system's; deliverables of both, joined."""
    keys = keys or []
    s = systems.select(*keys, "system", F.col("design_focus").alias("s_focus"), F.col("deliverables").alias("s_docs"), "interfaces")
    t = topics.select(*keys, "system", "group", F.col("design_focus").alias("t_focus"), F.col("deliverables").alias("t_docs"))
    out = req.join(s, [*keys, "system"], "left").join(t, [*keys, "system", "group"], "left")
    full = lambda c: F.nullif(F.col(c), F.lit(""))
    return out.withColumn("design_focus", F.coalesce(full("t_focus"), full("s_focus"), F.lit(""))).withColumn("deliverables", F.concat_ws("；", full("t_docs"), full("s_docs"))).drop("s_focus", "s_docs", "t_focus", "t_docs")


def tree_counts(req: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The tree's nodes with counts: all, systems, and topics, ordered by first appearance (first_ord)."""
    keys = keys or []
    out = req.rollup("system", "group") if not keys else req.groupingSets([[F.col(k) for k in keys], [F.col(k) for k in [*keys, "system"]], [F.col(k) for k in [*keys, "system", "group"]]], *keys, "system", "group")
    out = out.agg(F.count("*").alias("n"), F.min("ord").alias("first_ord"), F.grouping_id().alias("g"))
    return out.select(*keys, "system", "group", F.when(F.col("g") == 3, 0).when(F.col("g") == 1, 1).otherwise(2).alias("level"), "n", "first_ord")


def nested_tree(req: DataFrame) -> DataFrame:
    """One row a system: its topics, their requirements, and each one's tags, in order of appearance. Topics hold their own
    items only, so no array is larger than a system."""
    leaf = F.struct("ord", "requirement_id", "text", F.struct("space", "status", "source").alias("tags"))
    topics = req.groupBy("system", "group").agg(F.min("ord").alias("first_ord"), F.count("*").alias("n"), F.array_sort(F.collect_list(leaf)).alias("items"))
    node = F.struct("first_ord", "group", "n", "items")
    return topics.groupBy("system").agg(F.min("first_ord").alias("first_ord"), F.sum("n").alias("n"), F.array_sort(F.collect_list(node)).alias("topics"))


def options(req: DataFrame, column: str) -> DataFrame:
    """The distinct values, for a list to choose from."""
    return req.select(column).distinct().orderBy(column)


def filtered(req: DataFrame, query: str | None = None, system: str | None = None, space: str | None = None, status: str | None = None) -> DataFrame:
    """The interactive filter; a None means no condition."""
    test = F.lit(True)
    if query:
        test = test & F.contains(F.lower(F.concat_ws(" ", "text", "system", "group", "space")), F.lit(query.lower()))
    if system:
        test = test & (F.col("system") == system)
    if space:
        test = test & F.array_contains(T.split_tokens(F.col("space")), space)
    if status:
        test = test & (F.col("status") == status)
    return req.where(test)


def system_overview(req: DataFrame, questions: DataFrame, guidance: DataFrame | None = None, related: tuple[str, ...] = RELATED, top: int = 3) -> DataFrame:
    """Per system a guide to its details: topics and items, its topics' names as labels, its drawings and documents
    (guidance: system, deliverables), which of the related terms its texts hold, the first open questions by priority
    and how many there are, the priority of the first, and the link to its details (the id that tree_html gives)."""
    rank = F.row_number().over(Window.partitionBy("system").orderBy("priority", "ord"))
    asked = questions.groupBy("system").agg(F.count("*").alias("open_items"), F.min("priority").alias("priority"))
    first = questions.withColumn("rank", rank).where(F.col("rank") <= top).groupBy("system").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "question"))), lambda x: x["question"]).alias("open_questions"))
    rows = req.withColumn("key", T.semantic_key(F.col("text")))
    held = [F.max(F.contains("key", F.lit(T.key_of(t)))).alias(f"has_{i}") for i, t in enumerate(related)]
    topics = rows.groupBy("system", "group").agg(F.count("*").alias("n"), F.min("ord").alias("o"), *held)
    labels = F.transform(F.array_sort(F.collect_list(F.struct("o", "group"))), lambda x: x["group"])
    terms = F.array_compact(F.array(*[F.when(F.max(f"has_{i}"), F.lit(t)) for i, t in enumerate(related)])) if related else F.array().cast("array<string>")
    out = topics.groupBy("system").agg(F.count("*").alias("topics"), F.sum("n").alias("items"), F.min("o").alias("first_ord"), labels.alias("labels"), terms.alias("related_terms"))
    out = out.join(first, "system", "left").join(asked, "system", "left").withColumn("open_questions", F.coalesce("open_questions", F.array().cast("array<string>"))).fillna(0, ["open_items"])
    out = out.join(guidance.select("system", F.col("deliverables").alias("documents")), "system", "left") if guidance is not None else out.withColumn("documents", F.lit(None).cast("string"))
    return out.withColumn("documents", F.coalesce("documents", F.lit(""))).withColumn("details", F.concat(F.lit("#"), T.slug(F.col("system"))))


def paired_replies(turns: DataFrame, conv: str, turn: str, role: str, text: str, ask: str = "user", reply: str = "assistant") -> DataFrame:
    """Each question with the reply in the next turn, if there is one; open questions stay, marked."""
    w = Window.partitionBy(conv).orderBy(turn)
    rows = turns.withColumn("r", F.lead(role).over(w)).withColumn("t", F.lead(text).over(w)).where(F.col(role) == ask)
    answer = F.when(F.col("r") == reply, F.col("t"))
    return rows.select(conv, turn, F.col(text).alias("question"), answer.alias("reply"), answer.isNull().alias("is_open"))


def todo(*parts: tuple[str, int, DataFrame]) -> DataFrame:
    """One list of open points: (kind, priority, rows with key and note, and where known system, source, reason, reviewer)."""
    out = None
    for kind, priority, df in parts:
        more = [(F.coalesce(F.col(c).cast("string"), F.lit("")) if c in df.columns else F.lit("")).alias(c) for c in ("system", "source", "reason", "reviewer")]
        rows = df.select(F.lit(kind).alias("kind"), F.lit(priority).alias("priority"), F.col("key").cast("string").alias("key"), F.col("note").cast("string").alias("note"), *more)
        out = rows if out is None else out.unionByName(rows)
    return out


def governed(items: DataFrame, primary: str = "primary_requirements") -> DataFrame:
    """Where a primary and a review document speak of one key, the primary governs; review rows only add keys."""
    own = items.where(F.col("role") == primary).select("key").distinct()
    return items.where(F.col("role") == primary).unionByName(items.where(F.col("role") != primary).join(own, "key", "left_anti"))


def renumbered(items: DataFrame, prefix: str, order: str = "ord") -> DataFrame:
    return ordinal(items, "n", [], F.floor(F.col(order) / 4096), order).withColumn("id", F.format_string(prefix + "-%04d", "n"))
