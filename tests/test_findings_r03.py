"""Tests of the finding of round 3: pages are made and read in parts, none of which grows with its document."""

import json
import re

from pyspark.sql import functions as F

import __spark_entry__ as entry
from quillspark.operators import requirements as R
from quillspark.plans import delivery as Y

TEMPLATE = "<html>" + "".join("{{" + m + "}}\n" for m in Y.MARKERS) + "</html>"


def _master(items):
    """items: number, system, topic; a heading wherever one changes."""
    lines, at = ["# p | m", "", "## 專案摘要", "", "- one", "", "## 需求樹", ""], (None, None)
    for i, system, topic in items:
        if system != at[0]:
            lines += [f"### {system}", "", "- 系統摘要：about the system", ""]
        if (system, topic) != at:
            lines += [f"#### {topic}", "", "- 主題說明：about the topic", ""]
        at = (system, topic)
        lines += [f"- [REQ-M1-{i:04d}] do </b> {i}", f"  - 空間：s{i % 3}、s9", "  - 狀態：來源明示", "  - 來源：PDF 3", "  - 原文：as said"]
    return "\n".join(lines)


def test_no_part_grows_with_the_document(spark):
    docs = {f"d{n}": _master([(i, "S", f"g{i // 50}") for i in range(n)]) for n in (100, 2000)}
    parts = Y.page_parts(R.parse_master(spark.createDataFrame(list(docs.items()), "doc string, text string")), TEMPLATE)
    got = {r.doc: r for r in parts.groupBy("doc").agg(F.max(F.length("text")).alias("longest"), F.count(F.when(F.col("text").contains('class="requirement-row"'), 1)).alias("rows")).collect()}
    assert {d: r.rows for d, r in got.items()} == {"d100": 100, "d2000": 2000}
    assert max(r.longest for r in got.values()) < 1000


def test_the_query_makes_no_whole_page(spark):
    """What is collected for a document are the places and ids of its requirements, no texts."""
    plan = entry.queries()["delivery_pages"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"collect_list\(", plan)) == 1 and "concat_ws" not in plan


def test_parts_in_order_are_the_page(spark):
    """Systems and topics that come again stand where they came first; details stay in the master's order."""
    text = _master([(5, "B", "y"), (4, "B", "x"), (3, "A", "y"), (2, "B", "y"), (1, "A", "z")])
    tables = R.parse_master(spark.createDataFrame([("d", text), ("none", "# n\n\n## 專案摘要\n\n- no requirements\n")], "doc string, text string"))
    rows = Y.page_parts(tables, TEMPLATE).orderBy("doc", "at").collect()
    (page,) = Y.pages(tables, TEMPLATE).collect()
    assert {r.doc for r in rows} == {"d"} and page.doc == "d" and page.text == "".join(r.text for r in rows)
    held = {m: "".join(r.text for r in rows if r.marker == m) for m in Y.MARKERS}
    assert re.findall(r'data-id="REQ-M1-000(\d)"', held["TREE_HTML"]) == ["5", "2", "4", "3", "1"]
    assert re.findall(r'<section class="system-block tree-system" data-system="(\w)"', held["TREE_HTML"]) == ["B", "A"] and re.findall(r"<h3 [^>]*>(\w)</h3>", held["TREE_HTML"]) == ["y", "x", "y", "z"]
    assert held["TREE_HTML"].count("<section") == held["TREE_HTML"].count("</section>") and held["TREE_HTML"].endswith("</div></section></div>")
    details = json.loads(held["DETAILS_JSON"])
    assert [(r["id"][-1], r["text"], r["system_summary"], r["space_tokens"]) for r in details] == [(str(i), f"do </b> {i}", "about the system", [f"s{i % 3}", "s9"]) for i in (5, 4, 3, 2, 1)] and "</" not in held["DETAILS_JSON"]
    assert re.findall(r'value="(\w*)"', held["SPACE_OPTIONS"]) == ["", "s0", "s1", "s2", "s9"] and held["SUMMARY_HTML"] == '<ul class="summary-list"><li>one</li></ul>'
    assert "{{" not in page.text and page.text.startswith("<html>p\n未標示\n")
