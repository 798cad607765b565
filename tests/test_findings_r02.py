"""Tests of the findings of round 2: steps of groups write no texts; ids beyond four digits."""

import re

import duckdb
import pytest

import __spark_entry__ as entry
from quillspark.operators import margins as M
from quillspark.operators import requirements as R
from quillspark.plans import flows, registry
from quillspark.sources import documents, shared

SCREENED = ["screening_errors", "stage_receipts", "group_outline", "rendered_groups"]
IDS = ["delivery_outlines", "filtered_requirements", "prefixed_ids", "requirement_tree_html", "delivery_handoffs", "delivery_pages", "handoff", "open_points", "parsed_requirements", "requirement_details"]


@pytest.mark.parametrize("name", SCREENED)
def test_no_text_is_written(spark, name, monkeypatch):
    """Groups and what is made of them cross by source once; tables that are written hold no texts."""
    written = []

    def spy(df, *args, **kwargs):
        written.extend(df.columns)
        return shared.cut(df, *args, **kwargs)

    for module in (flows, registry):
        monkeypatch.setattr(module, "cut", spy, raising=False)
    df = entry.queries()[name](spark, "/root/testdata/sf0.001")
    assert not {"text", "block", "chunk", "quote", "body", "markdown"} & set(written)
    if name in ("group_outline", "rendered_groups"):
        crossings = re.findall(r"hashpartitioning\(([^)]*)\)", df._jdf.queryExecution().executedPlan().toString())
        assert crossings and all(re.fullmatch(r"source_id#\d+, \d+", x) for x in crossings)


@pytest.fixture(scope="module")
def wide(tmp_path_factory):
    """Keys about and beyond 9,999 and 99,999, one of each region's nations."""
    path = tmp_path_factory.mktemp("wide")
    src = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("nation", "region", "labels", "documents"):
        con.execute(f"COPY (SELECT * FROM read_parquet('{src}/{t}.parquet')) TO '{path}/{t}.parquet' (FORMAT parquet)")
    con.execute(f"COPY (SELECT * REPLACE (CAST(c_custkey + k AS BIGINT) AS c_custkey, c_name || k AS c_name) FROM read_parquet('{src}/customer.parquet'), (VALUES (0), (9950), (99950)) t(k)) TO '{path}/customer.parquet' (FORMAT parquet)")
    return str(path)


@pytest.mark.parametrize("name", IDS)
def test_ids_beyond_four_digits(spark, wide, name):
    con = duckdb.connect()
    for t in ("nation", "region", "labels", "documents", "customer"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{wide}/{t}.parquet')")
    df = entry.queries()[name](spark, wide)
    want = con.execute(entry.oracle_sql()[name])
    order = [[d[0] for d in want.description].index(c) for c in df.columns]
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(repr(tuple(r[i] for i in order)) for r in want.fetchall())


def test_parser_keeps_long_ids(spark):
    text = "# p\n\n## 需求樹\n\n### s\n\n#### g\n\n- [REQ-M1-9999] one\n- [REQ-M1-10000] two\n"
    tables = R.parse_master(spark.createDataFrame([("d", text)], "doc string, text string"))
    assert [r.requirement_id for r in tables["requirements"].orderBy("ord").collect()] == ["REQ-M1-9999", "REQ-M1-10000"]


@pytest.mark.parametrize("name", SCREENED)
def test_pages_cross_once(spark, name, monkeypatch):
    """In all jobs of a query together texts cross once, to a number of tasks that follows the texts' bytes and that adaptive
    execution doesn't merge to larger ones, which would spill; what is read of them is one branch, or the same crossing."""
    jobs = []

    def spy(df, *args, **kwargs):
        jobs.append(df)
        return shared.cut(df, *args, **kwargs)

    for module in (flows, registry):
        monkeypatch.setattr(module, "cut", spy, raising=False)
    monkeypatch.setattr(documents, "TASK_BYTES", 1 << 14)
    jobs.append(entry.queries()[name](spark, "/root/testdata/sf0.001"))
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in jobs]
    texts = [p for p in plans if re.search(r"FileScan parquet \[[^\]]*text", p)]
    assert len(texts) == 1 and all("REPARTITION_BY_NUM" in p and "RoundRobin" not in p for p in texts)
    assert "Join" not in texts[0] or name == "stage_receipts"
    assert all("REPARTITION_BY_NUM" in x for x in re.findall(r"Exchange hashpartitioning[^\n]*", texts[0]))
    assert int(re.search(r"hashpartitioning\(source_id#\d+, (\d+)\), REPARTITION_BY_NUM", texts[0])[1]) > 4


def test_margins_in_one_row(spark):
    """Lines that repeat at the edges of pages go: from the third page on, or from a share of the source's pages."""
    rows = [(s, p, f"{s} head\nbody {p} {s} {'x' * 60}\n{'twice' if p < 3 else 'foot' + 'abcdefghij'[p]}") for s, n in (("a", 5), ("b", 2)) for p in range(1, n + 1)] + [("c", 1, "")]
    got = M.cleaned_blocks(spark.createDataFrame(rows, "source_id string, pdf_page long, text string"), flows.L.LATIN)
    kept = {(r.source_id, r.pdf_page, r.block_index): r.block for r in got.collect()}
    assert not [b for (s, _, _), b in kept.items() if s == "a" and b == "a head"]
    assert kept[("a", 1, 2)] == "twice" and kept[("b", 1, 1)] == "b head" and kept[("b", 1, 3)] == "twice"
    assert len(kept) == 5 * 2 + 2 * 3


@pytest.mark.parametrize("name", ["delivery_handoffs", "delivery_errors"])
def test_customers_that_share_a_name(spark, tmp_path, name):
    """Copies with shifted keys and the same names are delivered, as in the SQL."""
    con, src = duckdb.connect(), "/root/testdata/sf0.001"
    for t in ("nation", "region"):
        con.execute(f"COPY (SELECT * FROM read_parquet('{src}/{t}.parquet')) TO '{tmp_path}/{t}.parquet' (FORMAT parquet)")
    con.execute(f"COPY (SELECT * REPLACE (CAST(c_custkey + k AS BIGINT) AS c_custkey) FROM read_parquet('{src}/customer.parquet'), (VALUES (0), (15000)) t(k)) TO '{tmp_path}/customer.parquet' (FORMAT parquet)")
    for t in ("nation", "region", "customer"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet')")
    df = entry.queries()[name](spark, str(tmp_path))
    want = con.execute(entry.oracle_sql()[name])
    order = [[d[0] for d in want.description].index(c) for c in df.columns]
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(repr(tuple(r[i] for i in order)) for r in want.fetchall())
