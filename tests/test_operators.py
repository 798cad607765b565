"""Operators on small hand-made tables."""

import pytest
from pyspark.sql import functions as F

from quillspark.functions import lexicon as L
from quillspark.operators import batches as B
from quillspark.operators import candidates as C
from quillspark.operators import chunks as K
from quillspark.operators import groups as G
from quillspark.operators import margins as M
from quillspark.operators import ocr as O
from quillspark.operators import quality as Q
from quillspark.operators import receipts as X
from quillspark.operators import regions as V
from quillspark.operators import requirements as R
from quillspark.operators.ordinals import ordinal
from quillspark.plans import render as D
from quillspark.sources import documents as S
from quillspark.sources import files
from quillspark.sources.shared import cut

BLOCK = "source_id string, pdf_page int, block_index int, block string"


def chunk(spark, text, **how):
    return spark.createDataFrame([(text,)], "t string").select(K.chunks_of(F.col("t"), **how).alias("c")).first()["c"]


def test_long_parts_are_sliced(spark):
    text = "".join(chr(0x4E00 + i % 500) for i in range(2000))
    got = chunk(spark, text)
    assert got == [text[0:760], text[680:1440], text[1360:2000]]
    assert chunk(spark, "x" * 760) == ["x" * 760] and chunk(spark, "") == []
    assert chunk(spark, "x" * 761) == ["x" * 760, "x" * 81]


def test_numbered_items_and_obligations_split(spark):
    assert chunk(spark, "前言文字\n1. 甲\n二、乙") == ["前言文字", "1. 甲", "二、乙"]
    assert chunk(spark, "電話應設置。網路應提供。") == ["電話應設置。", "網路應提供。"]
    assert chunk(spark, "說明一。說明二；說明三") == ["說明一。\n說明二；\n說明三"]
    assert chunk(spark, "a" * 30 + "\n" + "b" * 30 + "\n" + "c" * 30, limit=61) == ["a" * 30 + "\n" + "b" * 30, "c" * 30]


def test_ordinals_are_dense_and_ordered(spark):
    rows = [(i % 3, i) for i in range(200)]
    got = ordinal(spark.createDataFrame(rows, "k int, v int"), "n", ["k"], F.floor(F.col("v") / 16), "v").collect()
    for k in range(3):
        own = sorted((r.v, r.n) for r in got if r.k == k)
        assert [n for _, n in own] == list(range(1, len(own) + 1))


def pages_of(spark, texts):
    docs = spark.createDataFrame([("s", i, t) for i, t in enumerate(texts)], "source string, doc_id long, text string")
    return S.pages(docs)


def test_margins(spark):
    texts = [f"機密文件\n內容 {i} 甲乙丙丁\n第 {i} 節\n結尾線" for i in range(5)] + ["獨立", ""]
    pages = pages_of(spark, texts)
    blocks = S.blocks(pages)
    found = {r.line_key: r.n_pages for r in M.repeated_margin_lines(blocks, pages).collect()}
    assert found == {"機密文件": 5, "結尾線": 5}
    left = M.remove_margin_noise(blocks, M.repeated_margin_lines(blocks, pages))
    assert sorted((r.pdf_page, r.block_index, r.block) for r in left.collect())[:2] == [(1, 1, "內容 0 甲乙丙丁"), (1, 2, "第 0 節")]
    assert left.where("pdf_page = 6").count() == 1


def test_headings(spark):
    blocks = spark.createDataFrame([("s", 1, 1, "說明文字。"), ("s", 1, 2, "第一章 弱電系統"), ("s", 1, 3, "內文甲應設置電話。"), ("s", 1, 4, "1.2 設備規格"), ("s", 1, 5, "內文乙"), ("s", 2, 1, "無標題。")], BLOCK)
    got = {(r.pdf_page, r.block_index): (r.heading, r.heading_basis) for r in C.context_headings(blocks).collect()}
    assert got == {
        (1, 1): ("第一章 弱電系統", "page_heading"), (1, 2): ("第一章 弱電系統", "page_heading"), (1, 3): ("第一章 弱電系統", "preceding_heading"),
        (1, 4): ("第一章 弱電系統", "preceding_heading"), (1, 5): ("1.2 設備規格", "preceding_heading"), (2, 1): ("PDF page 2", "page_fallback"),
    }
    assert {r.pdf_page: r.heading for r in C.page_headings(blocks).collect()} == {1: "1.2 設備規格", 2: "PDF page 2"}


def flow(spark, texts):
    pages = pages_of(spark, texts)
    blocks = S.blocks(pages)
    chunks = K.chunks(blocks)
    terms = C.dynamic_terms(chunks)
    cands = C.candidates(C.enriched(chunks, C.context_headings(blocks), terms))
    return pages, blocks, terms, cands


def test_candidates_groups_and_batches(spark):
    texts = ["停車場車道應設置攝影機 XQ9。\n監視系統資料傳輸 XQ9", "停車場車道應設置攝影機 XQ9。\n- 12 -", ""]
    pages, blocks, terms, cands = flow(spark, texts)
    assert [(r.term, r.n) for r in terms.collect()] == [("XQ9", 3)]
    rows = {r.candidate_id: r for r in cands.collect()}
    assert sorted(rows) == ["CAND-00001", "CAND-00002", "CAND-00003"]
    first = rows["CAND-00001"]
    assert first.system_hints == ["監視系統", "停車管理系統"] and first.obligation_terms == ["應", "設置"] and first.space_hints == ["停車空間"] and first.space_hint_basis == "explicit"
    assert first.score == 6 + 1 + 1 and "XQ9" in first.preservation_terms and "停車" not in first.preservation_terms  # a semantic term is missing
    assert first.neighbor_candidate_ids == ["CAND-00002"] and rows["CAND-00003"].neighbor_candidate_ids == []
    status = {r.pdf_page: (r.status, r.coverage_status) for r in C.page_records(pages, blocks, cands, C.page_headings(blocks)).collect()}
    assert status == {1: ("candidate", "native_complete"), 2: ("candidate", "native_complete"), 3: ("unreadable", "unreadable")}
    records = G.records(cands)
    assert sorted((r.record_no, r.candidate_ids, r.pdf_pages) for r in records.collect()) == [(1, ["CAND-00001", "CAND-00003"], [1, 2]), (2, ["CAND-00002"], [1])]
    groups = G.groups(records).collect()
    assert [(g.evidence_group_id, g.route_candidate_ids, g.pdf_pages) for g in groups] == [("EGRP-0001", ["CAND-00001", "CAND-00003", "CAND-00002"], [1, 2])]
    assert groups[0].leading_context is None and groups[0].trailing_context is None


def test_group_limits(spark):
    rows = [("s", i, f"q{i}" * 3, ["c"] * n, [page], chars) for i, (n, page, chars) in enumerate([(5, 1, 10), (7, 1, 10), (1, 1, 10), (1, 2, 4000), (1, 2, 900), (13, 2, 5000), (1, 2, 1)], 1)]
    df = spark.createDataFrame(rows, "source_id string, record_no long, quote string, candidate_ids array<string>, pdf_pages array<int>, n int").withColumn("quote", F.expr("repeat('x', n)"))
    none = F.array().cast("array<string>")
    for c in ("context_headings", "system_hints", "space_hints", "business_axes", "preservation_terms", "source_confidences", "text_quality_flags", "signal_flags"):
        df = df.withColumn(c, none)
    df = df.withColumn("source_shape", F.lit("sentence")).withColumn("origin_kinds", F.array(F.lit("source")))
    got = sorted((g.group_no, [x.record_no for x in g.segments], g.leading_context is None, g.trailing_context is None) for g in G.groups(df).collect())
    assert got == [(1, [1, 2], True, False), (2, [3], False, False), (3, [4], False, False), (4, [5], False, False), (5, [6], False, False), (6, [7], False, True)]
    sized = spark.createDataFrame([("s", i, f"E{i}", [i], c) for i, c in enumerate([20000, 8000, 1, 30000, 5], 1)], "source_id string, group_no long, evidence_group_id string, pdf_pages array<int>, chars long")
    assert sorted((b.batch_id, b.evidence_group_ids) for b in G.screening_batches(sized).collect()) == [("SB-001", ["E1", "E2"]), ("SB-002", ["E3"]), ("SB-003", ["E4"]), ("SB-004", ["E5"])]
    with pytest.raises(ValueError, match="too small"):
        G.screening_batches(sized, 0)


def test_drafts_follow_the_groups(spark):
    _, _, _, cands = flow(spark, ["停車場車道應設置攝影機。"])
    regions = spark.createDataFrame([("VR-1", "s", 1, "h", "草稿 AB1", "pending", "low"), ("VR-2", "s", 1, "h", "x", "read", "high"), ("VR-3", "s", 1, "h", "  ", "pending", "low")], "region_id string, source_id string, pdf_page int, context_heading string, ocr_draft string, status string, confidence string")
    view = {g.evidence_group_id: g for g in G.candidate_view(cands, regions).collect()}
    assert sorted(view) == ["EGRP-0001", "EGRP-0002"] and view["EGRP-0002"].segments[0].quote == "草稿 AB1" and view["EGRP-0002"].route_visual_region_ids == ["VR-1"]


def test_quality_and_choice(spark):
    rows = [
        ("garbled", "、。、。、。,,,, ((((", "完整的頁面內容，文字清楚且可讀。", ["probable_fragment"]),
        ("same", "一段正常的文字內容。", "一段正常的文字內容。", []),
        ("none", "一段正常的文字內容。", None, ["low_native_text"]),
        ("blank", " \n", "另一個版本", []),
        ("short", "很長的正常文字內容" * 10 + "((((", "短文", []),
    ]
    df = spark.createDataFrame(rows, "k string, primary string, alternate string, review_reasons array<string>")
    got = {r.k: r.canonical_source for r in Q.canonical(df).collect()}
    assert got == {"garbled": "full_page", "same": "pdf_aware", "none": "pdf_aware", "blank": "full_page", "short": "pdf_aware"}


def test_cleaned_lines(spark):
    df = spark.createDataFrame([("a \na\n\n\n\na\nb\r\nb\n<!-- image -->\nPage 3 of 9\nb\na",)], "t string")
    assert df.select(Q.clean_page(F.col("t")).alias("v")).first()["v"] == "a\n\nb\na"


def test_review_reasons(spark):
    df = spark.createDataFrame([("x" * 103, 103), ("y" * 800, 800), ("bad � " + "z" * 300, 500), ("、、、" + "w" * 300, 300), ("，。，。" + "w" * 300, 300), ("，。，" + "w" * 300, 300)], "t string, n int")
    got = [r.v for r in df.select(Q.review_reasons(F.col("t"), F.col("n")).alias("v")).collect()]
    assert got == [["low_native_text", "short_pdf_aware_output"], [], ["replacement_character"], ["probable_fragment"], ["probable_fragment"], []]


def test_merging_batches_of_several_sources(spark):
    rows = [(s, b, i, f"CAND-{i:05d}", f"CLM-{i:05d}", ["CAND-00001"]) for s in ("s", "t") for b in (0, 1) for i in (1, 2)]
    cands = spark.createDataFrame(rows, "source_id string, batch_ord int, position int, candidate_id string, claim_id string, neighbor_candidate_ids array<string>")
    claims = spark.createDataFrame([(*r[:2], r[4]) for r in rows if r[:3] != ("t", 0, 2)], "source_id string, batch_ord int, claim_id string")
    evidence = spark.createDataFrame([(*r[:2], r[4], f"{r[0]}{r[1]}{r[2]}") for r in rows if r[:3] != ("s", 1, 1)], "source_id string, batch_ord int, claim_id string, quote string")
    assert sorted((r.source_id, r.batch_ord, r.candidate_id) for r in B.incomplete_chains(cands, claims, evidence).collect()) == [("s", 1, "CAND-00001"), ("t", 0, "CAND-00002")]
    c, _, e = B.merged(cands, claims, evidence)
    assert sorted((r.source_id, r.candidate_id, r.neighbor_candidate_ids) for r in c.collect()) == [(s, f"CAND-{i:05d}", [f"CAND-{(i - 1) // 2 * 2 + 1:05d}"]) for s in ("s", "t") for i in (1, 2, 3, 4)]
    want = {(s, f"CLM-{b * 2 + i:05d}", f"{s}{b}{i}") for s, b, i, *_ in rows}
    assert {(r.source_id, r.claim_id, r.quote) for r in e.collect()} == want - {("s", "CLM-00003", "s11")}


def test_batches_and_bisection(spark):
    ranges = B.page_batches(spark.createDataFrame([("s", 26), ("t", 25), ("u", 0)], "source_id string, page_count int"))
    assert sorted((r.source_id, r.batch_id, r.page_start, r.page_end) for r in ranges.collect()) == [("s", "B01", 1, 25), ("s", "B02", 26, 26), ("t", "B01", 1, 25)]
    rows = spark.createDataFrame([("s", "B03", 11, 15), ("s", "B04", 16, 16)], "source_id string, batch_id string, page_start int, page_end int")
    got = sorted((r.batch_id, r.page_start, r.page_end, r.terminal) for r in B.bisected(rows, rows.select("source_id", "batch_id")).collect())
    assert got == [("B03A", 11, 13, False), ("B03B", 14, 15, False), ("B04", 16, 16, True)]
    with pytest.raises(ValueError, match="5 to 30"):
        B.page_batches(rows, 31)


def test_recognition(spark):
    head = "level\tpage_num\tblock_num\tpar_num\tline_num\tword_num\tleft\ttop\twidth\theight\tconf\ttext\n"
    body = "5\t1\t1\t1\t1\t1\t0\t0\t1\t1\t90\tabcd\n5\t1\t1\t1\t2\t1\t0\t0\t1\t1\t60\txy\n4\t1\t1\t1\t1\t0\t0\t0\t1\t1\t-1\t\n5\t1\t1\t1\t1\t2\t0\t0\t1\t1\t-1\tbad\n5\t1\t1\t1\t1\t3\t0\t0\t1\t1\t30\t\"q"
    tokens = files.token_tables(spark.createDataFrame([("r", head + body)], "region_id string, tsv string"), "region_id", "tsv")
    r = O.recognised(tokens, ["region_id"]).first()
    assert r.text == 'abcd "q\nxy' and abs(r.mean_confidence - (90 * 4 + 60 * 2 + 30 * 2) / 8) < 1e-9
    rows = [("a", 1, "text", 80.0), ("a", 2, "text two", 99.0), ("b", 1, "text", 42.0), ("b", 2, "text", 91.0), ("c", 1, "text", 48.0), ("c", 2, "text", 52.0), ("d", 1, "text", None), ("d", 2, "text", None)]
    best = O.best_attempts(spark.createDataFrame([(*x, 1) for x in rows], "k string, attempt int, text string, mean_confidence double, image_count int"), ["k"])
    assert {r.k: (r.attempt, r.status) for r in best.collect()} == {"a": (1, "read"), "b": (2, "read"), "c": (2, "pending"), "d": (1, "pending")}


def test_late_candidates_follow_the_known_ones(spark):
    pages, blocks, _, cands = flow(spark, ["停車場車道應設置攝影機。\n1、監視系統資料", "電話應設置。"])
    cands = cut(cands)
    known = cands.select("source_id", "page_id", "pdf_page", "serial", "candidate_id").collect()
    last, page = max(r.serial for r in known), next(r.page_id for r in known if r.pdf_page == 1)
    other = next(r.page_id for r in known if r.pdf_page == 2)
    columns = "region_id string, page_id string, source_id string, pdf_page int, status string, transcribed_text string, context_heading string, context_heading_basis string, confidence string, mean_confidence double, engine string"
    rows = [
        ("V2", page, "s", 1, "read", "網路機房應設置光纖設備；", "第一章", "page_heading", "high", 90.0, "x"), ("V1", page, "s", 1, "read", "1、門禁應連動。", "第一章", "page_heading", "low", 20.0, "x"),
        ("V3", page, "s", 1, "read", "網路 機房應設置光纖設備；", "第一章", "page_heading", "high", 90.0, "x"), ("V4", other, "s", 2, "read", "電話應設置。", "第二章", "page_heading", "high", 90.0, "x"), ("V5", other, "s", 2, "pending", "", "", "", "low", None, None),
    ]
    regions = spark.createDataFrame(rows, columns)
    late = cut(O.late_candidates(O.late_chunks(regions, cands.select("page_id", F.col("chunk").alias("quote")), L.DOMAIN), cands))
    got = {r.region_id: r for r in late.collect()}
    assert {k: r.serial for k, r in got.items()} == {"V1": last + 1, "V2": last + 2}  # V3 repeats V2, V4 the page's own text
    assert got["V1"].source_shape == "list_item" and got["V1"].text_quality_flags == ["ocr_fragment"] and got["V2"].text_quality_flags == [] and got["V2"].evidence_id == f"EV-{last + 2:05d}"
    every = O.with_late(cands, late)
    on = {r.candidate_id: r for r in every.where(F.col("page_id") == page).collect()}
    order = [r.candidate_id for r in sorted(on.values(), key=lambda r: r.serial)]
    assert [on[c].sequence_on_page for c in order] == list(range(1, len(order) + 1)) and on[order[-1]].neighbor_candidate_ids == [order[-2]] and on[order[1]].neighbor_candidate_ids == [order[0], order[2]]
    records = spark.createDataFrame([(page, ["x"], True, "f"), (other, [], True, "f")], "page_id string, candidate_ids array<string>, native_text_present boolean, fingerprint string")
    held = {r.page_id: r.candidate_ids for r in O.pages_with(records, every).collect()}
    assert held[page] == order and len(held[other]) == sum(r.pdf_page == 2 for r in known)
    assert C.evidence(late).select("origin_kind").distinct().first().origin_kind == "source_ocr"
    made = G.groups(G.records(every)).collect()
    assert sum(len(r.route_candidate_ids) for r in made) == len(known) + 2 and all(r.segments[0].origin_kinds in (["source"], ["source_ocr"]) for r in made)
    none = O.late_candidates(O.late_chunks(regions.limit(0), cands.select("page_id", F.col("chunk").alias("quote")), L.DOMAIN), cands)
    assert none.count() == 0 and O.with_late(cands, none).count() == len(known)


def test_crops_paths_and_reports(spark):
    regions = spark.createDataFrame([("s", "V1", 2, [0.0, 1.0, 2.0, 3.0], "r"), ("s", "V2", 3, [0.0, 0.0, 0.0, 0.0], "r"), ("t", "V3", 1, [0.0, 0.0, 1.0, 1.0], "r")], "source_id string, region_id string, pdf_page int, bbox array<double>, reason_code string")

    def render(content, page, box, scale):
        if not box[3]:
            raise ValueError("empty")
        return content + bytes([page, int(scale * 10)])

    crops = files.region_crops(spark.createDataFrame([("s", b"%PDF"), ("u", b"x")], "source_id string, content binary"), regions, render)
    got = {r.region_id: r for r in crops.collect()}
    assert (got["V1"].crop, got["V1"].crop_file, got["V1"].error) == (b"%PDF\x02\x12", "V1.png", None)
    assert (got["V2"].crop, got["V2"].crop_file, got["V2"].error) == (None, "", "empty") and got["V3"].error == "no file"
    manifest = {r.source_id: r for r in files.crop_manifest(crops).collect()}
    assert manifest["s"].region_count == 2 and '"crop_file":"V1.png"' in manifest["s"].regions
    rows = spark.createDataFrame([(1, "a/x.json", "run/m.json"), (2, "b/y.json", "run/m.json"), (3, "c/z.json", "m.json"), (4, None, "m.json")], "i int, path string, manifest string")
    found = files.resolved(rows, spark.createDataFrame([("a/x.json",), ("run/y.json",), ("run/x.json",), ("run/y.json",)], "path string"))
    assert {r.i: (r.resolved, r.found) for r in found.collect()} == {1: ("a/x.json", True), 2: ("run/y.json", True), 3: ("c/z.json", False), 4: (None, False)}
    summary = spark.createDataFrame([("s", 3, 2, 5, 0, 1), ("t", 1, 0, 0, 1, 0)], "source_id string, page_count long, candidate_page_count long, candidate_count long, unreadable_page_count long, visual_pending_page_count long")
    lines = Q.reports(summary, spark.createDataFrame([("t", 2, "second"), ("t", 1, "first"), ("u", 1, "PDF not found")], "source_id string, ord int, message string"))
    assert {r.source_id: (r.report, r.exit_code) for r in lines.collect()} == {"s": ("PASS: candidate pack created | pages=3 candidate_pages=2 candidates=5 unreadable=0 visual_pending=1", 0), "t": ("FAIL: first", 1), "u": ("FAIL: PDF not found", 1)}


def test_overview_and_dossier(spark):
    req = spark.createDataFrame([("R1", "智慧建築應整合", "a", "g2", 1), ("R2", "x", "a", "g1", 2), ("R3", "y", "b", "g", 3)], "requirement_id string, text string, system string, group string, ord int")
    ask = spark.createDataFrame([("a", 1, 2, "q1"), ("a", 2, 1, "q2"), ("a", 3, 2, "q3"), ("a", 4, 3, "q4")], "system string, ord int, priority int, question string")
    guide = spark.createDataFrame([("a", "plans")], "system string, deliverables string")
    got = {r.system: r for r in R.system_overview(req, ask, guide).collect()}
    a, b = got["a"], got["b"]
    assert (a.labels, a.related_terms, a.open_questions, a.open_items, a.priority, a.documents) == (["g2", "g1"], ["智慧建築"], ["q2", "q1", "q3"], 4, 1, "plans")
    assert (b.open_questions, b.open_items, b.priority, b.documents, b.related_terms) == ([], 0, None, "", []) and a.details.startswith("#sys-")
    cands = cut(flow(spark, ["停車場車道應設置攝影機。", "電話應設置。"])[3])
    sources = spark.createDataFrame([("s", "a.pdf", None, 2)], "source_id string, name string, sha256 string, page_count int")
    regions = spark.createDataFrame([("s", "pending"), ("s", "read")], "source_id string, status string")
    text = D.dossier(D.rendered_groups(G.candidate_view(cands)), sources, regions, spark.createDataFrame([("s", 9), ("s", 4)], "source_id string, pdf_page int")).first().text
    assert "- 來源文件：a.pdf\n- 來源 SHA-256：`unknown`\n- PDF 頁數：2\n" in text and "影像區：1\n- 無法可靠讀取頁：2\n- 視覺已覆核但未形成可用文字頁：4,9\n" in text
    assert text.startswith(f"# 全文來源閱讀包\n\n{D.DOSSIER_NOTICE}\n\n## 文件資訊\n\n- 卷宗版本：1.2\n") and text.endswith("\n---\n") and f"{D.DOSSIER_RULES[4]}\n\n---\n\n## EGRP-0001" in text


def test_regions(spark):
    def box(i, page, x0, y0, x1, y1, w=40, h=30):
        return ("s", page, i, {"x0": float(x0), "y0": float(y0), "x1": float(x1), "y1": float(y1)}, 600.0, 900.0, w, h)

    ddl = "source_id string, pdf_page int, image_id int, box struct<x0:double,y0:double,x1:double,y1:double>, page_width double, page_height double, pixel_width int, pixel_height int"
    images = spark.createDataFrame([box(1, 1, 100, 100, 200, 112), box(2, 1, 100, 125, 220, 140), box(3, 2, 100, 100, 150, 112), box(4, 3, 100, 100, 300, 112), box(5, 3, 100, 400, 300, 412), box(6, 4, 0, 0, 600, 900, 800, 900), box(7, 5, 100, 100, 300, 112)], ddl)
    native = spark.createDataFrame([("s", 5, {"x0": 90.0, "y0": 90.0, "x1": 310.0, "y1": 120.0})], "source_id string, pdf_page int, box struct<x0:double,y0:double,x1:double,y1:double>")
    got = {r.pdf_page: (r.bbox, r.image_count) for r in V.detect(images, native).collect()}
    assert got == {1: ([93.0, 93.0, 227.0, 147.0], 2), 3: ([93.0, 93.0, 307.0, 419.0], 2), 4: ([0.0, 70.0, 600.0, 835.0], 3)}  # page 2: too narrow; 5: native


MASTER = """# 案名 | 需求主檔
- 來源文件：a.pdf
- 來源 SHA-256：`ABC`
- 產出日期：2024

## 專案摘要
- 摘要一

## 需求樹
### 監視
- 系統摘要：一個夠長的系統摘要文字說明
- 系統設計重點：一個夠長的設計重點文字說明
- 主要圖說／文件：平面圖說
#### 攝影
- 主題說明：八個字以上的說明
- 主題設計重點：八個字以上的重點
- [REQ-M1-0001] 應設 攝影機
  - 空間：車道、門廳
  - 狀態：來源明示
  - 來源：PDF 3
  - 原文：應設攝影機
- [REQ-M1-0002] 應設攝影機
  - 狀態：奇怪
  - 原文：x
## 需要人工確認
- [REV-M1-0001] 問題
  - 影響：大
## 背景與排除紀錄
- [CTX-M1-0001] 背景
  - 理由：無關
"""


def test_master_is_parsed_and_validated(spark):
    docs = spark.createDataFrame([("m", MASTER), ("empty", "# x\n{{name}}")], "doc string, text string")
    t = R.parse_master(docs)
    req = [tuple(r)[2:] for r in t["requirements"].orderBy("ord").collect()]
    assert req[0] == ("REQ-M1-0001", "應設 攝影機", "監視", "攝影", "車道、門廳", "來源明示", "PDF 3", "應設攝影機")
    assert req[1] == ("REQ-M1-0002", "應設攝影機", "監視", "攝影", "", "奇怪", "", "x")
    p = {r.doc: r for r in t["project"].collect()}["m"]
    assert (p.project_name, p.source_file, p.source_sha256, p.generated_date) == ("案名", "a.pdf", "ABC", "2024")
    assert [r.text for r in t["summary"].collect()] == ["摘要一"] and t["context"].first().reason == "無關"
    assert t["topic_guidance"].first().summary == "八個字以上的說明"
    errors = {(r.doc, r.rule, r.key) for r in R.validate(t, docs).collect()}
    assert errors == {
        ("m", "missing space", "REQ-M1-0002"), ("m", "invalid status", "REQ-M1-0002"), ("m", "missing page source", "REQ-M1-0002"), ("m", "missing quote", "REQ-M1-0002"),
        ("m", "duplicate text", "REQ-M1-0002"), ("m", "incomplete review", "REV-M1-0001"), ("empty", "no requirements", ""), ("empty", "unresolved placeholders", ""),
    }
    with pytest.raises(ValueError, match="master validation failed"):
        X.assert_none(R.validate(t, docs), "master validation")


def test_filter_tokens(spark):
    df = spark.createDataFrame([("a", "應設 Camera", "監視", "g", "車道、門廳", "s"), ("b", "x", "門禁", "g", "門廳", "s")], "id string, text string, system string, group string, space string, status string")
    pick = lambda **k: [r.id for r in R.filtered(df, **k).collect()]
    assert pick(space="門廳") == ["a", "b"] and pick(space="車道") == ["a"] and pick(query="CAMERA") == ["a"] and pick(system="門禁", status="s") == ["b"] and pick() == ["a", "b"]


def test_gate_order(spark):
    text = "# 弱電來源包\n\n- 來源文件：a.pdf\n- 來源 SHA-256：`" + "a" * 64 + "`\n- 已閱讀批次：1 / 1\n\n<!-- screened:SB-001 -->\n"
    receipt = {"stage": "weak_current_source_complete", "source_name": "A.PDF", "source_sha256": "A" * 64, "pdf_page_count": 10, "extraction_batch_count": 1, "screening_batch_count": 1, "screened_batch_ids": ["SB-001"], "screened_evidence_group_count": 1}
    import hashlib

    receipt["package_sha256"] = hashlib.sha256(text.encode()).hexdigest()
    ddl = "k string, text string, master_file string, master_sha256 string, r struct<stage:string,source_name:string,source_sha256:string,pdf_page_count:int,extraction_batch_count:int,screening_batch_count:int,screened_batch_ids:array<string>,screened_evidence_group_count:int,package_sha256:string>"

    def case(k, text=text, file="x/a.pdf", sha="a" * 64, **change):
        return (k, text, file, sha, None if change.get("none") else receipt | change)

    cases = [case("good"), case("no text", None), case("header", "x"), case("open", text.replace("1 / 1", "0 / 1")), case("count", text + "<!-- screened:SB-002 -->"), case("file", file="b.pdf"), case("receipt", none=True), case("stage", stage="x"), case("tampered", text + "more"), case("pages", pdf_page_count=194), case("groups", screened_evidence_group_count=0)]
    got = {r.k: r.rule for r in X.gate_errors(spark.createDataFrame(cases, ddl), ["k"]).collect()}
    assert got == {"no text": "source package missing", "header": "header missing", "open": "not every batch was screened", "count": "marker count", "file": "master file mismatch", "receipt": "receipt missing", "stage": "receipt not complete", "tampered": "package hash mismatch", "pages": "implausible extraction batches", "groups": "no evidence groups"}


def test_screening_markers(spark):
    batches = spark.createDataFrame([("s", "SB-001", [2, 1], ["E1", "E2"])], "source_id string, batch_id string, pdf_pages array<int>, evidence_group_ids array<string>")

    def rule(pages, groups, marks=1):
        text = "<!-- screened:SB-001 -->\n" * marks + f"<!-- reviewed-pages:{pages} -->\n<!-- reviewed-groups:{groups} -->"
        found = X.screening_errors(batches, spark.createDataFrame([("s", "SB-001", text)], "source_id string, batch_id string, text string"), ["source_id", "batch_id"]).collect()
        return found[0].rule if found else None

    assert rule("2, 1", "E1,E2") is None and rule("1,2,2", "E1,E2") == "reviewed page marker mismatch"
    assert rule("1,2", "E2,E1") == "reviewed group marker mismatch" and rule("1,2", "E1,E2", 2) == "marker missing or duplicated"


def test_rendering(spark):
    _, _, _, cands = flow(spark, ["停車場車道應設置攝影機。\n1、監視系統資料", "電話應設置。"])
    text = D.rendered_groups(G.candidate_view(cands)).orderBy("group_no").first().markdown
    assert text.startswith("## EGRP-0001 | PDF 1 | ") and "> 停車場車道應設置攝影機。" in text and "- 來源空間提示：停車空間" in text and D.POINTER in text
    html = spark.createDataFrame([(f"<p>{D.START}old{D.END}</p>", '{"a":"</script>"}')], "t string, p string").select(D.inject(F.col("t"), F.col("p")).alias("h")).first().h
    assert html == f'<p>{D.START}{{"a":"<\\/script>"}}{D.END}</p>'
    with pytest.raises(Exception, match="markers are missing"):
        spark.createDataFrame([("<p></p>", "{}")], "t string, p string").select(D.inject(F.col("t"), F.col("p"))).collect()


def test_files(spark, tmp_path):
    for name, data in (("a.pdf", b"%PDF-1 x"), ("b.pdf", b"%PDF-1 x"), ("c.pdf", b"no"), ("d.pdf", b"%PDF-2 y")):
        (tmp_path / name).write_bytes(data)
    up = files.uploads(spark, str(tmp_path)).collect()
    assert sorted(r.name for r in up) == ["a.pdf", "d.pdf"]

    def broken(content):
        raise RuntimeError("broken")

    def plain(content):
        if content.endswith(b"y"):
            raise RuntimeError("no text")
        yield 1, 1, content.decode(), 0.0, 0.0, 1.0, 1.0

    got = {(r.block, r.engine, r.error) for r in files.extracted(files.uploads(spark, str(tmp_path)), [("one", broken), ("two", plain)]).collect()}
    assert got == {("%PDF-1 x", "two", None), (None, None, "one=broken; two=no text")}
    out = spark.createDataFrame([("s1", "line\nline"), ("s2", "x")], "source_id string, text string")
    files.write_texts(out, "source_id", str(tmp_path / "out"))
    assert {r.value for r in spark.read.text(str(tmp_path / "out"), wholetext=True).collect()} == {"line\nline\n", "x\n"}
    files.write_table(out.withColumn("a", F.array("text")), str(tmp_path / "csv"), "csv")
    assert spark.read.csv(str(tmp_path / "csv"), header=True, multiLine=True, escape='"').count() >= 2


def test_lexicon_is_a_parameter(spark):
    own = L.Lexicon(systems={"x": ["foo"]}, capabilities={}, spaces={}, semantic=[], obligations=["must"], guarded={}, interfaces=[], headings=[], plain_headings=["head"], negations=[], conditions=[], generic=[])
    pages = pages_of(spark, ["head line\nfoo must be"])
    blocks = S.blocks(pages)
    rows = C.candidates(C.enriched(K.chunks(blocks, own), C.context_headings(blocks, own), None, own)).collect()
    assert [(r.system_hints, r.obligation_terms, r.heading) for r in rows] == [([], [], "head line"), (["x"], ["must"], "head line")]
