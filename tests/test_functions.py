"""Scalars, geometry and lexicons on hand-made values."""

import unicodedata

import pytest
from pyspark.sql import functions as F

from quillspark.functions import geometry as G
from quillspark.functions import lexicon as L
from quillspark.functions import text as T


def value(spark, column, **cells):
    """The value of an expression over one row."""
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in cells.items()]) if cells else spark.range(1)
    return df.select(column.alias("v")).first()["v"]


def s(spark, make, text):
    return value(spark, make(F.col("t")), t=text)


@pytest.mark.parametrize(("text", "want"), [("a 　 b\t\tc", "a b c"), ("x\n\n\n\ny ", "x\n\ny"), ("", ""), (" 　 ", "")])
def test_clean_text(spark, text, want):
    assert s(spark, T.clean_text, text) == want


@pytest.mark.parametrize("text", ["Wi-Fi 弱電／ＡＢ", "I/O 點 — a_b.c\\d", "ABC　x", "É ö ﬁ"])
def test_keys_agree_with_literals(spark, text):
    normal = unicodedata.normalize("NFKC", text)
    assert s(spark, T.semantic_key, normal) == T.key_of(text)
    assert s(spark, lambda c: T.semantic_key(T.nfkc(c)), text) == T.key_of(text)


def test_navigation(spark):
    toc = "第一章 ........ 3\n第二章 ........ 9\n備註"
    for text, want in (("", True), ("12 - 13/4", True), (toc, True), ("一行 ........ 3", False), ("正常文字", False), ("a\nb", False)):
        assert s(spark, T.is_navigation, text) is want, text


def test_recognised_spacing_and_use(spark):
    assert s(spark, T.ocr_spacing, "弱 電 系 統 ， 應 設 （ 一 ） a b") == "弱電系統， 應設 （一） a b"
    for text, images, want in (("ab1", 0, False), ("ab12", 0, True), ("ab12", 3, False), ("....", 0, False), ("弱電系統", 2, True)):
        assert value(spark, T.ocr_usable(F.col("t"), F.col("n")), t=text, n=images) is want


def test_printed_page(spark):
    assert s(spark, T.printed_page, "Title\n 20 \nbody") == 20
    assert s(spark, T.printed_page, "page 20 here\n1234") is None
    assert s(spark, T.printed_page, "\n".join("abcdefgh") + "\n7") is None


def test_codes_and_pages(spark):
    assert s(spark, T.latin_codes, "use RS-485 and CAT6A, IP67 PBX x") == ["RS-485", "CAT6A", "IP67", "PBX"]
    assert s(spark, T.pdf_pages, "PDF 3, pdf12 and PDF  7") == [3, 12, 7]


def test_slug_and_escape(spark):
    assert s(spark, T.slug, "ab") == f"sys-{(1 * 97 + 2 * 98) % 1000003:06d}"
    assert s(spark, T.slug, "弱電") == f"sys-{(ord('弱') + 2 * ord('電')) % 1000003:06d}"
    assert s(spark, T.html_escape, "<a href=\"x\">&'") == "&lt;a href=&quot;x&quot;&gt;&amp;&#x27;"


def test_diagnostics(spark):
    cases = [("MemoryError", "", None, None, "E_MEMORY"), ("OSError", "x", 5, None, "E_PERMISSION"), ("ModuleNotFoundError", "no", None, None, "E_DEPENDENCY_MISSING"), ("OSError", "load c10.dll", 126, None, "E_TORCH_RUNTIME"), ("OSError", "x", 193, None, "E_ARCH"), ("OSError", "filename or extension is too long", None, None, "E_PATH_TOO_LONG"), ("OSError", "x", None, 28, "E_DISK_SPACE"), ("URLError", "SSL failed", None, None, "E_NETWORK"), ("ValueError", "Invalid PDF", None, None, "E_PDF_INVALID"), ("ValueError", "odd", None, None, "E_RUNTIME")]
    df = spark.createDataFrame(cases, "k string, m string, w int, e int, want string")
    got = df.select("want", T.diagnostic_code(F.col("k"), F.col("m"), F.col("w"), F.col("e")).alias("code")).collect()
    assert all(r.want == r.code for r in got)
    fatal = df.select("want", T.is_fatal(F.col("want")).alias("f")).collect()
    assert {r.want for r in fatal if not r.f} == {"E_PDF_INVALID", "E_RUNTIME"}
    line = value(spark, T.diagnostic_line(F.lit("E_X"), F.lit("a|b\nc"), F.lit("d")))
    assert line == "DOC_ERR|E_X|a/b c|d"
    assert s(spark, T.parse_diagnostic, line).asDict() == {"code": "E_X", "message": "a/b c", "action": "d"}
    assert s(spark, T.parse_diagnostic, "ERR|a|b|c") is None


def test_obligations(spark):
    def terms(text):
        return value(spark, L.obligations(F.col("t"), T.semantic_key(F.col("t"))), t=text)

    assert terms("本案需求說明") == [] and terms("需設置") == ["需", "設置"]
    assert terms("對應之應用") == [] and terms("承商應提供") == ["應", "提供"]
    assert terms("必須不得") == ["須", "必須", "不得"]


def test_categories_and_terms(spark):
    key = T.semantic_key(F.col("t"))
    assert value(spark, L.categories(key, L.DOMAIN.systems), t="車道 Wi-Fi 與 CCTV") == ["資訊網路系統", "監視系統", "停車管理系統"]
    assert value(spark, L.system_terms(key), t="車道 Wi-Fi 與 CCTV") == ["wifi", "wi-fi", "cctv", "車道"]
    assert value(spark, T.term_present("sip", F.col("t"), key), t="gossip SIP2") is False
    assert value(spark, T.term_present("sip", F.col("t"), key), t="use SIP.") is True


def test_table_match_equals_literals(spark):
    rows = spark.createDataFrame([(1, "車道與電話"), (2, "無"), (3, "pbx")], "i int, t string").withColumn("k", T.semantic_key(F.col("t")))
    table = L.lexicon_rows(spark, L.DOMAIN.systems).select("category", "category_ord", "term_key")
    got = {r.i: r.categories for r in L.match_table(rows, "k", table, ["i"]).collect()}
    want = {r.i: r.c for r in rows.select("i", L.categories(F.col("k"), L.DOMAIN.systems).alias("c")).collect()}
    assert got == want


def test_rectangles(spark):
    r = lambda *x: G.rect(*[F.lit(float(v)) for v in x])
    assert value(spark, G.area(r(0, 0, 4, 5))) == 20 and value(spark, G.area(r(4, 0, 0, 5))) == 0
    assert value(spark, G.overlap_ratio(r(0, 0, 10, 10), r(5, 0, 20, 10))) == 0.5
    assert value(spark, G.overlap_ratio(r(0, 0, 0, 0), r(0, 0, 1, 1))) == 0
    assert tuple(value(spark, G.expand(r(3, 3, 95, 50), F.lit(100.0), F.lit(60.0)))) == (0, 0, 100, 57)
    for box, want in (((10, 100, 60, 112), True), ((10, 60, 60, 72), False), ((10, 100, 60, 130), False), ((10, 840, 60, 852), False)):
        assert value(spark, G.text_like(r(*box), F.lit(900.0), F.lit(40), F.lit(20))) is want
