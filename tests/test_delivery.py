"""The delivery chain: outputs that agree, faults that stop a document, archives, and texts in compatibility forms."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from quillspark.operators import batches as B
from quillspark.plans import delivery as Y
from quillspark.plans import registry
from quillspark.plans.flows import Flow
from quillspark.sources import documents as D

SF = "/root/testdata/sf0.001"


def test_outputs_agree_and_pack(spark):
    outputs, errors = registry._delivered(Flow(spark, SF))
    docs = {}
    for r in outputs.collect():
        docs.setdefault(r.doc, {})[r.output] = r.text
    assert set(docs) == {"AFRICA", "AMERICA"} and all(set(x) == {Y.PAGE, Y.OUTLINE, Y.HANDOFF} for x in docs.values())
    assert {r.doc for r in errors.collect()} == {"ASIA", "EUROPE", "MIDDLE EAST"}
    required = {(r.doc, r.text) for r in registry.R.parse_master(registry._masters(Flow(spark, SF)))["requirements"].collect()}
    for doc, texts in docs.items():
        own = [t for d, t in required if d == doc]
        assert own and all(t in text for t in own for text in texts.values())
        assert "{{" not in texts[Y.PAGE] and "PDF 20 頁" in texts[Y.HANDOFF]
    for r in Y.archives(outputs).collect():
        with zipfile.ZipFile(io.BytesIO(r.archive)) as z:
            assert {n: z.read(n).decode() for n in z.namelist()} == docs[r.doc]


def test_markers_that_are_left_are_an_error(spark):
    df = spark.createDataFrame([("a {{NAME}} {{OTHER}}",)], "t string")
    assert df.select(Y.filled(F.col("t"), {"NAME": F.lit("x"), "OTHER": F.lit("y")}).alias("t")).first().t == "a x y"
    with pytest.raises(Exception, match="template markers are left: .*OTHER"):
        df.select(Y.filled(F.col("t"), {"NAME": F.lit("x")})).collect()


def test_missing_batches_and_documents(spark):
    batches = spark.createDataFrame([("s", "B01", 1, 25), ("s", "B02", 26, 30), ("t", "B01", 1, 5)], "source_id string, batch_id string, page_start int, page_end int")
    texts = spark.createDataFrame([("s", "B01", "x EV-1"), ("t", "B01", "head\n## EG-1 CAND-2\nend")], "source_id string, batch_id string, text string")
    sources = spark.createDataFrame([("s", "s.pdf", "h", 30), ("t", "t.pdf", "i", 5)], "source_id string, name string, sha256 string, page_count int")
    whole, missing = Y.merged_dossiers(batches, texts, sources)
    assert [tuple(r) for r in missing.collect()] == [("s", "B02")]
    (r,) = whole.collect()
    assert r.source_id == "t" and r.text.endswith("# B01 | PDF 1-5\n\n## B01-EG-1 B01-CAND-2\nend\n")


def test_batches_go_from_state_to_state(spark):
    batches = spark.createDataFrame([("s", "B03", 11, 15, "pending"), ("s", "B04", 16, 16, "pending"), ("s", "B05", 17, 18, "complete"), ("s", "B06", 19, 20, "pending")], "source_id string, batch_id string, page_start int, page_end int, status string")
    outcomes = lambda *rows: spark.createDataFrame([("s", *r) for r in rows], "source_id string, batch_id string, ok boolean")
    one = B.advanced(batches, outcomes(("B03", False), ("B04", False), ("B05", False)))
    assert sorted(tuple(r)[1:] for r in one.collect()) == [("B03A", 11, 13, "pending"), ("B03B", 14, 15, "pending"), ("B04", 16, 16, "terminal"), ("B05", 17, 18, "complete"), ("B06", 19, 20, "pending")]
    two = B.advanced(one, outcomes(("B03A", True), ("B03B", False)))
    assert sorted(tuple(r)[1:] for r in two.collect())[:3] == [("B03A", 11, 13, "complete"), ("B03BA", 14, 14, "pending"), ("B03BB", 15, 15, "pending")]


def test_full_width_texts_score_as_others(spark):
    from quillspark.functions import lexicon as L
    from quillspark.functions import text as T

    df = spark.createDataFrame([(1, "ＣＣＴＶ監視系統應設置", "a"), (2, "CCTV監視系統應設置", "a"), (3, None, "a")], "doc_id long, text string, source string")
    blocks = D.blocks(D.pages(D.normalised(df)))
    hits = [r.h for r in blocks.select(L.system_terms(T.semantic_key(F.col("block"))).alias("h")).collect()]
    assert len(hits) == 2 and hits[0] == hits[1] and "cctv" in hits[0]
