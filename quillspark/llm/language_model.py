"""Language-model scores by stupid backoff, computed relationally: n-gram count tables partitioned by hash, joined to
the exploded n-grams of the texts, and summed by document.

1. Rows become batches of bounded bytes, in their order, compressed; a batch is named by its contents, so that no other
   can take its place when a lost task repeats.
2. Each batch explodes its texts to n-grams of 1 to `order` words and sends the distinct ones with their counts to the
   hash ranges of the count tables (counting.totals), which return the corpus counts.
3. The batch's n-grams meet their counts, and the scores of a document's words are summed.

A document is scored by the corpus without itself: its own n-grams are taken off the counts, so that a text of its own
backs off and a text that stands elsewhere too does not. With such counts c and N words, a word w after the words h
scores c(h w) / c(h) if c(h w) is at least `least`, else BACKOFF times its score after the shorter h; without h,
c(w) / N, and an unseen word UNSEEN / N.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import grams, read, small_batches, text_bytes, word_hashes
from .counting import BLOBS, batch_bytes, emit, in_order, n_buckets, n_ranges, totals

BACKOFF, UNSEEN = 0.4, 0.5
#: The item whose count is N; it precedes all hashes.
ALL = np.zeros(1, np.uint64)


def in_batches(rows: DataFrame, size: int, n: int) -> DataFrame:
    """rows (id, text) as batches, dealt to n partitions: batch, and data, the rows of about `size` bytes of text as
    compressed Arrow."""

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=6))
        part_id, n, held, kept = TaskContext.get().partitionId(), 0, 0, []

        def batch() -> pa.RecordBatch:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, kept[0].schema, options=options) as out:
                out.write_table(pa.Table.from_batches(kept).combine_chunks())
            data = sink.getvalue().to_pybytes()
            name = hashlib.blake2b(data, digest_size=8, salt=struct.pack("<QQ", part_id, n)).digest()
            return pa.RecordBatch.from_arrays([pa.array([int.from_bytes(name, "little", signed=True)]), pa.array([data], pa.binary())], ["batch", "data"])

        for part in parts:
            if not part.num_rows:
                continue
            sizes = pa.compute.fill_null(pa.compute.binary_length(part.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends, at = held + np.cumsum(sizes), 0
            while at < len(ends):
                stop = min(len(ends), int(np.searchsorted(ends, size)) + 1)
                kept.append(part.slice(at, stop - at))
                held, at = int(ends[stop - 1]), stop
                if held >= size:
                    yield batch()
                    ends, held, kept, n = ends - held, 0, [], n + 1
        if kept:
            yield batch()

    return rows.mapInArrow(work, "batch long, data binary").repartition(n, "batch")


def _texts(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def _exploded(table: pa.Table, order: int) -> tuple[list[int], np.ndarray]:
    """Words of each text, and all n-grams: text by text, by length, in order."""
    sizes, every = [], [np.empty(0, np.uint64)]
    for x in table.column(1):
        h = word_hashes(x.as_py())
        sizes.append(len(h))
        every += [grams(h, k) for k in range(1, order + 1)]
    return sizes, np.concatenate(every)


def _scores(own: np.ndarray, n: int, seen: int, order: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores of a text's n words and steps of backoff, by the counts of its n-grams, in a corpus of `seen` words."""
    counts, at = [], 0
    for k in range(order):
        counts.append(own[at : at + max(0, n - k)].astype(np.float64))
        at += max(0, n - k)
    score = np.log10(np.maximum(counts[0], UNSEEN)) - np.log10(max(1, seen))
    steps = np.zeros(n, np.int64)
    for k in range(1, min(order, n)):
        full = counts[k] >= least
        found = np.log10(np.maximum(counts[k], 1)) - np.log10(np.maximum(counts[k - 1][:-1], 1))
        steps[k:] = np.where(full, 0, steps[k:] + 1)
        score[k:] = np.where(full, found, np.log10(BACKOFF) + score[k:])
    return score, steps


def score_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = 3, least: int = 1, leave_out: bool = True) -> DataFrame:
    """For each row its id, n_words, n_backoffs (words scored by a shorter n-gram than their place allows) and log10 score.

    The corpus is all rows of df, copies too; with leave_out, all but the row itself. A null or empty text has 0 words
    and score 0. Rows with null or equal ids each count and give a row. Texts of any length are one piece; only the two
    columns are looked at. df should give the same partitions again when it is read again, as files do; if not, and an
    executor is lost, the job fails and has to be run again on a written table.
    """
    rows = small_batches(df).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    total = text_bytes(rows)
    size = batch_bytes(total)
    batches, buckets = -(-total // size) or 1, n_buckets(total / 6 * order)
    table, ranges = in_batches(rows, size, batches), n_ranges(batches, buckets)

    def send(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for batch, data in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                sizes, every = _exploded(_texts(data.as_py()), order)
                found, counts = np.unique(every, return_counts=True)
                yield from emit(batch, np.concatenate([ALL, found]), np.concatenate([[sum(sizes)], counts]), ranges).to_batches()

    def end(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            raise RuntimeError("a repeated task had other batches: write the table before it is scored")
        rows = _texts(left.column("data")[0].as_py())
        sizes, every = _exploded(rows, order)
        _, place, own = np.unique(every, return_inverse=True, return_counts=True)
        sums = in_order(right) + np.concatenate([[sum(sizes)], own])
        seen, sums = int(sums[0]), sums[1:]
        backoffs, scores, at = [], [], 0
        for n in sizes:
            held = sum(max(0, n - k) for k in range(order))
            _, inside, own = np.unique(place[at : at + held], return_inverse=True, return_counts=True)
            counts = sums[place[at : at + held]] - (own[inside] if leave_out else 0)
            score, steps = _scores(counts, n, seen - n * leave_out, order, least) if n else (np.zeros(0), np.zeros(0))
            at += held
            backoffs.append(int((steps > 0).sum()))
            scores.append(float(score.sum()))
        return pa.table({"id": rows.column(0), "n_words": pa.array(sizes, pa.int64()), "n_backoffs": pa.array(backoffs, pa.int64()), "score": pa.array(scores, pa.float64())})

    sums = totals(table.mapInArrow(send, BLOBS), batches, buckets)
    kind = rows.schema["id"].dataType.simpleString()
    found = table.groupBy("batch").cogroup(sums.groupBy("batch")).applyInArrow(end, f"id {kind}, n_words long, n_backoffs long, score double")
    return found.withColumnRenamed("id", id_col)


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_documents(read(spark, sf_dir, "documents"))
    return scored.select("doc_id", "n_words", "n_backoffs", F.round("score", 3).alias("score"), F.round(F.col("score") / F.greatest("n_words", F.lit(1)), 6).alias("mean_score"))


OP5_SQL = r"""
WITH docs AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
w AS (SELECT doc_id, unnest(ws) AS c, generate_subscripts(ws, 1) AS i FROM docs),
p AS (SELECT doc_id, i, c, lag(c) OVER d AS b, lag(c, 2) OVER d AS a FROM w WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
c1 AS (SELECT c, count(*) AS n FROM p GROUP BY c), o1 AS (SELECT doc_id, c, count(*) AS n FROM p GROUP BY doc_id, c),
c2 AS (SELECT b, c, count(*) AS n FROM p WHERE b IS NOT NULL GROUP BY b, c), o2 AS (SELECT doc_id, b, c, count(*) AS n FROM p WHERE b IS NOT NULL GROUP BY doc_id, b, c),
c3 AS (SELECT a, b, c, count(*) AS n FROM p WHERE a IS NOT NULL GROUP BY a, b, c), o3 AS (SELECT doc_id, a, b, c, count(*) AS n FROM p WHERE a IS NOT NULL GROUP BY doc_id, a, b, c),
u1 AS (SELECT doc_id, c, c1.n - o1.n AS n FROM o1 JOIN c1 USING (c)), u2 AS (SELECT doc_id, b, c, c2.n - o2.n AS n FROM o2 JOIN c2 USING (b, c)), u3 AS (SELECT doc_id, a, b, c, c3.n - o3.n AS n FROM o3 JOIN c3 USING (a, b, c)),
t AS (SELECT count(*) AS n FROM p),
g AS (SELECT p.doc_id, log10(greatest(u.n, 0.5)) - log10(greatest(t.n - len(docs.ws), 1)) AS s1, p.b IS NOT NULL AS has2, p.a IS NOT NULL AS has3, h2.n AS n2, h3.n AS n3, v1.n AS m1, v2.n AS m2
      FROM p CROSS JOIN t JOIN docs USING (doc_id) JOIN u1 u ON u.doc_id = p.doc_id AND u.c = p.c
      LEFT JOIN u2 h2 ON h2.doc_id = p.doc_id AND h2.b = p.b AND h2.c = p.c LEFT JOIN u3 h3 ON h3.doc_id = p.doc_id AND h3.a = p.a AND h3.b = p.b AND h3.c = p.c
      LEFT JOIN u1 v1 ON v1.doc_id = p.doc_id AND v1.c = p.b LEFT JOIN u2 v2 ON v2.doc_id = p.doc_id AND v2.b = p.a AND v2.c = p.b),
k AS (SELECT doc_id, CASE WHEN NOT has2 THEN s1 WHEN n3 >= 1 THEN log10(n3) - log10(m2) WHEN n2 >= 1 THEN CASE WHEN has3 THEN log10(0.4) ELSE 0 END + log10(n2) - log10(m1)
      ELSE CASE WHEN has3 THEN 2 ELSE 1 END * log10(0.4) + s1 END AS s, CASE WHEN has3 AND n3 < 1 OR has2 AND NOT has3 AND n2 < 1 THEN 1 ELSE 0 END AS k FROM g)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, CAST(coalesce(t.k, 0) AS BIGINT) AS n_backoffs, round(coalesce(t.s, 0.0), 3) AS score, round(coalesce(t.s, 0.0) / greatest(len(d.ws), 1), 6) AS mean_score
FROM docs d LEFT JOIN (SELECT doc_id, sum(s) AS s, sum(k) AS k FROM k GROUP BY doc_id) t ON t.doc_id = d.doc_id
"""
