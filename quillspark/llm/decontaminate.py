"""Benchmark decontamination: rare n-gram seeds join training passages to test items, then Smith-Waterman alignment of
words scores the passages, so that paraphrased or edited copies count too.

1. Document frequencies of the items' n-grams, over all documents.
2. Seeds: all n-grams of an item, since an edited copy that reaches the score may have kept any single one of them.
   Those in at most `rare` of the documents lead to the item at once; of an item that a document meets by common ones
   alone, the words that the two share must first be enough to reach the score. So `rare` changes no result.
3. Each document's seed hits are gathered by item and diagonal into windows; a window is aligned when the words that it
   shares with the item could reach the score at all, and what stands before and after a passage is aligned again, so
   that all passages of an item are found.
4. An item of fewer words than an n-gram is matched as a whole sequence, by texts that are it and nothing else.

Both passes are maps over the documents; what is shuffled is one count per n-gram and task. Items travel by broadcast in
slices of bounded size: more items mean more slices, each a pass of its own.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import grams, read, restored, small_batches, word_hashes

#: Bytes of item texts in a slice.
SLICE = 8 << 20
MATCH, MISMATCH, GAP = 2, -1, -1
#: A passage of this many matching words counts however long its item is.
LONG = 40


def align(item: np.ndarray, window: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment of two sequences of words: score, and where it begins and ends (exclusive) in window."""

    def best(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
        steps = np.arange(1, len(b) + 1) * -GAP
        row, top, end = np.zeros(len(b) + 1, np.int64), 0, 0
        for x in a:
            cells = np.maximum(row[:-1] + np.where(b == x, MATCH, MISMATCH), np.maximum(row[1:] + GAP, 0))
            row[1:] = np.maximum.accumulate(cells + steps) - steps  # gaps along the window
            at = int(row.argmax())
            if row[at] > top:
                top, end = int(row[at]), at
        return top, end

    score, end = best(item, window)
    if not score:
        return 0, 0, 0
    _, back = best(item[::-1], window[:end][::-1])
    return score, end - back, end


class Items:
    """A slice of test items and, once frequencies are known, its seeds."""

    def __init__(self, rows: list[tuple], n: int):
        own = [(i, word_hashes(t)) for i, t in rows]
        own = [(i, h) for i, h in own if len(h)]
        self.n, self.ids, self.words = n, [i for i, _ in own], [h for _, h in own]
        self.short: dict[bytes, list[int]] = {}
        for k, h in enumerate(self.words):
            if len(h) < n:
                self.short.setdefault(h.tobytes(), []).append(k)
        self.grams = [grams(h, n) for h in self.words]
        self.all = np.unique(np.concatenate([np.empty(0, np.uint64), *self.grams]))

    def choose(self, counts: dict[int, int], limit: float) -> None:
        found: list[tuple[int, int, int]] = []
        for k, own in enumerate(self.grams):
            df = np.array([counts.get(int(g.view(np.int64)), 0) for g in own])
            found += [(int(g), k, p, d <= limit) for p, (g, d) in enumerate(zip(own.tolist(), df.tolist(), strict=True))]
        found.sort()
        keys = np.array([x[0] for x in found], np.uint64)
        self.seeds, first = np.unique(keys, return_index=True)
        self.first = np.append(first, len(keys))
        self.item_of, self.place_of = (np.array([x[i] for x in found], np.int64) for i in (1, 2))
        self.rare = np.array([x[3] for x in found], bool)[first] if found else np.empty(0, bool)


def _at(table: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where wanted is in table: places in wanted, places in table."""
    if not len(table) or not len(wanted):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.minimum(np.searchsorted(table, wanted), len(table) - 1)
    hit = np.flatnonzero(table[at] == wanted)
    return hit, at[hit]


def _aligned(item: np.ndarray, h: np.ndarray, low: int, high: int, need: float) -> list[tuple[int, int, int]]:
    """All passages between two places: the best, then the best before and after it, and so on."""
    found, parts = [], [(low, high)]
    while parts:
        low, high = parts.pop()
        window = h[low:high]
        if MATCH * int(np.isin(window, item).sum()) < need:
            continue
        score, a, b = align(item, window)
        if score >= need:
            found.append((score, low + a, low + b))
            parts += [(low, low + a), (low + b, high)]
    return found


def passages(text: str | None, items: Items, share: float) -> list[tuple[int, int, float, int, int]]:
    """Each passage of an item in text: the item's place, score, similarity, and the first and last word (exclusive)."""
    h = word_hashes(text)
    out = [(k, MATCH * len(h), 1.0, 0, len(h)) for k in items.short.get(h.tobytes(), ())] if len(h) < items.n else []
    hits, seeds = _at(items.seeds, grams(h, items.n))
    diagonals: dict[int, list[int]] = {}
    sure: set[int] = set()  # items met by a rare seed
    for p, s in zip(hits.tolist(), seeds.tolist(), strict=True):
        for j in range(items.first[s], items.first[s + 1]):
            diagonals.setdefault(int(items.item_of[j]), []).append(p - int(items.place_of[j]))
            if items.rare[s]:
                sure.add(int(items.item_of[j]))
    for k, ds in sorted(diagonals.items()):
        item = items.words[k]
        m = len(item)
        need, pad = min(share * m, LONG) * MATCH, m // 4 + 2
        if k not in sure and MATCH * int(np.isin(item, h).sum()) < need:
            continue
        found: list[tuple[int, int, int]] = []
        ds, done = sorted(set(ds)), 0
        start = last = ds[0]
        for d in [*ds[1:], None]:
            if d is not None and d - last <= pad:
                last = d
                continue
            found += _aligned(item, h, max(done, start - pad), max(done, last + m + pad), need)
            done = max([done, *(b for _, _, b in found)])
            start = last = d
        out += [(k, score, score / (MATCH * m), a, b) for score, a, b in sorted(found, key=lambda x: x[1])]
    return out


def _frequencies(docs: DataFrame, items: Items) -> dict[int, int]:
    """Documents that hold each n-gram of the items; at most as many rows as the slice has n-grams."""
    shared = docs.sparkSession.sparkContext.broadcast((items.all, items.n))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, n = shared.value
        counts = np.zeros(len(table), np.int64)
        for batch in batches:
            for x in batch.column(0):
                _, at = _at(table, grams(word_hashes(x.as_py()), n))
                if len(at):
                    counts[np.unique(at)] += 1
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(table[some].view(np.int64)), pa.array(counts[some])], ["gram", "c"])

    found = docs.select("text").mapInArrow(work, "gram long, c long").groupBy("gram").agg(F.sum("c").alias("c"))
    return {r["gram"]: r["c"] for r in found.collect()}


def _slices(df: DataFrame, text: Column, benchmark: DataFrame, item_id: str, item_text: str, n: int, rare: float) -> Iterator[Broadcast]:
    """The items, slice by slice, with their seeds, as broadcasts."""
    spark = small_batches(df).sparkSession
    docs = df.select(text.alias("text"))
    bench = benchmark.select(F.col(item_id).alias("item"), F.col(item_text).alias("text"))
    size = bench.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    slices = -(-size // SLICE) or 1
    limit = max(5.0, rare * docs.count())
    for s in range(slices):
        part = bench.where(F.pmod(F.xxhash64("item", "text"), F.lit(slices)) == s) if slices > 1 else bench
        items = Items([tuple(r) for r in part.collect()], n)
        items.choose(_frequencies(docs, items), limit)
        items.grams, items.all = [], np.empty(0)
        yield spark.sparkContext.broadcast(vars(items))


def find_leaks(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", n: int = 3, rare: float = 0.0005, share: float = 0.5) -> DataFrame:
    """A row for each passage of an item in a row of df: id, item id, score, similarity, first and last word (exclusive).

    A passage counts when its alignment reaches `share` of the score of the whole item, or LONG matching words, and
    when it has n words of the item in a row; passages of one item don't overlap. An item of fewer than n words is found
    in texts that are that sequence of words; one without words in none. Null and empty texts have no passages.
    Equal rows, and rows with equal or null ids, each give their rows; equal items each give theirs. Of equal alignments
    the first counts. Other columns are not looked at.
    """
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind, item_kind = docs.schema["id"].dataType.simpleString(), benchmark.schema[item_id].dataType.simpleString()
    item_type = _arrow(benchmark.schema[item_id].dataType)

    def one_slice(shared: Broadcast) -> DataFrame:
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = restored(Items, shared.value)
            for batch in batches:
                rows, found = [], []
                for i, x in enumerate(batch.column(1)):
                    here = passages(x.as_py(), items, share)
                    rows += [i] * len(here)
                    found += here
                k, score, similarity, a, b = zip(*found, strict=True) if found else ((),) * 5
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(rows, pa.int64())), pa.array([items.ids[x] for x in k], item_type), pa.array(score, pa.int64()),
                    pa.array(similarity, pa.float64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()),
                ], ["id", "item", "score", "similarity", "first_word", "last_word"])

        return docs.mapInArrow(work, f"id {kind}, item {item_kind}, score long, similarity double, first_word long, last_word long")

    found = [one_slice(x) for x in _slices(df, F.col(text_col), benchmark, item_id, item_text, n, rare)]
    return functools.reduce(DataFrame.unionByName, found).withColumnsRenamed({"id": id_col, "item": item_id})


def _arrow(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def drop_leaks(df: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", n: int = 3, rare: float = 0.0005, share: float = 0.5) -> DataFrame:
    """The rows of df without a passage of any item. Rows are judged one by one: ids, null or repeated, play no part."""
    place, out = df.columns.index(text_col), df

    def without(out: DataFrame, shared: Broadcast) -> DataFrame:
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = restored(Items, shared.value)
            for batch in batches:
                yield batch.filter(pa.array([not passages(x.as_py(), items, share) for x in batch.column(place)], pa.bool_()))

        return out.mapInArrow(work, df.schema)

    for shared in _slices(df, F.col(text_col), benchmark, item_id, item_text, n, rare):
        out = without(out, shared)
    return out


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
