"""N-gram Jaccard join by a prefix tree.

1. Copies: one row per distinct text goes on. Map tasks drop the copies that they meet, and what is left of a text's
   copies is streamed through a sorted aggregate, so that no task holds them.
2. Each set of n-grams is put in one global order, rare n-grams first, by counts over all distinct texts
   (counting.totals). N-grams of one text alone can link nothing; they are counted, not stored. A text whose rare
   n-grams already rule out the threshold has no link and leaves here - most texts do.
3. Two sets that link share an n-gram of their prefixes (the first |x| - ceil(t |x|) + 1 in the order). Sets that share
   one, directly or through others, form a block; a set is in one block, so it is shipped once.
4. Each block's sets are stored in a compressed trie. Each set walks the trie, shares the partial overlap of common
   paths, and drops a subtree when the overlap so far plus what can remain on either side misses the least overlap
   that its sizes need, or when the subtree holds only sets that are linked to it already. A block over a size bound
   is split by bands of size (sets of bands two apart can't link) and then into pairs of hashed parts: every pair of
   the block meets in some group, in bounded memory.
5. The links that joined two classes go to the components rounds.

The threshold is exact in integers. Hashes have 64 bits.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, grams, read, small_batches, word_hashes
from .components import components
from .counting import BLOBS, batch_bytes, emit, in_order, n_buckets, n_ranges, totals

#: N-grams of a group of the trie join, about.
GROUP = 2_000_000
#: Digests that a map task remembers.
SEEN = 1 << 18
#: Bands of sizes; a little over 4/3, so that rounding can't part two sizes in the ratio 3 : 4 by two bands.
BAND = 1.34


def shingles(text: str | None, n: int) -> np.ndarray:
    """Distinct hashes of the runs of n words, ascending; of the whole sequence if there are fewer words."""
    h = word_hashes(text)
    return np.unique(grams(h, min(n, len(h)))) if len(h) else h


def _without_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """digest, text: without copies of what this task has met lately."""
    seen: set[bytes] = set()
    for batch in batches:
        fresh = []
        for i, d in enumerate(batch.column(0).to_pylist()):
            if d not in seen:
                seen.add(d)
                fresh.append(i)
        if len(seen) > SEEN:
            seen = set()
        yield batch.take(pa.array(fresh, pa.int64()))


def least_overlap(n: int, m: int, percent: int) -> int:
    """The least common items o of sets of n and m items with 100 o >= percent (n + m - o)."""
    return -(-percent * (n + m) // (100 + percent))


class _Node:
    __slots__ = ("seg", "kids", "docs", "lo", "hi", "deep", "first", "mixed")

    def __init__(self, seg: np.ndarray, docs: list[int], lo: int, hi: int, deep: int, first: int):
        self.seg, self.docs, self.lo, self.hi, self.deep, self.first = seg, docs, lo, hi, deep, first
        self.kids: dict[int, _Node] = {}
        self.mixed = False


def trie_links(sizes: list[int], items: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links between sets that make the same classes as all links with Jaccard of at least percent / 100.

    sizes: of the whole sets; items: of each set, what may also be in others. One link for each joining of two classes.
    """
    flat = np.concatenate(items)
    vocabulary, place, counts = np.unique(flat, return_inverse=True, return_counts=True)
    rank = np.empty(len(vocabulary), np.int64)
    rank[np.lexsort((vocabulary, -counts))] = np.arange(len(vocabulary))  # frequent first: paths are shared longest
    place = np.where(counts[place] > 1, rank[place], -1)
    parts = np.split(place, np.cumsum([len(x) for x in items])[:-1])
    parent = list(range(len(sizes)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links: list[tuple[int, int]] = []
    has = np.zeros(len(vocabulary), bool)
    root = _Node(np.empty(0, np.int64), [], 1 << 62, 0, 0, 0)
    for q in sorted(range(len(sizes)), key=lambda i: (sizes[i], i)):
        own = np.sort(parts[q][parts[q] >= 0])
        n, least, listed, length = sizes[q], -(-percent * sizes[q] // 100), own.tolist(), len(own)
        has[own] = True
        stack = [(kid, 0, length) for kid in root.kids.values()] + ([(root, 0, length)] if root.docs else [])
        while stack:
            node, overlap, rest = stack.pop()
            if node.hi < least:
                continue
            need = least_overlap(n, max(node.lo, least), percent)
            if overlap + min(rest, len(node.seg) + node.deep) < need or (not node.mixed and find(node.first) == find(q)):
                continue
            if len(node.seg):
                overlap += int(np.count_nonzero(has[node.seg]))
                rest = length - bisect_right(listed, int(node.seg[-1]))
            for d in node.docs:
                if 100 * overlap >= percent * (n + sizes[d] - overlap) and (a := find(d)) != (b := find(q)):
                    parent[max(a, b)] = min(a, b)
                    links.append((d, q))
            if node is not root and overlap + min(rest, node.deep) >= need:
                stack += sorted(((k, overlap, rest) for k in node.kids.values()), key=lambda x: bool(has[x[0].seg[0]]))
        has[own] = False
        # insert
        node, at = root, 0
        while True:
            node.lo, node.hi, node.deep = min(node.lo, n), max(node.hi, n), max(node.deep, length - at)
            if node is not root and not node.mixed and find(node.first) != find(q):
                node.mixed = True
            if at == length:
                node.docs.append(q)
                break
            kid = node.kids.get(listed[at])
            if kid is None:
                node.kids[listed[at]] = _Node(own[at:], [q], n, n, 0, q)
                break
            m = min(len(kid.seg), length - at)
            same = kid.seg[:m] == own[at : at + m]
            stop = m if same.all() else int(np.argmin(same))
            if stop < len(kid.seg):  # split the edge
                low = _Node(kid.seg[stop:], kid.docs, kid.lo, kid.hi, kid.deep, kid.first)
                low.kids, low.mixed = kid.kids, kid.mixed
                top = _Node(kid.seg[:stop], [], kid.lo, kid.hi, kid.deep + len(low.seg), kid.first)
                top.mixed = kid.mixed
                top.kids[int(low.seg[0])] = low
                node.kids[listed[at]] = kid = top
            node, at = kid, at + stop
    return links


def _group(percent: int):
    def links(table: pa.Table) -> pa.Table:
        table = table.sort_by([("block", "ascending"), ("iid", "ascending")])
        block, iid, n = (table.column(c).to_numpy() for c in ("block", "iid", "n"))
        tokens = table.column("tokens").combine_chunks()
        flat, ends = tokens.flatten().to_numpy(), np.cumsum(tokens.value_lengths().to_numpy())
        items = np.split(flat, ends[:-1])
        out: list[np.ndarray] = []
        edges = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
        for a, b in zip(edges, edges[1:], strict=False):
            out += [iid[[a + x, a + y]] for x, y in trie_links(n[a:b].tolist(), items[a:b], percent)]
        both = np.array(out, np.int64).reshape(-1, 2)
        return pa.table({"a": both[:, 0], "b": both[:, 1]})

    return links


def _grouped(sets: DataFrame, blocks: DataFrame, n: int) -> DataFrame:
    """The sets of blocks, each with the groups to which it goes: small blocks whole, several to a group; the rest split."""
    sets = sets.join(blocks.select(F.col("node").alias("iid"), F.col("root").alias("block")), "iid")
    placed = cut(sets.select("iid", "block", "n", F.size("tokens").alias("held"), F.floor(F.log(F.col("n").cast("double")) / float(np.log(BAND))).cast("int").alias("band")), n)
    size = cut(placed.groupBy("block").agg(F.sum("held").alias("all_held")), n)
    total = size.agg(F.sum("all_held").alias("n")).first()["n"] or 0
    packs = max(1, int(total / (GROUP / 64)))
    placed = placed.join(size, "block")
    whole = placed.where(F.col("all_held") <= GROUP).select("iid", "block", F.pmod(F.xxhash64("block"), F.lit(packs)).alias("pack"), F.lit(-9).alias("band"), F.lit(0).alias("i"), F.lit(0).alias("j"))
    split = placed.where(F.col("all_held") > GROUP).withColumn("band", F.explode(F.array("band", F.col("band") - 1)))
    parts = cut(split.groupBy("block", "band").agg(F.ceil(F.sum("held") / (GROUP / 2)).cast("int").alias("k")), n)
    split = split.join(parts, ["block", "band"]).withColumn("own", F.pmod(F.xxhash64("iid"), F.col("k")).cast("int"))
    other = F.filter(F.sequence(F.lit(0), F.greatest(F.col("k") - 1, F.lit(0))), lambda x: (x != F.col("own")) | (F.col("k") == 1))
    split = split.withColumn("other", F.explode(other)).select("iid", "block", F.col("block").alias("pack"), "band", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    return whole.unionByName(split)


def jaccard_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 75) -> DataFrame:
    """For each row of df its id, n_shingles and component_id: the smallest id reachable by links, its own included.

    Two rows link when their sets of n-word shingles have a Jaccard similarity of at least percent / 100. A text of
    fewer words is one shingle; a null text, or one without words, has an empty set and links with nothing. Equal rows
    and rows with equal ids each give a row. A null id is never a component_id unless all ids of the class are null.
    """
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("digest", F.unhex(F.sha2("text", 256)))
    n_rows = df.count()
    texts = cut(rows.groupBy("digest").agg(F.min("id").alias("least_id"), F.max(F.octet_length("text")).alias("bytes")), n_rows)
    total = texts.agg(F.sum("bytes").alias("n")).first()["n"] or 0
    batches, buckets = -(-total // batch_bytes(total)) or 1, n_buckets(total / 6)
    ranges = n_ranges(batches, buckets)
    single = small_batches(rows).select("digest", "text").mapInArrow(_without_copies, "digest binary, text string")
    # dealt by batch alone, so that neither the aggregate nor the groups need another exchange
    dealt = single.withColumn("batch", F.pmod(F.xxhash64("digest"), F.lit(batches))).repartition(batches, "batch")
    dealt = dealt.groupBy("batch", "digest").agg(F.first("text").alias("text"))

    def send(table: pa.Table) -> pa.Table:
        own = [shingles(x.as_py(), n) for x in table.column("text")]
        found, counts = np.unique(np.concatenate(own), return_counts=True)
        return emit(table.column("batch")[0].as_py(), found, counts, ranges)

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("digest")
        own = [shingles(x.as_py(), n) for x in left.column("text")]
        sizes = [len(x) for x in own]
        _, place, here = np.unique(np.concatenate([np.empty(0, np.uint64), *own]), return_inverse=True, return_counts=True)
        found, at = (in_order(right) + here)[place], np.cumsum([0, *sizes])
        kept: list = []
        prefix: list[int] = []
        for i, hashes in enumerate(own):
            df_of = found[at[i] : at[i + 1]]
            some = df_of > 1
            shared = hashes[some]
            # of the prefix, what is left when the n-grams of this text alone have taken their places
            k = len(hashes) + percent * len(hashes) // -100 + 1 - (len(hashes) - len(shared)) if len(hashes) else 0
            prefix.append(max(k, 0))
            kept.append(shared[np.lexsort((shared, df_of[some]))].view(np.int64) if k > 0 and len(shared) else None)
        iid = (left.column("batch")[0].as_py() << 24) + np.arange(len(own), dtype=np.int64)
        return pa.table({"digest": left.column("digest"), "iid": iid, "n": pa.array(sizes, pa.int64()), "prefix": pa.array(prefix, pa.int32()), "tokens": pa.array(kept, pa.list_(pa.int64()))})

    schema = "digest binary, iid long, n long, prefix int, tokens array<long>"
    sums = totals(dealt.groupBy("batch").applyInArrow(send, BLOBS), batches, buckets)
    sets = cut(dealt.groupBy("batch").cogroup(sums.groupBy("batch")).applyInArrow(finish, schema))
    open_sets = sets.where(F.col("tokens").isNotNull())
    seen = open_sets.agg(F.count("*").alias("n"), F.sum("prefix").alias("heads")).first()
    n_open, n_heads = seen["n"], seen["heads"] or 0
    heads = open_sets.select("iid", F.explode(F.slice("tokens", 1, F.col("prefix"))).alias("token"))
    first = cut(heads.groupBy("token").agg(F.min("iid").alias("a"), F.count("*").alias("c")).where("c > 1").drop("c"), n_heads)
    blocks = cut(components(heads.join(first, "token").select("a", F.col("iid").alias("b")).where("a <> b").distinct()), n_open)
    places = _grouped(open_sets, blocks, n_open)
    groups = open_sets.select("iid", "n", "tokens").join(places, "iid").groupBy("pack", "band", "i", "j")
    links = groups.applyInArrow(_group(percent), "a long, b long")
    classes = cut(components(links), n_open)
    known = sets.select("digest", "iid", "n").join(texts.select("digest", "least_id"), "digest").join(classes.withColumnRenamed("node", "iid"), "iid", "left")
    known = cut(known, n_rows)
    least = cut(known.where(F.col("root").isNotNull()).groupBy("root").agg(F.min("least_id").alias("class_id")), n_open)
    known = cut(known.join(least, "root", "left").select("digest", F.col("n").alias("n_shingles"), F.coalesce("class_id", "least_id").alias("class_id")), n_rows)
    out = rows.select("id", "digest").join(known, "digest")
    return out.select(F.col("id").alias(id_col), "n_shingles", F.when(F.col("n_shingles") == 0, F.col("id")).otherwise(F.col("class_id")).alias("component_id"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(read(spark, sf_dir, "documents"))
