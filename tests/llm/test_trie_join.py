"""The trie join against brute force: all pairs of sets, exact Jaccard, union-find."""

import random
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillspark.llm import trie_join as TJ


def shingles(text, n=5):
    ws = (text or "").encode().lower().split()
    return frozenset(tuple(ws[i : i + n]) for i in range(len(ws) - n + 1)) if len(ws) >= n else frozenset([tuple(ws)] if ws else [])


def classes(sets, percent=75):
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def corpus(seed, n=120):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    shared = [r.choice(vocabulary) for _ in range(40)]
    out = []
    for i in range(n):
        k = r.randrange(6)
        if k < 3 and out:
            ws = (r.choice(out)[1] or "").split()
            for _ in range(r.randrange(1 + len(ws) // 20 + 1)):
                if ws:
                    ws[r.randrange(len(ws))] = r.choice(vocabulary)
        else:
            ws = [r.choice(vocabulary) for _ in range(r.choice([0, 1, 3, 5, 8, 30, 90]))]
            if k == 4:
                at = r.randrange(len(ws) + 1)
                ws[at:at] = shared
        out.append((i, " ".join(ws)))
    return out


def check(spark, rows, **how):
    got = TJ.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string"), **how).collect()
    sets = {i: shingles(t) for i, t in rows}
    want = classes(sets)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted((i, len(sets[i]), want[i]) for i, _ in rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    check(spark, corpus(seed))


def test_split_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(TJ, "GROUP", 400)  # nearly all blocks are split by bands and parts
    check(spark, corpus(3))


def test_edges_of_input(spark):
    long = " ".join(f"x{i}" for i in range(30000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a"), (5, "A"), (6, "a b c d e"), (7, "a b  c d E"), (8, long), (9, long + " end"), (10, "É b c d e"), (11, "é b c d e")]
    check(spark, rows)


def test_nulls_ties_and_clashing_columns(spark):
    rows = [(None, "p q r s t u"), (2, "p q r s t u"), (2, "p q r s t u"), (7, "p q r s t u"), (None, "only null ids here ok"), (3, None)]
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], "doc_id long, text string, digest string, n long, least_id string")
    got = sorted(((r.doc_id, r.component_id) for r in TJ.jaccard_classes(df).collect()), key=str)
    assert got == sorted([(None, 2), (2, 2), (2, 2), (7, 2), (None, None), (3, 3)], key=str)
    assert TJ.jaccard_classes(df.limit(0)).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(0, 25), min_size=1, max_size=20), min_size=1, max_size=25))
def test_trie_links_make_the_classes_of_all_links(sets):
    sizes = [len(s) for s in sets]
    links = TJ.trie_links(sizes, [np.array(sorted(s), np.int64) for s in sets], 75)
    root = {i: i for i in range(len(sets))}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        assert 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
        x, y = find(a), find(b)
        assert x != y  # one link for each joining of classes
        root[max(x, y)] = min(x, y)
    assert {i: find(i) for i in root} == classes({i: frozenset(s) for i, s in enumerate(sets)})


def test_hot_copies(spark):
    text = "the same words again and again here"
    check(spark, [(i, text) for i in range(400)] + [(1000 + i, f"{text} and {i}") for i in range(40)])
