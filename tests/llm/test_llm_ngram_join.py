import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from linkscore.llm import ngram_join as J
from linkscore.llm.components import components
from linkscore.llm.store import Scratch


def shingles(text):
    words = J_WORDS(text)
    if len(words) >= 5:
        return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    return frozenset([tuple(words)]) if words else frozenset()


def J_WORDS(text):
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * len(rows)
    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if sets[a] and common >= 0.8 * (len(sets[a]) + len(sets[b]) - common) - 1e-9:
                links[a] += 1
                links[b] += 1
                parent[root(a)] = root(b)
    least = {}
    for k, (d, _) in enumerate(rows):
        least[root(k)] = min(least.get(root(k), (True, None)), (d is None, d), key=repr if d is None else lambda x: (x[0], x[1] or 0))
    return sorted(((d, least[root(k)][1], links[k]) for k, (d, _) in enumerate(rows)), key=repr)


def result(df):
    return sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    words = ["w%d" % k for k in range(3000)]
    texts = []
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.randint(60, 260))]
        for _ in range(rng.randint(1, 9)):
            copy = list(base)
            for _ in range(rng.randint(0, 5)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
    hot = [rng.choice(words) for _ in range(200)]
    for _ in range(70):  # a large class of different texts
        copy = list(hot)
        copy[rng.randrange(len(copy))] = rng.choice(words)
        texts.append("  ".join(copy))
    texts += ["", None, None, " \n", "one", "one", "one two", "one two", "a b c d e", "a b c d e"] + ["same words in all of these"] * 30
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_equals_brute_force(spark, rows, monkeypatch):
    monkeypatch.setattr(J, "BLOCK_NODES", 16)  # cuts the large class into pairs of blocks
    extra = [(*r, "n", 1, "k", 2.0) for r in rows]
    df = spark.createDataFrame(extra, "doc_id long, text string, node string, n int, `key` string, members double")
    assert result(J.near_classes(df.repartition(4))) == brute(rows)


def test_nulls_and_repeated_ids(spark):
    text = "some words that make a text of more than five"
    rows = [(1, text), (1, text), (None, text), (None, None), (2, None), (3, "other words that stand alone here")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(J.near_classes(df)) == sorted(
        [(1, 1, 2), (1, 1, 2), (None, 1, 2), (None, None, 0), (2, 2, 0), (3, 3, 0)], key=repr
    )


def test_empty_table(spark):
    assert J.near_classes(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_depth_meets_the_target():
    p = J.matched_depth()
    assert 1 - (1 - 0.8**p) ** J.TREES >= J.RECALL > 1 - (1 - 0.8 ** (p + 1)) ** J.TREES
    assert J.matched_depth(recall=0.5) > p


def test_paths_agree_as_often_as_the_sets_are_similar():
    rng = np.random.default_rng(1)
    same = total = 0
    for _ in range(150):
        common = rng.integers(0, 1 << 63, 80, np.uint64)
        a, b = (np.concatenate((common, rng.integers(0, 1 << 63, 10, np.uint64))) for _ in range(2))
        first = [J.labels(x) >> (J.BITS * (J.DEPTH - 1)) for x in (a, b)]
        same += (first[0] == first[1]).sum()
        total += J.TREES
    assert abs(same / total - 0.8) < 0.03


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sets(st.integers(0, 30), min_size=1), min_size=1, max_size=9))
def test_linked_equals_jaccard(sets):
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    links = J.linked(arrays, 0.5)
    for a, x in enumerate(sets):
        for b, y in enumerate(sets):
            assert links[a, b] == (a != b and len(x & y) >= 0.5 * len(x | y))
    roots = J._roots(links)
    for a in range(len(sets)):
        assert not links[a].any() or all(roots[b] == roots[a] for b in np.flatnonzero(links[a]))


def test_shingles_of_long_and_short_texts():
    texts = ["", "a", "a b", "b a", "x " * 400_000, "a b c d e f"]
    sets = list(J.shingle_sets(pa.array(texts)))
    assert [len(s) for s in sets] == [0, 1, 1, 1, 1, 2] and len({s.tobytes() for s in sets}) == 6


def test_components_equal_union_find(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(120), rng.randrange(120)) for _ in range(70)] + [(500 + k, 501 + k) for k in range(40)] + [(700, 701 + k) for k in range(50)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    nodes = defaultdict(int)
    for r in components(Scratch(spark), spark.createDataFrame(edges, "a long, b long")).collect():
        nodes[r["node"]] += 1
        assert r["root"] == root(r["node"])
    assert set(nodes) == {x for e in edges if e[0] != e[1] for x in e} and set(nodes.values()) == {1}
