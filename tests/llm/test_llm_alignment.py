"""Alignment of two tokenizations against brute force over whole texts."""

import hashlib
from collections import Counter
from functools import reduce

import numpy as np
import public_tokenizers
import pytest
from conftest import SF, rows
from hypothesis import given, settings
from hypothesis import strategies as st

from linkscore.llm import alignment as A
from linkscore.llm.queries import op12_alignment

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string"
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def encoders():
    return A.Encoders(*PATHS)


def whole(encoders, text):
    """Groups of a text encoded whole, or None where it has no tokens."""
    if not text:
        return None
    a, b = encoders.a.encode(" " + text, add_special_tokens=False).ids, encoders.b.encode(text)
    bytes_a, bytes_b = [encoders.bytes_a[x] for x in a], [encoders.bytes_b[x] for x in b]
    if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
        return None
    groups, at, i, j = [([], [])], [0, 0], 0, 0
    while i < len(a) or j < len(b):
        if at[0] <= at[1]:
            groups[-1][0].append(a[i])
            at[0] += len(bytes_a[i])
            i += 1
        else:
            groups[-1][1].append(b[j])
            at[1] += len(bytes_b[j])
            j += 1
        if at[0] == at[1]:
            groups.append(([], []))
    return groups[:-1]


def expected(encoders, docs):
    found = [(doc_id, whole(encoders, text)) for doc_id, text in docs]
    links = [Counter((x, y) for a, b in groups or [] for x in a for y in b) for _, groups in found]
    counts = Counter(pair for held in links for pair in held)
    top = Counter()
    for (x, _), n in counts.items():
        top[x] = max(top[x], n)
    out = []
    for (doc_id, groups), held in zip(found, links):
        text = None if groups is None else ";".join(A.shown(*g) for g in groups)
        out.append(
            (
                doc_id,
                sum(len(a) for a, _ in groups or []),
                sum(len(b) for _, b in groups or []),
                len(groups or []),
                sum(held.values()),
                sum(n for (x, y), n in held.items() if counts[x, y] == top[x]),
                sum(n * counts[pair] for pair, n in held.items()),
                "" if text is None else hashlib.sha256(text.encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def test_query_equals_brute_force(spark, encoders):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = expected(encoders, docs)
    assert result(op12_alignment(spark, SF)) == want
    # Every text a long one, in small parts and ranges of bytes, and batches of any rows.
    frame = spark.read.parquet(f"{SF}/documents.parquet").repartition(3)
    assert result(A.align(frame, *PATHS, long_chars=500, part_chars=300, chunk_bytes=37)) == want


TEXTS = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "tab\there", "line\n\n next", "<|endoftext|> and <s> </s> <0x41> <unk>", "▁x", "x▁ y",
    "日本語 text 🙂🙂 é é", " x y z", "zero\x00byte", "don't we'll 12345 x=1;", "=" * 300, " " * 200, "ééé" * 200, "\x1c\x1d x",
]


def test_awkward_texts_repeats_and_clashing_columns(spark, encoders):
    docs = [*enumerate(TEXTS), (None, "a b a b"), (None, None), (4, "a"), (4, "a"), (90, "nospace" * 3000), (91, "word　" * 900)]
    names = "row long, start int, node string, batch long, kind string, id string"
    frame = spark.createDataFrame([(*d, 1, 2, "n", 3, "k", "i") for d in docs], f"{SCHEMA}, {names}").repartition(4)
    want = expected(encoders, docs)
    assert result(A.align(frame, *PATHS)) == want
    assert result(A.align(frame, *PATHS, long_chars=0, part_chars=2, chunk_bytes=5)) == want


def test_large_groups_list_their_distinct_ids(monkeypatch):
    a, b = [5, 6, 5, 9], [1, 1, 2]
    want = Counter((x, y) for x in a for y in b)
    for most in (100, 3):
        monkeypatch.setattr(A, "LISTED_LINKS", most)
        seen = Counter()
        for pair, n in zip(*A.links_of(a, b)):
            seen[int(pair) >> 16, int(pair) & 0xFFFF] += int(n)
        assert seen == want


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab é日 \n\t▁'1.🙂 ́"), max_size=40))
def test_pieces_give_the_tokens_of_the_whole_text(encoders, text):
    groups = whole(encoders, text)
    found = A.encoded_text(encoders, text)
    assert (bool(text) and found.same.all()) == (groups is not None)
    if groups is not None:
        assert found.a.tolist() == [i for g, _ in groups for i in g]
        assert found.b.tolist() == [i for _, g in groups for i in g]
        texts, counts = A.group_texts(found, encoders)
        assert texts == [A.shown(*g) for g in groups] and counts.sum() == len(groups)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=30), st.lists(st.integers(1, 4), min_size=1, max_size=30), st.data())
def test_fragments_are_a_monoid(sizes_a, sizes_b, data):
    short = sum(sizes_a) - sum(sizes_b)
    sizes_a, sizes_b = sizes_a + [-short] * (short < 0), sizes_b + [short] * (short > 0)
    end_a, end_b = np.cumsum(sizes_a), np.cumsum(sizes_b)
    a, b = np.arange(len(end_a), dtype=np.int32), np.arange(len(end_b), dtype=np.int32)
    total = int(end_a[-1])
    cuts = sorted(data.draw(st.sets(st.integers(0, total), max_size=8)) | {0, total})
    parts = [A.fragment(a, end_a, b, end_b, low, high) for low, high in zip(cuts, cuts[1:])]

    def tree(found):
        if len(found) < 2:
            return found[0] if found else A.EMPTY
        k = data.draw(st.integers(1, len(found) - 1))
        return A.compose(tree(found[:k]), tree(found[k:]))

    want = A.fragment(a, end_a, b, end_b, 0, total)
    for got in (tree(parts), reduce(A.compose, parts, A.EMPTY)):
        assert all(np.array_equal(x, y) for x, y in zip(got, want))
    for f in parts:  # open beginning, closed groups and open end are all there is
        stretches = [f.prefix, *f.closed(), f.suffix]
        assert np.array_equal(np.concatenate([x for x, _ in stretches]), f.a)
        assert np.array_equal(np.concatenate([y for _, y in stretches]), f.b)


def test_empty_table_and_partitioning(spark):
    assert result(A.align(spark.createDataFrame([], SCHEMA), *PATHS)) == []
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert rows(A.align(docs.repartition(1), *PATHS)) == rows(A.align(docs.repartition(9, "text"), *PATHS))


def test_a_task_takes_one_python_worker(spark, encoders, monkeypatch):
    plans, put = [], A.Scratch.put
    kept = lambda self, df, *split: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or put(self, df, *split)
    monkeypatch.setattr(A.Scratch, "put", kept)
    docs = [(1, "one two, three. " * 30), (2, "short one"), (3, None)]
    df = A.align(spark.createDataFrame(docs, SCHEMA), *PATHS, long_chars=100, part_chars=50, chunk_bytes=64)
    assert result(df) == expected(encoders, docs)
    plans.append(df._jdf.queryExecution().optimizedPlan().toString())
    steps = [line for plan in plans for line in plan.splitlines() if not line.lstrip(" :+-").startswith("Project")]
    assert any("MapInArrow" in x for x in steps)
    assert not [x for x, y in zip(steps, steps[1:]) if "MapInArrow" in x and "MapInArrow" in y and y.index("MapInArrow") > x.index("MapInArrow")]
