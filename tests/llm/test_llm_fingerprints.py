"""Threshold-scaled fingerprints against a plain computation."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF, rows

from linkscore.llm import fingerprints as P
from linkscore.llm.queries import op11_fingerprints

SCHEMA = "doc_id long, text string"


def shingles(text, words=5):
    found = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return {tuple(found[k : k + words]) for k in range(len(found) - words + 1)} if len(found) >= words else {tuple(found)} - {()}


def in_order(docs):
    """Rows by descending id, null ids last, with the next row of each."""
    order = sorted(docs, key=lambda d: (d[0] is None, -(d[0] or 0)))
    return list(zip(order, order[1:] + order[:1]))


def edit(text, nxt):
    return text[: len(text) - len(text) // 2] + nxt[: len(text) // 2]


def sketch(text, **options):
    return P.sketches(pa.array([text], pa.string()), **options)[0]


def exact(a, b):
    return len(shingles(a) & shingles(b)) / max(len(shingles(a) | shingles(b)), 1)


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {r["doc_id"]: r for r in op11_fingerprints(spark, SF).collect()}
    assert len(got) == len(docs)
    off = []
    for (doc_id, text), (_, nxt) in in_order(docs):
        text, nxt = text or "", nxt or ""
        edited, r = edit(text, nxt), got[doc_id]
        own, other, follow = sketch(text), sketch(edited), sketch(nxt)
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert (r["fingerprint"], r["edited_fingerprint"]) == (P.packed(own), P.packed(other))
        assert (r["near_edited"], r["near_next"]) == (P.likeness(own, other), P.likeness(own, follow))
        if len(shingles(text)) > 200:
            off.append(abs(r["near_edited"] - exact(text, edited)))
            off.append(abs(r["near_next"] - exact(text, nxt)))
    assert np.mean(off) < 0.05 and max(off) < 0.3


def test_estimates_follow_the_shingles():
    rng = random.Random(3)
    text = [f"w{rng.randrange(10**6)}" for _ in range(30_000)]
    whole, part, half = (" ".join(text[:n]) for n in (30_000, 1_000, 15_000))
    a, b, c = sketch(whole), sketch(part), sketch(half)
    assert abs(len(a) / 29_996 - P.FRACTION) < 0.01
    assert P.containment(b, a) == 1.0 and abs(P.containment(a, b) - 996 / 29_996) < 0.01
    assert abs(P.likeness(a, c) - 0.5) < 0.03 and P.likeness(a, a) == 1.0
    assert abs(len(sketch(whole, fraction=1.0)) - 29_996) <= 1


def test_union_of_fingerprints_is_that_of_the_union():
    rng = random.Random(5)
    for words in (0, 1, 3, 5, 6, 9, 40, 400):
        for more in (0, 2, 7, 60):
            a, b = (" ".join(f"v{rng.randrange(300)}" for _ in range(n)) for n in (words, more))
            every = np.union1d(sketch(a, fraction=1.0), sketch(b, fraction=1.0))
            below = every[every < P.limit(P.FRACTION)]
            want = below if len(below) else every[:1]
            assert P.merge(sketch(a), sketch(b)).tolist() == want.tolist()
            assert P.unpacked(P.packed(want)).tolist() == want.tolist()


AWKWARD = [
    (None, "null id " * 9), (None, None), (4, ""), (3, None), (2, "  \n "), (9, "one"), (8, "two words"), (7, "é" * 3001),
    (6, "a b c d e f g " * 30_000), (5, "a b c d e f g " * 30_000), (1, "𝄞 x y " * 50),
]


@pytest.mark.parametrize("chunk_rows", [1, 2, 3, 1000])
def test_any_chunks_and_awkward_rows(spark, chunk_rows):
    docs = [*AWKWARD, (4, ""), (4, "")]
    frame = spark.createDataFrame([(*d, 1, "x", "y", True) for d in docs], f"{SCHEMA}, chunk int, tie string, id string, after boolean")
    got = P.edited_fingerprints(frame.repartition(4), chunk_rows=chunk_rows).collect()
    assert len(got) == len(docs)
    by = {(r["doc_id"], r["n_chars"]): r for r in got}
    numbered = [d for d in docs if d[0] is not None]
    for (doc_id, text), (_, nxt) in in_order(numbered)[:-1]:
        text, r = text or "", by[doc_id, len(text or "")]
        assert r["edited_sha256"] == hashlib.sha256(edit(text, nxt or "").encode()).hexdigest()
    assert by[6, 420_000]["fingerprint"] == by[5, 420_000]["fingerprint"] and by[6, 420_000]["near_next"] == 1.0
    assert by[3, 0]["fingerprint"] == "" and by[8, 9]["fingerprint"] != ""
    # The last of all is one of the null ids; the first follows it.
    last = [r for r in got if r["doc_id"] is None]
    assert {r["n_chars"] for r in last} == {0, 72}


def test_does_not_depend_on_partitioning(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    one = rows(P.edited_fingerprints(docs.repartition(1), chunk_rows=7))
    assert one == rows(P.edited_fingerprints(docs.repartition(11, "text")))


def test_one_row_and_none(spark):
    (r,) = P.edited_fingerprints(spark.createDataFrame([(1, "abcd")], SCHEMA)).collect()
    assert r["edited_sha256"] == hashlib.sha256(b"abab").hexdigest() and r["near_next"] == 1.0
    empty = spark.createDataFrame([], SCHEMA)
    assert P.edited_fingerprints(empty).collect() == [] and P.fingerprints(empty).collect() == []


def test_groups_merge_and_overlap(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source")
    found = P.fingerprints(docs).join(docs.select("doc_id", "source"), "doc_id")
    got = {}
    for r in P.merged(found, "source").collect():
        got.setdefault(r["source"], set()).add(r["hash"])
    want = {}
    for r in found.collect():
        want[r["source"]] = P.merge(want.get(r["source"], np.empty(0, np.uint64)), P.unpacked(r["fingerprint"]))
    assert got == {k: set(v.tolist()) for k, v in want.items() if len(v)}
    table = P.merged(found, "source")
    for r in P.overlaps(table, table, "source", "source").collect():
        assert r["contained"] == pytest.approx(P.containment(want[r["left"]], want[r["right"]]))
