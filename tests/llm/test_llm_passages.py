from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from linkscore.llm import passages as P
from linkscore.llm import queries
from linkscore.llm import repeats as R


def brute(texts, words):
    split = [(t or "").split() for t in texts]
    rows = Counter(x for w in split for x in {tuple(w[i : i + words]) for i in range(len(w) - words + 1)})
    out = []
    for w in split:
        held = [i for i in range(len(w) - words + 1) if rows[tuple(w[i : i + words])] > 1]
        out.append(len({j for i in held for j in range(i, i + words)}))
    return out


def said(rng, n, letters="abcd"):
    return ["".join(rng.choice(list(letters), rng.integers(2, 6))) for _ in range(n)]


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(8)
    base = said(rng, 600)
    pieces = [" ".join([*said(rng, 30), *base[a : a + n], *said(rng, 20)]) for a, n in rng.integers([0, 40], [500, 90], (60, 2))]
    own = " ".join(said(rng, 60, "wxyz"))
    awkward = [
        None, "", " \n", " ".join(base), "\t\n".join(base), " ".join(base[:51]), " ".join(base[:50]), own + " " + own,
        " ".join(["same"] * 300), " ".join(["same"] * 80), " ".join(["even"] * 200), " ".join(["é ü"] * 90),
    ]
    return pieces + awkward + [pieces[0], pieces[0] + " more"]


@pytest.mark.parametrize("words", [51, 20, 8])
def test_equals_brute_force(spark, texts, words):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    found = {r["doc_id"]: r["n_shared"] for r in R.remove_repeats(df, words=words).collect()}
    assert [found[k] for k in range(len(texts))] == brute(texts, words)


def test_equal_rows_and_null_ids(spark):
    text = " ".join(said(np.random.default_rng(2), 55))
    rows = [(1, text), (1, text), (None, "x " + text), (None, None), (2, "short"), (3, None)]
    out = R.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), words=51).collect()
    assert sorted((r["doc_id"] or 0, r["n_shared"]) for r in out) == [(0, 0), (0, 55), (1, 55), (1, 55), (2, 0), (3, 0)]


def test_query_tells_of_passages_too_short_to_be_removed(spark, tmp_path):
    rng = np.random.default_rng(4)
    passage = " ".join(said(rng, 52))
    assert len(passage) < 400
    texts = [" ".join([*said(rng, 90), passage, *said(rng, 80)]) for _ in range(3)] + [" ".join(said(rng, 200))]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = sorted(queries.op3_repeats(spark, str(tmp_path)).collect())
    assert [r["n_removed"] for r in found] == [0, 0, 0, 0]
    assert [r["n_shared_words"] for r in found] == [52, 52, 52, 0]


def test_many_words_in_chunks(monkeypatch):
    text = " ".join(said(np.random.default_rng(6), 4000))
    batch = pa.RecordBatch.from_arrays([pa.array([b"k"]), pa.array([text])], names=["key", "text"])

    def starts(chunk):
        monkeypatch.setattr(P, "_CHUNK", chunk)
        (out,) = P._anchored(51)([batch])
        return sorted(p for b, n in zip(out["begin"].to_pylist(), out["starts"].to_pylist()) for p in range(b, b + n))

    assert starts(1 << 20) == starts(300) == list(range(3950))


def test_length_of_passages(spark):
    with pytest.raises(ValueError, match="8 to 71"):
        R.remove_repeats(spark.createDataFrame([], "doc_id long, text string"), words=72)
