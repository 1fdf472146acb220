import hashlib
from collections import Counter

import numpy as np
import pytest
from conftest import SF

from linkscore.llm import repeats as R


def brute(texts):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + 400] for b in data for i in range(len(b) - 399))
    out = []
    for b in data:
        cover = np.zeros(len(b) + 1, int)
        for i in range(len(b) - 399):
            if seen[b[i : i + 400]] > 1:
                cover[i] += 1
                cover[i + 400] -= 1
        cover = np.cumsum(cover)[:-1] > 0
        spans = (np.diff(np.concatenate(([False], cover)).astype(int)) == 1).sum()
        kept = np.frombuffer(b, np.uint8)[~cover].tobytes()
        out.append((len(b), int(spans), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.fixture(scope="module")
def texts(spark):
    rng = np.random.default_rng(3)
    base = "".join(map(chr, rng.integers(97, 100, 3000)))
    given = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    awkward = [
        None, "", "a" * 399, "a" * 400, "b" * 401, "ab" * 700, "c" * 3000, base, base[:1500] + "é" + base[1500:],
        "x" + base[200:2500] + base[100:700], "é" * 300 + "ü" * 250,
    ]
    return given[:60] + awkward + [base[a : a + 900] for a in rng.integers(0, 2000, 20)]


@pytest.mark.parametrize("limit", [R.MEMORY_CONTEXTS, 7])  # 7: classes of more contexts go through files
def test_equals_brute_force(spark, texts, limit):
    rows = [(k, t, k, "c") for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, `key` long, `class` string").repartition(5)
    found = {r["doc_id"]: r for r in R.remove_repeats(df, memory_contexts=limit).collect()}
    got = [
        (found[k]["n_bytes"], len(found[k]["spans"]), hashlib.sha256(found[k]["kept"]).hexdigest()) for k in range(len(texts))
    ]
    assert got == brute(texts)


def test_repeated_rows_and_null_ids(spark):
    text = "".join(map(chr, np.random.default_rng(1).integers(97, 120, 500)))
    rows = [(1, text), (1, text), (None, text + "!"), (None, None), (2, "short")]
    out = R.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, bytes(r["kept"])) for r in out) == [(0, b""), (0, b"!"), (1, b""), (1, b""), (2, b"short")]


def test_empty_table(spark):
    assert R.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_long_texts_in_chunks(monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(5)
    text = "".join(map(chr, rng.integers(97, 123, 9000)))

    def starts(chunk):
        monkeypatch.setattr(R, "_CHUNK", chunk)
        rows = list(R.text_contexts(pa.array([text])))
        return sorted(p for _, begin, n, *_ in rows for b, k in zip(begin, n) for p in range(b, b + k))

    assert starts(1 << 20) == starts(700) == list(range(len(text) - 399))
