import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from linkscore.llm import language as L


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(SF.replace("0.001", "0.01") + "/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    return L.fit(docs.filter(L.learnable(F.col("doc_id"))))


def test_held_out_accuracy(docs, model):
    found = L.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").filter(L.held_out(F.col("doc_id")))
    right, low, high = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    assert right > 0.98 and 0 <= low <= high <= 1


def test_awkward_texts(spark, model):
    texts = [None, "", "123 !!", "²½", " ", "the " * 200_000, "Und", "der die das und nicht mit", "DER DIE DAS UND NICHT MIT"]
    df = spark.createDataFrame([(k, t, "xx", "id", 0.5) for k, t in enumerate(texts)] + [(0, None, None, None, None)], "doc_id long, text string, lang string, id string, score double")
    rows = {}
    for r in L.identify(df, model).collect():
        rows.setdefault(r["doc_id"], []).append(r)
    assert len(rows[0]) == 2 and all(rows[k][0]["lang_pred"] == "und" and rows[k][0]["score"] == 0 for k in range(5))
    assert rows[5][0]["lang_pred"] == "en" and rows[7][0]["lang_pred"] == rows[8][0]["lang_pred"] == "de"


def test_texts_do_not_depend_on_their_neighbours():
    texts = [b"the and of", b"", b"  der die ", b"x"]
    offsets = np.cumsum([0, *map(len, texts)])
    together = list(L.features(np.frombuffer(b"".join(texts), np.uint8), offsets))
    for text, x in zip(texts, together):
        alone = next(L.features(np.frombuffer(text, np.uint8), np.array([0, len(text)])))
        assert np.allclose(alone, x)


@pytest.mark.parametrize("k", [1, 2, 4, 5, 6, 20])
def test_codewords_lie_apart(k):
    code = L.codewords(k)
    apart = min(((code[i] != code[j]).sum() for i in range(k) for j in range(i)), default=1)
    assert len(code) == k and apart >= {1: 1, 2: 1, 4: 4, 5: 8}.get(k, 5)


def test_without_labels_all_is_unknown(spark):
    df = spark.createDataFrame([(1, "text", None), (2, None, "en")], "doc_id long, text string, lang string")
    assert L.fit(df) is None
    assert {r["lang_pred"] for r in L.identify(df, None).collect()} == {"und"}
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert L.fit(empty) is None and L.identify(empty, None).collect() == []


def test_one_language(spark):
    df = spark.createDataFrame([(k, f"some words {k}", "en") for k in range(5)], "doc_id long, text string, lang string")
    assert {r["lang_pred"] for r in L.identify(df, L.fit(df)).collect()} == {"en"}


@pytest.mark.parametrize("same_id", [None, 7])
def test_null_and_repeated_ids_do_not_fill_the_sample(spark, monkeypatch, same_id):
    # Half of the rows share an id; of these, some are copies of one text.
    rows = [(k, f"own words {k}", "en") for k in range(300)] + [(same_id, f"shared words {k}", "en") for k in range(200)]
    rows += [(same_id, "shared words of copies", "en")] * 100 + [(900, "der die das", "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(6)
    gathered, trained = [], []
    monkeypatch.setattr(L, "train", lambda x, y, languages: trained.append((x, y)))
    to_pandas = type(df).toPandas
    monkeypatch.setattr(type(df), "toPandas", lambda self: gathered.append(to_pandas(self)) or gathered[-1])
    L.fit(df, max_per_language=40)
    x, y = trained[0]
    assert [len(g) for g in gathered] == [41] and np.bincount(y).tolist() == [2, 80]
    own = next(L.features(np.frombuffer(b"own", np.uint8), np.array([0, 3])))
    shared = next(L.features(np.frombuffer(b"shared", np.uint8), np.array([0, 6])))
    full = x[::2][1:]
    n_own = int((full @ own > full @ shared).sum())
    assert 14 <= n_own <= 34


def test_sample_does_not_depend_on_partitions(spark, monkeypatch):
    df = spark.createDataFrame([(None, f"words {k}", "en") for k in range(500)], "doc_id long, text string, lang string")
    trained = []
    monkeypatch.setattr(L, "train", lambda x, y, languages: trained.append(x))
    for n in (1, 7):
        L.fit(df.repartition(n), max_per_language=20)
    assert trained[0].shape[0] == 40 and np.array_equal(*trained)


def test_every_language_is_learned(spark):
    rng = np.random.default_rng(5)
    words = {f"l{k:02}": ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(8)] for k in range(75)}
    rows = [(k, " ".join(rng.choice(w, 30)), lang) for k, (lang, w) in enumerate(list(words.items()) * 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.fit(df)
    assert model.languages == sorted(words)
    new = [(k, " ".join(rng.choice(w, 20)), lang) for k, (lang, w) in enumerate(words.items())]
    found = L.identify(spark.createDataFrame(new, "doc_id long, text string, lang string"), model).collect()
    assert {r["doc_id"]: r["lang_pred"] for r in found} == {k: lang for k, _, lang in new}
    assert sum(r["ambiguous"] for r in found) <= 2


def test_more_languages_than_texts_give_one_text_each(spark, monkeypatch):
    rows = [(k, f"words {k}", f"l{k % 30}") for k in range(300)]
    trained = []
    monkeypatch.setattr(L, "train", lambda x, y, languages: trained.append((y, languages)))
    L.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), max_texts=10)
    assert np.bincount(trained[0][0]).tolist() == [2] * 30 and len(trained[0][1]) == 30


def test_decoding_equals_the_sum_of_losses(monkeypatch):
    rng = np.random.default_rng(3)
    code, margins, reliability = L.codewords(7), rng.normal(0, 3, (50, 29)), rng.uniform(0.1, 1, 29)
    reliability, margins = reliability[: code.shape[1]], margins[:, : code.shape[1]]
    loss = np.logaddexp(0, -margins[:, None, :] * code[None]) @ reliability
    near = np.exp(loss.min(1, keepdims=True) - loss)
    monkeypatch.setattr(L, "_DECODED", 100)
    best, share = L.Model([str(k) for k in range(7)], code, np.zeros((1, 1)), reliability).decode(margins)
    assert np.array_equal(best, loss.argmin(1)) and np.allclose(share, 1 / near.sum(1))


def test_codewords_of_many_languages_lie_apart():
    code = L.codewords(1300)
    product = code @ code.T
    np.fill_diagonal(product, -code.shape[1])
    assert (code.shape[1] - product.max()) / 2 >= 10
