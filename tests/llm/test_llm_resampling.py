import numpy as np
import pytest
from conftest import SF
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linkscore.llm import resampling as R


@pytest.mark.parametrize("values", [[1.0], [2.0] * 9, [float(k % 7) for k in range(50)], [0.1 * k * (-1) ** k for k in range(60)], [1e-300, 1e300, 5.0]])
def test_kth_largest(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for k in {1, len(values) // 2 + 1, len(values)}:
        assert R.kth_largest(df, "x", k) == sorted(values, reverse=True)[k - 1]


def test_good_text_weighs_more(spark):
    folder = SF.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    out = R.resample(docs, labels).cache()
    judged = out.join(labels, "doc_id").groupBy("quality").agg(F.avg("log_weight").alias("w"), F.avg(F.col("kept").cast("int")).alias("k"))
    by = {r["quality"]: r for r in judged.collect()}
    assert by[1]["w"] > by[0]["w"] and by[1]["k"] > 0.95 and by[0]["k"] < 0.2
    share = labels.agg(F.avg("quality")).first()[0]
    assert out.filter("kept").count() == round(share * out.count())


def test_weights_equal_the_formula(spark):
    texts = ["good words here", "bad words there", "good good", "noise", ""]
    rows = spark.createDataFrame([(t, k in (0, 2)) for k, t in enumerate(texts)], "text string, target boolean")
    ratios = R.log_ratios(rows)
    total, target = np.ones(R.BUCKETS), np.ones(R.BUCKETS)
    for k, t in enumerate(texts):
        data = np.frombuffer(t.encode(), np.uint8)
        _, buckets = R.hashed_grams(data, np.array([0, len(data)]))
        assert len(buckets) == max(0, 2 * len(t.split()) - 1)
        np.add.at(total, buckets, 1)
        if k in (0, 2):
            np.add.at(target, buckets, 1)
    assert np.allclose(ratios, np.log(target / target.sum()) - np.log(total / total.sum()))


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet="ab \n", max_size=12), min_size=1, max_size=6))
def test_grams_stay_within_their_text(texts):
    data = [np.frombuffer(t.encode(), np.uint8) for t in texts]
    doc, buckets = R.hashed_grams(np.concatenate(data), np.cumsum([0, *map(len, data)]))
    for k, x in enumerate(data):
        alone = R.hashed_grams(x, np.array([0, len(x)]))[1]
        assert sorted(buckets[doc == k]) == sorted(alone)


def test_awkward_tables(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, None, None), (1, 1, 0)], "doc_id long, quality int, toxic int")
    none = spark.createDataFrame([], labels.schema)
    docs = spark.createDataFrame(
        [(1, "a b", 0.0, "h"), (1, "a b", 0.0, "h"), (2, None, 0.0, "h"), (3, "", 0.0, "h"), (None, "c d " * 90_000, 0.0, "h")],
        "doc_id long, text string, log_weight double, `hash` string",
    )
    out = R.resample(docs, labels).collect()
    assert len(out) == 5 and not any(r["kept"] for r in out if r["n_grams"] == 0)
    first = [r for r in out if r["doc_id"] == 1]
    assert first[0] == first[1]
    assert [r["kept"] for r in sorted(R.resample(docs, none).collect(), key=repr)].count(True) == 3
    assert R.resample(docs.limit(0), labels).collect() == []


@pytest.mark.parametrize("per_gram", [False, True])
def test_kept_are_the_largest_sums(spark, per_gram):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = R.resample(docs, labels, share=0.3, temperature=0.01 if per_gram else 1.0, per_gram=per_gram).collect()
    worded = sorted((r["sum"] for r in out if r["n_grams"]), reverse=True)
    border = worded[round(0.3 * len(out)) - 1]
    assert all(r["kept"] == (r["n_grams"] > 0 and r["sum"] >= border) for r in out)


def test_log_weight_is_the_ratio_of_the_models(spark):
    ratios = np.random.default_rng(2).normal(size=R.BUCKETS)
    texts = ["a b c", "", "b " * 500, "x"]
    rows = spark.createDataFrame([(k, k, t) for k, t in enumerate(texts)], "id int, hash long, text string")
    for r in R.weighted(rows, ratios, 1.0).collect():
        data = np.frombuffer(texts[r["id"]].encode(), np.uint8)
        _, buckets = R.hashed_grams(data, np.array([0, len(data)]))
        assert r["log_weight"] == pytest.approx(ratios[buckets].sum()) and r["n_grams"] == len(buckets)


def test_a_bounded_target_is_cut_on_the_executors(spark):
    docs = spark.createDataFrame([(k, f"w{k} common words") for k in range(400)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "CAST(doc_id % 2 AS INT) AS quality", "0 AS toxic")
    out = R.resample(docs, labels, max_target=20).collect()
    assert len(out) == 400 and sum(r["kept"] for r in out) >= 200
