import re
from collections import Counter

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from linkscore.llm import rules as Q


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated = {k + j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for j in range(3)}
    seen, dup, lines = set(), 0, 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            lines += 1
            dup += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, dup, len(repeated), lines, len(set(words))


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct_words"]


def test_statistics_equal_brute_force(spark):
    given = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    odd = [
        None, "", " ", "a", "a a a", "a b c a b c", "\n\n", "x\nx\nx ", "x\r\nx\r\n", "é è ü # |", "a\x0bb\x1cc", "ab " * 90_000,
        "long" * 400_000, "a b c d\n" * 7, "\ta\n a\n\ta",
    ]
    rows = [(k, t, "i") for k, t in enumerate(given + odd)] + [(None, "x y", "i")]
    df = spark.createDataFrame(rows, "doc_id long, text string, id string")
    found = {r["id"]: tuple(r[n] for n in NAMES) for r in Q.text_statistics(df).collect()}
    assert found == {k: brute(t) for k, t, _ in rows}


def test_learns_a_conjunction():
    rng = np.random.default_rng(0)
    columns = {"words": rng.uniform(0, 100, 3000), "upper_share": rng.uniform(0, 1, 3000), "digit_share": rng.uniform(0, 1, 3000)}
    bad = (columns["words"] > 60) & (columns["upper_share"] < 0.3)
    learned = Q.learn(columns, bad)
    covered = np.zeros(3000, bool)
    for rule in learned:
        covered |= Q._covers(rule, columns, 3000)
    assert (covered == bad).mean() > 0.97


def test_nothing_to_learn():
    columns = {"words": np.arange(10.0)}
    assert Q.learn(columns, np.zeros(10, bool)) == []
    assert Q.learn({"words": np.empty(0)}, np.zeros(0, bool)) == []


def test_rules_are_ordered_expressions(spark):
    first = (Q.Condition("words", True, 3.0),)
    second = (Q.Condition("words", True, 2.0), Q.Condition("upper_share", False, 0.5))
    df = spark.createDataFrame([(4, 0, 8), (2, 8, 8), (2, 1, 8), (0, 0, 0)], "n_words long, n_upper long, word_chars long")
    assert [r[0] for r in df.select(Q.as_column([first, second])).collect()] == [1, 0, 2, 0]
    assert [r[0] for r in df.select(Q.as_column([])).collect()] == [0, 0, 0, 0]


@pytest.fixture(scope="module")
def judged(spark):
    folder = SF.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    return Q.quality_rules(docs, labels).join(labels, "doc_id").filter(~F.col("base_failed"))


def test_bad_documents_go_and_good_ones_stay(judged):
    share = {r["quality"]: r["kept"] for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert share[0] < 0.05 and share[1] > 0.99


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert Q.quality_rules(docs, labels).collect() == []
    one = spark.createDataFrame([(1, "w " * 60), (2, None)], "doc_id long, text string")
    assert {r["doc_id"]: r["kept"] for r in Q.quality_rules(one, labels).collect()} == {1: False, 2: False}


def test_the_sample_is_bounded_and_repeated_ids_do_not_fill_it(spark, monkeypatch):
    seen = {}

    def learn(columns, bad):
        seen["rows"], seen["bad"] = len(bad), int(bad.sum())
        return []

    monkeypatch.setattr(Q, "learn", learn)
    rows = [(k, f"word{k} " * (1 + k % 50)) for k in range(900)] + [(7, "the same row")] * 600 + [(None, "no id")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(
        [(k, k % 2) for k in range(900)] + [(7, None), (7, 1), (7, 1), (None, 0)], "doc_id long, quality int"
    )
    statistics = Q.text_statistics(docs).cache()
    Q.fit(statistics, labels)
    # Copies of a row and of its label count once: id 7 has two texts.
    assert seen["rows"] == 901
    Q.fit(statistics, labels, max_sample=100)
    assert seen["rows"] == 100 and 25 < seen["bad"] < 75


def test_clashing_columns_and_null_labels(spark):
    rows = [(1, "w x y z " * 30, 1, "i", 2), (1, "w x y z " * 30, 1, "i", 2), (2, None, 1, "i", 2), (None, "", 1, "i", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int, id string, `rule` int")
    labels = spark.createDataFrame([(1, None), (1, 0), (1, 0), (2, 1), (None, 1)], "doc_id long, quality int")
    assert sorted(str(r["doc_id"]) for r in Q.quality_rules(docs, labels).collect()) == ["1", "1", "2", "None"]
