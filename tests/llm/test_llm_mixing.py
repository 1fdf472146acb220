import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from linkscore.llm import mixing as M
from linkscore.llm.store import Scratch


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, tokens int, `pass` int, `row` long")


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    out = []
    for source, n in (("hot", 900), ("b", 200), ("c", 200), (None, 150), ("tiny", 3)):
        for _ in range(n):
            out.append((len(out), "w " * rng.randint(1, 40), source, 9, 9, 9))
    return out + [(None, None, "c", 1, 1, 1), (5, "", "b", 1, 1, 1), (5, "", "b", 1, 1, 1)]


def words(text):
    return max(1, len((text or "").split()))


def tokens_of(rows):
    total = defaultdict(int)
    for _, text, source, *_ in rows:
        total[source] += words(text)
    return total


@pytest.fixture(scope="module")
def mixed(spark, rows):
    M.BLOCK_DOCS, before = 50, M.BLOCK_DOCS
    out = M.mix(frame(spark, rows).repartition(3), max_passes=4.0).collect()
    M.BLOCK_DOCS = before
    return out


def test_weights_are_the_flattest_within_the_limit(rows, mixed):
    total = tokens_of(rows)
    least, most = min(total.values()), max(total.values())
    alpha = 1 - math.log(4) / math.log(most / least)  # passes differ as tokens ** (alpha - 1)
    powers = {s: t**alpha for s, t in total.items()}
    for r in mixed:
        assert r["weight"] == pytest.approx(powers[r["source"]] / sum(powers.values()), rel=1e-5)


def test_quotas_are_met_by_whole_passes_and_part_of_one(rows, mixed):
    total, taken, passes = tokens_of(rows), defaultdict(int), defaultdict(lambda: defaultdict(list))
    count = defaultdict(int)
    for _, _, source, *_ in rows:
        count[source] += 1
    for r in mixed:
        taken[r["source"]] += r["n_tokens"]
        passes[r["source"]][r["pass"]].append(r)
    scale = max(total[s] / next(r["weight"] for r in mixed if r["source"] == s) for s in total)
    for source, by in passes.items():
        quota = next(r["weight"] for r in mixed if r["source"] == source) * scale
        assert quota - 1 <= taken[source] <= quota + 41
        assert all(len(by[p]) == count[source] for p in range(max(by)))
        assert len(by[max(by)]) <= count[source]
        orders = [[r["row_key"] for r in sorted(by[p], key=lambda r: r["mix_position"])] for p in range(max(by) + 1)]
        if len(orders) > 1 and count[source] > 100:
            assert orders[0][:50] != orders[1][:50]
        ends = sorted((r["mix_position"], r["n_tokens"]) for p in by for r in by[p])
        at = 0
        for position, n in ends:  # documents follow each other without a gap
            assert position * quota == pytest.approx(at, abs=1.5)
            at += n


def test_a_budget_and_an_entropy(spark, rows):
    out = M.mix(frame(spark, rows), budget_tokens=3000, max_passes=None, max_entropy=0.8)
    weights = [r[0] for r in out.groupBy("source").agg(F.first("weight")).select("first(weight)").collect()]
    entropy = -sum(w * math.log2(w) for w in weights) / math.log2(len(weights))
    assert entropy == pytest.approx(0.8, abs=1e-3)
    assert 3000 <= out.agg(F.sum("n_tokens")).first()[0] <= 3000 + 41 * len(weights)


def test_no_row_is_python(spark, rows):
    plan = M.mix(frame(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_empty_and_single(spark):
    assert M.mix(frame(spark, [])).collect() == []
    one = M.mix(frame(spark, [(1, None, None, 1, 1, 1)])).collect()
    assert len(one) == 1 and one[0]["weight"] == 1.0 and one[0]["source"] is None


def test_the_mix_depends_on_the_rows_alone(spark, rows, monkeypatch):
    monkeypatch.setattr(M, "BLOCK_DOCS", 50)
    monkeypatch.setattr(M, "COPIES", 4)  # so that copies are numbered in several parts
    many = rows + [(7, "same words", "hot", 1, 1, 1)] * 30 + [(None, None, None, 1, 1, 1)] * 9
    mixes = []
    for partitions in (1, 5, 50):
        shuffled = random.Random(partitions).sample(many, len(many))
        out = M.mix(frame(spark, shuffled).repartition(partitions), max_passes=4.0).drop("weight", "mix_position").collect()
        mixes.append(sorted(map(repr, out)))
    assert mixes[0] == mixes[1] == mixes[2]
    whole = [r for r in out if r["pass"] == 0 and r["doc_id"] == 7 and r["source"] == "hot" and r["n_tokens"] == 2]
    assert len(whole) >= 30


def test_block_starts_are_running_sums_however_blocks_are_spanned(spark):
    rows = [(s, p, b, (7 * b + 3 * p + len(s or "")) % 11 + 1) for s in ("a", "bb", None) for p in range(2) for b in range(0, 50, 1 + p)]
    totals = {s: sum(t for x, p, _, t in rows if x == s and p == 0) for s in ("a", "bb", None)}
    given = [(s, p, b, t, totals[s]) for s, p, b, t in rows]
    schema = "source string, pass int, block long, block_tokens long, tokens long"
    expected = {(s, p, b): p * totals[s] + sum(t for x, q, c, t in rows if (x, q) == (s, p) and c < b) for s, p, b, _ in rows}
    for span in (1, 7, 50, 2_000):
        blocks = spark.createDataFrame(given, schema).repartition(5)
        found = M._block_starts(Scratch(spark), blocks, span).collect()
        assert len(found) == len(rows)
        assert {(r["source"], r["pass"], r["block"]): r["before"] for r in found} == expected
