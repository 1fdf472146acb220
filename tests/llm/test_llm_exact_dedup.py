import re
from collections import defaultdict

import pytest

from linkscore.llm import exact_dedup

COLUMNS = "id string, doc_id long, text string, row long, `group` string, digit int, size int, keep_id long, kept int"


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc_id)
    out = []
    for ids in groups.values():
        keep = min(ids, key=lambda x: (x is None, x))
        kept_one = False
        for x in ids:
            kept = x == keep and not kept_one
            kept_one |= kept
            out.append((x, keep, len(ids), kept))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def awkward():
    long = "word " * 40_000
    texts = [
        None, "", "", " ", "  \t\n ", "a", "a", " a", "a b", "a\tb", "a \x0b b", "a b", "é" * 70, "é" * 70, "é" * 69 + "e",
        "x" * 64, "x" * 64, "x" * 65, "y" * 65_600, "y" * 65_600, "y" * 65_601, long, long + "end", long + "end", long,
    ]
    rows = list(enumerate(texts))
    return rows + [(5, "a"), (5, "a"), (None, "a"), (None, "only"), (None, "only"), (7, None)] + [(900 + k, "hot") for k in range(60)]


def test_equals_brute_force(spark, awkward):
    df = spark.createDataFrame([("i", d, t, 1, "g", 2, 3, 4, 5) for d, t in awkward], COLUMNS).repartition(5)
    assert result(exact_dedup.exact_groups(df)) == brute(awkward)


def test_digits_of_any_width_give_the_same(spark, awkward, monkeypatch):
    monkeypatch.setattr(exact_dedup, "FIRST_DIGIT", 3)
    monkeypatch.setattr(exact_dedup, "GROWTH", 40)
    df = spark.createDataFrame(awkward, "doc_id long, text string")
    assert result(exact_dedup.exact_groups(df)) == brute(awkward)


def test_empty_table(spark):
    df = exact_dedup.exact_groups(spark.createDataFrame([], "doc_id long, text string"))
    assert df.collect() == [] and df.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def test_a_round_writes_two_files_a_task_at_most(spark, awkward, monkeypatch):
    tables, put = [], exact_dedup.Scratch.put
    monkeypatch.setattr(exact_dedup.Scratch, "put", lambda self, df, *split: tables.append(put(self, df, *split)) or tables[-1])
    df = spark.createDataFrame(awkward, "doc_id long, text string")
    assert result(exact_dedup.exact_groups(df)) == brute(awkward)
    files = [x for table in tables if "rest" in table.columns for x in table.inputFiles()]
    tasks = {(x.split("/")[-3], x.split("/")[-1].split("-")[1]) for x in files}  # table, task
    assert files and len(files) <= 2 * len(tasks)
    assert {x.split("/")[-2] for x in files} <= {"live=true", "live=false"}
