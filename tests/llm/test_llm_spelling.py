"""Spelling variants against brute force."""

import re
import zlib
from collections import Counter

from conftest import SF, rows

from linkscore.llm import spelling
from linkscore.llm.queries import op13_spelling

SCHEMA = "doc_id long, text string"
COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def lower(text):
    return "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text)


def expected(docs, every=97, min_length=5, min_count=3):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    known = {w: n for w, n in counts.items() if n >= min_count and len(w) >= min_length}
    letters = sorted(set("".join(known)))

    def near(w):
        cuts = [(w[:i], w[i:]) for i in range(len(w) + 1)]
        made = {a + b[1:] for a, b in cuts} | {a + x + b for a, b in cuts for x in letters}
        made |= {a + x + b[1:] for a, b in cuts if b for x in letters}
        return [x for x in made if x in known and x != w]

    forms, count = {}, {}
    for w, n in known.items():
        found = near(w)
        count[w] = len(found)
        best = min(found, key=lambda x: (-known[x], x), default=None)
        forms[w] = best if best and known[best] >= 2 * n else None
    out = []
    for w, n in known.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, n, count[w], known.get(forms[w])))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def test_equals_brute_force_on_the_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert found(op13_spelling(spark, SF)) == expected(docs)


def test_runs_of_equal_letters_chains_and_ties(spark):
    counts = {"aaaaa": 3, "aaaaaa": 7, "aaaaaaa": 20, "abcde": 4, "abcdf": 4, "abcdg": 9, "bcde": 50, "abcdeé": 9, "ÀBCDE": 30}
    docs = [(k, " ".join([w] * n)) for k, (w, n) in enumerate(counts.items())]
    for every in (97, 2, 1 << 40):
        got = found(spelling.variant_groups(spark.createDataFrame(docs, SCHEMA), every=every))
        assert got == expected(docs, every)
    got = {r[0]: r for r in got}
    assert got["aaaaa"][1:3] == ("aaaaaa", "aaaaaaa") and got["Àbcde"][0] == "Àbcde"


def test_does_not_depend_on_partitioning(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert rows(spelling.variant_groups(docs.repartition(1))) == rows(spelling.variant_groups(docs.repartition(23, "text")))


def test_nulls_repeats_long_words_and_clashing_columns(spark):
    long = "ab" * 20_000
    docs = [(None, "Stone stone STONE"), (1, None), (1, ""), (2, f"{long} {long} {long}é {long}é"), (2, f"{long} {long}é {long}é")]
    docs += [(7, "stones stonés stones’ Ωstones stones")] * 3
    frame = spark.createDataFrame([(*d, "x", 1, 2) for d in docs], f"{SCHEMA}, word string, n int, id int")
    got = found(spelling.variant_groups(frame))
    short = [d for d in docs if not (d[1] or "").startswith("abab")]
    assert [r for r in got if len(r[0]) < 100] == expected(short)
    assert {(len(r[0]), r[4]) for r in got if len(r[0]) > 100} <= {(40_000, 1), (40_001, 1), (39_999, 0), (40_000, 0)}


def test_empty_table(spark):
    out = spelling.variant_groups(spark.createDataFrame([], SCHEMA))
    assert out.columns == COLUMNS and out.count() == 0
