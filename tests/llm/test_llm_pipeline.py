import re
from collections import Counter, defaultdict

import corpus_pipeline
import duckdb
import public_tokenizers
import pytest
from conftest import SF
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from linkscore.llm import ngram_join
from linkscore.llm import queries as Q
from linkscore.llm.store import Scratch


@pytest.fixture(scope="module")
def stages(spark):
    scratch, docs, out = Scratch(spark), spark.read.parquet(f"{SF}/documents.parquet"), {}
    out["input"] = docs
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = scratch.put(stage(spark, docs, SF))
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_all_but_the_last_return_the_columns_of_documents(stages):
    for name in [n for n, _ in corpus_pipeline.STAGES][:-1]:
        assert stages[name].schema.simpleString() == stages["input"].schema.simpleString()


def test_language_keeps_clean_documents(stages):
    assert stages["language"].count() >= 0.99 * stages["input"].count()


def test_one_of_each_equal_text_stays(stages):
    least = {}
    for doc_id, text in sorted(texts(stages["language"]).items()):
        least.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text), doc_id)
    assert set(texts(stages["exact_dedup"])) == set(least.values())


def test_one_of_each_near_class_stays(stages):
    given, kept = texts(stages["exact_dedup"]), set(texts(stages["near_dedup"]))
    sets = {}
    for doc_id, text in given.items():
        words = text.split()
        sets[doc_id] = frozenset(zip(*(words[k:] for k in range(5)))) or frozenset([tuple(words)])
    near, at = defaultdict(set), defaultdict(list)
    for doc_id, s in sets.items():
        for x in s:
            at[x].append(doc_id)
    for a, s in sets.items():
        for b, common in Counter(d for x in s for d in at[x]).items():
            if a != b and common >= 0.8 * (len(s) + len(sets[b]) - common) - 1e-9:
                near[a].add(b)
    seen, expected = set(), set()
    for doc_id in sorted(given):
        if doc_id not in seen:
            expected.add(doc_id)
            front = [doc_id]
            while front:
                x = front.pop()
                if x not in seen:
                    seen.add(x)
                    front += near[x]
    assert kept == expected


def test_the_mix_takes_every_document(stages):
    times = {r["doc_id"]: r["count"] for r in stages["mixing"].groupBy("doc_id").count().collect()}
    assert set(times) == set(texts(stages["near_dedup"])) and set(times.values()) <= {1, 2}


def test_packing_holds_all_tokens(stages):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = sum(len(tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1 for r in stages["mixing"].collect())
    assert stages["packing"].agg(F.sum("length")).first()[0] == expected


def test_stages_take_awkward_rows(spark):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "the words of a text and", "en", "s", 9), (1, "the words of a text and", "en", None, 9), (None, "the words of a text and", None, None, 9), (3, "the word " * 60_000, "en", "s", 9)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, `row` long, key string, node int"
    for given in (spark.createDataFrame([(*r, 1, "k", 2) for r in rows], schema), spark.createDataFrame([], schema)):
        docs = given
        counts = []
        for name, stage in corpus_pipeline.STAGES:
            docs = Scratch(spark).put(stage(spark, docs, SF))
            counts.append(docs.count())
            assert name == "packing" or docs.columns == given.columns
        # The null and the empty text go; of the three equal texts one stays.
        assert counts[:3] == ([4, 2, 2] if given.count() else [0, 0, 0])


@pytest.mark.parametrize("ids", [[None] * 6, [4] * 6, [None, 4, 4, 9, None, 4]])
def test_one_of_near_copies_with_null_or_repeated_ids_stays(spark, ids):
    first, second = (" ".join(f"{c}{k}" for k in range(100)) for c in "ab")
    near = [first, first + " x", first + " y", first + " z", second, second + " x"]
    rows = [(d, t, "en", "s", 9) for d, t in zip(ids, near)] + [(None, "words that stand alone here", "en", "s", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.without_near_copies(spark, docs.repartition(3), SF).collect()
    assert sorted(r["text"][0] for r in kept) == ["a", "b", "w"]
    # Of a class the least id stays, null last.
    least = [min((d for d in group if d is not None), default=None) for group in (ids[:4], ids[4:])]
    assert [r["doc_id"] for r in sorted(kept, key=lambda r: r["text"])] == [*least, None]
    found = ngram_join.near_classes(docs).collect()
    assert len({r["class_key"] for r in found}) == 3


@pytest.fixture(scope="module")
def found(spark):
    return {name: q(spark, SF).toPandas() for name, q in Q.QUERIES.items()}


COLUMNS = {
    "op3_repeats": {"doc_id": "int64", "n_bytes": "int64", "n_removed": "int64", "n_spans": "int64", "kept_sha256": "object"},
    "op4_packing": dict.fromkeys(["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"], "int64"),
    "op5_language": {"doc_id": "int64", "held_out": "bool", "lang_pred": "object", "score": "float64"},
    "op6_quality_rules": {"doc_id": "int64", "n_words": "int64", "word_chars": "int64", "n_symbols": "int64", "n_dup_lines": "int64", "n_repeat_words": "int64", "base_failed": "bool", "kept": "bool"},
    "op8_exact_dedup": {"doc_id": "int64", "keep_id": "int64", "group_size": "int64", "kept": "bool", "text_sha256": "object"},
    "op10_secret_scan": {"doc_id": "int64", "n_assign": "int64", "n_access": "int64", "n_hex": "int64", "base_sha256": "object", "spans": "object"},
}


def test_columns_are_as_agreed(found):
    for name, columns in COLUMNS.items():
        kinds = found[name].dtypes.astype(str).to_dict()
        assert {c: kinds[c].replace("string", "object").replace("str", "object") for c in columns} == columns, name
        assert name in ("op2_mixing", "op4_packing") or len(found[name]) == 200


@pytest.mark.parametrize("name", list(Q.ORACLES))
def test_query_equals_oracle(found, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    expected = con.sql(Q.ORACLES[name]).df()
    columns = sorted(expected.columns)
    rows = [sorted(map(str, x[columns].itertuples(index=False, name=None))) for x in (found[name], expected)]
    assert sorted(found[name].columns) == columns and rows[0] == rows[1]
