import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from conftest import SF
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from linkscore.llm import packing as K

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", "a<|endoftext|>b <|startoftext|>", "İstanbul Σας ΣΑΣ x\x1cy z w   don't I'LL we'VE '", "½²µªº ÀÉÈ ß ﬁ é 中文 🙂🙂 a_b-c 12345",
    "\x00 \x7f\x80\x85t ﻿", "\t\n  ", "<| x", "S'S 's'T", "a\x0bb\x0cc​d", "a b c d　e\x85f᠎g", "ŠĐ x. y, .,. .",
]


def brute_rooms(lengths, context):
    rooms, before = [], []
    for length in lengths:
        fits = [k for k, r in enumerate(rooms) if r >= length]
        k = min(fits, key=lambda j: rooms[j]) if fits else len(rooms)
        if not fits:
            rooms.append(context)
        before.append(rooms[k])
        rooms[k] -= length
    return before


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), max_size=60))))
def test_best_fit_takes_the_tightest_window(case):
    context, lengths = case
    lengths = sorted(lengths, reverse=True)
    window, offset = K.best_fit(np.array(lengths, np.int64), context)
    assert (context - offset).tolist() == brute_rooms(lengths, context)
    used = defaultdict(int)
    for w, o, n in zip(window, offset, lengths):
        assert used[w] == o
        used[w] += n
    assert all(n <= context for n in used.values())


def test_ids_equal_the_tokenizer(spark):
    encode, tokenizer = K.word_encoder(PATH), Tokenizer.from_file(PATH)
    given_texts = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    for text in ODD + given_texts:
        assert encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_pieces_cover_all_ids(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    rows = [(r["doc_id"], r["text"], 1, "s") for r in docs]
    rows += [(1000, None, 1, "s"), (1001, "", 1, "s"), (1002, "word " * 9000, 1, "s"), (1003, "again", 1, "s"), (1003, "again", 1, "s"), (None, "x", 1, "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard int, length string")
    pieces = K.pack(df, PATH, shard_pieces=60).collect()
    tokenizer = Tokenizer.from_file(PATH)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
    for doc_id, text, *_ in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        mine = sorted(by_doc[doc_id], key=lambda p: p["start"])
        copies = 2 if doc_id == 1003 else 1
        assert sum(p["length"] for p in mine) == copies * len(ids)
        for p in mine:
            cut = ids[p["start"] : p["start"] + p["length"]]
            assert p["ids_crc32"] == zlib.crc32(cut.tobytes()) and p["doc_tokens"] == len(ids)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096


def test_one_shard_wastes_little(spark):
    df = K.pack(spark.read.parquet(f"{SF}/documents.parquet"), PATH)
    tokens, sequences = df.selectExpr("sum(length)", "count(distinct sequence_id)").first()
    assert sequences == -(-tokens // 4096)


def test_empty_table(spark):
    assert K.pack(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []
