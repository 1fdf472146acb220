"""Words of each text in passages that another row holds too.

A passage is any string of a given number of words, whatever white space lies between them. Every word where
one starts is assigned the anchor of the passage: its 8-word gram with the least hash, the first of equals.
The choice depends on the passage alone. A run of starts with one anchor is a context, contexts with the same
anchor gram form a class, and only classes found in two or more rows matter. Contexts that two or more rows
hold go on as one: their passages are shared. Where a class has several contexts, their passages are counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkscore.llm.store import Scratch
from linkscore.llm.words import _BASE, _BASE_INVERSE, _powers, mixed, separated, text_blocks, word_hashes

GRAM = 8
#: The most words of a passage, so that the starts of a context fit the bits of a long.
LONGEST = 64 + GRAM - 1

_CHUNK = 1 << 20
_TEXTS = 500  # whose marks are spread out at a time
_PLACE_BITS = 22


def least_in_window(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values, from minima to the left and right within blocks of w."""
    blocks = np.full(-(-len(x) // w) * w, np.iinfo(np.uint64).max, np.uint64)
    blocks[: len(x)] = x
    blocks = blocks.reshape(-1, w)
    to_here = np.minimum.accumulate(blocks, 1).ravel()
    from_here = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    n = len(x) - w + 1
    return np.minimum(from_here[:n], to_here[w - 1 : w - 1 + n])


def _strings(h: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the strings of words from begin to end."""
    prefix = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * _powers(_BASE, len(h)), out=prefix[1:])
    return mixed((prefix[end] - prefix[begin]) * _powers(_BASE_INVERSE, len(h) + 1)[begin]).astype(np.int64)


def _contexts(h: np.ndarray, row: np.ndarray, words: int) -> tuple[np.ndarray, ...]:
    """First start, number of starts, class and digest of the contexts; row has each word's text."""
    if len(h) < words:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    grams, n = mixed(h), 1
    while n < GRAM:
        right = grams[n:]
        grams = grams[:-n] * np.uint64(0xC2B2AE3D27D4EB4F) + (right ^ (right >> np.uint64(29))) * np.uint64(0x165667B19E3779F9)
        n *= 2
    grams = mixed(grams)
    low = np.uint64((1 << _PLACE_BITS) - 1)
    place = np.arange(len(grams), dtype=np.uint64)
    anchor = (least_in_window((grams & ~low) | place, words - GRAM + 1) & low).astype(np.int64)
    inside = row[: len(anchor)] == row[words - 1 :]
    cut = np.flatnonzero((anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1])) + 1
    begin, stop = np.concatenate(([0], cut)), np.concatenate((cut, [len(anchor)]))
    begin, stop = begin[inside[begin]], stop[inside[begin]]
    return begin, stop - begin, grams[anchor[begin]].astype(np.int64), _strings(h, begin, stop + words - 1)


def _is_first(*columns: np.ndarray) -> np.ndarray:
    """Whether no earlier row has the same values."""
    order = np.lexsort(columns[::-1])
    new = np.ones(len(order), bool)
    new[1:] = np.any([x[order][1:] != x[order][:-1] for x in columns], axis=0) if len(order) else new[1:]
    first = np.empty(len(order), bool)
    first[order] = new
    return first


def _anchored(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n, data, offsets in text_blocks(batch.column(1)):
                data, begins = separated(data, offsets)
                starts, _, h = word_hashes(data)
                row = np.searchsorted(begins, starts, "right") - 1
                found = []
                for a in range(0, max(1, len(h) - words + 1), _CHUNK):  # many words in overlapping chunks
                    b = a + _CHUNK + words - 1
                    begin, *rest = _contexts(h[a:b], row[a:b], words)
                    found.append((begin + a, *rest))
                begin, count, number, digest = (np.concatenate(x) for x in zip(*found))
                if not len(begin):
                    continue
                text = row[begin]
                arrays = [
                    batch.column(0).take(pa.array(first + text)),
                    pa.array(number),
                    pa.array(digest),
                    pa.array(begin - np.searchsorted(row, text)),
                    pa.array(count),
                    pa.array(_is_first(text, number).astype(np.int64)),
                    pa.array(_is_first(text, number, digest).astype(np.int64)),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["key", "class", "digest", "begin", "starts", "new_class", "new"])

    return run


def _passages(words: int):
    """The passages of the wanted contexts of each text, with how many rows a context stands for: a text's own count once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, wanted in zip(batch.column(0), batch.column(1)):
                data = np.frombuffer((text.as_py() or "").encode(), np.uint8)
                h = word_hashes(data)[2]
                number, digest, begin, starts, whole = (x.to_numpy(zero_copy_only=False) for x in wanted.values.flatten())
                which = np.repeat(np.arange(len(starts)), starts)
                at = np.arange(len(which)) - np.repeat(np.cumsum(starts) - starts, starts)
                passage = _strings(h, begin[which] + at, begin[which] + at + words)
                number, whole = number[which], whole[which]
                weight = np.where(whole, 2, _is_first(whole, number, passage)).astype(np.int64)
                columns = [number, digest[which], at, passage, weight]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["class", "digest", "at", "passage", "weight"])

    return run


def _covered(words: int):
    """The number of words in the shared passages of each text."""

    at = np.arange(words - GRAM + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(a, _TEXTS) for a in range(0, len(batch), _TEXTS)):
                lists = part.column(1)
                text = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
                begin, starts, mask = (x.to_numpy() for x in lists.flatten().flatten())
                which, after = np.nonzero(((mask[:, None] >> at) & 1).astype(bool) & (at < starts[:, None]))
                text, begin = text[which], begin[which] + after
                order = np.lexsort((begin, text))
                text, begin = text[order], begin[order]
                step = np.full(len(text), words)
                same = text[1:] == text[:-1]
                step[:-1][same] = np.minimum(words, np.diff(begin)[same])
                n = np.bincount(text, step, len(lists)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n)], names=["key", "n_shared"])

    return run


def shared_words(scratch: Scratch, rows: DataFrame, words: int) -> DataFrame:
    """Key and n_shared of each text with a passage that another row has too: its words in such passages.

    rows are key and text, equal keys for equal texts only. Equal rows share their passages; null has none.
    """
    if not GRAM <= words <= LONGEST:
        raise ValueError(f"a passage has {GRAM} to {LONGEST} words")
    schema = "key binary, class long, digest long, begin long, starts long, new_class long, new long"
    found = scratch.put(rows.select("key", "text").mapInArrow(_anchored(words), schema))
    classes = scratch.put(found.groupBy("class").agg(F.sum("new_class").alias("n")).filter("n > 1").select("class"))
    live = scratch.put(found.join(classes.hint("merge"), "class").drop("new_class"))
    scratch.drop(found)
    place = F.min(F.struct("key", "begin", "starts")).alias("place")
    distinct = scratch.put(live.groupBy("class", "digest").agg(F.sum("new").alias("n"), place))
    several = scratch.put(distinct.groupBy("class").agg(F.count("*").alias("n")).filter("n > 1").select("class"))
    wanted = scratch.put(
        distinct.join(several.hint("merge"), "class")
        .select("class", "digest", "place.*", (F.col("n") > 1).alias("whole"))
        .groupBy("key")
        .agg(F.collect_list(F.struct("class", "digest", "begin", "starts", "whole")).alias("wanted"))
    )
    texts = rows.select("key", "text").join(wanted.hint("merge"), "key").dropDuplicates(["key"]).select("text", "wanted")
    passages = scratch.put(
        texts.mapInArrow(_passages(words), "class long, digest long, at long, passage long, weight long")
    )
    shared = passages.groupBy("class", "passage").agg(F.sum("weight").alias("n")).filter("n > 1").select("class", "passage")
    bit = F.expr("shiftleft(1L, cast(at AS int))")
    partly = (
        passages.filter("weight < 2")
        .join(shared.hint("merge"), ["class", "passage"])
        .groupBy("class", "digest")
        .agg(F.bit_or(bit).alias("mask"))
    )
    whole = distinct.filter("n > 1").select("class", "digest", F.lit(-1).cast("long").alias("mask"))
    repeated = scratch.put(whole.unionByName(partly))
    marks = live.join(repeated.hint("merge"), ["class", "digest"])
    per_text = marks.groupBy("key").agg(F.collect_list(F.struct("begin", "starts", "mask")).alias("marks"))
    out = scratch.put(per_text.mapInArrow(_covered(words), "key binary, n_shared long"))
    for table in (classes, live, distinct, several, wanted, passages, repeated):
        scratch.drop(table)
    return out
