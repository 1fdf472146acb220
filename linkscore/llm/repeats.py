"""Removal of repeated passages by external induced sorting of suffixes.

A passage is any string of 400 bytes. Every position where one starts is assigned the anchor of the
passage: its 32-byte gram with the least hash, the first of equals. The choice depends on the passage
alone, so equal passages have equal anchors at the same place within them, and all their suffixes can
be compared at one alignment. A run of starts with one anchor and the bytes they span is a context.
Contexts with the same anchor gram form a class; only classes of two or more occurrences matter.

Equal contexts are counted first, with partial aggregates, and go on as one: their passages repeat.
The distinct contexts of a class are sorted by induction from the last aligned column to the first:
the order of the suffixes at a column, and their common prefixes, follow from those at the next column
by one pass through a priority queue on the preceding byte. Queue tuples are (byte, rank, context,
common prefix); the queue of a class beyond the memory limit lives in files, and so do its bytes. A
start repeats if the common prefix with a neighbour in its order reaches the length of a passage.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkscore.llm.keys import row_key
from linkscore.llm.passages import least_in_window, shared_words
from linkscore.llm.store import Scratch
from linkscore.llm.words import _BASE, _BASE_INVERSE, _powers, mixed, text_blocks

PASSAGE = 400
GRAM = 32
#: Contexts that one in-memory sort takes; a larger class is sorted in files.
MEMORY_CONTEXTS = 24_000

_WINDOW = PASSAGE - GRAM + 1
_COLUMNS = PASSAGE + _WINDOW - 1
_CHUNK = 1 << 20
_PLACE_BITS = 22


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    h, n = mixed(data.astype(np.uint64) + np.uint64(1)), 1
    while n < GRAM:
        right = h[n:]
        h = h[:-n] * np.uint64(0xC2B2AE3D27D4EB4F) + (right ^ (right >> np.uint64(29))) * np.uint64(0x165667B19E3779F9)
        n *= 2
    return mixed(h)


def _contexts(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Begin, starts, anchor place, anchor hash and digest of the contexts of adjoining texts."""
    if len(data) < PASSAGE:
        return tuple(np.empty(0, np.int64) for _ in range(5))
    grams = _gram_hashes(data)
    place = np.arange(len(grams), dtype=np.uint64)
    low = np.uint64((1 << _PLACE_BITS) - 1)
    anchor = (least_in_window((grams & ~low) | place, _WINDOW) & low).astype(np.int64)
    inside = np.zeros(len(anchor) + 1, np.int64)
    np.add.at(inside, np.clip(ends - PASSAGE + 1, 0, len(anchor)), 1)
    np.add.at(inside, np.clip(ends, 0, len(anchor)), -1)
    inside = np.cumsum(inside)[:-1] == 0
    cut = np.flatnonzero((anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1])) + 1
    begin, stop = np.concatenate(([0], cut)), np.concatenate((cut, [len(anchor)]))
    keep = inside[begin]
    begin, stop = begin[keep], stop[keep]
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(data)), out=prefix[1:])
    digest = mixed((prefix[stop + PASSAGE - 1] - prefix[begin]) * _powers(_BASE_INVERSE, len(data) + 1)[begin])
    at = anchor[begin]
    return begin, stop - begin, at - begin, grams[at].astype(np.int64), digest.astype(np.int64)


def text_contexts(texts: pa.Array) -> Iterator[tuple[np.ndarray, ...]]:
    """Row number, then as _contexts with begins counted from the text's first byte."""
    for first, n, data, offsets in text_blocks(texts):
        step = _CHUNK if n == 1 else len(data)
        for chunk in range(0, max(1, len(data) - PASSAGE + 1), step):  # a long text in overlapping chunks
            part = data[chunk : chunk + step + PASSAGE - 1]
            begin, *rest = _contexts(part, offsets[1:] - chunk)
            row = np.searchsorted(offsets, begin + chunk, "right") - 1
            yield first + row, begin + chunk - offsets[row], *rest


_FIELDS = ["begin", "starts", "shift", "class", "digest"]


def _anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, *values in text_contexts(batch.column(1)):
            arrays = [batch.column(0).take(pa.array(row)), *(pa.array(x.astype(np.int64)) for x in values)]
            yield pa.RecordBatch.from_arrays(arrays, names=["key", *_FIELDS])


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the wanted contexts of each text, which come as lists."""
    for batch in batches:
        for text, wanted in zip(batch.column(0), batch.column(1)):
            data, rows = (text.as_py() or "").encode(), wanted.as_py()
            if not rows:
                continue
            pieces = [data[x["begin"] : x["begin"] + x["starts"] + PASSAGE - 1] for x in rows]
            columns = [pa.array([x[k] for x in rows], pa.int64()) for k in ("class", "digest", "shift")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(pieces, pa.binary())], names=["class", "digest", "shift", "bytes"])


class ByteQueue:
    """A priority queue on the byte, first in first out within one, of tuples (context, common prefix).

    Beyond limit tuples each byte's queue moves to a file of the folder.
    """

    def __init__(self, folder: str, limit: int):
        self.folder, self.limit, self.held = folder, limit, 0
        self.memory: dict[int, list[np.ndarray]] = {}
        self.files: dict[int, object] = {}

    def push(self, byte: int, tuples: np.ndarray) -> None:
        self.memory.setdefault(byte, []).append(tuples)
        self.held += len(tuples)
        if self.held > self.limit:
            for k, parts in self.memory.items():
                if k not in self.files:
                    self.files[k] = tempfile.TemporaryFile(dir=self.folder)
                for part in parts:
                    self.files[k].write(part.tobytes())
            self.memory, self.held = {}, 0

    def pop(self) -> Iterator[np.ndarray]:
        """All tuples by byte, in blocks."""
        for byte in sorted({*self.memory, *self.files}):
            file = self.files.pop(byte, None)
            if file:
                file.seek(0)
                while block := file.read(8 * self.limit):
                    yield np.frombuffer(block, np.int32).reshape(-1, 2)
                file.close()
            yield from self.memory.pop(byte, [])


def _sorted_in_files(columns: np.ndarray, low: np.ndarray, high: np.ndarray, folder: str, limit: int, covered: np.ndarray) -> None:
    """The induction for one large class; columns and covered may lie in files."""
    queue = ByteQueue(folder, limit)
    for a in range(0, columns.shape[1], limit):
        ids = np.arange(a, min(a + limit, columns.shape[1]), dtype=np.int32)
        queue.push(0, np.column_stack((ids, np.zeros_like(ids))))
    for c in range(int(high.max()) - 1, int(low.min()) - 1, -1):
        following = ByteQueue(folder, limit)
        least = np.full(257, 0, np.int64)  # common prefix of each byte's last tuple with the present one
        last: dict[int, int] = {}
        for block in queue.pop():
            ids, lcp = block[:, 0], block[:, 1].astype(np.int64)
            present = (low[ids] <= c) & (c < high[ids])
            byte = np.where(present, columns[c][ids].astype(np.int64) + 1, 0)
            for b in np.unique(byte).tolist():
                at = np.flatnonzero(byte == b)
                new = np.zeros(len(at), np.int64)
                if b:
                    new[1:] = _range_min(lcp, at[:-1] + 1, at[1:] + 1)
                    new[0] = min(least[b], lcp[: at[0] + 1].min()) if b in last else -1
                    new = np.minimum(new + 1, PASSAGE)
                following.push(b, np.column_stack((ids[at], new)).astype(np.int32))
                if c < _WINDOW and b:
                    hit = new >= PASSAGE
                    covered[c, ids[at[hit]]] = True
                    covered[c, ids[at[np.flatnonzero(hit[1:])]]] = True
                    if hit[0]:
                        covered[c, last[b]] = True
                last[b] = int(ids[at[-1]])
            total = lcp.min()
            for b in last:
                here = np.flatnonzero(byte == b)
                if len(here):
                    least[b] = lcp[here[-1] + 1 :].min(initial=PASSAGE)
                else:
                    least[b] = min(least[b], total)
        queue = following


def _range_min(x: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Minima of x over [begin, end), for ends after their begins."""
    if not len(begin):
        return np.empty(0, x.dtype)
    order = np.argsort(-begin, kind="stable")
    index = np.empty(2 * len(begin), np.int64)
    index[0::2], index[1::2] = begin[order], end[order]
    padded = np.append(x, x.dtype.type(0))
    out = np.empty(len(begin), x.dtype)
    out[order] = np.minimum.reduceat(padded, index)[0::2]
    return out


def _sorted_in_memory(columns: np.ndarray, low: np.ndarray, high: np.ndarray, classes: np.ndarray, covered: np.ndarray) -> None:
    """The induction for many classes at once; contexts of a class adjoin."""
    n = len(classes)
    order, lcp = np.arange(n), np.zeros(n, np.int64)
    begins = np.concatenate(([True], classes[1:] != classes[:-1]))
    for c in range(int(high.max()) - 1, int(low.min()) - 1, -1):
        present = (low[order] <= c) & (c < high[order])
        byte = np.where(present, columns[c][order].astype(np.int64) + 1, 0)
        differ = np.concatenate(([False], (byte[1:] != byte[:-1]) & ~begins[1:]))
        if differ.any():
            mixed_classes = np.zeros(int(classes[-1]) + 1, bool)
            mixed_classes[classes[differ]] = True
            place = np.flatnonzero(mixed_classes[classes])
            keys = classes[place] * 257 + byte[place]
            perm = np.argsort(keys, kind="stable")
            key, old = keys[perm], place[perm]
            same = np.concatenate(([False], key[1:] == key[:-1]))
            new = np.full(len(place), -1, np.int64)
            after = np.flatnonzero(same)
            new[after] = _range_min(lcp, old[after - 1] + 1, old[after] + 1) if len(after) else 0
            order[place], byte[place], lcp[place] = order[old], byte[old], new
        lcp = np.where(begins | (byte == 0), 0, np.minimum(lcp + 1, PASSAGE))
        if c < _WINDOW:
            hit = lcp >= PASSAGE
            hit[:-1] |= hit[1:]
            covered[c, order[hit]] = True


def _rows(pieces: list[bytes], shifts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of contexts, a row each, at their aligned columns; first column and end of each."""
    low = _WINDOW - 1 - shifts
    high = low + np.array([len(x) for x in pieces])
    rows = np.zeros((len(pieces), _COLUMNS), np.uint8)
    for k, piece in enumerate(pieces):
        rows[k, low[k] : high[k]] = np.frombuffer(piece, np.uint8)
    return rows, low, high


class LargeClass:
    """A class of more contexts than the limit: its bytes, queues and verdicts lie in files."""

    def __init__(self, number: int, limit: int):
        self.number, self.limit, self.parts = number, limit, []
        self.place = tempfile.TemporaryDirectory()
        self.rows = open(f"{self.place.name}/rows", "wb")

    def add(self, digests: np.ndarray, shifts: np.ndarray, pieces: list[bytes]) -> None:
        rows, low, high = _rows(pieces, shifts)
        self.rows.write(rows.tobytes())
        self.parts.append((digests, low, high))

    def ranges(self) -> Iterator[pa.RecordBatch]:
        self.rows.close()
        digests, low, high = (np.concatenate(x) for x in zip(*self.parts))
        n, folder = len(digests), self.place.name
        rows = np.memmap(f"{folder}/rows", np.uint8, "r", shape=(n, _COLUMNS))
        columns = np.memmap(f"{folder}/columns", np.uint8, "w+", shape=(_COLUMNS, n))
        covered = np.memmap(f"{folder}/covered", bool, "w+", shape=(_WINDOW, n))
        for a in range(0, n, self.limit):
            columns[:, a : a + self.limit] = rows[a : a + self.limit].T
        _sorted_in_files(columns, low, high, folder, self.limit, covered)
        for a in range(0, n, self.limit):
            b = min(a + self.limit, n)
            yield _ranges(np.full(b - a, self.number), digests[a:b], low[a:b], high[a:b], np.array(covered[:, a:b]))
        del rows, columns, covered
        self.place.cleanup()


def _ranges(classes: np.ndarray, digests: np.ndarray, low: np.ndarray, high: np.ndarray, covered: np.ndarray) -> pa.RecordBatch:
    """Runs of repeated starts, counted from each context's first start."""
    edge = np.diff(np.pad(covered.T.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    which, begin = np.nonzero(edge == 1)
    end = np.nonzero(edge == -1)[1]
    columns = (classes[which], digests[which], begin - low[which], end - low[which])
    return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in columns], names=["class", "digest", "first", "last"])


def _small_classes(held: list[tuple]) -> pa.RecordBatch:
    classes, digests, shifts = (np.array([r[k] for r in held], np.int64) for k in range(3))
    rows, low, high = _rows([r[3] for r in held], shifts)
    covered = np.zeros((_WINDOW, len(held)), bool)
    number = np.concatenate(([0], np.cumsum(classes[1:] != classes[:-1])))
    _sorted_in_memory(np.ascontiguousarray(rows.T), low, high, number, covered)
    return _ranges(classes, digests, low, high, covered)


def _repeated(limit: int):
    """Reads contexts sorted by class; whole classes share a sort in memory while they fit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, begun, large = [], 0, None  # begun: where in held the last class begins
        for batch in batches:
            classes = batch.column("class").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(classes)) + 1).tolist(), len(classes)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                number, part = int(classes[a]), batch.slice(a, b - a)
                columns = [part.column(x) for x in ("digest", "shift", "bytes")]
                if large and large.number == number:
                    large.add(columns[0].to_numpy(), columns[1].to_numpy(), columns[2].to_pylist())
                    continue
                if large:
                    yield from large.ranges()
                    large = None
                if held and held[-1][0] != number:
                    if len(held) >= limit:
                        yield _small_classes(held)
                        held = []
                    begun = len(held)
                held += zip([number] * (b - a), *(x.to_pylist() for x in columns))
                if len(held) - begun > limit:
                    if begun:
                        yield _small_classes(held[:begun])
                    large = LargeClass(number, limit)
                    for k in range(begun, len(held), limit):
                        part = held[k : k + limit]
                        large.add(np.array([r[1] for r in part]), np.array([r[2] for r in part]), [r[3] for r in part])
                    held, begun = [], 0
        if large:
            yield from large.ranges()
        if held:
            yield _small_classes(held)

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = []
        for ranges in batch.column(1).to_pylist():
            runs: list[list[int]] = []
            for begin, end in sorted((x["begin"], x["end"]) for x in ranges):
                if runs and begin <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], end)
                else:
                    runs.append([begin, end])
            spans.append([{"begin": a, "end": b} for a, b in runs])
        kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], names=["key", "spans"])


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    memory_contexts: int = MEMORY_CONTEXTS,
    words: int | None = None,
) -> DataFrame:
    """One row per input row: id_col, n_bytes, spans, kept; with words also n_shared.

    spans are the maximal runs of bytes covered by some 400-byte string that also starts elsewhere in
    the table, as (begin, end); kept are the other bytes of the text, joined (UTF-8, where cuts may
    fall within a character). Null counts as the empty text, texts under 400 bytes have no span.
    Repeated rows, with equal ids or not, are documents of their own. Long texts are read whole, in
    overlapping chunks, and put together again in time linear in their length. An empty table gives an
    empty result; other columns are ignored.

    n_shared are the words of the text in strings of so many words that another row has too, which may
    be shorter than 400 bytes; they say nothing of what is removed.
    """
    scratch = Scratch(docs.sparkSession)
    key = row_key(id_col, text_col).alias("key")
    rows = docs.select(F.col(id_col).alias("id"), key, F.coalesce(text_col, F.lit("")).alias("text"))
    shared = shared_words(scratch, rows, words) if words else None
    found = scratch.put(
        rows.select("key", "text").mapInArrow(_anchored, "key binary, " + ", ".join(f"`{x}` long" for x in _FIELDS))
    )
    classes = scratch.put(found.groupBy("class").agg(F.count("*").alias("n")).filter("n > 1").select("class"))
    live = scratch.put(found.join(classes.hint("merge"), "class"))
    scratch.drop(found)
    place = F.min(F.struct("key", "begin", "starts", "shift")).alias("place")
    distinct = scratch.put(live.groupBy("class", "digest").agg(F.count("*").alias("n"), place))
    several = scratch.put(distinct.groupBy("class").agg(F.count("*").alias("n")).filter("n > 1").select("class"))
    ranges = _sorted_ranges(scratch, rows, distinct.join(several.hint("merge"), "class"), memory_contexts)
    whole = distinct.filter("n > 1").select(
        "class", "digest", F.lit(0).cast("long").alias("first"), F.col("place.starts").alias("last")
    )
    partly = ranges.join(distinct.filter("n = 1").select("class", "digest").hint("merge"), ["class", "digest"])
    repeated = scratch.put(whole.unionByName(partly))
    marks = (
        live.join(repeated.hint("merge"), ["class", "digest"])
        .select(
            "key",
            (F.col("begin") + F.col("first")).alias("begin"),
            (F.col("begin") + F.col("last") + (PASSAGE - 1)).alias("end"),
        )
        .distinct()
    )
    per_text = marks.groupBy("key").agg(F.collect_list(F.struct("begin", "end")).alias("ranges"))
    spans = scratch.put(per_text.mapInArrow(_merged, "key binary, spans array<struct<begin:long,end:long>>"))
    if shared:
        spans = spans.hint("merge").join(shared, "key", "full")
    return _without(rows, spans).withColumnRenamed("id", id_col)


def _sorted_ranges(scratch: Scratch, rows: DataFrame, contexts: DataFrame, limit: int) -> DataFrame:
    """(class, digest, first, last) start ranges that repeat within classes of several contexts."""
    wanted = scratch.put(
        contexts.select("class", "digest", "place.*")
        .groupBy("key")
        .agg(F.collect_list(F.struct("class", "digest", "begin", "starts", "shift")).alias("wanted"))
    )
    texts = rows.drop("id").join(wanted.hint("merge"), "key").dropDuplicates(["key"]).select("text", "wanted")
    pieces = texts.mapInArrow(_cut_out, "class long, digest long, shift long, bytes binary")
    dealt = pieces.repartition("class").sortWithinPartitions("class")
    return scratch.put(dealt.mapInArrow(_repeated(limit), "class long, digest long, first long, last long"))


def _without(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """The texts joined with their spans, and what the spans leave."""
    joined = rows.join(spans.hint("merge"), "key", "left")
    data = F.col("text").cast("binary")
    n_bytes = F.octet_length("text").cast("long")
    # What lies between the spans, each part copied once; as hex digits, since cuts may fall within a character.
    begins = F.concat(F.array(F.lit(0).cast("long")), F.col("spans.end"))
    ends = F.concat(F.col("spans.begin"), F.array(n_bytes))
    parts = F.zip_with(begins, ends, lambda a, b: F.hex(F.substring(data, (a + 1).cast("int"), (b - a).cast("int"))))
    left = F.unhex(F.array_join(parts, ""))
    none = F.array().cast("array<struct<begin:long,end:long>>")
    n_shared = [F.coalesce("n_shared", F.lit(0)).cast("long").alias("n_shared")] if "n_shared" in spans.columns else []
    return joined.select(
        "id",
        n_bytes.alias("n_bytes"),
        F.coalesce("spans", none).alias("spans"),
        F.when(F.col("spans").isNull(), data).otherwise(left).alias("kept"),
        *n_shared,
    )
