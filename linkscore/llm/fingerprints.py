"""Document fingerprints: threshold-scaled sketches of word shingles.

A text's fingerprint holds the hash of every shingle (five words in a row) that lies below a fixed
fraction of the hash range. The fraction is the same for all texts, so a fingerprint is a sample of the
shingles at one rate whatever the length: two of them give an estimate of likeness or of containment
between texts of very unequal length, and the union of fingerprints is the fingerprint of the union.
A text none of whose hashes lies below the limit keeps its least one, so only texts without words have
an empty fingerprint; of a union the hashes above the limit go as soon as there is one below.

As text a fingerprint is the base64 form of its hashes, 48 bits each, in order.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkscore.llm.words import mixed, separated, text_blocks, word_hashes

FRACTION = 1 / 8
SHINGLE_WORDS = 5
HASH_BYTES = 6

#: Rows of a chunk of neighbours, and the most chunks whose bounds the driver holds.
CHUNK_ROWS = 1000
MAX_CHUNKS = 100_000

_SHIFT = np.uint64(64 - 8 * HASH_BYTES)


def limit(fraction: float) -> int:
    """Hashes below this are kept."""
    return int(fraction * (1 << 8 * HASH_BYTES))


def _kept(hashes: np.ndarray, below: int) -> np.ndarray:
    low = hashes[hashes < below]
    return np.unique(low) if len(low) else hashes.min(keepdims=True) if len(hashes) else hashes


def _folded(words: np.ndarray, count: int) -> np.ndarray:
    """Hashes of the shingles of so many words."""
    h = np.zeros(max(len(words) - count + 1, 0), np.uint64)
    for k in range(count):
        h = mixed(h + words[k : k + len(h)] + np.uint64(k + 1))
    return h >> _SHIFT


def sketches(texts: pa.Array, fraction: float = FRACTION, words: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """The fingerprint of each text as sorted hashes. A text of fewer words is one shingle; null is empty."""
    below, out = limit(fraction), []
    for _, count, data, offsets in text_blocks(texts):
        data, begins = separated(data, offsets)
        starts, _, hashes = word_hashes(data)
        first = np.searchsorted(starts, begins)
        shingles = _folded(hashes, words)
        for a, b in zip(first[:count], first[1:]):
            of_text = shingles[a : b - words + 1] if b - a >= words else _folded(hashes[a:b], int(b - a))[: b - a]
            out.append(_kept(of_text, below))
    return out


def packed(sketch: np.ndarray) -> str:
    """A fingerprint as text."""
    wide = sketch.astype(">u8").view(np.uint8).reshape(-1, 8)
    return base64.b64encode(wide[:, 8 - HASH_BYTES :].tobytes()).decode()


def unpacked(text: str) -> np.ndarray:
    """The sorted hashes of a fingerprint."""
    narrow = np.frombuffer(base64.b64decode(text), np.uint8).reshape(-1, HASH_BYTES)
    wide = np.zeros((len(narrow), 8), np.uint8)
    wide[:, 8 - HASH_BYTES :] = narrow
    return wide.reshape(-1).view(">u8").astype(np.uint64)


def merge(a: np.ndarray, b: np.ndarray, fraction: float = FRACTION) -> np.ndarray:
    """The fingerprint of both texts' shingles together."""
    return _kept(np.union1d(a, b), limit(fraction))


def _common(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    return int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard similarity of the shingles; 1 for two empty fingerprints."""
    common = _common(a, b)
    both = len(a) + len(b) - common
    return common / both if both else 1.0


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of a's shingles that b holds; 1 for an empty a."""
    return _common(a, b) / len(a) if len(a) else 1.0


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fraction: float = FRACTION, words: int = SHINGLE_WORDS
) -> DataFrame:
    """One row per row: id_col and fingerprint.

    Whole texts of any length count; null and empty texts and those without a word have the empty
    fingerprint. Repeated rows and ids are rows of their own, an empty table gives an empty result and
    other columns are not read. Equal texts have equal fingerprints.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([packed(s) for s in sketches(batch.column(1), fraction, words)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), found], names=["id", "fingerprint"])

    schema = f"id {rows.schema['id'].dataType.simpleString()}, fingerprint string"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def merged(found: DataFrame, by: str, fraction: float = FRACTION) -> DataFrame:
    """(by, hash): the fingerprint of each group's texts together, a row per hash; ``found`` has by and
    fingerprint. A group without a word has no row; null is a group of its own."""
    data = F.unbase64("fingerprint")
    places = F.when(F.octet_length(data) > 0, F.sequence(F.lit(0), (F.octet_length(data) / HASH_BYTES).cast("int") - 1))
    one = lambda i: F.conv(F.hex(F.substring(data, i * HASH_BYTES + 1, F.lit(HASH_BYTES))), 16, 10)
    hashes = found.select(F.col(by).alias("by"), F.explode(F.transform(places, one)).alias("hash"))
    hashes = hashes.select("by", F.col("hash").cast("bigint"))
    low = hashes.where(F.col("hash") < limit(fraction)).distinct()
    least = hashes.groupBy("by").agg(F.min("hash").alias("hash")).where(F.col("hash") >= limit(fraction))
    return low.unionByName(least).withColumnRenamed("by", by)


def overlaps(left: DataFrame, right: DataFrame, left_by: str, right_by: str) -> DataFrame:
    """(left, right, common, contained): for two tables from :func:`merged`, the estimated share of the
    left group's shingles that the right one holds, for groups with one in common."""
    a, b = left.withColumnRenamed(left_by, "left"), right.withColumnRenamed(right_by, "right")
    sizes = a.groupBy("left").agg(F.count("*").alias("size"))
    common = a.join(b, "hash").groupBy("left", "right").agg(F.count("*").alias("common"))
    joined = common.join(sizes.withColumnRenamed("left", "of"), F.col("left").eqNullSafe(F.col("of")))
    return joined.select("left", "right", "common", (F.col("common") / F.col("size")).alias("contained"))


def _order(known: bool, value, tie: int) -> tuple:
    return (True, value, tie) if known else (False, tie)


def chunk_bounds(keys: DataFrame, chunks: int) -> list[tuple]:
    """The last key (id, tie) of each of about so many ranges of the rows, in order."""
    dealt = keys.repartitionByRange(chunks, "id", "tie")
    last = F.max(F.struct(F.col("id").isNotNull().alias("known"), "id", "tie")).alias("last")
    found = dealt.groupBy(F.spark_partition_id().alias("part")).agg(last).collect()
    return sorted({_order(*r["last"]) for r in found})


def next_texts(
    docs: DataFrame,
    use: Callable[[Sequence[str], Sequence[str]], list[pa.Array]],
    schema: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """id_col and the columns of ``schema``, which ``use`` makes of each text and the text of the next row.

    Rows follow each other by descending id, after the last comes the first. Equal ids are ordered by a
    hash of the text and the text, null ids come last. The rows are cut into chunks at keys that exist,
    and the row that follows a chunk is sent along with it, so the texts are moved once.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    kind = rows.schema["id"].dataType.simpleString()
    chunks = min(max(-(-rows.count() // chunk_rows), 1), MAX_CHUNKS)
    bounds = chunk_bounds(rows.select("id", "tie"), chunks)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            take, chunk, after = [], [], []
            for k, (value, tie) in enumerate(zip(batch.column("id").to_pylist(), batch.column("tie").to_pylist())):
                key = _order(value is not None, value, tie)
                # Bounds are the rows' own keys, so none lies beyond the last.
                at = min(bisect_left(bounds, key), len(bounds) - 1)
                take.append(k)
                chunk.append(at)
                after.append(False)
                if bounds[at] == key:
                    take.append(k)
                    chunk.append((at + 1) % len(bounds))
                    after.append(True)
            held = batch.take(pa.array(take, pa.int64()))
            columns = [pa.array(chunk, pa.int32()), pa.array(after, pa.bool_()), *held.columns]
            yield pa.RecordBatch.from_arrays(columns, names=["chunk", "after", *held.schema.names])

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row so far, as (id, text, chunk, after)
        for batch in batches:
            ids, texts = batch.column("id"), batch.column("text").to_pylist()
            chunk, after = batch.column("chunk").to_pylist(), batch.column("after").to_pylist()
            if held is not None:
                ids = pa.concat_arrays([held[0], ids])
                texts, chunk, after = [held[1], *texts], [held[2], *chunk], [held[3], *after]
            own = [k for k in range(len(texts) - 1) if not after[k] and chunk[k] == chunk[k + 1]]
            if own:
                made = use([texts[k] for k in own], [texts[k + 1] for k in own])
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(own, pa.int64())), *made], names=names)
            held = (ids[-1:], texts[-1], chunk[-1], after[-1]) if len(texts) else held

    names = ["id", *(x.split()[0] for x in schema.split(","))]
    dealt = rows.mapInArrow(deal, f"chunk int, after boolean, id {kind}, text string, tie long")
    placed = dealt.repartition("chunk").sortWithinPartitions("chunk", "after", F.desc("id"), F.desc("tie"), F.desc("text"))
    return placed.mapInArrow(pairs, f"id {kind}, {schema}").withColumnRenamed("id", id_col)


EDITED = (
    "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double,"
    " held_by_edited double, held_by_next double"
)


def edited_fingerprints(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    fraction: float = FRACTION,
    words: int = SHINGLE_WORDS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Each text's fingerprint held against that of its edited form and of the next text.

    The edited text has the last half of its code points replaced by the first as many, or all, of the
    next document by descending id (of the first after the last). Columns: id_col, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next (estimated Jaccard
    similarity), held_by_edited and held_by_next (estimated share of the text's shingles that the other
    holds).

    One row per row; a null text is empty, a lone row is its own next one. Of equal ids the order is by
    content, null ids come last; equal rows of one id are alike, and all but the last have their like as
    the next document. Texts of any length count whole, an empty table gives an empty result and other
    columns are not read.
    """

    def use(texts: Sequence[str], nexts: Sequence[str]) -> list[pa.Array]:
        edits = [a[: len(a) - len(a) // 2] + b[: len(a) // 2] for a, b in zip(texts, nexts)]
        # Texts stand in a row after each other: a next text mostly is the following text.
        known = sketches(pa.array([*texts, nexts[-1]], pa.string()), fraction, words)
        own, edited = known[:-1], sketches(pa.array(edits, pa.string()), fraction, words)
        follow = [
            known[k + 1] if k + 1 == len(texts) or nexts[k] == texts[k + 1] else sketches(pa.array([nexts[k]]), fraction, words)[0]
            for k in range(len(texts))
        ]
        numbers = [(likeness(a, e), likeness(a, f), containment(a, e), containment(a, f)) for a, e, f in zip(own, edited, follow)]
        return [
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edits], pa.string()),
            pa.array([packed(s) for s in own], pa.string()),
            pa.array([packed(s) for s in edited], pa.string()),
            *(pa.array(column, pa.float64()) for column in zip(*numbers)),
        ]

    return next_texts(docs, use, EDITED, id_col, text_col, chunk_rows)
