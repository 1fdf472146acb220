"""Packing token sequences: best-fit decreasing with a segment tree over remaining capacities.

Texts are tokenized whole. An overlong document is first cut into full windows; its rest and the
short documents are placed longest first, each into the tightest open window that still has room,
found in a segment tree indexed by remaining capacity. Pieces are light rows (no text, no ids), dealt
over shards by a hash; a shard packs on its own, so no task holds more than a shard's pieces.
"""

from __future__ import annotations

import zlib
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkscore.llm.store import Scratch

CONTEXT = 4096
END_OF_DOCUMENT = 2
#: Pieces of a shard on average. A shard wastes at most about one window, so larger is denser.
SHARD_PIECES = 50_000
CACHED_WORDS = 200_000
CACHED_PARTS = 400_000

# Words of these characters are lower-cased, split and cached here just as the tokenizer does it;
# all others, and those that may hold a special token, go to the tokenizer whole.
_PLAIN = regex.compile(r"[!-~¡-ÿ]+")
_PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_CHARS = dict(zip(_SHOWN, map(chr, _SHOWN))) | {
    b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in set(_SHOWN))
}


def word_encoder(path: str) -> Callable[[str], np.ndarray]:
    """Ids of a text under a word-wise BPE tokenizer file, equal to its encode without special tokens added.

    White space never enters a token, so words are encoded one by one and remembered.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    words: dict[str, bytes] = {}
    parts: dict[str, bytes] = {}

    def part_ids(part: str) -> bytes:
        ids = parts.get(part)
        if ids is None:
            shown = part if part.isascii() else "".join(_BYTE_CHARS[b] for b in part.encode())
            ids = array("I", [x.id for x in tokenizer.model.tokenize(shown)]).tobytes()
            if len(parts) < CACHED_PARTS:
                parts[part] = ids
        return ids

    def word_ids(word: str) -> bytes:
        lower, body = word.lower(), word[:-1]
        if word.isascii() and word.isalpha():
            ids = part_ids(lower)
        elif word[-1] in ".," and body.isascii() and body.isalpha():
            ids = part_ids(lower[:-1]) + part_ids(word[-1])
        elif "<|" not in word and _PLAIN.fullmatch(word):
            ids = b"".join(map(part_ids, _PARTS.findall(lower)))
        else:
            ids = np.array(tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        if len(words) < CACHED_WORDS:
            words[word] = ids
        return ids

    def encode(text: str) -> np.ndarray:
        get = words.get
        found = [get(w) or word_ids(w) for w in _split(text)]
        return np.frombuffer(b"".join(found), "<u4")

    return encode


def _split(text: str) -> list[str]:
    # str.split() also splits at four control characters that are no white space to the tokenizer.
    if any(x in text for x in "\x1c\x1d\x1e\x1f"):
        return _WORD.findall(text)
    return text.split()


_WORD = regex.compile(r"[^\x20\x09-\x0D]+")


def _pieces(path: str, context: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_encoder(path)
        for batch in batches:
            rows, columns = [], [[], [], [], []]
            for k, text in enumerate(batch.column(1)):
                ids = np.append(encode(text.as_py() or ""), np.uint32(END_OF_DOCUMENT)).astype("<u4")
                for start in range(0, len(ids), context):
                    piece = ids[start : start + context]
                    rows.append(k)
                    for column, value in zip(columns, (start, len(piece), zlib.crc32(piece.tobytes()), len(ids))):
                        column.append(value)
            kept = [batch.column(j).take(pa.array(rows, pa.int64())) for j in (0, 2)]
            yield pa.RecordBatch.from_arrays(
                [*kept, *(pa.array(c, pa.int64()) for c in columns)],
                names=["id", "row", "start", "length", "ids_crc32", "doc_tokens"],
            )

    return run


class Windows:
    """Open windows by remaining capacity, in a segment tree whose nodes tell whether any is below."""

    def __init__(self, context: int):
        self.size = 1 << context.bit_length()
        self.any = bytearray(2 * self.size)
        self.open: dict[int, list[int]] = defaultdict(list)

    def add(self, window: int, room: int) -> None:
        self.open[room].append(window)
        node = self.size + room
        while node and not self.any[node]:
            self.any[node] = 1
            node >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """Removes and returns a window with the least room of at least length, and its room."""
        node = self.size + length
        while not self.any[node]:
            while node & 1:  # a right child: nothing larger below its parent
                node >>= 1
                if node <= 1:
                    return None
            node += 1
            if not node & (node - 1):
                return None
        while node < self.size:
            node = 2 * node if self.any[2 * node] else 2 * node + 1
        room = node - self.size
        window = self.open[room].pop()
        if not self.open[room]:
            while node and not (node < self.size and (self.any[2 * node] or self.any[2 * node + 1])):
                self.any[node] = 0
                node >>= 1
        return window, room


def best_fit(lengths: np.ndarray, context: int) -> tuple[np.ndarray, np.ndarray]:
    """Window and offset of each piece, placed in the given order, which should be longest first."""
    windows, opened = Windows(context), 0
    window, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for k, length in enumerate(lengths.tolist()):
        found = windows.take(length)
        if found is None:
            found = opened, context
            opened += 1
        window[k], room = found
        offset[k] = context - room
        if room > length:
            windows.add(int(window[k]), room - length)
    return window, offset


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    context: int = CONTEXT,
    shard_pieces: int = SHARD_PIECES,
) -> DataFrame:
    """One row per piece: id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    tokenizer is the path of a word-wise BPE file, to be found on every executor. Every document,
    empty and null ones as well, ends with the id END_OF_DOCUMENT. Rows with equal ids are packed as
    documents of their own. An empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("row")
    )
    kind = rows.schema["id"].dataType.simpleString()
    fields = f"id {kind}, row long, start long, length long, ids_crc32 long, doc_tokens long"
    pieces = scratch.put(rows.mapInArrow(_pieces(tokenizer, context), fields))
    shards = -(-pieces.count() // shard_pieces) or 1

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = None, []
        for batch in batches:  # sorted by shard, and longest first within one
            numbers = batch.column("shard").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
            for a, b in zip(cuts, cuts[1:]):
                if b > a:
                    if held and numbers[a] != shard:
                        yield placed(held, shard)
                        held = []
                    shard = int(numbers[a])
                    held.append(batch.slice(a, b - a))
        if held:
            yield placed(held, shard)

    def placed(held: list[pa.RecordBatch], shard: int) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        window, offset = best_fit(table.column("length").to_numpy(), context)
        table = table.drop_columns(["shard", "row"])
        table = table.append_column("sequence_id", pa.array(window * shards + shard))
        return table.append_column("offset", pa.array(offset)).to_batches()[0]

    schema = f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("row", "start"), F.lit(shards)))
    parts = min(shards, 100_000)
    return (
        dealt.repartition(parts, "shard")
        .sortWithinPartitions("shard", F.desc("length"), "row", "start")
        .mapInArrow(place, schema)
        .withColumnRenamed("id", id_col)
    )
