"""Alignment of two tokenizations of the same texts.

Tokens of A and B are byte ranges of one text. Where a token of each ends at the same byte is a *joint
end*, and the joint ends cut both into groups. A stretch of text therefore yields a fragment: what
stands before its first joint end is open to the left, what stands after its last one is open to the
right, and the groups between are closed. Fragments compose: the open end of one and the open beginning
of the next become groups, or stay open. Composition is associative with the empty fragment as identity,
so the fragments of a very long document are made in many tasks, from ranges of bytes, and reduced
in a tree, eight neighbours at a time.

A space between two characters that are no white space ends tokens of both kinds: A's begin with it
and no piece of B has one after another character (checked when the model is read). Short documents
are pieces cut there, which are encoded once a task and remembered.

What is needed of the corpus, how many documents hold an id pair linked, is counted per batch of
documents, added up by a shuffle of the batches' distinct pairs, and sent back to the batches. The
batch keeps its documents as lists of groups, so links are never moved one by one.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache, reduce
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkscore.llm.store import Scratch

#: Texts of more code points are split into parts for many tasks, and their tokens into ranges of bytes.
LONG_CHARS = 50_000
PART_CHARS = 20_000
CHUNK_BYTES = 1 << 14
#: Fragments of so many neighbouring ranges are composed at a time.
FAN = 8
#: Code points of texts in a batch and pieces it knows, beyond which it is handed on; pieces or groups that
#: a task remembers from batch to batch; documents whose new pieces are encoded together.
BATCH_CHARS = 8 << 20
BATCH_PIECES = 200_000
CACHED_PIECES = 150_000
STEP = 64
CACHED_LENGTH = 64
#: Groups with more links than this list their distinct ids.
LISTED_LINKS = 1024

_CUT = re.compile(r"(?<=\S) (?=\S)")
# Pieces of letters, digits and signs that A's own split treats as this one does. Apostrophes, other
# white space than one line feed, and all other characters are left to A.
_PLAIN = re.compile(r"[!-&(-~À-ÖØ-öø-ÿ]+(?:\n[!-&(-~À-ÖØ-öø-ÿ]+)*")
_PARTS = r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[!-&(-/:-@\[-`{-~]+|\n"
_ID_BITS = 16


class Fragment(NamedTuple):
    """A stretch of both token streams; joint end k lies after ends_a[k] and ends_b[k] tokens."""

    a: np.ndarray
    b: np.ndarray
    ends_a: np.ndarray
    ends_b: np.ndarray

    @property
    def prefix(self) -> tuple[np.ndarray, np.ndarray]:
        """Tokens up to the first joint end, or all: a group once its beginning is known."""
        return (self.a[: self.ends_a[0]], self.b[: self.ends_b[0]]) if len(self.ends_a) else (self.a, self.b)

    @property
    def suffix(self) -> tuple[np.ndarray, np.ndarray]:
        """Tokens after the last joint end; none if there is no joint end, as the prefix has them."""
        return (self.a[self.ends_a[-1] :], self.b[self.ends_b[-1] :]) if len(self.ends_a) else (self.a[:0], self.b[:0])

    def closed(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """The groups between the first and the last joint end."""
        cuts = list(zip(self.ends_a, self.ends_b))
        return [(self.a[i:k], self.b[j:m]) for (i, j), (k, m) in zip(cuts, cuts[1:])]

    def groups(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """All groups of a whole text, which begins and ends at a joint end."""
        return [self.prefix, *self.closed()] if len(self.ends_a) else []


EMPTY = Fragment(*(np.empty(0, np.int32) for _ in range(4)))


def compose(x: Fragment, y: Fragment) -> Fragment:
    """The fragment of two stretches, the second right behind the first."""
    return Fragment(
        np.concatenate((x.a, y.a)),
        np.concatenate((x.b, y.b)),
        np.concatenate((x.ends_a, y.ends_a + len(x.a))).astype(np.int32),
        np.concatenate((x.ends_b, y.ends_b + len(x.b))).astype(np.int32),
    )


def _joint(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The joint ends of two ascending lists of token ends, and the tokens of each up to them."""
    at = np.intersect1d(end_a, end_b, assume_unique=True)
    return at, (np.searchsorted(end_a, at) + 1).astype(np.int32), (np.searchsorted(end_b, at) + 1).astype(np.int32)


def fragment(a: np.ndarray, end_a: np.ndarray, b: np.ndarray, end_b: np.ndarray, low: int, high: int) -> Fragment:
    """The fragment of the tokens that end in the bytes (low, high]."""
    i, k = np.searchsorted(end_a, (low, high), "right")
    j, m = np.searchsorted(end_b, (low, high), "right")
    _, ends_a, ends_b = _joint(end_a[i:k], end_b[j:m])
    return Fragment(a[i:k], b[j:m], ends_a, ends_b)


def _byte_level() -> dict[str, int]:
    """The byte of each character of a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


_BYTES = _byte_level()


class Encoders:
    """Both tokenizers, with the bytes of every id."""

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        names = [self.a.id_to_token(k) or "" for k in range(self.a.get_vocab_size())]
        # An entry with a character outside the byte level is a special token, which texts never give.
        self.bytes_a = [bytes(map(_BYTES.__getitem__, x)) if all(map(_BYTES.__contains__, x)) else x.encode() for x in names]
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("a piece of the second tokenizer has a space behind another character")
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)
        ]
        self.plain = self._merges_by_id(path_a)
        # Every id as text with what may follow it.
        self.text_a = [np.array([f"{k}{x}" for k in range(len(names))], object) for x in ",|"]
        self.text_b = [np.array([f"{k}{x}" for k in range(len(pieces))], object) for x in ",\n"]
        self.length_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.length_b = np.array([len(x) for x in self.bytes_b], np.int64)

    def _merges_by_id(self, path_a: str):
        """A's merges as an encoder of plain pieces, if A merges in the order of the ids (else none)."""
        from tiktoken import Encoding

        with open(path_a, encoding="utf-8") as f:
            model = json.load(f)["model"]
        merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        order = [model["vocab"][x] for x in merged]
        if any(x >= y for x, y in zip(order, order[1:])) or len(order) + 256 > len(model["vocab"]):
            return None
        ids = [k for x, k in model["vocab"].items() if len(x) == 1 and x in _BYTES] + order
        ranks = {self.bytes_a[k]: k for k in ids}
        return Encoding("plain", pat_str=_PARTS, mergeable_ranks=ranks, special_tokens={})

    def encode(self, pieces: Sequence[str], plain: int) -> "Encoded":
        """Tokens of each piece with a space before it; none for a piece whose bytes they do not give back.

        The first ``plain`` pieces are plain ones.
        """
        b, count_b = _flat(self.b.encode(list(pieces), num_threads=1))
        rest = [" " + p for p in pieces[plain:]]
        a, count_a = _flat([x.ids for x in self.a.encode_batch(rest, add_special_tokens=False)])
        own = [f" {p}".encode() for p in pieces]
        if plain:
            sizes = np.fromiter(map(len, own[:plain]), np.int64, plain)
            ids = np.array(self.plain.encode_ordinary(" " + " ".join(pieces[:plain])), np.int32)
            upto = np.searchsorted(np.cumsum(self.length_a[ids]), np.cumsum(sizes)) + 1
            a, count_a = np.concatenate((ids, a)), np.concatenate((np.diff(upto, prepend=0), count_a))
        same = np.ones(len(pieces), bool)
        for ids, counts, table, length in ((a, count_a, self.bytes_a, self.length_a), (b, count_b, self.bytes_b, self.length_b)):
            if b"".join(map(table.__getitem__, ids.tolist())) == b"".join(own) and not _uneven(length[ids], counts, own):
                continue
            ends = np.cumsum(counts)
            for k, (end, count) in enumerate(zip(ends.tolist(), counts.tolist())):
                same[k] &= b"".join(map(table.__getitem__, ids[end - count : end].tolist())) == own[k]
        if not same.all():
            a, b = a[np.repeat(same, count_a)], b[np.repeat(same, count_b)]
            count_a, count_b = count_a * same, count_b * same
        return Encoded(a, count_a, b, count_b, same)

    def plain_first(self, pieces: list[str]) -> tuple[list[str], int]:
        """The pieces, plain ones first, and how many these are. Plain ones may be encoded in one go."""
        plain = [p for p in pieces if _PLAIN.fullmatch(p)] if self.plain else []
        rest = set(pieces).difference(plain)
        return plain + [p for p in pieces if p in rest], len(plain)


def _uneven(lengths: np.ndarray, counts: np.ndarray, own: list[bytes]) -> bool:
    """Whether a piece's tokens are not as long as the piece."""
    total, ends = np.concatenate(([0], np.cumsum(lengths))), np.cumsum(counts)
    return (total[ends] - total[ends - counts] != np.fromiter(map(len, own), np.int64, len(own))).any()


def encoded_text(encoders: Encoders, text: str) -> "Encoded":
    """Tokens of the pieces of a text, in its order."""
    pieces = pieces_of(text) if text else []
    names, plain = encoders.plain_first(list(dict.fromkeys(pieces)))
    found, at = encoders.encode(names, plain), {p: k for k, p in enumerate(names)}
    back = np.fromiter(map(at.__getitem__, pieces), np.int64, len(pieces))
    sides = []
    for ids, counts in ((found.a, found.count_a), (found.b, found.count_b)):
        starts = np.cumsum(counts) - counts
        sides += [ids[_spread(starts[back], counts[back])], counts[back]]
    return Encoded(*sides, found.same[back])


class Encoded(NamedTuple):
    """Tokens of many pieces one behind the other, how many each has, and whether it is given back."""

    a: np.ndarray
    count_a: np.ndarray
    b: np.ndarray
    count_b: np.ndarray
    same: np.ndarray


def _flat(ids: Sequence[Sequence[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter(chain.from_iterable(ids), np.int32, int(counts.sum())), counts


def pieces_of(text: str) -> list[str]:
    """A text cut at the spaces that end tokens of both kinds, which are left out."""
    return _CUT.split(text)


def links_of(a: Sequence[int], b: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """The id pairs (a << 16 | b) linked in a group, and how often."""
    if len(a) * len(b) <= LISTED_LINKS:
        pairs = np.array([x << _ID_BITS | y for x in a for y in b], np.int64)
        return pairs, np.ones(len(pairs), np.int64)
    x, n = np.unique(np.array(a, np.int64), return_counts=True)
    y, m = np.unique(np.array(b, np.int64), return_counts=True)
    return (x[:, None] << _ID_BITS | y).ravel(), (n[:, None] * m).ravel()


def shown(a: Sequence[int], b: Sequence[int]) -> str:
    return f"{','.join(map(str, a))}|{','.join(map(str, b))}"


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of ranges, one range behind the other."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


class Groups:
    """Groups by their text, with their numbers of tokens and their links."""

    def __init__(self):
        self.known: dict[str, int] = {}
        self.text: list[str] = []
        self.numbers = np.empty((0, 4), np.int64)  # n_a, n_b, links, distinct links
        self.starts = np.empty(0, np.int64)
        self.pairs, self.times = np.empty(0, np.int64), np.empty(0, np.int64)

    def codes(self, texts: list[str]) -> np.ndarray:
        """The number of each group, after new ones are taken in."""
        new = list(set(texts) - self.known.keys())
        if new:
            self.known.update(zip(new, range(len(self.text), len(self.text) + len(new))))
            self.text += new
            rows, links = [], []
            for text in new:
                a, b = ([int(x) for x in side.split(",")] for side in text.split("|"))
                links.append(links_of(a, b))
                rows.append((len(a), len(b), len(a) * len(b), len(links[-1][0])))
            self.numbers = np.concatenate((self.numbers, np.array(rows, np.int64)))
            self.pairs = np.concatenate((self.pairs, *(x for x, _ in links)))
            self.times = np.concatenate((self.times, *(x for _, x in links)))
            self.starts = np.cumsum(self.numbers[:, 3]) - self.numbers[:, 3]
        return np.fromiter(map(self.known.__getitem__, texts), np.int64, len(texts))


def group_texts(found: Encoded, encoders: Encoders) -> tuple[list[str], np.ndarray]:
    """The groups of all pieces as texts, in order, and how many each piece has."""
    # Bytes of all pieces one behind the other; each piece ends at a joint end.
    _, ends_a, ends_b = _joint(np.cumsum(encoders.length_a[found.a]), np.cumsum(encoders.length_b[found.b]))
    groups = np.bincount(np.searchsorted(np.cumsum(found.count_a), ends_a), minlength=len(found.same))
    out = np.empty(len(found.a) + len(found.b), object)
    sides = ((found.a, ends_a, np.concatenate(([0], ends_b[:-1])), encoders.text_a), (found.b, ends_b, ends_a, encoders.text_b))
    for ids, ends, before, (inner, last) in sides:
        if len(ids):
            text = inner[ids]
            text[ends - 1] = last[ids[ends - 1]]
            out[np.arange(len(ids)) + np.repeat(before, np.diff(ends, prepend=0))] = text
    return "".join(out.tolist()).split("\n")[:-1], groups


class Pieces:
    """Pieces of text by name, as lists of groups. A piece that is not given back has the number -1."""

    def __init__(self):
        self.known: dict[str, int] = {}
        self.sizes, self.codes = np.empty(0, np.int64), np.empty(0, np.int64)
        self.starts = self.sizes

    def add(self, names: list[str], encoders: Encoders, groups: Groups) -> None:
        """Takes in new pieces."""
        names, plain = encoders.plain_first(names)
        found = encoders.encode(names, plain)
        texts, sizes = group_texts(found, encoders)
        first = len(self.sizes)
        self.known.update(zip(names, np.where(found.same, np.arange(first, first + len(names)), -1).tolist()))
        self.sizes = np.concatenate((self.sizes, sizes))
        self.codes = np.concatenate((self.codes, groups.codes(texts)))
        self.starts = np.cumsum(self.sizes) - self.sizes

    def groups_of(self, pieces: list[str]) -> np.ndarray | None:
        """The groups of a text of these pieces, None if one is not given back."""
        at = np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))
        return None if not len(at) or at.min() < 0 else self.codes[_spread(self.starts[at], self.sizes[at])]


def _squeezed(values: np.ndarray, kind: type) -> bytes:
    return pa.compress(values.astype(kind).tobytes(), "zstd", asbytes=True)


def _opened(data: bytes, kind: type, count: int) -> np.ndarray:
    size = count * np.dtype(kind).itemsize
    return np.frombuffer(pa.decompress(data, size, "zstd", asbytes=True) if size else b"", kind)


PAIR, LINKS, DOCUMENT = 0, 1, 2
_RESULT = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_SHAPE = f"batch long, kind byte, seq long, pair long, n long, {_RESULT}, sizes array<long>, blobs array<binary>"


class Batch:
    """Documents as lists of groups, until they are handed on with their distinct pairs."""

    def __init__(self, kind: pa.DataType, space: int):
        self.groups, self.pieces, self.kind, self.space, self.made = Groups(), Pieces(), kind, space, 0
        self.clear()

    def clear(self) -> None:
        self.rows: list[tuple] = []
        self.ids: list = []
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.chars = 0
        if len(self.pieces.known) > CACHED_PIECES or len(self.groups.text) > CACHED_PIECES:
            self.groups, self.pieces = Groups(), Pieces()

    def add(self, doc_id, codes: np.ndarray | None, chars: int) -> None:
        """A document of these groups in order; None for one without tokens."""
        self.ids.append(doc_id)
        self.chars += chars
        if codes is None:
            self.rows.append((0, 0, 0, 0, ""))
            self.held.append((np.empty(0, np.int64),) * 2)
            return
        n_a, n_b, n_links, _ = self.groups.numbers[codes].sum(axis=0).tolist()
        text = ";".join(map(self.groups.text.__getitem__, codes.tolist()))
        self.rows.append((n_a, n_b, len(codes), n_links, hashlib.sha256(text.encode()).hexdigest()))
        self.held.append(np.unique(codes, return_counts=True))

    def flush(self) -> Iterator[pa.RecordBatch]:
        """The batch's pairs with their numbers of documents, its groups' links, and its documents."""
        if not self.rows:
            return
        batch, self.made = self.space << 32 | self.made, self.made + 1
        sizes = np.array([len(c) for c, _ in self.held], np.int64)
        codes = np.concatenate([c for c, _ in self.held])
        used = np.flatnonzero(np.bincount(codes))
        codes = np.searchsorted(used, codes)
        rows = self.groups.numbers[used, 3]
        place = _spread(self.groups.starts[used], rows)
        distinct, local = np.unique(self.groups.pairs[place], return_inverse=True)
        first = np.cumsum(rows) - rows
        counts = np.zeros(len(distinct), np.int64)
        ends, begin = np.cumsum(sizes), 0
        weight = np.cumsum(rows[codes])
        while begin < len(sizes):  # some documents at a time, so that their links fit in memory
            low = int(ends[begin - 1]) if begin else 0
            upto = (int(weight[low - 1]) if low else 0) + 1_000_000
            end = max(begin + 1, int(np.searchsorted(ends, np.searchsorted(weight, upto, "right"), "right")))
            mine = codes[low : int(ends[end - 1])]
            of_doc = np.repeat(np.arange(end - begin), sizes[begin:end])
            links = local[_spread(first[mine], rows[mine])]
            once = np.sort(np.repeat(of_doc, rows[mine]) * max(len(distinct), 1) + links)
            once = once[np.diff(once, prepend=-1) > 0]
            counts += np.bincount(once % max(len(distinct), 1), minlength=len(distinct))
            begin = end
        yield self._rows(batch, PAIR, pair=distinct, n=counts)
        many = np.concatenate([n for _, n in self.held])
        blobs = [_squeezed(rows, np.uint32), _squeezed(local, np.uint32), _squeezed(self.groups.times[place], np.uint32)]
        yield self._rows(batch, LINKS, seq=[0], sizes=[[len(rows), len(local)]], blobs=[blobs])
        step = 2000
        for k in range(0, len(sizes), step):
            a, b = (int(ends[k - 1]) if k else 0), int(ends[min(k + step, len(sizes)) - 1])
            blobs = [_squeezed(sizes[k : k + step], np.uint32), _squeezed(codes[a:b], np.uint32), _squeezed(many[a:b], np.uint32)]
            yield self._rows(batch, LINKS, seq=[k + 1], sizes=[[len(sizes[k : k + step]), b - a]], blobs=[blobs])
        columns = dict(zip(("n_a", "n_b", "n_groups", "n_links", "groups_sha256"), zip(*self.rows)))
        yield self._rows(batch, DOCUMENT, seq=np.arange(len(sizes)), id=self.ids, **columns)
        self.clear()

    def _rows(self, batch: int, kind: int, **columns) -> pa.RecordBatch:
        size = len(next(iter(columns.values())))
        schema = pa.schema(
            [("id", self.kind), ("batch", pa.int64()), ("kind", pa.int8()), ("seq", pa.int64()), ("pair", pa.int64()), ("n", pa.int64())]
            + [(n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")]
            + [("groups_sha256", pa.string()), ("sizes", pa.list_(pa.int64())), ("blobs", pa.list_(pa.binary()))]
        )
        columns |= {"batch": np.full(size, batch), "kind": np.full(size, kind, np.int8)}
        return pa.RecordBatch.from_arrays([pa.array(columns.get(f.name, [None] * size), f.type) for f in schema], schema=schema)


@lru_cache(maxsize=2)
def encoders_of(path_a: str, path_b: str) -> Encoders:
    """Both tokenizers, read once in a Python worker."""
    return Encoders(path_a, path_b)


Map = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _short(path_a: str, path_b: str) -> Map:
    """Documents (id, text) to batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders, batch = encoders_of(path_a, path_b), None
        for rows in batches:
            batch = batch or Batch(rows.column(0).type, 2 * TaskContext.get().partitionId())
            ids, texts = rows.column(0).to_pylist(), rows.column(1)
            for k in range(0, len(rows), STEP):
                step = texts[k : k + STEP].to_pylist()
                cut = [pieces_of(t) if t else [] for t in step]
                new = list(set(chain.from_iterable(cut)) - batch.pieces.known.keys())
                batch.pieces.add(new, encoders, batch.groups)
                for doc_id, text, pieces in zip(ids[k : k + STEP], step, cut):
                    batch.add(doc_id, batch.pieces.groups_of(pieces), len(text or ""))
                for piece in [p for p in new if len(p) > CACHED_LENGTH]:  # not kept by name
                    del batch.pieces.known[piece]
                if batch.chars > BATCH_CHARS or len(batch.pieces.known) > BATCH_PIECES:
                    yield from batch.flush()
        if batch:
            yield from batch.flush()

    return run


def _parts(part_chars: int) -> Map:
    """Long documents (row, id, text) to parts that end at spaces between words, with their first byte."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for k, (row, text) in enumerate(zip(rows.column("row").to_pylist(), rows.column("text"))):
                held, size, at, out = [], 0, 0, []
                for piece in pieces_of(text.as_py()):
                    held.append(piece)
                    size += len(piece) + 1
                    if size > part_chars:
                        out.append((at, " ".join(held)))
                        at += len(out[-1][1].encode()) + 1
                        held, size = [], 0
                if held:
                    out.append((at, " ".join(held)))
                # No batch holds more than one document's parts.
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row] * len(out), pa.int64()),
                        pa.array([x for x, _ in out], pa.int64()),
                        pa.array([t for _, t in out], pa.string()),
                        rows.column("id").take(pa.array([k] * len(out), pa.int64())),
                    ],
                    names=["row", "start", "text", "id"],
                )

    return run


_FRAGMENT = "row long, start long, node long, same boolean, a binary, b binary, ends_a binary, ends_b binary"


def _fragment_rows(found: list[tuple[int, int, int, bool, Fragment]], ids: pa.Array) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), *[pa.binary()] * 4)
    rows = [(*head, *(x.astype(np.int32).tobytes() for x in f)) for *head, f in found]
    columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays([*columns, ids], names=[x.split()[0] for x in _FRAGMENT.split(",")] + ["id"])


def _fragments(path_a: str, path_b: str, chunk_bytes: int) -> Map:
    """Parts to the fragments of their ranges of bytes; node is the range's number in the document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = encoders_of(path_a, path_b)
        for rows in batches:
            for k in range(len(rows)):
                row, start, text = (rows.column(c)[k].as_py() for c in ("row", "start", "text"))
                tokens, found = encoded_text(encoders, text), []
                if tokens.same.all():
                    end_a = start + np.cumsum(encoders.length_a[tokens.a])
                    end_b = start + np.cumsum(encoders.length_b[tokens.b])
                    for chunk in range(start // chunk_bytes, (int(end_a[-1]) - 1) // chunk_bytes + 1):
                        low, high = max(start, chunk * chunk_bytes), (chunk + 1) * chunk_bytes
                        found.append((row, low, chunk, True, fragment(tokens.a, end_a, tokens.b, end_b, low, high)))
                else:
                    found.append((row, start, start // chunk_bytes, False, EMPTY))
                yield _fragment_rows(found, rows.column("id").take(pa.array([k] * len(found), pa.int64())))

    return run


def _read(rows: pa.RecordBatch, k: int) -> Fragment:
    return Fragment(*(np.frombuffer(rows.column(c)[k].as_py(), np.int32) for c in ("a", "b", "ends_a", "ends_b")))


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fragments in the order of row and start; those of one row and node become one, in their order."""
    held, place, own = [], None, None

    def joined() -> pa.RecordBatch:
        same = all(s for _, s, _ in held)
        whole = reduce(compose, (f for _, _, f in held)) if same else EMPTY
        return _fragment_rows([(place[0], held[0][0], place[1], same, whole)], own)

    for rows in batches:
        for k in range(len(rows)):
            at = rows.column("row")[k].as_py(), rows.column("node")[k].as_py()
            if at != place and held:
                yield joined()
                held = []
            if not held:
                place, own = at, rows.column("id")[k : k + 1]
            held.append((rows.column("start")[k].as_py(), rows.column("same")[k].as_py(), _read(rows, k)))
    if held:
        yield joined()


def _long(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fragments in the order of row and start to batches of whole documents.

    Both in one step: behind each other two steps would take two Python workers a task, which both stay
    and in time hold the tokenizers.
    """
    batch = None
    for rows in _composed(batches):
        batch = batch or Batch(rows.column("id").type, 2 * TaskContext.get().partitionId() + 1)
        for k in range(len(rows)):
            whole, doc_id = _read(rows, k), rows.column("id")[k].as_py()
            if not rows.column("same")[k].as_py():
                batch.add(doc_id, None, 0)
                continue
            codes = batch.groups.codes([shown(a.tolist(), b.tolist()) for a, b in whole.groups()])
            batch.add(doc_id, codes, len(whole.a) * 4)
            if batch.chars > BATCH_CHARS or len(batch.groups.text) > BATCH_PIECES:
                yield from batch.flush()
    if batch:
        yield from batch.flush()


def _long_documents(
    scratch: Scratch, docs: DataFrame, path_a: str, path_b: str, part_chars: int, chunk_bytes: int
) -> DataFrame:
    kind = docs.schema["id"].dataType.simpleString()
    numbered = docs.withColumn("row", F.monotonically_increasing_id())
    parts = scratch.put(numbered.mapInArrow(_parts(part_chars), f"row long, start long, text string, id {kind}"))
    pieces = parts.repartition("row", "start")
    found = scratch.put(pieces.mapInArrow(_fragments(path_a, path_b, chunk_bytes), f"{_FRAGMENT}, id {kind}"))
    last = found.agg(F.max("node")).first()[0] or 0
    while last:
        last //= FAN
        nodes = found.withColumn("node", F.floor(F.col("node") / FAN).cast("long"))
        nodes = nodes.repartition("row", "node").sortWithinPartitions("row", "start")
        found = scratch.put(nodes.mapInArrow(_composed, f"{_FRAGMENT}, id {kind}"))
    # A short text that lies within one range still has a fragment for each of its parts.
    whole = found.repartition("row").sortWithinPartitions("row", "start")
    return whole.mapInArrow(_long, f"id {kind}, {_SHAPE}")


def _finished(kind: str) -> Map:
    """Batches with the corpus's counts of their pairs, in the order of kind and seq, to documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch, held, best, total, queue = None, [], None, None, []
        table: list[tuple[np.ndarray, np.ndarray]] = []
        for rows in batches:
            numbers, kinds = rows.column("batch").to_numpy(), rows.column("kind").to_numpy()
            cuts = np.flatnonzero(np.diff(numbers) | np.diff(kinds)) + 1
            for low, high in zip([0, *cuts], [*cuts, len(rows)]):
                part = rows.slice(low, high - low)
                if not len(part):
                    continue
                if numbers[low] != batch:
                    batch, held, table, queue = numbers[low], [], [], []
                if kinds[low] == PAIR:
                    found = part.column("found").flatten()
                    held.append([found.field(k).to_numpy() for k in range(3)])
                elif kinds[low] == LINKS:
                    for seq, sizes, blobs in zip(*(part.column(c).to_pylist() for c in ("seq", "sizes", "blobs"))):
                        first = _opened(blobs[0], np.uint32, sizes[0]).astype(np.int64)
                        second, third = (_opened(x, np.uint32, sizes[1]).astype(np.int64) for x in blobs[1:])
                        if seq == 0:  # links of the groups
                            pair, count, top = (np.concatenate(c) for c in zip(*held)) if held else (np.empty(0, np.int64),) * 3
                            order = np.argsort(pair)
                            count, top = count[order], top[order]
                            group = np.repeat(np.arange(len(first)), first)
                            total = np.bincount(group, weights=third * count[second], minlength=len(first)).astype(np.int64)
                            best = np.bincount(group, weights=third * top[second], minlength=len(first)).astype(np.int64)
                        else:  # groups of documents
                            doc = np.repeat(np.arange(len(first)), first)
                            sums = (np.bincount(doc, weights=third * x[second], minlength=len(first)).astype(np.int64) for x in (best, total))
                            table.append(tuple(sums))
                else:
                    if table:
                        queue, table = [np.concatenate(x) for x in zip(*table)], []
                    at = part.column("seq").to_numpy()
                    columns = [part.column(c) for c in ("id", "n_a", "n_b", "n_groups", "n_links")]
                    sums = [pa.array(queue[0][at]), pa.array(queue[1][at])]
                    yield pa.RecordBatch.from_arrays(
                        [*columns, *sums, part.column("groups_sha256")],
                        names=["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
                    )

    return run


def pair_counts(batches: DataFrame) -> DataFrame:
    """(pair, count, top): how many documents hold each id pair linked, and 1 if that is its A id's highest."""
    counts = batches.where(F.col("kind") == PAIR).groupBy("pair").agg(F.sum("n").alias("count"))
    a = F.shiftright("pair", _ID_BITS)
    # An A id has at most as many pairs as B has entries.
    highest = F.max("count").over(Window.partitionBy("a"))
    return counts.withColumn("a", a).select("pair", "count", (F.col("count") == highest).cast("long").alias("top"))


def align(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    long_chars: int = LONG_CHARS,
    part_chars: int = PART_CHARS,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """One row per document: id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``path_a`` names a byte-level BPE file and ``path_b`` a piece model, at the same place on every
    executor; A reads a space and the text, B the text, before which it puts a space itself. Each pair of
    tokens of A and B in one group is a link. The count of an id pair is the number of rows that hold it
    linked; n_best counts links whose pair has the highest count of its A id, count_sum adds the counts of
    all links. groups_sha256 digests the groups as ``a1,a2|b1;a3|b2``.

    Null and empty texts, and those whose tokens do not give back the bytes of a space and the text under
    both, have no tokens: zeros, and an empty digest. Texts of any length are taken whole. Repeated rows
    and ids, null ids too, are documents of their own; an empty table gives an empty result and other
    columns are not read.
    """
    scratch = Scratch(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    long = F.coalesce(F.length("text") > long_chars, F.lit(False))
    short = rows.where(~long).mapInArrow(_short(path_a, path_b), f"id {kind}, {_SHAPE}")
    batches = scratch.put(short.unionByName(_long_documents(scratch, rows.where(long), path_a, path_b, part_chars, chunk_bytes)))
    counts = scratch.put(pair_counts(batches))
    # A batch's distinct pairs, which its size bounds, go back to it together.
    wanted = batches.where(F.col("kind") == PAIR).select("batch", "pair")
    found = F.collect_list(F.struct("pair", "count", "top")).alias("found")
    back = wanted.join(counts, "pair").groupBy("batch").agg(found).withColumn("kind", F.lit(PAIR).cast("byte"))
    rest = batches.where(F.col("kind") != PAIR).drop("pair", "n")
    dealt = rest.unionByName(back, allowMissingColumns=True).repartition("batch").sortWithinPartitions("batch", "kind", "seq")
    numbers = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return dealt.mapInArrow(_finished(kind), f"id {kind}, {numbers}").withColumnRenamed("id", id_col)
