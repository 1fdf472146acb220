"""Grouping of spelling variants by a dictionary of trie-node pairs.

The words are put into two tries, one read forwards and one read backwards, and the nodes are
numbered. A word is then, at any place, a pair of integers: the node of what stands before the place
and the node of what stands behind it. Leaving out one code point gives a *skip* pair, leaving out
none a *split* pair. Two words differ by one replaced code point exactly when they have a skip pair in
common, and by one inserted or deleted one exactly when a skip pair of the longer is a split pair of
the shorter. So the exact neighbours meet in an equality join on two integers, and strings are not
compared at all.

The words of a pair agree in all but one code point. There are as many of them as letters at most, so
no group is large, however frequent its words are; each word takes a summary from its groups, and pairs
of words are never listed.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkscore.llm.store import Scratch

#: A run whose hash with its document's id is divisible by this loses one code point.
EDIT_EVERY = 97
MIN_LENGTH = 5
MIN_COUNT = 3
#: A form is this many times as frequent as its variant.
FORM_RATIO = 2

#: Distinct words that a task counts before it hands them on.
COUNTED_WORDS = 400_000
#: Rows of one batch of places.
PLACES = 100_000

# Letters are single bytes in Latin-1; every other character becomes a space.
_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256)
)
#: Depth of the trie nodes that are numbered by their code points.
HEAD = 3
_NODE_BITS = 39

SKIP, SKIP_OF_RUN, SPLIT = 0, 1, 2


def runs(text: str) -> list[bytes]:
    """The runs of letters of a text in Latin-1, A to Z in lower case."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split()


def edited(run: bytes, of_id: int, every: int) -> bytes:
    """The run without one code point, if its hash says so. of_id is the crc32 of the id and a colon."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), of_id)
    if h % every:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1 :]


def _counted(every: int, min_length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for name, text in zip(batch.column(0), batch.column(1)):
                text = text.as_py()
                if not text:
                    continue
                of_id = zlib.crc32(f"{name.as_py() or ''}:".encode())
                for word, n in Counter(runs(text)).items():
                    word = edited(word, of_id, every)
                    if len(word) >= min_length:
                        counts[word] += n
            if len(counts) > COUNTED_WORDS:
                yield counted(counts)
                counts = Counter()
        if counts:
            yield counted(counts)

    def counted(counts: Counter) -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in counts], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(counts.values(), pa.int64())], names=["word", "n"])

    return run


def word_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    every: int = EDIT_EVERY,
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
) -> DataFrame:
    """(word, n): the edited runs of all texts with their number, counted in the tasks first."""
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    found = rows.mapInArrow(_counted(every, min_length), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _path(word: str, before: str, nodes: list[int], made: int) -> tuple[list[int], int]:
    """Numbers of the trie nodes on a word's path, given the word before it in the order, its nodes
    and the number of nodes made for their common first HEAD code points."""
    if word[:HEAD] == before[:HEAD] and before:
        common = HEAD
        while common < len(before) and word[common : common + 1] == before[common]:
            common += 1
    else:
        a, b, c = (ord(x) for x in word[:HEAD])
        nodes, common, made = [0, 1 + a, 257 + 256 * a + b], HEAD - 1, 0
    base = 0
    for x in word[:HEAD]:
        base = base << 8 | ord(x)
    base = (base << _NODE_BITS) + made
    new = len(word) - common
    return nodes[: common + 1] + list(range(base, base + new)), made + new


def _paths(key: str, name: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds the node numbers of the column key, whose rows come in its order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, nodes, made = "", [], 0
        for batch in batches:
            paths = []
            for word in batch.column(key).to_pylist():
                nodes, made = _path(word, before, nodes, made)
                before = word
                paths.append(np.array(nodes, np.int64))
            yield batch.append_column(name, pa.array(paths, pa.list_(pa.int64())))

    return run


def numbered(words: DataFrame, key: str, name: str) -> DataFrame:
    """The words (of three code points or more) with the numbers of the trie nodes on the path of key.

    Words with the same first three code points are numbered together in their order, so numbers grow
    with the order of the words and do not depend on how the rows are dealt.
    """
    schema = f"{', '.join(f'{c} {t}' for c, t in words.dtypes)}, {name} array<bigint>"
    near = words.repartition(F.substring(key, 1, HEAD)).sortWithinPartitions(key)
    return near.mapInArrow(_paths(key, name), schema)


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per place of a word: its pair of nodes, what kind of pair it is, the word's id and n."""
    names, held, size = ["prefix", "suffix", "kind", "id", "n"], [[], [], [], [], []], 0
    for batch in batches:
        for word, n, ahead, behind in zip(
            batch.column("word").to_pylist(), batch.column("n").to_pylist(), batch.column("ahead"), batch.column("behind")
        ):
            ahead, behind = ahead.values.to_numpy(), behind.values.to_numpy()[::-1]
            letters = np.frombuffer(word.encode("latin-1"), np.uint8)
            kind = np.full(len(word), SKIP_OF_RUN, np.int8)
            kind[1:][letters[1:] == letters[:-1]] = SKIP
            rows = 2 * len(word) + 1
            for column, values in zip(
                held,
                (
                    np.concatenate((ahead[:-1], ahead)),
                    np.concatenate((behind[1:], behind)),
                    np.concatenate((kind, np.full(len(word) + 1, SPLIT, np.int8))),
                    np.full(rows, ahead[-1]),
                    np.full(rows, n, np.int64),
                ),
            ):
                column.append(values)
            size += rows
            if size >= PLACES:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in held], names=names)
                held, size = [[], [], [], [], []], 0
    if size:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in held], names=names)


def _neighbours(places: DataFrame) -> DataFrame:
    """(id, n_near, near): how many neighbours each word has, and the first of them by n and order.

    A row takes from its pair of nodes what the others there are to it. All skips are replacements of
    each other. The split is the shorter word, which the skips lengthen; a letter left out of a run of
    equal ones counts at the run's first place only, so every neighbour is met once.
    """
    pair = Window.partitionBy("prefix", "suffix")
    ranked = pair.orderBy((F.col("kind") == SPLIT).cast("int"), F.desc("n"), "id")
    whole = ranked.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def best(rows: Column) -> Column:
        return F.max(F.when(rows, F.struct("n", (-F.col("id")).alias("by")))).over(pair)

    kind = F.col("kind")
    met = places.withColumns(
        {
            "rows": F.count("*").over(pair),
            "skips": F.count(F.when(kind != SPLIT, 1)).over(pair),
            "starts": F.count(F.when(kind == SKIP_OF_RUN, 1)).over(pair),
            "first_id": F.first("id").over(whole),
            "first": F.first(F.struct("n", (-F.col("id")).alias("by"))).over(whole),
            "second": F.nth_value(F.struct("n", (-F.col("id")).alias("by")), 2).over(whole),
            "start": best(kind == SKIP_OF_RUN),
            "split": best(kind == SPLIT),
        }
    ).where("rows > 1")
    others = F.when(F.col("first_id") != F.col("id"), F.col("first")).when(F.col("skips") > 1, F.col("second"))
    shorter = F.when(kind == SKIP_OF_RUN, F.col("split"))
    near = F.when(kind == SPLIT, F.col("start")).otherwise(F.greatest(others, shorter))
    count = F.when(kind == SPLIT, F.col("starts")).otherwise(F.col("skips") - 1 + F.when(shorter.isNotNull(), 1).otherwise(0))
    found = met.select("id", count.alias("count"), near.alias("near")).where("count > 0")
    return found.groupBy("id").agg(F.sum("count").alias("n_near"), F.max("near").alias("near"))


def _roots(scratch: Scratch, forms: DataFrame) -> DataFrame:
    """(id, root): where the chain of forms (id, form) from each id ends.

    Each round doubles the step, and n at least doubles along a chain, so there are six rounds at most.
    """
    at = scratch.put(forms.select("id", F.col("form").alias("root")))
    while True:
        onward = at.select(F.col("id").alias("root"), F.col("root").alias("further"))
        moved = scratch.put(
            at.join(onward, "root", "left").select(
                "id", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
            )
        )
        scratch.drop(at)
        at = moved
        if at.where("moved").isEmpty():
            return at.select("id", "root")


def variant_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    every: int = EDIT_EVERY,
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    ratio: int = FORM_RATIO,
) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    Words are the runs of letters (A to Z, a to z, U+00C0 to U+00FF) of whole texts, A to Z in lower
    case. A run whose crc32 with its document's id is divisible by ``every`` loses one code point; a null
    id reads as an empty one. Words of ``min_length`` (at least three) code points and ``min_count``
    occurrences count. Two words are near when they differ by one inserted, deleted or replaced code
    point. A word's form is its near word of largest n (ties: the first in code-point order) if that is
    ``ratio`` times its own n or more, else null; its root is the end of the chain of forms.

    Null and empty texts have no words; texts and words may be of any length. Repeated rows and ids
    count each time. An empty table gives an empty result; other columns are not read.
    """
    if min_length < HEAD:
        raise ValueError(f"words need {HEAD} code points at least")
    scratch = Scratch(docs.sparkSession)
    words = word_counts(docs, id_col, text_col, every, min_length, min_count)
    words = scratch.put(numbered(words, "word", "ahead"))
    both = numbered(words.withColumn("backwards", F.reverse("word")), "backwards", "behind")
    places = both.mapInArrow(_places, "prefix long, suffix long, kind byte, id long, n long")
    near = _neighbours(places)
    own = words.select("word", "n", F.element_at("ahead", -1).alias("id"))
    form = F.when(F.col("near.n") >= ratio * F.col("n"), -F.col("near.by"))
    known = scratch.put(
        own.join(near, "id", "left").select("id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), form.alias("form"))
    )
    roots = _roots(scratch, known.where("form IS NOT NULL").select("id", "form"))
    named = known.select(F.col("id").alias("form"), F.col("word").alias("form_word"), F.col("n").alias("form_n"))
    ends = known.select(F.col("id").alias("root"), F.col("word").alias("root_word"))
    varied = known.where("form IS NOT NULL").join(roots, "id").join(named, "form").join(ends, "root")
    columns = ["word", F.col("form_word").alias("form"), F.col("root_word").alias("root"), "n", "n_near", "form_n"]
    nothing = F.lit(None)
    rest = known.where("form IS NULL").select(
        "word", nothing.cast("string").alias("form"), F.col("word").alias("root"), "n", "n_near", nothing.cast("long").alias("form_n")
    )
    return varied.select(*columns).unionByName(rest)
