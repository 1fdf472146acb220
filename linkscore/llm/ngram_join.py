"""N-gram Jaccard self-join: MinHash LSH by paths of one length, then exact verification.

A document is the set of its 5-word shingles. Each tree of the forest labels it with the minimum
hashes of its set under the tree's functions, a few bits each, packed so that labels sort as paths of
a prefix trie. Two sets of similarity s share a path of length p with chance s^p, so paths are matched
at the greatest length whose chance over all trees, at the threshold itself, meets the target recall.
That length is fixed in advance: no trie is descended, and paths are not shortened by what is found.

Documents with the same set form one node. Nodes that share a matched path in some tree fall into one
candidate group, found from (node, first node of the path) links alone. Within a group the shingle
sets are compared exactly, block by block: a group of many nodes is cut into blocks, and each pair of
blocks is a task's work. A task returns one row per node: how many documents it is linked to, and one
link towards the rest of its class. Neither pairs nor groups are gathered or emitted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkscore.llm.components import components
from linkscore.llm.keys import row_key
from linkscore.llm.store import Scratch
from linkscore.llm.words import mixed, separated, text_blocks, word_hashes

WORDS = 5
SIMILARITY = 0.8
RECALL = 0.999
TREES = 20
DEPTH = 7
BITS = 9
#: A block of a large candidate group: nodes, and shingles of all its nodes.
BLOCK_NODES = 384
BLOCK_SHINGLES = 1_500_000

_COLUMNS = 4096
_TERMS = np.array([pow(0x9E3779B97F4A7C15, 2 * k + 1, 1 << 64) for k in range(WORDS)], np.uint64)
_FUNCTIONS = np.random.default_rng(20).integers(1, 1 << 63, TREES * DEPTH, np.uint64) * np.uint64(2) + np.uint64(1)


def matched_depth(similarity: float = SIMILARITY, recall: float = RECALL, trees: int = TREES, depth: int = DEPTH) -> int:
    """The longest path whose matches over all trees find a pair of this similarity often enough."""
    for p in range(depth, 0, -1):
        if 1 - (1 - similarity**p) ** trees >= recall:
            return p
    raise ValueError("too few trees for the target recall")


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles; a text of fewer words has one, of all of them."""
    for _, n, data, offsets in text_blocks(texts):
        text, begins = separated(data, offsets)
        starts, _, hashes = word_hashes(text)
        first = np.searchsorted(starts, begins)
        sums = np.zeros(max(0, len(hashes) - WORDS + 1), np.uint64)
        for k, term in enumerate(_TERMS):
            sums += hashes[k : k + len(sums)] * term
        sums = mixed(sums)
        for a, b in zip(first[:-1], first[1:]):
            if b - a >= WORDS:
                yield np.unique(sums[a : b - WORDS + 1])
            elif b > a:
                yield mixed((hashes[a:b] * _TERMS[: b - a]).sum(keepdims=True) + np.uint64(b - a))
            else:
                yield np.empty(0, np.uint64)


def set_key(shingles: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def labels(shingles: np.ndarray) -> np.ndarray:
    """The path of the set in each tree."""
    least = np.full(len(_FUNCTIONS), np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(shingles), 1024):
        np.minimum(least, (_FUNCTIONS[:, None] * shingles[k : k + 1024]).min(1), out=least)
    steps = (mixed(least) >> np.uint64(64 - BITS)).reshape(TREES, DEPTH)
    path = np.zeros(TREES, np.uint64)
    for k in range(DEPTH):
        path = (path << np.uint64(BITS)) | steps[:, k]
    return path.astype(np.int64)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes, sizes, paths = [], [], []
        for s in shingle_sets(batch.column(2)):
            nodes.append(set_key(s))
            sizes.append(len(s))
            paths.append(labels(s) if len(s) else None)
        arrays = [pa.array(nodes, pa.binary()), pa.array(sizes, pa.int64()), pa.array(paths, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], names=["id", "key", "node", "n", "paths"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingle sets of texts whose node is known; a text that only shares the key with it goes."""
    for batch in batches:
        sets = list(shingle_sets(batch.column("text")))
        nodes = batch.column("node").to_pylist()
        rows = [k for k, s in enumerate(sets) if set_key(s) == nodes[k]]
        kept = batch.take(pa.array(rows, pa.int64())).drop_columns(["text"])
        yield kept.append_column("shingles", pa.array([sets[k].tobytes() for k in rows], pa.binary()))


def linked(sets: list[np.ndarray], similarity: float, side: np.ndarray | None = None) -> np.ndarray:
    """Which pairs of sets are as similar, as a matrix; with sides, only pairs across them."""
    m = len(sets)
    sizes = np.array([len(s) for s in sets], np.float64)
    owner = np.repeat(np.arange(m), sizes.astype(np.int64))
    values, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    number = np.cumsum(shared) - 1
    keep = shared[place]
    column, owner = number[place[keep]], owner[keep]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    common = np.zeros((m, m), np.float64)
    width = int(number[-1]) + 1 if len(number) else 0
    for begin in range(0, width, _COLUMNS):
        a, b = np.searchsorted(column, [begin, begin + _COLUMNS])
        present = np.zeros((m, min(_COLUMNS, width - begin)), np.float32)
        present[owner[a:b], column[a:b] - begin] = 1
        common += present @ present.T
    union = sizes[:, None] + sizes[None] - common
    links = common >= similarity * union - 1e-9 * union
    np.fill_diagonal(links, False)
    if side is not None:
        links &= side[:, None] != side[None]
    return links


def _roots(links: np.ndarray) -> np.ndarray:
    """For each row the first row of its component."""
    root = np.full(len(links), -1)
    for k in range(len(links)):
        if root[k] < 0:
            root[k], front = k, np.flatnonzero(links[k])
            while len(front):
                front = front[root[front] < 0]
                root[front] = k
                front = np.flatnonzero(links[front].any(0)) if len(front) else front
                front = front[root[front] < 0]
    return root


def _verified(similarity: float):
    def task(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).to_pydict()
        sets = [np.frombuffer(x, np.uint64) for x in table["shingles"]]
        side = None if table["i"][0] == table["j"][0] else np.array(table["side"])
        links = linked(sets, similarity, side)
        weight = links @ np.array(table["members"], np.float64)
        root = _roots(links)
        rows = np.flatnonzero(links.any(1))
        nodes = table["node"]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([nodes[k] for k in rows], pa.binary()),
                pa.array(weight[rows].astype(np.int64)),
                pa.array([nodes[root[k]] for k in rows], pa.binary()),
            ],
            names=["node", "links", "other"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:  # sorted by group and pair of blocks
            keys = list(zip(*(batch.column(x).to_pylist() for x in ("group", "i", "j"))))
            cuts = [0, *(k for k in range(1, len(keys)) if keys[k] != keys[k - 1]), len(keys)]
            for a, b in zip(cuts, cuts[1:]):
                if b > a:
                    if held and keys[a] != key:
                        yield task(held)
                        held = []
                    key = keys[a]
                    held.append(batch.slice(a, b - a))
        if held:
            yield task(held)

    return run


def near_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    similarity: float = SIMILARITY,
    recall: float = RECALL,
) -> DataFrame:
    """One row per input row: id_col, class_id, n_links, copy_id, n_shingles, row_key, class_key.

    n_links is the number of other rows whose shingle sets have at least this Jaccard similarity;
    class_id is the least id among the rows reached over links, copy_id the least among those with
    the same set (null ids come last). Null texts and texts without a word have no shingles: they link
    to nothing and are a class of their own. Rows with equal ids are documents of their own. Texts are
    taken whole; an empty table gives an empty result; other columns are ignored. row_key is keys.row_key();
    class_key is that of the class's first row, of the least id and then the least key, so that classes
    are told apart and one row of each is found also where ids are null or repeated.
    """
    scratch = Scratch(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    signed = scratch.put(
        rows.mapInArrow(_signatures, f"id {kind}, key binary, node binary, n long, paths array<bigint>")
    )
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "key")).alias("first")
    nodes = scratch.put(
        signed.filter("n > 0")
        .groupBy("node")
        .agg(first, F.count("*").alias("members"), F.first("n").alias("n"), F.first("paths").alias("paths"))
    )
    groups = _candidate_groups(scratch, nodes, matched_depth(similarity, recall))
    found = _links(scratch, rows, nodes, groups, similarity)
    roots = components(scratch, found.select(F.col("node").alias("a"), F.col("other").alias("b")))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    with_root = (
        nodes.select("node", "members", "first")
        .join(counts.hint("merge"), "node", "left")
        .join(roots.hint("merge"), "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    with_root = scratch.put(with_root)
    classes = scratch.put(with_root.groupBy("root").agg(F.min("first").alias("least")))
    summary = scratch.put(
        with_root.join(classes.hint("merge"), "root").select(
            "node",
            F.col("least.id").alias("class_id"),
            F.col("least.key").alias("class_key"),
            F.col("first.id").alias("copy_id"),
            (F.coalesce("links", F.lit(0)) + F.col("members") - 1).alias("n_links"),
        )
    )
    # A row without shingles has no node and meets no other.
    return (
        signed.select("id", "node", "n", "key")
        .join(summary.hint("merge"), "node", "left")
        .select(
            F.col("id").alias(id_col),
            F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("id")).alias("class_id"),
            F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
            F.when(F.col("n") > 0, F.col("copy_id")).otherwise(F.col("id")).alias("copy_id"),
            F.col("n").alias("n_shingles"),
            F.col("key").alias("row_key"),
            F.when(F.col("n") > 0, F.col("class_key")).otherwise(F.col("key")).alias("class_key"),
        )
    )


def _candidate_groups(scratch: Scratch, nodes: DataFrame, depth: int) -> DataFrame:
    """(node, group, blocks) of the nodes that share a path of this length with another."""
    paths = nodes.select("node", F.posexplode("paths").alias("tree", "path")).select(
        "node", "tree", F.shiftrightunsigned("path", BITS * (DEPTH - depth)).alias("path")
    )
    met = scratch.put(
        paths.groupBy("tree", "path").agg(F.min("node").alias("b"), F.count("*").alias("size")).filter("size > 1")
    )
    stars = paths.join(met.select("tree", "path", "b").hint("merge"), ["tree", "path"])
    roots = scratch.put(components(scratch, stars.select(F.col("node").alias("a"), "b")))
    members = roots.join(nodes.select("node", "n").hint("merge"), "node")
    sizes = scratch.put(members.groupBy("root").agg(F.count("*").alias("nodes"), F.sum("n").alias("n")))
    blocks = F.ceil(F.greatest(F.col("nodes") / BLOCK_NODES, F.col("n") / BLOCK_SHINGLES)).cast("int")
    sizes = sizes.select("root", F.least(blocks, "nodes").cast("int").alias("blocks"))
    return scratch.put(roots.join(sizes.hint("merge"), "root").select("node", F.col("root").alias("group"), "blocks"))


def _links(scratch: Scratch, rows: DataFrame, nodes: DataFrame, groups: DataFrame, similarity: float) -> DataFrame:
    """(node, links, other) as the tasks over pairs of blocks return them."""
    wanted = groups.join(nodes.select("node", "members", "first.key").hint("merge"), "node")
    # The join has placed and sorted the rows by key, so one of each is left without a further shuffle.
    texts = rows.drop("id").join(wanted.hint("merge"), "key").dropDuplicates(["key"])
    texts = texts.select("node", "group", "blocks", "members", "text")
    sets = scratch.put(
        texts.mapInArrow(_sets, "node binary, group binary, blocks int, members long, shingles binary")
    )
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    pairs = (
        sets.withColumn("own", own)
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "group",
            F.least("own", "with").alias("i"),
            F.greatest("own", "with").alias("j"),
            (F.col("own") > F.col("with")).cast("int").alias("side"),
            "node",
            "members",
            "shingles",
        )
    )
    dealt = pairs.repartition("group", "i", "j").sortWithinPartitions("group", "i", "j")
    return scratch.put(dealt.mapInArrow(_verified(similarity), "node binary, links long, other binary"))
