"""Mixing sources to target weights: temperature, then budgeted block permutations. DataFrame code only.

The weight of a source is its share of the tokens raised to an exponent, normalised: 1 keeps the
natural mix, 0 makes all sources equal. The exponent is bisected to the flattest mix that meets a
target: an entropy of the weights, or a limit on how often the most repeated source is passed over.
The budget of tokens is split by the weights. A source's quota is realised as whole passes over its
documents and a part of one more, each pass a permutation of its own: documents are dealt into blocks
by a keyed hash, and follow each other in hash order within a block. Running sums of tokens are taken
over the spans of blocks of a source, over the blocks of one span and over the documents of one block,
and the quota ends where they together reach it, so no source, however large, is sorted or summed in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkscore.llm.keys import row_key
from linkscore.llm.store import Scratch

BLOCK_DOCS = 2_000
#: Blocks that follow each other are summed as one span first.
SPAN_BLOCKS = 2_000
#: Rows of the same id, text and source that are numbered in one go.
COPIES = 4_096
#: The exponent is found to 64 ** -ROUNDS.
STEPS, ROUNDS = 64, 5
SEED = 17


def n_tokens(text: Column) -> Column:
    """Words of the text, runs of characters other than ASCII white space; a document counts as one at least."""
    words = F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    return F.greatest(words, F.lit(1)).cast("long")


def _weights_at(sources: DataFrame, lowest: float, width: float) -> DataFrame:
    """Weights of all sources for STEPS + 1 exponents from lowest on."""
    grid = F.sequence(F.lit(0), F.lit(STEPS))
    raised = sources.select("*", F.explode(grid).alias("step")).withColumn(
        "alpha", F.lit(lowest) + F.col("step") * (width / STEPS)
    )
    raised = raised.withColumn("power", F.pow("share", "alpha"))
    total = raised.groupBy("step").agg(F.sum("power").alias("total"))
    return raised.join(F.broadcast(total), "step").withColumn("weight", F.col("power") / F.col("total"))


def exponent(
    sources: DataFrame, budget: float | None, max_entropy: float | None = None, max_passes: float | None = None
) -> float:
    """The least exponent in 0..1 whose mix has at most max_entropy (in bits, as a share of the most that the
    sources allow) and passes over no source more than max_passes times.

    sources: source, tokens, share (of all tokens). With no budget, the budget is what passes over
    every source once at least. Both measures fall as the exponent grows. If even 1 misses the
    target, it is 1. Without sources it is 1.
    """
    lowest, width = 0.0, 1.0
    for _ in range(ROUNDS):
        at = _weights_at(sources, lowest, width)
        passes = F.col("weight") / F.col("tokens")
        measured = (
            at.groupBy("step")
            .agg(
                (-F.sum(F.col("weight") * F.log2("weight")) / F.greatest(F.log2(F.count("*")), F.lit(1e-9))).alias("entropy"),
                F.max(passes).alias("most"),
                F.min(passes).alias("least"),
            )
            .orderBy("step")
            .collect()  # STEPS + 1 rows
        )
        meets = lambda x: (max_entropy is None or x["entropy"] <= max_entropy + 1e-12) and (
            max_passes is None or (x["most"] * budget if budget else x["most"] / x["least"]) <= max_passes * (1 + 1e-12)
        )
        first = next((x["step"] for x in measured if meets(x)), None)
        if first is None:
            return 1.0
        if first == 0:
            return lowest
        lowest, width = lowest + (first - 1) * width / STEPS, width / STEPS
    return lowest + width


def mix(
    docs: DataFrame,
    source_col: str = "source",
    id_col: str = "doc_id",
    text_col: str = "text",
    budget_tokens: int | None = None,
    max_entropy: float | None = None,
    max_passes: float | None = 2.0,
    seed: int = SEED,
) -> DataFrame:
    """One row per realised document: id_col, source, n_tokens, weight, pass, block, mix_position, row_key.

    budget_tokens is the size of the mix; by default the least that takes every document once at
    least. A source is passed over whole as often as its quota allows, then documents are taken while
    the quota is not reached (the last one may exceed it). mix_position in 0..1 is how far into its
    source's quota a document begins; sorting by it interleaves the sources evenly. A null source is a
    source of its own. Null texts count as one token, texts are counted whole. Rows with equal ids are
    realised each. An empty table gives an empty result; other columns are ignored. row_key is
    keys.row_key(). The mix depends on the rows alone, not on their order or partitions.
    """
    scratch = Scratch(docs.sparkSession)
    rows = scratch.put(
        _numbered(
            docs.select(
                F.col(id_col).alias("id"),
                F.col(source_col).alias("source"),
                n_tokens(F.col(text_col)).alias("n_tokens"),
                row_key(id_col, text_col).alias("row_key"),
            )
        )
    )
    totals = scratch.put(rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs")))
    everything = totals.agg(F.sum("tokens").alias("t")).first()["t"] or 1
    sources = totals.withColumn("share", F.col("tokens") / F.lit(everything))
    alpha = exponent(sources, budget_tokens, max_entropy, max_passes)
    plan = scratch.put(_quotas(sources, alpha, budget_tokens))
    return _realised(scratch, rows, plan, seed).withColumnRenamed("id", id_col)


def _numbered(rows: DataFrame) -> DataFrame:
    """The rows with `copy`, a number from 0 among those of the same id, text and source.

    They are counted, and as many rows as were counted are made of each; parts of a large count are
    dealt to different tasks first.
    """
    same = rows.groupBy("row_key", "source").agg(
        F.first("id").alias("id"), F.first("n_tokens").alias("n_tokens"), F.count("*").alias("copies")
    )
    parts = same.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) DIV {COPIES}"))))
    several = parts.filter("copies > 1").repartition("row_key", "part")
    last = F.least("copies", (F.col("part") + 1) * COPIES) - 1
    numbered = several.withColumn("copy", F.explode(F.sequence(F.col("part") * COPIES, last)))
    single = parts.filter("copies = 1").withColumn("copy", F.lit(0).cast("long"))
    return single.unionByName(numbered).drop("copies", "part")


def _quotas(sources: DataFrame, alpha: float, budget: int | None) -> DataFrame:
    """(source, tokens, weight, quota, passes, blocks): passes are those begun."""
    raised = sources.withColumn("power", F.pow("share", F.lit(alpha)))
    total, once = raised.agg(F.sum("power"), F.max(F.col("tokens") / F.col("power"))).first()
    weight = F.col("power") / F.lit(total)
    quota = F.lit(budget).cast("double") * weight if budget else F.col("power") * F.lit(once)
    return (
        raised.withColumn("weight", weight)
        .withColumn("quota", F.round(quota).cast("long"))
        .withColumn("passes", F.greatest(F.ceil(F.col("quota") / F.col("tokens")), F.lit(1)).cast("int"))
        .withColumn("blocks", F.ceil(F.col("docs") / BLOCK_DOCS).cast("long"))
        .select("source", "tokens", "weight", "quota", "passes", "blocks")
    )


def _block_starts(scratch: Scratch, blocks: DataFrame, span_blocks: int = SPAN_BLOCKS) -> DataFrame:
    """(source, pass, block, block_tokens, before): the tokens of the source that come before each block.

    A source of n documents has n / BLOCK_DOCS blocks; a task sums the spans of a source or the blocks of a span.
    """
    blocks = scratch.put(blocks.withColumn("span", F.expr(f"block DIV {span_blocks}")))
    spans = blocks.groupBy("source", "pass", "span").agg(F.sum("block_tokens").alias("span_tokens"), F.first("tokens").alias("tokens"))
    until = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = spans.select(
        F.col("source").alias("s"),
        F.col("pass").alias("p"),
        F.col("span").alias("n"),
        (F.col("pass") * F.col("tokens") + F.sum("span_tokens").over(until("source", "pass").orderBy("span")) - F.col("span_tokens")).alias("first"),
    )
    same = F.col("source").eqNullSafe(F.col("s")) & (F.col("pass") == F.col("p")) & (F.col("span") == F.col("n"))
    inside = F.sum("block_tokens").over(until("source", "pass", "span").orderBy("block")) - F.col("block_tokens")
    placed = blocks.withColumn("inside", inside).join(spans, same)
    return placed.select("source", "pass", "block", "block_tokens", (F.col("first") + F.col("inside")).alias("before"))


def _realised(scratch: Scratch, rows: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    same_source = F.col("source").eqNullSafe(F.col("plan_source"))
    plan = plan.withColumnRenamed("source", "plan_source")
    each = (
        rows.join(plan, same_source)
        .withColumn("pass", F.explode(F.sequence(F.lit(0), F.col("passes") - 1)))
        .withColumn("turn", F.xxhash64(F.lit(seed), "pass", "row_key", "copy"))
        .withColumn("block", F.pmod(F.xxhash64("turn"), F.col("blocks")))
    )
    each = scratch.put(each.drop("plan_source", "blocks", "passes"))
    group = ["source", "pass", "block"]
    blocks = each.groupBy(*group).agg(F.sum("n_tokens").alias("block_tokens"), F.first("tokens").alias("tokens"))
    starts = scratch.put(_block_starts(scratch, blocks).withColumnRenamed("source", "s"))
    starts = starts.withColumnRenamed("pass", "p").withColumnRenamed("block", "b")
    at_block = F.col("source").eqNullSafe(F.col("s")) & (F.col("pass") == F.col("p")) & (F.col("block") == F.col("b"))
    placed = each.join(starts, at_block).drop("s", "p", "b").filter("before < quota")
    in_block = (
        Window.partitionBy(*group).orderBy("turn", "row_key", "copy").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    begin = F.col("before") + F.sum("n_tokens").over(in_block) - F.col("n_tokens")
    return (
        placed.withColumn("begin", begin)
        .filter("begin < quota")
        .select(
            "id",
            "source",
            "n_tokens",
            "weight",
            "pass",
            "block",
            (F.col("begin") / F.col("quota")).alias("mix_position"),
            "row_key",
        )
    )
