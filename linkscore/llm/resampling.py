"""Quality by importance resampling: hashed n-gram models of target and raw text, Gumbel top-k.

Two bags of hashed word unigrams and bigrams are counted in one pass: over a bounded sample of target
texts, whose ids are broadcast, and over all texts. The log ratio of the two generative models for a
document is the sum over its n-grams of the log ratio of their smoothed shares. Its log weight is that
sum or, by default, the mean in its place, which leaves out the length: the sum of a bad but very short
text is near that of an average one. Adding Gumbel noise, drawn from the row's own hash, and keeping the k largest
sums samples k documents without replacement in proportion to their weights. The k-th largest sum is
found by counting in ever finer ranges, not by sorting.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkscore.llm.store import Scratch
from linkscore.llm.words import mixed, separated, text_blocks, word_hashes

BUCKETS = 1 << 15
TEMPERATURE = 0.01
#: N-grams of weight 0 that a mean counts beside the document's own, so that very short ones stay near the average.
PRIOR_GRAMS = 10
#: Most target rows that the target model takes, the first by a hash of their id.
MAX_TARGET = 20_000
RANGES = 1024
SEED = 5


def hashed_grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text number and bucket of every word and every pair of adjoining words."""
    text, begins = separated(data, offsets)
    starts, _, hashes = word_hashes(text)
    doc = np.searchsorted(begins, starts, "right") - 1
    pair = mixed(hashes[:-1] * np.uint64(3) + hashes[1:])[doc[1:] == doc[:-1]]
    pair_doc = doc[1:][doc[1:] == doc[:-1]]
    buckets = (np.concatenate((hashes, pair)) & np.uint64(BUCKETS - 1)).astype(np.int64)
    return np.concatenate((doc, pair_doc)), buckets


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task's texts, all and target, as one row per bucket."""
    total, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        wanted = batch.column(1).to_numpy(zero_copy_only=False)
        for first, n, data, offsets in text_blocks(batch.column(0)):
            doc, buckets = hashed_grams(data, offsets)
            total += np.bincount(buckets, minlength=BUCKETS)
            target += np.bincount(buckets[wanted[first : first + n][doc]], minlength=BUCKETS)
    if total.any():
        columns = [pa.array(np.arange(BUCKETS)), pa.array(total), pa.array(target)]
        yield pa.RecordBatch.from_arrays(columns, names=["bucket", "total", "target"])


def log_ratios(texts: DataFrame, smoothing: float = 1.0) -> np.ndarray:
    """The log of target over raw share of each bucket. texts: text, target."""
    counted = texts.mapInArrow(_bags, "bucket long, total long, target long")
    bags = counted.groupBy("bucket").agg(F.sum("total").alias("total"), F.sum("target").alias("target")).toPandas()
    total, target = np.full(BUCKETS, smoothing), np.full(BUCKETS, smoothing)
    total[bags["bucket"]] += bags["total"].to_numpy(float)
    target[bags["bucket"]] += bags["target"].to_numpy(float)
    return np.log(target / target.sum()) - np.log(total / total.sum())


def weighted(rows: DataFrame, ratios: np.ndarray, temperature: float, per_gram: bool = False) -> DataFrame:
    """rows (id, hash, text) as (id, hash, n_grams, log_weight): the sum of log ratios, or their mean."""
    shared = rows.sparkSession.sparkContext.broadcast(ratios)  # one number per bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n, data, offsets in text_blocks(batch.column(2)):
                doc, buckets = hashed_grams(data, offsets)
                grams = np.bincount(doc, minlength=n)
                logs = np.bincount(doc, weights=shared.value[buckets], minlength=n)
                weight = (logs / (grams + PRIOR_GRAMS) if per_gram else logs) / temperature
                columns = [batch.column(k).slice(first, n) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(grams.astype(np.int64)), pa.array(weight)], names=["id", "hash", "n_grams", "log_weight"]
                )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, hash long, n_grams long, log_weight double")


def kth_largest(frame: DataFrame, column: str, k: int) -> float:
    """The k-th largest value, by counting in ranges that narrow until one value is left."""
    low, high = frame.agg(F.min(column), F.max(column)).first()
    while low < high:
        width = (high - low) / RANGES
        if width == 0 or low + width == low:
            break
        number = F.least(F.floor((F.col(column) - low) / width), F.lit(RANGES - 1))
        inside = frame.filter(F.col(column).between(low, high))
        counts = (
            inside.groupBy(number.alias("range"))
            .agg(F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high"))
            .orderBy(F.desc("range"))
            .collect()  # RANGES rows at most
        )
        for x in counts:
            if k <= x["n"]:
                narrowed = (x["low"], x["high"])
                break
            k -= x["n"]
        if narrowed == (low, high):
            break
        low, high = narrowed
    return low


def resample(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    share: float | None = None,
    temperature: float = TEMPERATURE,
    seed: int = SEED,
    max_target: int = MAX_TARGET,
    per_gram: bool = True,
) -> DataFrame:
    """One row per input row: id_col, n_grams, log_weight, sum (with noise) and kept.

    The target are the texts of rows labelled with quality 1 and not toxic (labels: doc_id, quality,
    toxic), of max_target ids at most; the raw model is counted over all rows. share is the share of rows
    to keep, by default that of quality 1 among the labels. log_weight is the mean log ratio of the
    n-grams over the temperature; without per_gram it is their sum, the log ratio of the two models as
    such, which a temperature of 1 suits. Of equal sums at the border all stay. Null and empty texts have no n-gram, weight 0
    as an average text, and are never kept. Repeated rows draw the same noise. Texts are read whole.
    Without labels all rows with words are kept; an empty table gives an empty result; other columns
    are ignored, whatever their names.
    """
    scratch = Scratch(docs.sparkSession)
    known = labels.filter("quality IS NOT NULL")
    good = known.filter("quality = 1 AND coalesce(toxic, 0) = 0").select(F.col("doc_id").alias("id")).distinct()
    # Executors leave about half as many again as are taken, so that few ids meet where the first are cut.
    drawn = 1.5 * max_target / max(1, good.agg(F.approx_count_distinct("id")).first()[0])
    if drawn < 1:
        good = good.filter(F.xxhash64("id") < int(drawn * (1 << 64)) - (1 << 63))
    good = good.orderBy(F.xxhash64("id"), "id").limit(max_target)
    if share is None:
        share = known.agg(F.avg((F.col("quality") == 1).cast("double"))).first()[0]
    rows = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(F.lit(seed), id_col, text_col).alias("hash"), F.col(text_col).alias("text")
    )
    labelled = rows.join(F.broadcast(good.withColumn("target", F.lit(True))), "id", "left")
    texts = labelled.select("text", F.coalesce("target", F.lit(False)).alias("target"))
    ratios = log_ratios(texts)
    # A uniform number strictly between 0 and 1 from the row's hash.
    uniform = (F.shiftrightunsigned("hash", 11) + 0.5) / float(1 << 53)
    summed = scratch.put(
        weighted(rows, ratios, temperature, per_gram).withColumn("sum", F.col("log_weight") - F.log(-F.log(uniform)))
    )
    worded = summed.filter("n_grams > 0")
    k = worded.count() if share is None else min(round(share * summed.count()), worded.count())
    border = kth_largest(worded, "sum", k) if k else float("inf")
    kept = (F.col("n_grams") > 0) & (F.col("sum") >= border)
    return summed.withColumn("kept", kept).drop("hash").withColumnRenamed("id", id_col)
