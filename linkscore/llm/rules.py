"""Quality rules: a decision list learned from labelled statistics.

Sequential covering: a rule is grown as a conjunction of thresholds, condition by condition, by the
information it gains on the rows that no earlier rule covers; pruned on rows it has not seen; kept
while it is precise there. The list becomes one ordered conditional expression over the columns of
text_statistics, so applying it stays in Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkscore.llm.store import Scratch
from linkscore.llm.words import mixed, separated, text_blocks, word_hashes

SYMBOLS = b"#*$%&|<>"
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Most labelled rows a fit takes, the first by a hash of their id.
MAX_SAMPLE = 20_000

COUNTS = [
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_upper",
    "n_digits",
    "n_punctuation",
    "n_short_words",
    "n_distinct_words",
]
FEATURES = {
    "words": ("n_words", None),
    "chars_per_word": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "words_per_line": ("n_words", "n_lines"),
    "upper_share": ("n_upper", "word_chars"),
    "digit_share": ("n_digits", "word_chars"),
    "punctuation_share": ("n_punctuation", "word_chars"),
    "short_word_share": ("n_short_words", "n_words"),
    "distinct_share": ("n_distinct_words", "n_words"),
}


def _lookup(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


_SYMBOL, _PUNCTUATION = _lookup(SYMBOLS), _lookup(PUNCTUATION)
_UPPER, _DIGIT = _lookup(bytes(range(65, 91))), _lookup(bytes(range(48, 58)))
_CONTINUATION, _SPACE = _lookup(bytes(range(0x80, 0xC0))), _lookup(b" \t\n\v\f\r")
_CODE_POINT = ~_CONTINUATION & ~_SPACE


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Which values occur twice or more."""
    order = np.sort(keys)
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    if not len(twice):
        return np.zeros(len(keys), bool)
    place = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return twice[place] == keys


def _block_counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    n = len(offsets) - 1
    text, begins = separated(data, offsets)
    starts, ends, hashes = word_hashes(text)
    doc = np.searchsorted(begins, starts, "right") - 1

    def per_doc(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(mask[text], dtype=np.int64)))
        return total[begins[1:]] - total[begins[:-1]]

    def words_per_doc(mask: np.ndarray) -> np.ndarray:
        return np.bincount(doc[mask], minlength=n)

    salt = mixed(doc.astype(np.uint64) ^ np.uint64(0xD6E8FEB86659FD93))
    inside = doc[2:] == doc[:-2] if len(doc) > 2 else np.zeros(0, bool)
    repeat_words = np.zeros(len(doc) + 2, bool)
    if inside.any():
        three = hashes[:-2] + hashes[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[2:] * np.uint64(0x165667B19E3779F9)
        at = np.flatnonzero(inside)
        again = at[_repeated(mixed(three[at]) ^ salt[at])]
        for k in range(3):
            repeat_words[again + k] = True
    in_word = np.concatenate(([0], np.cumsum(_CODE_POINT[text], dtype=np.int64)))
    return {
        "n_words": np.bincount(doc, minlength=n),
        "word_chars": per_doc(_CODE_POINT),
        "n_symbols": per_doc(_SYMBOL),
        "n_repeat_words": words_per_doc(repeat_words[: len(doc)]),
        "n_upper": per_doc(_UPPER),
        "n_digits": per_doc(_DIGIT),
        "n_punctuation": per_doc(_PUNCTUATION),
        "n_short_words": words_per_doc(in_word[ends] - in_word[starts] <= 3),
        "n_distinct_words": np.bincount(doc[np.unique(hashes ^ salt, return_index=True)[1]], minlength=n),
    }


def _lines(text: str | None) -> tuple[int, int]:
    """Lines with a word, and those among them equal to an earlier line."""
    lines = (text or "").split("\n")
    with_word = [x for x in lines if x.strip(" \t\v\f\r")]
    return len(with_word), len(with_word) - len(set(with_word))


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        for first, rows, data, offsets in text_blocks(texts):
            counts = _block_counts(data, offsets)
            lines = np.array([_lines(x) for x in texts.slice(first, rows).to_pylist()], np.int64)
            counts |= {"n_lines": lines[:, 0], "n_dup_lines": lines[:, 1]}
            columns = [pa.array(counts[x].astype(np.int64)) for x in COUNTS]
            yield pa.RecordBatch.from_arrays([ids.slice(first, rows), *columns], names=["id", *COUNTS])


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id and the counts of COUNTS over the whole text; null has none.

    Words are runs of characters other than ASCII white space. A 3-word window counts as repeated if
    it occurs twice or more in its text. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, " + ", ".join(f"{x} long" for x in COUNTS)
    return rows.mapInArrow(_statistics, schema)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def feature(name: str) -> Column:
    over, under = FEATURES[name]
    if under is None:
        return F.col(over).cast("double")
    return F.when(F.col(under) > 0, F.col(over) / F.col(under)).otherwise(0.0)


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def holds(self, columns: dict[str, np.ndarray]) -> np.ndarray:
        x = columns[self.feature]
        return x >= self.threshold if self.at_least else x <= self.threshold

    def column(self) -> Column:
        x = feature(self.feature)
        return x >= self.threshold if self.at_least else x <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _covers(rule: Rule, columns: dict[str, np.ndarray], n: int) -> np.ndarray:
    covered = np.ones(n, bool)
    for condition in rule:
        covered &= condition.holds(columns)
    return covered


def _grown(columns: dict[str, np.ndarray], bad: np.ndarray, max_conditions: int, cuts: int) -> Rule:
    rule: Rule = ()
    covered = np.ones(len(bad), bool)
    while len(rule) < max_conditions:
        p, n = int((covered & bad).sum()), int((covered & ~bad).sum())
        if not p or not n:
            break
        before, best = np.log2(p / (p + n)), (1e-9, None)
        for name, x in columns.items():
            values = np.unique(np.quantile(x[covered & bad], np.linspace(0, 1, cuts)))
            good_x, bad_x = np.sort(x[covered & ~bad]), np.sort(x[covered & bad])
            for at_least in (True, False):
                side = "left" if at_least else "right"
                pp, nn = np.searchsorted(bad_x, values, side), np.searchsorted(good_x, values, side)
                pp, nn = (p - pp, n - nn) if at_least else (pp, nn)
                gain = pp * (np.log2(np.maximum(pp, 1e-9) / np.maximum(pp + nn, 1e-9)) - before)
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (gain[k], Condition(name, at_least, float(values[k])))
        if best[1] is None:
            break
        rule += (best[1],)
        covered &= best[1].holds(columns)
    return rule


def _pruned(rule: Rule, columns: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """The start of the rule that separates the unseen rows best."""

    def worth(r: Rule) -> float:
        covered = _covers(r, columns, len(bad))
        p, n = (covered & bad).sum(), (covered & ~bad).sum()
        return (p - n) / (p + n) if p + n else -1.0

    return max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda r: (worth(r), -len(r)), default=())


def learn(
    columns: dict[str, np.ndarray],
    bad: np.ndarray,
    max_rules: int = 12,
    max_conditions: int = 4,
    cuts: int = 33,
    min_precision: float = 0.95,
    min_covered: int = 3,
) -> list[Rule]:
    """Rules that reject, in order. Every third row prunes, the others grow."""
    held = np.arange(len(bad)) % 3 == 2
    grow = {k: v[~held] for k, v in columns.items()}
    prune = {k: v[held] for k, v in columns.items()}
    grow_bad, prune_bad = bad[~held], bad[held]
    rules: list[Rule] = []
    while len(rules) < max_rules and grow_bad.any():
        rule = _pruned(_grown(grow, grow_bad, max_conditions, cuts), prune, prune_bad)
        if not rule:
            break
        seen, unseen = _covers(rule, grow, len(grow_bad)), _covers(rule, prune, len(prune_bad))
        hits = int((seen & grow_bad).sum() + (unseen & prune_bad).sum())
        if hits < min_covered or hits < min_precision * int(seen.sum() + unseen.sum()):
            break
        rules.append(rule)
        grow, grow_bad = {k: v[~seen] for k, v in grow.items()}, grow_bad[~seen]
        prune, prune_bad = {k: v[~unseen] for k, v in prune.items()}, prune_bad[~unseen]
    return rules


def as_column(rules: list[Rule]) -> Column:
    """The number of the first rule that holds, from 1; 0 if none does."""
    verdict = None
    for k, rule in enumerate(rules, 1):
        holds = rule[0].column()
        for condition in rule[1:]:
            holds &= condition.column()
        verdict = F.when(holds, k) if verdict is None else verdict.when(holds, k)
    return F.lit(0) if verdict is None else verdict.otherwise(0)


def fit(statistics: DataFrame, labels: DataFrame, max_sample: int = MAX_SAMPLE) -> list[Rule]:
    """Rules from the labelled rows, at most max_sample of them by a hash of id, label and features.

    labels: doc_id, quality (0 is bad, null is no label). Rows with the same id, label and features
    count once. Executors cut the sample by a bound on the hash, so what the driver reads does not grow
    with the labels. Without labels there are no rules.
    """
    known = labels.filter("quality IS NOT NULL").select(F.col("doc_id").alias("id"), "quality")
    rows = statistics.join(known, "id").select("quality", *(feature(x).alias(x) for x in FEATURES), F.xxhash64("id").alias("order"))
    drawn = F.xxhash64("order", "quality", *FEATURES)
    rows = Scratch(statistics.sparkSession).put(rows.withColumn("drawn", drawn))
    different = rows.agg(F.approx_count_distinct("drawn")).first()[0]
    # Half as many again are below the bound on average, since the count is an estimate.
    share = 1.5 * max_sample / max(1, different)
    if share < 1:
        rows = rows.filter(F.col("drawn") < int(share * (1 << 64)) - (1 << 63))
    sample = rows.dropDuplicates(["drawn"]).toPandas().nsmallest(max_sample, "drawn").sort_values(["order", "quality", "drawn"])
    return learn({x: sample[x].to_numpy(float) for x in FEATURES}, sample["quality"].to_numpy() == 0)


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id_col, the counts, base_failed, rule (0: none holds) and kept.

    kept is false where the base rules fail or a learned rule holds. A null or empty text has no
    words and fails. Repeated ids stay as rows of their own. Texts are read whole; an empty table gives
    an empty result; other columns are ignored, whatever their names.
    """
    statistics = Scratch(docs.sparkSession).put(text_statistics(docs, id_col, text_col))
    rules = fit(statistics, labels)
    return (
        statistics.withColumn("base_failed", base_failed())
        .withColumn("rule", as_column(rules))
        .withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))
        .withColumnRenamed("id", id_col)
    )
