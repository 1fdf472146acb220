"""Language identification with error-correcting output codes.

Every language gets a codeword. One binary classifier per bit, a logistic regression over hashed
byte n-grams of the lower-cased letters, predicts the bits of a whole text. Decoding adds up, for
each codeword, the logistic loss of the bits, weighted by how reliable each bit's classifier is, and
takes the codeword with the least; a text whose two nearest codewords are about as near is flagged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkscore.llm.words import separated, text_blocks

UNKNOWN = "und"
BUCKETS = 4096
#: Most texts of a language that a fit takes, the first by a hash of id and text; each adds a short cut of itself.
MAX_PER_LANGUAGE = 400
#: Most texts of a fit. With more languages each gives fewer, one at least: every language is learned.
MAX_TEXTS = 6400
#: Most numbers of rows x languages that decoding holds at once.
_DECODED = 1 << 22
AMBIGUOUS = 0.6

_LETTER = regex.compile(r"\p{L}")
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[:65] = _FOLD[91:97] = _FOLD[123:128] = 32
_GRAMS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


def _hashed(data: np.ndarray) -> list[np.ndarray]:
    """Buckets of the 2-, 3- and 4-byte grams that begin at each byte."""
    b = data.astype(np.uint32)
    gram, found = b, []
    for n, odd in zip((1, 2, 3), _GRAMS):
        gram = (gram[:-1] << np.uint32(8)) ^ b[n:]
        h = gram * odd
        found.append(((h ^ (h >> np.uint32(15))) * np.uint32(0x27D4EB2F) >> np.uint32(20)).astype(np.int32))
    return found


def _folded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters in lower case, runs of all else as one space, a space before and after each text."""
    text, begins = separated(data, offsets)
    text = np.concatenate(([np.uint8(32)], _FOLD[text]))
    # Upper-case letters of Latin-1 follow a byte of 0xC3 in UTF-8.
    text[1:][(text[:-1] == 0xC3) & (text[1:] >= 0x80) & (text[1:] <= 0x9E)] += 32
    keep = np.ones(len(text), bool)
    keep[1:] = (text[1:] != 32) | (text[:-1] != 32)
    keep[begins[1:]] = True
    place = np.concatenate(([0], np.cumsum(keep)))
    return text[keep], place[begins]


def features(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """For each text a unit vector of the square roots of its gram counts; zeros without letters."""
    text, begins = _folded(data, offsets)
    grams = _hashed(np.append(text, np.full(3, 32, np.uint8)))
    for a, b in zip(begins[:-1], begins[1:]):
        x = np.zeros(BUCKETS, np.int64)
        for n, g in enumerate(grams, 1):
            x += np.bincount(g[a : max(a, b - n + 1)], minlength=BUCKETS)
        root = np.sqrt(x, dtype=np.float32)
        size = float(np.sqrt(np.float64(x.sum())))
        yield root / np.float32(size) if size else root


def _later(first: int, k: int) -> np.ndarray:
    """Which pairs of the 512 rows from first with the k - first - 1 rows after it hold a row and a later one."""
    return np.arange(first, min(first + 512, k))[:, None] < np.arange(first + 1, k)[None]


def codewords(k: int, seed: int = 7) -> np.ndarray:
    """k codewords of -1 and 1: all splits of the languages up to 5, else random rows kept apart."""
    if k < 2:
        return np.ones((k, 1))
    if k <= 5:
        bits = [[(s >> j) & 1 for s in range(1, 1 << (k - 1))] for j in range(k)]
        return np.array(bits) * 2.0 - 1
    rng, best = np.random.default_rng(seed), None
    width = int(np.ceil(10 * np.log2(k)))
    for _ in range(max(1, min(200, 400_000_000 // (k * k)))):
        code = rng.integers(0, 2, (k, width)) * 2.0 - 1
        code = code[:, np.abs(code.sum(0)) < k]
        # Rows of -1 and 1 differ in half of what their product lacks to the full length.
        nearest = max((code[i : i + 512] @ code[i + 1 :].T)[_later(i, k)].max() for i in range(0, k - 1, 512))
        apart = (code.shape[1] - nearest) / 2
        if best is None or apart > best[0]:
            best = (apart, code)
    return best[1]


@dataclass(frozen=True)
class Model:
    """languages, codewords [k, bits], weights [buckets + 1, bits], reliability [bits]."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    reliability: np.ndarray

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best language and its share for rows of bit margins: shares are exponentials of the weighted losses.

        The loss log(1 + exp(-margin)) of a bit that should be 1 grows by the margin if it should be -1; the
        first is the same for all languages, so the losses differ by a product of margins and codewords.
        """
        other = (self.code < 0).T.astype(float)
        step = max(1, _DECODED // len(self.languages))
        best, share = np.zeros(len(margins), np.int64), np.zeros(len(margins))
        for a in range(0, len(margins), step):
            loss = (margins[a : a + step] * self.reliability) @ other
            best[a : a + step] = loss.argmin(1)
            share[a : a + step] = 1 / np.exp(loss.min(1, keepdims=True) - loss).sum(1)
        return best, share

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        bias = self.weights[-1]
        margins = np.array([x @ self.weights[:-1] + bias for x in features(data, offsets)])
        return self.decode(margins.reshape(-1, self.code.shape[1]))


def train(x: np.ndarray, y: np.ndarray, languages: list[str], steps: int = 120, ridge: float = 1e-4) -> Model:
    """Logistic regressions for all bits at once, by accelerated gradient descent; each language weighs the same."""
    code = codewords(len(languages))
    target = code[y]
    x = np.hstack([x, np.ones((len(x), 1), np.float32)]).astype(np.float32, copy=False)
    share = (1.0 / np.bincount(y, minlength=len(languages)).clip(1))[y]
    share = (share / share.sum())[:, None].astype(np.float32)
    w = np.zeros((x.shape[1], code.shape[1]), np.float32)
    ahead, rate = w, 2.0 / (0.25 * float(share[:, 0] @ np.einsum("ij,ij->i", x, x)) + ridge)
    for step in range(steps):
        margin = (x @ ahead) * target
        slope = x.T @ (-target * share / (1 + np.exp(np.clip(margin, -30, 30)))).astype(np.float32) + ridge * ahead
        new = ahead - rate * slope
        ahead, w = new + (step / (step + 3)) * (new - w), new
    right = ((x @ w) * target > 0).T @ share[:, 0]
    reliability = np.clip(2 * right - 1, 0.05, 1.0)
    return Model(languages, code, w, reliability / reliability.mean())


def _cut(text: str, number: int) -> str:
    """A few words of the text, so that the model also learns from short ones."""
    words = text.split()
    n = 1 + number % 12
    begin = (number // 12) % max(1, len(words) - n + 1)
    return " ".join(words[begin : begin + n])


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The features of each text and of its cut in one row; rows of the same language, id and text once a partition."""
    seen = set()
    for batch in batches:
        keys = list(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()))
        new = [k for k, key in enumerate(keys) if not (key in seen or seen.add(key))]
        batch = batch.take(pa.array(new, pa.int64()))
        if not new:
            continue
        cuts = [_cut(t, keys[k][1]) for k, t in zip(new, batch.column(1).to_pylist())]
        both = [
            [x.astype(np.float16).tobytes() for _, _, d, o in text_blocks(texts) for x in features(d, o)]
            for texts in (batch.column(1), pa.array(cuts, pa.string()))
        ]
        rows = pa.array([a + b for a, b in zip(*both)], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), rows, batch.column(2)], names=["lang", "x", "order"])


def fit(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    order: Column | None = None,
    max_per_language: int = MAX_PER_LANGUAGE,
    max_texts: int = MAX_TEXTS,
) -> Model | None:
    """A model from a bounded sample of the labelled rows; None if no row has both text and label.

    The sample are the first max_per_language rows of a language by a hash of id (or order) and text, so
    null and repeated ids are drawn like others, and rows of the same id and text count once. Executors
    cut it before the driver reads it. Every language is learned; with more than max_texts /
    max_per_language of them each gives fewer rows, one at least.
    """
    order = F.xxhash64(F.col("doc_id") if order is None else order, text_col).bitwiseAND(F.lit((1 << 63) - 1))
    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), order.alias("order"))
    rows = rows.filter("lang IS NOT NULL AND text IS NOT NULL")
    known = (
        rows.groupBy("lang")
        .agg(F.approx_count_distinct("order").alias("different"), F.min("order").alias("least"))
        .collect()  # one row a language
    )
    if not known:
        return None
    most = max(1, min(max_per_language, max_texts // len(known)))
    # A bound that half as many again are under on average, since the count is an estimate; one row at least.
    bounds = [
        (x["lang"], max(x["least"], int(min(1.0, (1.5 * most + 8) / max(1, x["different"])) * ((1 << 63) - 1024))))
        for x in known
    ]
    bounds = F.broadcast(docs.sparkSession.createDataFrame(bounds, "lang string, bound long"))  # one row a language
    drawn = rows.join(bounds, "lang").filter("order <= bound").select("lang", "text", "order")
    drawn = drawn.mapInArrow(_sample_features, "lang string, x binary, order long").dropDuplicates(["lang", "order"])
    place = F.row_number().over(Window.partitionBy("lang").orderBy("order"))
    sample = drawn.withColumn("place", place).filter(F.col("place") <= most).toPandas()
    sample = sample.sort_values(["lang", "order"])
    languages = sorted(x["lang"] for x in known)
    x = np.frombuffer(b"".join(sample["x"]), np.float16).reshape(-1, BUCKETS).astype(np.float32)
    number = {lang: k for k, lang in enumerate(languages)}
    return train(x, sample["lang"].map(number).to_numpy(np.int64).repeat(2), languages)


def identify(
    docs: DataFrame, model: Model | None, id_col: str | Column = "doc_id", text_col: str = "text", name: str = "doc_id"
) -> DataFrame:
    """One row per input row: id_col, lang_pred, score (0 to 1), ambiguous.

    id_col may be any column to carry along, such as a struct of all columns, under name. Only the text
    is read, the whole of it. Null texts, texts without a letter, and all texts if there is no model,
    are `und` with score 0 and not ambiguous. Rows are independent of each other.
    """
    carried = F.col(id_col) if isinstance(id_col, str) else id_col
    rows = docs.select(carried.alias("id"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded: buckets x bits

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for first, n, data, offsets in text_blocks(batch.column(1)):
                texts = batch.column(1).slice(first, n).to_pylist()
                known = np.array([bool(t and model and _LETTER.search(t)) for t in texts])
                lang, score = np.full(n, UNKNOWN, object), np.zeros(n)
                if known.any():
                    best, share = model.predict(data, offsets)
                    lang[known] = np.array(model.languages, object)[best[known]]
                    score[known] = share[known]
                columns = [pa.array(lang, pa.string()), pa.array(score), pa.array(known & (score < AMBIGUOUS))]
                names = ["id", "lang_pred", "score", "ambiguous"]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), *columns], names=names)

    schema = T.StructType(
        [
            T.StructField("id", rows.schema["id"].dataType),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("ambiguous", T.BooleanType()),
        ]
    )
    return rows.mapInArrow(predict, schema).withColumnRenamed("id", id_col if isinstance(id_col, str) else name)


def learnable(doc_id: Column) -> Column:
    """Rows that a model may learn from; the others are held out to judge it."""
    return ~held_out(doc_id)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))
