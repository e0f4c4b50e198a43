"""Quality rules: plain counts of each text, and a classifier of hashed n-grams.

The classifier is a logistic regression over hashed features, trained on the
labelled rows and calibrated on others of them:

* a text's words give word 1- and 2-grams, its characters give 3- and 4-grams;
  each kind is hashed into ``SIDE`` places, and a place's value is the square
  root of its share of the text's n-grams of the kind (each kind is a unit
  vector, so length is no feature);
* Spark's logistic regression is fitted on ``FIT_ROWS`` labelled documents at
  most, with classes weighted alike;
* labelled documents that the fit has not seen (one in ``CALIBRATE_ONE_IN``)
  calibrate its margins to probabilities by Platt's method;
* every text is scored whole where it lies, in Arrow batches, against the
  fixed thresholds below.

Documents with crc32(doc_id as text) mod 4 = 2 are neither fitted nor
calibrated on, so their labels stay for testing.

Bounds: the labelled documents that are learned from are chosen by a hash of
their id, about ``FIT_ROWS`` of them at any size; a labelled id counts once,
with the smallest of its texts.  Counts, features and scores cover whole texts.
The model is 2 * ``SIDE`` weights and is broadcast.

Defined results: null, empty and blank texts have no words, fail the base
rules and are not kept; ``quality`` is the probability of a good text, also
for them.  Ids with labels of both kinds are learned once with each.  With no
labelled row, ``quality`` is null and the base rules alone decide; with labels
of one kind it is that kind's smoothed share.  Rows that repeat, or have no
id, each keep their row; other columns are left out; an empty table gives an
empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .common import discard, id_fold, map_rows, stored, texts_of

#: Fixed rules.
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
SYMBOLS = b"#*$%&|<>"
#: A text is kept from this probability on.
KEEP_FROM = 0.5

#: Places of each kind of n-gram.
SIDE = 1 << 14
#: Labelled documents that are learned from, about, and the share of them that calibrates.
FIT_ROWS = 8_000
CALIBRATE_ONE_IN = 4
REGULARIZATION = 1e-4
ROUNDS = 60
#: Characters and words folded at a time, so that a very long text needs bounded memory.
BLOCK = 1 << 20

_BLANKS = b" \t\n\x0b\x0c\r"
_MIX = np.uint64(0x9E3779B97F4A7C15)  # odd, the golden ratio of 64 bits
_SHIFT = np.uint64(64 - SIDE.bit_length() + 1)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_COUNT_TYPES = ", ".join(f"{c} long" for c in COUNTS)


def word_codes(words: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """A number for each word, equal for equal words, and the distinct words by number."""
    numbers = dict.fromkeys(words)
    distinct = list(numbers)
    numbers.update(zip(distinct, range(len(distinct)), strict=True))
    return np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)), distinct


def repeated_words(codes: np.ndarray, distinct: int) -> int:
    """Words that lie in a window of three words that the text holds twice or more."""
    if len(codes) < 4:
        return 0
    if distinct < 1 << 20:
        windows = (codes[:-2] * distinct + codes[1:-1]) * distinct + codes[2:]
    else:  # the product would pass 63 bits: number the pairs first
        pairs = np.unique(codes[:-1] * distinct + codes[1:], return_inverse=True)[1]
        windows = pairs[:-1] * distinct + codes[2:]
    ordered = np.sort(windows)
    again = np.isin(windows, ordered[1:][ordered[1:] == ordered[:-1]])
    inside = np.zeros(len(codes), bool)
    for i in range(3):
        inside[i:len(again) + i] |= again
    return int(inside.sum())


def base_counts(text: str, raw: bytes, codes: np.ndarray, distinct: int) -> tuple[int, ...]:
    """The values of ``COUNTS`` for a text, its UTF-8 bytes and its words' numbers."""
    lines = [line for line in raw.split(b"\n") if line.strip(_BLANKS)]
    return (len(codes), len(text) - sum(raw.count(b) for b in _BLANKS), sum(raw.count(b) for b in SYMBOLS),
            len(lines) - len(set(lines)), repeated_words(codes, distinct))


def gram_counts(text: str, codes: np.ndarray, distinct: list[bytes]) -> np.ndarray:
    """How often a text's n-grams fall into each of the 2 * ``SIDE`` places, words first."""
    out = np.zeros(2 * SIDE, np.int64)
    names = np.fromiter(map(zlib.crc32, distinct), np.uint64, len(distinct))
    for start in range(0, max(len(codes), len(text)), BLOCK):
        # a block's last word or characters but the text's last are only the ends of n-grams that begin in it
        words = names[codes[start:start + BLOCK + 1]]
        points = np.frombuffer(text[start:start + BLOCK + 3].encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
        three = (points[:-2] << np.uint64(42)) | (points[1:-1] << np.uint64(21)) | points[2:]
        four = three[:-1] * np.uint64(0x1_0000_01B3) + points[3:]
        grams = (words[:BLOCK] + np.uint64(1), words[:-1] * np.uint64(0x1_0000_01B3) + words[1:], three[:BLOCK], four)
        places = ((np.concatenate(grams) * _MIX) >> _SHIFT).astype(np.int64)
        places[len(grams[0]) + len(grams[1]):] += SIDE
        out += np.bincount(places, minlength=2 * SIDE)
    return out


def hashed_shares(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places that a text's n-grams fall into, and their values: square roots of their shares of the kind."""
    places = np.flatnonzero(counts)
    values = np.sqrt(counts[places])
    words = int(np.searchsorted(places, SIDE))
    for own in (values[:words], values[words:]):
        if len(own):
            own /= np.sqrt(own @ own)
    return places, values


def _fold(text: str | None) -> tuple[tuple[int, ...], tuple[np.ndarray, np.ndarray]]:
    """Counts and features of one text."""
    text = text or ""
    raw = text.encode("utf-8", "replace")
    codes, distinct = word_codes(raw.split())
    return base_counts(text, raw, codes, len(distinct)), hashed_shares(gram_counts(text, codes, distinct))


def labelled_texts(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, text, quality) of about ``rows`` labelled ids that may be learned from, each with one text."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
             .filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & (id_fold(F.col("doc_id")) != 2)).distinct())
    total = known.count()
    # spread over the ids by a hash; the largest 63-bit hash passes if all rows may be taken
    share = 1.0 if total <= rows else rows / total
    chosen = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < F.lit(int(share * (1 << 40))))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    own = (texts.join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id", "left_semi")  # about ``rows`` numbers
           .groupBy("doc_id").agg(F.min("text").alias("text")))
    return own.join(chosen, "doc_id")


#: How Spark's ML vectors lie in a table: 0 marks a sparse one.
_VECTOR = "struct<type: tinyint, size: int, indices: array<int>, values: array<double>>"


def featured(labelled: DataFrame) -> DataFrame:
    """(doc_id, quality, features) of labelled texts, features as the fields of an ML vector."""
    vector = pa.struct([("type", pa.int8()), ("size", pa.int32()), ("indices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part, rows = batch.slice(start, 64), []
                for (text,) in texts_of([part], "text"):
                    places, values = _fold(text)[1]
                    rows.append({"type": 0, "size": 2 * SIDE, "indices": places, "values": values})
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("quality"), pa.array(rows, vector)], names=["doc_id", "quality", "features"])

    return map_rows(labelled, fold, f"doc_id long, quality int, features {_VECTOR}")


def _as_vectors(table: DataFrame) -> DataFrame:
    """The stored ``featured`` rows with ``features`` read as ML vectors."""
    schema = StructType([*(f for f in table.schema if f.name != "features"), StructField("features", VectorUDT())])
    return table.sparkSession.read.schema(schema).parquet(*sorted({f.rsplit("/", 1)[0] for f in table.inputFiles()}))


class Model:
    """Weights of the places, intercept, and Platt's slope and offset."""

    def __init__(self, weights: np.ndarray, intercept: float, slope: float, offset: float):
        self.weights, self.intercept, self.slope, self.offset = weights, intercept, slope, offset

    def quality(self, places: np.ndarray, values: np.ndarray) -> float:
        margin = self.slope * (float(self.weights[places] @ values) + self.intercept) + self.offset
        return float(1 / (1 + np.exp(-np.clip(margin, -500, 500))))


def platt(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the likeliest logistic curve through smoothed labels, by Newton steps.

    The targets are (n + 1) / (n + 2) and 1 / (n + 2) of each kind's count n,
    which keeps the slope finite when the margins part the kinds entirely.
    """
    n_good, n_bad = int(good.sum()), int((~good).sum())
    if not n_good or not n_bad:
        return 1.0, 0.0
    target = np.where(good, (n_good + 1) / (n_good + 2), 1 / (n_bad + 2))
    x = np.stack([margins, np.ones_like(margins)], 1)

    def loss(at: np.ndarray) -> float:
        return float(np.sum(np.logaddexp(0, x @ at) - target * (x @ at)))

    at = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -500, 500)))
        slope = x.T @ (p - target)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-9 * np.eye(2), slope)
        size = 1.0
        while size > 1e-6 and loss(at - size * step) > loss(at):
            size /= 2
        at = at - size * step
        if np.abs(size * step).max() < 1e-10:
            break
    return float(at[0]), float(at[1])


def learn_quality(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model | float | None:
    """A model; the smoothed share of good labels where all are alike; None without labels."""
    table = stored(featured(labelled_texts(docs, labels, rows)), "quality-fit")
    try:
        calibrates = F.pmod(F.xxhash64(F.lit("calibrate"), "doc_id"), F.lit(CALIBRATE_ONE_IN)) == 0
        seen = {(r["c"], r["quality"]): r["n"] for r in
                table.groupBy(calibrates.alias("c"), "quality").agg(F.count(F.lit(1)).alias("n")).collect()}
        good, bad = (sum(n for (_, q), n in seen.items() if q == kind) for kind in (1, 0))
        if not good + bad:
            return None
        if not seen.get((False, 1)) or not seen.get((False, 0)):
            return (good + 1) / (good + bad + 2)
        halves = F.when(F.col("quality") == 1, F.lit(0.5 / seen[False, 1])).otherwise(F.lit(0.5 / seen[False, 0]))
        fit_rows = _as_vectors(table).filter(~calibrates).select(
            "features", F.col("quality").cast("double").alias("label"), (halves * (seen[False, 1] + seen[False, 0])).alias("weight"))
        fitted = LogisticRegression(maxIter=ROUNDS, regParam=REGULARIZATION, standardization=False, weightCol="weight").fit(fit_rows)
        weights, intercept = fitted.coefficients.toArray(), float(fitted.intercept)
        spread = docs.sparkSession.sparkContext.broadcast(weights)

        def margin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own = [float(np.dot(spread.value[v["indices"]], v["values"])) + intercept for (v,) in texts_of([batch], "features")]
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.float64()), batch.column("quality")], names=["margin", "quality"])

        # a bounded number of pairs: one in CALIBRATE_ONE_IN of the learned rows
        held = map_rows(table.filter(calibrates), margin, "margin double, quality int").collect()
        slope, offset = platt(np.array([r["margin"] for r in held]), np.array([r["quality"] == 1 for r in held], bool))
        return Model(weights, intercept, slope, offset)
    finally:
        discard(table)


def score_quality(docs: DataFrame, model: Model | float | None) -> DataFrame:
    """(doc_id, the values of ``COUNTS``, quality) of each row of ``docs`` (doc_id, text)."""
    known = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = known.value
        for batch in batches:
            counts, scores = [], []
            for (text,) in texts_of([batch], "text"):
                c, features = _fold(text)
                counts.append(c)
                scores.append(own.quality(*features) if isinstance(own, Model) else own)
            columns = [pa.array(x, pa.int64()) for x in zip(*counts, strict=True)] or [pa.array([], pa.int64())] * len(COUNTS)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns, pa.array(scores, pa.float64())], names=["doc_id", *COUNTS, "quality"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_rows(rows, score, f"doc_id long, {_COUNT_TYPES}, quality double")


def judge_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, the values of ``COUNTS``, base_failed, quality, kept) of each row of ``docs``."""
    scored = score_quality(docs, learn_quality(docs, labels))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    return scored.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.coalesce("quality", F.lit(1.0)) >= KEEP_FROM))
