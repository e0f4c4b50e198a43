"""Language identification with hyperdimensional profiles.

Each letter slot has a random bipolar vector; an n-gram's vector binds its
letters' vectors, each rotated by its place, by elementwise product; a text or
a language is the bundle (sum) of its n-grams' vectors.  A document gets the
language whose prototype has the largest cosine with it.

Bundling is linear, so the prototypes need only n-gram counts by language:
tasks count, one shuffle adds, and the (at most ``SLOTS ** 3`` per language)
totals are folded into vectors.  A document's vector is made where it lies.

Defined results: null texts and texts without a letter are ``und`` with score
0; so is everything if no labelled row is there to learn from.  Cosines that
tie go to the language first in code point order.  Repeated rows each keep
their row; null languages are not learned from; other columns stay out of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import RowBuffer, id_fold, map_rows, texts_of

DIMENSIONS = 1024
SLOTS = 64
SEED = 20_011
UNDEFINED = "und"
#: Characters folded at a time, so that a very long text needs bounded memory.
CHUNK = 1 << 20


def _letter_vectors() -> np.ndarray:
    return np.random.default_rng(SEED).choice(np.array([-1, 1], np.int8), (SLOTS, DIMENSIONS))


def _pair_vectors() -> np.ndarray:
    """Vectors of the first two places: twice rotated times once rotated letters."""
    letters = _letter_vectors()
    return (np.roll(letters, 2, 1)[:, None] * np.roll(letters, 1, 1)[None]).reshape(SLOTS * SLOTS, DIMENSIONS)


def _slot(char: str) -> int:
    """0 for what is no letter, 1 to 26 for a to z, others by code point over the rest."""
    if "a" <= char <= "z":
        return ord(char) - 96
    return 27 + ord(char) * 40_503 % (SLOTS - 27) if char.isalpha() else 0


def _low_slots() -> np.ndarray:
    return np.array([_slot(chr(c)) for c in range(0x3000)], np.int64)


def text_grams(text: str, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigrams of slots (runs of non-letters are one) and their counts."""
    total = np.zeros(0, np.int64)
    counts = np.zeros(0, np.int64)
    lower = text.lower()
    last = np.zeros(1, low.dtype)
    for start in range(0, len(lower), CHUNK):
        points = np.frombuffer(lower[start:start + CHUNK].encode("utf-32-le", "replace"), np.uint32)
        slots = low[np.minimum(points, len(low) - 1)]
        for i in np.flatnonzero(points >= len(low)):
            slots[i] = _slot(chr(points[i]))
        # the slots that the pieces before ended with come first, so that a text's n-grams don't depend on the pieces
        slots = np.concatenate((last, slots, [0] if start + CHUNK >= len(lower) else [])).astype(low.dtype)
        slots = slots[np.concatenate(([True], (slots[1:] != 0) | (slots[:-1] != 0)))]
        last = slots[-2:]
        if len(slots) < 3:
            continue
        grams = (slots[:-2] * SLOTS + slots[1:-1]) * SLOTS + slots[2:]
        grams, n = np.unique(grams, return_counts=True)
        if len(total):
            both, where = np.unique(np.concatenate((total, grams)), return_inverse=True)
            n = np.bincount(where, np.concatenate((counts, n)), len(both)).astype(np.int64)
            grams = both
        total, counts = grams, n
    return total, counts


def _has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def bundle(grams: np.ndarray, counts: np.ndarray, pairs: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """The sum of the n-grams' vectors, in blocks of n-grams."""
    out = np.zeros(DIMENSIONS, np.float64)
    for start in range(0, len(grams), 4096):
        g = grams[start:start + 4096]
        out += counts[start:start + 4096].astype(np.float32) @ (pairs[g // SLOTS] * letters[g % SLOTS]).astype(np.float32)
    return out


def learn_prototypes(labelled: DataFrame) -> dict[str, np.ndarray]:
    """Unit prototype of each language of ``labelled`` (text, lang), from all its rows."""
    schema = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, sums = _low_slots(), {}
        for text, lang in texts_of(batches, "text", "lang"):
            if lang not in sums:
                if len(sums) >= 32:  # a task holds few languages' counts at a time
                    yield from flush(sums)
                    sums.clear()
                sums[lang] = np.zeros(SLOTS ** 3, np.int64)
            grams, n = text_grams(text, low)
            sums[lang][grams] += n
        yield from flush(sums)

    def flush(sums: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for lang, n in sums.items():
            grams = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(n[grams])], schema=schema)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, letters, sums = _pair_vectors(), _letter_vectors(), {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            grams, n = batch.column("gram").to_numpy(), batch.column("n").to_numpy()
            for lang in set(langs):
                own = langs == lang
                sums[lang] = sums.get(lang, 0) + bundle(grams[own], n[own], pairs, letters)
        for lang, vector in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * DIMENSIONS, pa.string()), pa.array(np.arange(DIMENSIONS, dtype=np.int64)), pa.array(vector)],
                names=["lang", "place", "value"])

    known = labelled.filter(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang")
    grams = map_rows(known, count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    sums = (map_rows(grams, fold, "lang string, place long, value double")
            # whole numbers far below 2**53, so the order of adding is no matter
            .groupBy("lang", "place").agg(F.sum("value").alias("value")).collect())
    vectors: dict[str, np.ndarray] = {}
    for row in sums:
        vectors.setdefault(row["lang"], np.zeros(DIMENSIONS))[row["place"]] = row["value"]
    return {lang: v / norm for lang, v in sorted(vectors.items()) if (norm := np.linalg.norm(v)) > 0}


def identify(docs: DataFrame, prototypes: dict[str, np.ndarray], also: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, lang_pred, score) of each row of ``docs`` (doc_id, text), and the columns ``also``.

    score is the cosine with the best prototype, not below 0.
    """
    spark = docs.sparkSession
    langs = list(prototypes)
    known = spark.sparkContext.broadcast(np.array([prototypes[x] for x in langs]).reshape(len(langs), DIMENSIONS))
    kept = docs.select("doc_id", "text", *also)
    # as types, not as text: names of columns and fields may hold anything
    out_type = StructType([f for f in kept.schema if f.name != "text" or "text" in also]
                          + [StructField("lang_pred", StringType()), StructField("score", DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, pairs, letters, best = _low_slots(), _pair_vectors(), _letter_vectors(), known.value
        for batch in batches:
            langs_out, scores = [], []
            for (text,) in texts_of([batch], "text"):
                lang, cosine = UNDEFINED, 0.0
                if langs and _has_letter(text):
                    vector = bundle(*text_grams(text, low), pairs, letters)
                    if norm := float(np.sqrt(vector @ vector)):
                        cosines = best @ vector / norm
                        at = int(np.argmax(cosines))
                        lang, cosine = langs[at], float(min(1.0, max(0.0, cosines[at])))
                    else:
                        lang = langs[0]
                langs_out.append(lang)
                scores.append(cosine)
            out = batch if "text" in also else batch.drop_columns(["text"])
            yield out.append_column("lang_pred", pa.array(langs_out, pa.string())).append_column("score", pa.array(scores, pa.float64()))

    return map_rows(kept, score, out_type)


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, lang, ...) with a language, all their columns.

    Learned as by ``predict_languages``; only texts that are null or have no
    letter are rejected (short texts have small cosines and are kept), also if
    no labelled row is there to learn from.
    """
    fold = id_fold(F.col("doc_id"))
    prototypes = learn_prototypes(docs.filter(fold != 2).select("text", "lang"))
    scored = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("document"), "doc_id", "text") if docs.columns else docs
    # with nothing learned, one prototype that all texts with a letter have cosine 0 with
    found = identify(scored, prototypes or {"unlearned": np.zeros(DIMENSIONS)}, ("document",))
    return found.filter(F.col("lang_pred") != UNDEFINED).select("document.*")


def predict_languages(docs: DataFrame) -> DataFrame:
    """Learn from the rows of fold 0, 1 and 3, predict all: (doc_id, held_out, lang_pred, score)."""
    held = docs.select("doc_id", "text", "lang").withColumn("held_out", id_fold(F.col("doc_id")) == 2)
    prototypes = learn_prototypes(held.filter(~F.col("held_out")))
    return identify(held, prototypes, ("held_out",)).select("doc_id", "held_out", "lang_pred", "score")
