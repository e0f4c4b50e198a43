"""Toxicity by class-conditional Kneser-Ney character models.

A word is read letter by letter; each letter (and the end) has the seven before
it as its context, in its own word only.  Toxic and ordinary labelled texts each
have their own counts at that order; everything below it, order by order, is one
Kneser-Ney model of continuation counts (distinct left neighbours) over both
classes, so an expression that is rare in a class falls back on what both share
and its log-likelihoods differ only where a class has evidence.  A text's score
compares its two log-likelihoods, divided by its length, through a logistic
curve fitted on labelled rows that the counts left out.

The counts come from all labelled rows: tasks pre-aggregate, a shuffle adds.
Log ratios are tabled by gram (and by context, for grams that were not seen),
then by distinct word of the corpus, and summed by text.  Of either table the
heaviest keys (``HEAD_KEYS``, ``HEAD_WORDS``) are broadcast and looked up in
place; the others are joined by a shuffle.  A bitmap of fixed size tells which
grams outside the head may be in the table at all.

Defined results: a null or empty text has log ratio 0 (its score is the
curve's value there); without labelled rows of both classes every score is 0;
null labels are not learned from, an id labelled twice is toxic if one label
says so; repeated documents each keep their row; other columns are left out.
"""

from __future__ import annotations

import math
import string
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import FLUSH_ROWS, RowBuffer, discard, heaviest, id_fold, map_rows, scratch, stored, texts_of

ORDER = 8
DISCOUNT = 0.75
#: Weight of the backoff of the toxic model, in rows of its context: what a few toxic texts hold by chance counts little.
STRENGTH = 1.0
#: Share of a toxic text's words that come from the toxic class's own model; the rest read as any other.
MIXED = 0.02
THRESHOLD = 0.3
HEAD_KEYS = 600_000
#: log2 of the bits of the bitmap of grams outside the head.
BITMAP_BITS = 26
#: One labelled row in so many is kept for the logistic curve.
CURVE_PART = 5
#: Labels that may be broadcast to the documents; more are joined by a shuffle.
BROADCAST_LABELS = 2_000_000
PARTIAL_KEYS = 400_000
#: Words that may be broadcast, and the most characters of one.
HEAD_WORDS = 300_000
HEAD_CHARS = 64
MARKS = string.punctuation
_START, _END = "\x02" * (ORDER - 1), "\x03"


def word_grams(word: str) -> list[str]:
    word = word.strip(MARKS)
    padded = f"{_START}{word}{_END}"
    return [padded[i:i + ORDER] for i in range(len(word) + 1)]


def words_of(text: str | None) -> list[str]:
    return text.lower().split() if text else []


def gram_counts(labelled: DataFrame) -> DataFrame:
    """(gram, t, o): counts over all toxic and all ordinary rows of ``labelled`` (text, toxic)."""
    schema = pa.schema([("gram", pa.string()), ("t", pa.int64()), ("o", pa.int64())])

    def counted(words: list[Counter]) -> Iterator[pa.RecordBatch]:
        grams: tuple[Counter, Counter] = (Counter(), Counter())
        for own, sums in zip(words, grams, strict=True):
            for word, n in own.items():
                for gram in word_grams(word):
                    sums[gram] += n
            own.clear()
        keys = list(grams[0] | grams[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.string()), *(pa.array([s[k] for k in keys], pa.int64()) for s in (grams[1], grams[0]))], schema=schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = [Counter(), Counter()]
        for text, toxic in texts_of(batches, "text", "toxic"):
            words[toxic].update(words_of(text))
            if len(words[0]) + len(words[1]) > PARTIAL_KEYS:
                yield from counted(words)
        yield from counted(words)

    return (map_rows(labelled.select("text", "toxic"), count, "gram string, t long, o long")
            .groupBy("gram").agg(F.sum("t").alias("t"), F.sum("o").alias("o")))


def shared_model(grams: DataFrame, wanted: DataFrame) -> DataFrame:
    """(lower, p): Kneser-Ney probability of the last letter of each ``wanted`` gram without its first.

    All of ``grams`` count, at every order below ``ORDER``; ``wanted`` are some of them.
    """
    counts = {}
    types = grams.select(F.col("gram").alias("g"))
    for n in range(ORDER - 1, 0, -1):
        # how many different letters come before: the continuation count; each order is written once
        counts[n] = types = stored(types.select(F.substring("g", 2, n).alias("g")).groupBy("g").agg(F.count("*").alias("c")), f"grams-{n}")
    whole = counts[1].agg(F.sum("c").alias("all"))
    model = counts[1].crossJoin(F.broadcast(whole)).select("g", (F.col("c") / F.col("all")).alias("p"))  # one row
    for n in range(2, ORDER):
        h = F.substring("g", 1, n - 1).alias("h")
        contexts = counts[n].groupBy(h).agg(F.sum("c").alias("s"), F.count("*").alias("k"))
        level = (wanted.select(F.substring("gram", -n, n).alias("g")).distinct().join(counts[n], "g")
                 .select("g", "c", h, F.substring("g", 2, n - 1).alias("below")).join(contexts, "h"))
        model = (level.join(model.select(F.col("g").alias("below"), F.col("p").alias("q")), "below")
                 .select("g", ((F.greatest(F.col("c") - DISCOUNT, F.lit(0.0)) + DISCOUNT * F.col("k") * F.col("q")) / F.col("s")).alias("p")))
    return model.select(F.col("g").alias("lower"), "p")


def log_ratios(grams: DataFrame) -> DataFrame:
    """(key, weight, value): log P_toxic - log P_ordinary by gram that the toxic class has, by context for the rest.

    A gram that the toxic class lacks has the ratio of its context, whatever
    the ordinary class has of it; without the context there, it has ratio 0.
    """
    own = Window.partitionBy("h")
    level = grams.withColumn("h", F.substring("gram", 1, ORDER - 1)).withColumn("lower", F.substring("gram", 2, ORDER - 1))
    for c in "to":
        level = (level.withColumn(f"n_{c}", F.sum(c).over(own))
                 .withColumn(f"k_{c}", F.sum((F.col(c) > 0).cast("long")).over(own)))
    level = stored(level.filter("t > 0"), "toxic-grams")
    backed = (STRENGTH + DISCOUNT * F.col("k_t")) / (F.col("n_t") + STRENGTH)
    ordinary = F.when(F.col("n_o") > 0, (F.greatest(F.col("o") - DISCOUNT, F.lit(0.0)) + DISCOUNT * F.col("k_o") * F.col("p"))
                      / F.col("n_o")).otherwise(F.col("p"))
    toxic = F.greatest(F.col("t") - DISCOUNT, F.lit(0.0)) / (F.col("n_t") + STRENGTH) + backed * ordinary
    by_gram = level.join(shared_model(grams, level), "lower").select(
        F.col("gram").alias("key"), (F.col("t") + F.col("o")).alias("weight"), (F.log(toxic) - F.log(ordinary)).alias("value"))
    by_context = (level.groupBy("h").agg(F.max("n_t").alias("n_t"), F.max("n_o").alias("n_o"), F.max("k_t").alias("k_t"))
                  .select(F.col("h").alias("key"), (F.col("n_t") + F.col("n_o")).alias("weight"), F.log(backed).alias("value")))
    return by_gram.unionByName(by_context)


def _bitmap(keys: DataFrame) -> np.ndarray:
    """2**BITMAP_BITS bits; those of the hashes of ``keys.key`` are set."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.array([bit_of(k) for k in batch.column("key").to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at >> 16), pa.array(at & 0xFFFF)], names=["block", "place"])

    bits = np.zeros(1 << BITMAP_BITS, bool)
    # at most 2**16 places a block, 2**(BITMAP_BITS - 16) blocks
    for row in (map_rows(keys.select("key"), places, "block long, place long").groupBy("block")
                .agg(F.collect_set("place").alias("places")).toLocalIterator()):
        bits[(row["block"] << 16) + np.array(row["places"], np.int64)] = True
    return np.packbits(bits)


def bit_of(key: str) -> int:
    return xxhash.xxh64_intdigest(key) >> (64 - BITMAP_BITS)


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, docs): the distinct words of ``docs.text``, without marks around them."""
    schema = pa.schema([("word", pa.string()), ("docs", pa.int64())])

    def flush(seen: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], schema=schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for (text,) in texts_of(batches, "text"):
            seen.update({w.strip(MARKS) for w in set(words_of(text))})
            if len(seen) > PARTIAL_KEYS:
                yield flush(seen)
                seen.clear()
        yield flush(seen)

    return map_rows(docs.select("text"), count, "word string, docs long").groupBy("word").agg(F.sum("docs").alias("docs"))


def word_ratios(words: DataFrame, model: DataFrame, head_keys: int = HEAD_KEYS) -> DataFrame:
    """(word, docs, letters, value): log of the mixed toxic over the ordinary probability of each word.

    A toxic text takes a word from the toxic class's own model with
    probability ``MIXED``, else from the ordinary one.
    """
    spark = words.sparkSession
    floor = heaviest(model, "weight", head_keys)
    top = model.filter(F.col("weight") >= floor).select("key", "value").toArrow()
    rest = model.filter(F.col("weight") < floor)
    head = spark.sparkContext.broadcast((dict(zip(top["key"].to_pylist(), top["value"].to_pylist(), strict=True)), _bitmap(rest)))
    later_type = pa.list_(pa.struct([("gram", pa.string()), ("context", pa.string()), ("fallback", pa.float64())]))
    schema = pa.schema([("word", pa.string()), ("docs", pa.int64()), ("letters", pa.int64()), ("known", pa.float64()), ("later", later_type)])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, bitmap = head.value
        out = RowBuffer(schema)

        def listed(key: str) -> bool:
            at = bit_of(key)
            return bool(bitmap[at >> 3] >> (7 - (at & 7)) & 1)

        for word, docs in texts_of(batches, "word", "docs"):
            known, later, grams = [], [], word_grams(word)
            for gram in grams:
                if (v := values.get(gram)) is None:
                    context = gram[:-1]
                    v = values.get(context)
                    if listed(gram) or v is None and listed(context):
                        later.append({"gram": gram, "context": context, "fallback": v or 0.0})
                        continue
                known.append(v or 0.0)
            out.add(word, docs, len(grams), math.fsum(known), later)
            yield from out.full()
        yield from out.rest()

    rows = stored(map_rows(words, spread, "word string, docs long, letters long, known double, "
                           "later array<struct<gram: string, context: string, fallback: double>>"), "words-read")
    table = rest.select("key", "value")
    # only words with grams outside the head are joined with the rest of the table
    more = (rows.filter(F.size("later") > 0).select("word", F.explode("later").alias("g")).select("word", "g.*")
            .join(table.select(F.col("key").alias("gram"), F.col("value").alias("by_gram")), "gram", "left")
            .join(table.select(F.col("key").alias("context"), F.col("value").alias("by_context")), "context", "left")
            .groupBy("word").agg(F.sum(F.coalesce("by_gram", F.coalesce("by_context", F.lit(0.0)) + F.col("fallback"))).alias("more")))
    whole = rows.filter(F.size("later") == 0).withColumn("more", F.lit(0.0)).unionByName(rows.filter(F.size("later") > 0).join(more, "word"))
    # rounded, so that the order of adding is no matter
    ratio = F.exp(F.least(F.round(F.col("known") + F.col("more"), 9), F.lit(200.0)))
    return whole.select("word", "docs", "letters", F.round(F.log((1 - MIXED) + MIXED * ratio), 9).alias("value"))


def text_ratios(docs: DataFrame, words: DataFrame, head_words: int = HEAD_WORDS) -> DataFrame:
    """(doc_id, ratio) of each row of ``docs`` (doc_id, text): its words' log ratios over its letters."""
    spark = docs.sparkSession
    short = words.filter(F.length("word") <= HEAD_CHARS)
    top = short.filter(F.col("docs") >= heaviest(short, "docs", head_words)).select("word", "value").toArrow()
    head = spark.sparkContext.broadcast(dict(zip(top["word"].to_pylist(), top["value"].to_pylist(), strict=True)))
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("copies", pa.int64()), ("letters", pa.int64()),
                        ("known", pa.float64()), ("word", pa.string()), ("n", pa.int64())])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, out = head.value, RowBuffer(schema)
        for doc_id, text in texts_of(batches, "doc_id", "text"):
            key = xxhash.xxh64_intdigest(text or "") - 2 ** 63
            sums, letters = [], 0
            rare: Counter[str] = Counter()
            for raw, n in Counter(words_of(text)).items():
                word = raw.strip(MARKS)
                letters += (len(word) + 1) * n
                if (v := values.get(word)) is not None:
                    sums.append(v * n)
                else:
                    rare[word] += n
            for word, n in rare.items():
                out.add(doc_id, key, 0, 0, 0.0, word, n)
            # the document's own row: a key that no word is, and that no other document shares
            out.add(doc_id, key, 1, letters, math.fsum(sums), f"{_END} {key}", 0)
            if len(out) >= FLUSH_ROWS:
                yield out.batch()
        yield from out.rest()

    rows = map_rows(docs, spread, "doc_id long, text_key long, copies long, letters long, known double, word string, n long")
    sums = (rows.join(words.select("word", "value"), "word", "left").groupBy("doc_id", "text_key")
            .agg(F.sum("copies").alias("copies"), F.sum("letters").alias("letters"),
                 F.sum(F.col("known") + F.coalesce("value", F.lit(0.0)) * F.col("n")).alias("total")))
    ratio = F.when(F.col("letters") > 0, F.round(F.col("total") / F.col("letters"), 9)).otherwise(F.lit(0.0))
    # equal rows were summed together; both sums hold each of them once, and each gets its row back
    return sums.select("doc_id", ratio.alias("ratio"), F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).drop("copy")


def fit_curve(points: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Logistic regression of the label on the ratio over (ratio, label, rows) bins: (slope, offset)."""
    if not points:
        return 0.0, -math.inf
    x, y, w = (np.array(c, float) for c in zip(*points, strict=True))
    if not 0 < (w * y).sum() < w.sum():
        return 0.0, -math.inf if not (w * y).sum() else math.inf
    scale = max(float(np.sqrt((w * x * x).sum() / w.sum())), 1e-9)
    design, beta = np.stack([x / scale, np.ones_like(x)], 1), np.zeros(2)
    ridge = np.diag([1e-3, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -40, 40)))
        step = np.linalg.solve((design * (w * p * (1 - p) + 1e-12)[:, None]).T @ design + ridge, design.T @ (w * (y - p)) - ridge @ beta)
        beta += step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0] / scale), float(beta[1])


def _only(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """What ``make`` returns, written; the tables made on the way are deleted."""
    with scratch() as made:
        out = stored(make(), name)
        for table in made[:-1]:
            discard(table)
        del made[:-1]
    return out


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``, learned from ``labels`` (doc_id, toxic)."""
    known = (labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
             .filter(id_fold(F.col("doc_id")) != 2)
             .withColumn("curve", F.crc32(F.concat(F.lit("curve "), F.col("doc_id").cast("string")).cast("binary")) % CURVE_PART == 0))
    known = stored(known, "labels")
    train = known.filter(~F.col("curve"))
    if train.count() <= BROADCAST_LABELS:
        train = F.broadcast(train)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # each table is deleted once the next one is written
    model = _only(lambda: log_ratios(stored(gram_counts(texts.join(train, "doc_id")), "grams")), "ratios")
    words = _only(lambda: word_ratios(vocabulary(texts), model), "words")
    discard(model)
    ratios = stored(text_ratios(texts, words), "text-ratios")
    discard(words)
    step = 4096.0  # bins of the curve: ratios within -8..8
    points = (ratios.join(known.filter("curve"), "doc_id")
              .groupBy(F.round(F.greatest(F.least(F.col("ratio"), F.lit(8.0)), F.lit(-8.0)) * step).alias("bin"), "toxic")
              .count().collect())
    slope, offset = fit_curve([(r["bin"] / step, r["toxic"], r["count"]) for r in points])
    score = F.lit(0.0) if math.isinf(offset) and offset < 0 else F.lit(1.0) if math.isinf(offset) else (
        1 / (1 + F.exp(-(F.col("ratio") * slope + offset))))
    return (ratios.withColumn("score", score.cast("double"))
            .select("doc_id", (id_fold(F.col("doc_id")) == 2).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "ratio"))
