"""Phrases whose words belong together, counted in a prefix-free parse.

A document's words, with a mark between pieces, are cut where their content
says so: wherever a window of ``OVERLAP`` words hashes to 0 modulo ``SPACING``.
A chunk runs from the start of one such window to the end of the next, so
neighbours overlap by exactly that window and equal passages give equal chunks
wherever they stand.  Tasks and one shuffle leave each distinct chunk once, with
the number of times the parse holds it: the dictionary.

All n-grams are then counted inside distinct chunks, each weighted with its
chunk's frequency.  An n-gram that starts in a chunk's last window belongs to
the next chunk, which starts with that window, so overlaps are counted once;
n-grams have at most ``OVERLAP + 1`` words and lie whole in their chunk.

Words are counted first, then pairs, then what is longer.  A phrase is no more
frequent than its parts, so a pair is only handed on if its words, and a longer
phrase if all its pairs, may reach the least count.  Which may is read from a bitmap of a fixed size
(``PLACES`` bits): it can let a rare n-gram through, never lose a frequent one,
and as the corpus grows it spares less work.  Counts are exact: within a task
n-grams are told apart by their words' numbers, between tasks by their text.

Everything is per language (null: ``und``).  A phrase's score is that of its
weakest cut, ``floor(SCALE * a / (l + r))``; phrases inside a longer one that
takes ``COVER_PERCENT`` of their occurrences go.  Arithmetic that may pass 64
bits is done in decimals of 38 digits.

Defined results: null, empty and blank texts and pieces without a word count
nothing.  Rows that repeat count each time; ids and other columns are not
read.  Words and phrases tie in UTF-8 byte order.  An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, map_rows, stored

#: Words of a cutting window; phrases have one more at most.
OVERLAP = 3
LONGEST = OVERLAP + 1
#: One window in about so many cuts the text.
SPACING = 24
LEAST_COUNT = 30
SCALE = 2_000_000
COVER_PERCENT = 80
KEPT_PER_LANG = 2000
UNDEFINED = "und"
#: Bits of a level's bitmap, and those of its parts that Spark's bitmap functions make.
PLACES = 1 << 27
_PART_BITS = 32_768
#: Bytes of text folded at a time, one row at least.
BLOCK_BYTES = 4 << 20

#: A-Z become a-z, the marks between pieces a full stop (no word holds one), tab a blank.
_FOLD = bytes.maketrans(bytes(range(65, 91)) + b",;:!?\n\x0b\x0c\r\t", bytes(range(97, 123)) + b"." * 9 + b" ")
_STOP = b"."
_MIX = np.uint64(0x9E3779B97F4A7C15)  # odd, the golden ratio of 64 bits
_STEP = np.uint64(0x1_0000_01B3)
_BACK = np.uint64(pow(0x1_0000_01B3, -1, 1 << 64))


def _mixed(codes: np.ndarray) -> np.ndarray:
    """Codes of 64 bits whose bits all depend on all bits of ``codes``."""
    out = codes * _MIX
    out ^= out >> np.uint64(29)
    out *= _MIX
    return out ^ (out >> np.uint64(32))


def _codes(names: pa.Array) -> np.ndarray:
    """64-bit codes of strings: polynomials of their bytes, all taken from one running sum."""
    offsets = pc.cumulative_sum(pc.binary_length(names)).to_numpy(zero_copy_only=False).astype(np.int64)
    raw = np.frombuffer(b"".join(names.cast(pa.binary()).to_pylist()), np.uint8).astype(np.uint64) + np.uint64(1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(raw * np.cumprod(np.full(len(raw), _STEP)))))
    back = np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(len(raw), _BACK))))
    starts = np.concatenate(([0], offsets[:-1]))[:len(offsets)]
    return _mixed((sums[offsets] - sums[starts]) * back[starts])


def split_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Numbers of all words, how many each text has, and the distinct words by number.

    The mark between pieces is a word too: one for each run of marks, none at
    the ends of a text.
    """
    marked = pa.array([text.translate(_FOLD).replace(_STOP, b" . ") for text in texts], pa.binary()).cast(pa.string())
    split = pc.ascii_split_whitespace(marked)
    lengths = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    encoded = split.flatten().dictionary_encode()
    numbers, distinct = encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary
    # of the marks stay those between two words of a text; the empty strings around a text's blanks go
    text_of = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
    empty, stop = (distinct.index(pa.scalar(x)).as_py() for x in ("", "."))
    for drop in ("empty", "first", "last"):
        if drop == "empty":
            keep = numbers != empty
        else:
            new = text_of[1:] != text_of[:-1]
            stops = numbers == stop
            if drop == "first":  # a mark at its text's start or after another
                keep = ~(stops & np.concatenate(([True], new | stops[:-1]))[:len(stops)])
            else:
                keep = ~(stops & np.concatenate((new, [True]))[:len(stops)])
        if not keep.all():
            numbers, text_of = numbers[keep], text_of[keep]
    return numbers, np.bincount(text_of, minlength=len(texts)), distinct


def cut_chunks(numbers: np.ndarray, lengths: np.ndarray, distinct: pa.Array) -> tuple[np.ndarray, ...]:
    """start, end, last and text of each chunk: its words' range, whether it ends its text, the text's place."""
    ends = np.cumsum(lengths)
    begins, text_of = ends - lengths, np.repeat(np.arange(len(lengths)), lengths)
    names = _codes(distinct)[numbers]
    windows = names[:-2] * _STEP * _STEP + names[1:-1] * _STEP + names[2:]
    cuts = np.flatnonzero((_mixed(windows) >> np.uint64(32)) % np.uint64(SPACING) == 0)
    own = text_of[cuts]
    cuts = cuts[(cuts > begins[own]) & (cuts + OVERLAP <= ends[own])]
    start = np.sort(np.concatenate((begins[lengths > 0], cuts)))
    text = text_of[start]
    last = np.concatenate((text[1:] != text[:-1], [True]))[:len(text)]
    return start, np.where(last, ends[text], np.concatenate((start[1:], [0]))[:len(start)] + OVERLAP), last, text


def _blocks(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in batches that hold about ``BLOCK_BYTES`` of ``column``, or one row."""
    held: list[pa.RecordBatch] = []
    size = 0

    def joined() -> pa.RecordBatch:
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start = 0
        for end, own in enumerate(sizes.tolist(), 1):
            if size and size + own > BLOCK_BYTES:
                held.append(batch.slice(start, end - 1 - start))
                yield joined()
                held, size, start = [], 0, end - 1
            size += own
        if start < batch.num_rows:
            held.append(batch.slice(start))
    if sum(part.num_rows for part in held):
        yield joined()


def chunk_dictionary(docs: DataFrame) -> DataFrame:
    """(lang, chunk, last, times) of the distinct chunks of ``docs`` (text, lang); ``chunk`` holds words and marks."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches, "text"):
            langs = batch.column("lang")
            numbers, lengths, distinct = split_words([t or b"" for t in batch.column("text").to_pylist()])
            chunks = cut_chunks(numbers, lengths, distinct)
            for at in range(0, len(chunks[0]), 50_000):
                starts, ends, last, texts = (c[at:at + 50_000] for c in chunks)
                sizes = ends - starts
                first = np.cumsum(sizes) - sizes
                words = distinct.take(pa.array(numbers[np.repeat(starts - first, sizes) + np.arange(sizes.sum())]))
                lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(words)), pa.int32()), words)
                yield pa.RecordBatch.from_arrays([langs.take(pa.array(texts)), pc.binary_join(lists, " "), pa.array(last)], names=["lang", "chunk", "last"])

    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNDEFINED)).alias("lang"), F.col("text").cast("string").cast("binary").alias("text"))
    return (map_rows(rows, parse, "lang string, chunk string, last boolean")
            .groupBy("lang", "chunk", "last").agg(F.count(F.lit(1)).alias("times")))


def _gram_places(parts: list[np.ndarray], langs: np.ndarray) -> np.ndarray:
    """Places in a bitmap of n-grams, given as their words' codes, and their languages' codes."""
    code = langs.copy()
    for words in parts:
        code = code * _STEP + words
    return (_mixed(code) >> np.uint64(64 - PLACES.bit_length() + 1)).astype(np.int64)


def frequent_places(grams: DataFrame) -> Broadcast:
    """A bitmap of ``PLACES`` bits, set at the places of ``grams`` (lang, phrase).

    Its parts are made by Spark; at most ``PLACES / 8`` bytes reach the driver at any size.
    """

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            split = pc.split_pattern(batch.column("phrase"), " ")  # a level's phrases are equally long
            words = [_codes(pc.list_element(split, i)) for i in range(len(split[0]))]
            langs = _codes(batch.column("lang"))
            yield pa.RecordBatch.from_arrays([pa.array(_gram_places(words, langs))], names=["place"])

    place = F.col("place")
    parts = (map_rows(grams.select("lang", "phrase"), places, "place long")
             .groupBy(F.floor(place / _PART_BITS).cast("int").alias("part"))
             .agg(F.bitmap_construct_agg(F.pmod(place, F.lit(_PART_BITS))).alias("bits")))
    table = np.zeros(PLACES // 8, np.uint8)
    for row in parts.collect():
        own = np.frombuffer(row["bits"], np.uint8)
        table[row["part"] * (_PART_BITS // 8):][:len(own)] = own
    return grams.sparkSession.sparkContext.broadcast(table.tobytes())


def count_grams(dictionary: DataFrame, lengths: tuple[int, ...], frequent: Broadcast | None = None, inside: int = 0) -> DataFrame:
    """(lang, phrase, f) of the n-grams of ``lengths`` words, without marks, of all texts.

    ``frequent`` is a bitmap of n-grams of ``inside`` words; longer ones that hold one it rules out are left out.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(frequent.value, np.uint8) if frequent is not None else None
        for batch in _blocks(batches, "chunk"):
            yield from block(batch, bits)

    def block(batch: pa.RecordBatch, bits: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        chunks = pc.split_pattern(batch.column("chunk"), " ")
        sizes = pc.list_value_length(chunks).to_numpy(zero_copy_only=False)
        encoded = chunks.flatten().dictionary_encode()
        numbers, distinct = encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary
        langs = batch.column("lang").dictionary_encode()
        chunk_of = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        lang_of, times = langs.indices.to_numpy(zero_copy_only=False), batch.column("times").to_numpy(zero_copy_only=False)
        # an n-gram starts before its chunk's last window (unless the text ends there), and ends within the chunk
        ends = np.cumsum(sizes)
        word = np.concatenate((numbers != distinct.index(pa.scalar(".")).as_py(), np.zeros(max(lengths), bool)))
        first = np.flatnonzero(np.arange(len(numbers)) < np.where(batch.column("last").to_numpy(zero_copy_only=False), ends, ends - OVERLAP)[chunk_of])
        if bits is not None:
            names, lang_names = _codes(distinct)[numbers], _codes(langs.dictionary)[lang_of]
            whole = np.flatnonzero(np.arange(len(numbers)) + inside <= ends[chunk_of])
            places = _gram_places([names[whole + i] for i in range(inside)], lang_names[chunk_of[whole]])
            may = np.zeros(len(numbers) + max(lengths), bool)
            may[whole] = (bits[places >> 3] >> (places & 7).astype(np.uint8)) & 1
        for length in lengths:
            at = first[first + length <= ends[chunk_of[first]]]
            for i in range(length):
                at = at[word[at + i]]
                if bits is not None and i <= length - inside:
                    at = at[may[at + i]]
            if len(at):
                yield summed(at, length, numbers, distinct, lang_of[chunk_of[at]], langs.dictionary, times[chunk_of[at]])

    def summed(at, length, numbers, distinct, lang_of, langs, times) -> pa.RecordBatch:
        code = lang_of.astype(np.int64)
        for i in range(length):
            if i and len(langs) * len(distinct) ** (i + 1) >= 1 << 62:  # number the prefixes before the product passes 63 bits
                code = np.unique(code, return_inverse=True)[1]
            code = code * len(distinct) + numbers[at + i]
        order = np.argsort(code)
        starts = np.flatnonzero(np.concatenate(([True], code[order][1:] != code[order][:-1])))
        one = order[starts]
        columns = [distinct.take(pa.array(numbers[at[one] + i])) for i in range(length)]
        return pa.RecordBatch.from_arrays(
            [langs.take(pa.array(lang_of[one])), columns[0] if length == 1 else pc.binary_join_element_wise(*columns, " "),
             pa.array(np.add.reduceat(times[order], starts))], names=["lang", "phrase", "f"])

    return (map_rows(dictionary, count, "lang string, phrase string, f long")
            .groupBy("lang", "phrase").agg(F.sum("f").alias("f")))


def _part(first, words) -> Column:
    """The text of ``words`` words of a phrase from the word number ``first`` on."""
    return F.array_join(F.slice(F.split("phrase", " "), first, words), " ")


def phrase_scores(counts: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) of each phrase of two words or more of ``counts`` (lang, phrase, words, f)."""
    cuts = F.transform(F.sequence(F.lit(1), F.col("words") - 1), lambda k: F.struct(
        k.alias("cut"), _part(F.lit(1), k).alias("left"), _part(k + 1, F.col("words") - k).alias("right")))
    cut = counts.filter("words > 1").select("lang", "phrase", F.col("f").alias("a"), F.explode(cuts).alias("c")).select("lang", "phrase", "a", "c.*")
    known = counts.select("lang", "phrase", "f")
    # a phrase's parts are as frequent as itself at least, so each is in the counts
    both = (cut.join(known.withColumnsRenamed({"phrase": "left", "f": "l"}), ["lang", "left"])
            .join(known.withColumnsRenamed({"phrase": "right", "f": "r"}), ["lang", "right"]))
    a, l, r = (F.col(c).cast("decimal(20,0)") for c in "alr")
    score = F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * a, l + r)
    return (both.withColumn("score", score).groupBy("lang", "phrase")
            .agg(F.min(F.struct("score", "cut", "a", "l", "r")).alias("best"))
            .select("lang", "phrase", "best.a", "best.l", "best.r", "best.score"))


def covering_counts(counts: DataFrame) -> DataFrame:
    """(lang, phrase, longer) of all phrases inside longer ones: the largest count of a longer phrase."""
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda n: F.transform(
        F.sequence(F.lit(1), F.col("words") - n + 1), lambda i: _part(i, n))))
    return (counts.filter("words > 2").select("lang", F.explode(inner).alias("phrase"), "f")
            .groupBy("lang", "phrase").agg(F.max("f").alias("longer")))


def mine_phrases(docs: DataFrame, least: int = LEAST_COUNT, most: int = KEPT_PER_LANG) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``most`` phrases of ``docs`` (text, lang)."""
    dictionary = stored(chunk_dictionary(docs), "phrase-chunks")
    words = stored(count_grams(dictionary, (1,)), "phrase-words")
    levels, bits = [words.filter(F.col("f") >= least)], []
    for inside, lengths in ((1, (2,)), (2, tuple(range(3, LONGEST + 1)))):
        bits.append(frequent_places(levels[-1]))
        levels.append(stored(count_grams(dictionary, lengths, bits[-1], inside).filter(F.col("f") >= least), "phrase-counts"))
    counts = levels[0].unionByName(levels[1]).unionByName(levels[2]).withColumn("words", F.size(F.split("phrase", " ")))
    covered = F.lit(100).cast("decimal(10,0)") * F.col("longer").cast("decimal(20,0)") >= F.lit(COVER_PERCENT).cast("decimal(10,0)") * F.col("a").cast("decimal(20,0)")
    scored = phrase_scores(counts).join(covering_counts(counts), ["lang", "phrase"], "left").filter(~F.coalesce(covered, F.lit(False)))
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    # first within parts of a language, so that one task sees a bounded number of a large language's phrases
    order = [F.col("score").desc(), F.col("a").desc(), "phrase"]
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    some = scored.withColumn("part", part).withColumn("place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("place") <= most)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= most)
    result = stored(ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score"), "phrases")
    for table in (dictionary, words, *levels[1:]):
        discard(table)
    for table in bits:
        table.destroy()
    return result
