"""Benchmark decontamination: documents that hold a benchmark item, up to a few edits.

Texts and items are sequences of lower-case words without marks; in scripts that
write no blanks between words (``_UNSPACED``) each letter is a word.  A document
holds an item of L words if some stretch of it is within ``MOST_EDITS`` * L word
edits (insert, delete, replace) of the item: items of up to six words match
exactly, those of one word wherever the word stands.

Method, over every item-sized window of every whole text, where the text lies:

1. q-gram lemma: a stretch within e edits of an item has at most L + e words and
   keeps at least L - 1 - 2e of the item's word pairs; windows after whose start
   so many words hold fewer pairs of items of that length are passed over, then
   those that, with e words more on either side, hold fewer of any one item.
   This drops no window that could match.
2. CGK embedding: a random walk reads the window, at each step copying the word
   it stands on and moving on or not by a random bit of (step, word).  Equal
   words bring shifted walks together again, so few edits become few unequal
   places.  ``WALKS`` walks, ``SAMPLES`` random sets of ``BITS`` places each:
   windows and items that agree on a set are candidates.  With a share h of
   unequal places, one set finds a pair with (1 - h) ** BITS and all of them with
   1 - (1 - (1 - h) ** BITS) ** (WALKS * SAMPLES): 0.999 at h = 0.3.
3. Candidates are verified by the exact edit distance of the item to any stretch
   around the window.

The benchmark is the query set: it is read in blocks of ``BLOCK_ITEMS`` items,
one pass over the documents each; documents are never shuffled.

A text's windows are read ``WINDOW_CELLS`` numbers at a time, so memory doesn't
grow with windows times their length.

Defined results: null and empty texts and items, and those of marks alone, match
nothing; repeated items each match; repeated
documents each give their rows; a null doc_id is carried as it is; other
columns stay out of it; empty tables give an empty result.
"""

from __future__ import annotations

import re
import string
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import RowBuffer, map_rows, texts_of

MOST_EDITS = 0.15
WALKS = 8
SAMPLES = 6
BITS = 4
BLOCK_ITEMS = 20_000
#: Numbers in the walks of the windows that are handled together.
WINDOW_CELLS = 4_000_000
#: Windows whose edit distance to an item is found together.
VERIFIED_ROWS = 64
SEED = 7
_MARKS = string.punctuation + "。、，．！？：；「」『』（）《》"
#: Letters of scripts without blanks: Thai, Lao, Myanmar, Khmer, kana, Han.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


class _Codes(dict):
    """Word to code: 0 for words of no item, -1 for what has no letter or digit.  It keeps no words of texts."""

    def __init__(self, known: dict[str, int]):
        super().__init__(known)
        self[""] = -1

    def __missing__(self, raw: str) -> int:
        return self.get(raw.strip(_MARKS), 0)

    def of_text(self, text: str | None) -> np.ndarray:
        """The codes of a text's words, without those of marks alone."""
        get, raw = self.get, raw_words(text)
        # a word of letters and digits has no marks to strip
        codes = np.fromiter([get(w) or (0 if w.isalnum() else get(w.strip(_MARKS), 0)) for w in raw], np.int64, len(raw))
        return codes if codes.size and codes.min() >= 0 else codes[codes >= 0]


def raw_words(text: str | None) -> list[str]:
    """Words with their marks."""
    text = (text or "").lower()
    if not text.isascii() and _UNSPACED.search(text):
        text = _UNSPACED.sub(r" \g<0> ", text)
    return text.split()


def words_of(text: str | None) -> list[str]:
    return [w for raw in raw_words(text) if (w := raw.strip(_MARKS))]


def edits_allowed(length: int) -> int:
    return int(MOST_EDITS * length)


def edit_distances_within(item: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of words, least edits between the item and any stretch of the row, and where that stretch ends."""
    places = np.arange(texts.shape[1] + 1)
    rows = np.zeros((len(texts), len(places)), np.int64)
    for i, word in enumerate(item.tolist(), 1):
        new = np.full_like(rows, i)
        np.minimum(rows[:, :-1] + (texts != word), rows[:, 1:] + 1, out=new[:, 1:])
        # inserts: each place may come from any before it, a step each
        rows = np.minimum.accumulate(new - places, 1) + places
    ends = rows.argmin(1)
    return rows[np.arange(len(rows)), ends], ends


def dense_starts(places: np.ndarray, least: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Where stretches of ``width`` that hold ``least`` of the sorted places start: from, up to; both sorted, maybe overlapping."""
    if len(places) < least:
        return places[:0], places[:0]
    low, high = places[least - 1:] - width + 1, places[:len(places) - least + 1]
    some = low <= high
    return low[some], high[some]


def spans(firsts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``counts`` numbers from each of ``firsts`` on, one span after the other."""
    return np.repeat(firsts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())


def walks(windows: np.ndarray) -> np.ndarray:
    """CGK walks over rows of words: (WALKS, rows, 2 * length) copied words, 0 beyond the end."""
    rows, length = windows.shape
    padded = np.concatenate((windows, np.zeros((rows, 1), windows.dtype)), 1)
    at, out = np.zeros((WALKS, rows), np.int64), np.zeros((WALKS, rows, 2 * length), windows.dtype)
    every = np.arange(rows)[None]
    with np.errstate(over="ignore"):
        for step in range(2 * length):
            word = padded[every, at]
            out[:, :, step] = word
            salt = np.arange(WALKS, dtype=np.uint64)[:, None] * np.uint64(1_000_003) + np.uint64(step + 1)
            coin = (word.astype(np.uint64) + salt) * np.uint64(0x9E3779B97F4A7C15)
            coin = (coin ^ (coin >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            at = np.minimum(at + (coin >> np.uint64(63)).astype(np.int64), length)
    return out


def sampled_places(length: int) -> np.ndarray:
    """(WALKS, SAMPLES, BITS) sampled steps for items of this length."""
    rng = np.random.default_rng([SEED, length])
    return np.array([[rng.choice(2 * length, BITS, replace=False) for _ in range(SAMPLES)] for _ in range(WALKS)])


def table_keys(windows: np.ndarray, places: np.ndarray) -> Iterator[list[bytes]]:
    """For each of the tables, the windows' keys."""
    for out, sets in zip(walks(windows), places, strict=True):
        for own in sets:
            yield np.ascontiguousarray(out[:, own]).view(f"V{len(own) * out.itemsize}").ravel().tolist()


class ItemIndex:
    """Benchmark items by length: their words' codes, their word pairs and their tables."""

    def __init__(self, items: list[tuple[int, str]]):
        codes: dict[str, int] = {}
        self.items: list[tuple[int, np.ndarray]] = []
        for item_id, text in items:
            words = words_of(text)
            if words:
                self.items.append((item_id, np.array([codes.setdefault(w, len(codes) + 1) for w in words], np.int64)))
        self.codes = _Codes(codes)
        by_length = defaultdict(list)
        self.single: dict[int, list[int]] = defaultdict(list)
        for n, (_, words) in enumerate(self.items):
            if len(words) == 1:
                self.single[int(words[0])].append(n)
            else:
                by_length[len(words)].append(n)
        self.single_codes = np.array(sorted(self.single), np.int64)
        self.lengths = np.array(sorted(by_length), np.int64)
        self.least = np.array([max(1, n - 1 - 2 * edits_allowed(n)) for n in sorted(by_length)], np.int64)
        # of each benchmark word pair, the lengths of the items that hold it, as bits (of the length modulo 64)
        bits: dict[int, int] = defaultdict(int)
        for _, words in self.items:
            for pair in (words[:-1] << 32 | words[1:]).tolist():
                bits[pair] |= 1 << (len(words) % 64)
        self.pairs = np.array(sorted(bits), np.int64)
        self.pair_lengths = np.array([bits[p] for p in sorted(bits)], np.uint64)
        self.holders = {length: self._holders_of(own) for length, own in by_length.items()}
        self.tables, self.places = {}, {}
        for length, own in sorted(by_length.items()):
            self.tables[length], self.places[length] = [], sampled_places(length)
            for keys in table_keys(np.stack([self.items[n][1] for n in own]), self.places[length]):
                table = defaultdict(list)
                for n, key in zip(own, keys, strict=True):
                    table[key].append(n)
                self.tables[length].append(dict(table))

    def _holders_of(self, numbers: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of these items, all of one length: (pair, item that holds it, how often) sorted by pair; where each of ``pairs`` starts there."""
        rows = []
        for n in numbers:
            words = self.items[n][1]
            own, times = np.unique(np.searchsorted(self.pairs, words[:-1] << 32 | words[1:]), return_counts=True)
            rows.append(np.stack((own, np.full(len(own), n), times)))
        pairs, items, times = np.concatenate(rows, 1)
        order = np.argsort(pairs, kind="stable")
        pairs, firsts = np.unique(pairs[order], return_index=True)
        return pairs, np.append(firsts, len(order)), items[order], times[order]

    def matches(self, codes: np.ndarray) -> dict[int, tuple[int, int]]:
        """Item number to (edits, first word) of its best match in a text's codes."""
        found = self._words_held(codes)
        if len(codes) < 2 or not len(self.pairs):
            return found
        known = np.flatnonzero((codes[:-1] > 0) & (codes[1:] > 0))
        pairs = codes[known] << 32 | codes[known + 1]
        which = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
        hit = self.pairs[which] == pairs
        known, which = known[hit], which[hit]
        if len(known) < self.least.min():
            return found
        bits, shifts = self.pair_lengths[which], (self.lengths % 64).astype(np.uint64)
        step = max(1, WINDOW_CELLS // len(shifts))
        held = sum(((bits[at:at + step, None] >> shifts[None]) & np.uint64(1)).sum(0) for at in range(0, len(bits), step))
        for k in np.flatnonzero(held >= self.least).tolist():
            length, least = int(self.lengths[k]), int(self.least[k])
            edits = edits_allowed(length)
            own = (bits >> shifts[k]) & np.uint64(1) == 1
            starts, likely = self._starts(known[own], which[own], length, least, len(codes))
            step = max(1, WINDOW_CELLS // length)
            for at in range(0, len(starts), step):
                self._read_windows(codes, starts[at:at + step], length, edits, likely, found)
        return found

    def _starts(self, at: np.ndarray, which: np.ndarray, length: int, least: int, words: int) -> tuple[np.ndarray, set[int]]:
        """Starts of windows of a text that may match items of ``length``, and those items, from the places of their pairs."""
        edits = edits_allowed(length)
        low, high = dense_starts(at, least, length + edits - 1)
        # a text shorter than the item is one window, filled up with words of no item
        high = np.minimum(high, max(0, words - length + edits))
        low = np.maximum(low, np.concatenate(([0], high[:-1] + 1)))
        starts = spans(low, np.maximum(high - low + 1, 0))
        if not len(starts):
            return starts, set()
        near = np.searchsorted(starts, at + edits, "right") > np.searchsorted(starts, at - length - edits + 1, "right")
        at, which = at[near], which[near]
        may, likely = np.zeros(len(starts), bool), set()
        for n, pairs in self._likely(which, length, least):
            low, high = dense_starts(at[np.isin(which, pairs)], least, length + 2 * edits - 1)
            if len(low):
                likely.add(n)
                may |= np.searchsorted(low, starts - edits, "right") > np.searchsorted(high, starts - edits)
        return starts[may], likely

    def _likely(self, which: np.ndarray, length: int, least: int) -> Iterator[tuple[int, np.ndarray]]:
        """Items of ``length`` with ``least`` of their pairs among ``which``, and those pairs."""
        pairs, firsts, items, times = self.holders[length]
        seen, often = np.unique(which, return_counts=True)
        row = np.minimum(np.searchsorted(pairs, seen), len(pairs) - 1)
        own = pairs[row] == seen  # others are of lengths with the same bit
        row, seen, often = row[own], seen[own], often[own]
        counts = firsts[row + 1] - firsts[row]
        rows, seen, often = spans(firsts[row], counts), np.repeat(seen, counts), np.repeat(often, counts)
        numbers, place = np.unique(items[rows], return_inverse=True)
        held = np.bincount(place, np.minimum(often, times[rows]), len(numbers))
        for m in np.flatnonzero(held >= least).tolist():
            yield int(numbers[m]), seen[place == m]

    def _words_held(self, codes: np.ndarray) -> dict[int, tuple[int, int]]:
        """Items of one word in a text's codes."""
        found: dict[int, tuple[int, int]] = {}
        if len(self.single_codes):
            places = np.flatnonzero(np.isin(codes, self.single_codes))
            for code, first in zip(*np.unique(codes[places], return_index=True), strict=True):
                found |= dict.fromkeys(self.single[int(code)], (0, int(places[first])))
        return found

    def _read_windows(self, codes: np.ndarray, starts: np.ndarray, length: int, edits: int,
                      likely: set[int], found: dict[int, tuple[int, int]]) -> None:
        """Add the matches of items of ``length`` words at the windows from ``starts`` to ``found``."""
        at = starts[:, None] + np.arange(length)[None]
        windows = np.where(at < len(codes), codes[np.minimum(at, len(codes) - 1)], 0)
        # a text that repeats itself has few different windows
        windows, first_of = np.unique(windows, axis=0, return_index=True)
        starts, step = starts[first_of], max(1, WINDOW_CELLS // (WALKS * 2 * length))
        for at in range(0, len(starts), step):
            self._look_up(codes, windows[at:at + step], starts[at:at + step], edits, likely, found)

    def _look_up(self, codes: np.ndarray, windows: np.ndarray, starts: np.ndarray, edits: int,
                 likely: set[int], found: dict[int, tuple[int, int]]) -> None:
        length = windows.shape[1]
        candidates: dict[int, dict[int, None]] = defaultdict(dict)
        for table, keys in zip(self.tables[length], table_keys(windows, self.places[length]), strict=True):
            for start, key in zip(starts.tolist(), keys, strict=True):
                for n in table.get(key, ()):
                    if n in likely:
                        candidates[n][start] = None
        # beyond either end of the text stand words of no item: to replace one is to delete one of the item's
        around = np.arange(-edits, length + edits)
        for n, own in candidates.items():
            own = np.array(list(own))
            for k in range(0, len(own), VERIFIED_ROWS):
                # a stretch without an edit can't be bettered
                if not found.get(n, (1, 0))[0]:
                    break
                at = own[k:k + VERIFIED_ROWS, None] + around
                texts = np.where((at >= 0) & (at < len(codes)), codes[np.clip(at, 0, len(codes) - 1)], 0)
                distances, ends = edit_distances_within(self.items[n][1], texts)
                best = int(distances.argmin())
                distance, end = int(distances[best]), int(ends[best] + at[best, 0])
                if distance <= edits and (n not in found or distance < found[n][0]):
                    found[n] = distance, max(0, int(at[best, 0]), end - length)


def _block_matches(docs: DataFrame, items: list[tuple[int, str]]) -> DataFrame:
    index = docs.sparkSession.sparkContext.broadcast(ItemIndex(items))
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("edits", pa.int32()), ("item_words", pa.int32()), ("first_word", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index.value
        out = RowBuffer(schema)
        for doc_id, text in texts_of(batches, "doc_id", "text"):
            for n, (edits, first) in sorted(own.matches(own.codes.of_text(text)).items()):
                out.add(doc_id, own.items[n][0], edits, len(own.items[n][1]), first)
            yield from out.full()
        yield from out.rest()

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_rows(texts, read, "doc_id long, item_id long, edits int, item_words int, first_word long")


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, edits, item_words, first_word): the best match of each item in each of ``docs``."""
    return reduce(DataFrame.unionByName, (_block_matches(docs, items) for items in item_blocks(benchmark)))


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold an item; all their columns."""
    return reduce(_block_clean, item_blocks(benchmark), docs)


def item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items (item_id, text), at most about ``BLOCK_ITEMS`` at a time; at least one, maybe empty, block."""
    items = benchmark.filter("text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    blocks = max(1, -(-items.count() // BLOCK_ITEMS))
    for b in range(blocks):
        yield [(r["item_id"], r["text"]) for r in items.filter(F.pmod(F.xxhash64("text", "item_id"), F.lit(blocks)) == b).collect()]


def _block_clean(docs: DataFrame, items: list[tuple[int, str]]) -> DataFrame:
    index = docs.sparkSession.sparkContext.broadcast(ItemIndex(items))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index.value
        for batch in batches:
            clean = [not own.matches(own.codes.of_text(text)) for (text,) in texts_of([batch], "text")]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return map_rows(docs, keep, docs.schema)
