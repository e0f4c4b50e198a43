import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from airmesh.llm import collocations as c

from .conftest import ODD_TEXTS

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def plain_phrases(rows, least, most):
    """The contract word by word: {(lang, rank): (phrase, a, l, r, n, score)}."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            n[lang] += len(words)
            for k in range(1, 5):
                f.update((lang, tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    longer = Counter()
    candidates = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= least}
    for (lang, words), a in candidates.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                longer[lang, words[i:i + k]] = max(longer[lang, words[i:i + k]], a)
    found = {}
    for (lang, words), a in candidates.items():
        if 100 * longer[lang, words] >= 80 * a:
            continue
        score, _, l, r = min((2_000_000 * a // (f[lang, words[:k]] + f[lang, words[k:]]), k, f[lang, words[:k]], f[lang, words[k:]]) for k in range(1, len(words)))
        found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), a, l, r, score))
    return {(lang, i): (x[2].decode(), *x[3:6], n[lang], x[6]) for lang, xs in found.items() for i, x in enumerate(sorted(xs)[:most], 1)}


def mined(df, least, most):
    return {(r.lang, r["rank"]): (r.phrase, r.a, r.l, r.r, r.n, r.score) for r in c.mine_phrases(df, least, most).collect()}


@pytest.mark.parametrize("spacing", [1, 3, 24])
def test_equals_the_plain_count(spark, monkeypatch, spacing):
    rnd = random.Random(spacing)
    words = ["a", "B", "c", "D", "éa", "x#", "日本", "b"]
    line = " ".join(rnd.choice(words) for _ in range(60))
    rows = []
    for i in range(120):
        text = "".join(rnd.choice(words) + rnd.choice([" ", " ", "  ", "\t", ", ", ".", "\n", " ! ? ", "\r\n", "\x0b"]) for _ in range(rnd.randrange(0, 80)))
        rows.append((text + line if i % 3 else text, rnd.choice(["en", "fr", None])))
    monkeypatch.setattr(c, "SPACING", spacing)
    df = spark.createDataFrame(rows, "text string, lang string").repartition(7)
    want = plain_phrases(rows, 4, 40)
    assert len(want) > 60
    assert mined(df, 4, 40) == want


def test_odd_tables(spark, odd, empty):
    want = plain_phrases([(r.text, r.lang) for r in odd.collect()], 1, 2000)
    assert mined(odd, 1, 2000) == want and want
    assert c.mine_phrases(empty).count() == 0
    # words that are marks, and texts of marks alone
    marks = spark.createDataFrame([("...",), (". . .",), ("a . b",), (None,), (", a b",), ("a b ,",)], "text string").withColumn("lang", F.lit(None))
    assert mined(marks, 1, 10) == plain_phrases([(r.text, None) for r in marks.collect()], 1, 10)


def test_counts_past_64_bits(spark):
    big = 5_000_000_000_000_000
    counts = spark.createDataFrame([("en", "a", 1, big + 7), ("en", "b", 1, big + 1), ("en", "a b", 2, big)], "lang string, phrase string, words int, f long")
    row = c.phrase_scores(counts).first()
    assert row.score == 2_000_000 * big // (2 * big + 8)


def test_chunks_overlap_by_a_window_and_are_found_again():
    texts = [" ".join(f"w{i * i % 97}" for i in range(400)).encode()] * 2 + [b"x y. " + b" ".join(b"w%d" % (i * i % 97) for i in range(400))]
    numbers, lengths, distinct = c.split_words(texts)
    chunks = list(zip(*(x.tolist() for x in c.cut_chunks(numbers, lengths, distinct))))
    own = [[x for x in chunks if x[3] == t] for t in range(3)]
    for text in own:
        assert [x[2] for x in text] == [False] * (len(text) - 1) + [True]
        for before, after in zip(text, text[1:]):
            assert after[0] == before[1] - c.OVERLAP
    assert sum(x[1] - x[0] - c.OVERLAP * (not x[2]) for x in chunks) == len(numbers)
    words = [[tuple(numbers[a:b].tolist()) for a, b, _, _ in text] for text in own]
    assert words[0] == words[1] and words[2][-3:] == words[0][-3:] and len(words[0]) > 5


def test_blocks_hold_whole_rows(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(c, "BLOCK_BYTES", 50)
    texts = [None if t is None else t.encode() for t in ODD_TEXTS] * 3
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[i:i + 4], pa.binary())], names=["text"]) for i in range(0, len(texts), 4)]
    blocks = list(c._blocks(iter(batches), "text"))
    assert [t for b in blocks for t in b.column("text").to_pylist()] == texts
    assert all(b.num_rows == 1 or sum(len(t or b"") for t in b.column("text").to_pylist()) <= 50 for b in blocks)
    assert all(b.num_rows for b in blocks)
