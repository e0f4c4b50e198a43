"""Token counts of whole texts without materialising token ids.

A sentencepiece BPE model whose pieces hold a blank mark only at their front
never merges across the end of a word, so a text's pieces are the pieces of
its pre-tokens (blanks, then everything up to the next blank).  Each distinct
pre-token is encoded once; a document's count is the sum over its pre-tokens
of frequency times pieces:

1. tasks pre-aggregate their pre-tokens, a shuffle leaves the distinct ones;
2. their piece counts are taken once and written to the shared folder;
3. documents are split again and joined with the counts.  The most frequent
   pre-tokens (at most ``HEAD_TERMS`` of at most ``HEAD_CHARS`` characters,
   whatever the corpus) are broadcast and summed where the document lies; only
   the others are shuffled, so no hot word meets in one task.

Defined results: a null or empty text has 0 tokens; rows that repeat (also
whole copies with one id, or a null id) each keep their row; other columns of
the input are left out; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import FLUSH_ROWS, RowBuffer, heaviest, map_rows, stored, texts_of

HEAD_TERMS = 300_000
HEAD_CHARS = 64
#: Distinct pre-tokens that a task holds before it hands on its partial counts.
PARTIAL_TERMS = 400_000
_MARK = "▁"
_RUN = re.compile(r" +[^ ]*")


def pre_tokens(text: str) -> list[str]:
    """The pre-tokens of a text, each without its first blank.

    The library puts one blank before a text, so every pre-token starts with
    at least one; a trailing blank alone is the empty string.
    """
    if not text:
        return []
    text = text.replace(_MARK, " ")
    parts = text.split(" ")
    if "" in parts:
        return [run[1:] for run in _RUN.findall(" " + text)]
    return parts


def splits_at_blanks(model_path: str) -> bool:
    """Whether no piece of the model holds a blank mark after another character."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=model_path)
    return not any(_MARK in model.id_to_piece(i).lstrip(_MARK) for i in range(model.get_piece_size()))


def _partial_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("term", pa.string()), ("docs", pa.int64())])
    seen: Counter[str] = Counter()
    for (text,) in texts_of(batches, "text"):
        seen.update(set(pre_tokens(text or "")))
        if len(seen) > PARTIAL_TERMS:
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], schema=schema)
            seen.clear()
    yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], schema=schema)


def piece_counts(docs: DataFrame, model_path: str) -> DataFrame:
    """(term, docs, pieces) of every distinct pre-token of ``docs.text``."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=model_path)
        for batch in batches:
            terms = batch.column("term").to_pylist()
            # the pre-token "" is a blank mark alone; encode("") would give nothing
            pieces = [len(ids) if term else 1 for term, ids in zip(terms, model.encode(terms, num_threads=1), strict=True)]
            yield batch.append_column("pieces", pa.array(pieces, pa.int64()))

    terms = (map_rows(docs.select("text"), _partial_terms, "term string, docs long")
             .groupBy("term").agg(F.sum("docs").alias("docs")))
    return map_rows(terms, encode, "term string, docs long, pieces long")


def count_tokens(docs: DataFrame, model_path: str, head_terms: int = HEAD_TERMS) -> DataFrame:
    """One row (doc_id, n_bytes, n_tokens) for each row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = stored(piece_counts(docs, model_path), "pieces")
    short = counts.filter(F.length("term") <= HEAD_CHARS)
    floor = heaviest(short, "docs", head_terms)
    top = short.filter(F.col("docs") >= floor).select("term", "pieces").toArrow()
    head = spark.sparkContext.broadcast(dict(zip(top["term"].to_pylist(), top["pieces"].to_pylist(), strict=True)))
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_bytes", pa.int64()),
                        ("copies", pa.int64()), ("known", pa.int64()), ("term", pa.string()), ("n", pa.int64())])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, out = head.value, RowBuffer(schema)
        for doc_id, text in texts_of(batches, "doc_id", "text"):
            raw = (text or "").encode()
            key = xxhash.xxh64_intdigest(raw) - 2 ** 63
            known = 0
            for term, n in Counter(pre_tokens(text or "")).items():
                if (p := pieces.get(term)) is not None:
                    known += p * n
                else:
                    out.add(doc_id, key, 0, 0, 0, term, n)
            # the document's own row: a key that no term has, and that no other document shares
            out.add(doc_id, key, len(raw), 1, known, f"{_MARK}{key}", 0)
            if len(out) >= FLUSH_ROWS:
                yield out.batch()
        yield from out.rest()

    rows = map_rows(docs, spread, "doc_id long, text_key long, n_bytes long, copies long, known long, term string, n long")
    rest = counts.select("term", "pieces")
    sums = (rows.join(rest, "term", "left")
            .groupBy("doc_id", "text_key")
            .agg(F.max("n_bytes").alias("n_bytes"), F.sum("copies").alias("copies"),
                 F.sum(F.col("known") + F.col("n") * F.coalesce("pieces", F.lit(0))).alias("total")))
    # equal rows were summed together; each gets its share and its row back
    return sums.select("doc_id", "n_bytes", F.expr("total div copies").alias("n_tokens"),
                       F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).drop("copy")
