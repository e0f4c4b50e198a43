import io
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from airmesh.llm import tokencount, tokenfile

MODEL, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")


def expected_counts(rows):
    model = SentencePieceProcessor(model_file=MODEL)
    return Counter((r.doc_id, len((r.text or "").encode()), len(model.encode(r.text or ""))) for r in rows)


def test_model_never_merges_across_blanks():
    assert tokencount.splits_at_blanks(MODEL)


@pytest.mark.parametrize("head", [0, 50, 300_000])
def test_token_counts_equal_the_library(docs, odd, head):
    for table in (docs, odd):
        got = tokencount.count_tokens(table, MODEL, head_terms=head)
        assert Counter(map(tuple, got.collect())) == expected_counts(table.collect())


def test_token_counts_of_nothing(empty):
    assert tokencount.count_tokens(empty, MODEL).collect() == []


def test_token_files_round_trip(docs, odd, empty):
    tokenizer = Tokenizer.from_file(WORDS)
    for table in (docs, odd, empty):
        rows = sorted(table.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
        got = tokenfile.token_file_digests(table, WORDS, 1).collect()
        ids = [np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4") for r in rows]
        assert Counter((g.doc_id, g.n_tokens, g.ids_crc32) for g in got) == Counter(
            (r.doc_id, len(i), zlib.crc32(i.tobytes())) for r, i in zip(rows, ids, strict=True))
        # records lie end to end in id order
        got.sort(key=lambda g: g.start)
        assert [g.start for g in got] == [sum(g.n_tokens for g in got[:k]) for k in range(len(got))]
        assert [g.doc_id for g in got] == [r.doc_id for r in rows]


def test_index_seeks_to_records(docs, tmp_path):
    folder = f"file://{tmp_path}/tokens"
    index = tokenfile.write_token_files(docs, folder, lambda: tokenfile.ChunkEncoder(WORDS), 1).collect()
    for row in index[::17]:
        doc_id, ids = tokenfile.read_at(folder, row.file, row.offset)
        assert doc_id == row.doc_id and len(ids) == row.n_tokens


def test_damage_is_noticed():
    record = tokenfile.frame(b"payload")
    assert list(tokenfile.unframe(io.BytesIO(record * 2))) == [b"payload"] * 2
    for at in range(len(record)):
        broken = bytearray(record)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            list(tokenfile.unframe(io.BytesIO(bytes(broken))))
    with pytest.raises(ValueError):
        list(tokenfile.unframe(io.BytesIO(record[:-1])))


def test_small_cache_gives_the_same_ids(docs):
    texts = [r.text or "" for r in docs.collect()]
    assert tokenfile.ChunkEncoder(WORDS, 10).encode(texts) == tokenfile.ChunkEncoder(WORDS).encode(texts)


def test_marks_after_every_letter_and_digit():
    """A mark after any letter of any script gives the library's ids, also where normalising changes the letter."""
    import struct
    import sys

    from tokenizers import Tokenizer

    library, encoder = Tokenizer.from_file(WORDS), tokenfile.ChunkEncoder(WORDS)
    letters = [chr(i) for i in range(sys.maxunicode + 1) if chr(i).isalnum() and not 0xD800 <= i < 0xE000]
    texts = [f"a{c}{mark} b" for c in letters for mark in ".,"]
    for start in range(0, len(texts), 20_000):
        part = texts[start:start + 20_000]
        wanted = [e.ids for e in library.encode_batch(part, add_special_tokens=False)]
        got = encoder.encode(part)
        for text, ids, want in zip(part, got, wanted, strict=True):
            assert struct.unpack(f"<{len(ids) // encoder.width}{encoder.kind}", ids) == tuple(want), text.encode("unicode_escape")
