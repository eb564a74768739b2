import unicodedata

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cubeloom.llm.bpe import WordBpe, byte_letters, decode, encode, piece_table

PATH = public_tokenizers.path("word_bpe_49k.json")
MODEL, LIBRARY = WordBpe.from_file(PATH), Tokenizer.from_file(PATH)
LETTERS, SPLIT = byte_letters(), MODEL.splitter()

known = st.characters(exclude_categories=["Cs", "Cn"], max_codepoint=0x2FFFF).filter(
    lambda c: unicodedata.unidata_version and unicodedata.category(c) not in ("Cn", "Co")
)


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(max_codepoint=0x24F), st.sampled_from(" 'stllΣς<|endoftext|>\n🙂漢é")), max_size=80))
def test_words_encode_as_the_library_does(text):
    mine = [i for w in SPLIT(text.encode()) for i in MODEL.encode_word(w, LETTERS)]
    assert mine == LIBRARY.encode(text, add_special_tokens=False).ids


def test_messy_rows(spark, messy):
    more = spark.createDataFrame(
        [(20, "a<|endoftext|>b <|startoftext|>", "s"), (21, "ΑΣ ǅ ŉ ﬁ İ 12³ ½ x_y don'T 'S", None)],
        "doc_id long, text string, source string",
    )
    docs = messy.unionByName(more, allowMissingColumns=True)
    rows = encode(docs, MODEL).collect()
    want = []
    for r in docs.collect():
        ids = LIBRARY.encode(r.text or "", add_special_tokens=False).ids
        want.append((r.doc_id, len(ids), np.array(ids, "<u4").tobytes(), LIBRARY.decode(ids, skip_special_tokens=False)))
    assert sorted(((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in rows), key=str) == sorted(want, key=str)


def test_decode_by_join(spark):
    ids = LIBRARY.encode("Some words, and more.", add_special_tokens=False).ids
    df = spark.createDataFrame([(1, ids), (1, ids), (2, []), (None, None)], "doc_id long, ids array<int>")
    got = sorted(map(str, [tuple(r) for r in decode(df, piece_table(spark, MODEL)).collect()]))
    text = LIBRARY.decode(ids, skip_special_tokens=False)
    assert got == sorted(map(str, [(1, text), (1, text), (2, ""), (None, "")]))


def test_empty_table(empty):
    assert encode(empty, MODEL).collect() == []


@pytest.mark.parametrize("chunk_words", [1, 50])
def test_chunks_do_not_change_the_result(spark, messy, chunk_words, monkeypatch):
    from cubeloom.llm import bpe
    from cubeloom.llm.chunks import write_chunks

    whole = sorted(map(str, encode(messy, MODEL).collect()))
    monkeypatch.setattr(bpe, "write_chunks", lambda d, s: write_chunks(d, s, chunk_words))
    assert sorted(map(str, bpe.encode(messy, MODEL).collect())) == whole
