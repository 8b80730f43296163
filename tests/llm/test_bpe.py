import hashlib
import random

import numpy as np
import pytest
from conftest_llm import awkward_rows
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerloop.llm import bpe

PARTS = (
    ["a", "the", "The", " ", "  ", "\n", "\t", "'s", "'", "!", "12", "é", "ß", "漢", "😀"]
    + ["<|endoftext|>", "　", "\xa0", "\x1c", "\x85", "zx", "qj", "\r\n", "don't", "Ā", "x" * 70]
    + ["×", "÷", "Ñandú", "ſ", "ŉ", "ƀ", "ª", "²", "½", "·", "x" * 39, "é" * 20, "ab12;)", "\x00"]
)


@pytest.fixture(scope="module")
def both():
    definition = bpe.vocabulary()
    return bpe.Codec(definition), Tokenizer.from_str(definition)


def check(both, text):
    codec, library = both
    wanted = library.encode(text, add_special_tokens=False).ids
    ids = codec.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == wanted
    assert codec.decode(ids) == library.decode(wanted, skip_special_tokens=False)


@settings(max_examples=400, deadline=None)
@given(parts=st.lists(st.sampled_from(PARTS), max_size=14))
def test_ids_are_those_of_the_library(both, parts):
    check(both, "".join(parts))


@settings(max_examples=200, deadline=None)
@given(text=st.text(max_size=40))
def test_any_text(both, text):
    check(both, text)


def test_words_are_remembered_and_forgotten(both):
    definition = bpe.vocabulary()
    tiny = bpe.Codec(definition, remembered=5)
    rnd = random.Random(4)
    texts = [" ".join(f"w{rnd.randrange(99)}'s" for _ in range(30)) for _ in range(20)]
    assert tiny.encode_many(texts) == both[0].encode_many(texts)
    assert [tiny.encode(t) for t in texts] == both[0].encode_many(texts)


@settings(max_examples=60, deadline=None)
@given(texts=st.lists(st.lists(st.sampled_from(PARTS), max_size=9).map("".join), max_size=9))
def test_texts_of_one_group_keep_their_ids(both, texts):
    codec, library = both
    texts = [*texts, None, *texts, "", " ".join(texts)]
    wanted = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in codec.encode_many(texts)] == wanted


def test_every_two_byte_letter_and_sign(both):
    every = [chr(c) for c in range(0x21, 0x250)]
    for text in (" ".join(every), " ".join(f"a{c}1{c}b" for c in every), "".join(every)):
        check(both, text)


def test_forced_boundaries_are_pairs_no_token_has(both):
    codec, library = both
    tokens = [codec.decode(np.array([k], "<u4").tobytes()) for k in (1000, 20000)]
    assert all(codec.joined[a, b] for t in tokens for a, b in zip(t.encode(), t.encode()[1:]))
    assert not codec.joined[ord("e"), ord(" ")]


def test_other_kinds_of_tokenizers_are_refused():
    import public_tokenizers

    definition = bpe.read_definition(public_tokenizers.path("word_bpe_49k.json"))
    with pytest.raises(ValueError):
        bpe.Codec(definition)


def test_awkward_documents(spark, folder, both):
    rows = awkward_rows()
    found = bpe.op1_bpe(spark, folder(rows, extra=True)).collect()
    wanted = []
    for doc_id, text, *_ in rows:
        ids = both[1].encode(text or "", add_special_tokens=False).ids
        packed = np.array(ids, "<u4").tobytes()
        digests = (hashlib.sha256(packed), hashlib.sha256((text or "").encode()))
        wanted.append((doc_id, len(ids), *(d.hexdigest() for d in digests)))
    assert sorted(map(tuple, found), key=repr) == sorted(wanted, key=repr)


def test_empty_table(spark, folder):
    assert bpe.op1_bpe(spark, folder()).collect() == []
