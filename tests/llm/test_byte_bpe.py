"""Byte-level BPE against the tiktoken library, and round trips."""

import struct

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tripwire.llm import byte_bpe

FILES = ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"]


def open_both(name):
    ranks = byte_bpe.read_ranks(public_tokenizers.path(name))
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return byte_bpe.Codec(ranks, public_tokenizers.PATTERN), theirs


@pytest.fixture(scope="module", params=FILES)
def both(request):
    return open_both(request.param)


def ids(packed):
    return list(struct.unpack(f"<{len(packed) // 4}I", packed))


def same(both, text):
    ours, theirs = both
    packed = ours.encode(text)
    assert ids(packed) == theirs.encode_ordinary(text)
    assert ours.decode(packed) == text.encode()


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="aAe'sdlmvrt S1,.\n\t\x00\x1c\x85 é漢😀́<|>", max_size=60))
def test_any_text(both, text):
    same(both, text)


@pytest.mark.parametrize("text", ["", "<|endoftext|>", "x" * 100_000, " " * 50_000 + "a", "　 " * 5_000, "1" * 30_000])
def test_odd_texts(both, text):
    same(both, text)


def test_text_of_more_than_one_stretch(both, monkeypatch):
    monkeypatch.setattr(byte_bpe, "STRETCH", 64)
    monkeypatch.setattr(byte_bpe, "KNOWN", 10)
    same(both, "Some words, then more words; 12 numbers and Ünïcödé. " * 40)


def test_whole_pieces_that_merges_do_not_reach():
    """A pre-token that is a piece is that piece, as in tiktoken, also where no two parts of it are pieces."""
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 300, b"zz": 400}
    ours = byte_bpe.Codec(ranks, public_tokenizers.PATTERN)
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for text in ["abc", "abcd", "zzz", "abc zz"]:
        assert ids(ours.encode(text)) == theirs.encode_ordinary(text)
    with pytest.raises(ValueError):
        byte_bpe.Codec({b"a": 0}, public_tokenizers.PATTERN)
    with pytest.raises(KeyError):
        ours.decode(struct.pack("<I", 299))


def test_tables(docs, odd):
    ours, theirs = open_both(FILES[0])
    for rows in (docs, odd, odd.limit(0)):
        texts = {}
        for r in rows.select("doc_id", "text").collect():
            texts.setdefault(r.doc_id, []).append(r.text or "")
        encoded = byte_bpe.encode(rows, ["doc_id"], ours)
        decoded = byte_bpe.decode(encoded, ["doc_id", "n_tokens", "ids"], ours).collect()
        assert len(decoded) == sum(map(len, texts.values()))
        for r in decoded:
            text = bytes(r.decoded).decode()
            assert text in texts[r.doc_id]
            assert ids(bytes(r.ids)) == theirs.encode_ordinary(text) and r.n_tokens == len(r.ids) // 4
