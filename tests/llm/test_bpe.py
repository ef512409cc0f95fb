import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ravel.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec():
    with open(PATH, encoding="utf-8") as f:
        return bpe.Codec(f.read())


def digests(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    back = library.decode(ids, skip_special_tokens=False)
    return (len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(),
            hashlib.sha256(back.encode()).hexdigest())


def test_query_equals_library_on_whole_table(spark, library):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = sorted((r.doc_id, *digests(library, r.text)) for r in docs)
    got = sorted(tuple(r) for r in bpe.op8_bpe(spark, sf).collect())
    assert got == want


ALPHABET = ["a", "b", " ", "  ", "\n", "'", "re", "'ll", "é", "ß", "1", "23", ".", "…", "語", " ",
            "\u0085", "🙂", "<|endoftext|>", "<|endof", "text|>", "\t", "\r\n", "the", " the"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(ALPHABET), max_size=120), st.randoms(use_true_random=False))
def test_joined_parts_equal_the_whole(library, codec, parts, rng):
    """Any cut at character bounds, inside special tokens too."""
    text = "".join(parts)
    cuts = sorted(rng.randint(0, len(text)) for _ in range(rng.randint(0, 8)))
    pieces = [codec.encode(text[a:b].encode()) for a, b in zip([0, *cuts], [*cuts, len(text)])]
    ids = codec.join(pieces).tolist()
    assert ids == library.encode(text, add_special_tokens=False).ids
    assert codec.decode(np.array(ids, dtype=np.uint32)) == text


def test_latin_text_equals_library(library, codec):
    """Every plain Latin character beside letters, digits, spaces, marks."""
    assert codec._ranked is not None
    chars = [chr(c) for c in [9, 10, 13, *range(0x20, 0x7F), *range(0xC0, 0x240)]]
    for c in chars:
        for t in (c, c + c, f"a{c}b", f"1{c} 2", f" {c}x's {c}", f"{c}\n\n {c}  {c}'ll", f".{c}.{c}"):
            assert not t.encode().translate(None, bpe._LATIN)
            assert codec.encode(t.encode()).tolist() == \
                library.encode(t, add_special_tokens=False).ids
    for c in range(0x3000):
        if chr(c) not in chars:
            assert chr(c).encode().translate(None, bpe._LATIN)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_any_text_equals_library(library, codec, text):
    assert codec.encode(text.encode()).tolist() == \
        library.encode(text, add_special_tokens=False).ids


def test_chunks_cover_and_resynchronise():
    rng = random.Random(3)
    body = "".join(rng.choice("abcdé 語\n") for _ in range(60_000)).encode()
    for data in (body, b"", b"x", b"a" * 50_000, "語".encode() * 9_000):
        ends = bpe.chunk_ends(data)
        assert (ends[-1] == len(data)) if data else ends == []
        start = 0
        for e in ends:
            data[start:e].decode()
            assert e - start <= bpe.MAX_CHUNK
            start = e
    whole = set(bpe.chunk_ends(body))
    moved = {e - 7 for e in bpe.chunk_ends(b"prefix " + body)}
    assert len(whole & moved) > 0.9 * len(whole)


def test_long_texts_go_in_segments(library, codec, monkeypatch):
    monkeypatch.setattr(bpe, "SEGMENT", 100)
    for text in ("word's  text.\n\n" * 200, "語" * 500, "<|endoftext|> " * 40):
        assert codec.encode(text.encode()).tolist() == \
            library.encode(text, add_special_tokens=False).ids


def test_edge_cases(spark, library):
    rng = random.Random(1)
    shared = " ".join("w%d's" % rng.randrange(5000) for _ in range(2000))
    rows = [(1, None, 1), (2, "", 2), (3, "plain", 3), (4, shared, 4), (4, shared, 4),
            (None, "own start<|endoftext|>" + shared + " tail", 5),
            (6, "語" * 20_000, 6), (7, "x" + "語" * 20_000, 6), (8, shared[100:9000] + "'" + shared, 7),
            (9, "a" * 30_000, 0), (10, "a" * 30_001 + " \n " + shared, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = sorted((tuple(r) for r in bpe.encode_digests(docs).collect()), key=str)
    assert got == sorted(((i, *digests(library, t)) for i, t, _ in rows), key=str)
    assert bpe.encode_digests(docs.where("doc_id < 0")).count() == 0


def test_bloom_has_every_hash(spark):
    rows = spark.range(5000).selectExpr("xxhash64(id) as h1", "xxhash64(id, 1) as h2")
    words = bpe.bloom_words(rows, 1 << 16)
    h = np.array([tuple(r) for r in rows.collect()], dtype=np.int64)
    assert bpe.in_bloom(words, h[:, 0], h[:, 1]).all()
    other = np.random.default_rng(0).integers(-2**62, 2**62, size=(2000, 2))
    assert bpe.in_bloom(words, other[:, 0], other[:, 1]).mean() < 0.3


def test_other_tokenizers_are_refused():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f, \
            pytest.raises(ValueError):
        bpe.Codec(f.read())
