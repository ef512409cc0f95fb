import hashlib

import numpy as np
import public_tokenizers as public
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from ravel.llm import byte_bpe

PATH = public.path("byte_bpe_multi_50k.tiktoken")
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def ranks():
    with open(PATH, "rb") as f:
        return byte_bpe.parse_ranks(f.read())


@pytest.fixture(scope="module")
def truth(ranks):
    return tiktoken.Encoding("truth", pat_str=public.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


@pytest.fixture(scope="module")
def tok(ranks):
    return byte_bpe.ByteTokenizer(byte_bpe.tokenizer_json(ranks, public.PATTERN))


def hexed(data):
    return hashlib.sha256(data).hexdigest()


def row_of(truth, doc_id, text):
    ids = truth.encode_ordinary(text or "")
    return (doc_id, len(ids), hexed(",".join(map(str, ids)).encode()),
            hexed(truth.decode_bytes(ids)))


def test_query_equals_tiktoken_on_whole_table(spark, truth):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    out = byte_bpe.op11_byte_bpe(spark, SF)
    assert dict(out.dtypes)["n_tokens"] == "bigint"
    got = sorted(tuple(r)[:4] for r in out.collect())
    assert got == sorted(row_of(truth, r.doc_id, r.text) for r in docs)


def test_every_code_point(tok, truth):
    """Each character beside letters, digits, spaces and marks."""
    texts = [f"a{c}b 1{c} {c}.{c}" for c in map(chr, [*range(0xD800), *range(0xE000, 0x110000, 7)])]
    for at in range(0, len(texts), 4096):
        part = texts[at:at + 4096]
        assert [i.tolist() for i in tok.encode(part)] == truth.encode_ordinary_batch(part)


PARTS = ["a", "aa", "the", " the", " ", "  ", "\n", "\r\n", "\t", "'s", "'", "'ll", "1", "2024", "é",
         "ß", "語", "한", "🙂", "👩‍👩‍👧", "́", " ", " ", "\u0085", "٣", "<|endoftext|>",
         "Ünïcödé", "-----", "....", "𞤀", "\U0001e030", "͸", "\x00", "ﷺ"]


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=80), st.lists(st.sampled_from(PARTS), max_size=60).map("".join)))
def test_any_text(tok, truth, text):
    ids = truth.encode_ordinary(text)
    got = tok.encode([text, "", text])
    assert [g.tolist() for g in got] == [ids, [], ids]
    assert tok.decode_bytes(ids) == text.encode()
    assert "".join(tok.decode_stream(ids)) == text
    starts, ends = tok.offsets(text.encode(), got[0])
    # the same spans character by character
    at, spans = 0, []
    owner = [k for k, c in enumerate(text) for _ in c.encode()]
    for i in ids:
        n = len(truth.decode_single_token_bytes(i))
        spans.append((owner[at], owner[at + n - 1] + 1))
        at += n
    assert list(zip(starts.tolist(), ends.tolist())) == spans


def test_torn_characters(tok):
    ids = tok.encode(["🙂語"])[0].tolist()
    assert len(ids) > 2
    for k in range(len(ids) + 1):
        raw = tok.decode_bytes(ids[:k])
        assert "".join(tok.decode_stream(ids[:k])) == byte_bpe.decode_text(raw)
    assert tok.decode_bytes([None, 1 << 30, -1, ids[0]]) == "�".encode() * 3 + tok.pieces[ids[0]]


def test_kept_matches_are_bounded(ranks, truth, monkeypatch):
    monkeypatch.setattr(byte_bpe, "KEPT_MATCHES", 20)
    monkeypatch.setattr(byte_bpe, "SLICE_CHARS", 100)
    tok = byte_bpe.ByteTokenizer(byte_bpe.tokenizer_json(ranks, public.PATTERN))
    texts = ["x" * 300, " ".join(f"word{i % 37}" for i in range(400)), "語" * 150, "y\n " * 90]
    for _ in range(2):
        assert [i.tolist() for i in tok.encode(texts)] == [truth.encode_ordinary(t) for t in texts]
        assert len(tok._kept) <= 120 and not any(len(m) > 64 for m in tok._kept)
    for t in texts:
        assert "".join(byte_bpe.segments(t)) == t


def test_last_pairs_on_a_small_table():
    ranks = {b: r for r, b in enumerate([b"a", b"b", b"c", b"ab", b"bc", b"abc", b"zz"])}
    assert byte_bpe.last_pair(b"abc", ranks) == (b"ab", b"c")
    assert byte_bpe.last_pair(b"zzz", ranks | {b"zzz": 9}) == (b"zz", b"z")
    assert byte_bpe.last_pair(b"cabzc", ranks) is None
    with pytest.raises(ValueError):
        byte_bpe.tokenizer_json(ranks, public.PATTERN)


def test_edge_cases(spark, truth):
    rows = [(1, None, 1, "x"), (2, "", 2, "x"), (3, "plain text", 3, "x"), (3, "plain text", 3, "x"),
            (None, "語🙂", 4, "x"), (5, "word " * 90_000, 5, "x"), (6, "a" * 3_000, 6, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int, decoded string")
    spec = byte_bpe.default_spec(spark)
    coded = byte_bpe.encode_documents(docs, spec)
    out = byte_bpe.decode_documents(coded, spec).collect()
    got = sorted(((r.doc_id, r.ids, bytes(r.decoded).decode()) for r in out), key=str)
    assert got == sorted(((i, truth.encode_ordinary(t or ""), t or "") for i, t, _, _ in rows),
                         key=str)
    last = next(r for r in out if r.doc_id is None)
    assert last.starts[0] == 0 and last.ends[-1] == 2
    assert byte_bpe.encode_documents(docs, spec, offsets=False).where("starts is null").count() == 7
    none = byte_bpe.encode_documents(docs.where("doc_id < 0"), spec)
    assert byte_bpe.decode_documents(none, spec).count() == 0
    odd = spark.createDataFrame([(1, None), (2, [64, None, 10**9])], "k int, ids array<int>")
    assert sorted((r.k, bytes(r.decoded).decode()) for r in
                  byte_bpe.decode_documents(odd, spec).collect()) == [(1, ""), (2, "a��")]


def test_offsets_of_long_arrays(tok):
    text = "né " * 1000
    ids = tok.encode([text])[0]
    starts, ends = tok.offsets(text.encode(), ids)
    assert starts[0] == 0 and ends[-1] == len(text)
    assert (np.diff(starts) >= 0).all()
