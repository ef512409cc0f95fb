"""Byte-level BPE encoding and decoding by the tokenizers library.

A file of ranks (a token's bytes and its rank, which is its id) becomes a
tokenizer of the tokenizers library: bytes are written as printable stand-in
characters (``byte_characters``), a pattern splits the text, every match is
mapped to stand-ins and merged by itself, and a match that is a token as a
whole is taken as it is. Matches recur, so a task lets the library merge each
distinct one once and keeps its ids (``KEPT_MATCHES``); splitting is done by
the regex library, or by the tokenizers library itself where a text holds a
character that the two put into different classes.

The merge list is rebuilt from the ranks. Merging always takes the adjacent
pair whose joint token has the lowest rank, leftmost first. Whatever stands
around a token, the merges inside its span come in the order they have when
the token is merged alone, for a merge across its ends would keep it from
arising at all. So each token arises from one pair of parts only, the last
pair of its own merging, and that list of pairs, ordered by rank, gives the
ids that merging by ranks gives.

Offsets come from the ids: token lengths in bytes add up to byte positions,
and a map from byte to character (UTF-8 lead bytes counted) turns them into
code points. A token that holds part of a character spans the whole character,
so neighbours may overlap there. Decoding reverses the byte table, joins the
bytes, and only then reads characters, so that a character split between
tokens comes back whole; of a cut sequence of ids the torn characters at its
ends become U+FFFD.

Scale: a map over documents without a shuffle. Texts go to the library in
slices of about ``SLICE_CHARS``; a longer text is cut before white space that
follows a visible ASCII character, where a match always begins. What is
broadcast is the tokenizer (a few MB, checked when it is loaded).

Edge cases: a null text is empty; an empty text has no tokens. Repeated rows
and null ids give rows of their own. There are no special tokens: their
strings are ordinary text. Null arrays decode to an empty text; ids that are
null or not in the vocabulary decode to U+FFFD. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import codecs
import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ravel.llm.common import bound_batches, read

MAX_FILE = 64 << 20
SLICE_CHARS = 1 << 18   # text that is split at once
KEPT_MATCHES = 1 << 18  # distinct matches whose ids a task keeps
KEPT_CHARS = 64         # of at most so many characters
DECODED_IDS = 1 << 18   # ids decoded at once
_BOUND = re.compile(r"(?<=[!-~])[ \n]")
_loaded: dict[int, "ByteTokenizer"] = {}


def byte_characters() -> list[str]:
    """The stand-in character of each byte: printable Latin-1 stands for
    itself, the other bytes in order for U+0100, U+0101, ... (a fixed rule of
    the format)."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, spare = [], 0x100
    for b in range(256):
        out.append(chr(b if b in printable else spare))
        spare += b not in printable
    return out


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from lines of base64 and a number."""
    return {base64.b64decode(token): int(rank)
            for token, rank in (line.split() for line in data.splitlines() if line.strip())}


def last_pair(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The two parts ``token`` arises from when it is merged alone; None if
    merging does not reach it."""
    parts = [token[i:i + 1] for i in range(len(token))]
    while len(parts) > 2:
        rank, at = min(((ranks.get(a + b, len(ranks)), i)
                        for i, (a, b) in enumerate(zip(parts, parts[1:]))))
        if rank == len(ranks):
            return None
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return tuple(parts) if len(parts) == 2 else None


def tokenizer_json(ranks: dict[bytes, int], pattern: str) -> str:
    """What a task needs: the rank table as a tokenizer of the tokenizers
    library, the pattern, and the characters it is not sure of."""
    from tokenizers import Regex, Tokenizer, decoders, models, pre_tokenizers

    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("every single byte must be a token")
    if sorted(ranks.values()) != list(range(len(ranks))):
        raise ValueError("ranks must be 0, 1, 2, ...")
    shown = byte_characters()

    def chars(token: bytes) -> str:
        return "".join(map(shown.__getitem__, token))

    ordered = sorted(ranks, key=ranks.get)
    pairs = (last_pair(token, ranks) for token in ordered)
    tok = Tokenizer(models.BPE(
        vocab={chars(token): rank for token, rank in ranks.items()},
        merges=[(chars(p[0]), chars(p[1])) for p in pairs if p], ignore_merges=True))
    tok.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), "isolated"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    tok.decoder = decoders.ByteLevel()
    return json.dumps({"tokenizer": tok.to_str(), "pattern": pattern,
                       "disputed": disputed(pattern)})


def segments(text: str) -> list[str]:
    """``text`` cut into parts of about ``SLICE_CHARS`` where a match of the
    pattern begins whatever stands around; whole where there is no such place."""
    out, start = [], 0
    while len(text) - start > SLICE_CHARS:
        cut = _BOUND.search(text, start + SLICE_CHARS)
        if not cut:
            break
        out.append(text[start:cut.start()])
        start = cut.start()
    return [*out, text[start:]]


def disputed(pattern: str) -> str:
    """Characters that the regex library and the tokenizers library put into
    different classes (their Unicode versions differ), for the classes that
    ``pattern`` names."""
    from tokenizers import Regex, pre_tokenizers

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    differ = np.zeros(len(every), dtype=bool)
    for name in sorted(set(re.findall(r"\\p\{\w+\}|\\s", pattern))):
        theirs, mine = np.ones(len(every), dtype=bool), np.zeros(len(every), dtype=bool)
        for _, (a, b) in pre_tokenizers.Split(Regex(f"{name}+"), "removed") \
                .pre_tokenize_str(every):
            theirs[a:b] = False
        for m in regex.finditer(f"{name}+", every):
            mine[m.start():m.end()] = True
        differ |= theirs != mine
    return "".join(every[i] for i in np.flatnonzero(differ))


class ByteTokenizer:
    """Encoder and decoder of one tokenizer, inside a task."""

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        spec = json.loads(spec)
        self._library = Tokenizer.from_str(spec["tokenizer"])
        self._matches = Tokenizer.from_str(spec["tokenizer"])
        self._matches.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False,
                                                               use_regex=False)
        self._split = regex.compile(spec["pattern"]).findall
        self._disputed = np.zeros(0x110000, dtype=bool)
        self._disputed[[ord(c) for c in spec["disputed"]]] = True
        self._kept: dict[str, bytes] = {}
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        vocab = self._library.get_vocab()
        self.pieces = [b""] * len(vocab)
        for token, i in vocab.items():
            self.pieces[i] = bytes(map(byte_of.__getitem__, token))
        self.lengths = np.array([len(p) for p in self.pieces], dtype=np.int64)
        every = [*self.pieces, "\ufffd".encode()]
        self._table = np.frombuffer(b"".join(every), dtype=np.uint8)
        self._size = np.array([len(p) for p in every], dtype=np.int64)
        self._first = np.cumsum(self._size) - self._size

    def matches(self, text: str) -> list[str]:
        """The pattern's matches in ``text``, in order."""
        if not text.isascii() and self._disputed[
                np.frombuffer(text.encode("utf-32-le"), dtype="<u4")].any():
            return [m for m, _ in self._library.pre_tokenizer[0].pre_tokenize_str(text)]
        return self._split(text)

    def _learn(self, new: list[str]) -> None:
        """Keep the ids of ``new`` matches, packed. They go to the library as
        the words of one sequence; token lengths tell where each ends."""
        found = self._matches.encode_batch_fast([new], is_pretokenized=True,
                                                add_special_tokens=False)[0]
        ids = np.array(found.ids, dtype=np.int32)
        sizes = np.cumsum([len(m.encode()) for m in new])
        ends = ((np.searchsorted(np.cumsum(self.lengths[ids]), sizes) + 1) * 4).tolist()
        raw = ids.tobytes()
        self._kept.update(zip(new, (raw[i:j] for i, j in zip([0, *ends], ends))))

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts of about ``SLICE_CHARS`` characters together."""
        split = [self.matches(t) for t in texts]
        every = set().union(*split)
        if len(self._kept) + len(every) > KEPT_MATCHES:
            self._kept.clear()
        new = list(every.difference(self._kept))
        if new:
            self._learn(new)
        kept = self._kept.__getitem__
        out = [np.frombuffer(b"".join(map(kept, m)), dtype=np.int32) for m in split]
        for m in new:
            if len(m) > KEPT_CHARS:
                del self._kept[m]
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        parts = [(k, s) for k, text in enumerate(texts) for s in segments(text)]
        ids: list[list] = [[] for _ in texts]
        at = 0
        while at < len(parts):
            stop, size = at, 0
            while stop < len(parts) and size < SLICE_CHARS:
                size += len(parts[stop][1])
                stop += 1
            found = self._ids([s for _, s in parts[at:stop]])
            for (k, _), i in zip(parts[at:stop], found):
                ids[k].append(i)
            at = stop
        return [np.concatenate(x) for x in ids]

    def offsets(self, data: bytes, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First code point of every token and the one after its last."""
        raw = np.frombuffer(data, dtype=np.uint8)
        character = np.cumsum((raw & 0xC0) != 0x80) - 1
        ends = np.cumsum(self.lengths[ids])
        starts = ends - self.lengths[ids]
        return character[starts].astype(np.int32), (character[ends - 1] + 1).astype(np.int32)

    def decode_bytes(self, ids) -> bytes:
        """Bytes of the tokens, a gather from the table of all tokens' bytes;
        U+FFFD for what is no id."""
        out = []
        for at in range(0, len(ids), DECODED_IDS):
            i = ids[at:at + DECODED_IDS]
            if isinstance(i, list):
                i = np.array([-1 if x is None else x for x in i], dtype=np.int64)
            i = np.where((i >= 0) & (i < len(self.pieces)), i, len(self.pieces))
            n = self._size[i]
            first = self._first[i] - (np.cumsum(n) - n)
            out.append(self._table[np.repeat(first, n) + np.arange(n.sum())].tobytes())
        return b"".join(out)

    def decode_stream(self, ids):
        """Text of every id in turn: a character split between tokens comes
        with the token that completes it; what stays torn comes last."""
        reader = codecs.getincrementaldecoder("utf-8")("replace")
        for i in ids:
            yield reader.decode(self.decode_bytes([i]))
        yield reader.decode(b"", final=True)


class Spec:
    """A broadcast tokenizer with an identity that survives pickling."""

    def __init__(self, spark: SparkSession, text: str):
        self.id = xxhash.xxh3_64_intdigest(text)
        self._shared = spark.sparkContext.broadcast(text)

    def tokenizer(self) -> ByteTokenizer:
        """The worker's tokenizer; one is kept."""
        if self.id not in _loaded:
            _loaded.clear()
            _loaded[self.id] = ByteTokenizer(self._shared.value)
        return _loaded[self.id]


def load(spark: SparkSession, path: str, pattern: str) -> Spec:
    """Read a rank file on the driver and broadcast it as a tokenizer."""
    if os.path.getsize(path) > MAX_FILE:
        raise ValueError(f"rank file over {MAX_FILE >> 20} MB")
    with open(path, "rb") as f:
        return Spec(spark, tokenizer_json(parse_ranks(f.read()), pattern))


def encode_documents(docs: DataFrame, spec: Spec, id_col: str = "doc_id",
                     text_col: str = "text", offsets: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids, starts, ends) of every row: token ids and their
    code points [start, end) as array<int> (null without ``offsets``)."""
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    names, ints = ["doc_id", "n_tokens", "ids", "starts", "ends"], pa.list_(pa.int32())

    def column(parts):
        ends = np.cumsum([0, *map(len, parts)], dtype=np.int64)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(
            np.concatenate(parts) if parts else np.zeros(0, dtype=np.int32), pa.int32()))

    def run(batches):
        tok = spec.tokenizer()
        for b in batches:
            texts = b["text"].to_pylist()
            ids = tok.encode(texts)
            if offsets:
                spans = [tok.offsets(t.encode(), i) for t, i in zip(texts, ids)]
                places = [column([s[k] for s in spans]) for k in (0, 1)]
            else:
                places = [pa.nulls(len(texts), ints)] * 2
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], pa.array([len(i) for i in ids], pa.int64()), column(ids), *places],
                names)

    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids array<int>, starts array<int>, "
                                "ends array<int>")


def decode_documents(encoded: DataFrame, spec: Spec, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded`` (binary: the bytes of its ids); cast it to
    string for text, or see ``decode_text`` where ids may cut a character."""
    bound_batches(encoded.sparkSession)
    kept = [c for c in encoded.columns if c != "decoded"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                       for f in encoded.select(*kept).schema)

    def run(batches):
        tok = spec.tokenizer()
        for b in batches:
            lists = b[ids_col]
            ids = np.asarray(lists.flatten().fill_null(-1))
            ends = np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(lists), 0)))
            found = [tok.decode_bytes(ids[i:j]) for i, j in zip([0, *ends[:-1]], ends)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, pa.binary())],
                                             [*b.schema.names, "decoded"])

    return encoded.select(*kept).mapInArrow(run, f"{schema}, decoded binary")


def decode_text(data: bytes) -> str:
    """Text of decoded bytes; torn characters become U+FFFD."""
    return data.decode("utf-8", "replace")


def default_spec(spark: SparkSession) -> Spec:
    import public_tokenizers as public

    return load(spark, public.path("byte_bpe_multi_50k.tiktoken"), public.PATTERN)


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over ``documents``; ``n_split`` counts tokens that begin
    inside a character, as their offsets tell."""
    spec = default_spec(spark)
    coded = encode_documents(read(spark, sf_dir, "documents"), spec)
    split = F.expr("size(filter(starts, (s, i) -> i > 0 and s < ends[i - 1]))")
    coded = coded.select("doc_id", "n_tokens", "ids", split.cast("long").alias("n_split"))
    out = decode_documents(coded, spec)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return out.select("doc_id", "n_tokens", F.sha2(ids, 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"), "n_split")


QUERIES = {"op11_byte_bpe": op11_byte_bpe}
ORACLE: dict[str, str] = {}
