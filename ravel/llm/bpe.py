"""Byte-level BPE encoding with content-defined chunk reuse.

1. A rolling hash over each text's bytes cuts content-defined chunks; 128-bit
   chunk hashes are counted over all documents. Chunks met more than once are
   the shared ones.
2. The shared chunks' hashes go into a Bloom filter of fixed size. Documents
   without a shared chunk are encoded where they are read. Those with one send
   their pieces on: own text between shared chunks as token ids, shared chunks
   by hash. A false positive of the filter only makes a chunk travel by hash.
3. Every shared chunk is encoded once, and its ids are joined to the pieces.
4. Pieces of a document are put together in order. Each join is repaired: a
   window around it is re-encoded and must agree exactly with the tokens
   before it and after it, else the window grows, at last to whole pieces.

Why agreement settles a join: the pre-tokenizer's pattern matches white space
only at the start of a match or in runs of it, so a space or line break after
a visible ASCII character always starts a new pre-token ("anchor"), and BPE
never merges across pre-tokens. The text between two anchors is therefore
encoded the same way alone and in its document.

Scale: texts never cross the network except one copy of each shared chunk (a
task sends a chunk at most once). A chunk in a third of all documents is one
row of the chunk table; its ids reach the documents through a join whose hot
side Spark may split. No group is larger than one document. What is broadcast
is the tokenizer file and the filter (``FILTER_BITS`` bits, 8 MB), whatever
the corpus holds; with very many shared chunks the filter fills up and more
chunks travel by hash, with the same result.

Edge cases: a null text is empty; an empty text has no tokens. The special
token's string in a text becomes the special token, as the tokenizers library
does. Repeated rows and null ids get rows of their own. Extra columns are
ignored.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ravel.llm.common import bound_batches, pinned, read

CUT_BITS = 9            # a cut every 512 bytes on average
MIN_CHUNK = 64
MAX_CHUNK = 8192
FILTER_BITS = 1 << 26   # a power of two, at most 2^32
# The byte-level pre-tokenizer's pattern (a fixed value of the format).
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
           r"|\s+(?!\S)|\s+")
# UTF-8 bytes of plain Latin text: tab, line breaks, printable ASCII, and the
# letters U+00C0 to U+023F. Regex engines agree on their classes.
_LATIN = bytes([9, 10, 13, *range(0x20, 0x7F), *range(0x80, 0xC0), *range(0xC3, 0xC9)])
# Encodings hold over 100 bytes a token in memory: longer texts are encoded
# in segments that end at anchors.
SEGMENT = 1 << 16
_GEAR = np.random.default_rng(20).integers(0, 1 << 32, size=256, dtype=np.uint32)
_loaded: dict[int, "Codec"] = {}


def chunk_ends(data: bytes) -> list[int]:
    """Ends of the content-defined chunks of UTF-8 ``data``; the last is its
    length. A cut depends on the 32 bytes before it and the chunk limits."""
    n = len(data)
    if not n:
        return []
    raw = np.frombuffer(data, dtype=np.uint8)
    h = _GEAR[raw]
    for w in (1, 2, 4, 8, 16):
        if w >= n:
            break
        t = h.copy()
        t[w:] += h[:-w] << np.uint32(w)
        h = t
    cut = np.flatnonzero((h >> np.uint32(32 - CUT_BITS)) == 0) + 1
    ends, start = [], 0
    for c in cut.tolist():
        while c - start > MAX_CHUNK:
            start = _char_start(data, start + MAX_CHUNK)
            ends.append(start)
        if c - start >= MIN_CHUNK and c < n and data[c] & 0xC0 != 0x80:
            ends.append(c)
            start = c
    while n - start > MAX_CHUNK:
        start = _char_start(data, start + MAX_CHUNK)
        ends.append(start)
    return ends + [n]


def _char_start(data: bytes, at: int) -> int:
    while data[at] & 0xC0 == 0x80:
        at -= 1
    return at


def _chunk_hash(data: bytes) -> tuple[int, int]:
    d = xxhash.xxh3_128_intdigest(data)
    return d >> 64, d & 0xFFFFFFFFFFFFFFFF


def _signed(values) -> np.ndarray:
    return np.array(values, dtype=np.uint64).view(np.int64)


def _anchors(data: bytes) -> np.ndarray:
    """Positions of a space or line break right after visible ASCII."""
    raw = np.frombuffer(data, dtype=np.uint8)
    white = (raw[1:] == 0x20) | (raw[1:] == 0x0A)
    return np.flatnonzero(white & (raw[:-1] > 0x20) & (raw[:-1] < 0x7F)) + 1


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of the 256 bytes in a byte-level vocabulary:
    printable Latin-1 stands for itself, the rest for 256, 257, ..."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """Encoder and decoder of one byte-level BPE tokenizer file.

    Plain Latin text goes through a rank-based encoder built from the same
    file (about four times as fast); anything else, and text that may hold an
    added token, goes through the tokenizers library itself."""

    def __init__(self, spec: str):
        import tiktoken

        j = json.loads(spec)
        model = j["model"]
        if model["type"] != "BPE" or (j.get("pre_tokenizer") or {}).get("type") != "ByteLevel" \
                or j["pre_tokenizer"].get("add_prefix_space") or j.get("normalizer"):
            raise ValueError("a byte-level BPE tokenizer without normalizer is needed")
        added = {t["id"]: t["content"].encode() for t in j.get("added_tokens", [])}
        if any(b" " in v or b"\n" in v for v in added.values()):
            raise ValueError("added tokens must not hold white space")
        alphabet = byte_alphabet()
        self.pieces = [b""] * (max([*model["vocab"].values(), *added]) + 1)
        ranks = {}
        for token, i in model["vocab"].items():
            if i not in added:
                self.pieces[i] = bytes(alphabet[c] for c in token)
                ranks[self.pieces[i]] = i
        for i, token in added.items():
            self.pieces[i] = token
        self.added = list(added.values())
        self._spec = spec
        self._library = None
        # ranks stand for the merge list only if ids follow its order
        merges = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        in_order = j["pre_tokenizer"].get("use_regex", True) \
            and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix",
                                               "end_of_word_suffix", "ignore_merges")) \
            and all(model["vocab"].get(a + b) == 256 + i for i, (a, b) in enumerate(merges)) \
            and len(ranks) == 256 + len(model["merges"])
        self._ranked = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks,
                                         special_tokens={}) if in_order else None

    @property
    def library(self):
        if self._library is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_str(self._spec)
            self._library.no_truncation()
            self._library.no_padding()
        return self._library

    def _ids(self, data: bytes) -> np.ndarray:
        if self._ranked and not data.translate(None, _LATIN) \
                and not any(a in data for a in self.added):
            return self._ranked.encode_to_numpy(data.decode(), disallowed_special=())
        ids = self.library.encode(data.decode(), add_special_tokens=False).ids
        return np.array(ids, dtype=np.uint32)

    def encode_all(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of whole texts; a long one goes in segments between anchors."""
        return [self._segments(data) if len(data) > SEGMENT else self._ids(data)
                for data in texts]

    def _segments(self, data: bytes) -> np.ndarray:
        parts, start, a = [], 0, _anchors(data)
        while len(data) - start > SEGMENT:
            i = np.searchsorted(a, start + SEGMENT)
            if i == len(a):
                break
            parts.append(self._ids(data[start:a[i]]))
            start = int(a[i])
        return np.concatenate([*parts, self._ids(data[start:])])

    def encode(self, data: bytes) -> np.ndarray:
        return self.encode_all([data])[0]

    @property
    def packed(self) -> str:
        """How ids travel between stages: two bytes each if they fit."""
        return "<u2" if len(self.pieces) <= 1 << 16 else "<u4"

    def bytes_of(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids.tolist()))

    def decode(self, ids: np.ndarray) -> str:
        return self.bytes_of(ids).decode("utf-8", "replace")

    def _anchored(self, ids: np.ndarray, tail: bool):
        """Two anchors nearest to the join and what lies beyond them:
        (token index of the far anchor, of the near one, bytes from the far
        anchor to the join side); None if there are no two."""
        n, k = len(ids), 32
        while True:
            part = ids[max(0, n - k):] if tail else ids[:k]
            lens = np.fromiter((len(self.pieces[i]) for i in part.tolist()),
                               dtype=np.int64, count=len(part))
            data = self.bytes_of(part)
            a = _anchors(data) if len(data) > 1 else ()
            if len(a) >= 2:
                starts = np.cumsum(lens) - lens
                far, near = (a[-2], a[-1]) if tail else (a[1], a[0])
                at = np.searchsorted(starts, [far, near])
                if (at < len(starts)).all() and (starts[at] == [far, near]).all():
                    shift = max(0, n - k) if tail else 0
                    return (int(at[0]) + shift, int(at[1]) + shift,
                            data[far:] if tail else data[:far])
            if k >= n:
                return None
            k *= 4

    def join(self, pieces: list[np.ndarray]) -> np.ndarray:
        """Ids of the text whose consecutive parts were encoded alone."""
        done: list[np.ndarray] = []
        cur = np.empty(0, dtype=np.uint32)
        raw: list[bytes] = []   # text waiting for an anchor to be encoded up to
        for p in pieces:
            if not len(p):
                continue
            if not raw and not len(cur):
                cur = p
                continue
            left = None if raw else self._anchored(cur, True)
            if not raw and left is None:
                raw.append(self.bytes_of(cur))
            right = self._anchored(p, False)
            if right is None:
                if not raw:
                    done.append(cur[:left[1]])
                    raw.append(self.bytes_of(cur[left[1]:]))
                raw.append(self.bytes_of(p))
                continue
            after = p[right[1]:right[0]]
            if raw:
                ids = self.encode(b"".join(raw) + right[2])
                before = ids[:0]
            else:
                ids = self.encode(left[2] + right[2])
                before = cur[left[0]:left[1]]
            inner = len(ids) - len(after)
            if inner >= len(before) and (ids[:len(before)] == before).all() \
                    and (ids[inner:] == after).all():
                if not raw:
                    done.append(cur[:left[1]])
                done.append(ids[len(before):inner])
                cur, raw = p[right[1]:], []
            else:                       # no agreement: take the whole parts
                raw = (raw or [self.bytes_of(cur)]) + [self.bytes_of(p)]
        done.append(self.encode(b"".join(raw)) if raw else cur)
        return np.concatenate(done).astype(np.uint32)


def codec(spec) -> Codec:
    """The worker's codec for a broadcast tokenizer file."""
    if spec.id not in _loaded:
        _loaded.clear()
        _loaded[spec.id] = Codec(spec.value)
    return _loaded[spec.id]


class _Spec:
    """A broadcast with an identity that survives pickling."""

    def __init__(self, sc, text: str):
        self.id = xxhash.xxh3_64_intdigest(text)
        self._b = sc.broadcast(text)

    @property
    def value(self) -> str:
        return self._b.value


def load_spec(spark: SparkSession, path: str) -> _Spec:
    """Broadcast the tokenizer file (a few MB, read on the driver)."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if len(text) > 64 << 20:
        raise ValueError("tokenizer file over 64 MB")
    Codec(text)
    return _Spec(spark.sparkContext, text)


def shared_chunks(texts: DataFrame) -> DataFrame:
    """(h1, h2) of chunks that occur more than once in ``data``."""
    def run(batches):
        for b in batches:
            hashes = []
            for data in b["data"].to_pylist():
                start = 0
                for end in chunk_ends(data):
                    hashes.append(_chunk_hash(data[start:end]))
                    start = end
            yield pa.RecordBatch.from_arrays(
                [pa.array(_signed([h[k] for h in hashes])) for k in (0, 1)], ["h1", "h2"])

    return (texts.select("data").mapInArrow(run, "h1 long, h2 long")
            .groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"))
            .where("n > 1").select("h1", "h2"))


def bloom_words(hashes: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """Bloom filter as 64-bit words, or-ed together by Spark: at most
    ``bits / 64`` rows reach the driver, however many hashes there are."""
    spots = F.array(*[F.shiftright(h, by).bitwiseAND(F.lit(bits - 1))
                      for h in ("h1", "h2") for by in (0, 32)])
    rows = (hashes.select(F.explode(spots).alias("p"))
            .select(F.shiftright("p", 6).alias("word"),
                    F.expr("shiftleft(1L, cast(p & 63 as int))").alias("bit"))
            .groupBy("word").agg(F.bit_or("bit").alias("bit")).toPandas())
    words = np.zeros(bits // 64, dtype=np.int64)
    words[rows["word"].to_numpy(dtype=np.int64)] = rows["bit"].to_numpy(dtype=np.int64)
    return words


def in_bloom(words: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    found = np.ones(len(h1), dtype=bool)
    for h in (h1, h2):
        for by in (0, 32):
            p = (h >> by) & (len(words) * 64 - 1)
            found &= (words[p >> 6] >> (p & 63)) & 1 == 1
    return found


def _split(data: bytes, words: np.ndarray):
    """(start, end, h1, h2, shared) of the chunks of ``data``."""
    ends = chunk_ends(data)
    starts = [0, *ends[:-1]]
    pairs = [_chunk_hash(data[a:b]) for a, b in zip(starts, ends)]
    h1, h2 = _signed([p[0] for p in pairs]), _signed([p[1] for p in pairs])
    return starts, ends, h1, h2, in_bloom(words, h1, h2)


def encode_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens long, ids binary, decoded string) of every row; ids
    are little-endian unsigned 32-bit integers."""
    spark = docs.sparkSession
    bound_batches(spark)
    spec = load_spec(spark, tokenizer_path)
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("data"))
    words = spark.sparkContext.broadcast(bloom_words(shared_chunks(texts)))

    def finished(doc_ids, ids, c):
        return pa.RecordBatch.from_arrays(
            [pa.array(doc_ids, pa.int64()), pa.array([len(x) for x in ids], pa.int64()),
             pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()),
             pa.array([c.decode(x) for x in ids], pa.string())],
            ["doc_id", "n_tokens", "ids", "decoded"])

    def alone(batches):
        c = codec(spec)
        for b in batches:
            rows = [r for r in zip(b["doc_id"].to_pylist(), b["data"].to_pylist())
                    if not _split(r[1], words.value)[4].any()]
            yield finished([r[0] for r in rows], c.encode_all([r[1] for r in rows]), c)

    def cut(batches):
        c = codec(spec)
        row = TaskContext.get().partitionId() << 40
        sent = set()
        for b in batches:
            out, own = [], []
            for doc_id, data in zip(b["doc_id"].to_pylist(), b["data"].to_pylist()):
                row += 1
                starts, ends, h1, h2, shared = _split(data, words.value)
                if not shared.any():
                    continue
                at, seq = 0, 0
                for i in np.flatnonzero(shared).tolist():
                    if starts[i] > at:
                        own.append((len(out), data[at:starts[i]]))
                        out.append([row, doc_id, seq, None, None, None, None])
                        seq += 1
                    key = (int(h1[i]), int(h2[i]))
                    chunk = None if key in sent else data[starts[i]:ends[i]]
                    sent.add(key)
                    out.append([row, doc_id, seq, *key, chunk, None])
                    at, seq = ends[i], seq + 1
                if at < len(data):
                    own.append((len(out), data[at:]))
                    out.append([row, doc_id, seq, None, None, None, None])
            for (k, _), ids in zip(own, c.encode_all([d for _, d in own])):
                out[k][6] = ids.astype(c.packed).tobytes()
            kinds = [pa.int64()] * 5 + [pa.binary()] * 2
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)],
                ["row", "doc_id", "seq", "h1", "h2", "chunk", "ids"])

    def once(batches):
        c = codec(spec)
        for b in batches:
            ids = c.encode_all(b["chunk"].to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b["h1"], b["h2"],
                 pa.array([x.astype(c.packed).tobytes() for x in ids], pa.binary())],
                ["h1", "h2", "ids"])

    def together(batches):
        c = codec(spec)
        for b in batches:
            parts = b["parts"].to_pylist()
            yield finished(b["doc_id"].to_pylist(), [
                c.join([np.frombuffer(p["ids"], dtype=c.packed) for p in doc]) for doc in parts], c)

    schema = "doc_id long, n_tokens long, ids binary, decoded string"
    plain = texts.mapInArrow(alone, schema)
    pieces = pinned(texts.mapInArrow(
        cut, "row long, doc_id long, seq long, h1 long, h2 long, chunk binary, ids binary"))
    table = (pieces.where("chunk is not null").groupBy("h1", "h2")
             .agg(F.first("chunk").alias("chunk"))
             .mapInArrow(once, "h1 long, h2 long, ids binary"))
    keys = ["row", "doc_id", "seq", "ids"]
    refs = pieces.where("h1 is not null").drop("ids").join(table, ["h1", "h2"]).select(*keys)
    joined = (pieces.where("h1 is null").select(*keys).unionByName(refs)
              .groupBy("row", "doc_id")
              .agg(F.sort_array(F.collect_list(F.struct("seq", "ids"))).alias("parts"))
              .mapInArrow(together, schema))
    return plain.unionByName(joined)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encode_digests(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row."""
    out = encode_documents(docs, tokenizer_path or default_tokenizer())
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over ``documents``."""
    return encode_digests(read(spark, sf_dir, "documents"))


QUERIES = {"op8_bpe": op8_bpe}
ORACLE: dict[str, str] = {}
