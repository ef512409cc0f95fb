"""Benchmark decontamination by latent semantic retrieval.

1. Benchmark items are cut into passages of at most ``ITEM_WORDS`` words.
   Document frequencies of their terms are counted over all documents; a
   document that holds a passage's longest words does not count for that
   passage's terms, so that a passage leaked into many documents keeps its
   weight.
2. A randomised SVD of the passages' TF-IDF matrix is computed by Spark: each
   pass multiplies the partitions' rows with the current basis and adds the
   partial products up by blocks of terms. The rank is doubled until every
   passage keeps ``CAPTURED`` of its norm.
3. Every document is read as windows of ``WINDOW`` words at half-window steps.
   A window's TF-IDF vector is projected to the latent space and compared with
   all passages, by cosine and by the share of the passage's weight that it
   covers, which does not depend on the words around a copy; windows too poor
   in benchmark terms to reach any passage's threshold are not projected. A run of ``SHORT``
   words of a passage, or a whole passage of fewer, is a candidate where it
   occurs, so that no word-for-word copy depends on the projection.
4. A candidate is checked against the words around its window: the longest
   common subsequence must hold ``LCS_SURE`` of the passage's words, or
   ``LCS_PARAPHRASE`` of them and the answer, the passage's last words, in
   order. Passages under ``SHORT`` words must occur word for word.

Scale: documents are only mapped over; nothing of them is shuffled but term
counts, partially summed by task. They are read twice, whatever the size of the
benchmark: once for the frequencies of all its terms, once to match all its
passages. A benchmark is taken in blocks of about ``BLOCK_WORDS`` words and
``BLOCK_PASSAGES`` passages, so a basis has at most that many rows, of at most
one float a passage. Blocks travel as broadcast files; a task numbers the words
of about ``CHUNK_BYTES`` of text once and holds one block after another against
them, so that its memory does not grow with the benchmark.

Edge cases: null or empty texts and items without words match nothing. Items of
fewer than ``LEAST_WORDS`` words and ``LEAST_CHARS`` characters are too short to
tell a copy from common speech: they match nothing and ``too_short`` lists them. Words
are runs of letters, digits and non-ASCII characters, lower-cased. Equal items
are reported each under its own item_id; rows that repeat a doc_id or an
item_id share one result row, with the best match. Null ids are kept as null.
An empty benchmark or an empty documents table gives an empty result. Extra
columns are ignored; where documents are filtered they pass through.
"""

from __future__ import annotations

import math
from collections import defaultdict
from itertools import count, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ravel.llm.common import bound_batches, pinned, read

WINDOW = 32            # words; windows start every half window
ITEM_WORDS = 64
BLOCK_WORDS = 32768    # expected benchmark words a block, per pass
BLOCK_PASSAGES = 1024  # and passages
CHUNK_BYTES = 8 << 20  # of text that a task holds against one block after another
LEAST_WORDS = 3        # an item has at least so many words
LEAST_CHARS = 24       # or characters (scripts without spaces)
RANK = 128             # to begin with
CAPTURED = 0.9         # least share of each passage's norm in the latent space
OVERSAMPLE = 16
POWER_STEPS = 2
# Of the cosine, or of the covered weight, a full copy would have: a candidate.
# 0.55 keeps copies with two words in five replaced.
CANDIDATE = 0.55
LCS_SURE = 0.8
LCS_PARAPHRASE = 0.6
ANSWER_WORDS = 5
ANSWER_SHARE = 0.8
SHORT = 8
MARKS = 4              # longest words by which a leaked passage is told
_TERMS_PER_ROW = 256
_RUN_BASE = np.uint64(0x9E3779B97F4A7C15)
_RUN_BITS = 20
_CLEAN = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(_CLEAN).split()


def tells(words: list[bytes]) -> bool:
    """Whether an item is long enough for its occurrence to mean anything."""
    return len(words) >= LEAST_WORDS or len(b"".join(words).decode()) >= LEAST_CHARS


def lcs_length(masks: dict, size: int, words) -> int:
    """Longest common subsequence with a passage given as bit masks of its
    word positions (bit-parallel: one addition a matching word)."""
    v = (1 << size) - 1
    for w in words:
        m = masks.get(w)
        if m:
            u = v & m
            v = (v + u) | (v - u)
    return size - (v & ((1 << size) - 1)).bit_count()


def _masks(words) -> dict:
    out: dict = {}
    for i, w in enumerate(words):
        out[w] = out.get(w, 0) | 1 << i
    return out


def _least_cover(weights: np.ndarray) -> float:
    """Share of a passage's weight in the best window of a full copy, where
    the copy lies worst between the windows' starts."""
    step, sums = WINDOW // 2, np.append(0.0, np.cumsum(weights))
    first = np.arange(step)[:, None]        # words of the copy before a start
    starts = first + np.arange(-step, len(weights), step)[None, :]
    inside = sums[np.clip(starts + WINDOW, 0, len(weights))] - sums[np.clip(starts, 0, len(weights))]
    return float(inside.max(axis=1).min() / sums[-1])


def _run_hashes(ids: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each position on."""
    ids = ids.astype(np.uint64) + np.uint64(1)
    out = np.zeros(max(0, len(ids) - size + 1), dtype=np.uint64)
    for j in range(size):
        out = out * _RUN_BASE + ids[j:j + len(out)]
    return out


class Texts:
    """Some texts as arrays of numbers, one for each distinct word of them."""

    def __init__(self, texts):
        numbers = defaultdict(count().__next__)
        self.ids = []
        for text in texts:
            words = words_of(text)
            self.ids.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
        self.words = list(numbers)

    def terms(self, vocab: dict) -> np.ndarray:
        """The term number of each word; ``len(vocab)`` for words outside."""
        return np.fromiter(map(vocab.get, self.words, repeat(len(vocab))), np.int32,
                           len(self.words))


class Passages:
    """One block of benchmark passages with its vocabulary; broadcast."""

    def __init__(self, items: list[tuple], passages: list[list[bytes]]):
        self.items = items                      # item_id of each passage
        vocab = sorted({w for p in passages for w in p})
        self.vocab = {w: i for i, w in enumerate(vocab)}
        self.words = [np.array([self.vocab[w] for w in p], dtype=np.int32) for p in passages]
        marks = [sorted(set(p), key=lambda w: (-len(w), w))[:MARKS] for p in passages]
        self.marks = np.array([[self.vocab[m[min(i, len(m) - 1)]] for i in range(MARKS)]
                               for m in marks], dtype=np.int32).reshape(-1, MARKS)
        self.idf = np.zeros(len(vocab) + 1)
        self.basis = self.latent = self.limit = self.captured = self.cover = self.reach = None
        self.least = 0.0
        self._index_runs()

    def _index_runs(self) -> None:
        """{run length: (marks by leading hash bits, {hash: [(passage, offset)]})}."""
        self.runs: dict = {}
        for k, p in enumerate(self.words):
            size = min(len(p), SHORT)
            table = self.runs.setdefault(size, {})
            for at, h in enumerate(_run_hashes(p, size).tolist()):
                table.setdefault(h, []).append((k, at))
        for size, table in self.runs.items():
            marked = np.zeros(1 << _RUN_BITS, dtype=bool)
            marked[np.fromiter(table, np.uint64, len(table)) >> np.uint64(64 - _RUN_BITS)] = True
            self.runs[size] = marked, table

    def copies(self, ids: np.ndarray) -> set:
        """(passage, start of the copy) for every run of a passage in ``ids``."""
        found = set()
        for size, (marked, table) in self.runs.items():
            h = _run_hashes(ids, size)
            at = np.flatnonzero(marked[h >> np.uint64(64 - _RUN_BITS)])
            for i, key in zip(at.tolist(), h[at].tolist()):
                for k, offset in table.get(key, ()):
                    found.add((k, max(0, i - offset)))
        return found

    def present(self, ids: np.ndarray) -> np.ndarray:
        """Terms for which a document of these term numbers counts: those it
        holds, without those of passages whose marks it holds all."""
        held = np.zeros(len(self.vocab) + 1, dtype=bool)
        held[ids] = True
        held[-1] = False
        for k in np.flatnonzero(held[self.marks].all(axis=1)):
            held[self.words[k]] = False
        return np.flatnonzero(held)

    def weigh(self, df: np.ndarray, n_docs: int) -> None:
        """Inverse document frequencies; a word outside the vocabulary weighs
        as one met in no document."""
        self.idf = np.log((n_docs + 2) / (np.append(df, 0) + 1))

    def _row(self, p: np.ndarray):
        t, tf = np.unique(p, return_counts=True)
        return t, tf * self.idf[t]

    def rows(self):
        """(terms, weights) of each passage that may be met in part: its sparse
        TF-IDF row, of norm 1 so that no passage gives way to a heavier one."""
        for p in self.words:
            if len(p) >= SHORT:
                t, w = self._row(p)
                yield t, w / np.linalg.norm(w)

    def shares(self, basis: np.ndarray) -> np.ndarray:
        """Share of each row's norm that lies in the basis."""
        return np.array([np.linalg.norm(w @ basis[t]) for t, w in self.rows()])

    def settle(self, basis: np.ndarray) -> None:
        """Take the latent basis (terms x rank) and place the passages."""
        self.basis = np.vstack([basis * self.idf[:-1, None],
                                np.zeros((1, basis.shape[1]))]).astype(np.float32)
        latent = np.array([self.basis[p].sum(axis=0) for p in self.words])
        norms = np.linalg.norm(latent, axis=1)
        full = np.array([np.linalg.norm(self._row(p)[1]) for p in self.words])
        self.captured = np.minimum(norms / np.maximum(full, 1e-12), 1.0)
        self.latent = (latent / np.maximum(norms, 1e-12)[:, None]).astype(np.float32)
        size = np.array([len(p) for p in self.words])
        projected = size >= SHORT
        self.limit = CANDIDATE * np.sqrt(np.minimum(size, WINDOW) / np.maximum(size, WINDOW))
        # a window's latent norm is at most the norm of its benchmark terms:
        # below this share of the whole window's norm no limit is reached
        self.least = float((self.limit * self.captured)[projected].min(initial=2.0)) ** 2 / 2
        # latent product with a passage at which a window covers enough of it,
        # and the most that each word adds to a passage's limit
        self.cover = np.full(len(size), np.inf)
        self.reach = np.zeros(len(self.idf))
        for k in np.flatnonzero(projected):
            p = self.words[k]
            t, w = self._row(p)
            need = CANDIDATE * _least_cover((w * self.idf[t])[np.searchsorted(t, p)])
            self.cover[k] = need * norms[k]
            self.reach[t] = np.maximum(self.reach[t], w * self.idf[t] / (need * (w @ w)))
        # shorter passages must occur word for word: their runs find them
        self.limit[~projected] = np.inf
        self.masks = [_masks(p.tolist()) for p in self.words]
        self.answers = [_masks(p[-ANSWER_WORDS:].tolist()) for p in self.words]

    def candidates(self, text: str | None):
        """(document as term numbers, [(passage, window start, cosine)])."""
        texts = Texts([text])
        ids = texts.terms(self.vocab)[texts.ids[0]]
        return ids, self.near(ids)

    def near(self, ids: np.ndarray) -> list:
        """[(passage, window start, cosine)] of a document's term numbers."""
        n, step = len(ids), WINDOW // 2
        if not n:
            return []
        found = {(k, start): None for k, start in self.copies(ids)}
        w2 = (self.idf ** 2)[ids]
        starts = np.arange(0, n, step)
        every = np.add.reduceat(w2, starts)
        known = np.add.reduceat(np.where(ids < len(self.vocab), w2, 0), starts)
        reach = np.add.reduceat(self.reach[ids], starts)
        if len(starts) > 1:
            every = every[:-1] + every[1:]
            known = known[:-1] + known[1:]
            reach = reach[:-1] + reach[1:]
        at = np.flatnonzero((known > 0) & ((known >= self.least * every) | (reach >= CAPTURED)))
        if len(at):
            latent = np.array([self.basis[ids[starts[i]:starts[i] + WINDOW]].sum(axis=0) for i in at])
            norms = np.maximum(np.linalg.norm(latent, axis=1)[:, None],
                               self.captured[None, :] * np.sqrt(every[at])[:, None])
            along = latent @ self.latent.T
            cos = along / np.maximum(norms, 1e-12)
            near = (cos >= self.limit[None, :]) | (along >= self.cover[None, :] * (1 - 1e-4))
            for i, j in np.argwhere(near):
                found[int(j), int(starts[at[i]])] = float(cos[i, j])
        return [(k, start, self.cosine(ids, k, start) if cos is None else cos)
                for (k, start), cos in found.items()]

    def cosine(self, ids: np.ndarray, k: int, start: int) -> float:
        """Cosine of a passage and the benchmark words of the window at
        ``start``, without projection."""
        window = ids[start:start + max(WINDOW, len(self.words[k]))]
        (t, a), (u, b) = self._row(window[window < len(self.vocab)]), self._row(self.words[k])
        _, i, j = np.intersect1d(t, u, assume_unique=True, return_indices=True)
        return float(a[i] @ b[j] / max(np.linalg.norm(a) * np.linalg.norm(b), 1e-12))

    def verify(self, ids: np.ndarray, k: int, start: int):
        """(share of the longest common subsequence, answer found, hit)."""
        p = self.words[k]
        span = ids[max(0, start - len(p)):start + WINDOW + len(p)]
        if len(p) < SHORT:
            hit = len(span) >= len(p) and bool(
                (np.lib.stride_tricks.sliding_window_view(span, len(p)) == p).all(axis=1).any())
            return float(hit), hit, hit
        span = span.tolist()
        share = lcs_length(self.masks[k], len(p), span) / len(p)
        if share < LCS_PARAPHRASE:
            return share, False, False
        size = min(ANSWER_WORDS, len(p))
        answer = lcs_length(self.answers[k], size, span) >= ANSWER_SHARE * size
        return share, answer, share >= LCS_SURE or answer

    def hits(self, text: str | None) -> dict:
        """Verified passages of a text: {item: (lcs, cosine, answer)}."""
        texts = Texts([text])
        return self.verified(texts.terms(self.vocab)[texts.ids[0]])

    def verified(self, ids: np.ndarray) -> dict:
        """``hits`` of a document's term numbers."""
        best: dict = {}
        for k, start, cos in self.near(ids):
            item = self.items[k]
            if item in best and best[item][0] == 1.0:
                continue
            share, answer, hit = self.verify(ids, k, start)
            if hit:
                best[item] = max(best.get(item, (0.0, 0.0, False)), (share, cos, answer))
        return best


def too_short(benchmark: DataFrame, id_col: str = "item_id",
              text_col: str = "text") -> DataFrame:
    """(item_id, text) of the items that hold words, but too few to be looked for."""
    def run(batches):
        for b in batches:
            words = map(words_of, b["text"].to_pylist())
            yield b.filter(pa.array([bool(w) and not tells(w) for w in words], pa.bool_()))

    return benchmark.select(F.col(id_col).cast("long").alias("item_id"),
                            F.col(text_col).alias("text")) \
        .mapInArrow(run, "item_id long, text string")


def _blocks(benchmark: DataFrame, id_col: str, text_col: str):
    """The benchmark's passages, block by block."""
    texts = benchmark.select(F.col(id_col).cast("long").alias("item"),
                             F.col(text_col).alias("text")).distinct()

    def cut(batches):
        for b in batches:
            items, parts = [], []
            for item, text in zip(b["item"].to_pylist(), b["text"].to_pylist()):
                words = words_of(text)
                n = max(1, math.ceil(len(words) / ITEM_WORDS))
                for i in range(n if tells(words) else 0):
                    items.append(item)
                    parts.append(words[len(words) * i // n:len(words) * (i + 1) // n])
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, pa.int64()), pa.array(parts, pa.list_(pa.binary()))],
                ["item", "words"])

    rows = pinned(texts.mapInArrow(cut, "item long, words array<binary>"))
    total, passages = rows.agg(F.sum(F.size("words")), F.count(F.lit(1))).first()
    blocks = math.ceil(max((total or 0) / BLOCK_WORDS, passages / BLOCK_PASSAGES))
    for i in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("item", "words"), F.lit(blocks)) == i) \
            .orderBy("item", "words").collect()
        if part:
            yield Passages([r.item for r in part], [[bytes(w) for w in r["words"]] for r in part])


def _chunks(batches):
    """Lists of Arrow batches that hold about ``CHUNK_BYTES`` of text each."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b["text"].nbytes
        if size >= CHUNK_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def _in_turn(blocks):
    """The values of broadcast blocks, for a task: of several, each is read
    from its file when its turn comes and not kept."""
    for block in blocks:
        path = getattr(block, "_path", None)
        yield block.load_from_path(path) if path and len(blocks) > 1 else block.value


def _numbered(held) -> Texts:
    return Texts(t for b in held for t in b["text"].to_pylist())


def document_frequencies(texts: DataFrame, blocks: list) -> DataFrame:
    """(block, term, n): documents holding each term of each block outside its
    own passages, over all rows of ``texts`` (column ``text``) in one pass; the
    term after a block's last counts the rows."""
    def run(batches):
        df: dict = {}
        for held in _chunks(batches):
            numbered = _numbered(held)
            for at, block in enumerate(_in_turn(blocks)):
                n = df.setdefault(at, np.zeros(len(block.vocab) + 1, dtype=np.int64))
                n[-1] += len(numbered.ids)
                terms = numbered.terms(block.vocab)
                for ids in numbered.ids:
                    if len(ids):
                        n[block.present(terms[ids])] += 1
        for at, n in df.items():
            found = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(found), at)), pa.array(found), pa.array(n[found])],
                ["block", "term", "n"])

    return (texts.mapInArrow(run, "block long, term long, n long")
            .groupBy("block", "term").agg(F.sum("n").alias("n")))


def randomised_svd(rows: DataFrame, terms: int, rank: int = RANK) -> np.ndarray:
    """Leading right singular vectors (terms x at most ``rank``) of the sparse
    matrix whose rows are (t array<int>, w array<double>).

    Spark multiplies and sums; the driver holds one terms x rank matrix and
    makes it orthonormal between passes."""
    sc = rows.sparkSession.sparkContext
    width = min(terms, rank + OVERSAMPLE)
    q = np.random.default_rng(7).standard_normal((terms, width))
    q, _ = np.linalg.qr(q)

    def gram(batches):
        """This partition's part of (A' A) Q, cut into blocks of terms."""
        basis = shared.value
        z: dict[int, np.ndarray] = {}
        for b in batches:
            for t, w in zip(b["t"].to_pylist(), b["w"].to_pylist()):
                t, w = np.array(t, dtype=np.int64), np.array(w)
                y = w @ basis[t]
                for at in np.unique(t // _TERMS_PER_ROW).tolist():
                    mine = t // _TERMS_PER_ROW == at
                    part = z.setdefault(at, np.zeros((_TERMS_PER_ROW, width)))
                    part[t[mine] % _TERMS_PER_ROW] += w[mine, None] * y
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(z), pa.int64()), pa.array([v.tobytes() for v in z.values()],
                                                     pa.binary())], ["at", "part"])

    def add(pdf):
        total = sum(np.frombuffer(p) for p in pdf["part"])
        pdf = pdf.iloc[:1].copy()
        pdf["part"] = [total.tobytes()]
        return pdf

    for _ in range(POWER_STEPS + 1):
        shared = sc.broadcast(q)
        z = np.zeros((terms + _TERMS_PER_ROW, width))
        parts = (rows.mapInArrow(gram, "at long, part binary")
                 .groupBy("at").applyInPandas(add, "at long, part binary"))
        for at, part in parts.toLocalIterator():
            z[at * _TERMS_PER_ROW:(at + 1) * _TERMS_PER_ROW] = \
                np.frombuffer(bytes(part)).reshape(-1, width)
        shared.unpersist()
        q, sizes, _ = np.linalg.svd(z[:terms], full_matrices=False)
    keep = sizes > sizes[0] * 1e-10 if len(sizes) and sizes[0] > 0 else sizes > 0
    return q[:, keep][:, :rank]


def prepared_blocks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                    item_col: str = "item_id", item_text_col: str = "text"):
    """Broadcast ``Passages``, ready to match, one for each block."""
    spark = docs.sparkSession
    bound_batches(spark)
    sc = spark.sparkContext
    drafts = [sc.broadcast(block) for block in _blocks(benchmark, item_col, item_text_col)]
    if not drafts:
        return
    counts = pinned(document_frequencies(docs.select(F.col(text_col).alias("text")), drafts))
    for at, draft in enumerate(drafts):
        block = draft.value
        df = np.zeros(len(block.vocab) + 1, dtype=np.int64)
        for term, n in counts.where(F.col("block") == at).select("term", "n").collect():
            df[term] = n
        block.weigh(df[:-1], int(df[-1]))
        block.settle(latent_basis(spark, block))
        yield sc.broadcast(block)
        drafts[at] = None
        draft.unpersist()


def latent_basis(spark: SparkSession, block: Passages, rank: int = RANK) -> np.ndarray:
    """The basis of the least rank, doubled from ``rank`` on, in which every
    passage keeps ``CAPTURED`` of its norm; as many directions as there are
    passages hold them whole."""
    rows = [(t.tolist(), w.tolist()) for t, w in block.rows()]
    if not rows:
        return np.zeros((len(block.vocab), 1))
    table = spark.createDataFrame(rows, "t array<int>, w array<double>")
    while True:
        basis = randomised_svd(table, len(block.vocab), rank)
        if rank >= len(rows) or block.shares(basis).min() >= CAPTURED:
            return basis
        rank = min(2 * rank, len(rows))


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, lcs, cosine, answer): one row for each document and
    item found in it."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.col(text_col).alias("text"))
    schema = "doc_id long, item_id long, lcs double, cosine double, answer boolean"
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.bool_()]
    blocks = list(prepared_blocks(docs, benchmark, text_col))
    if not blocks:
        return docs.sparkSession.createDataFrame([], schema)

    def run(batches):
        for held in _chunks(batches):
            doc_ids = [d for b in held for d in b["doc_id"].to_pylist()]
            numbered, rows = _numbered(held), []
            for block in _in_turn(blocks):
                terms = numbered.terms(block.vocab)
                for d, ids in zip(doc_ids, numbered.ids):
                    rows += [(d, item, *hit) for item, hit in block.verified(terms[ids]).items()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                ["doc_id", "item_id", "lcs", "cosine", "answer"])

    out = texts.mapInArrow(run, schema)
    best = out.groupBy("doc_id", "item_id").agg(
        F.max(F.struct("lcs", "cosine", "answer")).alias("b"))
    return best.select("doc_id", "item_id", "b.lcs", "b.cosine", "b.answer")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows in which a benchmark item was found."""
    blocks = list(prepared_blocks(docs, benchmark))
    if not blocks:
        return docs

    def run(batches):
        for held in _chunks(batches):
            numbered = _numbered(held)
            clean = np.ones(len(numbered.ids), dtype=bool)
            for block in _in_turn(blocks):
                terms = numbered.terms(block.vocab)
                for i in np.flatnonzero(clean):
                    clean[i] = not block.verified(terms[numbered.ids[i]])
            at = 0
            for b in held:
                yield b.filter(pa.array(clean[at:at + len(b)]))
                at += len(b)

    return docs.mapInArrow(run, docs.schema)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents`` against all of ``benchmark``."""
    return find_contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES = {"op10_decontaminate": op10_decontaminate}
ORACLE: dict[str, str] = {}
