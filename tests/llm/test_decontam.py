import random
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
import pytest

from ravel.llm import decontam as D

SF = "/root/testdata/sf0.01"


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], prev + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_lcs_equals_table(spark):
    rng = random.Random(0)
    for _ in range(300):
        a = [rng.randrange(6) for _ in range(rng.randint(1, 70))]
        b = [rng.randrange(8) for _ in range(rng.randint(0, 90))]
        assert D.lcs_length(D._masks(a), len(a), b) == slow_lcs(a, b)


def test_words():
    assert D.words_of("It's  ÉTÉ—no. 1\n") == ["it", "s", "été—no", "1"] \
        or D.words_of("It's  ÉTÉ—no. 1\n") == [w.encode() for w in ("it", "s", "été—no", "1")]
    assert D.words_of(None) == []


@pytest.fixture(scope="module")
def tables(spark):
    return (spark.read.parquet(f"{SF}/documents.parquet"),
            spark.read.parquet(f"{SF}/benchmark.parquet"))


def test_query_against_brute_force(spark, tables):
    """Candidates lose no pair that the checks would accept anywhere (recall
    of the latent search), and every word-for-word copy is found."""
    docs, bench = tables
    got = {(r.doc_id, r.item_id) for r in D.op10_decontaminate(spark, SF).collect()}
    block = next(iter(D.prepared_blocks(docs, bench))).value
    texts = {r.doc_id: r.text for r in docs.collect()}
    copies, accepted = set(), set()
    for d, t in texts.items():
        joined = b" " + b" ".join(D.words_of(t)) + b" "
        ids = np.array([block.vocab.get(w, len(block.vocab)) for w in D.words_of(t)])
        known = set(ids.tolist())
        for k, item in enumerate(block.items):
            p = block.words[k]
            words = b" ".join(sorted(block.vocab, key=block.vocab.get)[i] for i in p) \
                if len(known & set(p.tolist())) >= 0.6 * len(set(p.tolist())) else None
            if words is None:
                continue
            if b" " + words + b" " in joined:
                copies.add((d, item))
            if any(block.verify(ids, k, s)[2] for s in range(0, len(ids), D.WINDOW // 2)):
                accepted.add((d, item))
    assert copies <= got
    assert got <= accepted
    assert len(got) >= 0.95 * len(accepted)
    # what is reported but not a copy is at least a near copy
    for d, item in got - copies:
        p = [k for k in range(len(block.items)) if block.items[k] == item][0]
        words = [list(block.vocab)[i] for i in block.words[p]]
        s = SequenceMatcher(None, words, D.words_of(texts[d]), autojunk=False)
        assert sum(m.size for m in s.get_matching_blocks()) >= 0.5 * len(words)


def test_paraphrases_are_caught_and_clean_text_is_left(spark, tables):
    docs, bench = tables
    rng = random.Random(4)
    items = [(r.item_id, r.text) for r in bench.orderBy("item_id").collect()]
    filler = [w for r in docs.where("doc_id between 100 and 160").collect()
              for w in r.text.split() if w.isalpha()]
    rows, planted = [], []
    for n, (item, text) in enumerate(items):
        for kind in ("copy", "case", "swap", "drop", "order"):
            words = text.split()
            if kind == "case":
                words = [w.upper() + "," for w in words]
            if kind == "swap":      # one word in six replaced
                words = [rng.choice(filler) if i % 6 == 3 else w for i, w in enumerate(words)]
            if kind == "drop":      # a quarter left out, the answer kept
                words = [w for i, w in enumerate(words) if i % 4 or i >= len(words) - 5]
            if kind == "order":     # same words, sorted: not a copy
                words = sorted(words)
            d = len(rows)
            rows.append((d, " ".join([*rng.choices(filler, k=rng.randint(0, 90)), *words,
                                      *rng.choices(filler, k=rng.randint(0, 90))])))
            if kind != "order":
                planted.append((d, item))
    clean = [(10_000 + i, " ".join(rng.choices(filler, k=300))) for i in range(200)]
    got = {(r.doc_id, r.item_id) for r in D.find_contamination(
        spark.createDataFrame(rows + clean, "doc_id long, text string"), bench).collect()}
    assert len(got & set(planted)) >= 0.97 * len(planted)
    assert not [g for g in got if g[0] >= 10_000]
    assert len({g[0] for g in got} - {p[0] for p in planted}) <= 0.05 * len(items)


def test_svd_spans_the_leading_directions(spark):
    rng = np.random.default_rng(1)
    a = rng.standard_normal((60, 8)) @ rng.standard_normal((8, 300))
    a[:, rng.random(300) < .5] = 0
    rows = spark.createDataFrame([(np.flatnonzero(r).tolist(), r[r != 0].tolist()) for r in a],
                                 "t array<int>, w array<double>").repartition(4)
    q = D.randomised_svd(rows, 300, rank=8)
    assert q.shape == (300, 8)
    assert np.allclose(a @ q @ q.T, a, atol=1e-6)


def test_edge_cases(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    bench = spark.createDataFrame([(1, item), (1, item), (2, item), (3, None), (4, ""), (5, "..."),
                                   (None, "one two three four five six seven eight nine ten"),
                                   (6, "short exact words")], "item_id long, text string")
    long_text = " ".join(f"w{i}" for i in range(200_000))
    docs = spark.createDataFrame(
        [(1, None, 0.0), (2, "", 0.0), (3, item, 0.0), (3, item, 0.0), (None, "x " + item, 0.0),
         (4, long_text + " " + item.upper(), 0.0), (5, "so: short, exact words here", 0.0),
         (6, "short words exact", 0.0),
         (7, "One two three four five six seven eight nine ten", 0.0)],
        "doc_id long, text string, lcs double")
    got = {(r.doc_id, r.item_id) for r in D.find_contamination(docs, bench).collect()}
    assert got == {(3, 1), (3, 2), (None, 1), (None, 2), (4, 1), (4, 2), (5, 6), (7, None)}
    kept = D.drop_contaminated(docs, bench)
    assert kept.schema == docs.schema
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 6]
    empty = spark.createDataFrame([], bench.schema)
    assert D.find_contamination(docs, empty).count() == 0
    assert D.drop_contaminated(docs, empty).count() == docs.count()
    assert D.find_contamination(docs.where("doc_id > 99"), bench).count() == 0


def test_several_blocks_and_long_items(spark, monkeypatch):
    rng = random.Random(2)
    make = lambda n: " ".join("v%d" % rng.randrange(4000) for _ in range(n))
    items = [(i, make(40)) for i in range(30)] + [(100, make(900))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame([(i, make(100) + " " + t + " " + make(50)) for i, t in items]
                                 + [(500 + i, make(200)) for i in range(30)],
                                 "doc_id long, text string")
    monkeypatch.setattr(D, "BLOCK_WORDS", 700)
    got = {(r.doc_id, r.item_id) for r in D.find_contamination(docs, bench).collect()}
    assert got == {(i, i) for i, _ in items}


def word_copies(docs, bench):
    """(doc_id, item_id) of every passage that occurs word for word."""
    parts = []
    for r in bench.collect():
        words = D.words_of(r.text)
        n = -(-len(words) // D.ITEM_WORDS)
        parts += [(r.item_id, b" %s " % b" ".join(words[len(words) * i // n:len(words) * (i + 1) // n]))
                  for i in range(n)]
    joined = [(r.doc_id, b" %s " % b" ".join(D.words_of(r.text))) for r in docs.collect()]
    return {(d, item) for d, text in joined for item, p in parts if p in text}


def test_every_copy_is_found_where_passages_outnumber_the_first_rank(spark):
    sf = "/root/testdata/sf0.1"
    docs, bench = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    assert bench.count() > D.RANK
    copies = word_copies(docs, bench)
    assert len(copies) > 200
    assert copies <= {(r.doc_id, r.item_id) for r in D.op10_decontaminate(spark, sf).collect()}


def test_every_passage_keeps_its_share_and_blocks_hold_few_passages(spark, monkeypatch):
    items = [(i, " ".join(f"w{i}x{j}" for j in range(8 + i % 50))) for i in range(300)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame([(1, "nothing here")], "doc_id long, text string")
    block, = [b.value for b in D.prepared_blocks(docs, bench)]
    assert block.captured.min() >= D.CAPTURED and len(block.items) == 300
    monkeypatch.setattr(D, "BLOCK_PASSAGES", 100)
    blocks = [b.value for b in D.prepared_blocks(docs, bench)]
    assert len(blocks) == 3 and sum(len(b.items) for b in blocks) == 300


@pytest.mark.parametrize("n_docs", [9_000, 900_000, 10 ** 10])
def test_words_around_a_copy_do_not_hide_it(monkeypatch, n_docs):
    """The projection alone finds short copies between words outside the
    vocabulary, however many documents there are."""
    rng = random.Random(5)
    words = [b"w%d" % i for i in range(3000)]
    zipf = [1 / (i + 1) for i in range(3000)]
    items = [rng.choices(words, zipf, k=rng.randint(15, 46)) for _ in range(100)]
    block = D.Passages(list(range(100)), items)
    share = np.array([1 / (int(w[1:]) + 1) for w in sorted(block.vocab, key=block.vocab.get)])
    block.weigh((share * n_docs).astype(int), n_docs)
    rows = np.zeros((100, len(block.vocab)))
    for row, (t, w) in zip(rows, block.rows()):
        row[t] = w
    block.settle(np.linalg.svd(rows, full_matrices=False)[2].T)
    monkeypatch.setattr(D.Passages, "copies", lambda self, ids: set(), raising=False)
    for k, item in enumerate(items):
        for at in range(0, 32, 3):
            text = [b"f%d" % i for i in range(at)] + item + [b"g%d" % i for i in range(90)]
            found = block.candidates(b" ".join(text).decode())[1]
            assert k in {j for j, *_ in found}, (k, at)


def counted(spark, docs):
    """``docs`` through a step that counts the rows read."""
    rows = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            rows.add(len(b))
            yield b

    return docs.mapInArrow(run, docs.schema), rows


def test_documents_are_read_as_often_for_many_blocks_as_for_one(spark, monkeypatch):
    rng = random.Random(6)
    make = lambda n: " ".join("v%d" % rng.randrange(3000) for _ in range(n))
    items = [(i, make(rng.randint(4, 120))) for i in range(60)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame(
        [(i, make(60) + " " + t + " " + make(20)) for i, t in items]
        + [(100 + i, " ".join(w for j, w in enumerate(t.split()) if j % 7)) for i, t in items]
        + [(500 + i, make(200)) for i in range(30)] + [(600, None), (601, "")],
        "doc_id long, text string")
    found, reads = [], []
    for passages in (1024, 16):
        monkeypatch.setattr(D, "BLOCK_PASSAGES", passages)
        source, rows = counted(spark, docs)
        assert (len(list(D._blocks(bench, "item_id", "text"))) > 3) == (passages == 16)
        found.append({(r.doc_id, r.item_id) for r in D.find_contamination(source, bench).collect()})
        reads.append(rows.value)
        source, rows = counted(spark, docs)
        kept = {r.doc_id for r in D.drop_contaminated(source, bench).collect()}
        assert kept == {r.doc_id for r in docs.collect()} - {d for d, _ in found[-1]}
        assert rows.value == reads[-1]
    assert reads == [2 * docs.count()] * 2
    assert {(i, i) for i, _ in items} <= found[0] and {(i, i) for i, _ in items} <= found[1]
    assert found[0] == found[1]


def test_items_too_short_to_tell_match_nothing(spark):
    bench = spark.createDataFrame(
        [(1, "The"), (2, "of the"), (3, "one two three"), (4, "…"), (5, None), (6, "?"),
         (7, "気" * 30), (8, "気" * 9), (None, "in")], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, "The end of the road"), (2, "one two three"), (3, "so: " + "気" * 30), (4, "気" * 9),
         (5, "in the end")], "doc_id long, text string")
    assert {(r.doc_id, r.item_id) for r in D.find_contamination(docs, bench).collect()} \
        == {(2, 3), (3, 7)}
    assert sorted(r.doc_id for r in D.drop_contaminated(docs, bench).collect()) == [1, 4, 5]
    short = {(r.item_id, r.text) for r in D.too_short(bench).collect()}
    assert {i for i, _ in short} == {1, 2, 4, 8, None}


def test_chunks_hold_all_batches_and_little_text(monkeypatch):
    monkeypatch.setattr(D, "CHUNK_BYTES", 1000)
    batches = [pa.RecordBatch.from_arrays([pa.array(["x" * n, None, ""])], ["text"])
               for n in (10, 400, 5000, 300, 300, 300, 300, 1)]
    held = list(D._chunks(iter(batches)))
    assert [b for h in held for b in h] == batches and len(held) == 3
    assert list(D._chunks(iter([]))) == []
