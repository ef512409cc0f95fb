"""Word program: quirks Q1-Q4, randomized equivalence, report bytes."""

import glob
import random
import re

from ravel.operators import words
from ravel.plans.programs import word_job

PUNCT = re.compile(r"[!-,./:-@\[-`{-~]")


def ref_counts(lines):
    """Plain-Python restatement of the word rules (the procedural form)."""
    tot, prevs = {}, {}
    for row in lines:
        for seg in ("# " + row).lower().replace("--", "--# ").split("--"):
            toks = [t for t in seg.split(" ") if t]
            for b, a in zip(toks, toks[1:]):
                if a[0].isalpha():
                    w = PUNCT.sub("", a)
                    p = PUNCT.sub("", b) if b[-1].isalpha() else None
                else:
                    w, p = PUNCT.sub("", a[1:]), None
                tot[w] = tot.get(w, 0) + 1
                if p is not None:
                    prevs[(w, p)] = prevs.get((w, p), 0) + 1
    return tot, prevs


def run(spark, lines):
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    counts = words.word_prev_counts_all(df)
    tot = {r.word: r.n for r in words.word_totals(df).collect()}
    prevs = {(r.word, r.prev): r.n for r in words.word_prev_counts(df, counts=counts).collect()}
    return tot, prevs


def test_quirks(spark):
    tot, prevs = run(spark, ["The 1984 (\"hi dont don't -- x  y\tz", "a -"])
    assert tot["984"] == 1 and tot["hi"] == 1  # Q1: non-letter start loses a char
    assert tot[""] == 1                          # Q1: '-' -> empty word, counted
    assert prevs[("dont", "dont")] == 1          # Q3: don't -> dont before counting
    assert ("the", "#") not in prevs and tot["the"] == 1  # Q4: first word, no prev
    assert tot["x"] == 1 and ("x", "dont") not in prevs   # '--' restarts with the sentinel
    assert tot["y\tz"] == 1                      # tab is not a separator


def test_unicode_punct_kept(spark):
    tot, prevs = run(spark, ["l’été “quoted”"])  # Q2: only ASCII punctuation stripped
    assert tot == {"l’été": 1, "quoted”": 1} and prevs == {}


def test_random_equivalence(spark):
    rnd = random.Random(7)
    alphabet = list("abcé-'.,!?#()\"1 2  ") + ["--", "\t", "“", "ß"]
    lines = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(800)]
    assert run(spark, lines) == ref_counts(lines)


def test_nested_lists_order(spark):
    df = spark.createDataFrame([("x a",), ("y a",), ("y a",), ("b a",), ("z b",)], "line string")
    r = {x.word: (x.n, [(p.prev, p.n) for p in x.prevs]) for x in words.predecessor_lists(df).collect()}
    assert r["a"] == (4, [("y", 2), ("b", 1), ("x", 1)])
    assert r["x"] == (1, [])  # only the sentinel before it: counted, no list


def test_hot_word_lists_are_chunked_in_order(spark):
    rnd = random.Random(4)
    names = [f"p{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(41)]
    lines = [f"{rnd.choice(names)} the" for _ in range(500)] + ["x a", "y a"]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    rows = words.predecessor_lists(df, max_prevs_per_row=7).collect()
    the = sorted([r for r in rows if r.word == "the"], key=lambda r: r.chunk)
    assert len(the) > 1 and all(len(r.prevs) <= 7 for r in the)
    got = [(p.prev, p.n) for r in the for p in r.prevs]
    cnt = {}
    for ln in lines[:500]:
        w = ln.split(" ")[0]
        cnt[w] = cnt.get(w, 0) + 1
    assert got == sorted(cnt.items(), key=lambda kv: (-kv[1], kv[0]))
    assert {r.n for r in the} == {500}
    assert [r.chunk for r in rows if r.word == "a"] == [0]


def test_report_bytes(spark, tmp):
    src = f"{tmp}/in.txt"
    with open(src, "w") as f:
        f.write("x a\ny a\ny a\nb\n")
    word_job(spark, src, f"{tmp}/out")
    data = b"".join(open(p, "rb").read() for p in sorted(glob.glob(f"{tmp}/out/part-*")))
    assert data == b"a:3\r\n\ty:2\r\n\tx:1\r\ny:2\r\nb:1\r\nx:1\r\n"
