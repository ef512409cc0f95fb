import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from ravel.llm import lines

SPACE = " \t\n\x0b\x0c\r"


def slow(rows):
    """rows of (doc_id, text) -> sorted (doc_id, kept text, lines, dropped)."""
    def key(line):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACE))

    held, split = {}, [(d, (t or "").split("\n")) for d, t in rows]
    for d, ls in split:
        for k in {key(x) for x in ls}:
            if len(k) >= 20:
                held.setdefault(k, []).append(d)
    out = []
    for d, ls in split:
        kept = []
        for x in ls:
            ids = held.get(key(x), [])
            named = [i for i in ids if i is not None]
            if len(ids) < 3 or not named or d == max(named):
                kept.append(x)
        out.append((d, "\n".join(kept), len(ls), len(ls) - len(kept)))
    return sorted(out, key=str)


def run(spark, rows, **kw):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = lines.dedup_lines(docs, **kw).select(
        "doc.doc_id", F.coalesce("doc.text", F.lit("")), "n_lines", "n_dropped").collect()
    return sorted((tuple(r) for r in got), key=str)


A, B = "a line that is long enough", "Ünother LINE, also long enough"
ROWS = [(1, f"{A}\nx\n{B}"), (2, f"  {A.upper()}\t\n{A}\ny"), (3, f"{B}\n{A}\n\n"), (4, None),
        (5, ""), (6, f"{B}\r\n{B}"), (6, f"{B}\r\n{B}"), (None, f"{A}\nkeep"), (7, "x\nx"),
        (8, "Ü" + "z" * 18), (9, "Ü" + "z" * 18), (10, "Ü" + "z" * 18),
        (11, "\x85" + "q" * 18), (12, "\x85" + "q" * 19), (13, "\x85" + "q" * 19),
        (14, "\x85" + "Q" * 19 + "\x0c"), (15, A.replace("a", "A"))]


@pytest.mark.parametrize("batches", [1, 3, 5])
def test_small_tables(spark, batches):
    assert run(spark, ROWS, batches=batches) == slow(ROWS)


def test_null_ids_only_and_empty(spark):
    rows = [(None, A)] * 3 + [(None, None)]
    assert run(spark, rows) == slow(rows)
    assert run(spark, []) == []


def test_very_long_text_and_hot_line(spark):
    rows = [(i, "\n".join([A, f"own line number {i} of this text"] * 3)) for i in range(300)]
    rows.append((1000, "\n".join(f"{j % 700} {A}" for j in range(60_000))))
    rows += [(1001 + i, "\n".join(f"{j} {A}" for j in range(0, 700, 2))) for i in range(2)]
    assert run(spark, rows) == slow(rows)


def test_extra_columns_pass_through(spark):
    docs = spark.createDataFrame([(1, A, 5, "p", True), (2, A, 6, "q", None), (3, A, 7, "r", None)],
                                 "doc_id long, text string, h1 int, drops string, first boolean")
    got = sorted(tuple(r) for r in lines.drop_repeated_lines(docs).collect())
    assert got == [(1, "", 5, "p", True), (2, "", 6, "q", None), (3, A, 7, "r", None)]


def test_runs_compact_and_leave_no_tables(spark):
    runs = lines.LineRuns(spark, fanout=2)
    for i in range(5):
        runs.add(spark.range(3).selectExpr("id as h1", "id + 1 as h2", f"{10 - i} as id"))
    assert [len(x) for x in runs.levels] == [1, 0, 1]
    assert sorted(tuple(r) for r in runs.merged().collect()) == [
        (i, i + 1, 5, 10) for i in range(3)]
    runs.close()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("ravel_run")]


def test_plan_has_no_python(spark):
    plan = lines.op2_line_dedup(spark, "/root/testdata/sf0.001") \
        ._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"create view documents as from '{sf}/documents.parquet'")
    want = sorted(con.sql(lines.ORACLE["op2_line_dedup"]).fetchall())
    got = lines.op2_line_dedup(spark, sf)
    assert got.columns == ["doc_id", "n_lines", "n_dropped", "kept_sha256"]
    assert sorted(tuple(r) for r in got.collect()) == want
    text = spark.read.parquet(f"{sf}/documents.parquet").first()
    same = [w for w in want if w[0] == text.doc_id][0]
    if same[2] == 0:
        assert same[3] == hashlib.sha256((text.text or "").encode()).hexdigest()


def test_nothing_is_left_behind(spark, monkeypatch):
    """Scratch tables and folders go, after a success and after a failure in
    any write."""
    import os

    from ravel.llm import lines as L
    from ravel.session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(spark).removeprefix("file:")
    left = lambda: ({t.name for t in spark.catalog.listTables() if t.name.startswith("ravel_run")},
                    {f for f in os.listdir(base) if f.startswith("ravel-")})
    docs = spark.createDataFrame([(i, "a line that is long enough\nown %d" % i) for i in range(9)],
                                 "doc_id long, text string")
    before = left()
    assert L.drop_repeated_lines(docs).count() == 9
    assert left() == before
    push = L.LineRuns._push
    for n in (1, 2, 4):
        calls = [n]

        def broken(self, at, run):
            calls[0] -= 1
            if not calls[0]:
                self._write(run)
                raise RuntimeError("lost")
            push(self, at, run)

        monkeypatch.setattr(L.LineRuns, "_push", broken)
        with pytest.raises(RuntimeError, match="lost"):
            L.drop_repeated_lines(docs).count()
        assert left() == before
