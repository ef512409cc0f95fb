import subprocess
import sys

import __spark_entry__ as entry
import corpus_pipeline
from ravel.llm.registry import ORACLE, QUERIES


def test_one_query_for_each_operator():
    numbers = sorted(int(q[2:].split("_")[0]) for q in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert entry.queries()["pipeline"] is corpus_pipeline.run


def test_modules_import_without_a_session():
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True,
                         cwd=entry._HERE, timeout=120)
    assert out.returncode == 0, out.stderr
