"""Write PLANS.md: physical plans of the headline queries (explain output)."""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ravel.plans.registry import QUERIES  # noqa: E402
from ravel.session import build_session  # noqa: E402

NOTES = {
    "word_totals": "one narrow stage (split/explode/pairs, no shuffle) reading only `text`; "
                   "one partial+final aggregation on the word.",
    "phone_pairs": "per-record regex in a Generate; scans read only (url, html) and (doc_id, text).",
    "cast_parse": "title rules as two regex extractions; the title filter is evaluated in the join.",
    "adjacency_sizes": "cast sizes by a partial aggregation joined back to the edges; no pair is "
                       "emitted. The edges are pinned once.",
    "trending_rows": "pane hash aggregation over raw rows, window expansion of the partials, "
                     "tag counts from the same (reused) shuffle, join on (window, tag) for "
                     "tagged posts only.",
    "trending_top": "block / sub-level / level rank limits each applied Partial before its "
                    "exchange, then lag/running-sum runs per window.",
}


def scan_line(ln: str) -> str:
    """A FileScan line reduced to its columns, pushed filters and schema."""
    head = ln[:ln.index("FileScan")] + "FileScan " + ln.split("FileScan ", 1)[1].split(" Batched")[0]
    parts = [head]
    for key in ("PushedFilters: ", "ReadSchema: "):
        if key in ln:
            parts.append(key + ln.split(key, 1)[1].split(", ReadSchema")[0][:120])
    return ", ".join(parts)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    out = ["# Physical plans of the headline queries", "",
           f"`python tools/plans.py {sf}` (AQE initial plans; long lines cut).", ""]
    for name, note in NOTES.items():
        buf = io.StringIO()
        with redirect_stdout(buf):
            QUERIES[name](spark, sf).explain()
        text = re.sub(r"#\d+L?", "", buf.getvalue())
        lines = [scan_line(ln) if "FileScan" in ln else ln[:170]
                 for ln in text.splitlines() if ln.strip()]
        out += [f"## {name}", "", note, "", "```", *lines, "```", ""]
    spark.stop()
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                           "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
