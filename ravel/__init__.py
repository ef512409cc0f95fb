"""ravel: text, event-stream and graph analytics as Spark DataFrame plans.

Every public operator takes DataFrames and returns DataFrames built from
built-in Spark SQL expressions, so Catalyst can prune, push down and
code-generate the whole plan. Sub-packages:

* ``functions``  column expressions (tokens, phone patterns, titles, tags)
* ``sources``    readers (text lines, blank-line records, crawl segments)
                 and bindings of the programs to the given tables
* ``operators``  the programs' relational cores (words, phones, trending,
                 degrees of separation)
* ``sinks``      text reports, parquet output, counters
* ``streaming``  Structured Streaming wrapper of the trending program
* ``plans``      the registry of named queries and their SQL oracles
"""

from ravel.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
