"""Queries of the corpus operators and the pipeline, with their SQL."""

from __future__ import annotations

from ravel.llm import (ann, bpe, byte_bpe, decontam, lines, negatives, periodic, pii, secrets, simhash,
                       toxicity, urls, warc)

QUERIES = {}
ORACLE = {}

for _mod in (ann, lines, pii, secrets, toxicity, urls, warc, bpe, simhash, decontam, byte_bpe,
             negatives, periodic):
    QUERIES.update(_mod.QUERIES)
    ORACLE.update(_mod.ORACLE)
