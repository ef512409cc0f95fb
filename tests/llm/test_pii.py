import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ravel.llm import pii as P


def digits(s):
    return re.sub(r"[^0-9]", "", s)


def luhn(s):
    d = [int(c) for c in s][::-1]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


PLAIN = {      # the patterns as the contract words them
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 12 <= len(digits(s)) <= 19 and luhn(digits(s))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15)}


def plain(text):
    out = [(m.start(), i, k, m.end()) for i, (k, (p, ok)) in enumerate(PLAIN.items())
           for m in re.finditer(p, text or "") if ok(m.group())]
    return [(k, a, b) for a, _, k, b in sorted(out)]


def base(text):
    return [s[:3] for s in P.find_spans(text) if s[0] in P.BASE]


PARTS = ["a", "b.c", "@", "@x.y", "1", "12", "255", "256", ".", "..", "-", " ", "  ", "+", "+1", "(",
         ")", "4111111111111111", "4111 1111-1111 1111", "192.168.0.1", "é", "_", "%", "٣",
         "user@mail.example.com", "+49 (30) 123-4567", "000", "\n", "DE89370400440532013000"]


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=25).map("".join))
def test_base_spans_equal_plain_patterns(text):
    assert base(text) == plain(text)


def test_query_equals_brute_force_on_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in P.op3_pii(spark, sf).collect()}
    assert len(got) == len(docs)
    total = 0
    for d in docs:
        want, r = plain(d.text), got[d.doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == \
            [sum(k == x for x, _, _ in want) for k in P.BASE]
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        spans = [s for s in r.spans.split(",") if s]
        assert [s for s in spans if s.split(":")[0] in P.BASE] == \
            [s for s in joined.split(",") if s]
        starts = [int(s.split(":")[1]) for s in spans]
        assert starts == sorted(starts)
        total += len(want)
    assert total > 20


@pytest.mark.parametrize("text, kinds", [
    ("iban DE89 3704 0044 0532 0130 00 ok", ["iban"]), ("DE88370400440532013000", []),
    ("my ssn is 123-45-6789", ["ssn"]), ("123-45-6789", []), ("order part 123-45-6789 ssn", []),
    ("xDE89370400440532013000", []), ("GB82WEST12345698765432", ["iban"])])
def test_added_kinds(text, kinds):
    assert [s[0] for s in P.find_spans(text) if s[0] not in P.BASE] == kinds


def test_context_moves_the_score():
    plain_, near = P.find_spans("1.2.3.4")[0], P.find_spans("server ip 1.2.3.4")[0]
    against = P.find_spans("version 1.2.3.4")[0]
    assert against[3] < plain_[3] < near[3] and against[0] == "ip"


def test_long_runs_are_linear():
    for text in ("1" * 300_000, "1." * 200_000, "1 " * 200_000, "a" * 300_000 + "@",
                 "a@" * 200_000, "+1" + "(" * 300_000, "AB12" * 80_000):
        P.find_spans(text)


def test_rows_and_redaction(spark):
    rows = [(1, None, "x"), (2, "", "y"), (3, "mail a.b@c.de now", None), (3, "mail a.b@c.de now", None),
            (None, "é +49 30 123456 é", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = sorted(((r.doc_id, [s.text for s in r.spans]) for r in P.find_pii(docs).collect()), key=str)
    assert got == [(1, []), (2, []), (3, ["a.b@c.de"]), (3, ["a.b@c.de"]), (None, ["+49 30 123456"])]
    clean = sorted((tuple(r) for r in P.redact(docs).collect()), key=str)
    assert clean[2] == (3, "mail <email> now", None) and clean[0] == (1, None, "x")
    assert clean[-1] == (None, "é <phone> é", None)
    assert P.find_pii(docs.where("doc_id > 9")).count() == 0
