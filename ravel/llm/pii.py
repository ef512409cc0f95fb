"""Personal data: patterns propose spans, checksums confirm them, context
words adjust their score.

Base kinds are email, ip (parts at most 255), card (12 to 19 digits, Luhn) and
phone (9 to 15 digits after a plus); a base span that passes its check stays,
whatever its score. Added kinds are iban (mod 97) and ssn (which has no
checksum and needs a context word); they are reported from ``THRESHOLD`` on
and only where no base span lies. Scores start at the kind's weight, rise with
a context word of the kind nearby and fall with a word that speaks against it.

Scale: rows are scanned where they are read; nothing is shuffled. All scans
are linear in the text: patterns take whole runs and never start over inside.

Edge cases: a null text is empty and has no spans. Offsets count code points,
ends are exclusive. Spans of one kind do not overlap; a failed candidate is
not retried inside. Null ids and repeated rows get a row each. Extra columns
are ignored.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ravel.llm.common import bound_batches, read

BASE = ("email", "ip", "card", "phone")
KINDS = BASE + ("iban", "ssn")
THRESHOLD = 0.5
# Weight of a kind alone; words that support it; words that speak against it.
WEIGHT = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.8, "ssn": 0.3}
FOR = {"email": ("mail", "email", "contact"), "ip": ("ip", "address", "host", "server"),
       "card": ("card", "visa", "credit", "payment"), "phone": ("tel", "phone", "call", "mobile"),
       "iban": ("iban", "account", "bank", "transfer"),
       "ssn": ("ssn", "social", "security", "taxpayer")}
AGAINST = {"email": (), "ip": ("version", "release", "section"), "card": ("order", "tracking"),
           "phone": ("order", "total"), "iban": ("part", "serial"), "ssn": ("order", "part")}
NEAR = 40               # code points looked at on either side
STEP = 0.3
_DIGIT = re.compile(r"[0-9]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_GROUPED = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")
_PLUS = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_WORDS = re.compile(r"[a-z]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def mod97(account: str) -> bool:
    """Country and check digits moved to the end, letters as 10 .. 35."""
    s = account.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def emails(text: str):
    """Leftmost matches, found from their at-signs: the first at-sign with a
    domain after it and a local part before it."""
    floor, at = 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        start = at
        if domain:
            while start > floor and text[start - 1] in _LOCAL:
                start -= 1
        if domain and start < at:
            floor = domain.end()
            yield start, floor
            at = text.find("@", floor)
        else:
            at = text.find("@", at + 1)


def ips(text: str):
    """Groups of four in each maximal run of dotted numbers."""
    for m in _DOTTED.finditer(text):
        if m.group().count(".") < 3:
            continue
        parts = m.group().split(".")
        at = m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in four):
                yield at, end
            at = end + 1


def cards(text: str):
    for m in _GROUPED.finditer(text):
        if m.end() - m.start() < 12:
            continue
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str):
    for m in _PLUS.finditer(text):
        if 9 <= len(_DIGIT.findall(m.group())) <= 15:
            yield m.span()


def ibans(text: str):
    for m in _IBAN.finditer(text):
        before = text[m.start() - 1:m.start()]
        if not (before.isascii() and before.isalnum()) and mod97(m.group()):
            yield m.span()


def ssns(text: str):
    for m in _SSN.finditer(text):
        s = m.group()
        before = text[m.start() - 1:m.start()]
        if before not in {"-", *"0123456789"} and s[:3] not in ("000", "666") and s[0] != "9" \
                and s[4:6] != "00" and s[7:] != "0000":
            yield m.span()


_FINDERS = {"email": emails, "ip": ips, "card": cards, "phone": phones, "iban": ibans, "ssn": ssns}


def score(kind: str, text: str, start: int, end: int) -> float:
    near = set(_WORDS.findall(text[max(0, start - NEAR):start].lower()))
    near |= set(_WORDS.findall(text[end:end + NEAR].lower()))
    s = WEIGHT[kind] + STEP * (not near.isdisjoint(FOR[kind])) \
        - STEP * (not near.isdisjoint(AGAINST[kind]))
    return min(1.0, max(0.0, s))


def find_spans(text: str | None) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score), by start, then kind as listed."""
    text = text or ""
    digits = _DIGIT.search(text) is not None
    out = []
    for kind in KINDS:
        if not digits and kind != "email":
            break
        for start, end in _FINDERS[kind](text):
            s = score(kind, text, start, end)
            if kind in BASE or s >= THRESHOLD and not any(
                    k in BASE and a < end and start < b for k, a, b, _ in out):
                out.append((kind, start, end, s))
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans array<struct<kind, start, end, text, score>>)."""
    bound_batches(docs.sparkSession)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                               ("text", pa.string()), ("score", pa.float64())]))

    def run(batches):
        for b in batches:
            found = [[{"kind": k, "start": a, "end": z, "text": t[a:z], "score": s}
                      for k, a, z, s in find_spans(t)] for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(found, kind)],
                                             ["doc_id", "spans"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(
        run, "doc_id long, spans array<struct<kind:string,start:int,end:int,"
             "text:string,score:double>>")


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; of
    overlapping spans the first one names the replacement."""
    bound_batches(docs.sparkSession)

    def clean(text):
        parts, at = [], 0
        for kind, start, end, _ in find_spans(text):
            if start >= at:
                parts += [text[at:start], f"<{kind}>"]
            at = max(at, end)
        return "".join([*parts, text[at:]]) if parts else text

    def run(batches):
        for b in batches:
            i = b.schema.get_field_index(text_col)
            yield b.set_column(i, b.schema.field(i), pa.array(
                [clean(t) for t in b[text_col].to_pylist()], b.schema.field(i).type))

    return docs.mapInArrow(run, docs.schema)


def _joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of(spans, *kinds):
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over ``documents``."""
    found = find_pii(read(spark, sf_dir, "documents"))
    base = _of("spans", *BASE)
    return found.select(
        "doc_id",
        *[F.size(_of("spans", k)).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"))


QUERIES = {"op3_pii": op3_pii}
ORACLE: dict[str, str] = {}
