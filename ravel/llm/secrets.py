"""Secret scan: candidate strings, then a random forest removes the false
ones (DataFrame, SQL and Spark ML only).

A candidate is a run of 16 to 256 letters, digits, ``+/_-`` that holds a
digit, such a run of any length, with or without digits, that begins with a
known prefix or follows a word such as ``key`` or ``bearer``, a run of at least
6 visible characters assigned to a name such as ``password`` or ``token``, or
the first line of a private key. Features are its length, its character
classes and the transitions between them, its entropy, the share of it covered
by dictionary words, known prefixes, the path it was found under, and the
words next to it. The forest is trained on labelled findings; a finding is
kept where the forest's probability is at least ``THRESHOLD``.

The tables hold no labelled findings, so by default Spark derives a bounded
set of ``EXAMPLES``: key formats and assigned random values as secrets; card
numbers, identifiers, checksums, slugs, dates and placeholders as false
positives. Own labelled findings can be passed instead.

Scale: texts are only mapped over (two linear passes of one pattern); what is
shuffled are findings. What depends on the value alone is computed once for
each distinct value, and joined back by a join whose hot side Spark may
split, so a secret pasted into a third of all documents costs one row. The
dictionary (at most ``DICTIONARY`` words of at most 8 letters) and the forest
are all that is broadcast.

Edge cases: a null or empty text has no findings. Offsets count code points.
Every occurrence is a finding; rows that repeat an id have their own. A null
path or id is kept as null. An assigned value or a run may be of any length and
is one finding, whose features the forest judges. Extra columns are ignored.
"""

from __future__ import annotations

import json

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ravel.llm.common import pinned, read
from ravel.session import remove_path, scratch_path

THRESHOLD = 0.5
EXAMPLES = 8_000
DICTIONARY = 30_000
TREES = 24
DEPTH = 7
NEAR = 40
FIT_PARTITIONS = 16
PIECE = 256            # characters of a value looked up in one row
_RUN = r"[A-Za-z0-9+/_\-]"
_NAMES = r"(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|credential)"
# Public prefixes of keys and tokens.
_PREFIXES = "AKIA|ASIA|ghp_|gho_|ghs_|github_pat_|glpat-|xox[abp]-|sk_live_|sk_test_|AIza"
_KNOWN = rf"^({_PREFIXES}|-----BEGIN )"
_SECRET_WORDS = r"password|passwd|pwd|secret|token|key|credential|auth|bearer|private"
CANDIDATE = (
    # the short look-behinds only spare the long one where it cannot match; a
    # value of over 256 characters comes first, so that no part of it is taken
    r"(?<=[=: \"'])(?<=[=:][ ]{0,2}[\"']{0,1})(?=[^\s\"']{257})"
    rf"(?i:(?<={_NAMES}[\"']{{0,1}}[ ]{{0,2}}[=:][ ]{{0,2}}[\"']{{0,1}}))[^\s\"']{{257,}}+"
    rf"|(?<!{_RUN})(?=[A-Za-z+/_\-]*+[0-9]){_RUN}{{16,}}+={{0,2}}"
    r"|(?<=[=: \"'])(?<=[=:][ ]{0,2}[\"']{0,1})"
    rf"(?i)(?<={_NAMES}[\"']{{0,1}}[ ]{{0,2}}[=:][ ]{{0,2}}[\"']{{0,1}})[^\s\"']{{6,256}}+(?![^\s\"'])"
    rf"|(?-i:(?<!{_RUN})(?={_PREFIXES}){_RUN}{{16,}}+={{0,2}})"
    rf"|(?<=[=:> \"'])(?={_RUN}{{16}})(?<=(?:{_SECRET_WORDS})[\"']{{0,1}}[ ]{{0,2}}[=:>]{{0,2}}[ ]{{0,2}}[\"']{{0,1}})"
    rf"{_RUN}{{16,}}+={{0,2}}"
    r"|-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----")
_PLAIN_WORDS = r"commit|sha|md5|checksum|etag|uuid|guid|id|version|release|number|order|card|date"
_PLACEHOLDERS = r"example|sample|dummy|placeholder|your|xxxx|changeme|0000|1234567"
FEATURES = ["length", "digits", "uppers", "lowers", "others", "runs", "transitions", "hex",
            "entropy", "dictionary", "known", "placeholder", "dashed", "assigned", "quoted",
            "secret_word", "plain_word", "path_test", "path_config", "path_depth"]


def findings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             path_col: str | None = "source") -> DataFrame:
    """(doc_id, path, start, value, before, after) of every candidate."""
    path = F.col(path_col).cast("string") if path_col in docs.columns else F.lit(None).cast("string")
    rows = docs.select(F.monotonically_increasing_id().alias("row"),
                       F.col(id_col).cast("long").alias("doc_id"), path.alias("path"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.where(F.col("text").rlike(CANDIDATE))
    values = F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0))
    rows = rows.select("row", "doc_id", "path", values.alias("values"),
                       F.split("text", CANDIDATE, -1).alias("gaps"))
    each = F.transform("values", lambda v, i: F.struct(
        i.alias("i"), v.alias("value"), F.char_length(F.get("gaps", i)).alias("skip"),
        F.right(F.get("gaps", i), F.lit(NEAR)).alias("before"),
        F.left(F.get("gaps", i + 1), F.lit(NEAR)).alias("after")))
    rows = rows.select("row", "doc_id", "path", F.inline(each))
    up_to = Window.partitionBy("row").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("skip") + F.char_length("value")).over(up_to)
    return rows.select("doc_id", "path", (end - F.char_length("value")).cast("long").alias("start"),
                       "value", "before", "after")


def dictionary_words(spark: SparkSession, path: str | None = None) -> DataFrame:
    """(word): lower-case words of 4 to 8 letters from a vocabulary file."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    words = {w.lstrip("Ġ").lower() for w in vocab if w.startswith("Ġ")}
    words = sorted(w for w in words if 4 <= len(w) <= 8 and w.isascii() and w.isalpha())
    return spark.createDataFrame([(w,) for w in words[:DICTIONARY]], "word string")


def _share(value: Column, of: str) -> Column:
    return F.char_length(F.regexp_replace(value, of, "")) / F.char_length(value)


def value_features(values: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Features of the distinct ``value``s: one row each."""
    v = F.col("value")
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(
        v, "[A-Z]", "A"), "[a-z]", "a"), "[0-9]", "0")
    chars = F.split(v, "")
    n = F.char_length(v)
    entropy = F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda s, c: s - F.when(
        c == "", 0.0).otherwise(
            (n - F.char_length(F.replace(v, c, F.lit("")))) / n
            * F.log2((n - F.char_length(F.replace(v, c, F.lit("")))) / n)))
    # long values: runs of the sorted characters, one step each
    term = lambda k: F.when(k == 0, 0.0).otherwise(-k / n * F.log2(k / n))
    state = lambda c, k, e: F.struct(c.alias("c"), k.alias("k"), e.alias("e"))
    by_runs = F.aggregate(
        F.array_sort(F.filter(chars, lambda c: c != "")),
        state(F.lit(""), F.lit(0), F.lit(0.0)),
        lambda s, c: state(c, F.when(s["c"] == c, s["k"] + 1).otherwise(F.lit(1)),
                           F.when(s["c"] == c, s["e"]).otherwise(s["e"] + term(s["k"]))),
        lambda s: s["e"] + term(s["k"]))
    entropy = F.when(n <= PIECE, entropy).otherwise(by_runs)
    plain = values.select("value").distinct().select(
        "value", n.cast("double").alias("length"), _share(v, "[^0-9]").alias("digits"),
        _share(v, "[^A-Z]").alias("uppers"), _share(v, "[^a-z]").alias("lowers"),
        _share(v, "[A-Za-z0-9]").alias("others"),
        F.char_length(F.regexp_replace(classes, r"(.)\1+", "$1")).cast("double").alias("runs"),
        v.rlike("^[0-9a-f]+$|^[0-9A-F]+$").cast("double").alias("hex"),
        entropy.alias("entropy"), v.rlike(_KNOWN).cast("double").alias("known"),
        F.lower(v).rlike(_PLACEHOLDERS).cast("double").alias("placeholder"),
        # words joined by single signs: told without a repeated group, whose
        # recursion a long value would not survive
        (v.rlike("^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-|^[0-9]+[-/][0-9]")
         | (v.rlike("^[a-z]+[-_/][a-z0-9]") & v.rlike("^[a-z0-9_/-]+$") & ~v.rlike("[-_/]([-_/]|$)")))
        .cast("double").alias("dashed"))
    plain = plain.withColumn("transitions", (F.col("runs") - 1) / F.greatest(F.col("length") - 1, F.lit(1)))
    # positions covered by dictionary words of 4 to 8 letters; values are cut
    # into overlapping pieces, so that a row stays short however long they are
    pieces = values.select("value").distinct().select(
        F.sha2("value", 256).alias("id"), F.explode(F.transform(
            F.sequence(F.lit(0), F.char_length("value") - 1, F.lit(PIECE)), lambda at: F.struct(
                at.alias("at"), F.substr("value", at + 1, F.lit(PIECE + 7)).alias("piece")))).alias("x"))
    pieces = pieces.select("id", "x.at", "x.piece")
    parts = F.flatten(F.transform(
        F.sequence(F.lit(1), F.least(F.char_length("piece"), F.lit(PIECE))), lambda p: F.transform(
            F.sequence(F.lit(4), F.lit(8)), lambda k: F.struct(
                (F.col("at") + p).alias("p"), k.alias("k"), F.lower(F.substr("piece", p, k)).alias("word")))))
    covered = (pieces.select("id", F.inline(parts))
               .where(F.char_length("word") == F.col("k"))
               .join(F.broadcast(dictionary), "word")
               .select("id", F.explode(F.sequence(F.col("p"), F.col("p") + F.col("k") - 1)).alias("p"))
               .distinct().groupBy("id").agg(F.count(F.lit(1)).alias("covered")))
    plain = plain.withColumn("id", F.sha2("value", 256))
    return (plain.join(covered, "id", "left")
            .withColumn("dictionary", F.coalesce(F.col("covered") / F.col("length"), F.lit(0.0)))
            .drop("covered", "id"))


def with_features(rows: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``rows`` of findings with the columns of ``FEATURES``."""
    before, after = F.lower(F.coalesce("before", F.lit(""))), F.lower(F.coalesce("after", F.lit("")))
    path = F.lower(F.coalesce("path", F.lit("")))
    near = F.regexp_extract(before, r"(\S*\s*\S*\s*\S*)$", 1)
    flag = lambda c: c.cast("double")
    rows = rows.select(
        "*", flag(before.rlike(r"[=:]\s*[\"']?$")).alias("assigned"),
        flag(before.rlike(r"[\"']$") & after.rlike(r"^[\"']")).alias("quoted"),
        flag(near.rlike(_SECRET_WORDS)).alias("secret_word"),
        flag(near.rlike(rf"(^|[^a-z])({_PLAIN_WORDS})([^a-z]|$)")).alias("plain_word"),
        flag(path.rlike("test|example|sample|fixture|doc")).alias("path_test"),
        flag(path.rlike(r"\.(env|ini|cfg|conf|ya?ml|properties|toml)$")).alias("path_config"),
        F.regexp_count(path, F.lit("/")).cast("double").alias("path_depth"))
    return rows.join(value_features(rows, dictionary), "value")


def example_findings(spark: SparkSession, n: int = EXAMPLES, seed: int = 1) -> DataFrame:
    """Labelled findings derived from hashes: (value, before, after, path,
    label)."""
    rows = spark.range(n).select(
        "id", F.sha2(F.concat_ws(":", F.lit(seed), "id"), 256).alias("h"),
        F.sha2(F.concat_ws(":", F.lit(seed), F.lit("x"), "id"), 256).alias("g"))
    h, g = F.col("h"), F.col("g")
    pick = lambda col, at, *words: F.element_at(
        F.array(*[F.lit(w) for w in words]),
        (F.pmod(F.xxhash64(col, F.lit(at)), F.lit(len(words))) + 1).cast("int"))
    word = pick(g, 1, "the", "of", "and", "light", "under", "is", "river", "we", "them", "on")
    other = pick(g, 2, "stone", "a", "by", "value", "was", "from", "house", "see", "it", "to")
    digits = F.translate(h, "abcdef", "038164")
    base64 = F.base64(F.unhex(h))
    alnum = F.regexp_replace(F.concat(base64, F.base64(F.unhex(g))), r"[+/=]", "")
    name = pick(g, 3, "password", "secret", "token", "api_key", "passwd", "client_secret", "auth_token")
    assign = pick(g, 4, "=", " = ", ": ", ":")
    quote = pick(g, 5, "", "\"", "'")
    prose = F.concat(word, F.lit(" "), other, F.lit(" "))
    random_value = F.element_at(F.array(
        F.substr(h, F.lit(1), F.lit(18)), F.substr(h, F.lit(1), F.lit(40)), h,
        F.substr(alnum, F.lit(1), F.lit(24)), F.substr(base64, F.lit(1), F.lit(43)),
        F.substr(alnum, F.lit(1), F.lit(12))), (F.pmod(F.xxhash64(g, F.lit(6)), F.lit(6)) + 1).cast("int"))
    key = F.concat(F.lit("AKIA"), F.upper(F.translate(F.substr(h, F.lit(1), F.lit(16)), "0189bd", "WXYZQK")))
    known = F.concat(pick(g, 7, "ghp_", "sk_live_", "AIza", "xoxb-", "glpat-"),
                     F.substr(alnum, F.lit(1), F.lit(36)))
    sum_word = pick(g, 8, "commit ", "sha1 ", "checksum: ", "etag ", "md5=")
    uid = F.concat_ws("-", *[F.substr(h, F.lit(a), F.lit(b)) for a, b in
                             ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    slug = F.concat_ws("-", pick(h, 1, "release", "chapter", "update", "report"),
                       pick(h, 2, "winter", "public", "annual", "market"),
                       pick(h, 3, "notes", "summary", "table", "figures"), F.substr(digits, F.lit(1), F.lit(4)))
    date = F.concat(F.lit("20"), F.substr(digits, F.lit(1), F.lit(2)), F.lit("-0"),
                    F.substr(digits, F.lit(4), F.lit(1)), F.lit("-1"), F.substr(digits, F.lit(6), F.lit(1)),
                    F.lit("T10-20-3"), F.substr(digits, F.lit(8), F.lit(1)))
    holder = pick(h, 4, "xxxxxxxxxxxxxxxxx1", "your_api_key_1234", "example-password-1",
                  "changeme00000000", "EXAMPLE0000000000000", "0000000000000000")
    plain_run = F.concat(pick(h, 5, "section", "window", "garden"), pick(h, 6, "number", "letter", "market"),
                         pick(h, 7, "station", "people", "system"), F.substr(digits, F.lit(1), F.lit(2)))
    sums = F.when(F.pmod(F.xxhash64(g, F.lit(9)), F.lit(2)) == 0, F.substr(h, F.lit(1), F.lit(40))) \
        .otherwise(F.substr(h, F.lit(1), F.lit(32)))
    kinds = [(1, key, prose, ""), (1, random_value, F.concat(prose, name, assign, quote), quote),
             (1, known, F.concat(prose, quote), quote), (1, key, F.concat(prose, F.lit("key=")), ""),
             (1, random_value, F.concat(prose, name, assign, quote), quote),
             (0, F.substr(digits, F.lit(1), F.lit(16)), prose, ""),
             (0, uid, F.concat(prose, pick(g, 10, "id ", "", "uuid: ")), ""),
             (0, sums, F.concat(prose, sum_word), ""), (0, slug, prose, ""), (0, date, prose, ""),
             (0, holder, F.concat(prose, name, assign, quote), quote), (0, plain_run, prose, ""),
             (0, F.concat(F.substr(digits, F.lit(1), F.lit(8)), F.lit("-"), F.substr(digits, F.lit(9), F.lit(10))),
              F.concat(prose, F.lit("number ")), "")]
    sides = F.array(*[F.struct(F.lit(y).alias("label"), v.alias("value"), b.alias("before"),
                               (F.concat(a, F.lit(" "), other) if not isinstance(a, str) else F.concat(
                                   F.lit(a + " "), other)).alias("after")) for y, v, b, a in kinds])
    one = F.element_at(sides, (F.pmod("id", F.lit(len(kinds))) + 1).cast("int"))
    path = pick(g, 11, "src/app.py", "conf/prod.env", "src0", "docs/readme.md", "tests/data.py", "src7", None)
    return rows.select(one.alias("x"), path.alias("path")).select("x.*", "path")


def train(labelled: DataFrame, dictionary: DataFrame) -> RandomForestClassificationModel:
    """Fit the forest on (value, before, after, path, label 0/1). The model is
    stored and read back: as fitted it keeps a summary that holds the session,
    which cannot be sent to tasks once the session has observed metrics."""
    spark = labelled.sparkSession
    rows = with_features(labelled, dictionary).select(
        F.col("label").cast("double").alias("label"), *FEATURES)
    # bagging follows the rows of each partition: a fixed number of partitions
    # by content, each in order, gives the same forest on any cluster
    rows = rows.repartition(FIT_PARTITIONS, "label", *FEATURES) \
        .sortWithinPartitions("label", *FEATURES)
    table = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)
    model = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=3).fit(
        pinned(table.select("label", "features")))
    path = scratch_path(spark, "forest")
    model.save(path)
    model = RandomForestClassificationModel.load(path)
    remove_path(spark, path)
    return model


def scan(docs: DataFrame, model: RandomForestClassificationModel | None = None,
         dictionary: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
         path_col: str | None = "source") -> DataFrame:
    """(doc_id, start, length, value, probability, secret) of every finding."""
    spark = docs.sparkSession
    dictionary = dictionary_words(spark) if dictionary is None else dictionary
    if model is None:
        model = train(example_findings(spark), dictionary)
    rows = with_features(pinned(findings(docs, id_col, text_col, path_col)), dictionary)
    scored = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows))
    p = vector_to_array("probability")[1]
    return scored.select("doc_id", "start", F.char_length("value").cast("long").alias("length"),
                         "value", p.alias("probability"), (p >= THRESHOLD).alias("secret"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings in all ``documents``, the false ones marked."""
    out = scan(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "start", "length", F.sha2("value", 256).alias("value_sha256"),
                      "probability", "secret")


QUERIES = {"op7_secrets": op7_secrets}
ORACLE: dict[str, str] = {}
