import hashlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as C
from ravel.llm import decontam, toxicity
from test_lines import slow as slow_lines
from test_simhash import slow_components, slow_fingerprint

SF = "/root/testdata/sf0.01"


def test_every_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    now = {r.doc_id: r.text for r in docs.collect()}
    stages = dict(C.STAGES)
    assert [n for n, _ in C.STAGES] == list(stages)

    model = toxicity.fit(docs, labels)
    now = {d: t for d, t in now.items() if model.at_least(t)[0] < model.cutoff}
    assert 0 < len(now) < docs.count()
    df = check(stages["toxicity"](spark, docs, SF), docs, now)

    now = {d: t for d, t, _, _ in slow_lines(sorted(now.items()))}
    df = check(stages["line dedup"](spark, df, SF), docs, now)
    assert all(r.n_chars == len(r.text or "") for r in df.collect())

    rows = [(d, slow_fingerprint(t)) for d, t in now.items()]
    now = {d: now[d] for (d, _), c in zip(rows, slow_components(rows)) if d == c}
    df = check(stages["simhash near-dedup"](spark, df, SF), docs, now)

    blocks = [b.value for b in decontam.prepared_blocks(df, bench)]
    now = {d: t for d, t in now.items() if not any(b.hits(t) for b in blocks)}
    df = check(stages["benchmark decontamination"](spark, df, SF), docs, now)

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {}
    for d, t in now.items():
        ids = library.encode(t or "", add_special_tokens=False).ids
        raw = np.array(ids, dtype="<u4").tobytes()
        back = library.decode(ids, skip_special_tokens=False)
        want[d] = (len(ids), raw, hashlib.sha256(raw).hexdigest(),
                   hashlib.sha256(back.encode()).hexdigest())
    last = {r.doc_id: (r.n_tokens, bytes(r.ids), r.ids_sha256, r.decoded_sha256)
            for r in stages["bpe"](spark, df, SF).collect()}
    assert last == want
    assert {r.doc_id: (r.n_tokens, bytes(r.ids), r.ids_sha256, r.decoded_sha256)
            for r in C.run(spark, SF).collect()} == want


def check(df, docs, want):
    """Same columns as documents and exactly the wanted texts; pinned."""
    assert df.columns == docs.columns and df.dtypes == docs.dtypes
    df = df.checkpoint()
    got = {r.doc_id: r.text for r in df.collect()}
    assert got == want
    return df


def test_stages_survive_odd_documents(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    odd = spark.createDataFrame([(1, None, None, None, None), (1, None, None, None, None),
                                 (2, "", "en", "s", 0), (None, "some text of no id", None, "s", 5),
                                 (3, "word " * 50_000, "en", None, 7), (4, "plain words here", "", "", 1)],
                                schema)
    for docs, least in ((odd, 3), (odd.where("doc_id > 9"), 0)):
        for _, stage in C.STAGES:
            docs = stage(spark, docs, SF).checkpoint()
        rows = docs.collect()
        assert len(rows) >= least and all(r.n_tokens is not None for r in rows)
