import re
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from qualitygate.llm import secret_scan, simhash
from qualitygate.llm.secret_scan import Looks, labelled_examples, redact, secret_findings, train

SMALL = "/root/testdata/sf0.01"
KEY = "4d44c79e8bf7c55759c4958dd60ed83d2ef8cd4e"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")


def test_held_out_findings(spark, docs):
    words = secret_scan.dictionary(docs)
    looks = Looks(words, secret_scan.transitions(docs))
    forest = train(looks, labelled_examples(words), spark)
    rows = [(f["features"], label) for text, start, stop, label in labelled_examples(words, 500, seed=99) for f in looks.found(text) if f["start"] < stop and start < f["stop"]]
    from pyspark.ml.functions import array_to_vector

    got = forest.transform(spark.createDataFrame(rows, "features array<double>, label int").select(array_to_vector("features").alias("features"), "label"))
    assert got.where("prediction = label").count() >= 0.93 * len(rows)


def test_findings_labelled_by_hand(spark, docs):
    """Lines that were written and labelled by hand, not by the rule that makes the training examples."""
    lines = [line.split("\t") for line in (Path(__file__).parent / "findings.txt").read_text().splitlines()]
    rows = [(10**6 + i, text) for i, (_, text, _) in enumerate(lines)]
    found: dict = {}
    for r in secret_findings(docs.limit(300).union(spark.createDataFrame(rows, "doc_id long, text string"))).where("doc_id >= 1000000").collect():
        found.setdefault(r.doc_id - 10**6, []).append(r.secret)
    secret = {i for i, (label, _, _) in enumerate(lines) if label == "1"}
    caught = {i for i in secret if lines[i][2] in found.get(i, [])}
    wrong = {i for i in set(range(len(lines))) - secret if i in found}
    assert len(caught) >= 0.9 * len(secret) and len(wrong) <= 1, ([lines[i] for i in secret - caught], [lines[i] for i in wrong])


def test_every_planted_token_and_nothing_else(docs):
    want = {(r.doc_id, m.start(1), m.end(1)) for r in docs.collect() for m in re.finditer(r'(?i)token = "([0-9a-f]{40})"', r.text or "")}
    assert {(r.doc_id, r.start, r.stop) for r in secret_findings(docs).collect()} == want


def test_redaction_and_edge_rows(spark, docs):
    rows = [(None, f'é token = "{KEY}" and secret = "{KEY[::-1]}" end', "s", 1), (2, None, "s", 1), (2, "", "s", 1), (2, f"commit {KEY}", "s", 1), (3, "plain " * 40_000 + f'token = "{KEY}"', "s", 1)]
    more = spark.createDataFrame(rows, "doc_id long, text string, start string, spans int")
    base = docs.limit(200).withColumn("start", F.lit("s")).withColumn("spans", F.lit(1))
    clean = redact(base.union(more))
    assert clean.columns == ["doc_id", "text", "start", "spans"] and clean.count() == 205
    texts = [r.text for r in clean.where("doc_id is null or doc_id in (2, 3)").collect()]
    assert 'é token = "[SECRET]" and secret = "[SECRET]" end' in texts and None in texts and "" in texts
    assert f"commit {KEY}" in texts and "plain " * 40_000 + 'token = "[SECRET]"' in texts
    assert redact(more.limit(0)).count() == secret_findings(more.limit(0)).count() == 0


def test_secrets_that_context_tells(spark, docs):
    """Short ones, other signs, a URL's password, and a dotted token as one."""
    token = "eyJhbGciOiJIUzI1NiIsInR5cCI6IkpXVCJ9.eyJzdWIiOiIxMjM0NTY3ODkwIn0x9Qa.dozjgNryP4J3jVmNHl0w5N-XgL0n3I9Pl"
    lines = ['password = "{}"', "api_key: {}", "db postgres://user:{}@host/db", "Authorization: Bearer {}"]
    secrets = ["Tr0ub4dor&3", "x7Kq92LmZ4", "p4$$w0rd!7", token]
    rows = [(i, line.format(secret)) for i, (line, secret) in enumerate(zip(lines, secrets, strict=True), 10**6)]
    rows += [(i, t) for i, t in enumerate(["password: required", "the key = value", "see example.documentation.reference"], 2 * 10**6)]
    table = docs.limit(300).union(spark.createDataFrame(rows, "doc_id long, text string"))
    found = {r.doc_id: r.secret for r in secret_findings(table).where("doc_id >= 1000000").collect()}
    assert found == dict(enumerate(secrets, 10**6))
    clean = {r.doc_id: r.text for r in redact(table).where("doc_id >= 1000000").collect()}
    assert [clean[i] for i in range(10**6, 10**6 + 4)] == [line.format("[SECRET]") for line in lines]


def test_coverage_takes_the_longest_word():
    looks = Looks(["the", "then", "cat"], np.zeros((128, 128)))
    assert looks.coverage("thencatx") == 7 / 8 and looks.coverage("xxxx") == 0


def one_of_each_group(texts):
    """The smallest id of each group of fingerprints that four or fewer differing bits connect, compared pair by pair."""
    ids = np.array(sorted(texts))
    codes = np.array([simhash.fingerprint(simhash.shingle_hashes(texts[i] or "", 4)) for i in ids], np.uint64)
    near = np.bitwise_count(codes[:, None] ^ codes[None, :]) <= 4
    label = np.arange(len(ids))
    while True:
        new = np.where(near, label[None, :], len(ids)).min(axis=1)
        if (new == label).all():
            return ids[np.unique(label)].tolist()
        label = new


def test_stages_take_any_rows(spark):
    """Null and repeated ids, null, blank and very long texts, repeated rows, other columns with the operators' names, no rows."""
    base = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").limit(60)
    good = base.first().text
    rows = [(None, good + " more"), (None, None), (7, None), (7, ""), (8, " \n"), (9, "word " * 60_000), (10, f'token = "{KEY}" ' + good), (10, f'token = "{KEY}" ' + good)]
    more = spark.createDataFrame(rows, "doc_id long, text string")
    names = ("row", "kept_row", "score", "fingerprint", "component", "spans", "start", "piece", "label", "kept")
    docs = base.union(more).select("*", *[F.lit(i).alias(n) for i, n in enumerate(names)])
    for table in (docs.limit(0), docs):
        now, before = table, table.count()
        for _, stage in corpus_pipeline.STAGES[:4]:
            now = corpus_pipeline.spool(stage(spark, now, SMALL))
            assert now.columns == table.columns and now.count() <= before
            assert all(tuple(r)[2:] == tuple(range(len(names))) for r in now.collect())
            before = now.count()
        pieces = corpus_pipeline.STAGES[4][1](spark, now, SMALL)
        assert pieces.where("piece = 0").count() == before
    texts = [r.text for r in now.collect()]
    assert sum('token = "[SECRET]"' in (t or "") for t in texts) == 1 and not any(KEY in (t or "") for t in texts)


def test_stages_keep_clean_documents(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "exact_dedup", "simhash_near_dedup", "secret_scans", "best_fit_packing"]
    now, kept = table, []
    for _, stage in corpus_pipeline.STAGES[:4]:
        now = corpus_pipeline.spool(stage(spark, now, SMALL))
        assert now.columns == table.columns and now.dtypes == table.dtypes
        kept.append({r.doc_id: r.text for r in now.collect()})
    whole = {r.doc_id: r.text for r in table.collect()}
    good = [d for d, q in labels.items() if q == 1]
    assert sum(d in kept[0] for d in good) >= 0.98 * len(good)
    squeezed = {}
    for d, t in sorted(kept[0].items()):
        squeezed.setdefault(re.sub("[ \t\n\x0b\x0c\r]", "", t), []).append((-len(t), d))
    assert set(kept[1]) == {min(g)[1] for g in squeezed.values()}
    assert set(kept[2]) == set(one_of_each_group(kept[1]))
    assert set(kept[3]) == set(kept[2])
    assert not any(re.search(r'(?i)token = "[0-9a-f]{40}"', t or "") for t in kept[3].values())
    assert all(t == whole[d] for d, t in kept[3].items() if "[SECRET]" not in (t or ""))
    pieces = corpus_pipeline.STAGES[4][1](spark, now, SMALL)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == set(kept[3])
