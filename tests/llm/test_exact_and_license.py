import hashlib
import re

from pyspark.sql import functions as F

from qualitygate.llm import exact_dedup
from qualitygate.llm.exact_dedup import drop_copies, exact_groups
from qualitygate.llm.license_scan import PHRASES, license_scan

SCHEMA = "doc_id long, text string, row long, normal string, digest string"
TEXTS = [None, "", " \t\n\x0b\x0c\r", "a b", "ab", "a  b", "a b", "a  b", "x" * 70000, "x" * 69999 + " x", "é", "é"]


def table(spark, texts):
    return spark.createDataFrame([(i, t, 7, "n", "d") for i, t in enumerate(texts)], SCHEMA)


def brute(rows):
    normal = [re.sub("[ \t\n\x0b\x0c\r]", "", t or "") for _, t in rows]
    out = []
    for (i, _), n in zip(rows, normal, strict=True):
        group = [k for k, m in enumerate(normal) if m == n]
        best = min(group, key=lambda k: (-len(rows[k][1] or ""), rows[k][0] is None, rows[k][0] or 0))
        out.append((i, rows[best][0], len(group), hashlib.sha256(n.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_groups_against_brute_force(spark):
    docs = table(spark, TEXTS)
    got = exact_groups(docs).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=repr) == brute(list(enumerate(TEXTS)))
    assert sum(r.kept for r in got) == len({r.text_sha256 for r in got})


def test_hot_text_is_dealt_out_with_the_same_result(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "HOT_SHARE", 10**9)
    rows = [(i, "same  text" if i == 170 else "same text") for i in range(400)] + [(None, "same  text"), (900, "other")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = exact_groups(docs).collect()
    assert {(r.keep_id, r.group_size) for r in got} == {(170, 401), (900, 1)}
    assert {r.doc_id for r in got if r.kept} == {170, 900}


def test_repeated_rows_null_ids_empty_table_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (None, "a", 3), (None, "b", 4), (None, "b ", 5)], "doc_id long, text string, `row` int").withColumn("points", F.lit("p"))
    kept = drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r.text, r.doc_id is None) for r in kept.collect()) == [("a", False), ("b ", True)]
    assert drop_copies(docs.limit(0)).count() == exact_groups(docs.limit(0)).count() == 0


def test_sort_needs_no_second_exchange(spark):
    docs = table(spark, ["a", "b"] * 50)
    rows = exact_dedup._numbered_texts(docs, "text", "doc_id", False)
    dealt = rows.withColumn("salt", F.pmod("row", F.lit(3))).withColumn("front", F.substring("normal", 1, 3)).repartitionByRange("front", "code", "salt")
    plan = dealt.groupBy("front", "code", "salt", "normal").agg(F.min(F.struct("points", "row")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "rangepartitioning" in plan


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_license_base_against_brute_force(spark):
    texts = [None, "", "MIT license", "the MIT/license and mit License, mit  licenses", "GNU General\nPublic-License mit license apache license", "mit licenſe", "apache Kicense", "general public public license", "é mit license" * 3, "word " * 30000 + "mit license", "license mit", "Apache_License"]
    got = {r.doc_id: r for r in license_scan(table(spark, texts)).collect()}
    for i, t in enumerate(texts):
        w = words(t)
        places = [(k, label) for k in range(len(w)) for p, label in PHRASES.items() if w[k : k + len(p.split())] == p.split()]
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(w), len(places), min([p[0] for p in places], default=None), max([p[0] for p in places], default=None)), t
        assert r.base_labels == ",".join(sorted({p[1] for p in places}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_license_method_labels(spark):
    texts = ["Permission is hereby granted, free of charge, to any person obtaining a copy of it", "Permission granted hereby free charge person copy", "Licensed under CC BY-NC 4.0.", "Mozilla Public License, v. 2.0", "subject to the terms of the Mozilla Public License, v. 2.0", "plain words"]
    got = {r.doc_id: r.labels for r in license_scan(table(spark, texts)).collect()}
    assert {i: got[i] for i in (0, 1, 2, 4, 5)} == {0: "mit", 1: "", 2: "cc-by-nc", 4: "mpl", 5: ""}
    assert license_scan(table(spark, []).limit(0)).count() == 0
