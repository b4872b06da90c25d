import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from qualitygate.llm import spelling

ALPHABET = "abé"


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    return any(a[i + x :] == b[i + y :] for x, y in ((1, 1), (1, 0), (0, 1)))


def by_force(counts):
    out, form = {}, {}
    near = {w: [x for x in counts if one_edit(w, x)] for w in counts}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), counts[form[w]] if form[w] is not None else None)
    return out


def result(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


@pytest.mark.parametrize("seed", range(3))
def test_all_short_words_against_brute_force(spark, seed, monkeypatch):
    rnd = random.Random(seed)
    if seed == 1:
        monkeypatch.setattr(spelling, "SENT_STATES", -1)  # shuffle every frontier
    counts = {"".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 8))): rnd.choice([1, 2, 3, 5, 8, 13, 40, 90, 300]) for _ in range(700)}
    counts |= {"x" * k: 2**k for k in range(12)} | {"q" * 3000: 5, "q" * 2999: 10, "q" * 1500 + "r" + "q" * 1499: 20, "wordé\U0001f600s": 2, "wordés": 4}
    table = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    assert result(spelling.spelling_variants(table)) == by_force(counts)


def test_colliding_nodes_bring_nothing(spark):
    rnd = random.Random(9)
    names = sorted({"".join(rnd.choice("abcd") for _ in range(rnd.randint(3, 6))) for _ in range(120)})
    words = spark.createDataFrame(list(enumerate(names)), "id long, word string")
    pairs = spelling.near_pairs(words, lambda x: x.astype("uint64") % 7).collect()
    want = {frozenset((i, j)) for i, a in enumerate(names) for j, b in enumerate(names) if one_edit(a, b)}
    assert {frozenset(p) for p in map(tuple, pairs)} == want


def test_words_of_documents_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60)
    docs = docs.union(docs.limit(5)).withColumn("word", F.lit(1)).withColumn("n", F.lit("clash")).withColumn("run", F.lit(2))
    extra = spark.createDataFrame([(None, "Éclair ÉCLAIR éclair, naïve-Naïve NAïVE×naïve"), (7, None), (8, ""), (9, "abcde" * 4000)], "doc_id long, text string")
    docs = docs.unionByName(extra, allowMissingColumns=True)
    counts = Counter()
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for r in docs.collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            run = run.translate(low)
            h = zlib.crc32(f"{'' if r.doc_id is None else r.doc_id}:{run}".encode())
            counts[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    assert len(counts) > 100
    got = spelling.spelling_variants(spelling.frequent_words(spelling.damaged(spelling.runs(docs))))
    assert result(got) == by_force(counts)


def test_empty_and_repeated(spark):
    table = spark.createDataFrame([("word", 3), ("word", 4), (None, 9), ("", 2), ("a", 5)], "word string, n long")
    assert result(spelling.spelling_variants(table)) == {"word": (None, "word", 7, 0, None), "": ("a", "a", 2, 1, 5), "a": (None, "a", 5, 1, None)}
    assert spelling.spelling_variants(table.limit(0)).count() == 0
    with pytest.raises(ValueError):
        spelling.spelling_variants(table, factor=1)
