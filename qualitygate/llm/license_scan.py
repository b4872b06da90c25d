"""License scans by a positional index of rare words, in DataFrame operations only.

Each template is indexed by its words of highest inverse document frequency, counted over
all documents. The places of such words in a file vote for (template, start) alignments;
an alignment counts if its rare words agree in relative position, the template's mandatory
key phrase stands where it should, and enough of the template's weight is found in place.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qualitygate.llm.common import numbered, spool, text_of

#: Words are runs of anything but ASCII that is neither letter nor digit.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Phrases that always give a label.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Label, wording, and the phrase within it that must be present.
TEMPLATES = [
    ("agpl", "gnu affero general public license version 3", "affero general public license"),
    ("apache", "licensed under the apache license version 2 0", "apache license version"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "binary forms"),
    ("cc-by", "creative commons attribution 4 0 international license", "creative commons attribution"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("gpl", "licensed under the gnu general public license version 3", "gnu general public license"),
    ("lgpl", "gnu lesser general public license version 3", "lesser general public license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", "hereby granted free"),
    ("mit", "released under the mit license", "mit license"),
    ("mpl", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
]
#: Words too common to be looked up; they keep their place in a template but carry no weight.
COMMON = {"a", "and", "any", "are", "in", "is", "of", "or", "the", "to", "with"}
#: Words by which a template is indexed, and the share of its weight that must stand in place.
RARE_WORDS, ENOUGH = 3, 0.6


def _weighty() -> list[tuple[int, str, int]]:
    """(template, word, offset) of all words that carry weight."""
    return [(t, w, i) for t, (_, wording, _) in enumerate(TEMPLATES) for i, w in enumerate(wording.split()) if w not in COMMON]


def _key_span(t: int) -> range:
    wording, key = TEMPLATES[t][1].split(), TEMPLATES[t][2].split()
    start = next(i for i in range(len(wording)) if wording[i : i + len(key)] == key)
    return range(start, start + len(key))


def _found_words(docs: DataFrame, text: str, key: str) -> DataFrame:
    """row, doc_id, n_words and the places of template and phrase words."""
    known = sorted({w for _, w, _ in _weighty()} | {w for p in PHRASES for w in p.split()})
    words = F.regexp_extract_all(text_of(text), F.lit(WORD), F.lit(0))
    placed = F.transform("words", lambda w, i: F.struct(i.cast("long").alias("at"), F.lower(w).alias("word"), F.octet_length(w).alias("size")))
    # Only A-Z count as upper case: a sign that lower() turns into an ASCII letter changes its length.
    hits = F.filter(placed, lambda p: p["word"].isin(known) & (p["size"] == F.octet_length(p["word"])))
    rows = numbered(docs, F.col(key).alias("doc_id"), words.alias("words"))
    return spool(rows.select("row", "doc_id", F.size("words").cast("long").alias("n_words"), F.transform(hits, lambda p: F.struct(p["at"].alias("at"), p["word"].alias("word"))).alias("hits")), "license")


def _phrase_places() -> Column:
    """(at, label) of each place where the words of a phrase follow each other."""

    def label(hit, i):
        found = F.lit(None).cast("string")
        for phrase, name in PHRASES.items():
            stands = F.lit(True)
            for k, word in enumerate(phrase.split()):
                other = F.get("hits", i + k)
                stands = stands & F.coalesce((other["word"] == word) & (other["at"] == hit["at"] + k), F.lit(False))
            found = F.when(stands, F.lit(name)).otherwise(found)
        return F.struct(hit["at"].alias("at"), found.alias("label"))

    return F.filter(F.transform("hits", label), lambda p: p["label"].isNotNull())


def _postings(spark, weights: dict[str, float]) -> DataFrame:
    """The index: word, template, offset, weight share, whether it is rare or part of the key phrase."""
    rows = []
    for t in range(len(TEMPLATES)):
        own = [(w, i) for u, w, i in _weighty() if u == t]
        total = sum(weights[w] for w, _ in own)
        rare = set(sorted({w for w, _ in own}, key=lambda w: (-weights[w], w))[:RARE_WORDS])
        rows += [F.struct(F.lit(w).alias("word"), F.lit(t).alias("template"), F.lit(i).cast("long").alias("offset"), F.lit(weights[w] / total).alias("share"), F.lit(int(w in rare)).alias("rare"), F.lit(int(i in _key_span(t))).alias("in_key")) for w, i in own]
    return spark.range(1).select(F.explode(F.array(*rows)).alias("p")).select("p.*")


def license_scan(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Licence labels of each row, as doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    A null or empty text has no words, no labels and score 0; a row with a null or repeated
    id is a row like any other. ``score`` is the largest share of a template's weight found
    in place, whether or not that was enough for a label. Frequencies of words are counted over all rows; only the
    table of template words, whose size is fixed, goes through the driver.
    """
    rows = _found_words(docs, text, key)
    n = rows.count()
    counts = rows.select(F.explode(F.array_distinct(F.col("hits.word"))).alias("word")).groupBy("word").count()
    seen = dict(tuple(r) for r in counts.collect())  # at most one row per template word
    weights = {w: math.log((n + 2) / (seen.get(w, 0) + 1)) for _, w, _ in _weighty()}
    found = rows.select("row", F.explode("hits").alias("hit")).join(F.broadcast(_postings(docs.sparkSession, weights)), F.col("hit.word") == F.col("word"))
    votes = found.groupBy("row", "template", (F.col("hit.at") - F.col("offset")).alias("start")).agg(F.sum("share").alias("share"), F.sum("rare").alias("rare"), F.sum("in_key").alias("in_key"))
    labels, keys = F.array(*[F.lit(t[0]) for t in TEMPLATES]), F.array(*[F.lit(len(_key_span(t))) for t in range(len(TEMPLATES))])
    stands = (F.col("rare") >= 2) & (F.col("in_key") == F.get(keys, F.col("template"))) & (F.col("share") >= ENOUGH)
    best = votes.where("rare >= 1").groupBy("row").agg(F.max("share").alias("score"), F.collect_set(F.when(stands, F.get(labels, F.col("template")))).alias("added"))
    none = F.array().cast("array<string>")
    out = rows.withColumn("places", _phrase_places()).join(best, "row", "left")
    base = F.array_sort(F.array_distinct(F.col("places.label")))
    every = F.array_sort(F.array_distinct(F.concat(base, F.coalesce("added", none))))
    return out.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(F.col("places.at")).alias("first_word"),
        F.array_max(F.col("places.at")).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.least(F.lit(1.0), F.round(F.coalesce("score", F.lit(0.0)), 6)).alias("score"),
    )
