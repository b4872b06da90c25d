"""Secret scans: wide patterns find candidates, a random forest removes the false ones.

Candidates are runs of 16 or more signs of keys, tokens of such runs of 8 or more joined by dots,
whatever is assigned to a credential word (of any length and signs; in quotes up to the closing
one, else up to white space or one of ,;"'`<>) and the password before a URL's host. A secret that
is none of these, as a short one in plain prose, is not found.

The forest looks at a candidate's length, its transitions between and within character
classes, how far words of a dictionary cover it, whether it stands in a path, and the words next to
it. Dictionary and transitions are counted over all documents; the forest learns from labelled
findings.
"""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from qualitygate.llm.common import numbered, spool, text_of
from qualitygate.llm.pretokens import text_blocks

#: What may be a secret: a long run of the signs that keys are made of, or several joined by dots.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_\-]{16,}={0,2}")
DOTTED = re.compile(r"(?<![A-Za-z0-9+/_\-.])[A-Za-z0-9_\-]{8,}(?:\.[A-Za-z0-9_\-]{8,})+")
#: What is assigned to a credential word, and the password of a URL, whatever their signs.
ASSIGNED = re.compile(
    r"(?i:token|secret|key|password|passwd|pwd|auth|bearer|credentials?|authorization)[\"'`\]]{0,2}[ \t]*(?::=|=>|[=:])[ \t]*(?:(?i:bearer|basic)[ \t]+)?"
    r"(?:\"(?P<a>[^\"\n]+)\"|'(?P<b>[^'\n]+)'|`(?P<c>[^`\n]+)`|(?P<d>[^\s,;\"'`<>]+))"
)
USERINFO = re.compile(r"://[^\s:/@]{0,256}:(?P<a>[^\s/]{1,256})@")
#: Words that name what follows them a secret, or something harmless.
CREDENTIAL = {"token", "secret", "key", "apikey", "password", "passwd", "pwd", "auth", "bearer", "credential", "credentials", "authorization"}
HARMLESS = {"commit", "sha", "md5", "checksum", "hash", "uuid", "guid", "build", "revision", "digest", "isbn", "order", "phone", "blob", "base64", "png", "etag", "image", "tree"}
#: Words of the dictionary: the most frequent of at least so many letters.
DICTIONARY, LETTERS = 4000, 3
FEATURES = ["length", "changes", "classes", "digits", "upper", "entropy", "likelihood", "coverage", "path", "assigned", "quoted", "credential", "harmless", "prose", "userinfo"]
TREES, DEPTH, KEEP = 40, 8, 0.5
FINDING = "start long, stop long, secret string, features array<double>"


def dictionary(docs: DataFrame, text: str = "text") -> list[str]:
    """The most frequent lower-case words over all documents; their number is fixed."""
    words = docs.select(F.explode(F.split(F.lower(text_of(text)), "[^a-z]+")).alias("word")).where(F.length("word") >= LETTERS)
    top = words.groupBy("word").count().orderBy(F.desc("count"), "word").limit(DICTIONARY)
    return [r.word for r in top.collect()]


def transitions(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Log likelihoods of the next ASCII character after each, over all documents: a table of fixed size."""

    def count(batches):
        total = np.zeros(128 * 128, np.int64)
        for _, texts in text_blocks(batches, 500_000):
            data = np.minimum(np.frombuffer("\n".join(texts).encode(), np.uint8), 127).astype(np.int64)
            total += np.bincount(data[:-1] * 128 + data[1:], minlength=128 * 128)
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(total)), pa.array(total[total > 0])], names=["pair", "n"])

    counted = docs.select(text_of(text).alias("text")).mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    table = np.full(128 * 128, 0.1)
    for r in counted.collect():  # at most 128 x 128 rows
        table[r.pair] += r.n
    table = table.reshape(128, 128)
    return np.log(table / table.sum(axis=1, keepdims=True))


def spans(text: str) -> list[tuple[int, int]]:
    """Places of all candidates; one may lie in another, the forest sees both."""
    out = {m.span() for pattern in (CANDIDATE, DOTTED) for m in pattern.finditer(text)}
    out |= {m.span(m.lastgroup) for pattern in (ASSIGNED, USERINFO) for m in pattern.finditer(text)}
    return sorted(out)


class Looks:
    """Features of candidates; sent to the tasks with its dictionary and transition table."""

    def __init__(self, words: list[str], likelihood: np.ndarray):
        self.words, self.likelihood = frozenset(words), likelihood.astype(np.float32)
        self.longest = max(map(len, words), default=0)

    def coverage(self, value: str) -> float:
        """Share of the letters that words cover, taking the longest word from each place."""
        low, at, covered = value.lower(), 0, 0
        while at < len(low):
            n = next((n for n in range(min(self.longest, len(low) - at), LETTERS - 1, -1) if low[at : at + n] in self.words), 0)
            covered += n
            at += n or 1
        return covered / len(value)

    def features(self, text: str, start: int, stop: int) -> list[float]:
        value = text[start:stop]
        kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "o" for c in value]
        codes = np.minimum(np.frombuffer(value.encode(), np.uint8), 127)
        counts = np.unique(codes, return_counts=True)[1] / len(codes)
        before, after = text[max(0, start - 60) : start], text[stop : stop + 30]
        near = re.findall(r"[^\W\d_]+", before.lower())[-3:][::-1]
        next_words = re.findall(r"[^\W\d_]+", after.lower())[:2]

        def closeness(names):
            return max((1 / (i + 1) for i, w in enumerate(near) if w in names), default=0.0)

        return [
            float(len(value)),
            sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / max(1, len(kinds) - 1),
            float(len(set(kinds))),
            kinds.count("d") / len(kinds),
            kinds.count("u") / len(kinds),
            float(-(counts * np.log2(counts)).sum()),
            float(self.likelihood[codes[:-1], codes[1:]].mean()) if len(codes) > 1 else 0.0,
            self.coverage(value),
            float("/" in value or before[-1:] in tuple("/.\\~") or after[:1] in tuple("/\\")),
            float(bool(re.search(r"[=:]\s*[\"'`]?$", before))),
            float(before[-1:] in tuple("\"'`") and after[:1] in tuple("\"'`")),
            closeness(CREDENTIAL),
            closeness(HARMLESS),
            sum(w in self.words for w in near + next_words) / 5,
            float(after[:1] == "@" and "://" in before),
        ]

    def found(self, text: str) -> list[dict]:
        return [{"start": a, "stop": b, "secret": text[a:b], "features": self.features(text, a, b)} for a, b in spans(text)]


def labelled_examples(words: list[str], n: int = 1500, seed: int = 11) -> list[tuple[str, int, int, int]]:
    """(text, start, stop, label) of findings made by rule: assigned credentials against hashes, paths, numbers and words.

    They stand in for findings that people have labelled; pass your own to ``train`` if you have them.
    """
    rnd = random.Random(seed)
    words = words or ["word", "plain", "text"]
    hexes, mixed = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"

    def signs(alphabet, n):
        return "".join(rnd.choice(alphabet) for _ in range(n))

    def value():
        return rnd.choice([signs(hexes, rnd.choice([32, 40, 40, 64])), signs(mixed, rnd.randint(20, 48)), signs(hexes.upper(), 40), "AKIA" + signs(mixed[:26] + "0123456789", 16), "ghp_" + signs(mixed, 36)])

    def prose(n):
        return [rnd.choice(words).capitalize() if rnd.random() < 0.2 else rnd.choice(words) for _ in range(n)]

    out = []
    for _ in range(n):
        good, name = value(), rnd.choice(sorted(CREDENTIAL))
        name = rnd.choice([name, name.upper(), "api_" + name, "my " + name])
        label = int(rnd.random() < 0.5)
        if label:
            secret, frame = good, rnd.choice(['{n} = "{v}"', "{n}: {v}", "{n}={v}", "{n}: '{v}'", "{n} {v}", '"{n}": "{v}",'])
        else:
            kind = rnd.randrange(6)
            harmless = rnd.choice(sorted(HARMLESS))
            if kind < 2:
                secret, frame = signs(hexes, rnd.choice([32, 40, 64])), harmless + rnd.choice([" {v}", ": {v}", '="{v}"', " = {v}", " = '{v}'"])
            elif kind == 2:
                secret, frame = "-".join(signs(hexes, k) for k in (8, 4, 4, 4, 12)), rnd.choice(["uuid={v}", "{v}", 'id: "{v}"'])
            elif kind == 3:
                secret, frame = "/".join(rnd.choice(words) for _ in range(5)) + "/" + signs(hexes, 8), rnd.choice(["see /{v}.html", "https://example.com/{v}", "path = /{v}"])
            elif kind == 4:
                secret, frame = signs("0123456789", rnd.randint(16, 22)), rnd.choice(["{v}", "order {v}", "{v}.", "phone: {v}"])
            else:
                secret = rnd.choice(["", "-", "_"]).join(prose(rnd.randint(3, 6)))
                secret, frame = secret + signs(words[0], max(0, 16 - len(secret))), rnd.choice(["{v}", "{v},", "key {v}", "the {v} of", '"{v}"'])
        lead = " ".join(prose(rnd.randint(0, 6))) + rnd.choice([" ", "\n", ".\n", " | "])
        line = lead + frame.replace("{n}", name)
        start = line.index("{v}")
        text = line.replace("{v}", secret) + rnd.choice([" ", "\n", ". "]) + " ".join(prose(rnd.randint(0, 5)))
        out.append((text, start, start + len(secret), label))
    return out + _in_context(words, n, random.Random(seed + 1))


def _in_context(words: list[str], n: int, rnd: random.Random) -> list[tuple[str, int, int, int]]:
    """Findings of which only the context tells: short or odd passwords, URLs and dotted tokens against settings, prose and names."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    mixed, odd = letters + "0123456789", "!@#$%^&*?+~.-_"

    def signs(alphabet, low, high):
        return "".join(rnd.choice(alphabet) for _ in range(rnd.randint(low, high)))

    def word():
        return rnd.choice(words)

    def password():
        made = list(signs(mixed, 4, 12) + signs("0123456789", 1, 3) + signs(odd, 1, 3))
        rnd.shuffle(made)
        leet = word().capitalize().replace("o", "0").replace("e", "3").replace("a", "4") + signs("0123456789", 1, 3) + signs(odd, 1, 2) + signs(mixed, 0, 2)
        return rnd.choice(["".join(made), leet, signs(mixed, 6, 7) + signs("0123456789", 2, 8)])

    def plain():
        return rnd.choice([word(), word().capitalize(), word(), signs("0123456789", 1, 4), "None", "null", "true", "required", "string", f"{word()}_{word()}", f"{word()}.{word()}", f"{word()}()", f"<{word()}>", f"${{{word().upper()}}}", f"{word()} {word()} {word()}"])

    assigned = ['{n} = "{v}"', "{n}: {v}", "{n}={v}", "{n}: '{v}'", '"{n}": "{v}",']
    out = []
    for _ in range(n):
        name = rnd.choice(sorted(CREDENTIAL))
        name = rnd.choice([name, name.upper(), "db_" + name, "my " + name])
        label, kind = int(rnd.random() < 0.5), rnd.randrange(4)
        if kind < 2:
            secret, frame = password() if label else plain(), rnd.choice(assigned)
            secret = secret if any(sign in frame for sign in "\"'") else secret.replace(" ", "_").strip("<>")
        elif kind == 2:
            secret = password().replace("@", "!") if label else rnd.choice(["password", "pass", "<password>", "$PASSWORD", "xxxx", word()])
            frame = f"{rnd.choice(['postgres', 'https', 'mysql', 'redis', 'amqp'])}://{word()}:{{v}}@{word()}.{word()}/{word()}"
        elif label:
            secret = "eyJ" + ".".join(signs(mixed + "-_", 18, 60) for _ in range(3))
            frame = rnd.choice([*assigned, "Authorization: Bearer {v}", "{n} {v}"])
        else:
            secret = ".".join((word() + word() + word() + "____")[:20] for _ in range(rnd.randint(2, 4)))
            frame = rnd.choice(["{v}", "see {v}", "import {v}", "https://{v}/", "{n}: {v}"])
        lead = " ".join(word() for _ in range(rnd.randint(0, 6))) + rnd.choice([" ", "\n", ".\n"])
        line = lead + frame.replace("{n}", name)
        start = line.index("{v}")
        out.append((line.replace("{v}", secret) + rnd.choice([" ", "\n"]) + " ".join(word() for _ in range(rnd.randint(0, 5))), start, start + len(secret), label))
    return out


def train(looks: Looks, findings: list[tuple[str, int, int, int]], spark: SparkSession):
    """A random forest from labelled findings (text, start, stop, label); every candidate that overlaps a finding has its label.

    A finding that no candidate overlaps is a row of its own.
    """
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    rows = []
    for text, start, stop, label in findings:
        near = [f["features"] for f in looks.found(text) if f["start"] < stop and start < f["stop"]]
        rows += [(f, float(label)) for f in near or [looks.features(text, start, stop)]]
    table = spark.createDataFrame(rows, "features array<double>, label double").coalesce(1)
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=5, featureSubsetStrategy="sqrt")
    return forest.fit(table.select(array_to_vector("features").alias("features"), "label"))


def candidates(rows: DataFrame, looks: Looks) -> DataFrame:
    """(row, doc_id, start, stop, secret, features) of all candidates in rows of (row, doc_id, text)."""

    def run(batches):
        for batch, texts in text_blocks(batches, 500_000):
            own = [looks.found(t) for t in texts]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("secret", pa.string()), ("features", pa.list_(pa.float64()))]))
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), pa.array(own, kind)], names=["row", "doc_id", "found"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    made = rows.select("row", "doc_id", "text").mapInArrow(run, f"row long, doc_id {kind}, found array<struct<{', '.join(f.replace(' ', ': ', 1) for f in FINDING.split(', '))}>>")
    return made.select("row", "doc_id", F.explode("found").alias("f")).select("row", "doc_id", "f.*")


def _scored(rows: DataFrame, findings=None) -> DataFrame:
    from pyspark.ml.functions import array_to_vector, vector_to_array

    words = dictionary(rows)
    looks = Looks(words, transitions(rows))
    forest = train(looks, findings or labelled_examples(words), rows.sparkSession)
    found = candidates(rows, looks).withColumnRenamed("features", "listed").withColumn("features", array_to_vector("listed"))
    return forest.transform(found).withColumn("score", F.round(vector_to_array("probability")[1], 6))


def secret_findings(docs: DataFrame, text: str = "text", key: str = "doc_id", findings=None) -> DataFrame:
    """doc_id, start, stop, secret, score of what the forest holds to be a secret; places are code points.

    A null or empty text has none; rows with null or repeated ids are texts of their own, other
    columns are not looked at, and an empty table gives no rows. No candidate is dropped before
    the forest has seen it; what is a candidate is said above. A secret within another is part of it.
    """
    rows = numbered(docs, F.col(key).alias("doc_id"), text_of(text).alias("text"))
    found = _scored(rows, findings).where(F.col("score") >= KEEP)
    earlier = Window.partitionBy("row").orderBy("start", F.desc("stop")).rowsBetween(Window.unboundedPreceding, -1)
    outer = found.withColumn("reached", F.coalesce(F.max("stop").over(earlier), F.lit(-1))).where("stop > reached")
    return outer.select("doc_id", "start", "stop", "secret", "score")


def redact(docs: DataFrame, text: str = "text", key: str = "doc_id", mark: str = "[SECRET]", findings=None, count: str | None = None) -> DataFrame:
    """``docs`` with each found secret replaced by ``mark``; all rows and columns stay, a null text stays null.

    ``count`` names a column, if ``docs`` has it, that gets the new number of characters where a text changed.
    """
    rows = spool(numbered(docs, F.col(key).alias("doc_id"), carry=True), "secrets")  # the text once
    rows = rows.withColumn("text", F.coalesce(F.col(f"kept_row.`{text}`"), F.lit("")))
    found = _scored(rows, findings).where(F.col("score") >= KEEP)
    earlier = Window.partitionBy("row").orderBy("start", F.desc("stop")).rowsBetween(Window.unboundedPreceding, -1)
    reached = found.withColumn("reached", F.coalesce(F.max("stop").over(earlier), F.lit(-1))).where("stop > reached")
    apart = reached.select("row", F.greatest("start", "reached").alias("start"), "stop")  # what overlaps is cut where the one before it ends
    spans = apart.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "stop")), asc=False).alias("spans"))  # bounded by the text
    clean = F.aggregate("spans", F.col("text"), lambda t, s: F.overlay(t, F.lit(mark), (s["start"] + 1).cast("int"), (s["stop"] - s["start"]).cast("int")))
    whole = rows.select("row", "kept_row").join(spans, "row", "left").withColumn("text", F.col(f"kept_row.`{text}`"))
    new = F.when(F.col("spans").isNull(), F.col("text")).otherwise(clean)
    columns = {c: F.col(f"kept_row.`{c}`") for c in docs.columns} | {text: new}
    if count in columns:
        columns[count] = F.when(F.col("spans").isNull(), columns[count]).otherwise(F.length(clean)).cast(docs.schema[count].dataType)
    return whole.select(*[column.alias(c) for c, column in columns.items()])
