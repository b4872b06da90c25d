"""Words that differ by one edit, by walking a frontier through two distributed tries.

One trie holds the words, the other the reversed words. An edge goes from a branching prefix to the
next one and is named by the characters between; both tables are shuffled by node, and a node's name
is a hash of its prefix. A state is (word, position, node, edits). Without an edit a word is on its own path,
which is known; at each node of it the states with one edit leave by the other edges. From then on
a state needs the one edge that goes on as the word does, so level by level the frontier is joined with
the edges, and shrinks. States that end with their word at the end of another have found a neighbour.

Of two neighbours the common start or the common end holds half of the longer word, so each
trie is only needed below that depth, where a node has few edges.
"""

from __future__ import annotations

from functools import reduce
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qualitygate.llm.common import spool, text_of

#: A frontier of at most so many states and characters is sent to the edges; a larger one is shuffled to them.
SENT_STATES, SENT_CHARACTERS = 50_000, 2_000_000
#: About so many characters of words are hashed at once.
CHARACTERS = 500_000
#: Fixed values of the hash of prefixes: an odd base, and the constants of the splitmix64 finisher.
BASE, MIX = 0x9E3779B97F4A7C15, (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def runs(docs: DataFrame, shortest: int = 5, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, run) of all maximal runs of at least ``shortest`` Latin letters, A-Z in lower case."""
    low = F.translate(text_of(text), ascii_uppercase, ascii_lowercase)
    found = F.regexp_extract_all(low, F.lit(f"[a-z\\u00C0-\\u00FF]{{{shortest},}}"), F.lit(0))
    return docs.select(F.col(key).alias("doc_id"), F.explode(found).alias("run"))


def damaged(found: DataFrame, every: int = 97) -> DataFrame:
    """``word`` of each run: a code point is missing where ``every`` divides the CRC-32 of ``<doc_id>:<run>``. A null id counts as empty."""
    marked = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "run")
    h = found.select("run", F.crc32(marked.cast("binary")).alias("h"))
    at = F.pmod("h", F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return h.select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word"))


def _mixed(points: np.ndarray) -> np.ndarray:
    x = points.astype(np.uint64) + np.uint64(1)
    for shift, by in ((30, MIX[0]), (27, MIX[1])):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
    return x ^ (x >> np.uint64(31))


def _prefixes(words: list[str], backward: bool, mixed):
    """(word number, depth, node, next): the prefixes of each word from half of it on. ``next`` is a code point plus one, 0 at the end."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    points = np.frombuffer("".join(w[::-1] if backward else w for w in words).encode("utf-32-le"), np.uint32)
    begin = np.cumsum(size) - size
    powers = np.cumprod(np.append(np.uint64(1), np.full(max(size.max(initial=0) - 1, 0), BASE, np.uint64)))
    sums = np.append(np.uint64(0), np.cumsum(mixed(points) * powers[np.arange(len(points)) - np.repeat(begin, size)]))
    first = (size + 1) // 2 if backward else size // 2  # the longer of two neighbours has this much in common with the other
    each = size - first + 1
    owner = np.repeat(np.arange(len(words)), each)
    depth = np.repeat(first, each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    at = begin[owner] + depth
    node = mixed(sums[at] - sums[begin[owner]] + depth.astype(np.uint64) * np.uint64(MIX[0]) + np.uint64(backward))
    ends = depth == size[owner]
    after = np.where(ends, 0, points[np.minimum(at, max(len(points) - 1, 0))].astype(np.int64) + 1) if len(points) else np.zeros(len(owner), np.int64)
    return owner, depth, node, after


def _paths(mixed):
    def run(batches):
        for batch in batches:
            words = batch.column("word").to_pylist()
            ends = np.cumsum([len(w) for w in words])
            a = 0
            while a < len(words):
                b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + CHARACTERS, "right")))
                for backward in (False, True):
                    owner, depth, node, after = _prefixes(words[a:b], backward, mixed)
                    ids = batch.column("id").slice(a, b - a).take(pa.array(owner))
                    columns = [ids, pa.array(np.full(len(owner), backward)), pa.array(depth.astype(np.int32)), pa.array(node.view(np.int64)), pa.array(after.astype(np.int32))]
                    yield pa.RecordBatch.from_arrays(columns, names=["id", "backward", "depth", "node", "next"])
                a = b

    return run


def _rest(word: str, at: Column, size: Column) -> Column:
    return F.substring(F.col(word), at + 1, size)


def _code(word: str, at: Column) -> Column:
    """The code point at a place plus one, 0 at the end."""
    return F.when(at < F.length(word), F.ascii(_rest(word, at, F.lit(1))) + 1).otherwise(0)


def _own_paths(words: DataFrame, mixed) -> DataFrame:
    """id, word (reversed in the second trie), depth, node, next, label and child of all words' places on nodes that branch or end a word."""
    paths = words.select("id", "word").mapInArrow(_paths(mixed), "id long, backward boolean, depth int, node long, next int")
    at_node = Window.partitionBy("node")
    kept = paths.withColumns({"low": F.min("next").over(at_node), "high": F.max("next").over(at_node)}).where("low = 0 or low < high")
    places = kept.drop("low", "high").join(words.select("id", "word"), "id")
    places = places.withColumn("word", F.when(F.col("backward"), F.reverse("word")).otherwise(F.col("word")))
    below = F.lead(F.struct("depth", "node")).over(Window.partitionBy("id", "backward").orderBy("depth"))
    places = places.withColumn("below", below)
    label = F.coalesce(_rest("word", F.col("depth"), F.col("below.depth") - F.col("depth")), F.lit(""))
    return spool(places.select("id", "word", "depth", "node", "next", label.alias("label"), F.col("below.node").alias("child")), "trie")


def _leave(own: DataFrame, edges: DataFrame) -> DataFrame:
    """States with one edit: where a word leaves its own path at a node, by another edge or by ending there.

    The word is the longer one, or the smaller one at that place: each pair is found from one side.
    """
    m = F.length("label")
    swapped = (F.col("first") > F.col("next")) & (_rest("word", F.col("depth") + 1, m - 1) == F.substring("label", F.lit(2), m))
    dropped = _rest("word", F.col("depth") + 1, m) == F.col("label")
    ended = F.length("word") == F.col("depth") + 1
    possible = F.when(F.col("first") == 0, ended).otherwise(swapped | dropped)
    left = own.where("next > 0").drop("label", "child").join(edges, "node").where((F.col("first") != F.col("next")) & possible)
    to = F.array_compact(F.array(F.when((F.col("first") > 0) & swapped, F.col("depth") + m), F.when((F.col("first") == 0) | dropped, F.col("depth") + 1 + m)))
    return left.select("id", "word", F.explode(to).alias("at"), F.col("child").alias("node"), "ended")


def near_pairs(words: DataFrame, mixed=_mixed) -> DataFrame:
    """(a, b): ids of words that differ by one inserted, deleted or replaced code point, in one of both orders. ``words`` is (id, word), written and distinct."""
    own = _own_paths(words, mixed)
    edges = own.select("node", F.col("next").alias("first"), "label", "child", F.when(F.col("next") == 0, F.col("id")).alias("ended")).distinct()
    edges = spool(edges, "trie")
    states, found = spool(_leave(own, edges), "trie"), []
    while True:
        found.append(states.where("ended is not null").select(F.col("id").alias("a"), F.col("ended").alias("b")))
        front = states.where("ended is null").select("id", "word", "at", "node", _code("word", F.col("at")).alias("first"))
        n, characters = front.agg(F.count(F.lit(1)), F.sum(F.length("word"))).first()
        if not n:
            break
        if n <= SENT_STATES and characters <= SENT_CHARACTERS:
            front = F.broadcast(front)
        m = F.length("label")
        on = edges.join(front, ["node", "first"]).where(_rest("word", F.col("at"), m) == F.col("label"))
        states = spool(on.select("id", "word", (F.col("at") + m).alias("at"), F.col("child").alias("node"), "ended"), "trie")
    # Nodes are named by hashes: a pair that two prefixes of one name would bring is none.
    pairs = reduce(DataFrame.union, found).distinct()
    both = pairs.join(words.select(F.col("id").alias("a"), F.col("word").alias("x")), "a").join(words.select(F.col("id").alias("b"), F.col("word").alias("y")), "b")
    return spool(both.where(F.levenshtein("x", "y", 1) == 1).select("a", "b"), "pairs")


def _roots(forms: DataFrame) -> DataFrame:
    """(id, root): the last of the forms that follow each other from ``id``, by doubling the steps. Forms grow in number, so there is no circle."""
    now = spool(forms.select("id", F.col("form_id").alias("root")), "roots")
    while True:
        on = now.select(F.col("id").alias("root"), F.col("root").alias("further"))
        now = spool(now.join(on, "root", "left").select("id", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if now.where("moved").isEmpty():
            return now.select("id", "root")
        now = now.select("id", "root")


def spelling_variants(counted: DataFrame, factor: int = 2) -> DataFrame:
    """word, form, root, n, n_near and form_n of each word in ``counted`` (word, n).

    Words are near if they differ by exactly one inserted, deleted or replaced code point. The form is
    the near word of largest n, of equal ones the smallest in code-point order, if its n is at
    least ``factor`` times the word's; else form and form_n are null. The root follows forms to the last.
    Repeated words count together, null words are left out, the empty word is a word, and an
    empty table gives no rows.
    """
    if factor < 2:
        raise ValueError("a form must be more frequent than its word")
    summed = counted.where("word is not null").groupBy("word").agg(F.sum("n").alias("n"))
    words = spool(summed.select(F.monotonically_increasing_id().alias("id"), "word", "n"), "words")
    pairs = near_pairs(words)
    sides = pairs.union(pairs.select("b", "a")).toDF("id", "other")
    others = words.select(F.col("id").alias("other"), F.struct((-F.col("n")).alias("less"), F.col("word").alias("form"), F.col("id").alias("form_id")).alias("place"))
    near = sides.join(others, "other").groupBy("id").agg(F.count(F.lit(1)).alias("n_near"), F.min("place").alias("place"))
    chosen = F.when(-F.col("place.less") >= factor * F.col("n"), F.col("place"))
    known = words.join(near, "id", "left").withColumn("place", chosen)
    known = spool(known.select("id", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "place.form", "place.form_id", (-F.col("place.less")).alias("form_n")), "forms")
    roots = _roots(known.where("form_id is not null"))
    named = roots.join(words.select(F.col("id").alias("root"), F.col("word").alias("last")), "root").select("id", "last")
    return known.join(named, "id", "left").select("word", "form", F.coalesce("last", "word").alias("root"), "n", "n_near", "form_n")


def frequent_words(found: DataFrame, shortest: int = 5, least: int = 3) -> DataFrame:
    """(word, n) of the words of at least ``shortest`` code points that occur at least ``least`` times."""
    return found.where(F.length("word") >= shortest).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
