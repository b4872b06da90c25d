"""Splitting many texts into pre-tokens at once, with numpy on code points.

Gives exactly the matches of the split pattern of the rank files: contractions, runs of
letters, digits or other signs with one leading space, and runs of white space that leave
their last character to what follows.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import chain, pairwise

import numpy as np
import pyarrow.compute as pc

LETTER, DIGIT, SPACE, OTHER, END = 1, 2, 3, 4, 9
#: The contractions of the pattern, without their apostrophe.
CONTRACTIONS = ("s", "t", "m", "d", "re", "ve", "ll")
#: Texts are split together up to so many characters; longer ones are cut between words.
CHUNK = 2_000_000


@lru_cache(1)
def _classes() -> np.ndarray:
    import regex

    table = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    for kind, sign in ((LETTER, r"\p{L}+"), (DIGIT, r"\p{N}+"), (SPACE, r"\s+")):
        for run in regex.finditer(sign, every):
            table[[ord(c) for c in run[0]]] = kind
    return table


def _starts(points: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Where matches begin; ``kind`` is END after each text, and also last."""
    n = len(kind)
    fresh = np.empty(n, bool)
    fresh[0] = True
    np.not_equal(kind[1:], kind[:-1], out=fresh[1:])
    white = kind == SPACE
    start = fresh.copy()
    # White space leaves its last character to a following sign of the same text.
    last = np.flatnonzero(white[:-1] & ~white[1:] & (kind[1:] != END))
    start[last] = True
    start[last[points[last] == 32] + 1] = False
    ends = np.flatnonzero(kind == END)
    start[ends] = True
    start[ends[:-1] + 1] = True
    marks = np.flatnonzero(points == 39)
    marks = marks[(kind[marks] == OTHER)]
    marks = marks[start[marks] & (marks + 1 < n)]
    marks = marks[kind[marks + 1] == LETTER]
    if len(marks):
        one, two = points[marks + 1], points[np.minimum(marks + 2, n - 1)]
        length = np.zeros(len(marks), np.int64)
        for letters in CONTRACTIONS:
            hit = one == ord(letters[0])
            if len(letters) == 2:
                hit &= (two == ord(letters[1])) & (kind[np.minimum(marks + 2, n - 1)] == LETTER)
            length[hit & (length == 0)] = len(letters)
        at, length = marks[length > 0], length[length > 0]
        start[at + 1] = False
        start[at + 1 + length] = True
    return start


def _cuts(text: str) -> list[str]:
    """Pieces of a very long text, cut before single spaces between other characters."""
    import regex

    cuts, at = [0], CHUNK
    while at < len(text) and (m := regex.compile(r"(?<=[^\s']) (?=\S)").search(text, at)):
        cuts.append(m.start())
        at = m.start() + CHUNK
    return [text[a:b] for a, b in pairwise([*cuts, len(text)])]


def _split_together(texts: list[str]) -> tuple[list[str], np.ndarray]:
    whole = "\0".join(texts) + "\0"
    points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
    kind = _classes()[points]
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    kind[ends] = END
    begin = np.flatnonzero(_starts(points, kind))
    keep = kind[begin] != END
    stop = np.append(begin[1:], len(points))[keep]
    begin = begin[keep]
    tokens = [whole[a:b] for a, b in zip(begin.tolist(), stop.tolist(), strict=True)]
    return tokens, np.diff(np.searchsorted(begin, ends), prepend=0)


def split(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """All pre-tokens of all texts in turn, and how many each text has."""
    tokens: list[str] = []
    counts: list[int] = []
    group: list[str] = []
    size = 0

    def flush():
        nonlocal size
        if group:
            more, n = _split_together(group)
            tokens.extend(more)
            counts.extend(n.tolist())
            group.clear()
            size = 0

    for text in texts:
        if size + len(text) > CHUNK:
            flush()
        if len(text) > CHUNK:
            pieces = [_split_together([p])[0] for p in _cuts(text)]
            tokens.extend(chain.from_iterable(pieces))
            counts.append(sum(map(len, pieces)))
        else:
            group.append(text)
            size += len(text)
    flush()
    return tokens, np.array(counts, np.int64)


def byte_signs() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it can be seen, else from U+0100 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(seen)]
    place = {b: chr(b) for b in seen} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}
    return [place[b] for b in range(256)]


def text_blocks(batches, size: int = 2_000_000):
    """Rows of Arrow batches regrouped so that a block holds about ``size`` bytes of text, or one text: (columns, texts)."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64))
        a = 0
        while a < len(ends):
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + size, "right")))
            rows = batch.slice(a, b - a)
            yield rows, rows.column("text").to_pylist()
            a = b
