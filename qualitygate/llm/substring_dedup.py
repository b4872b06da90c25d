"""Substring dedup by relative Lempel-Ziv parsing.

All documents are reference: their blocks are indexed by seeds, grams of words that every
long enough window shares with its copies. A document is factored against the indexed blocks,
each factor being stretched from the seed as far as the words agree; factors of at least a
window become duplicate spans. Of a seed and share only the first four different contexts
(``REFERENCES``) are factored against; all windows that no factor covers, not only those
across factor boundaries, are found by an exact count of window digests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from qualitygate.llm.repeats import Base, Words, factored_spans, repeated_seeds, without_spans

#: Words of a seed.
SEED = 8


def drop_repeated_words(docs: DataFrame, window: int = 35, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n_units (words), spans (of words removed) and kept (the other words, joined by spaces).

    Words are runs of anything but ASCII white space. A word goes if it lies in a window of
    ``window`` words that also starts anywhere else, in the same document or another; windows are judged
    on the input, so all copies go. Null and empty texts have no words; rows with null or
    repeated ids are documents of their own, and an empty table gives no rows.
    """
    base = Base(docs, text, key)
    _, flags = repeated_seeds(base, Words, window, min(SEED, window), even=True)
    spans = factored_spans(base, flags, Words, window, min(SEED, window))
    return without_spans(base, spans, Words)
