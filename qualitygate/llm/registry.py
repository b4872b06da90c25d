"""The queries of this package by name, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import functions as F

from qualitygate.llm import byte_bpe, conversations, neighbours, packing, quality, secret_scan, simhash, spelling
from qualitygate.llm.common import documents
from qualitygate.llm.exact_dedup import exact_groups
from qualitygate.llm.license_scan import license_scan
from qualitygate.llm.repeats import removed
from qualitygate.llm.substring_dedup import drop_repeated_words
from qualitygate.llm.suffix_dedup import drop_repeated_bytes
from qualitygate.llm.token_counts import token_counts


def _tokenizer(name):
    import public_tokenizers  # only here, so that the other queries do not need it

    return public_tokenizers.path(name)


def op1_suffix_array_dedup(spark, sf_dir):
    kept = drop_repeated_bytes(documents(spark, sf_dir))
    n_spans = F.size("spans").cast("long").alias("n_spans")
    return kept.select("doc_id", F.col("n_units").alias("n_bytes"), removed().alias("n_removed"), n_spans, F.sha2("kept", 256).alias("kept_sha256"))


def op2_secret_scan(spark, sf_dir):
    found = secret_scan.secret_findings(documents(spark, sf_dir))
    return found.select("doc_id", "start", "stop", F.sha2("secret", 256).alias("secret_sha256"), "score")


def op3_byte_bpe(spark, sf_dir):
    ranks = _tokenizer("byte_bpe_multi_50k.tiktoken")
    coded = byte_bpe.encode(documents(spark, sf_dir), ranks, decoded=True)
    listed = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))


def op4_exact_dedup(spark, sf_dir):
    return exact_groups(documents(spark, sf_dir))


def op5_substring_dedup(spark, sf_dir):
    kept = drop_repeated_words(documents(spark, sf_dir))
    return kept.select("doc_id", F.col("n_units").alias("n_words"), removed().alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


def op6_simhash(spark, sf_dir):
    return simhash.near_duplicates(documents(spark, sf_dir))


def op7_license_scan(spark, sf_dir):
    return license_scan(documents(spark, sf_dir))


def op8_best_fit_packing(spark, sf_dir):
    pieces = packing.token_pieces(documents(spark, sf_dir), _tokenizer("byte_bpe_50k.json"))
    return packing.pack(pieces)


def op9_quality_classifier(spark, sf_dir):
    return quality.quality_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op10_nearest_neighbours(spark, sf_dir):
    return neighbours.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op11_token_counts(spark, sf_dir):
    return token_counts(documents(spark, sf_dir), _tokenizer("byte_bpe_50k.json"))


def op12_spelling_variants(spark, sf_dir):
    return spelling.spelling_variants(spelling.frequent_words(spelling.damaged(spelling.runs(documents(spark, sf_dir)))))


def op13_conversation_repair(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return conversations.repair(conversations.damaged(turns), F.col("present"))


_ALL = (
    op1_suffix_array_dedup,
    op2_secret_scan,
    op3_byte_bpe,
    op4_exact_dedup,
    op5_substring_dedup,
    op6_simhash,
    op7_license_scan,
    op8_best_fit_packing,
    op9_quality_classifier,
    op10_nearest_neighbours,
    op11_token_counts,
    op12_spelling_variants,
    op13_conversation_repair,
)
QUERIES = {f.__name__: f for f in _ALL}

ORACLE = {
    "op4_exact_dedup": r"""
        WITH b AS (SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS normal FROM documents),
        g AS (SELECT normal, count(*) AS group_size, first(doc_id ORDER BY length(t) DESC, doc_id) AS keep_id FROM b GROUP BY normal)
        SELECT b.doc_id, g.keep_id, g.group_size, b.doc_id = g.keep_id AS kept, sha256(b.normal) AS text_sha256
        FROM b JOIN g USING (normal)
    """,
    "op5_substring_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS j FROM d),
        starts AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM d),
        windows AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 34], ' ')) AS code FROM starts),
        repeated AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY code) AS n FROM windows) AS w WHERE n > 1),
        covered AS (
            SELECT words.doc_id, j, word, max(i) OVER (PARTITION BY words.doc_id ORDER BY j ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS hit
            FROM words LEFT JOIN repeated ON words.doc_id = repeated.doc_id AND j = i
        ),
        kept AS (SELECT doc_id, count(hit) AS n_removed, string_agg(word, ' ' ORDER BY j) FILTER (WHERE hit IS NULL) AS rest FROM covered GROUP BY doc_id)
        SELECT d.doc_id, len(ws) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)
    """,
}
