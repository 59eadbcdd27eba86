"""The llm queries and, where SQL can say it, their DuckDB twins."""

from __future__ import annotations

import public_tokenizers

from lexiforge.llm import bpe, exact_dedup, media, packing, pii, quality, secrets, simhash, substring, urls
from lexiforge.storage import read_table


def op1_simhash_near_dedup(spark, sf_dir):
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle_words=4, budget=4)


def op2_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(read_table(spark, sf_dir, "documents"), keep="largest")


def op3_packing(spark, sf_dir):
    return packing.packed(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_secret_scan(spark, sf_dir):
    return secrets.span_digests(read_table(spark, sf_dir, "documents"))


def op5_substring_dedup(spark, sf_dir):
    return substring.word_digests(read_table(spark, sf_dir, "documents"))


def op6_quality(spark, sf_dir):
    return quality.scored(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_byte_bpe(spark, sf_dir):
    return bpe.round_trip(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op8_pii(spark, sf_dir):
    return pii.report(read_table(spark, sf_dir, "documents"))


def op9_media(spark, sf_dir):
    return media.stored_texts(read_table(spark, sf_dir, "documents"))


def op10_url_filter(spark, sf_dir):
    return urls.filtered_urls(read_table(spark, sf_dir, "pages"))


QUERIES = {f.__name__: f for f in (op1_simhash_near_dedup, op2_exact_dedup, op3_packing, op4_secret_scan, op5_substring_dedup, op6_quality, op7_byte_bpe, op8_pii, op9_media, op10_url_filter)}

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _secrets_sql() -> str:
    """Positions are the running sums of the lengths of what lies between matches and of the matches."""
    quote = lambda p: "'" + p.replace("'", "''") + "'"
    parts = []
    for rank, r in enumerate(secrets.RULES):
        p = quote(r.pattern)
        parts.append(f"""
            SELECT doc_id, {rank} AS rank, '{r.kind}' AS kind, starts[i] AS a, starts[i] + length(hits[i]) AS b
            FROM (SELECT doc_id, unnest(range(1, len(hits) + 1)) AS i, hits, judged,
                         list_transform(range(1, len(hits) + 1), lambda j: coalesce(list_sum(list_transform(gaps[1:j], lambda x: length(x))), 0)
                                        + coalesce(list_sum(list_transform(hits[1:j - 1], lambda x: length(x))), 0))::BIGINT[] AS starts
                  FROM (SELECT doc_id, regexp_extract_all(t, {p}, 0) AS hits, regexp_extract_all(t, {p}, {r.group}) AS judged, string_split_regex(t, {p}) AS gaps
                        FROM d WHERE regexp_matches(t, {p})))
            WHERE length(judged[i]) >= {r.least}""")
    return f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        s AS ({" UNION ALL ".join(parts)}),
        g AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
                     string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, rank) FILTER (rank < 3) AS base,
                     string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, rank) AS spans
              FROM s GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
               sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM d LEFT JOIN g ON d.doc_id = g.doc_id"""


ORACLE_SQL = {
    "op2_exact_dedup": f"""
        WITH d AS (SELECT doc_id, {_LOWERED} AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               row_number() OVER (PARTITION BY t ORDER BY doc_id DESC) = 1 AS kept, sha256(t) AS text_sha256
        FROM d""",
    "op4_secret_scan": _secrets_sql(),
}
