"""The registered queries of this package: each applies one operator, with its
production parameters, to its whole table and derives the columns that the
contract names."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from streamops.llm import (conversations, decontaminate, html, langid, minhash, ngram, packing, pii, quality, resample,
                           secrets, substrings, warc)
from streamops.llm.common import read_table

RANKS = "byte_bpe_50k.tiktoken"


def op9_bestfit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, read_table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS),
                        public_tokenizers.PATTERN)


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(read_table(spark, sf_dir, "pages"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, read_table(spark, sf_dir, "pages"))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(spark, read_table(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find(spark, read_table(spark, sf_dir, "documents"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram.score(spark, read_table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(spark, read_table(spark, sf_dir, "documents"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(spark, read_table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contaminated documents: one row per document and item."""
    return decontaminate.contaminated(spark, read_table(spark, sf_dir, "documents"),
                                      read_table(spark, sf_dir, "benchmark"))


def op10_quality_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(spark, read_table(spark, sf_dir, "documents")).drop("_id", "_row", "removed")


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.removed(spark, read_table(spark, sf_dir, "documents")).drop("kept")


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.audit(spark, read_table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_html_extraction": op1_html_extraction,
    "op2_warc": op2_warc,
    "op3_minhash": op3_minhash,
    "op4_secret_scan": op4_secret_scan,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_language_id": op6_language_id,
    "op7_pii": op7_pii,
    "op8_decontamination": op8_decontamination,
    "op9_bestfit_packing": op9_bestfit_packing,
    "op10_quality_lines": op10_quality_lines,
    "op11_substring_dedup": op11_substring_dedup,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_conversation_repair": op13_conversation_repair,
}

# CRC-32 of a string's UTF-8 bytes, over the 256 remainders of the polynomial (``CRC_TABLE`` as column ``tab``).
CRC_TABLE = ("SELECT list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: "
             "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab")


def _crc(s: str) -> str:
    octets = (f"list_transform(range(1, 2 * strlen({s}) + 1, 2), lambda i: "
              f"CAST('0x' || substr(hex(encode({s})), i, 2) AS BIGINT))")
    return (f"xor(list_reduce(list_concat([4294967295], {octets}), lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8)), "
            f"4294967295)")


ORACLE: dict[str, str] = {
    "op11_substring_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        runs AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS run
                 FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
        least AS (SELECT run, min(doc_id) AS first FROM runs GROUP BY run),
        gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM runs JOIN least USING (run)
                 WHERE doc_id > first),
        kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n
                 FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d)
                 ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
               sha256(coalesce(t, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)""".replace("\\\\", "\\"),
    "op12_importance_resampling": rf"""
        WITH d AS (SELECT 'd' AS side, doc_id AS id, text FROM documents
                   UNION ALL SELECT 'b', row_number() OVER (), text FROM benchmark),
        w AS (SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
              'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM d),
        f AS (SELECT side, id, unnest(w) AS f FROM w),
        b AS (SELECT f, {_crc('f')} % 10000 AS b FROM (SELECT DISTINCT f FROM f), ({CRC_TABLE})),
        n AS (SELECT b, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t FROM f JOIN b USING (f) GROUP BY b),
        al AS (SELECT coalesce(sum(s), 0) AS s, coalesce(sum(t), 0) AS t FROM n),
        g AS (SELECT b, floor(1000 * ln(CAST((n.t + 1) * (al.s + 10000) AS DOUBLE) / CAST((n.s + 1) * (al.t + 10000) AS DOUBLE)))
              AS g FROM n, al),
        k AS (SELECT id, CAST(floor(sum(g) / count(*)) AS BIGINT) AS weight FROM f JOIN b USING (f) JOIN g USING (b)
              WHERE side = 'd' GROUP BY id),
        sc AS (SELECT id, len(w) AS n, coalesce(weight, 0) AS weight,
                      CAST('0x' || left(sha256('2024:' || id), 8) AS BIGINT) AS h FROM w LEFT JOIN k USING (id) WHERE side = 'd'),
        r AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score FROM sc),
        o AS (SELECT *, row_number() OVER (PARTITION BY n >= 20 ORDER BY score DESC, id) AS p,
                     count(*) OVER (PARTITION BY n >= 20) AS many FROM r)
        SELECT id AS doc_id, n AS n_features, weight, score, CASE WHEN n >= 20 AND p <= 10 * many // 100 THEN p END AS rank
        FROM o""",
    # the best (cost, edits, lines) that end in each place, row by row, over all inserts and edits
    "op13_conversation_repair": rf"""
        WITH RECURSIVE c AS (SELECT conv_id AS v, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_crc('s')} % 20 AS c
            FROM (SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS s
                  FROM conversations), ({CRC_TABLE})),
        d AS (SELECT v, turn, CASE c WHEN 4 THEN 'user' ELSE role END AS role, CASE c WHEN 1 THEN '' WHEN 2 THEN
              regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE c WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
              FROM c WHERE c <> 0),
        p AS (SELECT *, row_number() OVER (PARTITION BY v ORDER BY turn NULLS FIRST, role, text, copy) AS pos FROM d),
        q AS (SELECT *, left(role, 1) AS i, lead(left(role, 1)) OVER (PARTITION BY v ORDER BY pos) AS nxt,
                     CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                          WHEN row_number() OVER (PARTITION BY v, role, text ORDER BY pos) > 1 THEN 'duplicate'
                          WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault FROM p),
        ins(f, t, made) AS (VALUES (0, 0, ''), (0, 2, 'u'), (0, 3, 'ua'), (1, 1, ''), (1, 2, 'u'), (1, 3, 'ua'),
                                   (2, 2, ''), (2, 3, 'a'), (3, 3, ''), (3, 2, 'u')),
        edit(f, t, e, i, cost) AS (VALUES (0, 0, 'D', '', 3), (1, 1, 'D', '', 3), (2, 2, 'D', '', 3), (3, 3, 'D', '', 3),
            (0, 1, 'K', 's', 0), (0, 2, 'K', 'u', 0), (1, 2, 'K', 'u', 0), (3, 2, 'K', 'u', 0), (2, 3, 'K', 'a', 0),
            (0, 2, 'R', 'user', 2), (1, 2, 'R', 'user', 2), (3, 2, 'R', 'user', 2), (2, 3, 'R', 'assistant', 2)),
        move AS (SELECT ins.f, edit.t, e, i, cost + 2 * length(made) AS cost, repeat('I', length(made)) || e AS letters,
                        replace(replace(made, 'u', 'user:' || chr(10)), 'a', 'assistant:' || chr(10)) AS lines
                 FROM ins JOIN edit ON ins.t = edit.f),
        step(v, pos, place, best) AS (
            SELECT DISTINCT v, CAST(0 AS BIGINT), 0, {{'cost': CAST(0 AS BIGINT), 'audit': '', 'lines': ''}} FROM q
            UNION ALL
            SELECT s.v, s.pos + 1, m.t, min({{'cost': CAST(best.cost + m.cost + CASE WHEN e <> 'D' AND fault = 'truncated' THEN 1 ELSE 0 END
                AS BIGINT), 'audit': best.audit || letters, 'lines': best.lines || m.lines || CASE e WHEN 'D' THEN ''
                WHEN 'K' THEN role || ':' || text || chr(10) ELSE m.i || ':' || text || chr(10) END}})
            FROM step s JOIN q ON q.v IS NOT DISTINCT FROM s.v AND q.pos = s.pos + 1 JOIN move m ON m.f = s.place
                AND (e = 'D' OR fault NOT IN ('blank', 'duplicate') AND (e = 'R' OR m.i = q.i))
            GROUP BY s.v, s.pos, m.t),
        n AS (SELECT v, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                     count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                     count(*) FILTER (fault = 'truncated') AS truncated,
                     count(*) FILTER (nxt IS NOT NULL AND i || nxt NOT IN ('su', 'ua', 'au')) AS illegal FROM q GROUP BY v),
        z AS (SELECT n.v, min({{'cost': CAST(best.cost + 2 * length(made) AS BIGINT), 'audit': best.audit || repeat('I', length(made)),
                'lines': best.lines || replace(replace(made, 'u', 'user:' || chr(10)), 'a', 'assistant:' || chr(10))}}) AS best
              FROM step s JOIN n ON s.v IS NOT DISTINCT FROM n.v AND s.pos = n.n JOIN ins ON ins.f = s.place AND ins.t IN (0, 3) GROUP BY n.v)
        SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0) AS cost,
               coalesce(best.audit, '') AS audit, sha256(coalesce(left(best.lines, greatest(length(best.lines) - 1, 0)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN n ON n.v IS NOT DISTINCT FROM o.conv_id
        LEFT JOIN z ON z.v IS NOT DISTINCT FROM o.conv_id""",
}
