"""The registered queries of this subpackage. Each takes (spark, folder of tables)."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from .frames import table


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pii_semi_crf(spark: SparkSession, folder: str) -> DataFrame:
    from .pii import KINDS, find

    def derive(text, base, spans):
        many = {k: 0 for k in KINDS}
        for kind, _, _ in base:
            many[kind] += 1
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        return *many.values(), hashlib.sha256(listed.encode()).hexdigest(), ",".join(f"{k}:{a}:{b}" for k, a, b in spans)

    return find(table(spark, folder, "documents"), "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string", derive)


def op2_license_rules(spark: SparkSession, folder: str) -> DataFrame:
    from .license_rules import scan

    return scan(table(spark, folder, "documents"))


def op3_token_rollups(spark: SparkSession, folder: str) -> DataFrame:
    """Insert all documents; recount those with repeated lines without these; delete toxic ones; commit the recount again."""
    import uuid

    from pyspark.sql import functions as F

    from .frames import shared_folder
    from .rollups import Rollup, counted, union

    docs = table(spark, folder, "documents").select("doc_id", "source", "lang", "text")
    lines = F.split("text", "\n", -1)
    once = F.array_distinct(lines)
    inserts = counted(docs, F.col("text"), "insert")
    revised = counted(docs.filter(F.size(once) < F.size(lines)), F.array_join(once, "\n"), "revise")
    toxic = table(spark, folder, "labels").filter("toxic = 1").select("doc_id").distinct()
    deletes = counted(toxic.withColumns({"source": F.lit(None).cast("string"), "lang": F.lit(None).cast("string")}), F.lit(""), "delete")
    rollup = Rollup(spark, f"{shared_folder(spark)}/rollup-{uuid.uuid4().hex}")
    rollup.commit("inserts", inserts)
    rollup.commit("recounts", revised)
    rollup.commit("deletes", union(deletes))
    rollup.commit("recounts", revised)
    return rollup.totals()


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, source, lang,
         CASE WHEN len(list_distinct(string_split(text, chr(10)))) < len(string_split(text, chr(10)))
              THEN array_to_string(list_distinct(string_split(text, chr(10))), chr(10)) ELSE coalesce(text, '') END AS t
  FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)
), c AS (
  SELECT source, lang, 'space-1' AS tokenizer, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS n FROM d
  UNION ALL
  SELECT source, lang, 'alnum-1', len(regexp_extract_all(t, '[0-9A-Za-z\x{80}-\x{10FFFF}]+')) FROM d
)
SELECT source, lang, tokenizer, count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_tokens FROM c GROUP BY ALL
"""


def op4_minhash_lsh_forest(spark: SparkSession, folder: str) -> DataFrame:
    from .lsh_forest import near_duplicates

    return near_duplicates(table(spark, folder, "documents"))


def op5_threshold_top_k(spark: SparkSession, folder: str) -> DataFrame:
    from .threshold_topk import top_k

    return top_k(table(spark, folder, "embeddings"), lambda id: id % 20 == 0)


OP5_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    from .quality_rules import judge, ledger

    return judge(ledger(table(spark, folder, "documents"))).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "bits")


OP6_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), g AS (
  SELECT row, i, w[i] || chr(1) || w[i + 1] || chr(1) || w[i + 2] AS k
  FROM (SELECT row, w, unnest(range(1, len(w) - 1)) AS i FROM d)
), r AS (
  SELECT row, count(DISTINCT p) AS n FROM (
    SELECT row, unnest([i, i + 1, i + 2]) AS p FROM (SELECT *, count(*) OVER (PARTITION BY row, k) AS n FROM g) WHERE n > 1
  ) GROUP BY row
), m AS (
  SELECT doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines,
         coalesce(r.n, 0) AS n_repeat_words, len(l) AS n_lines,
         len(regexp_extract_all(t, '[A-Z]')) AS n_upper, len(regexp_extract_all(t, '[A-Za-z]')) AS n_letters
  FROM d LEFT JOIN r USING (row)
), b AS (
  SELECT *, CAST((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (2 * n_symbols > n_words)::INT
    + 8 * (2 * n_dup_lines > n_lines)::INT + 16 * (word_chars < 2 * n_words)::INT + 32 * (word_chars > 20 * n_words)::INT
    + 64 * (n_letters >= 100 AND 10 * n_upper > 7 * n_letters)::INT + 128 * (100 * n_repeat_words > 30 * n_words)::INT
    + 256 * (4 * n_symbols > n_words)::INT + 512 * (3 * n_dup_lines > n_lines)::INT AS INTEGER) AS bits
  FROM m
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, bits & 3 <> 0 AS base_failed,
       bits & 127 = 0 AND bit_count(bits & 896) < 2 AS kept, bits
FROM b
"""


def quality_rule_ablation(spark: SparkSession, folder: str) -> DataFrame:
    """Per rule of op6's policy: how many documents fail it, go only because of it, and would be kept without it."""
    from .quality_rules import ablation, ledger

    return ablation(ledger(table(spark, folder, "documents")))


_KEEPS = "({0} & 127 = 0 AND bit_count({0} & 896) < 2)"
ABLATION_SQL = f"""
WITH q AS ({OP6_SQL}),
r(rule, bit) AS (VALUES ('few_words', 1), ('repeated_windows', 2), ('symbols', 4), ('duplicate_lines', 8), ('short_words', 16), ('long_words', 32),
  ('capitals', 64), ('some_repeats', 128), ('some_symbols', 256), ('some_duplicate_lines', 512))
SELECT rule, count_if(bits & bit <> 0) AS failed, count_if(NOT {_KEEPS.format("bits")} AND {_KEEPS.format("(bits & ~bit)")}) AS only,
       count_if({_KEEPS.format("(bits & ~bit)")}) AS kept_without
FROM q CROSS JOIN r GROUP BY rule
"""


def op7_co_training(spark: SparkSession, folder: str) -> DataFrame:
    from .co_training import fit, score

    docs = table(spark, folder, "documents").select("doc_id", "text", "source", "lang", "n_chars")
    return score(docs, fit(docs, table(spark, folder, "labels"))).select("doc_id", "p_text", "p_page", "score", "kept")


def op8_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    from .packing import pack

    return pack(table(spark, folder, "documents"), tokenizer_file()).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op9_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    from .ngram_lm import score

    return score(table(spark, folder, "documents"))


def op10_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    from .bpe import vocabulary
    from .bpe_codec import round_trip

    path = tokenizer_file()

    def digest(ids, at, decoded):
        names, values, cut = vocabulary(path).decimal, ids.tolist(), at.tolist()
        return {
            "n_tokens": at[1:] - at[:-1],
            "ids_sha256": [hashlib.sha256(",".join([names[i] for i in values[a:b]]).encode()).hexdigest() for a, b in zip(cut, cut[1:], strict=False)],
            "decoded_sha256": [hashlib.sha256(d.decode("utf-8", "replace").encode()).hexdigest() for d in decoded],
        }

    return round_trip(table(spark, folder, "documents"), path, "n_tokens long, ids_sha256 string, decoded_sha256 string", digest)


QUERIES = {f.__name__: f for f in (op1_pii_semi_crf, op2_license_rules, op3_token_rollups, op4_minhash_lsh_forest, op5_threshold_top_k, op6_quality_rules, op7_co_training, op8_best_fit_packing, op9_lm_scores, op10_bpe_round_trip, quality_rule_ablation)}
#: The other queries' methods are not expressible in SQL; tests/llm holds them against brute force.
ORACLES = {"op3_token_rollups": OP3_SQL, "op5_threshold_top_k": OP5_SQL, "op6_quality_rules": OP6_SQL, "quality_rule_ablation": ABLATION_SQL}
