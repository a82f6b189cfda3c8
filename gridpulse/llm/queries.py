"""The registered queries of this subpackage and their DuckDB SQL.

Each query applies its operator, with production parameters, to the whole
table and derives the contract's columns from the operator's output.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.llm.collocations import collocations
from gridpulse.llm.common import documents, fold_share, plain_words
from gridpulse.llm.decontaminate import contamination
from gridpulse.llm.exact_dedup import exact_dedup
from gridpulse.llm.hard_negatives import hard_negatives
from gridpulse.llm.language_id import identify_language
from gridpulse.llm.license_scan import BLOCK_WORDS, PHRASES, TEMPLATES, license_scan
from gridpulse.llm.line_dedup import line_dedup
from gridpulse.llm.lm_score import lm_score
from gridpulse.llm.minhash_dedup import setsketch_classes
from gridpulse.llm.packing import pack
from gridpulse.llm.pseudonyms import pseudonymise
from gridpulse.llm.simhash_dedup import simhash_classes
from gridpulse.llm.token_files import read_token_files, write_token_files
from gridpulse.session import unique_scratch

# The pseudonym key of the query; a user passes a secret of their own.
DEMO_KEY = "demonstration key"


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify_language(documents(spark, sf_dir), fold_share("doc_id") != 0)
    return found.select("doc_id", (fold_share("doc_id") == 0).alias("held_out"), "lang_pred", "score", "margin")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lm_score(documents(spark, sf_dir), fold_share("doc_id") != 1)
    held_out = (fold_share("doc_id") == 1).alias("held_out")
    return found.select("doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


def op4_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(documents(spark, sf_dir), DEMO_KEY).select("doc_id", "text", "n_found", "found")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(documents(spark, sf_dir)).drop("matches")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_classes(documents(spark, sf_dir), width=3, radius=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), "byte", capacity=1024, end_id=2)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = unique_scratch(spark, "llm/token-files")
    write_token_files(documents(spark, sf_dir), path, public_tokenizers.path("word_bpe_49k.json"), "word", end_id=1)
    return read_token_files(spark, path, with_ids=False)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup(documents(spark, sf_dir), min_docs=10, min_chars=1)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collocations(documents(spark, sf_dir), min_count=10, longest=3, inside_percent=50, top=2000)
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = setsketch_classes(documents(spark, sf_dir), width=2, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(rows["vec_id"] % 7 == 0, (rows["label"] + 1) % 10).otherwise(rows["label"])
    return hard_negatives(rows.select("vec_id", label.alias("label"), "embedding"), F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_lm_score": op3_lm_score,
    "op4_pii_pseudonyms": op4_pii_pseudonyms,
    "op5_license_scan": op5_license_scan,
    "op6_decontamination": op6_decontamination,
    "op7_simhash_dedup": op7_simhash_dedup,
    "op8_packing": op8_packing,
    "op9_token_files": op9_token_files,
    "op10_line_dedup": op10_line_dedup,
    "op11_collocations": op11_collocations,
    "op12_minhash_dedup": op12_minhash_dedup,
    "op13_hard_negatives": op13_hard_negatives,
}



def _license_sql() -> str:
    """Every block against every template, in plain SQL."""

    def listed(words: list[bytes]) -> str:
        return "[" + ", ".join(f"'{w.decode()}'" for w in words) + "]"

    rows = []
    for i, (label, text) in enumerate(TEMPLATES):
        words = plain_words(text)
        own = sorted(set(words))
        # A template of up to s words, s a power of two and at least 8, meets windows of 2 s words.
        step = max(8, 2 ** math.ceil(math.log2(len(words))))
        rows.append(f"({i}, '{label}', {step}, {math.ceil(0.8 * len(own) - 1e-9)}, {listed(own)})")
    phrases = ", ".join(f"('{label}', {listed(plain_words(text))})" for text, label in PHRASES)
    half = BLOCK_WORDS // 2
    text = _LOWER.format("coalesce(text, '')")
    return f"""
        WITH t(template, label, step, need, own) AS (VALUES {", ".join(rows)}),
        p(label, phrase) AS (VALUES {phrases}),
        l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos
              FROM (SELECT doc_id, string_split({text}, chr(10)) AS ls FROM documents)),
        w AS (SELECT doc_id, pos, regexp_extract_all(line, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM l),
        placed AS (SELECT *, coalesce(sum(len(words)) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM w),
        d AS (SELECT doc_id, flatten(list(words ORDER BY pos)) AS words FROM w GROUP BY doc_id),
        places AS (SELECT doc_id, label, unnest(list_filter(range(len(words)), lambda i: words[i + 1 : i + len(phrase)] = phrase)) AS spot
                   FROM d, p),
        base AS (SELECT doc_id, count(*) AS n_base, min(spot) AS first_word, max(spot) AS last_word, list_distinct(list(label)) AS base
                 FROM places GROUP BY doc_id),
        steps AS (SELECT DISTINCT step FROM t),
        blocks AS (SELECT doc_id, before + lo AS lo, least(len(words) - lo, {BLOCK_WORDS}) AS n, 0 AS span, list_distinct(words[lo + 1 : lo + {BLOCK_WORDS}]) AS block
                   FROM (SELECT *, unnest(range(0, greatest(1, len(words) - {half}), {half})) AS lo FROM placed)
                   UNION ALL
                   SELECT doc_id, lo, least(2 * step, len(words) - lo) AS n, step AS span, list_distinct(words[lo + 1 : lo + 2 * step]) AS block
                   FROM (SELECT *, unnest(range(0, greatest(1, CAST(ceil(len(words) / step) AS BIGINT) - 1) * step, step)) AS lo FROM d, steps)),
        found AS (SELECT doc_id, lo, n, span, template, label, len(own) AS size, list_intersect(own, block) AS common, need
                  FROM blocks, t WHERE span = 0 OR span = step),
        met AS (SELECT *, len(common) / size AS containment FROM found WHERE len(common) >= need),
        telling AS (SELECT * FROM met m WHERE NOT EXISTS (
            SELECT 1 FROM met b WHERE b.doc_id = m.doc_id AND list_has_all(b.common, m.common) AND (
              (b.lo = m.lo AND b.n = m.n AND b.span = m.span
               AND (b.containment > m.containment OR b.containment = m.containment AND (b.size > m.size OR b.size = m.size AND b.template < m.template)))
              OR (b.containment > m.containment AND b.lo < m.lo + m.n AND b.lo + b.n > m.lo)))),
        m AS (SELECT doc_id, list(label) AS labels, max(containment) AS score FROM telling GROUP BY doc_id)
        SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
               array_to_string(list_sort(coalesce(base, [])), ',') AS base_labels,
               array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(labels, [])))), ',') AS labels,
               CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(score, 0.0) END AS score
        FROM d LEFT JOIN base USING (doc_id) LEFT JOIN m USING (doc_id)"""


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {
    "op11_collocations": f"""
        WITH p AS (SELECT coalesce(lang, 'und') AS lang,
                          unnest(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
        w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \\t]'), lambda x: x <> '') AS ws FROM p),
        g AS (SELECT lang, m, unnest(list_transform(range(1, len(ws) - m + 2), lambda i: array_to_string(ws[i : i + m - 1], ' '))) AS phrase
              FROM w, (VALUES (1), (2), (3)) AS t(m)),
        f AS (SELECT lang, m, phrase, count(*) AS n FROM g GROUP BY ALL),
        tot AS (SELECT lang, sum(n) AS n FROM f WHERE m = 1 GROUP BY lang),
        c AS (SELECT lang, m, phrase, n AS a, string_split(phrase, ' ') AS ws, unnest(range(1, m)) AS k FROM f WHERE m > 1 AND n >= 10),
        s AS (SELECT c.lang, c.m, c.phrase, a, k, x.n AS l, y.n AS r,
                     (1000000::HUGEINT * a * a) // (x.n::HUGEINT * y.n) AS score
              FROM c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(ws[1 : k], ' ')
                     JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(ws[k + 1 :], ' ')),
        b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        around AS (SELECT lang, unnest([array_to_string(string_split(phrase, ' ')[1:2], ' '), array_to_string(string_split(phrase, ' ')[2:3], ' ')]) AS phrase,
                          a FROM b WHERE m = 3),
        kept AS (SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM around o WHERE o.lang = b.lang AND o.phrase = b.phrase AND 100 * o.a >= 50 * b.a)),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
        SELECT lang, rank, phrase, a, l, r, CAST(tot.n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
        FROM ranked JOIN tot USING (lang) WHERE rank <= 2000""",
    "op12_minhash_dedup": f"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
        s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) < 2 THEN ws ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS g FROM w),
        n AS (SELECT w.doc_id, count(s.g) AS n FROM w LEFT JOIN s ON s.doc_id = w.doc_id GROUP BY w.doc_id),
        shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
        links AS (SELECT x, y FROM shared JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 80 * (p.n + q.n - c)),
        pairs AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
        reached(doc_id, root) AS (SELECT doc_id, doc_id FROM n UNION SELECT pairs.y, reached.root FROM reached JOIN pairs ON pairs.x = reached.doc_id),
        c AS (SELECT doc_id, min(root) AS component_id FROM reached GROUP BY doc_id)
        SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM n JOIN c USING (doc_id)""",
    "op13_hard_negatives": """
        WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
                   FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        pairs AS (SELECT a.vec_id AS anchor_id, e.vec_id AS other_id, a.label = e.label AS alike,
                         CAST(list_inner_product(a.v, e.v) AS BIGINT) AS score
                  FROM e a, e WHERE a.vec_id % 100 = 0 AND a.vec_id <> e.vec_id),
        pos AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM pairs WHERE alike
                QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
        neg AS (SELECT anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
                       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS rank
                FROM pos JOIN pairs USING (anchor_id)
                WHERE NOT alike AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score)
        SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= 5""",
    "op5_license_scan": _license_sql(),
    "op2_exact_dedup": f"""
        WITH d AS (SELECT doc_id, {_LOWER.format("coalesce(text, '')")} AS norm FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY norm)""",
    "op10_line_dedup": f"""
        WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
        l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM d),
        k AS (SELECT *, {_LOWER.format("trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM l),
        c AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
        SELECT doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (c.key IS NULL), '')) AS kept_sha256
        FROM k LEFT JOIN c USING (key) GROUP BY doc_id""",
}
