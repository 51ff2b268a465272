"""The queries of this subpackage, as ``__spark_entry__`` registers them.

``QUERIES``: name -> callable(spark, sf_dir) -> DataFrame; ``ORACLE_SQL``:
name -> DuckDB statement, where SQL can express the result.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import licenses, main_text, periodic, quality, toxicity, warc
from tillroll.llm.bpe import bpe_digests, read_ranks
from tillroll.llm.exact import exact_groups
from tillroll.llm.labelled_pages import labelled_pages
from tillroll.llm.license_texts import TEMPLATES
from tillroll.llm.packing import pack_documents
from tillroll.llm.ranked import search
from tillroll.llm.simhash import near_duplicates
from tillroll.llm.suffix import remove_repeats
from tillroll.llm.urls import judge_urls
from tillroll.session import ensure_checkpoint_dir

# The tokenizers of the contracts.
WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_RANKS = "byte_bpe_50k.tiktoken"

# The URL rules of the contract (host, path, verdict).
URL_RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_tokenizer() -> str:
    """The word tokenizer's definition, read on the driver."""
    with open(public_tokenizers.path(WORD_TOKENIZER), encoding="utf-8") as f:
        return f.read()


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = main_text.train(labelled_pages())
    return main_text.extract(_table(spark, sf_dir, "pages"), model)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), word_tokenizer(), capacity=2048)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"), TEMPLATES)


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = quality.judge(docs, quality.fit(docs, _table(spark, sf_dir, "labels")))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    found = judge_urls(_table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return found.select("page_id", "host", "path", "rule", "verdict")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_groups(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = read_ranks(public_tokenizers.path(BYTE_RANKS))
    return bpe_digests(_table(spark, sf_dir, "documents"), tokens, public_tokenizers.PATTERN)


def held_out(doc_id: str = "doc_id"):
    """Rows no label is learnt from: crc32 of the id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Model:
    return toxicity.fit(docs, _table(spark, sf_dir, "labels").where(~held_out()))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = toxicity.score(docs, toxicity_model(spark, docs, sf_dir))
    return found.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=50)


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``docs`` as op12's contract has it: of each document whose
    h = crc32(doc_id) ends in 0, the words from a = g % n on, g = floor(h/10),
    go round the p = 1 + floor((n - a) / (3 + g % 8)) words at a."""
    words = F.filter(F.split(F.col("text").cast("string"), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g, n = F.floor(h / 10), F.greatest(F.size(words), F.lit(1))
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    times = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), times)), F.lit(1), n - a)
    planted = F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")
    hit = (h % 10 == 0) & (F.size(words) > 0)
    return docs.select("doc_id", F.when(hit, planted).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_planted_periods(_table(spark, sf_dir, "documents"))
    found = periodic.collapse_runs(docs, min_length=6, min_exponent=4, digest=True)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("")
    found = found.withColumn("longest", longest)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.col2")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.col3")).alias("period"),
        F.floor(1000 * F.col("longest.length") / -F.col("longest.col3")).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.col("text").alias("collapsed_sha256"),
    )


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{ensure_checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    index = warc.write_archives(_table(spark, sf_dir, "pages"), folder, min_bytes=1000)
    found = warc.read_records(index, payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extraction": op1_html_extraction,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_license_scan": op3_license_scan,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_url_filter": op6_url_filter,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_toxicity": op9_toxicity,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_ranked_search": op11_ranked_search,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_warc": op13_warc,
}

# the white space of the contracts, as a character class for DuckDB
_WHITE_CLASS = r"[\x20\x09-\x0D]"

_OP7_SQL = f"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS original,
         sha256(regexp_replace(coalesce(text, ''), '{_WHITE_CLASS}', '', 'g')) AS text_sha256
  FROM documents
), ranked AS (
  SELECT doc_id, text_sha256,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY length(original) DESC, doc_id
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM texts
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM ranked
"""

_OP3_TEMPLATES = ", ".join(f"({i}, '{name}', '{text}')" for i, (name, text) in enumerate(TEMPLATES))
_OP3_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_OP3_SQL = f"""
WITH templates(t, license, text) AS (VALUES {_OP3_TEMPLATES}), units AS (
  SELECT doc_id, 'line' AS kind, unnest(string_split(text, chr(10))) AS unit FROM documents WHERE text IS NOT NULL
  UNION ALL SELECT doc_id, 'paragraph', unnest(string_split(text, chr(10) || chr(10))) FROM documents WHERE text IS NOT NULL
  UNION ALL SELECT doc_id, 'whole', text FROM documents WHERE text IS NOT NULL
), numbered AS (
  SELECT row_number() OVER () AS u, doc_id, kind, regexp_extract_all({_OP3_LOWER.format("unit")}, '[a-z0-9]+') AS w FROM units
), own AS (
  SELECT u, pair, count(*) AS n FROM (
    SELECT u, unnest([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) AS pair FROM numbered WHERE len(w) > 1
  ) GROUP BY u, pair
), t_words AS (
  SELECT t, license, regexp_extract_all({_OP3_LOWER.format("text")}, '[a-z0-9]+') AS w FROM templates
), t_own AS (
  SELECT t, license, pair, count(*) AS n FROM (
    SELECT t, license, unnest([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) AS pair FROM t_words
  ) GROUP BY t, license, pair
), shared AS (
  SELECT own.u, t_own.t, t_own.license, sum(least(own.n, t_own.n)) AS both_n FROM own JOIN t_own USING (pair) GROUP BY own.u, t_own.t, t_own.license
), scored AS (
  SELECT n.doc_id, n.u, n.kind, s.license, 2 * s.both_n / (len(n.w) - 1 + len(t.w) - 1) AS dice
  FROM shared s JOIN numbered n USING (u) JOIN t_words t USING (t)
)
SELECT doc_id, license, max(dice) AS dice, count(DISTINCT u) FILTER (kind = 'line') AS n_lines
FROM scored WHERE dice >= 0.8 GROUP BY doc_id, license
"""

_OP6_RULES = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in URL_RULES)
_OP6_SQL = f"""
WITH rules(host, path, verdict) AS (VALUES {_OP6_RULES}), split AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM split
), fits AS (
  SELECT p.page_id, r.host || r.path AS rule, r.verdict,
         row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host || r.path) DESC, length(r.host) DESC, r.verdict DESC) AS place
  FROM parts p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fits f ON f.page_id = p.page_id AND f.place = 1
"""

_TERM_CLASS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_OP11_TERMS = f"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_TERM_CLASS}')"
_OP11_SQL = f"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, {_OP11_TERMS} AS words FROM documents WHERE text IS NOT NULL
), counted AS (
  SELECT count(*) AS n_docs, sum(len(words))::BIGINT AS total FROM texts WHERE len(words) > 0
), sized AS (
  SELECT r, doc_id, 100 - 50 + (50 * len(words) * n_docs) // total AS m FROM texts, counted WHERE len(words) > 0
), held AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(words) AS term FROM texts) GROUP BY r, term
), items AS (
  SELECT row_number() OVER () AS i, item_id, unnest(list_distinct({_OP11_TERMS})) AS term FROM benchmark WHERE text IS NOT NULL
), weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM held, counted GROUP BY term, n_docs
), scored AS (
  SELECT i.i, i.item_id, s.r, s.doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM items i JOIN weights USING (term) JOIN held h USING (term) JOIN sized s USING (r) GROUP BY i.i, i.item_id, s.r, s.doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST, r)::INTEGER AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""

_OP13_SQL = """
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest, coalesce(html, '') AS payload FROM pages
), kept AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload) AS keep_id FROM payloads
), judged AS (
  SELECT *, payload_bytes >= 1000 AND keep_id IS NOT NULL AND page_id IS DISTINCT FROM keep_id AS again FROM kept
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN keep_id END AS refers_to
FROM judged
"""

ORACLE_SQL: dict[str, str] = {
    "op3_license_scan": _OP3_SQL,
    "op6_url_filter": _OP6_SQL,
    "op7_exact_dedup": _OP7_SQL,
    "op11_ranked_search": _OP11_SQL,
    "op13_warc": _OP13_SQL,
}
