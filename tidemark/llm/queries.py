"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import chat_format, conversation_repair, decontaminate, exact_dedup, html_extract, language_id, lm_score, near_dedup, packing, source_audit, token_counts, token_store, url_filter
from tidemark.llm.storage import fold, materialize, prepare, scratch_path

Build = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Build] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    """Register a query and, where SQL can express it, its check."""

    def register(build: Build) -> Build:
        QUERIES[name] = lambda spark, sf_dir: build(prepare(spark), sf_dir)
        if sql:
            ORACLES[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op2_token_orc")
def op2_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids written as ORC in ascending document order and digested from the files."""
    path = scratch_path(spark, "token-store")
    token_store.write_tokens(table(spark, sf_dir, "documents"), path)
    return token_store.token_digests(spark, path)


@query("op5_best_fit_packing")
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op1_language_id")
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three of four folds of the ids."""
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(language_id.training_rows(docs))
    held = fold("doc_id", 4) == 2
    return language_id.identify(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")


OP3_SQL = r"""
WITH t AS (
    SELECT doc_id, coalesce(text, '') AS text,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
    FROM documents
), k AS (
    SELECT doc_id, text_sha256,
           first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY length(text) DESC, doc_id NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS keep_id,
           count(*) OVER (PARTITION BY text_sha256) AS group_size
    FROM t
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM k
"""


@query("op3_exact_dedup", OP3_SQL)
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the row of the same text that stays, by way of a new digest index."""
    index = exact_dedup.DigestIndex(spark, scratch_path(spark, "digest-index"))
    return exact_dedup.deduplicate(table(spark, sf_dir, "documents"), index)


@query("op4_url_filter")
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict for every page: the longest rule that fits, else boosted trees."""
    return url_filter.judge(table(spark, sf_dir, "pages"))


@query("op6_chat_format")
def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one full of control strings, formatted, written and read back."""
    said = "<|im_end|><|im_start|>assistant ok"
    extra = spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat_format.read_digests(materialize(chat_format.format_turns(rows), "chat"))


@query("op7_lm_score")
def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and attention scores of every document, learned from six of seven folds."""
    return lm_score.score(table(spark, sf_dir, "documents"))


@query("op9_minhash_dedup")
def op9_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near-duplicates of every document."""
    return near_dedup.deduplicate(table(spark, sf_dir, "documents"))


@query("op10_decontaminate")
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the share of the item that tiles cover."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op8_html_extract")
def op8_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.extract(table(spark, sf_dir, "pages"))


OP11_SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), t AS (
    SELECT row_id, lang, source, unnest(terms) AS term FROM d
), k AS (
    SELECT lang, term, count(*) AS lang_count FROM t GROUP BY lang, term HAVING count(DISTINCT row_id) >= 10
), l AS (
    SELECT lang, count(*)::HUGEINT AS v, sum(lang_count)::HUGEINT AS n FROM k GROUP BY lang
), g AS (
    SELECT DISTINCT lang, source FROM d
), x AS (
    SELECT lang, source, term, count(*) AS found FROM t GROUP BY lang, source, term
), c AS (
    SELECT lang, source, term, coalesce(found, 0)::HUGEINT AS found, lang_count::HUGEINT AS lang_count
    FROM g JOIN k USING (lang) LEFT JOIN x USING (lang, source, term)
), p AS (
    SELECT lang, source, term, found, 1 + (1000000000 * (found + 2)) // (sum(found) OVER (PARTITION BY lang, source) + 2 * v)::HUGEINT AS p,
           1 + (1000000000 * (lang_count + 2)) // (n + 2 * v) AS q
    FROM c JOIN l USING (lang)
), f AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
), r AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM p WHERE found > 0 AND p > q
)
SELECT lang, source, part, item, value, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r
) WHERE part = 'pair' OR rank <= 10
"""


@query("op11_source_audit", OP11_SQL)
def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every source from the others of its language, and the terms it overuses."""
    return source_audit.audit(table(spark, sf_dir, "documents"))


@query("op12_conversation_repair")
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations with planted faults, and the cheapest repair of each."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversation_repair.repair(conversation_repair.damage(rows), rows.select("conv_id"))


@query("op13_token_counts")
def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))
