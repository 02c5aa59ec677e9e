"""Choosing documents and files to work on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.dimensions import document_rules
from tidemark.operators.ordered import first_of_group

_DONE = ("ok", "no_matches")


def _work_order() -> list[Column]:
    return [
        F.col("priority").asc(),
        F.coalesce(F.col("submit_datetime"), F.lit("")).asc(),
        F.col("doc_id").asc(),
    ]


def select_documents(documents: DataFrame, rules: DataFrame | None = None, *, ordered: bool = False) -> DataFrame:
    """Listed documents with a rule for their type that fetches packages, a CSV package and an id.

    Adds ``category``, ``priority`` and ``download_csv``; rules without the latter fetch.  ``ordered`` sorts the whole result by
    (priority, submission, id), which costs a shuffle.
    """
    rules = document_rules(documents.sparkSession) if rules is None else rules
    usable = documents.where(
        (F.col("csv_flag").cast("string") == "1") & F.col("doc_id").isNotNull() & (F.col("doc_id") != "")
    )
    rules = rules if "download_csv" in rules.columns else rules.withColumn("download_csv", F.lit(True))
    chosen = usable.join(rules.where(F.coalesce("download_csv", F.lit(True))), "doc_type_code")
    return chosen.orderBy(*_work_order()) if ordered else chosen


def candidates(
    documents: DataFrame,
    processed: DataFrame,
    limit: int,
    *,
    type_codes: Sequence[str] | None = None,
    rules: DataFrame | None = None,
) -> DataFrame:
    """The next ``limit`` unprocessed documents in work order.

    A document listed on several days counts once, as on the latest of them.
    """
    chosen = select_documents(documents, rules)
    if type_codes is not None:
        chosen = chosen.where(F.col("doc_type_code").isin(*type_codes))
    newest = [F.col("file_date").desc(), F.coalesce(F.col("submit_datetime"), F.lit("")).desc(), F.col("priority").asc()]
    once = first_of_group(chosen, ["doc_id"], newest)
    fresh = once.join(processed.select("doc_id"), "doc_id", "left_anti")
    return fresh.orderBy(*_work_order()).limit(limit)


def outdated_sources(sources: DataFrame, index: DataFrame, *, alias_version: int, alias_sha256: str) -> DataFrame:
    """Source files whose index entry is missing, failed or outdated; one without an etag always is."""
    current = index.where(
        F.col("status").isin(*_DONE)
        & (F.col("alias_config_version") == F.lit(alias_version))
        & (F.col("alias_config_sha256") == F.lit(alias_sha256))
    ).select("source_key", "source_etag", "source_size")
    return sources.join(current, ["source_key", "source_etag", "source_size"], "left_anti")


def work_newest(sources: DataFrame, limit: int | None) -> DataFrame:
    """The newest ``limit`` sources by key, so that fresh ones do not wait behind a backlog; all without a limit."""
    return sources if limit is None else sources.orderBy(F.col("source_key").desc()).limit(limit)


def pending_sources(
    sources: DataFrame, index: DataFrame, *, alias_version: int, alias_sha256: str, limit: int
) -> DataFrame:
    """The newest ``limit`` source files that have to be worked, newest first.

    ``sources`` has ``source_key, source_etag, source_size``.
    """
    return work_newest(outdated_sources(sources, index, alias_version=alias_version, alias_sha256=alias_sha256), limit)
