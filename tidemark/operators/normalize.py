"""From long fact tables to canonical metric and ownership tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import vocabulary as v
from tidemark.functions.numbers import ratio_number, statement_number
from tidemark.functions.text import clean, local_name
from tidemark.operators.aggregates import earliest, first_present, present
from tidemark.operators.dimensions import metric_aliases
from tidemark.operators.quality import require_columns


def split_rejects(df: DataFrame, checks: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with an ``error`` text naming the first failed check)."""
    failed = F.coalesce(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(text)) for text, bad in checks.items()])
    marked = df.withColumn("error", failed)
    return marked.where(F.col("error").isNull()).drop("error"), marked.where(F.col("error").isNotNull())


def split_facts(facts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(facts of a document, rejected facts that name none), the latter with their ``error``."""
    return split_rejects(facts, {"no doc_id": F.col("doc_id").isNull()})


def financial_metrics(
    facts: DataFrame,
    run_id: str,
    *,
    aliases: DataFrame | None = None,
    source_key: Column | None = None,
    row_order: Sequence[str] = (),
) -> DataFrame:
    """One row per (fact, metric) whose element is an alias of a canonical metric.

    Identity texts are the first non-blank of the whole document, also when
    they stand on facts that match no alias.  ``split_facts`` lists the facts
    that name no document.
    """
    require_columns(facts, ["doc_id", "element_id", "value", "context_id"], "financial fact")
    facts, _ = split_facts(facts)
    aliases = metric_aliases(facts.sparkSession) if aliases is None else aliases
    texts = [name for name in v.STATEMENT_TEXTS if name in facts.columns]
    documents = facts.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("__facts"), *[first_present(facts, name, row_order) for name in texts]
    )
    documents = documents.drop("__facts").withColumns(
        {name: F.lit(None).cast("string") for name in v.STATEMENT_TEXTS if name not in texts}
    )
    matched = (
        facts.select(
            "doc_id",
            local_name(F.col("element_id")).alias("local_name"),
            *[present(facts, name).alias(name) for name in v.FACT_TEXTS],
            clean(F.col("value")).alias("raw_value"),
            (F.lit(None).cast("string") if source_key is None else source_key).alias("source_parquet_key"),
        )
        .join(aliases, "local_name")
        .withColumn("numeric_value", statement_number(F.col("raw_value")))
    )
    return (
        matched.join(documents, "doc_id")
        .withColumns(
            {
                "source_id": F.lit(v.SOURCE_FILINGS),
                "dataset": F.lit("financial_metrics"),
                "ingestion_run_id": F.lit(run_id),
            }
        )
        .select(*v.METRIC_COLUMNS)
    )


def ownership_summary(
    facts: DataFrame,
    run_id: str,
    *,
    source_key: Column | None = None,
    row_order: Sequence[str] = (),
) -> DataFrame:
    """One row per substantial holder context; a document without any keeps one row of nulls.

    Facts reduce to one row per (document, context, field) before the fields
    become columns; of several aliases of a field the first row wins.
    ``split_facts`` lists the facts that name no document.
    """
    require_columns(facts, ["doc_id", "doc_type_code", "element_id", "context_id", "value"], "ownership fact")
    facts, _ = split_facts(facts)
    local, value = local_name(F.col("element_id")), clean(F.col("value"))
    key = F.lit(None).cast("string") if source_key is None else source_key

    def field_of(elements: Mapping[str, Sequence[str]]) -> Column:
        pairs = [F.lit(x) for name, names in elements.items() for element in names for x in (element, name)]
        return F.try_element_at(F.create_map(*pairs), local)

    def columns_of(elements: Mapping[str, Sequence[str]]) -> list[Column]:
        return [F.max(F.when(F.col("__field") == name, F.col("__first.value"))).alias(name) for name in elements]

    texts = [name for name in v.REPORT_TEXTS if name in facts.columns]
    by_field = facts.groupBy("doc_id", field_of(v.OWNERSHIP_DOCUMENT_ELEMENTS).alias("__field")).agg(
        earliest(value, row_order).alias("__first"),
        *[earliest(present(facts, name), row_order).alias(name) for name in texts],
        F.min(key).alias("source_parquet_key"),
    )
    documents = by_field.groupBy("doc_id").agg(
        *[F.min(name)["value"].alias(v.REPORT_TEXTS[name]) for name in texts],
        *columns_of(v.OWNERSHIP_DOCUMENT_ELEMENTS),
        F.min("source_parquet_key").alias("source_parquet_key"),
    )
    documents = documents.withColumns(
        {output: F.lit(None).cast("string") for name, output in v.REPORT_TEXTS.items() if name not in texts}
    )
    title = F.coalesce("document_title", "doc_description", F.lit(""))
    documents = documents.withColumns(
        {
            "source_id": F.lit(v.SOURCE_FILINGS),
            "dataset": F.lit("ownership_summary"),
            "is_change_report": title.contains(v.CHANGE_REPORT_MARK),
            "is_correction": F.coalesce(F.col("doc_type_code") == v.CORRECTION_TYPE_CODE, F.lit(False))
            | title.contains(v.CORRECTION_MARK),
            "issuer_stock_code": F.substring("issuer_security_code", 1, 4),
            "total_filers_joint_holders": ratio_number(F.col("total_filers_joint_holders")),
            "ingestion_run_id": F.lit(run_id),
        }
    )

    element = F.when(clean(F.col("element_id")).isNotNull(), F.col("element_id"))
    context_fields = (
        facts.withColumn("__field", field_of(v.OWNERSHIP_HOLDER_ELEMENTS))
        .where(F.col("__field").isNotNull())
        .groupBy("doc_id", "context_id", "__field")
        .agg(earliest(value, row_order).alias("__first"), F.collect_set(element).alias("__elements"))
    )
    # At most one list of element ids per field reaches a context.
    contexts = context_fields.groupBy("doc_id", "context_id").agg(
        *columns_of(v.OWNERSHIP_HOLDER_ELEMENTS),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("__elements")))).alias("evidence_element_ids"),
    )
    holders = contexts.where(F.coalesce(*v.SUBSTANTIAL_FIELDS).isNotNull()).select(
        "doc_id",
        clean(F.col("context_id")).alias("holder_context_id"),
        "holder_name",
        "purpose",
        "important_proposal",
        *[F.col(name).alias(f"{name}_raw") for name in v.PARSED_FIELDS],
        *[ratio_number(F.col(name)).alias(name) for name in v.PARSED_FIELDS],
        "evidence_element_ids",
    )
    # A document without holders keeps one row.
    found = documents.join(holders, "doc_id", "left").withColumns(
        {
            "holding_ratio_change": F.col("holding_ratio") - F.col("previous_holding_ratio"),
            "evidence_element_ids": F.coalesce("evidence_element_ids", F.array().cast("array<string>")),
        }
    )
    return found.select(*v.OWNERSHIP_COLUMNS)
