"""Small fixed tables, built on the JVM side so that the planner knows their size."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import vocabulary as v


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, (list, tuple)):
        return f"array({', '.join(map(_literal, value))})"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (int, float)):
        return str(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def fixed_table(spark: SparkSession, columns: Sequence[str], rows: Iterable[Sequence]) -> DataFrame:
    values = ", ".join("(" + ", ".join(_literal(x) for x in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(columns)})")


def metric_aliases(spark: SparkSession, aliases: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """``local_name, metric``; one local name may feed several metrics."""
    pairs = [(name, metric) for metric, names in (aliases or v.METRIC_ALIASES).items() for name in names]
    return fixed_table(spark, ["local_name", "metric"], pairs)


def document_rules(spark: SparkSession) -> DataFrame:
    """``doc_type_code, category, priority, download_csv`` per type of filing that has a use."""
    rows = [(code, name, rank, fetched) for name, (codes, rank, fetched) in v.DOCUMENT_RULES.items() for code in codes]
    return fixed_table(spark, ["doc_type_code", "category", "priority", "download_csv"], rows)


def feature_catalog(spark: SparkSession) -> DataFrame:
    """``feature, higher_is_better, source_datasets`` (a list) and ``description`` of every built feature."""
    return fixed_table(spark, ["feature", "higher_is_better", "source_datasets", "description"], v.FEATURE_CATALOG)


def orient_features(features: DataFrame) -> DataFrame:
    """Add ``oriented_value``: the value with its sign set so that higher is better."""
    catalog = feature_catalog(features.sparkSession).select("feature", "higher_is_better")
    signed = F.when(F.col("higher_is_better"), F.col("value")).otherwise(-F.col("value"))
    return features.join(catalog, "feature").withColumn("oriented_value", signed)


def alias_fingerprint(aliases: DataFrame) -> DataFrame:
    """One row ``sha256``: content hash of an alias table, independent of row order."""
    line = F.concat_ws("\t", "metric", "local_name")
    return aliases.agg(F.sha2(F.concat_ws("\n", F.sort_array(F.collect_set(line))), 256).alias("sha256"))
