"""Statistics-catalog payloads: an object or a list of objects with open nested fields."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType, _parse_datatype_string

from tidemark import vocabulary as v
from tidemark.functions.times import to_utc
from tidemark.operators.normalize import split_rejects

_TABLES = "GET_STATS_LIST.DATALIST_INF.TABLE_INF"


def dotted_leaves(struct: StructType, path: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    """Paths of all leaf fields of a nested struct."""
    leaves: list[tuple[str, ...]] = []
    for field in struct.fields:
        here = (*path, field.name)
        if isinstance(field.dataType, StructType):
            leaves += dotted_leaves(field.dataType, here)
        else:
            leaves.append(here)
    return leaves


def _reach(column: Column, path: tuple[str, ...]) -> Column:
    return reduce(lambda c, name: c.getField(name), path, column)


def catalog_rejects(payloads: DataFrame) -> DataFrame:
    """Payloads that are not JSON or lack the catalog's object, with ``error``; they give no tables."""
    readable = F.try_parse_json("payload").isNotNull()
    listed = F.get_json_object("payload", f"$.{_TABLES.rpartition('.')[0]}").isNotNull()
    return split_rejects(payloads, {"unreadable payload": ~readable, "no catalog object": ~listed})[1]


def flatten_tables(payloads: DataFrame, table_schema: StructType | str, run_id: str) -> DataFrame:
    """One row per catalog table, nested fields as dotted columns.

    ``payloads`` has ``search_term, payload, observed_at, payload_sha256``.  A
    lone object reads as a list of one; a payload without tables gives no rows.
    Fields absent from a payload are null, so mixed payloads share one schema.
    """
    schema = _parse_datatype_string(table_schema) if isinstance(table_schema, str) else table_schema
    body = F.get_json_object("payload", f"$.{_TABLES}")
    tables = payloads.withColumn("__table", F.explode_outer(F.from_json(body, ArrayType(schema))))
    tables = tables.where(F.col("__table").isNotNull())
    observed = to_utc(F.col("observed_at"))
    return tables.select(
        "search_term",
        *[_reach(F.col("__table"), path).alias(".".join(path)) for path in dotted_leaves(schema)],
        F.lit(v.SOURCE_CATALOG).alias("source_id"),
        F.lit("stats_catalog").alias("dataset"),
        observed.alias("observed_at"),
        observed.alias("known_at"),
        "payload_sha256",
        F.lit(run_id).alias("ingestion_run_id"),
    )


def infer_table_schema(payloads: DataFrame) -> StructType:
    """Merged schema of all tables in the payloads, found by Spark's own inference over variants.

    One distributed pass.  Numbers and texts of one field widen to text.
    """
    body = F.get_json_object("payload", f"$.{_TABLES}")
    listed = F.when(F.ltrim(body).startswith("{"), F.concat(F.lit("["), body, F.lit("]"))).otherwise(body)
    elements = payloads.select(F.explode(F.from_json(listed, "array<string>")).alias("value"))
    found = elements.agg(F.schema_of_variant_agg(F.try_parse_json("value")).alias("s")).first()["s"]
    schema = _parse_datatype_string(found.replace("OBJECT<", "STRUCT<")) if found and found.startswith("OBJECT<") else StructType()
    return _as_text(schema)


def _as_text(kind: DataType) -> DataType:
    if isinstance(kind, StructType):
        out = StructType()
        for field in kind.fields:
            out = out.add(field.name, _as_text(field.dataType))
        return out
    return kind if isinstance(kind, ArrayType) else StringType()
