"""Registry of runnable queries, each with its SQL check where one exists."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, TimestampType

from tidemark.functions.times import iso_z
from tidemark.plans.oracle_views import VIEWS
from tidemark.session import configure

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Build
    sql: str | None


REGISTRY: dict[str, Query] = {}


def with_views(sql: str) -> str:
    """Prefix the shared views a statement mentions, directly or through other views."""
    needed: list[str] = []

    def need(text: str) -> None:
        for name, body in VIEWS.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                need(body)
                if name not in needed:
                    needed.append(name)

    need(sql)
    if not needed:
        return sql.strip()
    heads = ",\n".join(f"{name} AS (\n{VIEWS[name].strip()}\n)" for name in needed)
    return f"WITH {heads}\n{sql.strip()}"


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    """Register a query; the session settings are applied before its plan is built."""

    def register(build: Build) -> Build:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(configure(spark), sf_dir)

        REGISTRY[name] = Query(name, run, with_views(sql) if sql else None)
        return build

    return register


def report(df: DataFrame, places: int | None = None) -> DataFrame:
    """Result columns in portable types: stamps as ISO text, booleans as text, doubles rounded."""
    columns: list[Column] = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, TimestampType):
            c = iso_z(c)
        elif isinstance(field.dataType, BooleanType):
            c = c.cast("string")
        elif places is not None and isinstance(field.dataType, DoubleType):
            c = F.round(c, places)
        columns.append(c.alias(field.name))
    return df.select(*columns)
