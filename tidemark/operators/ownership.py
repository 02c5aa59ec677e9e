"""Ownership-change feature per filing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import finite
from tidemark.functions.text import clean
from tidemark.functions.times import to_utc
from tidemark.operators.aggregates import first_present, ranking
from tidemark.operators.quality import require_columns

FEATURE = "ownership_ratio_change"


def ownership_features(ownership: DataFrame, row_order: Sequence[str] = ()) -> DataFrame:
    """The holder with the largest absolute ratio change of each document, sign kept.

    A reported change is used as is; otherwise it is current minus previous.
    Documents without a usable change, ticker or stamp emit nothing.
    """
    require_columns(
        ownership,
        ["doc_id", "issuer_stock_code", "known_at", "observed_at", "holding_ratio", "previous_holding_ratio"],
        "ownership",
    )
    derived = finite(F.col("holding_ratio")) - finite(F.col("previous_holding_ratio"))
    if "holding_ratio_change" in ownership.columns:
        change = F.coalesce(finite(F.col("holding_ratio_change")), derived)
    else:
        change = derived
    holder = F.col("holder_name") if "holder_name" in ownership.columns else F.lit(None).cast("string")

    rows = ownership.withColumns({"__change": change, "__holder": clean(holder)})
    largest_first = ranking([-F.abs("__change"), *row_order], F.col("__change"), F.col("__holder"))
    chosen = F.min_by(
        F.struct("__change", "__holder"), F.when(F.col("__change").isNotNull(), largest_first)
    ).alias("__chosen")
    texts = [first_present(ownership, c, row_order) for c in ("issuer_stock_code", "known_at", "observed_at")]
    if "filing_date" in ownership.columns:
        texts.append(first_present(ownership, "filing_date", row_order))
    documents = rows.groupBy("doc_id").agg(*texts, chosen)

    known_day = F.substring(F.col("known_at").cast("string"), 1, 10)
    filed = F.coalesce(F.col("filing_date").cast("string"), known_day) if "filing_date" in ownership.columns else known_day
    return documents.select(
        filed.alias("date"),
        F.col("issuer_stock_code").alias("ticker"),
        F.lit(FEATURE).alias("feature"),
        F.col("__chosen.__change").alias("value"),
        to_utc(F.col("known_at")).alias("known_at"),
        to_utc(F.col("observed_at")).alias("observed_at"),
        clean(F.col("doc_id")).alias("source_doc_id"),
        F.col("__chosen.__holder").alias("holder_name"),
    ).dropna(subset=["date", "ticker", "value", "known_at", "observed_at"])
