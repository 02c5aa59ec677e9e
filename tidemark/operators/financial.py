"""Statement ratios per filing from canonical metrics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import vocabulary as v
from tidemark.functions.numbers import number, safe_ratio
from tidemark.functions.text import clean, is_consolidated, is_current_year
from tidemark.functions.times import to_utc
from tidemark.operators.aggregates import earliest, present, ranking
from tidemark.operators.quality import require_columns

_DOCUMENT_TEXTS = ("stock_code", "period_end", "known_at", "observed_at")


def _optional(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def preference(df: DataFrame) -> list[Column]:
    """Sort keys of a metric row: current year, consolidated, fitting period type come first."""
    year = F.when(is_current_year(_optional(df, "relative_year")), 0).otherwise(1)
    scope_text = _optional(df, "consolidation")
    scope = F.when(is_consolidated(scope_text), 0).when(clean(scope_text).isNull(), 1).otherwise(2)
    span = F.lower(clean(_optional(df, "period_type")))
    metric = F.col("metric")

    def fit(labels):
        return F.when(span.isin(*labels), 0).when(span.isNull(), 1).otherwise(2)

    period = (
        F.when(metric.isin(*v.BALANCE_METRICS), fit(v.INSTANT_LABELS))
        .when(metric.isin(*v.FLOW_METRICS), fit(v.DURATION_LABELS))
        .otherwise(1)
    )
    return [year, scope, period]


def picked_metrics(metrics: DataFrame, row_order: Sequence[str] = ()) -> DataFrame:
    """One row per document: its identity texts and the preferred value of each ratio input.

    Rows reduce to (document, metric) first, so the wide step sees at most one
    row per metric; ``row_order`` decides between rows of equal preference.
    """
    value = number(F.col("numeric_value"))
    choice = F.min_by(value, F.when(value.isNotNull(), ranking([*preference(metrics), *row_order], value)))
    per_metric = metrics.groupBy("doc_id", "metric").agg(
        choice.alias("__value"),
        *[earliest(present(metrics, name), row_order).alias(name) for name in _DOCUMENT_TEXTS],
    )
    return per_metric.groupBy("doc_id").agg(
        *[F.min(name)["value"].alias(name) for name in _DOCUMENT_TEXTS],
        *[F.max(F.when(F.col("metric") == m, F.col("__value"))).alias(m) for m in v.RATIO_METRICS],
    )


def _ratios() -> dict[str, Column]:
    c = {name: F.col(name) for name in v.RATIO_METRICS}
    equity = F.coalesce(c["shareholders_equity"], c["net_assets"])
    parts = [c[name] for name in v.DEBT_COMPONENTS]
    some_part = reduce(lambda a, b: a | b, [p.isNotNull() for p in parts])
    part_sum = reduce(lambda a, b: a + b, [F.coalesce(p, F.lit(0.0)) for p in parts])
    debt_parts = F.when(some_part, part_sum)
    debt = F.coalesce(c["interest_bearing_debt"], debt_parts)
    cash = c["cash_and_deposits"]
    capital = equity + debt - cash
    tax_rate = safe_ratio(c["income_tax"], c["pretax_income"])
    after_tax = F.when(tax_rate.between(0, 1), c["operating_income"] * (1 - tax_rate))
    buyback = F.abs(c["treasury_stock_purchase_cash_flow"])
    free_cash = c["operating_cash_flow"] - F.abs(c["capital_expenditure"])
    return {
        "interest_bearing_debt_components_proxy": debt_parts,
        "roe": safe_ratio(c["net_income"], equity),
        "roic_pre_tax_proxy": safe_ratio(c["operating_income"], capital),
        "roic": safe_ratio(after_tax, capital),
        "buyback_cash_outflow": buyback,
        "buyback_to_equity": F.when(equity > 0, buyback / equity),
        "fcf_conversion": safe_ratio(free_cash, c["net_income"]),
        "net_debt": c["interest_bearing_debt"] - cash,
        "net_debt_components_proxy": F.when(c["interest_bearing_debt"].isNull(), debt_parts - cash),
    }


def financial_features(metrics: DataFrame, row_order: Sequence[str] = ()) -> DataFrame:
    """Nine ratios per document in the common feature form.

    A feature whose inputs are missing is not emitted; nothing is inferred.
    """
    require_columns(metrics, ["doc_id", *_DOCUMENT_TEXTS, "metric", "numeric_value"], "financial metric")
    documents = picked_metrics(metrics, row_order).dropna(subset=list(_DOCUMENT_TEXTS))
    cells = [F.struct(F.lit(name).alias("feature"), value.alias("value")) for name, value in _ratios().items()]
    long = documents.select(
        F.col("period_end").cast("string").alias("date"),
        F.col("stock_code").alias("ticker"),
        F.inline(F.array(*cells)),
        to_utc(F.col("known_at")).alias("known_at"),
        to_utc(F.col("observed_at")).alias("observed_at"),
        F.col("doc_id").alias("source_doc_id"),
    )
    return long.where(F.col("value").isNotNull())
