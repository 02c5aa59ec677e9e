"""Identifier mapping between sources and dated security universes."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import clean, clean_code, security_code
from tidemark.functions.times import to_utc
from tidemark.operators.ordered import first_of_group
from tidemark.operators.quality import require_columns

_UNIVERSE_TEXTS = {
    "CoName": "company_name",
    "Mkt": "market_code",
    "MktNm": "market_name",
    "ProdCat": "product_category",
}


def latest_by_ticker(df: DataFrame, code: str, ties: Sequence[str] = ()) -> DataFrame:
    """The newest valid record per normalised ticker, added as ``ticker``."""
    valid = df.withColumns(
        {
            "ticker": security_code(F.col(code)),
            "known_at": to_utc(F.col("known_at")),
            "observed_at": to_utc(F.col("observed_at")),
        }
    ).dropna(subset=["ticker", "known_at", "observed_at"])
    newest = [F.col("known_at").desc(), F.col("observed_at").desc()]
    return first_of_group(valid, ["ticker"], newest + [F.col(c).desc_nulls_last() for c in ties])


def identifier_map(filers: DataFrame, listings: DataFrame) -> DataFrame:
    """Latest identity per ticker from two sources, either of which may be absent.

    A combined row is available only when both contributing records were.
    """
    require_columns(filers, ["sec_code", "edinet_code", "filer_name", "known_at", "observed_at"], "filer identifier")
    require_columns(listings, ["Code", "CoName", "known_at", "observed_at"], "listing identifier")
    left = latest_by_ticker(filers, "sec_code", ["sec_code", "edinet_code", "filer_name"]).select(
        "ticker",
        clean_code(F.col("sec_code")).alias("sec_code"),
        clean_code(F.col("edinet_code")).alias("edinet_code"),
        clean_code(F.col("filer_name")).alias("edinet_filer_name"),
        F.col("known_at").alias("__known_l"),
        F.col("observed_at").alias("__observed_l"),
    )
    right = latest_by_ticker(listings, "Code", ["Code", "CoName"]).select(
        "ticker",
        clean_code(F.col("Code")).alias("jquants_code"),
        clean_code(F.col("CoName")).alias("jquants_company_name"),
        F.col("known_at").alias("__known_r"),
        F.col("observed_at").alias("__observed_r"),
    )
    return left.join(right, "ticker", "full_outer").select(
        "ticker",
        "sec_code",
        "jquants_code",
        "edinet_code",
        F.coalesce("jquants_company_name", "edinet_filer_name").alias("company_name"),
        "edinet_filer_name",
        "jquants_company_name",
        F.greatest("__known_l", "__known_r").alias("known_at"),
        F.greatest("__observed_l", "__observed_r").alias("observed_at"),
        (F.upper("sec_code") == F.upper("jquants_code")).alias("code_match"),
    )


def universe_snapshot(
    master: DataFrame,
    *,
    allowed_markets: Iterable | None = None,
    allowed_product_categories: Iterable | None = None,
) -> DataFrame:
    """One row per (date, ticker) of the dated master lists, last version first.

    Filters apply only when given; a row without the filtered field then drops out.
    """
    require_columns(master, ["Date", "Code", "known_at", "observed_at"], "listing master")

    def text(name: str) -> Column:
        return clean(F.col(name)) if name in master.columns else F.lit(None).cast("string")

    listed = master.select(
        F.substring(clean(F.col("Date")), 1, 10).alias("date"),
        security_code(F.col("Code")).alias("ticker"),
        clean(F.col("Code")).alias("jquants_code"),
        *[text(name).alias(output) for name, output in _UNIVERSE_TEXTS.items()],
        to_utc(F.col("known_at")).alias("known_at"),
        to_utc(F.col("observed_at")).alias("observed_at"),
    ).dropna(subset=["date", "ticker", "known_at", "observed_at"])
    if allowed_markets is not None:
        listed = listed.where(F.col("market_code").isin(*[str(x) for x in allowed_markets]))
    if allowed_product_categories is not None:
        listed = listed.where(F.col("product_category").isin(*[str(x) for x in allowed_product_categories]))
    newest = [F.col("known_at").desc(), F.col("observed_at").desc()]
    ties = [F.col(c).desc_nulls_last() for c in ("jquants_code", *_UNIVERSE_TEXTS.values())]
    return first_of_group(listed, ["date", "ticker"], newest + ties)


def filter_to_universe(df: DataFrame, universe: DataFrame, *, date: str = "date", ticker: str = "ticker") -> DataFrame:
    """Rows whose security was listed on that very date; later or earlier lists never stand in."""
    require_columns(df, [date, ticker], "frame")
    require_columns(universe, ["date", "ticker"], "universe")
    members = universe.select(F.col("date").alias("__day"), F.col("ticker").alias("__member"))
    # Keys become columns first: as expressions of the join they would be worked out at every comparison of its sort.
    keyed = df.withColumns({"__on": F.substring(F.col(date).cast("string"), 1, 10), "__of": security_code(F.col(ticker))})
    listed = (F.col("__on") == F.col("__day")) & (F.col("__of") == F.col("__member"))
    return keyed.join(members, listed, "left_semi").drop("__on", "__of")
