"""Views of the sample tables in the shapes the operators expect.

Each reads whole tables and stays lazy.  Stored tables carry typed stamps; the
list and disclosure adapters carry ISO text, as providers deliver it.
"""

from __future__ import annotations

import codecs
import io
import itertools
import zipfile
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import vocabulary as v
from tidemark.operators.aggregates import exact_mean
from tidemark.session import ship_package

LAG_DAYS = 84

# Element names of the sample fact tables: canonical aliases first, then names
# outside the alias table that the discovery report must find.
FACT_ELEMENTS = (
    "NetSales", "OperatingIncome", "OrdinaryIncome", "IncomeTaxes", "ProfitLoss", "Assets", "Liabilities",
    "NetAssets", "Equity", "CashAndDeposits", "BondsPayable", "Depreciation", "IssuanceOfBonds",
    "DividendsPayable", "BorrowingsOther", "TreasuryStockDisposal", "EffectiveTaxExpense", "NumberOfEmployees",
)
REPORT_ELEMENTS = (
    "DocumentTitleCoverPage", "FilingDateCoverPage", "NameOfIssuer", "SecurityCodeOfIssuer", "StockListing",
    "ListedOrOTC", "TotalNumberOfFilersAndJointHoldersCoverPage", "Name", "PurposeOfHolding",
    "TotalNumberOfStocksEtcHeld", "NumberOfResidualStocksHeld", "HoldingRatioOfShareCertificatesEtc",
    "HoldingRatioOfShareCertificatesEtcPerLastReport",
)
FACT_ROW_ORDER = ["row_a", "row_b", "row_c", "row_d", "row_e"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def padded(key: Column | str, width: int) -> Column:
    """A key as text, filled with zeros up to ``width`` and never shortened."""
    text = (F.col(key) if isinstance(key, str) else key).cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), "0")


def security(key: Column | str) -> Column:
    """A four-character code of a number from 0 to 36^4 - 1, one to one; beyond that it fails.

    Up to 9999 it is the number itself; larger ones are counted on in base 36 from A000, without codes of digits alone.
    """
    number = (F.col(key) if isinstance(key, str) else key).cast("long")
    code = F.when(number < 10_000, padded(number, 4)).otherwise(F.upper(F.conv((number - 10_000 + 10 * 36**3).cast("string"), 10, 36)))
    return F.when(F.length(code) == 4, code).otherwise(F.raise_error(F.concat(F.lit("no code left for "), number.cast("string"))))


def day_text(moment: Column | str) -> Column:
    return F.date_format(moment, "yyyy-MM-dd")


def stamp_text(moment: Column | str, clock: str = "06:00:00") -> Column:
    return F.concat(day_text(moment), F.lit(f"T{clock}Z"))


def at_six(day: Column | str) -> Column:
    """Six o'clock UTC of a date or timestamp column's day."""
    return F.to_date(day).cast("timestamp") + F.expr("INTERVAL 6 HOURS")


def later(name: str, days: int) -> Column:
    return F.date_add(F.to_date(name), days)


def pick(options: Sequence[str], key: Column) -> Column:
    """The option at position ``key`` modulo their number."""
    return F.element_at(F.array(*[F.lit(o) for o in options]), (key % len(options) + 1).cast("int"))


def _line_order() -> list[Column]:
    names = ("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_extendedprice")
    return [F.col(c).alias(alias) for c, alias in zip(names, FACT_ROW_ORDER)]


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars: supplier as security, quantity-weighted price, traded value."""
    daily = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", F.to_date("l_shipdate").alias("day")).agg(
        (F.sum("l_extendedprice") / F.sum("l_quantity")).alias("AdjC"), F.sum("l_extendedprice").alias("Va")
    )
    return daily.select(
        F.col("day").alias("Date"),
        F.concat(security("l_suppkey"), F.lit("0")).alias("Code"),
        "AdjC",
        "Va",
        at_six("day").alias("known_at"),
        at_six(later("day", LAG_DAYS)).alias("observed_at"),
    )


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly cross-section of customers: order value as factor, balance as size."""
    customers = table(spark, sf_dir, "customer")
    joined = table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    price = F.col("o_totalprice")
    return joined.groupBy(
        F.date_format("o_orderdate", "yyyy-MM").alias("date"),
        F.col("o_custkey").cast("string").alias("ticker"),
        F.col("c_mktsegment").alias("sector"),
        F.col("c_acctbal").alias("market_cap"),
    ).agg(exact_mean(price).alias("factor"), (exact_mean(price % 100) / 1000).alias("forward_return"))


def weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly portfolio weights of nations by order value."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    joined = table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    month = F.date_format("o_orderdate", "yyyy-MM").alias("date")
    ticker = F.concat_ws("-", F.col("c_nationkey").cast("string"), "c_mktsegment").alias("ticker")
    amounts = joined.groupBy(month, ticker).agg(F.sum("o_totalprice").alias("amount"))
    totals = amounts.groupBy("date").agg(F.sum("amount").alias("total"))
    return amounts.join(totals, "date").select("date", "ticker", (F.col("amount") / F.col("total")).alias("weight"))


def statement_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical metric rows: part as document, supplier decides the metric."""
    flag, line = F.col("l_returnflag"), F.col("l_linenumber")
    part_code = padded("l_partkey", 5)
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("S"), part_code).alias("doc_id"),
        F.when(flag == "R", "").otherwise(part_code).alias("stock_code"),
        pick(["120", "130", "140"], F.col("l_partkey")).alias("doc_type_code"),
        F.to_date("l_shipdate").alias("period_end"),
        at_six("l_shipdate").alias("known_at"),
        at_six(later("l_shipdate", 1)).alias("observed_at"),
        pick(v.RATIO_METRICS, F.col("l_suppkey")).alias("metric"),
        F.when(F.col("l_quantity") > 2, F.col("l_extendedprice")).alias("numeric_value"),
        F.when(flag == "A", "CurrentYear").when(flag == "N", "Prior1Year").alias("relative_year"),
        F.when(F.col("l_linestatus") == "O", "連結").when(line < 5, "NonConsolidated").alias("consolidation"),
        F.when(line < 3, "instant").when(line < 6, "duration").alias("period_type"),
        F.concat(F.lit("Context"), line.cast("string")).alias("context_id"),
        F.when(line < 6, "JPY").otherwise(" ").alias("unit"),
        *_line_order(),
    )


def ownership_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Holder rows: order as document, supplier as holder, discount and tax as ratios."""
    change = F.when(F.col("l_returnflag") == "A", F.col("l_discount") - F.col("l_tax"))
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("doc_id"),
        padded("l_orderkey", 6).alias("issuer_stock_code"),
        F.when(F.col("l_linestatus") == "F", day_text("l_shipdate")).alias("filing_date"),
        at_six("l_shipdate").alias("known_at"),
        at_six(later("l_shipdate", 2)).alias("observed_at"),
        F.concat(F.lit("Holder "), F.col("l_suppkey").cast("string")).alias("holder_name"),
        F.col("l_discount").alias("holding_ratio"),
        F.when(F.col("l_quantity") > 5, F.col("l_tax")).alias("previous_holding_ratio"),
        change.alias("holding_ratio_change"),
        *_line_order(),
    )


def forecast_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast disclosures: nation and segment as company, order year as fiscal year."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    joined = table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    price, status = F.col("o_totalprice"), F.col("o_orderstatus")
    return joined.select(
        F.concat(
            padded("c_nationkey", 3), F.substring("c_mktsegment", 1, 1), F.lit("0")
        ).alias("Code"),
        F.concat(F.year("o_orderdate").cast("string"), F.lit("-03-31")).alias("CurFYEn"),
        day_text("o_orderdate").alias("DiscDate"),
        padded("o_orderkey", 10).alias("DiscNo"),
        price.alias("FSales"),
        F.when(F.col("o_orderpriority") != "5-LOW", price * 0.1).alias("FOP"),
        F.when(status == "F", price * 0.08).alias("FOdP"),
        F.when(status != "O", price - 250000).alias("FNP"),
        F.when(status != "P", F.floor(price / 100000)).cast("double").alias("FEPS"),
        stamp_text("o_orderdate", "06:30:00").alias("known_at"),
        stamp_text(later("o_orderdate", LAG_DAYS)).alias("observed_at"),
    )


def printed_value() -> Column:
    """Statement numbers as printed: triangles, brackets, percents, dashes."""
    flag, part = F.col("l_returnflag"), F.col("l_partkey").cast("string")
    line = padded("l_linenumber", 3)
    return (
        F.when(flag == "A", F.concat(F.lit("△1,"), line))
        .when(flag == "N", F.concat(F.lit(" ("), part, F.lit(")　")))
        .when(F.col("l_linenumber") < 3, F.concat(part, F.lit("%")))
        .when(F.col("l_linenumber") < 5, F.lit("－"))
        .otherwise(F.concat(F.lit("1.5e"), F.col("l_linenumber").cast("string")))
    )


def statement_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long fact rows with Japanese number notation: part as document."""
    line = F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("S"), F.col("l_partkey").cast("string")).alias("doc_id"),
        F.concat(F.lit("jp_cor:"), pick(FACT_ELEMENTS, F.col("l_suppkey") + F.col("l_partkey"))).alias("element_id"),
        F.concat(F.lit("item "), F.col("l_returnflag")).alias("item_name"),
        F.concat(F.lit("Context"), line.cast("string")).alias("context_id"),
        F.when(line < 6, "JPY").otherwise("　").alias("unit"),
        F.when(F.col("l_returnflag") == "R", " ").otherwise(F.lit("filer")).alias("filer_name"),
        F.when(F.col("l_linestatus") == "O", day_text("l_shipdate")).alias("submit_datetime"),
        printed_value().alias("value"),
        *_line_order(),
    )


def report_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long ownership facts: order as document, line number as holder context."""
    line = F.col("l_linenumber")
    percent = F.round(F.col("l_discount") * 100).cast("int").cast("string")
    element = pick(REPORT_ELEMENTS, F.col("l_suppkey") + F.col("l_partkey"))
    value = (
        F.when(element == "DocumentTitleCoverPage", F.when(line < 4, "変更報告書").otherwise("訂正報告書"))
        .when(element.startswith("HoldingRatio"), F.concat(percent, F.lit("％")))
        .when(element.startswith("TotalNumber"), F.concat(F.lit("1,"), F.lpad(percent, 3, "0")))
        .when(F.col("l_returnflag") == "R", "　")
        .otherwise(F.concat(F.lit(" text "), F.col("l_partkey").cast("string")))
    )
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("doc_id"),
        F.when(F.col("l_orderkey") < 5000, "350").otherwise("360").alias("doc_type_code"),
        F.concat(F.lit("jp_lvh:"), element).alias("element_id"),
        F.when(line < 7, F.concat(F.lit("Holder"), line.cast("string"))).alias("context_id"),
        value.alias("value"),
        day_text("l_shipdate").alias("submit_datetime"),
        *_line_order(),
    )


def document_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed documents: one per order, the priority decides the document type."""
    priority = F.col("o_orderpriority")
    code = (
        F.when(priority == "1-URGENT", "120")
        .when(priority == "2-HIGH", "350")
        .when(priority == "3-MEDIUM", "180")
        .when(priority == "4-NOT SPECIFIED", "220")
        .otherwise("999")
    )
    operated = F.concat(day_text(later("o_orderdate", 1)), F.lit("T11:00:00"))
    return table(spark, sf_dir, "orders").select(
        day_text("o_orderdate").alias("file_date"),
        F.col("o_orderkey").alias("seq_number"),
        F.concat(F.lit("S"), padded("o_orderkey", 9)).alias("doc_id"),
        code.alias("doc_type_code"),
        F.when(F.col("o_orderstatus") == "P", "0").otherwise("1").alias("csv_flag"),
        F.concat(day_text("o_orderdate"), F.lit(" 10:00")).alias("submit_datetime"),
        F.when(F.col("o_orderstatus") == "F", operated).alias("operation_datetime"),
        stamp_text("o_orderdate", "01:00:00").alias("known_at"),
        stamp_text(later("o_orderdate", 3)).alias("observed_at"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"),
    )


def listing_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated security lists: suppliers present in each shipping month."""
    suppliers = table(spark, sf_dir, "supplier")
    seen = table(spark, sf_dir, "lineitem").groupBy(
        "l_suppkey", F.date_format("l_shipdate", "yyyy-MM").alias("month"), "l_linestatus"
    ).agg(F.max("l_shipdate").alias("last_ship"))
    nation = F.col("s_nationkey").cast("string")
    return seen.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.concat("month", F.lit("-01T00:00:00")).alias("Date"),
        F.concat(security("s_suppkey"), F.lit("0")).alias("Code"),
        F.concat("s_name", F.lit(" "), "l_linestatus").alias("CoName"),
        F.concat(F.lit("0"), nation).alias("Mkt"),
        F.concat(F.lit("Market "), nation).alias("MktNm"),
        F.when(F.col("s_acctbal") > 0, "011").otherwise(" ").alias("ProdCat"),
        at_six("last_ship").alias("known_at"),
        at_six(later("last_ship", LAG_DAYS)).alias("observed_at"),
    )


_TABLE_HEADERS = {1: "Element ID\tContext ID\tValue\tItem Name", 2: "要素ID\tコンテキストID\t値"}
_CODECS = ("utf-16", "utf-16-le", "utf-16-be")


def _package(lines: pa.Table) -> pa.Table:
    """One ZIP of a supplier's lines: a table per line number, in several encodings; every fifth supplier's is unusable."""
    supplier, out = lines.column("l_suppkey")[0].as_py(), io.BytesIO()
    rows = sorted(zip(*(lines.column(n).to_pylist() for n in ("l_linenumber", "l_orderkey", "l_partkey", "l_extendedprice", "l_returnflag"))))
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("PublicDoc/readme.txt", b"no table")
        for number, group in itertools.groupby(rows, key=lambda r: r[0]):
            named = number % 2 == 1
            header = _TABLE_HEADERS[1 if named else 2]
            text = [header.replace("Value", "Amount") if supplier % 10 == 3 and number == 5 else header]
            for _, order, part, price, flag in group:
                text.append(f'jp:{order}\t"{flag}\tx"\t{price:.2f}' + (f'\t"part ""{part}""\n"' if named else ""))
            codec = _CODECS[number % 3]
            mark = b"" if codec != "utf-16-be" else codecs.BOM_UTF16_BE
            archive.writestr(f"XBRL_TO_CSV/line{number}.csv", mark + "\r\n".join(text).encode(codec))
    content = out.getvalue()
    if supplier % 10 == 7:
        content = content[: len(content) // 2]
    return pa.table({"path": [f"landed/S{supplier}.zip"], "content": pa.array([content], pa.binary())})


def fact_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filing packages as landed, one per supplier: ``path, content``."""
    ship_package(spark)
    lines = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_linenumber", "l_orderkey", "l_partkey", F.col("l_extendedprice").cast("double").alias("l_extendedprice"), "l_returnflag"
    )
    return lines.groupBy("l_suppkey").applyInArrow(_package, "path string, content binary")


def research_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Monthly features, labels, exposures and listing master over customers with orders in a month.

    A seventh of the features becomes known too late, furniture makers' outcomes are known at the decision already, and
    customers with orders of low priority only are not listed.
    """
    customers = table(spark, sf_dir, "customer")
    joined = table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    price, month = F.col("o_totalprice"), F.trunc(F.to_date("o_orderdate"), "month")
    monthly = joined.groupBy(
        month.alias("month"), F.col("o_custkey"), F.col("c_mktsegment").alias("sector"), F.col("c_acctbal").alias("market_cap")
    ).agg(exact_mean(price).alias("value"), (exact_mean(price % 100) / 1000).alias("forward_return"), F.max(F.col("o_orderpriority") != "5-LOW").alias("listed"))
    monthly = monthly.withColumns({"date": day_text("month"), "ticker": security("o_custkey")})
    late = F.when(F.col("o_custkey") % 7 == 0, 40).otherwise(0)
    features = monthly.select(
        "date", "ticker", F.lit("order_value").alias("feature"), "value",
        at_six(F.date_add("month", late)).alias("known_at"), at_six("month").alias("observed_at"),
    )
    outcome = F.when(F.col("sector") == "FURNITURE", F.col("month")).otherwise(F.add_months("month", 1))
    labels = monthly.select("date", "ticker", "forward_return", at_six("month").alias("decision_known_at"), at_six(outcome).alias("outcome_known_at"))
    exposures = monthly.select("date", "ticker", "sector", "market_cap")
    master = monthly.where("listed").select(
        F.col("date").alias("Date"), F.concat("ticker", F.lit("0")).alias("Code"), at_six("month").alias("known_at"), at_six("month").alias("observed_at")
    )
    return features, labels, exposures, master
