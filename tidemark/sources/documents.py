"""Document-list payloads of the filings provider."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import vocabulary as v
from tidemark.functions.text import content_hash, parsed_once
from tidemark.functions.times import jst_text, known_from_filing, to_utc
from tidemark.operators.changes import record_hash
from tidemark.operators.normalize import split_rejects
from tidemark.operators.quality import refused

_NUMERIC = ("seqNumber",)
# All fields are read as text: a number that comes as text must not be lost.
_RECORD = ", ".join(f"{name}: STRING" for name in v.FILING_FIELDS)
RESULTS_TYPE = f"ARRAY<STRUCT<{_RECORD}>>"
RESPONSE_SCHEMA = (
    f"metadata STRUCT<status: STRING, message: STRING, processDateTime: STRING>, results {RESULTS_TYPE}"
)


def _failures() -> dict[str, Column]:
    """Conditions on a parsed payload under which none of its records is read."""
    status = F.coalesce(F.col("__body.metadata.status"), F.lit(""))
    unreadable = F.col("__body.metadata").isNull() & F.col("__body.results").isNull()
    number = F.exists(
        F.coalesce(F.col("__body.results"), F.array().cast(RESULTS_TYPE)),
        lambda r: r["seqNumber"].isNotNull() & r["seqNumber"].try_cast("bigint").isNull(),
    )
    return {"unreadable payload": unreadable, "status is not 200": ~status.isin("", "200"), "bad seqNumber": number}


def _parsed(payloads: DataFrame) -> DataFrame:
    parsed = parsed_once(payloads, "__body", "payload", RESPONSE_SCHEMA)
    return parsed.withColumn("payload_sha256", content_hash(F.col("payload"))).drop("payload")


def document_list_rejects(payloads: DataFrame) -> DataFrame:
    """The payloads that give no rows, with ``error``; together with those read they are all payloads."""
    return split_rejects(_parsed(payloads), _failures())[1].drop("__body")


def read_document_list(payloads: DataFrame, run_id: str, *, strict: bool = True) -> DataFrame:
    """One typed row per listed document, with derived availability and hashes.

    ``payloads`` has ``file_date, payload, observed_at, source_url``.  A payload that cannot be read, whose status is
    not 200 or that has a bad number fails the job that reads it; without ``strict`` it gives no rows here and one in ``document_list_rejects``.
    """
    parsed, failures = _parsed(payloads), _failures()
    if strict:
        parsed = parsed.where(refused(failures, "document list", F.lit(True)))
    else:
        parsed, _ = split_rejects(parsed, failures)
    # The outer form keeps Spark from testing the parsed array before exploding it, a second parse.
    records = parsed.withColumn("r", F.explode_outer("__body.results")).where(F.col("r").isNotNull())
    observed = to_utc(F.col("observed_at"))
    processed = F.col("__body.metadata.processDateTime")
    code = F.col("r.secCode")
    return records.select(
        F.lit(v.SOURCE_FILINGS).alias("source_id"),
        F.lit("document_list").alias("dataset"),
        "file_date",
        *[
            (F.col(f"r.{field}").cast("bigint") if field in _NUMERIC else F.col(f"r.{field}")).alias(name)
            for field, name in v.FILING_FIELDS.items()
        ],
        F.when(F.length(code) >= 4, F.substring(code, 1, 4)).alias("stock_code"),
        known_from_filing(F.col("r.submitDateTime"), F.col("r.opeDateTime"), observed, processed).alias("known_at"),
        observed.alias("observed_at"),
        jst_text(processed).alias("source_process_at"),
        "source_url",
        "payload_sha256",
        record_hash(list(v.FILING_FIELDS), "r.", _NUMERIC).alias("record_sha256"),
        F.lit(run_id).alias("ingestion_run_id"),
    )
