"""Forecast revisions with Spark's state store: one entry per company and fiscal year, read and written by key.

A batch touches the state of the keys it holds and nothing else.  Features come out as if all disclosures had arrived in
one batch, or the query fails: a disclosure that is older than what its key has reached and was not seen before would have
changed features already written.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import Row

from tidemark.operators.forecast import KEY, METRICS, PREVIOUS, STATE_COLUMNS, disclosures, emit_revisions
from tidemark.session import ship_package

_MEASURES = ", ".join(f"{m} double" for m in METRICS)
_STATE = f"{_MEASURES}, last_known_us long, last_disc_no string"
_TAKEN = f"observed_us long, disc_no string, disc_date string, {_MEASURES}"
_TAKEN_NAMES = ("observed_us", "disc_no", "disc_date", *METRICS)
_OUTPUT = (  # what emit_revisions reads
    f"ticker string, cur_fy_end string, known_us long, {_TAKEN}, "
    + ", ".join(f"{PREVIOUS[m]} double" for m in METRICS) + ", __seen boolean"
)
_emitted = Row(*[part.split()[0] for part in _OUTPUT.split(", ")])


def _rank(values: tuple) -> tuple:
    """Ascending order with missing values first, as the batch operator has it."""
    return tuple((value is not None, value if value is not None else 0) for value in values)


class RevisionState(StatefulProcessor):
    """Last explicit forecasts of a key, the stamp it has reached, and the disclosure taken at each stamp."""

    def __init__(self, late: str = "fail") -> None:
        if late not in ("fail", "skip"):
            raise ValueError("late is 'fail' or 'skip'")
        self._late = late

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._forecast = handle.getValueState("forecast", _STATE)
        self._taken = handle.getMapState("taken", "known_us long", _TAKEN)

    def close(self) -> None:
        pass

    def _is_late(self, known: int, values: tuple) -> bool:
        """Whether a batch over all disclosures would have taken this one at its stamp."""
        if not self._taken.containsKey((known,)):
            return True
        return _rank(values) < _rank(tuple(self._taken.getValue((known,))))

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        offered: dict[int, tuple] = {}
        for row in rows:
            values = tuple(row[name] for name in _TAKEN_NAMES)
            held = offered.get(row.known_us)
            if held is None or _rank(values) < _rank(held):
                offered[row.known_us] = values
        state = self._forecast.get() if self._forecast.exists() else None
        last = list(state)[: len(METRICS)] if state else [None] * len(METRICS)
        reached, disc_no, moved = (state[-2], state[-1], False) if state else (None, None, False)
        for known in sorted(offered):
            values = offered[known]
            if reached is not None and known <= reached:
                if self._late == "fail" and self._is_late(known, values):
                    raise ValueError(f"disclosure {values[1]} of {tuple(key)} arrived after a later one; work older files off first")
                continue
            yield _emitted(*key, known, *values, *last, reached is not None)
            self._taken.updateValue((known,), values)
            last = [old if new is None else new for old, new in zip(last, values[3:])]
            reached, disc_no, moved = known, values[1], True
        if moved:
            self._forecast.update((*last, reached, disc_no))


def with_state(summary: DataFrame, late: str = "fail") -> DataFrame:
    """Features of the disclosures that move their key forward, for a stream or a batch.

    Of disclosures with one stamp the first counts, as in the batch operator; ones seen before change nothing.  ``late``
    says what a disclosure does that should have come before others: ``fail`` stops, ``skip`` leaves it out.  The rows
    that one key has in one micro-batch are sorted in one task, so the budget of files per batch bounds it.
    """
    ship_package(summary.sparkSession)
    typed = disclosures(summary).select(
        *KEY, F.unix_micros("known_at").alias("known_us"), F.unix_micros("observed_at").alias("observed_us"), "disc_no", "disc_date", *METRICS
    )
    rows = typed.groupBy(*KEY).transformWithState(RevisionState(late), _OUTPUT, "Append", "None")
    stamped = rows.withColumns({"known_at": F.timestamp_micros("known_us"), "observed_at": F.timestamp_micros("observed_us")})
    return emit_revisions(stamped.drop("known_us", "observed_us"))


def start_forecast_revisions(stream: DataFrame, features: str, checkpoint: str, late: str = "fail") -> StreamingQuery:
    """Write the features of all waiting files; the sink's log makes every batch count once, also after a crash."""
    return (
        with_state(stream, late)
        .writeStream.format("parquet")
        .option("compression", "zstd")
        .option("path", features)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stored_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The state that the stream with this checkpoint has reached, one row per key."""
    stored = spark.read.format("statestore").option("stateVarName", "forecast").load(checkpoint)
    named = stored.select(
        *[F.col(f"key.{c}").alias(c) for c in KEY], *[F.col(f"value.{m}").alias(m) for m in METRICS],
        F.timestamp_micros("value.last_known_us").alias("last_known_at"), F.col("value.last_disc_no").alias("last_disc_no"),
    )
    return named.select(*STATE_COLUMNS)
