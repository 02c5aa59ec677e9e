"""Coverage, discovery, storage and health reports as aggregations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import vocabulary as v
from tidemark.functions.numbers import looks_numeric, number
from tidemark.functions.text import clean, local_name, strip
from tidemark.operators.dimensions import fixed_table, metric_aliases
from tidemark.operators.ordered import first_of_group, top_of_group

_RATIO_PLACES = 4
FREQUENCY_COLUMNS = {
    "context_id": 50,
    "relative_year": 30,
    "consolidation": 30,
    "period_type": 30,
    "unit": 30,
}


def _share(part: Column, whole: Column) -> Column:
    return F.round(F.coalesce(F.try_divide(part, whole), F.lit(0.0)), _RATIO_PLACES)


def coverage(metrics: DataFrame) -> DataFrame:
    """Per metric: rows, documents, tickers, numeric rows and their ratios."""
    everything = metrics.agg(F.count_distinct(clean(F.col("doc_id"))).alias("n"))
    rows = metrics.select(
        clean(F.col("metric")).alias("metric"),
        clean(F.col("doc_id")).alias("doc"),
        clean(F.col("stock_code")).alias("stock"),
        number(F.col("numeric_value")).isNotNull().alias("numeric"),
    ).where(F.col("metric").isNotNull())
    grouped = rows.groupBy("metric").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("doc").alias("documents"),
        F.count_distinct("stock").alias("tickers"),
        F.count_if("numeric").alias("numeric_rows"),
    )
    return grouped.withColumns(
        {
            "document_ratio": _share(F.col("documents"), everything.scalar()),
            "numeric_ratio": _share(F.col("numeric_rows"), F.col("rows")),
        }
    )


def missing_metrics(metrics: DataFrame, configured: Sequence[str] = tuple(v.METRIC_ALIASES)) -> DataFrame:
    """Configured metrics that never occur."""
    names = fixed_table(metrics.sparkSession, ["metric"], [(m,) for m in configured])
    return names.join(metrics.select(clean(F.col("metric")).alias("metric")).distinct(), "metric", "left_anti")


def _counted(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``keys, kind, item, n``: how often each non-blank value of each column occurs."""
    texts = df.select(*keys, *[clean(F.col(c)).alias(c) for c in columns])
    long = texts.unpivot(list(keys), list(columns), "kind", "item").where(F.col("item").isNotNull())
    return long.groupBy(*keys, "kind", "item").agg(F.count(F.lit(1)).alias("n"))


def _most_common() -> list[Column]:
    return [F.col("n").desc(), F.col("item").asc()]


def value_frequencies(metrics: DataFrame, limits: Mapping[str, int] = FREQUENCY_COLUMNS) -> DataFrame:
    """The most frequent values of the context columns, ``kind, item, n, rank``."""
    counted = _counted(metrics.where(clean(F.col("metric")).isNotNull()), [], list(limits))
    top = top_of_group(counted, ["kind"], _most_common(), max(limits.values()), "rank")
    allowed = F.coalesce(*[F.when(F.col("kind") == kind, F.lit(k)) for kind, k in limits.items()])
    return top.where(F.col("rank") <= allowed)


def document_type_counts(metrics: DataFrame) -> DataFrame:
    """Documents per document type."""
    documents = metrics.groupBy("doc_id").agg(F.min(clean(F.col("doc_type_code"))).alias("doc_type_code"))
    known = documents.where(F.col("doc_type_code").isNotNull())
    return known.groupBy("doc_type_code").agg(F.count(F.lit(1)).alias("documents"))


def unmatched_elements(facts: DataFrame, aliases: DataFrame | None = None, top: int = 5) -> DataFrame:
    """Per element name outside the alias table: counts, usual item name, top units and contexts."""
    aliases = metric_aliases(facts.sparkSession) if aliases is None else aliases
    rows = (
        facts.withColumn("local_name", local_name(strip(F.col("element_id"))))
        .where(F.col("local_name") != "")
        .join(aliases.select("local_name"), "local_name", "left_anti")
    )
    totals = rows.groupBy("local_name").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(clean(F.col("doc_id"))).alias("documents"),
        F.count_if(looks_numeric(F.col("value"))).alias("numeric_rows"),
    )
    counted = _counted(rows, ["local_name"], ["item_name", "unit", "context_id"])
    ranked = top_of_group(counted, ["local_name", "kind"], _most_common(), top, "rank")

    def listed(kind: str) -> Column:
        cell = F.struct("rank", "item", "n")
        ordered = F.sort_array(F.collect_list(F.when(F.col("kind") == kind, cell)))
        return F.transform(ordered, lambda c: F.struct(c["item"].alias("item"), c["n"].alias("n")))

    usual = F.max(F.when((F.col("kind") == "item_name") & (F.col("rank") == 1), F.col("item")))
    # At most 3 kinds x ``top`` rows per element reach the lists.
    details = ranked.groupBy("local_name").agg(
        usual.alias("item_name"), listed("unit").alias("top_units"), listed("context_id").alias("top_contexts")
    )
    return totals.join(details, "local_name", "left").withColumn(
        "numeric_ratio", _share(F.col("numeric_rows"), F.col("rows"))
    )


def hint_matches(
    elements: DataFrame, hints: Mapping[str, Sequence[str]] = v.DISCOVERY_HINTS, top: int = 50
) -> DataFrame:
    """Unmatched elements whose name or item contains a target's keyword, best ``top`` per target.

    The keyword list is a constant of the plan: each element tests it in place
    and only its own matches become rows.
    """
    text = F.lower(F.concat_ws(" ", F.coalesce("local_name", F.lit("")), F.coalesce("item_name", F.lit(""))))
    targets = [
        F.when(F.coalesce(*[F.when(text.contains(h.lower()), True) for h in words], F.lit(False)), F.lit(target))
        for target, words in hints.items()
    ]
    matched = elements.withColumn("target", F.explode(F.array_compact(F.array(*targets))))
    best = [F.col(c).desc() for c in ("documents", "numeric_rows", "rows")] + [F.col("local_name").asc()]
    return top_of_group(matched, ["target"], best, top, "rank")


def discovery_report(elements: DataFrame, top: int = 200) -> DataFrame:
    """The ``top`` unmatched elements by rows, ranked over all targets, behind a row of rank 0 with their whole number.

    That row is labelled ``(total)``; its ``rows`` and ``documents`` are the number of elements and the rows they stand for.
    """
    best = elements.select("local_name", "rows", "documents").orderBy(F.col("rows").desc(), F.col("local_name").asc()).limit(top)
    order = Window.orderBy(F.col("rows").desc(), F.col("local_name").asc())  # over no more than the top
    ranked = best.withColumn("rank", F.row_number().over(order).cast("long"))
    total = elements.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("rows"), F.lit(0)).alias("documents"))
    return total.select(F.lit("(total)").alias("local_name"), "rows", "documents", F.lit(0).cast("long").alias("rank")).unionByName(ranked)


def storage_usage(listing: DataFrame, budget_bytes: int = v.STORAGE_BUDGET_BYTES) -> DataFrame:
    """Bytes and objects per first- and second-level path prefix, and in total with a budget level.

    ``listing`` has ``path`` and ``length``.  The total row has the label ``(total)``.
    """
    parts = F.split("path", "/")
    nested = F.size(parts) > 1
    first = F.when(nested, F.get(parts, F.lit(0))).otherwise("(root)")
    second = F.when(nested, F.concat_ws("/", F.slice(parts, 1, 2))).otherwise("(root)")
    labels = F.array(first, second, F.lit("(total)"))
    sized = listing.select(F.explode(labels).alias("label"), F.coalesce("length", F.lit(0)).alias("length"))
    usage = sized.groupBy("label").agg(F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("objects"))
    ratio = F.col("bytes") / F.lit(float(budget_bytes))
    level = F.coalesce(*[F.when(ratio >= floor, F.lit(name)) for name, floor in v.STORAGE_LEVELS], F.lit("ok"))
    is_total = F.col("label") == "(total)"
    return usage.withColumns(
        {
            "gib": F.round(F.col("bytes") / F.lit(float(1024**3)), 4),
            "budget_ratio": F.when(is_total, F.round(ratio, 6)),
            "level": F.when(is_total, level),
        }
    )


def prefix_stats(listing: DataFrame, prefixes: Sequence[str]) -> DataFrame:
    """Objects and bytes under each given prefix; a prefix without objects shows zero."""
    wanted = fixed_table(listing.sparkSession, ["prefix"], [(p,) for p in prefixes])
    hits = F.array_compact(F.array(*[F.when(F.col("path").startswith(p), F.lit(p)) for p in prefixes]))
    found = listing.select(F.explode(hits).alias("prefix"), "length").groupBy("prefix").agg(
        F.count(F.lit(1)).alias("objects"), F.sum("length").alias("bytes")
    )
    return wanted.join(found, "prefix", "left").select(
        "prefix",
        F.coalesce("objects", F.lit(0)).alias("objects"),
        F.coalesce("bytes", F.lit(0)).alias("bytes"),
        F.round(F.coalesce("bytes", F.lit(0)) / F.lit(float(1024**2)), 3).alias("mib"),
    )


def dataset_health(runs: DataFrame, storage_level: Column | str | None = None) -> DataFrame:
    """Latest run per job with its issues and an ok/attention status.

    ``runs`` has ``job, modified, path, status, failed_documents``; the newest
    run is the one with the greatest (modified, path).
    """
    latest = first_of_group(runs, ["job"], [F.col("modified").desc(), F.col("path").desc()])
    failures = F.coalesce("failed_documents", F.lit(0)).cast("long")
    level = storage_level if isinstance(storage_level, Column) else F.lit(storage_level).cast("string")
    issues = F.array_compact(
        F.array(
            F.when(level.isin("warning", "critical"), F.concat(F.lit("storage_"), level)),
            F.when(failures > 0, F.concat(F.col("job"), F.lit("_failures="), failures.cast("string"))),
            F.when(F.col("status") == "error", F.concat(F.col("job"), F.lit("_status_error"))),
        )
    )
    return latest.withColumn("issues", issues).withColumn(
        "health", F.when(F.size("issues") == 0, "ok").otherwise("attention")
    )


def series_check(configured: DataFrame, responses: DataFrame, observations: DataFrame) -> DataFrame:
    """Whether each configured series answered with status 200, rows, and its own code.

    ``responses`` has ``db, code, status`` per request; ``observations`` has
    ``db, code, series_id`` per returned value.
    """
    counted = observations.groupBy("db", "code").agg(
        F.count(F.lit(1)).alias("recent_rows"),
        F.max((F.col("series_id") == F.col("code")).cast("int")).alias("returned"),
    )
    checked = configured.join(responses, ["db", "code"], "left").join(counted, ["db", "code"], "left")
    complete = (F.col("status") == 200) & (F.col("recent_rows") > 0) & (F.col("returned") == 1)
    return checked.select(
        *configured.columns,
        F.coalesce("status", F.lit(0)).alias("status"),
        F.coalesce("recent_rows", F.lit(0)).alias("recent_rows"),
        F.coalesce(complete, F.lit(False)).alias("ok"),
    )
