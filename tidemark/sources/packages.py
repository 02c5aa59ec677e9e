"""Filing packages: ZIP files with tab-separated UTF-16 fact tables.

A package is taken apart in two steps.  The first reads central directories only and gives one row per fact table, still
compressed; these rows are dealt out by size, so a package with many or large tables is no single task.  The second inflates,
decodes and parses each table as a stream.  Spark does all joins, hashes and stamps.
"""

from __future__ import annotations

import codecs
import csv
import functools
import hashlib
import io
import itertools
import re
import struct
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.csv
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from tidemark import vocabulary as v
from tidemark.functions.text import content_hash
from tidemark.functions.times import known_from_filing, to_utc
from tidemark.operators.normalize import split_rejects
from tidemark.operators.quality import require_columns
from tidemark.session import scratch_path, ship_package
from tidemark.sources.datasets import write_dataset

_ROWS_PER_BATCH = 20_000
_CHUNK = 1 << 20
#: Columns read as text: of a table whose header shows that it has no more, and of any other.
_NARROW, _WIDE = 16, 1000
_ENCODINGS = ("utf-16", "utf-16-le", "utf-16-be")
_MEMBER = pa.schema(
    [("path", pa.string()), ("package_sha256", pa.string()), ("csv_file_name", pa.string()), ("method", pa.int32()),
     ("crc", pa.int64()), ("packed", pa.binary()), ("error", pa.string())]
)
_MEMBER_SCHEMA = from_arrow_schema(_MEMBER)
_LINEAGE = {
    "path": pa.string(),
    "package_sha256": pa.string(),
    "csv_file_name": pa.string(),
    "csv_sha256": pa.string(),
    "row_number": pa.int64(),
    "error": pa.string(),
}
_ARROW_SCHEMA = pa.schema({**_LINEAGE, **dict.fromkeys(v.FACT_COLUMNS, pa.string())})
_FACT_SCHEMA = from_arrow_schema(_ARROW_SCHEMA)


def is_fact_member(name: str) -> bool:
    """Whether an archive member is a table with the fact folder in its path; either slash parts it."""
    parts = [part.casefold() for part in re.split(r"[/\\]", name)]
    return parts[-1].endswith(".csv") and any(v.PACKAGE_FACT_FOLDER in part for part in parts)


def _packed_member(content: bytes, info: zipfile.ZipInfo) -> bytes:
    """Compressed bytes of a member, found by its local header."""
    if info.flag_bits & 1:
        raise ValueError(f"{info.filename} is encrypted")
    if info.compress_type not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
        raise ValueError(f"{info.filename} is compressed by method {info.compress_type}")
    # Fixed 30 bytes; the lengths of name and extra field stand at 26 and 28.
    name, extra = struct.unpack_from("<HH", content, info.header_offset + 26)
    start = info.header_offset + 30 + name + extra
    if start + info.compress_size > len(content):
        raise ValueError(f"{info.filename} is cut off")
    return content[start : start + info.compress_size]


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for files in batches:
        for path, sha256, content in zip(*(files.column(n) for n in ("path", "package_sha256", "content"))):
            lineage, raw = {"path": path.as_py(), "package_sha256": sha256.as_py()}, content.as_py()
            try:
                with zipfile.ZipFile(io.BytesIO(raw)) as archive:
                    found = [info for info in archive.infolist() if is_fact_member(info.filename)]
                if not found:
                    raise ValueError("package holds no fact table")
                for info in found:
                    row = {**lineage, "csv_file_name": info.filename, "method": info.compress_type, "crc": info.CRC,
                           "packed": _packed_member(raw, info)}
                    yield pa.RecordBatch.from_pylist([row], schema=_MEMBER)
            except (ValueError, zipfile.BadZipFile, struct.error, NotImplementedError) as problem:
                yield pa.RecordBatch.from_pylist([{**lineage, "error": str(problem)}], schema=_MEMBER)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in batches of some size: handing a batch over costs more than the rows of a small table."""
    held: list[pa.RecordBatch] = []
    rows = size = 0
    for batch in batches:
        held.append(batch)
        rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows >= _ROWS_PER_BATCH or size >= 4 * _CHUNK:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, rows, size = [], 0, 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _inflate(packed: bytes, method: int) -> Iterator[bytes]:
    if method == zipfile.ZIP_STORED:
        yield from (packed[i : i + _CHUNK] for i in range(0, len(packed), _CHUNK))
        return
    stream = zlib.decompressobj(-zlib.MAX_WBITS)
    rest = packed
    while rest or not stream.eof:
        chunk = stream.decompress(rest, _CHUNK)
        rest = stream.unconsumed_tail
        if chunk:
            yield chunk
        elif not rest:
            break
    if not stream.eof:
        raise ValueError("fact table is cut off")


def _inspect(packed: bytes, method: int, crc: int) -> tuple[str, str]:
    """(digest, encoding) of a table, after reading it once; it has to be whole and UTF-16."""
    digest, check = hashlib.sha256(), 0
    decoders = {name: codecs.getincrementaldecoder(name)() for name in _ENCODINGS}
    for chunk in _inflate(packed, method):
        digest.update(chunk)
        check = zlib.crc32(chunk, check)
        _feed(decoders, chunk, False)
    _feed(decoders, b"", True)
    if check != crc:
        raise ValueError("fact table is damaged")
    if not decoders:
        raise ValueError("fact table is not UTF-16")
    return digest.hexdigest(), next(iter(decoders))


def _feed(decoders: dict, chunk: bytes, last: bool) -> None:
    """Decode with the first encoding that is still possible, and with the others as long as it is not the first."""
    for name in list(decoders):
        try:
            decoders[name].decode(chunk, last)
        except UnicodeError:
            del decoders[name]


class _Text(io.RawIOBase):
    """A table re-encoded to UTF-8, read as a stream."""

    def __init__(self, packed: bytes, method: int, encoding: str) -> None:
        super().__init__()
        decoder = codecs.getincrementaldecoder(encoding)()
        chunks = itertools.chain(((c, False) for c in _inflate(packed, method)), [(b"", True)])
        self._parts = (decoder.decode(chunk, last).encode() for chunk, last in chunks)
        self._kept = b""

    def readable(self) -> bool:
        return True

    def readinto(self, target) -> int:
        while not self._kept:
            part = next(self._parts, None)
            if part is None:
                return 0
            self._kept = part
        size = min(len(target), len(self._kept))
        target[:size], self._kept = self._kept[:size], self._kept[size:]
        return size


def _columns(header: list[str]) -> dict[str, int]:
    """Position of every canonical column in a header; of several names for one column the last counts."""
    found = [v.FACT_HEADERS.get(cell.strip().lstrip("\ufeff").strip()) for cell in header]
    missing = [c for c in v.REQUIRED_FACT_COLUMNS if c not in found]
    if missing:
        raise ValueError(f"fact table lacks columns {missing}")
    return {name: i for i, name in enumerate(found) if name}


def _by_reader(text: io.RawIOBase, skip: int) -> Iterator[dict[str, pa.Array]]:
    """Columns of a table whose rows differ in length: short rows lack values, longer ones than the header are refused."""
    csv.field_size_limit(2**31 - 1)
    reader = csv.reader(io.TextIOWrapper(io.BufferedReader(text), encoding="utf-8", newline=""), delimiter="\t")
    header = next(reader, [])
    places = _columns(header)
    rows = itertools.islice((cells for cells in reader if cells), skip, None)
    while batch := list(itertools.islice(rows, _ROWS_PER_BATCH)):
        if any(len(cells) > len(header) for cells in batch):
            raise ValueError("fact row is longer than the header")
        yield {name: pa.array([cells[i] if i < len(cells) else None for cells in batch], pa.string()) for name, i in places.items()}


@functools.cache
def _arrow_options(width: int) -> dict[str, object]:
    """Options of a reader whose first ``width`` columns are text; a package has many small tables, all of few widths."""
    types = {f"f{i}": pa.string() for i in range(width)}
    return {
        "read_options": pa.csv.ReadOptions(use_threads=False, autogenerate_column_names=True, block_size=_CHUNK),
        "parse_options": pa.csv.ParseOptions(delimiter="\t", newlines_in_values=True),
        "convert_options": pa.csv.ConvertOptions(column_types=types, strings_can_be_null=False),
    }


def _by_arrow(text: io.RawIOBase) -> Iterator[dict[str, pa.Array]]:
    """Columns of a table whose rows all have the header's length."""
    buffered = io.BufferedReader(text, _CHUNK)
    # Without quotes, a first line in sight that is not blank holds the whole header, and its tabs tell the columns.
    head, ended, _ = buffered.peek().partition(b"\n")
    narrow = ended and head.strip() and b'"' not in head and head.count(b"\t") < _NARROW
    options = _arrow_options(_NARROW if narrow else _WIDE)
    places: dict[str, int] | None = None
    with pa.csv.open_csv(buffered, **options) as reader:
        for batch in reader:
            if places is None and batch.num_rows:
                places = _columns([column[0].as_py() for column in batch.columns])
                batch = batch.slice(1)
            if batch.num_rows:
                yield {name: batch.column(i) for name, i in places.items()}
    if places is None:
        _columns([])


def table_columns(packed: bytes, method: int, encoding: str) -> Iterator[dict[str, pa.Array]]:
    """Batches of a table's columns; optional columns that it lacks are left out."""
    done = 0
    try:
        for columns in _by_arrow(_Text(packed, method, encoding)):
            yield columns
            done += len(next(iter(columns.values())))
    except pa.ArrowInvalid:  # rows of several lengths: go on by the slower reader where this one stopped
        yield from _by_reader(_Text(packed, method, encoding), done)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for members in batches:
        for i in range(members.num_rows):
            member = {n: members.column(n)[i].as_py() for n in _MEMBER.names}
            lineage = {n: member[n] for n in ("path", "package_sha256", "csv_file_name")}
            try:
                if member["error"] is not None:
                    raise ValueError(member["error"])
                lineage["csv_sha256"], encoding = _inspect(member["packed"], member["method"], member["crc"])
                number = 0
                for columns in table_columns(member["packed"], member["method"], encoding):
                    size = len(next(iter(columns.values())))
                    values = {
                        "row_number": pa.array(range(number, number + size), pa.int64()), "error": pa.nulls(size, pa.string()),
                        **{n: pa.repeat(pa.scalar(x, pa.string()), size) for n, x in lineage.items()},
                        **{n: columns[n] if n in columns else pa.repeat(pa.scalar(""), size) for n in v.FACT_COLUMNS},
                    }
                    yield pa.RecordBatch.from_arrays([values[n] for n in _ARROW_SCHEMA.names], schema=_ARROW_SCHEMA)
                    number += size
            except (ValueError, zlib.error, csv.Error) as problem:
                lineage.pop("csv_sha256", None)
                yield pa.RecordBatch.from_pylist([{**lineage, "error": str(problem)}], schema=_ARROW_SCHEMA)


def unpack_files(files: DataFrame) -> DataFrame:
    """Fact rows of ZIP files given as ``path, package_sha256, content``, with one ``error`` row per failed package.

    Parsed rows are written once to the shared folder.  A package stays all or nothing: rows of a package with any error
    are left out by a join on the errors, so a failed one contributes its error only and never stops the others.
    """
    spark = files.sparkSession
    ship_package(spark)
    members = files.select("path", "package_sha256", "content").mapInArrow(lambda files: _gathered(_members(files)), _MEMBER_SCHEMA)
    staged = scratch_path(spark, "packages")
    write_dataset(members.hint("rebalance").mapInArrow(lambda packed: _gathered(_parse(packed)), _FACT_SCHEMA), staged)
    parsed = spark.read.schema(_FACT_SCHEMA).parquet(staged)
    first = F.min_by(F.struct("package_sha256", "csv_file_name", "error"), F.coalesce("csv_file_name", F.lit("")))
    errors = parsed.where(F.col("error").isNotNull()).groupBy("path").agg(first.alias("first")).select("path", "first.*")
    good = parsed.where(F.col("error").isNull()).join(errors.select("path"), "path", "left_anti")
    return good.select(*_FACT_SCHEMA.names).unionByName(errors, allowMissingColumns=True)


def unpack_packages(spark: SparkSession, path: str) -> DataFrame:
    """``unpack_files`` for the ZIP files under a path."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.zip")
        .load(path)
        .select("path", content_hash(F.col("content")).alias("package_sha256"), "content")
    )
    return unpack_files(files)


def read_fact_text(spark: SparkSession, path: str) -> DataFrame:
    """Already unzipped fact tables, read by Spark's CSV source.

    ``multiLine`` is required: line splitting does not understand UTF-16.
    """
    raw = (
        spark.read.option("sep", "\t")
        .option("encoding", "UTF-16")
        .option("multiLine", "true")
        .option("header", "true")
        .csv(path)
    )
    known = {c: v.FACT_HEADERS[c.strip().lstrip("\ufeff")] for c in raw.columns if c.strip().lstrip("\ufeff") in v.FACT_HEADERS}
    require_columns(raw.withColumnsRenamed(known), v.REQUIRED_FACT_COLUMNS, "fact table")
    names = {name: column for column, name in known.items()}
    return raw.select(
        *[(F.coalesce(F.col(f"`{names[c]}`"), F.lit("")) if c in names else F.lit("")).alias(c) for c in v.FACT_COLUMNS]
    )


def _split_listed(facts: DataFrame, listed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readable fact rows joined with their list row, rejected rows of packages without one).

    The file name (without ``.zip``) is the document id.
    """
    named = facts.where(F.col("error").isNull()).withColumn("doc_id", F.regexp_extract("path", r"([^/]+)\.zip$", 1))
    joined = named.join(listed.withColumn("__listed", F.lit(True)), "doc_id", "left")
    return split_rejects(joined, {"no list row": F.col("__listed").isNull()})


def package_rejects(facts: DataFrame, documents: DataFrame) -> DataFrame:
    """Fact rows that ``package_facts`` refuses, with an ``error``: of unreadable packages and of those without a list row."""
    _, unlisted = _split_listed(facts, documents.select("doc_id").distinct())
    return facts.where(F.col("error").isNotNull()).unionByName(unlisted.select(*facts.columns))


def package_facts(facts: DataFrame, documents: DataFrame, run_id: str) -> DataFrame:
    """Fact rows with the metadata of their document.

    ``documents`` are selected list rows with ``category`` and ``observed_at``.
    ``package_rejects`` lists the rows without one.
    """
    observed = to_utc(F.col("observed_at"))
    described = documents.select(
        F.lit(v.SOURCE_FILINGS).alias("source_id"),
        F.lit("xbrl_csv_facts").alias("dataset"),
        "category",
        "doc_id",
        F.coalesce("doc_type_code", F.lit("")).alias("doc_type_code"),
        "doc_description",
        "edinet_code",
        "sec_code",
        F.when(F.col("sec_code") != "", F.substring("sec_code", 1, 4)).alias("stock_code"),
        "filer_name",
        "issuer_edinet_code",
        "subject_edinet_code",
        "parent_doc_id",
        "period_start",
        "period_end",
        "submit_datetime",
        known_from_filing(F.col("submit_datetime"), F.col("operation_datetime"), observed).alias("known_at"),
        observed.alias("observed_at"),
        "source_url",
    )
    valid, _ = _split_listed(facts, described)
    return valid.select(
        *[c for c in described.columns if c != "source_url"],
        "csv_file_name",
        "row_number",
        *v.FACT_COLUMNS,
        "package_sha256",
        "csv_sha256",
        "source_url",
        F.lit(run_id).alias("ingestion_run_id"),
    )
