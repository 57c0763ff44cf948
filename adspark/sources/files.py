"""File readers (I-01..I-04, I-13, I-14).

A report file is one JSON array (plain or gzip). It is read whole (``wholetext``): gzip does not
split anyway, so parallelism comes from many files; rows are produced by ``inline`` of the parsed
array and can be repartitioned after parsing. The text reader keeps the raw bytes, so the
UTF-8 / latin1 decision (I-02) is made per file in the same pass.
"""

from __future__ import annotations

import csv
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adspark.functions.text import decode_with_fallback
from adspark.sources.paths import source_path

# Accepted input extensions and the status of rejected files.
ACCEPTED_EXTENSIONS = (".gz", ".json", ".csv")
UNSUPPORTED_STATUS = "INPUT_FORMAT_UNSUPPORTED"


def _paths(paths):
    return [paths] if isinstance(paths, str) else list(paths)


def plain_path(path: str) -> str:
    """The path with its wildcard characters escaped, so that it names one file."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def whole_files(spark: SparkSession, paths, *, fallback: str = "ISO-8859-1", recursive: bool = True) -> DataFrame:
    """One row per file: ``_file``, ``_mtime`` and the decoded text ``value``. Folders are read
    recursively (the report layout nests files several folders deep)."""
    # ``text(..., wholetext=True)``: the keyword must be passed, ``text`` resets the option otherwise.
    # With ``recursive=False`` the paths are names of files, without wildcards.
    paths = _paths(paths) if recursive else [plain_path(p) for p in _paths(paths)]
    raw = spark.read.option("recursiveFileLookup", recursive).text(paths, wholetext=True)
    return raw.select(
        source_path().alias("_file"),
        F.col("_metadata.file_modification_time").alias("_mtime"),
        decode_with_fallback(F.col("value"), fallback).alias("value"))


def parse_report(value: Column, schema: T.StructType, *, file: Column | None = None) -> Column:
    """The objects of a JSON array (or of one lone object) that is the whole text. NULL for anything
    else: text that does not parse, and text that goes on after the value, which the JSON parser
    itself would leave out silently. With ``file`` (its name) an error instead of NULL.

    The text is put into an array in front of an empty one: only if it is one whole value has that
    array two elements."""
    lone = F.regexp_like(value, F.lit(r"^\s*\{"))
    text = F.when(lone, F.concat(F.lit("[["), value, F.lit("],[]]"))).otherwise(F.concat(F.lit("["), value, F.lit(",[]]")))
    whole = F.filter(F.array(F.from_json(text, T.ArrayType(T.ArrayType(schema)))),
                     lambda p: (F.size(p) == 2) & (~lone | (F.size(F.get(p, F.lit(0))) == 1)))
    objects = F.get(F.get(whole, F.lit(0)), F.lit(0))
    if file is None:
        return objects
    return F.coalesce(objects, F.raise_error(F.concat(F.lit("not one whole JSON report: "), file)))


def read_json_report(spark: SparkSession, paths, schema: T.StructType | None = None, *,
                     fallback: str = "ISO-8859-1", files: DataFrame | None = None, mode: str = "wholetext",
                     encoding: str = "UTF-8", lines: bool = False) -> DataFrame:
    """I-01: each file holds one JSON array of objects; rows with ``_file`` and ``_mtime``. A file
    that is cut short, or goes on after the array, is an error. ``lines`` reads files that hold one
    array or object a line instead.

    ``mode="wholetext"`` (default) reads each file as one value, so the UTF-8 / latin1 decision
    (I-02) is made per file; a file must fit in one task's memory. ``mode="multiline"`` uses Spark's
    JSON reader, which streams the array elements of a file without holding the whole text (for
    very large files); it reads one fixed ``encoding``. Without ``schema`` nothing is inferred: pass
    the reading schema (all fields as text, see ``spec_input_schema``).
    """
    if schema is None:
        raise ValueError("read_json_report needs a schema (see spec_input_schema)")
    if mode == "multiline":
        df = spark.read.schema(schema).option("multiLine", True).option("encoding", encoding) \
            .option("recursiveFileLookup", True).json(_paths(paths))
        return df.select(source_path().alias("_file"),
                         F.col("_metadata.file_modification_time").alias("_mtime"), *[F.col(f"`{c}`") for c in df.columns])
    if mode != "wholetext":
        raise ValueError(f"unknown mode {mode!r}")
    files = whole_files(spark, paths, fallback=fallback) if files is None else files
    if lines:
        files = files.withColumn("value", F.explode(F.split("value", "\n"))).where(F.trim(F.regexp_replace("value", r"\s", " ")) != "")
    return files.select("_file", "_mtime", F.inline(parse_report(F.col("value"), schema, file=F.col("_file"))))


def spec_input_schema(spec, *, nested=("extendedData", "budget")) -> T.StructType:
    """Reading schema for a table's files: every configured column plus the nested entity inputs,
    all as text (JSON text for objects)."""
    names = list(dict.fromkeys([c for c, _ in spec.columns] + list(nested)))
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def csv_reader(spark: SparkSession):
    """Reader for CSV reports: header, text columns, doubled quotes, line breaks inside quotes. Bytes
    are read one by one as latin1, where quotes, commas and line ends are the same; ``decoded`` then
    decides per value (I-02)."""
    return spark.read.option("header", True).option("inferSchema", False).option("escape", '"').option("multiLine", True).option("encoding", "ISO-8859-1")


def _name(raw: str) -> str:
    """A column name that was read as latin1: UTF-8 if it is that, without a byte order mark."""
    data = raw.encode("latin-1", "replace")
    try:
        return data.decode("utf-8").lstrip("\ufeff")
    except UnicodeDecodeError:
        return raw


def decoded(df: DataFrame, names=None) -> DataFrame:
    """I-02 for rows of ``csv_reader``: each value as UTF-8 if it is valid, else as latin1."""
    names = [_name(c) for c in df.columns] if names is None else names
    return df.select(*[decode_with_fallback(F.encode(F.col(f"`{c}`"), "ISO-8859-1")).alias(n) for c, n in zip(df.columns, names, strict=True)], F.col("_metadata"))


def read_csv_report(spark: SparkSession, paths) -> DataFrame:
    """I-03: CSV with header, every column as text (no inference pass), plus ``_file``. Quoted values
    may hold commas, doubled quotes and line breaks; values are UTF-8 or latin1 (I-02)."""
    df = decoded(csv_reader(spark).csv(_paths(paths)))
    return df.withColumn("_file", source_path()) \
        .withColumn("_mtime", F.col("_metadata.file_modification_time")).drop("_metadata")


def header_names(line: str) -> list[str]:
    """Column names of a CSV header line; blank and repeated ones get their position."""
    names = next(csv.reader([line.lstrip("\ufeff")]), [])
    low = [n.lower() for n in names]
    return [f"_c{i}" if not n else f"{n}{i}" if low.count(n.lower()) > 1 else n for i, n in enumerate(names)]


def read_csv_files(spark: SparkSession, paths: list[str], header: str) -> DataFrame:
    """CSV files of these very names (no wildcards) that share the header line ``header``: columns
    as text, ``_file`` and ``_mtime``."""
    names = header_names(header)
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
    df = decoded(csv_reader(spark).schema(schema).csv([plain_path(p) for p in paths]), names)
    return df.withColumns({"_file": source_path(), "_mtime": F.col("_metadata.file_modification_time")}).drop("_metadata")


def read_listing_tsv(spark: SparkSession, paths, *, sku: str = "seller-sku", encoding: str | None = None) -> DataFrame:
    """I-04: gzip or plain tab-separated listing; NUL bytes dropped, blank SKUs dropped, distinct.
    Without ``encoding`` a SKU that is valid UTF-8 is read as such, any other as latin1 (I-02): the
    file is read byte by byte as latin1, where tabs and line ends are the same, and decoded after
    parsing, so no second pass over the file is needed."""
    df = spark.read.option("header", True).option("sep", "\t").option("encoding", encoding or "ISO-8859-1").csv(_paths(paths))
    c = F.col(f"`{sku}`")
    c = F.translate(c if encoding else decode_with_fallback(F.encode(c, "ISO-8859-1")), "\u0000", "")
    return df.select(c.alias(sku)).filter(F.col(f"`{sku}`").isNotNull() & (F.trim(F.col(f"`{sku}`")) != "")).distinct()


def file_format_gate(files: DataFrame, *, path: str = "path"):
    """I-13: split file rows into accepted (``.gz .json .csv``) and rejected (status row)."""
    ext = F.lower(F.regexp_extract(F.col(path), r"(\.[^./]+)$", 1))
    tagged = files.withColumn("extension", ext)
    ok = F.col("extension").isin(list(ACCEPTED_EXTENSIONS))
    return (tagged.filter(ok),
            tagged.filter(~ok).withColumn("status", F.lit(UNSUPPORTED_STATUS)))


def header_gate(headers: DataFrame, *, path: str = "_file", columns: str = "columns", keep=()) -> DataFrame:
    """I-14: a file is invalid if it has no columns, a column named ``Error`` or a column whose name
    (blanks removed) contains ``<html>``. ``columns`` is an array of header names. A zero-byte file
    produces no row at all in Spark's file sources, so it is never loaded (A-01 counts 0 rows)."""
    cols = F.col(columns)
    has_error = F.exists(cols, lambda c: c == F.lit("Error"))
    has_html = F.exists(cols, lambda c: F.lower(F.regexp_replace(c, r"\s", "")).contains("<html>"))
    verdict = (F.when(cols.isNull() | (F.size(cols) <= 0), F.lit("empty"))
               .when(has_error, F.lit("error_column"))
               .when(has_html, F.lit("html"))
               .otherwise(F.lit("valid")))
    return headers.select(F.col(path), *keep, verdict.alias("verdict"))


def csv_headers(spark: SparkSession, paths) -> DataFrame:
    """Header names of each CSV file (first line split by commas) for ``header_gate``."""
    files = whole_files(spark, paths)
    first = F.substring_index(F.col("value"), "\n", 1)
    return files.select("_file", F.when(F.length(F.trim(first)) == 0, F.array().cast("array<string>"))
                        .otherwise(F.split(F.regexp_replace(first, "\r$", ""), ",")).alias("columns"))


def json_headers(spark: SparkSession, paths) -> DataFrame:
    """Header names of each JSON-array file: the keys of its first object."""
    files = whole_files(spark, paths)
    first = F.get_json_object(F.col("value"), "$[0]")
    return files.select("_file", F.coalesce(F.json_object_keys(first), F.array().cast("array<string>")).alias("columns"))
