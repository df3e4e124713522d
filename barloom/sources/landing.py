"""Readers for contract lists and landed provider files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.numbers import lenient_double, lenient_long
from barloom.functions.symbols import strip
from barloom.operators.project import (
    MissingFields, missing_fields, normalize_contracts, normalize_time_column, rename_fields,
)
from barloom.operators.quality import validate_contracts
from barloom.schemas import (
    CONTRACT_REQUIRED, EQUITY_FIELD_NAMES, EQUITY_FIELDS, EQUITY_FLOATS, EQUITY_JSON_SCHEMA, FUTURES_FIELDS, FUTURES_SCHEMA,
    ORD, SYMBOL,
)

# Texts a contract list uses for "no value".
NO_VALUE = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


#: Part of ``monotonically_increasing_id`` that counts the rows inside a partition.
_ROW_BITS = (1 << 33) - 1


def _header_csv(spark: SparkSession, path: str) -> DataFrame:
    """All-text read by header name. A missing or empty file is an error, and so is a ragged line."""
    try:
        df = spark.read.option("header", True).option("mode", "FAILFAST").csv(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from error
        raise
    if not df.columns:
        raise ValueError(f"no content: {path}")
    return df.toDF(*[c.lstrip("﻿").strip() for c in df.columns])


def _file_position() -> Column:
    """Order of rows as they stand in their files, whatever the partitioning of the read.

    The running id grows within one block; file name and block offset order the blocks.
    """
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def _line_position() -> Column:
    """Rising position of a row in one list file. A row takes at least a byte, so positions of one
    block end before the next block begins."""
    row = F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS))
    return F.col("_metadata.file_block_start") + row


def read_contracts(spark: SparkSession, path: str) -> DataFrame:
    """Contract list, wide or narrow; every column text but ``multiplier`` (double)."""
    df = _header_csv(spark, path)
    named = df.select("*", _file_position().alias(ORD))
    texts = {c: F.when(~F.col(c).isin(*NO_VALUE), F.col(c)) for c in df.columns}
    named = named.withColumns(texts)
    if "multiplier" in named.columns:
        named = named.withColumn("multiplier", F.col("multiplier").cast("double"))
    return named


def load_contracts(spark: SparkSession, path: str) -> DataFrame:
    """Contract list checked and normalised: ``dataSymbol``, ``instrumentType``."""
    df = read_contracts(spark, path)
    absent = missing_fields(df, CONTRACT_REQUIRED)
    if absent:
        raise MissingFields(f"contract list lacks {absent}; required are {CONTRACT_REQUIRED}")
    report = validate_contracts(df).first()
    if not report.passed:
        raise ValueError(f"contract list {path}: {report.first_failed}")
    return normalize_contracts(df)


def read_constituents(spark: SparkSession, path: str, col: str = "Symbol") -> DataFrame:
    """Index members in file order: non-blank ``ticker`` with its ``pos``."""
    df = _header_csv(spark, path)
    absent = missing_fields(df, [col])
    if absent:
        raise MissingFields(f"constituents lack {absent}")
    named = df.select(F.col(col).alias("ticker"), _line_position().alias("pos"))
    return named.filter(strip(F.col("ticker")) != "")


def _first_records_carry(spark: SparkSession, path: str, fields: list[str], records: int = 100) -> bool:
    """Whether the first records, one a line, carry all the fields. Folder names of the form ``field=...`` carry theirs."""
    lines = spark.read.text(path)
    keys = lines.limit(records).select(F.explode(F.json_object_keys("value")).alias("key")).distinct()
    return set(fields) <= {r.key for r in keys.collect()} | set(lines.columns)


def read_equity_json(
    spark: SparkSession, path: str, symbol_pattern: str | None = None, multi_line: bool = False,
    schema_sample: float = 1.0,
) -> DataFrame:
    """Landed equity records under their stored names, 14 columns and the landing order.

    The symbol comes from a ``symbol`` field, a ``symbol=...`` folder, or the file name
    (``symbol_pattern``, first group). A field that no record carries is an error. Records are read once, with a fixed schema: where the
    first ones carry all fields between them, that settles it. Otherwise (and with ``multi_line``, where
    records have no line of their own) the fields are looked for in the share ``schema_sample`` of all records first.
    """
    reader = spark.read.option("multiLine", multi_line)
    expected = [f.name for f in EQUITY_JSON_SCHEMA] + ([] if symbol_pattern else [SYMBOL])
    try:
        if multi_line or not _first_records_carry(spark, path, expected):
            seen = reader.option("samplingRatio", schema_sample).json(path)
            absent = missing_fields(seen, expected) if seen.columns else []
            if absent:
                raise MissingFields(f"equity records lack {absent}; found {seen.columns}")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from error
        raise
    schema = T.StructType(EQUITY_JSON_SCHEMA.fields + ([] if symbol_pattern else [T.StructField(SYMBOL, T.StringType())]))
    df = reader.option("mode", "FAILFAST").schema(schema).json(path)
    if symbol_pattern:
        df = df.withColumn(SYMBOL, F.regexp_extract(F.col("_metadata.file_name"), symbol_pattern, 1))
    named = rename_fields(df.select("*", _file_position().alias(ORD)), EQUITY_FIELD_NAMES)
    typed = {**{c: lenient_double(F.col(c)) for c in EQUITY_FLOATS}, "volume": lenient_long(F.col("volume"))}
    return named.withColumns(typed).select(*EQUITY_FIELDS, ORD)


def read_futures_bars(spark: SparkSession, path: str, fmt: str = "parquet", symbol: Column | None = None) -> DataFrame:
    """Landed futures bars; ``ts_event`` becomes ``time`` and ``symbol`` (if given) is stamped on.

    An empty landing gives an empty frame of the stored schema.
    """
    try:
        df = spark.read.option("header", True).format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            empty = spark.createDataFrame([], FUTURES_SCHEMA)
            return empty.withColumn(ORD, F.lit(None).cast("bigint"))
        raise
    if ORD not in df.columns:
        df = df.select("*", _file_position().alias(ORD))
    df = normalize_time_column(df)
    if symbol is not None:
        df = df.withColumn(SYMBOL, symbol)
    first = [c for c in FUTURES_FIELDS if c in df.columns]
    return df.select(*first, *[c for c in df.columns if c not in first])
