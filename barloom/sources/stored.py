"""Reading stored bar tables: Parquet folders by generation and derived ``period``, of which the last commit lists the live ones."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.times import period_start
from barloom.operators.predicates import in_range
from barloom.operators.series import match_keys
from barloom.schemas import SYMBOL, TIME
from barloom.session import hadoop_path, path_exists

PERIOD, GENERATION = "period", "gen"
#: Folders inside a table that readers of bars leave alone.
LOG, MARKS = "_log", "_marks"
_NO_PERIOD = "__HIVE_DEFAULT_PARTITION__"


def prune(df: DataFrame, start, end) -> DataFrame:
    """Keep the partitions that can hold times of the range; a filter on ``time`` alone would not.

    Right for every grain, and for folders of several: the partition of a time begins on its day, its
    month or its year, and the others of the range begin later.
    """
    period = F.col(PERIOD)
    if start is not None:
        first = F.lit(start).cast("timestamp")
        holding = [period_start(first, grain) for grain in ("year", "month", "day")]
        df = df.filter((period > F.to_date(first)) | period.isin(*holding))
    if end is not None:
        df = df.filter(period <= F.to_date(F.lit(end).cast("timestamp")))
    return df


@dataclass(frozen=True)
class Snapshot:
    """State of a stored table: the number of its last commit and its live folders, ``gen=<id>/period=<day>``."""

    version: int
    folders: tuple[str, ...]

    @property
    def periods(self) -> list[str]:
        return sorted({f.rsplit("=", 1)[1] for f in self.folders})


def snapshot(spark: SparkSession, path: str) -> Snapshot:
    """The state the last commit left. Of a table without commits, all folders by period are live."""
    target, fs = hadoop_path(spark, path)
    if not fs.exists(target):
        return Snapshot(0, ())
    names = [entry.getPath().getName() for entry in fs.listStatus(target)]
    if LOG not in names:
        return Snapshot(0, tuple(sorted(n for n in names if n.startswith(f"{PERIOD}="))))
    log, _ = hadoop_path(spark, f"{path.rstrip('/')}/{LOG}")
    commits = [entry.getPath().getName() for entry in fs.listStatus(log)]
    last = max((n for n in commits if n.isdigit()), default=None)
    if last is None:
        return Snapshot(0, ())
    stream = fs.open(hadoop_path(spark, f"{path.rstrip('/')}/{LOG}/{last}")[0])
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Snapshot(int(last), tuple(text.split()))


def folder_name(generation: str | None, period) -> str:
    """A live folder's name from the values of its partition columns."""
    day = f"{PERIOD}={_NO_PERIOD if period is None else period.isoformat()}"
    return day if generation is None else f"{GENERATION}={generation}/{day}"


def read_folders(spark: SparkSession, path: str, folders, merge_schema: bool = False) -> DataFrame:
    """The rows of some folders of a table, with their ``gen`` (NULL for folders from before the first commit) and ``period``."""
    base = path.rstrip("/")
    parts = []
    for committed in (True, False):
        chosen = [f"{base}/{f}" for f in folders if f.startswith(f"{GENERATION}=") == committed]
        if chosen:
            df = spark.read.option("basePath", base).option("mergeSchema", merge_schema).parquet(*chosen)
            if df.schema[PERIOD].dataType != T.DateType():
                df = df.withColumn(PERIOD, F.col(PERIOD).cast("date"))
            parts.append(df if committed else df.withColumn(GENERATION, F.lit(None).cast("string")))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=merge_schema)


def read_stored(spark: SparkSession, path: str, schema: T.StructType, state: Snapshot | None = None) -> DataFrame:
    """A stored table with its ``period``; empty, with the given schema, where nothing is stored (any more)."""
    state = state or snapshot(spark, path)
    if state.folders:
        return read_folders(spark, path, state.folders).drop(GENERATION)
    kept = [f for f in schema.fields if f.name != PERIOD]
    return spark.createDataFrame([], T.StructType([*kept, T.StructField(PERIOD, T.DateType())]))


def read_marks(spark: SparkSession, path: str, state: Snapshot | None = None) -> DataFrame:
    """``symbol``, ``period``, ``latest`` time and ``rows`` of every live folder, without reading the bars.

    Inserts write these marks beside each generation. A folder that goes takes its marks with it, so deletes lower a symbol's
    latest time. Folders without marks are summed up from their bars.
    """
    state = state or snapshot(spark, path)
    base, columns = path.rstrip("/"), [SYMBOL, PERIOD, "latest", "rows"]
    generations = sorted({f.split("/")[0] for f in state.folders if f.startswith(f"{GENERATION}=")})
    marked = [g for g in generations if path_exists(spark, f"{base}/{MARKS}/{g}")]
    parts = []
    if marked:
        live = [tuple(part.split("=", 1)[1] for part in f.split("/")) for f in state.folders if f.split("/")[0] in marked]
        alive = spark.createDataFrame([(g, None if p == _NO_PERIOD else date.fromisoformat(p)) for g, p in live], f"{GENERATION} string, {PERIOD} date")
        kept = spark.read.option("basePath", f"{base}/{MARKS}").parquet(*[f"{base}/{MARKS}/{g}" for g in marked])
        alive = alive.select(F.col(GENERATION).alias("_gen"), F.col(PERIOD).alias("_period"))
        parts.append(kept.join(alive, match_keys({GENERATION: "_gen", PERIOD: "_period"}), "left_semi").select(columns))
    rest = [f for f in state.folders if f.split("/")[0] not in marked]
    if rest:
        parts.append(summed_up(read_folders(spark, path, rest)).select(columns))
    if not parts:
        return spark.createDataFrame([], f"{SYMBOL} string, {PERIOD} date, latest timestamp, rows long")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def summed_up(rows: DataFrame) -> DataFrame:
    """Marks of stored rows."""
    return rows.groupBy(SYMBOL, PERIOD).agg(F.max(TIME).alias("latest"), F.count(F.lit(1)).alias("rows"))


def latest_per_symbol(spark: SparkSession, path: str) -> DataFrame:
    """``symbol`` and its ``latest`` stored time, from the marks."""
    return read_marks(spark, path).groupBy(SYMBOL).agg(F.max("latest").alias("latest"))


def read_bars(
    spark: SparkSession, source: str, start=None, end=None, time_col: str = TIME,
    merge_schema: bool = False, schema: T.StructType | None = None,
) -> DataFrame:
    """Stored bars from a path or a catalog table, restricted to ``start <= time <= end`` if given.

    ``merge_schema`` brings together columns that batches added over time (raw tables). It reads every
    file's footer, so it is off unless asked for. A table that holds nothing is read with ``schema``.
    """
    is_path = "/" in source or ":" in source
    state = snapshot(spark, source) if is_path else None
    if state and state.folders:
        df = read_folders(spark, source, state.folders, merge_schema).drop(GENERATION)
    elif state and (state.version or schema is not None):
        return spark.createDataFrame([], schema or T.StructType([]))
    else:
        df = spark.read.option("mergeSchema", merge_schema).parquet(source) if is_path else spark.table(source)
    if PERIOD in df.columns:
        df = prune(df, start, end).drop(PERIOD)
    if start is not None and end is not None:
        return df.filter(in_range(start, end, time_col))
    if start is not None:
        return df.filter(F.col(time_col) >= F.lit(start).cast("timestamp"))
    if end is not None:
        return df.filter(F.col(time_col) <= F.lit(end).cast("timestamp"))
    return df


def last_period(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the latest period: enough to find a table's latest time without scanning it all.

    The period comes from the folder names; a table without them is returned whole.
    """
    state = snapshot(spark, path)
    days = [d for d in state.periods if d != _NO_PERIOD]
    if not days:
        return read_folders(spark, path, state.folders).drop(GENERATION) if state.folders else spark.read.parquet(path)
    return read_folders(spark, path, [f for f in state.folders if f.endswith(f"{PERIOD}={days[-1]}")]).drop(GENERATION)
