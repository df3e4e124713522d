"""Bar-shaped views over the given tables, for the registered queries.

The library itself does not build bars from ticks; these views only give its operators something of
the right shape to run on. Every view reads whole tables. The CASE expressions put dirt into rows
(missing, negative, padded or unreadable values), they select none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.session import ensure_session


class Tables:
    """The given tables of one folder and the views on them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = ensure_session(spark)
        self.folder = folder

    def read(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        naive = [f.name for f in df.schema if f.dataType.typeName() == "timestamp_ntz"]
        return df.withColumns({c: F.col(c).cast("timestamp") for c in naive}) if naive else df

    def bars(self, grain: str = "day") -> DataFrame:
        """Clean bars per event type and day: key (symbol, time)."""
        return (
            self.read("events")
            .groupBy(F.col("event_type").alias("symbol"), F.date_trunc(grain, "ts").alias("time"))
            .agg(
                F.min_by("value", "event_id").alias("open"),
                F.max("value").alias("high"),
                F.min("value").alias("low"),
                F.max_by("value", "event_id").alias("close"),
                F.count(F.lit(1)).alias("volume"),
            )
        )

    def dirty(self) -> DataFrame:
        """One row per event: padded symbols, missing keys and values, copies of (symbol, time)."""
        return self.read("events").selectExpr(
            "event_id AS _ord",
            "CASE WHEN event_id % 4 = 0 THEN concat(' ', event_type, ' ') ELSE event_type END AS symbol",
            "CASE WHEN event_id % 101 = 0 THEN NULL ELSE date_trunc('hour', ts) END AS time",
            "CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 97 = 0 THEN -value ELSE value END AS close",
            "CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 89 = 0 THEN -1 ELSE user_id END AS volume",
        )

    def texts(self) -> DataFrame:
        """Dirty rows whose numbers and times arrive as text, some of it unreadable."""
        return self.read("events").selectExpr(
            "event_id AS _ord",
            "event_type AS symbol",
            "CASE WHEN event_id % 103 = 0 THEN 'not a time'"
            " ELSE date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'.000Z'\") END AS time",
            "CASE WHEN event_id % 13 = 0 THEN 'bad' WHEN event_id % 7 = 0 THEN NULL ELSE CAST(value AS STRING) END AS close",
            "CASE WHEN event_id % 17 = 0 THEN '10.7' WHEN event_id % 19 = 0 THEN 'bad'"
            " WHEN event_id % 11 = 0 THEN NULL ELSE CAST(user_id AS STRING) END AS volume",
        )

    def rolls(self) -> DataFrame:
        """Contracts that change weekly within ten series; ``_ord`` is the contract number."""
        return (
            self.read("events")
            .groupBy(
                (F.col("user_id") % 10).alias("series"),
                F.floor((F.day("ts") - 1) / 7).cast("bigint").alias("_ord"),
                F.date_trunc("day", "ts").alias("time"),
            )
            .agg(
                F.min_by("value", "event_id").alias("open"),
                F.max("value").alias("high"),
                F.min("value").alias("low"),
                F.max_by("value", "event_id").alias("close"),
                F.count(F.lit(1)).alias("volume"),
            )
            .withColumn("symbol", F.concat(F.lit("C"), F.col("_ord").cast("string")))
        )

    def landed_futures(self) -> DataFrame:
        """Futures bars as landed: time in ``ts_event``, an extra column, some prices missing."""
        return self.rolls().select(
            "series", "symbol", F.col("time").alias("ts_event"), "high", "low",
            F.expr("CASE WHEN volume % 7 = 0 THEN NULL ELSE open END").alias("open"),
            F.expr("CASE WHEN volume % 5 = 0 THEN NULL ELSE close END").alias("close"),
            "volume", F.lit(1).alias("publisher"), "_ord",
        )

    def user_bars(self) -> DataFrame:
        """One bar per event with the user as symbol; a few prices and volumes cannot be typed."""
        return self.read("events").selectExpr(
            "event_id AS _ord",
            "concat('U', user_id) AS symbol",
            "date_trunc('day', ts) AS time",
            "CASE WHEN event_id % 997 = 0 THEN 'bad' ELSE CAST(value AS STRING) END AS open",
            "value AS high", "value AS low",
            "CASE WHEN event_id % 991 = 0 THEN NULL ELSE value END AS close",
            "CASE WHEN event_id % 1009 = 0 THEN NULL ELSE user_id END AS volume",
        )

    def equities(self) -> DataFrame:
        """Raw equity rows, one per event, with every kind of defect and a column too many."""
        return self.read("events").selectExpr(
            "event_id AS _ord",
            "CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 103 = 0 THEN 'not a time'"
            " ELSE date_format(date_trunc('hour', ts), \"yyyy-MM-dd'T'HH:mm:ss'.000Z'\") END AS time",
            "CASE WHEN event_id % 107 = 0 THEN NULL WHEN event_id % 4 = 0 THEN concat(' ', event_type, ' ')"
            " ELSE event_type END AS symbol",
            "value AS open", "value + 1 AS high", "value / 2 AS low",
            "CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 97 = 0 THEN -value ELSE value END AS close",
            "CASE WHEN event_id % 17 = 0 THEN '10.7' WHEN event_id % 19 = 0 THEN 'bad'"
            " WHEN event_id % 89 = 0 THEN '-1' WHEN event_id % 11 = 0 THEN NULL ELSE CAST(user_id AS STRING) END AS volume",
            "value / 4 AS adj_open", "value / 4 + 1 AS adj_high", "value / 8 AS adj_low", "value / 4 AS adjusted_close",
            "user_id * 1.5D AS adj_volume", "0.0D AS div_cash", "1.0D AS split_factor",
            "props AS junk_extra",
        )

    def hours(self) -> DataFrame:
        return self.read("events").select(
            F.col("event_type").alias("symbol"), F.date_trunc("hour", "ts").alias("time")
        ).distinct()

    def user_days(self) -> DataFrame:
        return self.read("events").select(
            F.concat(F.lit("U"), F.col("user_id")).alias("symbol"), F.date_trunc("day", "ts").alias("time")
        ).distinct()

    def contracts(self) -> DataFrame:
        """Contract list: colliding symbols after stripping, mixed asset types, fractional multiplier."""
        return self.read("part").selectExpr(
            "p_partkey AS _ord",
            "p_name AS assetDesc",
            "p_brand AS underlying",
            "CASE p_partkey % 5 WHEN 0 THEN 'ES' WHEN 1 THEN 'NQ' ELSE concat('P', p_partkey) END AS base",
            "CASE WHEN p_partkey % 3 = 0 THEN concat(' P', p_partkey div 2, ' ') ELSE concat('P', p_partkey div 2) END AS dataSymbol",
            "CASE p_size % 3 WHEN 0 THEN 'future' WHEN 1 THEN 'EQUITY' ELSE 'OPTION' END AS instrumentType",
            "p_retailprice / 10 AS multiplier",
        )


#: The same views for the SQL side.
SQL_VIEWS = {
    "bars": """
        SELECT event_type AS symbol, date_trunc('day', ts) AS time,
               arg_min(value, event_id) AS open, max(value) AS high, min(value) AS low,
               arg_max(value, event_id) AS close, count(*) AS volume
        FROM events GROUP BY event_type, date_trunc('day', ts)""",
    "hour_bars": """
        SELECT event_type AS symbol, date_trunc('hour', ts) AS time,
               arg_min(value, event_id) AS open, max(value) AS high, min(value) AS low,
               arg_max(value, event_id) AS close, count(*) AS volume
        FROM events GROUP BY event_type, date_trunc('hour', ts)""",
    "dirty": """
        SELECT event_id AS _ord,
               CASE WHEN event_id % 4 = 0 THEN concat(' ', event_type, ' ') ELSE event_type END AS symbol,
               CASE WHEN event_id % 101 = 0 THEN NULL ELSE date_trunc('hour', ts) END AS time,
               CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 97 = 0 THEN -value ELSE value END AS close,
               CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 89 = 0 THEN -1 ELSE user_id END AS volume
        FROM events""",
    "texts": """
        SELECT event_id AS _ord, event_type AS symbol,
               CASE WHEN event_id % 103 = 0 THEN 'not a time'
                    ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.000Z') END AS time,
               CASE WHEN event_id % 13 = 0 THEN 'bad' WHEN event_id % 7 = 0 THEN NULL
                    ELSE CAST(value AS VARCHAR) END AS close,
               CASE WHEN event_id % 17 = 0 THEN '10.7' WHEN event_id % 19 = 0 THEN 'bad'
                    WHEN event_id % 11 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS volume
        FROM events""",
    "rolls": """
        SELECT user_id % 10 AS series, CAST(floor((day(ts) - 1) / 7) AS BIGINT) AS _ord,
               date_trunc('day', ts) AS time,
               arg_min(value, event_id) AS open, max(value) AS high, min(value) AS low,
               arg_max(value, event_id) AS close, count(*) AS volume,
               concat('C', CAST(floor((day(ts) - 1) / 7) AS BIGINT)) AS symbol
        FROM events
        GROUP BY user_id % 10, CAST(floor((day(ts) - 1) / 7) AS BIGINT), date_trunc('day', ts)""",
    "landed_futures": """
        SELECT series, symbol, time AS ts_event, high, low,
               CASE WHEN volume % 7 = 0 THEN NULL ELSE open END AS open,
               CASE WHEN volume % 5 = 0 THEN NULL ELSE close END AS close, volume, _ord
        FROM rolls""",
    "user_bars": """
        SELECT event_id AS _ord, concat('U', user_id) AS symbol, date_trunc('day', ts) AS time,
               CASE WHEN event_id % 997 = 0 THEN 'bad' ELSE CAST(value AS VARCHAR) END AS open,
               value AS high, value AS low,
               CASE WHEN event_id % 991 = 0 THEN NULL ELSE value END AS close,
               CASE WHEN event_id % 1009 = 0 THEN NULL ELSE user_id END AS volume
        FROM events""",
    "equities": """
        SELECT event_id AS _ord,
               CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 103 = 0 THEN 'not a time'
                    ELSE strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%S.000Z') END AS time,
               CASE WHEN event_id % 107 = 0 THEN NULL WHEN event_id % 4 = 0 THEN concat(' ', event_type, ' ')
                    ELSE event_type END AS symbol,
               value AS open, value + 1 AS high, value / 2 AS low,
               CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 97 = 0 THEN -value ELSE value END AS close,
               CASE WHEN event_id % 17 = 0 THEN '10.7' WHEN event_id % 19 = 0 THEN 'bad'
                    WHEN event_id % 89 = 0 THEN '-1' WHEN event_id % 11 = 0 THEN NULL
                    ELSE CAST(user_id AS VARCHAR) END AS volume,
               value / 4 AS adj_open, value / 4 + 1 AS adj_high, value / 8 AS adj_low, value / 4 AS adjusted_close,
               user_id * CAST(1.5 AS DOUBLE) AS adj_volume, CAST(0 AS DOUBLE) AS div_cash,
               CAST(1 AS DOUBLE) AS split_factor
        FROM events""",
    "hours": "SELECT DISTINCT event_type AS symbol, date_trunc('hour', ts) AS time FROM events",
    "user_days": "SELECT DISTINCT concat('U', user_id) AS symbol, date_trunc('day', ts) AS time FROM events",
    "contracts": """
        SELECT p_partkey AS _ord, p_name AS assetDesc, p_brand AS underlying,
               CASE p_partkey % 5 WHEN 0 THEN 'ES' WHEN 1 THEN 'NQ' ELSE concat('P', p_partkey) END AS base,
               CASE WHEN p_partkey % 3 = 0 THEN concat(' P', p_partkey // 2, ' ')
                    ELSE concat('P', p_partkey // 2) END AS dataSymbol,
               CASE p_size % 3 WHEN 0 THEN 'future' WHEN 1 THEN 'EQUITY' ELSE 'OPTION' END AS instrumentType,
               p_retailprice / 10 AS multiplier
        FROM part""",
}
