"""Column lists and explicit schemas of the two product lines."""

from __future__ import annotations

from pyspark.sql import types as T

TIME = "time"
SYMBOL = "symbol"
#: Ingestion ordinal: a unique, source-supplied key that breaks ties in time.
ORD = "_ord"

OHLC = ["open", "high", "low", "close"]
FUTURES_FIELDS = [TIME, SYMBOL, *OHLC, "volume"]

# Stored columns of adjusted prices, of prices, of floating numbers and of equity bars.
ADJUSTED = ["adj_open", "adj_high", "adj_low", "adjusted_close"]
EQUITY_PRICES = [*OHLC, *ADJUSTED]
EQUITY_FLOATS = [*EQUITY_PRICES, "adj_volume", "div_cash", "split_factor"]
EQUITY_FIELDS = [
    TIME, SYMBOL, *OHLC, "volume", *ADJUSTED, "adj_volume", "div_cash", "split_factor",
]

# The equity provider's field names and the stored names they map to.
EQUITY_FIELD_NAMES = {
    "date": "time",
    "adjOpen": "adj_open",
    "adjHigh": "adj_high",
    "adjLow": "adj_low",
    "adjClose": "adjusted_close",
    "adjVolume": "adj_volume",
    "divCash": "div_cash",
    "splitFactor": "split_factor",
}

# Full-size index futures traded and stored as their micro contracts.
MICRO_CONTRACTS = {"ES": "MES", "RTY": "M2K", "NQ": "MNQ", "YM": "MYM"}

# Continuous-contract roll rules (calendar, open interest, volume).
ROLL_RULES = ("c", "n", "v")

# The asset classes the engine accepts.
ASSET_TYPES = ("FUTURE", "EQUITY")

FUTURES_SCHEMA = T.StructType(
    [
        T.StructField(TIME, T.TimestampType(), False),
        T.StructField(SYMBOL, T.StringType(), False),
        *[T.StructField(c, T.DoubleType()) for c in OHLC],
        T.StructField("volume", T.LongType()),
    ]
)

EQUITY_SCHEMA = T.StructType(
    [
        T.StructField(TIME, T.TimestampType(), False),
        T.StructField(SYMBOL, T.StringType(), False),
        *[T.StructField(c, T.DoubleType()) for c in OHLC],
        T.StructField("volume", T.LongType()),
        *[T.StructField(c, T.DoubleType()) for c in [*ADJUSTED, "adj_volume", "div_cash", "split_factor"]],
    ]
)

# Fields of the equity provider's JSON record. Read as text: one odd value must not fail the file.
EQUITY_JSON_FIELDS = [
    "date", *OHLC, "volume", "adjOpen", "adjHigh", "adjLow", "adjClose", "adjVolume", "divCash", "splitFactor",
]
EQUITY_JSON_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in EQUITY_JSON_FIELDS])

CONTRACT_REQUIRED = ["dataSymbol", "instrumentType"]
