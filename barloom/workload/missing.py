"""Missing-data policies, whole and with series split into segments."""

from __future__ import annotations

from barloom.operators import fill
from barloom.workload.registry import query, rounded

#: Far below any real limit, so that series of the test tables are split as hot ones would be.
SMALL = 300
COLS = ["close", "volume"]
_W = "PARTITION BY symbol ORDER BY time NULLS FIRST, _ord"
_BACK = f"OVER ({_W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
_FORTH = f"OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


@query("SELECT * FROM dirty WHERE symbol IS NOT NULL AND time IS NOT NULL AND close IS NOT NULL AND volume IS NOT NULL")
def fill_drop_missing(t):
    return fill.drop_missing(t.dirty())


_FFILL = (
    f"SELECT _ord, symbol, time, last_value(close IGNORE NULLS) {_FORTH} AS close,"
    f" last_value(volume IGNORE NULLS) {_FORTH} AS volume FROM dirty"
)
_BFILL = (
    f"SELECT _ord, symbol, time, first_value(close IGNORE NULLS) {_BACK} AS close,"
    f" first_value(volume IGNORE NULLS) {_BACK} AS volume FROM dirty"
)


def _line(c: str) -> str:
    return (
        f"round(CASE WHEN {c} IS NOT NULL THEN {c} WHEN nv_{c} IS NULL THEN pv_{c}"
        f" ELSE pv_{c} + (nv_{c} - pv_{c}) * (i - pi_{c}) / (ni_{c} - pi_{c}) END, 6) AS {c}"
    )


def _ends(c: str) -> str:
    return (
        f"last_value({c} IGNORE NULLS) {_FORTH} AS pv_{c},"
        f" last_value(CASE WHEN {c} IS NOT NULL THEN i END IGNORE NULLS) {_FORTH} AS pi_{c},"
        f" first_value({c} IGNORE NULLS) {_BACK} AS nv_{c},"
        f" first_value(CASE WHEN {c} IS NOT NULL THEN i END IGNORE NULLS) {_BACK} AS ni_{c}"
    )


_INTERPOLATED = (
    f"WITH numbered AS (SELECT *, CAST(row_number() OVER ({_W}) AS DOUBLE) AS i FROM dirty),"
    f" ends AS (SELECT *, {_ends('close')}, {_ends('volume')} FROM numbered)"
    f" SELECT _ord, symbol, time, {_line('close')}, {_line('volume')} FROM ends"
)


@query(_FFILL)
def fill_forward(t):
    return fill.forward_fill(t.dirty(), COLS)


@query(_FFILL)
def fill_forward_split(t):
    return fill.forward_fill(t.dirty(), COLS, max_rows=SMALL)


@query(_BFILL)
def fill_backward(t):
    return fill.backward_fill(t.dirty(), COLS)


@query(_BFILL)
def fill_backward_split(t):
    return fill.backward_fill(t.dirty(), COLS, max_rows=SMALL)


@query(_INTERPOLATED)
def fill_interpolate(t):
    return rounded(fill.interpolate(t.dirty(), COLS), *COLS)


@query(_INTERPOLATED)
def fill_interpolate_split(t):
    return rounded(fill.interpolate(t.dirty(), COLS, max_rows=SMALL), *COLS)


@query("SELECT _ord, symbol, time, coalesce(close, 0) AS close, coalesce(volume, 0) AS volume FROM dirty")
def fill_zero(t):
    return fill.zero_fill(t.dirty(), COLS)


@query(
    "SELECT _ord, symbol, time, round(coalesce(close, avg(close) OVER (PARTITION BY symbol)), 6) AS close,"
    " round(coalesce(volume, avg(volume) OVER (PARTITION BY symbol)), 6) AS volume FROM dirty"
)
def fill_mean(t):
    return rounded(fill.mean_fill(t.dirty(), COLS), *COLS)


_MEDIAN = (
    "WITH m AS (SELECT symbol, median(close) AS mc, median(volume) AS mv FROM dirty GROUP BY symbol)"
    " SELECT _ord, symbol, time, round(coalesce(close, mc), 6) AS close,"
    " round(coalesce(CAST(volume AS DOUBLE), mv), 6) AS volume FROM dirty JOIN m USING (symbol)"
)


@query(_MEDIAN)
def fill_median(t):
    return rounded(fill.median_fill(t.dirty(), COLS), *COLS)


@query(_MEDIAN)
def fill_median_split(t):
    return rounded(fill.handle_missing(t.dirty(), ["median_fill"], max_rows=SMALL), *COLS)


@query("SELECT _ord, symbol, time, coalesce(close, 7) AS close, coalesce(volume, 7) AS volume FROM dirty")
def fill_custom(t):
    return fill.custom_fill(t.dirty(), COLS, "7")


_SEQUENCE = (
    f"WITH filled AS ({_FFILL})"
    " SELECT _ord, symbol, time, round(coalesce(close, 0), 6) AS close, coalesce(volume, 0) AS volume FROM filled"
)
_CONFIG = {"forward_fill": "True", "zero_fill": "True", "drop_nan": "False", "mean_fill": "true"}


@query(_SEQUENCE)
def fill_sequence(t):
    """Forward fill, then zeros for what is left; ``"true"`` in lower case does not enable a policy."""
    return rounded(fill.handle_missing(t.dirty(), _CONFIG), "close")


@query(_SEQUENCE)
def fill_sequence_split(t):
    return rounded(fill.handle_missing(t.dirty(), _CONFIG, max_rows=SMALL), "close")


@query(
    f"WITH forth AS ({_FFILL}),"
    f" both_ways AS (SELECT _ord, symbol, time, first_value(close IGNORE NULLS) {_BACK} AS close,"
    f" first_value(volume IGNORE NULLS) {_BACK} AS volume FROM forth)"
    " SELECT * FROM both_ways"
)
def fill_both_ways_split(t):
    """Two ordered policies in a row over split series, lineage cut in between."""
    return fill.handle_missing(t.dirty(), ["forward_fill", "backward_fill"], max_rows=SMALL)
