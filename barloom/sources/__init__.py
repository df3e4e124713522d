from barloom.sources.landing import (
    load_contracts, read_constituents, read_contracts, read_equity_json, read_futures_bars,
)
from barloom.sources.stored import read_bars

__all__ = [
    "load_contracts", "read_bars", "read_constituents", "read_contracts", "read_equity_json", "read_futures_bars",
]
