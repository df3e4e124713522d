"""Symbol spelling rules and the host-independent symbol hash."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from barloom.schemas import MICRO_CONTRACTS

_HEX_WORD = 8
_WORDS = 5
_WORD_VALUES = 1 << (4 * _HEX_WORD)


def strip(c: Column) -> Column:
    """Remove surrounding whitespace of every kind (``trim`` alone removes only spaces)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def upper_symbol(c: Column) -> Column:
    return F.upper(strip(c))


def ticker(c: Column) -> Column:
    """Share-class spelling of the equity provider: ``brk.b`` becomes ``BRK-B``."""
    return F.replace(upper_symbol(c), F.lit("."), F.lit("-"))


def canonical(symbol: Column, kind: Column, roll: str, rank: str | int) -> Column:
    """Stored name: micro contract, roll rule and rank for futures; the plain symbol for equities."""
    micro = F.create_map(*[F.lit(x) for x in chain.from_iterable(MICRO_CONTRACTS.items())])
    base = F.coalesce(F.try_element_at(micro, symbol), symbol)
    return F.when(
        (kind == "FUTURE") & symbol.isNotNull(), F.concat_ws(".", base, F.lit(roll), F.lit(str(rank)))
    ).when(kind == "EQUITY", symbol)


def stable_bucket(c: Column, buckets: int) -> Column:
    """SHA-1 of the text modulo ``buckets``; the same on every host and in every run.

    The 160-bit digest does not fit a long, so its five 32-bit words are folded with Horner's rule.
    """
    if buckets < 1:
        raise ValueError("buckets must be at least 1")
    digest = F.sha1(c.cast("string").cast("binary"))
    carry = _WORD_VALUES % buckets
    rest = F.lit(0).cast("bigint")
    for word in range(_WORDS):
        value = F.conv(F.substring(digest, 1 + word * _HEX_WORD, _HEX_WORD), 16, 10).cast("bigint")
        rest = F.pmod(rest * F.lit(carry) + value, F.lit(buckets).cast("bigint"))
    return rest
