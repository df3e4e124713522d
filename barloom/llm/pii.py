"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score.

Four base kinds (email, ip, card, phone) are fixed by pattern and validator alone: their context only moves the score, never the
decision. Further kinds need more evidence. An IBAN has the length of its country (of unknown countries: the longest end at a border
that passes) and must pass the mod-97 check; a US social security number has no checksum, so
it needs a word nearby that names it and a score of at least ``threshold``.

Defined results. A null text counts as empty and has no spans. Offsets are code points, the end exclusive. Matches of one kind are
leftmost and do not overlap; different kinds may. A match that its validator refuses is dropped and the search goes on behind
it (an IBAN: behind its check digits). Spans are ordered by start, then by kind in the order of `KINDS`. Every step is linear in the length of the text, whatever
it holds. Repeated rows give repeated results, an empty table gives an empty table. Extra columns are carried along
unless they have the name of an output column: that raises an error.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.common import map_batches, strings

KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE = KINDS[:4]
SPAN = T.StructType(
    [
        T.StructField("kind", T.StringType(), False),
        T.StructField("start", T.IntegerType(), False),
        T.StructField("end", T.IntegerType(), False),
        T.StructField("score", T.DoubleType(), False),
    ]
)

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
#: A run of digits is taken whole, so no digit of it is looked at twice.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}")
IBAN_SIZE = {
    country: size
    for size, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
        27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}
ALPHANUMERIC = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")

#: Base score of a confirmed span, and the words that raise or lower it when they stand near.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.9, "phone": 0.7, "iban": 0.9, "ssn": 0.3}
HINTS = {
    "email": ("mail", "contact", "write to"),
    "ip": ("ip", "address", "host", "server"),
    "card": ("card", "visa", "credit", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
    "iban": ("iban", "account", "bank"),
    "ssn": ("ssn", "social security"),
}
DOUBTS = {"ip": ("version", "release", "section"), "card": ("order", "isbn", "serial"), "phone": ("version", "isbn")}
RAISE, LOWER, NEAR = 0.3, 0.3, 40


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) << (place & 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def mod97(iban: str) -> bool:
    compact = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97 == 1


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def octet(part: str) -> bool:
    value = part.lstrip("0")
    return len(value) <= 3 and int(value or 0) <= 255


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From each ``@`` back over the local part, but not into an earlier match, and on over the domain."""
    floor, at = 0, text.find("@")
    while at >= 0:
        before = text[floor:at]
        start = floor + len(before.rstrip(LOCAL))
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        floor = domain.end() if domain else at + 1
        at = text.find("@", floor)


def iban_end(text: str, start: int) -> int | None:
    """End of the IBAN whose country and check digits are at ``start``; looks at no more than 34 characters and the spaces between."""
    country, end, ends = text[start : start + 2], start + 4, []
    for size in range(5, 35):
        at = end + (text[end : end + 1] == " ")
        if text[at : at + 1] not in ALPHANUMERIC or text[at].islower():
            break
        end = at + 1
        if size >= 15 and size == IBAN_SIZE.get(country, size) and text[end : end + 1] not in ALPHANUMERIC:
            ends.append(end)
    return next((e for e in reversed(ends) if mod97(text[start:e])), None)


def ibans(text: str) -> Iterator[tuple[int, int]]:
    found = IBAN.search(text)
    while found:
        end = iban_end(text, found.start())
        if end:
            yield found.start(), end
        found = IBAN.search(text, end or found.end())


def proposals(text: str) -> Iterator[tuple[str, int, int]]:
    """Confirmed spans of every kind, unordered."""
    for start, end in emails(text):
        yield "email", start, end
    for found in CARD.finditer(text):
        digits = digits_of(found.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            yield "card", *found.span()
    for found in IP.finditer(text):
        if all(octet(part) for part in found.group().split(".")):
            yield "ip", *found.span()
    if "+" in text:
        for found in PHONE.finditer(text):
            if 9 <= len(digits_of(found.group())) <= 15:
                yield "phone", *found.span()
    for start, end in ibans(text):
        yield "iban", start, end
    for found in SSN.finditer(text):
        area, group, serial = found.group().split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield "ssn", *found.span()


def score(kind: str, text: str, start: int, end: int) -> float:
    near = f"{text[max(0, start - NEAR):start]} {text[end:end + NEAR]}".lower()
    value = PRIOR[kind]
    if any(word in near for word in HINTS[kind]):
        value += RAISE
    if any(word in near for word in DOUBTS.get(kind, ())):
        value -= LOWER
    return round(min(1.0, max(0.0, value)), 3)


def find(text: str, threshold: float = 0.5) -> list[tuple[str, int, int, float]]:
    """Spans of one text in order."""
    found = [(kind, start, end, score(kind, text, start, end)) for kind, start, end in proposals(text)]
    kept = [span for span in found if span[0] in BASE or span[3] >= threshold]
    return sorted(kept, key=lambda span: (span[1], KINDS.index(span[0]), span[2]))


def find_spans(docs: DataFrame, text: str = "text", out: str = "spans", threshold: float = 0.5, keep: list[str] | None = None) -> DataFrame:
    """Add the array of spans found in ``text``; ``keep`` names the other columns to carry along (default: all)."""
    carried = [c for c in docs.columns if keep is None or c in keep]
    if any(c.lower() == out.lower() for c in carried):
        raise ValueError(f"the table already has a column {out}")
    schema = T.StructType([*(docs.schema[c] for c in carried), T.StructField(out, T.ArrayType(SPAN, False), False)])
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = strings(batch.column(batch.schema.get_field_index(text)))
        spans = [[dict(zip(("kind", "start", "end", "score"), s)) for s in find(value, threshold)] for value in texts]
        return pa.RecordBatch.from_arrays(
            [*(batch.column(batch.schema.get_field_index(c)) for c in carried), pa.array(spans, arrow)], names=[*carried, out]
        )

    return map_batches(docs, run, schema)


def mask(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; of overlapping spans the first takes the place of all."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("text"))

    def put(done: Column, span: Column) -> Column:
        before = F.substring(text, done["at"] + 1, span["start"] - done["at"])
        grown = F.struct(span["end"].alias("at"), F.concat(done["text"], before, F.lit("["), span["kind"], F.lit("]")).alias("text"))
        longer = F.struct(F.greatest(done["at"], span["end"]).alias("at"), done["text"].alias("text"))
        return F.when(span["start"] >= done["at"], grown).otherwise(longer)

    return F.aggregate(
        spans, start, put, lambda done: F.concat(done["text"], F.substring(text, done["at"] + 1, F.length(text)))
    )
