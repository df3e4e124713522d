import re

import pytest

from barloom.llm import pii

# The contract's patterns as they are written.
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    found = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            total = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits)))
            fits = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 12 <= len(digits) <= 19 and total % 10 == 0,
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if fits:
                found.append((kind, *m.span()))
    return sorted(found, key=lambda s: (s[1], list(BASE).index(s[0])))


def texts(rng):
    parts = ["a@b.c", "a@b", "x@y.z.w@q.r", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 123-4567",
             "+1 5", "++12 345 678 901", "é", "@", "..", "0004111111111111111100", "a.b-c%d+e@f-g.h", "7", " ", "-", ".", "me@here.org@there.com", "0255.1.1.1"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(3000)]


def test_base_spans_are_those_of_the_patterns(rng):
    for text in texts(rng):
        assert [s[:3] for s in pii.find(text) if s[0] in pii.BASE] == plain(text), text


def test_further_kinds_need_evidence():
    good = "GB82 WEST 1234 5698 7654 32"
    assert [s[0] for s in pii.find(f"pay to {good}.") if s[0] not in pii.BASE] == ["iban"]
    assert not [s for s in pii.find("pay to GB83 WEST 1234 5698 7654 32.") if s[0] == "iban"]
    assert [s[0] for s in pii.find("my SSN is 123-45-6789")] == ["ssn"]
    assert pii.find("part 123-45-6789") == []
    near = pii.find("call my phone +1 555 123 4567")[0][3]
    assert near > pii.find("xxxx +1 555 123 4567")[0][3]


def test_table(spark):
    rows = [(1, "mail a@b.co now"), (None, None), (2, ""), (2, ""), (3, "x" * 200_000 + " " + "1" * 100_000 + "@" * 1000)]
    got = pii.find_spans(spark.createDataFrame(rows, "doc_id long, text string"), keep=["doc_id"]).collect()
    assert len(got) == 5 and [tuple(s)[:3] for r in got if r.doc_id == 1 for s in r.spans] == [("email", 5, 11)]
    with pytest.raises(ValueError):
        pii.find_spans(spark.createDataFrame([(1, "a", 1)], "doc_id long, text string, SPANS int"))
    assert pii.find_spans(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_mask(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, "é a@b.co and 1.2.3.4!"), (2, "nothing")], "doc_id long, text string")
    found = pii.find_spans(df).select("doc_id", pii.mask(F.col("text"), F.col("spans")).alias("m")).orderBy("doc_id").collect()
    assert [r.m for r in found] == ["é [email] and [ip]!", "nothing"]


@pytest.mark.parametrize(
    "before, iban, after",
    [
        ("IBAN ", "DE89 3704 0044 0532 0130 00", " BIC COBADEFF"),
        ("to ", "GB82WEST12345698765432", " I paid"),
        ("to ", "GB82 WEST 1234 5698 7654 32", " 2024 AND MORE CAPITAL WORDS"),
        ("REF AB12 ", "DE89370400440532013000", " 17"),
        ("", "NO9386011117947", " 5 NOK"),
        ("unknown country ", "ZZ22 3704 0044 0532 0130 00", " BIC"),
    ],
)
def test_iban_before_capitals_and_digits(before, iban, after):
    text = f"{before}{iban}{after}"
    assert [s[:3] for s in pii.find(text) if s[0] == "iban"] == [("iban", len(before), len(before) + len(iban))]


def test_no_iban_of_another_length():
    assert not [s for s in pii.find("IBAN DE89 3704 0044 0532 0130 00X and DE89 3704 0044 0532 0130") if s[0] == "iban"]
