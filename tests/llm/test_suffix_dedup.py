import numpy as np
import pytest

from barloom.llm.suffix_dedup import COVER, V, removed_bytes, repeated_suffixes, stretches

SCHEMA = "doc_id long, text string"


def brute(rows, length):
    """Bytes covered by a string of ``length`` bytes that starts at another place too."""
    texts = [(r[1] or "").encode() for r in rows]
    places = {}
    for i, data in enumerate(texts):
        for s in range(len(data) - length + 1):
            places.setdefault(data[s : s + length], []).append((i, s))
    covered = [bytearray(len(data)) for data in texts]
    for found in places.values():
        if len(found) > 1:
            for i, s in found:
                covered[i][s : s + length] = b"\1" * length
    kept = [bytes(b for b, c in zip(data, mask) if not c) for data, mask in zip(texts, covered)]
    spans = [sum(m[i] and not (i and m[i - 1]) for i in range(len(m))) for m in covered]
    return sorted((str(r[0]), len(t), s, k) for r, t, s, k in zip(rows, texts, spans, kept))


def texts_of(rng):
    """Random texts with shared passages, near copies, periods and many characters of two bytes."""
    word = lambda: "".join(rng.choice("abcé") for _ in range(rng.randint(1, 6)))
    passages = [" ".join(word() for _ in range(40)) for _ in range(4)]
    rows = []
    for i in range(60):
        parts = [" ".join(word() for _ in range(rng.randint(0, 30))) for _ in range(3)]
        parts.insert(rng.randint(0, 3), rng.choice([*passages, "", "ab" * rng.randint(10, 200), "z" * rng.randint(1, 300)]))
        rows.append((i, " ".join(parts)))
    base = rows[0][1] * 3
    for i in range(60, 75):
        at = rng.randrange(len(base))
        rows.append((i, f"{base[:at]}#{base[at + 1:]}"))
    return [*rows, (75, None), (76, ""), (77, "short"), (None, passages[0]), (5, rows[5][1]), (5, rows[5][1]), (6, passages[1])]


@pytest.mark.parametrize("length, gram, bucket, block", [(60, 32, 4096, 1 << 20), (60, 40, 3, 500), (90, 33, 1, 1)])
def test_against_brute_force(spark, rng, length, gram, bucket, block):
    rows = texts_of(rng)
    got = removed_bytes(spark.createDataFrame(rows, SCHEMA), length=length, gram=gram, bucket=bucket, block=block).collect()
    assert sorted((str(r.doc_id), r.n_bytes, len(r.spans), bytes(r.kept)) for r in got) == brute(rows, length)


def test_empty_table_and_extra_columns(spark):
    assert removed_bytes(spark.createDataFrame([], SCHEMA)).collect() == []
    odd = spark.createDataFrame([(1, "x" * 900, 1, "a")], f"{SCHEMA}, anchor int, key string")
    assert removed_bytes(odd).first().kept == b""


def test_cover_holds_all_differences():
    assert {(a - b) % V for a in COVER for b in COVER} == set(range(V))


def test_suffix_sort_marks_equal_prefixes(rng):
    data = bytes(rng.choice(b"ab") for _ in range(3000)) + b"ab" * 300
    data = np.frombuffer(data + data[100:700], np.uint8)
    starts = np.arange(len(data) - 100)
    windows = [data[s : s + 100].tobytes() for s in starts]
    want = np.array([windows.count(w) > 1 for w in windows])
    assert (repeated_suffixes(data, starts, 100) == want).all()


def test_equal_windows_have_equal_anchors(rng):
    data = np.frombuffer(bytes(rng.choice(b"abcdefgh") for _ in range(2000)), np.uint8)
    seen = {}
    for shift in (0, 77):
        anchor, first, n = stretches(data[shift:], 100, 40)
        for a, f, k in zip(anchor, first, n):
            for s in range(f, f + k):
                assert seen.setdefault(data[shift + s : shift + s + 100].tobytes(), a) == a
