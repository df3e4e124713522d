import base64
import sys

import pytest

from barloom.llm import bpe

public_tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts(rng):
    some = ["".join(rng.choice("abcdeéß€ 'theinqurs\n\t 0123　\x85\x1c😀A") for _ in range(rng.randint(1, 60))) for _ in range(400)]
    return [*some, "", "a" * 30_000, " " * 9_000, "it's we'll I'D", "<|endoftext|>", "ab" * 9_000, "日本語" * 50, "\n\n x \n"]


def test_round_trip_against_the_library(spark, rng, encoding):
    rows = [(i, t) for i, t in enumerate(texts(rng))] + [(None, None), (1, "again"), (1, "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = bpe.round_trip(df, PATH, PATTERN).collect()
    want = sorted((str(i), encoding.encode_ordinary(t or ""), t or "") for i, t in rows)
    assert sorted((str(r.doc_id), r.ids, r.decoded) for r in got) == want
    two = bpe.decode(bpe.encode(df, PATH, PATTERN, keep_text=False), PATH).collect()
    assert sorted((str(r.doc_id), r.ids, r.decoded) for r in two) == want


def test_full_caches_do_not_change_ids(rng, encoding):
    small = bpe.MergeTransducer(bpe.read_ranks(PATH), max_states=40, max_words=30)
    small.FLUSH = 16
    for text in texts(rng):
        for word in bpe.regex.compile(bpe.white_space(PATTERN)).findall(text):
            assert small.encode(word.encode()) == encoding.encode_ordinary(word)
            assert bpe.array("i", small.words[word]).tolist() == encoding.encode_ordinary(word)


def test_memory_of_remembered_words_is_bounded_in_any_script(monkeypatch):
    machine = bpe.MergeTransducer(bpe.read_ranks(PATH))
    monkeypatch.setattr(machine, "encode", lambda piece: [1] * len(piece))  # the memory is the test's matter, not the ids
    size = sys.getsizeof
    for words in ((f"w{i}" for i in range(900_000)), (f"{'日本語' * 19}{i:06d}" for i in range(200_000))):
        for word in words:
            machine.words[word]
        held = [machine.words, machine.words.older]
        assert sum(size(d) + sum(size(k) + size(v) for k, v in d.items()) for d in held) < 100 << 20


def test_a_word_is_remembered_once_and_kept_while_asked_for(encoding):
    small = bpe.MergeTransducer(bpe.read_ranks(PATH), max_states=40, max_bytes=2_000)
    for word in ["usual", *(f"{'日本語' * 9}{i}" for i in range(60)), "usual", *map(str, range(5))]:
        assert bpe.array("i", small.words[word]).tolist() == encoding.encode_ordinary(word)
        assert bpe.array("i", small.words["usual"]).tolist() == encoding.encode_ordinary("usual")
        assert len(small.words) + len(small.words.older) < 30
        assert not small.words.keys() & small.words.older.keys()


def test_streaming_decode_between_any_tokens(rng, encoding):
    decoder = bpe.decoder(PATH)
    ids = encoding.encode_ordinary("naïve 😀 日本 ñandú €")
    assert "".join(decoder.stream([i] for i in ids)) == "naïve 😀 日本 ñandú €"
    for _ in range(200):
        odd = [rng.randrange(256) for _ in range(12)]  # single bytes: mostly not UTF-8
        data = b"".join(decoder.tokens[i] for i in odd)
        assert decoder.decode(odd) == data.decode("utf-8", "replace")


def test_another_pattern(spark):
    assert bpe.USUAL_PATTERN == PATTERN
    df = spark.createDataFrame([(1, "ab cd")], "doc_id long, text string")
    own = tiktoken.Encoding("own", pat_str=r"\S|\s", mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})
    assert bpe.encode(df, PATH, r"\S|\s").first().ids == own.encode_ordinary("ab cd")


def test_bad_ids_clashing_names_and_empty_tables(spark):
    df = spark.createDataFrame([(1, [99_999])], "doc_id long, ids array<int>")
    with pytest.raises(Exception):
        bpe.decode(df, PATH).collect()
    with pytest.raises(ValueError):
        bpe.encode(spark.createDataFrame([(1, "x", 2)], "doc_id long, text string, IDS int"), PATH, PATTERN)
    assert bpe.round_trip(spark.createDataFrame([], "doc_id long, text string"), PATH, PATTERN).collect() == []
