"""Jaccard join of documents by word n-grams: rare-first prefixes with length, positional and suffix filters.

A document is its set of different shingles, as 64-bit hashes. Equal sets are one set from the start (128-bit digest). Shingles have one global order,
rare ones first, and two sets that reach the similarity share one of the first ``n - ceil(s * n) + 1`` shingles of each, so only these prefixes
are joined; what only one set holds is never sent. How often a shingle occurs is counted exactly, but counting it sends every shingle of every set once,
so counted ones come first in the order and are one hash class in ``counted``; a set with fewer of them than its prefix needs counts (and looks
up) all its shingles. Results do not depend on it: any order that all sets share is a right one.

A joined pair must have sizes that can reach the similarity (length), enough shingles left behind the shared place (positional), and suffixes that
do not differ more than the pair may differ in all (suffix): each suffix is divided into 512 hash ranges, and the ranges in which one suffix has an odd and
the other an even number of shingles differ in one shingle at least. The first shared prefix shingle of a linked pair
passes all three, so no link is lost. Pairs are made distinct and verified once, by the intersection of the whole sets.

Members of a large group of near copies are not joined with each other. In a round every set is compared with one set only, the leader
of one of its prefix shingles: first the set with the fewest rarer shingles of its own, then a new one each
round. Linked sets have one label from then on, and shingles whose holders all have one label are settled. Rounds
go on while most of their pairs link; only what sets of different labels still share is joined in full.

Defined results. A null text counts as empty. Words are runs of anything but space and \\t\\n\\v\\f\\r, with A-Z lower-cased. Fewer words than a
shingle needs are one shingle; no words give an empty set, linked with nothing, each row its own component. Repeated rows are one set. Null identifiers never
name a component unless it has no other. An empty table gives an empty one. Extra columns are not read. A very long text is one set of its task.
"""

from __future__ import annotations

import re
from functools import lru_cache, reduce
from math import log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.common import cut_lineage, map_batches, strings
from barloom.llm.components import connected_components

WORDS = 8  # of 64 hash ranges each, for the suffix filter
#: Bytes hashed at once, cut between words.
BLOCK = 1 << 20
_ONE, _TWO = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_FACTOR, _PLACE = 0xD1342543DE82EF95, np.uint64(0x9E3779B97F4A7C15)
_LETTERS = np.random.default_rng(42).integers(0, 2**64, 256, np.uint64)
_WORD = np.array([chr(i) not in " \t\n\v\f\r" for i in range(256)])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _ONE
    x = (x ^ (x >> np.uint64(27))) * _TWO
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the factor and of its inverse, modulo 2 ** 64."""
    factors = (_FACTOR, pow(_FACTOR, -1, 1 << 64))
    return tuple(np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n, f, np.uint64)))) for f in factors)


def _block_hashes(data: bytes) -> np.ndarray:
    """A hash per word: sums of its letters' numbers times powers of their places, all words at once."""
    letters = np.frombuffer(data, np.uint8)
    powers, inverse = _powers(max(BLOCK, 1 << (len(data) - 1).bit_length()))
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = _WORD[letters]
    edges = np.flatnonzero(np.diff(inside))
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LETTERS[letters] * powers[: len(data)], out=sums[1:])
    return _mixed((sums[ends] - sums[starts]) * inverse[starts])


def word_hashes(text: str) -> np.ndarray:
    """Hashes of the words of a text, A-Z lower-cased, in order."""
    data = text.encode().lower()
    parts, at = [], 0
    while len(data) - at > BLOCK:
        cut = re.compile(rb"[\x20\x09-\x0D]").search(data, at + BLOCK)
        if not cut:
            break
        parts.append(_block_hashes(data[at : cut.start()]))
        at = cut.start()
    if len(data) > at:
        parts.append(_block_hashes(data[at:]))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def shingle_hashes(text: str, shingle: int = 3) -> np.ndarray:
    """Hashes of the different shingles of a text, sorted."""
    words = word_hashes(text)
    if not len(words):
        return words
    width = min(shingle, len(words))
    out = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        out = out * _PLACE + words[i : i + len(out)]
    out = _mixed(out)
    out.sort()
    return out[np.concatenate(([True], out[1:] != out[:-1]))]


def least_overlap(size: int, num: int, den: int) -> int:
    """Shingles a set of this size shares at least with any set it is linked with."""
    return -(-num * size // den)


def prefix_length(size: int, num: int, den: int) -> int:
    return size - least_overlap(size, num, den) + 1


def range_bits(hashes: np.ndarray) -> np.ndarray:
    """Per shingle a row of words with the bit of its hash range set: the upper nine bits."""
    place = (hashes >> np.uint64(55)).astype(np.int64)
    bits = np.zeros((len(hashes), WORDS), np.uint64)
    bits[np.arange(len(hashes)), place >> 6] = np.uint64(1) << (place & 63).astype(np.uint64)
    return bits


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, kind))


def text_name(text: str) -> Column:
    """128 bits that name a text; null counts as empty."""
    return F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))


def _marked(docs: DataFrame, doc_id: str, text: str, shingle: int, num: int, den: int, counted: int) -> DataFrame:
    """Per row: identifier, name of the text, digest and size of its set, the shingles it counts, the ranges with an odd number of shingles."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_name(text).alias("name"), F.col(text).alias("text"))
    schema = T.StructType(
        [T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("name", T.StringType()), T.StructField("key", T.BinaryType()),
         T.StructField("n", T.LongType()), T.StructField("tokens", T.ArrayType(T.LongType())), T.StructField("parts", T.ArrayType(T.LongType()))]
    )

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_hashes(value, shingle) for value in strings(batch.column(2))]
        keys = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
        told = []
        for s in sets:
            first = s[s % np.uint64(counted) == 0]
            told.append(_signed(first if len(first) >= prefix_length(len(s), num, den) else s))
        parts = [_signed(np.bitwise_xor.reduce(range_bits(s), axis=0)) for s in sets]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(keys, pa.binary()), pa.array([len(s) for s in sets], pa.int64()), _lists(told, pa.int64()), _lists(parts, pa.int64())],
            names=schema.names,
        )

    return map_batches(rows, run, schema)


SUFFIX = [f"s{i}" for i in range(WORDS)]
PREFIX = "token long, set long, n long, pos long, " + ", ".join(f"{c} long" for c in SUFFIX)


def _prefixes(sets: DataFrame, num: int, den: int, counted: int) -> DataFrame:
    """Rows (token, set, n, pos, odd ranges of what is behind it) of the prefix shingles that more than one set counts."""
    told = sets.where("n > 0").select("set", F.explode("tokens").alias("token"))
    often = told.groupBy("token").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    shared = told.join(often, "token").groupBy("set").agg(F.collect_list(F.struct("token", "often")).alias("shared"))
    rows = shared.join(sets.select("set", "n", "parts", "tokens"), "set").select(
        "set", "n", "parts", "tokens", F.transform("shared", lambda t: t["token"]).alias("shared"), F.transform("shared", lambda t: t["often"]).alias("often")
    )
    names = [c.split()[0] for c in PREFIX.split(", ")]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for place, n, parts, tokens, shared, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), *(batch.column(i) for i in (2, 3, 4, 5))):
            tokens, shared = (x.values.to_numpy().view(np.uint64) for x in (tokens, shared))
            often = np.ones(len(tokens), np.int64)
            often[np.searchsorted(tokens, shared)] = counts.values.to_numpy()
            late = tokens % np.uint64(counted) != 0
            order = np.lexsort((tokens, often, late))[: prefix_length(n, num, den)]
            tokens, often = tokens[order], often[order]
            rest = parts.values.to_numpy() ^ _signed(np.bitwise_xor.accumulate(range_bits(tokens), axis=0))
            held = np.flatnonzero(often > 1)
            fixed = [_signed(tokens[held]), np.full(len(held), place), np.full(len(held), n), held + 1]
            out.append(np.column_stack([*fixed, rest[held]]))
        rows = np.concatenate(out) if out else np.zeros((0, len(names)), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in rows.T], names=names)

    return map_batches(rows, run, PREFIX)


def _full(docs: DataFrame, text: str, wanted: DataFrame, shingle: int) -> DataFrame:
    """set and all its shingles, for the wanted sets (set, name of a text that has it)."""
    texts = docs.select(text_name(text).alias("name"), F.col(text).alias("text")).join(wanted.select("name"), "name", "left_semi")
    texts = texts.groupBy("name").agg(F.first("text").alias("text")).join(wanted, "name").select("set", "text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [_signed(shingle_hashes(value, shingle)) for value in strings(batch.column(1))]
        return pa.RecordBatch.from_arrays([batch.column(0), _lists(sets, pa.int64())], names=["set", "tokens"])

    return map_batches(texts, run, "set long, tokens array<long>")


def _reaches(a: str, b: str, num: int, den: int) -> Column:
    """Length, positional and suffix filter for rows ``a`` and ``b`` of the prefix table that share a shingle."""
    na, nb, ia, ib = (F.col(f"{side}.{c}") for c in ("n", "pos") for side in (a, b))
    both = na + nb
    need = F.expr(f"({num} * ({a}.n + {b}.n) + {num + den - 1}) div {num + den}")
    length = (den * F.least(na, nb)) >= (num * F.greatest(na, nb))
    positional = 1 + F.least(na - ia, nb - ib) >= need
    apart = reduce(lambda x, y: x + y, [F.bit_count(F.col(f"{a}.{c}").bitwiseXOR(F.col(f"{b}.{c}"))) for c in SUFFIX])
    return length & positional & ((ia - 1) + (ib - 1) + apart <= both - 2 * need)


def _verified(pairs: DataFrame, full: DataFrame, num: int, den: int) -> DataFrame:
    """The rows of pairs (a, b and others) whose sets reach the similarity."""
    left = full.select(F.col("set").alias("a"), F.col("tokens").alias("_a"))
    right = full.select(F.col("set").alias("b"), F.col("tokens").alias("_b"))
    both = F.size(F.array_intersect("_a", "_b"))
    met = pairs.join(left, "a").join(right, "b")
    return met.where((num + den) * both >= num * (F.size("_a") + F.size("_b"))).select(pairs.columns)


def _relabelled(rows: DataFrame, linked: DataFrame) -> DataFrame:
    """Rows with coarser labels after new links (between labels la, lb), without the shingles whose holders have one label.

    Equal labels mean connected sets, but connected sets may have different labels: two steps towards the smallest neighbour are taken, no more.
    """
    edges = linked.select("la", "lb").union(linked.select("lb", "la"))
    least = cut_lineage(edges.groupBy(F.col("la").alias("label")).agg(F.least(F.first("la"), F.min("lb")).alias("next")))
    again = least.select(F.col("label").alias("next"), F.col("next").alias("last"))
    new = least.join(again, "next", "left").select("label", F.coalesce("last", "next").alias("new"))
    return _open(rows.join(new, "label", "left").withColumn("label", F.coalesce("new", "label")).drop("new"))


def _open(rows: DataFrame) -> DataFrame:
    """Rows of the shingles whose holders have several labels."""
    several = rows.groupBy("token").agg(F.min("label").alias("_l"), F.max("label").alias("_m")).where("_l <> _m").select("token")
    return cut_lineage(rows.join(several, "token"))


def similar_sets(prefixes: DataFrame, full: DataFrame, num: int, den: int) -> DataFrame:
    """root (smallest set reachable over links) of every set that is not its own root, as (node, root)."""
    band = F.floor(F.log(F.col("n").cast("double")) / log(den / num)).cast("long")
    rows, links, number = _open(prefixes.withColumns({"band": band, "label": F.col("set")})), [], 0
    while True:
        number += 1
        # The fewer rare shingles a set has before the shared one, the nearer it is to all that share it: such sets lead first.
        rank = lambda side: F.struct(F.col(f"{side}pos") if number == 1 else F.lit(0), F.xxhash64(f"{side}set", F.lit(number)), f"{side}set")
        told = F.struct(*[F.col(c) for c in rows.columns if c not in ("token", "band")])
        leaders = rows.groupBy("token", "band").agg(F.min_by(told, rank("")).alias("l"))
        leaders = leaders.select("token", "band", "l.*")
        tried = rows.alias("m").join(leaders.alias("l"), ["token", "band"]).where((F.col("m.label") != F.col("l.label")) & _reaches("m", "l", num, den))
        best = F.min_by(F.struct(F.col("l.set").alias("b"), F.col("l.label").alias("lb")), rank("l."))
        tried = tried.groupBy(F.col("m.set").alias("a"), F.col("m.label").alias("la")).agg(best.alias("l"))
        tried = cut_lineage(tried.select("a", "la", "l.*"))
        linked = cut_lineage(_verified(tried, full, num, den))
        pairs, new = tried.count(), linked.count()
        if new:
            links.append(linked.select("a", "b"))
            rows = _relabelled(rows, linked)
            full = cut_lineage(full.join(rows.select("set").distinct(), "set", "left_semi"))
        if new * 2 < pairs or not pairs:
            break
    # Sizes of a pair lie in one band or in two neighbouring ones.
    smaller = rows.withColumn("band", F.explode(F.array(F.col("band"), F.col("band") + 1)))
    order = (F.col("a.n") < F.col("b.n")) | ((F.col("a.n") == F.col("b.n")) & (F.col("a.set") < F.col("b.set")))
    met = smaller.alias("a").join(rows.alias("b"), ["token", "band"]).where((F.col("a.label") != F.col("b.label")) & order & _reaches("a", "b", num, den))
    pairs = cut_lineage(met.select(F.col("a.set").alias("a"), F.col("b.set").alias("b")).distinct())
    links.append(_verified(pairs, full, num, den))
    return connected_components(reduce(DataFrame.unionByName, links))


def similar_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, similarity: tuple[int, int] = (90, 100), counted: int = 4
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id. Linked: ``den * intersection >= num * union`` for similarity (num, den)."""
    num, den = similarity
    marked = cut_lineage(_marked(docs, doc_id, text, shingle, num, den, counted))
    one = marked.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.min("name").alias("name"), *(F.first(c).alias(c) for c in ("n", "tokens", "parts")))
    sets = cut_lineage(one.withColumn("set", F.monotonically_increasing_id()))
    prefixes = cut_lineage(_prefixes(sets, num, den, counted))
    wanted = cut_lineage(sets.join(prefixes.select("set").distinct(), "set").select("set", "name"))
    full = cut_lineage(_full(docs, text, wanted, shingle))
    roots = similar_sets(prefixes, full, num, den)
    rooted = sets.where("n > 0").select("key", "set", "doc_id").join(roots, F.col("set") == F.col("node"), "left").withColumn("root", F.coalesce("root", "set"))
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = rooted.join(least, "root").select("key", "component_id")
    rows = marked.select("doc_id", "key", F.col("n").alias("n_shingles")).join(named, "key", "left")
    return rows.select("doc_id", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
