"""Registered queries of the operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import bpe, chat_format, decontaminate, exact_dedup, html_extract, line_dedup, line_quality, merkle, ngram_join, pii, prefix_trie, simhash, suffix_dedup
from barloom.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def tokenizer() -> tuple[str, str]:
    """Rank file and pre-tokenising pattern of the production tokenizer."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@query
def op2_pii_spans(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = pii.find_spans(docs, keep=["doc_id"])

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE))
    return found.select(
        "doc_id", *(count(kind) for kind in pii.BASE), F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )


@query
def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(spark, f"{folder}/documents.parquet")


ORACLES["op4_exact_dedup"] = """
WITH n AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents
), g AS (
  SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY norm
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM n JOIN g USING (norm)
"""


@query
def op6_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks, pattern = tokenizer()
    coded = bpe.round_trip(table(spark, folder, "documents"), ranks, pattern)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op7_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    kept = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs), counts=True)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLES["op8_line_dedup"] = r"""
WITH d AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), l AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM d
), k AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), g AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), m AS (
  SELECT k.*, coalesce(k.doc_id <> g.keeper, FALSE) AS dropped FROM k LEFT JOIN g USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


@query
def op10_html_extract(spark: SparkSession, folder: str) -> DataFrame:
    return html_extract.extract(table(spark, folder, "pages")).withColumn("n_chars", F.length("text").cast("long"))


@query
def op9_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = suffix_dedup.removed_bytes(table(spark, folder, "documents"))
    return cut.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


#: Score from which a document counts as good.
GOOD = 0.3


def held_out() -> Column:
    """Rows that quality is never learned from."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0


def quality_model(spark: SparkSession, folder: str) -> line_quality.Model:
    labels = table(spark, folder, "labels").where(~held_out())
    return line_quality.train(table(spark, folder, "documents").select("doc_id", "text"), labels)


@query
def op3_line_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = line_quality.score(docs, quality_model(spark, folder))
    held = F.coalesce(held_out(), F.lit(False)).alias("held_out")
    return scored.select("doc_id", held, "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))


@query
def op5_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find_passages(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.groupBy("doc_id", "item_id").agg(
        F.count(F.lit(1)).alias("n_regions"), F.min("begin").alias("begin"), F.max("end").alias("end"), F.min("edits").alias("edits")
    )


@query
def op1_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    return chat_format.format_chats(table(spark, folder, "conversations"))


def _hex(name: str) -> Column:
    return F.lower(F.hex(name)).alias(name)


@query
def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 0
    changed = {"n_chars": F.col("n_chars") + F.when(tampered, 1).otherwise(0)}
    found = merkle.manifest(table(spark, folder, "documents"), changed=changed)
    return found.select(
        "doc_id", _hex("leaf"), _hex("subroot"), _hex("root"), F.sha2(F.lower(F.hex("proof")), 256).alias("proof_sha256"), _hex("folded_root"),
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


@query
def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    convs = prefix_trie.sequences(table(spark, folder, "conversations"))
    taken = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(9)).cast("int")
    return prefix_trie.prefix_nodes(prefix_trie.rebuilt(convs, F.col("conv_id") - F.col("conv_id") % 5, taken, most=8))


@query
def op11_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.similar_documents(table(spark, folder, "documents"))

#: CRC-32 of a text of ASCII characters, for the SQL below.
_CRC32 = """xor(4294967295, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST({} AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, k: xor(v >> 1, 3988292384 * (v & 1)))))"""

_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE concat(strlen(CAST({0} AS VARCHAR)), ':', {0}) END"
_LEAF = "sha256(concat(" + ", ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "{n}", "text")) + "))"

ORACLES["op12_merkle_manifest"] = f"""
WITH RECURSIVE d AS (
  SELECT *, CASE WHEN {_CRC32.format('doc_id')} % 7 = 0 THEN n_chars + 1 ELSE n_chars END AS later_chars FROM documents
), leaves AS (
  SELECT doc_id, lang, {_LEAF.format(n='n_chars')} AS leaf, {_LEAF.format(n='later_chars')} AS later FROM d
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY lang) AS n FROM leaves
), low AS (
  SELECT 0 AS level, lang, place, leaf AS h, n FROM placed
  UNION ALL
  SELECT level + 1, lang, place // 2, sha256(string_agg(h, '' ORDER BY place)), any_value((n + 1) // 2) FROM low WHERE n > 1 GROUP BY level, lang, place // 2
), subroots AS (
  SELECT lang, h, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM low WHERE n = 1
), high AS (
  SELECT 0 AS level, place, h, n FROM subroots
  UNION ALL
  SELECT level + 1, place // 2, sha256(string_agg(h, '' ORDER BY place)), any_value((n + 1) // 2) FROM high WHERE n > 1 GROUP BY level, place // 2
), steps AS (
  SELECT p.doc_id, p.leaf, o.level AS step, o.h AS other, o.place % 2 = 1 AS other_right
  FROM placed p JOIN low o ON o.lang IS NOT DISTINCT FROM p.lang AND o.place = xor(p.place >> o.level, 1) AND o.n > 1
  UNION ALL
  SELECT p.doc_id, p.leaf, 100 + o.level, o.h, o.place % 2 = 1
  FROM placed p JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang JOIN high o ON o.place = xor(s.place >> o.level, 1) AND o.n > 1
), levels AS (
  SELECT doc_id, leaf, later, lang, unnest(generate_series(0, CAST((SELECT max(level) FROM low l WHERE l.lang IS NOT DISTINCT FROM placed.lang) - 1 AS BIGINT))) AS step FROM placed
  UNION ALL
  SELECT doc_id, leaf, later, lang, unnest(generate_series(100, CAST((SELECT max(level) FROM high) + 99 AS BIGINT))) FROM placed
), ways AS (
  SELECT l.doc_id, l.leaf, l.later, row_number() OVER (PARTITION BY l.doc_id, l.leaf ORDER BY l.step) AS step, s.other, s.other_right
  FROM levels l LEFT JOIN steps s ON s.doc_id IS NOT DISTINCT FROM l.doc_id AND s.leaf = l.leaf AND s.step = l.step
), fold AS (
  SELECT doc_id, leaf, later AS h, 0 AS step FROM placed
  UNION ALL
  SELECT f.doc_id, f.leaf, sha256(CASE WHEN other IS NULL THEN h WHEN other_right THEN concat(h, other) ELSE concat(other, h) END), f.step + 1
  FROM fold f JOIN ways w ON w.doc_id IS NOT DISTINCT FROM f.doc_id AND w.leaf = f.leaf AND w.step = f.step + 1
), folded AS (
  SELECT doc_id, leaf, arg_max(h, step) AS h FROM fold GROUP BY doc_id, leaf
), proofs AS (
  SELECT doc_id, leaf, sha256(coalesce(string_agg(other, '' ORDER BY step), '')) AS proof_sha256 FROM ways GROUP BY doc_id, leaf
)
SELECT p.doc_id, p.leaf, s.h AS subroot, r.h AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256, f.h AS folded_root, f.h = r.h AS verified
FROM placed p JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang JOIN (SELECT h FROM high WHERE n = 1) r ON true
JOIN folded f ON f.doc_id IS NOT DISTINCT FROM p.doc_id AND f.leaf = p.leaf
LEFT JOIN proofs q ON q.doc_id IS NOT DISTINCT FROM p.doc_id AND q.leaf = p.leaf
"""

ORACLES["op13_prefix_trie"] = f"""
WITH own AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i, coalesce(text, '') AS text,
         md5(concat(strlen(coalesce(role, '')), ':', role, text)) AS token FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, {_CRC32.format('conv_id')} % 9 AS h FROM (SELECT DISTINCT conv_id FROM own)
), turns AS (
  SELECT c.conv_id, 0 AS part, o.i, o.text, o.token FROM convs c JOIN own o ON o.conv_id = c.base AND o.i <= c.h
  UNION ALL
  SELECT c.conv_id, 1, o.i, o.text, o.token FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.i > c.h
), paths AS (
  SELECT conv_id, row_number() OVER w AS depth, string_agg(token, '') OVER w AS path, strlen(text) AS bytes FROM turns
  WINDOW w AS (PARTITION BY conv_id ORDER BY part, i)
  UNION ALL SELECT conv_id, 0, '', 0 FROM convs
), longest AS (
  SELECT conv_id, max(depth) AS depth FROM paths GROUP BY conv_id
), nodes AS (
  SELECT path, any_value(p.depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(bytes) AS own_saved,
         coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (p.depth = l.depth), '') AS ends
  FROM paths p JOIN longest l USING (conv_id) GROUP BY path
), kids AS (
  SELECT substr(path, 1, 32 * (depth - 1)) AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1
), up AS (
  SELECT unnest(list_transform(generate_series(0, depth), lambda d: substr(n.path, 1, 32 * d))) AS path, own_saved, k.path IS NULL AS leaf FROM nodes n LEFT JOIN kids k USING (path)
), sums AS (
  SELECT path, sum(own_saved) AS saved, count(*) FILTER (leaf) AS n_leaves FROM up GROUP BY path
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children, s.n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens,
       sha256(n.ends) AS ends_sha256
FROM nodes n JOIN sums s USING (path) LEFT JOIN kids k USING (path) LEFT JOIN nodes p ON n.depth > 0 AND p.path = substr(n.path, 1, 32 * (n.depth - 1))
"""

ORACLES["op11_ngram_jaccard_join"] = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents
), s AS (
  SELECT r, doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
         ELSE list_distinct(list_transform(generate_series(1, len(words) - 2), lambda i: concat_ws(' ', words[i], words[i + 1], words[i + 2]))) END AS shingles FROM d
), t AS (
  SELECT r, hash(unnest(shingles)) AS token FROM s
), links AS (
  SELECT a.r AS a, b.r AS b FROM t a JOIN t b ON a.token = b.token AND a.r < b.r JOIN s x ON x.r = a.r JOIN s y ON y.r = b.r
  WHERE len(x.shingles) >= 0.8999 * len(y.shingles) AND len(y.shingles) >= 0.8999 * len(x.shingles)
  GROUP BY a.r, b.r, len(x.shingles), len(y.shingles) HAVING 190 * count(*) >= 90 * (len(x.shingles) + len(y.shingles))
), sides AS (
  SELECT a, b FROM links UNION SELECT b, a FROM links
), reach AS (
  SELECT r AS a, r AS b FROM s UNION SELECT reach.a, sides.b FROM reach JOIN sides ON reach.b = sides.a
)
SELECT s.doc_id, CAST(len(s.shingles) AS BIGINT) AS n_shingles, min(o.doc_id) AS component_id
FROM s JOIN reach ON reach.a = s.r JOIN s o ON o.r = reach.b GROUP BY s.r, s.doc_id, len(s.shingles)
"""
