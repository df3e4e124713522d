"""Main text of web pages by deducing the template that pages of one host share.

A page is read as tokens: its tags, each with the path of tags (and classes) above it, and its texts, those of the article too. The
occurrence vector of a token counts it on every page of its host; two random linear hashes of the vector stand for it, which are
sums over pages and so are added up before and after the shuffle, however many pages a host has. Tokens of one host with the same
vector are an equivalence class. It is valid if it covers most pages of its host, has several tokens, a tag among them, and its tokens first occur in the
same order on all its pages. Classes nest by the paths of their tags; together they are the template, and what they leave over is the slots. The
main slot is the deepest tag of the template that holds other blocks and most of the text that is in no class.

Text of a valid class is template, but for one case: pages that are near copies (editions, mirrors) share their article too. Where the texts of a class
are half or more of the main slot on the pages that have it, they are the content of copies, and stay.

What is left of a page is its main slot without template texts. Tag, role and class words are further evidence: parts
they call something else are left out before, and where a page has ``<article>`` or ``<main>`` elements, the slot is widened to the innermost of
them around it (a heading beside the body stays), or else what is in them is kept of the slot.

Defined results. A null html is an empty page: empty text. A null url is a host of its own. Broken markup is read as far as it goes: open
tags end with the page, unknown end tags are skipped, a cut tag is dropped. Character references are decoded (in the text only), white space inside a block
is one space, blocks are joined by one \\n; ``<br>`` is white space. A page whose text is all template keeps it rather than losing
everything. Repeated rows are repeated results (they count as pages of their host); an empty table gives an empty one. Extra columns
are not read; only those named in ``keep`` are carried along.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.common import SLICE, cut_lineage, strings

MARKUP = re.compile(r"<!--.*?(?:-->|$)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*(?:>|$)|<[A-Za-z][^<>]*$", re.S)
#: One attribute after another: any name, and its value, quoted or not.
ATTRIBUTE = re.compile(r"""([^\s/>=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Tags that a start tag of the key ends, if one is open within the nearest of the given limits.
ENDS = {"li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}),
        "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
OUTSIDE_TAGS = frozenset("head nav aside form footer script style noscript template iframe svg canvas object button select textarea dialog menu title".split())
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
OUTSIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements sponsor sponsored promo banner cookie cookies consent notice notices popup modal newsletter "
    "subscribe signup sidebar menu nav navbar navigation breadcrumb breadcrumbs header footer masthead comment comments respond disqus "
    "share sharing social related login search".split()
)
#: On the elements that hold the main text only these words count.
OUTSIDE_ARTICLE_WORDS = frozenset("ad ads advert advertisement sponsored promo comment comments related".split())
MAIN = frozenset(["article", "main"])


@dataclass
class Node:
    """A text with the path above it."""

    path: str
    block: int
    outside: bool
    main: bool
    text: str


@dataclass
class Page:
    tags: list[str] = field(default_factory=list)
    nodes: list[Node] = field(default_factory=list)
    #: Tags (as digests) and texts in order.
    order: list[tuple[int, Node | None]] = field(default_factory=list)


def _attributes(source: str) -> dict[str, str]:
    """Values by lower-case name; of a repeated name the first counts."""
    found: dict[str, str] = {}
    for name, value in ATTRIBUTE.findall(source):
        found.setdefault(name.lower(), value[1:-1] if value[:1] in ("'", '"') and value[:1] == value[-1:] else value)
    return found


def _outside(tag: str, attributes: dict[str, str], in_main: bool) -> bool:
    if tag in OUTSIDE_TAGS or (tag == "header" and not in_main):
        return True
    if not attributes:
        return False
    if attributes.get("role", "").lower() in OUTSIDE_ROLES or attributes.get("aria-hidden", "").lower() == "true":
        return True
    if "hidden" in attributes or re.search(r"display\s*:\s*none", attributes.get("style", ""), re.I):
        return True
    if tag in ("html", "body"):
        return False
    words = set(re.split(r"[^a-z0-9]+", f"{attributes.get('class', '')} {attributes.get('id', '')}".lower()))
    return bool(words & (OUTSIDE_ARTICLE_WORDS if tag in MAIN else OUTSIDE_WORDS))


def read_page(source: str) -> Page:
    """Tags with their paths and texts of a page, in order."""
    page = Page()
    stack: list[tuple[str, str, bool, bool]] = []  # tag, path, outside, main
    block, at, size = 0, 0, len(source)

    def text(upto: int) -> None:
        if upto > at and source[at:upto].strip():
            _, path, outside, main = stack[-1] if stack else ("", "", False, False)
            page.nodes.append(Node(path, block, outside, main, source[at:upto]))
            page.order.append((0, page.nodes[-1]))
        elif upto > at and page.nodes and page.nodes[-1].block == block:
            page.nodes[-1].text += " "

    def pop_to(tags: set[str] | frozenset[str], limits: set[str] | frozenset[str]) -> None:
        for depth in range(len(stack) - 1, -1, -1):
            if stack[depth][0] in tags:
                del stack[depth:]
                return
            if stack[depth][0] in limits:
                return

    while at < size:
        found = MARKUP.search(source, at)
        if not found:
            text(size)
            break
        text(found.start())
        at = found.end()
        tag = (found.group(2) or "").lower()
        if not tag:
            continue
        if tag == "br":
            if page.nodes and page.nodes[-1].block == block:
                page.nodes[-1].text += " "
            continue
        block += tag in BLOCK
        if found.group(1):
            if any(open_[0] == tag for open_ in stack):
                pop_to({tag}, frozenset())
            continue
        if tag in BLOCK and tag not in ("html", "body"):
            pop_to({"p"}, {"article", "main", "section", "div", "table", "td", "th", "li", "body", "button", "blockquote"})
        if tag in ENDS:
            pop_to(*ENDS[tag])
        attributes = _attributes(found.group(3))
        _, path, outside, main = stack[-1] if stack else ("", "", False, False)
        name = ".".join([tag, *sorted(attributes.get("class", "").split())]) + (f"#{attributes['id']}" if "id" in attributes else "")
        path = f"{path}/{name}"
        outside = outside or _outside(tag, attributes, main)
        main = main or (not outside and (tag in MAIN or attributes.get("role", "").lower() == "main"))
        page.tags.append(path)
        page.order.append((tag_digest(path), None))
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(source, at)
            at = end.end() if end else size
        elif tag not in VOID and not found.group(3).rstrip().endswith("/"):
            stack.append((tag, path, outside, main))
    return page


def _blocks(nodes: list[Node]) -> str:
    blocks: dict[int, list[str]] = {}
    for node in nodes:
        blocks.setdefault(node.block, []).append(node.text)
    lines = (" ".join(entities.unescape("".join(parts)).split()) for parts in blocks.values())
    return "\n".join(line for line in lines if line)


def digest(path: str, text: str) -> int:
    return xxhash.xxh64_intdigest(f"{path}\n{' '.join(text.split())}") - (1 << 63)


@lru_cache(maxsize=1 << 16)
def tag_digest(path: str) -> int:
    return digest(path, "")


def main_text(source: str, slot: str | None, fixed: frozenset[int]) -> str:
    """Text of a page, given its host's main slot and template texts."""
    inside = [node for node in read_page(source).nodes if not node.outside]
    article = [node for node in inside if node.main]
    if slot:
        frame = slot
        if article:
            parts = slot.split("/")
            depth = max((i for i, part in enumerate(parts) if re.split(r"[.#]", part)[0] in MAIN), default=len(parts) - 1)
            frame = "/".join(parts[: depth + 1])
        below = [node for node in article or inside if within(node.path, frame)]
        inside = below or article or inside
    else:
        inside = article or inside
    own = [node for node in inside if digest(node.path, node.text) not in fixed] if fixed else inside
    return _blocks(own or inside)


def within(path: str, frame: str) -> bool:
    return path == frame or path.startswith(f"{frame}/")


TOKENS = "host string, kind int, token string, digest long, pages long, total long, first long, second long, chars long"


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch, host and token: pages, occurrences, both hashes of the occurrence vector, characters of (or below) it."""
    for batch in (whole.slice(i, SLICE) for whole in batches for i in range(0, whole.num_rows, SLICE)):
        sums: dict[tuple, list[int]] = {}
        for host, source, number in zip(strings(batch.column(0)), strings(batch.column(1)), batch.column(2).to_pylist()):
            page = read_page(source)
            seen: dict[tuple, list[int]] = {(host, 0, "", 0): [1, 0]}
            for path in page.tags:
                seen.setdefault((host, 0, path, tag_digest(path)), [0, 0])[0] += 1
            for node in page.nodes:
                if node.outside:
                    continue
                known = seen.setdefault((host, 1, node.path, digest(node.path, node.text)), [0, 0])
                known[0] += 1
                known[1] += len(node.text)
                path = node.path
                while path:
                    seen.setdefault((host, 0, path, tag_digest(path)), [0, 0])[1] += len(node.text)
                    path = path.rpartition("/")[0]
                seen[host, 0, "", 0][1] += len(node.text)
            mark = f"{number}"
            first, second = xxhash.xxh32_intdigest(mark, 1) >> 1, xxhash.xxh32_intdigest(mark, 2) >> 1
            for key, (count, chars) in seen.items():
                known = sums.setdefault(key, [0, 0, 0, 0, 0])
                for i, value in enumerate((int(count > 0), count, first * count, second * count, chars)):
                    known[i] += value
        rows = [[*key, *values] for key, values in sums.items()]
        columns = list(zip(*rows)) or [[]] * 9
        kinds = [pa.string(), pa.int32(), pa.string(), *[pa.int64()] * 6]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[x.split()[0] for x in TOKENS.split(", ")])


#: What holds other blocks: a main slot ends in one of these, not in a paragraph.
CONTAINER = r"(^|/)(html|body|main|article|section|div|table|tbody|tr|td|center|blockquote|header|form|fieldset|details|dialog|figure)([.#][^/]*)?$"
CLASSES = "host string, first long, second long, own long, slot_chars long, way_low long, way_high long"


def _class_use(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per page and class of its host: the order of its tokens (hashed), its text and all text in the main slot."""
    names, kinds = [c.split()[0] for c in CLASSES.split(", ")], [pa.string(), *[pa.int64()] * 6]
    for batch in (whole.slice(i, SLICE) for whole in batches for i in range(0, whole.num_rows, SLICE)):
        rows, known, members = [], None, {}
        for host, source, slot, tokens in zip(strings(batch.column(0)), strings(batch.column(1)), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            if host != known:
                known, members = host, {t["digest"]: (t["first"], t["second"]) for t in tokens}
            page = read_page(source)
            ways: dict[tuple[int, int], dict[int, None]] = {}
            own: dict[tuple[int, int], int] = {}
            total = 0
            for mark, node in page.order:
                if node and node.outside:
                    continue
                if node and slot and within(node.path, slot):
                    total += len(node.text)
                if key := members.get(mark if node is None else digest(node.path, node.text)):
                    ways.setdefault(key, {}).setdefault(mark if node is None else digest(node.path, node.text))
                    if node and slot and within(node.path, slot):
                        own[key] = own.get(key, 0) + len(node.text)
            for key, way in ways.items():
                hashed = xxhash.xxh64_intdigest(",".join(map(str, way))) >> 1
                rows.append((host, *key, own.get(key, 0), total, hashed, hashed))
        columns = list(zip(*rows)) or [[]] * 7
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def templates(pages: DataFrame, support: float = 0.5, least_pages: int = 3, copied: float = 0.5) -> DataFrame:
    """Per host: its main slot and the digests of its template texts, from pages with columns host, html and number."""
    tokens = pages.select("host", "html", "number").mapInArrow(_tokens, TOKENS)
    summed = tokens.groupBy("host", "kind", "token", "digest").agg(*(F.sum(c).alias(c) for c in ("pages", "total", "first", "second", "chars")))
    summed = cut_lineage(summed)
    hosts = summed.where("kind = 0 AND token = ''").select("host", F.col("pages").alias("host_pages"), F.col("chars").alias("host_chars"))
    covered = summed.join(hosts, "host").where((F.col("token") != "") & (F.col("pages") >= least_pages) & (F.col("pages") >= support * F.col("host_pages")))
    # At most 1 / support times the tokens of a page are left of a host, so a class and a template are never large.
    sizes = covered.groupBy("host", "first", "second").agg(F.count_if(F.col("kind") == 0).alias("tags"), F.count_if(F.col("kind") == 1).alias("texts"))
    several = sizes.where("tags > 0 AND texts > 0").select("host", "first", "second")
    classed = cut_lineage(covered.join(several, ["host", "first", "second"]))

    # Text that is in no class, below each tag: all text below it without the texts of classes.
    above = F.expr("transform(sequence(2, size(split(token, '/'))), i -> array_join(slice(split(token, '/'), 1, i), '/'))")
    held = classed.where("kind = 1").select("host", F.explode(above).alias("token"), F.col("chars").alias("held")).groupBy("host", "token").agg(F.sum("held").alias("held"))
    in_all = classed.where("kind = 1").groupBy("host").agg(F.sum("chars").alias("held_all"))
    tags = covered.where((F.col("kind") == 0) & F.col("token").rlike(CONTAINER)).join(held, ["host", "token"], "left").join(in_all, "host", "left")
    free = F.col("chars") - F.coalesce("held", F.lit(0))
    all_free = F.col("host_chars") - F.coalesce("held_all", F.lit(0))
    most = F.when(all_free > 0, free >= 0.6 * all_free).otherwise((F.col("chars") >= 0.6 * F.col("host_chars")) & (F.col("host_chars") > 0))
    slots = cut_lineage(tags.where(most).groupBy("host").agg(F.max_by("token", F.struct(F.length("token"), "token")).alias("slot")))

    listed = classed.groupBy("host").agg(F.collect_list(F.struct("digest", "first", "second")).alias("tokens"))
    used = pages.select("host", "html").join(listed, "host").join(slots, "host", "left").select("host", "html", "slot", "tokens").mapInArrow(_class_use, CLASSES)
    judged = used.groupBy("host", "first", "second").agg(
        F.sum("own").alias("own"), F.sum("slot_chars").alias("slot_chars"), F.min("way_low").alias("low"), F.max("way_high").alias("high")
    )
    template = judged.where((F.col("low") == F.col("high")) & (F.col("own") < copied * F.col("slot_chars"))).select("host", "first", "second")
    texts = classed.where("kind = 1").join(template, ["host", "first", "second"])
    fixed = texts.groupBy("host").agg(F.collect_list("digest").alias("fixed"))
    return hosts.select("host").join(slots, "host", "left").join(fixed, "host", "left")


def host_of(url: str) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def extract(pages: DataFrame, url: str = "url", html: str = "html", keep: tuple[str, ...] = ("page_id",), out: str = "text") -> DataFrame:
    """The columns in ``keep``, the url and the main text of every page."""
    carried = [*keep, url]
    if out in carried:
        raise ValueError(f"the table already has a column {out}")
    number = F.xxhash64(F.col(url), F.col(html))
    found = cut_lineage(templates(pages.select(host_of(url).alias("host"), F.col(html).alias("html"), number.alias("number"))))
    source = pages.select(F.struct(*carried).alias("row"), host_of(url).alias("host"), F.col(html).alias("html"))
    joined = source.join(found, "host", "left").select("row.*", F.col("html").alias("_html"), "slot", "fixed")
    schema = T.StructType([*(pages.schema[c] for c in carried), T.StructField(out, T.StringType(), False)])
    names, width = schema.names, len(carried)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sources, slots, fixed = strings(batch.column(width)), batch.column(width + 1).to_pylist(), batch.column(width + 2).to_pylist()
            texts = [main_text(s, slot, frozenset(f or ())) for s, slot, f in zip(sources, slots, fixed)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], pa.array(texts, pa.string())], names=names)

    return joined.mapInArrow(run, schema)
