import re

import pytest

from barloom.llm import html_extract
from barloom.llm.html_extract import extract, main_text, read_page

SCHEMA = "page_id long, url string, html string"
NONE = frozenset()


def plain(source):
    return main_text(source, None, NONE)


@pytest.mark.parametrize(
    "source, text",
    [
        ("", ""),
        ("just  text &amp; more", "just text & more"),
        ("<article><h1>A</h1><p>b<b>c</b>\n d<br>e<p>f</article><footer>no</footer>", "A\nbc d e\nf"),
        ("<nav>no</nav><div class='ad box'>no</div><main><p>yes<p></main><aside>no</aside>", "yes"),
        ("<p>a<script>if (a<b) x('</p>')</script><style>p{}</style>b</p>", "ab"),
        ("<article><p>x</p><div class=comments><article class=comment>no</article></div><form>no</form></article>", "x"),
        ("<header>no</header><article><header><h1>T</h1></header><p>x</article>", "T\nx"),
        ("<article><p>cut off &am", "cut off &am"),
        ("<article><p>cut <b>in a tag</b><a href='x", "cut in a tag"),
        ("<!-- <article>no</article> --><p hidden>no</p><p style='display: none'>no</p><p>yes</p>", "yes"),
        ("</p></div><ul><li>a<li>b</ul>&copy;&#65;&#x42;", "a\nb\n©AB"),
        ("<title>no</title><p>a&nbsp;&nbsp;b\t c</p>", "a b c"),
    ],
)
def test_pages(source, text):
    assert plain(source) == text


def test_paths_close_what_markup_leaves_open():
    assert read_page("<p><b>a<p>b").tags == ["/p", "/p/b", "/p"]


def test_template_texts_and_slots_without_an_article(spark):
    page = lambda i: (
        f"<html><body><div class=top><span>Site name</span><span>Home</span></div><div class=body><p>Text number {i} of a page, which is long.</p>"
        f"<p>Second paragraph {i * i} of it, longer than the rest.</p><p>Written by us</p></div><div class=end>All rights</div></body></html>"
    )
    rows = [(i, f"http://A.org/{i}", page(i)) for i in range(20)] + [(100, "http://b.org/", page(5)), (None, None, None), (3, "x", ""), (3, "x", "")]
    df = spark.createDataFrame([(*r, 1) for r in rows], f"{SCHEMA}, slot int")
    got = extract(df).collect()
    assert len(got) == len(rows)
    want = {i: f"Text number {i} of a page, which is long.\nSecond paragraph {i * i} of it, longer than the rest." for i in range(20)}
    assert {r.page_id: r.text for r in got if r.url and r.url.startswith("http://A")} == want
    assert [r.text for r in got if r.page_id == 100][0].startswith("Site nameHome\nText number 5")  # one page shows no template
    assert [r.text for r in got if r.url is None] == [""]


def test_copies_of_one_page_keep_their_text(spark):
    rows = [(i, f"http://a.org/{i}", "<p>The same on all pages.</p>") for i in range(5)]
    assert {r.text for r in extract(spark.createDataFrame(rows, SCHEMA)).collect()} == {"The same on all pages."}
    assert extract(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize(
    "tag, attributes",
    [
        ("a", 'href="/the-hidden-valley"'),
        ("a", "href=/go?hidden title='hidden gems'"),
        ("div", 'data-role="banner" data-class="ad" data-id=menu'),
        ("div", "data-hidden xaria-hidden=true data-style='display:none'"),
        ("div", "class='post' class='ad' onclick=\"x('class=ad role=banner')\""),
    ],
)
def test_attributes_count_by_their_exact_names(tag, attributes):
    assert plain(f"<article><p>a <{tag} {attributes}>b</{tag}></article>").split() == ["a", "b"]
    assert plain(f"<body {attributes}><article>b</article>") == "b"


@pytest.mark.parametrize("attributes", ["HIDDEN", "hidden=''", 'title="x"hidden', "aria-hidden = 'true'", "role=banner", 'style="color:red;display: none"', "class=\n'x ad'"])
def test_attributes_that_put_a_part_outside(attributes):
    assert plain(f"<article><p>a</p><div {attributes}>b</div></article>") == "a"


def test_template_texts_and_teasers_of_pages_with_articles(spark):
    page = lambda i: (
        f"<html><body><div class=top>Site name</div><main><article class=post><h1>Title {i}</h1><div class=tools>Send to a friend</div><div class=body>"
        f"<p>Text number {i} of a page, which is long.</p><p>Second paragraph {i * i} of it, longer than the rest.</p></div>"
        f"<p>Read also</p></article><div class=more><article class=card><p>Teaser {i + 1}</p></article><article class=card><p>Teaser {i + 2}</p></article></div></main></body></html>"
    )
    rows = [(i, f"http://a.org/{i}", page(i)) for i in range(20)] + [(100, "http://b.org/", page(5))]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = {i: f"Title {i}\nText number {i} of a page, which is long.\nSecond paragraph {i * i} of it, longer than the rest." for i in range(20)}
    assert {i: got[i] for i in want} == want
    assert got[100].startswith("Title 5\nSend to a friend\nText number 5")  # one page shows no template


def article(i, copies, body="article", extra=""):
    """A page of a near copy: title and five paragraphs that all copies share, and one of its own."""
    shared = "".join(f"<p>Paragraph {k} of the story that every copy tells in the same words.</p>" for k in range(5))
    start, end = (f"<{body}>", f"</{body.split()[0]}>")
    return f"<html><body><div class=top>Site</div>{start}<h1>The title of it</h1>{shared}<p>Edition number {i} of {copies}.</p>{extra}{end}<div class=end>Rights</div></body></html>"


def story(i, copies):
    return "\n".join(["The title of it", *(f"Paragraph {k} of the story that every copy tells in the same words." for k in range(5)), f"Edition number {i} of {copies}."])


@pytest.mark.parametrize("body", ["article", "div class=content", "main", "div class=content id=x"])
def test_near_copies_of_one_host_keep_all_their_text(spark, body):
    rows = [(n * 100 + i, f"http://h{n}.org/{i}", article(i, n, body)) for n in (2, 3, 4, 9) for i in range(n)]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = {n * 100 + i: story(i, n) for n in (3, 4, 9) for i in range(n)}
    assert {k: got[k] for k in want} == want
    assert all(story(i, 2) in got[200 + i] for i in range(2))


def test_copies_beside_other_articles_keep_their_text_and_lose_the_template(spark):
    bar = "<div class=tools>Send to a friend</div>"
    other = lambda i: f"<html><body><div class=top>Site</div><article><h1>Title {i}</h1><p>{' '.join(f'w{i}x{k}' for k in range(60))}</p>{bar}</article><div class=end>Rights</div></body></html>"
    rows = [(i, f"http://a.org/{i}", article(i, 3, extra=f"<section class=mirror>Copied with leave.</section>{bar}")) for i in range(3)]
    rows += [(10 + i, f"http://a.org/o{i}", other(i)) for i in range(2)]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[i].startswith(story(i, 3)) for i in range(3))
    assert [got[10 + i] for i in range(2)] == [f"Title {i}\n{' '.join(f'w{i}x{k}' for k in range(60))}" for i in range(2)]


def test_a_class_in_changing_order_is_no_template(spark):
    def page(i, turned):
        tools = ["<b class=one>Alpha</b>", "<i class=two>Beta</i>"]
        return f"<html><body><div class=body><div class=row>{''.join(tools[::-1] if turned else tools)}</div><p>{' '.join(f'w{i}x{k}' for k in range(30))}</p></div></body></html>"

    rows = [(i, f"http://{host}.org/{i}", page(i, host == "b" and i % 2)) for host in "ab" for i in range(6)]
    got = {(r.url[7], r.page_id): r.text for r in extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all("Alpha" not in text for (host, _), text in got.items() if host == "a")
    assert all("Alpha" in text and "Beta" in text for (host, _), text in got.items() if host == "b")


def plain_hosts(pages):
    """Texts of hosts {host: [html]} by exact vectors, orders and sums."""
    out = {}
    for host, sources in pages.items():
        read = [read_page(s) for s in sources]
        events = [[("tag", "", path) if node is None else ("text", node.path, " ".join(node.text.split())) for path, node in walk(page)] for page in read]
        vectors = {e: tuple(page.count(e) for page in events) for page in events for e in page}
        classes = {}
        for event, vector in vectors.items():
            n = sum(v > 0 for v in vector)
            if n >= 3 and 2 * n >= len(sources):
                classes.setdefault(vector, []).append(event)
        classes = {v: e for v, e in classes.items() if {kind for kind, _, _ in e} == {"tag", "text"}}
        held = {e for events_ in classes.values() for e in events_ if e[0] == "text"}
        all_paths = {p for page in read for p in page.tags}
        chars = lambda test: sum(len(n.text) for page in read for n in page.nodes if not n.outside and test(n))
        free = lambda n: ("text", n.path, " ".join(n.text.split())) not in held
        wanted = free if chars(free) else lambda n: True
        slots = [
            p for p in all_paths
            if sum(p in page.tags for page in read) >= max(3, len(sources) / 2) and re.search(html_extract.CONTAINER, p)
            and chars(wanted) and chars(lambda n: wanted(n) and html_extract.within(n.path, p)) >= 0.6 * chars(wanted)
        ]
        slot = max(slots, key=lambda p: (len(p), p), default=None)
        fixed = set()
        for vector, members in classes.items():
            ways = [list(dict.fromkeys(e for e in page if e in members)) for page in events]
            on = [page for page, way in zip(read, ways) if way]
            mine = [n for page in on for n in page.nodes if not n.outside and slot and html_extract.within(n.path, slot)]
            own = sum(len(n.text) for n in mine if ("text", n.path, " ".join(n.text.split())) in members)
            if len({tuple(w) for w in ways if w}) == 1 and 2 * own < sum(len(n.text) for n in mine):
                fixed |= {html_extract.digest(path, text) for kind, path, text in members if kind == "text"}
        out[host] = [main_text(s, slot, frozenset(fixed)) for s in sources]
    return out


def walk(page):
    paths = iter(page.tags)
    for _, node in page.order:
        if node is None:
            yield next(paths), None
        elif not node.outside:
            yield "", node


def test_random_hosts_against_plain_vectors(spark, rng):
    def page():
        parts = []
        for _ in range(rng.randint(1, 7)):
            text = rng.choice(["Home", "About us and all the others", "Read on", " ".join(f"w{rng.randrange(500)}" for _ in range(rng.randint(1, 25)))])
            parts.append(rng.choice([f"<p>{text}</p>", f"<div class=a>{text}</div>", f"<div class=b><p>{text}</p></div>", f"<section><h2>{text}</h2></section>", text]))
        inner = "".join(parts)
        return rng.choice([f"<html><body>{inner}</body></html>", f"<html><body><div id=m>{inner}</div><div>Foot</div></body></html>", f"<body><article>{inner}</article>"])

    hosts = {}
    for h in range(40):
        base = [page() for _ in range(rng.randint(1, 4))]
        hosts[f"h{h}.org"] = [(b := rng.choice(base)).replace("</body>", f"<p>copy {i}</p></body>") if rng.random() < 0.5 else b + f"<p>{i}</p>" for i in range(rng.randint(1, 7))]
    rows = [(f"{h}#{i}", f"http://{h}/{i}", s) for h, sources in hosts.items() for i, s in enumerate(sources)]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, "page_id string, url string, html string")).collect()}
    want = {f"{h}#{i}": text for h, texts in plain_hosts(hosts).items() for i, text in enumerate(texts)}
    assert [k for k in want if got[k] != want[k]] == []
    assert sum(main_text(s, None, NONE) != want[f"{h}#{i}"] for h, sources in hosts.items() for i, s in enumerate(sources)) > 20
