"""Main text of pages, WARC archives, and benchmark windows."""

import base64
import gzip
import hashlib
import math
import random
import re
import time

import pyarrow.parquet as pq
import pytest
from messy import messy_docs, no_docs

from legworks.llm import decontaminate as D, html_density as H, warc as W

ARTICLE = "".join(f"<p>Sentence number {i} of the article, with enough words to be dense.</p>"
                  for i in range(6))
PAGES = {
    "article": ("<html><head><title>T</title><style>p{}</style><script>x='<p>no</p>'</script></head>"
                "<body><nav><ul><li><a href=/>Home</a></ul></nav><article><h1>Head &amp; more</h1>"
                + ARTICLE + "</article><footer>&copy; x</footer></body></html>"),
    "divs": ("<body><div id=menu><a href=/a>A</a><a href=/b>B</a></div><div class=content><h2>Head"
             " &amp; more</h2>" + ARTICLE + "</div><div class='comments'><p>First! what a long reader"
             " comment that is, with a lot of words in it</p></div><aside>Notes here</aside>"
             "<div class='cookie-notice'>We use cookies a lot on this page</div></body>"),
    "unclosed": ("<body><header>Site name</header><main><h1>Head &amp; more<p>"
                 + ARTICLE.replace("</p>", "") + "</main><form>Name <input> <button>Go</button></form>"),
}
PAGES["names"] = ("<body class='has-sidebar no-comments'><div class='wrap comments-open'><main "
                  "class='with-ads'><article class='post hentry'><header><h1>Head &amp; more</h1></header>"
                  + ARTICLE + "<aside>Pull</aside></article><section id='respond-form'><p>Leave a reply"
                  "</p></section><article class='comment'><p>I read this with interest.</p></article>"
                  "</main></div><div class='topBanner'>Buy now, and buy a lot of it</div></body>")
TEXT = ["Head & more", *(f"Sentence number {i} of the article, with enough words to be dense."
                         for i in range(6))]


@pytest.mark.parametrize("name", PAGES)
def test_main_text(name):
    assert H.extract(PAGES[name]).split("\n\n") == TEXT


def test_sections_of_shorter_paragraphs_stay():
    long, short = ("<section>" + f"<p>{w * 5}</p>" * 5 + "</section>"
                   for w in ("long words " * 9, "short one "))
    links = "<div><a href=/a>Some page</a> <a href=/b>Another page</a></div>"
    page = f"<body>{links}<div class=content>Lead in.{long}{short}{links}</div></body>"
    assert H.extract(page).split("\n\n") == [
        "Lead in.", *[("long words " * 45).strip()] * 5, *[("short one " * 5).strip()] * 5]


@pytest.mark.parametrize("wrap", [
    "<form id=aspnetForm>{}</form>", "<div class=content-sidebar-wrap><main>{}</main></div>",
    "<div class=share-story-body>{}</div>", "<article><div class=search-result-content>{}</div>"])
def test_wrappers_of_the_main_text_stay(wrap):
    small = "<div class=related-posts><p>Another post</p></div><form>Name <input></form>"
    page = "<body>" + wrap.format("<h2>Head &amp; more</h2>" + ARTICLE) + small
    assert H.extract(page).split("\n\n") == TEXT
    widgets = "".join(f"<div class='elementor-widget-text-editor'>{p}</p></div>"
                      for p in ARTICLE.split("</p>")[:-1])
    assert H.extract(f"<article><h2>Head &amp; more</h2>{widgets}{small}").split("\n\n") == TEXT


def test_blocks_and_white_space():
    page = ("<article><p>a <b>b</b>c\n\t d<br>e&nbsp;&#233;&lt;p&gt;</p>tail<!-- no --><p></p>"
            "<ul><li>one<li>two</ul><pre>x\n  y</pre></article>")
    assert H.extract(page) == "a bc d e é<p>\n\ntail\n\none\n\ntwo\n\nx y"
    assert [H.extract(x) for x in ("", None, "<nav>menu</nav>", "plain words")] == [
        "", "", "", "plain words"]
    assert H.extract("<p>" + "word " * 200_000) == ("word " * 200_000).strip()
    assert H.extract("<div>" * 3000 + "deep words") == "deep words"


PARAS = "".join(f"<p>Sentence number {i} of a section, with enough words to be dense.</p>"
                for i in range(10, 13))
SECTION = [f"Sentence number {i} of a section, with enough words to be dense." for i in range(10, 13)]
COMMENTS = "".join(f"<div><b>Reader {i}</b><p>{words}</p></div>" for i, words in enumerate((
    "I read this twice and I still wonder what to make of it, honestly.",
    "Thanks for this, it is the best that I have read on it for a long time.",
    "I think that the second half is wrong, and the first half is not new.")))


@pytest.mark.parametrize("name", ["discussion", "related", "notice", "search", "related-work"])
def test_named_sections_of_an_article_stay(name):
    for tag in ("section", "div"):
        part = f"<{tag} id='{name}'><h2>More on it</h2>{PARAS}</{tag}>"
        page = f"<body><nav>x</nav><article><h1>Head &amp; more</h1>{ARTICLE}{part}</article></body>"
        assert H.extract(page).split("\n\n") == [*TEXT, "More on it", *SECTION]


def test_furniture_in_an_article_goes():
    links = "".join(f"<li><a href=/{i}>Another post of ours, number {i}</a></li>" for i in range(6))
    parts = [f"<section id=related><h3>Related</h3><ul>{links}</ul></section>",
             "<div class=ad>Buy a lot of it now</div>", "<div class='share-buttons'><a href=/s>Share</a></div>",
             f"<section id=comments>{COMMENTS}</section>", f"<div class=comments>{COMMENTS}</div>",
             "<div class=newsletter><p>Sign up for our letter</p></div>",
             f"<article><p>{'A reader said this on it. ' * 3}</p></article>"]
    for part in parts:
        page = f"<body><article><h1>Head &amp; more</h1>{ARTICLE}{part}</article></body>"
        assert H.extract(page).split("\n\n") == TEXT, part


def test_sibling_articles_stay():
    teaser = "<article><a href=/x>Read about something else that we wrote last year</a></article>"
    page = f"<body><article><h1>Head &amp; more</h1>{ARTICLE}</article><article>{PARAS}</article>{teaser}"
    assert H.extract(page).split("\n\n") == [*TEXT, *SECTION]


def test_plain_divs_around_the_main_text():
    """Without an article: a site's intro, comments without a name and a copyright line go."""
    page = ("<body><div>Welcome to the site of somebody who writes about this and that.</div>"
            f"<div id=c><h1>Head &amp; more</h1>{ARTICLE}</div><div>{COMMENTS}</div>"
            "<div>&copy; 2024 Somebody. All rights reserved.</div></body>")
    assert H.extract(page).split("\n\n") == TEXT
    wrapped = page.replace("<body>", "<body><div id=page>").replace("</body>", "</div></body>")
    assert H.extract(wrapped).split("\n\n") == TEXT


def test_ties_go_to_the_outermost_then_the_first():
    a = "<div><p>one and the same words</p></div>"
    root = H.parse(f"<body><div>{a}</div><div>{a}</div></body>")
    nodes = H.in_order(root)
    H.densities(nodes)
    best = [n for n in nodes if n.total == max(m.total for m in nodes)]
    assert max(nodes, key=lambda n: n.total) is best[0]


def test_deep_pages_take_linear_time():
    at = time.monotonic()
    assert H.extract("<div>" * 50_000 + "deep words" + "</div>" * 50_000) == "deep words"
    assert H.extract("<article><section>" * 20_000 + "deep words" + "</x>" * 50_000) == "deep words"
    assert time.monotonic() - at < 60


def densities_again(node):
    """Composite density of a node and its descendants by the formulas, from the text alone:
    (characters, tags, link characters, link tags) of each, then the sums."""
    def text(n):
        return "".join("".join(c.split()) if isinstance(c, str) else "" if c.dropped else text(c)
                       for c in n.children)

    def inside(n):
        for c in n.children:
            if not isinstance(c, str) and not c.dropped:
                yield c
                yield from inside(c)

    def linked(n):
        if n.tag == "a":
            return len(text(n))
        return sum(linked(c) for c in n.children if not isinstance(c, str) and not c.dropped)

    page, page_links = len(text(node)), linked(node)

    def value(chars, tags, link_chars, link_tags):
        if not chars:
            return 0.0
        tags = max(tags, 1)
        ratio = (chars / max(link_chars, 1)) * (tags / max(link_tags, 1))
        base = math.log((chars / max(chars - link_chars, 1)) * link_chars
                        + page_links / page * chars + math.e)
        return chars / tags * math.log(max(ratio, 1.0)) / math.log(max(base, 1.1))

    def density(n):
        below = list(inside(n))
        return value(len(text(n)), len(below), linked(n), sum(c.tag == "a" for c in below))

    out = {}
    for n in [node, *inside(node)]:
        own = sum(len("".join(c.split())) for c in n.children if isinstance(c, str))
        out[id(n)] = density(n), value(own, 0, own if n.tag == "a" else 0, 0) + sum(
            density(c) for c in n.children if not isinstance(c, str) and not c.dropped)
    return out


def test_densities_agree_with_a_plain_reading():
    pages = pq.read_table("/root/testdata/sf0.001/pages.parquet").column("html").to_pylist()
    for html in [*pages, *PAGES.values()]:
        root = H.parse(html)
        nodes = H.in_order(root)
        H.densities(nodes)
        again = densities_again(root)
        assert len(again) == len(nodes)
        for n in nodes:
            assert (n.density, n.total) == pytest.approx(again[id(n)], rel=1e-9, abs=1e-9)


def page_frame(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.selectExpr("*", "'x' AS digest", "'y' AS record", "'z' AS text", "1 AS original")


def test_pages_table(spark):
    pages = page_frame(spark, [(1, "u", PAGES["article"]), (2, None, None), (2, None, None),
                               (None, "v", "")])
    out = H.main_text(pages).collect()
    assert sorted((str(r.page_id), str(r.url), r.text, r.n_chars) for r in out) == sorted(
        [("1", "u", "\n\n".join(TEXT), len("\n\n".join(TEXT))), ("2", "None", "", 0),
         ("2", "None", "", 0), ("None", "v", "", 0)])
    assert H.main_text(pages.where("page_id = -1")).collect() == []


def test_loser_tree_merges_sorted_runs():
    rnd = random.Random(1)
    for k in range(0, 9):
        runs = [sorted(rnd.randint(0, 30) for _ in range(rnd.randint(0, 12))) for _ in range(k)]
        merged = [x for x, in W.loser_tree_merge([iter([(x,) for x in r]) for r in runs],
                                                 lambda e: e)]
        assert merged == sorted(x for r in runs for x in r)


def test_archives_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(W, "RECORDS_PER_FILE", 7)
    monkeypatch.setattr(W, "MAX_GROUPS_BROADCAST", 0)      # groups joined by shuffle
    nasty = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n"
    rows = [(i, f"http://H{i % 3}.example.org:8{i}/p?q={i}#f", f"<p>é漢{i % 5}</p>")
            for i in range(40)]
    rows += [(50, "bad url\r\nX: y", nasty), (51, None, nasty), (52, "u", None), (53, "u", ""),
             (53, "u", ""), (None, "http://a/", "<p>é漢1</p>"), (60, "http://big/", "y" * 3_000_000)]
    out = W.archive(page_frame(spark, rows), str(tmp_path / "warc")).collect()
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    want = []
    for i, _, h in rows:
        raw = (h or "").encode()
        original = first[h or ""]
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        want.append((str(i), len(raw), digest, "response" if i == original else "revisit",
                     None if i == original else original))
    got = [(str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
           for r in out]
    assert sorted(got, key=str) == sorted(want, key=str)
    files = sorted((tmp_path / "warc").glob("part-*.gz"))
    assert len(files) > 3
    archived = b"".join(gzip.decompress(f.read_bytes()) for f in files)
    # another reading of the files: headers by pattern, blocks by length
    at, n = 0, 0
    while at < len(archived):
        end = archived.index(b"\r\n\r\n", at) + 4
        size = int(re.search(rb"\r\nContent-Length: (\d+)\r\n", archived[at:end])[1])
        assert archived[at:at + 10] == b"WARC/1.1\r\n"
        assert archived[end + size:end + size + 4] == b"\r\n\r\n"
        at, n = end + size + 4, n + 1
    assert n == len(rows)


def test_files_are_bounded_by_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(W, "FILE_BYTES", 60_000)
    rows = [(i, f"http://h{i}.org/", f"p{i} " * (300 if i % 5 else 9000)) for i in range(60)]
    rows += [(100, "http://big.org/", "z" * 400_000), (101, "http://big.org/2", "z" * 400_000)]
    pages = page_frame(spark, rows).coalesce(1)
    path = str(tmp_path / "w")
    W.write_warc(pages, path)
    sizes = {}
    for f in sorted((tmp_path / "w").glob("part-*.gz")):
        raw = gzip.decompress(f.read_bytes())
        sizes[f.name] = len(raw), raw.count(b"WARC/1.1")
    assert len(sizes) > 5 and sum(n for _, n in sizes.values()) == len(rows)
    assert all(size <= 60_000 or n == 1 for size, n in sizes.values())
    got = {(r.page_id, r.payload_bytes, r.record_type) for r in W.read_index(spark, path).collect()}
    assert got == {(i, len(h), "revisit" if i == 101 else "response") for i, _, h in rows}
    with_blocks = W.archive(pages, str(tmp_path / "v"))
    assert with_blocks.count() == len(rows)


def test_index_is_in_global_order(spark, tmp_path):
    rows = [(i, f"http://h{i * 7 % 5}.org/{i * 3 % 4}", f"p{i}") for i in range(60)]
    path = str(tmp_path / "w")
    W.write_warc(page_frame(spark, rows).repartition(4), path)
    index = W.merge_index(W.read_index(spark, path)).orderBy("part", "nth").collect()
    keys = [(r.url_key, r.capture_time, r.page_id) for r in index]
    assert keys == sorted(keys) and len(keys) == 60
    assert W.url_key("http://A.b.ORG:80/x/Y?z#f") == "org,b,a:80)/x/Y?z"
    empty = page_frame(spark, rows).where("page_id = -1")
    assert W.archive(empty, str(tmp_path / "none")).collect() == []


def naive(words, items):
    hit, found = set(), set()
    for item, text in items:
        w = D.words_of(text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            for at in range(len(words) - n + 1):
                if words[at:at + n] == w[i:i + n]:
                    hit |= set(range(at, at + n))
                    found.add(str(item) if item is not None else "")
    return len(hit), sorted(found)


@pytest.mark.parametrize("block", [D.PATTERN_BYTES, 60])
def test_windows_equal_naive_search(spark, block):
    rnd = random.Random(8)
    vocabulary = [f"v{i}" for i in range(6)]
    items = [(i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([1, 2, 5, 13, 14, 20]))))
             for i in range(12)]
    items += [(12, "Solo!"), (13, ""), (14, None), (None, "q r s"), (0, items[0][1])]
    rows = []
    for i in range(40):
        words = [rnd.choice(vocabulary) for _ in range(40)]
        if i % 3 == 0:
            words[5:5] = items[rnd.randrange(12)][1].upper().split()
        rows.append((100 + i, ", ".join(words) + ("; SOLO" if i % 9 == 0 else ""), "s"))
    docs = messy_docs(spark, rows).where("doc_id IS NULL OR doc_id <> 4")
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' AS row")
    out = D.decontaminate(docs, bench, block).collect()
    assert len(out) == docs.count()
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    for r in out:
        words = D.words_of(texts[r.doc_id])
        n_hit, found = naive(words, items)
        assert (r.n_words, r.n_hit, r.n_items) == (len(words), n_hit, len(found))
        assert r.items_sha256 == hashlib.sha256(",".join(found).encode()).hexdigest()
        assert r.contaminated == (n_hit > 0 and 20 * n_hit >= len(words))
    kept = D.drop_contaminated(docs, bench, block)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.select("doc_id").collect()) == sorted(
        str(r.doc_id) for r in out if not r.contaminated)


def test_empty_tables(spark):
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert D.decontaminate(no_docs(spark), bench).collect() == []
    docs = messy_docs(spark)
    assert {r.n_hit for r in D.decontaminate(docs, bench.where("item_id = 2")).collect()} == {0}


def test_shifts_skip_words():
    table = D.WuManber(13)
    table.add(tuple(b"p%d" % i for i in range(13)), "x")
    seen = []

    class Counted(list):
        def __getitem__(self, at):
            seen.append(at)
            return super().__getitem__(at)

    assert list(table.search(Counted([b"z"] * 1200))) == []
    assert len(seen) <= 1200 / 12 + 1      # a look every twelve words
