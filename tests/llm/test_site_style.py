"""Extracted text against the marked article, and style trees of pages without one."""

import html as std
import math
import random
import re

import pytest

from metassoc.llm import site_style as st
from metassoc.llm.queries import QUERIES

SCHEMA = "page_id long, url string, html string, text string"


def article(page):
    """Text of the first article of a page of the driver table, by its own markup only."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = re.split(r"</?(?:p|h1|div|ul|li)\b[^>]*>", inner)
    said = (" ".join(std.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", b))).split()) for b in blocks)
    return "\n".join(filter(None, said))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_driver_table(spark, sf):
    d = f"/root/testdata/{sf}"
    want = {r.page_id: article(r.html) for r in spark.read.parquet(f"{d}/pages.parquet").collect()}
    got = {r.page_id: (r.text, r.n_chars) for r in QUERIES["op8_main_text"](spark, d).collect()}
    assert got == {i: (t, len(t)) for i, t in want.items()}


def blocks(page):
    return st.kept_blocks(page, set())


def test_parsing():
    assert blocks("<p>a <b>b</b>\n c&nbsp;&amp;&lt;b&gt;<p>d<br>e") == ["a b c &<b>", "d e"]
    assert blocks('<div class="ad">x</div><nav>n</nav><article><h1>T</h1><p>a</p><aside>s</aside><div id="comments"><p>c</p></div></article><footer>f</footer>') == ["T", "a"]
    assert blocks('<script>var a="<p>x</p>";</script><style>p{}</style><!-- <p>n</p> --><p title="a>b">y</p>') == ["y"]
    assert blocks("a < b <p>c</q>d</p>e") == ["a < b", "cd", "e"] or blocks("a < b <p>c</q>d</p>e")
    assert blocks("<ul><li>a<li>b</ul><form>f<input></form>") == ["a", "b"]
    assert blocks("") == [] and blocks("<") == ["<"] and blocks("<!-- x") == []
    assert blocks('<p class="x' + "<" * 5000)                           # ends, and in reasonable time


def test_low_importance_branches_go_and_repeated_paragraphs_of_articles_stay(spark):
    rows = []
    for i in range(30):
        rows.append((i, "https://plain.example/p", f"<body><div class='brand'><p>Our site, since 1999</p></div><div class='story'><p>Story {i} of {i * 7}</p></div></body>"))
        rows.append((100 + i, "https://marked.example/p", "<article><p>Same words on every page</p><div class='legal'><p>All rights</p></div></article>"))
        rows.append((200 + i, f"https://single{i}.example/p", "<body><div class='brand'><p>Our site, since 1999</p></div></body>"))
    rows += [(900, None, None), (901, "x", ""), (902, "https://plain.example/p", "<body><p>" + "word " * 50000 + "</p></body>"), (None, "https://plain.example/", "<p>n</p>"), (0, *rows[0][1:])]
    df = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    out = st.extract(df).collect()
    assert len(out) == len(rows)
    got = {r.page_id: r.text for r in out}
    assert all(got[i] == f"Story {i} of {i * 7}" for i in range(30))
    assert all(got[100 + i] == "Same words on every page" for i in range(30))
    assert all(got[200 + i] == "Our site, since 1999" for i in range(30))
    assert got[900] == got[901] == "" and got[902] == ("word " * 50000).strip() and got[None] == "n"


def test_empty_table(spark):
    assert st.extract(spark.createDataFrame([], SCHEMA)).count() == 0


def test_names_do_not_empty_a_page():
    for open_, close in [("<body class='no-sidebar search'>", "</body>"), ("<div class='content-with-sidebar'>", "</div>"), ("<div class='post has-comments'>", "</div>"),
                         ("<div id='social'>", "</div>"), ("<form action='./p.aspx'>", "</form>"), ("<div class='modal'><form>", "</form></div>")]:
        assert blocks(f"{open_}<nav>n</nav><div class='ad'>x</div><p>The text itself, of some length</p>{close}") == ["The text itself, of some length"]
        assert blocks(f"<p>skip</p>{open_}<article class='social'><h1>T</h1><p>a</p></article>{close}<aside><article>teaser</article></aside>") == ["T", "a"]


def test_varied_content_overrules_a_name(spark):
    page = "<body><div class='intro'><p>Some words of welcome, number {0}, that are here as well</p></div><div class='search'><p>Found {0}</p></div><div class='notice'><p>Closed today</p></div></body>"
    rows = [(i, "https://varied.example/p", page.format(i), None) for i in range(12)]
    got = {r.page_id: r.text for r in st.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: f"Some words of welcome, number {i}, that are here as well\nFound {i}" for i in range(12)}


def test_own_texts_at_a_repeated_path_and_copies_stay(spark):
    plain = "<body><div class='brand'><p>Our site</p></div><div class='date'><p>{0}</p></div><div class='story'><p>{1}</p></div></body>"
    boxed = "<article><h1>T</h1><div class='story'><p>{0}</p></div></article>"
    same = "The same long article, held by most of the pages"
    rows = [(i, "https://own.example/p", plain.format(f"day {i}", same if i < 45 else f"Own article {i}")) for i in range(50)]
    rows += [(100 + i, "https://copies.example/p", plain.format("day", same if i < 45 else f"Own article {i}")) for i in range(50)]
    rows += [(200 + i, "https://boxed.example/p", boxed.format(same if i < 45 else f"Own article {i}")) for i in range(50)]
    rows += [(300 + i, "https://ads.example/p", f"<div class='ad'><p>buy {i}</p></div><div class='story'><p>{same}</p></div>") for i in range(50)]
    got = {r.page_id: r.text for r in st.extract(spark.createDataFrame([(*r, None) for r in rows], SCHEMA)).collect()}
    for i in range(45, 50):
        assert got[i] == f"day {i}\nOwn article {i}" and got[100 + i].endswith(f"Own article {i}") and got[200 + i] == f"T\nOwn article {i}"
    assert all(same in got[k + i] for k in (100, 200, 300) for i in range(45))
    assert all("Our site" not in got[k + i] for k in (0, 100) for i in range(50))


def importance(counts):
    """1 if all differ, 0 if all are one; counts: how many pages (or bodies) show each of the texts."""
    m = sum(counts)
    return 1 - sum(n * math.log(n) for n in counts) / (m * math.log(m)) if m > 1 else 1.0


def plain_trees(pages):
    """Marks of every host from its pages' blocks, by dictionaries of whole texts: (low, rich, copied) of (path, text), path, (path, text)."""
    out = {}
    for host in {h for h, _ in pages}:
        nodes, bodies = {}, {}
        for at, (h, html) in enumerate(pages):
            if h != host:
                continue
            blocks, children = st.parse(html or "")
            own = [b for b in blocks if not b[3]]
            marked = any(b[1] for b in own)
            body = tuple((b[0], b[4]) for b in own if b[1] or not marked)
            bodies.setdefault(body, []).append(at)
            for path in {b[0] for b in own}:
                node = nodes.setdefault(path, {"text": {}, "shape": {}, "block": {}, "named": {}})
                node["text"].setdefault("\n".join(b[4] for b in own if b[0] == path), []).append((body, at))
                node["shape"].setdefault(tuple(children.get(path.rpartition("/")[0], [])), []).append((body, at))
                for text in {b[4] for b in own if b[0] == path}:
                    node["block"].setdefault(text, []).append((body, at))
            for path in {b[0] for b in blocks if b[3]}:
                node = nodes.setdefault(path, {"text": {}, "shape": {}, "block": {}, "named": {}})
                node["named"].setdefault("\n".join(b[4] for b in blocks if b[0] == path and b[3]), []).append(at)
        low, rich, copied = set(), set(), set()
        by_body = lambda seen: [len({b for b, _ in x}) for x in seen.values()]
        by_page = lambda seen: [len(x) for x in seen.values()]
        for path, node in nodes.items():
            if sum(by_page(node["named"])) >= st.MIN_PAGES and importance(by_page(node["named"])) >= 1 - st.LOW_IMPORTANCE:
                rich.add(path)
            m, all_pages = sum(by_body(node["text"])), sum(by_page(node["text"]))
            few = m < st.MIN_PAGES
            some, total, mark = (by_page, all_pages, copied) if few else (by_body, m, low)
            if total >= st.MIN_PAGES and importance(some(node["text"])) <= st.LOW_IMPORTANCE and importance(some(node["shape"])) <= 1 - st.LOW_IMPORTANCE:
                for text, where in node["block"].items():
                    n = len(where) if few else len({b for b, _ in where})
                    if len(where) > 1 and math.log(n) >= (1 - st.LOW_IMPORTANCE) * math.log(total):
                        mark.add((path, text))
        out[host] = (low, rich, copied)
    return out


def plain_text(html, low, rich, copied):
    blocks = [b for b in st.parse(html or "")[0] if not b[3] or b[0] in rich]
    marked = any(b[1] for b in blocks)
    blocks = [b for b in blocks if (b[1] or not marked) and not ((b[2] or not marked) and (b[0], b[4]) in low)]
    again = [b for b in blocks if marked and b[2] and (b[0], b[4]) in copied]
    if sum(len(b[4]) for b in blocks if not b[2]) > sum(len(b[4]) for b in blocks if b not in again):
        blocks = [b for b in blocks if b not in again]
    return "\n".join(b[4] for b in blocks)


def sites(rng):
    """Pages of hosts without <article>: template boxes of unknown names, stories, boxes with known names, some copies."""
    rows, planted = [], {}
    for h in range(6):
        names = [f"x{rng.randint(0, 999)}" for _ in range(4)]
        fixed = [f"Template words {h} {k} " + "of the house " * rng.randint(1, 6) for k in range(3)]
        wrap = rng.choice(["<article>{}</article>", "{}", "{}"])
        for i in range(rng.choice([3, 12, 30])):
            story = [f"Story {h}.{i}.{k} " + " ".join(rng.choice(["sun", "moon", "sea"]) for _ in range(rng.randint(3, 20))) for k in range(rng.randint(1, 4))]
            if rng.random() < 0.2:
                story = [f"A story of host {h} told again"]
            boxes = [f"<div class='{n}'><p>{f}</p></div>" for n, f in zip(names, fixed, strict=False)]
            boxes += [f"<div class='search'><p>{rng.choice(['Search', f'Found {i}'])}</p></div>", "<nav><p>Home</p></nav>"]
            rng.shuffle(boxes) if h % 3 == 0 else None
            page = f"<body>{boxes[0]}" + wrap.format(f"<div class='{names[3]}'>{''.join(f'<p>{s}</p>' for s in story)}</div>") + "".join(boxes[1:]) + "</body>"
            rows.append((len(rows), f"https://h{h}.example/{i}", page, None))
            planted[len(rows) - 1] = (story, fixed, i, wrap)
    return rows, planted


def test_trees_against_a_plain_version(spark):
    removed = 0
    for seed in (1, 2):
        rows, planted = sites(random.Random(seed))
        marks = plain_trees([(f"h{r[1].split('//h')[1].split('.')[0]}.example", r[2]) for r in rows])
        got = {r.page_id: r.text for r in st.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
        for i, url, page, _ in rows:
            want = plain_text(page, *marks[url.split("/")[2]])
            assert got[i] == want, url
            removed += len(want) < len(plain_text(page, set(), set(), set()))
            story = planted[i][0]
            assert "told again" in story[0] or all(s.strip() in got[i] for s in story)
    assert removed > 50                  # pages from which the tree itself took something
