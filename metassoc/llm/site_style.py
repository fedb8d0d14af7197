"""Operator 8: main-text extraction by site style trees.

Every page is parsed into a tree of style nodes: an element is named by its tag and class, and the same chain of names on
pages of one host is one node of the host's style tree.  Two entropies tell how important a node is.  Presentation: the
entropy of the child sequences that a node shows on the host's pages (pages made from one template show one sequence).
Content: one minus the mean entropy of the texts in the node, where a text found on n of m pages has log n / log m (a text
repeated on all pages says nothing).  Elements that HTML has for menus, footers, controls and the like have no importance.
Class and id names (whole ones) and forms are a prior only: text in such a box goes unless the content entropy of its node is
high, the box holds most of the page's text, or it is around the marked article.

From branches of low importance the texts that many of the host's pages show there are removed; a page's own text stays.
Pages of a host with the same body count once, so copies of an article do not make it a template.  Where a page marks its article, text outside it goes, and inside
it only named boxes can fall to the entropies: plain paragraphs stay, however often they are repeated.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metassoc.llm.common import staged
from metassoc.session import prepare

MIN_PAGES = 4              # nodes on fewer pages of a host have no statistics
LOW_IMPORTANCE = 0.25      # content importance up to which a node on a fixed presentation is removed; from 1 - this on, names are overruled
WRAPPER_SHARE = 0.8        # a named box with this share of the page's text or more is no box beside the text

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|textarea|iframe|title)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[!?][^>]*>", re.S | re.I)
ATTRIBUTE = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)

# fixed values: elements of the HTML standard
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup "
             "time tt u var wbr img acronym".split())
NOISE_TAGS = set("nav footer aside button select option head menu dialog object audio video canvas map fieldset svg noscript template".split())
NOISE_WORDS = set("ad ads adv advert adverts advertisement advertising banner banners sponsor sponsored promo promotion cookie cookies consent "
                  "notice notices alert popup modal overlay sidebar aside nav navbar navigation menu menus breadcrumb breadcrumbs footer "
                  "comment comments disqus reply replies share sharing social related recommended newsletter subscribe subscription "
                  "signup login search widget toolbar pagination pager skip tags".split())
HEADER_WORDS = {"header", "masthead"}      # these and <header> are noise outside a marked article; inside one they hold its title
NOISE_ROLES = set("navigation banner contentinfo complementary search alert dialog menu menubar".split())
CLOSES_P = re.compile(r"(?:p|div|h[1-6]|ul|ol|li|dl|dt|dd|table|section|article|main|header|footer|aside|nav|form|pre|blockquote|figure|hr|address)\Z")
MAIN_TAGS = {"article", "main"}
NEVER_NOISE = {"html", "body", *MAIN_TAGS}

Block = tuple[str, bool, bool, bool, str]


def parse(html: str) -> tuple[list[Block], dict[str, list[str]]]:
    """Text blocks in page order, (path, inside a marked article, inside a box of it, noise by a name, text), without those in
    elements that are noise; and the child names of every node by path."""
    found: list[tuple[str, bool, bool, tuple[int, ...], str]] = []
    children: dict[str, list[str]] = {}
    by_name: list[bool] = []                      # per noise box: noise by its name only
    around: list[tuple[int, ...]] = []            # noise boxes around every marked article
    # an open element: tag, path, noise boxes around its text, marked, boxed
    stack: list[tuple[str, str, tuple[int, ...], bool, bool]] = [("", "", (), False, False)]
    text: list[str] = []
    at = 0

    def flush() -> None:
        if text:
            whole = " ".join(unescape("".join(text)).split())
            text.clear()
            _, path, noise, marked, boxed = stack[-1]
            if whole:
                found.append((path, marked, boxed, noise, whole))

    for token in TOKEN.finditer(html):
        if token.start() > at:
            text.append(html[at:token.start()])
        at = token.end()
        tag = token["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            text.append(" ")
            continue
        if tag in INLINE:
            continue
        if token["close"]:
            if any(e[0] == tag for e in stack):
                flush()
                while stack.pop()[0] != tag:
                    pass
            elif tag == "p":
                flush()
            continue
        flush()
        if CLOSES_P.match(tag):
            if stack[-1][0] == "p" or stack[-1][0] == tag == "li" or stack[-1][0] in ("dt", "dd") and tag in ("dt", "dd"):
                stack.pop()
        attrs = token["attrs"]
        named = {}
        if "=" in attrs:
            named = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in ATTRIBUTE.finditer(attrs)}
        name = f"{tag}.{named['class']}" if named.get("class") else tag
        _, path, noise, marked, boxed = stack[-1]
        children.setdefault(path, []).append(name)
        if tag in VOID or attrs.endswith("/") and tag in ("svg", "path"):
            continue
        main = tag in MAIN_TAGS or named.get("role") == "main"
        if not main and tag not in NEVER_NOISE:
            words = {*named.get("class", "").split(), named.get("id", "").strip()}
            fixed = tag in NOISE_TAGS or named.get("role") in NOISE_ROLES or not marked and tag in HEADER_WORDS
            if fixed or tag == "form" or named.get("role") == "form" or words & NOISE_WORDS or not marked and words & HEADER_WORDS:
                noise += (len(by_name),)
                by_name.append(not fixed)
        if main and not marked:
            around.append(noise)
        marked = marked or main
        boxed = marked and (boxed or tag == "div" and bool(named.get("class") or named.get("id")))
        stack.append((tag, f"{path}/{name}", noise, marked, boxed))
    if at < len(html):
        text.append(html[at:])
    flush()
    return _without_noise(found, by_name, around), children


def _without_noise(found: list[tuple[str, bool, bool, tuple[int, ...], str]], by_name: list[bool], around: list[tuple[int, ...]]) -> list[Block]:
    # what is around the marked article is no noise; articles in more boxes than another, those by element first, are teasers or comments
    weight = [(sum(not by_name[i] for i in boxes), len(boxes)) for boxes in around]
    no_noise = {i for boxes, w in zip(around, weight, strict=True) if w == min(weight) for i in boxes}
    left = [(p, m, b, [i for i in boxes if i not in no_noise], t) for p, m, b, boxes, t in found]
    left = [x for x in left if all(by_name[i] for i in x[3])]
    marked = any(m for _, m, _, _, _ in left)
    held: Counter = Counter()
    for _, m, _, boxes, t in left:
        if m or not marked:
            held.update(dict.fromkeys([-1, *boxes], len(t)))
    wrappers = {i for i, n in held.items() if n >= WRAPPER_SHARE * held[-1]}
    return [(p, m, b, not wrappers.issuperset(boxes), t) for p, m, b, boxes, t in left]


def _hash(s: str) -> int:
    return xxhash.xxh64_intdigest(s) - (1 << 63)


def host_of(url: Column) -> Column:
    at = F.instr(url, F.lit("://"))
    rest = F.when(at > 0, F.substring(url, at + 3, F.lit(2147483647))).otherwise(F.lit(""))
    return F.lower(F.regexp_extract(rest, r"^[^/?#]*", 0))


def features_of(html: str) -> tuple[int, set[tuple[int, int, int]]]:
    """Hash of the page's body (its text without boxes that are noise by name), and its features (path, kind, feature): texts
    of a node (0), child names of its parent (1), texts of a node that is noise by name (2), a block of a node (3)."""
    blocks, children = parse(html)
    marked = any(m for _, m, _, named, _ in blocks if not named)
    texts: dict[tuple[str, bool], list[str]] = {}
    for path, _, _, named, text in blocks:
        texts.setdefault((path, named), []).append(text)
    features = {(_hash(p), 2 if named else 0, _hash("\n".join(t))) for (p, named), t in texts.items()}
    # the presentation seen by a node is that of its parent
    features.update((_hash(p), 1, _hash(" ".join(children.get(p.rpartition("/")[0], [])))) for p, named in texts if not named)
    features.update((_hash(p), 3, _block(p, t)) for p, _, _, named, t in blocks if not named)
    return _hash("\n".join(f"{p} {t}" for p, m, _, named, t in blocks if not named and (m or not marked))), features


def _block(path: str, text: str) -> int:
    return _hash(f"{path}\n{text}")


def count_features(pages: DataFrame) -> DataFrame:
    """(host, path, kind, feature, n, rows) of (host, html): different bodies and pages with a feature (see ``features_of``);
    texts noise by name are counted by pages only.  Blocks of one page only are left out."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                body, features = features_of(html or "")
                seen.update((host, 0 if f[1] == 2 else body, *f) for f in features)
            columns = zip(*seen, strict=True) if seen else ((),) * 5
            types = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([*[pa.array(c, t) for c, t in zip(columns, types, strict=True)], pa.array(list(seen.values()), pa.int64())],
                                             names=["host", "body", "path", "kind", "feature", "rows"])

    each = pages.select("host", "html").mapInArrow(run, "host string, body long, path long, kind int, feature long, rows long")
    each = each.groupBy("host", "body", "path", "kind", "feature").agg(F.sum("rows").alias("rows"))
    n = F.sum(F.when(F.col("kind") == 2, F.col("rows")).otherwise(1))
    return each.groupBy("host", "path", "kind", "feature").agg(n.alias("n"), F.sum("rows").alias("rows")).where("kind != 3 OR rows > 1")


def style_tree(counts: DataFrame) -> DataFrame:
    """(host, path, bodies, pages, content, presentation, page_content, page_presentation, named, named_content) of
    ``count_features``: the merged trees' nodes with their importances over different bodies and over all pages, and the
    pages on which the node is noise by name with its content importance there."""
    def total(x: str) -> list[Column]:
        c = F.col(x)
        return [F.sum(c).alias(f"m_{x}"), F.sum(c * F.log(c.cast("double"))).alias(f"log_{x}")]

    def differs(x: str) -> Column:
        # mean over pages of log n / log m, n being the pages with the same text: 1 if all show one text, 0 if all differ
        m = F.col(f"m_{x}")
        return 1 - F.when(m > 1, F.col(f"log_{x}") / (m * F.log(m.cast("double")))).otherwise(F.lit(0.0))

    def of(kind: int, value: Column) -> Column:
        return F.max(F.when(F.col("kind") == kind, value))

    sums = counts.where("kind != 3").groupBy("host", "path", "kind").agg(*total("n"), *total("rows"))
    return sums.groupBy("host", "path").agg(
        of(0, F.col("m_n")).alias("bodies"), of(0, F.col("m_rows")).alias("pages"),
        of(0, differs("n")).alias("content"), of(1, differs("n")).alias("presentation"),
        of(0, differs("rows")).alias("page_content"), of(1, differs("rows")).alias("page_presentation"),
        of(2, F.col("m_rows")).alias("named"), of(2, differs("rows")).alias("named_content"))


def kept_blocks(html: str, low: set[int], rich: set[int] = frozenset(), copied: set[int] = frozenset()) -> list[str]:
    """Texts of the page's blocks that stay; ``low``: blocks repeated in nodes without importance, ``rich``: nodes whose
    content overrules names, ``copied``: blocks repeated by copies of too few bodies.  Copies do not tell a template from
    an article, so these go only from boxes of a marked article whose plain paragraphs hold more text."""
    blocks = [(p, m, b, t) for p, m, b, named, t in parse(html)[0] if not named or _hash(p) in rich]
    marked = any(m for _, m, _, _ in blocks)
    blocks = [(p, m, b, t) for p, m, b, t in blocks if (m or not marked) and not ((b or not marked) and _block(p, t) in low)]
    again = [marked and b and _block(p, t) in copied for p, _, b, t in blocks]
    plain = sum(len(t) for _, _, b, t in blocks if not b)
    drop = plain > sum(len(t) for (_, _, _, t), x in zip(blocks, again, strict=True) if x)
    return [t for (_, _, _, t), x in zip(blocks, again, strict=True) if not (x and drop)]


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            min_pages: int = MIN_PAGES, low_importance: float = LOW_IMPORTANCE) -> DataFrame:
    """(id_col, url_col, text) for every row: the page's main text, one block a line, white space inside a block made one space.

    Pages are grouped by the url's host ('' without one).  A null or empty page has an empty text; repeated rows and null
    ids are kept; other columns are not read; an empty table gives no rows."""
    prepare(df.sparkSession)
    pages = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")).withColumn("host", host_of(F.col("url")))
    counts = staged(count_features(pages), "style-counts")
    fixed = (F.col("bodies") >= min_pages) & (F.col("content") <= low_importance) & (F.col("presentation") <= 1 - low_importance)
    copied = (F.col("bodies") < min_pages) & (F.col("pages") >= min_pages) & (F.col("page_content") <= low_importance) & (F.col("page_presentation") <= 1 - low_importance)
    overruled = (F.col("named") >= min_pages) & (F.col("named_content") >= 1 - low_importance)
    nodes = style_tree(counts).select("host", "path", "bodies", "pages", *[F.coalesce(x, F.lit(False)).alias(n) for x, n in (
        (fixed, "fixed"), (copied, "copied"), (overruled, "overruled"))])
    nodes = staged(nodes.where("fixed OR copied OR overruled"), "style-tree")
    common = lambda n, m: F.log(n.cast("double")) >= (1 - low_importance) * F.log(m.cast("double"))
    blocks = counts.where("kind = 3").join(nodes.where("fixed OR copied"), ["host", "path"]).where(
        F.when(F.col("fixed"), common(F.col("n"), F.col("bodies"))).otherwise(common(F.col("rows"), F.col("pages"))))
    marks = blocks.select("host", F.when(F.col("fixed"), F.lit(0)).otherwise(F.lit(2)).alias("what"), F.col("feature").alias("mark")).union(
        nodes.where("overruled").select("host", F.lit(1), "path"))
    names = ("low", "rich", "copied")
    # a row per host at most; the table has a known size, and Spark broadcasts it only below its own threshold
    marks = staged(marks.groupBy("host").agg(*[F.collect_list(F.when(F.col("what") == i, F.col("mark"))).alias(n) for i, n in enumerate(names)]), "style-marks")
    joined = pages.join(marks, "host", "left").select("id", "url", "html", *names)
    schema = T.StructType([T.StructField(id_col, df.schema[id_col].dataType), T.StructField(url_col, df.schema[url_col].dataType), T.StructField("text", T.StringType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                texts = ["\n".join(kept_blocks(h or "", *[set(x or ()) for x in marks])) for h, *marks in
                         zip(*[part.column(i).to_pylist() for i in (2, 3, 4, 5)], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], names=schema.names)

    return joined.mapInArrow(run, schema)
