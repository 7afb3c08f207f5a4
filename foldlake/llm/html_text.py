"""HTML extraction by site template removal.

Each page is parsed to a tree and every block-level subtree that holds text is hashed. Spark counts, for each host, on
how many different articles a subtree stands; subtrees that recur across many pages of a host are its template and are
deleted. Elements go without a count where HTML itself says that they are no article (element, role, hidden state) and
where their class or id names what differs from page to page, such as reader comments and adverts. Names of what may as
well be text (notice, banner, share) only make a count of two enough, or decide on hosts of too few pages to count.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldlake.llm import common

#: A subtree outside the article is template if it stands on this share of a host's different pages, and on so many.
OUTSIDE_SHARE, OUTSIDE_PAGES = 0.1, 3
#: The same inside the article element, where short sentences may recur by chance.
INSIDE_SHARE, INSIDE_PAGES = 0.5, 10
#: The same for elements whose class or id is one of DOUBTFUL.
NAMED_SHARE, NAMED_PAGES = 0.02, 2
#: Inside an article, recurring subtrees are template only if they hold at most this share of its text: else the pages
#: are versions of one article.
INSIDE_MOST = 0.5

#: Templates with at most so many hashes (8 bytes each) in all are broadcast; larger ones are joined by host.
BROADCAST_HASHES = 500_000

# Element names of HTML and words by which sites name what is no article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noscript noembed noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " frameset h1 h2 h3 h4 h5 h6 header hgroup hr html li legend main menu nav ol optgroup option p pre search section"
    " summary table caption tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - frozenset("body html td th tr tbody thead tfoot caption option optgroup legend".split())
DROPPED = frozenset(
    "script style title textarea iframe noscript noembed noframes xmp head nav footer aside form button select option"
    " input template svg math canvas audio video object embed dialog menu map datalist fieldset label search".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar".split())
#: What of an article's header is article: title and lead, not the loose words of a byline.
HEADER_TEXT = frozenset("h1 h2 h3 h4 h5 h6 hgroup p".split())
#: Names of what differs from page to page, so that a count cannot tell it.
NAMES = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs footer masthead sidebar ad ads adv advert adverts advertisement"
    " advertising adsense sponsor sponsored sponsors related recommended recommendations comment comments commentlist"
    " disqus reply replies pagination pager".split()
)
#: Names of what a count tells: the same on many pages if it is no article.
DOUBTFUL = frozenset(
    "promo promotion banner cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription"
    " signup login share sharing social toolbar widget widgets".split()
)
#: Last parts of names that say nothing: what stands before them counts (ad-container, share-buttons, but not share-price).
PLAIN_PARTS = frozenset("list container wrapper wrap box block section area bar slot unit inner item items buttons links icons form thread top bottom left right".split())
#: Elements that end when one of the same group begins, and those where the search for an open one stops.
SIBLINGS = (
    (frozenset({"li"}), frozenset({"li"}), frozenset({"ul", "ol", "menu"})),
    (frozenset({"dt", "dd"}), frozenset({"dt", "dd"}), frozenset({"dl"})),
    (frozenset({"tr"}), frozenset({"tr", "td", "th"}), frozenset({"table"})),
    (frozenset({"td", "th"}), frozenset({"td", "th"}), frozenset({"tr", "table"})),
    (frozenset({"option"}), frozenset({"option"}), frozenset({"select"})),
    (frozenset({"p"}), frozenset({"p"}), BLOCK - {"p", "dt", "dd", "li"}),
)
_STARTS = {tag: at for at, (begins, _, _) in enumerate(SIBLINGS) for tag in begins - {"p"}}
_P = len(SIBLINGS) - 1
_SCOPED = frozenset().union(*(ended | limits for _, ended, limits in SIBLINGS))

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>""",
    re.S,
)
_BOGUS = re.compile("<[!?]")
_RAW_END = {tag: re.compile(rf"</{tag}\b[^>]*>?", re.I) for tag in RAW}
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")


class Node:
    __slots__ = ("tag", "attrs", "children", "parent", "open", "kind")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent, self.children, self.kind = tag, attrs, parent, [], None
        #: For each group of SIBLINGS the outermost open element that the next one of the group ends.
        self.open = parent.open if parent else (None,) * len(SIBLINGS)
        if tag in _SCOPED:
            self.open = tuple(
                None if tag in limits else before or (self if tag in ended else None)
                for before, (_, ended, limits) in zip(self.open, SIBLINGS)
            )


def parse(page: str) -> Node:
    """The tree of a page, in time in proportion to its length. End tags that HTML lets a page omit are supplied; stray
    end tags are ignored."""
    root = at = Node("#root", {}, None)
    end, size, last = 0, len(page), page.rfind(">")
    open_tags: Counter[str] = Counter()

    def close(until: Node) -> Node:
        node = at
        while node is not until:
            open_tags[node.tag] -= 1
            node = node.parent
        open_tags[until.tag] -= 1
        return until.parent

    while end < size:
        found = _TAG.search(page, end) if end <= last else None
        if found is None:
            bogus = _BOGUS.search(page, end)  # a comment without end
            at.children.append(page[end : bogus.start() if bogus else size])
            break
        if found.start() > end:
            at.children.append(page[end : found.start()])
        end = found.end()
        tag = found[2] or found[5]
        if not tag:
            continue
        tag = tag.lower()
        if found[1] or found[4]:
            if open_tags[tag]:
                up = at
                while up.tag != tag:
                    up = up.parent
                at = close(up)
            continue
        attrs = found[3] or found[6] or ""
        if tag in CLOSES_P and at.open[_P]:
            at = close(at.open[_P])
        if tag in _STARTS and at.open[_STARTS[tag]]:
            at = close(at.open[_STARTS[tag]])
        values = {}
        if attrs.strip(" \t\n\r\f/"):
            for name, a, b, c in _ATTR.findall(attrs):
                values.setdefault(name.lower(), html.unescape(a or b or c))
        node = Node(tag, values, at)
        at.children.append(node)
        if tag in RAW:
            ended = _RAW_END[tag].search(page, end)
            node.children.append(page[end : ended.start() if ended else size])
            end = ended.end() if ended else size
        elif tag not in VOID and not (attrs.endswith("/") and tag not in BLOCK):
            open_tags[tag] += 1
            at = node
    return root


def names(attrs: dict[str, str]) -> set[str]:
    """What class and id call an element: of each name the last part that says something."""
    out = set()
    for name in f"{attrs.get('class', '')} {attrs.get('id', '')}".lower().split():
        parts = [x for x in re.split(r"[-_\d]+", name) if x]
        while len(parts) > 1 and parts[-1] in PLAIN_PARTS:
            parts.pop()
        out.update(parts[-1:])
    return out


TEXT, DROPPED_ALWAYS, MAYBE = 0, 1, 2


def kind_of(node: Node) -> int:
    """Whether an element may be article (TEXT), is none by element, role, hidden state or name (DROPPED_ALWAYS), or
    bears a doubtful name (MAYBE)."""
    if node.kind is None:
        node.kind = _kind(node)
    return node.kind


def _kind(node: Node) -> int:
    attrs = node.attrs
    if node.tag in DROPPED:
        return DROPPED_ALWAYS
    if not attrs or node.tag in ("html", "body", "main", "article", "#root"):
        return TEXT
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in attrs.get("style", "").replace(" ", "").lower():
        return DROPPED_ALWAYS
    if attrs.get("role", "").lower() in DROPPED_ROLES:
        return DROPPED_ALWAYS
    if "class" in attrs or "id" in attrs:
        found = names(attrs)
        return DROPPED_ALWAYS if found & NAMES else MAYBE if found & DOUBTFUL else TEXT
    return TEXT


def dropped(node: Node, in_article: bool) -> bool:
    """Whether an element is no article whatever is counted. A header is the article's only if it stands in it."""
    return kind_of(node) == DROPPED_ALWAYS or node.tag == "header" and not in_article


def lengths(root: Node) -> dict[Node, int]:
    """Characters of text below each element, without dropped elements, all in one walk."""
    out: dict[Node, int] = {}
    todo: list[tuple[Node, bool]] = [(root, False)]
    while todo:
        node, seen = todo.pop()
        if seen:
            out[node] = sum(len(c) if isinstance(c, str) else out.get(c, 0) for c in node.children)
        else:
            todo.append((node, True))
            todo += [(c, False) for c in node.children if not isinstance(c, str) and not dropped(c, True)]
    return out


def container(root: Node) -> Node:
    """The element that holds the article: the article element with most text, else main, else the page."""
    size = lengths(root)
    for fits in (lambda n: n.tag == "article", lambda n: n.tag == "main" or n.attrs.get("role") == "main"):
        best = max((n for n in size if fits(n)), key=size.__getitem__, default=None)
        if best is not None and size[best]:
            return best
    return root


OUTSIDE, INSIDE, NAMED = 0, 1, 2


def hashes(root: Node, main: Node) -> list[tuple[int, int, Node]]:
    """Hash of each block-level subtree with text, and whether it stands outside the article, inside, or bears a doubtful
    name; children come first."""
    out, done = [], {}
    todo = [(root, False, False)]
    while todo:
        node, seen, inside = todo.pop()
        inside = main.tag != "#root" and (inside or node.parent is main)
        if not seen:
            todo.append((node, True, inside))
            todo += [(c, False, inside) for c in node.children if not isinstance(c, str) and c.tag not in ("script", "style")]
            continue
        digest, text = xxhash.xxh64(node.tag + "\0" + node.attrs.get("class", "") + "\0" + node.attrs.get("id", "")), False
        for child in node.children:
            if isinstance(child, str):
                words = " ".join(child.split())
                text = text or bool(words)
                digest.update("t" + words if words else "")
            elif child in done:
                value, full = done[child]
                text = text or full
                digest.update(value)
        done[node] = digest.digest(), text
        if text and node.tag in BLOCK and node.tag not in ("html", "body"):
            out.append((digest.intdigest() - (1 << 63), NAMED if kind_of(node) == MAYBE else INSIDE if inside else OUTSIDE, node))
    return out


def blocks(main: Node, template: set[Node]) -> list[str]:
    """The text blocks of the article in page order."""
    in_article = main.tag != "#root"
    out, now = [], []

    def cut() -> None:
        if words := " ".join(html.unescape("".join(now)).split()):
            out.append(words)
        now.clear()

    todo: list = [main]
    while todo:
        node = todo.pop()
        if node is None:
            cut()
        elif isinstance(node, str):
            now.append(node)
        elif node.tag == "br":
            now.append(" ")
        elif node is not main and (node in template or dropped(node, in_article)):
            if node.tag in BLOCK:
                cut()
        else:
            children = node.children
            if node.tag == "header" and node is not main:
                children = [c for c in children if not isinstance(c, str) and c.tag in HEADER_TEXT]
            if node.tag in BLOCK:
                cut()
                todo.append(None)
            todo.extend(reversed(children))
    cut()
    return out


def extract(page: str, template: frozenset[int] | set[int] | None = None) -> str:
    """The main text of a page, given the hashes of its site's template, or None if the site has too few pages to tell."""
    if not page:
        return ""
    root = parse(page)
    main = container(root)
    found = hashes(root, main)
    if template is None:
        gone = {node for _, kind, node in found if kind == NAMED}
    else:
        gone = {node for value, kind, node in found if value in template}
        inner = {node for value, kind, node in found if kind == INSIDE and value in template}
        if inner:
            whole, left = (sum(map(len, blocks(main, some - {main}))) for some in (gone - inner, gone))
            gone -= inner if whole - left > INSIDE_MOST * whole else set()
    return "\n\n".join(blocks(main, gone - {main}))


def host(url: Column) -> Column:
    """The lower-case host of a URL, empty if it has none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def subtrees(pages: DataFrame) -> DataFrame:
    """host, article (hash of what the article element holds), hashes, kinds: the subtrees of each page."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            articles, values, kinds = [], [], []
            for page in batch["html"].to_pylist():
                root = parse(page)
                main = container(root)
                found = hashes(root, main)
                text = "\0".join(blocks(main, set()))
                articles.append(xxhash.xxh64_intdigest(text) - (1 << 63))
                one = {value: kind for value, kind, node in found if node is not main}
                values.append(list(one))
                kinds.append(list(one.values()))
            yield pa.RecordBatch.from_arrays(
                [batch["host"], pa.array(articles, pa.int64()), pa.array(values, pa.list_(pa.int64())), pa.array(kinds, pa.list_(pa.int32()))],
                names=["host", "article", "hashes", "kinds"],
            )

    rows = pages.select(host(F.col("url")).alias("host"), F.col("html").cast("string").alias("html")).where("html <> ''")
    return rows.mapInArrow(hashed, "host string, article long, hashes array<long>, kinds array<int>")


def templates(pages: DataFrame) -> DataFrame:
    """host, template (hashes of the subtrees that recur across many pages of the host) for each host of OUTSIDE_PAGES
    different pages and more.

    Pages with the same article count once, so copies of an article are no template. As each hash stands on a fiftieth
    of a host's pages at least, a host's list is at most fifty times as long as its mean page has subtrees.
    """
    found = common.materialize(subtrees(pages), "subtrees")
    totals = found.select("host", "article").distinct().groupBy("host").agg(F.count("*").alias("pages")).where(F.col("pages") >= OUTSIDE_PAGES)
    each = found.select("host", "article", F.explode(F.arrays_zip("hashes", "kinds")).alias("s")).select(
        "host", "article", F.col("s.hashes").alias("hash"), F.col("s.kinds").alias("kind")
    )
    span = [F.min("kind").alias("least"), F.max("kind").alias("kind")]
    counts = each.groupBy("host", "hash", "article").agg(*span)
    counts = counts.groupBy("host", "hash").agg(F.count("*").alias("n"), F.min("least").alias("least"), F.max("kind").alias("kind"))
    counts = counts.where(F.col("n") >= NAMED_PAGES).join(totals, "host")

    def often(pages_at_least: int, share: float) -> Column:
        return (F.col("n") >= pages_at_least) & (F.col("n") >= share * F.col("pages"))

    named, inside = F.col("kind") == NAMED, F.col("least") >= INSIDE
    kept = F.when(named, often(NAMED_PAGES, NAMED_SHARE)).when(inside, often(INSIDE_PAGES, INSIDE_SHARE)).otherwise(often(OUTSIDE_PAGES, OUTSIDE_SHARE))
    lists = counts.where(kept).groupBy("host").agg(F.sort_array(F.collect_list("hash")).alias("template"))
    return totals.join(lists, "host", "left").select("host", F.coalesce("template", F.array().cast("array<long>")).alias("template"))


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row of pages, from its whole html.

    A null or empty page gives an empty text, a null url counts as the host ''. Where the pages differ and their host has
    three and more, its template is counted; else names alone decide. Repeated rows give repeated results;
    other columns are ignored, whatever their names; an empty table gives an empty result.
    """
    common.small_batches(pages.sparkSession)
    known = common.materialize(templates(pages).withColumnRenamed("host", "t_host"), "templates")
    hashes_in_all = known.agg(F.coalesce(F.sum(F.size("template") + 1), F.lit(0))).first()[0]
    if hashes_in_all <= BROADCAST_HASHES:
        known = F.broadcast(known)
    rows = pages.select("page_id", "url", common.text_or_empty("html").alias("html"), host(F.col("url")).alias("host"))
    rows = rows.join(known, F.col("host") == F.col("t_host"), "left").select("page_id", "url", "html", "template")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["template"].to_pylist()
            out = [extract(page, None if known is None else frozenset(known)) for page, known in zip(batch["html"].to_pylist(), lists, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["url"], pa.array(out, pa.string()), pa.array(map(len, out), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    kind = dict(pages.dtypes)["page_id"]
    return rows.mapInArrow(texts, f"page_id {kind}, url string, text string, n_chars long")


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every row of pages; extract_pages() says what odd rows give."""
    return extract_pages(common.table(spark, sf_dir, "pages"))
