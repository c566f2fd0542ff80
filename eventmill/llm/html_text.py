"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree: an element's place is its path of tags and classes. Two kinds of nodes are weighed
by entropy over the host's pages:

* presentation: how evenly the pages that have an element spread over its child sequences (1: each page its own, 0: all alike). An element that
  fewer than half of the host's pages have counts as 1;
* content: 1 - log_m(k) for a block of text that stands at the same place on k of the host's m pages (1: on one page only, 0: on all).

A block's importance is its content times GAMMA + (1 - GAMMA) * presentation of its parent, so what stands on every page has none; blocks below
the threshold are cut, and inside an article the threshold is lower. An element's importance is made from its blocks: the mean of their content by
length, where linked characters weigh LINKED, times BRANCH_GAMMA + (1 - BRANCH_GAMMA) * its presentation, times a prior. A branch below
BRANCH_THRESHOLD goes with all it holds. So lists of links at the same place in the same style go though their texts differ from page to page.
Hosts with fewer than LEAST_PAGES pages say too little; there the priors decide.

The prior comes from the markup. Tags, roles and hidden marks that say menu, header, footer, sidebar, form or script have 0 on any host, and so do names
of reader comments. Other words in a class or id are STRONG where they say nothing else (`ad-slot`), or WEAK (`legal-analysis`, `search-results`);
ids of headings and sections say nothing, nor do the names of articles. No prior and no entropy drops a branch that holds the main element or the
share WHOLE of the text around it (of comments: all of it), which is that text itself. Branches without a name are weighed outside articles only, and
where they have two blocks or more. An article of which every block is repeated, as where all pages of a host are the same, keeps them. Where a page has an article or main element, the blocks inside are the text; else all blocks of the body are.

The first pass over the pages sends hashes only: one row for each block and page. The second sends each page's blocks, compressed, to meet the
weights of its nodes. No host is gathered in one place, so the size of a host does not matter.

A null or empty html gives an empty text; a null url is a host of its own (the empty one). Pages are told apart by page_id, or where it is
null by a hash of url and html; rows that repeat are extracted each. Broken markup, unclosed elements and cut-off pages are read
as far as they go. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import html
import itertools
import re
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple
from urllib.parse import urlsplit

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmill.llm import text as T

GAMMA, THRESHOLD, ARTICLE_THRESHOLD, LEAST_PAGES = 0.9, 0.1, 0.05, 8
BRANCH_GAMMA, BRANCH_THRESHOLD, LINKED, WHOLE, LOW = 0.6, 0.15, 0.2, 0.8, 0.5
#: What a branch's own markup says of it, and the prior that this is worth.
UNNAMED, WEAK, STRONG, COMMENT = range(4)
ROOT = xxhash.xxh3_64_intdigest(b"") >> 1
PRIOR = {UNNAMED: 1.0, WEAK: 0.3, STRONG: 0.1, COMMENT: 0.0}

#: Fixed values of HTML: elements without content, with text that is no markup, and those that break a line of text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes noscript xmp svg template object select".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head"
    " header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Start tags that close an open element, up to the nearest element that holds it.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"tbody", "thead", "tfoot", "tr"}, {"table"}), "option": ({"option"}, {"select"}),
}
NOISE_TAGS = frozenset("nav aside form dialog menu button input label fieldset head audio video canvas annotation annotation-xml".split()) | RAW
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
NOISE_NAMES = frozenset(
    "nav navbar navigation menu menubar submenu breadcrumb breadcrumbs sidebar sidebars aside rail footer foot masthead topbar toolbar header"
    " ad ads adv advert adverts advertisement advertising adsense adslot adbox banner banners sponsor sponsored promo promos promotion promoted"
    " cookie cookies consent gdpr notice notices notification notifications alert alerts popup modal overlay lightbox paywall"
    " newsletter subscribe subscription signup login signin register form search searchbox share sharing social follow"
    " comment comments commentlist disqus reply replies respond discussion reviews feedback"
    " related recommended recommendations teaser teasers widget widgets pagination pager paging skip tags copyright legal disclaimer".split()
)
COMMENT_NAMES = frozenset("comment comments commentlist disqus reply replies respond".split())
#: Words beside which a name of noise still says nothing but noise.
PLACES = frozenset(
    "site page main global primary secondary top bottom left right upper lower box block slot area bar list container wrapper wrap inner outer section item items"
    " link links button buttons unit module panel group row col column post posts article articles story stories message text title content the my js".split()
)
#: Words after which a comment's name tells a state of the page, such as comments-open.
STATES = frozenset("open closed on off enabled disabled count".split())
PLAIN, NO_IDS = frozenset(("html", "body")), frozenset("h1 h2 h3 h4 h5 h6 section".split())
TAG = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)", re.S)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
NAME = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


class Element(NamedTuple):
    tag: str
    path: int
    noise: bool
    article: bool
    children: list[str]
    named: bool = False
    linked: bool = False
    kind: int = UNNAMED
    start: int = 0
    number: int = 0


class Block(NamedTuple):
    """A block of text: its element's path, its parent's path, whether it stands in an article, and how many of its characters are linked."""

    path: int
    parent: int
    article: bool
    text: str
    linked: int = 0


class Branch(NamedTuple):
    """An element over blocks start to stop: its number in page order, what its names say, whether it stands in an article, whether it is or holds a main."""

    number: int
    path: int
    kind: int
    article: bool
    start: int
    stop: int
    main: bool = False


def says(tag: str, attributes: str, inside_article: bool) -> tuple[bool, int, str]:
    """Whether tag, role or hidden marks say that an element is no content; what its names say; and its classes."""
    found = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(attributes)} if attributes.strip(" /") else {}
    style = found.get("style", "").replace(" ", "").lower()
    classes = " ".join(found.get("class", "").split())
    if tag in NOISE_TAGS or (tag == "header" and not inside_article) or tag == "footer":
        return True, UNNAMED, classes
    if tag in PLAIN:
        return False, UNNAMED, classes
    if "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in style or found.get("role", "").lower() in NOISE_ROLES:
        return True, UNNAMED, classes
    kind = UNNAMED
    for word in [*classes.split(), *([] if tag in NO_IDS else found.get("id", "").split())]:
        names = [x.lower() for x in NAME.findall(word)]
        if not names or names[0] in ("has", "with", "no", "without", "js") or NOISE_NAMES.isdisjoint(names) or (inside_article and "header" in names):
            continue
        if not COMMENT_NAMES.isdisjoint(names) and names[-1] not in STATES:
            kind = COMMENT
        elif tag not in ("article", "main"):
            plain = all(x in NOISE_NAMES or x in PLACES or x.isdigit() for x in names)
            kind = max(kind, STRONG if plain else WEAK)
    if tag not in BLOCK:
        return kind >= STRONG and not inside_article, UNNAMED, classes
    return False, kind, classes


def parse(page: str) -> tuple[list[Block], dict[int, int], list[Branch]]:
    """Blocks in page order that tags, roles and hidden marks leave, the child sequence of every such element (hashes by path), and the branches to
    weigh, outer ones first."""
    root = Element("", ROOT, False, False, [])
    stack, blocks, parts, styles, branches = [root], [], [], {}, []
    step, end, linked, number = 0, len(page), 0, 0

    def flush() -> None:
        nonlocal linked
        if parts:
            line = "".join(parts)
            line = " ".join((html.unescape(line) if "&" in line else line).split())
            parts.clear()
            at = next(i for i in range(len(stack) - 1, -1, -1) if i == 0 or stack[i].tag in BLOCK)
            if line:
                blocks.append(Block(stack[at].path, stack[max(0, at - 1)].path, stack[at].article, line, min(linked, len(line))))
        linked = 0

    def pop() -> None:
        if stack[-1].tag in BLOCK:
            flush()
        done = stack.pop()
        if not done.noise and done.children:
            styles[done.path] = style_of(done)
        if not done.noise and done.tag in BLOCK and len(blocks) > done.start and (done.kind or done.tag == "main" or len(blocks) > done.start + 1):
            branches.append(Branch(done.number, done.path, done.kind, stack[-1].article, done.start, len(blocks), done.tag == "main"))

    while step < end:
        at = page.find("<", step)
        found = TAG.match(page, at) if at >= 0 else None
        upto = at if found else at + 1 or end
        if upto > step and not stack[-1].noise:
            parts.append(page[step:upto])
            linked += len(page[step:upto].strip()) if stack[-1].linked else 0
        step = found.end() if found else upto
        tag = (found[2] or "").lower() if found else ""
        if not tag:
            continue
        if found[1]:
            at = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if at and not (tag not in BLOCK and any(e.tag in BLOCK for e in stack[at + 1 :])):
                while len(stack) > at:
                    pop()
            continue
        if tag in BLOCK:
            at = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == "p"), 0)
            while at and len(stack) > at:
                pop()
        if tag in CLOSES:
            closed, holders = CLOSES[tag]
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in holders:
                    break
                if stack[i].tag in closed:
                    while len(stack) > i:
                        pop()
        if tag in VOID:
            if tag in ("br", "hr") and not stack[-1].noise:
                parts.append(" ")
            continue
        if tag in BLOCK:
            flush()
        above = stack[-1]
        noise, kind, classes = (True, UNNAMED, "") if above.noise else says(tag, found[3], above.article)
        if tag in RAW:
            close = re.compile(f"</{re.escape(tag)}(?=[\\s/>]|$)", re.I).search(page, step)
            step = close.start() if close else end
        if not noise and not kind:
            above.children.append(tag)
        path = 0 if noise else xxhash.xxh3_64_intdigest(f"{above.path} {tag} {classes}".encode("utf-8", "surrogatepass")) >> 1
        article, number = above.article or (tag in ("article", "main") and not noise), number + 1
        stack.append(Element(tag, path, noise, article, [], above.named or kind > 0, above.linked or tag == "a", kind, len(blocks), number))
    flush()
    while len(stack) > 1:
        pop()
    styles[ROOT] = style_of(root)
    return blocks, styles, sorted(branches)


def style_of(element: Element) -> int:
    return xxhash.xxh3_64_intdigest(" ".join(element.children).encode("utf-8", "surrogatepass")) >> 1


def weight(text: str, linked: int) -> float:
    return len(text) - (1 - LINKED) * linked


def pruned(weights: list[float], branches: list[Branch], importance: Callable[[Branch], float]) -> list[bool]:
    """Whether each block goes with a branch. Outer branches are judged first; one that is nearly all of the text around it, or holds the main element, stays."""
    gone, sums = [False] * len(weights), [0.0, *itertools.accumulate(weights)]
    around, mains = [(0, len(weights))], [b for b in branches if b.main]
    for b in branches:
        while around[-1][1] <= b.start and len(around) > 1:
            around.pop()
        if gone[b.start] or b.main or any(b.start <= m.start and m.stop <= b.stop for m in mains):
            continue
        own, whole = sums[b.stop] - sums[b.start], sums[around[-1][1]] - sums[around[-1][0]]
        if own >= whole * (1 if b.kind == COMMENT else WHOLE):
            around.append((b.start, b.stop))
        elif importance(b) < BRANCH_THRESHOLD:
            gone[b.start : b.stop] = [True] * (b.stop - b.start)
    return gone


def only(blocks: list[Block], branches: list[Branch], take: list[bool]) -> tuple[list[Block], list[Branch]]:
    """The taken blocks and the branches over them."""
    new = [0, *itertools.accumulate(take)]
    moved = [b._replace(start=new[b.start], stop=new[b.stop]) for b in branches]
    return list(itertools.compress(blocks, take)), [b for b in moved if b.stop > b.start]


def by_names(branch: Branch) -> float:
    """The importance of a branch whose host says nothing."""
    return 0.0 if branch.kind else 1.0


def parts(page: str | None) -> tuple[list[Block], dict[int, int], list[Branch]]:
    """The blocks that may be the text, and the branches over them that are still to be weighed.

    Names that say nothing but noise decide on branches outside articles; then the blocks of articles are taken where there are any that names leave.
    """
    blocks, styles, branches = parse(page) if isinstance(page, str) else ([], {}, [])
    outside = [b for b in branches if not b.article and (b.kind >= STRONG or b.main)]
    gone = pruned([weight(b.text, b.linked) for b in blocks], outside, by_names)
    if not all(gone):
        blocks, branches = only(blocks, branches, [not x for x in gone])
    inside, within = only(blocks, [b for b in branches if b.article], [b.article for b in blocks])
    if not all(pruned([weight(b.text, b.linked) for b in inside], within, by_names)):
        blocks, branches = inside, within
    return blocks, styles, [b for b in branches if b.kind or b.main or not b.article]


def candidates(page: str | None) -> tuple[list[Block], dict[int, int]]:
    """The blocks of the text of a page that stands alone."""
    blocks, styles, branches = parts(page)
    gone = pruned([weight(b.text, b.linked) for b in blocks], branches, by_names)
    return (blocks if all(gone) else list(itertools.compress(blocks, [not x for x in gone]))), styles


def host_of(url: str | None) -> int:
    try:
        name = (urlsplit(url).hostname or "") if isinstance(url, str) else ""
    except ValueError:
        name = ""
    return xxhash.xxh3_64_intdigest(name.encode("utf-8", "surrogatepass")) >> 1


def signature(host: int, block: Block) -> int:
    return xxhash.xxh3_64_intdigest(f"{host} {block.path} {block.text}".encode("utf-8", "surrogatepass")) >> 1


def nodes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (page, host, node, style, article, parent): style is 0 for a block of text, whose node is its signature and whose parent goes with it."""
    for frame in frames:
        rows = []
        for key, url, page in zip(frame["key"], frame["url"], frame["html"], strict=True):
            host = host_of(url)
            blocks, styles, _ = parts(page)
            rows += [(key, host, host ^ path, style, False, 0) for path, style in styles.items()]
            rows += [(key, host, s, 0, b.article, host ^ b.parent) for s, b in {signature(host, b): b for b in blocks}.items()]
            rows.append((key, host, 0, 0, False, 0))
        yield pd.DataFrame(rows, columns=["page", "host", "node", "style", "article", "parent"])


def packed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each page's blocks as compressed lines, with their signatures and linked characters; and its branches, six numbers each."""
    for frame in frames:
        signs, linked, over, inside, texts = [], [], [], [], []
        for url, page in zip(frame["url"], frame["html"], strict=True):
            host, (blocks, _, branches) = host_of(url), parts(page)
            signs.append([signature(host, b) for b in blocks])
            linked.append([b.linked for b in blocks])
            inside.append(all(b.article for b in blocks))
            over.append([int(x) for b in branches for x in (host ^ b.path, b.kind, b.article, b.start, b.stop, b.main)])
            texts.append(zlib.compress("\n".join(b.text for b in blocks).encode("utf-8", "surrogatepass"), 5))
        root = [host_of(url) ^ ROOT for url in frame["url"]]
        yield pd.DataFrame({"key": frame["key"], "page_id": frame["page_id"], "url": frame["url"], "root": root, "signs": signs, "linked": linked, "over": over, "inside": inside, "blocks": texts})


def joined(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The text of each page without what the weights of its nodes cut."""
    for frame in frames:
        texts, cuts = [], []
        columns = ("root", "signs", "linked", "over", "inside", "blocks", "weights")
        for root, signs, linked, over, inside, blocks, weights in zip(*[frame[c] for c in columns], strict=True):
            lines = zlib.decompress(blocks).decode("utf-8", "replace").split("\n") if len(signs) else []
            weighed = {} if weights is None else {w["node"]: w for w in weights}
            weight_of = [weight(line, n) for line, n in zip(lines, linked, strict=True)]
            known = root in weighed
            contents = [weighed[s]["value"] if s in weighed else 1.0 for s in signs]

            def importance(b: Branch, known=known, weighed=weighed, weight_of=weight_of, contents=contents, lines=lines) -> float:
                if not known or b.kind == COMMENT:
                    return by_names(b)
                own = slice(b.start, b.stop)
                value = sum(w * c for w, c in zip(weight_of[own], contents[own], strict=True)) / sum(map(len, lines[own]))
                shape = weighed[b.path]["value"] if b.path in weighed else 1.0
                return value * (BRANCH_GAMMA + (1 - BRANCH_GAMMA) * shape) * PRIOR[b.kind]

            branches = [Branch(i, int(x[0]), int(x[1]), bool(x[2]), int(x[3]), int(x[4]), bool(x[5])) for i, x in enumerate(zip(*[iter(over)] * 6, strict=True))]
            gone = pruned(weight_of, branches, importance)
            cut = [g or (s in weighed and weighed[s]["cut"]) for g, s in zip(gone, signs, strict=True)]
            gone = gone if inside and all(cut) else cut
            texts.append("\n".join(itertools.compress(lines, [not g for g in gone])))
            cuts.append(sum(gone))
        yield pd.DataFrame({"page_id": frame["page_id"], "url": frame["url"], "text": texts, "n_cut": cuts})


def page_key() -> Column:
    return F.coalesce(F.col("page_id").cast("long"), F.xxhash64("url", "html"))


def style_tree(pages: DataFrame) -> DataFrame:
    """The nodes of all hosts' trees, one row for each page that has them, stored: see `nodes`."""
    rows = pages.select(page_key().alias("key"), "url", "html")
    found = rows.mapInPandas(nodes, "page long, host long, node long, style long, article boolean, parent long")
    return T.written(found, "style_tree")


def presentation(tree: DataFrame) -> DataFrame:
    """host, node, pages, presentation: entropy of an element's child sequences to the base of the pages that have it."""
    styles = tree.where("style <> 0").groupBy("host", "node", "style").agg(F.count("*").alias("n"))
    sums = styles.groupBy("host", "node").agg(F.sum("n").alias("pages"), F.sum(F.col("n") * F.log("n")).alias("nlogn"))
    entropy = F.when(F.col("pages") > 1, 1 - F.col("nlogn") / (F.col("pages") * F.log("pages"))).otherwise(1.0)
    return sums.select("host", "node", "pages", entropy.alias("presentation"))


def known_hosts(tree: DataFrame) -> DataFrame:
    """host, m: pages of the hosts that have enough of them."""
    # Stored, as a join with a stored table can split a host's or a parent's rows, and one with an aggregate cannot.
    return T.written(tree.where("node = 0").groupBy("host").agg(F.count("*").alias("m")).where(F.col("m") >= LEAST_PAGES), "hosts")


def repeated(tree: DataFrame, hosts: DataFrame, shapes: DataFrame) -> DataFrame:
    """node, content, importance and cut of the blocks whose content is LOW or less."""
    blocks = tree.where("style = 0 AND node <> 0").groupBy("node", "host", "parent", "article").agg(F.count("*").alias("k")).where("k > 1")
    low = blocks.join(hosts, "host").withColumn("content", 1 - F.log("k") / F.log("m")).where(F.col("content") <= LOW)
    weighed = low.join(shapes.select(F.col("node").alias("parent"), "presentation"), "parent", "left")
    importance = F.col("content") * (GAMMA + (1 - GAMMA) * F.coalesce("presentation", F.lit(0.0)))
    cut = importance < F.when(F.col("article"), ARTICLE_THRESHOLD).otherwise(THRESHOLD)
    rows = weighed.select("node", "content", importance.alias("importance"), cut.alias("cut"))
    return rows.groupBy("node").agg(F.min("content").alias("content"), F.min("importance").alias("importance"), F.max("cut").alias("cut"))


def unimportant(tree: DataFrame) -> DataFrame:
    """node, importance of the blocks to cut by themselves."""
    return repeated(tree, known_hosts(tree), T.written(presentation(tree), "presentation")).where("cut").select("node", "importance")


def weights(tree: DataFrame) -> DataFrame:
    """node, value, cut of known hosts: the content of repeated blocks, and the presentation of elements that most of the host's pages have."""
    hosts, shapes = known_hosts(tree), T.written(presentation(tree), "presentation")
    blocks = repeated(tree, hosts, shapes).select("node", F.col("content").alias("value"), "cut")
    elements = shapes.join(hosts, "host").where("2 * pages >= m").select("node", F.col("presentation").alias("value"), F.lit(False).alias("cut"))
    return blocks.union(elements)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_cut (blocks that the style tree cut, named ones too) of every row."""
    tree = style_tree(pages)
    weighed = T.written(weights(tree), "weights")
    hits = tree.where("node <> 0").select("page", "node").join(weighed, "node")
    found = hits.groupBy("page").agg(F.collect_set(F.struct("node", "value", "cut")).alias("weights"))
    rows = pages.select(page_key().alias("key"), F.col("page_id").cast("string").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    texts = rows.mapInPandas(packed, "key long, page_id string, url string, root long, signs array<long>, linked array<long>, over array<long>, inside boolean, blocks binary")
    both = texts.join(found, texts["key"] == found["page"], "left").select("page_id", "url", "root", "signs", "linked", "over", "inside", "blocks", "weights")
    out = both.mapInPandas(joined, "page_id string, url string, text string, n_cut long")
    return out.withColumn("page_id", F.col("page_id").cast("long"))
