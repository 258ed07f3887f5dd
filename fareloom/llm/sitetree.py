"""Main text of web pages through a site style tree.

The pages of a host are merged: elements with the same path of tags and classes are one
node of the host's tree. A node's presentation importance is the entropy of the child
sequences seen under it, its content importance one minus the mean entropy of the texts
below it over the pages (a text on every page is worth nothing, a text of one page is
worth one). Branches of low importance are noise and go from every page, inside an article
too. So does a single text that is nearly everywhere, though the other texts of its path
are not. Elements that say what they are (menus, footers, forms, adverts, comments) have no
importance at all; nothing else goes, so what stands outside an article is judged as well.

Copies of a page are not a layout. A page counts by a sketch of its longest text, a text by
the sketch of the longest other text of its page, and the entropies are those of the
sketches: a text between ever different others has a high one, a paragraph of near copies
has not, as most copies have one sketch. Equal bodies count once.

Importance comes from counts by (host, path, text), summed before the shuffle, so a host
with a third of all pages is no special case. A page meets its host's list of noise in a
join that AQE may split.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import pieces, prepare, stored
from fareloom.llm.linkgraph import host_of

THRESHOLD = 0.25  # importance below which a branch is noise
WEAK_WEIGHT = 0.5  # of the importance of what has a weak name: kept if its texts are its own
# Shares of a host's pages on which a text, and an element, must be to be layout at all; half of
# it under a weak name. Entropies alone would ask less of a large site than of a small one.
COMMON_TEXT = 0.3
COMMON_BRANCH = 0.1
CONTENT_SHARE = 0.9  # of content in a node's importance; the rest is presentation
MIN_PAGES = 4  # pages a branch must be seen on before it can be called noise
LEAST_SPREAD = math.log(MIN_PAGES) - 1e-9  # the entropy of as many unlike pages
SHORT_PAIRS = 16  # word pairs below which a text is its own sketch
PART_BYTES = 1 << 20

# Elements of HTML by their part in a page.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style textarea title noscript iframe template svg".split())
NOISE = frozenset(
    "head nav footer aside form script style noscript iframe template svg title textarea "
    "button select option label input dialog menu canvas object audio video map".split()
)
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main "
    "menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog menu menubar "
    "toolbar form".split()
)
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs consent "
    "cookie cookies copyright footer gdpr login masthead menu modal nav navbar navigation "
    "newsletter overlay pager pagination popup promo promotion recommended signup sponsor "
    "sponsored subscribe subscription toolbar widget widgets".split()
)
# Noise also beside the names of content, unless the name tells a state ("has-sidebar").
ALWAYS = frozenset(
    "comment comments commentlist disqus replies reply respond sidebar sidebars".split()
)
CONTENT = frozenset("article post entry content".split())
STATES = frozenset("has with no without open closed".split())
# Names that lessen a node's importance, whatever stands beside them.
WEAK = frozenset("share sharing social related notice notices skip".split())
HEADER_NAMES = frozenset(["header", "topbar", "site-header"])
# A start tag that ends an open element of these kinds.
CLOSES = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
}
SCOPE = frozenset("ul ol dl table article section div body nav aside main select".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)"
    r"|([^<]+|<)",
    re.S,
)
_MARK = re.compile(
    r"(?:\A|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I
)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACE = re.compile(r"\s+")


# Levels a path is spelled out for. Below, a new path begins at a key of the one above, so a
# page's paths take memory in proportion to its elements however deep they are nested.
CHAIN = 64


@dataclass
class Node:
    tag: str
    path: str
    level: int  # of the path's last element within its chain
    noise: bool
    article: bool
    weak: bool
    children: list[str] = field(default_factory=list)


def _marks(tag: str, attributes: str) -> tuple[str, bool, bool]:
    """The style name of an element (its classes and id), whether it says it is noise, and
    whether it has a weak name. The names of a whole page tell nothing of its text."""
    if not attributes or "=" not in attributes and "hidden" not in attributes.lower():
        return "", False, False
    names, noise, weak = [], False, False
    for key, value in _MARK.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "role":
            noise |= value.lower() in ROLES
            names.append(f"@{value.lower()}")
        elif key == "hidden" or key == "aria-hidden":
            noise |= key == "hidden" or value.lower() == "true"
        else:
            names.append(("." if key == "class" else "#") + re.sub(r"\d+", "0", value))
            told = [{x.lower() for x in _NAME.findall(name)} for name in value.split()]
            every = set().union(*told)
            noise |= bool(every & NAMES) and not every & CONTENT
            noise |= value.lower() in HEADER_NAMES
            if tag not in ("html", "body"):
                noise |= any(x & ALWAYS and not x & STATES for x in told)
                weak |= bool(every & WEAK)
    return "".join(names), noise, weak


@dataclass
class Page:
    """Blocks of text, each with the path of its element, and the child tags by path."""

    blocks: list[tuple[str, str, bool]]  # path, text, under a weak name
    styles: list[tuple[str, str, bool]]  # path, child tags, under a weak name
    links: dict[str, str]  # the path above the beginning of each further chain


def parse(source: str) -> Page:
    """The page without what says it is noise. Unclosed and stray tags are taken as they come."""
    root = Node("", "", 0, False, False, False)
    stack, blocks, styles = [root], [], []
    links: dict[str, str] = {}
    opened: Counter[str] = Counter()  # open elements by tag, so that none is looked for in vain
    text: list[str] = []

    def flush() -> None:
        if text:
            whole = _SPACE.sub(" ", entities.unescape("".join(text))).strip()
            text.clear()
            if whole:
                node = next((n for n in reversed(stack) if n.tag in BLOCK), root)
                blocks.append((node.path, whole, node.weak))

    def close(depth: int) -> None:
        while len(stack) > depth:
            node = stack.pop()
            opened[node.tag] -= 1
            if node.tag in BLOCK and not node.noise:
                styles.append((node.path, " ".join(node.children), node.weak))

    at, size = 0, len(source)
    while at < size:
        found = _TOKEN.match(source, at)
        if found is None:  # an unfinished tag at the end
            break
        at = found.end()
        ending, tag, attributes, plain = found.groups()
        if plain is not None:
            if not stack[-1].noise:
                text.append(plain)
            continue
        if tag is None:
            continue
        tag = tag.lower()
        if ending:
            depth = 0
            if opened[tag]:
                depth = next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag)
            if depth and (tag in BLOCK or not any(n.tag in BLOCK for n in stack[depth + 1 :])):
                if tag in BLOCK:
                    flush()
                close(depth)
            continue
        if tag in BLOCK or tag == "br":
            if tag == "br":
                if not stack[-1].noise:
                    text.append(" ")
            else:
                flush()
                for i in range(len(stack) - 1, 0, -1) if opened["p"] else ():
                    if stack[i].tag == "p":  # an open paragraph ends here
                        close(i)
                        break
                    if stack[i].tag in SCOPE:
                        break
        for other in CLOSES.get(tag, ()):
            for i in range(len(stack) - 1, 0, -1) if opened[other] else ():
                if stack[i].tag == other:
                    close(i)
                    break
                if stack[i].tag in SCOPE and stack[i].tag != other:
                    break
        if tag in VOID:
            continue
        parent = stack[-1]
        style, says, weak = _marks(tag, attributes)
        article = parent.article or tag in ("article", "main") or "@main" in style
        noise = parent.noise or says or tag in NOISE or (tag == "header" and not parent.article)
        path, level = parent.path, parent.level
        if tag in BLOCK:
            if level == CHAIN:
                above, path, level = path, f"~{_key(path):x}", 0
                links[path] = above
            path, level = f"{path}>{tag}{style}", level + 1
        if tag in BLOCK and (not parent.children or parent.children[-1] != tag):
            parent.children.append(tag)
        if noise and not parent.noise and tag in BLOCK:
            flush()
        if tag in RAW:  # up to its end tag, whatever stands in it
            if attributes.endswith("/"):
                continue
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(source, at)
            at = end.end() if end else size
            continue
        if attributes.endswith("/") and tag in ("svg", "path"):
            continue
        stack.append(Node(tag, path, level, noise, article, parent.weak or weak and tag in BLOCK))
        opened[tag] += 1
    flush()
    close(1)
    return Page(blocks, styles, links)


def _key(*parts: str) -> int:
    return int.from_bytes(xxhash.xxh64_digest("\x00".join(parts).encode("utf-8", "replace")), "big", signed=True)


def sketch(text: str) -> int:
    """The least hash of the text's word pairs, equal for most near copies of a text."""
    parts = text.split()
    if len(text) > 20 * len(parts):  # no spaces between words
        parts = list(text)
    pairs = [f"{a} {b}" for a, b in zip(parts, parts[1:])]
    if len(pairs) < SHORT_PAIRS:  # a few words in common do not make short texts copies
        pairs = [text]
    least = min(map(xxhash.xxh64_intdigest, (x.encode("utf-8", "replace") for x in pairs)))
    return least - (1 << 63)


def contexts(texts: list[str]) -> tuple[int, dict[str, int]]:
    """The page's sketch, and for each text the sketch of the longest other one."""
    ranked = sorted(set(texts), key=lambda t: (-len(t), t))[:2]
    longest, second = (*map(sketch, ranked), 0, 0)[:2]
    return longest, {t: second if t == ranked[0] else longest for t in texts}


def extract(source: str | None, noise: set[int]) -> str:
    """The page's text without the branches and texts that are in ``noise``."""
    if not source:
        return ""
    page = parse(source)
    known: dict[str, bool] = {"": False}

    def gone(path: str) -> bool:
        """The element or one above it is noise."""
        trail = []
        while path not in known:
            trail.append(path)
            path = path.rpartition(">")[0] or page.links.get(path, "")
        state = known[path]
        for below in reversed(trail):
            state = known[below] = state or _key(below) in noise
        return state

    return "\n\n".join(
        text
        for path, text, _ in page.blocks
        if not noise or not (gone(path) or _key(path, text) in noise)
    )


def noise_of(pages: DataFrame) -> DataFrame:
    """(host, noise): what is of low importance in every host's tree, as keys of paths
    and of paths with a text.

    Pages of one host with the same body count once, or copies would look like a layout.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "html", PART_BYTES):
            host, page, sketched, path, kind, value = [], [], [], [], [], []
            for h, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                if not source or not h:
                    continue
                parsed = parse(source)
                blocks = parsed.blocks
                body = _key(*[t for _, t, _ in blocks])
                own, others = contexts([t for _, t, _ in blocks])
                rows = {(p, 0, _key(s), own) for p, s, _ in parsed.styles}
                rows |= {(p, 3 if w else 1, _key(p, t), others[t]) for p, t, w in blocks}
                rows |= {(p, 2, int(w), own) for p, _, w in [*parsed.styles, ("", "", False)]}
                for p, k, v, c in rows:
                    host.append(h)
                    page.append(body)
                    sketched.append(c)
                    path.append(p)
                    kind.append(k)
                    value.append(v)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(host, pa.string()),
                    pa.array(page, pa.int64()),
                    pa.array(sketched, pa.int64()),
                    pa.array(path, pa.string()),
                    pa.array(kind, pa.int8()),
                    pa.array(value, pa.int64()),
                ],
                names=["host", "page", "sketch", "path", "kind", "value"],
            )

    rows = pages.select("host", "html").mapInArrow(
        run, "host string, page bigint, sketch bigint, path string, kind tinyint, value bigint"
    )
    # Pages of each text (3: under a weak name) or child sequence of a node and of the node
    # itself, each distinct page once, and the entropy of their sketches, which follow from
    # the body.
    counted = stored(
        rows.groupBy("host", "path", "kind", "value", "page")
        .agg(F.min("sketch").alias("sketch"))
        .groupBy("host", "path", "kind", "value", "sketch")
        .agg(F.count(F.lit(1)).alias("c"))
        .groupBy("host", "path", "kind", "value")
        .agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.log("c")).alias("c_log"))
        .select(
            "host", "path", "kind", "value", "n",
            F.greatest(F.log("n") - F.col("c_log") / F.col("n"), F.lit(0.0)).alias("spread"),
        ),
        "counted",
    )
    is_text = F.col("kind").isin(1, 3)
    sums = stored(
        counted.groupBy("host", "path").agg(
            F.max(F.when(F.col("kind") == 2, F.col("spread"))).alias("page_spread"),
            F.max(F.when(F.col("kind") == 2, F.col("value"))).alias("weak"),
            F.sum(F.when(F.col("kind") == 0, F.col("n"))).alias("styles"),
            F.sum(F.when(F.col("kind") == 0, F.col("n") * F.log("n"))).alias("style_log"),
            F.sum(F.when(is_text, F.lit(1))).alias("texts"),
            F.sum(F.when(is_text, F.col("spread"))).alias("text_spread"),
            F.max(F.when(is_text, F.col("spread"))).alias("widest"),
        ),
        "tree",
    )
    # Every node's texts are those of the elements below it as well; the path of the root is "".
    above = F.expr(
        "transform(sequence(0, size(split(path, '>')) - 1), "
        "i -> array_join(slice(split(path, '>'), 1, i + 1), '>'))"
    )
    # The root has the texts of further chains too; other elements have those of their own.
    above = F.array_union(above, F.array(F.lit("")))
    below = (
        sums.where("texts > 0")
        .select("host", F.explode(above).alias("path"), "texts", "text_spread", "widest")
        .groupBy("host", "path")
        .agg(
            F.sum("texts").alias("texts"),
            F.sum("text_spread").alias("text_spread"),
            F.max("widest").alias("widest"),
        )
    )
    # Entropies over that of the pages lie between 0 and 1.
    weighed = stored(
        sums.where("page_spread is not null")
        .select("host", "path", "page_spread", "styles", "style_log", "weak")
        .join(below, ["host", "path"])
        .withColumn("most", F.greatest("page_spread", "widest"))
        .where(F.col("most") >= LEAST_SPREAD),
        "weighed",
    )
    m = F.log("styles")
    presentation = (m - F.col("style_log") / F.col("styles")) / m
    content = 1 - F.col("text_spread") / F.col("texts") / F.col("most")
    importance = CONTENT_SHARE * content + (1 - CONTENT_SHARE) * presentation
    importance *= F.when(F.col("weak") == 1, WEAK_WEIGHT).otherwise(1.0)
    key = F.udf(_key, "bigint")
    site = weighed.where("path = ''").select("host", F.col("most").alias("site_most"))
    share = F.lit(COMMON_BRANCH) * F.when(F.col("weak") == 1, WEAK_WEIGHT).otherwise(1.0)
    branches = (
        weighed.where((F.col("path") != "") & (importance < THRESHOLD))
        .join(site, "host")
        .where(F.col("page_spread") - F.col("site_most") >= F.log(share))
        .select("host", key("path").alias("key"))
    )
    # A text has no children: its content alone decides, against all pages of the host.
    weight = F.when(F.col("kind") == 3, WEAK_WEIGHT).otherwise(1.0)
    texts = (
        counted.where(is_text & (F.col("spread") >= (1 - THRESHOLD / weight) * LEAST_SPREAD))
        .select("host", "value", "spread", weight.alias("weight"))
        .join(weighed.where("path = ''").select("host", "most"), "host")
        .where((1 - F.col("spread") / F.col("most")) * F.col("weight") < THRESHOLD)
        .where(F.col("spread") - F.col("most") >= F.log(F.lit(COMMON_TEXT) * F.col("weight")))
        .select("host", F.col("value").alias("key"))
    )
    return (
        branches.unionAll(texts)
        .groupBy("host")
        .agg(F.collect_list("key").alias("noise"))  # one site's layout
    )


def main_text(pages: DataFrame) -> DataFrame:
    """Every row's page_id, url, text and n_chars.

    Null and empty html give the empty text, as does a page that is all noise. Pages
    without a host have no site and lose only what says it is noise. Repeated rows come
    back as often as given. Other columns are ignored.
    """
    prepare(pages.sparkSession)
    slim = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    noise = stored(noise_of(slim), "noise")
    joined = slim.join(noise, "host", "left").select("page_id", "url", "html", "noise")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "html", PART_BYTES):
            texts = [
                extract(source, set(own or ()))
                for source, own in zip(
                    batch.column("html").to_pylist(), batch.column("noise").to_pylist()
                )
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    page_id = pages.schema["page_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"page_id {page_id}, url string, text string, n_chars bigint")
