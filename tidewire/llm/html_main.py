"""Main text of web pages by a site style tree.

The DOMs of a host's pages are merged: elements with the same chain of tags and classes are one style
node. A node's presentation (its child tags) and content (its texts) are counted over the pages; entropy
says how much they vary. A node that looks and reads the same on page after page is of low importance,
and branches made of such nodes only are removed from each page. Elements whose tag, role or class names
them as menus, notices and the like are removed too, and an article element, where there is one, bounds
what is read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import slices
from tidewire.session import materialize

# Element classes of HTML.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style xmp iframe noembed noframes textarea title".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup html li main menu nav ol p pre section summary table "
    "tbody td tfoot th thead tr ul hr".split()
)
CLOSES_P = BLOCK - frozenset("body caption html li dd dt tbody td tfoot th thead tr".split())
SAME_CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",),
}
WALLS = frozenset("ul ol dl table html body article main select".split())
# What is never main text, by tag, by role and by a word of a class or id.
NOISE_TAGS = frozenset(
    "head script style noscript template iframe object embed svg canvas nav footer aside form button select "
    "option textarea input label fieldset dialog menu".split()
)
NOISE_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split()
)
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments "
    "commentlist consent cookie cookies disclaimer disqus footer gdpr header masthead menu modal nav navbar "
    "navigation newsletter notice notification overlay pager pagination popup promo promotion related respond "
    "share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
TAG = re.compile(r"</?([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)>")
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
# A header of an article belongs to it; names like has-sidebar or no-ads speak of something else.
OWN_HEADER = frozenset("article post entry story content".split())
ABOUT = frozenset("has with no without wrapper container layout".split())
NAMING = re.compile(r"\b(?:class|id|role)\b", re.I)


@dataclass
class Element:
    tag: str
    names: tuple[str, ...] = ()
    role: str = ""
    children: list[Element | str] = field(default_factory=list)
    key: int = 0


@dataclass(frozen=True)
class StyleConfig:
    """A node is judged from `least_pages` pages of its host on; below `importance` it is low."""

    least_pages: int = 8
    importance: float = 0.2


DEFAULT = StyleConfig()


def parse(source: str) -> Element:
    """The element tree of a page, however broken its markup."""
    root = Element("html")
    stack = [root]
    at, end = 0, len(source)
    while at < end:
        less = source.find("<", at)
        if less != at:
            text = source[at : less if less >= 0 else end]
            stack[-1].children.append(entities.unescape(text))
            if less < 0:
                break
        following = source[less + 1 : less + 2]
        if following in ("!", "?"):
            comment = source.startswith("<!--", less)
            close = source.find("-->" if comment else ">", less + 2)
            at = end if close < 0 else close + (3 if comment else 1)
            continue
        match = TAG.match(source, less)
        if match is None:
            stack[-1].children.append("<")
            at = less + 1
            continue
        at = match.end()
        tag = match[1].lower()
        if source[less + 1] == "/":
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if depth:
                del stack[depth:]
            elif tag == "br":
                stack[-1].children.append(Element("br"))
            continue
        if tag in ("html", "body") and any(e.tag == tag for e in stack):
            continue
        if tag in CLOSES_P:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag in ("p", *WALLS)), 0)
            if depth and stack[depth].tag == "p":
                del stack[depth:]
        if tag in SAME_CLOSES:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in SAME_CLOSES[tag]:
                    del stack[i:]
                    break
                if stack[i].tag in WALLS:
                    break
        element = Element(tag, *naming(match[2]))
        stack[-1].children.append(element)
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(source, at)
            at = end if close is None else close.start()
            if close is not None:
                at = source.find(">", close.start()) + 1 or end
        elif tag not in VOID and not match[2].rstrip().endswith("/") or tag in BLOCK - VOID:
            stack.append(element)
    return root


def naming(attributes: str) -> tuple[tuple[str, ...], str]:
    """The names in class and id, without numbers, and the role of an element."""
    if not NAMING.search(attributes):
        return (), ""
    words: set[str] = set()
    role = ""
    for name, *values in ATTRIBUTE.findall(attributes):
        value = entities.unescape("".join(values)).lower()
        if name.lower() in ("class", "id"):
            words.update(re.sub(r"\d+", "", value).split())
        elif name.lower() == "role":
            role = value.strip()
    return tuple(sorted(words)), role


def give_keys(root: Element, host: str) -> list[Element]:
    """Name every element by its host and its chain of tags and classes; all elements in page order."""
    found, todo = [], [(root, xxhash.xxh3_64_intdigest(host))]
    while todo:
        element, above = todo.pop()
        style = f"{above}>{element.tag}.{'.'.join(element.names)}"
        element.key = xxhash.xxh3_64_intdigest(style) - 2**63
        found.append(element)
        todo += [(c, element.key) for c in reversed(element.children) if isinstance(c, Element)]
    return found


def is_noise(element: Element, in_article: bool) -> bool:
    """Whether an element's tag, role or class names it as something other than main text."""
    if element.tag in ("article", "main", "body", "html"):
        return element.tag == "article" and any("comment" in name for name in element.names)
    if element.tag == "header":
        return not in_article
    return element.tag in NOISE_TAGS or element.role in NOISE_ROLES or any(map(is_noise_name, element.names))


def is_noise_name(name: str) -> bool:
    words = set(re.findall(r"[^\W\d_]+", name))
    noise = words & NOISE_WORDS
    if words & OWN_HEADER:
        noise -= {"header"}
    return bool(noise) and not words & ABOUT


def outermost(root: Element, wanted: str) -> list[Element]:
    """The outermost article or main elements that no noise encloses."""
    found, todo = [], [root]
    while todo:
        element = todo.pop()
        if element.tag == wanted and not is_noise(element, False) or wanted == "main" and element.role == "main":
            found.append(element)
        else:
            todo += [c for c in reversed(element.children) if isinstance(c, Element) and not is_noise(c, False)]
    return found


def n_words(top: Element, removed: set[int]) -> int:
    return sum(len(line.split()) for line in blocks(top, removed))


def articles(root: Element, removed: frozenset[int] | set[int] = frozenset()) -> list[Element]:
    """The elements to read: main elements, article elements or the page.

    A main element that has text outside its articles is read whole. Articles with fewer words than the rest of
    the page, without what is `removed`, are teasers beside the main text: then the whole page is read.
    """
    found, mains = outermost(root, "article"), outermost(root, "main")
    if not found:
        return mains or [root]
    own = {id(e) for e in found}
    if mains:
        if any(n_words(main, own) for main in mains):
            return mains
        return found
    if n_words(root, own | removed) > sum(n_words(e, set()) for e in found):
        return [root]
    return found


def low_branches(elements: list[Element], low: frozenset[int]) -> set[int]:
    """Identities of elements all of whose nodes are low; `elements` are in page order."""
    whole: set[int] = set()
    for element in reversed(elements):
        inner = (c for c in element.children if isinstance(c, Element))
        if element.key in low and all(id(c) in whole for c in inner):
            whole.add(id(element))
    return whole


def blocks(top: Element, removed: set[int]) -> list[str]:
    """The texts of the blocks below an element, in page order; white space is one space."""
    out: list[str] = []
    pending: list[str] = []
    inside = top.tag in ("article", "main")

    def flush() -> None:
        text = " ".join("".join(pending).split())
        if text:
            out.append(text)
        pending.clear()

    todo: list[Element | str | None] = [top]
    while todo:
        item = todo.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            pending.append(item)
        elif item.tag == "br":
            pending.append(" ")
        elif item is top or not (id(item) in removed or is_noise(item, inside)):
            if item.tag in BLOCK:
                flush()
                todo.append(None)
            todo += reversed(item.children)
        elif item.tag in BLOCK:
            flush()
    flush()
    return out


def main_text(source: str | None, host: str, low: frozenset[int] = frozenset()) -> str:
    """The main text of one page. Inside an article or main element nothing is removed as low.

    If the low branches were all of a page, nothing is removed either.
    """
    root = parse(source or "")
    removed = low_branches(give_keys(root, host), low) if low else set()
    for gone in (removed, set()):
        tops = [top for top in articles(root, gone) if id(top) not in gone]
        found = [line for top in tops for line in blocks(top, gone if top is root else set())]
        if found or not gone:
            return "\n".join(found)
    return ""


def host_of(url: Column) -> Column:
    """The host of a url in lower case; empty where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1))


def own_text(element: Element) -> str:
    return " ".join("".join(c for c in element.children if isinstance(c, str)).split())


def style_rows(pages: DataFrame) -> DataFrame:
    """host, key, kind, value: what each page shows of each style node, once per distinct main text of a host.

    kind 0 is the node's presence, 1 its presentation, 2 one of its texts. Of copies one page is kept.
    """

    style = pa.struct([("key", pa.int64()), ("kind", pa.int32()), ("value", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            hosts, contents, styles = [], [], []
            columns = (batch.column(c).to_pylist() for c in ("host", "html"))
            for host, source in zip(*columns, strict=True):
                seen = set()
                root = parse(source or "")
                text = "\n".join(line for top in articles(root) for line in blocks(top, set()))
                contents.append(xxhash.xxh3_64_intdigest(text) - 2**63)
                for element in give_keys(root, host):
                    tags = " ".join(dict.fromkeys(c.tag for c in element.children if isinstance(c, Element)))
                    text = own_text(element)
                    seen.add((element.key, 0, 0))
                    seen.add((element.key, 1, xxhash.xxh3_64_intdigest(tags) - 2**63))
                    if text:
                        seen.add((element.key, 2, xxhash.xxh3_64_intdigest(text) - 2**63))
                hosts.append(host)
                styles.append([{"key": k, "kind": kind, "value": v} for k, kind, v in sorted(seen)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(contents, pa.int64()), pa.array(styles, pa.list_(style))],
                ["host", "content", "styles"],
            )

    narrow = pages.select(host_of(F.col("url")).alias("host"), F.col("html").cast("string"))
    shown = narrow.mapInArrow(
        run, "host string, content bigint, styles array<struct<key: bigint, kind: int, value: bigint>>"
    )
    once = shown.groupBy("host", "content").agg(F.min("styles").alias("styles"))
    return once.select("host", F.inline("styles"))


def importance(pages: DataFrame) -> DataFrame:
    """The site style trees: host, key, n_pages, presentation and content importance of every node.

    With m pages, presentation is the entropy of the presentations to the base m; content is one less the
    mean of log_m(c) over the texts, c being the pages a text occurs in: 1 if every page has its own, 0
    if all share it. Counts are added up before they move, so a host with a third of all pages is no
    larger than its distinct texts.
    """
    counts = style_rows(pages).groupBy("host", "key", "kind", "value").agg(F.count(F.lit(1)).alias("c"))
    of = lambda kind, x: F.sum(F.when(F.col("kind") == kind, x))
    c = F.col("c").cast("double")
    m = F.log(F.col("n_pages").cast("double"))
    return counts.groupBy("host", "key").agg(
        F.max(F.when(F.col("kind") == 0, F.col("c"))).alias("n_pages"),
        of(1, c).alias("s1"), of(1, c * F.log(c)).alias("l1"), of(2, c).alias("s2"), of(2, c * F.log(c)).alias("l2"),
    ).select(
        "host", "key", "n_pages", F.when(m > 0, (F.log("s1") - F.col("l1") / F.col("s1")) / m).alias("presentation"),
        F.when(m > 0, 1 - F.col("l2") / F.col("s2") / m).alias("content"),
    )


def low_nodes(pages: DataFrame, config: StyleConfig = DEFAULT) -> DataFrame:
    """host and `low`, the keys of its nodes of low importance; hosts without any are absent."""
    low = (
        (F.col("n_pages") >= config.least_pages) & (F.col("presentation") < config.importance)
        & (F.coalesce("content", F.lit(0.0)) < config.importance)
    )
    return importance(pages).where(low).groupBy("host").agg(F.collect_set("key").alias("low"))


def extract(pages: DataFrame, config: StyleConfig = DEFAULT) -> DataFrame:
    """page_id, url and main text of every page.

    NULL or empty html gives an empty text; a NULL or malformed url counts as the empty host. Repeated
    rows and further columns are no special case; an empty table gives an empty result.
    """
    low = materialize(low_nodes(pages, config), "low-nodes")
    rows = pages.select(
        F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string"),
        host_of(F.col("url")).alias("host"),
    ).join(low, "host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            columns = (batch.column(c).to_pylist() for c in ("html", "host", "low"))
            texts = [main_text(h, host, frozenset(k or ())) for h, host, k in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"]
            )

    return rows.mapInArrow(run, "page_id bigint, url string, text string")
