"""Main text of web pages by deducing each host's template from equivalence classes of tokens."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved

# Elements that break a block (all others, unknown ones too, stand within a line), that hold no
# content of the page, the same within a line, and that never have an end tag.
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()
)
BLOCK = ENDS_PARAGRAPH | frozenset(
    "html head body title p li dt dd tr td th thead tbody tfoot caption colgroup figcaption summary legend hgroup search center dir menu dialog br".split()
)
EXCLUDED = frozenset("head title script style noscript template nav footer aside form textarea iframe dialog menu header".split())
EXCLUDED_INLINE = frozenset("button select object svg canvas datalist".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTENT = frozenset(("article", "main"))
SIBLINGS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
}
# Elements that hold a part of a text: one alone is no slot.
PARTS = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl li dt dd pre blockquote figure figcaption table".split())
# Elements that no name excludes.
FRAME = frozenset("html body main article h1 h2 h3 h4 h5 h6".split())
# Classes, ids and roles that name what is no main text, alone, with each other or with words of place and shape.
NAMED = frozenset(
    "ad ads advert adverts advertisement banner promo sponsor sponsored cookie cookies consent gdpr notice notices popup modal overlay newsletter "
    "subscribe sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header masthead comment comments reply respond disqus share sharing "
    "social related recommended widget complementary contentinfo search".split()
)
PLACES = frozenset(
    "site page main global top bottom left right primary secondary list box bar block container wrapper wrap inner outer area section item items unit slot link links "
    "button buttons form text message post posts article articles".split()
)

# The share of a host's pages that must agree for a token, an order or a text to count as its template's.
SUPPORT = 0.5
# With fewer pages equal texts are no evidence for a template.
FEWEST = 3

# Quotes matter after an equals sign only, so ``title=don't`` is a whole attribute.
_ATTRIBUTES = r"(?>(?:[^=<>]++|=(?>\s*\"[^\"]*\"|\s*'[^']*'|))*)"
MARKUP = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|noscript|template|textarea|iframe)(?![a-zA-Z0-9:-]){_ATTRIBUTES}>.*?(?:</(?P=raw)\s*>|\Z)"
    rf"|<[!?][^>]*>|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attributes>(?![a-zA-Z0-9:-]){_ATTRIBUTES})>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*)))?")
SPACES = re.compile(r"\s+")


def _names(value: str) -> bool:
    """Whether a whole class, id or role names what is no main text: ``site-footer`` does, ``no-sidebar`` or ``related-work`` does not."""
    words = [w for w in re.split(r"[^a-z]+", value) if w]
    return any(w in NAMED for w in words) and all(w in NAMED or w in PLACES for w in words)


def _named(attributes: str, tag: str, inside_content: bool) -> tuple[str, bool, bool]:
    """The class value, whether names say that this is no main text, and whether it is hidden.

    Ids inside an article are anchors of its sections and say nothing.
    """
    kind, named, hidden = "", False, False
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name in ("class", "role") or (name == "id" and not inside_content):
            named |= tag not in FRAME and any(map(_names, value.split()))
        if name == "class":
            kind = re.sub(r"[0-9]+", "0", value.strip()).replace("/", "_").replace(" ", "_")
        hidden |= name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and "display:none" in value.replace(" ", ""))
    return kind, named, hidden


class Element(NamedTuple):
    """An element of a page: its token, the place of its parent among the page's elements, its tag and whether it is left out."""

    token: int
    parent: int
    tag: str
    excluded: bool


ROOT = 0  # the token of the page itself, which stands once on every page


def hash64(text: str) -> int:
    return int.from_bytes(blake2b(text.encode(errors="replace"), digest_size=8).digest(), "big", signed=True)


def token_of(parent: int, tag: str, kind: str) -> int:
    """The token of an element: its path from the root with classes, as a 64-bit hash, so deep paths cost no more."""
    return hash64(f"{parent}/{tag}.{kind}")


def read_page(page: str) -> tuple[list[Element], list[tuple[int, str, bool]]]:
    """The page's elements in the order in which they open, and its text blocks as (element, text, excluded).

    Equal tags in different roles are different tokens, since a token is a path with
    classes. Comments, scripts and styles are no text; character references are decoded
    after the markup is gone; white space becomes one space. Tags within a line, images
    and unknown tags among them, break no block.
    """
    elements = [Element(ROOT, -1, "", False)]
    blocks: list[tuple[int, str, bool]] = []
    stack, text = [0], []
    tokens: dict[tuple[int, str, str], int] = {}
    muted, depth_muted, held = "", 0, False  # the element within a line left out, how many of its tag are open, until its end tag
    unclosed: set[str] = set()

    def flush() -> None:
        if text:
            plain = SPACES.sub(" ", html.unescape("".join(text))).strip()
            if plain:
                blocks.append((stack[-1], plain, elements[stack[-1]].excluded))
            text.clear()

    def close(until: int) -> None:
        flush()
        del stack[until:]

    def ends(tag: str, start: int) -> bool:
        """Whether an end tag follows; looked for in vain once per tag only."""
        if tag not in unclosed and not re.compile(f"</{tag}\\b", re.I).search(page, start):
            unclosed.add(tag)
        return tag not in unclosed

    at = 0
    inside = 0  # open article and main elements
    for mark in MARKUP.finditer(page):
        if mark.start() > at and not muted:
            text.append(page[at : mark.start()])
        at = mark.end()
        tag = (mark["tag"] or "").lower()
        if not tag:
            continue
        if muted and (held or tag not in BLOCK):
            depth_muted += (tag == muted and tag not in VOID) * (-1 if mark["end"] else 1)
            muted = muted if depth_muted else ""
            continue
        if tag not in BLOCK:
            if tag in VOID or mark["end"]:
                continue
            if tag in EXCLUDED_INLINE:
                muted, depth_muted, held = (tag, 1, True) if ends(tag, at) else ("", 0, False)
            elif mark["attributes"] and _named(mark["attributes"], tag, inside > 0)[1]:
                muted, depth_muted, held = tag, 1, False
            continue
        muted = ""
        if mark["end"]:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if elements[stack[i]].tag == tag), None)
            if depth is None:
                flush()
            else:
                inside -= sum(elements[e].tag in CONTENT for e in stack[depth:])
                close(depth)
            continue
        flush()
        if tag in VOID:
            continue
        if tag in ENDS_PARAGRAPH and elements[stack[-1]].tag == "p":
            close(len(stack) - 1)
        while tag in SIBLINGS and elements[stack[-1]].tag in SIBLINGS[tag]:
            close(len(stack) - 1)
        kind, named, hidden = _named(mark["attributes"], tag, inside > 0)
        parent = elements[stack[-1]]
        excluded = parent.excluded or named or hidden or (tag in EXCLUDED and not (tag == "header" and inside > 0))
        key = (parent.token, tag, kind)
        if key not in tokens:
            tokens[key] = token_of(*key)
        elements.append(Element(tokens[key], stack[-1], tag, excluded))
        stack.append(len(elements) - 1)
        inside += tag in CONTENT
    if at < len(page) and not muted:
        text.append(page[at:])
    flush()
    return elements, blocks


class Token(NamedTuple):
    """What a page, or a host, says of a token; sizes and excluded blocks include what is nested in it."""

    token: int
    parent: int
    tag: str
    size: int
    outs: int
    constant: bool = False


class Seen(NamedTuple):
    """A token on one page: how often it opens, where first, and a hash of the free text in it."""

    token: Token
    times: int
    first: int
    said: int


def page_summary(page: str) -> list[Seen]:
    elements, blocks = read_page(page)
    size, outs, said = ([0] * len(elements) for _ in range(3))
    for element, text, excluded in blocks:
        if excluded:
            outs[element] += 1
        else:
            size[element] += len(text)
            said[element] += hash64(text)
    times, first, total = Counter(), {}, {}
    for k in range(len(elements) - 1, -1, -1):  # children stand behind their parents
        token, parent, *_ = elements[k]
        if k:
            size[parent] += size[k]
            outs[parent] += outs[k]
            said[parent] += said[k]
        times[token] += 1
        first[token] = k
        sums = total.setdefault(token, [0, 0, 0])
        for place, value in enumerate((size[k], outs[k], said[k])):
            sums[place] += value
    found = []
    for token, k in first.items():
        parent = elements[elements[k].parent].token if k else ROOT
        hashed = (total[token][2] + 2**63) % 2**64 - 2**63
        found.append(Seen(Token(token, parent, elements[k].tag, *total[token][:2]), times[token], k, hashed))
    return found


class Template(NamedTuple):
    """The slot that holds the main text, and the elements in it whose text belongs to the template."""

    slot: int
    furniture: list[int]


def deduce(skeleton: list[Token]) -> Template | None:
    """The main slot of a template whose valid classes consist of ``skeleton``; None if they hold no free text.

    The classes nest by the paths of their tokens; what a token holds outside the tokens
    nested in it is its slot. The slot with the most free text that is not the same on
    the pages holds the main text (any text, where none differs), one in an article or
    main element before others. The answer rises to the outermost article or main
    around it, or else to the highest element below body that adds neither excluded
    elements nor text of the template.
    """
    known = {t.token: t for t in skeleton}
    nested: dict[int, list[int]] = {}
    for t in sorted(skeleton):
        if t.token != ROOT and t.parent in known:
            nested.setdefault(t.parent, []).append(t.token)
    top = sorted(t for t in known if t == ROOT or known[t].parent not in known)
    order, depth, content, same = list(top), {}, {}, {}
    for t in order:  # enclosing tokens come first
        own = known[t]
        above = own.parent if t not in top else None
        depth[t] = 0 if above is None else depth[above] + 1
        content[t] = (None if above is None else content[above]) or (t if own.tag in CONTENT else None)
        same[t] = own.constant or (above is not None and same[above])
        order.extend(nested.get(t, ()))
    free = {t: known[t].size - sum(known[u].size for u in nested.get(t, ())) for t in order}
    fixed = {t: int(known[t].constant and known[t].size > 0) for t in order}
    for t in reversed(order):
        fixed[t] += sum(fixed[u] for u in nested.get(t, ()))

    filled = [t for t in order if free[t] > 0]
    varying = [t for t in filled if not same[t]]
    candidates = varying or filled
    if not candidates:
        return None
    slot = min([t for t in candidates if content[t] is not None] or candidates, key=lambda t: (-free[t], depth[t], t))
    if content[slot] is not None:
        return Template(content[slot], [])
    while known[slot].tag in PARTS and depth[slot]:
        slot = known[slot].parent
    while depth[slot] and known[parent := known[slot].parent].tag not in ("", "html", "body"):
        if known[slot].tag in ("html", "body") or known[parent].outs > known[slot].outs or (varying and fixed[parent] > fixed[slot]):
            break
        slot = parent
    inside, furniture = [slot], []
    for t in inside:
        for u in nested.get(t, ()):
            (furniture if varying and known[u].constant and known[u].size else inside).append(u)
    return Template(slot, sorted(furniture))


def article(page: str, template: Template | None) -> str:
    """The blocks in the host's slot; a page without that element is its own template."""
    elements, blocks = read_page(page)
    if template is None or all(e.token != template.slot for e in elements):
        template = deduce([s.token for s in page_summary(page) if s.times == 1])
    if template is None:
        return ""
    furniture, inside, out = set(template.furniture), [], []
    for element in elements:
        below = element.parent >= 0
        inside.append(element.token == template.slot or (below and inside[element.parent]))
        out.append(element.excluded or element.token in furniture or (below and out[element.parent]))
    return "\n".join(text for element, text, _ in blocks if inside[element] and not out[element])


TOKENS = "host string, page long, token long, parent long, tag string, times long, first long, size long, outs long, said long"


def page_tokens(pages: DataFrame) -> DataFrame:
    """One row per page and token, see ``Seen``; sizes are the free text in it."""

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                columns: list[list] = [[] for _ in TOKENS.split(",")]
                for host, key, page in zip(*(c.to_pylist() for c in whole.slice(start, 256).columns)):
                    for (token, parent, tag, size, outs, _), times, first, said in page_summary(page):
                        for column, value in zip(columns, (host, key, token, parent, tag, times, first, size, outs, said)):
                            column.append(value)
                kinds = {"string": pa.string(), "long": pa.int64()}
                names = [field.split() for field in TOKENS.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, names)], [n for n, _ in names])

    return pages.select("host", "page", "html").mapInArrow(tokens, TOKENS)


def equivalence_classes(tokens: DataFrame) -> DataFrame:
    """Per host and token of large support: its occurrence vector's fingerprint, which with the page count names its class.

    The fingerprint is the sum over pages of a hash of (page, times); tokens of one host
    with equal fingerprints and page counts occur equally often on every page. It is a
    partial sum in every map task, so a host with a third of all pages is no large group.
    Tokens on fewer than ``SUPPORT`` of their host's pages are no template: the others
    number at most 1 / SUPPORT times a page's. A page that stands twice counts twice.
    """
    vector = F.sum(F.xxhash64("page", "times").cast("decimal(38,0)"))
    counted = tokens.groupBy("host", "token").agg(
        vector.alias("class"),
        F.count(F.lit(1)).alias("pages"),
        F.sum((F.col("times") == 1).cast("long")).alias("once"),
        F.first("parent").alias("parent"),
        F.first("tag").alias("tag"),
        F.sum("size").alias("size"),
        F.sum("outs").alias("outs"),
    )
    hosts = counted.where(F.col("token") == ROOT).select("host", F.col("pages").alias("all_pages"))
    return counted.join(hosts, "host").where(F.col("pages") >= F.col("all_pages") * SUPPORT)


def valid_classes(tokens: DataFrame, classes: DataFrame) -> DataFrame:
    """The tokens of valid classes that open once on most pages, with ``constant``: whether most pages say the same there.

    A class is valid if its tokens open in the same order on at least ``SUPPORT`` of the
    pages that hold it, so one odd page does not undo it. Elements nest, so paths nest
    the classes. Orders and texts are counted per distinct value first: neither a host
    nor a class is one group.
    """
    skeleton = classes.where(F.col("once") >= F.col("all_pages") * SUPPORT)
    here = tokens.select("host", "page", "token", "first", "said").join(skeleton.select("host", "token", "class", "pages", "all_pages"), ["host", "token"])
    order = F.xxhash64(F.transform(F.array_sort(F.collect_set(F.struct("first", "token"))), lambda t: t["token"]))
    orders = here.groupBy("host", "class", "pages", "page").agg(order.alias("order")).groupBy("host", "class", "pages", "order").count()
    ordered = orders.groupBy("host", "class", "pages").agg((F.max("count") >= F.sum("count") * SUPPORT).alias("ordered"))
    texts = here.groupBy("host", "token", "all_pages", "said").count().groupBy("host", "token", "all_pages")
    said = texts.agg(((F.max("count") >= F.col("all_pages") * SUPPORT) & (F.col("all_pages") >= FEWEST)).alias("constant"))
    valid = skeleton.join(ordered.where("ordered"), ["host", "class", "pages"], "left_semi")
    return valid.join(said.drop("all_pages"), ["host", "token"])


def host_templates(tokens: DataFrame) -> DataFrame:
    """(host, slot, furniture): the main slot of each host's template and the template's elements in it.

    Only the tokens of a host's valid classes come together, at most 1 / SUPPORT times
    those of a page, never its pages.
    """
    valid = valid_classes(tokens, saved(equivalence_classes(tokens), "classes"))

    def deduced(rows: pa.Table) -> pa.Table:
        table = rows.to_pydict()
        found = deduce([Token(*row) for row in zip(*(table[c] for c in Token._fields))])
        hosts, slots, furniture = (table["host"][:1], [found.slot], [found.furniture]) if found else ([], [], [])
        columns = [pa.array(hosts, pa.string()), pa.array(slots, pa.int64()), pa.array(furniture, pa.list_(pa.int64()))]
        return pa.Table.from_arrays(columns, ["host", "slot", "furniture"])

    return valid.select("host", *Token._fields).groupBy("host").applyInArrow(deduced, "host string, slot long, furniture array<long>")


def main_text(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """The main text of every page: ``id_column``, ``url_column`` and ``text``, one row per input row.

    Element paths are the tokens. Tokens of a host that share their occurrence vector
    form a class; classes of large support whose tokens keep their order are nested into
    the host's template, and the slot with the most text that differs between pages is
    extracted, without elements whose tag or names say menu, notice, advert, comment and
    the like, and, outside article and main elements, without elements whose text is the
    same on most pages. Pages that lack their host's slot are read by the same rule on
    their own. Null html counts as empty and gives empty text; null and malformed
    urls share the host ''. Each page is extracted in its own row, so ids may repeat or
    be null. Other columns are ignored.
    """
    host = F.regexp_extract(F.lower(F.coalesce(F.col(url_column), F.lit(""))), r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1)
    base = pages.select(
        F.col(id_column).alias("id"), F.col(url_column).alias("url"), host.alias("host"),
        F.xxhash64(id_column, url_column, html_column).alias("page"), F.coalesce(html_column, F.lit("")).alias("html"),
    )
    templates = saved(host_templates(saved(page_tokens(base), "tokens")), "templates")
    joined = base.join(templates, "host", "left")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                rows = zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)))
                texts = [article(page, None if slot is None else Template(slot, furniture)) for page, slot, furniture in rows]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["id", "url", "text"])

    kind = pages.schema[id_column].dataType.simpleString()
    out = joined.select("id", "url", "html", "slot", "furniture").mapInArrow(extract, f"id {kind}, url string, text string")
    return out.select(F.col("id").alias(id_column), F.col("url").alias(url_column), "text")
