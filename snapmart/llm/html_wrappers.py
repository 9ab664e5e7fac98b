"""Main text of pages through wrappers inferred from the pages of each host.

A wrapper is a union-free regular expression over block tags: fixed tags, optional groups,
repeated groups, and text slots. It starts as the token stream of one page, with neighbouring
equal groups folded into repeated ones, and is aligned with the stream of each further page of
the host: a text mismatch makes a slot of a constant, and a tag that only some pages have makes
an optional group. Streams are kept balanced, as trees; blocks are told apart by tag, names and
by what they hold (links, bare text, or blocks), so equal tags with equal names still differ.

The wrapper of a host says where its main text lies: from the top down, the way leads into the
block whose slots hold most of the text that changes from page to page, until no block does.
Text in links and text that is the same on unlike pages weighs nothing, bare text little. Tags
and names such as `nav`, `article` or `class=ad` only weigh a block down or up; alone they
neither choose nor drop the block of the main text. Every page of the host is then read along
this way. A page that does not fit is read by a wrapper of its own, inferred from it alone.

Inside the main block everything is text, but for blocks named as menus, adverts, forms, notices
or comments that hold less than half of it, and for articles within the article, which are replies.
A headline right before a block without one, not the same on unlike pages, belongs to it.

Each task folds its pages into one wrapper a host, which is pruned of its rarest optional groups
beyond `NODES` blocks, so a host of any number of unlike pages stays bounded. The wrappers of a
host are merged in steps; what leaves the last step is the way to the main text alone, some
hundred bytes a host. These ways are broadcast while they are small. Beyond that only those of
hosts with many pages are, and the pages of all other hosts are joined with theirs.

Defined cases: a null page counts as empty and has no text; a null or odd URL belongs to the
host named ''; unclosed, stray and cut-off tags are tolerated; pages with blocks beyond `DEPTH`
levels are read by wrappers of their own, at any depth; repeated pages are independent rows and
count as one for what is the same; extra columns, also of names used here, are not read; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.llm.common import table, written
from snapmart.llm.url_filter import split_url

# Kinds of tags, and the words that name sections around a main text.
BLOCK_TAGS = set(
    """html body head title article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td
    th caption blockquote pre figure figcaption nav header footer aside form fieldset address details summary menu dialog
    hr center button select option textarea label legend iframe object noscript template canvas svg""".split()
)
#: Never text of a page.
OUT_TAGS = set(
    "head title button select option textarea label legend iframe object noscript template canvas svg".split()
)
#: Tags that are seldom main text.
ASIDE_TAGS = set("nav header footer aside form fieldset menu dialog".split())
#: Tags of a text's own structure: what lies around them is the block that holds the text.
TEXT_TAGS = set(
    """p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre figure figcaption
    address details summary""".split()
)
HEADINGS = {"h1", "h2", "h3"}
ASIDE_WORDS = set(
    """ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation
    menu menubar breadcrumb breadcrumbs pagination pager masthead topbar footer sidebar widget related recommended share
    sharing social follow comment comments commentlist respond reply replies disqus notice notices cookie cookies consent
    gdpr popup modal overlay newsletter subscribe subscription signup login toolbar""".split()
)
REPLY_WORDS = set("comment comments commentlist respond reply replies disqus".split())
IN_TAGS = {"article", "main"}
#: Tags around everything: their names differ by page and say nothing.
WHOLE_TAGS = {"page", "html", "body"}
CLOSED_BY_BLOCK = {"p"}
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}

#: Levels of a wrapper, and blocks beyond which its rarest optional groups go.
DEPTH, NODES = 60, 2_000
#: Hosts whose wrappers a task holds before it passes them on.
HOSTS_AT_ONCE = 2_000
#: Unlike pages with the same text in a slot, from which on it says nothing about where the main text lies.
SAME_PAGES = 2
#: Weight of aside tags, of aside names, and of text outside text tags; words that a heading stands for; gain of article and main.
ASIDE_WEIGHT, NAME_WEIGHT, BARE_WEIGHT, HEADING_WORDS, IN_GAIN = 0.1, 0.3, 0.2, 10, 2
#: Share of the weight that leads into a block; share of links that makes a block a menu.
LEAD_SHARE, LINK_SHARE = 0.75, 0.6
#: In a main block without text of its own: share of the heaviest block's weight that a block needs.
PART_SHARE = 0.15
#: Bytes of ways up to which all are broadcast, and pages of a host from which on its way is in any case.
BROADCAST_BYTES, HOT_PAGES = 32 << 20, 100_000

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(script|style)\b[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>"']|"[^"<]*"|'[^'<]*')*)>"""
    r"""|</?[a-zA-Z!?][^<>]*(?:>|\Z)|<![^>]*>|[^<]+|<""",
    re.S | re.I,
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
_PART = re.compile(r"[a-z]+")

#: What the names of a block say.
NOTHING, ASIDE, REPLY = range(3)


class Node:
    """A block of a page or wrapper; a leaf is a run of text with signature '#'."""

    __slots__ = ("sig", "tag", "name", "kids", "many", "maybe", "pages", "value", "words", "links", "runs", "seen", "text", "out", "up", "mass")

    def __init__(self, sig: str, tag: str, name: int = NOTHING):
        self.sig, self.tag, self.name = sig, tag, name
        self.kids: list[Node] = []
        self.many = self.maybe = self.out = False
        self.pages, self.value, self.words, self.links, self.runs = 1, None, 0, 0, 0
        #: Marks of up to SAME_PAGES unlike pages that hold this unchanged text.
        self.seen: list[int] = []
        self.text, self.mass = "", 0.0
        self.up: Node | None = None


def _start(tag: str, attributes: str) -> Node:
    """Block with the words of its class, id and role as signature, and what they name."""
    node = Node(tag, tag)
    node.out = tag in OUT_TAGS
    if attributes and tag not in WHOLE_TAGS:
        tokens = {t for m in _NAMES.finditer(attributes) for t in "".join(filter(None, m.groups())).lower().split()}
        words = sorted({w for t in tokens for w in _PART.findall(t)})
        # A token of such words only, like nav-menu, is a name as well; has-sidebar is none.
        named = [w for t in tokens if (w := _PART.findall(t)) and ASIDE_WORDS.issuperset(w)]
        if named:
            node.name = ASIDE if all(REPLY_WORDS.isdisjoint(w) for w in named) else REPLY
        node.out = node.out or bool(_HIDDEN.search(_NAMES.sub("", attributes)))
        node.sig = f"{tag}.{'.'.join(words)}" if words else tag
    return node


def parse(page: str) -> Node:
    """Balanced tree of a page's blocks, with its depth as value; inline tags belong to the text around them."""
    root = Node("page", "page")
    order = [root]
    stack, tags = [root], ["page"]
    open_at: dict[str, list[int]] = {}
    run: list[str] = []
    in_link = linked = deepest = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(entities.unescape("".join(run)).split())
        run.clear()
        if text:
            leaf = Node("#", "#")
            leaf.text, leaf.value = text, zlib.crc32(text.encode("utf-8", "replace"))
            leaf.words = text.count(" ") + 1
            leaf.links, leaf.runs = min(linked, leaf.words), 1
            leaf.up = stack[-1]
            leaf.up.kids.append(leaf)
            order.append(leaf)
        linked = 0

    def close(at: int) -> None:
        while len(stack) > at:
            stack.pop()
            open_at[tags.pop()].pop()

    for m in _TOKEN.finditer(page):
        tag = m.group(3)
        if tag is None:
            whole = m.group()
            if whole[0] != "<" or whole == "<":
                run.append(whole)
                if in_link:
                    linked += len(whole.split())
            continue
        tag = tag.lower()
        if tag not in BLOCK_TAGS:
            if tag == "br":
                run.append(" ")
            elif tag == "a":
                in_link = 0 if m.group(2) else 1
            continue
        flush()
        if m.group(2):
            if open_at.get(tag):
                close(open_at[tag][-1])
            continue
        if tags[-1] in CLOSED_BY_BLOCK:
            close(len(stack) - 1)
        closed = CLOSED_BY.get(tag)
        while closed and tags[-1] in closed:
            close(len(stack) - 1)
        if tag == "hr" or m.group(4).endswith("/"):
            continue
        node = _start(tag, m.group(4))
        node.up = stack[-1]
        node.up.kids.append(node)
        order.append(node)
        open_at.setdefault(tag, []).append(len(stack))
        stack.append(node)
        tags.append(tag)
        deepest = max(deepest, len(stack))
    flush()
    root.value = deepest
    _count(order)
    return root


def _count(order: list[Node]) -> None:
    """Words and links of blocks, and the signature's last part: what a block holds."""
    for node in order[1:]:
        node.out = node.out or node.up.out
    for node in reversed(order):
        if node.tag not in TEXT_TAGS and node.tag not in WHOLE_TAGS and node.tag != "#":
            if not node.words:
                kind = "empty"
            elif node.links >= LINK_SHARE * node.words:
                kind = "links"
            else:
                kind = "text" if all(k.tag == "#" for k in node.kids) else "blocks"
            node.sig += f"~{kind}"
        if node.up is not None and not node.out:
            node.up.words += node.words
            node.up.links += node.links


def ordered(root: Node) -> list[Node]:
    """All nodes in document order."""
    out, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        out.append(node)
        waiting.extend(reversed(node.kids))
    return out


# Wrappers


def merge(a: Node, b: Node, same_page: bool = False) -> Node:
    """`a` aligned with `b` of the same signature: what both match, and what only some have."""
    if a.sig == "#":
        a.value = a.value if a.value == b.value else None
        a.seen = [] if a.value is None else sorted({*a.seen, *b.seen})[:SAME_PAGES]
        a.words, a.links, a.runs = a.words + b.words, a.links + b.links, a.runs + b.runs
    a.many, a.maybe = a.many or b.many, a.maybe or b.maybe
    a.kids = _align(a.kids, b.kids, same_page)
    if not same_page:
        a.pages += b.pages
    return a


def _common(left: list[str], right: list[str]) -> list[tuple[int, int]]:
    """Pairs of places of a longest common subsequence; of a common one for very long streams."""
    if len(left) * len(right) > 10_000:
        places: dict[str, list[int]] = {}
        for k, sig in enumerate(right):
            places.setdefault(sig, []).append(k)
        out, now = [], 0
        for i, sig in enumerate(left):
            held = places.get(sig, [])
            k = bisect_left(held, now)
            if k < len(held):
                out.append((i, held[k]))
                now = held[k] + 1
        return out
    best = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
    for i in range(len(left) - 1, -1, -1):
        for j in range(len(right) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if left[i] == right[j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(left) and j < len(right):
        if left[i] == right[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def _align(left: list[Node], right: list[Node], same_page: bool) -> list[Node]:
    one, two = [k.sig for k in left], [k.sig for k in right]
    if one == two:
        return fold([merge(a, b, same_page) for a, b in zip(left, right)])
    out: list[Node] = []
    i = j = 0
    for at, to in [*_common(one, two), (len(left), len(right))]:
        for kid in left[i:at] + right[j:to]:
            kid.maybe = True
            out.append(kid)
        if at < len(left):
            out.append(merge(left[at], right[to], same_page))
        i, j = at + 1, to + 1
    return fold(out)


def fold(kids: list[Node]) -> list[Node]:
    """Neighbouring equal groups of one to three blocks become one repeated group."""
    for period in (1, 2, 3):
        out: list[Node] = []
        i = 0
        while i < len(kids):
            group = kids[i : i + period]
            sigs = [k.sig for k in group]
            j = i + period
            while len(group) == period and [k.sig for k in kids[j : j + period]] == sigs:
                for mine, other in zip(group, kids[j : j + period]):
                    merge(mine, other, True)
                j += period
            if j == i + period:
                out.append(kids[i])
                i += 1
                continue
            if period == 1:
                group[0].many = True
                out.append(group[0])
            else:
                node = Node("(" + " ".join(sigs) + ")", "(")
                node.kids, node.many = group, True
                out.append(node)
            i = j
        kids = out
    return kids


def wrapper_of(page: Node) -> Node:
    """The wrapper of a single page: its blocks down to `DEPTH` levels, with repeated groups folded."""
    texts = hashlib.blake2b(digest_size=8)
    for node in ordered(page):
        if node.tag == "#" and not node.out:
            texts.update(node.text.encode("utf-8", "replace") + b"\0")
    mark = [int.from_bytes(texts.digest(), "big")]

    def copy(node: Node, depth: int) -> Node:
        own = Node(node.sig, node.tag, node.name)
        if node.tag == "#":
            own.value, own.words, own.links, own.runs, own.seen = node.value, node.words, node.links, node.runs, mark
        elif depth < DEPTH:
            own.kids = fold([copy(k, depth + 1) for k in node.kids if not k.out])
        return own

    return pruned(copy(page, 0))


def pruned(wrapper: Node) -> Node:
    """The wrapper without its rarest optional groups, or its deepest levels, if it has too many blocks."""
    nodes = ordered(wrapper)
    rare, depth = 1, DEPTH
    while len(nodes) > NODES:
        if any(k.maybe for n in nodes for k in n.kids):
            for node in nodes:
                node.kids = [k for k in node.kids if not (k.maybe and k.pages <= rare)]
            rare *= 2
        else:
            depth = depth // 2
            _cut(wrapper, depth)
        nodes = ordered(wrapper)
        if not depth:
            break
    return wrapper


def _cut(node: Node, depth: int) -> None:
    if not depth:
        node.kids = node.kids[:NODES]
        for kid in node.kids:
            kid.kids = []
        return
    for kid in node.kids:
        _cut(kid, depth - 1)


def dump(node: Node) -> list:
    return [
        node.sig, node.tag, node.name, int(node.many), int(node.maybe), node.pages, node.value, node.words, node.links, node.runs,
        node.seen, [dump(k) for k in node.kids],
    ]


def load(raw: list) -> Node:
    node = Node(raw[0], raw[1], raw[2])
    node.many, node.maybe, node.pages = bool(raw[3]), bool(raw[4]), raw[5]
    node.value, node.words, node.links, node.runs, node.seen = raw[6:11]
    node.kids = [load(k) for k in raw[11]]
    return node


# The way to the main text


def _same(leaf: Node) -> bool:
    """Whether a text slot holds one text on unlike pages."""
    return leaf.value is not None and len(leaf.seen) >= SAME_PAGES


def weigh(root: Node) -> None:
    """Mass of every block: the words that speak for main text at or below it."""
    order = ordered(root)
    for plain in (False, True):
        for node in order:
            node.mass = 0.0
        hints = {id(root): 1.0}
        holder = {id(root): root}
        for node in order:
            hint = hints[id(node)]
            for kid in node.kids:
                own = ASIDE_WEIGHT if kid.tag in ASIDE_TAGS else NAME_WEIGHT if kid.name and kid.tag not in TEXT_TAGS else 1.0
                hints[id(kid)] = min(hint, own)
                holder[id(kid)] = node
            if node.tag == "#" and not node.out and (plain or not _same(node)):
                around = holder[id(node)].tag
                words = node.words if plain else node.words - node.links
                node.mass = words * (1.0 if around in TEXT_TAGS else BARE_WEIGHT) * hint
                if around in HEADINGS and words:
                    node.mass += HEADING_WORDS * node.runs * hint
        for node in reversed(order):
            if node is not root:
                holder[id(node)].mass += node.mass
        if root.mass:
            return


def value(node: Node) -> float:
    return node.mass * (IN_GAIN if node.tag in IN_TAGS else 1)


def members(node: Node) -> list[Node]:
    """Blocks of a node; those of repeated groups one by one."""
    if not any(k.tag == "(" for k in node.kids):
        return node.kids
    return [m for k in node.kids for m in (members(k) if k.tag == "(" else [k])]


def _is_part(node: Node) -> bool:
    """A piece of its block's own text."""
    return node.tag == "#" or node.tag in TEXT_TAGS


def _heading_only(node: Node) -> bool:
    if node.tag in HEADINGS:
        return True
    return node.tag in ("header", "div") and bool(node.kids) and all(k.tag in HEADINGS for k in members(node))


def way(wrapper: Node) -> list:
    """Levels from the top to the main block: [signatures of a block's parts, places that the way takes].

    The last one lists the main block's parts and the places that do not belong to it; places of
    headlines that are the same on unlike pages are listed with the level that they are on.
    """
    weigh(wrapper)
    levels, node = [], wrapper
    while True:
        parts = members(node)
        blocks = [k for k in parts if not _is_part(k) and not k.out]
        total = sum(map(value, parts))
        best = max(blocks, key=value, default=None)
        if best is None or not total or value(best) < LEAD_SHARE * total:
            # Like-named blocks are parts of one text.
            like = [k for k in parts if best is not None and k.sig == best.sig and "." in k.sig]
            if not like or sum(map(value, like)) < LEAD_SHARE * total or len(like) < 2:
                break
        sigs = [k.sig for k in parts]
        taken = [i for i, k in enumerate(parts) if k is best or (k.sig == best.sig and "." in k.sig)]
        same = [i for i, k in enumerate(parts) if _heading_only(k) and all(_same(x) for x in ordered(k) if x.tag == "#")]
        levels.append([sigs, taken, same])
        node = best
    own = sum(value(k) for k in parts if _is_part(k))
    heaviest = max(map(value, blocks), default=0.0)
    outside = []
    if own < (1 - LEAD_SHARE) * total:
        outside = [i for i, k in enumerate(parts) if not _is_part(k) and value(k) < PART_SHARE * heaviest]
    levels.append([[k.sig for k in parts], outside, []])
    return levels


def _places(node: Node, sigs: list[str]) -> list[tuple[Node, int | None]]:
    """Blocks of a page with their places in the wrapper."""
    places: dict[str, list[int]] = {}
    for at, sig in enumerate(sigs):
        places.setdefault(sig, []).append(at)
    out, now = [], 0
    for kid in node.kids:
        held = places.get(kid.sig)
        if held is None:
            out.append((kid, None))
            continue
        k = bisect_left(held, now)
        at = held[k] if k < len(held) else held[-1]
        now = max(now, at)
        out.append((kid, at))
    return out


def read(page: Node, levels: list) -> str | None:
    """Main text of a page along a way; none if the page does not fit."""
    found, headlines = [page], []
    for sigs, taken, same in levels[:-1]:
        now = []
        for node in found:
            before: list[Node] = []
            for kid, at in _places(node, sigs):
                if at in taken and not kid.out:
                    if not now:
                        headlines = before
                    now.append(kid)
                elif not kid.out and _heading_only(kid):
                    before = before if at in same else [*before, kid]
                else:
                    before = []
        if not now:
            return None
        found = now
    sigs, outside, _ = levels[-1]
    if found[0].tag == "article" and len(found) > 1:
        # One story and shorter articles beside it, or several of like length.
        sizes = sorted((n.words for n in found), reverse=True)
        if sizes[0] >= 2 * sizes[1]:
            found = [n for n in found if n.words == sizes[0]][:1]
    if any(x.tag == "h1" for n in found for x in ordered(n)):
        headlines = []
    texts = [x.text for h in headlines for x in ordered(h) if x.tag == "#"]
    for node in found:
        left_out = {id(k) for k, at in _places(node, sigs) if at in outside}
        texts += _texts(node, left_out)
    return "\n\n".join(texts)


def _texts(main: Node, left_out: set[int]) -> list[str]:
    """Texts of the main block, without asides, and without articles in it that are replies."""
    nested, waiting = [], list(main.kids)
    while waiting:
        node = waiting.pop()
        if node.tag == "article" and not node.out:
            nested.append(node)
        else:
            waiting.extend(node.kids)
    if nested and main.words - sum(n.words for n in nested) >= max(n.words for n in nested) / 2:
        left_out |= {id(n) for n in nested}
    out, waiting = [], [main]
    while waiting:
        node = waiting.pop()
        if node.out or id(node) in left_out:
            continue
        if node is not main and node.tag not in TEXT_TAGS and 2 * node.words < main.words:
            if node.tag in ASIDE_TAGS and node.tag != "header":
                continue
            if node.name == REPLY or (node.name == ASIDE and node.tag not in ("section", "article", "header")):
                continue
        if node.tag == "#":
            out.append(node.text)
        waiting.extend(reversed(node.kids))
    return out


def main_text(page: str, levels: list | None) -> str:
    """Main text of a page along its host's way, or along its own."""
    parsed = parse(page)
    text = read(parsed, levels) if levels and parsed.value <= DEPTH else None
    if text is None:
        text = read(parsed, way(parsed))
    return text or ""


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """(host, pages, way) of every host of `pages` (host, html)."""

    def fold_pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, Node] = {}
        for batch in batches:
            for host, page in zip(batch["host"], batch["html"]):
                one = wrapper_of(parse(page or ""))
                held[host] = pruned(merge(held[host], one)) if host in held else one
                if len(held) >= HOSTS_AT_ONCE:
                    yield _frame(held)
                    held = {}
        yield _frame(held)

    def together(group: pd.DataFrame) -> Node:
        wrappers = [load(json.loads(w)) for w in group["wrapper"].sort_values()]
        first = wrappers[0]
        for other in wrappers[1:]:
            first = pruned(merge(first, other))
        return first

    def merge_host(group: pd.DataFrame) -> pd.DataFrame:
        return _frame({group["host"].iloc[0]: together(group)})

    def settle(group: pd.DataFrame) -> pd.DataFrame:
        whole = together(group)
        return pd.DataFrame({"host": [group["host"].iloc[0]], "pages": [whole.pages], "way": [json.dumps(way(whole))]})

    kind = "host string, wrapper string"
    parts = pages.select("host", "html").mapInPandas(fold_pages, kind)
    # A host that many tasks hold is merged in steps, some of its wrappers in a group at a time.
    for salts in (1024, 32):
        parts = parts.groupBy("host", F.pmod(F.xxhash64("wrapper"), F.lit(salts)).alias("salt")).applyInPandas(merge_host, kind)
    return parts.groupBy("host").applyInPandas(settle, "host string, pages long, way string")


def _frame(held: dict[str, Node]) -> pd.DataFrame:
    return pd.DataFrame(
        {"host": list(held), "wrapper": [json.dumps(dump(n), separators=(",", ":")) for n in held.values()]}, dtype=object
    )


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text) of every page."""
    url = F.col(url_col).cast("string")
    narrow = pages.select(
        F.col(id_col).alias("page_id"), url.alias("url"), split_url(url)[0].alias("host"), F.col(html_col).cast("string").alias("html")
    )
    return read_pages(narrow, written(infer_wrappers(narrow), "wrappers"))


def read_pages(narrow: DataFrame, ways: DataFrame, broadcast_bytes: int = BROADCAST_BYTES, hot_pages: int = HOT_PAGES) -> DataFrame:
    """(page_id, url, text) of pages (page_id, url, host, html), each read along the way of its host."""
    size = ways.agg(F.sum(F.octet_length("host") + F.octet_length("way")).alias("size")).first().size or 0

    @F.pandas_udf("string")
    def text(html: pd.Series, way: pd.Series) -> pd.Series:
        loaded: dict[str, list] = {}
        out = []
        for page, raw in zip(html, way):
            if raw is not None and raw not in loaded:
                if len(loaded) >= HOSTS_AT_ONCE:
                    loaded.clear()
                loaded[raw] = json.loads(raw)
            out.append(main_text(page or "", loaded.get(raw)))
        return pd.Series(out, dtype=object)

    if size <= broadcast_bytes:
        joined = narrow.join(F.broadcast(ways.select("host", "way")), "host", "left")
    else:
        # Hosts with many pages are few: no more than pages divided by `hot_pages`.
        hot, rest = ways.where(F.col("pages") >= hot_pages), ways.where(F.col("pages") < hot_pages)
        first = narrow.join(F.broadcast(hot.select("host", F.col("way").alias("hot_way"))), "host", "left").select(
            "*", F.lit(None).cast("string").alias("way")
        )
        others = first.where("hot_way IS NULL").drop("way", "hot_way").join(rest.select("host", "way"), "host", "left")
        joined = first.where("hot_way IS NOT NULL").withColumn("way", F.col("hot_way")).drop("hot_way").unionByName(others)
    return joined.select("page_id", "url", text("html", "way").alias("text"))


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
