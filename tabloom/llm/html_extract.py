"""Main text of web pages by templates that pages of one host share."""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache, reduce
from itertools import accumulate, chain, pairwise
from operator import gt, lt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from tabloom.functions.lineage import materialize
from tabloom.llm.common import join_groups, mix, small

#: Pages in which a token must occur to be considered for the template of a host.
LEAST_PAGES = 3
#: Share of the host's pages that a class of tokens must cover, hence at most 1 / share times the tokens
#: of a page make up a template, however many pages a host has.
LEAST_SHARE = 0.2
#: Share of the pages from which text that is the same everywhere counts as furniture of the site.
TEXT_SHARE = 0.5
#: Tokens of the smallest class that is taken into a template.
LEAST_CLASS = 2
#: Share of the text that an element around slots holds, if they are the article; less suffices for one
#: that is named an article.
SLOT_SHARE, NAMED_SHARE = 0.8, 0.5

# Elements without an end, elements that break a line of text, elements that never hold
# main text, elements that may hold all of it, and words in class or id of what is not the article.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre "
    "section summary table tbody td tfoot th thead tr ul".split()
)
NEVER = set(
    "audio button canvas datalist dialog embed footer form head iframe input label math menu meter nav noscript "
    "object option progress script select style svg template textarea title video aside".split()
)
CONTAINERS = set("article main section div td body html".split())
RAW = ("script", "style", "noscript", "textarea", "title", "template", "iframe", "xmp")
FURNITURE = re.compile(
    r"(?:^|[\s_-])(?<!with[_-])(?<!has[_-])(?<!no[_-])(?:ads?|adbox|adslot|adunit|adsense|adsbygoogle|adverts?|"
    r"advertis\w*|sponsor\w*|promo\w*|banner|sidebar|menu|nav|navbar|navigation|breadcrumbs?|masthead|topbar|footer|"
    r"comments?|commentlist|respond|reply|replies|discuss\w*|disqus|cookies?|consent|gdpr|notice|notices|alert|"
    r"newsletter|subscribe|subscription|signup|share|sharing|social|related|recommend\w*|widget|popup|modal|overlay|"
    r"pagination|pager|login|search|skip|toolbar|copyright|legal|disclaimer)(?:$|[\s_-])"
)
#: Of these only outside of an article.
SITE_HEADER = re.compile(r"(?:^|[\s_-])header(?:$|[\s_-])")
ROLES = re.compile(r"navigation|banner|contentinfo|complementary|search|alert|dialog|menu|form")

_START = re.compile(r"<(?:(?P<comment>!--)|(?P<other>[!?])|(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?=[\s/>]))")
_SPECIAL = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][\w:.-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
#: Names of the attributes that _shown reads.
_TELLING = re.compile(r"class|id|style|role|hidden", re.I)
_RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW}
#: A start tag on the left ends these open elements.
_P_ENDS = BLOCKS - {"html", "body", "option", "optgroup", "legend", "caption"}
_IMPLIED = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
            "th": {"td", "th"}, "option": {"option"}}
_P_LIMITS = {"td", "th", "article", "section", "div"}
_SCOPES = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr"}, "th": {"tr"}}

#: Tells the token of an end tag from that of its start tag.
_END = 0x5555555555555555


@dataclass(slots=True)
class Node:
    """An element: its role is the path of names and classes that leads to it."""

    tag: str
    role: int
    outside: bool
    in_article: bool = False
    parent: Node | None = None
    level: int = 0
    #: Number of tag tokens in front of its own.
    place: int = -1
    #: The nearest element, itself included, that breaks a line.
    block: Node = field(init=False)

    def __post_init__(self):
        self.block = self if self.parent is None or self.tag in BLOCKS else self.parent.block


@dataclass(slots=True)
class Text:
    """A line of text within one block, with the element that holds it."""

    node: Node
    text: str
    token: int
    #: Number of tag tokens in front of it.
    place: int = 0


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))


@lru_cache(maxsize=1 << 16)
def _role(parent: int, tag: str, names: str) -> int:
    return _hash(f"{parent} {tag} {names}")


def _shown(tag: str, attributes: str, in_article: bool) -> tuple[str, bool]:
    """Class and id of a tag without digits, and whether they or the tag mark what is not the article."""
    if tag in NEVER or tag == "header" and not in_article:
        return "", True
    if not attributes or not _TELLING.search(attributes):
        return "", False
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
    names = re.sub(r"(?<=[a-z])(?=[A-Z])", "-", f"{found.get('class', '')} {found.get('id', '')}")
    names = re.sub(r"\d+", "", names).strip().lower()
    style = found.get("style", "").replace(" ", "").lower()
    outside = bool(
        (names and tag not in ("body", "html", "article", "main") and FURNITURE.search(names))
        or (names and not in_article and tag not in ("body", "html") and SITE_HEADER.search(names))
        or ROLES.fullmatch(found.get("role", "").strip().lower())
        or "hidden" in found
        or found.get("aria-hidden", "").lower() == "true"
        or "display:none" in style
        or "visibility:hidden" in style
    )
    return names, outside


class _Tags:
    """The tags and comments of a page in order, in time that grows with its length.

    A tag ends at the next > outside of quotes; without one it is text. A search that fails has passed
    places outside of quotes, and any later one that comes to such a place fails as well.
    """

    def __init__(self, page: str):
        self.page = page
        self.last = page.rfind(">")
        self.failed: set[int] = set()
        self.special = (0, -1)

    def _special_from(self, at: int) -> int:
        """Place of the next > or quote, or -1; remembers the stretch without any that it has passed."""
        first, place = self.special
        if not first <= at <= place:
            m = _SPECIAL.search(self.page, at)
            self.special = at, m.start() if m else len(self.page)
            place = self.special[1]
        return place if place < len(self.page) else -1

    def _end(self, at: int) -> int:
        passed = []
        while at <= self.last:
            place = self._special_from(at)
            if place < 0 or place in self.failed:
                break
            if self.page[place] == ">":
                return place
            passed.append(place)
            at = self.page.find(self.page[place], place + 1) + 1
            if not at:
                break
        self.failed.update(passed)
        return -1

    def after(self, at: int) -> tuple[int, int, str, str, str] | None:
        """start, end, slash, name and attributes of the next tag; a comment or the like has no name."""
        while m := _START.search(self.page, at):
            if m["comment"]:
                stop = self.page.find("-->", m.end())
                return m.start(), stop + 3 if stop >= 0 else len(self.page), "", "", ""
            if m["other"]:
                if m.end() <= self.last:
                    return m.start(), self.page.find(">", m.end()) + 1, "", "", ""
            else:
                begin = m.end()
                # A slash that is not behind white space is the last character of a tag.
                if self.page[begin] == ">":
                    stop = begin
                elif self.page[begin] == "/":
                    stop = begin + 1 if self.page.startswith(">", begin + 1) else -1
                else:
                    stop = self._end(begin)
                if stop >= 0:
                    return m.start(), stop + 1, m["close"], m["tag"].lower(), self.page[begin:stop]
            at = m.start() + 1
        return None


class _Open:
    """The open elements of a page, with the depths at which each tag is open."""

    def __init__(self, root: Node):
        self.stack = [root]
        self.depths: dict[str, list[int]] = {}

    def push(self, node: Node) -> None:
        self.depths.setdefault(node.tag, []).append(len(self.stack))
        self.stack.append(node)

    def cut(self, depth: int) -> None:
        for node in self.stack[depth:]:
            self.depths[node.tag].pop()
        del self.stack[depth:]

    def depth(self, tag: str) -> int:
        """Depth of the nearest open element of this tag; else 0."""
        own = self.depths.get(tag)
        return own[-1] if own else 0

    def nearest(self, tags: set[str], limits: set[str]) -> int:
        """Depth of the nearest open element of these, not looking beyond one of `limits`; else 0."""
        depth = max(map(self.depth, tags))
        return depth if depth and depth >= max(map(self.depth, limits), default=0) else 0


def parse(page: str) -> tuple[list[int], list[Text]]:
    """The tag tokens of a page, each by its role, and its blocks of text.

    Tags that are missing, doubled or nested wrongly are mended as browsers do in the common cases. What
    does not look like a tag is text. Takes time that grows with the page, however deep it is.
    """
    root = Node("", 0, False)
    open_nodes = _Open(root)
    stack = open_nodes.stack
    tags = _Tags(page)
    tokens: list[int] = []
    blocks: list[Text] = []
    parts: list[str] = []
    holder, begun = root, 0

    def flush() -> None:
        if parts:
            words = entities.unescape("".join(parts)).split()
            parts.clear()
            if words:
                line = " ".join(words)
                blocks.append(Text(holder, line, _hash(f"{holder.role} {line}"), begun))

    def close_to(depth: int) -> None:
        flush()
        open_nodes.cut(depth)

    at = 0
    while at < len(page):
        found = tags.after(at)
        end = found[0] if found else len(page)
        if end > at:
            if not parts:
                holder, begun = stack[-1].block, len(tokens)
            if not stack[-1].outside:
                parts.append(page[at:end])
            elif page[at:end].strip():
                flush()
        if not found:
            break
        _, at, closes, tag, attributes = found
        if not tag:
            continue
        if closes:
            depth = open_nodes.depth(tag)
            if depth:
                tokens.append(stack[depth].role ^ _END)
                if tag in BLOCKS or stack[depth].outside or any(n.tag in BLOCKS for n in stack[depth:]):
                    close_to(depth)
                else:
                    open_nodes.cut(depth)
            elif tag in BLOCKS:
                flush()
            continue
        if tag in BLOCKS:
            flush()
        ends_p = tag in _P_ENDS and open_nodes.depths.get("p")
        if ends_p and (depth := open_nodes.nearest({"p"}, _P_LIMITS)):
            close_to(depth)
        if tag in _IMPLIED and (depth := open_nodes.nearest(_IMPLIED[tag], _SCOPES.get(tag, set()))):
            close_to(depth)
        parent = stack[-1]
        # A header inside the article is part of it; elsewhere it belongs to the site.
        in_article = parent.in_article or tag in ("article", "main")
        names, outside = _shown(tag, attributes, in_article)
        role = _role(parent.role, tag, names)
        node = Node(tag, role, outside or parent.outside, in_article, parent, parent.level + 1, len(tokens))
        tokens.append(node.role)
        if outside:
            flush()
        if tag == "br" and parts:
            parts.append(" ")
        if tag in VOID or attributes.endswith("/") and tag not in BLOCKS:
            continue
        if tag in _RAW_END:
            stop = _RAW_END[tag].search(page, at)
            at = stop.end() if stop else len(page)
            continue
        open_nodes.push(node)
    flush()
    return tokens, blocks


def main_blocks(blocks: list[Text], slots: dict[int, float], furniture: set[int]) -> list[str]:
    """The text of the slots that hold the article.

    `slots` tells the elements of this page that belong to the template, by their place, and the share of
    its pages' text that the host has in the slots below each (0 for one that is no candidate). The deepest
    one with SLOT_SHARE is the article; one that is named so suffices with NAMED_SHARE and goes first.

    A page on which none of these holds text, as without a template, is weighed by itself: an article
    element with at least half of the text goes first, else the deepest element (of the template, if there is
    one) with four fifths of it. Furniture is left out of the article unless that would leave less than
    half of it: then the pages are copies of each other.
    """
    inside = [b for b in blocks if not b.node.outside]
    if not inside:
        return []
    # Every element with text below it, in the order of the page.
    weights: dict[int, int] = {}
    nodes: list[Node] = []
    total = 0
    for b in inside:
        size = _weight(len(b.text), b.token in furniture)
        total += size
        new, node = [], b.node
        while node is not None and id(node) not in weights:
            weights[id(node)] = 0
            new.append(node)
            node = node.parent
        nodes += reversed(new)
        weights[id(b.node)] += size
    by_level = sorted(nodes, key=lambda n: n.level)
    for node in reversed(by_level):
        if node.parent is not None:
            weights[id(node.parent)] += weights[id(node)]
    named = [n for n in nodes if n.tag == "article" or n.tag == "main"]
    framed = [n for n in nodes if not slots or n.place in slots]
    holders = [n for n in named if slots and slots.get(n.place, 0) >= NAMED_SHARE]
    best = max(holders, key=lambda n: (slots[n.place], n.level), default=None)
    if best is None and slots:
        holders = [n for n in framed if n.tag in CONTAINERS and slots[n.place] >= SLOT_SHARE]
        best = max(holders, key=lambda n: n.level, default=None)
    if best is None:
        best = max(named, key=lambda n: (weights[id(n)], n.level), default=None)
        if best is None or weights[id(best)] < 0.5 * total:
            fits = [n for n in framed if n.tag in CONTAINERS and weights[id(n)] >= 0.8 * total]
            best = max(fits, key=lambda n: n.level, default=None)
    chosen = inside
    if best is not None:
        below = {id(best)}
        for node in by_level:
            if id(node.parent) in below:
                below.add(id(node))
        chosen = [b for b in inside if id(b.node) in below]
    kept = [b for b in chosen if b.token not in furniture]
    if 2 * sum(len(b.text) for b in kept) < sum(len(b.text) for b in chosen):
        kept = chosen
    return [b.text for b in kept]


def _weight(size: int, is_furniture: bool) -> int:
    return 1 if is_furniture else size


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def page_stream(tokens: list[int], blocks: list[Text]) -> tuple[np.ndarray, list[int]]:
    """Tag and text tokens of a page in their order, signed, and the length of each text; 0 for a tag."""
    stream, sizes, at = [], [], 0
    for b in blocks:
        stream += tokens[at : b.place]
        sizes += [0] * (b.place - at)
        at = b.place
        stream.append(b.token)
        sizes.append(len(b.text))
    stream += tokens[at:]
    sizes += [0] * (len(tokens) - at)
    return np.array(stream, dtype=np.uint64).view(np.int64), sizes


def _ends(column: pa.ListArray) -> np.ndarray:
    """Where each list begins in the flattened column, and where the last one ends."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.concatenate([[0], np.cumsum(lengths)])


def _flat(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False)


def _lists(column: pa.ListArray) -> list[list[int]]:
    values = _flat(column).tolist()
    return [values[a:b] for a, b in pairwise(_ends(column).tolist())]


@dataclass
class Reading:
    """What following a template along a page finds.

    `slots` has the innermost slot around each token (0: none), `found` the place in the page, class and
    place in its class of each token of the template. Faults: `parents` (class, slot around an occurrence),
    `crossed` (class, its gap, another class that only starts in this gap, the gap of that) and `broken`,
    classes whose tokens are not in order.
    """

    slots: list[int]
    found: list[tuple[int, int, int]]
    parents: set[tuple[int, int]]
    crossed: set[tuple[int, int, int, int]]
    broken: set[int]


class Template:
    """The classes of a host, each a list of tokens in order, nested in gaps between tokens of others.

    Rows are token, class, place in the class and level. A token of a level above 0 is told by the slot
    of a lower level in which it lies: its number is that of the tag or text, exclusive or that of the slot.
    """

    def __init__(self, rows: list[dict]):
        self.at = {r["token"]: (r["class"], r["place"], r["level"]) for r in rows}
        self.rows = {(r["class"], r["place"]): i for i, r in enumerate(rows)}
        self.size = Counter(r["class"] for r in rows)
        self.level = {r["class"]: r["level"] for r in rows}
        self.levels = 1 + max(self.level.values(), default=-1)
        self.ids = {key: _signed(_hash(f"{key[0]} {key[1]}")) for key in self.rows}
        self.names = {slot: key for key, slot in self.ids.items()}

    def follow(self, stream: list[int]) -> Reading:
        """Read a page along the template. Only classes of the last level may be at fault."""
        out = Reading([], [], set(), set(), set())
        # The innermost slot of classes below each level; open occurrences: class, place, slots around it.
        slots = (0,) * (self.levels + 1)
        stack: list[list] = []
        depths: dict[int, int] = {}
        levels = range(self.levels)
        spoiled: set[int] = set()
        within = enumerate(stream)
        if self.levels == 1:
            within = [(at, token) for at, token in within if token in self.at]
        for at, token in within:
            out.slots += [slots[-1]] * (at + 1 - len(out.slots))
            for level in levels:
                hit = self.at.get(token ^ slots[level])
                if hit and hit[2] == level:
                    break
            else:
                continue
            cls, place, level = hit
            out.found.append((at, cls, place))
            if cls in spoiled:
                continue
            depth = depths.get(cls)
            fits = place == 0 if depth is None else place and stack[depth][1] == place - 1
            above = stack[depth + 1 :] if depth is not None and depth + 1 < len(stack) else ()
            if not fits:
                out.broken.add(cls)
            elif depth is None:
                out.parents.add((cls, slots[-1]))
                depths[cls] = len(stack)
                stack.append([cls, 0, slots])
            else:
                if above:
                    out.crossed |= {(cls, place - 1, x[0], x[1]) for x in above}
                    fits = all(self.level[x[0]] >= level for x in above)
                if fits:
                    for x in above:
                        spoiled.add(x[0])
                        del depths[x[0]]
                    del stack[depth + 1 :]
                    stack[-1][1] = place
            if not fits:
                # No more of this class on this page; those open above it stay.
                spoiled.add(cls)
                if depth is not None:
                    around = stack.pop(depth)[2]
                    slots = slots if above else around
                    del depths[cls]
                    depths.update((x[0], depth + i) for i, x in enumerate(above))
                continue
            around = stack[-1][2]
            if place == self.size[cls] - 1:
                slots = around
                stack.pop()
                del depths[cls]
            else:
                slots = around[: level + 1] + (self.ids[cls, place],) * (self.levels - level)
        out.slots += [slots[-1]] * (len(stream) - len(out.slots))
        out.broken |= depths.keys()
        return out


def out_of_order(places: list[list[int]]) -> set[int]:
    """Which tokens of a class stand in the way of the order that most of them keep on a page.

    `places` has for each token of the class, in the order of the class, where it occurs. In order, every
    occurrence of the class has all tokens before the next one begins. Tokens that are missing are out of order.
    """
    # The longest run of tokens whose first occurrences ascend.
    ends: list[int] = []
    chain: list[int] = []
    before: dict[int, int] = {}
    for i, own in enumerate(places):
        if not own:
            continue
        k = bisect_left(ends, own[0])
        ends[k : k + 1], chain[k : k + 1] = [own[0]], [i]
        before[i] = chain[k - 1] if k else -1
    run, i = [], chain[-1]
    while i >= 0:
        run.append(i)
        i = before[i]
    run.reverse()
    kept = run[:1]
    for i in run[1:]:
        own, first, past = places[i], places[kept[0]], places[kept[-1]]
        if len(own) == len(past) and all(map(gt, own, past)) and all(map(lt, own, first[1:])):
            kept.append(i)
    return set(range(len(places))) - set(kept)


class _Known:
    """What the template columns of a batch say, read once for each host."""

    def __init__(self, values: dict, make: Callable):
        self.hosts = values["host"].to_pylist()
        self.columns = [values[c] for c in ("template", "furniture", "shares") if c in values]
        self.make, self.known = make, {}

    def of(self, i: int):
        host = self.hosts[i]
        if host not in self.known:
            self.known[host] = self.make(*[c[i].as_py() for c in self.columns])
        return self.known[host]


def _struct(names: str, **wide: pa.DataType) -> pa.DataType:
    return pa.struct([(n, wide.get(n, pa.int32())) for n in names.split()])


_LONG = pa.int64()
_ROW = _struct("token class place level", token=_LONG)
_CLASS = _struct("class level pages times parent gap", pages=_LONG, times=_LONG)
#: What is known of a host while its template grows.
_HOST = pa.schema(
    [
        ("host", pa.string()),
        ("host_pages", _LONG),
        ("furniture", pa.list_(_LONG)),
        ("template", pa.list_(_ROW)),
        ("classes", pa.list_(_CLASS)),
    ]
)


def page_streams(df: DataFrame) -> DataFrame:
    """host, page_key and the tokens of each page in order, with the lengths of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            values = dict(zip(batch.schema.names, batch.columns, strict=True))
            found = [page_stream(*parse(page or "")) for page in values["html"].to_pylist()]
            ends = np.concatenate([[0], np.cumsum([len(f[1]) for f in found])])
            ends = pa.array(ends, pa.int32())
            streams = pa.array(np.concatenate([f[0] for f in found]))
            sizes = pa.array(np.fromiter(chain.from_iterable(f[1] for f in found), dtype=np.int32))
            lists = [pa.ListArray.from_arrays(ends, x) for x in (streams, sizes)]
            yield pa.RecordBatch.from_arrays(
                [values["host"], values["page_key"], *lists], names=["host", "page_key", "stream", "sizes"]
            )

    return df.mapInArrow(run, "host string, page_key long, stream array<bigint>, sizes array<int>")


def occurrence_vectors(pages: DataFrame) -> DataFrame:
    """host, token, is_text, pages, times, first and the occurrence vector of each token, as one number.

    Tokens of the template so far are left out; any other is told by the slot of it in which it lies. The
    vector says how often a token stands in each page of its host. Its fingerprint is the exclusive
    or of a hash of (page, count) over all pages, which tasks combine in any order; equal vectors have
    equal fingerprints. `first` sums the places of its first occurrences, so that of tokens which keep
    an order on all pages the earlier one has the smaller sum.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            values = dict(zip(batch.schema.names, batch.columns, strict=True))
            known = _Known(values, lambda t, f: (Template(t or []), None if f is None else set(f)))
            ends, tokens = _ends(values["stream"]), _flat(values["stream"]).copy()
            is_text = _flat(values["sizes"]) > 0
            wanted = np.ones(len(tokens), dtype=bool)
            for i, (begin, end) in enumerate(pairwise(ends.tolist())):
                template, furniture = known.of(i)
                if not template.at:
                    continue
                stream = tokens[begin:end].tolist()
                read = template.follow(stream)
                wanted[[begin + at for at, _, _ in read.found]] = False
                texts = (begin + np.flatnonzero(is_text[begin:end])).tolist()
                wanted[[at for at in texts if stream[at - begin] not in furniture]] = False
                tokens[begin:end] ^= np.array(read.slots, dtype=np.int64)
            pages = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
            places = np.arange(len(tokens)) - ends[pages]
            tokens, is_text, pages, places = (x[wanted] for x in (tokens, is_text, pages, places))
            if not len(tokens):
                continue
            # The tokens of each page, with the first of its places and their number.
            order = np.lexsort((tokens, pages))
            tokens, is_text, pages, places = (x[order] for x in (tokens, is_text, pages, places))
            starts = np.flatnonzero(np.diff(tokens, prepend=~tokens[0]) | np.diff(pages, prepend=-1))
            times = np.diff(starts, append=len(tokens))
            tokens, is_text, pages, places = (x[starts] for x in (tokens, is_text, pages, places))
            # Both numbers take part, so that (page, count) pairs of different pages differ.
            keys = values["page_key"].to_numpy(zero_copy_only=False).view(np.uint64)[pages]
            marks = mix(mix(keys) ^ times.astype(np.uint64)).view(np.int64)
            # The tokens of each host of this batch.
            names = {host: i for i, host in enumerate(dict.fromkeys(known.hosts))}
            hosts = np.array([names[h] for h in known.hosts])[pages]
            order = np.lexsort((tokens, hosts))
            tokens, is_text, hosts, places, times, marks = (
                x[order] for x in (tokens, is_text, hosts, places, times, marks)
            )
            starts = np.flatnonzero(np.diff(tokens, prepend=~tokens[0]) | np.diff(hosts, prepend=-1))
            columns = {
                "host": pa.array(list(names)).take(pa.array(hosts[starts])),
                "token": tokens[starts],
                "is_text": is_text[starts],
                "pages": np.diff(starts, append=len(tokens)),
                "times": np.add.reduceat(times, starts),
                "first": np.add.reduceat(places, starts),
                "vector": np.bitwise_xor.reduceat(marks, starts),
            }
            yield pa.RecordBatch.from_pydict({n: pa.array(x) for n, x in columns.items()})

    schema = "host string, token long, is_text boolean, pages long, times long, first long, vector long"
    counted = pages.mapInArrow(run, schema).groupBy("host", "token", "is_text")
    sums = [F.sum(c).alias(c) for c in ("pages", "times", "first")]
    return counted.agg(*sums, F.bit_xor("vector").alias("vector"))


def candidate_classes(vectors: DataFrame, hosts: DataFrame, total: int) -> DataFrame:
    """host, furniture and the equivalence classes of its tokens, each in the order of first places.

    Tokens of a host with the same occurrence vector form a class, if there are LEAST_CLASS of them in
    LEAST_PAGES pages and in LEAST_SHARE of the host's pages. Texts take part from TEXT_SHARE on, where
    they are furniture.
    """
    common = join_groups(vectors.where(F.col("pages") >= LEAST_PAGES), hosts, ["host"], "host_pages", total)
    least = F.when(F.col("is_text"), TEXT_SHARE).otherwise(LEAST_SHARE)
    common = common.where(F.col("pages") >= least * F.col("host_pages"))
    tokens = F.sort_array(F.collect_list(F.struct("first", "token")))
    texts = F.collect_list(F.when(F.col("is_text"), F.col("token")))
    classes = common.groupBy("host", "vector", "pages", "times").agg(tokens.alias("tokens"), texts.alias("texts"))
    in_order = F.col("tokens.token").alias("token")
    large = F.when(F.size("tokens") >= LEAST_CLASS, F.struct("pages", "times", in_order, "vector"))
    return classes.groupBy("host").agg(
        F.flatten(F.collect_list("texts")).alias("texts"), F.sort_array(F.collect_list(large)).alias("new")
    )


def _over_hosts(hosts: DataFrame, work: Callable[[dict], dict], **new: pa.DataType) -> DataFrame:
    """Apply `work` to each row of a table with a row for each host; `new` are the columns it adds."""
    schema = reduce(pa.Schema.append, (pa.field(*x) for x in new.items()), _HOST)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, rows=256):
            yield pa.RecordBatch.from_pylist([work(row) for row in batch.to_pylist()], schema=schema)

    return hosts.mapInArrow(run, from_arrow_schema(schema))


def _extended(row: dict) -> dict:
    """The template of a host with its new candidates as classes of a level above all others."""
    level = 1 + max((c["level"] for c in row["classes"]), default=-1)
    number = 1 + max((c["class"] for c in row["classes"]), default=-1)
    for found in row["new"]:
        meta = {"class": number, "level": level, "pages": found["pages"], "times": found["times"]}
        row["classes"].append({**meta, "parent": -1, "gap": -1})
        for place, token in enumerate(found["token"]):
            row["template"].append({"token": token, "class": number, "place": place, "level": level})
        number += 1
    return row


def template_faults(pages: DataFrame) -> DataFrame:
    """host and what its pages say about the classes of the last level: kind, class, a, b and c.

    Kinds: parent (the slot around an occurrence, as class and gap), crossed (own gap, other class, its
    gap) and broken (place of a token that is out of order).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            values = dict(zip(batch.schema.names, batch.columns, strict=True))
            known = _Known(values, lambda t: Template(t))
            said = set()
            for i, stream in enumerate(_lists(values["stream"])):
                template, host = known.of(i), known.hosts[i]
                read = template.follow(stream)
                for cls, slot in read.parents:
                    said.add((host, "parent", cls, *template.names.get(slot, (-1, -1)), 0))
                said |= {(host, "crossed", *x) for x in read.crossed}
                for cls in read.broken:
                    places: list[list[int]] = [[] for _ in range(template.size[cls])]
                    for at, own, place in read.found:
                        if own == cls:
                            places[place].append(at)
                    said |= {(host, "broken", cls, x, 0, 0) for x in out_of_order(places)}
            if said:
                columns = [list(c) for c in zip(*sorted(said), strict=True)]
                kinds = [pa.string(), pa.string(), *[pa.int32()] * 4]
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=["host", "kind", "class", "a", "b", "c"])

    return pages.mapInArrow(run, "host string, kind string, class int, a int, b int, c int").distinct()


def _settled(row: dict) -> dict:
    """The classes of a host after one look at all of its pages; `again` if they need another.

    A class whose tokens are out of order on some page is parted into those that keep it everywhere and
    the rest. Of two that cross, and of one that only sometimes lies inside another, the weaker is cut where
    the other begins or ends: higher level, then fewer pages, then fewer tokens. One that lies in different gaps of
    stronger ones goes; its tokens come back told by these gaps. What is left of one token is no class.
    """
    top = max(c["level"] for c in row["classes"])
    meta = {c["class"]: c for c in row["classes"]}
    tokens: dict[int, list[dict]] = {}
    for r in sorted(row["template"], key=lambda r: (r["class"], r["place"])):
        tokens.setdefault(r["class"], []).append(r)

    def strength(cls: int) -> tuple:
        return -meta[cls]["level"], meta[cls]["pages"], len(tokens[cls]), -cls

    parents: dict[int, set[tuple[int, int]]] = {}
    moved: dict[int, set[int]] = {}
    cuts: dict[int, set[int]] = {}
    gone: set[int] = set()
    for f in row["faults"] or []:
        if f["kind"] == "parent":
            parents.setdefault(f["class"], set()).add((f["a"], f["b"]))
        elif f["kind"] == "broken":
            moved.setdefault(f["class"], set()).add(f["a"])
    for f in row["faults"] or []:
        if f["kind"] == "crossed" and f["class"] not in moved and f["b"] not in moved:
            if strength(f["class"]) < strength(f["b"]):
                cuts.setdefault(f["class"], set()).add(f["a"])
            else:
                cuts.setdefault(f["b"], set()).add(f["c"])
    for cls in sorted(parents, key=strength, reverse=True):
        around = parents[cls]
        if len(around) == 1 or cls in moved or cls in cuts:
            continue
        if any(p in moved or p in cuts or p in gone for p, _ in around):
            continue
        weaker = [(p, gap) for p, gap in around if p >= 0 and strength(p) < strength(cls)]
        for p, gap in weaker:
            cuts.setdefault(p, set()).add(gap)
        if not weaker and meta[cls]["level"] == top:
            gone.add(cls)
    again = bool(moved or cuts or gone)
    kept, classes, number = [], [], 1 + max(meta)
    for cls, own in tokens.items():
        if cls in moved:
            parts = [
                [r for r in own if r["place"] not in moved[cls]],
                [r for r in own if r["place"] in moved[cls]],
            ]
            if len(parts[0]) < LEAST_CLASS:
                parts = []
        elif cls in gone:
            parts = []
        else:
            ends = [0, *sorted(gap + 1 for gap in cuts.get(cls, ())), len(own)]
            parts = [own[a:b] for a, b in pairwise(ends)]
        for part in parts:
            if len(part) >= LEAST_CLASS:
                new = cls if len(parts) == 1 else number
                number += len(parts) > 1
                parent, gap = min(parents.get(cls, {(-1, -1)}))
                classes.append({**meta[cls], "class": new, "parent": parent, "gap": gap})
                kept += [{**r, "class": new, "place": i} for i, r in enumerate(part)]
    row["template"], row["classes"] = kept, classes
    grown = any(c["level"] == top for c in classes)
    return {**row, "again": again and grown, "grown": grown}


def slot_weights(pages: DataFrame) -> DataFrame:
    """host, class, gap and the text in this gap on all pages; gap -1: all text of the pages with the class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            values = dict(zip(batch.schema.names, batch.columns, strict=True))
            known = _Known(values, lambda t, f: (Template(t), set(f or [])))
            sums: dict[tuple[str, int, int], int] = {}
            streams = zip(_lists(values["stream"]), _lists(values["sizes"]), strict=True)
            for i, (stream, sizes) in enumerate(streams):
                (template, furniture), host = known.of(i), known.hosts[i]
                read = template.follow(stream)
                total = 0
                for at, size in enumerate(sizes):
                    if size:
                        size = _weight(size, stream[at] in furniture)
                        total += size
                        if slot := read.slots[at]:
                            key = (host, *template.names[slot])
                            sums[key] = sums.get(key, 0) + size
                for cls in {cls for _, cls, _ in read.found}:
                    sums[host, cls, -1] = sums.get((host, cls, -1), 0) + total
            if sums:
                columns = [list(c) for c in zip(*sums, strict=True)]
                kinds = [pa.string(), pa.int32(), pa.int32()]
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*arrays, pa.array(list(sums.values()), pa.int64())], names=["host", "class", "gap", "size"]
                )

    summed = pages.mapInArrow(run, "host string, class int, gap int, size long")
    return summed.groupBy("host", "class", "gap").agg(F.sum("size").alias("size"))


def _shared(row: dict) -> dict:
    """Adds `shares`: of the text of a class's pages, what lies between each start tag and its end tag.

    Only for classes that occur once in each page with them; else 0, as for tokens that start no element.
    """
    rows = row["template"]
    size = {(w["class"], w["gap"]): w["size"] for w in row["weights"] or []}
    children: dict[int, list[dict]] = {}
    for c in row["classes"]:
        children.setdefault(c["parent"], []).append(c)
    # Classes in front of those nested in them; then each adds its text to the gap around it.
    nested = list(children.get(-1, []))
    for c in nested:
        nested += children.get(c["class"], [])
    tokens: dict[int, list[int]] = {}
    for i, r in enumerate(rows):
        tokens.setdefault(r["class"], []).append(i)
    for c in reversed(nested):
        inner = sum(size.get((c["class"], gap), 0) for gap in range(len(tokens[c["class"]])))
        size[c["parent"], c["gap"]] = size.get((c["parent"], c["gap"]), 0) + inner
    shares = [0.0] * len(rows)
    for c in nested:
        total = size.get((c["class"], -1), 0)
        if c["times"] != c["pages"] or not total:
            continue
        own = tokens[c["class"]]
        before = list(accumulate((size.get((c["class"], gap), 0) for gap in range(len(own))), initial=0))
        place = {rows[i]["token"]: k for k, i in enumerate(own)}
        for k, i in enumerate(own):
            end = place.get(rows[i]["token"] ^ _END, -1)
            if end > k:
                shares[i] = (before[end] - before[k]) / total
    return {**row, "shares": shares}


def host_templates(df: DataFrame) -> DataFrame:
    """host, host_pages, template, shares (see main_blocks) and furniture (tokens of texts) of every host.

    Rounds until no host finds another class. Each forms the classes of tokens with equal occurrence vectors
    (`candidate_classes`), tests on every page of the host that a class keeps its order and lies in one gap
    of each class around it, or in none, and parts those that do not (`_settled`) until all do. What is valid joins the
    template; tokens outside of it are told from the next round on by the slot of it that they lie in.
    """
    pages = materialize(page_streams(df), "streams")
    counted = pages.groupBy("host").agg(F.count("*").alias("host_pages"))
    empty = {"furniture": None, "template": [], "classes": []}
    growing = materialize(_over_hosts(counted, lambda row: {**row, **empty}), "hosts")
    total = growing.agg(F.sum("host_pages")).first()[0] or 0
    finished = []

    def with_pages(hosts: DataFrame, *columns: str) -> DataFrame:
        own = hosts.select("host", "host_pages", *columns)
        return join_groups(pages, own, ["host"], "host_pages", total).drop("host_pages")

    while not growing.isEmpty():
        vectors = occurrence_vectors(with_pages(growing, "template", "furniture"))
        found = candidate_classes(vectors, growing.select("host", "host_pages"), total)
        texts = F.coalesce("furniture", "texts", F.array().cast("array<bigint>"))
        trial = growing.join(found, "host", "left").withColumn("furniture", texts).drop("texts")
        trial = materialize(trial, "candidates")
        is_new = F.coalesce(F.size("new"), F.lit(0)) > 0
        finished.append(trial.where(~is_new).drop("new"))
        trial = materialize(_over_hosts(trial.where(is_new), _extended), "extended")
        grown = []
        while not trial.isEmpty():
            faults = template_faults(with_pages(trial, "template")).groupBy("host")
            faults = faults.agg(F.collect_list(F.struct("kind", "class", "a", "b", "c")).alias("faults"))
            looked = trial.join(faults, "host", "left")
            looked = materialize(_over_hosts(looked, _settled, again=pa.bool_(), grown=pa.bool_()), "settled")
            finished.append(looked.where(~F.col("grown")).drop("again", "grown"))
            grown.append(looked.where(F.col("grown") & ~F.col("again")).drop("again", "grown"))
            trial = looked.where("again").drop("again", "grown")
        growing = reduce(DataFrame.unionByName, grown) if grown else trial
    hosts = reduce(DataFrame.unionByName, finished) if finished else growing
    templates = hosts.where(F.size("template") > 0)
    weights = slot_weights(with_pages(templates, "template", "furniture")).groupBy("host")
    weights = weights.agg(F.collect_list(F.struct("class", "gap", "size")).alias("weights"))
    shared = _over_hosts(hosts.join(weights, "host", "left"), _shared, shares=pa.list_(pa.float64()))
    return materialize(shared.drop("classes"), "host-templates")


def extract(df: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url and text (the article) of every page.

    Blocks of text are joined by an empty line; within one, white space is one space and character
    references are decoded. A page without an article, or with NULL or empty html, has the text ''. Pages
    without a url form one host. Statistics are over all pages of a host and combined inside the tasks;
    the templates of hosts with very many pages are broadcast (they are at most a thousand, each of
    bounded size), all others are joined by host.
    """
    pages = df.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html")
    )
    address = F.regexp_extract(F.lower(F.coalesce("url", F.lit(""))), r"^[a-z]*:?//([^/?#]*)", 1)
    pages = pages.withColumn("host", address)
    keyed = pages.select(
        "host", "html", F.xxhash64("page_id", "url", F.length("html")).alias("page_key")
    )
    templates = host_templates(keyed)
    total = templates.agg(F.sum("host_pages")).first()[0] or 0
    joined = join_groups(pages, templates, ["host"], "host_pages", total, "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            values = dict(zip(batch.schema.names, batch.columns, strict=True))
            known = _Known(values, lambda t, f, s: (Template(t or []), {x % (1 << 64) for x in f or []}, s))
            texts = []
            for i, page in enumerate(values["html"].to_pylist()):
                tokens, blocks = parse(page or "")
                template, furniture, shares = known.of(i)
                slots = {}
                if template.at:
                    stream, sizes = page_stream(tokens, blocks)
                    texts_at = [b.place + i for i, b in enumerate(blocks)]
                    for at, cls, place in template.follow(stream.tolist()).found:
                        if not sizes[at]:
                            slots[at - bisect_left(texts_at, at)] = shares[template.rows[cls, place]]
                texts.append("\n\n".join(main_blocks(blocks, slots, furniture)))
            yield pa.RecordBatch.from_arrays(
                [values["page_id"], values["url"], pa.array(texts, pa.string())],
                names=["page_id", "url", "text"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string"
    return joined.select("host", "page_id", "url", "html", "template", "furniture", "shares").mapInArrow(run, schema)
