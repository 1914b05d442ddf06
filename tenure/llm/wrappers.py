"""Main text of web pages by wrappers inferred for each host.

A wrapper is a union-free regular expression over a page's tokens: elements in order, each once,
optional, or repeated, with text slots. Every page of a host is aligned with it: what only one
side has becomes optional, what comes again in the same shape closes a repeated group, and
differing text becomes a slot. Tasks infer partial wrappers of what they read, which are aligned
with each other in rounds. Elements of few pages are counted beside the wrapper, by host and
place, and given to the pages that have them. Slots then keep or lose their text by where most letters of the host's
pages stand, by links, and by how many pages have the same text there.
"""

from __future__ import annotations

import html
import json
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenure.operators.staging import staged

#: Text is template text when at least so many different pages have it in its place,
LEAST_PAGES = 3
#: and so large a share of the pages that have the place: of a single place, of a repeated one.
MOSTLY, ALWAYS = 0.6, 0.9
#: What stands on less than one page in so many is counted by its place, beside the wrapper.
RARE = 256
#: Partial wrappers of a host that one task of a round merges.
FAN = 32
#: Hosts a task keeps wrappers of before it writes them.
HOSTS_AT_ONCE = 256
#: Rules up to this size are broadcast, more are joined by shuffle.
BROADCAST_BYTES = 32 << 20
SURVEY = ["host", "part", "wrapper", "place", "text", "page"]
COUNTED = ["pages", "letters", "link_letters", "repeated"]
#: What elements deeper than this hold is read as if it stood here, but for places named so that
#: they are no article or a heading of one.
DEEPEST = 64

# Kinds of elements.
RAW = frozenset("script style template noscript iframe svg math object canvas audio video".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup html li main menu nav ol p pre section summary table tbody td tfoot th thead title"
    " tr ul".split()
)
NOT_ARTICLE = frozenset(
    "nav footer aside form head title menu dialog select button textarea input label fieldset".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements of running text: no container of an article, and kept whatever their class is named.
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd td th caption figcaption summary".split())
TELLING = frozenset("header article main".split())
#: A start of one of these ends an open element of its kind first.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}}
_BOILERPLATE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|nav|navbar|navigation|menu|breadcrumbs?|sidebar|widget"
    r"|cookies?|consent|notice|alert|popup|modal|overlay|newsletter|subscribe|signup|login|search|share|sharing|social"
    r"|related|recommend\w*|comments?|commentlist|disqus|respond|replies|reply|footer|footnav|masthead|topbar|toolbar|skip|legal"
    r"|copyright|pagination|pager|tags)(?:$|[\s_-])",
    re.I,
)
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_NAMES = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_DIGITS = re.compile(r"[0-9]+")


@dataclass
class Node:
    """An element of a page or of a wrapper; ``key`` is its name, class, id and role, with digits alike."""

    key: str
    name: str
    names: str = ""
    children: list = field(default_factory=list)
    #: Of a text: the text, None once it differs between pages. Of a wrapper: how often it stands.
    text: str | None = None
    pages: int = 1
    optional: bool = False
    repeated: bool = False
    #: Of a text: does it stand in links, on every page?
    linked: bool = False
    #: Of an element below the deepest level: kinds that names have told from there on.
    told: frozenset[str] = frozenset()
    #: Letters inside, in links and not.
    letters: int = 0
    link_letters: int = 0
    shape: str = ""


#: Keys of the elements that lead to one, the last first in pairs: None, or (path above, key).
Path = tuple | None
#: Pages, letters, letters in links of rare elements, and do they repeat, by place.
Rest = dict[int, list[int]]


@dataclass
class Rules:
    """What is known of a host: its wrapper, and the share of pages with a text, by place and text."""

    wrapper: Node
    template: dict[tuple[int, int], float]


def _barred(name: str, names: str) -> bool:
    """Is an element by itself no place of article text?"""
    return name in NOT_ARTICLE or bool(names and name not in ("article", "main", "body", "html") and _BOILERPLATE.search(names))


def _deep(name: str, names: str, stack: list[Node]) -> Node:
    """An element below the deepest level: shares the children of the one above, if names tell nothing new.

    The tree stays shallow: one barred element, and one each of the other kinds that names tell of.
    """
    above = stack[-1]
    kind = "barred" if _barred(name, names) else name
    if "barred" in above.told or kind in above.told or not (kind == "barred" or name in TELLING or name in HEADINGS):
        return Node(name, name, names, above.children, told=above.told)
    shown = names if kind == "barred" else ""
    node = Node(f"{name}.{shown}" if shown else name, name, shown, told=above.told | {kind})
    above.children.append(node)
    return node


def parse(page: str | None) -> Node:
    """A tree of block elements and texts; inline elements leave no trace, a <br> parts texts."""
    root = Node("", "")
    stack, at, part, links = [root], 0, [], [0, 0]  # links: open ones, letters in them

    def say(text: str) -> None:
        part.append(text)
        if links[0]:
            links[1] += len(text.strip())

    def flush() -> None:
        if not part:
            return
        text = " ".join("".join(part).split())
        if text:
            stack[-1].children.append(Node("#", "#", text=text, linked=links[1] >= 0.9 * len(text)))
        part.clear()
        links[1] = 0

    page = page or ""
    while at < len(page):
        found = _TOKEN.search(page, at)
        if not found:
            say(html.unescape(page[at:]))
            break
        if found.start() > at:
            say(html.unescape(page[at : found.start()]))
        at = found.end()
        if found[2] is None:
            if found[0].startswith("<![CDATA["):
                say(found[0][9:].removesuffix("]]>"))
            continue
        close, name, rest = found[1], found[2].lower(), found[3] or ""
        if name in RAW and not close:
            if not rest.endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            part.append(" ")
            continue
        if name == "a":
            links[0] = 0 if close else 1
        if name in VOID:
            if name in ("br", "hr"):
                flush()
            continue
        inside = stack[-1].name in NOT_ARTICLE or name in NOT_ARTICLE
        names = " ".join(x[1] or x[2] or x[3] for x in _NAMES.findall(rest)) if rest and not close else ""
        if name not in BLOCK and not inside and not (names and _BOILERPLATE.search(names)) and not (close and any(n.name == name for n in stack)):
            continue
        flush()
        if close:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == name:
                    del stack[k:]
                    break
                if stack[k].name in ("article", "body", "main") and name in ("p", "div", "span"):
                    break
            continue
        # A block ends an open paragraph, an item ends an open item of the same list.
        if name in BLOCK and stack[-1].name == "p":
            stack.pop()
        ends = CLOSES.get(name, ())
        while len(stack) > 1 and stack[-1].name in ends:
            stack.pop()
        if len(stack) >= DEEPEST:
            if not rest.endswith("/"):
                stack.append(_deep(name, names, stack))
            continue
        node = Node(f"{name}.{_DIGITS.sub('0', names)}" if names else name, name, names)
        stack[-1].children.append(node)
        if not rest.endswith("/"):
            stack.append(node)
    flush()
    return root


def _copy(node: Node) -> Node:
    return Node(node.key, node.name, node.names, [], node.text, linked=node.linked)


def folded(node: Node) -> Node:
    """A page as the first wrapper: repeated groups are found from the inside out.

    A child of the same shape as an earlier one closes a group from that one on, which repeats.
    """
    out = _copy(node)
    if node.key == "#":
        out.letters, out.link_letters = (0, len(node.text)) if node.linked else (len(node.text), 0)
        out.shape = "#"
        return out
    at: dict[str, int] = {}
    for c in map(folded, node.children):
        k = at.get(c.shape)
        if k is None:
            at[c.shape] = len(out.children)
            out.children.append(c)
            continue
        out.children[k] = joined(out.children[k], c)
        out.children[k].pages = 1
        out.children[k].shape = c.shape
        for member in out.children[k:]:
            member.repeated = True
    out.shape = f"{out.key}({' '.join(sorted(at))})"
    if len(out.shape) > 64:
        out.shape = f"{out.key}:{xxhash.xxh64_hexdigest(out.shape)}"
    return out


def joined(a: Node, b: Node, path: Path = None, rest: Rest | None = None) -> Node:
    """The least general element that covers both.

    With ``rest``, rare elements inside are counted there and left out; ``path`` leads to the element.
    """
    out = Node(a.key, a.name, a.names, [], a.text if a.text == b.text else None, a.pages + b.pages)
    out.optional, out.repeated, out.linked = a.optional or b.optional, a.repeated or b.repeated, a.linked and b.linked
    out.letters, out.link_letters = a.letters + b.letters, a.link_letters + b.link_letters
    out.children = align(a.children, b.children, path, rest)
    if rest is not None and any(c.pages * RARE < out.pages for c in out.children):
        _set_apart(out, path, rest)
    return out


def _set_apart(node: Node, path: Path, rest: Rest) -> None:
    """Count rare children in ``rest``; their letters stay letters of the element."""
    barred = any(_no_text(key.partition(".")[0]) for key in _keys(path))
    for c in node.children:
        if c.pages * RARE < node.pages:
            letters, link_letters = _count_apart(c, path, barred, rest)
            node.letters += letters
            node.link_letters += link_letters
    node.children = [c for c in node.children if c.pages * RARE >= node.pages]


def _count_apart(node: Node, path: Path, barred: bool, rest: Rest) -> tuple[int, int]:
    path = (path, node.key)
    barred = barred or _no_text(node.name)
    letters, link_letters = node.letters, node.link_letters
    if barred:
        letters, link_letters = 0, letters + link_letters
    for c in node.children:
        more = _count_apart(c, path, barred, rest)
        letters, link_letters = letters + more[0], link_letters + more[1]
    counts = rest.setdefault(_place(_keys(path)), [0, 0, 0, 0])
    counts[:] = counts[0] + node.pages, counts[1] + letters, counts[2] + link_letters, counts[3] | node.repeated
    return letters, link_letters


def _no_text(name: str) -> bool:
    return name in NOT_ARTICLE or name == "header"


def _keys(path: Path) -> tuple[str, ...]:
    out = []
    while path is not None:
        path, key = path
        out.append(key)
    return tuple(reversed(out))


def likeness(a: Node, b: Node) -> float:
    """How well two elements match: not at all if names differ or nothing inside has the same name."""
    if a.key != b.key:
        return 0.0
    if a.key == "#" or not a.children or not b.children:
        return 1.0
    if len(a.children) == len(b.children) == 1:
        return 3.0 if a.children[0].key == b.children[0].key else 0.0
    x, y = {c.key for c in a.children}, {c.key for c in b.children}
    return 1.0 + 2.0 * len(x & y) / len(x | y) if x & y else 0.0


def matches(a: list[Node], b: list[Node]) -> list[tuple[int, int]]:
    """Pairs of places of a best alignment of two sequences."""
    n, m = len(a), len(b)
    if not n or not m:
        return []
    if n == m == 1:
        return [(0, 0)] if likeness(a[0], b[0]) else []
    if n == m and all(likeness(x, y) > 1.5 for x, y in zip(a, b, strict=True)):
        return [(i, i) for i in range(n)]
    scores = [[likeness(x, y) for y in b] for x in a]
    best = [[0.0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        row, below, score = best[i], best[i + 1], scores[i]
        for j in range(m - 1, -1, -1):
            row[j] = max(below[j], row[j + 1], score[j] + below[j + 1] if score[j] else 0.0)
    out, i, j = [], 0, 0
    while i < n and j < m:
        if scores[i][j] and best[i][j] == scores[i][j] + best[i + 1][j + 1]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def align(a: list[Node], b: list[Node], path: Path = None, rest: Rest | None = None) -> list[Node]:
    """Two sequences as one; what only one of them has becomes optional."""
    out: list[Node] = []
    i = j = 0
    for x, y in [*matches(a, b), (len(a), len(b))]:
        for node in a[i:x] + b[j:y]:
            node.optional = True
            out.append(node)
        if x < len(a):
            out.append(joined(a[x], b[y], (path, a[x].key), rest))
        i, j = x + 1, y + 1
    return out


def infer(pages: list[str]) -> Node:
    """The wrapper of some pages of one host, with all their elements; pages with the same text count once."""
    wrapper, seen = None, set()
    for page in pages:
        tree = parse(page)
        words = _words(tree)
        if words not in seen:
            seen.add(words)
            wrapper = folded(tree) if wrapper is None else joined(wrapper, folded(tree))
    return wrapper or Node("", "")


def _slots(node: Node, path: tuple[str, ...] = ()) -> Iterator[tuple[tuple[str, ...], Node]]:
    for c in node.children:
        if c.key == "#":
            yield path, c
        else:
            yield from _slots(c, (*path, c.key))


def _words(tree: Node) -> str:
    return "\n".join(slot.text for _, slot in _slots(tree))


def _place(path: tuple[str, ...]) -> int:
    return _digest("\n".join(path))


def _digest(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - 2**63


def packed(node: Node) -> list:
    """A wrapper as plain lists, for JSON."""
    flags = node.optional + 2 * node.repeated + 4 * node.linked
    return [node.key, node.name, node.names, node.text, node.pages, flags, node.letters, node.link_letters, [packed(c) for c in node.children]]


def unpacked(row: list) -> Node:
    out = Node(row[0], row[1], row[2], [unpacked(c) for c in row[8]], row[3], row[4], bool(row[5] & 1), bool(row[5] & 2), bool(row[5] & 4))
    out.letters, out.link_letters = row[6], row[7]
    return out


def rules(wrapper: Node, template: dict[tuple[int, int], float] | None = None) -> Rules:
    """What a host's pages say: the wrapper with its letters summed up, and template texts with their share.

    Without counted texts, slots that hold one text on all of at least three pages are template text.
    """
    counted = dict(template or {})

    def sum_up(node: Node, path: tuple[str, ...], barred: bool) -> None:
        barred = barred or _no_text(node.name)
        if barred:
            node.link_letters, node.letters = node.link_letters + node.letters, 0
        for c in node.children:
            if c.key == "#":
                if template is None and c.text is not None and c.pages >= LEAST_PAGES and not c.optional:
                    counted[_place(path), _digest(c.text)] = 1.0
                if barred:
                    c.link_letters, c.letters = c.link_letters + c.letters, 0
            else:
                sum_up(c, (*path, c.key), barred)
            node.letters += c.letters
            node.link_letters += c.link_letters

    sum_up(wrapper, (), False)
    return Rules(wrapper, counted)


def _measure(node: Node) -> None:
    """Letters of a page's elements, summed from the inside out; not of links, menus and the like."""
    for c in node.children:
        if c.key == "#":
            c.letters, c.link_letters = (0, len(c.text)) if c.linked else (len(c.text), 0)
        else:
            _measure(c)
        if node.name in NOT_ARTICLE or node.name == "header":
            node.link_letters += c.letters + c.link_letters
        else:
            node.letters += c.letters
            node.link_letters += c.link_letters


def _mean(node: Node, twin: Node | None) -> float:
    """Letters of an element: their mean over the host's pages that have it, else its own."""
    return twin.letters / twin.pages if twin and twin.pages else float(node.letters)


def _twins(node: Node, twin: Node | None) -> dict[int, Node]:
    """The wrapper's elements that a page's children match, by place; repeats match the same one again."""
    if twin is None:
        return {}
    found = {i: twin.children[j] for i, j in matches(node.children, twin.children)}
    last: dict[str, Node] = {}
    for i, c in enumerate(node.children):
        if i in found:
            last[c.key] = found[i]
        else:
            again = last.get(c.key)
            if again is not None and again.repeated and likeness(c, again):
                found[i] = again
    return found


def extract(page: str | None, found: Rules | None = None, rest: Rest | None = None) -> str:
    """The article of one page.

    The page is matched with its host's wrapper; what joins set apart is known by its place from
    ``rest`` and added to an element of the wrapper if only one can be meant. From the root, the article is followed into the
    one container that holds most letters; headings beside it belong to it. Template text, lists
    of links and elements that HTML has for other ends are no part of it. Names of classes only
    break ties: a block named like a notice goes if it is small beside the page and either a
    block of its own or mostly links; a paragraph or the bulk of a page stays whatever its name.
    """
    tree = parse(page)
    _measure(tree)
    wrapper = found.wrapper if found and found.wrapper.pages else None
    whole = max(tree.letters, 1)
    kept: list[tuple[str, bool]] = []

    def twins_of(node: Node, twin: Node | None, path: tuple[str, ...]) -> dict[int, Node]:
        twins = _twins(node, twin)
        if not rest:
            return twins
        alike = Counter(c.key for c in twin.children) if twin else {}
        for i, c in enumerate(node.children):
            at = (*path, c.key)
            counts = rest.get(_place(at))
            # As in a wrapper, elements with nothing in common inside are not the same.
            if not counts or (c.children and not any(_place((*at, inner.key)) in rest for inner in c.children)):
                continue
            own = twins.get(i)
            if own is None:
                own = Node(c.key, c.name, c.names, pages=0)
            elif alike[c.key] > 1:
                continue
            twins[i] = replace(
                own,
                pages=own.pages + counts[0],
                letters=own.letters + counts[1],
                link_letters=own.link_letters + counts[2],
                repeated=own.repeated or bool(counts[3]),
            )
        return twins

    def named_away(node: Node, twin: Node | None) -> bool:
        if not node.names or node.name in ("article", "main", "body", "html") or not _BOILERPLATE.search(node.names):
            return False
        if node.letters > 0.5 * whole:
            return False
        return node.name not in TEXTUAL or node.link_letters > node.letters

    def menu(node: Node, twin: Node | None) -> bool:
        if node.name in TEXTUAL or node.name == "header" or node.letters or not node.link_letters:
            return False
        many = sum(1 for _ in _slots(node)) > 1
        return many and (twin is None or twin.link_letters >= 0.8 * (twin.letters + twin.link_letters))

    def templates(path: tuple[str, ...], slot: Node, twin: Node | None) -> bool:
        share = found.template.get((_place(path), _digest(slot.text)), 0.0) if found else 0.0
        return share >= (ALWAYS if twin is not None and twin.repeated else MOSTLY)

    def take(node: Node, twin: Node | None, path: tuple[str, ...], article: bool, header: bool) -> None:
        twins = twins_of(node, twin, path)
        for i, c in enumerate(node.children):
            own = twins.get(i)
            if c.key == "#":
                if not header or (article and node.name in HEADINGS):
                    kept.append((c.text, templates(path, c, own if own is not None and own.repeated else twin)))
                continue
            if c.name in NOT_ARTICLE or named_away(c, own) or menu(c, own):
                continue
            take(c, own, (*path, c.key), article or c.name == "article", header or c.name == "header")

    def shown(node: Node, name: str) -> list[Node]:
        out = []
        for c in node.children:
            if c.key == "#" or c.name in NOT_ARTICLE or named_away(c, None):
                continue
            out += [c] if c.name == name else shown(c, name)
        return out

    marked = shown(tree, "article") or shown(tree, "main")
    targets = {id(n) for n in marked} if any(n.letters for n in marked) else set()

    def seek(node: Node, twin: Node | None, path: tuple[str, ...]) -> None:
        """Follow the page to its article."""
        twins = twins_of(node, twin, path)
        if targets:
            for i, c in enumerate(node.children):
                if id(c) in targets:
                    take(c, twins.get(i), (*path, c.key), c.name == "article", False)
                elif c.key != "#" and c.name not in NOT_ARTICLE and not named_away(c, twins.get(i)):
                    seek(c, twins.get(i), (*path, c.key))
            return
        means = [0.0 if c.key == "#" or named_away(c, twins.get(i)) else _mean(c, twins.get(i)) for i, c in enumerate(node.children)]
        loose = sum(c.letters for c in node.children if c.key == "#")
        k = max(range(len(means)), key=means.__getitem__, default=None)
        if k is None or node.children[k].name in TEXTUAL or means[k] < 0.7 * (sum(means) + loose) or not means[k]:
            take(node, twin, path, False, node.name == "header")
            return
        for i, c in enumerate(node.children):
            if i == k:
                seek(c, twins.get(i), (*path, c.key))
            elif c.name in HEADINGS:
                take(Node("", "", children=[c]), None, path, True, False)

    seek(tree, wrapper, ())
    left = [text for text, template in kept if not template]
    # Near copies of one article over a host are not its template.
    if sum(map(len, left)) * 2 < sum(len(text) for text, _ in kept):
        left = [text for text, _ in kept]
    return " ".join(left)


def _survey(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of all pages: partial wrappers of the hosts met, rare elements, and where each page has which text."""
    wrappers: dict[str, Node] = {}
    part = 0

    def flushed() -> pd.DataFrame:
        rows = [(h, part, json.dumps(packed(w)), None, None, None) for h, w in wrappers.items()]
        wrappers.clear()
        return _typed(pd.DataFrame(rows, columns=SURVEY), [*SURVEY, *COUNTED])

    for batch in batches:
        seen: set[tuple[str, int]] = set()
        rests: dict[str, Rest] = {}
        texts = []
        for host, page, at in zip(batch["host"], batch["html"], batch["part"], strict=True):
            part = int(at)
            tree = parse(page if isinstance(page, str) else "")
            digest = _digest(_words(tree))
            if not tree.children or (host, digest) in seen:
                continue
            seen.add((host, digest))
            one = folded(tree)
            wrappers[host] = joined(wrappers[host], one, None, rests.setdefault(host, {})) if host in wrappers else one
            for place, text in {
                (_place(path), _digest(slot.text))
                for path, slot in _slots(tree)
                if not slot.linked and not any(key.partition(".")[0] in NOT_ARTICLE for key in path)
            }:
                texts.append((host, part, None, place, text, digest))
            if len(wrappers) > HOSTS_AT_ONCE:
                yield flushed()
        yield _typed(pd.DataFrame(texts, columns=SURVEY), [*SURVEY, *COUNTED])
        for host, rest in rests.items():
            if rest:
                yield _typed(_apart(host, rest), [*SURVEY, *COUNTED])
    if wrappers:
        yield flushed()


def _typed(frame: pd.DataFrame, columns: list[str]) -> pd.DataFrame:
    """A frame with these columns; what it does not have is null."""
    frame = frame.reindex(columns=columns).astype({c: object if c in ("host", "wrapper") else "Int64" for c in columns})
    return frame.assign(**{c: frame[c].where(frame[c].notna(), None) for c in ("host", "wrapper")})


def _apart(host: str, rest: Rest) -> pd.DataFrame:
    return pd.DataFrame([(host, place, *map(int, counts)) for place, counts in rest.items()], columns=["host", "place", *COUNTED])


def _merge(rows: pd.DataFrame) -> pd.DataFrame:
    wrapper, rest = None, {}
    for text in rows.sort_values(["part", "wrapper"])["wrapper"]:
        other = unpacked(json.loads(text))
        wrapper = other if wrapper is None else joined(wrapper, other, None, rest)
    first = rows.iloc[0]
    whole = pd.DataFrame({"host": [first["host"]], "part": [int(first["part"]) // FAN], "wrapper": [json.dumps(packed(wrapper))]})
    columns = ["host", "part", "wrapper", "place", *COUNTED]
    return pd.concat([_typed(frame, columns) for frame in (whole, _apart(first["host"], rest))])


def _places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The places of all elements of pages."""

    def walk(node: Node, path: tuple[str, ...]) -> Iterator[int]:
        for c in node.children:
            yield _place((*path, c.key))
            yield from walk(c, (*path, c.key))

    for batch in batches:
        out = []
        for host, page, name in zip(batch["host"], batch["html"], batch["page"], strict=True):
            out += [(host, name, place) for place in set(walk(parse(page), ()))]
        yield pd.DataFrame(out, columns=["host", "page", "place"])


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    known: dict[str, Rules] = {}
    for batch in batches:
        texts = []
        for page, host, wrapper, template, apart in zip(*(batch[c] for c in ("html", "host", "wrapper", "template", "apart")), strict=True):
            if host not in known:
                if len(known) > HOSTS_AT_ONCE:
                    known.clear()
                node = unpacked(json.loads(wrapper)) if isinstance(wrapper, str) else Node("", "", pages=0)
                counted = {(int(p), int(t)): float(s) for p, t, s in json.loads(template)} if isinstance(template, str) else {}
                known[host] = rules(node, counted)
            rest = {int(row[0]): [int(x) for x in row[1:]] for row in json.loads(apart)} if isinstance(apart, str) else None
            texts.append(extract(page if isinstance(page, str) else "", known[host], rest))
        yield batch[["page_id", "url"]].assign(text=texts)


def host_rules(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(host, wrapper, template) and (host, place, counts) of all pages (host, html).

    A task joins the pages it reads into one partial wrapper a host; rounds merge at most FAN
    parts of a host in a task, so a host of very many pages is no group of its own. What a join
    finds rare is counted by its place, summed over all tasks and rounds. A text is template text
    of a place when enough different pages of the host that have the place have it there.
    """
    counts = "place long, pages long, letters long, link_letters long, repeated long"
    schema = "host string, part int, wrapper string, place long, text long, page long, pages long, letters long, link_letters long, repeated long"
    survey = staged(rows.select("host", "html", F.spark_partition_id().alias("part")).mapInPandas(_survey, schema), "survey")
    parts = survey.where("wrapper IS NOT NULL").select("host", "part", "wrapper")
    last = parts.agg(F.max("part")).first()[0] or 0
    apart = survey.where("pages IS NOT NULL").select("host", "place", *COUNTED)
    while True:
        group = [F.col("host"), F.floor(F.col("part") / FAN).alias("round")]
        merged = staged(parts.groupBy(*group).applyInPandas(_merge, f"host string, part int, wrapper string, {counts}"), "wrappers")
        parts = merged.where("wrapper IS NOT NULL").select("host", "part", "wrapper")
        apart = apart.union(merged.where("pages IS NOT NULL").select("host", "place", *COUNTED))
        if last < FAN:
            break
        last //= FAN
    sums = [F.sum(c).alias(c) for c in COUNTED[:3]] + [F.max("repeated").alias("repeated")]
    apart = staged(apart.groupBy("host", "place").agg(*sums), "rare_places")
    seen = survey.where("text IS NOT NULL").select("host", "place", "text", "page").distinct()
    often = seen.groupBy("host", "place", "text").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_PAGES)
    pages = survey.where("text IS NOT NULL").select("host", "place", "page").distinct().groupBy("host", "place").agg(F.count(F.lit(1)).alias("of"))
    shares = often.join(pages, ["host", "place"]).where(F.col("n") >= MOSTLY * F.col("of"))
    one = F.array(F.col("place").cast("string"), F.col("text").cast("string"), (F.col("n") / F.col("of")).cast("string"))
    template = shares.groupBy("host").agg(F.to_json(F.collect_list(one)).alias("template"))
    return staged(parts.select("host", "wrapper").join(template, "host", "left"), "host_rules"), apart


def _small(df: DataFrame, size: Column) -> DataFrame:
    return F.broadcast(df) if (df.agg(F.sum(size)).first()[0] or 0) <= BROADCAST_BYTES else df


def _with_rare(rows: DataFrame, apart: DataFrame) -> DataFrame:
    """``rows`` with what is known of their rare elements as ``apart``; null where a page has none.

    Only pages of hosts with rare elements are read for it, and only pages that have some get a row.
    """
    if apart.isEmpty():
        return rows.withColumn("apart", F.lit(None).cast("string"))
    named = rows.withColumn("page", F.sha2(F.col("html"), 256))
    hosts = staged(apart.select("host").distinct(), "rare_hosts")
    wanted = named.where("html IS NOT NULL").select("host", "html", "page").join(_small(hosts, F.length("host") + 16), "host", "left_semi")
    places = wanted.mapInPandas(_places, "host string, page string, place long")
    found = places.join(_small(apart, F.length("host") + 48), ["host", "place"]).distinct()
    one = F.array(*[F.col(c).cast("string") for c in ("place", *COUNTED)])
    given = staged(found.groupBy("host", "page").agg(F.to_json(F.collect_list(one)).alias("apart")), "rare_given")
    return named.join(_small(given, F.length("apart") + F.length("host") + 80), ["host", "page"], "left")


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every page.

    A null or empty page has the empty text; a null url is a host of its own; repeated rows are
    all extracted and count once for their wrapper; an empty table gives an empty result; other
    columns are not used. Equal pages of a host have equal texts.
    """
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[^/?#]*//([^/?#]*)", 1)), F.lit(""))
    rows = pages.select(F.col("page_id").cast("string").alias("page_id"), "url", "html", host.alias("host"))
    found, apart = host_rules(rows)
    found = _small(found, F.length("wrapper") + F.coalesce(F.length("template"), F.lit(0)))
    judged = _with_rare(rows, apart).join(found, "host", "left").select("page_id", "url", "html", "host", "wrapper", "template", "apart")
    texts = judged.mapInPandas(_extract, "page_id string, url string, text string")
    return texts.select(F.col("page_id").cast("long").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))
