"""Main text of web pages by wrappers: one union-free regular expression a host, inferred from its pages."""

from __future__ import annotations

import hashlib
import html
import json
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from somnolake.llm.columnar import column, join_groups, partitions, written

# --- pages as token streams ---------------------------------------------------------------

# Element names of HTML.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu nav noscript object ol "
    "optgroup option p pre search section select summary svg table tbody td template textarea tfoot th thead title tr ul".split()
)
VOID = frozenset("hr meta link base".split())
IN_HEAD = frozenset("title noscript template".split())
# an element that an opening tag ends, and the elements it is looked for within
ENDS = {
    "li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)), "tbody": (("thead", "tbody", "tfoot"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot"), ("table",)),
}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?:script|style)\b(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?:script|style)\s*>|\Z)"
    r"|<[!?][^<>]*>"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s<>/]*)(?P<rest>(?:[^<>\"']|\"[^\"]*+\"|'[^']*+')*+|[^<>]*)(?:>|(?=<)|\Z)",
    re.DOTALL | re.IGNORECASE,
)
_LABELS = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_DIGITS = re.compile(r"\d+")

TEXT, MOST_DEEP = "#", 100


class Node:
    """A token of the expression: an element, a group of siblings that repeats, or a text slot.

    `optional`: some page lacks it; `many`: some page repeats it.  A slot keeps what its texts have
    in common: `first` is the one text of all pages unless they vary.
    """

    __slots__ = ("key", "kids", "optional", "many", "pages", "chars", "linked", "first", "lines")

    def __init__(self, key: str, kids: list | None = None):
        self.key, self.kids = key, [] if kids is None else kids
        self.optional = self.many = False
        self.pages, self.chars, self.linked, self.first, self.lines = 1, 0, 0, None, None


def _key(name: str, rest: str) -> str:
    """An element by name and labels; numbers in labels don't tell elements apart."""
    if "=" not in rest:
        return name
    labels = [f"{kind.lower()}={' '.join((a or b or c).lower().split())}" for kind, a, b, c in _LABELS.findall(rest)]
    return _DIGITS.sub("0", "|".join([name, *labels]))


def _brief(line: str) -> str:
    """What stands for a line where only equality counts."""
    return line if len(line) <= 200 else f"{line[:150]} {hashlib.sha256(line.encode('utf-8', 'surrogatepass')).hexdigest()}"


def page_tree(page: str) -> Node:
    """The page's blocks as a tree; each text slot holds (order, text).

    Blocks end where an element of BLOCKS begins or ends.  Other elements are part of the text.
    Missing end tags are supplied, stray ones ignored; what is nested deeper than MOST_DEEP
    elements belongs to the element above.
    """
    root = Node("")
    stack, names = [root], [""]
    parts, linked, in_link, order, at = [], 0, 0, 0, 0
    deeper: dict[str, int] = defaultdict(int)

    def end_line() -> None:
        nonlocal linked, order
        if parts:
            line = " ".join("".join(parts).split())
            parts.clear()
            if line:
                slot = Node(TEXT)
                slot.chars, slot.linked, slot.first, slot.lines = len(line), min(linked, len(line)), line[:200], [(order, line)]
                stack[-1].kids.append(slot)
                order += 1
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            text = html.unescape(text) if "&" in text else text
            parts.append(text)
            linked += len(text) if in_link else 0

    def leave(depth: int) -> None:
        del stack[depth:], names[depth:]

    for token in _TOKEN.finditer(page):
        add(page[at:token.start()])
        at = token.end()
        name = token["name"]
        if name is None:
            continue
        name = name.lower()
        if name not in BLOCKS and name not in VOID:
            if name == "br":
                parts.append(" ")
            elif name == "a":
                in_link = 0 if token["end"] else 1
            continue
        end_line()
        if token["end"]:
            in_link = 0
            if deeper[name]:
                deeper[name] -= 1
            elif name in names:
                leave(len(names) - 1 - names[::-1].index(name))
            continue
        if "head" in names and name not in IN_HEAD and name not in VOID:
            leave(names.index("head"))
        if "p" in names and name not in ("option", "button"):
            leave(len(names) - 1 - names[::-1].index("p"))
        if name in ENDS:
            ended, within = ENDS[name]
            for depth in range(len(names) - 1, 0, -1):
                if names[depth] in within:
                    break
                if names[depth] in ended:
                    leave(depth)
                    break
        if name in VOID or token["rest"].endswith("/") and name in ("iframe", "svg", "object"):
            continue
        if len(stack) > MOST_DEEP:
            deeper[name] += 1
            continue
        node = Node(_key(name, token["rest"]))
        stack[-1].kids.append(node)
        stack.append(node)
        names.append(name)
    add(page[at:])
    end_line()
    return root


# --- inference ----------------------------------------------------------------------------


def _absorb(one: Node, other: Node, same_page: bool = False) -> None:
    """Make `one` the expression of both, which have the same key."""
    one.many |= other.many
    one.optional |= other.optional
    one.pages = max(one.pages, other.pages) if same_page else one.pages + other.pages
    one.chars += other.chars
    one.linked += other.linked
    if one.first != other.first:
        one.first = None
    if one.lines is not None and other.lines is not None:
        one.lines += other.lines
    if one.kids or other.kids:
        one.kids = _aligned(one.kids, other.kids)


def _group_key(nodes: list[Node]) -> str:
    return "(" + " ".join(node.key for node in nodes) + ")"


def folded(node: Node, widest: int = 4) -> Node:
    """Repeats among the children become groups: X X X is X+, X Y X Y is (X Y)+."""
    for kid in node.kids:
        folded(kid, widest)
    out: list[Node] = []
    for kid in node.kids:
        if out and out[-1].key == kid.key:
            _absorb(out[-1], kid, same_page=True)
            out[-1].many = True
        else:
            out.append(kid)
    node.kids = _tandem(out, widest)
    return node


def _tandem(nodes: list[Node], widest: int) -> list[Node]:
    keys, out, at = [node.key for node in nodes], [], 0
    while at < len(nodes):
        for width in range(2, widest + 1):
            unit = keys[at:at + width]
            if len(unit) == width and unit == keys[at + width:at + 2 * width]:
                group = Node(_group_key(nodes[at:at + width]), nodes[at:at + width])
                at += width
                while keys[at:at + width] == unit:
                    for one, other in zip(group.kids, nodes[at:at + width], strict=True):
                        _absorb(one, other, same_page=True)
                    at += width
                group.many = True
                out.append(group)
                break
        else:
            out.append(nodes[at])
            at += 1
    return out


def _with_groups(nodes: list[Node], others: list[Node]) -> list[Node]:
    """Single rounds of the groups that `others` has become groups here too."""
    groups = {node.key: len(node.kids) for node in others if node.key.startswith("(")}
    if not groups:
        return nodes
    out, at = [], 0
    while at < len(nodes):
        for key, width in groups.items():
            part = nodes[at:at + width]
            if len(part) == width and part[0].key[0] != "(" and _group_key(part) == key:
                if out and out[-1].key == key:
                    _absorb(out[-1], Node(key, part), same_page=True)
                    out[-1].many = True
                else:
                    out.append(Node(key, part))
                at += width
                break
        else:
            out.append(nodes[at])
            at += 1
    return out


def _steps(xs: list[Node], ys: list[Node]) -> Iterator[tuple[Node | None, Node | None]]:
    """Both token lists side by side: equal tokens in one step, a mismatch by skipping.

    At a mismatch the nearer match decides which list has a token that the other lacks.
    """
    places: tuple[dict[str, list[int]], dict[str, list[int]]] = ({}, {})
    for place, nodes in zip(places, (xs, ys), strict=True):
        for at, node in enumerate(nodes):
            place.setdefault(node.key, []).append(at)

    def ahead(which: int, key: str, at: int) -> float:
        found = places[which].get(key, ())
        k = bisect_left(found, at)
        return found[k] - at if k < len(found) else float("inf")

    i = j = 0
    while i < len(xs) and j < len(ys):
        if xs[i].key == ys[j].key:
            yield xs[i], ys[j]
            i, j = i + 1, j + 1
            continue
        skip_x, skip_y = ahead(0, ys[j].key, i), ahead(1, xs[i].key, j)
        if skip_x <= skip_y:
            yield xs[i], None
            i += 1
        else:
            yield None, ys[j]
            j += 1
    yield from ((x, None) for x in xs[i:])
    yield from ((None, y) for y in ys[j:])


def _aligned(xs: list[Node], ys: list[Node]) -> list[Node]:
    xs, ys = _with_groups(xs, ys), _with_groups(ys, xs)
    out: list[Node] = []
    for x, y in _steps(xs, ys):
        if x is not None and y is not None:
            _absorb(x, y)
            out.append(x)
        else:
            one = x if y is None else y
            one.optional = True
            out.append(one)
    return out


def _packed(node: Node) -> list:
    first = None if node.key != TEXT else node.first
    flags = node.optional + 2 * node.many
    return [node.key, flags, node.pages, node.chars, node.linked, first, [_packed(kid) for kid in node.kids]]


def _unpacked(data: list) -> Node:
    node = Node(data[0], [_unpacked(kid) for kid in data[6]])
    node.optional, node.many = bool(data[1] & 1), bool(data[1] & 2)
    node.pages, node.chars, node.linked, node.first = data[2:6]
    return node


def expression(node: Node) -> str:
    """The wrapper as text: tags, # for text that varies, "text" for text that doesn't, ( )+ and ( )?"""
    inner = " ".join(expression(kid) for kid in node.kids)
    if node.key == TEXT:
        told = "#" if node.first is None else json.dumps(node.first, ensure_ascii=False)
    elif node.key.startswith("(") or not node.key:
        told = inner
    else:
        told = f"<{node.key}> {inner} </>" if inner else f"<{node.key}></>"
    if node.many or node.optional:
        told = f"({told})" + {(True, False): "+", (True, True): "*", (False, True): "?"}[node.many, node.optional]
    return told


# --- which slots are the main text ----------------------------------------------------------

# Elements and labels that never hold the main text.
OUT_NAMES = frozenset(
    "head title nav aside footer form fieldset button select option optgroup textarea dialog menu search noscript template iframe object svg".split()
)
OUT_WORDS = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead banner footer sidebar aside widget complementary "
    "contentinfo ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr "
    "notice notices alert popup modal overlay newsletter subscribe subscription signup login search searchform share sharing social "
    "related recommended pagination pager comment comments commentlist disqus respond reply replies form toolbar skip".split()
)
# labels that name a part of the whole: of these elements only a label that is the whole word counts
WHOLES = frozenset("html body main article".split())
MAIN_WORDS = frozenset("article articlebody content entry post story maincontent".split())
_WORD = re.compile(r"[^a-z0-9]+")


def _role(key: str, in_article: bool) -> tuple[bool, int]:
    """(never main text, how surely it holds the article: 3 article, 2 main, 1 by label, 0 no)."""
    name, *labels = key.split("|")
    if name in OUT_NAMES or name == "header" and not in_article:
        return True, 0
    words = [word for label in labels for word in label.partition("=")[2].split()]
    parts = {part for word in words for part in (_WORD.split(word) if name not in WHOLES else [word])}
    parts |= {word.replace("-", "").replace("_", "") for word in words}
    if in_article:
        parts -= {"header", "banner"}
    out = bool(parts & OUT_WORDS)
    if out:
        return True, 0
    sure = 3 if name == "article" else 2 if name == "main" or "main" in words else 1 if parts & MAIN_WORDS else 0
    return False, sure


def _slots(node: Node, out: bool = False, sure: int = 0) -> Iterator[tuple[Node, bool, int]]:
    if node.key == TEXT:
        yield node, out, sure
        return
    if node.key and not node.key.startswith("("):
        never, own = _role(node.key, sure == 3)
        out, sure = out or never, max(sure, own)
    for kid in node.kids:
        yield from _slots(kid, out, sure)


def main_slots(wrapper: Node) -> dict[int, bool]:
    """Whether each slot of a wrapper, by id(), is main text.

    Slots in navigation, adverts, comments and the like never are.  Of the others those are that
    stand in an article, else in the main element, else in an element labelled as such.  A host
    without any of these gives its slots that aren't mostly links, without texts that several of its
    pages have in common, unless all its texts are such.
    """
    slots = list(_slots(wrapper))
    best = max((sure for _, out, sure in slots if not out), default=0)
    if best:
        return {id(slot): not out and sure == best for slot, out, sure in slots}
    some_vary = any(slot.first is None for slot, out, _ in slots if not out)

    def fixed(slot: Node) -> bool:
        return some_vary and slot.first is not None and slot.pages >= 3

    return {id(slot): not out and 2 * slot.linked <= slot.chars and not fixed(slot) for slot, out, _ in slots}


def rules_of(wrapper: Node) -> str:
    """The wrapper as extraction needs it: keys, children, and the verdict on each slot."""
    verdict = main_slots(wrapper)

    def packed(node: Node) -> list:
        return [node.key, verdict.get(id(node), False), [packed(kid) for kid in node.kids]]

    return json.dumps(packed(wrapper), ensure_ascii=False, separators=(",", ":"))


def _rules(data: list) -> Node:
    node = Node(data[0], [_rules(kid) for kid in data[2]])
    node.optional = data[1]  # of a slot: whether it is main text
    return node


def _taken(node: Node, rule: Node, lines: list, unmatched: list) -> None:
    """Collect the lines of the page's slots that match main slots of the wrapper.

    A wrapper holds the tokens of all its pages in their order, so each matches the next equal one.
    """
    at = 0
    for own in _with_groups(node.kids, rule.kids):
        k = next((k for k in range(at, len(rule.kids)) if rule.kids[k].key == own.key), None)
        if k is None:
            unmatched.append(own)
            continue
        at = k + 1
        if own.key != TEXT:
            _taken(own, rule.kids[k], lines, unmatched)
        elif rule.kids[k].optional:
            lines += own.lines


def main_text(tree: Node, wrapper: Node) -> str:
    """The lines of a folded page that its wrapper, as `rules_of` gives it, says are main text.

    Tokens that the wrapper doesn't know are judged by the page alone.
    """
    lines: list[tuple[int, str]] = []
    unmatched: list[Node] = []
    _taken(tree, wrapper, lines, unmatched)
    if unmatched:
        verdict = main_slots(tree)
        lines += [line for node in unmatched for slot, _, _ in _slots(node) if verdict.get(id(slot)) for line in slot.lines]
    return "\n".join(line for _, line in sorted(lines))


# --- tables ---------------------------------------------------------------------------------


def host_of(url: str):
    """The host in lower case; '' where there is none."""
    found = F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(F.coalesce(found, F.lit("")))


MOST_NODES = 200_000
WAYS = 256


def _size(node: Node) -> int:
    return 1 + sum(map(_size, node.kids))


def _page_wrappers(pages: DataFrame) -> DataFrame:
    """(host, way, wrapper): what a task makes of its pages of a host."""

    def run(batches):
        held: dict[str, Node] = {}
        sizes: dict[str, int] = {}
        way = TaskContext.get().partitionId() % WAYS

        def flush():
            names = list(held)
            told = [json.dumps(_packed(held[name]), ensure_ascii=False) for name in names]
            held.clear()
            sizes.clear()
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([way] * len(names), pa.int32()), pa.array(told, pa.string())], ["host", "way", "wrapper"])

        for batch in batches:
            for host, page in zip(column(batch, "host"), column(batch, "html"), strict=True):
                host, tree = host.as_py(), folded(page_tree(page.as_py() or ""))
                _drop_lines(tree)
                if host in held:
                    _absorb(held[host], tree)
                else:
                    held[host] = tree
                sizes[host] = max(sizes.get(host, 0), _size(tree))
                if sum(sizes.values()) > MOST_NODES:
                    yield flush()
        if held:
            yield flush()

    return pages.select("host", "html").mapInArrow(run, "host string, way int, wrapper string")


def _drop_lines(node: Node) -> None:
    node.lines = None
    for kid in node.kids:
        _drop_lines(kid)


def _merged(wrappers: DataFrame, keys: list[str], last: bool) -> DataFrame:
    """One wrapper for each value of `keys`; rows are met one after the other, none is kept."""

    def run(batches):
        now, held = None, None

        def told():
            text = rules_of(held) if last else json.dumps(_packed(held), ensure_ascii=False)
            row = {"host": [now[0]], "way": pa.array([now[1] if len(now) > 1 else 0], pa.int32()), "pages": [held.pages], "wrapper": [text], "expression": [expression(held) if last else None]}
            return pa.RecordBatch.from_pydict(row, schema=schema)

        schema = pa.schema([("host", pa.string()), ("way", pa.int32()), ("pages", pa.int64()), ("wrapper", pa.string()), ("expression", pa.string())])
        for batch in batches:
            for row in zip(*(column(batch, k).to_pylist() for k in keys), column(batch, "wrapper"), strict=True):
                one = _unpacked(json.loads(row[-1].as_py()))
                if row[:-1] == now:
                    _absorb(held, one)
                    continue
                if held is not None:
                    yield told()
                now, held = row[:-1], one
        if held is not None:
            yield told()

    dealt = wrappers.repartition(partitions(wrappers.sparkSession), *keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, "host string, way int, pages long, wrapper string, expression string")


def host_wrappers(pages: DataFrame) -> DataFrame:
    """(host, pages, wrapper, expression): the union-free expression of the pages of each host.

    Every page is folded into its own expression, these are aligned page by page in the tasks that
    read them, and what the tasks found is aligned twice more: within WAYS parts of the tasks, then
    by host.  So no task sees a host's pages beyond its own share.  `pages` has (host, html).
    """
    by_way = _merged(_page_wrappers(pages), ["host", "way"], last=False)
    return written(_merged(by_way, ["host"], last=True).drop("way"), "wrappers")


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of `pages`: the article of the whole html.

    Blocks are joined by one line break, white space within a block is one space, character
    references are decoded.  Null and empty html give an empty text and no characters; a page
    without a host, or a null url, belongs to the host ''; rows that repeat are each extracted;
    other columns are not read; no pages give no rows.  The wrappers of hosts with more than a
    thousandth of all pages are broadcast, so their pages don't move.
    """
    shaped = pages.select("page_id", "url", "html", host_of("url").alias("host"))
    wrappers = host_wrappers(shaped)

    def run(batches):
        known: dict[str, Node] = {}
        for batch in batches:
            found = []
            for page, rules in zip(column(batch, "html"), column(batch, "wrapper"), strict=True):
                page, rules = page.as_py(), rules.as_py()
                if rules not in known:
                    if len(known) > 200:
                        known.clear()
                    known[rules] = _rules(json.loads(rules))
                found.append(main_text(folded(page_tree(page or "")), known[rules]))
            yield pa.RecordBatch.from_arrays([
                column(batch, "page_id"), column(batch, "url"), pa.array(found, pa.string()), pa.array(list(map(len, found)), pa.int64()),
            ], ["page_id", "url", "text", "n_chars"])

    joined = join_groups(shaped, wrappers.select("host", "wrapper", "pages"), "host", "pages")
    kinds = dict(pages.dtypes)
    return joined.select("page_id", "url", "html", "wrapper").mapInArrow(
        run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    )
