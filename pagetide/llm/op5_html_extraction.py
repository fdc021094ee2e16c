"""Main text of web pages by wrappers learnt from the pages of each host.

The DOM trees of a host's pages are aligned by simple tree matching: two nodes match
if their signatures (tag and class words) do, and their children are paired in order
so that as many nodes as possible match. The aligned tree is the host's template.
It counts for every node its pages, the text below, the text inside links, and how
often the text differed. Nodes whose text stays the same belong to the template.
The slots are the varying children of the lowest node that covers all varying text
outside of menus, notices and the like; an article or main element is one as a whole.
A container whose class, role or id names a box as a whole (comments, adverts, related
links) is none of it, however it varies; of other nodes class and role tell menus and
the like, within a slot for those alone whose own text the template does not see varying.
A form round most of the page is a frame, and a header with a first-level heading in the
content is content. A place beside the text is no slot next to a larger one.
Each page's text is what it has there, and what else it has that the template does
not know as text that stays the same.

Templates are merged within each task first, so a host sends one template per task,
however many pages it has, and are then merged by host. A template forgets its
rarest nodes beyond ``NODES``, so its size is bounded; that they vary stays known of
their parents, and text is never left out for what was forgotten. All pages take part
in learning; a node that only copies of one page have is not taken as the template's.

Results for unusual input: null and empty pages, and pages without content, give
empty text; a page of which the host's template leaves nothing is taken as its own
template; a null or unusual address is a host like any other; very long pages are
read whole; rows that repeat an id give a row each; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import html as entities
import json
import re
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Nodes a template keeps, and levels of a tree; what lies deeper is read as siblings.
NODES, DEPTH = 400, 150
#: Children of one node up to which those of one signature are kept apart.
MANY = 64

# Fixed values of HTML: void and raw-text elements, elements that end a paragraph,
# elements inside a line of text, and elements that never hold the article's text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
NEVER = frozenset(
    "nav footer aside form menu dialog button select option input label fieldset head object embed audio video canvas map".split()
) | RAW
NEVER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner menu nav navbar "
    "navigation breadcrumb breadcrumbs sidebar widget widgets related recommended share sharing social cookie cookies "
    "consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login comment comments "
    "reply replies respond disqus footer masthead toolbar pagination pager copyright legal skip hidden complementary "
    "contentinfo search".split()
)
#: Words that say nothing of what a node is, beside one that does.
NEUTRAL = frozenset(
    "list box area section block wrap wrapper container item items thread inner outer holder module panel unit slot top bottom "
    "left right main site page user users reader readers post posts article articles link links bar button buttons group "
    "title body content text header global inline media news story stories row col column columns s".split()
)
#: Words of a place beside the text; what is named so is no slot next to a larger one.
SIDE = frozenset("left right side rail margin extra secondary".split())
#: Elements that hold others; what they are named holds for all that is in them.
BOXES = frozenset("div section ul ol dl li table aside center figure".split())
#: How a node is barred: by its class or role, or whatever the template says.
NAMED, NEVER_IS = 1, 2
#: Elements that are content as a whole.
WHOLE = ("article", "main")
#: Elements that hold a page, and the root.
PAGE = ("", "html", "body")
#: Elements closed by the start of another of their kind.
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
FENCES = frozenset("ul ol dl table select body html article section div main".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_NAMES = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NONE = re.compile(r"display\s*:\s*none", re.I)
_WORD = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("tag", "words", "named", "unseen", "frame", "kids")

    def __init__(self, tag: str, words: frozenset[str] = frozenset(), named: int = 0, unseen: bool = False):
        self.tag, self.words, self.named, self.unseen = tag, words, named, unseen
        #: A form round most of the page, or a header with the heading of the page.
        self.frame = False
        self.kids: list[Node | str] = []

    @property
    def sign(self) -> str:
        return " ".join([self.tag, *sorted(self.words)])

    def barred(self, inside: bool) -> int:
        """Whether the node never holds content (``NEVER_IS``), or its class or role says
        so (``NAMED``), which the host's template may overrule; a header does within an article.

        A container that is named as a whole, a box of comments, adverts or links, never
        holds content, however its text varies; headings and prose may by variation."""
        if self.unseen or self.tag in NEVER and not self.frame:
            return NEVER_IS
        if self.tag == "header" and not inside:
            return NAMED if self.frame else NEVER_IS
        if self.tag in ("html", "body", "main") or self.tag == "article" and not inside:
            return 0
        return NEVER_IS if self.named & NEVER_IS and self.tag in BOXES else self.named & NAMED


def _names(names: str) -> tuple[frozenset[str], int]:
    """Words of class, id and role, and what they say, as bits: ``NEVER_IS`` where all words
    of one name are of ``NEVER_WORDS`` or say nothing, ``NAMED`` where half of those of a
    class or role are. An id says nothing of headings, which are named by their text."""
    words: set[str] = set()
    named = 0
    for kind, *values in _NAMES.findall(names):
        for name in "".join(values).lower().split():
            found = _WORD.findall(name)
            words.update(found)
            never = sum(w in NEVER_WORDS for w in found)
            if never and all(w in NEVER_WORDS or w in NEUTRAL for w in found):
                named |= NEVER_IS
            if found and kind.lower() != "id" and 2 * never >= len(found):
                named |= NAMED
    return frozenset(words), named


def _hidden(attributes: str) -> bool:
    """Whether the element is not shown: by its attributes' names, not by their texts."""
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).strip().lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and _NONE.search(value):
            return True
    return False


def _mark_frames(root: Node) -> None:
    """Marks forms that hold more than half of the page's text, and headers that hold a
    heading of the first level."""
    marked: list[tuple[Node, int]] = []

    def measure(node: Node) -> tuple[int, bool]:
        if node.tag in RAW or node.tag == "head":
            return 0, False
        size, heading = 0, node.tag == "h1"
        for kid in node.kids:
            if isinstance(kid, str):
                size += len("".join(kid.split()))
            else:
                more, found = measure(kid)
                size, heading = size + more, heading or found
        if node.tag == "form":
            marked.append((node, size))
        elif node.tag == "header":
            node.frame = heading
        return size, heading

    total, _ = measure(root)
    for node, size in marked:
        node.frame = 2 * size > total


def parse(page: str) -> Node:
    """The page's tree; missing end tags are implied as browsers do for common elements."""
    root = Node("")
    stack, at = [root], 0
    scan = _TOKEN.scanner(page)
    while token := scan.search():
        if token.start() > at:
            stack[-1].kids.append(page[at : token.start()])
        at = token.end()
        if token[2] is None:
            continue
        tag = token[2].lower()
        if token[1]:
            _close(stack, tag)
            continue
        if tag in BLOCKS:
            _close(stack, "p", FENCES | {"li", "td", "th", "blockquote"})
        for same in SIBLINGS.get(tag, ()):
            _close(stack, same, FENCES - {"div", "section"})
        names = token[3]
        words, named = _names(names) if "=" in names else (frozenset(), 0)
        unseen = bool(names) and _hidden(names)
        if unseen:
            words |= {"hidden"}
        node = Node(tag, words, named, unseen)
        stack[-1].kids.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            scan = _TOKEN.scanner(page, at)
        elif tag not in VOID and not names.rstrip().endswith("/") and len(stack) < DEPTH:
            stack.append(node)
    if at < len(page):
        stack[-1].kids.append(page[at:])
    _mark_frames(root)
    return root


def _close(stack: list[Node], tag: str, fences: frozenset[str] | set[str] = frozenset()) -> None:
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag == tag:
            del stack[i:]
            return
        if stack[i].tag in fences:
            return


# A template node is a list: signature, pages, chars, chars in links, hash of the first
# page's text, pages whose text differed, barred, children, hash of the first page,
# whether a page that is no copy of it has the node, whether children were forgotten.
SIGN, PAGES, CHARS, LINKS, FIRST, VARIED, BARRED, KIDS, PAGE_HASH, SHARED, FORGOT = range(11)


def outline(page: Node) -> list:
    """A page's tree as a template, which knows copies by the text of what is not barred."""
    template = _outline(page, False)
    whole = zlib.crc32(repr([n[FIRST] for n in _walk(template, NEVER_IS) if not n[BARRED]]).encode())
    for node in _walk(template):
        node[PAGE_HASH] = whole
    return template


def _outline(node: Node, inside: bool) -> list:
    """The node as a template: neighbours of one signature are one node."""
    own = "".join(k for k in node.kids if isinstance(k, str)).split()
    text = " ".join(own)
    inside = inside or node.tag in WHOLE
    kids: list[list] = []
    for kid in node.kids:
        if isinstance(kid, Node) and kid.tag not in VOID:
            sub = _outline(kid, inside)
            if kids and kids[-1][SIGN] == sub[SIGN]:
                _join(kids[-1], sub, same_page=True)
            else:
                kids.append(sub)
    if len(kids) > MANY:
        kids = _folded(kids, same_page=True)
    chars = len(text)
    return [node.sign, 1, chars, chars if node.tag == "a" else 0, zlib.crc32(text.encode()), 0, node.barred(inside), kids, 0, False, False]


def _join(a: list, b: list, same_page: bool = False) -> list:
    """``b`` aligned with ``a`` of equal signature, and added to it."""
    if same_page:
        a[FIRST] = zlib.crc32(b"%d %d" % (a[FIRST], b[FIRST]))
    else:
        a[VARIED] += b[VARIED] if b[FIRST] == a[FIRST] else b[PAGES]
        a[PAGES] += b[PAGES]
        a[SHARED] = a[SHARED] or b[SHARED] or a[PAGE_HASH] != b[PAGE_HASH]
        a[FORGOT] = a[FORGOT] or b[FORGOT]
    a[CHARS] += b[CHARS]
    a[LINKS] += b[LINKS]
    a[BARRED] = min(a[BARRED], b[BARRED])
    kids, at = [], 0
    for i, j in _pairs(a[KIDS], b[KIDS]):
        while at < i:
            kids.append(a[KIDS][at])
            at += 1
        if isinstance(j, tuple):
            kids.append(b[KIDS][j[0]])
        else:
            kids.append(_join(a[KIDS][at], b[KIDS][j], same_page))
            at += 1
    kids += a[KIDS][at:]
    a[KIDS] = _folded(kids, same_page) if len(kids) > 2 * MANY else kids
    return a


def _folded(kids: list[list], same_page: bool) -> list[list]:
    """Children with those of one signature as one node, at its first place. Rules hold by
    signature anyway; so a list of any length has as many nodes as kinds of children."""
    first: dict[str, list] = {}
    for kid in kids:
        if kid[SIGN] in first:
            _join(first[kid[SIGN]], kid, same_page)
        else:
            first[kid[SIGN]] = kid
    return list(first.values())


def _pairs(a: list[list], b: list[list]) -> list[tuple]:
    """Simple tree matching of two rows of children, which are ``MANY`` at most or of
    different signatures.

    ``(i, j)`` pairs a's child i with b's child j; ``(i, (j,))`` puts b's child j,
    which has no partner, before a's child i. Rows of equal signatures are paired as they are.
    """
    if [k[SIGN] for k in a] == [k[SIGN] for k in b]:
        return [(i, i) for i in range(len(a))]
    n, m = len(a), len(b)
    if n * m > MANY * MANY * 16:  # of thousands of kinds of children: by kind, in a's order
        place = {kid[SIGN]: i for i, kid in reversed(list(enumerate(a)))}
        out, at = [], 0
        for j, kid in enumerate(b):
            i = place.get(kid[SIGN], -1)
            out.append((i, j) if i >= at else (at, (j,)))
            at = i + 1 if i >= at else at
        return out
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            score = max(best[i + 1][j], best[i][j + 1])
            if a[i][SIGN] == b[j][SIGN]:
                score = max(score, best[i + 1][j + 1] + _matched(a[i], b[j]))
            best[i][j] = score
    out, i, j = [], 0, 0
    while j < m:
        if i < n and a[i][SIGN] == b[j][SIGN] and best[i][j] == best[i + 1][j + 1] + _matched(a[i], b[j]):
            out.append((i, j))
            i, j = i + 1, j + 1
        elif i < n and best[i][j] == best[i + 1][j]:
            i += 1
        else:
            out.append((i, (j,)))
            j += 1
    return out


def _matched(a: list, b: list) -> int:
    """Most nodes that two trees of equal signature can match, in order."""
    first, second = a[KIDS], b[KIDS]
    row = [0] * (len(second) + 1)
    for x in reversed(first):
        new = [0] * (len(second) + 1)
        for j in range(len(second) - 1, -1, -1):
            new[j] = max(row[j], new[j + 1])
            if x[SIGN] == second[j][SIGN]:
                new[j] = max(new[j], row[j + 1] + _matched(x, second[j]))
        row = new
    return 1 + row[0]


def merged(a: list | None, b: list) -> list:
    if a is None:
        return b
    return bounded(_join(a, b))


def bounded(template: list) -> list:
    """The template without its rarest nodes, if it has too many; of nodes equally rare
    the lower ones go first, and the later ones of a level."""
    order = [template]
    for node in order:
        order += node[KIDS]
    if len(order) > 2 * NODES:
        kept = {id(n) for n in sorted(order, key=lambda n: -n[PAGES])[:NODES]}
        _forget(template, kept)
    return template


def _forget(node: list, kept: set[int]) -> None:
    """A forgotten node's text counts as its parent's, varying if it varies."""
    kids = []
    for kid in node[KIDS]:
        _forget(kid, kept)
        if id(kid) in kept:
            kids.append(kid)
            continue
        node[FORGOT] = True
        if not kid[BARRED] and (text := _own(kid)) > 0:
            if not _own(node):  # the parent's own text is the same on all pages
                node[CHARS] = node[LINKS]
            node[CHARS] += text
            node[VARIED] = max(node[VARIED], 1)
    node[KIDS] = kids


def _walk(node: list, barred: int | None = None) -> Iterator[list]:
    """The node and all below it, but for those barred so."""
    waiting = [node]
    while waiting:
        node = waiting.pop()
        yield node
        waiting += [k for k in node[KIDS] if k[BARRED] != barred] if barred else node[KIDS]


def _masses(template: list) -> dict[int, int]:
    """Varying text outside of links, by node, with all that is below it."""
    masses: dict[int, int] = {}

    def mass(node: list) -> int:
        total = 0
        if not node[BARRED]:
            total = _own(node) + sum(map(mass, node[KIDS]))
        masses[id(node)] = total
        return total

    mass(template)
    return masses


def _own(node: list) -> int:
    varies = not node[SHARED] or node[VARIED] > 0
    return (node[CHARS] - node[LINKS]) * varies


def _tag(sign: str) -> str:
    return sign.split(" ", 1)[0]


def _slots(template: list, masses: dict[int, int]) -> list[tuple[list, list[str]]]:
    """The nodes that hold the host's content, each with its path from the root.

    The lowest node that covers all varying text is one slot if it is an article or
    main element or holds blocks of text itself; else its varying children are slots.
    """
    node, path = template, [template[SIGN]]
    while _tag(node[SIGN]) not in WHOLE:
        kids = [k for k in node[KIDS] if masses.get(id(k), 0) > 0]
        if len(kids) != 1 or not _holds(kids[0]) or _own(node) > 0:
            break
        node = kids[0]
        path.append(node[SIGN])
    kids = [k for k in node[KIDS] if masses.get(id(k), 0) > 0]
    if _tag(node[SIGN]) in WHOLE or _tag(node[SIGN]) not in PAGE and not _frames(node) and (_own(node) > 0 or not all(map(_holds, kids))):
        return [(node, path)]
    out: list[tuple[list, list[str]]] = []
    waiting = [(k, [*path, k[SIGN]]) for k in reversed(kids)]
    while waiting:
        node, path = waiting.pop()
        if _tag(node[SIGN]) in PAGE or _frames(node):
            waiting += [(k, [*path, k[SIGN]]) for k in reversed(node[KIDS]) if masses.get(id(k), 0) > 0]
        else:
            out.append((node, path))
    return out


def _beside(found: list[tuple[list, list[str]]], masses: dict[int, int]) -> set[int]:
    """Slots named for a place beside the text, next to a larger one."""
    largest = max((masses[id(node)] for node, _ in found), default=0)
    return {id(n) for n, _ in found if 2 * masses[id(n)] < largest and SIDE & set(n[SIGN].split()[1:])}


def _frames(node: list) -> bool:
    """Whether an article or main element is below the node, which is none itself."""
    return _tag(node[SIGN]) not in WHOLE and any(_tag(n[SIGN]) in WHOLE for n in _walk(node, NEVER_IS))


def slot(template: list) -> list[str]:
    """Signatures from the root down to the slot with most of the varying text."""
    masses = _masses(template)
    found = _slots(template, masses)
    return max(found, key=lambda s: masses[id(s[0])])[1] if found else [template[SIGN]]


#: What a wrapper says of a node: nothing, the same on all pages, a slot, content
#: whatever its class or role.
OPEN, SAME, SLOT, CONTENT = range(4)


def _varies(node: list) -> bool:
    """Whether text of the node outside of links, on pages that are no copies, varies."""
    return node[SHARED] and any(_own(n) > 0 for n in _walk(node, NEVER_IS))


def wrapper(template: list, alone: bool = False) -> dict | None:
    """What the host's template says of its nodes, by signature: a kind and the rules
    of the nodes below. None if no text varies or all are copies. Nodes without rule are content.

    ``alone`` is a page's own template, which cannot tell what is the same on others:
    articles and main elements stand for the page if they hold most of its text.
    """
    masses = _masses(template)
    if not masses[id(template)] or not (alone or template[SHARED]):
        return None  # each page is taken as its own template
    found = _slots(template, masses)
    beside = _beside(found, masses)
    slots = {id(node) for node, _ in found} - beside
    whole = sum(masses[id(node)] for node, _ in found if _tag(node[SIGN]) in WHOLE)
    alone = alone and 2 * whole > masses[id(template)]

    def rules(node: list, inside: bool) -> dict:
        out: dict[str, list] = {}
        below = inside and (_tag(node[SIGN]) in WHOLE or id(node) not in slots)
        for kid in node[KIDS]:
            heading = alone and _tag(kid[SIGN]) == "header"
            if kid[BARRED] == NEVER_IS or kid[BARRED] and not (inside and (heading or _varies(kid))):
                continue
            if id(kid) in beside:
                rule = [SAME, {}]
            elif kid[BARRED]:
                rule = [CONTENT, rules(kid, True)]
            elif alone and not inside and not _frames(kid) and _tag(kid[SIGN]) not in WHOLE:
                rule = [SAME, {}]
            elif _tag(kid[SIGN]) in WHOLE or id(kid) in slots:
                rule = [SLOT, rules(kid, True)]
            elif not below and not masses[id(kid)] and (not inside or _holds(kid)) and not _keeps(kid) and not _lost(node, kid):
                rule = [SAME, {}]
            else:
                rule = [OPEN, rules(kid, inside)]
            _add_rule(out, kid[SIGN], rule)
        return {sign: rule for sign, rule in out.items() if rule[0] or rule[1]}

    return rules(template, False)


def _add_rule(rules: dict, sign: str, rule: list) -> None:
    """Of neighbours of one signature, what holds for some of them is kept for all."""
    if sign not in rules:
        rules[sign] = rule
        return
    old = rules[sign]
    old[0] = max(old[0], rule[0]) if SAME not in (old[0], rule[0]) else SAME if old[0] == rule[0] else old[0] + rule[0] - SAME
    for below, more in rule[1].items():
        _add_rule(old[1], below, more)


def _lost(node: list, kid: list) -> bool:
    """Whether text of the kid may have been forgotten, so that it only seems the same."""
    return node[FORGOT] and kid[PAGES] < node[PAGES] or any(n[FORGOT] and n[VARIED] for n in _walk(kid))


def _keeps(node: list) -> bool:
    """Whether an article or main element is below the node, or content by its variation."""
    return any(_tag(n[SIGN]) in WHOLE or n[BARRED] == NAMED and _varies(n) for n in _walk(node, NEVER_IS))


def _holds(node: list) -> bool:
    return node[SIGN].split()[0] in BLOCKS - {"p", "li", "td", "th", "tr", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "dl", "pre", "blockquote"}


def _text(root: Node, rules: dict) -> str:
    """Blocks of the page in order, one a line, without what the rules leave out."""
    blocks: list[str] = []
    line: list[str] = []

    def cut() -> None:
        text = " ".join(entities.unescape("".join(line)).split())
        if text:
            blocks.append(text)
        line.clear()

    waiting: list = [(root, rules, False)]
    while waiting:
        item, below, inside = waiting.pop()
        if item is None:
            cut()
        elif isinstance(item, str):
            line.append(item)
        elif item.tag == "br":
            line.append(" ")
        else:
            kind, own = (OPEN, below) if item is root else below.get(item.sign, (OPEN, {}))
            barred = item.barred(inside)
            if kind == SAME or barred == NEVER_IS or barred and kind != CONTENT:
                continue
            inside = inside or item.tag in WHOLE
            block = item.tag in BLOCKS
            if block:
                cut()
                waiting.append((None, {}, inside))
            waiting += [(kid, own, inside) for kid in reversed(item.kids)]
    cut()
    return "\n".join(blocks)


def extract(page: str | None, rules: dict | None) -> str:
    if not page:
        return ""
    root = parse(page)
    if rules is not None and (text := _text(root, rules)):
        return text
    rules = wrapper(outline(root), alone=True)
    return rules and _text(root, rules) or _text(root, {}) or _text(_unnamed(root), {})


def _unnamed(root: Node) -> Node:
    """The page without what its classes say, where they leave no text at all."""
    waiting = [root]
    while waiting:
        node = waiting.pop()
        node.named = 0
        waiting += [k for k in node.kids if isinstance(k, Node)]
    return root


def _host(url: str | None) -> str:
    return re.sub(r"^[a-z][a-z0-9+.-]*://|^//", "", (url or "").lower()).split("/")[0].split("?")[0].split("#")[0]


def _learn(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each host's template over the pages of one task."""
    templates: dict[str, list] = {}
    for batch in batches:
        for url, page in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist()):
            if page:
                host = _host(url)
                templates[host] = merged(templates.get(host), outline(parse(page)))
        if len(templates) > 2000:
            yield _templates(templates)
            templates = {}
    yield _templates(templates)


def _templates(templates: dict[str, list]) -> pa.RecordBatch:
    rows = [json.dumps(t) for t in templates.values()]
    return pa.record_batch([pa.array(list(templates), pa.string()), pa.array(rows, pa.string())], ["host", "template"])


def _merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One wrapper per host; the partition holds all of a host's templates, in order."""
    host, template = None, None
    for batch in batches:
        hosts, found = [], []
        for name, row in zip(batch.column("host").to_pylist(), batch.column("template").to_pylist()):
            if template is not None and name != host:
                hosts.append(host)
                found.append(json.dumps(wrapper(template)))
                template = None
            host, template = name, merged(template, json.loads(row))
        if hosts:
            yield pa.record_batch([pa.array(hosts), pa.array(found)], ["host", "rules"])
    if template is not None:
        yield pa.record_batch([pa.array([host]), pa.array([json.dumps(wrapper(template))])], ["host", "rules"])


def _extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, rules = None, None  # pages of a host mostly come together
    for batch in batches:
        texts = []
        for page, row in zip(batch.column("html").to_pylist(), batch.column("rules").to_pylist()):
            if row != last:
                last, rules = row, json.loads(row) if row else None
            texts.append(extract(page, rules))
        sizes = pa.array([len(t) for t in texts], pa.int64())
        columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), sizes]
        yield pa.record_batch(columns, ["page_id", "url", "text", "n_chars"])


def page_hosts(pages: DataFrame) -> DataFrame:
    """``pages`` with the host of each address, as the templates name it."""
    bare = F.regexp_replace(F.lower(F.coalesce(F.col("url"), F.lit(""))), r"^[a-z][a-z0-9+.-]*://|^//", "")
    return pages.withColumn("host", F.regexp_extract(bare, r"^[^/?#]*", 0))


def wrappers(pages: DataFrame) -> DataFrame:
    """Each host's wrapper, from all its pages: ``host``, ``rules`` as JSON."""
    parts = pages.select("url", "html").mapInArrow(_learn, "host string, template string")
    sorted_ = parts.repartition("host").sortWithinPartitions("host", "template")
    return sorted_.mapInArrow(_merge, "host string, rules string")


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page its main text and that text's length."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    found = page_hosts(rows).join(wrappers(rows), "host", "left").select("page_id", "url", "html", "rules")
    kind = rows.schema["page_id"].dataType.simpleString()
    return found.mapInArrow(_extract, f"page_id {kind}, url string, text string, n_chars long")
