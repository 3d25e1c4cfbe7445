"""Main text of web pages by tree scoring.

A page becomes a tree of elements (implied end tags as browsers do).  What is
never article is cut first: scripts, styles, forms, menus, and elements whose
tag, role, or a whole word of class or id says menu, header, footer, sidebar,
notice, advert or comment; a compound name says what its last word says, words of
kind ("-box", "-list") aside, unless it speaks of layout or state ("no-", "-open").
Readers' comments without such a name are known by their heading or by items that
can each be answered.  A form or an element so named stays if it holds a
``main``, or an ``article`` no shorter than those elsewhere, or most of the text of a
page that has no article elsewhere, with little of it in links.  Then every paragraph passes points for its length and its commas to
its ancestors, fewer with each level, and a container's points are discounted
by the share of its text inside links.  The best container is widened to the
``article`` (else ``main``) around it, its siblings that look like more of the
same are kept (within a ``main`` or ``article`` at each level up to that), and the
blocks left are the text.

Pages are independent: one pass, no shuffle, memory of one page at a time.

Defined cases: a null or empty page, or one without any text, gives ``""``;
broken markup (unclosed tags, a ``<`` in running text, an unfinished comment)
never fails; repeated rows give equal texts; an empty table gives no rows;
other columns pass through.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from hearth.llm.frames import apart

# Element names by what they mean for the text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCK = frozenset((
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol "
    "p pre section summary table tbody td tfoot th thead tr ul").split())
CUT = frozenset((
    "head script style noscript template iframe object embed svg canvas annotation annotation-xml audio "
    "video nav header footer aside form button select textarea input label fieldset dialog menu map").split())
PARAGRAPH = frozenset("p pre td blockquote li dd div section article main".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
MORE = frozenset("p pre blockquote ul ol dl table figure section article".split())
#: words that mark what isn't the article
_WORD = (r"(?:ads?|advert[a-z]*|banner|sponsor[a-z]*|promo[a-z]*|nav[a-z]*|menu[a-z]*|breadcrumbs?|header|"
         r"masthead|footer|contentinfo|side-?bar[a-z]*|complementary|widgets?|notices?|alert[a-z]*|cookies?|"
         r"consent|gdpr|popup|modal|overlay|newsletter|subscri[a-z]+|sign-?up|login|search|share|sharing|"
         r"social|comments?|commentlist|disqus|replies|respond|related|recommend[a-z]*|pagination|pager|"
         r"toolbar|skip-?link|copyright)(?![a-z0-9])")
#: what may stand before and after them (none is such a word itself); "no-", "has-", "-open" may not
_PLACE = r"(?:site|page|main|global|top|bottom|left|right|primary|secondary|sub|mobile|desktop)"
_KIND = (r"(?:slot|box|bar|list|links?|area|wrap|wrapper|container|section|block|unit|form|buttons?|icons?|"
         r"panel|inner|item|items|title|body|left|right|primary|secondary|top|bottom|thread|message|media|"
         r"posts?|articles?|stories|[0-9]+)(?![a-z0-9])")
#: a whole word of class, id or role
NOT_ARTICLE = re.compile(rf"(?:{_PLACE}[-_]+)*+{_WORD}(?:[-_]+(?:{_WORD}|{_KIND}))*+")
#: words that mark a name as such by standing last in it, whatever stands before
#: ("reader-comments", "google-ad", "js-cookie-notice"), words of kind after them aside
LAST_WORD = re.compile(
    r"(?:ads?|advert[a-z]*|sponsor(?:ed|s|ship)?|promos?|promotions?|side-?bars?|cookies?|notices?|consent|gdpr|"
    r"popups?|newsletters?|comments?|commentlist|disqus|replies|share|sharing|social|related|"
    r"recommend[a-z]*|breadcrumbs?|pagination|pager|footer|menu|navbar|navigation)")
#: likewise, but for a section of an article that only its heading or its items give away
TALK = frozenset("discussion discussions thread threads feedback responses reactions".split())
#: a name with one of these words speaks of something else's layout or state
LAYOUT = frozenset("no not non has with without hide show".split())
#: paragraph text beside which a page's talk is not its article
LEAST_TEXT = 80
KIND_WORD = re.compile(_KIND)
#: a heading over readers' comments, and a comment's link to answer it
TALK_HEADING = re.compile(r"(?:\W|\d|all|reader'?s?|user)*(?:comments?|replies|reader responses)(?:\W|\d)*|"
                          r"(?:leave|post|add|write) a (?:comment|reply)\W*|join the (?:conversation|discussion)\W*", re.I)
ANSWER = re.compile(r"\W*(?:reply|reply to .{1,40}|answer|quote|report|flag|upvote|like)\W*\d*\W*", re.I)
#: an open element of the first set ends where one of the second begins
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
        "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr", "tbody", "tfoot"},
        "th": {"td", "th", "tr", "tbody", "tfoot"}}
ITEMS = frozenset().union(*ENDS.values())
#: an implied end never reaches beyond these
SCOPE = frozenset("html body table ul ol dl article section main div td th blockquote".split())

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*>?|"
    # a value in quotes may hold ">", a stray quote may not; possessive: linear in the page
    r"<(/?)([a-zA-Z][^\s/>]*+)([^>=]*+(?:=(?:\s*+(?:\"[^\"]*+\"|'[^']*+'))?+[^>=]*+)*+)>", re.S)
#: what may still begin where no ">" follows
UNFINISHED = re.compile(r"<[!?].*\Z", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")


class Node:
    __slots__ = ("tag", "parent", "children", "attributes", "points")

    def __init__(self, tag: str, parent: "Node | None", attributes: str = ""):
        self.tag, self.parent, self.attributes = tag, parent, attributes
        self.children: list[Node | str] = []
        self.points = 0.0


def parse(page: str) -> Node:
    root = here = Node("html", None)
    at, end, last = 0, len(page), page.rfind(">")
    while at < end:
        m = (TOKEN if at <= last else UNFINISHED).search(page, at)
        if m is None:
            here.children.append(html.unescape(page[at:]))
            break
        if m.start() > at:
            here.children.append(html.unescape(page[at:m.start()]))
        at = m.end()
        if m.lastindex is None:
            continue
        tag = m[2].lower()
        if m[1]:
            here = _close(here, tag)
            continue
        if tag in ("html", "body"):
            continue
        here = _imply(here, tag)
        node = Node(tag, here, m[3])
        here.children.append(node)
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = close.end() if close else end
        elif tag not in VOID and not m[3].endswith("/"):
            here = node
        elif tag not in VOID and tag in BLOCK:
            here = node  # "/>" means nothing on such elements
    return root


def _close(here: Node, tag: str) -> Node:
    node = here
    while node is not None and node.tag != tag:
        if node.tag in ("td", "th") and tag not in ("table", "tr", "tbody", "thead", "tfoot"):
            return here
        node = node.parent
    return here if node is None or node.parent is None else node.parent


def _imply(here: Node, tag: str) -> Node:
    """Ends an open paragraph before a block, and items and cells before their like."""
    if tag in BLOCK:
        node = here
        while node is not None and node.tag not in SCOPE and node.tag != "li":
            if node.tag == "p":
                here = node.parent
                break
            node = node.parent
    node = here if tag in ITEMS else None
    while node is not None and node.parent is not None:
        if tag in ENDS.get(node.tag, ()):
            here = node.parent
            if tag in ("td", "th", "li", "dt", "dd", "option"):
                break
        elif node.tag in ("table", "ul", "ol", "dl", "select"):
            break
        node = node.parent
    return here


def _attributes(text: str) -> dict[str, str]:
    return {k.lower(): html.unescape(a or b or c) for k, a, b, c in ATTRIBUTE.findall(text)}


def _named(name: str) -> bool:
    """Whether a word of class, id or role says that its element isn't the article."""
    if NOT_ARTICLE.fullmatch(name.lower()):
        return True
    words = [w for w in re.split(r"[-_]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower()) if w]
    if LAYOUT.intersection(words):
        return False
    while len(words) > 1 and KIND_WORD.fullmatch(words[-1]) and not LAST_WORD.fullmatch(words[-1]):
        words.pop()
    return bool(words) and bool(LAST_WORD.fullmatch(words[-1]))


def _talk(node: Node, names: list[str]) -> bool:
    """Whether an element holds readers' comments: by its heading; by items that each can
    be answered; or, outside of an article, by its name alone."""
    if node.tag not in ("div", "section", "ul", "ol"):
        return False
    inner = [c for c in node.children if not isinstance(c, str)]
    head = inner[0] if inner else None
    for _ in range(3):
        if head is not None and head.tag in ("div", "header"):
            head = next((c for c in head.children if not isinstance(c, str)), None)
    if head is not None and head.tag in HEADING and TALK_HEADING.fullmatch(" ".join(_flat(head).split())):
        return True
    answered: dict[str, int] = {}
    for c in inner:
        if c.tag in ("li", "div", "section", "article") and _answered(c):
            answered[c.tag] = answered.get(c.tag, 0) + 1
    if max(answered.values(), default=0) > 1 and 2 * sum(answered.values()) > len(inner):
        return True
    if not any(TALK.intersection(re.split(r"[-_]+", n.lower())) and not LAYOUT.intersection(
            re.split(r"[-_]+", n.lower())) for n in names):
        return False
    up = node.parent
    while up is not None and up.tag != "article":
        up = up.parent
    return up is None


def _answered(item: Node) -> bool:
    """Whether an item has a link or button to answer it, within its first elements."""
    stack, seen = [item], 0
    while stack and seen < 40:
        node = stack.pop()
        seen += 1
        if node.tag in ("a", "button") and ANSWER.fullmatch(" ".join(_flat(node).split())):
            return True
        stack += [c for c in node.children if not isinstance(c, str)]
    return False


def _cut(node: Node) -> str:
    """"always", "named" (unless it holds the article), "talk" (unless there is nothing
    else), or ""."""
    if node.tag in CUT and node.tag != "form":
        return "always"
    named, names = node.tag == "form", []
    if node.attributes.strip() and node.tag not in ("html", "body"):
        found = _attributes(node.attributes)
        if ("hidden" in found or found.get("aria-hidden", "").lower() == "true"
                or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", ""), re.I)):
            return "always"
        names = " ".join(found.get(k, "") for k in ("class", "id", "role")).split()
        named = named or node.tag != "main" and any(map(_named, names))
    return "talk" if _talk(node, names) else "named" if named else ""


def prune(root: Node) -> None:
    nodes, named, stack = [], {}, [root]
    while stack:
        node = stack.pop()
        nodes.append(node)
        left: list[Node | str] = []
        for c in node.children:
            cut = "" if isinstance(c, str) else _cut(c)
            if cut == "always":
                continue
            left.append(c)
            if not isinstance(c, str):
                stack.append(c)
            if cut:
                named[c] = cut
        node.children = left
    if named:
        _prune_named(nodes, named)


def _prune_named(nodes: list[Node], named: dict[Node, str]) -> None:
    """Cuts the named elements but those that hold the article; ``nodes`` has parents first."""
    own = {n: len(" ".join(_own(n).split())) for n in nodes if n.tag in PARAGRAPH or n.tag == "form"}
    total, sure = sum(own.values()), 0  # paragraph text, and that of articles which stay anyway
    free, inside = {None: True}, {None: False}
    for n in nodes:
        free[n] = n not in named and free[n.parent]
        inside[n] = n.tag in ("article", "main") or inside[n.parent]
        sure += own.get(n, 0) if free[n] and inside[n] else 0
    # of what stays in an element: text, that in links, paragraph text, that in articles, whether a main
    held: dict[Node, tuple[int, int, int, int, bool]] = {}
    stays = set()
    for n in reversed(nodes):
        text = link = article = 0
        paragraphs, main = own.get(n, 0), False
        for c in n.children:
            if isinstance(c, str):
                text += len(c.strip())
            elif c not in named or c in stays:
                t, k, p, a, m = held[c]
                text, link, paragraphs, main = text + t, link + k, paragraphs + p, main or m or c.tag == "main"
                article += p if c.tag in ("article", "main") else a
        held[n] = text, text if n.tag == "a" else link, paragraphs, article, main
        if n in named and text and (main or link < 0.25 * text and (
                article and (n.tag == "form" or article >= sure) or not sure and (
                    2 * paragraphs > total if named[n] == "named" else total - paragraphs < LEAST_TEXT))):
            stays.add(n)
    for n in nodes:
        n.children = [c for c in n.children if isinstance(c, str) or c not in named or c in stays]


def walk(root: Node):
    """Elements in page order."""
    stack = [root]
    while stack:
        node = stack.pop()
        yield node
        stack += [c for c in reversed(node.children) if not isinstance(c, str)]


def measure(root: Node) -> dict[Node, tuple[int, int]]:
    """Per element the characters of its text, and of these in links."""
    size: dict[Node, tuple[int, int]] = {}
    for node in reversed(list(walk(root))):
        text = link = 0
        for c in node.children:
            if isinstance(c, str):
                text += len(c.strip())
            else:
                text, link = text + size[c][0], link + size[c][1]
        size[node] = (text, text if node.tag == "a" else link)
    return size


def score(root: Node) -> Node | None:
    """The container with the most points, or None."""
    size = measure(root)
    containers = []
    for node in walk(root):
        if node.tag not in PARAGRAPH:
            continue
        own = " ".join(_own(node).split())
        if not own:
            continue
        points = 1 + own.count(",") + min(len(own) / 100, 3)
        level, up = 1, node.parent
        if node.tag in ("div", "section", "article", "main"):  # text of its own: its container too
            level, up = 0, node
        while up is not None:
            if not up.points:
                containers.append(up)
            up.points += points / (1 if level < 2 else 2 if level == 2 else 3 * level)
            level, up = level + 1, up.parent
    best = None
    for node in containers:
        text, link = size[node]
        node.points *= 1 - link / text if text else 0
        if best is None or node.points > best.points:
            best = node
    return best


def _own(node: Node) -> str:
    """Its text outside of blocks in it."""
    return " ".join(c if isinstance(c, str) else "" if c.tag in BLOCK else _flat(c, BLOCK)
                    for c in node.children)


def _flat(node: Node, without: frozenset = frozenset()) -> str:
    """Text of an element, but for elements ``without`` in it."""
    out, stack = [], [node]
    while stack:  # no recursion: elements may be nested without limit
        item = stack.pop()
        if isinstance(item, str):
            out.append(item)
        elif item.tag == "br":
            out.append(" ")
        elif item.tag not in without:
            stack += reversed(item.children)
    return "".join(out)


def kept(root: Node) -> list[Node]:
    """The best container and those of its siblings that are kept, in order."""
    best = score(root)
    if best is None:
        found = [n for n in walk(root) if n.tag in ("article", "main")]
        return found[:1] or [root]
    for wide in ("article", "main"):
        up = best
        while up is not None and up.tag != wide:
            up = up.parent
        if up is not None:
            best = up
            break
    inside = [n for n in walk(best) if n.tag in ("article", "main") and n.points >= best.points / 5]
    outer = [n for n in inside if n.parent not in inside]
    start = best
    if len(outer) == 1:  # the best container holds the article and more
        best = outer[0]
    above, up = [], best.parent
    while up is not None:
        above.append(up)
        up = up.parent
    # up to the outermost main or article around it, and to the container it was found in
    wide = max((k for k, n in enumerate(above) if n.tag in ("article", "main")), default=-1)
    if best.tag == "main" and wide < 0:
        return [best]
    last = max(0, wide + (wide >= 0 and above[wide].tag == "article"),
               above.index(start) if start is not best else 0)
    size = measure(root)
    out, node = [best], best
    for k, up in enumerate(above[:last + 1]):
        # outside of main and article only what is surely of the article's kind
        strict = k > wide and (best.tag == "article" or wide >= 0)
        at = next(i for i, c in enumerate(up.children) if c is node)
        before, after = ([c for c in part if not isinstance(c, str) and _is_more(c, best, size[c], strict)]
                         for part in (up.children[:at], up.children[at + 1:]))
        out, node = before + out + after, up
    return out


def _is_more(node: Node, best: Node, size: tuple[int, int], strict: bool) -> bool:
    """Whether a sibling looks like more of the best container."""
    text, link = size
    low = link < 0.25 * text
    if strict:
        return low and (node.tag in HEADING or node.tag in ("article", "section") and node.points > 0)
    return node.points >= max(2, best.points / 5) or node.tag in HEADING or low and node.tag in MORE


def _prune_cells(best: Node) -> None:
    """Where the article is a cell of a table layout, cuts the cells of links beside it."""
    if best.tag not in ("table", "tbody", "tr"):
        return
    size = measure(best)
    for row in walk(best):
        cells = [c for c in row.children if not isinstance(c, str) and c.tag in ("td", "th")]
        most = max((size[c][0] for c in cells), default=0)
        gone = {c for c in cells if 2 * size[c][1] > size[c][0] and 5 * size[c][0] < most}
        row.children = [c for c in row.children if c not in gone]


def blocks(nodes: list[Node]) -> list[str]:
    """Texts of the blocks in page order, white space as single spaces."""
    out, held = [], []

    def end():
        if line := " ".join("".join(held).split()):
            out.append(line)
        held.clear()

    stack: list = list(reversed(nodes))
    while stack:
        item = stack.pop()
        if item is None:
            end()
        elif isinstance(item, str):
            held.append(item)
        elif item.tag == "br":
            held.append(" ")
        elif item.tag in BLOCK:
            end()
            stack.append(None)
            stack += reversed(item.children)
        else:
            stack += reversed(item.children)
    end()
    return out


def main_text(page: str | None) -> str:
    if not page:
        return ""
    root = parse(page)
    prune(root)
    found = kept(root)
    for node in found:
        _prune_cells(node)
    return "\n".join(blocks(found))


def extract_main_text(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """``pages`` with ``text_col`` in place of ``html_col`` (and of any column of that name)."""
    rest = [f for f in pages.schema.fields if f.name not in (html_col, text_col)]
    schema = T.StructType([*rest, T.StructField(text_col, T.StringType(), False)])

    def run(batches):
        for batch in batches:
            last = batch.num_columns - 1
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [main_text(p.as_py()) for p in part.column(last)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:last], pa.array(texts, pa.string())], schema.names)

    inner, _ = apart(pages, html_col)
    at = [c for c, f in zip(inner.columns, pages.schema.fields, strict=True) if f in rest]
    return inner.select(*at, html_col).mapInArrow(run, schema)
