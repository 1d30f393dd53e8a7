"""Main text of web pages by tag-path ratios.

A page's text nodes are grouped by their path of block tags from the root. For each path, the unlinked text length and the
punctuation per node are summed over the page. Both series are smoothed along the page, near nodes counting more the
closer they are in the tree, and fused by their geometric mean; a path's score is the mean over its nodes. Two thresholds
on the scores, both relative to the page's own level, select the content nodes: nodes of strong paths are content, and so
are nodes of weak paths that lie in the strong ones' container, so that headings, short paragraphs and captions stay.
The container is the lowest element around all strong nodes that isn't itself a part of a text, such as a list; it grows to
the article or main around it, and to the nearest element that begins with an h1 if it has none. In a body without one,
weak nodes count between strong nodes and as headings before them.

Elements that are menus, footers, sidebars, forms, scripts and styles by their tag or role, and hidden ones, never count.
Names in classes and ids are weights only: a named element's nodes form paths of their own with a lower score, unless it holds
the page's h1 or main or, if it isn't named after comments, an article, or most of the text of a page without any of these.
Nodes in an article or main weigh more. A table, figure, quotation or listing within one is part of it, whatever it is named.

Reader comments without such a name are known by their run: three or more siblings alike in tag and class, after other text,
each with a sign of an author or a date, or in an element named after a discussion. A footer without one is known by its
copyright line, outside articles and after other text; it goes with the element around it. Buttons within a sentence stay in it.

Defined results: a null or empty page and a page without text have an empty text; null ids and repeated rows are extracted
each; broken markup is read as browsers do in the main (missing end tags, stray end tags, unquoted values); further
columns are ignored; an empty table gives no rows. One page at a time is in memory.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*+)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>|<[!?/][^>]*>", re.DOTALL
)
_LOOSE = re.compile(r"<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*+)(?P<rest>[^>]*)>")
_ATTRIBUTE = re.compile(r"([^\s=\"'>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content isn't markup; that of a textarea is text, that of the others is never shown.
RAW = frozenset("script style textarea title noscript template iframe canvas".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr "
    "math mi mn mo ms mtext mrow mfrac msup msub msubsup msqrt mroot munder mover munderover semantics annotation svg g text tspan desc object".split()
)
#: A start tag of the key ends an open element of the value.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Elements that never hold main text.
APART = frozenset("head nav footer aside form button fieldset dialog menu audio video datalist".split())
#: Elements that are parts of a text and never the whole of one.
PARTS = frozenset("p li td th dd dt blockquote tr h1 h2 h3 h4 h5 h6 pre ul ol dl table thead tbody tfoot section figure figcaption header hgroup details".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 header hgroup".split())
#: Names of boilerplate, as words of classes and ids; those after comments first.
_COMMENTS = r"comments?|commentlist|disqus|respond|repl(?:y|ies)"
_NAMED = re.compile(
    rf"(?:^|[\s_-])(?:(?P<comments>{_COMMENTS})|ads?|adverts?|advertisements?|advertising|sponsor(?:ed|s)?|promo(?:tion)?s?|banners?|cookies?|consent|gdpr|notices?|alerts?|"
    r"newsletter|subscribe|subscription|signup|sign-up|nav|navbar|navigation|menus?|breadcrumbs?|masthead|footers?|sidebars?|side-bar|aside|widgets?|related|recommended|"
    r"shar(?:e|ing)|social|login|search|popup|modal|overlay|pager|pagination|toolbar|skip-link|site-header|page-header|topbar)(?=$|[\s_-])",
    re.IGNORECASE,
)
#: Names of elements that hold comments if what they hold is a run of alike elements, and of what signs a comment.
_TALK = re.compile(r"(?:^|[\s_-])(?:discussions?|threads?|reactions?|responses?|talk|conversations?|reviews?|feedback|guestbook|community|readers?)(?=$|[\s_-])", re.IGNORECASE)
_SIGNED = re.compile(r"(?:^|[\s_-])(?:authors?|users?|usernames?|byline|posted|posters?|avatars?|dates?|time|timestamps?|reply|said)(?=$|[\s_-])", re.IGNORECASE)
_RIGHTS = re.compile(r"^(?:©|\(c\)\s|copyright\b)|\ball rights reserved\b|\balle rechte vorbehalten\b|\btous droits réservés\b|\btodos los derechos reservados\b", re.IGNORECASE)
#: Elements that a comment is; how many of them make a run; the length up to which a line is a copyright line.
_RUN_TAGS, RUN, RIGHTS_CHARS = frozenset("div li article section tr dd".split()), 3, 300
#: Elements that are part of the article around them, and those in which a button is part of a sentence.
_OWN, _SENTENCES = frozenset("table pre figure blockquote".split()), frozenset("p li td th dd dt h1 h2 h3 h4 h5 h6 figcaption blockquote".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
_PUNCTUATION = re.compile(r"[.,;:!?…。、，！？；：]")

#: Weights of named elements and of articles; what linked text counts; what a step in the tree beyond siblings takes away.
NAMED_WEIGHT, ARTICLE_WEIGHT, LINKED, STEP = 0.02, 8.0, 0.1, 0.5
#: Thresholds of strong and weak paths, as parts of the page's level, and how far nodes smooth each other.
STRONG, WEAK, REACH = 0.5, 0.03, 2


@dataclass(eq=False)
class Element:
    tag: str
    parent: Element | None
    apart: bool
    depth: int
    named: str = ""
    weight: float = 1.0
    path: int = 0
    chars: int = 0
    content: int = 0
    holds: set[str] = field(default_factory=set)
    inside: bool = False
    kind: str = ""
    talk: bool = False
    signed: bool = False
    first: int = -1
    within: bool = False


@dataclass
class Block:
    """Text of one block: the stretch between two block-level tags."""

    element: Element
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""
    plain: bool = False


def _attributes(rest: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(rest)}


def _hidden(known: dict[str, str]) -> bool:
    return "hidden" in known or known.get("aria-hidden") == "true" or bool(_HIDDEN.search(known.get("style", "")))


def _element(tag: str, rest: str, parent: Element) -> Element:
    apart, named, kind, talk, signed = parent.apart or tag in APART, "", "", False, False
    inside = parent.inside or tag in ("article", "main")
    if tag == "header" and not apart:
        up: Element | None = parent
        while up is not None and up.tag not in ("article", "main"):
            up = up.parent
        apart = up is None
    if not apart and ("=" in rest or "hidden" in rest):
        known = _attributes(rest)
        apart = _hidden(known) or known.get("role", "").lower() in _ROLES
        kind = known.get("class", "")
        talk, signed = (bool(x.search(kind) or x.search(known.get("id", ""))) for x in (_TALK, _SIGNED))
        if tag not in ("html", "body", "article", "main") and not (inside and tag in _OWN):
            m = _NAMED.search(known.get("class", "")) or _NAMED.search(known.get("id", ""))
            named = "" if m is None else "comments" if m["comments"] else "other"
    return Element(tag, parent, apart, parent.depth + 1, named, inside=inside, kind=kind, talk=talk, signed=signed)


def blocks(page: str) -> list[Block]:
    """The page's blocks outside apart elements, in page order; character references are decoded in each stretch of text."""
    root = Element("#root", None, False, 0)
    at, open_, found, low = root, [root], [], 0
    now = Block(root)
    links = pressed = 0
    unseen: tuple[str, int] = ("", 0)  # an inline element that isn't shown, and how many of its tag are open in it
    unclosed: set[str] = set()
    last = page.rfind(">")

    def flush(element: Element) -> Block:
        if now.parts:
            now.text = " ".join("".join(now.parts).split())
            if now.text and now.plain:
                found.append(now)
        return Block(element)

    def add(text: str) -> None:
        if text and not at.apart and not unseen[1]:
            text = html.unescape(text)
            now.parts.append(text)
            now.plain |= not pressed and bool(text.strip())
            if links:
                now.linked += len(text)

    while low < len(page):
        start = page.find("<", low)
        if start < 0:
            add(page[low:])
            break
        add(page[low:start])
        if start > last and not page.startswith("<!--", start):
            add(page[start:])
            break
        m = _MARKUP.match(page, start) or _LOOSE.match(page, start)
        if m is None:
            add("<")
            low = start + 1
            continue
        low, tag = m.end(), (m["tag"] or "").lower() if "tag" in m.re.groupindex else ""
        if not tag:
            continue
        if tag == "br":
            add(" ")
        elif m["end"]:
            if tag == "button" and pressed:
                pressed = 0
                continue
            if tag in INLINE:
                if tag == "a":
                    links = max(0, links - 1)
                if tag == unseen[0]:
                    unseen = (tag, unseen[1] - 1) if unseen[1] > 1 else ("", 0)
                continue
            for k in range(len(open_) - 1, 0, -1):
                if open_[k].tag == tag:
                    at = open_[k].parent or root
                    del open_[k:]
                    now, unseen, links, pressed = flush(at), ("", 0), 0, 0
                    break
        elif tag in RAW and not m["rest"].endswith("/"):
            close = None if tag in unclosed else re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.IGNORECASE).search(page, low)
            if close is None:
                unclosed.add(tag)
            if tag == "textarea":
                add(page[low : close.start() if close else len(page)])
            low = close.end() if close else len(page) if tag in ("script", "style", "textarea") else low
        elif tag in VOID or tag in RAW:
            if tag == "hr":
                now = flush(at)
        elif tag == "button" and at.tag in _SENTENCES and not at.apart:
            pressed = 1
        elif tag in INLINE:
            if m["rest"].endswith("/"):
                continue
            at.signed |= tag == "time" or "=" in m["rest"] and bool(_SIGNED.search(_attributes(m["rest"]).get("class", "")))
            if tag == "a":
                links = 1  # links don't nest
            if tag == unseen[0]:
                unseen = (tag, unseen[1] + 1)
            elif not unseen[1] and not at.apart and ("=" in m["rest"] or "hidden" in m["rest"]) and _hidden(_attributes(m["rest"])):
                unseen = (tag, 1)
        else:
            closing = ENDS.get(tag, frozenset())
            for k in range(len(open_) - 1, 0, -1):
                name = open_[k].tag
                if name == "p" or name in closing:
                    at = open_[k].parent or root
                    del open_[k:]
                elif name not in ("tbody", "thead"):
                    break
            at = _element(tag, m["rest"], at)
            open_.append(at)
            now, unseen, links, pressed = flush(at), ("", 0), 0, 0
        if now.element is not at and not now.parts:
            now = Block(at)
    flush(root)
    return found


def _upwards(element: Element | None) -> Iterator[Element]:
    while element is not None:
        yield element
        element = element.parent


def _elements(found: list[Block]) -> list[Element]:
    """The elements around the blocks, each after those around it."""
    seen: dict[int, Element] = {}
    for b in found:
        chain = []
        for e in _upwards(b.element):
            if id(e) in seen:
                break
            chain.append(e)
        seen.update((id(e), e) for e in reversed(chain))
    return list(seen.values())


def _runs(found: list[Block], elements: list[Element]) -> list[Element]:
    """Elements of reader comments, told by their run: alike, after other text, and signed or in one named after talk."""
    alike: dict[tuple[int, str, str], list[Element]] = {}
    for k, b in enumerate(found):
        b.element.first = k if b.element.first < 0 else b.element.first
    for e in reversed(elements):
        up = e.parent
        if up is not None:
            up.first = e.first if up.first < 0 else min(up.first, e.first)
            up.signed |= e.signed and up.tag in _RUN_TAGS and e.tag not in ("article", "section")
    for e in elements:
        if e.parent is not None and e.tag in _RUN_TAGS and e.first > 0:
            alike.setdefault((id(e.parent), e.tag, e.kind), []).append(e)
    out: list[Element] = []
    for run in alike.values():
        up = run[0].parent
        if len(run) < RUN or not (up.talk or all(x.signed for x in run)) or any(x.holds & {"h1", "main"} for x in run):
            continue
        # what holds little else, such as a heading over them, goes with them
        whole = up.tag not in ("body", "html", "#root", "article", "main") and up.first > 0 and 10 * sum(x.chars for x in run) >= 7 * up.chars
        out += [up] if whole else run
    return out


def _without_rights(found: list[Block], elements: list[Element]) -> list[Block]:
    """Blocks without unnamed footers: the element around a copyright line, unless the page's first text is in it."""
    gone: set[int] = set()
    for k, b in enumerate(found):
        if k and not b.element.inside and len(b.text) <= RIGHTS_CHARS and _RIGHTS.search(b.text):
            around = b.element.parent
            whole = around is not None and around.first > 0 and around.tag not in ("body", "html", "#root") and not around.holds & {"h1", "article", "main"}
            gone.add(id(around if whole else b.element))
    if not gone:
        return found
    for e in elements:
        e.within = id(e) in gone or (e.parent is not None and e.parent.within)
    return [b for b in found if not b.element.within]


def weigh(found: list[Block], named: float = NAMED_WEIGHT, article: float = ARTICLE_WEIGHT) -> None:
    """Give each element its weight and its path: the same tags and the same named steps from the root make one path. Blocks
    of unnamed footers are taken out of ``found``."""
    elements, paths = _elements(found), {}
    for b in found:
        b.element.chars += len(b.text)
    for e in reversed(elements):
        if e.parent is not None:
            e.parent.chars += e.chars
            e.parent.holds |= e.holds
            if e.tag in ("h1", "main", "article"):
                e.parent.holds.add(e.tag)
    for e in _runs(found, elements):
        e.named = e.named or "comments"
    found[:] = _without_rights(found, elements)
    landmarks, total = {"h1", "main", "article"}, sum(len(b.text) for b in found)
    marked = any(e.tag in landmarks for e in elements)
    for e in elements:
        above = e.parent
        if above is None:
            continue
        cleared = e.holds & {"h1", "main"} or e.named != "comments" and ("article" in e.holds or not marked and 2 * e.chars > total)
        mark = bool(e.named) and not cleared
        e.weight = above.weight * (named if mark and above.weight >= 1 else 1.0) * (article if e.tag in ("article", "main") and above.weight == 1.0 else 1.0)
        e.path = paths.setdefault((above.path, e.tag, mark), len(paths) + 1)


def _distance(a: Element, b: Element) -> int:
    """Steps in the tree from one element to the other."""
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent or a
        else:
            b = b.parent or b
        steps += 1
    return steps


def _smooth(values: list[list[float]], elements: list[Element]) -> list[list[float]]:
    """Each series smoothed along the page; nodes further apart in the tree than siblings count less."""
    n, out = len(elements), [[0.0] * len(elements) for _ in values]
    for i in range(n):
        kernel = [
            (j, math.exp(-0.5 * (j - i) ** 2) * STEP ** max(0, _distance(elements[i], elements[j]) - 2))
            for j in range(max(0, i - REACH), min(n, i + REACH + 1))
        ]
        total = sum(k for _, k in kernel)
        for series, smoothed in zip(values, out, strict=True):
            smoothed[i] = sum(k * series[j] for j, k in kernel) / total
    return out


def path_scores(found: list[Block]) -> dict[int, float]:
    """The fused, weighted ratio of each path, as a part of the page's level: the mean of the scores, each weighing as its text."""
    sums: dict[int, list[float]] = {}
    for b in found:
        own = sums.setdefault(b.element.path, [0.0, 0.0, 0.0])
        own[0] += len(b.text) - (1 - LINKED) * min(b.linked, len(b.text))
        own[1] += len(_PUNCTUATION.findall(b.text))
        own[2] += 1
    ratio = {p: (chars / n, (marks + 1) / n) for p, (chars, marks, n) in sums.items()}
    pairs = [ratio[b.element.path] for b in found]
    long, marks = _smooth([[x for x, _ in pairs], [y for _, y in pairs]], [b.element for b in found])
    fused: dict[int, list[float]] = {}
    for b, (x, y), u, v in zip(found, pairs, long, marks, strict=True):
        fused.setdefault(b.element.path, []).append(b.element.weight * math.sqrt(math.sqrt(x * u) * math.sqrt(y * v)))
    score = {p: sum(v) / len(v) for p, v in fused.items()}
    weight = {b.element.path: b.element.weight for b in found}
    level = sum(score[p] * sums[p][0] * weight[p] for p in score) / max(1e-9, sum(sums[p][0] * weight[p] for p in score))
    return {p: s / level if level else 1.0 for p, s in score.items()}


def _container(strong: list[Block], found: list[Block]) -> Element:
    elements = _elements(found)
    for e in elements:
        e.content, e.first = 0, len(found)
    for b in strong:
        b.element.content += 1
    for k, b in enumerate(found):
        b.element.first = min(b.element.first, k)
    for e in reversed(elements):
        if e.parent is not None:
            e.parent.content += e.content
            e.parent.first = min(e.parent.first, e.first)
    around = list(_upwards(strong[0].element))
    whole = next(e for e in around if e.content == len(strong) and e.tag not in PARTS)
    articles = [e for e in _upwards(whole) if e.tag in ("article", "main")]
    if articles:
        return articles[-1]
    if whole.tag not in ("body", "html", "#root") and "h1" not in whole.holds:
        whole = next((e for e in _upwards(whole) if found[e.first].element.tag == "h1"), whole)
    return whole


def select(found: list[Block]) -> list[Block]:
    """The content nodes among weighed blocks, by the two thresholds on their paths' scores."""
    if not found:
        return []
    scores = path_scores(found)
    strong = [b for b in found if scores[b.element.path] >= STRONG]
    whole, ids = _container(strong, found), {id(b) for b in strong}
    at = [k for k, b in enumerate(found) if id(b) in ids]
    loose = whole.tag in ("body", "html", "#root")
    lead = at[0]
    while loose and lead > 0 and found[lead - 1].element.tag in HEADINGS:
        lead -= 1

    held: set[int] = set()  # elements in an article or main that has content
    for e in _elements(found):
        e.within = e is whole or (e.parent is not None and e.parent.within)
        if e.tag in ("article", "main") and e.content or e.parent is not None and id(e.parent) in held:
            held.add(id(e))

    def joins(k: int, b: Block) -> bool:
        if scores[b.element.path] < WEAK or not b.element.within:
            return False
        return not loose or lead <= k <= at[-1] or b.element.inside and id(b.element) in held

    return [b for k, b in enumerate(found) if id(b) in ids or joins(k, b)]


def main_text(page: str | None) -> str:
    """The page's main text: its content nodes, two line ends between them."""
    found = blocks(page or "")
    weigh(found)
    return "\n\n".join(b.text for b in select(found))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [main_text(p) for p in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], ["page_id", "url", "text", "n_chars"]
            )

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html").mapInArrow(
        texts, "page_id long, url string, text string, n_chars long"
    )
