"""Main text of web pages by tag-path ratios.

A page is cut into blocks: the text between block-level tags, with the path of
block-level tags that leads to it (a tag's first class or id belongs to it).
Over the blocks that share a path are summed text length, punctuation and text
in links. Then, per page:

- ratio: mean text length of a path's blocks, times its punctuation a block,
  times its share of text outside links;
- smooth: ratios are averaged over neighbouring blocks in page order, so that a
  short paragraph among long ones is not lost;
- fuse: smoothed and own ratio are multiplied, and weighted by what tag names
  and class names say (navigation, adverts and the like weigh nothing, an
  article more);
- threshold: paths with at least ``SHARE`` of the best fused value are content.
  They span a container, the longest path that most of their value shares, and
  the other paths in it belong to the article too, unless they weigh nothing or
  are mostly links; content paths outside of it stay.

Forms, and elements whose class, id or role has comment words, take out all that
is in them. Never html, body, main and article; words that a section of an article
may have too (review, discussion) only if the element holds comments or forms,
or has a namesake; and none that holds most of the page's text outside of
navigation, unless an article, main or content element outside of it has text.

Pages are independent of each other: there is no shuffle, and a long or deeply
nested page costs memory in proportion to its own length.

Defined cases: null or empty html gives an empty text; so does a page without
text blocks; unclosed and stray tags are tolerated (an element whose text never
counts, such as a button or drawing, but for scripts and styles, ends at once if it
has no end tag; an option's text ends at the next tag); a header element counts for
nothing with the title in it, a class name such as entry-header does not; repeated rows give equal
texts; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable
from html import unescape
from math import log1p

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SHARE = 0.12
KERNEL = (0.25, 0.5, 0.25)
CONTAINER_MASS = 0.8

INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span"
    " strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title svg math iframe object select button canvas".split())
# Without an end tag the rest of the page is theirs; of the others, the tag alone is skipped.
TO_THE_END = frozenset(("script", "style"))
NOTHING = frozenset("head nav header footer aside form menu dialog fieldset".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# A start tag ends an open element of these when it is one of them.
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr"
    " main menu nav ol p pre section table ul".split()
)
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}

_TAG = re.compile(
    r"""<(?:!--(?:.*?)(?:-->|\Z)|(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>"']|"[^"]*"|'[^']*')*+)>|[!?/][^>]*>|/?[a-zA-Z][^<>]*>?)""",
    re.S,
)
_NAMES = re.compile(r"""(?:^|\s)(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_NOISE = re.compile(
    r"(?:^|[^a-z])(?:ads?|adverts?|advertisements?|advertising|sponsor(?:ed)?|promos?|promotions?|banners?|cookies?|consent|gdpr|notices?"
    r"|alerts?|popups?|modals?|overlay|newsletters?|subscribe|subscriptions?|signup|login|paywall|sidebars?|side|aside|widgets?|menus?"
    r"|nav|navbar|navigation|breadcrumbs?|crumbs|pager|pagination|toc|footers?|foot|headers?|masthead|topbar|toolbar|share|sharing"
    r"|social|related|recommended|recommendations|trending|popular|comments?|replies|reply|respond|discussion|disqus|reviews?"
    r"|tags?|taglist|disclaimer|legal|copyright|hidden|forms?|search)(?:$|[^a-z])"
)
_COMMENTS = re.compile(r"(?:^|[^a-z])(?:comments?|replies|reply|respond|discussion|disqus|reviews?)(?:$|[^a-z])")
# What says that there are comments elsewhere.
_COMMENT_STATE = re.compile(r"(?<![a-z])(?:(?:has|with|without|no)[-_]comments?|comments?[-_](?:open|opened|closed|enabled|disabled|on|off))(?![a-z])")
_MAYBE_COMMENTS = re.compile(r"(?:^|[^a-z])(?:respond|discussion|reviews?)(?=$|[^a-z])")
_CONTENT = re.compile(r"(?:^|[^a-z])(?:article|articlebody|content|entry|post|story|main|body|text|prose)(?:$|[^a-z])")
# A heading of the article, not of the page.
_OWN_HEADER = re.compile(r"(?<![a-z])(?:article|content|entry|post|story|text)[-_]?headers?(?![a-z])")
_PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？¿¡]")


def _names(attributes: str) -> tuple[str, bool]:
    """Class, id and role in lower case, words split at changes of case; and whether the element is hidden."""
    words, hidden = [], False
    for name, value in _NAMES.findall(attributes):
        value, name = value.strip("\"'"), name.lower()
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            hidden = True
        elif name == "style":
            hidden |= re.search(r"display\s*:\s*none", value.lower()) is not None
        else:
            words.append(re.sub(r"(?<=[a-z])(?=[A-Z])", "-", value).lower())
    return " ".join(words), hidden


class Path:
    """A tag path: one object for each path of a page, so that a long one is not copied for every element."""

    __slots__ = ("parent", "tag", "depth", "below")

    def __init__(self, parent: Path | None, tag: str):
        self.parent, self.tag, self.depth, self.below = parent, tag, parent.depth + 1 if parent else 0, {}

    def child(self, tag: str) -> Path:
        found = self.below.get(tag)
        if found is None:
            found = self.below[tag] = Path(self, tag)
        return found

    def names(self) -> tuple[str, ...]:
        """The tags from the root."""
        names, path = [], self
        while path.parent is not None:
            names.append(path.tag)
            path = path.parent
        return tuple(reversed(names))


class _Seal:
    """A form or an element that may hold comments; whether it takes its text out is known when the page has ended."""

    __slots__ = ("path", "sure")

    def __init__(self, path: Path, sure: bool):
        self.path, self.sure = path, sure


def _closed(found: list[tuple[_Element, str, int]]) -> set[_Seal]:
    """The seals that hold."""
    texts = [(e, len(text) - linked) for e, text, linked in found if not e.sealed]
    size: dict[_Seal, int] = {}
    for e, n in texts:
        for seal in e.seals:
            size[seal] = size.get(seal, 0) + n
    if not size:
        return set()
    named = Counter(seal.path for seal in size)
    most = sum(n for _, n in texts) / 2
    # Elements that hold most of the text stand in each other.
    large = {seal for seal, n in size.items() if n > most}
    content = [e for e, n in texts if n and e.weight > 1]
    spared = {seal for seal in large if not any(seal not in e.seals and not set(e.seals) - large for e in content)}
    return {seal for seal in size if (seal.sure or named[seal.path] > 1) and seal not in spared}


class _Element:
    __slots__ = ("tag", "path", "weight", "sealed", "seals")

    def __init__(self, tag: str, attributes: str, parent: _Element | None):
        names, hidden = _names(attributes) if attributes else ("", False)
        first = names.split(" ", 1)[0] if names else ""
        self.tag = tag
        self.path = parent.path.child(f"{tag}.{first}" if first else tag) if parent else Path(None, "")
        self.weight = parent.weight if parent else 1.0
        # Nothing inside a sealed element counts; a class name that merely sounds like noise
        # may also belong to a frame around the article, which then counts again.
        self.sealed = bool(parent and parent.sealed) or (tag in NOTHING and tag != "form") or hidden
        self.seals = parent.seals if parent else ()
        names = _COMMENT_STATE.sub("", names)
        frame = tag in ("html", "body", "main", "article")
        comments = bool(names and _COMMENTS.search(names))
        if tag == "form" or comments:
            for seal in self.seals:
                seal.sure = True
            if not frame:
                sure = tag == "form" or _COMMENTS.search(_MAYBE_COMMENTS.sub("-", names)) is not None
                self.seals = (*self.seals, _Seal(self.path, sure))
        if comments:
            names = _COMMENTS.sub("-", _MAYBE_COMMENTS.sub("-", names))
        noisy = tag not in ("html", "body", "form") and bool(names and _NOISE.search(_OWN_HEADER.sub("-", names)))
        if self.sealed or noisy:
            self.weight = 0.0
        elif tag in ("article", "main"):
            self.weight = 3.0
        elif names and _CONTENT.search(names):
            self.weight = min(3.0, self.weight * 3.0)


def blocks(html: str) -> list[tuple[Path, float, str, int]]:
    """``(path, weight, text, characters in links)`` of the non-empty blocks in page order."""
    found: list[tuple[_Element, str, int]] = []
    stack = [_Element("", "", None)]
    pieces: list[str] = []
    linked, in_link, at = 0, 0, 0
    opened: Counter[str] = Counter()  # tags on the stack
    endless: set[str] = set()  # tags with no end tag from here on

    def end_block() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                found.append((stack[-1], text, min(linked, len(text))))
            pieces.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw:
            text = unescape(raw) if "&" in raw else raw
            pieces.append(text)
            if in_link:
                linked += len(" ".join(text.split()))

    def close(k: int) -> None:
        end_block()
        opened.subtract(e.tag for e in stack[k:])
        del stack[k:]

    while True:
        tag = _TAG.search(html, at)
        if tag is None:
            add(html[at:])
            break
        add(html[at : tag.start()])
        at = tag.end()
        name = tag[2].lower() if tag[2] else ""
        if not name:
            continue
        if tag[1]:
            if name == "a":
                in_link = 0
            elif name not in INLINE and name not in VOID:
                k = next(k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == name) if opened[name] > 0 else 0
                end_block()
                if k:
                    close(k)
            continue
        if name == "option":  # text alone, up to the next tag of any kind
            following = html.find("<", at)
            at = following if following >= 0 else len(html)
            continue
        if name in RAW:
            drawn = name in ("svg", "math", "object", "canvas")
            if not drawn and name not in ("button", "select"):
                end_block()
            if name in ("svg", "math") and (tag[3] or "").endswith("/"):
                continue
            end = None if name in endless else re.compile(f"</{name}\\b[^>]*>", re.I).search(html, at)
            if end is not None:
                at = end.end()
            elif name in TO_THE_END:
                at = len(html)
            else:
                endless.add(name)
            continue
        if name in INLINE:
            if name == "a":
                in_link = 1
            continue
        end_block()
        if name in VOID:
            continue
        in_link = 0
        if name in CLOSES_P and stack[-1].tag == "p":
            close(len(stack) - 1)
        if name in CLOSES and any(opened[other] > 0 for other in CLOSES[name]):
            # Only within the list or table that the element stands in.
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in CLOSES[name]:
                    close(k)
                    break
                if stack[k].tag in ("ul", "ol", "dl", "table"):
                    break
        stack.append(_Element(name, tag[3] or "", stack[-1]))
        opened[name] += 1
    end_block()
    closed = _closed(found)
    return [(e.path, 0.0 if closed.intersection(e.seals) else e.weight, text, linked) for e, text, linked in found]


def _container(mass: dict[Path, float]) -> Path | None:
    """The longest path below which most of the mass is."""
    below: dict[Path, float] = {}
    for path in mass:
        while path.parent is not None and path.parent not in below:
            path = path.parent
            below[path] = 0.0
    for path in sorted({*below, *mass}, key=lambda p: -p.depth):
        if path.parent is not None:
            below[path.parent] += below.get(path, 0.0) + mass.get(path, 0.0)
    enough, container = CONTAINER_MASS * sum(mass.values()), None
    for path in sorted(below, key=lambda p: p.depth):  # those with most of the mass stand in each other
        if path.depth and below[path] >= enough and (container is None or path.parent is container):
            container = path
    return container


def _inside(paths: Iterable[Path], container: Path | None) -> set[Path]:
    """The paths that begin with the container; all if there is none."""
    if container is None:
        return set(paths)
    known, found = {container: True}, set()
    for path in paths:
        chain, at = [], path
        while at is not None and at not in known:
            chain.append(at)
            at = at.parent
        known.update(dict.fromkeys(chain, at is not None and known[at]))
        if known[path]:
            found.add(path)
    return found


def content_paths(page: list[tuple[Path, float, str, int]]) -> set[Path]:
    """The paths that hold the main text."""
    paths: dict[Path, list[float]] = {}
    for path, weight, text, linked in page:
        sums = paths.setdefault(path, [0.0, 0.0, 0.0, 0.0, weight])
        sums[0] += 1
        sums[1] += len(text)
        sums[2] += len(_PUNCTUATION.findall(text))
        sums[3] += linked
    ratio = {
        path: (size / n) * log1p(marks / n) * (1 - linked / size) if weight else 0.0
        for path, (n, size, marks, linked, weight) in paths.items()
    }
    values = [ratio[path] for path, *_ in page]
    reach = len(KERNEL) // 2
    smooth: dict[Path, float] = dict.fromkeys(paths, 0.0)
    for i, (path, *_) in enumerate(page):
        near = [(KERNEL[k + reach], values[i + k]) for k in range(-reach, reach + 1) if 0 <= i + k < len(values)]
        smooth[path] += sum(w * v for w, v in near) / sum(w for w, _ in near)
    fused = {p: ((smooth[p] / paths[p][0]) * ratio[p]) ** 0.5 * paths[p][4] for p in paths}
    best = max(fused.values(), default=0.0)
    if best <= 0:  # no punctuation anywhere: the text outside links alone decides
        fused = {p: (s[1] - s[3]) * s[4] for p, s in paths.items()}
        best = max(fused.values(), default=0.0)
        if best <= 0:
            return set()
    chosen = {p for p, v in fused.items() if v >= SHARE * best}
    mass = {p: fused[p] * paths[p][1] for p in chosen}
    container = _container(mass)
    if container is not None and container.tag.split(".")[0] in ("html", "body"):
        # The page itself: besides chosen paths only headings are taken along.
        inside = {p for p in _inside(paths, container) if p.tag.split(".")[0] in HEADINGS}
    else:
        inside = _inside(paths, container)
    return chosen | {p for p in inside if paths[p][4] and paths[p][3] < paths[p][1] / 2}


def main_text(html: str | None) -> str:
    if not html:
        return ""
    page = blocks(html)
    kept = content_paths(page)
    return "\n".join(text for path, _, text, _ in page if path in kept)


def extract(html: str | Column = "html") -> Column:
    """The main text of a column of pages."""

    @F.arrow_udf("string")
    def of(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(x) for x in pages.to_pylist()], pa.string())

    return of.asNondeterministic()(F.col(html) if isinstance(html, str) else html)
