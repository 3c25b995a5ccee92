"""HTML as a sequence of leaf blocks: the text between block tags, with the path of open elements around it."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^\"'>])*)(?:>|\Z)", re.S)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
WORD = re.compile(r"[a-z]+")
# Elements whose content is no text, elements without content, and elements inside a line.
RAW = frozenset("script style noscript template svg iframe object textarea title xmp canvas".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split())
# What may stand in a head; anything else ends it, as its end tag may be left out.
HEAD_PARTS = frozenset("html head base basefont bgsound link meta title script style noscript template".split())
# Opening one of these ends an open element of the kinds named, up to the nearest of the boundaries.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
        "th": ("td", "th"), "option": ("option",)}
BOUNDARY = frozenset("ul ol dl table select article section main div nav aside body".split())


class Path:
    """The names of the open elements, outermost first: those of the innermost one, and the path of the others.

    Paths share what they have in common, so a page takes room in proportion to its length however deep it is, and equal
    elements in equal places are one object. ``counts`` says how often each own name stands on the whole path, ``distinct`` how
    many different names do.
    """

    __slots__ = ("parent", "names", "counts", "distinct", "size", "inside")

    def __init__(self, parent: Path | None = None, names: tuple[str, ...] = (), counts: tuple[int, ...] = ()):
        self.parent, self.names, self.counts = parent, names, counts
        self.size = len(names) + (parent.size if parent else 0)
        self.distinct = sum(c == 1 for c in counts) + (parent.distinct if parent else 0)
        self.inside: dict[tuple[str, str], Path] = {}

    def up(self) -> Iterator[Path]:
        """This path, the one without the innermost element, and so on."""
        here: Path | None = self
        while here is not None:
            yield here
            here = here.parent

    def __len__(self) -> int:
        return self.size

    def __iter__(self) -> Iterator[str]:
        return iter([name for here in reversed(list(self.up())) for name in here.names])


class Leaf(NamedTuple):
    path: tuple[str, ...] | Path
    text: str
    linked: int


def _tokens(tag: str, attributes: str) -> tuple[str, ...]:
    words = [w for value in NAMES.findall(attributes) for w in WORD.findall(value.lower())]
    return (tag, *(f".{w}" for w in dict.fromkeys(words)))


def leaves(source: str | None, root: Path | None = None) -> list[Leaf]:
    """The blocks of a page in order: references decoded, white space made one space, no empty ones.

    A path holds the names of the open elements and, marked with a dot, the words of their classes, ids and
    roles. Pages read with one ``root`` share their paths. ``linked`` counts the characters inside links. Raw elements, comments and the head hold no text; a head
    ends at its end tag or at the first thing that may not stand in it.
    """
    source = source or ""
    out: list[Leaf] = []
    stack: list[tuple[str, Path]] = []
    opened: Counter[str] = Counter()  # open elements by name
    standing: Counter[str] = Counter()  # names on the path
    root = Path() if root is None else root
    parts: list[str] = []
    linked = links = at = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            out.append(Leaf(stack[-1][1] if stack else root, text, min(linked, len(text))))
        parts.clear()
        linked = 0

    def say(raw: str) -> None:
        nonlocal linked
        if opened["head"] and raw.strip():
            leave_head()
        if raw and not opened["head"]:
            text = html.unescape(raw)
            parts.append(text)
            linked += len(text.strip()) if links else 0

    def close(index: int) -> None:
        nonlocal links
        for tag, path in stack[index:]:
            links -= tag == "a"
            opened[tag] -= 1
            if tag not in INLINE:
                for name in path.names:
                    standing[name] -= 1
        del stack[index:]

    def leave_head() -> None:
        for index, (tag, _) in enumerate(stack):
            if tag == "head":
                return close(index)

    def enter(tag: str, attributes: str) -> None:
        nonlocal links
        path = stack[-1][1] if stack else root
        if tag not in INLINE:
            known = path.inside.get((tag, attributes))
            if known is None:
                names = _tokens(tag, attributes)
                known = Path(path, names, tuple(standing[n] + 1 for n in names))
                path.inside[tag, attributes] = known
            path = known
            standing.update(path.names)
        stack.append((tag, path))
        opened[tag] += 1
        links += tag == "a"

    def close_open(kinds: tuple[str, ...]) -> None:
        if not any(opened[kind] for kind in kinds):
            return None
        for index in range(len(stack) - 1, -1, -1):
            if stack[index][0] in kinds:
                return close(index)
            if stack[index][0] in BOUNDARY:
                return None

    size = len(source)
    while at < size:
        found = TOKEN.search(source, at)
        if not found:
            say(source[at:])
            break
        say(source[at:found.start()])
        at = found.end()
        name = found.group(2)
        if name is None:
            continue
        name = name.lower()
        if opened["head"] and name not in HEAD_PARTS:
            leave_head()
        if name in RAW and not found.group(1):
            if not found.group(3).endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(source, at)
                at = end.end() if end else size
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name not in INLINE:
            flush()
        if found.group(1):
            for index in range(len(stack) - 1 if opened[name] else -1, -1, -1):
                if stack[index][0] == name:
                    close(index)
                    break
                if name in INLINE and stack[index][0] not in INLINE:
                    break
            continue
        if name in VOID:
            continue
        if name not in INLINE:
            if stack and stack[0][0] == "html" and name == "body":
                close(1)
            close_open(("p",))
            close_open(ENDS.get(name, ()))
        enter(name, found.group(3))
    flush()
    return out
