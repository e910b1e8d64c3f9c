"""Leaf blocks of web pages: runs of text between block-level tags, with the elements that hold them."""

import html
import re
from dataclasses import dataclass

# Elements that begin a new block, that have no content, whose content is no page text, and that end others of their kind.
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2
h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("head iframe noscript script style svg template textarea title".split())
IN_HEAD = frozenset("base basefont bgsound head html link meta noscript script style template title".split())  # all others end an open head
ENDS_ITSELF = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr",), "th": ("tr",), "option": ("select",)}
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|textarea|title|iframe|noscript|template)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|</?[A-Za-z][^>]*(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)", re.S | re.I)
_NAME = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Element:
    """An open element, as a link to the one around it. What it says is counted once along the path, so that a path is as long as what is new in it."""

    __slots__ = ("around", "said", "tag", "text", "words")

    def __init__(self, tag: str, words: tuple[str, ...], around: "Element | None") -> None:
        self.tag, self.words, self.around = tag, words, around
        self.text = 0  # characters of its blocks
        known = around.said if around else frozenset()
        own = {(tag, w) for w in (f"in:{tag}", *words)}
        self.said = known if own <= known else known | own


@dataclass
class Block:
    text: str
    linked: int  # characters inside links
    element: Element | None  # the innermost element around it


def _said(attributes: str) -> tuple[str, ...]:
    """The words of an element's class, id and role."""
    names = [a or b or c for a, b, c in _NAME.findall(attributes)] if attributes else []
    return tuple(dict.fromkeys(f"c:{w.lower()}" for name in names for w in _PART.findall(name)))


def blocks(markup: str | None) -> list[Block]:
    """The leaf blocks of a page in order; a null or empty page has none.

    Character references are decoded and white space becomes one blank. Comments, scripts, styles and the head are no text; formulas and
    what stands in for objects are. Elements that are never closed end with the page; a page cut inside a tag ends before it. A head ends at the first element
    that cannot stand in it.
    """
    found: list[Block] = []
    stack: list[Element] = []
    open_: dict[str, list[int]] = {}  # places on the stack of the elements of each tag
    held: list[str] = []
    linked = silent = links = 0

    def flush() -> None:
        nonlocal held, linked
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            if text:
                found.append(Block(text, linked, stack[-1] if stack else None))
            held, linked = [], 0

    def close(index: int) -> None:
        nonlocal silent, links
        if any(e.tag in BLOCK for e in stack[index:]):
            flush()
        for e in stack[index:]:
            silent -= e.tag in SILENT
            links -= e.tag == "a"
            open_[e.tag].pop()
        del stack[index:]

    def innermost(tags, until=()) -> int:
        last = max((open_[t][-1] for t in tags if open_.get(t)), default=-1)
        return last if last >= max((open_[t][-1] for t in until if open_.get(t)), default=-1) else -1

    def text(piece: str) -> None:
        nonlocal linked
        if piece and not silent:
            held.append(piece)
            if links:
                linked += len(piece)

    at, markup = 0, markup or ""
    for m in _TOKEN.finditer(markup):
        text(markup[at:m.start()])
        at = m.end()
        tag = (m[3] or m[1] or "").lower()
        if not tag:
            continue
        if m[2]:
            index = innermost((tag,))
            if index >= 0:
                close(index)
            elif tag in BLOCK:
                flush()
            continue
        if open_.get("head") and tag not in IN_HEAD:
            close(innermost(("head",)))
        if m[1]:  # an element whose content is no markup, with its end
            continue
        if tag in BLOCK:
            paragraph = innermost(("p",), ("td", "th", "button", "object"))
            if paragraph >= 0:
                close(paragraph)
            if tag in ENDS_ITSELF:
                like = ("dt", "dd") if tag in ("dt", "dd") else ("td", "th") if tag in ("td", "th") else (tag,)
                index = innermost(like, ENDS_ITSELF[tag])
                if index >= 0:
                    close(index)
            flush()
        if tag == "br":
            text(" ")
        if tag in VOID or m[4].endswith("/") and tag not in BLOCK:
            continue
        open_.setdefault(tag, []).append(len(stack))
        stack.append(Element(tag, _said(m[4]), stack[-1] if stack else None))
        silent += tag in SILENT
        links += tag == "a"
    text(markup[at:])
    flush()
    return found


def measure(found: list[Block]) -> int:
    """Give every element the characters of the blocks inside it, and return those of the page."""
    seen: list[Element] = []
    for b in found:
        if b.element is not None:
            if not b.element.text:
                seen.append(b.element)
            b.element.text += len(b.text)
    # Inner elements pass on what they hold; an element is passed on once all inside it are, as deeper ones come first.
    depth: dict[int, int] = {}

    def depth_of(element: Element) -> int:
        chain = []
        while element is not None and id(element) not in depth:
            chain.append(element)
            element = element.around
        d = depth[id(element)] if element is not None else 0
        for e in reversed(chain):
            d += 1
            depth[id(e)] = d
        return d

    levels: dict[int, dict[int, Element]] = {}
    for e in seen:
        while e is not None and id(e) not in levels.setdefault(depth_of(e), {}):
            levels[depth_of(e)][id(e)] = e
            e = e.around
    for d in sorted(levels, reverse=True):
        for e in levels[d].values():
            if e.around is not None:
                e.around.text += e.text
    return sum(len(b.text) for b in found)
