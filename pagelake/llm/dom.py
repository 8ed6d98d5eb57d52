"""HTML pages as sequences of leaf blocks, inside tasks."""

from __future__ import annotations

import html as html_lib
import re
from typing import NamedTuple

# Elements that start a block, elements whose content is no text of the page, elements without
# content, and start tags that end an open element of the same row.
BLOCK = frozenset("""address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure
button label footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select
summary table tbody td tfoot th thead tr ul""".split())
RAW = frozenset("script style noscript template title textarea iframe".split())  # up to their end tag
UNREAD = frozenset("svg math object".split())
HEAD = frozenset("base basefont bgsound head html link meta noframes".split()) | RAW - {"textarea", "iframe"}
# Start tags that end an open svg or math, and elements in them that may hold such tags.
BREAKOUT = frozenset("""b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing
menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var""".split()) | BLOCK
HOLDERS = frozenset("foreignobject desc annotation-xml mi mo mn ms mtext".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ENDS = {"li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
        "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
SCOPE = frozenset("table ul ol dl body html select".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^\"'>]++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)[^>]*>|<[!?/][^>]*>", re.DOTALL | re.IGNORECASE)
_STOP = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.IGNORECASE) for name in RAW | UNREAD}
_CLOSED = re.compile(r"(?:^|[\s\"'])[^\s=\"']*/\s*\Z")
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_TOKEN = re.compile(r"[a-z]+|[0-9]+")


class Block(NamedTuple):
    """Text of a leaf block, the open elements around it (tag and names), and
    how many of its characters are in links."""

    text: str
    path: tuple[tuple[str, tuple[str, ...]], ...]
    linked: int


def _closed(m: re.Match) -> bool:
    """Whether a start tag ends with a slash that is no part of a value."""
    return bool(_CLOSED.search(m[0][1:-1]))


def blocks(page: str | None) -> list[Block]:
    """Leaf blocks in page order: character references decoded, white space
    made one blank, trimmed; blocks without text are left out.

    The text of ``RAW`` and ``UNREAD`` elements and of the head is left out.
    A raw element or object without an end tag ends at its own tag, an svg or
    math also at a tag it can't hold, all at the end of a block around them,
    and the head at the first tag or text that it can't hold.
    """
    page = page or ""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    unread: list[str] = []  # open UNREAD elements, and the holders and blocks in them
    stops: dict[str, re.Match | None] = {}
    in_head = False
    linked = links = at = 0

    def stop(name: str) -> re.Match | None:
        """The next end tag of that name; each stretch is searched once."""
        if name not in stops or stops[name] and stops[name].start() < at:
            stops[name] = _STOP[name].search(page, at)
        return stops[name]

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            out.append(Block(text, tuple(stack), linked))
        parts.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked, in_head
        if unread or in_head and not raw.strip():
            return
        in_head = False
        text = html_lib.unescape(raw) if "&" in raw else raw
        parts.append(text)
        if links:
            linked += len(text)

    while m := _TAG.search(page, at):
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        name = m["name"] or m["name2"]
        if not name:
            continue
        name = name.lower()
        end = m["end"] or m["end2"]
        if in_head and (name in ("head", "body", "html", "br") if end else name not in HEAD):
            in_head = False
        if name in RAW:
            if not end and not (unread and _closed(m)) and (after := stop(name)):
                at = after.end()
            continue
        if name == "head":
            in_head = not end and all(tag == "html" for tag, _ in stack) and not unread
            continue
        if unread:
            if end:
                if name in unread:
                    del unread[len(unread) - 1 - unread[::-1].index(name):]
                    continue
                if name not in BLOCK or all(tag != name for tag, _ in stack):
                    continue
                unread.clear()
            else:
                if name in BREAKOUT:
                    while unread and unread[-1] in ("svg", "math"):
                        unread.pop()
                if unread:
                    if name in UNREAD | HOLDERS | BLOCK - VOID and not _closed(m):
                        unread.append(name)
                    continue
        if name in UNREAD:
            if not end and not _closed(m) and (name != "object" or stop(name)):
                unread.append(name)
            continue
        if end:
            if name == "a":
                links = max(0, links - 1)
            elif name in BLOCK:
                flush()
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == name:
                        del stack[k:]
                        break
        elif name == "br":
            parts.append(" ")
        elif name == "a":
            links += 1
        elif name in BLOCK:
            flush()
            links = 0
            ends = ENDS.get(name, {"p"} if name not in ("body", "html") else ())
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in ends:
                    del stack[k:]
                    break
                if stack[k][0] in SCOPE or stack[k][0] not in ("p", *ends) and name not in ENDS:
                    break
            if name not in VOID:
                names = " ".join(filter(None, (g for f in _NAMES.findall(m["attrs"] or "") for g in f)))
                stack.append((name, tuple(_TOKEN.findall(names.lower()))))
    if at < len(page):
        add(page[at:])
    flush()
    return out
