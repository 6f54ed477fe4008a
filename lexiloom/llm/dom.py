r"""Pages as trees of blocks: one linear pass over the html.

A page becomes its block elements in page order (depth, label, flags) and its text runs, each
with the block it lies in. Inline elements are no nodes; their text belongs to the block around
them. White space in a run is made one space and the run is trimmed; empty runs go.

The time is linear in the length of the html for any input: an element that closes others is
found by a table of open tags, and quotes that hide the end of a tag are followed through only once.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass
from html import unescape

import numpy as np

# Fixed values of HTML: elements without content, with raw text, and that begin a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
BLOCK = frozenset("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead title tr ul".split())
# Start tags that end an open element of the same kind, inside the nearest scope.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset("ul ol dl table select div article section main nav aside body".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figure table ul ol dl".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Tags, roles and label words of what is no content.
BOILERPLATE_TAGS = frozenset("head nav footer aside form script style noscript iframe template select button input textarea svg canvas object dialog menu title".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert".split())
BOILERPLATE_WORDS = frozenset("ad ads advert adverts advertisement banner sponsor sponsored promo promotion menu nav navbar navigation breadcrumb breadcrumbs footer sidebar aside widget cookie cookies consent notice notices alert popup modal newsletter subscribe share sharing social related recommended comment comments disqus respond replies login search pagination pager copyright legal skip".split())
HEADER_WORDS = frozenset("header masthead".split())
# Words of a label that say where or how a part stands, not what it is about.
PLACE_WORDS = frozenset("area article articles bar block body bottom box button buttons column container content entry form global group head holder icons inner item items left line link links list main module page panel post posts primary right row secondary section site slot story text thread top unit wrap wrapper zone".split())
OWN_WORDS = frozenset("article content entry post story".split())

#: Flags of a node.
DROP, HEADER, LANDMARK, PROSE_TAG, HEADING, OWN_HEADER = 1, 2, 4, 8, 16, 32

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/><]*)([^<>\"']*)>")
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/><]*)")
_REST = re.compile(r"(?:[^>\"']+|\"[^\"]*\"|'[^']*')*+>")
_LOOSE = re.compile(r"[^<>]*>")
_OTHER = re.compile(r"<!--.*?(?:-->|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role|hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)|(?=[\s/]|\Z))", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_DIGITS = re.compile(r"\d+")


@dataclass
class Page:
    depth: np.ndarray  # of each node, in page order
    label: np.ndarray  # hash of tag, class and id
    flags: np.ndarray
    own: np.ndarray  # characters of the node's own runs
    link: np.ndarray  # those of them inside links
    text: np.ndarray  # hash of the own runs, 0 without any
    run_node: np.ndarray  # node of each run, in page order
    runs: list[str]


def label_flags(names: str, role: str) -> int:
    """Flags from classes, id and role. A name counts if each of its words says what is no content or where it stands."""
    out = DROP if role in BOILERPLATE_ROLES or role == "hidden" else 0
    for name in names.split():
        words = {w.lower() for w in _PART.findall(name) if len(w) > 1}
        if not words or not words <= BOILERPLATE_WORDS | HEADER_WORDS | PLACE_WORDS:
            continue
        if words & BOILERPLATE_WORDS:
            out |= DROP
        elif words & HEADER_WORDS:
            out |= HEADER | (OWN_HEADER if words & OWN_WORDS else 0)
    return out | (LANDMARK if role == "main" else 0)


_known: dict[tuple[str, str, str], tuple[int, int]] = {}


def _node(tag: str, names: str, role: str) -> tuple[int, int]:
    """(label, flags) of an element."""
    if (found := _known.get((tag, names, role))) is None:
        if len(_known) > 20_000:
            _known.clear()
        flags = label_flags(names, role) if tag not in ("html", "body") else 0
        if tag in ("article", "main"):
            flags = flags & ~(DROP | HEADER) | LANDMARK
        if tag in BOILERPLATE_TAGS:
            flags |= DROP
        if tag == "header":
            flags |= HEADER
        flags |= (PROSE_TAG if tag in PROSE else 0) | (HEADING if tag in HEADINGS else 0)
        found = _known[tag, names, role] = zlib.crc32(f"{tag} {_DIGITS.sub('#', names)}".encode("utf-8", "surrogatepass")), flags
    return found


def parse(html: str) -> Page:
    """Blocks and runs of a page; every fault is mended in the simplest way, and markup that is cut off ends at the cut."""
    depth, label, flags = [0], [zlib.crc32(b"#root")], [0]
    run_node: list[int] = []
    runs: list[str] = []
    links: list[int] = []
    stack: list[tuple[str, int, bool]] = [("#root", 0, True)]  # tag, node, whether a block
    open_at: dict[str, list[int]] = {}
    scopes: list[int] = []
    line: list[str] = []
    muted = in_link = linked = 0  # open inline elements that are left out; open links; characters in links of this run
    at, size, careful = 0, len(html), True

    def flush() -> None:
        nonlocal linked
        if line:
            if words := " ".join("".join(line).split()):
                run_node.append(stack[-1][1])
                runs.append(words)
                links.append(min(linked, len(words)))
            line.clear()
        linked = 0

    def cut(to: int) -> None:
        """Closes all from this place of the stack on."""
        nonlocal muted, in_link
        in_link = 0
        while len(stack) > to:
            tag, _, block = stack[-1]
            if block:
                if not muted:
                    flush()
            else:
                muted -= 1
            stack.pop()
            open_at[tag].pop()
            if tag in SCOPES:
                scopes.pop()

    def text(a: int, b: int) -> None:
        nonlocal linked
        if not muted:
            piece = unescape(html[a:b])
            line.append(piece)
            if in_link:
                linked += len(piece.strip())

    while at < size:
        i = html.find("<", at)
        if i < 0:
            text(at, size)
            break
        if i > at:
            text(at, i)
        m = _TAG.match(html, i)
        if m:
            close, tag, given, at = m[1], m[2].lower(), m[3], m.end()
        else:
            m = _NAME.match(html, i)
            if m is None:
                if (other := _OTHER.match(html, i)) is not None:
                    at = other.end()
                else:
                    text(i, i + 1)
                    at = i + 1
                continue
            rest = _REST.match(html, m.end()) if careful else None
            if rest is None:
                careful = False  # from here on a quote may not hide the end of a tag, so no stretch is read twice
                rest = _LOOSE.match(html, m.end())
            if rest is None:
                if html.find("<", m.end()) < 0:
                    break  # a tag cut off at the end
                text(i, m.end())
                at = m.end()
                continue
            close, tag, given, at = m[1], m[2].lower(), html[m.end() : rest.end() - 1], rest.end()
        if close:
            if tag == "a":
                in_link = 0
            if places := open_at.get(tag):
                cut(places[-1])
            elif tag in BLOCK and not muted:
                flush()
            continue
        block = tag in BLOCK
        if block:
            if not muted:
                flush()
            if tag != "br":
                if places := open_at.get("p"):
                    cut(places[-1])
                for other in CLOSES.get(tag, ()):
                    if (places := open_at.get(other)) and (not scopes or places[-1] > scopes[-1]):
                        cut(places[-1])
        names = role = ""
        if given and not given.isspace():
            for key, value in _ATTRIBUTE.findall(given):
                key = key.lower()
                if key == "role":
                    role = value.strip("\"'").lower()
                elif key == "hidden":
                    role = "hidden"
                else:
                    names += " " + value.strip("\"'")
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>|</{re.escape(tag)}\Z", re.I).search(html, at)
            at = end.end() if end else size
            continue
        if tag in VOID or given.endswith("/"):
            continue
        if tag == "a":
            in_link = 1
        own_label, own_flags = _node(tag, names.strip(), role)
        if not block and not own_flags & (DROP | LANDMARK):
            continue
        if not block and own_flags & DROP:
            stack.append((tag, -1, False))
            muted += 1
        else:
            depth.append(len(stack))
            label.append(own_label)
            flags.append(own_flags)
            if not block and not muted:
                flush()
            stack.append((tag, len(depth) - 1, True))
        open_at.setdefault(tag, []).append(len(stack) - 1)
        if tag in SCOPES:
            scopes.append(len(stack) - 1)
    cut(1)
    if not muted:
        flush()
    return _page(depth, label, flags, run_node, runs, links)


def _page(depth: list[int], label: list[int], flags: list[int], run_node: list[int], runs: list[str], links: list[int]) -> Page:
    """Settles which headers go: one that holds a heading stays inside a landmark, or if its label says it is the article's own."""
    n = len(depth)
    up = parents(depth)
    heads, inside = [bool(f & HEADING) for f in flags], [False] * n
    for i in range(n - 1, 0, -1):
        if heads[i] and not flags[i] & DROP:
            heads[up[i]] = True
    kept = [0] * n
    for i in range(n):
        inside[i] = bool(flags[i] & LANDMARK) or (i > 0 and inside[up[i]])
        gone = flags[i] & DROP or (flags[i] & HEADER and not (heads[i] and (inside[i] or flags[i] & OWN_HEADER))) or (i > 0 and kept[up[i]] & DROP)
        kept[i] = flags[i] & (LANDMARK | PROSE_TAG) | (DROP if gone else 0)
    own, link, text = np.zeros(n, np.uint32), np.zeros(n, np.uint32), [0] * n
    live = [k for k, i in enumerate(run_node) if not kept[i] & DROP]
    for k in live:
        i = run_node[k]
        own[i] += len(runs[k])
        link[i] += links[k]
        text[i] = zlib.crc32(runs[k].encode("utf-8", "surrogatepass"), text[i] or 1)
    as_u4 = lambda x: np.array(x, np.uint32)
    return Page(as_u4(depth), as_u4(label), np.array(kept, np.uint8), own, link, as_u4(text), as_u4([run_node[k] for k in live]), [runs[k] for k in live])


def parents(depth: list[int]) -> list[int]:
    """Index of each node's parent; -1 for the root."""
    out, path = [], []
    for i, d in enumerate(depth):
        # A node's depth is that of the stack, which inline parts may have made deeper than its parent's by more than one.
        while path and depth[path[-1]] >= d:
            path.pop()
        out.append(path[-1] if path else -1)
        path.append(i)
    return out
