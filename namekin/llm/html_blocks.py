"""Leaf blocks of an HTML page, in page order, with their ancestors.

A block is a stretch of text without a block-level tag inside. Inline tags are removed without leaving a
space, ``br`` leaves one, and so does the border of two elements of a formula. Comments, scripts, styles,
titles, templates and ``noscript`` are not text, nor are descriptions and annotations inside ``svg`` and
``math``, which are not shown. All other text is, with that of formulas, drawings, form fields and
fallback content; whether it is main text is not decided here.
"""

from __future__ import annotations

import html
import re
import sys
from dataclasses import dataclass

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Elements that do not end a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby "
    "s samp small span strike strong sub sup time tt u var wbr math tspan textpath".split()
)
#: Elements of a formula. They do not end a block either.
FORMULA = frozenset(
    "annotation annotation-xml maction menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms "
    "mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split()
)
#: Elements that end no block.
WITHIN = INLINE | FORMULA
#: Elements whose content is raw text, up to their end tag, and not text of the page.
RAW = frozenset("script style title".split())
#: Elements whose content is text of the page in which tags mean nothing; in the second, not even entities do.
LITERAL = frozenset(["textarea", "xmp"])
#: Elements whose whole content is not text of the page.
HIDDEN = frozenset("noscript template".split())
#: Elements of other languages. In them a tag may close itself, and some further elements are not shown.
FOREIGN = frozenset(["svg", "math"])
FOREIGN_HIDDEN = frozenset("metadata desc annotation annotation-xml".split())
#: Elements inside foreign ones that hold HTML again.
HTML_AGAIN = frozenset("foreignobject mi mo mn ms mtext".split())
#: Elements that cannot stand in a foreign element: it ends before them.
BREAKOUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing "
    "menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var article aside footer "
    "header main nav section figure form".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that an opening tag of the same kind, or of a listed one, closes.
CLOSED_BY = {
    "p": frozenset("p div ul ol dl table h1 h2 h3 h4 h5 h6 section article aside nav header footer form blockquote pre hr main figure".split()),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option"]),
}
_CONTAINERS = frozenset("table ul ol dl article section div main".split())
_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?\]\]>|<[!?][^>]*(?:>|\Z)"
    # A quote counts right after the equals sign only, and if it is closed; else the tag ends at its first '>'.
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[\s/]+|[^\s/>=]+(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>]*))?|=)*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([\w:-]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")
_NAME_PART = re.compile(r"[a-z]+|[0-9]+")


@dataclass
class Block:
    """Text, and one feature name per ancestor tag and per word of its class, id and role."""

    text: str
    ancestors: frozenset
    tag: str
    linked: float
    keep: bool | None = None


def _element(name: str, attributes: str) -> tuple[frozenset, bool]:
    names = {f"tag:{name}"}
    keep = False
    if attributes:
        for key, value in _ATTRIBUTE.findall(attributes):
            key = key.lower()
            if key in ("class", "id", "role", "itemprop"):
                names.update(f"name:{p}" for p in _NAME_PART.findall(value.lower()))
            elif key == "data-keep":
                keep = True
            elif key in ("hidden", "aria-hidden"):
                names.add("name:hidden")
    return frozenset(names), keep


def blocks(page: str | None) -> list[Block]:
    """The blocks of a page that hold text."""
    if not page:
        return []
    out: list[Block] = []
    stack: list[tuple[str, frozenset, bool]] = []  # element, features of it and its ancestors, keep
    parts: list[str] = []
    linked = in_link = foreign = at = 0
    closed_at = -1  # where the last end tag ended

    def flush():
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                around = next((e for e in reversed(stack) if e[0] not in WITHIN), ("", frozenset(), False))
                out.append(Block(text, around[1], around[0], min(1.0, linked / len(text)), around[2]))
            parts.clear()
        linked = 0

    while at < len(page):
        m = _TOKEN.search(page, at)
        end = m.start() if m else len(page)
        if end > at:
            parts.append(page[at:end])
            if in_link:
                linked += end - at
        if not m:
            break
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA[") and m[0].endswith("]]>") and any(e[0] in FOREIGN for e in stack):
                parts.append(m[0][9:-3].replace("&", "&amp;"))
            continue
        name = m[2].lower()
        if foreign and name in BREAKOUT:
            flush()
            del stack[max(k for k, e in enumerate(stack) if e[0] in FOREIGN) :]
            in_link, foreign = any(e[0] == "a" for e in stack), _in_foreign(stack)
        if name == "br":
            parts.append(" ")
            continue
        if name not in WITHIN:
            flush()
        if m[1]:
            closed_at = at
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
                if name in WITHIN and stack[k][0] not in WITHIN:
                    break  # an inline end tag does not close blocks
            in_link, foreign = any(e[0] == "a" for e in stack), _in_foreign(stack)
            continue
        if m[3].endswith("/") and (foreign or name in FOREIGN):
            closed_at = at
            continue
        if name in RAW or name in HIDDEN or foreign and name in FOREIGN_HIDDEN:
            at = _end_of(page, name, at)
            continue
        if name in FORMULA and closed_at == m.start():
            parts.append(" ")
        if name in VOID:
            continue
        closes = [k for k, e in enumerate(stack) if name in CLOSED_BY.get(e[0], ())]
        if closes and not any(e[0] in _CONTAINERS for e in stack[closes[-1] + 1 :]):
            del stack[closes[-1] :]
        names, keep = _element(name, m[3])
        above = stack[-1] if stack else ("", frozenset(), False)
        stack.append((name, above[1] if name in INLINE else above[1] | names, above[2] or keep))
        in_link, foreign = any(e[0] == "a" for e in stack), _in_foreign(stack)
        if name in LITERAL and not foreign:
            end = re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I).search(page, at)
            text = page[at : end.start() if end else len(page)]
            parts.append(text.replace("&", "&amp;") if name == "xmp" else text)
            at += len(text)
    flush()
    return out


def _in_foreign(stack: list[tuple[str, frozenset, bool]]) -> bool:
    """Whether a tag that follows belongs to a foreign element."""
    return next((e[0] in FOREIGN for e in reversed(stack) if e[0] in FOREIGN or e[0] in HTML_AGAIN), False)


def _end_of(page: str, name: str, at: int) -> int:
    """Where the content of a hidden element ends, its end tag included."""
    depth = 1
    for m in re.compile(rf"<(/?){name}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).finditer(page, at):
        depth += -1 if m[1] else name not in RAW and not m[0].endswith("/>")
        if not depth:
            return m.end()
    return len(page)
