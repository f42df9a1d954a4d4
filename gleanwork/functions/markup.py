"""HTML text as a flow of tags and texts, in time linear in its length.

The standard library's parser needs quadratic time on unfinished tags and comments, and one such
page would hold up a whole stage. This reader makes one pass with a pattern that never backtracks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

START, END, TEXT, VERBATIM = "start", "end", "text", "verbatim"

# Elements whose content is no markup, by whether that content is shown, and whether
# character references in it count.
HIDDEN_TAGS = frozenset("script style".split())
RAW_TAGS = frozenset("iframe noembed noframes xmp".split())
REFERENCE_TAGS = frozenset("textarea title".split())

# A tag with its attributes (a quote counts only after an equals sign), the start of a comment, or
# the start of markup that never ends.
_MARKUP = re.compile(
    r"""<(?:
        (?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)
            (?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+'|(?!["']))|["'])*+>
        |(?P<comment>!--)
        |(?P<other>[!?/])
        |(?P<open>[a-zA-Z])
    )""",
    re.VERBOSE,
)
_CLOSERS = {
    tag: re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE)
    for tag in HIDDEN_TAGS | RAW_TAGS | REFERENCE_TAGS
}


def markup_events(html: str) -> Iterator[tuple[str, str]]:
    """``(kind, value)``: a tag name that starts or ends, or a text with references resolved."""
    position = 0
    while True:
        found = _MARKUP.search(html, position)
        text = html[position : found.start()] if found else html[position:]
        if text:
            yield TEXT, unescape(text)
        if found is None or found["open"]:
            return
        position = found.end()
        if found["comment"] or found["other"]:
            # "<!-->" is a whole comment, so its end may overlap with its start.
            mark = "-->" if found["comment"] else ">"
            close = html.find(mark, position - 2 if found["comment"] else position - 1)
            if close < 0:
                return
            position = close + len(mark)
            continue
        tag = found["tag"].lower()
        yield (END if found["end"] else START), tag
        if tag in _CLOSERS and not found["end"]:
            closer = _CLOSERS[tag].search(html, position)
            content = html[position : closer.start() if closer else len(html)]
            position += len(content)
            if content and tag not in HIDDEN_TAGS:
                yield VERBATIM, unescape(content) if tag in REFERENCE_TAGS else content
