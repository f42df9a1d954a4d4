"""Main text of web pages by inferred wrappers: union-free regular expressions, one per host.

A page becomes a stream of structure tags and texts. Runs that repeat side by side become a repeated group.
Streams of one host are aligned one after another: equal texts stay fixed, differing ones become slots,
what only one side has becomes an optional group. Each task folds its own pages into a wrapper per host;
these partial wrappers are aligned again in ``SPLITS`` parts and then per host, so a host with very many
pages takes no single task. Beside the wrapper stands on how many pages each path had text and whether it
was one text. The slots of a wrapper that can hold an article are then read off, and each page is extracted
with the slots of its host: those in an article container where the page has text there, else the others.
"""

from __future__ import annotations

import bisect
import html
import json
import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwork.llm.common import table
from gleanwork.workspace import materialise

SPLITS = 64
LONGEST_PERIOD = 12
MOST_HOSTS = 2000
#: Longer lists are cut at items that occur once before their common parts are looked for.
MOST_CELLS = 250_000
FIXED_PAGES = 3
FIXED_SHARE = 0.9

# Tags by their part in a page, and the words by which classes and ids name what is no article.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set(
    "html head title body address article aside blockquote canvas dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup li main menu nav ol p pre section summary table tbody td tfoot th thead "
    "tr ul button select option iframe object".split()
)
HIDDEN = set("head title script style noscript template svg math iframe object canvas".split())
NOT_ARTICLE = set("nav header footer aside form menu dialog button select option fieldset".split())
ARTICLE = set("article main".split())
CLOSES_P = BLOCK - {"html", "head", "title", "body"}
SAME_LEVEL = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = set("ul ol dl table article section div body main select".split())
NOISE_WORDS = set(
    "ad ads advert advertisement adverts banner sidebar menu nav navbar navigation breadcrumb breadcrumbs cookie cookies "
    "notice notices consent popup modal promo promotion sponsor sponsored social share sharing related comment comments "
    "reply replies respond newsletter subscribe login signup footer header masthead toolbar widget pagination".split()
)
ARTICLE_WORDS = set("content article post entry story main".split())
#: Names with one of these say how a page looks: has-sidebar, no-cookie, ad-free, comments-open.
STATE_WORDS = set(
    "has have with without no not non is free off on less open closed enabled disabled active hidden visible layout template".split()
)
#: What may stand around an article and is never noise by its names, or not for an article in it.
WHOLE = set("html body main article".split())
AROUND = set("form fieldset".split())

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|svg|math|iframe|textarea|title)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*+(?:\"[^\"]*+\"[^>\"']*+|'[^']*+'[^>\"']*+)*+[^>]*+)>"
    r"|<[!?/][^>]*>",
    re.S | re.I,
)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
WORDS = re.compile(r"[a-z]+")


def label(tag: str, attributes: str) -> str:
    """The tag with the names of its class, id and role, their words joined by ``-``; digits don't count."""
    if "=" not in attributes:
        return tag
    names = ["-".join(WORDS.findall(name)) for found in NAMES.findall(attributes) for name in "".join(found).lower().split()]
    return ".".join([tag, *(name for name in dict.fromkeys(names) if name)])


def parse(page: str):
    """Yields ``("open", label)``, ``("close", label)`` and ``("text", path, raw text, all in links)``.

    Only block tags count. An open paragraph, list item or cell ends where the next one or a block begins;
    a closing tag that matches nothing is passed over, and the end of the page closes all that is open.
    """
    stack: list[tuple[str, str]] = []
    paths = [""]
    piece: list[str] = []
    linked, unlinked, in_link = False, False, False
    at = 0
    last = page.rfind(">") + 1

    def flush():
        nonlocal piece, linked, unlinked
        text = "".join(piece)
        out = ("text", paths[-1], text, linked and not unlinked) if text and not text.isspace() else None
        piece, linked, unlinked = [], False, False
        return out

    def add(raw):
        nonlocal linked, unlinked
        piece.append(raw)
        if not raw.isspace():
            linked, unlinked = linked or in_link, unlinked or not in_link

    def pop():
        paths.pop()
        return ("close", stack.pop()[1])

    for found in MARKUP.finditer(page, 0, last):
        if found.start() > at:
            add(page[at : found.start()])
        at = found.end()
        tag = found[3]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            piece.append(" ")
            continue
        if tag == "a":
            in_link = not found[2]
        if tag not in BLOCK:
            continue
        text = flush()
        if text:
            yield text
        if found[2]:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    while len(stack) > depth:
                        yield pop()
                    break
                if tag == "p" and stack[depth][0] != "p":
                    break
            continue
        if tag in CLOSES_P and stack and stack[-1][0] == "p":
            yield pop()
        for depth in range(len(stack) - 1, -1, -1) if tag in SAME_LEVEL else ():
            if stack[depth][0] in SAME_LEVEL[tag]:
                while len(stack) > depth:
                    yield pop()
                if tag != "tr" or not stack or stack[-1][0] not in SAME_LEVEL[tag]:
                    break
            elif stack[depth][0] in SCOPE:
                break
        name = label(tag, found[4])
        if tag not in VOID:
            stack.append((tag, name))
            paths.append(paths[-1] + "/" + name)
            yield ("open", name)
    if at < len(page):
        add(page[at:])
    text = flush()
    if text:
        yield text
    while stack:
        yield pop()


# A wrapper is a list of items: ["<", label], [">", label], ["x", mark or None, paths], ["+", items] and
# ["?", items]. A text keeps the paths at which it stood, as an optional group may hold an opening tag alone.


def key(item):
    return "#" if item[0] == "x" else item[0] + item[1] if item[0] in "<>" else item[0] + str(key(item[1][0]))


def unify(a, b):
    """One item for two of the same key."""
    if a[0] == "x":
        return a if a == b else ["x", a[1] if a[1] == b[1] else None, sorted({*a[2], *b[2]})]
    return a if a[0] in "<>" else [a[0], align(a[1], b[1])]


def spread(items, optional=False):
    """Items with their key and whether they are optional; optional groups give way to their items."""
    for item in items:
        if item[0] == "?":
            yield from spread(item[1], True)
        else:
            yield key(item), item, optional


def gather(marked) -> list:
    """The list again; optional items side by side become one group."""
    out: list = []
    for _, item, optional in marked:
        if not optional:
            out.append(item)
        elif out and out[-1][0] == "?":
            out[-1][1].append(item)
        else:
            out.append(["?", [item]])
    return out


def align(a: list, b: list) -> list:
    """The wrapper of two wrappers. What both have stays, what one has becomes optional.

    A wrapper that was made from a stream takes that stream in again without growing.
    """
    return gather(_align(list(spread(a)), list(spread(b))))


def _both(x, y):
    return x[0], unify(x[1], y[1]), x[2] or y[2]


def _align(a: list, b: list) -> list:
    head = 0
    while head < min(len(a), len(b)) and a[head][0] == b[head][0]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail][0] == b[-1 - tail][0]:
        tail += 1
    front = [_both(x, y) for x, y in zip(a[:head], b[:head])]
    back = [_both(x, y) for x, y in zip(a[len(a) - tail :], b[len(b) - tail :])]
    a, b = a[head : len(a) - tail], b[head : len(b) - tail]
    if a and b:
        pairs = _longest_common(a, b) if len(a) * len(b) <= MOST_CELLS else _anchors(a, b)
    else:
        pairs = []
    middle, i0, j0 = [], 0, 0
    for i, j in [*pairs, (len(a), len(b))]:
        if pairs and len(a) * len(b) > MOST_CELLS:
            middle += _align(a[i0:i], b[j0:j])
        else:
            middle += [(k, item, True) for k, item, _ in a[i0:i] + b[j0:j]]
        if i < len(a):
            middle.append(_both(a[i], b[j]))
        i0, j0 = i + 1, j + 1
    return front + middle + back


def _longest_common(a: list, b: list) -> list[tuple[int, int]]:
    """Positions of a longest common subsequence of the keys."""
    best = [[0] * (len(b) + 1)]
    for i in range(len(a) - 1, -1, -1):
        below, line = best[-1], [0] * (len(b) + 1)
        for j in range(len(b) - 1, -1, -1):
            line[j] = below[j + 1] + 1 if a[i][0] == b[j][0] else max(below[j], line[j + 1])
        best.append(line)
    best.reverse()
    pairs, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i][0] == b[j][0]:
            pairs.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return pairs


def _anchors(a: list, b: list) -> list[tuple[int, int]]:
    """For long lists: the longest rising run of keys that occur once on either side."""
    in_a, in_b = Counter(k for k, _, _ in a), Counter(k for k, _, _ in b)
    place = {k: j for j, (k, _, _) in enumerate(b) if in_b[k] == 1}
    once = [(i, place[k]) for i, (k, _, _) in enumerate(a) if in_a[k] == 1 and k in place]
    ends, tops, before = [], [], []
    for n, (_, j) in enumerate(once):
        slot = bisect.bisect_left(ends, j)
        before.append(tops[slot - 1] if slot else -1)
        ends[slot : slot + 1], tops[slot : slot + 1] = [j], [n]
    chain, n = [], tops[-1] if tops else -1
    while n >= 0:
        chain.append(once[n])
        n = before[n]
    return chain[::-1]


def is_balanced(items: list) -> bool:
    """Whether each tag of the run opens and closes within it."""
    depth = 0
    for item in items:
        depth += (item[0] == "<") - (item[0] == ">")
        if depth < 0:
            return False
    return depth == 0


def fold_repeats(items: list) -> list:
    """Runs of whole elements that follow themselves become one repeated group, shortest runs first."""
    for period in range(1, LONGEST_PERIOD + 1):
        keys, out, i = [key(x) for x in items], [], 0
        while i < len(items):
            again = keys[i][0] not in ">#" and keys[i : i + period] == keys[i + period : i + 2 * period]
            if not again or len(keys) - i < 2 * period or not is_balanced(items[i : i + period]):
                out.append(items[i])
                i += 1
                continue
            times = 2
            while keys[i : i + period] == keys[i + times * period : i + (times + 1) * period]:
                times += 1
            group = items[i : i + period]
            for n in range(1, times):
                group = [unify(x, y) for x, y in zip(group, items[i + n * period : i + (n + 1) * period])]
            out.append(["+", group])
            i += times * period
        items = out
    return items


def page_items(page: str) -> list:
    items = []
    for event in parse(page):
        if event[0] == "text":
            items.append(["x", zlib.crc32(" ".join(event[2].split()).encode("utf-8", "replace")), [event[1]]])
        else:
            items.append(["<" if event[0] == "open" else ">", event[1]])
    return items


def page_stream(page: str) -> list:
    return fold_repeats(page_items(page))


# Facts of pages: for pages without an article container and for those with one, their number and the
# least FIXED_PAGES marks of their texts; for each path its mark (None: texts differ) and both numbers of pages.


def page_facts(items: list) -> dict:
    texts: dict[str, list] = {}
    for item in items:
        if item[0] == "x" and path_kind(item[2][0]) != "noise":
            texts.setdefault(item[2][0], []).append(item[1])
    which = int(any(path_kind(path) == "article" for path in texts))
    count = [1 - which, which]
    marks = {path: zlib.crc32(repr(found).encode()) for path, found in texts.items()}
    whole = zlib.crc32(repr(sorted(marks.items())).encode())
    return {
        "pages": count,
        "marks": [[whole] * n for n in count],
        "paths": {path: [mark, *count] for path, mark in marks.items()},
    }


def add_facts(a: dict, b: dict) -> dict:
    """The facts of both; ``a`` is changed."""
    a["pages"] = [x + y for x, y in zip(a["pages"], b["pages"])]
    a["marks"] = [sorted({*x, *y})[:FIXED_PAGES] for x, y in zip(a["marks"], b["marks"])]
    for path, (mark, *count) in b["paths"].items():
        known = a["paths"].get(path)
        if known is None:
            a["paths"][path] = [mark, *count]
        else:
            known[:] = [mark if mark == known[0] else None, known[1] + count[0], known[2] + count[1]]
    return a


def is_boilerplate(path: str, facts: dict) -> bool:
    """Whether one text stands here on nearly all pages without an article, or nearly all pages of the
    host, and these are not all the same page."""
    mark, *count = facts["paths"].get(path, (None, 0, 0))
    plain = (count[0], facts["pages"][0], facts["marks"][0])
    every = (sum(count), sum(facts["pages"]), set().union(*facts["marks"]))
    return mark is not None and any(
        len(marks) >= FIXED_PAGES and seen >= FIXED_SHARE * pages for seen, pages, marks in (plain, every)
    )


def slots(items: list):
    """``(path, fixed)`` of each text of a wrapper, once for each path at which it stood."""
    for item in items:
        if item[0] == "x":
            for path in item[2]:
                yield path, item[1] is not None
        elif item[0] in "+?":
            yield from slots(item[1])


def names_noise(names: list[str]) -> bool:
    """Whether a name begins or ends with a noise word and is not the name of a state."""
    for name in names:
        words = name.split("-")
        if (words[0] in NOISE_WORDS or words[-1] in NOISE_WORDS) and STATE_WORDS.isdisjoint(words):
            return True
    return False


def is_noise(name: str) -> bool:
    tag, *names = name.split(".")
    return tag in NOT_ARTICLE or tag in HIDDEN or tag not in WHOLE and names_noise(names)


def is_article(name: str) -> bool:
    tag, *names = name.split(".")
    return tag in ARTICLE or tag not in WHOLE and any(w in ARTICLE_WORDS for n in names for w in n.split("-"))


def path_kind(path: str) -> str:
    """``article`` in an article container, ``noise`` in menus, headers and the like, else ``plain``.

    An article element outweighs forms and noisy names around it, not those in it, unless its own name is
    noisy, as that of a comment is. Other containers in noisy names are ``plain``.
    """
    tags = path.split("/")[1:]
    if not any(map(is_noise, tags)):
        return "article" if any(map(is_article, tags)) else "plain"
    last = max(at for at, name in enumerate(tags) if is_noise(name))
    around = [name.split(".")[0] for name in tags[: last + 1]]
    if any((tag in NOT_ARTICLE or tag in HIDDEN) and tag not in AROUND for tag in around):
        return "noise"
    inner = [name for name in tags[last + 1 :] if is_article(name) and not names_noise(name.split(".")[1:])]
    if any(name.split(".")[0] in ARTICLE for name in inner):
        return "article"
    return "plain" if inner else "noise"


def content_paths(wrapper: list, facts: dict) -> list[str]:
    """The paths of the slots that can hold the article: those in article containers, and for pages without
    one all others outside menus, headers and the like that are no boilerplate."""
    chosen = set()
    for path, fixed in slots(wrapper):
        kind = path_kind(path)
        if kind == "article" or kind == "plain" and not (fixed and is_boilerplate(path, facts)):
            chosen.add(path)
    return sorted(chosen)


def main_text(page: str, paths: set[str]) -> str:
    """The blocks at these paths: those in article containers, or all if the page has no text in one.
    Outside an article, blocks that are nothing but links are left out."""
    article, others = [], []
    for event in parse(page):
        if event[0] == "text" and event[1] in paths:
            inside = path_kind(event[1]) == "article"
            if event[3] and not inside:
                continue
            text = " ".join(html.unescape(event[2]).split())
            if text:
                (article if inside else others).append(text)
    return "\n".join(article or others)


WRAPPERS = pa.schema([("host", pa.string()), ("part", pa.int32()), ("wrapper", pa.string()), ("facts", pa.string())])


def _partial_wrappers(batches):
    folded: dict[str, list] = {}

    def rows():
        hosts = sorted(folded)
        parts = [zlib.crc32(folded[h][0].encode()) % SPLITS for h in hosts]
        arrays = [
            pa.array(hosts, pa.string()),
            pa.array(parts, pa.int32()),
            pa.array([json.dumps(folded[h][1]) for h in hosts], pa.string()),
            pa.array([json.dumps(folded[h][2]) for h in hosts], pa.string()),
        ]
        return pa.RecordBatch.from_arrays(arrays, schema=WRAPPERS)

    for batch in batches:
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            items = page_items(page)
            facts, stream = page_facts(items), fold_repeats(items)
            known = folded.get(host)
            if known is None:
                folded[host] = [page[-200:], stream, facts]
            else:
                known[1], known[2] = align(known[1], stream), add_facts(known[2], facts)
            if len(folded) > MOST_HOSTS:
                yield rows()
                folded.clear()
    if folded:
        yield rows()


def _merge(rows: pa.Table):
    wrapper, facts = None, {"pages": [0, 0], "marks": [[], []], "paths": {}}
    for text in sorted(rows.column("wrapper").to_pylist()):
        items = json.loads(text)
        wrapper = items if wrapper is None else align(wrapper, items)
    for text in rows.column("facts").to_pylist():
        add_facts(facts, json.loads(text))
    return wrapper or [], facts


def _merge_part(key: tuple, rows: pa.Table) -> pa.Table:
    wrapper, facts = _merge(rows)
    return pa.Table.from_arrays(
        [pa.array([key[0].as_py()]), pa.array([key[1].as_py()], pa.int32()), pa.array([json.dumps(wrapper)]), pa.array([json.dumps(facts)])],
        schema=WRAPPERS,
    )


def _merge_host(key: tuple, rows: pa.Table) -> pa.Table:
    wrapper, facts = _merge(rows)
    return pa.table(
        {
            "host": pa.array([key[0].as_py()]),
            "wrapper": pa.array([json.dumps(wrapper)]),
            "pages": pa.array([sum(facts["pages"])], pa.int64()),
            "paths": pa.array([content_paths(wrapper, facts)], pa.list_(pa.string())),
        }
    )


def _extract(schema: pa.Schema):
    def run(batches):
        for batch in batches:
            texts = [
                main_text(page, set(paths or ()))
                for page, paths in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            ]
            arrays = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())]
            yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, schema)], schema=schema)

    return run


def host_of(url):
    """The host in lower case; empty for a null address or one without a host."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def infer_wrappers(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """``host, wrapper`` (JSON), ``pages, paths`` (of the article's slots) per host."""
    rows = pages.select(host_of(F.col(url)).alias("host"), F.coalesce(F.col(page), F.lit("")).alias("html"))
    ddl = "host string, part int, wrapper string, facts string"
    partial = rows.mapInArrow(_partial_wrappers, ddl)
    merged = partial.groupBy("host", "part").applyInArrow(_merge_part, ddl)
    return merged.groupBy("host").applyInArrow(_merge_host, "host string, wrapper string, pages long, paths array<string>")


def page_texts(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every row.

    White space within a block becomes one blank, blocks are joined by a line feed. A null, empty or
    broken page gives the text that its tags allow, at least the empty text. Pages without a host share a
    wrapper. Repeated rows are extracted one by one; an empty table gives no rows.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    wrappers = materialise(infer_wrappers(pages, url, page).select("host", "paths"), "page-wrappers")
    rows = pages.select(
        F.col(page_id).alias("page_id"),
        F.col(url).alias("url"),
        F.coalesce(F.col(page), F.lit("")).alias("html"),
        host_of(F.col(url)).alias("host"),
    )
    kind = pages.schema[page_id].dataType
    fields = [("page_id", to_arrow_type(kind)), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())]
    joined = rows.join(wrappers, "host", "left").select("page_id", "url", "html", "paths")
    return joined.mapInArrow(
        _extract(pa.schema(fields)), f"page_id {kind.simpleString()}, url string, text string, n_chars long"
    )


def op6_html_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_texts(table(spark, sf_dir, "pages"))


BOOK = {"op6_html_wrappers": (op6_html_wrappers, None)}
