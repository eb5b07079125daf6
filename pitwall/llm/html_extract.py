"""Main text of web pages by wrappers: union-free regular expressions inferred
for each host.

A page is read as a stream of block tags and text slots, which nests into a
tree.  Its expression is inferred as the host's pages are aligned one after the
other.  Inside a page, neighbours of equal shape, or runs of several tags that
repeat, become one repeated group.  Between pages (and between wrappers, so
that partial results merge) the sequences of each level are aligned by their
longest common subsequence.  What only one side has becomes optional, what one
side has repeated becomes repeated, and equal slots whose texts differ become
variable.  There are no alternatives.

Every task merges the pages it reads into one wrapper a host; partial wrappers
meet in rounds of ``FAN_IN``, whatever share of the pages a host has.  The
finished wrapper is labelled once: menus, headers, footers, sidebars, notices,
adverts, forms and comments by their tags and class words; the article by its
element, or else as the group that holds the variable, unlinked text.  A page is
then parsed along its host's wrapper and gives the slots of the labelled groups.

Wrappers are bounded: texts enter as digests, levels deeper than ``DEEPEST`` are
read as part of the level above, and a level of more than ``WIDEST`` items
keeps one repeated item for each tag.

Defined results.  A null or empty page, or one without text, gives an empty
text.  A null url belongs to the host ''.  Character references are decoded;
white space inside a block becomes one space (a line break tag too); blocks are
joined by one newline.  Inside a header element of the article only headings
count.  Unclosed tags, missing end tags and unfinished comments are read as
browsers read them.  A page in which the wrapper labels no article is its own
wrapper.  Repeated rows give repeated results.  Columns other than page_id, url
and html are not read.  Empty tables give an empty result.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwall.llm.shared import fresh, staged

FAN_IN = 32
DEEPEST, WIDEST = 40, 48
#: A task hands on its wrappers once it holds so many hosts.
HOSTS_AT_ONCE = 4096
#: Wrappers are broadcast up to this many characters in all (checked).
BROADCAST_CHARS = 48_000_000
#: Else pages meet them in so many parts of each host.
SALTS = 32

# -- fixed values: tags and words ------------------------------------------

BLOCKS = frozenset(
    "address article aside blockquote caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul button svg object video audio canvas template map".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
DROPPED = frozenset("aside audio button canvas dialog fieldset footer form map menu nav object optgroup option search select svg template video".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
CONTAINERS = frozenset("body center div section table tbody tr td details figure blockquote dl ul ol".split())
ENDS = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "tbody": {"table"}, "thead": {"table"}, "tfoot": {"table"}, "option": {"select"}, "optgroup": {"select"}}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"tbody", "thead", "tfoot"}, "thead": {"tbody", "thead"}, "tfoot": {"tbody", "thead"}, "option": {"option"}, "optgroup": {"option", "optgroup"}}
#: Words of classes, ids and roles that mark what is not the article.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup login nav navbar navigation menu breadcrumb breadcrumbs pagination pager masthead topbar footer contentinfo sidebar complementary widget related recommended recommendations share sharing social comment comments disqus replies respond toolbar search dialog".split()
)

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*+>?"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:\"[^\"]*+\"|'[^']*+'|[^'\">])*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[a-z]+")


# -- pages -----------------------------------------------------------------

@lru_cache(1 << 14)
def _signature(name: str, attributes: str) -> str:
    """``name`` and its class words; '!' in front marks what is dropped, '@'
    what names itself the main part."""
    found = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(attributes)}
    classes = sorted(set(_WORD.findall(found.get("class", "").lower())))
    words = set(classes) | set(_WORD.findall((found.get("id", "") + " " + found.get("role", "")).lower()))
    own = "@" if name in ("article", "main") or found.get("role", "").lower() == "main" or found.get("itemprop", "").lower() == "articlebody" else ""
    if name in DROPPED or "hidden" in found or (words & MARKS and not own):
        return f"!{name}" + "".join(f".{c}" for c in classes[:4])
    if name == "header" or "header" in words:
        own = "^"
    return f"{own}{name}" + "".join(f".{c}" for c in classes[:4])


def tag_of(signature: str) -> str:
    return signature.lstrip("!@^").split(".")[0]


class Node:
    """An element (or a slot, signature '#') of a page."""

    __slots__ = ("signature", "kids", "text", "linked")

    def __init__(self, signature: str, text: str = "", linked: int = 0):
        self.signature, self.kids, self.text, self.linked = signature, [], text, linked


def parse(page: str) -> Node:
    """Tree of the page's blocks and slots."""
    root = Node("body")
    stack, names = [root], ["body"]
    pieces: list[str] = []
    link = linked = 0

    def flush():
        nonlocal linked, link
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            pieces.clear()
            if text:
                stack[-1].kids.append(Node("#", text, min(linked, len(text))))
        linked = link = 0

    def pop_to(i: int):
        del stack[i:], names[i:]

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        text = page[at : m.start() if m else end]
        if text:
            pieces.append(text)
            if link:
                linked += len(text)
        if not m:
            break
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        if m[1] or m[4]:  # an end tag
            if name == "a":
                link = 0
            if name in BLOCKS or name in names:
                flush()
                for i in range(len(names) - 1, 0, -1):
                    if names[i] == name:
                        pop_to(i)
                        break
            continue
        if name in RAW:
            close = re.compile(rf"</{name}(?=[\s/>])[^>]*+>?", re.I).search(page, at)
            at = close.end() if close else end
            continue
        attributes = m[3] or m[6] or ""
        if name not in BLOCKS:
            if name == "br":
                pieces.append(" ")
            elif name == "a":
                link = 1
            if name in VOID or not attributes or name in ("html", "body", "head"):
                continue
            signature = _signature(name, attributes)
            if signature[0] != "!" or attributes.rstrip().endswith("/"):
                continue
        else:
            signature = _signature(name, attributes)
        flush()
        if names[-1] == "p" and name in BLOCKS:
            pop_to(len(names) - 1)
        if name in CLOSES:
            for i in range(len(names) - 1, 0, -1):
                if names[i] in CLOSES[name]:
                    pop_to(i)
                    break
                if names[i] in ENDS[name]:
                    break
        if name in VOID or len(stack) >= DEEPEST:
            continue
        node = Node(signature)
        stack[-1].kids.append(node)
        stack.append(node)
        names.append(name)
    flush()
    return root


# -- expressions -----------------------------------------------------------
# An item is a dict: s signature, k items inside, o optional, r repeated, g a
# group of several items (its signature names them), n pages that have it; for
# slots also t digest of the text (None: variable), c characters, l linked ones.

def expression(node: Node) -> dict:
    if node.signature == "#":
        return {"s": "#", "k": [], "o": 0, "r": 0, "g": 0, "n": 1, "t": xxhash.xxh64_hexdigest(node.text), "c": len(node.text), "l": node.linked}
    return {"s": node.signature, "k": _bounded(fold([expression(k) for k in node.kids])), "o": 0, "r": 0, "g": 0, "n": 1}


def _alike(a: dict, b: dict) -> bool:
    """Neighbours that are one repeated item: same signature, similar inside."""
    if a["s"] != b["s"]:
        return False
    x, y = {k["s"] for k in a["k"]}, {k["s"] for k in b["k"]}
    return not x or not y or 2 * len(x & y) >= min(len(x), len(y))


def _repeated(a: dict, b: dict) -> dict:
    both = merge(a, b)
    both["n"], both["r"] = max(a["n"], b["n"]), 1
    return both


def fold(items: list[dict]) -> list[dict]:
    """Runs that repeat, of one item and then of more, become repeated items."""
    out: list[dict] = []
    for x in items:
        if out and x["s"] != "#" and _alike(out[-1], x):
            out[-1] = _repeated(out[-1], x)
        else:
            out.append(x)
    width = 2
    while 2 * width <= len(out):
        i = 0
        while i + 2 * width <= len(out):
            names = [x["s"] for x in out[i : i + width]]
            if names != [x["s"] for x in out[i + width : i + 2 * width]] or "(" in "".join(names):
                i += 1
                continue
            group = _group(out[i : i + width])
            end = i + width
            while [x["s"] for x in out[end : end + width]] == names:
                group = _repeated(group, _group(out[end : end + width]))
                end += width
            out[i:end] = [group]
            i += 1
        width += 1
    return out


def _group(items: list[dict]) -> dict:
    return {"s": "(" + " ".join(x["s"] for x in items) + ")", "k": items, "o": 0, "r": 0, "g": 1, "n": max(x["n"] for x in items)}


def _regrouped(items: list[dict], groups: list[dict]) -> list[dict]:
    """Items that stand alone on one side as a group's body count as the group."""
    for g in groups:
        names, width, i = [x["s"] for x in g["k"]], len(g["k"]), 0
        out = []
        while i < len(items):
            if [x["s"] for x in items[i : i + width]] == names:
                out.append(_group(items[i : i + width]))
                i += width
            else:
                out.append(items[i])
                i += 1
        items = out
    return items


def merge(a: dict, b: dict) -> dict:
    out = {"s": a["s"], "k": merge_items(a["k"], b["k"]), "o": a["o"] | b["o"], "r": a["r"] | b["r"], "g": a["g"], "n": a["n"] + b["n"]}
    if a["s"] == "#":
        out |= {"t": a["t"] if a["t"] == b["t"] else None, "c": a["c"] + b["c"], "l": a["l"] + b["l"]}
    return out


def merge_items(a: list[dict], b: list[dict]) -> list[dict]:
    """Align two levels; what has no counterpart becomes optional."""
    if len(a) == len(b) and all(x["s"] == y["s"] for x, y in zip(a, b)):
        return [merge(x, y) for x, y in zip(a, b)]
    known = {x["s"] for x in a if x["g"]}, {x["s"] for x in b if x["g"]}
    a, b = _regrouped(a, [x for x in b if x["g"] and x["s"] not in known[0]]), _regrouped(b, [x for x in a if x["g"] and x["s"] not in known[1]])
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i]["s"] == b[j]["s"] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and a[i]["s"] == b[j]["s"]:
            out.append(merge(a[i], b[j]))
            i, j = i + 1, j + 1
        elif j >= len(b) or (i < len(a) and best[i + 1][j] >= best[i][j + 1]):
            out.append({**a[i], "o": 1})
            i += 1
        else:
            out.append({**b[j], "o": 1})
            j += 1
    return _bounded(fold_optional(out))


def fold_optional(items: list[dict]) -> list[dict]:
    """After alignment a repeated item may have an optional neighbour of its
    own kind: it takes it in."""
    out: list[dict] = []
    for x in items:
        if out and x["s"] != "#" and out[-1]["s"] == x["s"] and (out[-1]["r"] or x["r"]):
            last, both = out[-1], _repeated(out[-1], x)
            both["o"] = last["o"] & x["o"]
            out[-1] = both
        else:
            out.append(x)
    return out


def _bounded(items: list[dict]) -> list[dict]:
    """A level that is too wide keeps one repeated item for each tag."""
    if len(items) <= WIDEST:
        return items
    by_tag: dict[str, dict] = {}
    todo = items[::-1]
    while todo:
        x = todo.pop()
        if x["g"]:
            todo.extend(x["k"][::-1])
            continue
        mark = x["s"][0] if x["s"][0] in "!@^" else ""
        key = mark + (tag_of(x["s"]) if tag_of(x["s"]) in BLOCKS or x["s"] == "#" else "div")
        x = {**x, "s": key, "o": 1, "r": 1}
        by_tag[key] = _repeated(by_tag[key], x) if key in by_tag else x
    return list(by_tag.values())


# -- labels ----------------------------------------------------------------

def label(wrapper: dict) -> dict:
    """Mark the groups that hold the article (m) and what is left out (x)."""

    def has_main(x: dict) -> bool:
        return x["s"][0] == "@" or any(has_main(k) for k in x["k"])

    def outermost(x: dict, tags: tuple) -> list[dict]:
        if x.get("x"):
            return []
        if x["s"][0] == "@" and (not tags or tag_of(x["s"]) in tags):
            return [x]
        return [m for k in x["k"] for m in outermost(k, tags)]

    def mark(x: dict) -> None:
        x["x"] = int(x["s"][0] == "!" and (tag_of(x["s"]) in DROPPED or not has_main(x)))
        for k in x["k"]:
            mark(k)

    def weight(x: dict, constant: bool) -> int:
        if x.get("x") or x["s"][0] == "^":
            return 0
        own = 0
        if x["s"] == "#":
            own = 0 if x["t"] is not None and x["n"] > 1 and not constant else max(0, x["c"] - 2 * x["l"])
        return own + sum(weight(k, constant) for k in x["k"])

    mark(wrapper)
    main = outermost(wrapper, ("article",)) or outermost(wrapper, ())
    if not main:
        constant = not weight(wrapper, False)
        at = wrapper
        while True:
            whole, inside, todo = weight(at, constant), [], list(at["k"])
            while todo:
                k = todo.pop()
                if k["g"]:
                    todo.extend(k["k"])
                elif tag_of(k["s"]) in CONTAINERS and 10 * weight(k, constant) >= 8 * whole > 0:
                    inside.append(k)
            if not inside or any(k["r"] for k in inside):
                break
            at = inside[0]
        main = [at]
        if not constant:
            _leave_constants(at)
    for x in main:
        x["m"] = 1
    return wrapper


def _leave_constants(x: dict) -> None:
    """Where only the text tells the article, texts that three and more pages
    have alike belong to the template."""
    if x["s"] == "#" and x["t"] is not None and x["n"] >= 3:
        x["x"] = 1
    for k in x["k"]:
        _leave_constants(k)


def _slim(x: dict) -> list:
    """What extraction reads of a labelled wrapper."""
    return [x["s"], x.get("m", 0), x.get("x", 0), [_slim(k) for k in x["k"]], x["g"]]


# -- extraction ------------------------------------------------------------

def _flat(items: list, out: list) -> list:
    for x in items:
        if x[4]:
            _flat(x[3], out)
        else:
            out.append(x)
    return out


def extract(root: Node, wrapper: list) -> list[str] | None:
    """Blocks of the article by the labelled wrapper; None where it labels no
    part of this page."""
    out: list[str] = []
    found = False

    def walk(node: Node, item: list | None, inside: bool, heading_only: bool) -> None:
        nonlocal found
        if item is not None and item[2]:
            return
        if item is None and node.signature[0] == "!":
            return
        if item is not None and item[1]:
            inside = found = True
        if node.signature == "#":
            if inside and not heading_only:
                out.append(node.text)
            return
        tag = tag_of(node.signature)
        if node.signature[0] == "^":
            heading_only = True
        elif tag in HEADINGS:
            heading_only = False
        if item is None:
            for k in node.kids:
                walk(k, None, inside, heading_only)
            return
        # Parse the level along the wrapper: each item may be left out or come
        # again, groups start over.
        items = _flat(item[3], [])
        at = 0
        for k in node.kids:
            hit = next((i for i in range(at, len(items)) if items[i][0] == k.signature), None)
            if hit is None:
                hit = next((i for i in range(len(items)) if items[i][0] == k.signature), None)
            if hit is None:  # a level that was too wide names tags only
                bare = (k.signature[0] if k.signature[0] in "!@^" else "") + tag_of(k.signature)
                hit = next((i for i in range(len(items)) if items[i][0] == bare), None)
            at = at if hit is None else hit
            walk(k, None if hit is None else items[hit], inside, heading_only)

    walk(root, wrapper, False, False)
    return out if found else None


# -- the job ---------------------------------------------------------------

def host(url: Column) -> Column:
    """Lower-cased host of a url, without user and port."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One wrapper for each host of the pages a task reads."""
    held: dict[str, dict] = {}

    def handed():
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array([json.dumps(w) for w in held.values()], pa.string())], names=["host", "wrapper"])

    for batch in batches:
        for name, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            mine = expression(parse(page or ""))
            held[name] = merge(held[name], mine) if name in held else mine
            if len(held) >= HOSTS_AT_ONCE:
                yield handed()
                held.clear()
    yield handed()


def _merged(table: pa.Table) -> pa.Table:
    """One wrapper from those of a group, in an order that repeats."""
    whole = None
    for text in sorted(table["wrapper"].to_pylist()):
        whole = json.loads(text) if whole is None else merge(whole, json.loads(text))
    return pa.table({"host": pa.array([table["host"][0].as_py()], pa.string()), "wrapper": pa.array([json.dumps(whole)], pa.string())})


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        slim = [json.dumps(_slim(label(json.loads(w)))) for w in batch.column("wrapper").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(slim, pa.string())], names=["host", "wrapper"])


def wrappers(pages: DataFrame) -> DataFrame:
    """host, wrapper: the labelled wrapper of every host."""
    parts = staged(pages.select("host", "html").mapInArrow(_infer, "host string, wrapper string"), "html-wrappers")
    while True:
        most = parts.groupBy("host").count().agg(F.max("count")).first()[0] or 0
        if most <= 1:
            break
        if most <= FAN_IN:
            groups = F.lit(0)
        else:
            groups = F.pmod(F.xxhash64("wrapper", F.monotonically_increasing_id()), F.lit(-(-most // FAN_IN)))
        parts = staged(parts.withColumn("part", groups).groupBy("host", "part").applyInArrow(lambda t: _merged(t), "host string, wrapper string"), "html-wrappers")
    return staged(parts.mapInArrow(_labelled, "host string, wrapper string"), "html-labelled")


@lru_cache(4096)
def _loaded(text: str) -> list:
    return json.loads(text)


def _texts(names: list[str], text: str, n_chars: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for page, wrapper in zip(batch.column("html").to_pylist(), batch.column("wrapper").to_pylist()):
                root = parse(page or "")
                blocks = extract(root, _loaded(wrapper)) if wrapper is not None else None
                if blocks is None:
                    blocks = extract(root, _slim(label(expression(root)))) or []
                found.append("\n".join(blocks))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(found, pa.string()), pa.array([len(x) for x in found], pa.int64())], names=[*names, text, n_chars])

    return run


def main_text(pages: DataFrame, *, keys: tuple[str, ...] = ("page_id", "url"), url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The ``keys`` of every page, text and n_chars."""
    names = list(keys)
    held = pages.select(*names, host(F.col(url_col)).alias("host"), F.col(html_col).cast("string").alias("html"))
    labelled = wrappers(held)
    size = labelled.agg(F.coalesce(F.sum(F.length("wrapper")), F.lit(0))).first()[0]
    if size <= BROADCAST_CHARS:
        met = held.join(F.broadcast(labelled), "host", "left")
    else:
        salt = fresh(held, "salt")
        many = labelled.withColumn(salt, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        met = held.withColumn(salt, F.pmod(F.xxhash64("html"), F.lit(SALTS))).join(many, ["host", salt], "left")
    schema = ", ".join([*[f"`{c}` {held.schema[c].dataType.simpleString()}" for c in names], "text string", "n_chars long"])
    return met.select(*names, "html", "wrapper").mapInArrow(_texts(names, "text", "n_chars"), schema)
