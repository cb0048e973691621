"""Captured pages -> trees, or rows of nodes.

This is the only place where Python touches the data. A page's markup is read once into
flat arrays: the elements in document order with the place of the last element inside each,
and one text, as shown, in which every element's text is a slice. Memory is linear in the
page whatever its depth. ``page_trees`` hands a page over as one row of these arrays;
``html_nodes`` as one row per element with its chain of enclosing elements. Which element
is a grid, a label or a panel is decided afterwards by DataFrame expressions.
"""

from __future__ import annotations

import gc
import re
from collections.abc import Iterator, Sequence
from html import unescape
from itertools import accumulate
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NODE_FIELDS = (
    T.StructType()
    .add("pre", T.IntegerType())
    .add("post", T.IntegerType())
    .add("parent", T.IntegerType())
    .add("depth", T.IntegerType())
    .add("tag", T.StringType())
    .add("id", T.StringType())
    .add("cls", T.ArrayType(T.StringType()))
    .add("attrs", T.MapType(T.StringType(), T.StringType()))
    .add("text", T.StringType())
    .add("path", T.ArrayType(T.StructType().add("pre", T.IntegerType()).add("sel", T.StringType())))
)

TREE_NODE = (
    T.StructType()
    .add("i", T.IntegerType())
    .add("last", T.IntegerType())
    .add("up", T.IntegerType())
    .add("tag", T.StringType())
    .add("id", T.StringType())
    .add("cls", T.ArrayType(T.StringType()))
    .add("attrs", T.MapType(T.StringType(), T.StringType()))
    .add("start", T.IntegerType())
    .add("end", T.IntegerType())
)

# Fixed values of the HTML grammar.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style noscript iframe template".split())
PLAIN = frozenset("title textarea".split())
FORMATTING = frozenset("a b big code em font i nobr s small strike strong tt u".split())
UNNAMED = FORMATTING | {"html", "body"}  # part of a path only with an id or a class
BLOCK = frozenset(
    "address article aside blockquote caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol option p pre search section "
    "summary table tbody td tfoot th thead title tr ul".split()
)
ENDS_P = BLOCK - frozenset("caption dd dt li option tbody td tfoot th thead title tr".split()) | {"dd", "dt", "li"}
CELL_WALL = frozenset("table td th caption template html".split())
TABLE_WALL = frozenset(["table"])
_P = frozenset(["p"])
# start tag -> (open elements it ends, elements the search does not go past)
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu"} | CELL_WALL),
    "dt": ({"dt", "dd"}, {"dl"} | CELL_WALL),
    "dd": ({"dt", "dd"}, {"dl"} | CELL_WALL),
    "option": ({"option"}, {"select", "datalist"} | CELL_WALL),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"td", "th", "tr", "caption"}, {"table"}),
    "tbody": ({"td", "th", "tr", "tbody", "thead", "tfoot", "caption"}, {"table"}),
    "thead": ({"td", "th", "tr", "tbody", "thead", "tfoot", "caption"}, {"table"}),
    "tfoot": ({"td", "th", "tr", "tbody", "thead", "tfoot", "caption"}, {"table"}),
}
RULED = VOID | RAW | PLAIN | frozenset(IMPLIED_END)  # more happens at their start than that they are open
_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)"
    r"((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|\Z)",
    re.S,
)
# attribute texts whose quotes all close in them: what follows in the page can't change where such a tag ends
_CLOSED = re.compile(r"(?:[^>=\"']++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+")
_ATTR = re.compile(r"([^\s/>=]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.I) for t in RAW | PLAIN}
_SPACE = " \t\n\r\f"
_SPACES = re.compile(r"[ \t\n\r\f]{2,}|[\t\n\r\f]")
_NO_ATTRS: tuple = ((), (), None, [], "")
_seen_attrs: dict[str, tuple] = {}
_seen_tags: dict[str, tuple[str, str, tuple, bool]] = {}


def read_attrs(raw: str) -> tuple:
    """Attribute text -> (names, values, id, classes, selector part).

    Markup repeats itself, so short attribute texts are remembered.
    """
    found = _seen_attrs.get(raw)
    if found is not None:
        return found
    attrs: dict[str, str] = {}
    for key, double, single, bare in _ATTR.findall(raw):
        key = key.lower()
        if key not in attrs:
            value = double or single or bare
            attrs[key] = unescape(value) if "&" in value else value
    element_id = attrs.pop("id", None)
    classes = attrs.pop("class", "").split()
    sel = (f"#{element_id} " if element_id else "") + "".join(f".{c} " for c in classes)
    found = (tuple(attrs), tuple(attrs.values()), element_id, classes, sel)
    if len(raw) < 60:
        if len(_seen_attrs) > 5000:
            _seen_attrs.clear()
        _seen_attrs[raw] = found
    return found


def remember_tag(written: str, is_end: str, tag: str, raw: str) -> None:
    """Keep what a tag reads as, by how it is written; addresses seldom repeat, so tags with one are left out."""
    if len(written) < 60 and "href" not in raw and "src" not in raw and _CLOSED.fullmatch(raw):
        if len(_seen_tags) > 5000:
            _seen_tags.clear()
        _seen_tags[written] = (is_end, tag, read_attrs(raw) if raw else _NO_ATTRS, is_end == "" and tag not in RULED)


def absolute(url: str, address: str) -> str:
    """Address as a browser completes it; a fragment of the same page stays as it is."""
    if not address or address.startswith("#"):
        return address
    try:
        return urljoin(url, address)
    except ValueError:
        return address


class Page:
    """The elements of one page in document order, as arrays that are linear in its markup.

    ``up`` is the element around (-1 at the top), ``last`` the last element inside (itself
    without any), ``post`` the order of closing. ``start`` and ``end`` are the bytes of ``text``
    that an element shows: space runs are one space, a block's border is a line break.
    """

    def __init__(self, html: str):
        self.tag: list[str] = []
        self.attrs: list[tuple] = []
        self.up: list[int] = []
        self.last: list[int] = []
        self.post: list[int] = []
        self.depth: list[int] = []
        self.start: list[int] = []
        self.end: list[int] = []
        self.parts: list[bytes] = []
        self._read(html)
        self.text = b"".join(self.parts)
        del self.parts

    def shown(self, i: int) -> str:
        """The text of one element."""
        return self.text[self.start[i] : self.end[i]].decode("utf-8", "replace").strip(" \n")

    def _read(self, html: str) -> None:
        names: list[str] = []  # open elements and their places
        places: list[int] = []
        opened: dict[str, int] = {}  # how many of a tag are open: what isn't open need not be searched
        parts = self.parts
        tags, held, up, depth, last, post, starts, ends = (
            self.tag, self.attrs, self.up, self.depth, self.last, self.post, self.start, self.end
        )
        closed = size = 0
        gap = 0  # white space since the last text: 1 a space, 2 a line break

        def add(s: str) -> None:
            nonlocal gap, size
            core = s.strip(_SPACE)
            if not core:
                gap = max(gap, 1) if s else gap
                return
            if s[0] in _SPACE:
                gap = max(gap, 1)
            if gap and size:
                parts.append(b"\n" if gap == 2 else b" ")
                size += 1
            if "  " in core or not core.isprintable():
                core = _SPACES.sub(" ", core)
            raw = core.encode("utf-8", "replace")
            parts.append(raw)
            size += len(raw)
            gap = 1 if s[-1] in _SPACE else 0

        def close_top() -> None:
            nonlocal closed, gap
            tag, i = names.pop(), places.pop()
            if opened[tag] == 1:
                del opened[tag]
            else:
                opened[tag] -= 1
            post[i] = closed
            last[i] = len(tags) - 1
            ends[i] = size
            closed += 1
            if tag in BLOCK:
                gap = 2

        def close_from(index: int) -> None:
            while len(names) > index:
                close_top()

        def outermost(targets, walls) -> int:
            found = -1
            if not targets.isdisjoint(opened):
                for i in range(len(names) - 1, -1, -1):
                    n = names[i]
                    if n in targets:
                        found = i
                    elif n in walls:
                        break
            return found

        def open_element(tag: str, attrs: tuple) -> None:
            nonlocal closed, gap
            if "p" in opened and tag in ENDS_P:
                at = outermost(_P, CELL_WALL)
                if at >= 0:
                    close_from(at)
            rule = IMPLIED_END.get(tag)
            if rule is not None:
                at = outermost(*rule)
                if at >= 0:
                    close_from(at)
                if tag == "tr" and names and names[-1] == "table":
                    open_element("tbody", _NO_ATTRS)
            if tag in BLOCK or tag == "br":
                gap = 2
            i = len(tags)
            tags.append(tag)
            held.append(attrs)
            up.append(places[-1] if places else -1)
            depth.append(len(places))
            last.append(i)
            starts.append(size)
            ends.append(size)
            post.append(closed)
            if tag in VOID:
                closed += 1
                return
            names.append(tag)
            places.append(i)
            opened[tag] = opened.get(tag, 0) + 1

        at = 0
        length = len(html)
        while at < length:
            start = html.find("<", at)
            if start < 0:
                break
            stop = html.find(">", start) + 1
            known = _seen_tags.get(html[start:stop])
            if known is None:
                m = _TOKEN.search(html, at)
                if m is None:
                    break
                start, stop = m.span()
            if start > at:
                s = html[at:start]
                add(unescape(s) if "&" in s else s)
            at = stop
            if known is None:
                is_end, tag, raw = m.groups()
                if tag is None or html[at - 1] != ">":
                    continue  # no element; a tag that the page ends in is none either
                tag = tag.lower()
                attrs = read_attrs(raw) if raw and not is_end else _NO_ATTRS
                remember_tag(html[start:at], is_end, tag, raw)
            else:
                is_end, tag, attrs, free = known
                if free and not ("p" in opened and tag in ENDS_P):
                    # open_element where no rule applies, without the call
                    if tag in BLOCK:
                        gap = 2
                    i = len(tags)
                    tags.append(tag)
                    held.append(attrs)
                    up.append(places[-1] if places else -1)
                    depth.append(len(places))
                    last.append(i)
                    starts.append(size)
                    ends.append(size)
                    post.append(closed)
                    names.append(tag)
                    places.append(i)
                    opened[tag] = opened.get(tag, 0) + 1
                    continue
            if is_end:
                if names and names[-1] == tag:
                    close_top()
                    continue
                if tag not in opened:
                    if tag == "p":
                        open_element("p", _NO_ATTRS)
                        close_top()
                    continue
                walls = TABLE_WALL if tag in ("td", "th", "tr", "tbody", "thead", "tfoot", "caption") else CELL_WALL
                if tag in FORMATTING:
                    walls = BLOCK
                for i in range(len(names) - 1, -1, -1):
                    if names[i] == tag:
                        close_from(i)
                        break
                    if names[i] in walls:
                        break
                continue
            open_element(tag, attrs)
            if tag in RAW or tag in PLAIN:
                end = _RAW_END[tag].search(html, at)
                stop = end.start() if end else length
                if tag in PLAIN:
                    add(unescape(html[at:stop]))
                at = end.end() if end else length
                close_top()
        if at < length:
            add(unescape(html[at:]))
        close_from(0)
        open_element = None  # the function refers to itself; let go of the page at once

    def named(self, i: int) -> bool:
        """Whether an element is part of the chains of what lies in it."""
        return self.attrs[i][4] != "" or self.tag[i] not in UNNAMED

    def kept(self, tags: frozenset[str] | None, classes: frozenset[str] = frozenset()) -> list[int]:
        """Places of the elements with one of the tags or classes, of all without ``tags``."""
        if tags is None:
            return list(range(len(self.tag)))
        return [i for i, t in enumerate(self.tag) if t in tags or not classes.isdisjoint(self.attrs[i][3])]

    def chains(self, wanted: list[int]) -> Iterator[tuple[list[int], list[str]]]:
        """For every wanted element, in order: places and selectors of the named elements around it."""
        pre: list[int] = []
        sel: list[str] = []
        here = 0
        for i in wanted:
            while here < i:
                while pre and self.last[pre[-1]] < here:
                    pre.pop()
                    sel.pop()
                if self.last[here] > here and self.named(here):
                    pre.append(here)
                    sel.append(f"{self.tag[here]} {self.attrs[here][4]}")
                here += 1
            while pre and self.last[pre[-1]] < i:
                pre.pop()
                sel.pop()
            yield pre, sel


def page_of(html: str | None) -> Page:
    return Page((html or "").replace("\x00", ""))


def _offsets(values: list[int]) -> pa.Array:
    return pa.array(values, pa.int32())


class _Attrs:
    """Id, classes and attributes of elements as Arrow columns; ``url`` completes relative addresses."""

    def __init__(self) -> None:
        self.id: list[str | None] = []
        self.cls_at, self.cls = [0], []
        self.attr_at, self.attr_key, self.attr_value = [0], [], []

    def add(self, attrs: tuple, url: str | None) -> None:
        keys, values, element_id, classes, _ = attrs
        self.id.append(element_id)
        if classes:
            self.cls.extend(classes)
        self.cls_at.append(len(self.cls))
        if keys:
            if url and ("href" in keys or "src" in keys):
                values = [absolute(url, v) if k in ("href", "src") else v for k, v in zip(keys, values)]
            self.attr_key.extend(keys)
            self.attr_value.extend(values)
        self.attr_at.append(len(self.attr_key))

    def columns(self) -> list[pa.Array]:
        keys, values = pa.array(self.attr_key, pa.string()), pa.array(self.attr_value, pa.string())
        return [
            pa.array(self.id, pa.string()),
            pa.ListArray.from_arrays(_offsets(self.cls_at), pa.array(self.cls, pa.string())),
            pa.MapArray.from_arrays(_offsets(self.attr_at), keys, values),
        ]


def node_rows(
    page: Page, tags: frozenset[str] | None, texts: frozenset[str] | None, url: str | None, flush: int
) -> Iterator[list[pa.Array]]:
    """Node columns of a page in pieces of about ``flush`` rows, or as many entries of their chains."""
    wanted = page.kept(tags)
    chains = page.chains(wanted)
    at = 0
    while at < len(wanted):
        first = at
        held = _Attrs()
        text: list[str | None] = []
        path_at, path_pre, path_sel = [0], [], []
        size = 0
        while at < len(wanted) and at - first < flush and len(path_pre) < 50 * flush and size < 1000 * flush:
            i = wanted[at]
            at += 1
            held.add(page.attrs[i], url)
            text.append(page.shown(i) if (texts is None or page.tag[i] in texts) and page.tag[i] not in VOID else None)
            size += len(text[-1] or "")
            pre, sel = next(chains)
            path_pre.extend(pre)
            path_sel.extend(sel)
            path_at.append(len(path_pre))
        rows = wanted[first:at]
        path = pa.StructArray.from_arrays([pa.array(path_pre, pa.int32()), pa.array(path_sel, pa.string())], ["pre", "sel"])
        yield [
            pa.array(rows, pa.int32()),
            *(pa.array([x[i] for i in rows], pa.int32()) for x in (page.post, page.up, page.depth)),
            pa.array([page.tag[i] for i in rows], pa.string()),
            *held.columns(),
            pa.array(text, pa.string()),
            pa.ListArray.from_arrays(_offsets(path_at), path),
        ]


def html_nodes(
    pages: DataFrame,
    carry: Sequence[str] = (),
    tags: Sequence[str] | None = None,
    base: str | None = None,
    flush: int = 20_000,
    texts: Sequence[str] | None = None,
) -> DataFrame:
    """Element rows of every page: ``page_id``, the ``carry`` columns, then ``NODE_FIELDS``.

    ``carry`` copies page columns (group, page number ...) onto the rows so that they
    need not be joined back. ``tags`` limits which elements become rows, ``texts`` which of them bring
    their text (all by default). ``base`` names the column with the page's address, to
    complete relative ``href`` and ``src`` values the way a browser reports them. Rows are handed over in
    pieces of about ``flush``, so a task holds one page's arrays and a piece.
    """
    keys = ["page_id", *carry]
    source = pages.select(*keys, "html", *([F.col(base).alias("_base")] if base else []))
    schema = T.StructType([source.schema[k] for k in keys] + list(NODE_FIELDS.fields))
    keep = None if tags is None else frozenset(tags)
    say = None if texts is None else frozenset(texts)

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a page's many small objects all stay alive; collect garbage less often
        usual = gc.get_threshold()
        gc.set_threshold(200_000, 50, 50)
        try:
            for batch in batches:
                html = batch.column(len(keys))
                urls = batch.column(len(keys) + 1) if base else None
                pending: list[pa.RecordBatch] = []
                rows = 0
                for i in range(batch.num_rows):
                    for columns in node_rows(page_of(html[i].as_py()), keep, say, urls[i].as_py() if base else None, flush):
                        take = pa.array([i] * len(columns[0]), pa.int32())
                        held = [batch.column(k).take(take) for k in range(len(keys))]
                        pending.append(pa.RecordBatch.from_arrays(held + columns, names=schema.names))
                        rows += len(take)
                        if rows >= flush:
                            yield from pa.Table.from_batches(pending).combine_chunks().to_batches()
                            pending, rows = [], 0
                if pending:
                    yield from pa.Table.from_batches(pending).combine_chunks().to_batches()
        finally:
            gc.set_threshold(*usual)

    return source.mapInArrow(expand, schema)


def tree_columns(
    pages: list[tuple[Page, str | None]], tags: frozenset[str] | None, classes: frozenset[str] = frozenset()
) -> list[pa.Array]:
    """``text, nodes`` of several pages; places and ends count the kept elements only."""
    held = _Attrs()
    place, last, up, tag, start, end, at = [], [], [], [], [], [], [0]
    for page, url in pages:
        wanted = page.kept(tags, classes)
        number = [-1] * len(page.tag)
        for n, i in enumerate(wanted):
            number[i] = n
        upto = list(accumulate([n >= 0 for n in number]))  # kept elements up to each element
        around = []  # the named element around each element
        for i in page.up:
            around.append(i if i < 0 or page.named(i) else around[i])
        place.extend(range(len(wanted)))
        last.extend([upto[page.last[i]] - 1 for i in wanted])
        up.extend([number[around[i]] if around[i] >= 0 else -1 for i in wanted])
        tag.extend([page.tag[i] for i in wanted])
        start.extend([page.start[i] for i in wanted])
        end.extend([page.end[i] for i in wanted])
        for i in wanted:
            held.add(page.attrs[i], url)
        at.append(len(place))
    ints = [pa.array(x, pa.int32()) for x in (place, last, up)]
    bounds = [pa.array(x, pa.int32()) for x in (start, end)]
    nodes = pa.StructArray.from_arrays([*ints, pa.array(tag, pa.string()), *held.columns(), *bounds], TREE_NODE.names)
    return [pa.array([p.text for p, _ in pages], pa.binary()), pa.ListArray.from_arrays(_offsets(at), nodes)]


def page_trees(
    pages: DataFrame,
    carry: Sequence[str] = (),
    tags: Sequence[str] | None = None,
    base: str | None = None,
    flush: int = 20_000,
    classes: Sequence[str] = (),
) -> DataFrame:
    """One row per page: ``page_id``, the ``carry`` columns, ``text`` and ``nodes``.

    ``nodes`` holds the elements in document order: place ``i``, the place of the ``last`` element inside, of
    the element around (``up``, -1 at the top or if it isn't kept), tag, id, classes, attributes, and the bytes of ``text``
    from ``start`` to ``end`` that the element shows. So what lies in an element is a slice of ``nodes``, and its
    text a slice of ``text``. ``tags`` limits which elements are kept; elements of one of ``classes`` are whatever their tag.
    A page without markup has no nodes.
    """
    keys = ["page_id", *carry]
    source = pages.select(*keys, "html", *([F.col(base).alias("_base")] if base else []))
    schema = T.StructType([source.schema[k] for k in keys]).add("text", T.BinaryType()).add("nodes", T.ArrayType(TREE_NODE))
    keep = None if tags is None else frozenset(tags)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        usual = gc.get_threshold()
        gc.set_threshold(200_000, 50, 50)
        try:
            for batch in batches:
                html = batch.column(len(keys))
                urls = batch.column(len(keys) + 1) if base else None
                some: list[tuple[Page, str | None]] = []
                first = size = 0
                for i in range(batch.num_rows):
                    some.append((page_of(html[i].as_py()), urls[i].as_py() if base else None))
                    size += len(some[-1][0].tag)
                    if size >= flush or i + 1 == batch.num_rows:
                        held = [batch.column(k).slice(first, len(some)) for k in range(len(keys))]
                        yield pa.RecordBatch.from_arrays(held + tree_columns(some, keep, frozenset(classes)), names=schema.names)
                        first, size, some = i + 1, 0, []
        finally:
            gc.set_threshold(*usual)

    return source.mapInArrow(read, schema)


def register_html_nodes(spark: SparkSession) -> None:
    """Offer ``LATERAL html_nodes(html)`` to SQL users of this session."""

    def eval(self, html: str):
        for columns in node_rows(page_of(html), None, None, None, 20_000):
            for r in pa.RecordBatch.from_arrays(columns, names=NODE_FIELDS.names).to_pylist(maps_as_pydicts="lossy"):
                yield tuple(r[n] if n != "path" else [(p["pre"], p["sel"]) for p in r[n]] for n in NODE_FIELDS.names)

    spark.udtf.register("html_nodes", F.udtf(type("HtmlNodesUdtf", (), {"eval": eval}), returnType=NODE_FIELDS))
