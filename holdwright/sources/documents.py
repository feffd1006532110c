"""Tables of HTML filings and facts of XBRL instances."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.text import holds

TABLES = "doc string, idx long, pos long, text string, grid array<array<string>>"
_TYPES = {"doc": pa.string(), "idx": pa.int64(), "pos": pa.int64(), "text": pa.string(), "grid": pa.list_(pa.list_(pa.string()))}
# A start tag with quoted attributes that need no reading, or an end tag; and tags whose content is no markup.
_ATTRIBUTE = r"""[ \t\n\r\f]+([a-zA-Z][a-zA-Z0-9-]*)=(?:"([^"<>&]*)"|'([^'<>&]*)')"""
_TAG = re.compile(r"<(?:/([a-zA-Z][a-zA-Z0-9]*)|([a-zA-Z][a-zA-Z0-9]*)((?:%s)*))[ \t\n\r\f]*>" % re.sub(r"\((?!\?)", "(?:", _ATTRIBUTE))
_NO_MARKUP = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript", "plaintext"}


class _Tables(HTMLParser):
    """The outermost tables of a page: offset of the start, and rows of (text, colspan)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[int, list[list[tuple[str, int]]]]] = []
        self.depth, self.cell, self.span = 0, None, 1
        self.line, self.at = [0], None

    def read(self, html: str) -> list[tuple[int, list[list[tuple[str, int]]]]]:
        tags = list(_TAG.finditer(html))
        if len(tags) == html.count("<") and _NO_MARKUP.isdisjoint((m[1] or m[2]).lower() for m in tags):
            self._read_plain(html, tags)
        else:
            for part in html.split("\n")[:-1]:
                self.line.append(self.line[-1] + len(part) + 1)
            self.feed(html)
            self.close()
        self._end_cell()
        return self.found

    def _read_plain(self, html: str, tags: list[re.Match]) -> None:
        """The parser's events for a page of plain tags alone, which is most of the time of such a page."""
        done = 0
        for m in tags:
            self.at = m.start()
            if self.cell is not None:
                self.handle_data(unescape(html[done : self.at]))
            done = m.end()
            if m[1]:
                self.handle_endtag(m[1].lower())
            else:
                self.handle_starttag(m[2].lower(), [(k.lower(), v or w) for k, v, w in re.findall(_ATTRIBUTE, m[3])] if m[3] else [])
        self.handle_data(unescape(html[done:]))

    def _end_cell(self) -> None:
        if self.cell is not None:
            self.found[-1][1][-1].append((" ".join("".join(self.cell).split()), self.span))
            self.cell = None

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.depth += 1
            if self.depth == 1:
                row, col = self.getpos()
                self.found.append((self.line[row - 1] + col if self.at is None else self.at, []))
        elif self.depth == 1 and tag == "tr":
            self._end_cell()
            self.found[-1][1].append([])
        elif self.depth == 1 and tag in ("td", "th"):
            self._end_cell()
            if not self.found[-1][1]:
                self.found[-1][1].append([])
            self.cell, self.span = [], _span(attrs)
        elif self.cell is not None and tag == "br":
            self.cell.append(" ")

    def handle_endtag(self, tag):
        if tag == "table" and self.depth:
            if self.depth == 1:
                self._end_cell()
            self.depth -= 1
        elif self.depth == 1 and tag in ("td", "th", "tr"):
            self._end_cell()

    def handle_data(self, data):
        if self.cell is not None:
            self.cell.append(data)


# What a tag is to the tables of a page; ODD tags are left to the parser.
_OTHER, _TABLE, _TABLE_END, _ROW, _ROW_END, _CELL, _CELL_END, _ODD = range(8)
_STARTS, _ENDS = {"table": _TABLE, "tr": _ROW, "td": _CELL, "th": _CELL}, {"table": _TABLE_END, "tr": _ROW_END, "td": _CELL_END, "th": _CELL_END}
#: Characters of pages that are looked at together.
_TOGETHER = 4 << 20


def _span(attrs: list[tuple[str, str]]) -> int:
    span = dict(attrs).get("colspan") or "1"
    return min(max(int(span) if span.isdecimal() else 1, 1), 200)


def _kind_of_tag(tag: bytes) -> tuple[int, int]:
    """(kind, columns) of a tag's text."""
    m = _TAG.fullmatch(tag.decode(errors="replace"))
    if not m or (m[1] or m[2]).lower() in _NO_MARKUP:
        return _ODD, 1
    kind = (_ENDS if m[1] else _STARTS).get((m[1] or m[2]).lower(), _OTHER)
    return kind, _span([(k.lower(), v or w) for k, v, w in re.findall(_ATTRIBUTE, m[3])]) if kind == _CELL and m[3] else 1


def _kinds(data: np.ndarray, at: np.ndarray, end: np.ndarray, known: dict[bytes, tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Kinds and columns of the tags from at to before end; a text is looked at once."""
    kind, span = np.full(len(at), _ODD, np.int8), np.ones(len(at), np.int64)
    size = end - at
    short = np.flatnonzero((size >= 3) & (size <= 8))
    key, padded = np.zeros(len(short), np.uint64), np.concatenate([data, np.zeros(8, np.uint8)])
    for k in range(8):
        key |= np.where(k < size[short], padded[at[short] + k], 0).astype(np.uint64) << np.uint64(8 * k)
    found, where = np.unique(key, return_inverse=True)
    kind[short] = np.array([_kind_of_tag(int(k).to_bytes(8, "little").rstrip(b"\0"))[0] for k in found], np.int8)[where] if len(found) else 0
    for i in np.flatnonzero(size > 8).tolist():
        tag = data[at[i] : end[i]].tobytes()
        if tag not in known:
            if len(known) > 100_000:
                known.clear()
            known[tag] = _kind_of_tag(tag)
        kind[i], span[i] = known[tag]
    return kind, span


def _plain_tables(data: np.ndarray, edge: np.ndarray, repeat: bool, known: dict) -> tuple[np.ndarray, np.ndarray, dict[str, pa.Array]]:
    """(pages that are not plain, page of each table, columns pos, text and grid) of pages that lie between edges in data.

    Plain pages have plain tags alone, no table within a table, and cells that hold no tags and stand in a row. The tags of all
    pages are looked at together; what the parser would make of them is in ``_Tables``.
    """
    pages = len(edge) - 1
    at, gt = np.flatnonzero(data == 60), np.flatnonzero(data == 62)
    after = np.searchsorted(gt, at)
    end = np.append(gt + 1, len(data) + 1)[after]
    page = np.searchsorted(edge, at, "right") - 1
    odd = np.zeros(pages, bool)
    whole = end <= edge[page + 1]
    odd[page[~whole]] = True
    at, end, page = at[whole], end[whole], page[whole]
    kind, span = _kinds(data, at, end, known)
    odd[page[kind == _ODD]] = True

    # Depth within a page: 1 between a table's start and end.
    step = (kind == _TABLE).astype(np.int64) - (kind == _TABLE_END)
    depth = np.append(0, np.cumsum(step))
    first = np.searchsorted(page, np.arange(pages + 1))
    depth = depth - np.append(depth[first[:-1]], 0)[np.append(page, pages)]
    inside = depth[:-1] + step
    odd[page[(inside < 0) | (inside > 1)]] = True
    some = first[1:] > first[:-1]
    odd[np.flatnonzero(some)[inside[first[1:][some] - 1] != 0]] = True

    # A cell's tag is followed by one that ends the cell, and has a row of its table before it.
    table = np.cumsum(kind == _TABLE) - 1
    row = (kind == _ROW) & (inside == 1)
    rows = np.cumsum(row) - 1
    cell = np.flatnonzero((kind == _CELL) & (inside == 1))
    ends = np.append(np.isin(kind, (_ROW, _ROW_END, _CELL, _CELL_END, _TABLE_END)), False)
    table_of_row = np.append(table[row], -1)
    odd[page[cell[~ends[cell + 1] | (table_of_row[rows[cell]] != table[cell])]]] = True

    good = ~odd[page]
    tables = np.flatnonzero((kind == _TABLE) & good)
    kept_rows = np.flatnonzero(row & good)
    cell = cell[good[cell]]
    number = np.full(len(kind) + 1, -1)
    number[tables] = np.arange(len(tables))
    nth = np.full(len(kind) + 1, -1)
    nth[kept_rows] = np.arange(len(kept_rows))
    tags_of_tables, tags_of_rows = np.flatnonzero(kind == _TABLE), np.flatnonzero(row)
    row_table = number[tags_of_tables[table[kept_rows]]]
    cell_row = nth[tags_of_rows[rows[cell]]]

    # Texts: between a cell's tag and the next. Those with references, other than plain characters or spaces to squeeze are read one by one.
    begin, stop = end[cell], np.append(at, 0)[cell + 1]
    space = data == 32
    unlike = (data < 32) | (data > 126) | (data == 38)
    unlike[1:] |= space[1:] & (space[:-1] | (data[:-1] == 62))
    unlike[:-1] |= space[:-1] & (data[1:] == 60)
    spots = np.flatnonzero(unlike)
    read = np.flatnonzero(np.searchsorted(spots, stop) > np.searchsorted(spots, begin))
    offsets = np.append(np.column_stack([begin, stop]).ravel(), [len(data), len(data)]).astype(np.int32)
    if len(begin):
        offsets[-2:] = stop[-1]
    texts = pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(data))
    source = np.arange(len(cell)) * 2
    none = len(offsets) - 2
    if len(read):
        fixed = [" ".join(unescape(data[begin[i] : stop[i]].tobytes().decode()).split()) for i in read.tolist()]
        source[read] = len(texts) + np.arange(len(read))
        texts = pa.concat_arrays([texts, pa.array(fixed, pa.string())])
    own = texts.take(pa.array(source))
    filled = pc.binary_length(own).to_numpy(zero_copy_only=False) > 0 if len(cell) else np.zeros(0, bool)

    # The grid: a row's cells by their columns, rows as wide as the widest of the table.
    wide = span[cell]
    row_width = np.bincount(cell_row, wide, len(kept_rows)).astype(np.int64)
    width = np.zeros(len(tables), np.int64)
    np.maximum.at(width, row_table, row_width)
    row_from = np.append(0, np.cumsum(width[row_table]))
    before = np.append(0, np.cumsum(wide))
    starts = np.searchsorted(cell_row, np.arange(len(kept_rows)))
    column = before[:-1] - before[starts[cell_row]]
    place = row_from[cell_row] + column
    out = np.full(row_from[-1], none)
    if repeat:
        out[np.repeat(place, wide) + np.arange(before[-1]) - np.repeat(before[:-1], wide)] = np.repeat(source, wide)
    else:
        out[place] = source
    lists = pa.ListArray.from_arrays(pa.array(row_from, pa.int32()), texts.take(pa.array(out)))
    grid = pa.ListArray.from_arrays(pa.array(np.searchsorted(row_table, np.arange(len(tables) + 1)), pa.int32()), lists)
    seen = np.searchsorted(row_table[cell_row[filled]], np.arange(len(tables) + 1))
    text = pc.binary_join(pa.ListArray.from_arrays(pa.array(seen, pa.int32()), own.filter(pa.array(filled))), " ")
    pos = at[tables] - edge[page[tables]]
    # Offsets count characters, not bytes.
    more = np.flatnonzero((data & 0xC0) == 0x80)
    pos = pos - (np.searchsorted(more, at[tables]) - np.searchsorted(more, edge[page[tables]]))
    return odd, page[tables], {"pos": pa.array(pos, pa.int64()), "text": text, "grid": grid}


def html_tables(pages: DataFrame, doc: str, html: str, repeat: bool = True, least: int = 50) -> DataFrame:
    """TABLES of every page: those with at least ``least`` characters, in order, with their offset.

    The grid is rectangular: a cell over several columns repeats its text (or is followed by
    blanks), short rows are padded. Plain pages are read many at once, others by the parser.
    """

    def parsed(names: list, htmls: list) -> pa.RecordBatch:
        out = {c: [] for c in _TYPES}
        for name, page in zip(names, htmls, strict=True):
            n = 0
            for pos, rows in _Tables().read(page) if page else []:
                grid = [[t if repeat or k == 0 else "" for t, span in row for k in range(span)] for row in rows]
                text = " ".join(t for row in rows for t, _ in row if t)
                if len(text) < least:
                    continue
                width = max(map(len, grid), default=0)
                for c, v in zip(out.values(), (name, n, pos, text, [r + [""] * (width - len(r)) for r in grid]), strict=True):
                    c.append(v)
                n += 1
        return pa.RecordBatch.from_arrays([pa.array(out[c], k) for c, k in _TYPES.items()], list(_TYPES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, tuple[int, int]] = {}
        for b in batches:
            if not b.num_rows:
                continue
            names, htmls = b.column(0), pc.fill_null(b.column(1), "").cast(pa.large_binary())
            edges = np.frombuffer(htmls.buffers()[1], np.int64)[htmls.offset : htmls.offset + len(htmls) + 1]
            every = np.frombuffer(htmls.buffers()[2], np.uint8) if edges[-1] else np.zeros(0, np.uint8)
            i = 0
            while i < b.num_rows:
                j = max(i + 1, int(np.searchsorted(edges, edges[i] + _TOGETHER, "right")) - 1)
                odd, page, columns = _plain_tables(every[edges[i] : edges[j]], edges[i : j + 1] - edges[i], repeat, known)
                stays = pc.utf8_length(columns["text"]).to_numpy(zero_copy_only=False) >= least
                page = page[stays]
                columns = {c: v.filter(pa.array(stays)) for c, v in columns.items()}
                nth = np.arange(len(page)) - np.searchsorted(page, page)
                if len(page):
                    yield pa.RecordBatch.from_arrays([names.take(pa.array(page + i)), pa.array(nth, pa.int64()), columns["pos"], columns["text"], columns["grid"]], list(_TYPES))
                if odd.any():
                    left = pa.array(np.flatnonzero(odd) + i)
                    yield parsed(names.take(left).to_pylist(), b.column(1).take(left).to_pylist())
                i = j

    return pages.select(F.col(doc).cast("string").alias("doc"), F.col(html).alias("html")).mapInArrow(run, TABLES)


def cells(tables: DataFrame) -> DataFrame:
    """(doc, idx, r, c, text), a row for each cell that isn't blank."""
    rows = tables.select("doc", "idx", F.posexplode("grid").alias("r", "row"))
    return rows.select("doc", "idx", "r", F.posexplode("row").alias("c", "text")).filter(F.trim("text") != "")


def is_investment_table(text: Column) -> Column:
    """A schedule of investments by its phrases: one of the first, or two words of the second beside money and a legal form."""
    low = F.lower(text)
    has = lambda words: holds(low, [[words]])
    second = sum((F.contains(low, F.lit(w)).cast("int") for w in vocab.SCHEDULE_WORDS), F.lit(0))
    return has(vocab.SCHEDULE_PHRASES) | ((second >= 2) & has(vocab.SCHEDULE_MONEY) & has(vocab.SCHEDULE_FORMS))


def before_prior_year(tables: DataFrame, prior: Column) -> DataFrame:
    """A document's tables before the first of the prior year; all of them if it is the first."""
    w = Window.partitionBy("doc").orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    d = tables.withColumn("__past", F.max(prior.cast("int")).over(w)).withColumn("__kept", F.sum((F.col("__past") == 0).cast("int")).over(Window.partitionBy("doc")))
    return d.filter((F.col("__past") == 0) | (F.col("__kept") == 0)).drop("__past", "__kept")


def under_headings(elements: DataFrame, doc: str, pos: str, heading: Column, stop: Column, wanted: Column, prior: Column, other: Column) -> DataFrame:
    """Of a filing's elements in order: those wanted under a heading, up to the next stop or the heading's first of the prior year.

    A filing where no heading leads to any has those that ``other`` finds by their content. Conditions that are null don't hold.
    """
    so = lambda c: F.coalesce(c, F.lit(False))
    run = Window.partitionBy(doc).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    mark = F.when(so(heading), F.struct(F.col(pos).alias("at"), F.lit(True).alias("open"))).when(so(stop), F.struct(F.col(pos).alias("at"), F.lit(False).alias("open")))
    d = elements.withColumn("__m", F.last(mark, ignorenulls=True).over(run))
    part = Window.partitionBy(doc, "__m.at").orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("__past", F.max(so(wanted & prior)).over(part))
    d = d.withColumn("__in", so(wanted) & so(F.col("__m.open")) & ~F.col("__past"))
    d = d.withColumn("__any", F.max("__in").over(Window.partitionBy(doc)))
    return d.filter(F.col("__in") | (~F.col("__any") & so(wanted) & so(other))).select(*elements.columns)


CONTEXTS = "doc string, id string, instant string, start string, end string, dimensions map<string,string>"
FACTS = "doc string, context string, concept string, unit string, decimals string, value string"


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _instance(xml: str | None) -> tuple[list[tuple], list[tuple]]:
    """Contexts and facts of one instance, read as a stream; none of a document that breaks off or is no XML."""
    import io
    from xml.etree import ElementTree

    contexts, facts, depth = [], [], 0
    try:
        for event, e in ElementTree.iterparse(io.BytesIO((xml or "<x/>").encode()), events=("start", "end")):
            depth += 1 if event == "start" else -1
            if event == "start" or depth != 1:
                continue
            if _local(e.tag) == "context":
                named = {_local(x.tag): (x.text or "").strip() for x in e.iter()}
                dims = {}
                for x in e.iter():
                    if x.get("dimension"):
                        parts = [t for t in map(str.strip, x.itertext()) if t]
                        dims[x.get("dimension")] = " | ".join(parts)  # a typed member that is split over elements
                contexts.append((e.get("id"), named.get("instant"), named.get("startDate"), named.get("endDate"), dims))
            elif e.get("contextRef"):
                facts.append((e.get("contextRef"), _local(e.tag), e.get("unitRef"), e.get("decimals"), (e.text or "").strip()))
            e.clear()
    except ElementTree.ParseError:
        return [], []
    return contexts, facts


def _instances(frames: Iterator[pd.DataFrame], contexts: bool) -> Iterator[pd.DataFrame]:
    names = ["doc", "id", "instant", "start", "end", "dimensions"] if contexts else ["doc", "context", "concept", "unit", "decimals", "value"]
    for pdf in frames:
        out = [(doc, *row) for doc, xml in zip(pdf["doc"], pdf["xml"], strict=True) for row in _instance(xml)[0 if contexts else 1]]
        yield pd.DataFrame(out, columns=names)


def xbrl_contexts(instances: DataFrame, doc: str, xml: str) -> DataFrame:
    d = instances.select(F.col(doc).cast("string").alias("doc"), F.col(xml).alias("xml"))
    return d.mapInPandas(lambda frames: _instances(frames, True), CONTEXTS)


def xbrl_facts(instances: DataFrame, doc: str, xml: str) -> DataFrame:
    d = instances.select(F.col(doc).cast("string").alias("doc"), F.col(xml).alias("xml"))
    return d.mapInPandas(lambda frames: _instances(frames, False), FACTS)


def positions(contexts: DataFrame, facts: DataFrame, period: str) -> DataFrame:
    """Facts of contexts with a dimension at the period (instant, or end where there is none)."""
    at = contexts.filter((F.size("dimensions") > 0) & (F.coalesce("instant", "end") == period))
    return facts.join(at.select("doc", F.col("id").alias("context"), "dimensions"), ["doc", "context"])
