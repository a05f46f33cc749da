"""Landed departure and arrival boards (HTML) as flight documents.

Python only turns a page into rows of cell texts and attributes. All patterns
and rules are column expressions, so they run in the JVM.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.zones import board_times_to_utc
from ..session import ship_package
from .landing import NAME_PATTERN

CELL = "struct<text: string, parts: array<string>, terminal: string, gate: string, delays: array<string>>"
ROW_SCHEMA = (
    "path string, row_no int, number string, href string, place string, airline string, "
    f"departure {CELL}, arrival {CELL}, arrival_mark string, status string, next_text string, next_code string, "
    "error string"
)

# Class marks of the board page.
TABLE, HEADER, COMPENSATION, NO_FLIGHTS = "flightsTable", "flightsTable-header", "compensation-row", "noflights"
DELAYED = ("estimatedTime arrDelayed", "estimatedTime depDelayed")
VOID = {"br", "img", "hr", "input", "meta", "link", "wbr", "col", "source", "area", "base", "embed"}

# Text and the plain tag, comment or doctype behind it, which every version of ``HTMLParser`` reads alike.
TOKEN = re.compile(
    r"""([^<]*)<(?:([a-zA-Z][a-zA-Z0-9]*)((?:[ \t\n]+[a-zA-Z][a-zA-Z0-9_-]*="[^"]*")*)[ \t\n]*(/?)>"""
    r"""|/([a-zA-Z][a-zA-Z0-9]*)[ \t\n]*>|!--(?!-?>)(?:[^-]|-(?!-))*-->|!(?:doctype|DOCTYPE)[ \t\n][^<>]*>)"""
)
ATTRIBUTE = re.compile(r"""([a-zA-Z][a-zA-Z0-9_-]*)="([^"]*)\"""")
NO_ATTRIBUTES: dict[str, str | None] = {}
# Elements whose content is no markup, or is not in some versions.
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript", "plaintext"}


class _Page(HTMLParser):
    """Elements of a page in document order, from one pass.

    Element ``i`` has the text ``text[starts[i]:ends[i]]`` and its descendants are the elements
    ``i + 1`` up to ``subs[i]``. Open elements are a plain stack, so tags that are
    never closed cost no recursion, and an end tag without a start is known at once.

    Plain markup is read token by token here; from the first token that is anything else, the rest of the page
    goes to ``HTMLParser``.
    """

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.tags: list[str] = []
        self.attrs: list[dict[str, str | None]] = []
        self.starts: list[int] = []
        self.ends: list[int] = []
        self.subs: list[int] = []
        self.pieces: list[str] = []
        self.size = 0
        self.open: list[int] = []
        self.open_tags: Counter[str] = Counter()
        rest = self._plain(html)
        if rest < len(html):
            self.feed(html[rest:])
            self.close()
        for last in self.open:
            self.ends[last], self.subs[last] = self.size, len(self.tags)
        self.text = "".join(self.pieces)

    def _plain(self, html: str) -> int:
        """Read plain tokens; where the first other one, or the text before it, begins."""
        at, size = 0, 0
        tags, attrs, starts, ends, subs, opened, open_tags = (
            self.tags, self.attrs, self.starts, self.ends, self.subs, self.open, self.open_tags
        )
        for found in TOKEN.finditer(html):
            if found.start() != at:
                break
            text, tag, marks, single, closed = found.groups()
            if tag:
                tag = tag.lower()
                if tag in RAW:
                    break
            if text:
                if "&" in text:
                    text = unescape(text)
                self.pieces.append(text)
                size += len(text)
            if tag:
                attrs.append({
                    name.lower(): unescape(value) if "&" in value else value for name, value in ATTRIBUTE.findall(marks)
                } if marks else NO_ATTRIBUTES)
                tags.append(tag)
                starts.append(size)
                ends.append(size)
                subs.append(len(tags))
                if not single and tag not in VOID:
                    opened.append(len(tags) - 1)
                    open_tags[tag] = open_tags.get(tag, 0) + 1
            elif closed:
                closed = closed.lower()
                while open_tags.get(closed):
                    last = opened.pop()
                    ends[last], subs[last] = size, len(tags)
                    open_tags[tags[last]] -= 1
                    if tags[last] == closed:
                        break
            at = found.end()
        self.size = size
        return at

    def handle_starttag(self, tag, attrs):
        self.tags.append(tag)
        self.attrs.append(dict(attrs) if attrs else {})
        self.starts.append(self.size)
        self.ends.append(self.size)
        self.subs.append(len(self.tags))
        if tag not in VOID:
            self.open.append(len(self.tags) - 1)
            self.open_tags[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._end_last()

    def handle_endtag(self, tag):
        while self.open_tags[tag]:
            if self._end_last() == tag:
                return

    def handle_data(self, data):
        self.pieces.append(data)
        self.size += len(data)

    def _end_last(self) -> str:
        last = self.open.pop()
        self.ends[last], self.subs[last] = self.size, len(self.tags)
        self.open_tags[self.tags[last]] -= 1
        return self.tags[last]

    def classes(self, i: int) -> list[str]:
        return (self.attrs[i].get("class") or "").split()

    def said(self, i: int) -> str:
        return self.text[self.starts[i] : self.ends[i]].strip()

    def inside(self, i: int | None, tag: str | None = None, mark: str | None = None) -> Iterator[int]:
        """Descendants of element ``i`` (of the page if None) with a tag and a class."""
        k, end = (0, len(self.tags)) if i is None else (i + 1, self.subs[i])
        while k < end:
            if tag is not None:
                try:
                    k = self.tags.index(tag, k, end)
                except ValueError:
                    return
            if mark is None or mark in self.classes(k):
                yield k
            k += 1

    def first(self, i: int | None, tag: str | None = None, mark: str | None = None) -> int | None:
        return next(self.inside(i, tag, mark), None)


def _cell(page: _Page, cell: int) -> dict:
    terminal, gate = page.first(cell, mark="terminal"), page.first(cell, mark="gate")
    return {
        "text": page.said(cell),
        # Only parts that may hold a clock time are looked at.
        "parts": [t for t in map(page.said, page.inside(cell)) if ":" in t],
        "terminal": page.said(terminal) if terminal is not None else "",
        "gate": page.said(gate) if gate is not None else "",
        "delays": [
            page.attrs[k]["data-delay"] or "" for k in page.inside(cell, "span")
            if " ".join(page.classes(k)) in DELAYED and "data-delay" in page.attrs[k]
        ],
    }


def page_rows(path: str, html: str | None) -> list[dict]:
    """The flight rows of one page, each with its following compensation row."""
    page = _Page(html or "")
    table = page.first(None, "table", TABLE)
    if table is None or page.first(None, "span", NO_FLIGHTS) is not None:
        return []
    rows, out = list(page.inside(table, "tr")), []
    for i, row in enumerate(rows):
        marks = page.classes(row)
        if HEADER in marks or COMPENSATION in marks or page.first(row, "th") is not None:
            continue
        cells = list(page.inside(row, "td"))
        if len(cells) < 6:
            continue
        link, place, airline = (page.first(cell, "a") for cell in cells[:3])
        status = page.first(cells[5], "span")
        times = [page.attrs[k].get("data-arrivaltime") for k in page.inside(cells[5], "button")]
        after = rows[i + 1] if i + 1 < len(rows) and COMPENSATION in page.classes(rows[i + 1]) else None
        note = page.first(after, "td") if after is not None else None
        out.append({
            "path": path, "row_no": i,
            "number": page.said(link) if link is not None else "",
            "href": (page.attrs[link].get("href") or "") if link is not None else None,
            "place": page.said(place) if place is not None else None,
            "airline": page.said(airline if airline is not None else cells[2]),
            "departure": _cell(page, cells[3]), "arrival": _cell(page, cells[4]),
            "arrival_mark": next((m for m in times if m), None),
            "status": page.said(status) if status is not None else "",
            "next_text": page.said(note) if note is not None else None,
            "next_code": page.attrs[after].get("data-cs") if note is not None else None,
            "error": None,
        })
    return out


def parsed_pages(pages: DataFrame) -> DataFrame:
    """Board rows of pages (``path``, ``html``); a page that cannot be read is one row with ``error``."""
    ship_package(pages.sparkSession)
    schema = pages.sparkSession.createDataFrame([], ROW_SCHEMA).schema

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(schema)
        for batch in batches:
            rows: list[dict] = []
            for path, html in zip(*(c.to_pylist() for c in batch.columns)):
                try:
                    rows += page_rows(path, html)
                except (AssertionError, ValueError) as error:
                    # What the parser raises on declarations it cannot read.
                    rows.append({"path": path, "error": f"{type(error).__name__}: {error}"})
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return pages.select("path", "html").mapInArrow(parse, ROW_SCHEMA)


def board_rows(pages: DataFrame) -> DataFrame:
    """Raw board rows from pages with ``path`` and ``html``."""
    return parsed_pages(pages).filter("error is null").drop("error")


def unreadable_pages(pages: DataFrame) -> DataFrame:
    """Path and error of pages that gave no rows because they cannot be read."""
    return parsed_pages(pages).filter("error is not null").select("path", "error")


# ---- rules -------------------------------------------------------------------

CLOCK = r"\d{1,2}:\d{2}"


def _times(cell: str) -> Column:
    """Clock times of a cell, notes in brackets removed, in order.

    Times of the inner elements count once each; only without any the cell's
    own text is read.
    """
    def found(text: Column) -> Column:
        return F.regexp_extract_all(
            F.regexp_replace(text, r"\s*\[.*?\]", ""), F.lit(CLOCK), F.lit(0)
        )

    timed = F.filter(f"{cell}.parts", lambda part: part.rlike(CLOCK))
    inner = F.array_distinct(F.flatten(F.transform(timed, found)))
    return F.when(F.size(inner) > 0, inner).otherwise(found(F.col(f"{cell}.text")))


def _edge(times: Column, index: int) -> Column:
    return F.coalesce(F.try_element_at(times, F.lit(index)), F.lit(""))


def _delay(cell: str) -> Column:
    """First positive delay mark, else not delayed."""
    minutes = F.filter(
        F.transform(f"{cell}.delays", lambda d: F.trim(d).try_cast("int")), lambda d: d > 0
    )
    first = F.coalesce(F.get(minutes, 0), F.lit(0))
    return F.struct((first > 0).alias("is_delayed"), first.alias("minutes"))


def _pattern(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def flight_documents(rows: DataFrame, airports: DataFrame) -> DataFrame:
    """Board rows with ``airport``, ``board_type`` and ``board_date`` as flight documents."""
    code = F.regexp_extract("place", r"\[([A-Z]{3})\]", 1)
    leaving = F.col("board_type") == "departure"
    shaped = rows.withColumn("code", F.coalesce(code, F.lit(""))).select(
        "path", "row_no", "number", "airline", "status", "departure", "arrival", "board_type",
        F.when(leaving, F.col("airport")).otherwise(F.col("code")).alias("from_code"),
        F.when(leaving, F.col("code")).otherwise(F.col("airport")).alias("to_code"),
        F.when(
            F.col("href").isNotNull(),
            F.coalesce(_pattern(F.col("href"), r"d=(\d{4}-\d{2}-\d{2})"), "board_date"),
        ).alias("dep_date"),
        _pattern(F.col("arrival_mark"), r"(\d{4}-\d{2}-\d{2})").alias("arr_date"),
        _times("departure").alias("dep_times"), _times("arrival").alias("arr_times"),
        F.coalesce(
            _pattern(F.col("next_text"), r"(?i)operated by\s+([A-Z0-9]+)"),
            F.nullif("next_code", F.lit("")),
        ).alias("operated_by"),
    ).withColumns({
        "dep_scheduled": _edge(F.col("dep_times"), 1), "dep_estimated": _edge(F.col("dep_times"), -1),
        "arr_scheduled": _edge(F.col("arr_times"), 1), "arr_estimated": _edge(F.col("arr_times"), -1),
    })
    for end, airport in (("dep", "from_code"), ("arr", "to_code")):
        times = {f"{end}_{kind}_utc": f"{end}_{kind}" for kind in ("scheduled", "estimated")}
        shaped = board_times_to_utc(shaped, airports, f"{end}_date", times, airport)

    def side(end: str, cell: str) -> Column:
        def iso(kind: str) -> Column:
            return F.date_format(f"{end}_{kind}_utc", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias(f"{kind}_utc")

        return F.struct(
            F.col(f"{end}_date").alias("date"),
            F.col(f"{end}_scheduled").alias("scheduled"), F.col(f"{end}_estimated").alias("estimated"),
            iso("scheduled"), iso("estimated"),
            F.col(f"{cell}.gate").alias("gate"), F.col(f"{cell}.terminal").alias("terminal"),
            _delay(cell).alias("delay"),
        ).alias(cell)

    return shaped.select(
        "path", "row_no", F.col("number").alias("flight_number"), "from_code", "to_code", "airline",
        side("dep", "departure"), side("arr", "arrival"), "status",
        F.col("board_type").alias("airport_type"), "operated_by",
    )


def parse_boards(pages: DataFrame, airports: DataFrame) -> DataFrame:
    """Flight documents of landed pages (``path``, ``html``); keys come from the file name."""
    name = F.element_at(F.split("path", "/"), -1)
    rows = board_rows(pages).withColumns({
        "airport": F.regexp_extract(name, NAME_PATTERN, 1),
        "board_type": F.regexp_extract(name, NAME_PATTERN, 2),
        "board_date": F.regexp_extract(name, NAME_PATTERN, 3),
    })
    return flight_documents(rows, airports)


def read_boards(spark: SparkSession, folder: str, airports: DataFrame) -> DataFrame:
    """All landed boards of a folder."""
    pages = (
        spark.read.format("text").option("wholetext", True).option("pathGlobFilter", "raw_*.html").load(folder)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("html"))
    )
    return parse_boards(pages, airports)
