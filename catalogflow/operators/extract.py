"""Attributes of fetched pages: element selection, repeated blocks, script records, items."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogflow.functions.records import first_of
from catalogflow.functions.text import between, first_between, literal_pattern


@dataclass(frozen=True)
class Select:
    """All elements of a tag whose attributes have the given values.

    ``take`` is ``text`` for an element's own direct text, ``all_text`` for the text of the whole element, ``inner`` or
    ``outer`` for its markup as written, or an attribute name. ``inside`` limits the search to elements below one that
    matches (``child`` to its direct children), and ``nth`` to the n-th of its tag under one parent, from 1.
    """

    tag: str
    where: Mapping[str, str] = field(default_factory=dict)
    take: str = "text"
    inside: "Select | None" = None
    child: bool = False
    nth: int | None = None


def _plain(s: Select | None) -> tuple | None:
    """A selector as plain values, which travel to the workers without this module."""
    return s and (s.tag, dict(s.where), s.take, _plain(s.inside), s.child, s.nth)


def flat_texts(html: Column, tag: str) -> Column:
    """Inner markup of every element of a tag that does not nest, without leaving the JVM."""
    return F.regexp_extract_all(html, F.lit(f"(?s)<{tag}(?:\\s[^>]*)?>(.*?)</{tag}>"), F.lit(1))


def attr_values(html: Column, tag: str, attr: str) -> Column:
    """Values of a double-quoted attribute of every element of a tag, as written in the page."""
    return F.regexp_extract_all(html, F.lit(f'<{tag}\\s(?:[^>]*\\s)?{attr}="([^"]*)"'), F.lit(1))


def select_elements(html: Column, selectors: Mapping[str, Select]) -> Column:
    """``struct`` of one list of texts per selector, from a single pass over the page.

    Pages need not be well formed: end tags may be left out where HTML allows, and an element never closed ends with its parent. This is the only extractor
    that runs in Python (Arrow batches); prefer the native ones where an element is flat.
    """
    fields = list(selectors)
    plans = [_plain(s) for s in selectors.values()]
    # Elements that HTML defines as having no content.
    void = frozenset("area base br col embed hr img input link meta source track wbr".split())
    # Elements whose end tag may be left out, and the start tags that then end them.
    ended_by = {name: frozenset(starts.split()) for name, starts in {
        "p": "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section "
             "table ul",
        "li": "li", "dt": "dt dd", "dd": "dt dd", "option": "option optgroup", "tr": "tr", "td": "td th tr", "th": "td th tr",
    }.items()}

    @F.pandas_udf(T.StructType([T.StructField(f, T.ArrayType(T.StringType())) for f in fields]))
    def run(pages: pd.Series) -> pd.DataFrame:
        from html.parser import HTMLParser

        def matches(plan, path, at):
            """Whether element ``at`` of a path of ``(tag, attributes, place among its kind)`` fits a selector."""
            tag, where, _, inside, child, nth = plan
            name, attrs, place = path[at]
            if name != tag or (nth and place != nth) or any(attrs.get(k) != v for k, v in where.items()):
                return False
            above = range(max(at - 1, 0), at) if child else range(at)
            return inside is None or any(matches(inside, path, n) for n in above)

        class Collector(HTMLParser):
            def __init__(self, page):
                super().__init__(convert_charrefs=True)
                self.page, self.path, self.open, self.kinds = page, [], [], [{}]
                self.taking = []  # depth and lists of the open elements that collect something
                self.depths = {}  # depths at which each tag is open
                self.found = [[] for _ in plans]
                self.lines = [0]
                for line in page.split("\n"):
                    self.lines.append(self.lines[-1] + len(line) + 1)

            def here(self):
                line, column = self.getpos()
                return self.lines[line - 1] + column

            def handle_starttag(self, tag, attrs):
                while self.path and tag in ended_by.get(self.path[-1][0], ()):
                    self.end(self.here(), self.here())
                kinds = self.kinds[-1]
                kinds[tag] = kinds.get(tag, 0) + 1
                self.path.append((tag, dict(attrs), kinds[tag]))
                begin, taken = self.here(), []
                for n, plan in enumerate(plans):
                    if plan[0] == tag and matches(plan, self.path, len(self.path) - 1):
                        value = [self.path[-1][1][plan[2]] or ""] if plan[2] in self.path[-1][1] else []
                        if value or plan[2] in ("text", "all_text", "inner", "outer"):
                            self.found[n].append(value)
                            taken.append((plan[2], value))
                self.open.append((begin, begin + len(self.get_starttag_text()), taken))
                self.kinds.append({})
                self.depths.setdefault(tag, []).append(len(self.open) - 1)
                if taken:
                    self.taking.append((len(self.open), taken))
                if tag in void:
                    self.end(self.open[-1][1], self.open[-1][1])

            def end(self, inner, outer):
                """Close the innermost element, whose content ends at ``inner`` and whose markup at ``outer``."""
                begin, content, taken = self.open.pop()
                self.depths[self.path.pop()[0]].pop()
                self.kinds.pop()
                if taken:
                    self.taking.pop()
                for take, value in taken:
                    if take == "inner":
                        value.append(self.page[content:inner])
                    elif take == "outer":
                        value.append(self.page[begin:outer])

            def handle_endtag(self, tag):
                if self.depths.get(tag):
                    here, depth = self.here(), self.depths[tag][-1]
                    while len(self.open) > depth + 1:
                        self.end(here, here)
                    self.end(here, self.page.find(">", here) + 1 or len(self.page))

            def handle_startendtag(self, tag, attrs):
                self.handle_starttag(tag, attrs)

            def handle_data(self, data):
                for depth, taken in self.taking:
                    for take, value in taken:
                        if take == "all_text" or (take == "text" and depth == len(self.open)):
                            value.append(data)

        def collect(page):
            if page is None:
                return [None for _ in plans]
            collector = Collector(page)
            collector.feed(page)
            collector.close()
            while collector.open:
                collector.end(len(page), len(page))
            return [["".join(texts) for texts in found] for found in collector.found]

        return pd.DataFrame([collect(p) for p in pages], columns=fields)

    return run(html)


def blocks(c: Column, start: str, end: str, **fields: tuple[str, str]) -> Column:
    """Repeated blocks as an array of structs, each field the first text between its own markers."""
    return F.transform(
        between(c, start, end),
        lambda b: F.struct(*[first_between(b, s, e).alias(name) for name, (s, e) in fields.items()]),
    )


def options(c: Column, header: str, end: str = "</select>") -> Column:
    """Options of a drop-down after its header option, as structs of visible ``text`` and ``value``."""
    part = first_between(c, header, end)
    return F.transform(
        between(part, "<option", "</option>"),
        lambda o: F.struct(
            F.substring_index(o, ">", -1).alias("text"), first_between(o, 'value="', '"').alias("value")
        ),
    )


def single_or_options(c: Column, header: str, text: Column, value: Column) -> Column:
    """The options of a drop-down, or the single text and value shown when there is no drop-down."""
    return F.when(c.contains(header), options(c, header)).otherwise(
        F.array(F.struct(text.alias("text"), value.alias("value")))
    )


def image_urls(c: Column, start: str, end: str, base: str = "") -> Column:
    """Image URLs found between markers, made absolute, without ``null`` entries."""
    kept = F.filter(between(c, start, end), lambda u: (u != "null") & (u != ""))
    return F.transform(kept, lambda u: F.concat(F.lit(base), u))


def script_records(
    c: Column, begin: str, stop: str, marker: str, fields: Mapping[str, tuple[str, str]],
    defaults: Mapping[str, str] | None = None,
) -> Column:
    """Records of a script part, cut at a marker, as structs in page order; absent fields get a default or null."""
    defaults = defaults or {}
    part = F.substring_index(F.get(F.split(c, literal_pattern(begin)), F.lit(1)), stop, 1)
    pieces = F.slice(F.split(part, literal_pattern(marker)), 2, 1_000_000_000)
    return F.transform(
        pieces,
        lambda p: F.struct(*[
            F.coalesce(first_between(p, s, e), F.lit(defaults.get(name))).alias(name)
            for name, (s, e) in fields.items()
        ]),
    )


def bracket_records(c: Column, fields: list[str]) -> Column:
    """Records of a list of quoted lists, by position; an empty cell stays empty, a missing one is null, other text gives null."""
    cells = F.from_json(c, "array<array<string>>", {"allowSingleQuotes": "true"})
    return F.transform(cells, lambda r: F.struct(*[F.get(r, F.lit(n)).alias(name) for n, name in enumerate(fields)]))


def extract_items(
    pages: DataFrame, fields: Mapping[str, Callable[[Column], Column]], required: tuple[str, ...] = (),
    html: str = "html",
) -> DataFrame:
    """One item per page: every field extracted in one projection, the page text dropped.

    A page that lacks a required field is flagged in ``error`` and does not affect other pages.
    """
    items = pages.select(
        *[c for c in pages.columns if c != html], *[f(F.col(html)).alias(name) for name, f in fields.items()]
    )
    missing = [F.when(F.col(f).isNull(), F.lit(f)) for f in required]
    error = F.nullif(F.concat_ws(",", *missing), F.lit("")) if missing else F.lit(None).cast("string")
    return items.withColumn("error", error)


def fallback(*candidates: Column, default: str | None = None) -> Column:
    """First candidate text that is present, else the default."""
    return first_of(*candidates, default=default)
