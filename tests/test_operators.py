"""Operators on small tables with skewed, blank, repeated and missing keys, against plain Python."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from catalogflow.functions.numbering import digits, letters
from catalogflow.operators import assets, catalog as cat, extract, feed, ledger, matching, ordering, outcome, variants


def skewed(n=600, seed=7):
    """Rows of which a third belong to one key, in mixed order."""
    rng = random.Random(seed)
    rows = [("hot" if i % 3 == 0 else f"k{rng.randrange(40)}", i, rng.randrange(5)) for i in range(n)]
    rng.shuffle(rows)
    return rows


def brute_positions(rows):
    seen, out = {}, set()
    for key, order, value in sorted(rows, key=lambda r: r[1]):
        out.add((key, order, value, seen.get(key, 0)))
        seen[key] = seen.get(key, 0) + 1
    return out


@pytest.mark.parametrize("parts", [2, 16, None])
def test_numbering_splits_hot_keys(spark, parts):
    rows = skewed()
    df = spark.createDataFrame(rows, "k string, o bigint, v int")
    got = ordering.numbered(df, ["k"], ["o"], parts=parts)
    assert {tuple(r) for r in got.collect()} == brute_positions(rows)


def test_numbering_with_equal_leads_and_null_keys(spark):
    rows = [(None, 5, i) for i in range(20)] + [("a", 5, i) for i in range(20)] + [("a", None, 99)]
    df = spark.createDataFrame(rows, "k string, o bigint, v int")
    got = ordering.numbered(df, ["k"], ["o", "v"], parts=6).collect()
    assert sorted(r.pos for r in got if r.k is None) == list(range(20))
    assert {(r.v, r.pos) for r in got if r.k == "a"} == {(99, 0)} | {(i, i + 1) for i in range(20)}


@pytest.mark.parametrize("kind", ["equal", "outlier", "null"])
def test_no_task_holds_a_hot_key(spark, kind):
    """A third of the rows has one key: with equal order values, with one outlier among them, or a null key."""
    hot = F.col("id") % 3 == 0
    key = F.when(hot, F.lit(None if kind == "null" else -1)).otherwise(F.col("id"))
    lead = {"equal": F.lit(5), "outlier": F.when(F.col("id") == 0, 10**15).otherwise(F.col("id") % 7), "null": F.col("id")}[kind]
    df = spark.range(0, 6000, 1, 4).select(key.cast("bigint").alias("k"), F.when(hot, lead).otherwise(1).cast("bigint").alias("o"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        got = ordering.numbered(df, ["k"], ["o"], parts=16).where(F.col("k").eqNullSafe(F.lit(None if kind == "null" else -1)))
        tasks = got.groupBy(F.spark_partition_id()).count().collect()
        assert len(tasks) > 2 and max(r["count"] for r in tasks) < 1500
        rows = sorted((r.pos, r.o) for r in got.collect())
        assert [p for p, _ in rows] == list(range(2000)) and [o for _, o in rows] == sorted(o for _, o in rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_list_pieces_keep_order_and_repeats(spark):
    rows = skewed()
    df = spark.createDataFrame(rows, "k string, o bigint, v int")
    pieces = ordering.list_pieces(ordering.list_rows(df, "k", "v", ["o"], parts=8), "k", "v", size=10).collect()
    joined = {}
    for p in sorted(pieces, key=lambda r: (r.k, r.piece)):
        assert len(p["values"]) <= 10
        joined.setdefault(p.k, []).extend(p["values"])
    expected = {}
    for key, _, value in sorted(rows, key=lambda r: r[1]):
        expected.setdefault(key, []).append(value)
    assert joined == expected


def test_first_by_id(spark):
    rows = [(0, "a", "u1"), (1, "", "u2"), (2, "a", "u3"), (3, "", "u4"), (4, "b", "u5")]
    df = spark.createDataFrame(rows, "ord bigint, product_id string, url string")
    assert [r.ord for r in cat.first_by_id(df).orderBy("ord").collect()] == [0, 1, 4]
    assert [r.ord for r in cat.first_by_id(df, drop_blank=True).orderBy("ord").collect()] == [0, 4]


def test_url_rules(spark):
    cells = ["http://a", " https://b ", "ftp://c", "", "see http://d", None]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string")
    rows = df.select("i", cat.normal_url(F.col("c")).alias("url"))
    assert [r.url for r in rows.orderBy("i").collect()] == ["http://a", "https://b", cat.NO_URL, cat.NO_URL, "see http://d", cat.NO_URL]
    sheet_with, sheet_without = cat.split_by_url(rows, "sheet")
    assert sheet_with.count() == 3 and {r.url for r in sheet_without.collect()} == {""}
    db_with, db_without = cat.split_by_url(rows.unionByName(spark.createDataFrame([(9, None)], "i int, url string")), "db")
    assert {r.i for r in db_with.collect()} == {0, 2, 3, 5} and {r.i for r in db_without.collect()} == {1, 4, 9}
    with pytest.raises(ValueError):
        cat.has_url(F.col("url"), "other")


def test_normal_id_truncates_floats(spark):
    df = spark.createDataFrame([(12.0,), (7.9,), (-3.7,)], "x double")
    assert [r[0] for r in df.select(cat.normal_id(F.col("x"), True)).collect()] == ["12", "7", "-3"]


def test_backfill(spark):
    rows = [("a", ""), ("b", "http://b"), ("c", None), ("d", "")]
    df = spark.createDataFrame(rows, "product_id string, url string")
    links = spark.createDataFrame([("a", "http://new-a"), ("b", "http://new-b"), ("d", None)], "product_id string, url string")
    got = {r.product_id: (r.url, r.sought, r.found) for r in cat.backfill_urls(df, links).collect()}
    assert got == {"a": ("http://new-a", True, True), "b": ("http://b", False, False), "c": ("", True, False), "d": ("", True, False)}
    every = {r.product_id: r.url for r in cat.backfill_urls(df, links, every_row=True).collect()}
    assert every == {"a": "http://new-a", "b": "http://new-b", "c": "", "d": ""}
    assert cat.backfill_report(cat.backfill_urls(df, links)).first().message == "Updated 1 out of 3 missing links"


def test_match_first_and_nth(spark):
    catalog = spark.createDataFrame([(0, "u", "p0"), (1, "v", "p1"), (2, "u", "p2"), (3, "u", "p3")], "ord bigint, url string, product_id string")
    pages = spark.createDataFrame([(10, "u"), (11, "u"), (12, "v"), (13, "w"), (14, "u"), (15, "u")], "fetch_ord bigint, requested_url string")
    first = {(r.fetch_ord, r.product_id) for r in matching.match_first(pages, catalog).collect()}
    assert first == {(10, "p0"), (11, "p0"), (12, "p1"), (14, "p0"), (15, "p0")}
    nth = {(r.fetch_ord, r.product_id) for r in matching.match_nth(pages, catalog).collect()}
    assert nth == {(10, "p0"), (11, "p2"), (12, "p1"), (14, "p3")}


def test_feed_joins(spark):
    records = spark.createDataFrame([("1", "x"), ("2", "y"), ("2", "z")], "Id string, n string")
    catalog = spark.createDataFrame([("2",), ("2",), ("3",)], "product_id string")
    assert sorted(r.n for r in matching.in_catalog(records, catalog, "Id").collect()) == ["y", "z"]
    assert [r.product_id for r in matching.not_in_feed(catalog, records, "Id").collect()] == ["3"]
    ratio = matching.match_ratio(matching.feed_status(catalog, records, "Id")).first()
    assert (ratio.total, ratio.missing, ratio.message) == (3, 1, "1 id(s) from id list weren't found in feed")


@pytest.mark.parametrize("count", [0, 1, 30])
def test_two_and_three_levels(spark, count):
    products = spark.createDataFrame([("p", "P"), ("q", "Q")], "product_id string, name string")
    rows = [("p", f"c{i:02d}", f"s{j}", 1000 - 10 * i + j) for i in range(count) for j in range(2)]
    options = spark.createDataFrame(rows, "product_id string, color string, size string, ord bigint")
    two = {r.product_id: (r.master_product_id, r.color) for r in variants.two_levels(products, options).collect()}
    assert two["q_0"] == ("q", "NO_COLOR")
    assert len(two) == 2 + (count or 1) + 1
    three = {r.product_id: r for r in variants.three_levels(products, options, letters).collect()}
    assert len(three) == 2 + count + 2 * count
    if count:  # the last colour of the loop comes first on the page
        assert three["p_a"].color == f"c{count - 1:02d}" and three["p_a"].master_product_id == "p"
        assert three["p_a_b"]["size"] == "s1" and three["p_a_b"].master_product_id == "p_a"
    if count == 30:
        assert three["p_aa"].color == "c03" and "p_ad_b" in three


@pytest.mark.parametrize("range_bytes", [64 << 20, 1 << 12])
def test_three_levels_shuffle_variants_once(spark, capsys, monkeypatch, range_bytes):
    """Colours and sizes are numbered after one shuffle by product; products without id give no rows; a repeated row keeps its place."""
    monkeypatch.setattr(ordering, "RANGE_BYTES", range_bytes)
    rows = [(f"p{i % 97}" if i % 31 else None, f"c{i * 7 % 5}" if i % 11 else None, f"s{i * 3 % 4}" if i % 13 else None, i * 37 % 2003 if i % 17 else None) for i in range(2000)]
    rows += rows[:50]
    products = spark.createDataFrame([("p1", "P")], "product_id string, name string")
    got = variants.three_levels(products, spark.createDataFrame(rows, "product_id string, color string, size string, ord bigint"), digits)
    got.explain("formatted")
    assert len(re.findall(r"^\([0-9]+\) Exchange", capsys.readouterr().out, re.M)) == 1
    none_first = lambda v: (v is not None, v)
    tree = {}
    for p, c, s, o in rows:
        if p is not None:
            tree.setdefault(p, {}).setdefault(c or variants.NO_COLOR, []).append((none_first(o), none_first(s)))
    want = Counter([("p1", None, None, None, 0)])
    for p, colors in tree.items():
        first = {c: min((o for o, _ in x if o[0]), default=(False, None)) for c, x in colors.items()}
        for i, c in enumerate(sorted(colors, key=lambda c: (first[c], c))):
            want[(f"{p}_{i}", p, c, None, 1)] += 1
            want.update((f"{p}_{i}_{j}", f"{p}_{i}", None, s[1], 2) for j, (_, s) in enumerate(sorted(colors[c])))
    assert Counter((r.product_id, r.master_product_id, r.color, r["size"], r.level) for r in got.collect()) == want


def test_three_levels_cut_a_large_product(spark, monkeypatch):
    """A product with most of the rows takes the ranges, and the tree is that of one task."""
    rows = [("hot" if i % 3 else f"p{i}", f"c{i * 7 % 40}", f"s{i % 9}", i * 37 % 6007) for i in range(6000)]
    products = spark.createDataFrame([], "product_id string, name string")
    options = spark.createDataFrame(rows, "product_id string, color string, size string, ord bigint")
    whole = Counter(variants.three_levels(products, options, letters).collect())
    monkeypatch.setattr(ordering, "RANGE_BYTES", 1 << 12)
    small, large = ordering.split_large(*ordering.written(options, "options"), ["product_id"])
    assert large is not None and small.where("product_id = 'hot'").count() == 0 and large.where("product_id = 'hot'").count() == 4000
    assert Counter(variants.three_levels(products, options, letters).collect()) == whole


def test_numbering_of_small_keys_needs_no_ranges(spark, capsys):
    df = spark.range(0, 6000, 1, 4).select((F.col("id") % 500).alias("k"), (-F.col("id")).alias("o"))
    got = ordering.numbered(df, ["k"], ["o"], parts=16)
    got.explain("formatted")
    assert len(re.findall(r"^\([0-9]+\) Exchange", capsys.readouterr().out, re.M)) == 1
    assert Counter(r.pos for r in got.collect()) == Counter({i: 500 for i in range(12)})


def test_record_levels_keep_page_order(spark):
    df = spark.sql("""select 'r' as id, array(named_struct('color', 'red', 'size', 'S'), named_struct('color', null, 'size', 'M'),
                      named_struct('color', 'red', 'size', 'L')) as rec""")
    rows = df.select(F.inline(variants.record_levels(F.col("id"), F.col("rec"), ["size"], letters))).collect()
    assert [(r.product_id, r.master_product_id, r.color, r["size"], r.level) for r in rows] == [
        ("r_a", "r", "red", None, 1), ("r_b", "r", "no_color", None, 1),
        ("r_a_a", "r_a", None, "S", 2), ("r_a_b", "r_a", None, "L", 2), ("r_b_a", "r_b", None, "M", 2)]


def test_options_and_lookup(spark):
    sizes = spark.createDataFrame([("p", "1", "S"), ("p", "1", "M"), ("p", "9", "L")], "p string, c string, size string")
    colors = spark.createDataFrame([("p", "1", 4, "late"), ("p", "1", 2, "red")], "p string, c string, ord bigint, color string")
    assert {(r["size"], r.color) for r in variants.join_options(sizes, colors, ["p", "c"]).collect()} == {("S", "red"), ("M", "red")}
    assert {(r["size"], r.color) for r in variants.lookup(sizes, colors, ["p", "c"], "color").collect()} == {("S", "late"), ("M", "late"), ("L", None)}


def test_bundles(spark):
    df = spark.createDataFrame([("1", "A", "look", None, 3), ("2", "B", "", "line", 4)],
                               "product_id string, name string, look_id string, line_id string, order_index int")
    looks = spark.createDataFrame([("look", "Look")], "product_id string, name string")
    lines = spark.createDataFrame([("line", "Line")], "product_id string, name string")
    rows = {r.product_id: r for r in variants.bundle_catalog(df, looks, lines).collect()}
    assert set(rows) == {"look", "line", "1", "2", "look_1", "line_2"}
    assert (rows["look"].shop_look, rows["look"].normal, rows["line"].shop_line) == ("True", "False", "True")
    assert (rows["look_1"].master_product_id, rows["look_1"].style, rows["line_2"].order_index) == ("look", "1", 4)


PAGE = """<html lang=en><body><div id="a"><h1>One &amp; <b>two</b> three</h1><img src=x.jpg alt="null"><p>open<div class="c">in</div>
</div><script>var t="<h1>no</h1>";</script><H1 class='k'>Last</H1><select><option>Choose</option><option value="1">Red</option>
<option value="2">Blue</option></select></body>"""


def test_select_elements(spark):
    df = spark.createDataFrame([(PAGE,), (None,), ("<h1>never closed",)], "html string")
    selectors = {
        "own": extract.Select("h1"), "whole": extract.Select("h1", take="all_text"), "k": extract.Select("h1", {"class": "k"}),
        "src": extract.Select("img", take="src", inside=extract.Select("div", {"id": "a"})), "lang": extract.Select("html", take="lang"),
    }
    rows = [r[0] for r in df.select(extract.select_elements(F.col("html"), selectors)).collect()]
    assert rows[0].own == ["One &  three", "Last"] and rows[0].whole == ["One & two three", "Last"]
    assert rows[0].k == ["Last"] and rows[0].src == ["x.jpg"] and rows[0].lang == ["en"]
    assert rows[1].own is None
    assert rows[2].own == ["never closed"]


def test_select_markup_children_and_places(spark):
    page = """<div id="top"><p>a<div><p>b</p><h1>deep</h1></div>
<h1>one <i>x</i></h1><h1>two</h1><img src="i"/><span>1</span><span class="s">2</span></div><p>last"""
    selectors = {
        "inner": extract.Select("h1", take="inner", child=True, inside=extract.Select("div", {"id": "top"})),
        "outer": extract.Select("span", take="outer", nth=2), "img": extract.Select("img", take="outer"),
        "second": extract.Select("h1", nth=2), "open": extract.Select("p", take="inner", nth=3), "paragraphs": extract.Select("p", take="inner"),
    }
    row = spark.createDataFrame([(page,)], "h string").select(extract.select_elements(F.col("h"), selectors)).first()[0]
    assert row.outer == ['<span class="s">2</span>'] and row.img == ['<img src="i"/>']
    assert row.inner == ["one <i>x</i>", "two"] and row.second == ["two"] and row.open == []
    assert row.paragraphs == ["a", "b", "last"]  # an open <p> ends where a block starts


def test_native_extractors(spark):
    df = spark.createDataFrame([(PAGE,)], "html string")
    html = F.col("html")
    row = df.select(
        extract.attr_values(html, "option", "value").alias("values"), extract.flat_texts(html, "option").alias("texts"),
        extract.options(html, "Choose</option>").alias("options"), extract.image_urls(html, 'alt="', '"').alias("images"),
        extract.bracket_records(F.lit("[['S','Small'],['M','Medium']]"), ["short", "full"]).alias("sizes"),
        extract.script_records(F.lit("x// begin #Color','red') id('1') #id('2')// end # id('3')"), "// begin", "// end", "#",
                               {"color": ("Color','", "')"), "id": ("id('", "')")}, {"color": "no_color"}).alias("records"),
    ).first()
    assert row["values"] == ["1", "2"] and row.texts == ["Choose", "Red", "Blue"]
    assert [(o.text, o.value) for o in row.options] == [("Red", "1"), ("Blue", "2")]
    assert row.images == []
    assert [(s.short, s.full) for s in row.sizes] == [("S", "Small"), ("M", "Medium")]
    assert [(r.color, r.id) for r in row.records] == [("red", "1"), ("no_color", "2")]


def test_items_isolate_errors(spark):
    from catalogflow.functions.text import first_between

    df = spark.createDataFrame([(1, "<h1>a</h1>"), (2, "none")], "id int, html string")
    items = extract.extract_items(df, {"name": lambda h: first_between(h, "<h1>", "</h1>")}, required=("name",))
    assert {(r.id, r.name, r.error) for r in items.collect()} == {(1, "a", None), (2, None, "name")}


def test_outcome_rules_first_match_wins(spark):
    rows = [("u", "u", 200, "ok"), ("", "u", 404, "ok"), ("u", "v", 404, "ok"), ("u", "v", 200, "gone"), ("u", "u", 200, "x gone"),
            ("u", "u", 200, None), (None, None, None, None), (cat.NO_URL, cat.NO_URL, 200, "ok")]
    df = spark.createDataFrame(rows, "r string, f string, s int, h string")
    code = outcome.outcome_code(F.col("r"), F.col("f"), F.col("s"), F.col("h"), ("gone",))
    got = [(r.c, r.st) for r in df.select(code.alias("c"), outcome.status_of(code).alias("st")).collect()]
    assert got == [(None, "ran"), (101, "no_url"), (104, "error"), (102, "no_avail"), (102, "no_avail"), (100, "error"), (101, "no_url"), (101, "no_url")]


def test_own_outcome_table(spark):
    rules = (outcome.Rule("moved", 104, "error", "NOT_AVAILABLE", None), outcome.Rule("http", 102, "no_avail", "NOT_IN_STOCK", "sheet", http=(400, 499)),
             outcome.Rule("text", None, "ran", "NOT_IN_STOCK", "item", texts=("few", "last")), outcome.Rule("failed", 100, "error", "NOT_AVAILABLE", None))
    rows = [("u", "v", 404, "few"), ("u", "u", 410, "few"), ("u", "u", 200, "the last"), ("u", "u", 500, "ok"), ("u", "u", None, None), (None, "u", 200, "bad")]
    df = spark.createDataFrame(rows, "r string, f string, s int, h string")
    html = F.col("h")
    result = outcome.page_outcome(rules, F.col("r"), F.col("f"), F.col("s"), html.isNull(), [outcome.contains_any(html, r.texts) for r in rules], html == "bad")
    assert [tuple(r.o) for r in df.select(result.alias("o")).collect()] == [
        (104, "error", "NOT_AVAILABLE", None), (102, "no_avail", "NOT_IN_STOCK", "sheet"), (None, "ran", "NOT_IN_STOCK", "item"),
        (None, "ran", "IN_STOCK", "all"), (None, "ran", "IN_STOCK", "all"), (100, "error", "NOT_AVAILABLE", None)]
    with pytest.raises(ValueError, match="cause"):
        outcome.Rule("weather")


def test_urls_not_available_are_listed_up_to_a_limit(spark):
    rows = [("c", i, 102, f"u{i}") for i in range(7)] + [("c", 9, 100, "e"), ("d", 0, None, "x")]
    df = spark.createDataFrame(rows, "catalog_id string, ord bigint, code int, url string").withColumn("aborted", F.lit(False))
    got = {r.catalog_id: r for r in outcome.counters(df, max_listed=3).collect()}
    assert (got["c"].n102, got["c"].urls102, got["c"].urls100) == (7, ["u0", "u1", "u2"], ["e"]) and got["d"].urls102 == []


def failures(spark, errors, fine=0):
    rows = [("c", i, 100, f"u{i}") for i in range(errors)] + [("c", errors + i, None, "ok") for i in range(fine)] + [("d", 0, 102, "x")]
    return spark.createDataFrame(rows, "catalog_id string, ord bigint, code int, url string")


@pytest.mark.parametrize(("errors", "kept", "aborted"), [(5, 8, False), (6, 6, True), (9, 6, True)])
def test_cut_off_at_the_error_after_the_limit(spark, errors, kept, aborted):
    rows = outcome.cut_off(failures(spark, errors, fine=3))
    assert rows.where("catalog_id = 'c'").count() == kept
    count = {r.catalog_id: r for r in outcome.counters(rows).collect()}
    assert (count["c"].n100, count["c"].aborted, count["c"].urls100) == (min(errors, 6), aborted, [f"u{i}" for i in range(5)])
    assert (count["d"].n102, count["d"].aborted, count["d"].urls100) == (1, False, [])
    texts = {r.catalog_id: r.m for r in outcome.counters(rows).select("catalog_id", outcome.report_message().alias("m")).collect()}
    assert texts["c"].startswith("Scraping terminated" if aborted else "Scraper report:\n\nScraping finished, scraped 8 products, 0 not")
    assert texts["d"].endswith("1 not available, 0 internal errors on client page, and 0 unhandled errors.")


def test_status_update(spark):
    rows = spark.createDataFrame([(1, "none"), (2, "none"), (3, "ran"), (4, None)], "id bigint, status string")
    new = spark.createDataFrame([(1, "error", 5), (1, "ran", 2), (3, "ran", 1), (4, "ran", 1)], "id bigint, status string, ord bigint")
    without = spark.createDataFrame([(2,), (3,)], "id bigint")
    got = {r.id: (r.status, r.changed) for r in outcome.update_status(rows, new, without).collect()}
    assert got == {1: ("ran", True), 2: ("no_url", True), 3: ("ran", False), 4: ("ran", True)}
    assert outcome.rows_changed(outcome.update_status(rows, new, without)).first()[0] == 3


def test_completeness(spark):
    catalog = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "catalog_id string")
    got = {r.catalog_id: r for r in outcome.completeness(spark.createDataFrame([("a",), ("b",)], "catalog_id string"), catalog).collect()}
    assert got["a"].incomplete and got["a"].message == "Scraper didn't go through all products, please report\nScraped 1 product out of 2"
    assert not got["b"].incomplete and got["b"].message == "Scraped 1 product out of 1"
    assert got["c"].scraped == 0


def test_long_rows_typed_view_and_subsets(spark):
    props = (feed.Property("price", "Price", "decimal"), feed.Property("n", "N", "integer"), feed.Property("tags", "Tags", "text_list"),
             feed.Property("b", "B", "boolean"))
    items = spark.createDataFrame([("1", "9,999.5", " 7", ["x", "", None, "y"], "True"), ("2", "call", None, None, "maybe")],
                                  "product_id string, price string, n string, tags array<string>, b string")
    rows = {(r.product_id, r.field, r.pos, r.value) for r in feed.long_rows(items, ["price", "n", "tags"]).collect()}
    assert rows == {("1", "price", 0, "9,999.5"), ("1", "n", 0, " 7"), ("1", "tags", 0, "x"), ("1", "tags", 1, "y"), ("2", "price", 0, "call")}
    typed = {r.product_id: r for r in feed.typed_view(items, props).collect()}
    assert (str(typed["1"].price), typed["1"].n, typed["1"].b) == ("9999.50", 7, True)
    assert (typed["2"].price, typed["2"].b) == (None, None)
    failed = {r.field: (r.n_values, r.n_failed) for r in feed.cast_failures(items, props).collect()}
    assert failed == {"price": (2, 1), "n": (1, 0), "tags": (1, 0), "b": (2, 1)}
    assert feed.properties_schema(props)["tags"].metadata == {"display_name": "Tags", "value_type": "text_list"}


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "product_id string")


def test_ledger_merge_is_idempotent(spark):
    known = ledger.id_rows(ids(spark, "a", "a_1", "a_2", "b_1"))
    run = ids(spark, "a", "a_2", "a_10", "a_10", "c_1")
    changed = ledger.changes(known, ledger.id_rows(run))
    assert {(r.variant_id, r.change) for r in changed.collect()} == {
        ("a", "kept"), ("a_2", "kept"), ("a_10", "added"), ("c_1", "added"), ("a_1", "gone")}  # b is not in the run
    merged = ledger.merged(known, changed)
    assert [r.variant_id for r in ordering.sorted_ids(merged, "variant_id").collect()] == ["a", "a_1", "a_10", "a_2", "b_1", "c_1"]
    deletes = feed.delete_list(run, ledger.gone(changed))
    assert sorted(r.product_id for r in deletes.collect()) == ["a", "a_1", "a_10", "a_10", "a_2", "c_1"]
    again = ledger.changes(merged, ledger.id_rows(run))
    assert ledger.added(again).count() == 0
    assert {r.product_id for r in ledger.gone(again).collect()} == {"a_1"}


def test_assets(spark):
    images = spark.createDataFrame([("1", "http://s.invalid/a/x.jpg"), ("1", "http://s.invalid/a/x.jpg"), ("2", ""), ("2", None)], "product_id string, url string")
    from catalogflow.functions.urls import file_stem

    rows = assets.manifest(images, {"small": (50, 62)}, file_stem)
    assert {(r.key, r.box_width) for r in rows.collect()} == {("1/full/x.jpg", None), ("1/small/x.jpg", 50)}
    stored = spark.sql("select '1/full/x.jpg' as key, timestamp'2024-01-01' as stored_at union all select '1/full/x.jpg', timestamp'2024-01-20'")
    run = F.lit("2024-02-10").cast("date")
    assert {r.key for r in assets.stale(rows, stored, run, 30).collect()} == {"1/small/x.jpg"}
    assert {r.key for r in assets.stale(rows, stored, run, 21).collect()} == {"1/small/x.jpg", "1/full/x.jpg"}
    sized = spark.createDataFrame([("u", 10, 99), ("v", 99, 99)], "url string, width int, height int")
    assert [r.reason for r in assets.size_check(sized, 50, 50).orderBy("url").collect()] == ["Image too small (10x99 < 50x50): u", None]
