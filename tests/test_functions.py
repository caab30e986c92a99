"""Column functions on the edge values the inputs hold."""

import hashlib
import string

import pytest
from pyspark.sql import functions as F

from catalogflow.functions import numbering, prices, records, text, urls


def one(spark, column, value, kind="string"):
    row = spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v")).alias("r")).first()[0]
    return row


@pytest.mark.parametrize(("f", "value", "expected"), [
    (text.strip_breaks, "a\r\nb\tc", "abc"),
    (text.squeeze, "a   ' b\n  c", "a  b c"),
    (lambda c: text.squeeze(c, drop_spaces=True), " a 'b' ", "ab"),
    (text.plain_chars, "1⁄2 cup|", "1/2cup"),
    (text.strip_tags, "<p>a<b>c</b>\n<br\n>", "ac\n<br\n>"),
    (text.strip_anchors, "x<a href='y'>z</a>w", "xw"),
    (lambda c: text.cut(c, "|", 1), "a|b|c", "b"),
    (lambda c: text.cut(c, ".", 5), "a.b", None),
    (text.cdata, "x", "<![CDATA[x]]>"),
    (text.unescape_markup, "&amp;lt;b&gt; &quot;", '<b> "'),
    (text.decode_entities, "&amp;eacute; &#233; plain", "é é plain"),
    (text.decode_entities, "no entity", "no entity"),
    (text.decode_entities, None, None),
    (lambda c: text.has_marker(c, "disabled"), "x disabled y", "True"),
    (lambda c: text.has_marker(c, "disabled"), "x", "False"),
    (prices.price_text, "Now $1,299.50 each", "1,299.50"),
    (lambda c: prices.price_text(c, keep_comma=False), "Now $1,299.50", "1299.50"),
    (prices.labelled_price, "Pris : 1 299 Kr", "1299"),
    (prices.drop_last, "12.3400", "12.34"),
    (prices.drop_last, "1", ""),
    (prices.stock_code, "NOT_AVAILABLE", "NOT_IN_STOCK"),
    (prices.stock_code, "ADVANCED_SALE_LIMITED", "IN_STOCK"),
    (prices.stock_code, "PREORDER", "PREORDER"),
    (prices.stock_upper, "in_stock", "IN_STOCK"),
    (prices.stock_upper, None, "IN_STOCK"),
    (prices.stock_flag, "0", "NOT_IN_STOCK"),
    (prices.stock_flag, None, "IN_STOCK"),
    (prices.rating, "Rating: 4.6 out of 5", "4.6"),
    (prices.rating, "no votes", "0.0"),
    (urls.id_after, "http://s.invalid/p?productId=12=3", "12"),
    (urls.file_stem, "http://s.invalid/a/b.c.jpg?x=1", "b"),
    (lambda c: urls.name_after(c, "fashion/"), "http://s.invalid/fashion/p1/i2?$x$", "p1"),
    (lambda c: urls.name_after(c, "fashion/"), "http://s.invalid/fashion/p1/i2?x", "p1/i2"),
    (lambda c: urls.account_url(c, "me", production=False), "http://www.s.invalid/XXXXX", "http://qa.s.invalid/me"),
    (lambda c: urls.query_url("http://s.invalid?sku=", c, F.lit(None).cast("string"), F.lit("XL")), "a b", "http://s.invalid?sku=a%20b%20XL"),
    (lambda c: urls.locale_id(c, F.lit("fr")), "7", "7_can_fr"),
    (records.normal_json, '{"b": 1, "a": [1, 2]}', '{"a":[1,2],"b":1}'),
    (records.normal_json, '{"b": 1', None),
    (records.normal_json, '{"b": 1} x', None),
    (records.normal_json, '{"b": 1}, 2', None),
    (records.normal_json, "", None),
])
def test_text_values(spark, f, value, expected):
    assert one(spark, f, value) == expected


def test_between(spark):
    def between(value, start="[", end="]"):
        return one(spark, lambda c: text.between(c, start, end), value)

    assert between("x[a]y[b]z") == ["a", "b"]
    assert between("x[a]y[open") == ["a", "open"]  # no end marker: the piece stays whole
    assert between("no marker") == []
    assert between("[][]") == ["", ""]
    assert between(None) is None
    assert one(spark, lambda c: text.between(c, "\\E.*", "$"), "a\\E.*b$\\E.*c") == ["b", "c"]
    assert one(spark, lambda c: text.first_between(c, "<", ">"), "none") is None


def test_cut_each_leaves_values_without_separator(spark):
    assert one(spark, lambda c: text.cut_each(c, "&cat="), ["u?a&cat=1", "v"], "array<string>") == ["u?a", "v"]


@pytest.mark.parametrize("length", [0, 1, 1999, 2000, 2001, 4000, 6500])
def test_chunks_lose_nothing(spark, length):
    value = (string.ascii_letters + "é\n😀") * 200
    value = value[:length]
    pieces = one(spark, text.chunks, value)
    assert "".join(pieces) == value
    assert all(len(p) == 2000 for p in pieces[:-1])
    assert len(pieces) == max(1, -(-length // 2000))
    fixed = one(spark, lambda c: text.fixed_chunks(c, 3, 1000), value)
    assert fixed == [value[:1000], value[1000:2000], value[2000:]]


def test_points_use_binary_floating_point(spark):
    assert one(spark, prices.loyalty_points, "19.99") == 1998
    assert one(spark, prices.loyalty_points, "5.49") == 549
    assert one(spark, prices.loyalty_points, "n/a") is None


def test_price_value(spark):
    assert str(one(spark, prices.price_value, "$9,999.5")) == "9999.50"
    assert one(spark, prices.price_value, "1.2.3") is None
    assert one(spark, prices.price_value, "free") is None


def test_asset_path_hashes_url_or_its_path(spark):
    url = "http://shop.invalid/a.jpg"
    assert one(spark, lambda c: urls.asset_path("st", c), url) == f"st/full/{hashlib.sha1(url.encode()).hexdigest()}.jpg"
    tail = hashlib.sha1(b"/a.jpg").hexdigest()
    assert one(spark, lambda c: urls.asset_path("st", c, "shop.invalid"), url) == f"st/full/{tail}.jpg"


def test_loose_json_is_reshaped(spark):
    shape = "skuId string, price double, swatch string"
    change = lambda c: records.reshape_json(c, shape, ("skuId",), swatch=lambda r: F.concat(F.lit("s/"), r["swatch"]))
    assert one(spark, change, '{skuId: "1", price: 2.5, swatch: "x"}') == '{"price":2.5,"swatch":"s/x"}'


def test_strided_records(spark):
    flat = "a0,b0,c0,a1,b1,c1,a2"
    rows = one(spark, lambda c: records.strided(c, 3, {"x": 0, "y": 1}), flat)
    assert [(r.x, r.y) for r in rows] == [("a0", "b0"), ("a1", "b1"), ("a2", None)]
    assert [r.x for r in one(spark, lambda c: records.strided(c, 3, {"x": 0}, start=3), flat)] == ["a1", "a2"]
    assert one(spark, lambda c: records.strided(c, 7, {"x": 0}, start=7), flat) == []


def test_letters_go_past_z(spark):
    def expected(n):
        out = ""
        n += 1
        while n:
            n, r = divmod(n - 1, 26)
            out = chr(97 + r) + out
        return out

    positions = [0, 1, 25, 26, 27, 51, 52, 701, 702, 703, 18277, 18278, 475253, 475254, 2**31, 8353082582, 2**53 + 1, 2**63 - 1]
    rows = spark.createDataFrame([(p,) for p in positions], "p bigint").select("p", numbering.letters(F.col("p")).alias("s")).collect()
    assert {r.p: r.s for r in rows} == {p: expected(p) for p in positions}


def test_lists(spark):
    df = spark.createDataFrame([(["a", "", None, "b"], None)], "x array<string>, y array<string>")
    row = df.select(
        records.non_blank(F.col("x")).alias("kept"), records.concat_lists(F.col("y"), F.col("x")).alias("all"),
        records.first_list(F.col("y"), F.array().cast("array<string>"), F.col("x")).alias("first"),
        records.first_of(F.lit(""), F.lit(None).cast("string"), default="0.0").alias("value"),
        records.pack_each(k=F.array(F.lit("1"), F.lit("2")), v=F.array(F.lit('"q"'))).alias("packed"),
    ).first()
    assert row.kept == ["a", "b"]
    assert row["all"] == row["first"] == ["a", "", None, "b"]
    assert row.value == "0.0"
    assert row.packed == ['{"k":"1","v":"\\"q\\""}', '{"k":"2"}']


def test_entities_are_decoded_as_the_standard_library_does(spark):
    import random
    from html import unescape

    rng = random.Random(3)
    parts = ["&", "&amp;", "&amp", "&AMP;lt;", "&notit;", "&notin;", "&copy", "&eacutex", "&#233;", "&#xE9", "&#x1F600;", "&#128;", "&#0;", "&#13;", "&#1;", "&#xD800;", "&#x110000;", "&#99999999999;",
             "&#0000065;", "&#65534;", "&bogus;", "&;", "&#;", "&#x;", " ", "a", ";", "<", "#", "é", "&CounterClockwiseContourIntegral;", "&gt", "&frac12x", "\n", "&ThickSpace;", "&nbsp"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(9))) for _ in range(600)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i bigint, t string").select("i", text.decode_entities(F.col("t")).alias("d")).collect()
    assert {r.i: r.d for r in rows} == {i: unescape(unescape(t)) for i, t in enumerate(texts)}
