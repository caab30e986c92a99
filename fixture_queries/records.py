"""JSON values, packed lists and flat record lists."""

from pyspark.sql import functions as F

from catalogflow.functions import records, text
from fixture_queries.base import between_sql, query

_K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT)"


@query("tx_15_loose_json", f"""
    SELECT event_id, {_K} AS k, {_K} * 2 AS doubled, true AS label_dropped FROM events""")
def _(t):
    loose = F.concat(F.lit("{label: 'x', k: "), F.get_json_object("props", "$.k"), F.lit("}"))
    shape = "label string, k bigint"
    changed = records.reshape_json(loose, shape, drop=("label",), doubled=lambda r: r["k"] * 2)
    return t.events.select(
        "event_id", records.loose_json(loose, shape)["k"].alias("k"),
        F.get_json_object(changed, "$.doubled").cast("bigint").alias("doubled"),
        F.get_json_object(changed, "$.label").isNull().alias("label_dropped"),
    )


_MENU_SQL = f"""
    WITH l AS (SELECT page_id, {between_sql('html', '<li><a href="', '"')} AS hrefs,
                      list_transform(string_split(html, '<li><a href="')[2:],
                          lambda x: string_split(string_split(x, '">')[2], '</a>')[1]) AS labels
               FROM pages)
    SELECT page_id, generate_subscripts(hrefs, 1) - 1 AS pos, unnest(hrefs) AS href, unnest(labels) AS label FROM l"""


def menu_lists(pages):
    """Aligned link and label lists of each page's menu."""
    blocks = text.between(F.col("html"), "<li>", "</li>")
    return pages.select(
        "page_id",
        F.transform(blocks, lambda b: text.first_between(b, 'href="', '"')).alias("hrefs"),
        F.transform(blocks, lambda b: text.first_between(b, '">', "</a>")).alias("labels"),
    )


@query("tx_16_pack_json", _MENU_SQL)
def _(t):
    packed = records.pack_each(href=F.col("hrefs"), label=F.col("labels"))
    rows = menu_lists(t.pages).select("page_id", F.posexplode(packed).alias("pos", "json"))
    return rows.select(
        "page_id", F.col("pos").cast("bigint").alias("pos"), F.get_json_object("json", "$.href").alias("href"),
        F.get_json_object("json", "$.label").alias("label"),
    )


@query("tx_17_normal_json", """
    SELECT event_id, CASE WHEN event_type = 'error' THEN NULL
                          ELSE '{"k":' || regexp_extract(props, '([0-9]+)', 1) || '}' END AS normal
    FROM events""")
def _(t):
    raw = F.when(F.col("event_type") == "error", F.concat("props", F.lit("}"))).otherwise(F.col("props"))
    return t.events.select("event_id", records.normal_json(raw).alias("normal"))


@query("tx_18_strided", """
    WITH r AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice, unnest([0, 1]) AS pos FROM lineitem)
    SELECT l_orderkey, l_linenumber, CAST(pos AS BIGINT) AS pos,
           CAST(CASE pos WHEN 0 THEN l_suppkey ELSE l_suppkey + 1 END AS VARCHAR) AS id,
           CAST(l_extendedprice AS VARCHAR) AS price, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS shifted_id
    FROM r""")
def _(t):
    supplier, price = F.col("l_suppkey"), F.col("l_extendedprice").cast("string")
    quantity = F.col("l_quantity").cast("bigint").cast("string")
    record = lambda s: [s.cast("string"), F.lit("a"), price, F.lit("b"), F.lit("c"), quantity, F.lit("d"), F.lit("e")]
    flat = F.concat_ws(",", *record(supplier), *record(supplier + 1))
    seven = F.concat_ws(",", *[F.lit("h")] * 7, *([F.lit("x")] * 4 + [quantity] + [F.lit("y")] * 2) * 2)
    both = F.arrays_zip(
        records.strided(flat, 8, {"id": 0, "price": 2}).alias("a"), records.strided(seven, 7, {"id": 4}, start=7).alias("b")
    )
    rows = t.lineitem.select("l_orderkey", "l_linenumber", F.posexplode(both).alias("pos", "r"))
    return rows.select(
        "l_orderkey", "l_linenumber", F.col("pos").cast("bigint").alias("pos"), F.col("r.a.id").alias("id"),
        F.col("r.a.price").alias("price"), F.col("r.b.id").alias("shifted_id"),
    )


@query("jn_07_positional_zip", _MENU_SQL)
def _(t):
    zipped = records.zip_lists(href=F.col("hrefs"), label=F.col("labels"))
    rows = menu_lists(t.pages).select("page_id", F.posexplode(zipped).alias("pos", "z"))
    return rows.select("page_id", F.col("pos").cast("bigint").alias("pos"), "z.href", "z.label")


@query("jn_07_long_zip", _MENU_SQL)
def _(t):
    from catalogflow.operators.variants import zip_positions

    lists = menu_lists(t.pages)
    left = lists.select("page_id", F.posexplode("hrefs").alias("pos", "href"))
    right = lists.select("page_id", F.posexplode("labels").alias("pos", "label"))
    return zip_positions(left, right, ["page_id"]).withColumn("pos", F.col("pos").cast("bigint"))


@query("st_04_concat_lists", f"""
    SELECT page_id, array_to_string(list_concat({between_sql('html', 'href="', '"')},
                                                {between_sql('html', '<h1>', '</h1>')}), '|') AS all_values,
           CAST(len({between_sql('html', 'href="', '"')}) + 1 AS BIGINT) AS n
    FROM pages""")
def _(t):
    joined = records.concat_lists(
        text.between(F.col("html"), 'href="', '"'), F.lit(None).cast("array<string>"), text.between(F.col("html"), "<h1>", "</h1>")
    )
    return t.pages.select("page_id", F.array_join(joined, "|").alias("all_values"), F.size(joined).cast("bigint").alias("n"))


@query("fl_04_drop_blanks", """
    SELECT doc_id, concat_ws(',', CASE WHEN lang <> 'en' THEN lang END, source) AS kept FROM documents""")
def _(t):
    values = F.array(F.when(F.col("lang") != "en", F.col("lang")), F.lit(""), F.col("source"))
    return t.documents.select("doc_id", F.array_join(records.non_blank(values), ",").alias("kept"))
