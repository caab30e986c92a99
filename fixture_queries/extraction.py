"""Extraction of attributes from pages."""

from pyspark.sql import functions as F

from catalogflow.functions import records, text
from catalogflow.operators import extract
from catalogflow.operators.feed import keep_fields, long_rows
from fixture_queries.base import between_sql, query, sha

_DECODE = ("replace(replace(replace(replace({0}, '&middot;', chr(183)), '&copy;', chr(169)), '&quot;', '\"'), "
           "'&amp;', '&')")
_MENU_SQL = """
    WITH l AS (SELECT page_id, string_split(html, '<li>')[2:] AS b FROM pages),
         r AS (SELECT page_id, generate_subscripts(b, 1) - 1 AS pos, string_split(unnest(b), '</li>')[1] AS x FROM l)
    SELECT page_id, pos, {columns} FROM r"""
_HREF = """string_split(string_split(x, 'href="')[2], '"')[1]"""
_LABEL = """string_split(string_split(x, '">')[2], '</a>')[1]"""


@query("ex_01_select_elements", f"""
    SELECT page_id, {_DECODE.format("regexp_extract(html, '<h1>(.*?)</h1>', 1)")} AS heading,
           {_DECODE.format("regexp_extract(html, '<title>(.*?)</title>', 1)")} AS title,
           regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang,
           {_DECODE.format('''array_to_string(regexp_extract_all(html, '<li><a href="([^"]*)"', 1), ' ')''')} AS links,
           {_DECODE.format('''array_to_string(regexp_extract_all(html, '<li><a href="[^"]*">(.*?)</a>', 1), ' ')''')} AS labels,
           CAST(len(regexp_extract_all(html, '<div class="ad">')) AS BIGINT) AS ads
    FROM pages""")
def _(t):
    nav = extract.Select("nav")
    found = extract.select_elements(F.col("html"), {
        "h1": extract.Select("h1"), "title": extract.Select("title"), "lang": extract.Select("html", take="lang"),
        "links": extract.Select("a", take="href", inside=nav), "labels": extract.Select("li", take="all_text", inside=nav),
        "ads": extract.Select("div", {"class": "ad"}, take="class"),
    })
    rows = t.pages.select("page_id", found.alias("f"))
    return rows.select(
        "page_id", F.get("f.h1", F.lit(0)).alias("heading"), F.get("f.title", F.lit(0)).alias("title"),
        F.get("f.lang", F.lit(0)).alias("lang"), F.array_join("f.links", " ").alias("links"),
        F.array_join("f.labels", " ").alias("labels"), F.size("f.ads").cast("bigint").alias("ads"),
    )


@query("ex_01_element_markup", """
    SELECT page_id, sha1(regexp_extract(html, '(?s)<article>(.*)</article>', 1)) AS body, regexp_extract(html, '<nav>.*?</nav>') AS menu,
           regexp_extract_all(html, '<li>(.*?)</li>', 1)[2] AS second
    FROM pages""")
def _(t):
    found = extract.select_elements(F.col("html"), {
        "body": extract.Select("article", take="inner"), "menu": extract.Select("nav", take="outer"),
        "second": extract.Select("li", take="inner", nth=2, child=True, inside=extract.Select("ul", inside=extract.Select("nav"))),
    })
    rows = t.pages.select("page_id", found.alias("f"))
    first = lambda name: F.get(f"f.{name}", F.lit(0))
    return rows.select("page_id", sha(first("body")).alias("body"), first("menu").alias("menu"), first("second").alias("second"))


@query("ex_01_flat_elements", """
    SELECT page_id, array_to_string(regexp_extract_all(html, '<h1>(.*?)</h1>', 1), ' ') AS heading,
           array_to_string(regexp_extract_all(html, '<a href="([^"]*)"', 1), ' ') AS links,
           array_to_string(regexp_extract_all(html, '<div class="([^"]*)"', 1), ' ') AS classes
    FROM pages""")
def _(t):
    html = F.col("html")
    return t.pages.select(
        "page_id", F.array_join(extract.flat_texts(html, "h1"), " ").alias("heading"),
        F.array_join(extract.attr_values(html, "a", "href"), " ").alias("links"),
        F.array_join(extract.attr_values(html, "div", "class"), " ").alias("classes"),
    )


@query("ex_02_fallback", """
    SELECT page_id, CASE WHEN contains(html, '&quot;') THEN 'quoted' ELSE regexp_extract(html, '<h1>(.*?)</h1>', 1) END AS name,
           '0.0' AS rating, regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang
    FROM pages""")
def _(t):
    html = F.col("html")
    name = extract.fallback(
        text.first_between(html, '<span class="name">', "</span>"), F.when(html.contains("&quot;"), "quoted"), F.lit(""),
        text.first_between(html, "<h1>", "</h1>"),
    )
    lists = records.first_list(text.between(html, "<dd>", "</dd>"), extract.attr_values(html, "html", "lang"))
    return t.pages.select(
        "page_id", name.alias("name"), extract.fallback(text.first_between(html, "<em>", "</em>"), default="0.0").alias("rating"),
        F.get(lists, F.lit(0)).alias("lang"),
    )


@query("ex_03_blocks", _MENU_SQL.format(columns=f"{_HREF} AS href, {_LABEL} AS label"))
def _(t):
    found = extract.blocks(F.col("html"), "<li>", "</li>", href=('href="', '"'), label=('">', "</a>"))
    rows = t.pages.select("page_id", F.posexplode(found).alias("pos", "b"))
    return rows.select("page_id", F.col("pos").cast("bigint").alias("pos"), "b.href", "b.label")


@query("ex_04_options", _MENU_SQL.format(columns=f"{_LABEL} AS text, {_HREF} AS value") + """
    UNION ALL SELECT p_partkey, 0, p_name, p_type FROM part""")
def _(t):
    html = F.replace(F.replace("html", F.lit('<li><a href="'), F.lit('<option value="')), F.lit("</a></li>"), F.lit("</option>"))
    menu = extract.single_or_options(F.replace(html, F.lit("</ul>"), F.lit("</select>")), "<nav><ul>", F.lit("one"), F.lit("1"))
    rows = t.pages.select("page_id", F.posexplode(menu).alias("pos", "o"))
    single = extract.single_or_options(F.col("p_brand"), "<select>", F.col("p_name"), F.col("p_type"))
    shown = t.part.select(F.col("p_partkey").alias("page_id"), F.posexplode(single).alias("pos", "o"))
    return rows.unionByName(shown).select("page_id", F.col("pos").cast("bigint").alias("pos"), "o.text", "o.value")


@query("ex_05_images", """
    WITH l AS (SELECT page_id, list_filter(""" + between_sql("html", '<a href="', '"') + """, lambda x: x <> '/The') AS v
               FROM pages)
    SELECT page_id, generate_subscripts(v, 1) - 1 AS pos, 'http://img.invalid' || unnest(v) AS url FROM l""")
def _(t):
    html = F.replace("html", F.lit('"/The"'), F.lit('"null"'))
    rows = t.pages.select("page_id", F.posexplode(extract.image_urls(html, '<a href="', '"', "http://img.invalid")).alias("pos", "url"))
    return rows.select("page_id", F.col("pos").cast("bigint").alias("pos"), "url")


@query("ex_06_script_records", _MENU_SQL.format(
    columns=f"{_HREF} AS id, {_LABEL} AS size, 'no_color' AS color, CAST(NULL AS VARCHAR) AS price"))
def _(t):
    found = extract.script_records(
        F.col("html"), "<nav>", "</nav>", "<li>",
        {"id": ('href="', '"'), "size": ('">', "</a>"), "color": ("Color','", "')"), "price": ('price="', '"')},
        {"color": "no_color"},
    )
    rows = t.pages.select("page_id", F.posexplode(found).alias("pos", "r"))
    return rows.select("page_id", F.col("pos").cast("bigint").alias("pos"), "r.*")


@query("ex_06_bracket_records", """
    SELECT p_partkey, 0 AS pos, p_name AS short, p_brand AS full_name, CAST(p_size AS VARCHAR) AS number FROM part
    UNION ALL SELECT p_partkey, 1, p_type, '', CAST(p_partkey AS VARCHAR) FROM part""")
def _(t):
    script = F.format_string("[['%s','%s','%d'],['%s','','%d']]", "p_name", "p_brand", "p_size", "p_type", "p_partkey")
    found = extract.bracket_records(script, ["short", "full_name", "number"])
    rows = t.part.select("p_partkey", F.posexplode(found).alias("pos", "r"))
    return rows.select("p_partkey", "pos", "r.*")


# One site's extractors: item field to function of the page text.
ITEM_FIELDS = {
    "name": lambda h: text.first_between(h, "<h1>", "</h1>"),
    "language": lambda h: F.get(extract.attr_values(h, "html", "lang"), F.lit(0)),
    "links": lambda h: text.between(h, '<li><a href="', '"'),
    "description": lambda h: text.squeeze(text.strip_tags(F.get(text.between(h, "<article>", "</article>"), F.lit(0)))),
    "quoted": lambda h: text.first_between(h, "&quot;", "&quot;"),
}

_ITEMS_SQL = f"""
    WITH i AS (SELECT page_id, regexp_extract(html, '<h1>(.*?)</h1>', 1) AS name,
                      regexp_extract(html, '<html lang="([^"]*)"', 1) AS language,
                      {between_sql('html', '<li><a href="', '"')} AS links,
                      replace(regexp_replace(regexp_replace(translate(string_split(string_split(html, '<article>')[2],
                          '</article>')[1], chr(13) || chr(10) || chr(9), ''), '<.*?>', '', 'g'), ' +', ' ', 'g'), '''', '')
                          AS description,
                      string_split(string_split(html, '&quot;')[2], '&quot;')[1] AS quoted
               FROM pages)"""


@query("ex_07_items", _ITEMS_SQL + """
    SELECT page_id, name, language, CAST(len(links) AS BIGINT) AS n_links, sha1(description) AS description,
           CASE WHEN quoted IS NULL THEN 'quoted' END AS error
    FROM i""")
def _(t):
    items = extract.extract_items(t.pages.select("page_id", "html"), ITEM_FIELDS, required=("name", "quoted"))
    return items.select(
        "page_id", "name", "language", F.size("links").cast("bigint").alias("n_links"), sha(F.col("description")).alias("description"),
        "error",
    )


@query("sc_03_long_rows", _ITEMS_SQL + """,
    v AS (SELECT page_id, 'name' AS field, [name] AS v FROM i UNION ALL SELECT page_id, 'language', [language] FROM i
          UNION ALL SELECT page_id, 'links', links FROM i UNION ALL SELECT page_id, 'quoted', [quoted] FROM i),
    f AS (SELECT page_id, field, list_filter(v, lambda x: x IS NOT NULL AND x <> '') AS v FROM v)
    SELECT page_id, field, generate_subscripts(v, 1) - 1 AS pos, unnest(v) AS value FROM f""")
def _(t):
    items = extract.extract_items(t.pages.select("page_id", "html"), ITEM_FIELDS)
    rows = long_rows(items, ["name", "language", "links", "quoted"], ["page_id"])
    return rows.withColumn("pos", F.col("pos").cast("bigint"))


@query("sc_05_field_subsets", _ITEMS_SQL + """
    SELECT page_id, 'master' AS role, name, language, CAST(NULL AS VARCHAR) AS link, true AS link_omitted FROM i
    UNION ALL
    SELECT page_id, 'child', NULL, NULL, link, false FROM (SELECT page_id, unnest(links) AS link FROM i)""")
def _(t):
    items = extract.extract_items(t.pages.select("page_id", "html"), ITEM_FIELDS)
    masters = items.select("page_id", F.lit("master").alias("role"), "name", "language", F.get("links", F.lit(0)).alias("link"))
    children = items.select("page_id", F.lit("child").alias("role"), "name", "language", F.explode("links").alias("link"))
    rows = keep_fields(masters.unionByName(children), "role", {"master": ["name", "language"], "child": ["link"]})
    written = F.to_json(F.struct("name", "language", "link"))
    return rows.withColumn("link_omitted", ~written.contains('"link"'))


@query("sl_03_first_elements", f"""
    SELECT page_id, ({between_sql('html', '<li><a href="', '"')})[1] AS link, ({between_sql('html', '<p>', '</p>')})[1] AS para
    FROM pages""")
def _(t):
    from catalogflow.operators.ordering import first_rows

    html = F.col("html")
    rows = t.pages.select("page_id", F.get(text.between(html, '<li><a href="', '"'), F.lit(0)).alias("link"),
                          F.posexplode(text.between(html, "<p>", "</p>")).alias("pos", "para"))
    return first_rows(rows, ["page_id"], ["pos"]).drop("pos")


@query("hr_04_cross_sell", f"""
    WITH l AS (SELECT page_id, string_split(html, '<li>')[2:] AS b FROM pages),
         r AS (SELECT page_id, generate_subscripts(b, 1) - 1 AS pos, string_split(unnest(b), '</li>')[1] AS x FROM l)
    SELECT CAST(page_id AS VARCHAR) AS product_id, pos, {_HREF} AS id, {_LABEL} AS name,
           'http://shop.invalid/product?id=' || {_HREF} AS product_url, length({_HREF}) > 0 AS wrapped
    FROM r""")
def _(t):
    from catalogflow.operators.variants import cross_sell

    found = extract.blocks(F.col("html"), "<li>", "</li>", id=('href="', '"'), name=('">', "</a>"))
    packed = cross_sell(found, "http://shop.invalid/product?id=")
    rows = t.pages.select(F.col("page_id").cast("string").alias("product_id"), F.posexplode(packed).alias("pos", "json"))
    body = F.substring_index(F.substring_index("json", "<![CDATA[", -1), "]]>", 1)
    return rows.select(
        "product_id", F.col("pos").cast("bigint").alias("pos"),
        *[F.get_json_object(body, f"$.{f}").alias(f) for f in ("id", "name", "product_url")],
        F.col("json").startswith("<![CDATA[").alias("wrapped"),
    )
