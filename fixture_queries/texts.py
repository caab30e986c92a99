"""Text, price and URL functions."""

from pyspark.sql import functions as F

from catalogflow.functions import prices, text, urls
from fixture_queries.base import between_sql, query, rows_sql, sha, size

_BREAKS = "replace(replace(replace({0}, chr(13), ''), chr(10), ''), chr(9), '')"


@query("tx_01_strip_breaks", f"""
    SELECT doc_id, sha1({_BREAKS.format('text')}) AS clean, CAST(length({_BREAKS.format('text')}) AS BIGINT) AS n
    FROM documents""")
def _(t):
    clean = text.strip_breaks(F.col("text"))
    return t.documents.select("doc_id", sha(clean).alias("clean"), size(clean).alias("n"))


@query("tx_02_squeeze", f"""
    SELECT doc_id,
           sha1(replace(regexp_replace({_BREAKS.format('text')}, ' +', ' ', 'g'), '''', '')) AS collapsed,
           sha1(replace(replace({_BREAKS.format('text')}, ' ', ''), '''', '')) AS without_spaces,
           replace(lang || ' ' || source, ' ', '') || ',' || source AS each_value
    FROM documents""")
def _(t):
    values = text.drop_spaces_each(F.array(F.concat_ws(" ", "lang", "source"), "source"))
    return t.documents.select(
        "doc_id",
        sha(text.squeeze(F.col("text"))).alias("collapsed"),
        sha(text.squeeze(F.col("text"), drop_spaces=True)).alias("without_spaces"),
        F.array_join(values, ",").alias("each_value"),
    )


@query("tx_03_plain_chars", """
    SELECT doc_id, sha1(replace(replace(replace(lang || '|' || source || chr(8260) || text, chr(160), ''),
                                        chr(8260), '/'), '|', '')) AS plain
    FROM documents""")
def _(t):
    marked = F.concat("lang", F.lit("|"), "source", F.lit("⁄"), "text")
    return t.documents.select("doc_id", sha(text.plain_chars(marked)).alias("plain"))


@query("tx_04_strip_tags", """
    SELECT page_id, sha1(regexp_replace(html, '<.*?>', '', 'g')) AS without_tags,
           sha1(regexp_replace(html, '<a.*?a>', '', 'g')) AS without_anchors
    FROM pages""")
def _(t):
    html = F.col("html")
    return t.pages.select(
        "page_id", sha(text.strip_tags(html)).alias("without_tags"), sha(text.strip_anchors(html)).alias("without_anchors")
    )


@query("tx_05_between", rows_sql(
    "pages", "page_id", between_sql("html", "<p>", "</p>"), "pos, sha1(x) AS found, CAST(length(x) AS BIGINT) AS n"))
def _(t):
    rows = t.pages.select("page_id", F.posexplode(text.between(F.col("html"), "<p>", "</p>")).alias("pos", "x"))
    return rows.select("page_id", F.col("pos").cast("bigint").alias("pos"), sha(F.col("x")).alias("found"), size(F.col("x")).alias("n"))


@query("tx_06_cut", f"""
    SELECT page_id, string_split(url, '?')[1] AS base, string_split(url, '/')[5] AS number,
           array_to_string(list_transform({between_sql('html', 'href="', '"')},
               lambda x: CASE WHEN contains(x, ',') THEN string_split(x, ',')[1] ELSE x END), ' ') AS links
    FROM pages""")
def _(t):
    links = text.cut_each(text.between(F.col("html"), 'href="', '"'), ",")
    return t.pages.select(
        "page_id", text.cut(F.col("url"), "?").alias("base"), text.cut(F.col("url"), "/", 4).alias("number"),
        F.array_join(links, " ").alias("links"),
    )


@query("tx_07_cdata", f"""
    SELECT page_id, sha1('<![CDATA[' || html || ']]>') AS wrapped,
           sha1(array_to_string(list_transform({between_sql('html', '<p>', '</p>')},
                lambda x: '<![CDATA[' || x || ']]>'), '')) AS wrapped_each
    FROM pages""")
def _(t):
    each = text.cdata_each(text.between(F.col("html"), "<p>", "</p>"))
    return t.pages.select(
        "page_id", sha(text.cdata(F.col("html"))).alias("wrapped"), sha(F.array_join(each, "")).alias("wrapped_each")
    )


@query("tx_08_unescape_markup", """
    SELECT page_id, sha1(replace(replace(replace(replace(e, '&amp;', '&'), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'))
           AS plain
    FROM (SELECT page_id, replace(replace(html, '<', '&amp;lt;'), '>', '&gt;') AS e FROM pages)""")
def _(t):
    escaped = F.replace(F.replace("html", F.lit("<"), F.lit("&amp;lt;")), F.lit(">"), F.lit("&gt;"))
    return t.pages.select("page_id", sha(text.unescape_markup(escaped)).alias("plain"))


_ROUND = ("replace(replace(replace(replace({0}, '&middot;', chr(183)), '&copy;', chr(169)), '&quot;', '\"'), "
          "'&amp;', '&')")


@query("tx_09_decode_entities", f"""
    SELECT page_id, sha1({_ROUND.format(_ROUND.format('html'))}) AS decoded FROM pages""")
def _(t):
    return t.pages.select("page_id", sha(text.decode_entities(F.col("html"))).alias("decoded"))


@query("tx_10_price_text", """
    SELECT doc_id AS id, sha1(regexp_replace(text, '[^0-9,.]', '', 'g')) AS price,
           sha1(regexp_replace(text, '[^0-9.]', '', 'g')) AS no_comma, CAST(NULL AS DOUBLE) AS value
    FROM documents
    UNION ALL
    SELECT p_partkey, regexp_replace(s, '[^0-9,.]', '', 'g'), regexp_replace(s, '[^0-9.]', '', 'g'),
           TRY_CAST(regexp_replace(s, '[^0-9.]', '', 'g') AS DOUBLE)
    FROM (SELECT *, 'Price: $1,' || CAST(p_retailprice AS VARCHAR) AS s FROM part)""")
def _(t):
    def priced(df, key, c, shown, value):
        return df.select(
            F.col(key).alias("id"), shown(prices.price_text(c)).alias("price"),
            shown(prices.price_text(c, keep_comma=False)).alias("no_comma"), value.cast("double").alias("value"),
        )

    tag = F.concat(F.lit("Price: $1,"), F.col("p_retailprice").cast("string"))
    texts = priced(t.documents, "doc_id", F.col("text"), sha, F.lit(None))
    return texts.unionByName(priced(t.part, "p_partkey", tag, lambda c: c, prices.price_value(tag)))


@query("tx_11_labelled_price", """
    SELECT p_partkey, CAST(p_retailprice AS VARCHAR) AS amount FROM part""")
def _(t):
    label = F.concat(F.lit("Pris: "), F.col("p_retailprice").cast("string"), F.lit(" Kr : "), "p_name")
    return t.part.select("p_partkey", prices.labelled_price(label).alias("amount"))


@query("tx_12_drop_last", """
    SELECT p_partkey, CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) AS price FROM part""")
def _(t):
    return t.part.select("p_partkey", prices.drop_last(F.col("p_retailprice").cast("decimal(18,4)").cast("string")).alias("price"))


@query("tx_13_loyalty_points", """
    SELECT l_partkey, CAST(sum(CAST(trunc(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS points,
           count(*) AS n
    FROM lineitem GROUP BY l_partkey""")
def _(t):
    points = prices.loyalty_points(F.col("l_extendedprice").cast("string"))
    return t.lineitem.groupBy("l_partkey").agg(F.sum(points).alias("points"), F.count("*").alias("n"))


@query("tx_14_chunks", """
    WITH p AS (SELECT doc_id, text, unnest(range(greatest(1, CAST(ceil(length(text) / 2000.0) AS BIGINT)))) AS chunk
               FROM documents)
    SELECT doc_id, chunk, CAST(length(substring(text, chunk * 2000 + 1, 2000)) AS BIGINT) AS n,
           sha1(substring(text, chunk * 2000 + 1, 2000)) AS piece
    FROM p""")
def _(t):
    rows = t.documents.select("doc_id", F.posexplode(text.chunks(F.col("text"))).alias("chunk", "x"))
    return rows.select("doc_id", F.col("chunk").cast("bigint").alias("chunk"), size(F.col("x")).alias("n"), sha(F.col("x")).alias("piece"))


@query("tx_14_fixed_chunks", """
    SELECT doc_id, sha1(left(text, 2000)) AS head, sha1(substring(text, 2001, 2000)) AS second,
           sha1(substring(text, 4001)) AS rest
    FROM documents""")
def _(t):
    pieces = text.fixed_chunks(F.col("text"), 3)
    return t.documents.select(
        "doc_id", sha(text.truncate(F.col("text"))).alias("head"), sha(pieces[1]).alias("second"), sha(pieces[2]).alias("rest")
    )


@query("tx_19_stock_codes", """
    SELECT o_orderkey, o_orderpriority,
           CASE o_orderstatus WHEN 'F' THEN 'NOT_IN_STOCK' WHEN 'P' THEN 'IN_STOCK' ELSE 'O' END AS by_code,
           CASE WHEN o_orderstatus = 'O' THEN 'IN_STOCK' ELSE 'NOT_IN_STOCK' END AS by_text,
           CASE WHEN o_orderstatus = 'O' THEN 'IN_STOCK' WHEN o_orderstatus = 'P' THEN 'IN_STOCK' ELSE 'F' END AS by_upper,
           CASE WHEN o_orderstatus = 'P' THEN 'IN_STOCK' ELSE 'NOT_IN_STOCK' END AS by_absence,
           CASE WHEN o_orderstatus = 'F' THEN 'NOT_IN_STOCK' ELSE 'IN_STOCK' END AS by_flag
    FROM orders""")
def _(t):
    s = F.col("o_orderstatus")
    code = F.when(s == "F", "NOT_AVAILABLE").when(s == "P", "ADVANCED_SALE_LIMITED").otherwise(s)
    shown = F.when(s == "O", "In stock").otherwise("Sold out")
    raw = F.when(s == "O", "in_stock").when(s == "F", s)
    flag = F.when(s == "F", "False").otherwise("1")
    return t.orders.select(
        "o_orderkey", "o_orderpriority", prices.stock_code(code).alias("by_code"), prices.stock_text(shown).alias("by_text"),
        prices.stock_upper(raw).alias("by_upper"), prices.stock_unless(F.when(s != "P", s)).alias("by_absence"),
        prices.stock_flag(flag).alias("by_flag"),
    )


@query("tx_20_marker_flag", """
    SELECT page_id, CASE WHEN contains(html, '&quot;') THEN 'True' ELSE 'False' END AS quoted,
           CASE WHEN contains(html, '<nav>') THEN 'True' ELSE 'False' END AS menu
    FROM pages""")
def _(t):
    return t.pages.select(
        "page_id", text.has_marker(F.col("html"), "&quot;").alias("quoted"), text.has_marker(F.col("html"), "<nav>").alias("menu")
    )


@query("tx_21_rating", """
    SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN '0.0' ELSE CAST(p_size AS VARCHAR) END AS rating FROM part""")
def _(t):
    shown = F.when(F.col("p_type") != "PROMO", F.format_string("Rating : %d out of 50 votes", "p_size"))
    return t.part.select("p_partkey", prices.rating(shown).alias("rating"))


@query("tx_22_ids_in_urls", """
    SELECT page_id, string_split(url, '=')[2] AS by_equals, CAST(page_id AS VARCHAR) AS by_sku,
           regexp_extract(url, '^https?://([^/]*)', 1) AS first, 'h' || CAST(page_id AS VARCHAR) AS second
    FROM pages""")
def _(t):
    url = F.col("url")
    pair = urls.paired_ids(F.concat(F.parse_url("url", F.lit("HOST")), F.lit("|h"), F.col("page_id").cast("string")))
    return t.pages.select(
        "page_id", urls.id_after(url).alias("by_equals"),
        urls.id_after(F.concat(url, F.lit("&sku="), F.col("page_id").cast("string")), "&sku=").alias("by_sku"),
        pair["first"].alias("first"), pair["second"].alias("second"),
    )


@query("tx_23_build_urls", """
    WITH l AS (SELECT page_id, """ + between_sql("html", 'href="', '"') + """ AS v FROM pages)
    SELECT page_id AS id, pos, 'http://shop.invalid' || x || '?w=351' AS url
    FROM (SELECT page_id, unnest(v) AS x, generate_subscripts(v, 1) - 1 AS pos FROM l)
    UNION ALL
    SELECT p_partkey, -1, 'http://shop.invalid/price?sku=' || CAST(p_partkey AS VARCHAR) || '%20'
           || replace(p_name, ' ', '%20') || CASE WHEN p_type = 'PROMO' THEN '' ELSE '%20' || p_type END || '&qty=1'
    FROM part""")
def _(t):
    links = urls.absolute_each("http://shop.invalid", text.between(F.col("html"), 'href="', '"'), "?w=351")
    menu = t.pages.select(F.col("page_id").alias("id"), F.posexplode(links).alias("pos", "url"))
    kind = F.when(F.col("p_type") != "PROMO", F.col("p_type"))
    price = urls.query_url(
        "http://shop.invalid/price?sku=", F.col("p_partkey").cast("string"), F.col("p_name"), kind, suffix="&qty=1"
    )
    menu = menu.withColumn("pos", F.col("pos").cast("bigint"))
    return menu.unionByName(t.part.select(F.col("p_partkey").alias("id"), F.lit(-1).cast("bigint").alias("pos"), price.alias("url")))


@query("tx_24_locale_urls", """
    SELECT page_id, locale, replace(url, 'www', 'qa') || '?account=' || account AS url,
           replace(url, 'www', 'qa') || '?account=us_account' AS default_url
    FROM pages, (VALUES ('us', 'us_account'), ('eng', 'en_account'), ('fr', 'fr_account')) AS v(locale, account)""")
def _(t):
    default = urls.account_url(F.concat("url", F.lit("?account=XXXXX")), "us_account", production=False)
    accounts = {"us": "us_account", "eng": "en_account", "fr": "fr_account"}
    rows = t.pages.select("page_id", default.alias("default_url"))
    return rows.select("page_id", "default_url", F.inline(urls.per_locale(F.col("default_url"), accounts, "us_account")))


@query("tx_25_locale_ids", """
    SELECT doc_id, CASE WHEN lang = 'en' THEN CAST(doc_id AS VARCHAR) ELSE CAST(doc_id AS VARCHAR) || '_can_' || lang END
           AS product_id
    FROM documents""")
def _(t):
    language = F.when(F.col("lang") != "en", F.col("lang"))
    return t.documents.select("doc_id", urls.locale_id(F.col("doc_id").cast("string"), language).alias("product_id"))


@query("tx_26_asset_path", """
    SELECT page_id, 'images/shop/full/' || sha1(url) || '.jpg' AS by_url,
           'images/shop/full/' || sha1(string_split(url, '.example.')[2]) || '.jpg' AS by_path
    FROM pages""")
def _(t):
    return t.pages.select(
        "page_id", urls.asset_path("images/shop", F.col("url")).alias("by_url"),
        urls.asset_path("images/shop", F.col("url"), ".example.").alias("by_path"),
    )


@query("tx_27_asset_names", """
    SELECT page_id, string_split(url, '/')[-1] AS file_name, string_split(string_split(url, '/')[-1], '.')[1] AS stem,
           string_split(string_split(url, '?')[1], '.example.')[2] AS after_marker,
           string_split(string_split(string_split(url, '?')[1], '.example.')[2] || '/i/x', '/i')[1] AS before_variant,
           CAST(page_id AS VARCHAR) || '/small/' || string_split(string_split(url, '/')[-1], '.')[1] || '.jpg' AS thumb
    FROM pages""")
def _(t):
    url = F.col("url")
    variant = F.concat(F.substring_index(url, "?", 1), F.lit("/i/x?$size$"))
    return t.pages.select(
        "page_id", urls.file_name(url).alias("file_name"), urls.file_stem(url).alias("stem"),
        urls.name_after(url, ".example.").alias("after_marker"), urls.name_after(variant, ".example.").alias("before_variant"),
        urls.product_asset_path(F.col("page_id").cast("string"), urls.file_stem(url), "small").alias("thumb"),
    )


@query("ux_02_sql_functions", f"""
    SELECT page_id, array_to_string({between_sql('html', '<h1>', '</h1>')}, '|') AS heading,
           sha1(regexp_replace({_BREAKS.format('html')}, '<.*?>', '', 'g')) AS plain, 'images/full/' || sha1(url) || '.jpg' AS asset,
           string_split(regexp_extract(url, '^https?://([^/]*)', 1), '_')[1] AS root,
           CAST(CAST(page_id AS VARCHAR) || '.5' AS DOUBLE) AS price, CAST(page_id * 100 + 50 AS BIGINT) AS points,
           CAST(page_id AS VARCHAR) || ',5' AS shown
    FROM pages""")
def _(t):
    from catalogflow.functions import sql

    sql.register(t.spark)
    return t.spark.sql("""
        SELECT page_id, array_join(text_between(html, '<h1>', '</h1>'), '|') AS heading, sha1(text_plain(html)) AS plain,
               asset_path('images', url) AS asset, root_id(parse_url(url, 'HOST')) AS root,
               cast(price_value(concat('$', page_id, '.5 each')) AS double) AS price, loyalty_points(concat(page_id, '.5')) AS points,
               price_text(concat('$', page_id, ',5')) AS shown
        FROM {pages}""", pages=t.pages)
