"""Page outcomes, cut-off, status update and reports; events stand for fetches, users for catalogues."""

from pyspark.sql import functions as F

from catalogflow.operators import outcome
from catalogflow.session import shared_folder
from catalogflow.sources.reports import write_reports
from fixture_queries.base import query

_CODE = "CASE event_type WHEN 'error' THEN 100 WHEN 'signup' THEN 101 WHEN 'view' THEN 102 WHEN 'purchase' THEN 104 END"
_STATUS = "CASE event_type WHEN 'error' THEN 'error' WHEN 'signup' THEN 'no_url' WHEN 'view' THEN 'no_avail' " \
          "WHEN 'purchase' THEN 'error' ELSE 'ran' END"


def coded(t):
    """Fetches of each catalogue with their outcome code."""
    kind = F.col("event_type")
    code = F.when(kind == "error", 100).when(kind == "signup", 101).when(kind == "view", 102).when(kind == "purchase", 104)
    return t.events.select(
        F.col("user_id").alias("catalog_id"), F.col("event_id").alias("ord"), code.alias("code"),
        F.concat(F.lit("http://shop.invalid/"), F.col("event_id").cast("string")).alias("url"),
    )


@query("fl_05_outcome", f"""
    SELECT event_id, coalesce({_CODE}, 0) AS code, {_STATUS} AS status,
           CASE WHEN event_type = 'click' THEN 'IN_STOCK' ELSE 'NOT_AVAILABLE' END AS in_stock
    FROM events""")
def _(t):
    kind, url = F.col("event_type"), F.concat(F.lit("http://shop.invalid/"), F.col("event_id").cast("string"))
    moved = (kind == "view") & (F.col("value") < 30)
    code = outcome.outcome_code(
        F.when(kind != "signup", url), F.when(moved, F.lit("http://shop.invalid/")).otherwise(url),
        F.when(kind == "purchase", 404).otherwise(200),
        F.when((kind == "view") & ~moved, "<p>no longer available</p>").when(kind != "error", "<p>ok</p>"),
        unavailable=("no longer available",),
    )
    shown = F.coalesce(code, F.lit(0)).alias("code")
    return t.events.select("event_id", shown, outcome.status_of(code).alias("status"), outcome.stock_of(code).alias("in_stock"))


_CUT = f"""
    WITH e AS (SELECT user_id AS catalog_id, event_id AS ord, {_CODE} AS code, 'http://shop.invalid/' || event_id AS url FROM events),
         l AS (SELECT catalog_id, ord AS last_ord FROM e WHERE code = 100
               QUALIFY row_number() OVER (PARTITION BY catalog_id ORDER BY ord) = 6),
         k AS (SELECT e.*, last_ord IS NOT NULL AS aborted FROM e LEFT JOIN l USING (catalog_id)
               WHERE last_ord IS NULL OR ord <= last_ord)"""


@query("wn_04_cut_off", _CUT + "SELECT catalog_id, ord, coalesce(code, 0) AS code, url, aborted FROM k")
def _(t):
    return outcome.cut_off(coded(t)).withColumn("code", F.coalesce("code", F.lit(0)))


@query("ag_03_counters", _CUT + """
    SELECT catalog_id, count(*) AS scraped, count(*) FILTER (code = 100) AS n100, count(*) FILTER (code = 101) AS n101,
           count(*) FILTER (code = 102) AS n102, count(*) FILTER (code = 104) AS n104, bool_or(aborted) AS aborted,
           coalesce(array_to_string(list_slice(list(url ORDER BY ord) FILTER (code = 100), 1, 5), ' '), '') AS urls,
           coalesce(array_to_string(list_slice(list(url ORDER BY ord) FILTER (code = 102), 1, 100), ' '), '') AS urls102
    FROM k GROUP BY catalog_id""")
def _(t):
    counts = outcome.counters(outcome.cut_off(coded(t))).withColumn("urls", F.array_join("urls100", " ")).drop("urls100")
    return counts.withColumn("urls102", F.array_join("urls102", " "))


@query("ag_03_error_rows", _CUT + "SELECT catalog_id, code, ord, url FROM k WHERE code IS NOT NULL")
def _(t):
    return outcome.error_rows(outcome.cut_off(coded(t)))


_MESSAGES = _CUT + """,
    c AS (SELECT catalog_id, count(*) AS scraped, count(*) FILTER (code = 100) AS n100, count(*) FILTER (code = 101) AS n101,
                 count(*) FILTER (code = 102) AS n102, count(*) FILTER (code = 104) AS n104, bool_or(aborted) AS aborted,
                 list_slice(list(url ORDER BY ord) FILTER (code = 100), 1, 5) AS urls
          FROM k GROUP BY catalog_id)
    SELECT catalog_id,
           CASE WHEN aborted THEN 'Scraping terminated after error occurred on 5 urls.' || chr(10) || chr(10)
                     || 'those errors occurred on:' || chr(10) || array_to_string(urls, chr(10))
                ELSE 'Scraper report:' || chr(10) || chr(10) || 'Scraping finished, scraped ' || scraped || ' products, '
                     || n101 || ' not provided, ' || n102 || ' not available, ' || n104
                     || ' internal errors on client page, and ' || n100 || ' unhandled errors.'
                     || CASE WHEN n100 > 0 THEN chr(10) || chr(10) || 'Unhandled errors occurred on:' || chr(10) || chr(10)
                             || array_to_string(urls, chr(10)) ELSE '' END END AS message
    FROM c"""


@query("ag_04_messages", _MESSAGES)
def _(t):
    return outcome.counters(outcome.cut_off(coded(t))).select("catalog_id", outcome.report_message().alias("message"))


@query("ag_04_settings_lines", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'Running US ' WHEN o_orderstatus = 'F' THEN 'Running canada english'
                            ELSE 'Running canada french' END
           || CASE WHEN o_totalprice > 100000 THEN ' on production ' ELSE ' on development ' END
           || CASE WHEN o_orderpriority = '1-URGENT' THEN 'with upload ' ELSE 'without upload ' END
           || 'for ' || o_orderpriority || ' catalog' AS line,
           chr(10) || chr(10) || chr(9) || o_orderpriority AS log_line,
           o_orderpriority || ' ' || chr(10) || chr(10) || ' ' || o_orderstatus AS final
    FROM orders""")
def _(t):
    language = F.when(F.col("o_orderstatus") == "O", "us").when(F.col("o_orderstatus") == "F", "english").otherwise("french")
    line = outcome.settings_line(
        language, F.col("o_totalprice") > 100000, F.col("o_orderpriority") == "1-URGENT", F.col("o_orderpriority"))
    return t.orders.select("o_orderkey", line.alias("line"), outcome.message_line(F.col("o_orderpriority"), 1, 1).alias("log_line"),
                           outcome.final_message(F.col("o_orderpriority"), F.col("o_orderstatus")).alias("final"))


@query("ag_05_completeness", _CUT + """
    SELECT catalog_id, total, scraped, scraped < total AS incomplete,
           CASE WHEN scraped < total THEN 'Scraper didn''t go through all products, please report' || chr(10) ELSE '' END
           || 'Scraped ' || scraped || ' product out of ' || total AS message
    FROM (SELECT catalog_id, count(*) AS total FROM e GROUP BY ALL) JOIN (SELECT catalog_id, count(*) AS scraped FROM k GROUP BY ALL)
         USING (catalog_id)""")
def _(t):
    return outcome.completeness(outcome.cut_off(coded(t)), coded(t))


_UPDATE = f"""
    WITH n AS (SELECT user_id AS id, {_STATUS} AS status FROM events
               QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1),
         u AS (SELECT o_orderkey AS id, o_orderpriority AS priority, o_orderstatus AS old,
                      coalesce(n.status, CASE WHEN o_orderpriority = '5-LOW' THEN 'no_url' END, o_orderstatus) AS status
               FROM orders LEFT JOIN n ON n.id = o_orderkey)"""


def updated(t):
    """Orders whose status is updated by the first event with their id; some have no URL."""
    kind = F.col("event_type")
    status = F.when(kind == "error", "error").when(kind == "signup", "no_url").when(kind == "view", "no_avail") \
        .when(kind == "purchase", "error").otherwise("ran")
    new = t.events.select(F.col("user_id").alias("id"), status.alias("status"), F.col("event_id").alias("ord"))
    rows = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"))
    return outcome.update_status(rows, new, rows.where(F.col("priority") == "5-LOW").select("id"))


@query("jn_06_status_update", _UPDATE + "SELECT id, priority, status, status <> old AS changed FROM u")
def _(t):
    return updated(t)


@query("ag_07_rows_changed", _UPDATE + "SELECT priority, count(*) FILTER (status <> old) AS changed_rows FROM u GROUP BY priority")
def _(t):
    return outcome.rows_changed(updated(t), "priority")


@query("snk_04_report_files", _MESSAGES)
def _(t):
    import uuid

    path = f"{shared_folder(t.spark)}/reports-{uuid.uuid4().hex}"
    reports = outcome.counters(outcome.cut_off(coded(t))).select("catalog_id", outcome.report_message().alias("message"))
    write_reports(reports, path)
    read = t.spark.read.schema("value string, catalog_id bigint").text(path, wholetext=True)
    return read.select("catalog_id", F.regexp_replace("value", "\n$", "").alias("message"))
