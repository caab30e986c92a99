"""Outcome of each fetched page, error cut-off, status update and run report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogflow.operators.catalog import NO_URL
from catalogflow.operators.joins import join_reduced
from catalogflow.operators.ordering import first_rows

# Outcome codes, the status written for each, and the codes' names in reports.
UNHANDLED, NOT_PROVIDED, NOT_AVAILABLE, SITE_ERROR = 100, 101, 102, 104
STATUS = {UNHANDLED: "error", NOT_PROVIDED: "no_url", NOT_AVAILABLE: "no_avail", SITE_ERROR: "error"}
RAN = "ran"
IN_STOCK, OUT_OF_STOCK, NOT_IN_FEED = "IN_STOCK", "NOT_IN_STOCK", "NOT_AVAILABLE"
MAX_ERRORS = 5
MAX_LISTED = 100
CAUSES = ("no_url", "http", "http_outside", "moved", "text", "no_text", "failed")
ROWS = ("all", "item", "sheet", None)


@dataclass(frozen=True)
class Rule:
    """One line of a site's outcome table: what meets it, and the code, status, stock value and feed rows of such pages.

    ``cause`` is one of :data:`CAUSES`: no URL to fetch, an HTTP status within or outside ``http``, a redirect, a page that
    contains one of ``texts``, no page text, a required field missing. ``row`` says what the feed gets: the product with its
    variants (``all``), the product alone (``item``), the id and name of the catalogue row (``sheet``), nothing (None).
    """

    cause: str
    code: int | None = None
    status: str = RAN
    stock: str = IN_STOCK
    row: str | None = "all"
    texts: tuple[str, ...] = ()
    http: tuple[int, int] = (200, 299)

    def __post_init__(self) -> None:
        if self.cause not in CAUSES or self.row not in ROWS:
            raise ValueError(f"a rule has a cause of {CAUSES} and a row of {ROWS}, not {self.cause!r} and {self.row!r}")


def standard_rules(unavailable: tuple[str, ...] = ()) -> tuple[Rule, ...]:
    """The table of a site that has none of its own."""
    return (
        Rule("no_url", NOT_PROVIDED, "no_url", NOT_IN_FEED, None),
        Rule("http", SITE_ERROR, "error", NOT_IN_FEED, None, http=(404, 404)),
        Rule("moved", NOT_AVAILABLE, "no_avail", NOT_IN_FEED, "sheet"),
        Rule("text", NOT_AVAILABLE, "no_avail", NOT_IN_FEED, "sheet", texts=unavailable),
        Rule("http_outside", UNHANDLED, "error", NOT_IN_FEED, None),
        Rule("no_text", UNHANDLED, "error", NOT_IN_FEED, None),
        Rule("failed", UNHANDLED, "error", NOT_IN_FEED, None),
    )


def contains_any(html: Column, texts: Sequence[str]) -> Column:
    """Whether a page contains one of the texts."""
    found = F.lit(False)
    for t in texts:
        found = found | html.contains(t)
    return found


def page_outcome(
    rules: Sequence[Rule], requested_url: Column, final_url: Column, http_status: Column, no_text: Column, texts: Sequence[Column], failed: Column,
) -> Column:
    """Struct ``(code, status, stock, row)`` of a fetch by the first rule that it meets; a fetch that meets none is fine.

    ``texts`` tells for each rule whether the page contains one of its texts.
    """
    result = None
    for rule, found in zip(rules, texts, strict=True):
        low, high = rule.http
        met = {
            "no_url": requested_url.isNull() | requested_url.isin("", NO_URL),
            "http": http_status.between(low, high),
            "http_outside": ~http_status.between(low, high),
            "moved": final_url != requested_url,
            "text": found,
            "no_text": no_text,
            "failed": failed,
        }[rule.cause]
        value = _outcome(rule)
        result = F.when(met, value) if result is None else result.when(met, value)
    fine = _outcome(Rule("failed"))
    return fine if result is None else result.otherwise(fine)


def _outcome(rule: Rule) -> Column:
    return F.struct(
        F.lit(rule.code).cast("int").alias("code"), F.lit(rule.status).alias("status"), F.lit(rule.stock).alias("stock"),
        F.lit(rule.row).cast("string").alias("row"),
    )


def outcome_code(
    requested_url: Column, final_url: Column, http_status: Column, html: Column,
    unavailable: tuple[str, ...] = (), error: Column | None = None,
) -> Column:
    """Error code of a fetch, null when it is fine; the first matching rule wins.

    No URL, page not found, redirected, a text that says the product is gone, any other HTTP status than a success, no text,
    failed extraction.
    """
    rules = standard_rules(unavailable)
    failed = F.lit(False) if error is None else error.isNotNull()
    texts = [contains_any(html, r.texts) for r in rules]
    return page_outcome(rules, requested_url, final_url, http_status, html.isNull(), texts, failed).code


def status_of(code: Column) -> Column:
    """Catalogue status for an outcome code."""
    chain = F.when(code.isNull(), RAN)
    for value, status in STATUS.items():
        chain = chain.when(code == value, status)
    return chain


def stock_of(code: Column) -> Column:
    """Stock value for an outcome code."""
    return F.when(code.isNull(), "IN_STOCK").otherwise("NOT_AVAILABLE")


def error_limits(
    outcomes: DataFrame, catalog: str = "catalog_id", order: str = "ord", code: str = "code", max_errors: int = MAX_ERRORS
) -> DataFrame:
    """Position of the ``max_errors + 1``-th unhandled error of each catalogue that has so many.

    At most ``max_errors + 1`` errors per catalogue and task are shuffled.
    """
    errors = outcomes.where(F.col(code) == UNHANDLED).select(catalog, order)
    first = first_rows(errors, [catalog], [order], max_errors + 1)
    last = first.groupBy(catalog).agg(F.max(order).alias("last_ord"), F.count("*").alias("_errors"))
    return last.where(F.col("_errors") > max_errors).drop("_errors")


def cut_off(
    outcomes: DataFrame, limits: DataFrame | None = None, catalog: str = "catalog_id", order: str = "ord",
    max_errors: int = MAX_ERRORS,
) -> DataFrame:
    """Rows of each catalogue up to its error limit, and whether it was aborted there."""
    if limits is None:
        limits = error_limits(outcomes, catalog, order, max_errors=max_errors)
    joined = join_reduced(outcomes, limits, [catalog], "left")
    kept = joined.where(F.col("last_ord").isNull() | (F.col(order) <= F.col("last_ord")))
    return kept.withColumn("aborted", F.col("last_ord").isNotNull()).drop("last_ord")


def update_status(catalog: DataFrame, outcomes: DataFrame, without_url: DataFrame | None = None,
                  key: str = "id") -> DataFrame:
    """Catalogue rows with their new status; rows without an outcome keep the old one.

    ``outcomes`` holds ``(key, status, ord)``, of which the first per key counts. Ids in ``without_url``
    get ``no_url``, but never before an outcome of their own. Adds ``changed``.
    """
    new = outcomes.select(key, F.struct(F.lit(0).alias("late"), "ord", "status").alias("_new"))
    if without_url is not None:
        forced = F.struct(F.lit(1).alias("late"), F.lit(0).cast("bigint").alias("ord"), F.lit("no_url").alias("status"))
        new = new.unionByName(without_url.select(key, forced.alias("_new")))
    first = new.groupBy(key).agg(F.min("_new").alias("_new"))
    joined = join_reduced(catalog, first, [key], "left")
    status = F.coalesce(F.col("_new.status"), F.col("status"))
    return joined.select(
        *[c for c in catalog.columns if c != "status"],
        status.alias("status"),
        F.coalesce(~status.eqNullSafe(F.col("status")), F.lit(False)).alias("changed"),
    )


def rows_changed(updated: DataFrame, *scope: str) -> DataFrame:
    """How many rows the update changed."""
    return updated.groupBy(*scope).agg(F.count_if("changed").alias("changed_rows"))


def counters(
    outcomes: DataFrame, catalog: str = "catalog_id", max_errors: int = MAX_ERRORS, max_listed: int = MAX_LISTED,
) -> DataFrame:
    """Processed rows and errors by code for each catalogue, with the URLs of unhandled errors and of products not available.

    Expects rows after :func:`cut_off`, so a catalogue lists at most ``max_errors`` URLs; the error that
    ended the run is counted but not listed. Of the products not available the first ``max_listed`` are
    listed; :func:`error_rows` has all.
    """
    totals = outcomes.groupBy(catalog).agg(
        F.count("*").alias("scraped"),
        *[F.count_if(F.col("code") == c).alias(f"n{c}")
          for c in (UNHANDLED, NOT_PROVIDED, NOT_AVAILABLE, SITE_ERROR)],
        F.max("aborted").alias("aborted"),
    )
    limits = {UNHANDLED: max_errors, NOT_AVAILABLE: max_listed}
    failed = outcomes.where(F.col("code").isin(*limits)).select(catalog, "code", "ord", "url")
    listed = first_rows(failed, [catalog, "code"], ["ord"], max(limits.values()))
    urls = listed.groupBy(catalog).agg(*[
        F.transform(F.slice(F.array_sort(F.collect_list(F.when(F.col("code") == c, F.struct("ord", "url")))), 1, n), lambda x: x.url)
        .alias(f"urls{c}") for c, n in limits.items()
    ])
    empty = F.array().cast("array<string>")
    names = [f"urls{c}" for c in limits]
    return totals.join(urls, catalog, "left").withColumns({n: F.coalesce(n, empty) for n in names})


def error_rows(outcomes: DataFrame, catalog: str = "catalog_id") -> DataFrame:
    """Every failed URL of every code in long form, for lists that are too long for a message."""
    return outcomes.where(F.col("code").isNotNull()).select(catalog, "code", "ord", "url")


# The sentences of a run report.
REPORT = (
    "Scraper report:\n\nScraping finished, scraped %d products, %d not provided, %d not available, "
    "%d internal errors on client page, and %d unhandled errors."
)
LISTED = "\n\nUnhandled errors occurred on:\n\n"
ABORTED = "Scraping terminated after error occurred on %d urls.\n\nthose errors occurred on:\n"
INCOMPLETE = "Scraper didn't go through all products, please report"
PROGRESS = "Scraped %d product out of %d"


def report_message(max_errors: int = MAX_ERRORS) -> Column:
    """Report text of a row of :func:`counters`."""
    urls = F.array_join("urls100", "\n")
    done = F.concat(
        F.format_string(REPORT, "scraped", "n101", "n102", "n104", "n100"),
        F.when(F.size("urls100") > 0, F.concat(F.lit(LISTED), urls)).otherwise(""),
    )
    ended = F.concat(F.lit(ABORTED % max_errors), urls)
    return F.when(F.col("aborted"), ended).otherwise(done)


def completeness(scraped: DataFrame, catalog: DataFrame, key: str = "catalog_id") -> DataFrame:
    """Rows processed against rows listed per catalogue, with a warning line when some are missing."""
    total = catalog.groupBy(key).agg(F.count("*").alias("total"))
    done = scraped.groupBy(key).agg(F.count("*").alias("scraped"))
    joined = total.join(done, key, "left").withColumn("scraped", F.coalesce("scraped", F.lit(0).cast("bigint")))
    fewer = F.col("scraped") < F.col("total")
    return joined.withColumn("incomplete", fewer).withColumn(
        "message",
        F.concat_ws("\n", F.when(fewer, INCOMPLETE), F.format_string(PROGRESS, "scraped", "total")),
    )


def message_line(text: Column, blank_lines: int = 0, tabs: int = 0) -> Column:
    """One added line of a message log, after blank lines and tabs."""
    return F.concat(F.lit("\n" * (1 + blank_lines) + "\t" * tabs), text)


def final_message(log: Column, report: Column) -> Column:
    """Message log and report text in one."""
    return F.concat(log, F.lit(" \n\n "), report)


def settings_line(language: Column, production: Column, upload: Column, file: Column) -> Column:
    """The settings of a run in one line."""
    # Wording of the settings line.
    where = (
        F.when(language == "us", "Running US ")
        .when(language == "english", "Running canada english")
        .otherwise("Running canada french")
    )
    environment = F.when(production, " on production ").otherwise(" on development ")
    uploads = F.when(upload, "with upload ").otherwise("without upload ")
    listed = F.when(F.coalesce(file, F.lit("")) != "", F.format_string("for %s catalog", file)).otherwise("")
    return F.concat(where, environment, uploads, listed)
