"""A catalogue run: catalogue and fetched pages to feed, statuses, ledger changes, images and report."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogflow.functions import urls
from catalogflow.operators import assets, catalog as cat, feed, ledger, matching, outcome
from catalogflow.operators.joins import join_reduced
from catalogflow.operators.variants import bundle_masters, bundle_members, kind_flags, record_levels, union_rows
from catalogflow.plans.profile import SiteProfile
from catalogflow.session import staged
from catalogflow.sources import feed_store, files, ledger_store, reports, sheets


BUNDLE_COLUMNS = ("look_id", "line_id", "order_index")
LOCALE_COLUMNS = ("_locale", "_language")  # of a catalogue with an edition for each locale


@dataclass(frozen=True)
class RunTables:
    """Everything a run yields from :func:`staged_pages` and the known ledger rows, each table planned when asked for.

    ``known`` may also be a function that gives the ledger rows of a table of roots. With a ``label`` the updates and the comparison
    with the ledger, which several outputs read, are written once as well. ``bundles`` are the looks and lines that the
    catalogue's ``look_id`` and ``line_id`` name. ``unreadable`` has a ``(catalog_id, message)`` for each sheet that could not be read.
    """

    profile: SiteProfile
    catalog: DataFrame
    pages: DataFrame
    known: DataFrame | Callable[[DataFrame], DataFrame]
    stored: DataFrame | None = None
    run_date: Column | None = None
    label: str | None = None
    bundles: tuple[DataFrame, DataFrame] | None = None
    unreadable: DataFrame | None = None

    def _once(self, df: DataFrame, name: str) -> DataFrame:
        return df if self.label is None else staged(df, f"{self.profile.name}-{self.label}/{name}")

    @cached_property
    def live_pages(self) -> DataFrame:
        """Pages of the catalogues that kept within their error limit; an aborted one yields its report only."""
        return self.pages.where(~F.col("aborted"))

    @cached_property
    def live_catalog(self) -> DataFrame:
        """Rows of the catalogues that were not aborted."""
        return join_reduced(self.catalog, self.pages.where("aborted").select("catalog_id").distinct(), ["catalog_id"], "left_anti")

    @cached_property
    def updates(self) -> DataFrame:
        """Product, colour and size rows, placeholders and bundle rows."""
        fields = [f for f in self.profile.fields if f != "product_id"]
        return self._once(_updates(self.profile, self.live_catalog, self.live_pages, fields, self.bundles), "updates")

    @cached_property
    def changes(self) -> DataFrame:
        """Comparison of the run's ids with the ledger."""
        now = ledger.id_rows(feed.update_and_delete(self.updates)[1], languages=self.profile.languages)
        known = self.known(now.select("root_id").distinct()) if callable(self.known) else self.known
        return self._once(ledger.changes(known, now), "ledger-changes")

    @cached_property
    def deletes(self) -> DataFrame:
        """Ids to delete before the update, by catalogue: a gone id belongs to the catalogues that list its root."""
        now = self.updates.where(F.coalesce("product_id", F.lit("")) != "").select("catalog_id", "product_id")
        roots = now.select("catalog_id", ledger.root_id(F.col("product_id"), self.profile.languages).alias("root_id")).distinct()
        return now.unionByName(ledger.gone(self.changes).join(roots, "root_id").select("catalog_id", "product_id"))

    @cached_property
    def ledger_added(self) -> DataFrame:
        """Rows the ledger gains."""
        return ledger.added(self.changes)

    @cached_property
    def statuses(self) -> DataFrame:
        """Catalogue rows with their new status."""
        new = self.live_pages.select("catalog_id", "product_id", "ord", F.col("_outcome.status").alias("status"))
        return _statuses(self.catalog, new, catalog_without_url(self.profile, self.live_catalog))

    @cached_property
    def mismatches(self) -> DataFrame:
        """Pages that show another id than their catalogue row, with a message."""
        seen = self.live_pages.where(F.col("code").isNull()).select("catalog_id", "ord", "url", "product_id", F.col("_site_id").alias("site_id"))
        return matching.id_mismatches(seen, "product_id", "site_id")

    @cached_property
    def casts(self) -> DataFrame | None:
        """Values of the declared fields and how many are not of their declared type; none where the feed has no declared field."""
        declared = [p for p in self.profile.properties if p.identifier in self.updates.columns]
        return feed.cast_failures(self.updates, declared) if declared else None

    @cached_property
    def report(self) -> DataFrame:
        """Counters and message of each catalogue."""
        counts = outcome.counters(self.pages, max_errors=self.profile.max_errors)
        done = outcome.completeness(self.pages, catalog_with_url(self.profile, self.catalog)).withColumnRenamed("message", "progress")
        missing = catalog_without_url(self.profile, self.catalog).groupBy("catalog_id").agg(F.count("*").alias("_missing"))
        joined = done.drop("scraped").join(counts, "catalog_id", "left").join(missing, "catalog_id", "left")
        joined = joined.withColumn("n101", F.coalesce("n101", F.lit(0)) + F.coalesce("_missing", F.lit(0))).drop("_missing")
        text = F.when(F.col("scraped").isNotNull(), outcome.report_message(self.profile.max_errors))
        done = joined.withColumn("message", F.concat_ws("\n\n", "progress", text))
        if self.unreadable is None:
            return done
        return union_rows(done, self.unreadable.select(F.col("catalog_id").cast(done.schema["catalog_id"].dataType), F.lit(True).alias("aborted"), "message"))

    @cached_property
    def images(self) -> DataFrame:
        """Images to store, without those stored recently."""
        wanted = self.live_pages.where(F.col("code").isNull()).select("product_id", F.explode("image_urls").alias("url"))
        images = assets.manifest(wanted, self.profile.thumbs, self.profile.asset_name)
        if self.stored is None:
            return images
        run_date = F.current_date() if self.run_date is None else self.run_date
        return assets.stale(images, self.stored, run_date, self.profile.image_days)


def processed(profile: SiteProfile, catalog: DataFrame, fetched: DataFrame) -> DataFrame:
    """One row per fetched catalogue page: its item and its outcome code.

    ``catalog`` holds ``(catalog_id, ord, product_id, name, url)`` and ``fetched`` holds
    ``(requested_url, final_url, http_status, html)``. Fields are extracted where the page is read, so page texts are
    never shuffled; only the items meet the catalogue.
    """
    html, rules = F.col("html"), profile.outcome_rules()
    none = F.lit(None).cast("string")
    items = fetched.select(
        "requested_url", "final_url", "http_status", html.isNull().alias("_no_text"), F.array(*[outcome.contains_any(html, r.texts) for r in rules]).alias("_texts"),
        *[f(html).alias(name) for name, f in profile.fields.items()],
        (profile.variants(html) if profile.variants else F.lit(None).cast("array<struct<color:string>>")).alias("_records"),
        (profile.images(html) if profile.images else F.lit(None).cast("array<string>")).alias("image_urls"),
        (profile.site_id(html) if profile.site_id else none).alias("_site_id"),
    )
    missing = F.lit(False)
    for name in profile.required:
        missing = missing | F.col(name).isNull()
    result = outcome.page_outcome(
        rules, F.col("requested_url"), F.col("final_url"), F.col("http_status"), F.col("_no_text"), [F.col("_texts")[i] for i in range(len(rules))], missing)
    coded = items.withColumn("_outcome", result).withColumn("code", F.col("_outcome.code")).drop("_no_text", "_texts", "final_url", "http_status")
    extra = [c for c in (*BUNDLE_COLUMNS, *LOCALE_COLUMNS) if c in catalog.columns]
    listed = catalog_with_url(profile, catalog)
    row = ["catalog_id", "ord", "product_id", F.col("name").alias("sheet_name"), *extra]
    if profile.page_key is None:
        return matching.match_first(coded, listed.select(*row, "url"), scope=("catalog_id",)).withColumnRenamed("requested_url", "url")
    keyed = listed.select(*row, _in_locale(profile, F.col(profile.match_column), F.col("_locale") if profile.locales else None).alias("_key"))
    key = _in_locale(profile, profile.page_key(F.col("requested_url")), _locale_of(profile, F.col("requested_url")))
    return matching.match_first(coded.withColumn("_key", key), keyed, "_key", "_key", ("catalog_id",)).drop("_key").withColumnRenamed("requested_url", "url")


def _locale_of(profile: SiteProfile, url: Column) -> Column | None:
    """Locale whose account a URL names; the longest account counts, where one holds another."""
    by_length = sorted(profile.locales.items(), key=lambda x: -len(x[1].user))
    return F.coalesce(*[F.when(url.contains(locale.user), name) for name, locale in by_length]) if by_length else None


def _in_locale(profile: SiteProfile, key: Column, locale: Column | None) -> Column:
    """A key that pages and catalogue rows of one locale share, null without key or locale."""
    return F.concat(locale, F.lit(" "), key) if profile.locales else key


def staged_pages(profile: SiteProfile, catalog: DataFrame, fetched: DataFrame, label: str) -> DataFrame:
    """Processed pages up to the error cut-off, written once to the shared folder since every output reads them."""
    return limited(profile, staged(processed(profile, catalog, fetched), f"{profile.name}-{label}/pages"), label)


def limited(profile: SiteProfile, pages: DataFrame, label: str) -> DataFrame:
    """Written pages up to the error cut-off.

    The limits are written too: their file size tells Spark whether to broadcast them, before any page is shuffled.
    """
    limits = staged(outcome.error_limits(pages, max_errors=profile.max_errors), f"{profile.name}-{label}/limits")
    return outcome.cut_off(pages, limits, max_errors=profile.max_errors)


def _updates(
    profile: SiteProfile, catalog: DataFrame, pages: DataFrame, fields: list[str],
    bundles: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """Product, colour and size rows of the pages, and placeholders for catalogue rows without a URL."""
    record = pages.schema["_records"].dataType.elementType
    details = [f.name for f in record if f.name != "color"]
    row = F.col("_outcome.row")
    fine, whole = row.isin("all", "item"), row == "all"
    shown = F.coalesce(F.when(fine, F.col("_site_id")), "product_id")  # a page that moved or is gone may show any id
    pages = pages.withColumn("product_id", _feed_id(pages, shown))
    products = pages.where(row.isNotNull()).select(
        "catalog_id", "product_id", *[F.when(fine, F.col(f)).alias(f) if f != "name" else
                        F.when(fine, F.col("name")).otherwise(F.col("sheet_name")).alias("name") for f in fields],
        F.col("_outcome.stock").alias("in_stock"), F.when(whole, F.col("_records")).alias("_records"),
    )
    main = products.drop("_records").withColumn("level", F.lit(0))
    levels = products.where(F.size("_records") > 0).select("catalog_id", F.inline(record_levels(F.col("product_id"), F.col("_records"), details, profile.suffix)))
    if bundles is not None:
        main = main.select("*", *kind_flags("normal"))
    unlisted = catalog_without_url(profile, catalog)
    rows = union_rows(main, levels, cat.placeholders(unlisted.withColumn("product_id", _feed_id(unlisted, F.col("product_id")))))
    if bundles is None:
        return rows
    looks, lines = (_of_catalogs(masters, catalog, key) for masters, key in zip(bundles, ("look_id", "line_id"), strict=True))
    members = pages.where(whole).select(
        "catalog_id", "product_id", *fields, *[c for c in BUNDLE_COLUMNS if c in pages.columns],
        F.transform("_records", lambda r: F.to_json(r)).alias("variants"),
    )
    return union_rows(
        rows, bundle_masters(looks, "look"), bundle_masters(lines, "line"),
        bundle_members(members, "look_id"), bundle_members(members, "line_id"),
    )


def _feed_id(rows: DataFrame, product_id: Column) -> Column:
    """Id that the feed has for a product, with country and language in a localised edition."""
    return urls.locale_id(product_id, F.col("_language")) if "_language" in rows.columns else product_id


def _of_catalogs(masters: DataFrame, catalog: DataFrame, key: str) -> DataFrame:
    """Looks or lines with the catalogues whose rows name them, a row for each; one that no row names belongs to none."""
    if "catalog_id" in masters.columns:
        return masters
    named = catalog.where(F.coalesce(key, F.lit("")) != "").select("catalog_id", F.col(key).alias("product_id")).distinct()
    return masters.join(named, "product_id", "left")


def prepared(profile: SiteProfile, catalog: DataFrame) -> DataFrame:
    """Catalogue rows with normal ids and, for a site whose sheets name the URLs, normal URLs; an edition of each for every locale."""
    rows = catalog.withColumn("product_id", cat.normal_id(F.col("product_id")))
    rows = rows.withColumn("url", cat.normal_url(F.col("url"))) if profile.url_rule == "sheet" else rows
    if not profile.locales:
        return rows
    url = urls.account_url(F.col("url"), profile.account, profile.production)
    users = {name: locale.user for name, locale in profile.locales.items()}
    each = rows.withColumn("_edition", F.explode(urls.per_locale(url, users, profile.account)))
    language = F.coalesce(*[F.when(F.col("_edition.locale") == name, F.lit(locale.language).cast("string")) for name, locale in profile.locales.items()])
    return each.withColumns({
        "catalog_id": F.concat_ws("_", "catalog_id", "_edition.locale"), "url": F.col("_edition.url"),
        "_locale": F.col("_edition.locale"), "_language": language,
    }).drop("_edition")


def catalog_without_url(profile: SiteProfile, catalog: DataFrame) -> DataFrame:
    """Catalogue rows that name no page to fetch."""
    return cat.split_by_url(cat.first_by_id(catalog, scope=("catalog_id",)), profile.url_rule)[1]


def catalog_with_url(profile: SiteProfile, catalog: DataFrame) -> DataFrame:
    """Catalogue rows a run is expected to fetch."""
    return cat.split_by_url(cat.first_by_id(catalog, scope=("catalog_id",)), profile.url_rule)[0]


def _statuses(catalog: DataFrame, new: DataFrame, unlisted: DataFrame) -> DataFrame:
    key = F.struct("catalog_id", "product_id")
    rows = cat.with_status(catalog) if "status" not in catalog.columns else catalog
    return outcome.update_status(
        rows.withColumn("_id", key), new.select(key.alias("_id"), "ord", "status"), unlisted.select(key.alias("_id")), key="_id"
    ).drop("_id")


def run(
    profile: SiteProfile, catalog: DataFrame, fetched: DataFrame, out: str, run_id: str, stored: DataFrame | None = None,
    fmt: str = "parquet", trial: int | None = None, bundles: tuple[DataFrame, DataFrame] | None = None,
    unreadable: DataFrame | None = None,
) -> RunTables:
    """Run a site and write its feed version, ledger additions, statuses, image manifest and reports below ``out``.

    Repeating a run id replaces what its earlier attempt wrote. A catalogue over its error limit gets its report and nothing else: its
    feed, ledger and statuses stay as they were. ``trial`` limits a run to the first rows of each catalogue.
    """
    spark = catalog.sparkSession
    if trial is not None:
        catalog = cat.trial(catalog, trial)
    label = f"{run_id}-{uuid.uuid4().hex}"  # staged tables of this attempt only
    catalog = staged(prepared(profile, catalog), f"{profile.name}-{label}/catalog")
    pages = staged_pages(profile, catalog, fetched, label)
    known = lambda roots: ledger_store.read_ledger(spark, f"{out}/ledger", skip_run=run_id, roots=roots)
    result = RunTables(profile, catalog, pages, known, stored, label=label, bundles=bundles, unreadable=unreadable)
    declared = feed.properties_table(spark, profile.properties)
    feed_store.write_feed(f"{out}/feed", run_id, declared, result.deletes, result.updates, fmt, catalogs=result.live_catalog)
    ledger_store.append_ledger(result.ledger_added, f"{out}/ledger", run_id)
    feed_store.write_table(result.statuses, f"{out}/statuses", run_id)
    feed_store.write_table(result.images, f"{out}/images", run_id)
    if profile.site_id is not None:
        feed_store.write_table(result.mismatches, f"{out}/mismatches", run_id)
    if result.casts is not None:
        feed_store.write_table(result.casts, f"{out}/casts", run_id)
    reports.write_reports(result.report, f"{out}/reports")
    return result


def file_stem(file: Column) -> Column:
    """Name of a file without folder and ending."""
    return F.regexp_replace(F.substring_index(files.decoded(file), "/", -1), "\\.[^.]*$", "")


def run_sheets(
    profile: SiteProfile, sheet_path: str, fetched: DataFrame, out: str, run_id: str, catalog_of: Callable[[Column], Column] = file_stem, **options,
) -> RunTables:
    """:func:`run` over the catalogues of all CSV sheets below a path, read by the profile's layout and ``read_rows``.

    ``catalog_of`` gives the catalogue from a sheet's file path. A sheet that cannot be read gets a report and nothing else.
    """
    rows, problems = sheets.read_csv(fetched.sparkSession, sheet_path, profile.layout, profile.read_rows)
    catalog = rows.withColumn("catalog_id", catalog_of(F.col("file"))).drop("file", "sheet")
    if "name" not in catalog.columns:
        catalog = catalog.withColumn("name", F.lit(None).cast("string"))
    unreadable = problems.select(catalog_of(F.col("file")).alias("catalog_id"), "message")
    return run(profile, catalog, fetched, out, run_id, unreadable=unreadable, **options)
