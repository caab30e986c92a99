"""URLs, ids inside URLs, and names of stored assets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalogflow.functions.text import cut


def id_after(url: Column, marker: str = "=") -> Column:
    """The id that follows the first marker, up to the next one."""
    return cut(url, marker, 1)


def paired_ids(c: Column, separator: str = "|") -> Column:
    """Two ids packed in one value, as ``struct(first, second)``."""
    return F.struct(cut(c, separator, 0).alias("first"), cut(c, separator, 1).alias("second"))


def absolute(base: str, path: Column, suffix: str = "") -> Column:
    """Absolute URL of a relative path, with an optional query suffix."""
    return F.concat(F.lit(base), path, F.lit(suffix))


def absolute_each(base: str, paths: Column, suffix: str = "") -> Column:
    """:func:`absolute` on every path of an array."""
    return F.transform(paths, lambda p: absolute(base, p, suffix))


def query_url(base: str, *parts: Column, suffix: str = "") -> Column:
    """Base, the non-null parts separated by spaces, and suffix; every space is written ``%20``."""
    return F.replace(F.concat(F.lit(base), F.concat_ws(" ", *parts), F.lit(suffix)), F.lit(" "), F.lit("%20"))


def account_url(url: Column, user: str, production: bool = True) -> Column:
    """Put the account in place of its placeholder; outside production the host becomes ``qa``."""
    # Account placeholder, production and test host labels.
    filled = F.replace(url, F.lit("XXXXX"), F.lit(user))
    return filled if production else F.replace(filled, F.lit("www"), F.lit("qa"))


def per_locale(url: Column, users: dict[str, str], default_user: str) -> Column:
    """One ``struct(locale, url)`` per locale, the account replaced by the locale's; explode it to rows."""
    return F.array(*[
        F.struct(F.lit(locale).alias("locale"), F.replace(url, F.lit(default_user), F.lit(user)).alias("url"))
        for locale, user in users.items()
    ])


def locale_id(product_id: Column, language: Column) -> Column:
    """Product id qualified by country and language; unchanged when there is no language."""
    return F.when(language.isNull(), product_id).otherwise(F.concat_ws("_", product_id, F.lit("can"), language))


def asset_path(store: str, url: Column, host: str | None = None) -> Column:
    """Stored path of an asset: hash of its URL, or of the part after ``host`` when one is given."""
    hashed = url if host is None else cut(url, host, 1)
    return F.concat(F.lit(store), F.lit("/full/"), F.sha1(hashed.cast("binary")), F.lit(".jpg"))


def file_name(url: Column) -> Column:
    """Last path segment of a URL."""
    return F.substring_index(url, "/", -1)


def file_stem(url: Column) -> Column:
    """Last path segment up to its first dot."""
    return F.substring_index(file_name(url), ".", 1)


def name_after(url: Column, marker: str) -> Column:
    """Name between ``marker`` and the query; up to ``/i`` as well when the URL holds a ``$``."""
    name = cut(F.substring_index(url, "?", 1), marker, 1)
    return F.when(url.contains("$"), F.substring_index(name, "/i", 1)).otherwise(name)


def product_asset_path(product_id: Column, name: Column, size: str | Column = "full") -> Column:
    """Path of a product's asset in one size."""
    size = F.lit(size) if isinstance(size, str) else size
    return F.concat(F.concat_ws("/", product_id, size, name), F.lit(".jpg"))
