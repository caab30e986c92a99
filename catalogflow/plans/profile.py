"""Description of a site: everything that differs from one site to the next."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame

from catalogflow.functions.numbering import digits
from catalogflow.operators.feed import Property
from catalogflow.operators.outcome import MAX_ERRORS, Rule, standard_rules
from catalogflow.sources.sheets import DEFAULT, Layout, apply_layout

Extractor = Callable[[Column], Column]


@dataclass(frozen=True)
class Locale:
    """An edition of a site: the account in its URLs, and the language that its ids end in (without one they stay)."""

    user: str
    language: str | None = None


@dataclass(frozen=True)
class SiteProfile:
    """A site plug-in.

    ``fields`` maps item fields to functions of the page text, ``variants`` gives an array of
    ``struct(color, size, ...)`` and ``images`` an array of URLs. ``read_rows`` and ``asset_name`` replace a shared step.
    ``rules`` is the site's own outcome table; without one, ``unavailable`` holds the texts of pages whose product is gone.

    A page meets the catalogue row of its URL. With ``page_key``, a function of the URL, it meets the row whose ``match_column`` has that key,
    such as the id inside the URL. ``site_id`` is the id that the page itself shows: the feed names the product by it, and a difference
    from the sheet's is listed. With ``locales`` every catalogue is run once for each, under the id ``<catalogue>_<locale>``: the
    placeholder in its URLs becomes ``account`` and that the locale's, on the test host outside ``production``.
    """

    name: str
    fields: Mapping[str, Extractor]
    required: tuple[str, ...] = ("name",)
    variants: Extractor | None = None
    images: Extractor | None = None
    properties: tuple[Property, ...] = ()
    layout: Layout = DEFAULT
    url_rule: str = "sheet"
    unavailable: tuple[str, ...] = ()
    max_errors: int = MAX_ERRORS
    suffix: Callable[[Column], Column] = digits
    thumbs: Mapping[str, tuple[int, int]] = field(default_factory=dict)
    image_days: int = 300
    read_rows: Callable[[DataFrame, Layout], DataFrame] = apply_layout
    asset_name: Extractor | None = None
    rules: tuple[Rule, ...] | None = None
    page_key: Extractor | None = None
    match_column: str = "product_id"
    site_id: Extractor | None = None
    locales: Mapping[str, Locale] = field(default_factory=dict)
    account: str = ""
    production: bool = True

    @property
    def languages(self) -> tuple[str, ...]:
        """Languages that ids of the site may end in."""
        return tuple(sorted({locale.language for locale in self.locales.values() if locale.language}))

    def outcome_rules(self) -> tuple[Rule, ...]:
        """The outcome table of the site."""
        return standard_rules(self.unavailable) if self.rules is None else self.rules


_PROFILES: dict[str, SiteProfile] = {}


def register(profile: SiteProfile) -> SiteProfile:
    """Make a profile available by name; a later one of the same name replaces it."""
    _PROFILES[profile.name] = profile
    return profile


def profile(name: str) -> SiteProfile:
    """The registered profile of a site."""
    if name not in _PROFILES:
        raise KeyError(f"no site {name!r}; known sites: {', '.join(sorted(_PROFILES)) or 'none'}")
    return _PROFILES[name]
