"""JSON values, packed attribute lists and flat lists read as records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalogflow.functions.text import literal_pattern


def with_value(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row, however often a lambda inside reads it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def loose_json(c: Column, schema: str) -> Column:
    """Parse an object literal whose field names may lack quotes; null when malformed."""
    return F.from_json(c, schema, {"allowUnquotedFieldNames": "true", "allowSingleQuotes": "true"})


def reshape_json(c: Column, schema: str, drop: tuple[str, ...] = (), **changed) -> Column:
    """Parse a loose object, drop fields, replace others by ``f(struct) -> Column``, and write it again."""
    parsed = loose_json(c, schema)
    result = parsed
    for name, change in changed.items():
        result = result.withField(name, change(parsed))
    return F.to_json(result.dropFields(*drop) if drop else result)


def normal_json(c: Column) -> Column:
    """JSON text parsed and written again; null when malformed, or when text follows the value."""
    alone = F.try_parse_json(F.concat(F.lit("["), c, F.lit("]")))  # inside brackets, trailing text is an error
    value = F.variant_get(alone, "$[0]", "variant")
    return F.to_json(F.when(F.variant_get(alone, "$[1]", "variant").isNull(), value))


def pack_each(**lists: Column) -> Column:
    """Aligned lists to one JSON object per position."""
    zipped = F.arrays_zip(*[c.alias(name) for name, c in lists.items()])
    return F.transform(zipped, lambda z: F.to_json(z))


def strided(c: Column, stride: int, picks: dict[str, int], start: int = 0, separator: str = ",") -> Column:
    """Read a flat separated list as records of ``stride`` values, keeping the values at the given offsets.

    The result is an array of structs; an offset past the end gives null.
    """
    none = F.array().cast("array<int>")

    def records(values: Column) -> Column:
        starts = F.when(F.size(values) > start, F.sequence(F.lit(start), F.size(values) - 1, F.lit(stride)))
        return F.transform(
            F.coalesce(starts, none),
            lambda i: F.struct(*[F.get(values, i + offset).alias(name) for name, offset in picks.items()]),
        )

    return with_value(F.split(c, literal_pattern(separator)), records)


def zip_lists(**lists: Column) -> Column:
    """Aligned lists as an array of structs, ready for ``inline``."""
    return F.arrays_zip(*[c.alias(name) for name, c in lists.items()])


def concat_lists(*lists: Column) -> Column:
    """Lists joined end to end; an absent list counts as empty."""
    return F.concat(*[F.coalesce(c, F.array().cast("array<string>")) for c in lists])


def non_blank(values: Column) -> Column:
    """The values that are neither null nor empty."""
    return F.filter(values, lambda v: v.isNotNull() & (v != ""))


def first_of(*candidates: Column, default: str | None = None) -> Column:
    """First candidate that is neither null nor empty, else ``default``."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in candidates], F.lit(default))


def first_list(*candidates: Column) -> Column:
    """First candidate list that has a value."""
    return F.coalesce(*[F.when(F.size(c) > 0, c) for c in candidates])
