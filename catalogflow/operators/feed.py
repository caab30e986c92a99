"""Shape items into a product feed: declared properties, typed fields, long rows, update and delete lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogflow.functions.records import non_blank

# Declared value types and the Spark type of each.
VALUE_TYPES = {
    "text": T.StringType(),
    "text_list": T.ArrayType(T.StringType()),
    "boolean": T.BooleanType(),
    "decimal": T.DecimalType(18, 2),
    "integer": T.LongType(),
}


@dataclass(frozen=True)
class Property:
    """Declaration of a custom feed field."""

    identifier: str
    display_name: str
    value_type: str = "text"


def properties_schema(properties: Sequence[Property]) -> T.StructType:
    """Declarations as a schema; display name and declared type are field metadata."""
    return T.StructType([
        T.StructField(p.identifier, VALUE_TYPES[p.value_type], True,
                      {"display_name": p.display_name, "value_type": p.value_type})
        for p in properties
    ])


def properties_table(spark: SparkSession, properties: Sequence[Property]) -> DataFrame:
    """Declarations as a table."""
    rows = [(p.identifier, p.display_name, p.value_type) for p in properties]
    return spark.createDataFrame(rows, "identifier string, display_name string, value_type string")


def _typed(raw: Column, value_type: str) -> Column:
    if value_type == "text_list":
        return raw
    if value_type == "text":
        return raw.cast("string")
    text = F.trim(raw)
    if value_type == "decimal":
        text = F.replace(text, F.lit(","), F.lit(""))
    return text.try_cast(VALUE_TYPES[value_type])


def typed_view(items: DataFrame, properties: Sequence[Property]) -> DataFrame:
    """Declared fields in their declared type; a value that does not cast is null."""
    types = {p.identifier: p.value_type for p in properties}
    return items.select(*[
        _typed(F.col(c), types[c]).alias(c) if c in types else F.col(c) for c in items.columns
    ])


def cast_failures(items: DataFrame, properties: Sequence[Property]) -> DataFrame:
    """Values and values that do not cast, per declared field, in one pass."""
    names = [p.identifier for p in properties]
    counts = items.agg(
        *[F.count(p.identifier).alias(f"{p.identifier}_values") for p in properties],
        *[F.count_if(F.col(p.identifier).isNotNull() & _typed(F.col(p.identifier), p.value_type).isNull())
          .alias(f"{p.identifier}_failed") for p in properties],
    )
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("field"), F.col(f"{n}_values").alias("n_values"), F.col(f"{n}_failed").alias("n_failed"))
        for n in names
    ])))


def long_rows(items: DataFrame, fields: Sequence[str], keys: Sequence[str] = ("product_id",)) -> DataFrame:
    """One row per field and position of every item, blanks and nulls dropped.

    Text fields count as lists of one. Positions are those of the kept values.
    """
    types = dict(items.dtypes)
    lists = [
        F.struct(
            F.lit(f).alias("field"),
            non_blank(F.col(f) if types[f].startswith("array") else F.array(F.col(f).cast("string"))).alias("values"),
        )
        for f in fields
    ]
    per_field = items.select(*keys, F.inline(F.array(*lists)))
    return per_field.select(*keys, "field", F.posexplode("values").alias("pos", "value"))


def update_and_delete(items: DataFrame, product_id: str = "product_id") -> tuple[DataFrame, DataFrame]:
    """Update records and delete ids of the same items; every updated id is also deleted first."""
    return items, items.select(F.col(product_id).alias("product_id")).where(F.coalesce("product_id", F.lit("")) != "")


def delete_list(current: DataFrame, gone: DataFrame) -> DataFrame:
    """Delete ids of this run followed by ids seen before and absent now; repeats of current ids stay."""
    return current.select("product_id").unionAll(gone.select("product_id"))


def keep_fields(rows: DataFrame, role: str, subsets: Mapping[object, Sequence[str]]) -> DataFrame:
    """Rows of each role carry only that role's fields; the others are null and left out by the writers."""
    held = {f for fields in subsets.values() for f in fields}

    def kept(name: str) -> Column:
        roles = [value for value, fields in subsets.items() if name in fields]
        return F.when(F.col(role).isin(*roles), F.col(name)).alias(name)

    return rows.select(*[kept(c) if c in held else F.col(c) for c in rows.columns])
