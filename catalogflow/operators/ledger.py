"""The ledger of every variant id ever published, kept as rows ``(root_id, variant_id)``.

Rows, not one list per root: a root with very many variants stays spread over tasks. Ids never leave
the ledger, so a run only adds rows and the old ones need not be rewritten.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogflow.functions.urls import locale_id
from catalogflow.operators.joins import join_reduced


def root_id(variant_id: Column, languages: Sequence[str] = ()) -> Column:
    """Root of a variant id: the text before its first underscore, with the country and language of an id in one of ``languages``."""
    root = F.substring_index(variant_id, "_", 1)
    for language in languages:
        own = locale_id(F.substring_index(variant_id, "_", 1), F.lit(language))
        root = F.when((variant_id == own) | variant_id.startswith(F.concat(own, F.lit("_"))), own).otherwise(root)
    return root


def id_rows(ids: DataFrame, variant_id: str = "product_id", languages: Sequence[str] = ()) -> DataFrame:
    """Distinct ledger rows of a list of ids."""
    return ids.select(root_id(F.col(variant_id), languages).alias("root_id"), F.col(variant_id).alias("variant_id")).distinct()


def changes(ledger: DataFrame, current: DataFrame) -> DataFrame:
    """Compare a run with the ledger: ``(root_id, variant_id, change)`` for the roots of the run.

    ``added`` ids are new, ``kept`` ids were known, ``gone`` ids were published before and are absent now.
    The comparison is keyed by root and id, so a large root is spread.
    """
    now = current.select("root_id", "variant_id").distinct()
    known = join_reduced(ledger.select("root_id", "variant_id"), now.select("root_id").distinct(), ["root_id"], "left_semi")
    both = known.withColumn("_old", F.lit(True)).join(
        now.withColumn("_new", F.lit(True)), ["root_id", "variant_id"], "full"
    )
    change = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "gone").otherwise("kept")
    return both.select("root_id", "variant_id", change.alias("change"))


def added(changed: DataFrame) -> DataFrame:
    """Rows to append to the ledger."""
    return changed.where(F.col("change") == "added").select("root_id", "variant_id")


def gone(changed: DataFrame) -> DataFrame:
    """Extra ids to delete: known ids of this run's roots that the run lacks."""
    return changed.where(F.col("change") == "gone").select(F.col("variant_id").alias("product_id"), "root_id")


def merged(ledger: DataFrame, changed: DataFrame) -> DataFrame:
    """The ledger after the run; roots outside the run are unchanged."""
    return ledger.select("root_id", "variant_id").unionByName(added(changed))
