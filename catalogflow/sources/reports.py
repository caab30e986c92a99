"""Storage of run reports, one folder per catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_reports(reports: DataFrame, path: str, catalog: str = "catalog_id") -> None:
    """Write the message of each catalogue as text; a catalogue's report is replaced, others stay."""
    (
        reports.select(catalog, "message").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(catalog).text(path)
    )
