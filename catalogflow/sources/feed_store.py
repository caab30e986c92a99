"""Storage of product feeds: one folder per version, the last two kept, and a log of commits that says which count.

``_log`` is only added to (its oldest commits are dropped): commit n is one small file that names the folder of every kept version and
the table of the catalogues' current and previous versions as of that commit.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catalogflow.sources import files

PARTS = ("properties", "delete", "update")
ROW_TAGS = {"properties": "property", "delete": "product_id", "update": "product"}
LOG = "_log"
LISTED = "catalog_id string, version string, folder string"
KEPT_COMMITS = 100
TRIES = 50  # commits of other runs that one commit waits for


def write_part(df: DataFrame, path: str, part: str, fmt: str = "parquet") -> None:
    """Write one part of a feed as parquet or XML. Null fields are left out of the XML."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if fmt == "xml":
        if part == "properties":
            df = df.select(*[F.col(c).alias("_" + c.replace("_", "-")) for c in df.columns])
        elif part == "delete":
            df = df.select(F.col("product_id").alias("_VALUE"))
        writer = df.write.mode("overwrite").format("xml")
        writer.option("rootTag", part).option("rowTag", ROW_TAGS[part]).option("declaration", "").save(f"{path}/{part}")
    else:
        writer.parquet(f"{path}/{part}")


def write_feed(path: str, version: str, properties: DataFrame, deletes: DataFrame, updates: DataFrame,
               fmt: str = "parquet", catalogs: DataFrame | None = None) -> None:
    """Write a feed version and commit it; the last two are kept. Versions must sort in time order.

    Each attempt writes to a folder of its own, and counts from the moment its commit is there, so a job that is lost half-way leaves the
    current feed as it was. With a column ``catalog_id`` each catalogue has a current and a previous version of its own, kept until it
    has two newer ones; ``catalogs`` names those that the version holds, also where their feed is empty (otherwise those of the updates).
    """
    spark = updates.sparkSession
    attempt, folder = 0, f"version={version}"
    while not files.claim(spark, f"{path}/{folder}"):
        attempt += 1
        folder = f"version={version}~{attempt:04d}"
    for part, df in zip(PARTS, (properties, deletes, updates), strict=True):
        write_part(df, f"{path}/{folder}", part, fmt)
    if catalogs is None and "catalog_id" in updates.columns:
        catalogs = updates
    held = None
    if catalogs is not None:
        held = f"{path}/{folder}/catalogs"
        catalogs.select("catalog_id").distinct().write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(held)
    _commit(spark, path, version, folder, held)


def _head(spark: SparkSession, path: str) -> tuple[int, dict]:
    """Number and content of the last commit: the folder of each kept version, and where its list of catalogues lies."""
    commits = [n for n in files.names(spark, f"{path}/{LOG}") if n.endswith(".json")]
    if not commits:
        return 0, {"folders": {}, "catalogs": None}
    return int(commits[-1].partition(".")[0]), json.loads(files.read_text(spark, f"{path}/{LOG}/{commits[-1]}"))


def _listed(spark: SparkSession, path: str, head: dict) -> DataFrame:
    """(catalog_id, version, folder) of all catalogues' kept versions at a commit."""
    return spark.read.schema(LISTED).parquet(f"{path}/{LOG}/{head['catalogs']}") if head["catalogs"] else spark.createDataFrame([], LISTED)


def _commit(spark: SparkSession, path: str, version: str, folder: str, held: str | None) -> None:
    """Add a version to the log: a new list of the catalogues' versions, and one small file that names it and the kept folders.

    The file gets the next number by a rename that fails if another run took the number; then the newer list is read and the
    version is added to that, so that runs side by side lose nothing. Folders that the commit let go are removed after it.
    """
    for _ in range(TRIES):
        number, head = _head(spark, path)
        rows = _listed(spark, path, head).where(F.col("version") != version)
        if held is not None:
            own = spark.read.parquet(held).select(F.col("catalog_id").cast("string"), F.lit(version).alias("version"), F.lit(folder).alias("folder"))
            rows = rows.unionByName(own)
        newest = Window.partitionBy("catalog_id").orderBy(F.desc("version"))
        kept = rows.withColumn("back", F.row_number().over(newest) - 1).where("back < 2").drop("back")
        listed = f"catalogs-{uuid.uuid4().hex}"
        kept.write.parquet(f"{path}/{LOG}/{listed}")
        folders = {**head["folders"], version: folder}
        needed = {r["version"] for r in spark.read.schema(LISTED).parquet(f"{path}/{LOG}/{listed}").select("version").distinct().collect()}  # at most two a catalogue
        stay = {v: f for v, f in folders.items() if v in needed or v in sorted(folders)[-2:]}
        if files.publish(spark, f"{path}/{LOG}/{number + 1:020d}.json", json.dumps({"folders": stay, "catalogs": listed})):
            _forget(spark, path, number - KEPT_COMMITS)
            for gone in {*head["folders"].values()} - {*stay.values()}:
                files.remove(spark, f"{path}/{gone}")
            return
        files.remove(spark, f"{path}/{LOG}/{listed}")
    raise RuntimeError(f"{TRIES} other runs committed to {path} at the same time")


def _forget(spark: SparkSession, path: str, number: int) -> None:
    """Remove a commit that no run can still be reading."""
    old = f"{path}/{LOG}/{number:020d}.json"
    if number > 0 and files.exists(spark, old):
        files.remove(spark, f"{path}/{LOG}/{json.loads(files.read_text(spark, old))['catalogs']}")
        files.remove(spark, old)


def catalog_versions(spark: SparkSession, path: str) -> DataFrame | None:
    """(catalog_id, version, back) of the feeds that name catalogues, ``back`` counted from the catalogue's newest version."""
    head = _head(spark, path)[1]
    if not head["catalogs"]:
        return None
    newest = Window.partitionBy("catalog_id").orderBy(F.desc("version"))
    return _listed(spark, path, head).withColumn("back", F.row_number().over(newest) - 1)


def read_catalogs(spark: SparkSession, path: str, part: str, back: int = 0, only: list | None = None) -> DataFrame:
    """A part of every catalogue's current feed, or of its previous one with ``back=1`` (parquet), with its version.

    All folders that hold a wanted version are one scan. ``only`` names the catalogues to read.
    """
    wanted = catalog_versions(spark, path)
    if wanted is not None:
        wanted = wanted.where(F.col("back") == back)
        if only is not None:
            wanted = wanted.where(F.col("catalog_id").isin([str(c) for c in only]))
        folders = [r["folder"] for r in wanted.select("folder").distinct().collect()]  # at most one a catalogue
    if wanted is None or not folders:
        raise FileNotFoundError(f"no feed version with catalogues in {path}")
    whole = spark.read.option("mergeSchema", "true").parquet(*[f"{path}/{f}/{part}" for f in sorted(folders)])
    whole = whole.withColumn("_folder", F.element_at(F.split(files.decoded(F.col("_metadata.file_path")), "/"), -3))
    chosen = wanted.select(F.col("catalog_id").alias("_c"), F.col("folder").alias("_f"), "version")
    same = whole["catalog_id"].cast("string").eqNullSafe(chosen["_c"]) & (F.col("_folder") == F.col("_f"))
    return whole.join(chosen, same).drop("_c", "_f", "_folder")


def write_table(df: DataFrame, path: str, version: str) -> None:
    """Write one table of a run beside those of earlier runs; repeating the run replaces its own."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/version={version}")


def versions(spark: SparkSession, path: str) -> list[str]:
    """Kept versions, oldest first."""
    return sorted(_head(spark, path)[1]["folders"])


def read_feed(spark: SparkSession, path: str, part: str, back: int = 0) -> DataFrame:
    """A part of the current feed, or of the previous one with ``back=1`` (parquet)."""
    found = _head(spark, path)[1]["folders"]
    if len(found) <= back:
        raise FileNotFoundError(f"no feed version in {path}")
    return spark.read.parquet(f"{path}/{found[sorted(found)[-1 - back]]}/{part}")
