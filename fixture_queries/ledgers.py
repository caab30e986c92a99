"""The variant ledger: earlier shipments are what was published before, later ones are the run."""

from pyspark.sql import functions as F

from catalogflow.operators import ledger
from catalogflow.operators.feed import delete_list
from catalogflow.session import shared_folder
from catalogflow.sources import ledger_store
from fixture_queries.base import query

_ID = "CAST(l_partkey AS VARCHAR) || '_' || CAST(l_suppkey AS VARCHAR)"
_SQL = f"""
    WITH ids AS (SELECT CAST(l_partkey AS VARCHAR) AS root_id, {_ID} AS variant_id, l_shipdate < TIMESTAMP '2001-08-01' AS old
                 FROM lineitem),
         old AS (SELECT DISTINCT root_id, variant_id FROM ids WHERE old),
         now AS (SELECT DISTINCT root_id, variant_id FROM ids WHERE NOT old),
         gone AS (SELECT * FROM old WHERE root_id IN (SELECT root_id FROM now) EXCEPT SELECT * FROM now)"""


def published(t, earlier: bool):
    """Variant ids shipped before the run, or in it (with repeats)."""
    limit = F.lit("2001-08-01").cast("timestamp_ntz")
    rows = t.lineitem.where(F.col("l_shipdate") < limit if earlier else F.col("l_shipdate") >= limit)
    return rows.select(F.concat_ws("_", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")).alias("product_id"))


def compared(t):
    """Changes of the run against the ledger."""
    return ledger.changes(ledger.id_rows(published(t, True)), ledger.id_rows(published(t, False)))


@query("hr_05_root_id", f"""
    SELECT CAST(l_partkey AS VARCHAR) AS root_id, count(*) AS n FROM lineitem GROUP BY ALL""")
def _(t):
    ids = published(t, True).unionAll(published(t, False))
    return ids.groupBy(ledger.root_id(F.col("product_id")).alias("root_id")).agg(F.count("*").alias("n"))


@query("hr_06_ledger_merge", _SQL + "SELECT * FROM old UNION SELECT * FROM now")
def _(t):
    return ledger.merged(ledger.id_rows(published(t, True)), compared(t))


@query("hr_06_ledger_changes", _SQL + """
    SELECT root_id, variant_id, 'gone' AS change FROM gone
    UNION ALL SELECT root_id, variant_id, CASE WHEN variant_id IN (SELECT variant_id FROM old) THEN 'kept' ELSE 'added' END
    FROM now""")
def _(t):
    return compared(t)


@query("st_02_gone_ids", _SQL + "SELECT variant_id AS product_id, root_id FROM gone")
def _(t):
    return ledger.gone(compared(t))


@query("st_03_delete_list", _SQL + """
    SELECT product_id, count(*) AS n
    FROM (SELECT variant_id AS product_id FROM ids WHERE NOT old UNION ALL SELECT variant_id FROM gone) GROUP BY ALL""")
def _(t):
    return delete_list(published(t, False), ledger.gone(compared(t))).groupBy("product_id").agg(F.count("*").alias("n"))


def _stored(t, name):
    import uuid

    path = f"{shared_folder(t.spark)}/{name}-{uuid.uuid4().hex}"
    earlier = ledger_store.read_ledger(t.spark, path)
    ledger_store.append_ledger(earlier.unionByName(ledger.id_rows(published(t, True))), path, "run1")
    return path


def _every(t):
    return ledger.id_rows(published(t, True).unionByName(published(t, False)))


@query("src_05_ledger_read", _SQL + "SELECT * FROM old UNION SELECT * FROM now")
def _(t):
    import uuid

    path = f"{shared_folder(t.spark)}/ledger-read-{uuid.uuid4().hex}"
    ledger_store.append_ledger(_every(t), path, "run1")
    return ledger_store.read_ledger(t.spark, path)


@query("src_05_ledger_import", _SQL + "SELECT * FROM old UNION SELECT * FROM now")
def _(t):
    ids = _every(t)
    documents = ids.select(F.to_json(F.create_map("root_id", F.array("variant_id", "variant_id"))).alias("value"))
    return ledger_store.import_json(documents)


@query("snk_03_ledger_write", _SQL + "SELECT * FROM old UNION SELECT * FROM now")
def _(t):
    path = _stored(t, "ledger-write")
    for _attempt in range(2):  # the second attempt replaces the first
        known = ledger_store.read_ledger(t.spark, path, skip_run="run2")
        changed = ledger.changes(known, ledger.id_rows(published(t, False)))
        ledger_store.append_ledger(ledger.added(changed), path, "run2")
    return ledger_store.read_ledger(t.spark, path)
