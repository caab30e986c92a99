"""Run registered queries against their SQL: ``python compare.py [scale folder] [name prefix ...]``."""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal
from pathlib import Path
from typing import TYPE_CHECKING

from fixture_queries import ORACLE, QUERIES

if TYPE_CHECKING:
    import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    """A DuckDB connection with the tables of a scale as views."""
    import duckdb  # only here: the tests are collected without it

    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (float, Decimal)):
        return f"{float(v):.6f}"
    return f"{type(v).__name__}:{v}"


def rows(table) -> list[tuple]:
    """Rows of an Arrow table as sorted text tuples, columns in name order."""
    names = sorted(table.column_names)
    columns = [[_value(v) for v in table.column(n).to_pylist()] for n in names]
    return sorted(zip(*columns, strict=True))


def mismatch(df, con, name: str) -> str | None:
    """What differs between the result of a query and its SQL, or nothing."""
    ours, theirs = df.toArrow(), con.sql(ORACLE[name]).to_arrow_table()
    if sorted(ours.column_names) != sorted(theirs.column_names):
        return f"columns {sorted(ours.column_names)} against {sorted(theirs.column_names)}"
    kinds = [(n, str(ours.schema.field(n).type), str(theirs.schema.field(n).type)) for n in ours.column_names]
    plain = lambda k: k.replace("large_", "").replace("timestamp[us, tz=UTC]", "timestamp[us]")
    kinds = [k for k in kinds if plain(k[1]) != plain(k[2])]
    if kinds:
        return f"types {kinds}"
    a, b = rows(ours), rows(theirs)
    if len(a) != len(b):
        return f"{len(a)} rows against {len(b)}; {sorted(set(a) - set(b))[:2]} / {sorted(set(b) - set(a))[:2]}"
    if not a:
        return "no rows on either side"
    wrong = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
    return f"{len(wrong)} of {len(a)} rows differ, first {wrong[0]}" if wrong else None


if __name__ == "__main__":
    from catalogflow.session import builder

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = [n for n in QUERIES if not sys.argv[2:] or n.startswith(tuple(sys.argv[2:]))]
    spark = builder("compare", spark__sql__shuffle__partitions="8", spark__ui__enabled="false").master("local[8]").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), 0
    for name in chosen:
        start = time.time()
        try:
            problem = mismatch(QUERIES[name](spark, folder), con, name) if name in ORACLE else f"no SQL, {QUERIES[name](spark, folder).count()} rows"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{time.time() - start:6.2f}s {name}: {problem or 'ok'}", flush=True)
    print(f"{len(chosen) - bad} of {len(chosen)} agree")
