"""Time the headline queries: ``BENCH_SF_DIR=... BENCH_CPUS=8 python bench.py`` prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from catalogflow.session import builder
from fixture_queries import QUERIES

HEADLINE = """
    run_page_catalog run_statuses run_reports run_vendor_feed ex_01_select_elements ex_01_flat_elements ex_07_items
    sc_03_long_rows src_04_vendor_feed tx_02_squeeze tx_05_between tx_09_decode_entities tx_10_price_text tx_14_chunks
    tx_16_pack_json tx_18_strided fl_05_outcome jn_01_match_first jn_02_match_nth jn_03_in_catalog jn_05_join_options
    jn_06_status_update jn_10_backfill ag_01_ordered_lists ag_01_list_pieces ag_03_counters ag_04_messages
    wn_01_first_by_id wn_03_letter_numbering wn_04_cut_off sl_01_sorted_ids hr_02_three_levels hr_03_bundles
    hr_06_ledger_merge snk_03_ledger_write im_01_manifest im_02_stale_assets sc_02_cast_failures
""".split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        builder("bench", spark__ui__enabled="false", spark__driver__memory="16g")
        .config("spark.sql.shuffle.partitions", cpus).master(f"local[{cpus}]").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    timed("tx_09_decode_entities")  # start the JVM's and Python's workers before the clock
    times = {name: round(timed(name), 3) for name in names}
    print(json.dumps({
        "metric": "total wall time of headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
