"""Readers and writers, round trips and repeated runs."""

import csv
import os
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from catalogflow.functions import text, urls
from catalogflow.operators import feed, ledger
from catalogflow.operators.catalog import NO_URL
from catalogflow.operators.extract import script_records
from catalogflow.plans import feed_run, site_run
from catalogflow.plans.profile import Locale, SiteProfile, profile, register
from catalogflow.sources import documents, feed_store, files, ledger_store, sheets, tables, vendor_feed
from catalogflow.sources.reports import write_reports


def test_parquet_and_csv_sheets(spark, out):
    rows = [("head", "x", "y"), ("head", "", ""), (" 1 ", "One", "http://a"), ("2", "Two, b", "none"), ("2", " Two ", "https://c ")]
    spark.createDataFrame(rows, "id string, name string, link string").coalesce(1).write.parquet(f"{out}/p")
    with open(f"{out}/s.csv", "w") as f:
        f.writelines(",".join(f'"{c}"' for c in r) + "\n" for r in rows)
    for cells in (sheets.parquet_rows(spark, f"{out}/p"), sheets.csv_rows(spark, f"{out}/s.csv", 3)):
        got = sheets.apply_layout(cells, sheets.COMPACT).orderBy("ord").collect()
        assert [(r.ord, r.product_id, r.name, r.url) for r in got] == [
            (0, "1", "One", "http://a"), (1, "2", "Two, b", NO_URL), (2, "2", "Two", "https://c")]


@pytest.fixture
def small_ranges(spark):
    """Text is read in ranges of 500 bytes."""
    settings = {"spark.sql.files.maxPartitionBytes": "500", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_csv_sheets_by_byte_ranges(spark, out, small_ranges):
    rnd, want = random.Random(5), {}
    for name in ("a", "b", "c"):
        rows = [["".join(rnd.choice(["x", "yy", " ", '"', ",", "\n", "\r\n", "é"]) for _ in range(rnd.randrange(9))) for _ in range(3)] for _ in range(150)]
        with open(f"{out}/{name}.csv", "w", newline="") as f:
            csv.writer(f, lineterminator="\r\n" if name == "b" else "\n").writerows(rows)
        want |= {(f"{name}.csv", i): r for i, r in enumerate(rows)}
    assert spark.read.text(f"{out}/a.csv").rdd.getNumPartitions() > 2
    got = {(r.sheet, r.row): [r._c0 or "", r._c1 or "", r._c2 or ""] for r in sheets.csv_rows(spark, out, 3).collect()}
    assert got == want


def test_small_byte_ranges_share_tasks(spark, out, small_ranges):
    """The number of tasks follows the bytes and not the ranges, of which there are hundreds here."""
    want = {(f"{name}.csv", i): [f"{name}{i}", f"line\nof {i}", "x" * (i % 40)] for name in "ab" for i in range(3000)}
    for name in "ab":
        with open(f"{out}/{name}.csv", "w", newline="") as f:
            csv.writer(f, lineterminator="\n").writerows(want[f"{name}.csv", i] for i in range(3000))
    assert spark.read.text(out).rdd.getNumPartitions() > 300
    spark.sparkContext.setJobGroup(out, out)
    rows = sheets.csv_rows(spark, f"{out}/*.csv", 3)  # reads the ranges
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(out) for s in tracker.getJobInfo(j).stageIds]
    assert 1 < max(s.numTasks for s in stages if s) <= 4 * spark.sparkContext.defaultParallelism
    assert {(r.sheet, r.row): [r._c0, r._c1, r._c2 or ""] for r in rows.collect()} == want


def test_unreadable_sheets_are_report_rows(spark, out, small_ranges):
    body = "".join(f"{i},n{i},http://{i}\n" for i in range(60))
    for name, text_ in {"good": "h\nh\n" + body, "open": "h\nh\n" + body + '1,"x,http://1\n' + body, "narrow": "h,h\nh,h\n1,2\n" * 30,
                        "long": "h\nh\n" + '1,"' + "x\n" * 10_001 + '",http://1\n', "empty": ""}.items():
        with open(f"{out}/{name}.csv", "w") as f:
            f.write("\ufeff" * (name == "good") + text_)
    rows, problems = sheets.read_csv(spark, out, sheets.COMPACT)
    assert {(r.sheet, r.n) for r in rows.groupBy("sheet").agg(F.count("*").alias("n")).collect()} == {("good.csv", 60)}
    assert {(r.sheet, r.code, r.reason) for r in problems.collect()} == {
        ("open.csv", 103, "a quote is not closed"), ("narrow.csv", 103, "the sheet has no column 2 for url"), ("long.csv", 103, "a record has more than 10000 lines")}
    assert problems.where("sheet = 'open.csv'").first().message == "Error reading excel file\nError occurred for given file: open.csv"


def test_run_from_sheets_with_an_own_reader(spark, out):
    os.makedirs(f"{out}/sheets")
    catalog, fetched = inputs(spark)
    for c in ("c", "e"):
        rows = [(r.product_id, r.name, r.url) for r in catalog.where(F.col("catalog_id") == c).orderBy("ord").collect()]
        with open(f"{out}/sheets/{c}.csv", "w", newline="") as f:
            csv.writer(f).writerows([("id", "name", "url"), *rows])
    with open(f"{out}/sheets/f.csv", "w") as f:
        f.write('"never closed')
    upper = lambda cells, layout: sheets.apply_layout(cells, layout).withColumn("name", F.upper("name"))
    site = replace(SHOP, name="sheet_shop", layout=sheets.Layout(1, {"product_id": 0, "name": 1, "url": 2}), read_rows=upper)
    result = site_run.run_sheets(site, f"{out}/sheets", fetched, f"{out}/run", "1")
    updates = {r.product_id: r.name for r in feed_store.read_feed(spark, f"{out}/run/feed", "update").collect()}
    assert updates["p0"] == "Zero!" and updates["p2"] == "TWO" and "p0_0_1" in updates and "q0" not in updates
    messages = {r.catalog_id: r.value for r in spark.read.text(f"{out}/run/reports", wholetext=True).collect()}
    assert set(messages) == {"c", "e", "f"} and messages["f"].startswith("Error reading excel file\nError occurred for given file: f.csv")
    assert result.report.where("catalog_id = 'f'").first().aborted


def test_layouts(spark):
    df = spark.createDataFrame([(1.0, "look", "line", "x", "http://a", 0)], "_c0 double, _c1 string, _c2 string, _c3 string, _c4 string, row bigint")
    rows = sheets.apply_layout(df.withColumn("row", F.lit(1).cast("bigint")), sheets.BUNDLE).first()
    assert rows.product_id == "1" and rows.look_id == "look" and "order_index" not in rows.asDict()
    with pytest.raises(ValueError, match="no column 3"):
        sheets.apply_layout(df.drop("_c3", "_c4"), sheets.DEFAULT)


def test_catalog_select_reaches_the_scan(spark, out):
    df = spark.createDataFrame([(1, "n", "u", "p", "none", 7, "wide"), (2, "n", "u", "p", "none", 8, "wide")],
                               "id bigint, name string, url string, product_id string, status string, catalog_id bigint, extra string")
    df.write.parquet(f"{out}/t")
    table = spark.read.parquet(f"{out}/t")
    assert [r.id for r in tables.select_catalog(table, 7).collect()] == [1]
    assert [r.id for r in tables.select_catalog(table, 7, row_id=2).collect()] == [2]
    plan = tables.select_catalog(table, 7)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(catalog_id,7)" in plan and "extra" not in plan


FEED = """<feed xmlns:m="urn:m" xmlns:d="urn:d"><entry><m:properties><d:Id>1</d:Id><d:EngName>Vase</d:EngName>
<d:EngLongDesc>&amp;lt;b&amp;gt;caf&amp;eacute;</d:EngLongDesc><d:RetailPrice>12.3400</d:RetailPrice><d:IsActive>0</d:IsActive>
<d:ImagePath_Large>a.jpg</d:ImagePath_Large><d:Alternate2ImagePath_Large>b.jpg</d:Alternate2ImagePath_Large></m:properties></entry>
<entry><m:properties><d:Id>2</d:Id><d:EngName>Lamp</d:EngName><d:RetailPrice>5.0000</d:RetailPrice><d:IsActive>true</d:IsActive>
</m:properties></entry></feed>"""


def test_vendor_feed_run(spark, out):
    with open(f"{out}/feed.xml", "w") as f:
        f.write(FEED)
    catalog = spark.createDataFrame([("1",), ("9",)], "product_id string")
    result = feed_run.run(vendor_feed.read_feed(spark, f"{out}/feed.xml"), catalog, f"{out}/run", "1", base="http://v.invalid/")
    assert feed_store.read_feed(spark, f"{out}/run/feed", "delete").first().product_id == "1"
    assert spark.read.parquet(f"{out}/run/statuses").count() == 2
    item = result.updates.first()
    assert result.updates.count() == 1
    assert (item.name_english, item.custom_price, item.in_stock, item.name_spanish) == ("Vase", "12.34", "NOT_IN_STOCK", None)
    assert item.description_english == "<![CDATA[<b>café]]>"
    assert item.image_urls == ["http://v.invalid/a.jpg", "http://v.invalid/b.jpg"] and len(item.normal_image_url) == 2
    assert {(r.product_id, r.status) for r in result.statuses.collect()} == {("1", "ran"), ("9", "not_found")}
    assert result.report.first().missing == 1
    assert [r.product_id for r in spark.read.parquet(f"{out}/run/not_found").collect()] == ["9"]
    assert spark.read.text(f"{out}/run/reports/catalog_id=all", wholetext=True).first().value.strip() == "1 id(s) from id list weren't found in feed"
    for df in (result.updates, result.statuses, result.not_found, result.report):  # the XML was parsed once, before
        assert not [f for f in df.inputFiles() if f.endswith(".xml")] and "xml" not in df._jdf.queryExecution().executedPlan().toString().lower().replace("feed.xml", "")


def test_vendor_feed_run_over_catalogues(spark, out):
    with open(f"{out}/feed.xml", "w") as f:
        f.write(FEED)
    catalog = spark.createDataFrame([("a", "1"), ("a", "1"), ("a", "7"), ("b", "1"), ("b", "2"), ("c", None)], "catalog_id string, product_id string")
    feed_run.run(vendor_feed.read_feed(spark, f"{out}/feed.xml"), catalog, f"{out}/run", "1")
    for part in ("update", "delete"):
        rows = feed_store.read_catalogs(spark, f"{out}/run/feed", part).collect()
        assert sorted((r.catalog_id, r.product_id) for r in rows) == [("a", "1"), ("b", "1"), ("b", "2")]
    messages = {r.catalog_id: r.value.strip() for r in spark.read.text(f"{out}/run/reports", wholetext=True).collect()}
    assert messages["b"] == "All ids found in feed." and messages["a"].startswith("1 id(s)") and messages["c"].startswith("1 id(s)")


def test_ledger_store(spark, out):
    path = f"{out}/ledger"
    assert ledger_store.read_ledger(spark, path).count() == 0
    rows = lambda *v: ledger.id_rows(spark.createDataFrame([(x,) for x in v], "product_id string"))
    ledger_store.append_ledger(rows("a", "a_1", "b_1"), path, "1")
    for _attempt in range(2):
        known = ledger_store.read_ledger(spark, path, skip_run="2")
        ledger_store.append_ledger(ledger.added(ledger.changes(known, rows("a_1", "a_2", "c_1"))), path, "2")
    assert sorted(r.variant_id for r in ledger_store.read_ledger(spark, path).collect()) == ["a", "a_1", "a_2", "b_1", "c_1"]
    roots = spark.createDataFrame([("a",)], "root_id string")
    pruned = ledger_store.read_ledger(spark, path, roots=roots)
    assert {r.variant_id for r in pruned.where("root_id = 'a'").collect()} == {"a", "a_1", "a_2"}
    ledger_store.compact(ledger_store.read_ledger(spark, path), f"{out}/compact", "all")
    assert ledger_store.read_ledger(spark, f"{out}/compact").count() == 5


def many(spark, roots, ids, start=0):
    """Ledger rows of many roots, a third of them of one root."""
    root = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("r"), (F.col("id") % roots).cast("string")))
    return spark.range(start, start + ids).select(root.alias("root_id"), F.concat_ws("_", root, F.sha1(F.col("id").cast("string").cast("binary"))).alias("variant_id"))


def files_of(df, path):
    """How many files of a folder a table reads."""
    return sum(path in f for f in df.inputFiles())


def test_a_run_over_few_roots_opens_few_ledger_files(spark, out):
    path = f"{out}/ledger"
    ledger_store.append_ledger(many(spark, 5000, 60_000), path, "big", file_bytes=100_000)
    for n in range(6):  # small runs, one file each
        ledger_store.append_ledger(spark.createDataFrame([(f"s{n}", f"s{n}_{i}") for i in range(50)], "root_id string, variant_id string"), path, f"small{n}")
    every = ledger_store.read_ledger(spark, path)
    assert files_of(every, "run=big") > 20 and files_of(every, "run=small") == 6
    pick = lambda *names: ledger_store.read_ledger(spark, path, roots=spark.createDataFrame([(n,) for n in names], "root_id string"))
    few = pick("r7", "s3")
    assert files_of(few, "run=big") <= 2 and files_of(few, "run=small") == 1
    for name in ("r7", "s3", "hot"):
        assert pick(name).where(F.col("root_id") == name).count() == every.where(F.col("root_id") == name).count() > 0
    assert pick("nowhere").where("root_id = 'nowhere'").count() == 0
    # a run whose manifest was lost is read whole
    files.remove(spark, f"{path}/_manifest/run=small5")
    assert files_of(pick("s3"), "run=small") == 2


def test_files_of_a_hot_root_follow_its_size(spark, out):
    held = []
    for n in (30_000, 90_000):
        ledger_store.append_ledger(many(spark, 500, n), f"{out}/{n}", "1", file_bytes=150_000)
        written = spark.read.parquet(f"{out}/{n}/run=1")
        held.append(written.where("root_id = 'hot'").select(F.input_file_name()).distinct().count())
        assert written.count() == n
    assert held[0] >= 3 and held[1] >= 2 * held[0]


def test_a_run_reads_the_ledger_of_its_roots(spark, out):
    site_run.run(SHOP, *inputs(spark), out, "0001")
    ledger_store.append_ledger(many(spark, 5000, 30_000), f"{out}/ledger", "0002", file_bytes=50_000)
    asked = []
    read = ledger_store.read_ledger
    try:
        ledger_store.read_ledger = lambda *a, **k: asked.append(read(*a, **k)) or asked[-1]
        site_run.run(SHOP, *inputs(spark, "#c=red;s=S;"), out, "0003")
    finally:
        ledger_store.read_ledger = read
    assert len(asked) == 1 and files_of(asked[0], "run=0001") == 1 and files_of(asked[0], "run=0002") < files_of(read(spark, f"{out}/ledger"), "run=0002") / 2
    assert "p0_1" in {r.product_id for r in feed_store.read_feed(spark, f"{out}/feed", "delete").collect()}


def test_ledger_import(spark):
    docs = spark.createDataFrame([('{"a": ["a", "a_1", "a_1"], "b": []}',)], "value string")
    assert {tuple(r) for r in ledger_store.import_json(docs).collect()} == {("a", "a"), ("a", "a_1")}


def test_feed_versions_keep_two(spark, out):
    declared = feed.properties_table(spark, [feed.Property("size", "Size", "integer")])
    for n in (1, 2, 3, 3):
        updates = spark.createDataFrame([(str(i), ["x", "y"], None) for i in range(n)], "product_id string, tags array<string>, none string")
        feed_store.write_feed(f"{out}/f", f"{n:04d}", declared, updates.select("product_id"), updates)
    assert feed_store.versions(spark, f"{out}/f") == ["0002", "0003"]
    assert feed_store.read_feed(spark, f"{out}/f", "update").count() == 3
    assert feed_store.read_feed(spark, f"{out}/f", "update", back=1).count() == 2
    with pytest.raises(FileNotFoundError):
        feed_store.read_feed(spark, f"{out}/f", "update", back=2)


def test_runs_side_by_side_lose_nothing(spark, out, monkeypatch):
    declared = feed.properties_table(spark, [])
    rows = lambda *c: spark.createDataFrame([(x, f"{x}1") for x in c], "catalog_id string, product_id string")
    write = lambda v, *c: feed_store.write_feed(f"{out}/f", v, declared, rows(*c), rows(*c))
    write("1", "a", "b")
    publish, between = files.publish, []

    def late(*args):  # another run commits just before this one does
        if not between:
            between.append(True)
            write("3", "b")
        return publish(*args)

    monkeypatch.setattr(files, "publish", late)
    write("2", "a")
    monkeypatch.setattr(files, "publish", publish)
    current = lambda **k: {(r.catalog_id, r.version) for r in feed_store.read_catalogs(spark, f"{out}/f", "update", **k).collect()}
    assert current() == {("a", "2"), ("b", "3")} and current(back=1) == {("a", "1"), ("b", "1")} and current(only=["b"]) == {("b", "3")}
    assert feed_store.versions(spark, f"{out}/f") == ["1", "2", "3"]
    write("4", "a", "b")
    assert current(back=1) == {("a", "2"), ("b", "3")} and feed_store.versions(spark, f"{out}/f") == ["2", "3", "4"]
    assert "version=1" not in files.folders(spark, f"{out}/f")
    assert len([n for n in files.names(spark, f"{out}/f/_log") if n.endswith(".json")]) == 4  # one small file a commit
    plan = feed_store.read_catalogs(spark, f"{out}/f", "update")._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan


def test_a_lost_job_leaves_the_current_feed(spark, out):
    declared, rows = feed.properties_table(spark, []), spark.createDataFrame([("a", "a1")], "catalog_id string, product_id string")
    feed_store.write_feed(f"{out}/f", "1", declared, rows, rows)
    broken = rows.withColumn("product_id", F.raise_error(F.lit("lost")))
    for version in ("1", "2"):
        with pytest.raises(Exception, match="lost"):
            feed_store.write_feed(f"{out}/f", version, declared, rows, broken)
    assert feed_store.read_feed(spark, f"{out}/f", "update").count() == 1 and feed_store.versions(spark, f"{out}/f") == ["1"]
    feed_store.write_feed(f"{out}/f", "2", declared, rows, rows)
    assert feed_store.versions(spark, f"{out}/f") == ["1", "2"]


def test_bundles_belong_to_the_catalogues_that_name_them(spark, out):
    catalog, fetched = inputs(spark)
    listed = catalog.withColumns({"look_id": F.when(F.col("product_id") == "p0", "L1").otherwise(""), "line_id": F.lit(None).cast("string")})
    looks = spark.createDataFrame([("L1", "Look one")], "product_id string, name string")
    site_run.run(SHOP, listed, fetched, out, "1", bundles=(looks, looks.where("false")))
    for part in ("update", "delete"):
        ids = {(r.catalog_id, r.product_id) for r in feed_store.read_catalogs(spark, f"{out}/feed", part).collect()}
        assert {("c", "L1"), ("c", "L1_p0"), ("c", "p0")} <= ids, part


def test_publish_is_once(spark, out):
    assert files.publish(spark, f"{out}/one", "é") and not files.publish(spark, f"{out}/one", "two")
    assert files.read_text(spark, f"{out}/one") == "é" and files.names(spark, out) == ["one"]


def test_feed_as_xml(spark, out):
    declared = feed.properties_table(spark, [feed.Property("size", "Size", "integer")])
    updates = spark.createDataFrame([("1", ["x", "<&>"], None)], "product_id string, tags array<string>, none string")
    feed_store.write_feed(f"{out}/f", "1", declared, updates.select("product_id"), updates, fmt="xml")
    xml = {p: "".join(r.value for r in spark.read.text(f"{out}/f/version=1/{p}", wholetext=True).collect()) for p in feed_store.PARTS}
    assert '<property identifier="size" display-name="Size" value-type="integer"' in xml["properties"]
    assert "<product_id>1</product_id>" in xml["delete"]
    assert "<tags>x</tags>" in xml["update"] and "&lt;&amp;" in xml["update"] and "none" not in xml["update"]


def test_feed_as_one_document(spark, out):
    import xml.etree.ElementTree as et

    path = f"{out}/export.xml"
    declared = feed.properties_table(spark, [feed.Property("size", "Size & fit", "integer"), feed.Property("tags", "Tags", "text_list")])
    rows = [(f"p{i:04d}", ["x", "<&>"] if i % 3 else None, f"two\n<product_id>{i}</product_id> lines é" if i % 2 else None) for i in range(400)]
    updates = spark.createDataFrame(rows, "product_id string, tags array<string>, name string").repartition(7)
    deletes = updates.select("product_id").unionAll(spark.createDataFrame([("gone&1",), ("",), (None,)], "product_id string"))
    documents.write_document(path, declared, deletes, updates, order=["product_id"], namespace="urn:feed")
    tree = et.parse(path).getroot()
    assert [c.tag for c in tree] == [f"{{urn:feed}}{p}" for p in feed_store.PARTS]
    assert [(p.get("identifier"), p.get("display-name"), p.get("value-type")) for p in tree[0]] == [("size", "Size & fit", "integer"), ("tags", "Tags", "text_list")]
    assert [d.text for d in tree[1]] == ["gone&1", *[r[0] for r in rows]]
    got = [(p[0].text, [e.text for e in p if e.tag.endswith("tags")] or None, next((e.text for e in p if e.tag.endswith("name")), None)) for p in tree[2]]
    assert got == rows
    assert sorted(tuple(r) for r in documents.read_document(spark, path, "update", updates.schema).collect()) == rows
    assert sorted(r.product_id for r in documents.read_document(spark, path, "delete").collect()) == ["gone&1", *[r[0] for r in rows]]
    assert {tuple(r) for r in documents.read_document(spark, path, "properties").collect()} == {tuple(r) for r in declared.collect()}
    # the next export keeps this one as a backup, and an empty feed is a whole document
    for _again in range(2):
        documents.write_document(path, declared.where("false"), deletes.where("false"), updates.where("false"))
    assert [len(c) for c in et.parse(path).getroot()] == [0, 0, 0] and [len(c) for c in et.parse(f"{out}/export_backup.xml").getroot()] == [0, 0, 0]
    assert files.folders(spark, out) == [] and not [n for n in files.names(spark, out) if "draft" in n]


def test_reports_replace_one_catalogue(spark, out):
    rows = lambda *r: spark.createDataFrame(list(r), "catalog_id string, message string")
    write_reports(rows(("a", "one\ntwo"), ("b", "x")), f"{out}/r")
    write_reports(rows(("b", "new")), f"{out}/r")
    got = {r.catalog_id: r.value.strip() for r in spark.read.text(f"{out}/r", wholetext=True).collect()}
    assert got == {"a": "one\ntwo", "b": "new"}


SHOP = register(SiteProfile(
    name="test_shop", fields={"name": lambda h: text.first_between(h, "<h1>", "</h1>")},
    variants=lambda h: script_records(h, "<v>", "</v>", "#", {"color": ("c=", ";"), "size": ("s=", ";")}),
    images=lambda h: text.between(h, 'src="', '"'), unavailable=("sold out",), max_errors=2,
    properties=(feed.Property("level", "Level", "integer"),),
))


def inputs(spark, sizes="#c=red;s=S;#c=red;s=M;#c=blue;s=S;"):
    catalog = spark.createDataFrame(
        [("c", 0, "p0", "Zero", "http://0"), ("c", 1, "p0", "Again", "http://0b"), ("c", 2, "p2", "Two", "http://2"), ("c", 3, "p3", "Three", NO_URL),
         ("c", 4, "p4", "Four", "http://4"), ("c", 5, "p5", "Five", "http://5"), ("e", 0, "q0", "E0", "http://q0"), ("e", 1, "q1", "E1", "http://q1"),
         ("e", 2, "q2", "E2", "http://q2"), ("e", 3, "q3", "E3", "http://q3")],
        "catalog_id string, ord bigint, product_id string, name string, url string")
    page = f'<h1>Zero!</h1><v>{sizes}</v><img src="http://i/1.jpg"><img src="http://i/1.jpg">'
    fetched = [("http://0", "http://0", 200, page), ("http://2", "http://home", 200, "moved"), ("http://4", "http://4", 200, "sold out"),
               ("http://5", "http://5", 404, "x"), ("http://other", "http://other", 200, page)]
    fetched += [(f"http://q{i}", f"http://q{i}", 200, "broken") for i in range(3)] + [("http://q3", "http://q3", 200, page)]
    return catalog, spark.createDataFrame(fetched, "requested_url string, final_url string, http_status int, html string")


def test_site_run(spark, out):
    result = site_run.run(SHOP, *inputs(spark), out, "0001")
    updates = {r.product_id: r for r in feed_store.read_feed(spark, f"{out}/feed", "update").collect()}
    assert set(updates) == {"p0", "p0_0", "p0_1", "p0_0_0", "p0_0_1", "p0_1_0", "p2", "p4", "p3"}
    assert updates["p0"].name == "Zero!" and updates["p0"].in_stock == "IN_STOCK"
    assert updates["p2"].name == "Two" and {updates[p].in_stock for p in ("p2", "p3", "p4")} == {"NOT_AVAILABLE"}
    assert updates["p0_0_1"]["size"] == "M" and updates["p0_0_1"].master_product_id == "p0_0" and updates["p0_1"].color == "blue"
    statuses = {(r.catalog_id, r.ord): r.status for r in result.statuses.collect()}
    assert statuses == {("c", 0): "ran", ("c", 1): "ran", ("c", 2): "no_avail", ("c", 3): "no_url", ("c", 4): "no_avail", ("c", 5): "error",
                        ("e", 0): "none", ("e", 1): "none", ("e", 2): "none", ("e", 3): "none"}  # e stops at its third error and publishes nothing
    report = {r.catalog_id: r for r in result.report.collect()}
    assert (report["c"].scraped, report["c"].n102, report["c"].n104, report["c"].incomplete) == (4, 2, 1, False)
    assert report["e"].aborted and report["e"].incomplete and "Scraping terminated after error occurred on 2 urls." in report["e"].message
    assert result.images.count() == spark.read.parquet(f"{out}/images").count() == 1
    assert spark.read.parquet(f"{out}/statuses").count() == 10
    # The next run drops a size: its id is deleted, the ledger keeps it, and a repeat of the run changes nothing.
    for _attempt in range(2):
        site_run.run(SHOP, *inputs(spark, "#c=red;s=S;#c=blue;s=S;"), out, "0002")
        deletes = sorted(r.product_id for r in feed_store.read_feed(spark, f"{out}/feed", "delete").collect())
        assert deletes == sorted({"p0", "p0_0", "p0_1", "p0_0_0", "p0_0_1", "p0_1_0", "p2", "p4", "p3"})
        assert ledger_store.read_ledger(spark, f"{out}/ledger").count() == 9


def test_site_run_with_bundles(spark):
    catalog, fetched = inputs(spark)
    listed = catalog.withColumns({"look_id": F.when(F.col("product_id") == "p0", "L1").otherwise(""), "line_id": F.lit(None).cast("string"),
                                  "order_index": F.col("ord").cast("int")})
    looks = spark.createDataFrame([("L1", "Look one", "http://i/look.jpg")], "product_id string, name string, normal_image_url string")
    lines = spark.createDataFrame([("N1", "Line one")], "product_id string, name string")
    pages = site_run.staged_pages(SHOP, listed, fetched, "bundles")
    result = site_run.RunTables(SHOP, listed, pages, ledger.id_rows(looks).where("false"), bundles=(looks, lines))
    rows = {r.product_id: r for r in result.updates.collect()}
    assert {"L1", "N1", "L1_p0", "p0", "p0_0"} <= set(rows) and "N1_p0" not in rows
    member = rows["L1_p0"]
    assert (member.master_product_id, member.style, member.name, member.order_index) == ("L1", "p0", "Zero!", 0)
    assert member.variants[0] == '{"color":"red","size":"S"}' and rows["L1"].shop_look == "True"
    assert {"L1_p0", "L1"} <= {r.product_id for r in result.deletes.collect()}


def test_editions_have_feeds_and_ids_of_their_own(spark, out):
    site = replace(SHOP, name="test_editions", account="acc", page_key=lambda u: urls.id_after(u, "sku="), max_errors=9,
                   locales={"us": Locale("acc"), "fr": Locale("acc_fr", "fr")})
    catalog = spark.createDataFrame([("c", 0, "p0", "Zero", "http://s/XXXXX?sku=p0"), ("c", 1, "p1", "One", "http://s/XXXXX?sku=p1"), ("c", 2, "p2", "Two", NO_URL)],
                                    "catalog_id string, ord bigint, product_id string, name string, url string")

    def fetch(us, fr):
        rows = [(f"http://t/{account}?x=1&sku=p0", 200, f"<h1>Zero {account}</h1><v>{sizes}</v>") for account, sizes in (("acc", us), ("acc_fr", fr))]
        rows += [("http://t/acc_fr?sku=p1", 200, "sold out"), ("http://t/other?sku=p1", 200, "<h1>x</h1>"), ("http://t/acc?no", 200, "<h1>x</h1>")]
        return spark.createDataFrame([(u, u, s, h) for u, s, h in rows], "requested_url string, final_url string, http_status int, html string")

    both = "#c=red;s=S;#c=red;s=M;"
    result = site_run.run(site, catalog, fetch(both, both), out, "1")
    feed_of = lambda part: {c: {r.product_id for r in feed_store.read_catalogs(spark, f"{out}/feed", part).where(F.col("catalog_id") == c).collect()} for c in ("c_us", "c_fr")}
    first = {"c_us": {"p0", "p0_0", "p0_0_0", "p0_0_1", "p2"}, "c_fr": {"p0_can_fr", "p0_can_fr_0", "p0_can_fr_0_0", "p0_can_fr_0_1", "p1_can_fr", "p2_can_fr"}}
    assert feed_of("update") == first and feed_of("delete") == first
    statuses = {(r.catalog_id, r.product_id): r.status for r in result.statuses.collect()}
    assert statuses == {("c_us", "p0"): "ran", ("c_us", "p1"): "none", ("c_us", "p2"): "no_url", ("c_fr", "p0"): "ran", ("c_fr", "p1"): "no_avail", ("c_fr", "p2"): "no_url"}
    # the French edition loses a size: it alone deletes that id
    site_run.run(site, catalog, fetch(both, "#c=red;s=S;"), out, "2")
    assert feed_of("delete") == first and "p0_can_fr_0_1" not in feed_of("update")["c_fr"]


def test_pages_may_show_ids_of_their_own(spark, out):
    site = replace(SHOP, name="test_own_ids", site_id=lambda h: F.nullif(text.first_between(h, "<id>", "</id>"), F.lit("")))
    catalog, fetched = inputs(spark)
    shown = fetched.withColumn("html", F.concat("html", F.when(F.col("requested_url") == "http://0", "<id>z0</id>").otherwise("<id>wrong</id>")))
    result = site_run.run(site, catalog.where("catalog_id = 'c'"), shown, out, "1")
    ids = {r.product_id for r in result.updates.collect()}
    assert {"z0", "z0_0", "z0_0_1", "p2", "p4", "p3"} <= ids and not ids & {"p0", "wrong"}  # pages that are gone keep the sheet's id
    assert [tuple(r) for r in spark.read.parquet(f"{out}/mismatches").select("catalog_id", "product_id", "site_id", "message").collect()] == [
        ("c", "p0", "z0", "Not equal, id in sheet p0, on site z0")]
    assert {(r.product_id, r.status) for r in result.statuses.where("ord < 2").collect()} == {("p0", "ran")}
    casts = spark.read.parquet(f"{out}/casts").collect()
    assert [(r.field, r.n_failed) for r in casts] == [("level", 0)] and casts[0].n_values > 0


def test_trial_run(spark, out):
    result = site_run.run(SHOP, *inputs(spark), out, "1", trial=1)
    assert {r.product_id for r in result.updates.where("level = 0").collect()} == {"p0"}


def test_profiles_are_found_by_name():
    assert profile("test_shop") is SHOP
    with pytest.raises(KeyError, match="no site"):
        profile("missing")


def test_a_stopped_catalogue_writes_nothing_in_later_batches(spark, out):
    from catalogflow.streaming import arrivals

    catalog, fetched = inputs(spark)
    written = lambda n: {r.product_id for r in spark.read.parquet(f"{out}/pages/batch={n}").collect()}
    counts = lambda n: {(r.catalog_id, r.errors) for r in spark.read.parquet(f"{out}/pages/_errors/batch={n}").collect()}

    def arrive(*urls):  # every call restarts the stream
        if urls:
            fetched.where(F.col("requested_url").isin(*urls)).coalesce(1).write.mode("append").parquet(f"{out}/in")
        stream = spark.readStream.schema(fetched.schema).parquet(f"{out}/in")
        arrivals.start(SHOP, catalog.withColumn("product_id", F.concat(F.lit(" "), "product_id")), stream, f"{out}/pages", f"{out}/check").awaitTermination()

    arrive("http://0", "http://q0", "http://q1")
    arrive("http://q2")
    assert written(0) == {"p0", "q0", "q1"} and written(1) == {"q2"} and counts(1) == {("e", 3)}  # ids are those of the prepared catalogue
    arrive("http://q3", "http://4")
    assert written(2) == {"p4"}
    os.remove(f"{out}/check/commits/2")  # as if the driver was lost after the batch's rows were written: the batch runs again
    if os.path.exists(f"{out}/check/commits/.2.crc"):
        os.remove(f"{out}/check/commits/.2.crc")
    arrive()
    assert written(2) == {"p4"} and counts(2) == {("e", 3)} and not os.path.exists(f"{out}/pages/_errors/batch=0")
    files.remove(spark, f"{out}/pages/_errors/batch=2")  # a lost count is taken from the pages
    arrive("http://q3", "http://5")
    assert written(3) == {"p5"} and counts(3) == {("e", 3)}
    done = arrivals.finish(SHOP, spark, f"{out}/pages", "stopped")
    assert {(r.catalog_id, r.product_id) for r in done.where("aborted").collect()} == {("e", "q0"), ("e", "q1"), ("e", "q2")}


def test_arrivals_match_a_batch_run(spark, out):
    from catalogflow.streaming import arrivals

    catalog, fetched = inputs(spark)
    for n, part in enumerate(fetched.randomSplit([0.5, 0.5], seed=3)):
        part.coalesce(1).write.mode("append").parquet(f"{out}/in")
        stream = spark.readStream.schema(fetched.schema).parquet(f"{out}/in")
        arrivals.start(SHOP, catalog, stream, f"{out}/pages", f"{out}/check").awaitTermination()
    empty = ledger_store.read_ledger(spark, f"{out}/none")
    streamed = site_run.RunTables(SHOP, catalog, arrivals.finish(SHOP, spark, f"{out}/pages", "arrived"), empty)
    batch = site_run.RunTables(SHOP, catalog, site_run.staged_pages(SHOP, catalog, fetched, "compare"), empty)
    for name in ("updates", "deletes", "statuses", "report"):
        a, b = getattr(streamed, name), getattr(batch, name)
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())), name
