"""

Every query reads the given tables or data that Spark derives from them. Where an operator works on
folders, files or archives, these are first written from the tables to the scratch folder.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from datetime import datetime

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapvault import fixtures
from snapvault.functions.files import file_type, format_size
from snapvault.functions.naming import snapshot_name, snapshot_time
from snapvault.lakehouse import Lakehouse
from snapvault.operators import archive as archive_ops
from snapvault.operators.audit import (
    cleanup_documents,
    log_events,
    log_table,
    read_cleanup_logs,
    read_logs,
    read_manifests,
)
from snapvault.operators.filecopy import copy_files, delete_paths, files_as_table, write_files
from snapvault.operators.items import file_items, items_frame, sidecars
from snapvault.operators.restore import restore
from snapvault.operators.retention import retain, snapshot_catalogue
from snapvault.operators.snapshot import Source, snapshot, snapshot_many
from snapvault.operators.tables import copy_table, copy_tables, profile_tables, store_table
from snapvault.operators.verify import verify_content, verify_copied_files, verify_snapshot
from snapvault.plans import restore as restore_plans
from snapvault.plans import retention as retention_plans
from snapvault.plans import summary
from snapvault.plans import verify as verify_plans
from snapvault.session import configure, scratch_dir, settled
from snapvault.sources import archives as archive_sources
from snapvault.sources.hadoop import Folders
from snapvault.sources.inventory import binary_file_inventory, file_inventory, folder_sizes, only_files, walk
from snapvault.sources.tables import discover_tables, scan_table

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

AS_OF = datetime(1998, 6, 1, 12)
TREE_AS_OF = datetime(2025, 2, 20)
TAKEN_AT = datetime(2025, 11, 10, 14, 30, 15)
EXTENSIONS = [".jpg", ".PDF", ".txt", ".xlsx", ".csv", ".json", ".zip", ".py", ".mp4", ".mp3", ".foo", "", ".tar.gz"]
PATTERNS = ["src1*.csv", "*/doc_?.txt", "src[2-4]/*.[!jpPz]*"]


def _session(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return configure(spark)


def _path(sf_dir: str, table: str) -> str:
    return f"{sf_dir}/{table}.parquet"


def _table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return scan_table(_session(spark), _path(sf_dir, table))


# --- derived inputs -------------------------------------------------------------------------------


def _snapshots(spark, sf_dir):
    """A catalogue of snapshots, one per order: with a time, without one, and with an impossible one."""
    key, stamp = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd_HH-mm-ss")
    name = (
        F.when(key % 11 == 0, F.concat(F.lit("scratch_"), key))
        .when(key % 13 == 0, F.lit("Gold_finance_prd_backup_2001-02-30_00-00-00"))
        .when(key % 7 == 0, F.concat(F.lit("Gold_finance_prd_backup_"), stamp))
        .otherwise(F.concat(F.lit("silver1_transform_dev_backup_"), stamp))
    )
    size = F.floor("o_totalprice").cast("bigint") * 1024 + key
    columns = (key.alias("snap_no"), name.alias("name"), size.alias("size_bytes"))
    build = lambda: settled(_table(spark, sf_dir, "orders").select(*columns), "snapshots")
    return _once(spark, sf_dir, "snapshots", build)


def _plan(spark, sf_dir):
    return retention_plans.retention_plan(_snapshots(spark, sf_dir), AS_OF, 30, " SILVER1_ ")


def _documents(spark, sf_dir):
    """One file per document, spread over folders by source and language."""
    names = F.array(*[F.lit(e) for e in EXTENSIONS])
    extension = F.get(names, (F.col("doc_id") % len(EXTENSIONS)).cast("int"))
    docs = _table(spark, sf_dir, "documents").withColumn("name", F.concat(F.lit("doc_"), "doc_id", extension))
    return docs.withColumn("relative_path", F.concat_ws("/", "source", "lang", "name"))


def _files(spark, sf_dir):
    return _documents(spark, sf_dir).select(
        "doc_id",
        "relative_path",
        "name",
        F.col("n_chars").alias("size"),
        F.lit(False).alias("is_directory"),
        file_type(F.col("name")).alias("type"),
        F.lit(None).cast("string").alias("error"),
    )


def _present_files(spark, sf_dir):
    """The files a target already has: those of labelled documents, toxic ones with another size."""
    labels = _table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return _files(spark, sf_dir).join(labels, "doc_id").withColumn("size", F.col("size") + F.col("toxic"))


def _items(spark, sf_dir):
    """Item records of many runs, one record per order; a run is a month."""
    status = F.when(F.col("o_orderstatus") == "F", "success").when(F.col("o_orderstatus") == "O", "failed")
    return _table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM").alias("run"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "table").otherwise("file").alias("kind"),
        F.col("o_orderkey").cast("string").alias("name"),
        status.otherwise("skipped").alias("status"),
        F.col("o_custkey").alias("row_count"),
        F.lit(6).alias("column_count"),
        F.floor("o_totalprice").cast("bigint").alias("size_bytes"),
    )


def _supplier_profiles(spark, sf_dir):
    """Row counts per supplier, of all lines and of those not returned."""
    lines = _table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("string").alias("name"), "l_returnflag")
    count = F.count(F.lit(1)).alias("row_count")
    kept = lines.where("l_returnflag <> 'R' OR name = '1'")
    return lines.groupBy("name").agg(count), kept.groupBy("name").agg(count)


_built: dict = {}


def _once(spark, sf_dir, what, build):
    """Folders that several queries only read are written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, what)
    if key not in _built:
        _built[key] = build()
    return _built[key]


def _make_room(spark, sf_dir, what):
    """Delete a lake that the steps to come do not read, its folders side by side; a query that needs it again has it written again."""
    lake = _built.pop((spark.sparkContext.applicationId, sf_dir, what), None)
    if lake is not None:
        folder = F.expr("left(relative_path, length(relative_path) - length(name) - 1)")
        held = only_files(walk(spark, lake.files)).select(folder.alias("relative_path")).distinct()
        delete_paths(spark, held, lake.files, directories=True)
        Folders(spark).delete(lake.root)


def _write_documents(spark, sf_dir, root, path):
    rows = _documents(spark, sf_dir).select(path.alias("relative_path"), F.encode("text", "UTF-8").alias("content"))
    return write_files(spark, rows, root)


LAKE_TABLES = ("customer", "orders", "lineitem")


def _lake(spark, sf_dir) -> Lakehouse:
    def build():
        lake = Lakehouse(scratch_dir(_session(spark), "lake"))
        copy_tables(spark, {t: _path(sf_dir, t) for t in LAKE_TABLES}, lake.tables)
        _write_documents(spark, sf_dir, lake.files, F.col("relative_path"))
        return lake

    return _once(spark, sf_dir, "lake", build)


def _lake_snapshot(spark, sf_dir):
    def build():
        source = Source(_lake(spark, sf_dir), "lh_silver1", "wsp_transform_dev")
        return snapshot(spark, source, scratch_dir(spark, "backups"), TAKEN_AT)

    return _once(spark, sf_dir, "snapshot", build)


def _restored(spark, sf_dir):
    """A second restore that must leave alone what the first one has put there.

    The lake goes first: beside the snapshot and its copy at the target it would be a third copy of everything.
    """

    def build():
        path, target = _lake_snapshot(spark, sf_dir).path, Lakehouse(scratch_dir(spark, "target"))
        _make_room(spark, sf_dir, "lake")
        restore(spark, path, target, table_names=["customer"], file_patterns=["src1/*"], verify=None)
        return restore(spark, path, target, overwrite=False)

    return _once(spark, sf_dir, "restored", build)


def _backup_root(spark, sf_dir):
    """Real snapshot folders written from the documents, with hidden content that counts."""
    root = scratch_dir(_session(spark), "backup_root")
    day = F.date_format(F.date_add(F.lit("2025-01-01").cast("date"), (F.col("doc_id") % 60).cast("int")), "yyyy-MM-dd")
    name = F.concat("source", F.lit("_backup_"), day, F.lit("_06-00-00"))
    inside = F.when(F.col("lang") == "en", F.lit("_manifest")).otherwise(F.lit("files"))
    _write_documents(spark, sf_dir, root, F.concat_ws("/", name, inside, "name"))
    return root


def _file_archives(spark, sf_dir):
    docs = _documents(spark, sf_dir).select(
        F.concat(F.lit("doc_"), "doc_id", F.lit(".zip")).alias("archive"),
        "relative_path",
        F.encode("text", "UTF-8").alias("content"),
        F.col("source").alias("backup_type"),
    )
    return fixtures.file_archives(docs)


def _archive_entries(spark, sf_dir):
    def build():
        root, archives = archive_ops.store_binary_archives(spark, _file_archives(spark, sf_dir))
        return root, archive_ops.scan_archives(spark, root, archives)

    return _once(spark, sf_dir, "archives", build)


# --- queries --------------------------------------------------------------------------------------


def q_table_snapshot(spark, sf_dir):
    out = scratch_dir(_session(spark), "snapshot")
    copy_table(spark, "lineitem", _path(sf_dir, "lineitem"), out)
    return scan_table(spark, out)


def _through_restore(spark, sf_dir, table):
    base = scratch_dir(_session(spark), "roundtrip")
    source = Source(Lakehouse(f"{base}/lake"), "lh_silver1", "wsp_transform_dev")
    taken = snapshot(spark, source, f"{base}/backups", TAKEN_AT, table_paths={table: _path(sf_dir, table)})
    target = Lakehouse(f"{base}/target")
    restore(spark, taken.path, target)
    return scan_table(spark, f"{target.tables}/{table}")


def q_table_restore(spark, sf_dir):
    return _through_restore(spark, sf_dir, "orders")


def q_table_restore_nested(spark, sf_dir):
    return _through_restore(spark, sf_dir, "embeddings")


def _round_trip(table):
    return lambda spark, sf_dir: _through_restore(spark, sf_dir, table)


ROUND_TRIPS = [t for t in TABLES if t not in ("orders", "embeddings")]


def q_restore_damaged(spark, sf_dir):
    """A snapshot that has lost rows since it was taken must leave the table at the target as it is."""
    base = scratch_dir(_session(spark), "damage")
    source = Source(Lakehouse(f"{base}/lake"), "lh_silver1", "wsp_transform_dev")
    taken = snapshot(spark, source, f"{base}/backups", TAKEN_AT, table_paths={"orders": _path(sf_dir, "orders")})
    target = Lakehouse(f"{base}/target")
    copy_table(spark, "orders", _path(sf_dir, "orders"), f"{target.tables}/orders")
    _table(spark, sf_dir, "orders").where("o_orderkey % 4 <> 0").write.mode("overwrite").parquet(f"{taken.path}/tables/orders")
    run = restore(spark, taken.path, target)
    kept = scan_table(spark, f"{target.tables}/orders").agg(F.count("*").cast("string"))
    told = (("kept_rows", kept), ("item", run.items.select("status")), ("run", run.manifest.select("status")))
    rows = [df.select(F.lit(what).alias("what"), F.col(df.columns[0]).alias("value")) for what, df in told]
    return rows[0].union(rows[1]).union(rows[2])


def q_table_discovery(spark, sf_dir):
    prefix = F.when(F.col("o_orderstatus") == "P", "_tmp_").otherwise("cust_")
    path = F.concat(F.lit("/lake/Tables/"), prefix, "o_custkey", F.lit("/part-"), "o_orderkey", F.lit(".parquet"))
    return discover_tables(_table(spark, sf_dir, "orders").select(path.alias("path")), "/lake/Tables")


def q_table_profile(spark, sf_dir):
    profiles = profile_tables(_session(spark), {t: _path(sf_dir, t) for t in TABLES})
    return profiles.select("name", "row_count", "column_count")


def q_snapshot_status(spark, sf_dir):
    paths = {t: _path(sf_dir, t) for t in ("customer", "lineitem", "orders", "no_such_table")}
    records = copy_tables(_session(spark), paths, scratch_dir(spark, "status"))
    return items_frame(spark, records).select("name", "status", "row_count")


def q_snapshot_sidecar(spark, sf_dir):
    document = "table_name string, row_count bigint, columns array<string>, backup_method string"
    cards = sidecars(_lake_snapshot(spark, sf_dir).items)
    parsed = cards.select(F.from_json("metadata_json", document).alias("d")).select("d.*")
    return parsed.select("table_name", "row_count", F.array_join("columns", ",").alias("columns"), "backup_method")


def q_snapshot_run(spark, sf_dir):
    return _lake_snapshot(spark, sf_dir).items.select("kind", "name", "status", "row_count", "size_bytes")


def q_snapshot_many(spark, sf_dir):
    lake = _lake(spark, sf_dir)
    sources = [
        Source(lake, "lh_silver1", "wsp_transform_dev"),
        Source(lake, "lh_silver1", " "),
        Source(lake, "Gold_Lakehouse", "WSP_Finance_Workspace"),
    ]
    rows = snapshot_many(spark, sources, scratch_dir(spark, "many"), at=TAKEN_AT)
    name = F.substring_index("snapshot", "/", -1).alias("snapshot")
    return summary.run_summary(rows.withColumn("snapshot", name), "snapshot")


def q_run_summary(spark, sf_dir):
    return summary.run_summary(_items(spark, sf_dir), "run")


def q_manifest(spark, sf_dir):
    return summary.snapshot_counts(_items(spark, sf_dir), "run")


def q_manifest_catalogue(spark, sf_dir):
    root = _lake_snapshot(spark, sf_dir).path.rsplit("/", 1)[0]
    names = "backup_folder_name tables_backed_up files_backed_up files_failed total_rows total_size status".split()
    return read_manifests(spark, root).select(*names, "verification_passed")


def q_snapshot_name(spark, sf_dir):
    customer, nation = _table(spark, sf_dir, "customer"), _table(spark, sf_dir, "nation")
    lake = F.concat(F.lit("LH_"), "c_mktsegment", F.lit("_Lakehouse_lh_"), "c_custkey")
    workspace = F.concat(F.lit("wsp_"), "n_name", F.lit("_Workspace"))
    at = F.lit(TAKEN_AT.isoformat(sep=" ")).cast("timestamp_ntz")
    rows = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.select("c_custkey", snapshot_name(lake, workspace, at).alias("name"))


def q_restore_plan(spark, sf_dir):
    part = _table(spark, sf_dir, "part").select(F.concat(F.lit("tbl_"), "p_partkey").alias("name"), "p_size")
    return restore_plans.restore_plan(part.select("name"), part.where("p_size <= 20"), overwrite=False)


def q_restore_selective(spark, sf_dir):
    target = Lakehouse(scratch_dir(_session(spark), "selective"))
    names = ["orders", "customer", "not_there"]
    run = restore(spark, _lake_snapshot(spark, sf_dir).path, target, files=False, table_names=names)
    return run.items.select("name", "row_count")


def q_restore_status(spark, sf_dir):
    return _restored(spark, sf_dir).items.select("kind", "name", "status", "row_count", "size_bytes")


RESTORE_COUNTS = (
    "tables_restored tables_failed tables_skipped files_restored files_failed files_skipped total_size status"
).split()


def q_restore_manifest(spark, sf_dir):
    return _restored(spark, sf_dir).manifest.select(*RESTORE_COUNTS, "verification_passed")


def q_layout_detect(spark, sf_dir):
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    path = (
        F.when((flag == "R") & (status == "F"), F.concat(F.lit("tables/t"), "l_partkey", F.lit("/part-0.parquet")))
        .when((flag == "R") & (F.col("l_linenumber") % 2 == 1), F.lit("tables/readme.txt"))
        .when(flag == "R", F.lit("tables/_tmp/part-0.parquet"))
        .when((flag == "A") & (status == "F"), F.concat(F.lit("old_"), "l_partkey", F.lit(".zip")))
        .when(flag == "A", F.lit("files_backup_zip_data/part-0.parquet"))
        .when(status == "F", F.lit("_manifest/part-0.parquet"))
        .otherwise(F.concat(F.lit("files/a"), "l_partkey", F.lit(".zip")))
    )
    rows = _table(spark, sf_dir, "lineitem").select("l_orderkey", path.alias("relative_path"))
    return restore_plans.detect_layout(rows, F.concat(F.lit("snap_"), "l_orderkey"))


def q_verify_counts(spark, sf_dir):
    return verify_plans.verify_counts(*_supplier_profiles(spark, sf_dir))


def q_verify_verdict(spark, sf_dir):
    files = verify_plans.verify_files(_files(spark, sf_dir), _present_files(spark, sf_dir))
    return verify_plans.verdict(q_verify_counts(spark, sf_dir), files)


def _damaged(spark, sf_dir):
    """A copy of lineitem in which every returned line has another tax."""

    def build():
        out = scratch_dir(_session(spark), "damaged")
        tax = F.when(F.col("l_returnflag") == "R", F.col("l_tax") + 1).otherwise(F.col("l_tax"))
        _table(spark, sf_dir, "lineitem").withColumn("l_tax", tax).write.parquet(out)
        return out

    return _once(spark, sf_dir, "damaged", build)


def q_verify_content(spark, sf_dir):
    pair = {"lineitem": (_path(sf_dir, "lineitem"), _damaged(spark, sf_dir))}
    return verify_content(spark, pair, exact=True).select("name", "data_matches", "missing_rows", "extra_rows")


def q_verify_content_screened(spark, sf_dir):
    """One order of all has other taxes, and the last one is gone: only rows of their hash buckets meet."""
    lines, out = _table(spark, sf_dir, "lineitem"), scratch_dir(spark, "one_damaged")
    tax = F.when(F.col("l_orderkey") == 1, F.col("l_tax") + 1).otherwise(F.col("l_tax"))
    last = lines.agg(F.max("l_orderkey")).head()[0]
    lines.where(F.col("l_orderkey") < last).withColumn("l_tax", tax).write.parquet(out)
    pairs = {
        "damaged": (_path(sf_dir, "lineitem"), out),
        "intact": (_path(sf_dir, "lineitem"), f"{_lake_snapshot(spark, sf_dir).path}/tables/lineitem"),
    }
    checks = verify_content(spark, pairs, exact=True, screen=True)
    return checks.select("name", "data_matches", "expected_rows", "actual_rows", "missing_rows", "extra_rows")


def q_verify_checksum(spark, sf_dir):
    pairs = {
        "damaged": (_path(sf_dir, "lineitem"), _damaged(spark, sf_dir)),
        "intact": (_path(sf_dir, "lineitem"), f"{_lake_snapshot(spark, sf_dir).path}/tables/lineitem"),
    }
    return verify_content(spark, pairs).select("name", "data_matches", "expected_rows", "actual_rows")


def q_verify_snapshot(spark, sf_dir):
    tables, _ = verify_snapshot(spark, _lake_snapshot(spark, sf_dir).path, content=True)
    return tables.drop("error")


def q_verify_files(spark, sf_dir):
    return verify_plans.verify_files(_files(spark, sf_dir), _present_files(spark, sf_dir))


def q_verify_files_content(spark, sf_dir):
    """Copies of which some are then changed without a change of size, and some are lost."""
    root = _lake(spark, sf_dir).files
    target = scratch_dir(spark, "content_target")
    status = copy_files(spark, only_files(walk(spark, root)), root, target)
    items = file_items(status, root, target, "file_copy", TAKEN_AT)
    docs = _documents(spark, sf_dir)
    altered = F.concat(F.unhex(F.lit("01")), F.substring(F.encode("text", "UTF-8"), 2, 1 << 30))
    write_files(spark, docs.where("doc_id % 10 = 3 AND text <> ''").select("relative_path", altered.alias("content")), target)
    delete_paths(spark, docs.where("doc_id % 10 = 4"), target, directories=False)
    checks = verify_copied_files(spark, items, target, content=True)
    return checks.select("relative_path", "file_exists", "size_matches", "content_matches")


def q_table_commit_pointer(spark, sf_dir):
    """A table of versions: rows that are not those expected change nothing, and who reads an older version can finish."""
    path, steps = f"{scratch_dir(_session(spark), 'versioned')}/orders", []
    orders = _table(spark, sf_dir, "orders")

    def told(step):
        rows = scan_table(spark, path).agg(F.count("*").alias("row_count"), F.sum("o_orderkey").alias("key_sum"))
        steps.append(rows.select(F.lit(step).alias("step"), "row_count", "key_sum"))

    first = {"row_count": orders.count()}
    for step, rows, expected in (("first", orders, first), ("refused", orders.where("o_orderkey % 2 = 0"), first), ("second", orders.where("o_orderstatus = 'F'"), None)):
        store_table(spark, "orders", rows, path, overwrite=True, expected=expected, commit="pointer")
        told(step)
    return steps[0].union(steps[1]).union(steps[2])


def q_file_inventory(spark, sf_dir):
    root = _lake(spark, sf_dir).files
    return file_inventory(spark, root).select("name", "relative_path", "is_directory", "size", "type")


def q_binary_file_scan(spark, sf_dir):
    return binary_file_inventory(spark, _lake(spark, sf_dir).files).select("name", "relative_path", "size", "type")


def q_files_as_table(spark, sf_dir):
    """With parts so small that most documents take several rows."""
    files = _lake(spark, sf_dir).files
    table = files_as_table(spark, files, scratch_dir(spark, "as_table"), TAKEN_AT, part_bytes=1000)
    return table.select(
        "original_path", "file_name", "file_type", F.col("part").cast("bigint").alias("part"), "offset", "size_bytes",
        F.md5("content").alias("content_md5"),
    )


def q_file_copy_status(spark, sf_dir):
    root = _lake(spark, sf_dir).files
    status = copy_files(spark, only_files(walk(spark, root)), root, scratch_dir(spark, "copy_target"))
    return status.select("relative_path", "status", "written_bytes")


def q_file_type(spark, sf_dir):
    return _files(spark, sf_dir).select("relative_path", "type")


def q_file_totals(spark, sf_dir):
    return summary.file_totals(_files(spark, sf_dir))


def q_file_type_summary(spark, sf_dir):
    return summary.file_type_summary(_files(spark, sf_dir))


def q_file_restore_plan(spark, sf_dir):
    files = _files(spark, sf_dir).select("relative_path", "size")
    return restore_plans.files_to_restore(files, _present_files(spark, sf_dir), overwrite=False)


def q_file_glob_select(spark, sf_dir):
    return restore_plans.select_files(_files(spark, sf_dir).select("relative_path"), PATTERNS)


def q_size_format(spark, sf_dir):
    return _snapshots(spark, sf_dir).select("snap_no", format_size(F.col("size_bytes")).alias("size_text"))


def q_snapshot_time(spark, sf_dir):
    return _snapshots(spark, sf_dir).select("snap_no", "name", snapshot_time(F.col("name")).alias("ts"))


def q_snapshot_age(spark, sf_dir):
    return _plan(spark, sf_dir).select("snap_no", "age_days", "is_expired")


def q_snapshot_match(spark, sf_dir):
    return _plan(spark, sf_dir).select("snap_no", "matches_pattern")


def q_folder_size(spark, sf_dir):
    return folder_sizes(_files(spark, sf_dir)).select("name", "size_bytes")


def q_snapshot_catalogue(spark, sf_dir):
    root = _once(spark, sf_dir, "backup_root", lambda: _backup_root(spark, sf_dir))
    aged = retention_plans.with_age(snapshot_catalogue(spark, root), TREE_AS_OF)
    return aged.select("name", "ts", "age_days", "size_bytes", "is_expired")


def q_retention_plan(spark, sf_dir):
    return _plan(spark, sf_dir).select("snap_no", "name", "age_days", "action")


def q_retention_summary(spark, sf_dir):
    return retention_plans.retention_summary(_plan(spark, sf_dir))


def q_retention_delete_list(spark, sf_dir):
    """With the place of each snapshot in the list, which the list's order gives."""
    listed = retention_plans.delete_list(_plan(spark, sf_dir), "snap_no").select("snap_no", "name", "ts", "size_bytes")
    at = F.monotonically_increasing_id()  # grows with the order of a sorted result
    ranked = settled(listed.withColumn("at", at), "delete-list")
    earlier = ranked.groupBy(F.shiftright("at", 33).alias("p")).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1))
    parts = earlier.withColumn("before", F.coalesce(before, F.lit(0)))
    inside = F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    joined = ranked.withColumn("p", F.shiftright("at", 33)).join(parts, "p")
    return joined.select("snap_no", "name", "ts", "size_bytes", (F.col("before") + inside).alias("place"))


def q_retention_keep_top10(spark, sf_dir):
    return retention_plans.keep_list(_plan(spark, sf_dir), 10, "snap_no").select("snap_no", "name", "ts")


def q_retention_result(spark, sf_dir):
    return retention_plans.retention_result(_plan(spark, sf_dir))


def q_retention_apply(spark, sf_dir):
    run = retain(spark, _backup_root(spark, sf_dir), TREE_AS_OF, 30, "src1", dry_run=False)
    return run.deletions.select("name", "status", "size_bytes")


def q_snapshot_as_of(spark, sf_dir):
    return retention_plans.newest_as_of(_snapshots(spark, sf_dir), AS_OF)


def _logs(spark, sf_dir):
    kind = F.col("event_type")
    level = (
        F.when(kind == "error", "ERROR").when(kind == "signup", "WARNING").when(kind == "view", "DEBUG").otherwise("INFO")
    )
    return _table(spark, sf_dir, "events"), F.col("ts"), level, F.col("props")


def q_log_table(spark, sf_dir):
    return log_table(*_logs(spark, sf_dir))


def q_log_rollup(spark, sf_dir):
    return summary.log_rollup(log_events(*_logs(spark, sf_dir)))


def q_run_logs(spark, sf_dir):
    """All lines; the folders, which have random names, are masked."""
    root = _lake_snapshot(spark, sf_dir).path.rsplit("/", 1)[0]
    masked = F.regexp_replace("message", r"snapshot of .* to .*/", "snapshot of <source> to <root>/")
    return read_logs(spark, root).select("run", "level", masked.alias("message"))


def q_cleanup_log(spark, sf_dir):
    kind, at = F.col("event_type"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    first = F.struct(at.alias("timestamp"), F.lit("INFO").alias("level"), kind.alias("message"))
    level = F.when(kind == "error", "ERROR").otherwise("SUCCESS")
    second = F.struct(at.alias("timestamp"), level.alias("level"), F.col("props").alias("message"))
    parameters = F.struct(
        F.lit("/backups").alias("backup_root"),
        F.col("user_id").cast("int").alias("retention_days"),
        (kind == "view").alias("dry_run"),
        kind.alias("name_pattern"),
    )
    runs = _table(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("cleanup_timestamp"),
        parameters.alias("parameters"),
        F.array(first, second).alias("log_entries"),
    )
    out = scratch_dir(spark, "cleanup_logs")
    cleanup_documents(runs).write.text(out)
    return read_cleanup_logs(spark, out)


ENTRY_COLUMNS = ["archive", "entry", "kind", "file_name", "relative_path", "file_type", "size"]


def q_archive_entries(spark, sf_dir):
    return _archive_entries(spark, sf_dir)[1].select(*ENTRY_COLUMNS)


def q_archive_entries_binary(spark, sf_dir):
    return archive_sources.archive_entries_binary(_file_archives(spark, sf_dir)).select(*ENTRY_COLUMNS)


def q_archive_metadata(spark, sf_dir):
    root, entries = _archive_entries(spark, sf_dir)
    documents = archive_sources.archive_metadata(entries, root)
    return documents.select("archive", "backup_type", "tables_backed_up", "files_backed_up")


def q_archive_format_choice(spark, sf_dir):
    choice = restore_plans.archive_format("auto", F.col("p_size") % 3 == 0, F.col("p_size") % 2 == 0)
    return _table(spark, sf_dir, "part").select("p_partkey", choice.alias("restore_format"))


def _table_through_archives(spark, sf_dir, table, fmt):
    archives = fixtures.table_archives(_table(spark, sf_dir, table), table, fmt)
    # The archives get random names, so they are settled before anything is read from them.
    held = scratch_dir(spark, "held")
    archives.write.parquet(held)
    root, names = archive_ops.store_binary_archives(spark, scan_table(spark, held))
    entries, target = archive_ops.scan_archives(spark, root, names), scratch_dir(spark, "from_archives")
    archive_ops.restore_tables(spark, entries, root, target)
    return scan_table(spark, f"{target}/{table}")


def q_archive_table_restore(spark, sf_dir):
    return _table_through_archives(spark, sf_dir, "orders", "parquet")


def q_archive_table_restore_csv(spark, sf_dir):
    return _table_through_archives(spark, sf_dir, "customer", "csv")


def q_archive_table_restore_csv_breaks(spark, sf_dir):
    return _table_through_archives(spark, sf_dir, "documents", "csv")


def q_archive_file_restore(spark, sf_dir):
    return _files_through_archives(spark, sf_dir, None)


def q_archive_file_select(spark, sf_dir):
    return _files_through_archives(spark, sf_dir, ["src1*"])


def _files_through_archives(spark, sf_dir, patterns):
    root, entries = _archive_entries(spark, sf_dir)
    target = scratch_dir(spark, "unpacked")
    items = archive_ops.restore_files(spark, entries, root, target, patterns=patterns)
    back = files_as_table(spark, target, scratch_dir(spark, "unpacked_rows"), TAKEN_AT)
    back = back.select(F.col("original_path").alias("name"), F.md5("content").alias("content_md5"))
    return items.select("name", "status", "size_bytes").join(back, "name", "left")


def entry(spark: SparkSession) -> DataFrame:
    """Snapshot ``lineitem``, restore it, and check the restored rows against the source."""
    sf_dir = "/root/testdata/sf0.001"
    base = scratch_dir(_session(spark), "entry")
    source = Source(Lakehouse(f"{base}/lake"), "lh_silver1", "wsp_transform_dev")
    taken = snapshot(spark, source, f"{base}/backups", TAKEN_AT, table_paths={"lineitem": _path(sf_dir, "lineitem")})
    target = Lakehouse(f"{base}/target")
    restore(spark, taken.path, target)
    pair = {"lineitem": (_path(sf_dir, "lineitem"), f"{target.tables}/lineitem")}
    return verify_content(spark, pair, exact=True)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return core_queries() | _training_text()[0]


def core_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = {name[2:]: f for name, f in globals().items() if name.startswith("q_")}
    return named | {f"table_restore_{t}": _round_trip(t) for t in ROUND_TRIPS}


def _training_text() -> tuple[dict, dict]:
    """Queries and SQL of the operators for training text, if they are there."""
    try:
        import corpus_pipeline
        from snapvault.llm import queries as llm
    except ImportError as error:
        if error.name not in ("corpus_pipeline", "snapvault.llm"):
            raise
        return {}, {}
    sql = llm.SQL | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
    return llm.QUERIES | {"pipeline": corpus_pipeline.run}, sql


# --- the same in SQL ------------------------------------------------------------------------------

_SNAP = """snap AS (
SELECT o_orderkey AS snap_no,
       CASE WHEN o_orderkey % 11 = 0 THEN 'scratch_' || o_orderkey
            WHEN o_orderkey % 13 = 0 THEN 'Gold_finance_prd_backup_2001-02-30_00-00-00'
            WHEN o_orderkey % 7 = 0 THEN 'Gold_finance_prd_backup_' || strftime(o_orderdate, '%Y-%m-%d_%H-%M-%S')
            ELSE 'silver1_transform_dev_backup_' || strftime(o_orderdate, '%Y-%m-%d_%H-%M-%S') END AS name,
       CAST(floor(o_totalprice) AS BIGINT) * 1024 + o_orderkey AS size_bytes
FROM orders)"""
_SNAP_T = (
    _SNAP
    + """, snap_t AS (
SELECT *, CAST(floor(epoch(TIMESTAMP '1998-06-01 12:00:00' - ts) / 86400) AS BIGINT) AS age_days,
       contains(lower(name), lower(trim(' SILVER1_ '))) AS matches_pattern
FROM (SELECT *, try_strptime(nullif(regexp_extract(name, '(\\d{4}-\\d{2}-\\d{2}_\\d{2}-\\d{2}-\\d{2})$', 1), ''),
             '%Y-%m-%d_%H-%M-%S') AS ts FROM snap))"""
)
_SNAP_P = (
    _SNAP_T
    + """, snap_p AS (
SELECT *, CASE WHEN ts IS NULL THEN 'invalid' WHEN NOT matches_pattern THEN 'retain'
               WHEN age_days > 30 THEN 'delete' ELSE 'retain' END AS action
FROM snap_t)"""
)
_TYPE = """CASE WHEN NOT contains(name, '.') THEN 'unknown' ELSE coalesce(
   map {'jpg':'image','pdf':'document','txt':'text','xlsx':'spreadsheet','csv':'data','json':'data',
        'zip':'archive','gz':'archive','py':'code','mp4':'video','mp3':'audio'}[lower(string_split(name, '.')[-1])],
   'other') END"""
_FILES = f"""doc AS (
SELECT *, 'doc_' || doc_id || (['.jpg','.PDF','.txt','.xlsx','.csv','.json','.zip','.py','.mp4','.mp3','.foo','',
       '.tar.gz'])[1 + doc_id % 13] AS name FROM documents),
ffile AS (
SELECT doc_id, source, lang, text, source || '/' || lang || '/' || name AS relative_path, name, n_chars AS size,
       CAST(strlen(text) AS BIGINT) AS bytes, {_TYPE} AS type FROM doc),
present AS (
SELECT f.relative_path, f.size + l.toxic AS target_size FROM ffile f JOIN labels l ON f.doc_id = l.doc_id)"""
_LAKE_COUNTS = """lake AS (SELECT 'customer' AS name, count(*) AS row_count FROM customer
UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem)"""
_RUNS = """item AS (
SELECT strftime(o_orderdate, '%Y-%m') AS run, CASE WHEN o_orderpriority = '1-URGENT' THEN 'table' ELSE 'file' END AS kind,
  CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'failed' ELSE 'skipped' END AS status,
  o_custkey AS row_count, CAST(floor(o_totalprice) AS BIGINT) AS size_bytes FROM orders)"""
_BY_SUPPLIER = """v AS (
SELECT CAST(l_suppkey AS VARCHAR) AS name, count(*) AS expected_rows,
  nullif(count(*) FILTER (WHERE l_returnflag <> 'R' OR l_suppkey = 1), 0) AS actual_rows FROM lineitem GROUP BY 1),
checked AS (SELECT name, actual_rows IS NOT NULL AS verified, coalesce(expected_rows = actual_rows, false) AS data_matches,
  expected_rows, actual_rows FROM v)"""
_CHECKED_FILES = """fcheck AS (
SELECT s.relative_path, p.relative_path IS NOT NULL AS file_exists, coalesce(s.size = p.target_size, false) AS size_matches,
  CASE WHEN p.relative_path IS NOT NULL THEN 'file_copy' END AS restore_method
FROM ffile s LEFT JOIN present p ON s.relative_path = p.relative_path)"""
_TREE = """tree AS (
SELECT source || '_backup_' || strftime(DATE '2025-01-01' + CAST(doc_id % 60 AS INTEGER), '%Y-%m-%d') || '_06-00-00' AS name,
  (DATE '2025-01-01' + CAST(doc_id % 60 AS INTEGER)) + INTERVAL 6 HOUR AS ts, CAST(sum(strlen(text)) AS BIGINT) AS size_bytes
FROM documents GROUP BY 1, 2),
aged AS (SELECT name, ts, CAST(floor(epoch(TIMESTAMP '2025-02-20 00:00:00' - ts) / 86400) AS BIGINT) AS age_days, size_bytes FROM tree)"""
_LEVEL = "CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARNING' ELSE 'INFO' END"
_LAYOUT = """inv AS (
SELECT 'snap_' || l_orderkey AS snapshot,
  CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'tables/t' || l_partkey || '/part-0.parquet'
       WHEN l_returnflag = 'R' AND l_linenumber % 2 = 1 THEN 'tables/readme.txt'
       WHEN l_returnflag = 'R' THEN 'tables/_tmp/part-0.parquet'
       WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'old_' || l_partkey || '.zip'
       WHEN l_returnflag = 'A' THEN 'files_backup_zip_data/part-0.parquet'
       WHEN l_linestatus = 'F' THEN '_manifest/part-0.parquet'
       ELSE 'files/a' || l_partkey || '.zip' END AS p FROM lineitem),
flags AS (
SELECT snapshot, bool_or(regexp_matches(p, '^tables/[^_/][^/]*/.')) AS has_tables,
  bool_or(NOT contains(p, '/') AND ends_with(p, '.zip')) AS has_zip_file,
  bool_or(split_part(p, '/', 1) IN ('complete_backup_zip_data','files_backup_zip_data','lakehouse_complete_backup_zip_data')
    AND contains(p, '/')) AS has_zip_data,
  bool_or(starts_with(p, '_manifest/')) AS has_manifest FROM inv GROUP BY snapshot)"""
_ENTRIES = f"""SELECT 'doc_' || doc_id || '.zip' AS archive, 'files/' || relative_path AS entry, 'file' AS kind, name AS file_name,
  relative_path, type AS file_type, bytes AS size FROM ffile
UNION ALL SELECT 'doc_' || doc_id || '.zip', '_backup_info/metadata.json', 'metadata', 'metadata.json', NULL, NULL,
  CAST(strlen('{{"backup_type": "' || source || '", "files_backed_up": 1, "tables_backed_up": 0}}') AS BIGINT) FROM ffile"""
_MANY = """SELECT '{0}_backup_2025-11-10_14-30-15' AS snapshot, 'table' AS kind, CAST(3 AS BIGINT) AS succeeded,
  CAST(0 AS BIGINT) AS failed, CAST(0 AS BIGINT) AS skipped
UNION ALL SELECT '{0}_backup_2025-11-10_14-30-15', 'file', count(*), 0, 0 FROM documents"""


def oracle_sql() -> dict[str, str]:
    return core_sql() | _training_text()[1]


def core_sql() -> dict[str, str]:
    profile = " UNION ALL ".join(
        f"SELECT '{t}' AS name, count(*) AS row_count, (SELECT count(*) FROM (DESCRIBE {t})) AS column_count FROM {t}"
        for t in TABLES
    )
    return {
        "table_snapshot": "SELECT * FROM lineitem",
        "table_restore": "SELECT * FROM orders",
        "table_restore_nested": "SELECT * FROM embeddings",
        **{f"table_restore_{t}": f"SELECT * FROM {t}" for t in ROUND_TRIPS},
        "restore_damaged": """SELECT 'kept_rows' AS what, CAST(count(*) AS VARCHAR) AS value FROM orders
UNION ALL SELECT 'item', 'failed' UNION ALL SELECT 'run', 'failed'""",
        "table_discovery": "SELECT DISTINCT 'cust_' || o_custkey AS name FROM orders WHERE o_orderstatus <> 'P'",
        "table_profile": profile,
        "snapshot_status": """SELECT 'customer' AS name, 'success' AS status, count(*) AS row_count FROM customer
UNION ALL SELECT 'orders', 'success', count(*) FROM orders UNION ALL SELECT 'lineitem', 'success', count(*) FROM lineitem
UNION ALL SELECT 'no_such_table', 'failed', NULL""",
        "snapshot_sidecar": f"""WITH {_FILES}, {_LAKE_COUNTS}, cols AS (
SELECT table_name, string_agg(column_name, ',' ORDER BY column_index) AS columns FROM duckdb_columns()
WHERE table_name IN ('customer', 'orders', 'lineitem') GROUP BY 1)
SELECT name AS table_name, row_count, columns, 'read_write' AS backup_method FROM lake JOIN cols ON table_name = name
UNION ALL SELECT relative_path, NULL, NULL, 'file_copy' FROM ffile""",
        "snapshot_run": f"""WITH {_FILES}, {_LAKE_COUNTS}
SELECT 'table' AS kind, name, 'success' AS status, row_count, CAST(NULL AS BIGINT) AS size_bytes FROM lake
UNION ALL SELECT 'file', relative_path, 'success', NULL, bytes FROM ffile""",
        "snapshot_many": _MANY.format("silver1_transform_dev")
        + " UNION ALL SELECT NULL, 'run', 0, 1, 0 UNION ALL "
        + _MANY.format("gold_finance"),
        "run_summary": f"""WITH {_RUNS} SELECT run, kind, count(*) FILTER (WHERE status = 'success') AS succeeded,
  count(*) FILTER (WHERE status = 'failed') AS failed, count(*) FILTER (WHERE status = 'skipped') AS skipped
FROM item GROUP BY run, kind""",
        "manifest": f"""WITH {_RUNS}, c AS (
SELECT run, count(*) FILTER (WHERE kind = 'table') AS tables_discovered, count(*) FILTER (WHERE kind = 'file') AS files_discovered,
  count(*) FILTER (WHERE kind = 'table' AND status = 'success') AS tables_backed_up,
  count(*) FILTER (WHERE kind = 'table' AND status = 'failed') AS tables_failed,
  count(*) FILTER (WHERE kind = 'file' AND status = 'success') AS files_backed_up,
  count(*) FILTER (WHERE kind = 'file' AND status = 'failed') AS files_failed,
  CAST(coalesce(sum(row_count) FILTER (WHERE kind = 'table' AND status = 'success'), 0) AS BIGINT) AS total_rows,
  CAST(coalesce(sum(size_bytes) FILTER (WHERE kind = 'file'), 0) AS BIGINT) AS total_size FROM item GROUP BY run)
SELECT *, CASE WHEN tables_backed_up + files_backed_up = 0 AND tables_failed + files_failed = 0 THEN 'empty'
  WHEN tables_failed + files_failed = 0 THEN 'success' WHEN tables_backed_up + files_backed_up = 0 THEN 'failed'
  ELSE 'partial' END AS status FROM c""",
        "manifest_catalogue": f"""WITH {_FILES}, {_LAKE_COUNTS}
SELECT 'silver1_transform_dev_backup_2025-11-10_14-30-15' AS backup_folder_name, CAST(3 AS BIGINT) AS tables_backed_up,
  count(*) AS files_backed_up, CAST(0 AS BIGINT) AS files_failed,
  (SELECT CAST(sum(row_count) AS BIGINT) FROM lake) AS total_rows, CAST(sum(bytes) AS BIGINT) AS total_size,
  'success' AS status, true AS verification_passed FROM ffile""",
        "snapshot_name": """SELECT c_custkey,
  replace(replace(lower('LH_' || c_mktsegment || '_Lakehouse_lh_' || c_custkey), 'lh_', ''), '_lakehouse', '') || '_' ||
  replace(replace(lower('wsp_' || n_name || '_Workspace'), 'wsp_', ''), '_workspace', '') || '_backup_2025-11-10_14-30-15' AS name
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
        "restore_plan": """SELECT 'tbl_' || p_partkey AS name, CASE WHEN p_size <= 20 THEN 'skip' ELSE 'restore' END AS action
FROM part""",
        "restore_selective": f"WITH {_LAKE_COUNTS} SELECT name, row_count FROM lake WHERE name IN ('orders', 'customer')",
        "restore_status": f"""WITH {_FILES}, {_LAKE_COUNTS}
SELECT 'table' AS kind, name, CASE WHEN name = 'customer' THEN 'skipped' ELSE 'success' END AS status,
  CASE WHEN name <> 'customer' THEN row_count END AS row_count, CAST(NULL AS BIGINT) AS size_bytes FROM lake
UNION ALL SELECT 'file', relative_path, CASE WHEN source = 'src1' THEN 'skipped' ELSE 'success' END, NULL, bytes FROM ffile""",
        "restore_manifest": f"""WITH {_FILES} SELECT CAST(2 AS BIGINT) AS tables_restored, CAST(0 AS BIGINT) AS tables_failed,
  CAST(1 AS BIGINT) AS tables_skipped, count(*) FILTER (WHERE source <> 'src1') AS files_restored,
  CAST(0 AS BIGINT) AS files_failed, count(*) FILTER (WHERE source = 'src1') AS files_skipped,
  CAST(coalesce(sum(bytes) FILTER (WHERE source <> 'src1'), 0) AS BIGINT) AS total_size, 'success' AS status,
  true AS verification_passed FROM ffile""",
        "layout_detect": f"""WITH {_LAYOUT} SELECT *, CASE WHEN has_tables THEN 'direct_copy' WHEN has_zip_file THEN 'zip_file'
  WHEN has_zip_data THEN 'zip_in_table' ELSE 'unknown' END AS layout FROM flags""",
        "verify_counts": f"WITH {_BY_SUPPLIER} SELECT * FROM checked",
        "verify_verdict": f"""WITH {_FILES}, {_BY_SUPPLIER}, {_CHECKED_FILES}, t AS (
SELECT count(*) FILTER (WHERE verified) AS tables_verified, count(*) FILTER (WHERE data_matches) AS tables_matching,
  bool_and(verified AND data_matches) AS ok FROM checked), f AS (
SELECT count(*) AS files_verified, count(*) FILTER (WHERE file_exists AND size_matches) AS files_matching,
  bool_and(file_exists AND size_matches) AS ok FROM fcheck)
SELECT tables_verified, tables_matching, files_verified, files_matching, t.ok AND f.ok AS overall_success FROM t, f""",
        "verify_content": """SELECT 'lineitem' AS name, count(*) FILTER (WHERE l_returnflag = 'R') = 0 AS data_matches,
  count(*) FILTER (WHERE l_returnflag = 'R') AS missing_rows, count(*) FILTER (WHERE l_returnflag = 'R') AS extra_rows
FROM lineitem""",
        "verify_content_screened": """WITH l AS (SELECT *, max(l_orderkey) OVER () AS last FROM lineitem)
SELECT 'damaged' AS name, false AS data_matches, count(*) AS expected_rows, count(*) FILTER (WHERE l_orderkey < last) AS actual_rows,
  count(*) FILTER (WHERE l_orderkey IN (1, last)) AS missing_rows, count(*) FILTER (WHERE l_orderkey = 1) AS extra_rows FROM l
UNION ALL SELECT 'intact', true, count(*), count(*), 0, 0 FROM l""",
        "verify_checksum": """SELECT 'damaged' AS name, count(*) FILTER (WHERE l_returnflag = 'R') = 0 AS data_matches,
  count(*) AS expected_rows, count(*) AS actual_rows FROM lineitem
UNION ALL SELECT 'intact', true, count(*), count(*) FROM lineitem""",
        "verify_snapshot": f"""WITH {_LAKE_COUNTS} SELECT name, true AS verified, true AS data_matches,
  row_count AS expected_rows, row_count AS actual_rows FROM lake""",
        "verify_files": f"WITH {_FILES}, {_CHECKED_FILES} SELECT * FROM fcheck",
        "verify_files_content": f"""WITH {_FILES} SELECT relative_path, doc_id % 10 <> 4 AS file_exists, doc_id % 10 <> 4 AS size_matches,
  CASE WHEN doc_id % 10 <> 4 THEN doc_id % 10 <> 3 OR bytes = 0 END AS content_matches FROM ffile""",
        "table_commit_pointer": """SELECT 'first' AS step, count(*) AS row_count, CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM orders
UNION ALL SELECT 'refused', count(*), CAST(sum(o_orderkey) AS BIGINT) FROM orders
UNION ALL SELECT 'second', count(*), CAST(sum(o_orderkey) AS BIGINT) FROM orders WHERE o_orderstatus = 'F'""",
        "file_inventory": f"""WITH {_FILES}
SELECT name, relative_path, false AS is_directory, bytes AS size, type FROM ffile
UNION ALL SELECT DISTINCT source, source, true, 0, 'directory' FROM ffile
UNION ALL SELECT DISTINCT lang, source || '/' || lang, true, 0, 'directory' FROM ffile""",
        "binary_file_scan": f"WITH {_FILES} SELECT name, relative_path, bytes AS size, type FROM ffile",
        "files_as_table": f"""WITH {_FILES}, piece AS (
SELECT *, unnest(range(greatest(1, (bytes + 999) // 1000))) AS part FROM ffile)
SELECT relative_path AS original_path, name AS file_name, type AS file_type, CAST(part AS BIGINT) AS part,
  CAST(part * 1000 AS BIGINT) AS "offset", CAST(least(1000, bytes - part * 1000) AS BIGINT) AS size_bytes,
  md5(unhex(substr(hex(encode(text)), CAST(part * 2000 + 1 AS BIGINT), 2000))) AS content_md5 FROM piece""",
        "file_copy_status": f"""WITH {_FILES} SELECT relative_path, 'success' AS status, bytes AS written_bytes FROM ffile""",
        "file_type": f"WITH {_FILES} SELECT relative_path, type FROM ffile",
        "file_totals": f"WITH {_FILES} SELECT count(*) AS total_files, CAST(sum(size) AS BIGINT) AS total_size FROM ffile",
        "file_type_summary": f"""WITH {_FILES} SELECT type, count(*) AS n_files, CAST(sum(size) AS BIGINT) AS size FROM ffile
GROUP BY type""",
        "file_restore_plan": f"""WITH {_FILES} SELECT relative_path, size FROM ffile s
WHERE NOT EXISTS (SELECT 1 FROM present t WHERE t.relative_path = s.relative_path)""",
        "file_glob_select": f"""WITH {_FILES} SELECT relative_path FROM ffile
WHERE regexp_full_match(relative_path, 'src1.*\\.csv') OR regexp_full_match(relative_path, '.*/doc_.\\.txt')
  OR regexp_full_match(relative_path, 'src[2-4]/.*\\.[^jpPz].*')""",
        "size_format": f"""WITH {_SNAP} SELECT snap_no, CASE WHEN size_bytes < 1024 THEN printf('%.2f B', size_bytes / 1.0::DOUBLE)
  WHEN size_bytes < 1048576 THEN printf('%.2f KB', size_bytes / 1024.0::DOUBLE)
  WHEN size_bytes < 1073741824 THEN printf('%.2f MB', size_bytes / 1048576.0::DOUBLE)
  ELSE printf('%.2f GB', size_bytes / 1073741824.0::DOUBLE) END AS size_text FROM snap""",
        "snapshot_time": f"WITH {_SNAP_T} SELECT snap_no, name, ts FROM snap_t",
        "snapshot_age": f"WITH {_SNAP_T} SELECT snap_no, age_days, coalesce(age_days > 30, false) AS is_expired FROM snap_t",
        "snapshot_match": f"WITH {_SNAP_T} SELECT snap_no, matches_pattern FROM snap_t",
        "folder_size": "SELECT source AS name, CAST(sum(n_chars) AS BIGINT) AS size_bytes FROM documents GROUP BY source",
        "snapshot_catalogue": f"""WITH {_TREE} SELECT name, ts, age_days, size_bytes, age_days > 30 AS is_expired FROM aged""",
        "retention_plan": f"WITH {_SNAP_P} SELECT snap_no, name, age_days, action FROM snap_p",
        "retention_summary": f"""WITH {_SNAP_P} SELECT count(*) AS total_backups, count(*) FILTER (WHERE ts IS NOT NULL) AS valid_backups,
  count(*) FILTER (WHERE ts IS NULL) AS invalid_backups,
  count(*) FILTER (WHERE ts IS NOT NULL AND matches_pattern) AS pattern_matched,
  count(*) FILTER (WHERE action = 'delete') AS expired_backups, count(*) FILTER (WHERE action = 'retain') AS retained_backups,
  CAST(coalesce(sum(size_bytes) FILTER (WHERE action = 'delete'), 0) AS BIGINT) AS total_size_to_delete,
  CAST(coalesce(sum(size_bytes) FILTER (WHERE action = 'retain'), 0) AS BIGINT) AS total_size_to_retain FROM snap_p""",
        "retention_delete_list": f"""WITH {_SNAP_P} SELECT snap_no, name, ts, size_bytes,
  row_number() OVER (ORDER BY ts, name, snap_no) AS place FROM snap_p WHERE action = 'delete'""",
        "retention_keep_top10": f"""WITH {_SNAP_P} SELECT snap_no, name, ts FROM snap_p WHERE action = 'retain'
ORDER BY ts DESC, snap_no LIMIT 10""",
        "retention_result": f"""WITH {_SNAP_P} SELECT 'success' AS status, true AS dry_run, count(*) AS total_backups,
  count(*) FILTER (WHERE action = 'delete') AS expired_backups, CAST(0 AS BIGINT) AS deleted_backups,
  CAST(0 AS BIGINT) AS space_freed_bytes, CAST(0 AS BIGINT) AS failed_deletions FROM snap_p""",
        "retention_apply": f"""WITH {_TREE} SELECT name, 'success' AS status, size_bytes FROM aged
WHERE age_days > 30 AND contains(name, 'src1')""",
        "snapshot_as_of": f"""WITH {_SNAP_T} SELECT split_part(name, '_backup_', 1) AS source, arg_max(name, ts) AS name, max(ts) AS ts
FROM snap_t WHERE ts <= TIMESTAMP '1998-06-01 12:00:00' GROUP BY 1""",
        "log_table": f"""SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp, {_LEVEL} AS level, props AS message
FROM events WHERE event_type <> 'view'""",
        "log_rollup": f"""SELECT CAST(ts AS DATE) AS day, {_LEVEL} AS level, count(*) AS n FROM events
WHERE event_type <> 'view' GROUP BY 1, 2""",
        "run_logs": f"""WITH {_LAKE_COUNTS} SELECT 'silver1_transform_dev_backup_2025-11-10_14-30-15' AS run, 'INFO' AS level,
  'table ' || name || ': success ' || row_count AS message FROM lake
UNION ALL SELECT 'silver1_transform_dev_backup_2025-11-10_14-30-15', 'INFO', unnest(['snapshot of <source> to <root>/'
  || 'silver1_transform_dev_backup_2025-11-10_14-30-15', 'verification by counts: passed'])""",
        "cleanup_log": """WITH e AS (SELECT *, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS cleanup_timestamp,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS logged FROM events)
SELECT cleanup_timestamp, CAST(user_id AS INTEGER) AS retention_days, event_type = 'view' AS dry_run, event_type AS name_pattern,
  logged AS timestamp, 'INFO' AS level, event_type AS message FROM e
UNION ALL SELECT cleanup_timestamp, CAST(user_id AS INTEGER), event_type = 'view', event_type, logged,
  CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'SUCCESS' END, props FROM e""",
        "archive_entries": f"WITH {_FILES} {_ENTRIES}",
        "archive_entries_binary": f"WITH {_FILES} {_ENTRIES}",
        "archive_metadata": """SELECT 'doc_' || doc_id || '.zip' AS archive, source AS backup_type,
  CAST(0 AS BIGINT) AS tables_backed_up, CAST(1 AS BIGINT) AS files_backed_up FROM documents""",
        "archive_format_choice": """SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'parquet' WHEN p_size % 2 = 0 THEN 'csv'
  ELSE 'none' END AS restore_format FROM part""",
        "archive_table_restore": "SELECT * FROM orders",
        "archive_table_restore_csv": "SELECT * FROM customer",
        "archive_table_restore_csv_breaks": "SELECT * FROM documents",
        "archive_file_restore": f"""WITH {_FILES} SELECT relative_path AS name, 'success' AS status, bytes AS size_bytes,
  md5(text) AS content_md5 FROM ffile""",
        "archive_file_select": f"""WITH {_FILES} SELECT relative_path AS name, 'success' AS status, bytes AS size_bytes,
  md5(text) AS content_md5 FROM ffile WHERE starts_with(relative_path, 'src1')""",
    }
