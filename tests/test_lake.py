import os
import tempfile

from pyspark.sql import functions as F

from lakeledger.operators import export, reconcile
from lakeledger.plans import scenarios as S
from lakeledger.sources import lake

SF = "/root/testdata/sf0.001"


def test_export_roundtrip_incremental_and_edges(spark):
    root = tempfile.mkdtemp(prefix="lakeledger-test-lake-")
    src = S.SOURCES["orders"]
    orders = S.read_source(spark, SF, "orders")
    v = export.export_table(spark, orders, src, root)
    assert v.where(F.col("status") != "complete").count() == 0
    # round trip: the lake holds exactly the source rows
    back = lake.read_table(spark, root, "orders").drop(*lake.PARTITION_COLS)
    assert orders.exceptAll(back).count() == 0 and back.exceptAll(orders).count() == 0
    # second run skips everything
    v2 = export.export_table(spark, orders, src, root)
    assert v2.where(F.col("status") != "skipped").count() == 0
    # an object that nobody published is not a unit, nor is one of another name
    for name in ("x.parquet.tmp", "y.parquet"):
        unit = os.path.join(lake.attempt_path(root, "orders", "stray"), "unit_month=209901", "unit_server=srv-001")
        os.makedirs(unit, exist_ok=True)
        open(os.path.join(unit, name), "w").close()
    assert lake.lake_units(spark, root, ["orders"]).where(F.col("month") == "209901").count() == 0


def test_large_unit_is_split_by_rows_and_any_column_is_taken(spark):
    """12,000 equal rows of one unit, with a map column and columns named
    month and server; and rows without keys."""
    root = tempfile.mkdtemp(prefix="lakeledger-test-lake-")
    src = export.SourceTable("big", "k", "d")
    df = spark.range(12_000).select(
        F.when(F.col("id") >= 90, F.lit(1).cast("long")).alias("k"), F.lit("2024-01-05").cast("date").alias("d"),
        F.create_map(F.lit("a"), F.lit(1)).alias("m"), F.lit("x").alias("month"), F.lit("y").alias("server"))
    df = df.withColumn("d", F.when(F.col("k").isNull(), None).otherwise(F.col("d")))
    v = export.export_table(spark, df, src, root, rows_per_file=500).collect()
    assert {(r.month, r.server, r.n_lake, r.status) for r in v} == {
        ("202401", "srv-002", 11_910, "complete"), (export.NO_KEY, export.NO_KEY, 90, "complete")}
    attempts = lake.current_attempts(spark, root, "big")
    sizes = spark.read.parquet(*[lake.attempt_path(root, "big", a) for a in attempts]).groupBy(
        F.input_file_name()).count().agg(F.max("count"), F.count("*")).first()
    assert sizes[0] <= 500 and sizes[1] >= 24
    back = lake.read_table(spark, root, "big")
    assert back.count() == 12_000 and set(df.columns) <= set(back.columns)


def test_source_that_cannot_be_read_is_an_error_row(spark):
    folder = tempfile.mkdtemp(prefix="lakeledger-test-src-")
    orders = S.read_source(spark, SF, "orders")
    orders.write.mode("overwrite").parquet(folder + "/o")
    bad = spark.read.parquet(folder + "/o")
    for f in os.listdir(folder + "/o"):
        if f.endswith(".parquet"):
            with open(os.path.join(folder, "o", f), "wb") as out:
                out.write(b"not parquet at all")
    planned = export.source_counts(orders, S.SOURCES["orders"])
    got = export.safe_source_counts(spark, bad, S.SOURCES["orders"], planned)
    assert got.where("local_status <> 'ERROR' or n_local is not null").count() == 0 and got.count() == planned.count()
    units = reconcile.reconcile_units(got, planned.withColumnRenamed("n_local", "n_lake"))
    assert reconcile.reconcile_at(units, ["table_name"]).first().verdict == "ERROR"


def test_planned_unit_absent_on_both_sides_has_a_row(spark):
    keys = "table_name string, month string, server string"
    local = spark.createDataFrame([("t", "202401", "a", 5)], keys + ", n_local long")
    held = spark.createDataFrame([("t", "202401", "a", 5), ("t", "202401", "z", 1)], keys + ", n_lake long")
    plan = spark.createDataFrame([("t", "202401", "a"), ("t", "202401", "b")], keys)
    got = {r.server: r for r in reconcile.reconcile_units(local, held, plan).collect()}
    assert got["b"].lake_status == "NO_FILES" and got["b"].local_status == "NO_ROWS" and got["b"].unit_status == "OK"
    assert got["z"].unit_status == "UNEXPECTED" and got["a"].unit_status == "OK"


def test_only_the_table_is_listed(spark):
    root = tempfile.mkdtemp(prefix="lakeledger-test-lake-")
    for name in ("one", "two"):
        df = S.read_source(spark, SF, "orders").limit(20)
        export.write_and_publish(spark, df, export.SourceTable(name, "o_orderkey", "o_orderdate"), root)
    found = lake.files(spark, root, "one", lake.current_attempts(spark, root, "one"))
    assert found.where(~F.col("path").contains("/one/attempt=")).count() == 0
    assert all("/one/" in f for f in found.inputFiles())


def test_absent_vs_empty_units(spark):
    root = tempfile.mkdtemp(prefix="lakeledger-test-lake-")
    S.build_lake(spark, SF, root, ["lineitem"], export_fault=True, drift=True)
    local = S.local_counts(spark, SF, ["lineitem"])
    units = reconcile.reconcile_units(local, lake.lake_units(spark, root, ["lineitem"]))
    by = {r.server: r for r in reconcile.reconcile_at(units, ["table_name", "server"]).collect()}
    assert by["srv-003"].lake_status == "NO_FILES" and by["srv-003"].verdict == "ERROR"
    assert by["srv-009"].n_lake == 0 and by["srv-009"].lake_status == "OK"
    assert by["srv-007"].diff == by["srv-007"].n_local
    assert by["srv-001"].verdict == "OK"
    assert by["srv-005"].diff <= 0
    assert lake.read_table(spark, root, "missing_table") is None


def test_states_of_files(spark):
    """Truncated, footer zeroed behind an intact tail, whole but without rows,
    gone, and one of two files damaged."""
    import glob

    import pyarrow.parquet as pq
    root = tempfile.mkdtemp(prefix="lakeledger-test-lake-")
    src = S.SOURCES["orders"]
    orders = S.read_source(spark, SF, "orders")
    export.write_and_publish(spark, orders, src, root)
    before = {(r.month, r.server): r.n_lake for r in lake.lake_units(spark, root, ["orders"]).collect()}
    names = sorted(glob.glob(lake.table_path(root, "orders") + "/attempt=*/unit_month=*/unit_server=*/*.parquet"))
    unit = lambda f: tuple(p.split("=")[1] for p in f.split("/")[-3:-1])
    cut, zeroed, empty, gone, half = names[0], names[7], names[11], names[17], names[23]
    data = open(cut, "rb").read()
    open(cut, "wb").write(data[:len(data) // 2])
    data = open(zeroed, "rb").read()
    size = int.from_bytes(data[-8:-4], "little")
    open(zeroed, "wb").write(data[:-8 - size] + bytes(size) + data[-8:])
    pq.write_table(pq.read_table(empty, partitioning=None).slice(0, 0), empty)
    os.remove(gone)
    pq.write_table(pq.read_table(half, partitioning=None), half.replace(".parquet", "-more.parquet"))
    data = open(half, "rb").read()
    open(half, "wb").write(data[:-4])
    for f in (cut, zeroed, empty, gone, half):  # local checksums do not know of the damage
        crc = os.path.join(os.path.dirname(f), "." + os.path.basename(f) + ".crc")
        if os.path.exists(crc):
            os.remove(crc)
    after = {(r.month, r.server): (r.n_lake, r.lake_status) for r in lake.lake_units(spark, root, ["orders"]).collect()}
    want = {k: (n, "OK") for k, n in before.items()} | {unit(cut): (None, "ERROR"), unit(zeroed): (None, "ERROR"),
                                                        unit(empty): (0, "OK"), unit(gone): (None, "NO_FILES"),
                                                        unit(half): (None, "ERROR")}
    assert after == want
    lake.FEW_UNITS, few = 1, lake.FEW_UNITS
    try:
        again = {(r.month, r.server): (r.n_lake, r.lake_status) for r in lake.lake_units(spark, root, ["orders"]).collect()}
    finally:
        lake.FEW_UNITS = few
    assert again == want
