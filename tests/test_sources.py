"""Readers, writers, tables and streams."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopsight.schemas import RAW_RETAIL, TABLES, to_canonical
from shopsight.sources import readers, tables, versions, writers
from shopsight.streaming import live


@pytest.fixture
def df(spark):
    return spark.createDataFrame([(1, "a", 1.5), (2, "b", float("nan")), (3, None, 2.5)], "id INT, t STRING, v DOUBLE")


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_round_trip(spark, df, tmp_path, fmt):
    path = writers.write_file(df.filter("id != 2"), f"{tmp_path}/out.{fmt}", fmt)
    back = readers.read_json(spark, path, lines=True) if fmt == "json" else readers.read_file(spark, path)
    assert back.count() == 2 and back.filter("t IS NULL").count() == 1


def test_nan_becomes_null(df):
    assert readers.nan_to_null(df).filter("v IS NULL").count() == 1


def test_json_array(spark, tmp_path):
    (tmp_path / "rows.json").write_text('[{"a": 1}, {"a": 2}]')
    assert readers.read_file(spark, str(tmp_path / "rows.json")).count() == 2


def test_bad_sources(spark, df, tmp_path):
    with pytest.raises(ValueError):
        readers.detect_format("x.xlsx")
    with pytest.raises(ValueError):
        writers.write_file(df, f"{tmp_path}/x", "xml")
    with pytest.raises(ValueError):
        readers.read_database(spark, "jdbc:x:y")
    (tmp_path / "empty.csv").write_text("a,b\n")
    with pytest.raises(ValueError):
        readers.read_csv(spark, str(tmp_path / "empty.csv"))
    with pytest.raises(Exception):
        readers.read_file(spark, f"{tmp_path}/absent.csv")


def test_raw_names(spark):
    raw = spark.createDataFrame([], RAW_RETAIL)
    assert {"customer_id", "amount", "purchase_date"} <= set(to_canonical(raw).columns)


def test_transaction_scan_includes_both_ends(spark):
    rows = [(1, dt.datetime(2024, 1, d)) for d in (1, 2, 3)]
    t = spark.createDataFrame(rows, "customer_id INT, purchase_date TIMESTAMP")
    assert readers.transactions(t, 1, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)).count() == 2
    assert readers.transactions(t).count() == 3 and readers.customers(t, 9).count() == 0


def test_filters_reach_the_files(spark, tmp_path):
    path = writers.write_file(spark.range(50).selectExpr("id", "id % 3 AS m", "id * 2 AS x"), f"{tmp_path}/p", "parquet", partition_by=("m",))
    plan = readers.read_parquet(spark, path).filter("m = 1 AND id > 40").select("id")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(m" in plan and "GreaterThan(id,40)" in plan and "ReadSchema: struct<id:bigint>" in plan


def test_update_leaves_null_conditions(spark):
    t = spark.createDataFrame([(1, 5), (2, None), (3, 50)], "id INT, v INT")
    got = {r["id"]: r["v"] for r in tables.update_where(t, {"v": 0}, "v > 10").collect()}
    assert got == {1: 5, 2: None, 3: 0}
    with pytest.raises(ValueError):
        tables.update_where(t, {"zzz": 0}, "true")


def test_tables_segments_and_predictions(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS shop LOCATION '{tmp_path}/shop'")
    assert len(tables.create_tables(spark, "shop")) == len(TABLES)
    assert tables.create_tables(spark, "shop") == []
    seg = spark.createDataFrame([(1, "c1", 2, "Loyal", "333")], "segment_id INT, customer_id STRING, segment_label INT, segment_name STRING, rfm_score STRING")
    for version in ("v1", "v2"):
        stamped = writers.stamp_segments(seg, version).select(*TABLES["customer_segments"].names)
        writers.append_table(stamped, "shop.customer_segments")
    got = spark.table("shop.customer_segments")
    assert {r["model_version"] for r in got.collect()} == {"v1", "v2"}
    info = {r["column"]: r["rows"] for r in tables.table_info(got).collect()}
    assert info["customer_id"] == 2
    pred = writers.stamp_predictions(spark.createDataFrame([("c1", 0.4)], "customer_id STRING, prediction_value DOUBLE"), "m", "churn", "v1")
    assert pred.first()["prediction_type"] == "churn"
    spark.sql("DROP DATABASE shop CASCADE")


def test_export_and_query(spark, df, tmp_path):
    path = writers.export_table(df, str(tmp_path), "t", "csv", dt.datetime(2024, 5, 6, 7, 8, 9))
    assert path.endswith("t_20240506_070809.csv")
    assert readers.query(spark, "SELECT count(*) AS n FROM {d} WHERE id >= :low", {"low": 2}, d=df).first()["n"] == 2


def test_metrics_row(spark):
    m = spark.createDataFrame([("a", "accuracy", 0.5)], "model STRING, metric STRING, value DOUBLE")
    cm = spark.createDataFrame([("a", 0, 1, 7)], "model STRING, label INT, prediction INT, n LONG")
    row = writers.metrics_row(m, cm).first()
    assert (row["accuracy"], row["confusion_matrix_0_1"]) == (0.5, 7.0)


# --- streams -------------------------------------------------------------------------

ORDER = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("order_id", T.LongType()),
        T.StructField("purchase_date", T.TimestampType()),
        T.StructField("amount", T.DoubleType()),
    ]
)


def test_repeated_batch_changes_nothing(spark, tmp_path):
    a = spark.createDataFrame([(1, 1, dt.datetime(2024, 1, 1), 10.0)], ORDER)
    b = spark.createDataFrame([(1, 2, dt.datetime(2024, 1, 5), 20.0), (2, 3, dt.datetime(2024, 1, 2), 5.0)], ORDER)
    folder = f"{tmp_path}/totals"
    live.merge_batch(a, 0, folder)
    live.merge_batch(b, 1, folder)
    live.merge_batch(b, 1, folder)
    got = {r["customer_id"]: (r["recency"], r["frequency"], r["monetary"]) for r in live.totals_to_rfm(live.current_totals(spark, folder)).collect()}
    assert got == {1: (1, 2, 30.0), 2: (4, 1, 5.0)}
    live.compact_totals(spark, folder, f"{tmp_path}/compact")
    assert live.current_totals(spark, f"{tmp_path}/compact").agg(F.sum("n")).first()[0] == 3


def test_many_batches_leave_few_parts(spark, tmp_path):
    folder, batches = f"{tmp_path}/totals", 14
    rows = [[(k % 3, k, dt.datetime(2024, 1, 1 + k), 10.0 + k), (7, 100 + k, dt.datetime(2024, 2, 1), 1.0)] for k in range(batches)]
    for k in range(batches):
        batch = spark.createDataFrame(rows[k], ORDER).coalesce(1)
        if k == 9:  # died after writing its part, before publishing it
            batch.write.parquet(f"{folder}/totals-0-9")
        live.merge_batch(batch, k, folder, fan=3, keep=2)
        if k in (8, 9):
            live.merge_batch(batch, k, folder, fan=3, keep=2)
        parts = versions.files_of(spark, folder)
        assert len(parts) <= 2 * 3
        assert len(list((tmp_path / "totals").glob("totals-*"))) <= 2 * len(parts) + 6
    assert versions.versions(spark, folder) == [batches - 1, batches]
    got = {r["customer_id"]: (r["n"], r["sum_amount"]) for r in live.current_totals(spark, folder).collect()}
    want = {c: (len(v), sum(v)) for c in range(3) for v in [[10 + k for k in range(batches) if k % 3 == c]]} | {7: (batches, batches)}
    assert {c: (n, float(v)) for c, (n, v) in got.items()} == want
    live.compact_totals(spark, folder, f"{tmp_path}/compact")
    live.merge_batch(batch, batches - 1, f"{tmp_path}/compact")  # already among the totals
    live.merge_batch(batch, batches, f"{tmp_path}/compact")
    assert live.current_totals(spark, f"{tmp_path}/compact").agg(F.sum("n")).first()[0] == 2 * batches + 2


def test_late_rows_are_dropped(spark, tmp_path):
    schema = T.StructType([T.StructField("ts", T.TimestampType()), T.StructField("value", T.DoubleType())])
    folder = tmp_path / "in"
    for i, ts in enumerate([dt.datetime(2024, 1, 10, 5), dt.datetime(2024, 1, 1, 5), dt.datetime(2024, 1, 20, 5)]):
        spark.createDataFrame([(ts, 1.0)], schema).coalesce(1).write.mode("append").parquet(str(folder))
        if i == 0:
            first = live.read_stream(spark, str(folder), schema)
            figures = live.live_key_figures(first, "ts", "value")

            def run():
                q = (
                    figures.writeStream.outputMode("append").format("parquet").option("checkpointLocation", f"{tmp_path}/cp")
                    .trigger(availableNow=True).start(f"{tmp_path}/out")
                )
                q.awaitTermination()

        run()
    got = [r["window_start"].day for r in spark.read.parquet(f"{tmp_path}/out").collect()]
    assert 1 not in got and 10 in got


def _stored(spark, tmp_path):
    path = str(tmp_path / "stored")
    df = spark.createDataFrame([(i, i // 10, "a") for i in range(40)], "id long, part long, s string")
    versions.create(df.repartitionByRange(4, "part"), path)
    return path


def test_update_rewrites_only_files_with_hits(spark, tmp_path):
    path = _stored(spark, tmp_path)
    before = versions.files_of(spark, path)
    old = versions.read(spark, path)
    done = versions.update(spark, path, {"s": "b"}, "part = 2 AND id % 2 = 0")
    after = versions.files_of(spark, path)
    assert (done.version, done.rewritten, done.untouched) == (2, 1, len(before) - 1)
    assert len(set(before) & set(after)) == len(before) - 1
    assert sorted(r["id"] for r in versions.read(spark, path).filter("s = 'b'").collect()) == [20, 22, 24, 26, 28]
    # the old version, and what was opened before, stay as they were
    assert old.filter("s = 'b'").count() == versions.read(spark, path, 1).filter("s = 'b'").count() == 0
    assert versions.read(spark, path).count() == 40 and versions.versions(spark, path) == [1, 2]


def test_update_without_hits_conflicts_and_errors(spark, tmp_path, monkeypatch):
    path = _stored(spark, tmp_path)
    assert versions.update(spark, path, {"s": "b"}, "id > 100").version == 1
    assert versions.update(spark, path, {"s": "b"}, "nullif(id, id) = 1").version == 1
    with pytest.raises(ValueError):
        versions.update(spark, path, {"nothing": 1}, "id = 1")
    with pytest.raises(ValueError):
        versions.create(spark.range(1), path)
    with pytest.raises(ValueError):
        versions.read(spark, path, 7)
    with pytest.raises(ValueError):
        versions.read(spark, str(tmp_path / "none"))
    # a second writer that started from version 1, too
    versions.update(spark, path, {"s": "b"}, "id = 1")
    files = versions.files_of(spark, path)
    monkeypatch.setattr(versions, "versions", lambda *_: [1])
    with pytest.raises(Exception):  # noqa: B017, PT011
        versions.update(spark, path, {"s": "c"}, "id = 30")
    monkeypatch.undo()
    assert versions.files_of(spark, path) == files and versions.read(spark, path).filter("s = 'c'").count() == 0
