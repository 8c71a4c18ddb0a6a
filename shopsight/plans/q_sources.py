"""Reader, writer, table and streaming queries.

Files go to a fresh folder under the session's checkpoint folder.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopsight.operators import labels as Y
from shopsight.operators import metrics as M
from shopsight.operators import models as ML
from shopsight.operators import rfm as R
from shopsight.plans.catalogue import query, rnd, sql_rnd
from shopsight.plans.q_lifecycle import SQL_PRED
from shopsight.plans.q_models import binary
from shopsight.plans.q_rfm import base
from shopsight.plans.retail import SQL_ORD, SQL_RFM_BASE, orders_view, table
from shopsight.schemas import TABLES
from shopsight.session import ensure_checkpoint_dir, materialize
from shopsight.sources import readers, tables, versions, writers
from shopsight.streaming import live


def scratch(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/shopsight-{name}-{uuid.uuid4().hex}"


_CUSTOMER = T.StructType(
    [
        T.StructField("c_custkey", T.LongType()),
        T.StructField("c_name", T.StringType()),
        T.StructField("c_nationkey", T.IntegerType()),
        T.StructField("c_acctbal", T.DoubleType()),
        T.StructField("c_mktsegment", T.StringType()),
    ]
)
SQL_CUSTOMER = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


def _round_trip(name: str, format: str, read) -> None:
    @query(name, SQL_CUSTOMER)
    def round_trip(spark, sf):
        path = writers.write_file(table(spark, sf, "customer"), scratch(spark, name) + f".{format}", format)
        return read(spark, path)


_round_trip("a01_csv_scan", "csv", lambda s, p: readers.read_csv(s, p, _CUSTOMER))
_round_trip("a02_json_scan", "json", lambda s, p: readers.read_json(s, p, _CUSTOMER, lines=True))
_round_trip("a03_parquet_scan", "parquet", readers.read_parquet)
_round_trip("a05_format_by_suffix", "parquet", readers.read_file)


@query("a06_ingest_description", """SELECT * FROM (VALUES ('c_custkey', 'bigint', 0), ('c_name', 'string', 1), ('c_nationkey', 'int', 2), ('c_acctbal', 'double', 3), ('c_mktsegment', 'string', 4)) v("column", data_type, position), (SELECT count(*) AS rows FROM customer)""")
def a06(spark, sf):
    return readers.ingest(spark, f"{sf}/customer.parquet")[1]


@query("a07_partitioned_file_sink", "SELECT o_orderstatus, count(*) AS orders FROM orders WHERE o_orderstatus = 'P' GROUP BY 1")
def a07(spark, sf):
    path = writers.write_file(
        table(spark, sf, "orders"), scratch(spark, "orders"), "parquet", partition_by=("o_orderstatus",)
    )
    kept = readers.read_parquet(spark, path).filter("o_orderstatus = 'P'")
    return kept.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))


@query(
    "a08_append_rows",
    "SELECT o_orderpriority, count(*) * 2 AS rows FROM orders GROUP BY 1",
)
def a08(spark, sf):
    path = scratch(spark, "append")
    for _ in range(2):
        writers.write_file(table(spark, sf, "orders"), path, "parquet", mode="append")
    return readers.read_parquet(spark, path).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "a09_segment_sink",
    f"WITH {SQL_ORD}, {SQL_RFM_BASE} SELECT customer_id, frequency, 'v1' AS model_version, true AS is_stamped FROM rfm",
)
def a09(spark, sf):
    path = scratch(spark, "segments")
    stamped = writers.stamp_segments(base(spark, sf).select("customer_id", "frequency"), "v1")
    writers.write_file(stamped, path, "parquet", mode="append")
    out = readers.read_parquet(spark, path)
    return out.select("customer_id", "frequency", "model_version", F.col("created_date").isNotNull().alias("is_stamped"))


@query(
    "a10_prediction_sink",
    f"""{SQL_PRED} SELECT customer_id, {sql_rnd('round(probability, 3)', 3)} AS prediction_probability, 'rule' AS model_name, 'churn' AS prediction_type, 'v1' AS model_version FROM pred""",
)
def a10(spark, sf):
    path = scratch(spark, "predictions")
    scored = binary(spark, sf).select("customer_id", F.col("score").alias("prediction_probability"))
    writers.write_file(writers.stamp_predictions(scored, "rule", "churn", "v1"), path, "parquet", mode="append")
    out = readers.read_parquet(spark, path)
    return out.select("customer_id", rnd("prediction_probability", 3), "model_name", "prediction_type", "model_version")


@query(
    "a11_parameterised_sql",
    f"SELECT o_orderstatus AS status, count(*) AS orders, {sql_rnd('sum(o_totalprice)', 2)} AS revenue FROM orders WHERE o_totalprice >= 250000 GROUP BY 1",
)
def a11(spark, sf):
    out = readers.query(
        spark,
        "SELECT o_orderstatus AS status, count(*) AS orders, sum(o_totalprice) AS revenue FROM {orders} WHERE o_totalprice >= :floor GROUP BY 1",
        {"floor": 250000.0},
        orders=table(spark, sf, "orders"),
    )
    return out.select("status", "orders", rnd("revenue", 2))


@query("a12_customer_lookup", f"{SQL_CUSTOMER} WHERE c_custkey = (SELECT max(o_custkey) FROM orders)")
def a12(spark, sf):
    wanted = table(spark, sf, "orders").agg(F.max("o_custkey")).first()[0]
    return readers.customers(table(spark, sf, "customer"), wanted, "c_custkey")


@query(
    "a13_transaction_scan",
    f"""WITH {SQL_ORD} SELECT order_id, customer_id, amount FROM ord WHERE purchase_date BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1998-06-30'""",
)
def a13(spark, sf):
    out = readers.transactions(orders_view(spark, sf), start=dt.datetime(1998, 1, 1), end=dt.datetime(1998, 6, 30))
    return out.select("order_id", "customer_id", "amount")


@query(
    "a14_conditional_update",
    """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'REVIEW' ELSE c_mktsegment END AS c_mktsegment,
    CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS c_acctbal FROM customer""",
)
def a14(spark, sf):
    out = tables.update_where(table(spark, sf, "customer"), {"c_mktsegment": "REVIEW", "c_acctbal": 0}, "c_acctbal < 0")
    return out.select("c_custkey", "c_mktsegment", "c_acctbal")


@query(
    "a14_update_of_a_stored_table",
    """SELECT c_nationkey, count(*) AS rows, count(*) FILTER (c_nationkey < 4 AND c_acctbal < 0) AS reviewed, 0::BIGINT AS reviewed_before,
    count(*) FILTER (c_acctbal < 0 AND c_nationkey >= 4) AS negative, TRUE AS untouched_files_stay FROM customer GROUP BY 1""",
)
def a14_stored(spark, sf):
    """Customers by nation, updated in place: what readers of either version see, and that other files stay."""
    path = scratch(spark, "customers")
    rows = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal", F.lit("OPEN").alias("state"))
    versions.create(rows.repartitionByRange(8, "c_nationkey"), path)
    done = versions.update(spark, path, {"state": "REVIEW", "c_acctbal": 0}, "c_nationkey < 4 AND c_acctbal < 0")
    before, after = (set(versions.files_of(spark, path, v)) for v in (1, done.version))
    stay = len(before & after) == done.untouched and done.rewritten == len(before - after) and 0 < done.rewritten < len(before)
    old = versions.read(spark, path, 1).groupBy("c_nationkey").agg(F.count_if(F.col("state") == "REVIEW").alias("reviewed_before"))
    new = versions.read(spark, path).groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("state") == "REVIEW").alias("reviewed"),
        F.count_if(F.col("c_acctbal") < 0).alias("negative"),
    )
    return new.join(old, "c_nationkey").select(
        "c_nationkey", "rows", "reviewed", "reviewed_before", "negative", F.lit(stay).alias("untouched_files_stay")
    )


@query(
    "a15_declared_tables",
    """SELECT 'customers' AS "table", 7 AS columns, count(*) AS rows FROM customer UNION ALL SELECT 'transactions', 9, count(*) FROM orders
    UNION ALL SELECT 'customer_segments', 7, 0 UNION ALL SELECT 'model_predictions', 8, 0""",
)
def a15(spark, sf):
    """The four declared tables, two of them filled, as the session's catalogue describes them."""
    database = f"shopsight_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {database}")
    created = tables.create_tables(spark, database, scratch(spark, "tables"))
    people = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("customer_id"))
    bought = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("transaction_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_totalprice").alias("purchase_amount"),
    )
    for name, rows in (("customers", people), ("transactions", bought)):
        full = [F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in TABLES[name]]
        writers.append_table(rows.select(*full), f"{database}.{name}")
    out = None
    for name in created:
        declared = spark.table(name)
        row = declared.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name.rpartition(".")[2]).alias("table"), F.lit(len(declared.columns)).alias("columns"), "rows"
        )
        out = row if out is None else out.unionByName(row)
    out = materialize(out)
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return out


@query(
    "a16_table_info",
    """SELECT * FROM (VALUES ('n_nationkey', 'int'), ('n_name', 'string'), ('n_regionkey', 'int')) v("column", data_type), (SELECT count(*) AS rows FROM nation)""",
)
def a16(spark, sf):
    return tables.table_info(table(spark, sf, "nation")).drop("nullable")


@query(
    "a17_result_bundle",
    f"WITH {SQL_ORD}, {SQL_RFM_BASE} SELECT customer_id, recency, frequency, monetary FROM rfm",
)
def a17(spark, sf):
    path = writers.save_bundle(scratch(spark, "bundle"), {"rfm": base(spark, sf), "orders": orders_view(spark, sf)})
    return readers.read_parquet(spark, f"{path}/tables/rfm")


def _churn_model(spark, sf):
    data, feats = ML.prepare(Y.churn_label(base(spark, sf)), "customer_id", "label", ["recency", "frequency", "monetary"])
    model, metrics = ML.train(data, "customer_id", feats, "logistic_regression", "classification")
    return data, feats, model, metrics


@query("a18_model_save_and_load")
def a18(spark, sf):
    data, feats, model, metrics = _churn_model(spark, sf)
    path = writers.save_model(model, scratch(spark, "model"), metrics, feats)
    loaded = writers.load_model(path)
    old = ML.score(model, data, "customer_id", "classification").withColumnRenamed("probability", "before").drop("prediction")
    new = ML.score(loaded, data, "customer_id", "classification")
    return new.join(old, "customer_id").select("customer_id", "prediction", (F.col("before") == F.col("probability")).alias("is_same"))


@query(
    "a19_metrics_row",
    f"""{SQL_PRED}, c AS (SELECT churned AS label, CASE WHEN round(probability, 3) >= 0.5 THEN 1 ELSE 0 END AS p FROM pred)
    SELECT 'rule' AS model, {sql_rnd('count(*) FILTER (label = p) / count(*)', 8)} AS accuracy, count(*) FILTER (label = 0 AND p = 0)::DOUBLE AS confusion_matrix_0_0,
    count(*) FILTER (label = 1 AND p = 0)::DOUBLE AS confusion_matrix_1_0 FROM c""",
)
def a19(spark, sf):
    df = binary(spark, sf).withColumn("prediction", (F.col("score") >= 0.5).cast("int"))
    metrics = M.classification_metrics(df).withColumn("model", F.lit("rule"))
    cm = M.confusion(df).withColumn("model", F.lit("rule"))
    path = writers.save_metrics(metrics, scratch(spark, "metrics"), "csv", cm)
    out = readers.read_csv(spark, path)
    return out.select(
        "model", rnd("accuracy", 8), F.col("confusion_matrix_0_0").cast("double"), F.col("confusion_matrix_1_0").cast("double")
    )


@query("a20_timestamped_export", "SELECT o_orderstatus, count(*) AS orders FROM orders WHERE o_totalprice > 100000 GROUP BY 1")
def a20(spark, sf):
    kept = table(spark, sf, "orders").filter("o_totalprice > 100000").select("o_orderkey", "o_orderstatus", "o_orderdate")
    path = writers.export_table(kept, scratch(spark, "export"), "orders", "json")
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_orderstatus", T.StringType())])
    return readers.read_json(spark, path, schema, lines=True).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))


@query(
    "a21_analysis_reports",
    f"""WITH {SQL_ORD}, {SQL_RFM_BASE} SELECT 'rfm' AS report, count(*) AS rows FROM rfm UNION ALL SELECT 'clv', count(*) FROM rfm""",
)
def a21(spark, sf):
    rfm = base(spark, sf)
    paths = writers.write_reports({"rfm": rfm, "clv": R.clv(rfm)}, scratch(spark, "reports"), "parquet")
    read = [readers.read_parquet(spark, p).select(F.lit(n).alias("report")) for n, p in zip(("rfm", "clv"), paths)]
    return read[0].unionByName(read[1]).groupBy("report").agg(F.count(F.lit(1)).alias("rows"))


# --- streaming -----------------------------------------------------------------------------


def _events_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    folder = scratch(spark, "events")
    table(spark, sf, "events").repartitionByRange(3, "ts").sortWithinPartitions("ts").write.parquet(folder)
    return live.read_stream(spark, folder, schema)


def _run_to_end(stream, spark, mode: str):
    """Everything available now, written to files: whole results are replaced, new rows are appended."""
    folder = scratch(spark, "sink")
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", scratch(spark, "stream"))
    if mode == "append":
        writer = writer.format("parquet").option("path", folder)
    else:
        writer = writer.foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(folder))
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(folder)


@query(
    "n01_live_key_figures",
    f"""SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M') AS window_start, {sql_rnd('sum(value)', 2)} AS revenue, count(*) AS orders,
    {sql_rnd('avg(value)', 4)} AS avg_order_value FROM events WHERE event_type = 'purchase' GROUP BY 1""",
)
def n01(spark, sf):
    events = _events_stream(spark, sf).filter("event_type = 'purchase'")
    figures = live.live_key_figures(events, "ts", "value")
    out = _run_to_end(figures, spark, "complete")
    return out.select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("window_start"), rnd("revenue", 2), "orders", rnd("avg_order_value", 4)
    )


_LATE = "event_id % 10 = 0"


@query(
    "n01_closed_hours_without_late_rows",
    f"""WITH p AS (SELECT * FROM events WHERE event_type = 'purchase'),
    w AS (SELECT max(ts) - INTERVAL 1 DAY AS mark FROM p WHERE event_id % 10 > 1),
    kept AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, value FROM p, w
      WHERE NOT {_LATE} OR time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR > mark)
    SELECT strftime(start, '%Y-%m-%d %H:%M') AS window_start, {sql_rnd('sum(value)', 2)} AS revenue, count(*) AS orders,
      (SELECT count(*) > 0 FROM p, w WHERE {_LATE} AND time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR <= mark) AS has_late_rows
    FROM kept, (SELECT max(ts) - INTERVAL 1 DAY AS last FROM p) WHERE start + INTERVAL 1 HOUR <= last GROUP BY 1""",
)
def n01_append(spark, sf):
    """Every tenth event arrives after all others: hours that are closed by then are final, rows for them are dropped."""
    events = table(spark, sf, "events").filter("event_type = 'purchase'")
    folder = scratch(spark, "events")
    # files are taken in the order in which they were written; a batch drops what the watermark of the last but one forbids
    for part in ("event_id % 10 > 1", "event_id % 10 = 1", _LATE):
        events.filter(part).coalesce(1).write.mode("append").parquet(folder)
    stream = live.read_stream(spark, folder, events.schema, files_per_batch=1)
    figures, late = live.closed_key_figures(stream, "ts", "value", scratch(spark, "sink"), scratch(spark, "stream"))
    return figures.select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("window_start"), rnd("revenue", 2), "orders", F.lit(late > 0).alias("has_late_rows")
    )


@query(
    "n02_incremental_rfm",
    f"WITH {SQL_ORD}, {SQL_RFM_BASE} SELECT customer_id, recency, frequency, monetary FROM rfm",
)
def n02(spark, sf):
    source, totals = scratch(spark, "orders"), scratch(spark, "totals")
    orders = orders_view(spark, sf)
    orders.repartition(4, "order_id").write.parquet(source)
    stream = live.read_stream(spark, source, orders.schema, files_per_batch=2)
    live.start_customer_totals(stream, totals, scratch(spark, "stream")).awaitTermination()
    return live.totals_to_rfm(live.current_totals(spark, totals))


@query("n03_streaming_scores")
def n03(spark, sf):
    data, _, model, _ = _churn_model(spark, sf)
    folder = scratch(spark, "features")
    data.write.parquet(folder)
    stream = live.read_stream(spark, folder, data.schema)
    return _run_to_end(live.score_stream(stream, model, "customer_id"), spark, "append")
