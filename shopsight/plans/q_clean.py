"""Filter, cleaning, join, sort, sampling and set queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from shopsight.operators import clean as C
from shopsight.operators import features as X
from shopsight.operators import filters as B
from shopsight.operators import sampling as P
from shopsight.operators import sets as E
from shopsight.plans.catalogue import query, rnd, sql_rnd
from shopsight.plans.retail import SQL_ORD, SQL_TX, lines_view, orders_view, table
from shopsight.schemas import in_years, literal_for

# The given tables hold no NULL, so some are made the same way on both sides.
SQL_HOLED = f"""{SQL_TX}, holed AS (SELECT customer_id, order_id, amount, nullif(quantity, 13) AS quantity,
  nullif(category, 'PROMO') AS category, nullif(season, 'Fall') AS season FROM tx)"""


def holed(spark, sf):
    tx = lines_view(spark, sf, "customer_id", "order_id", "amount", "quantity", "category", "season")
    return tx.withColumns(
        {
            "quantity": F.nullif(F.col("quantity"), F.lit(13.0)),
            "category": F.nullif(F.col("category"), F.lit("PROMO")),
            "season": F.nullif(F.col("season"), F.lit("Fall")),
        }
    )


SPEC = B.FilterSpec(
    ranges={"age": (25, 55), "amount": (1000.0, 60000.0), "rating": (2.0, 4.5), "absent": (0, 1)},
    members={"gender": ["Female"], "location": [], "category": ["ECONOMY", "PROMO", "LARGE"]},
)
SQL_SPEC = (
    "age BETWEEN 25 AND 55 AND amount BETWEEN 1000 AND 60000 AND rating BETWEEN 2 AND 4.5 "
    "AND gender = 'Female' AND category IN ('ECONOMY', 'PROMO', 'LARGE')"
)
_FILTER_COLUMNS = ("customer_id", "age", "amount", "rating", "gender", "location", "category")


@query(
    "b01_filter_spec",
    f"""WITH {SQL_TX} SELECT category, location, count(*) AS purchases, {sql_rnd('sum(amount)', 2)} AS revenue
    FROM tx WHERE {SQL_SPEC} GROUP BY category, location""",
)
def b01(spark, sf):
    kept = B.apply_filters(lines_view(spark, sf, *_FILTER_COLUMNS), SPEC)
    return kept.groupBy("category", "location").agg(
        F.count(F.lit(1)).alias("purchases"), rnd(F.sum("amount"), 2, "revenue")
    )


@query(
    "b01_filter_spec_empty_list_rejects",
    f"WITH {SQL_TX} SELECT count(*) AS purchases FROM tx WHERE age BETWEEN 25 AND 55 AND false",
)
def b01_strict(spark, sf):
    spec = B.FilterSpec(ranges={"age": (25, 55)}, members={"gender": []}, strict_empty=True)
    return B.apply_filters(lines_view(spark, sf, "age", "gender"), spec).agg(F.count(F.lit(1)).alias("purchases"))


@query(
    "b02_filter_bounds",
    f"""WITH {SQL_TX} SELECT 'age' AS "column", min(age)::DOUBLE AS min_value, max(age)::DOUBLE AS max_value FROM tx
    UNION ALL SELECT 'amount', min(amount), max(amount) FROM tx
    UNION ALL SELECT 'rating', round(min(rating), 6), round(max(rating), 6) FROM tx""",
)
def b02(spark, sf):
    return B.filter_bounds(lines_view(spark, sf, "age", "amount", "rating"), ["age", "amount", "rating"])


@query(
    "b02_filter_options",
    f"""WITH {SQL_TX} SELECT DISTINCT 'category' AS "column", category AS value FROM tx
    UNION ALL SELECT DISTINCT 'gender', gender FROM tx UNION ALL SELECT DISTINCT 'location', location FROM tx""",
)
def b02_options(spark, sf):
    return B.filter_options(lines_view(spark, sf, "category", "gender", "location"), ["category", "gender", "location"])


@query(
    "b03_advanced_filters",
    f"""WITH {SQL_ORD}, ranged AS (SELECT * FROM ord WHERE purchase_date BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1999-12-31'
      AND amount >= 5000), q AS (SELECT quantile_cont(amount, 0.25) AS a, quantile_cont(amount, 0.75) AS b FROM ranged),
    kept AS (SELECT ranged.* FROM ranged, q WHERE amount BETWEEN a - 1.5 * (b - a) AND b + 1.5 * (b - a))
    SELECT customer_id, count(*) AS orders, {sql_rnd('sum(amount)', 2)} AS revenue FROM kept GROUP BY customer_id HAVING count(*) >= 4""",
)
def b03(spark, sf):
    kept = B.advanced_filter(
        orders_view(spark, sf),
        date_range=(dt.datetime(1996, 1, 1), dt.datetime(1999, 12, 31)),
        min_amount=5000,
        min_purchases=4,
        drop_outliers=["amount"],
    )
    return kept.groupBy("customer_id").agg(F.count(F.lit(1)).alias("orders"), rnd(F.sum("amount"), 2, "revenue"))


@query(
    "b04_filter_impact",
    f"""WITH {SQL_TX} SELECT count(*) AS rows_before, count(*) FILTER ({SQL_SPEC}) AS rows_after,
    {sql_rnd(f'(count(*) - count(*) FILTER ({SQL_SPEC})) * 100.0 / count(*)', 4)} AS reduction_pct FROM tx""",
)
def b04(spark, sf):
    out = B.filter_impact(lines_view(spark, sf, *_FILTER_COLUMNS), SPEC)
    return out.select("rows_before", "rows_after", rnd("reduction_pct", 4))


@query(
    "b05_columns_by_type",
    """SELECT 'customer_id' AS "column", 'numeric' AS kind, count(o_custkey) AS present, count(DISTINCT o_custkey) AS distinct_values FROM orders
    UNION ALL SELECT 'order_id', 'numeric', count(o_orderkey), count(DISTINCT o_orderkey) FROM orders
    UNION ALL SELECT 'purchase_date', 'datetime', count(o_orderdate), count(DISTINCT o_orderdate) FROM orders
    UNION ALL SELECT 'payment_method', 'text', count(o_orderpriority), count(DISTINCT o_orderpriority) FROM orders
    UNION ALL SELECT 'amount', 'numeric', count(o_totalprice), count(DISTINCT o_totalprice) FROM orders""",
)
def b05(spark, sf):
    from shopsight.schemas import datetime_columns, numeric_columns, string_columns

    df = orders_view(spark, sf, "customer_id", "order_id", "purchase_date", "payment_method", "amount")
    kinds = [(c, k) for k, fn in (("numeric", numeric_columns), ("text", string_columns), ("datetime", datetime_columns)) for c in fn(df)]
    # what the columns chosen by type hold
    held = [
        F.struct(F.lit(c).alias("column"), F.lit(k).alias("kind"), F.count(c).alias("present"), F.count_distinct(c).alias("distinct_values"))
        for c, k in kinds
    ]
    return df.agg(F.array(*held).alias("held")).select(F.inline("held"))


@query(
    "b06_drop_duplicate_rows",
    """SELECT count(*) AS rows, sum(k)::BIGINT AS key_sum FROM (SELECT DISTINCT l_orderkey AS k, l_linenumber FROM lineitem)""",
)
def b06(spark, sf):
    pairs = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return C.drop_duplicate_rows(pairs).agg(F.count(F.lit(1)).alias("rows"), F.sum("l_orderkey").alias("key_sum"))


@query(
    "b07_duplicate_count",
    """SELECT sum(n - 1)::BIGINT AS duplicate_rows FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
)
def b07(spark, sf):
    return C.duplicate_count(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"))


@query(
    "b08_duplicate_members",
    """SELECT l_orderkey, l_linenumber FROM (SELECT l_orderkey, l_linenumber,
    count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem) WHERE n > 1 ORDER BY 1, 2 LIMIT 5""",
)
def b08(spark, sf):
    return C.duplicate_members(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"))


@query(
    "b09_impute_median_and_mode",
    f"""WITH {SQL_HOLED}, med AS (SELECT quantile_cont(quantity, 0.5) AS q FROM holed),
    mc AS (SELECT category AS c FROM holed WHERE category IS NOT NULL GROUP BY category ORDER BY count(*) DESC, category LIMIT 1),
    ms AS (SELECT season AS s FROM holed WHERE season IS NOT NULL GROUP BY season ORDER BY count(*) DESC, season LIMIT 1)
    SELECT coalesce(category, (SELECT c FROM mc)) AS category, coalesce(season, (SELECT s FROM ms)) AS season, count(*) AS n,
    {sql_rnd('sum(coalesce(quantity, (SELECT q FROM med)))', 2)} AS quantity FROM holed GROUP BY 1, 2""",
)
def b09(spark, sf):
    full = C.impute(holed(spark, sf), numeric=["quantity"], text=["category", "season"])
    return full.groupBy("category", "season").agg(F.count(F.lit(1)).alias("n"), rnd(F.sum("quantity"), 2, "quantity"))


@query(
    "b10_missing_report",
    f"""WITH {SQL_HOLED} {' UNION ALL '.join(
        f'''SELECT '{c}' AS "column", count(*) FILTER ({c} IS NULL) AS missing, {sql_rnd(f"count(*) FILTER ({c} IS NULL) * 100.0 / count(*)", 4)} AS missing_pct FROM holed'''
        for c in ('customer_id', 'order_id', 'amount', 'quantity', 'category', 'season'))}""",
)
def b10(spark, sf):
    return C.missing_report(holed(spark, sf)).select("column", "missing", rnd("missing_pct", 4))


@query(
    "b11_parse_dates",
    """SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS orders FROM orders GROUP BY 1""",
)
def b11(spark, sf):
    text = table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("order_date"), F.lit("x").alias("other")
    )
    return C.parse_dates(text).groupBy(F.date_format("order_date", "yyyy-MM").alias("month")).agg(
        F.count(F.lit(1)).alias("orders")
    )


@query(
    "b12_text_to_numeric",
    f"""SELECT l_returnflag AS flag, {sql_rnd('sum(l_quantity)', 2)} AS quantity, count(*) FILTER (l_linestatus = 'F') AS unreadable
    FROM lineitem GROUP BY 1""",
)
def b12(spark, sf):
    li = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("flag"), F.col("l_quantity").cast("string").alias("qty"),
        F.when(F.col("l_linestatus") == "F", "n/a").otherwise("1.5").alias("mixed"),
    )
    out = C.to_numeric(li, ["qty", "mixed"])
    return out.groupBy("flag").agg(rnd(F.sum("qty"), 2, "quantity"), F.count_if(F.col("mixed").isNull()).alias("unreadable"))


@query(
    "b12_detect_text_types",
    """SELECT * FROM (VALUES ('qty', true, false), ('flag', false, false), ('ship_date', false, true)) v("column", is_numeric, is_date_named)
    WHERE (SELECT count(*) FROM lineitem WHERE try_cast(l_returnflag AS DOUBLE) IS NULL) > 0""",
)
def b12_detect(spark, sf):
    li = table(spark, sf, "lineitem").select(
        F.col("l_quantity").cast("string").alias("qty"),
        F.col("l_returnflag").alias("flag"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("ship_date"),
    )
    return C.detect_text_types(li)


@query(
    "b13_standard_names",
    f"""SELECT o_custkey AS customer_id, {sql_rnd('sum(o_totalprice)', 2)} AS purchase_amount FROM orders GROUP BY 1""",
)
def b13(spark, sf):
    df = table(spark, sf, "orders").select(F.col("o_custkey").alias("Customer ID"), F.col("o_totalprice").alias("PURCHASE.AMOUNT"))
    return C.standardize_names(df).groupBy("customer_id").agg(rnd(F.sum("purchase_amount"), 2, "purchase_amount"))


@query(
    "b14_age_and_amount_bins",
    f"""WITH {SQL_ORD} SELECT CASE WHEN age <= 25 THEN '18-25' WHEN age <= 35 THEN '26-35' WHEN age <= 45 THEN '36-45'
      WHEN age <= 55 THEN '46-55' WHEN age <= 65 THEN '56-65' ELSE '65+' END AS age_group,
    CASE WHEN amount <= 50000 THEN 'Low' WHEN amount <= 200000 THEN 'Medium' ELSE 'High' END AS amount_class, count(*) AS n FROM ord GROUP BY 1, 2""",
)
def b14(spark, sf):
    df = orders_view(spark, sf, "age", "amount")
    df = C.add_bins(df, "age", C.AGE_EDGES, C.AGE_LABELS, "age_group")
    df = C.add_bins(df, "amount", [50000, 200000], ["Low", "Medium", "High"], "amount_class")
    return df.groupBy("age_group", "amount_class").agg(F.count(F.lit(1)).alias("n"))


@query(
    "b15_schema_validation",
    """SELECT 'amount' AS "column", 'missing' AS status, 0::BIGINT AS usable
    UNION ALL SELECT 'o_custkey', 'ok', count(o_custkey) FROM orders UNION ALL SELECT 'o_orderkey', 'ok', count(o_orderkey) FROM orders
    UNION ALL SELECT 'o_orderdate', 'extra', 0 UNION ALL SELECT 'o_orderpriority', 'type_mismatch', count(TRY_CAST(o_orderpriority AS INT)) FROM orders
    UNION ALL SELECT 'o_orderstatus', 'type_mismatch', count(TRY_CAST(o_orderstatus AS INT)) FROM orders UNION ALL SELECT 'o_totalprice', 'ok', count(o_totalprice) FROM orders""",
)
def b15(spark, sf):
    df = table(spark, sf, "orders")
    expected = {
        "o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double", "o_orderstatus": "int",
        "o_orderpriority": "int", "amount": "double",
    }
    found = C.validate_schema(df, expected)
    # how many values of each column can be read as the expected type
    counts = [
        F.struct(F.lit(c).alias("column"), F.count(F.col(c).try_cast(t)).alias("usable"))
        for c, t in expected.items()
        if c in df.columns
    ]
    usable = df.agg(F.array(*counts).alias("c")).select(F.inline("c"))
    return found.join(usable, "column", "left").withColumn("usable", F.coalesce("usable", F.lit(0).cast("bigint")))


@query(
    "b16_value_bands",
    f"""WITH {SQL_ORD} SELECT CASE WHEN amount >= 300000 THEN 'high' WHEN amount >= 100000 THEN 'medium' ELSE 'low' END AS band,
    count(*) AS orders FROM ord GROUP BY 1""",
)
def b16(spark, sf):
    return B.value_bands(orders_view(spark, sf, "amount"), "amount", 300000, 100000).groupBy("band").agg(
        F.count(F.lit(1)).alias("orders")
    )


@query(
    "b17_customer_journey",
    f"""WITH {SQL_ORD} SELECT order_id, strftime(purchase_date, '%Y-%m-%d') AS day, amount FROM ord
    WHERE customer_id = (SELECT min(customer_id) FROM ord)""",
)
def b17(spark, sf):
    orders = orders_view(spark, sf)
    first = orders.agg(F.min("customer_id")).first()[0]
    return B.customer_journey(orders, first).select(
        "order_id", F.date_format("purchase_date", "yyyy-MM-dd").alias("day"), "amount"
    )


@query(
    "b17_all_customer_journeys",
    f"""WITH {SQL_ORD} SELECT customer_id, order_id, amount, row_number() OVER w AS step,
    date_diff('day', lag(purchase_date) OVER w, purchase_date) AS days_since_previous,
    CAST(sum(CAST(amount AS DECIMAL(18,2))) OVER (w ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_spend
    FROM ord WINDOW w AS (PARTITION BY customer_id ORDER BY purchase_date, order_id)""",
)
def b17_all(spark, sf):
    out = B.customer_journeys(orders_view(spark, sf))
    return out.select("customer_id", "order_id", "amount", "step", "days_since_previous", "running_spend")


@query(
    "b18_row_rules",
    f"""WITH {SQL_TX}, c AS (SELECT count(*) FILTER (NOT age >= 18) AS a, count(*) FILTER (NOT amount > 1000) AS b,
    count(*) FILTER (NOT rating BETWEEN 1 AND 4.9) AS c FROM tx)
    SELECT 'adult' AS rule, a AS violations, a = 0 AS is_valid FROM c UNION ALL SELECT 'amount', b, b = 0 FROM c
    UNION ALL SELECT 'rating', c, c = 0 FROM c""",
)
def b18(spark, sf):
    tx = lines_view(spark, sf, "age", "amount", "rating")
    return B.validate_rows(tx, {"adult": "age >= 18", "amount": "amount > 1000", "rating": "rating BETWEEN 1 AND 4.9"})


@query(
    "b19_first_and_last_rows",
    """(SELECT 'first' AS part, o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5) UNION ALL
    (SELECT 'last', o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey DESC LIMIT 5)""",
)
def b19(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    first = B.head(o, ["o_orderkey"], 5).withColumn("part", F.lit("first"))
    return first.unionByName(B.head(o, ["o_orderkey"], 5, last=True).withColumn("part", F.lit("last")))


# --- joins ----------------------------------------------------------------------


@query(
    "c01_attach_customer_stats",
    f"""WITH {SQL_ORD}, s AS (SELECT customer_id, count(*) AS n, sum(amount) AS t FROM ord GROUP BY 1)
    SELECT order_id, amount, n AS customer_orders, {sql_rnd('amount / t * 100', 4)} AS share_pct FROM ord LEFT JOIN s USING (customer_id)""",
)
def c01(spark, sf):
    orders = orders_view(spark, sf, "customer_id", "order_id", "amount")
    stats = orders.groupBy("customer_id").agg(F.count(F.lit(1)).alias("customer_orders"), F.sum("amount").alias("customer_total"))
    out = X.attach_customer_stats(orders, stats)
    return out.select(
        "order_id", "amount", "customer_orders", rnd(F.col("amount") / F.col("customer_total") * 100, 4, "share_pct")
    )


@query(
    "c02_merge_feature_tables",
    f"""WITH {SQL_ORD}, a AS (SELECT customer_id, count(*) AS orders FROM ord WHERE shipping_type = 'F' GROUP BY 1),
    b AS (SELECT customer_id, count(*) AS orders, max(amount) AS largest FROM ord WHERE shipping_type = 'P' GROUP BY 1),
    c AS (SELECT customer_id, min(amount) AS smallest FROM ord WHERE season = 'Winter' GROUP BY 1)
    SELECT customer_id, a.orders AS orders, b.orders AS f1_orders, largest, smallest
    FROM a FULL JOIN b USING (customer_id) FULL JOIN c USING (customer_id)""",
)
def c02(spark, sf):
    orders = orders_view(spark, sf, "customer_id", "shipping_type", "season", "amount")
    a = orders.filter("shipping_type = 'F'").groupBy("customer_id").agg(F.count(F.lit(1)).alias("orders"))
    b = orders.filter("shipping_type = 'P'").groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("orders"), F.max("amount").alias("largest")
    )
    c = orders.filter("season = 'Winter'").groupBy("customer_id").agg(F.min("amount").alias("smallest"))
    return X.merge_features(a, b, c, on="customer_id")


@query(
    "c03_compare_periods",
    f"""WITH {SQL_ORD}, cur AS (SELECT location, sum(amount) AS revenue, count(*) AS orders FROM ord WHERE year(purchase_date) = 1999 AND payment_method <> '1-URGENT' GROUP BY 1),
    prev AS (SELECT location, sum(amount) AS revenue, count(*) AS orders FROM ord WHERE year(purchase_date) = 1998 GROUP BY 1)
    SELECT location, cur.orders AS orders_current, prev.orders AS orders_previous, cur.orders - prev.orders AS orders_change,
    {sql_rnd('coalesce((cur.orders - prev.orders) / prev.orders * 100, 0)', 4)} AS orders_change_pct,
    {sql_rnd('cur.revenue - prev.revenue', 2)} AS revenue_change,
    {sql_rnd('coalesce((cur.revenue - prev.revenue) / prev.revenue * 100, 0)', 4)} AS revenue_change_pct
    FROM cur FULL JOIN prev USING (location)""",
)
def c03(spark, sf):
    orders = orders_view(spark, sf, "location", "amount", "purchase_date", "payment_method")
    agg = [F.sum("amount").alias("revenue"), F.count(F.lit(1)).alias("orders")]
    later = in_years(orders, "purchase_date", 1999, 1999) & (F.col("payment_method") != "1-URGENT")
    cur = orders.filter(later).groupBy("location").agg(*agg)
    prev = orders.filter(in_years(orders, "purchase_date", 1998, 1998)).groupBy("location").agg(*agg)
    out = X.compare_tables(cur, prev, "location")
    return out.select(
        "location", "orders_current", "orders_previous", "orders_change", rnd("orders_change_pct", 4),
        rnd("revenue_change", 2), rnd("revenue_change_pct", 4),
    )


@query(
    "c06_semi_join_items",
    f"""WITH {SQL_TX}, liked AS (SELECT item FROM tx GROUP BY item HAVING avg(rating) > 3)
    SELECT item, count(*) AS purchases FROM tx WHERE item IN (SELECT item FROM liked) GROUP BY item""",
)
def c06(spark, sf):
    tx = lines_view(spark, sf, "customer_id", "item", "rating")
    liked = tx.groupBy("item").agg(F.avg("rating").alias("r")).filter("r > 3").select("item")
    return E.keep_listed(tx, liked, ["item"]).groupBy("item").agg(F.count(F.lit(1)).alias("purchases"))


@query(
    "c07_anti_join_unbought",
    f"""WITH {SQL_TX}, u AS (SELECT DISTINCT customer_id FROM tx), i AS (SELECT DISTINCT item FROM tx),
    b AS (SELECT DISTINCT customer_id, item FROM tx)
    SELECT customer_id, item FROM (SELECT customer_id, item FROM u, i) a WHERE NOT EXISTS
      (SELECT 1 FROM b WHERE b.customer_id = a.customer_id AND b.item = a.item)""",
)
def c07(spark, sf):
    return E.unbought_items(lines_view(spark, sf, "customer_id", "item"), "customer_id", "item")


@query(
    "c08_merge_scored_lists",
    f"""WITH {SQL_TX}, a AS (SELECT customer_id, item, avg(rating) AS s FROM tx WHERE season = 'Winter' GROUP BY 1, 2),
    b AS (SELECT customer_id, item, avg(rating) AS s FROM tx WHERE season = 'Summer' GROUP BY 1, 2)
    SELECT customer_id, item, {sql_rnd('0.6 * coalesce(a.s, 0) + 0.4 * coalesce(b.s, 0)', 6)} AS score
    FROM a FULL JOIN b USING (customer_id, item)""",
)
def c08(spark, sf):
    tx = lines_view(spark, sf, "customer_id", "item", "rating", "season")

    def scored(season):
        return tx.filter(F.col("season") == season).groupBy("customer_id", "item").agg(F.avg("rating").alias("score"))

    out = E.merge_scores(scored("Winter"), scored("Summer"), ["customer_id", "item"], 0.6, 0.4)
    return out.select("customer_id", "item", rnd("score", 6))


# --- sorts, samples, sets ---------------------------------------------------------


@query(
    "f01_sorted_categories",
    f"WITH {SQL_TX} SELECT category, {sql_rnd('sum(amount)', 2)} AS revenue FROM tx GROUP BY 1 ORDER BY 2 DESC, 1",
)
def f01(spark, sf):
    tx = lines_view(spark, sf, "category", "amount")
    return tx.groupBy("category").agg(rnd(F.sum("amount"), 2, "revenue")).orderBy(F.col("revenue").desc_nulls_last(), "category")


@query(
    "f02_largest_and_smallest_orders",
    """(SELECT 'top' AS part, o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10) UNION ALL
    (SELECT 'bottom', o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 10)""",
)
def f02(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    top = E.top_k(o, "o_totalprice", ["o_orderkey"], 10).withColumn("part", F.lit("top"))
    return top.unionByName(E.top_k(o, "o_totalprice", ["o_orderkey"], 10, largest=False).withColumn("part", F.lit("bottom")))


@query(
    "f03_top_orders_per_customer",
    f"""WITH {SQL_ORD} SELECT customer_id, order_id, rank FROM (SELECT customer_id, order_id,
    CAST(row_number() OVER (PARTITION BY customer_id ORDER BY amount DESC, order_id) AS INTEGER) AS rank FROM ord) WHERE rank <= 3""",
)
def f03(spark, sf):
    orders = orders_view(spark, sf, "customer_id", "order_id", "amount")
    return E.top_per_group(orders, ["customer_id"], "amount", ["order_id"], 3).select("customer_id", "order_id", "rank")


_SQL_HASH = "('0x' || substr(md5(concat_ws('|', o_orderkey, '42')), 1, 15))::BIGINT"


@query(
    "f04_fixed_size_sample",
    f"""SELECT o_custkey AS customer_id, o_orderkey AS order_id, o_orderdate AS purchase_date, o_totalprice AS amount FROM orders
    ORDER BY {_SQL_HASH}, o_orderkey LIMIT 100""",
)
def f04(spark, sf):
    return P.sample_rows(orders_view(spark, sf), ["order_id"], 100, seed=42)


@query(
    "f06_hash_split",
    f"SELECT CASE WHEN {_SQL_HASH} % 1000 < 200 THEN 'test' ELSE 'train' END AS part, count(*) AS rows FROM orders GROUP BY 1",
)
def f06(spark, sf):
    train, test = P.hash_split(orders_view(spark, sf), ["order_id"], 20, seed=42)
    sizes = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return sizes.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "f06_stratified_split_sizes",
    """SELECT o_orderstatus AS label, count(*) AS rows, CAST(round(count(*) * 0.2) AS BIGINT) AS test_rows FROM orders GROUP BY 1""",
)
def f06_stratified(spark, sf):
    orders = orders_view(spark, sf, "order_id", "shipping_type")
    marked = P.stratified_split(orders, "order_id", "shipping_type", 0.2, seed=42)
    return marked.groupBy(F.col("shipping_type").alias("label")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("is_test")).alias("test_rows")
    )


@query(
    "f07_row_union",
    """SELECT o_orderstatus, count(*) AS n FROM (SELECT o_orderstatus FROM orders WHERE o_totalprice > 400000
    UNION ALL SELECT o_orderstatus FROM orders WHERE o_totalprice > 300000) GROUP BY 1""",
)
def f07(spark, sf):
    o = table(spark, sf, "orders")
    both = E.union_rows(o.filter("o_totalprice > 400000"), o.filter("o_totalprice > 300000"))
    return both.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query(
    "f08_columns_side_by_side",
    f"""WITH {SQL_ORD}, a AS (SELECT customer_id, count(*) AS orders FROM ord GROUP BY 1),
    b AS (SELECT customer_id, max(amount) AS largest FROM ord GROUP BY 1) SELECT customer_id, orders, largest FROM a JOIN b USING (customer_id)""",
)
def f08(spark, sf):
    orders = orders_view(spark, sf, "customer_id", "amount")
    a = orders.groupBy("customer_id").agg(F.count(F.lit(1)).alias("orders"))
    b = orders.groupBy("customer_id").agg(F.max("amount").alias("largest"))
    return E.side_by_side(a, b, ["customer_id"])


@query("f09_distinct_values", "SELECT DISTINCT p_brand AS value FROM part")
def f09(spark, sf):
    return E.distinct_values(table(spark, sf, "part"), "p_brand")


@query(
    "f10_item_set_operations",
    f"""WITH {SQL_TX}, w AS (SELECT DISTINCT customer_id, item FROM tx WHERE season = 'Winter'),
    s AS (SELECT DISTINCT customer_id, item FROM tx WHERE season = 'Summer')
    SELECT customer_id, count(*) FILTER (w.item IS NOT NULL AND s.item IS NOT NULL) AS both,
    count(*) AS either, count(*) FILTER (s.item IS NULL) AS only_first
    FROM w FULL JOIN s USING (customer_id, item) GROUP BY customer_id""",
)
def f10(spark, sf):
    tx = lines_view(spark, sf, "customer_id", "item", "season")
    return E.set_sizes(
        tx.filter("season = 'Winter'"), tx.filter("season = 'Summer'"), "customer_id", "item"
    )


@query(
    "f11_incremental_aggregates",
    f"""WITH {SQL_ORD} SELECT customer_id, count(*) AS n, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total,
    strftime(max(purchase_date), '%Y-%m-%d') AS last_day, {sql_rnd('stddev_samp(amount)', 4)} AS std FROM ord GROUP BY customer_id""",
)
def f11(spark, sf):
    orders = orders_view(spark, sf)
    cut = literal_for(orders, "purchase_date", dt.date(1999, 1, 1))
    old = E.customer_partials(orders.filter(F.col("purchase_date") < cut))
    new = E.customer_partials(orders.filter(F.col("purchase_date") >= cut))
    merged = E.finish_partials(E.merge_partials(old, new))
    return merged.select(
        "customer_id", "n", "total", F.date_format("last_purchase", "yyyy-MM-dd").alias("last_day"), rnd("std", 4)
    )
