"""Customer feature, calendar, encoding and scaling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shopsight.functions import scalars as H
from shopsight.operators import features as X
from shopsight.operators import transform as G
from shopsight.plans.catalogue import query, rnd, sql_rnd
from shopsight.plans.q_rfm import base
from shopsight.plans.retail import SQL_ORD, SQL_RFM_BASE, SQL_TX, lines_view, orders_view, table


def sql_mode(column: str, name: str) -> str:
    """CTE: most frequent value per customer, smallest among ties."""
    return f"""{name} AS (SELECT customer_id, arg_min({column}, (-n, {column})) AS v FROM
      (SELECT customer_id, {column}, count(*) AS n FROM tx GROUP BY 1, 2) GROUP BY 1)"""


@query(
    "d01_customer_features",
    f"""WITH {SQL_TX}, {sql_mode('category', 'mc')}, {sql_mode('season', 'ms')}, {sql_mode('payment_method', 'mp')},
    f AS (SELECT customer_id, arg_min(age, (purchase_date, order_id)) AS age, arg_min(gender, (purchase_date, order_id)) AS gender,
      arg_min(location, (purchase_date, order_id)) AS location, arg_min(previous_purchases, (purchase_date, order_id)) AS previous_purchases,
      arg_min(subscription, (purchase_date, order_id)) AS subscription_status,
      sum(amount) AS total, avg(amount) AS mean, coalesce(stddev_samp(amount), 0) AS std, min(amount) AS lo, max(amount) AS hi,
      count(amount) AS n, avg(rating) AS r, coalesce(stddev_samp(rating), 0) AS rs,
      count(*) FILTER (discount_applied = 'Yes') AS discount_count, count(*) FILTER (promo_used = 'Yes') AS promo_count FROM tx GROUP BY 1)
    SELECT f.customer_id, age, gender, location, previous_purchases, subscription_status, {sql_rnd('total', 2)} AS total_spent,
    {sql_rnd('mean', 4)} AS avg_spent, {sql_rnd('std', 4)} AS spending_std, lo AS min_spent, hi AS max_spent, n AS purchase_count,
    {sql_rnd('r', 6)} AS avg_rating, {sql_rnd('rs', 6)} AS rating_std, mc.v AS preferred_category, ms.v AS preferred_season,
    mp.v AS preferred_payment, discount_count, promo_count, {sql_rnd('hi - lo', 2)} AS spending_range,
    {sql_rnd('std / (mean + 1e-6)', 6)} AS spending_consistency, previous_purchases + n AS total_purchases,
    {sql_rnd('discount_count / n', 6)} AS discount_rate, {sql_rnd('promo_count / n', 6)} AS promo_rate,
    CAST(subscription_status = 'Yes' AS INTEGER) AS is_subscriber
    FROM f JOIN mc USING (customer_id) JOIN ms USING (customer_id) JOIN mp USING (customer_id)""",
)
def d01(spark, sf):
    tx = lines_view(
        spark, sf, "customer_id", "order_id", "purchase_date", "age", "gender", "location", "previous_purchases",
        "subscription", "amount", "rating", "category", "season", "payment_method", "discount_applied", "promo_used",
    )
    out = X.customer_features(tx)
    digits = {
        "total_spent": 2, "avg_spent": 4, "spending_std": 4, "avg_rating": 6, "rating_std": 6, "spending_range": 2,
        "spending_consistency": 6, "discount_rate": 6, "promo_rate": 6,
    }
    return out.select(*[rnd(c, digits[c]) if c in digits else c for c in out.columns if c != "rating_count"])


@query(
    "d02_clustering_features",
    f"""WITH {SQL_TX}, {sql_mode('category', 'mc')}, f AS (SELECT customer_id, count(*) AS n, sum(amount) AS t, avg(amount) AS m,
    stddev_samp(amount) AS s, avg(rating) AS r, min(previous_purchases) AS p FROM tx GROUP BY 1)
    SELECT customer_id, n AS purchase_frequency, {sql_rnd('t', 2)} AS total_spent, {sql_rnd('s', 4)} AS spending_std,
    {sql_rnd('r', 6)} AS avg_rating, mc.v AS preferred_category, {sql_rnd('s / m', 6)} AS spending_consistency, p + n AS customer_tenure
    FROM f JOIN mc USING (customer_id)""",
)
def d02(spark, sf):
    tx = lines_view(
        spark, sf, "customer_id", "order_id", "purchase_date", "previous_purchases", "amount", "rating", "category", "season", "payment_method"
    )
    return X.clustering_features(tx).select(
        "customer_id", "purchase_frequency", rnd("total_spent", 2), rnd("spending_std", 4), rnd("avg_rating", 6),
        "preferred_category", rnd("spending_consistency", 6), "customer_tenure",
    )


@query(
    "d03_segmentation_features",
    f"""WITH {SQL_TX} SELECT customer_id, {sql_rnd('sum(amount)', 2)} AS total_spent, {sql_rnd('avg(amount)', 4)} AS avg_spent,
    count(*) AS purchase_count, {sql_rnd('coalesce(stddev_samp(amount), 0)', 4)} AS spending_std, min(age) AS age,
    {sql_rnd('avg(rating)', 6)} AS avg_rating, count(DISTINCT category) AS category_variety FROM tx GROUP BY 1""",
)
def d03(spark, sf):
    tx = lines_view(spark, sf, "customer_id", "order_id", "purchase_date", "age", "amount", "rating", "category")
    return X.segmentation_features(tx).select(
        "customer_id", rnd("total_spent", 2), rnd("avg_spent", 4), "purchase_count", rnd("spending_std", 4), "age",
        rnd("avg_rating", 6), "category_variety",
    )


@query(
    "d04_derived_customer_stats",
    f"""WITH {SQL_TX}, s AS (SELECT customer_id, count(*) AS n, round(sum(quantity), 2) AS q, sum(price) AS t, avg(price) AS a, min(age) AS age,
      max(purchase_date) AS last FROM tx GROUP BY 1)
    SELECT customer_id, n AS purchase_frequency, q AS total_quantity, {sql_rnd('t', 2)} AS total_spent, age AS customer_age,
    {sql_rnd('t * n', 1)} AS clv, date_diff('day', last, (SELECT max(purchase_date) FROM tx)) AS recency, n AS rows_joined
    FROM s""",
)
def d04(spark, sf):
    tx = lines_view(spark, sf, "customer_id", "order_id", "purchase_date", "quantity", "price", "age")
    stats = X.derived_stats(tx, "quantity", "price")
    joined = X.attach_customer_stats(tx, stats)
    keys = ["customer_id", "purchase_frequency", "total_quantity", "total_spent", "customer_age", "clv", "recency"]
    out = joined.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_joined"))
    return out.withColumns({"total_spent": rnd(F.col("total_spent"), 2), "clv": rnd(F.col("clv"), 1)})


@query(
    "d07_behavioral_features",
    f"""WITH {SQL_TX}, {sql_mode('season', 'ms')}, {sql_mode('size', 'mz')}, {sql_mode('color', 'mo')}, {sql_mode('shipping_type', 'mh')},
    f AS (SELECT customer_id, count(DISTINCT category) AS c, count(DISTINCT season) AS s, count(DISTINCT payment_method) AS p,
      count(rating) AS n, coalesce(stddev_samp(rating), 0) AS v FROM tx GROUP BY 1)
    SELECT customer_id, c AS category_diversity, s AS season_diversity, p AS payment_diversity, ms.v AS preferred_season, mz.v AS preferred_size,
    mo.v AS preferred_color, mh.v AS preferred_shipping, n AS review_count, {sql_rnd('f.v', 6)} AS review_variability,
    {sql_rnd('(c + s + p) / 3', 6)} AS diversity_score, CAST(c = 1 AS INTEGER) AS brand_loyal, CAST(s = 1 AS INTEGER) AS season_consistent
    FROM f JOIN ms USING (customer_id) JOIN mz USING (customer_id) JOIN mo USING (customer_id) JOIN mh USING (customer_id)""",
)
def d07(spark, sf):
    tx = lines_view(
        spark, sf, "customer_id", "category", "season", "payment_method", "size", "color", "shipping_type", "rating"
    )
    out = X.behavioral_features(tx)
    return out.withColumns(
        {"review_variability": rnd(F.col("review_variability"), 6), "diversity_score": rnd(F.col("diversity_score"), 6)}
    )


@query(
    "d08_time_features",
    f"""WITH {SQL_ORD}, f AS (SELECT customer_id, count(DISTINCT month(purchase_date)) AS md, coalesce(stddev_samp(month(purchase_date)), 0) AS mv,
      count(DISTINCT isodow(purchase_date)) AS dd, avg(isodow(purchase_date) - 1) AS ad, count(DISTINCT quarter(purchase_date)) AS qd,
      min(purchase_date) AS a, max(purchase_date) AS b, count(*) AS n FROM ord GROUP BY 1)
    SELECT customer_id, md AS month_diversity, {sql_rnd('mv', 6)} AS month_variability, dd AS day_diversity, {sql_rnd('ad', 6)} AS avg_purchase_day,
    qd AS quarter_diversity, strftime(a, '%Y-%m-%d') AS first_purchase, strftime(b, '%Y-%m-%d') AS last_purchase, n AS total_purchases,
    date_diff('day', a, b) AS customer_tenure_days, {sql_rnd("n / (date_diff('day', a, b) + 1)", 8)} AS purchase_frequency_daily FROM f""",
)
def d08(spark, sf):
    out = X.time_features(orders_view(spark, sf, "customer_id", "purchase_date"))
    return out.withColumns(
        {
            "month_variability": rnd(F.col("month_variability"), 6),
            "avg_purchase_day": rnd(F.col("avg_purchase_day"), 6),
            "purchase_frequency_daily": rnd(F.col("purchase_frequency_daily"), 8),
            "first_purchase": F.date_format("first_purchase", "yyyy-MM-dd"),
            "last_purchase": F.date_format("last_purchase", "yyyy-MM-dd"),
        }
    )


@query(
    "d09_purchase_statistics",
    f"""WITH {SQL_TX} SELECT customer_id, count(*) AS purchases, {sql_rnd('sum(amount)', 2)} AS total_spent, {sql_rnd('avg(amount)', 4)} AS avg_spent,
    {sql_rnd('stddev_samp(amount)', 4)} AS spending_std, count(DISTINCT category) AS categories FROM tx GROUP BY 1""",
)
def d09(spark, sf):
    out = X.purchase_statistics(lines_view(spark, sf, "customer_id", "amount", "category"))
    return out.select(
        "customer_id", "purchases", rnd("total_spent", 2), rnd("avg_spent", 4), rnd("spending_std", 4), "categories"
    )


# --- calendar and scalar functions -----------------------------------------------


@query(
    "h01_calendar_parts",
    f"""WITH {SQL_ORD} SELECT year(purchase_date) AS year, month(purchase_date) AS month, quarter(purchase_date) AS quarter,
    week(purchase_date) AS week, isodow(purchase_date) - 1 AS weekday, dayname(purchase_date) AS day_name,
    CAST(isodow(purchase_date) >= 6 AS BIGINT) AS weekend, sum(day(purchase_date))::BIGINT AS days, count(*) AS orders FROM ord GROUP BY ALL""",
)
def h01(spark, sf):
    out = X.transaction_time_parts(orders_view(spark, sf, "purchase_date"))
    big = {"year": "purchase_year", "month": "purchase_month", "quarter": "purchase_quarter", "week": "purchase_week",
           "weekday": "purchase_weekday", "weekend": "purchase_is_weekend"}
    return out.groupBy(
        *[F.col(c).cast("bigint").alias(n) for n, c in big.items()], F.col("purchase_day_name").alias("day_name")
    ).agg(F.sum(F.col("purchase_day").cast("bigint")).alias("days"), F.count(F.lit(1)).alias("orders"))


@query(
    "h04_cyclic_calendar",
    f"""WITH {SQL_ORD} SELECT DISTINCT month(purchase_date) AS month, isodow(purchase_date) - 1 AS weekday,
    {sql_rnd('sin(2 * pi() * month(purchase_date) / 12)', 9)} AS month_sin, {sql_rnd('cos(2 * pi() * month(purchase_date) / 12)', 9)} AS month_cos,
    {sql_rnd('sin(2 * pi() * (isodow(purchase_date) - 1) / 7)', 9)} AS day_sin, {sql_rnd('cos(2 * pi() * (isodow(purchase_date) - 1) / 7)', 9)} AS day_cos FROM ord""",
)
def h04(spark, sf):
    out = X.transaction_time_parts(orders_view(spark, sf, "purchase_date"))
    return out.select(
        F.col("purchase_month").cast("bigint").alias("month"), F.col("purchase_weekday").cast("bigint").alias("weekday"),
        *[rnd(c, 9) for c in ("month_sin", "month_cos", "day_sin", "day_cos")],
    ).distinct()


@query(
    "h05_period_starts",
    f"""WITH {SQL_ORD} SELECT strftime(date_trunc('day', purchase_date), '%Y-%m-%d') AS day, strftime(date_trunc('month', purchase_date), '%Y-%m-%d') AS month,
    strftime(date_trunc('quarter', purchase_date), '%Y-%m-%d') AS quarter, count(*) AS orders FROM ord GROUP BY ALL""",
)
def h05(spark, sf):
    ts = F.col("purchase_date")
    periods = [F.date_format(H.period_start(ts, p), "yyyy-MM-dd").alias(n) for p, n in (("D", "day"), ("M", "month"), ("Q", "quarter"))]
    return orders_view(spark, sf, "purchase_date").groupBy(*periods).agg(F.count(F.lit(1)).alias("orders"))


@query(
    "h06_day_and_month_differences",
    """SELECT date_diff('day', o_orderdate::TIMESTAMP, l_shipdate::TIMESTAMP) AS days,
    (year(l_shipdate) - year(o_orderdate)) * 12 + month(l_shipdate) - month(o_orderdate) AS months, count(*) AS lines
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate >= o_orderdate GROUP BY ALL""",
)
def h06(spark, sf):
    joined = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    joined = joined.filter("l_shipdate >= o_orderdate")
    a, b = F.col("o_orderdate").cast("timestamp"), F.col("l_shipdate").cast("timestamp")
    return joined.groupBy(
        H.whole_days(a, b).alias("days"), H.months_between_periods(a, b).cast("bigint").alias("months")
    ).agg(F.count(F.lit(1)).alias("lines"))


@query(
    "h08_arithmetic_functions",
    f"""SELECT o_orderkey, least(greatest(o_totalprice, 1000), 100000) AS clipped, {sql_rnd('sqrt(o_totalprice)', 6)} AS root,
    abs(o_totalprice - 100000) AS distance FROM orders""",
)
def h08(spark, sf):
    price = F.col("o_totalprice")
    return table(spark, sf, "orders").select(
        "o_orderkey", H.clip(price, 1000.0, 100000.0).alias("clipped"), rnd(F.sqrt(price), 6, "root"),
        F.abs(price - 100000).alias("distance"),
    )


@query(
    "h09_joined_text",
    f"WITH {SQL_TX} SELECT concat_ws(' ', category, season, color, size) AS content, count(*) AS n, CAST(length(concat_ws(' ', category, season, color, size)) AS BIGINT) AS chars FROM tx GROUP BY ALL",
)
def h09(spark, sf):
    tx = lines_view(spark, sf, "category", "season", "color", "size")
    out = tx.groupBy(H.join_text("category", "season", "color", "size").alias("content")).agg(F.count(F.lit(1)).alias("n"))
    return out.withColumn("chars", F.length("content").cast("bigint"))


@query(
    "h10_text_lengths",
    "SELECT CAST(min(length(p_name)) AS BIGINT) AS shortest, CAST(max(length(p_name)) AS BIGINT) AS longest FROM part",
)
def h10(spark, sf):
    size = F.length("p_name").cast("bigint")
    return table(spark, sf, "part").agg(F.min(size).alias("shortest"), F.max(size).alias("longest"))


@query(
    "h12_formatted_figures",
    f"""WITH {SQL_ORD}, {SQL_RFM_BASE} SELECT customer_id, format('${{:,.2f}}', monetary) AS currency,
    format('{{:,}}', frequency) AS thousands, CASE WHEN monetary >= 1e9 THEN format('{{:.1f}}B', monetary / 1e9)
      WHEN monetary >= 1e6 THEN format('{{:.1f}}M', monetary / 1e6) WHEN monetary >= 1e3 THEN format('{{:.1f}}K', monetary / 1e3)
      ELSE format('{{:.0f}}', monetary) END AS short FROM rfm""",
)
def h12(spark, sf):
    money = F.col("monetary")
    return base(spark, sf).select(
        "customer_id", H.format_currency(money).alias("currency"), H.format_thousands(F.col("frequency")).alias("thousands"),
        H.format_short(money).alias("short"),
    )


@query(
    "h13_risk_bands",
    f"""WITH {SQL_TX}, p AS (SELECT customer_id, (sum(quantity) - count(*)) / (49.0::DOUBLE * count(*)) AS p FROM tx GROUP BY 1)
    SELECT CASE WHEN p > 0.7 THEN 'High Risk' WHEN p > 0.4 THEN 'Medium Risk' ELSE 'Low Risk' END AS band,
    CASE WHEN p > 0.6 THEN 'High Risk' WHEN p > 0.3 THEN 'Medium Risk' ELSE 'Low Risk' END AS form_band, count(*) AS n FROM p GROUP BY ALL""",
)
def h13(spark, sf):
    # quantities are whole numbers, so their sum does not depend on its order and a mean on the band's edge stays there
    mean = (F.sum("quantity") - F.count(F.lit(1))) / (49.0 * F.count(F.lit(1)))
    p = lines_view(spark, sf, "customer_id", "quantity").groupBy("customer_id").agg(mean.alias("p"))
    return p.groupBy(
        H.risk_band(F.col("p")).alias("band"), H.risk_band(F.col("p"), 0.6, 0.3).alias("form_band")
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "h14_lifespan",
    f"WITH {SQL_TX} SELECT customer_id, {sql_rnd('12 + avg(rating) / 5 * 24', 6)} AS lifespan_months FROM tx GROUP BY 1",
)
def h14(spark, sf):
    per = lines_view(spark, sf, "customer_id", "rating").groupBy("customer_id").agg(F.avg("rating").alias("r"))
    return per.select("customer_id", rnd(H.lifespan_months(F.col("r")), 6, "lifespan_months"))


# --- fitted transforms --------------------------------------------------------------


@query(
    "g01_label_encoding",
    f"""WITH {SQL_TX} SELECT location, CAST(dense_rank() OVER (ORDER BY location) - 1 AS INTEGER) AS location_encoded, count(*) AS n
    FROM tx GROUP BY location""",
)
def g01(spark, sf):
    out = G.label_encode(lines_view(spark, sf, "location"), ["location"])
    return out.groupBy("location", "location_encoded").agg(F.count(F.lit(1)).alias("n"))


@query(
    "g02_one_hot",
    f"""WITH {SQL_TX}, h AS (SELECT customer_id, nullif(season, 'Fall') AS season FROM tx) SELECT customer_id,
    count(*) FILTER (season = 'Spring') AS "season_Spring", count(*) FILTER (season = 'Summer') AS "season_Summer",
    count(*) FILTER (season = 'Winter') AS "season_Winter", count(*) FILTER (season IS NULL) AS season_nan FROM h GROUP BY 1""",
)
def g02(spark, sf):
    tx = lines_view(spark, sf, "customer_id", "season").withColumn("season", F.nullif("season", F.lit("Fall")))
    out = G.one_hot(tx, ["season"])
    return out.groupBy("customer_id").agg(*[F.sum(c).alias(c) for c in out.columns if c != "customer_id"])


@query(
    "g03_mixed_encoding",
    f"""WITH {SQL_TX}, i AS (SELECT item, dense_rank() OVER (ORDER BY item) - 1 AS code FROM (SELECT DISTINCT item FROM tx))
    SELECT CAST(code AS INTEGER) AS item_encoded, count(*) FILTER (gender = 'Female') AS "gender_Female",
    count(*) FILTER (gender = 'Male') AS "gender_Male" FROM tx JOIN i USING (item) GROUP BY 1""",
)
def g03(spark, sf):
    out = G.encode_mixed(lines_view(spark, sf, "item", "gender"), ["item", "gender"])
    return out.groupBy("item_encoded").agg(F.sum("gender_Female").alias("gender_Female"), F.sum("gender_Male").alias("gender_Male"))


@query(
    "g04_iqr_outliers",
    f"""WITH {SQL_TX}, q AS (SELECT quantile_cont(amount, 0.25) AS a1, quantile_cont(amount, 0.75) AS a3,
    quantile_cont(price, 0.25) AS p1, quantile_cont(price, 0.75) AS p3 FROM tx)
    SELECT category, count(*) FILTER (amount < a1 - 1.5 * (a3 - a1) OR amount > a3 + 1.5 * (a3 - a1)
      OR price < p1 - 1.5 * (p3 - p1) OR price > p3 + 1.5 * (p3 - p1)) AS outliers, count(*) AS n FROM tx, q GROUP BY category""",
)
def g04(spark, sf):
    out = G.flag_outliers(lines_view(spark, sf, "category", "amount", "price"), ["amount", "price"])
    return out.groupBy("category").agg(F.count_if("is_outlier").alias("outliers"), F.count(F.lit(1)).alias("n"))


@query(
    "g05_zscore_outliers",
    f"""WITH {SQL_TX}, q AS (SELECT avg(amount) AS m, stddev_samp(amount) AS s FROM tx)
    SELECT category, count(*) FILTER (abs((amount - m) / s) > 2) AS outliers FROM tx, q GROUP BY category""",
)
def g05(spark, sf):
    out = G.flag_outliers(lines_view(spark, sf, "category", "amount"), ["amount"], "zscore", 2.0)
    return out.groupBy("category").agg(F.count_if("is_outlier").alias("outliers"))


@query(
    "g06_standardize",
    f"""WITH {SQL_ORD}, {SQL_RFM_BASE}, s AS (SELECT avg(recency) AS rm, stddev_pop(recency) AS rs, avg(frequency) AS fm, stddev_pop(frequency) AS fs,
    avg(monetary) AS mm, stddev_pop(monetary) AS ms FROM rfm) SELECT customer_id, {sql_rnd('(recency - rm) / rs', 6)} AS recency,
    {sql_rnd('(frequency - fm) / fs', 6)} AS frequency, {sql_rnd('(monetary - mm) / ms', 6)} AS monetary, 0.0::DOUBLE AS constant FROM rfm, s""",
)
def g06(spark, sf):
    cols = ["recency", "frequency", "monetary", "constant"]
    out = G.standardize(base(spark, sf).withColumn("constant", F.lit(7)), cols)
    return out.select("customer_id", *[rnd(c, 6) for c in cols[:3]], "constant")


@query(
    "g08_cap_and_standardize",
    f"""WITH {SQL_ORD}, {SQL_RFM_BASE}, c AS (SELECT quantile_cont(monetary, 0.95) AS mc, quantile_cont(recency, 0.95) AS rc FROM rfm),
    k AS (SELECT customer_id, least(monetary, mc) AS m, least(recency, rc) AS r FROM rfm, c)
    SELECT customer_id, {sql_rnd('(m - (SELECT avg(m) FROM k)) / (SELECT stddev_pop(m) FROM k)', 6)} AS monetary_scaled,
    {sql_rnd('(r - (SELECT avg(r) FROM k)) / (SELECT stddev_pop(r) FROM k)', 6)} AS recency_scaled FROM k""",
)
def g08(spark, sf):
    out = G.cap_and_standardize(base(spark, sf), ["monetary", "recency"])
    return out.select("customer_id", rnd("monetary_scaled", 6), rnd("recency_scaled", 6))


@query(
    "g09_interactions",
    f"""WITH {SQL_ORD}, {SQL_RFM_BASE} SELECT customer_id, {sql_rnd('monetary * frequency', 2)} AS monetary_x_frequency,
    {sql_rnd('monetary / (frequency + 1e-6)', 4)} AS monetary_div_frequency FROM rfm""",
)
def g09(spark, sf):
    out = G.interactions(base(spark, sf), [("monetary", "frequency")])
    return out.select("customer_id", rnd("monetary_x_frequency", 2), rnd("monetary_div_frequency", 4))


@query(
    "g10_predictive_features",
    f"""WITH {SQL_TX}, s AS (SELECT customer_id, sum(amount) AS t, avg(amount) AS m, coalesce(stddev_samp(amount), 0) AS sd, max(amount) AS hi, count(*) AS n FROM tx GROUP BY 1)
    SELECT customer_id, count(*) AS lines, {sql_rnd('any_value(sd / (m + 1e-6))', 6)} AS spending_cv, {sql_rnd('any_value(t / n)', 4)} AS revenue_per_transaction,
    CAST(any_value(hi > 2 * m) AS INTEGER) AS is_high_value, min(date_diff('day', purchase_date, (SELECT max(purchase_date) FROM tx))) AS days_since_purchase,
    count(*) FILTER (isodow(purchase_date) >= 6) AS weekend_lines, count(*) FILTER (gender = 'Female') AS "gender_Female",
    {sql_rnd('sum(age * amount)', 2)} AS age_x_amount FROM tx JOIN s USING (customer_id) GROUP BY 1""",
)
def g10(spark, sf):
    tx = lines_view(spark, sf, "customer_id", "purchase_date", "amount", "rating", "age", "gender")
    out = X.predictive_features(tx, encode=["gender"])
    return out.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("lines"),
        rnd(F.max("spending_cv"), 6, "spending_cv"),
        rnd(F.max("revenue_per_transaction"), 4, "revenue_per_transaction"),
        F.max("is_high_value").alias("is_high_value"),
        F.min("days_since_purchase").alias("days_since_purchase"),
        F.sum("purchase_is_weekend").alias("weekend_lines"),
        F.sum("gender_Female").alias("gender_Female"),
        rnd(F.sum("age_x_amount"), 2, "age_x_amount"),
    )


SQL_FEATURES = f"""{SQL_ORD}, {SQL_RFM_BASE}, ft AS (SELECT customer_id, recency, frequency, monetary,
  CAST(customer_id % 53 AS DOUBLE) AS age, CASE WHEN recency > 200 THEN 1 ELSE 0 END AS label FROM rfm)"""


def features(spark, sf):
    return base(spark, sf).select(
        "customer_id", "recency", "frequency", "monetary", (F.col("customer_id") % 53).cast("double").alias("age"),
        F.when(F.col("recency") > 200, 1).otherwise(0).alias("label"),
    )


_FEATS = ["recency", "frequency", "monetary", "age"]


def _sql_ranked(score: str, k: int, prefix: str = SQL_FEATURES) -> str:
    parts = " UNION ALL ".join(f"SELECT '{c}' AS feature, {score.replace('@', c)} AS score FROM ft" for c in _FEATS)
    return (
        f"WITH {prefix}, s AS ({parts}) SELECT feature, {sql_rnd('score', 6)} AS score, "
        f"CAST(row_number() OVER (ORDER BY score DESC, feature) AS INTEGER) AS rank FROM s ORDER BY score DESC LIMIT {k}"
    )


@query("g11_select_by_correlation", _sql_ranked("abs(corr(@, label))", 3))
def g11(spark, sf):
    return G.select_by_correlation(features(spark, sf), _FEATS, "label", 3).select("feature", rnd("score", 6), "rank")


def _sql_mi(c: str) -> str:
    # the three comparisons together name the bin
    edges = f"(SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS q2, quantile_cont({c}, 0.75) AS q3 FROM ft)"
    return f"""(SELECT '{c}' AS feature, sum(n / t * ln(n * t / (nb * ny))) AS score FROM (SELECT n, sum(n) OVER () AS t,
      sum(n) OVER (PARTITION BY a, b, c) AS nb, sum(n) OVER (PARTITION BY y) AS ny FROM (SELECT {c} > q1 AS a, {c} > q2 AS b, {c} > q3 AS c,
      label AS y, count(*)::DOUBLE AS n FROM ft, {edges} GROUP BY ALL)))"""


@query(
    "g12_select_by_mutual_information",
    f"""WITH {SQL_FEATURES}, s AS ({' UNION ALL '.join(_sql_mi(c) for c in _FEATS)})
    SELECT feature, {sql_rnd('score', 6)} AS score, CAST(row_number() OVER (ORDER BY score DESC, feature) AS INTEGER) AS rank FROM s""",
)
def g12(spark, sf):
    out = G.select_by_mutual_information(features(spark, sf), _FEATS, "label", 4, bins=4)
    return out.select("feature", rnd("score", 6), "rank")


@query(
    "g13_select_by_f_score",
    f"""WITH {SQL_FEATURES}, s AS ({' UNION ALL '.join(f'''SELECT '{c}' AS feature, (SELECT sum(n * (m - (SELECT avg({c}) FROM ft)) ** 2) / sum(v)
      * ((SELECT count(*) FROM ft) - count(*)) / (count(*) - 1)
      FROM (SELECT count(*) AS n, avg({c}) AS m, count(*) * var_pop({c}) AS v FROM ft GROUP BY label)) AS score''' for c in _FEATS)})
    SELECT feature, {sql_rnd('score', 4)} AS score, CAST(row_number() OVER (ORDER BY score DESC, feature) AS INTEGER) AS rank FROM s""",
)
def g13(spark, sf):
    return G.select_by_f_score(features(spark, sf), _FEATS, "label", 4).select("feature", rnd("score", 4), "rank")


@query("g14_select_by_variance", _sql_ranked("var_samp(@)", 2).replace(sql_rnd("score", 6), sql_rnd("sqrt(score)", 4)))
def g14(spark, sf):
    out = G.select_by_variance(features(spark, sf), _FEATS, 2)
    return out.select("feature", rnd(F.sqrt("score"), 4, "score"), "rank")


@query(
    "g16_trim_target",
    f"""WITH {SQL_ORD}, {SQL_RFM_BASE}, q AS (SELECT quantile_cont(monetary, 0.01) AS a, quantile_cont(monetary, 0.99) AS b FROM rfm)
    SELECT customer_id, monetary FROM rfm, q WHERE monetary BETWEEN a AND b""",
)
def g16(spark, sf):
    return G.trim_target(base(spark, sf), "monetary").select("customer_id", "monetary")


@query(
    "g15_fill_feature_matrix",
    f"""WITH {SQL_ORD}, {SQL_RFM_BASE}, h AS (SELECT customer_id, nullif(recency, 1) AS recency, CASE WHEN monetary > 900000 THEN monetary END AS monetary FROM rfm)
    SELECT customer_id, coalesce(recency, 0) AS recency, {sql_rnd('coalesce(monetary, (SELECT avg(monetary) FROM h))', 4)} AS monetary FROM h""",
)
def g15(spark, sf):
    from shopsight.operators.clean import impute

    h = base(spark, sf).select(
        "customer_id", F.nullif("recency", F.lit(1).cast("long")).alias("recency"),
        F.when(F.col("monetary") > 900000, F.col("monetary")).alias("monetary"),
    )
    zero = impute(h, ["recency"], [], "zero")
    return impute(zero, ["monetary"], [], "mean").select("customer_id", "recency", rnd("monetary", 4))
