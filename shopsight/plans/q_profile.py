"""Profiling, correlation and test queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shopsight.operators import profile as P
from shopsight.operators import stats as S
from shopsight.plans.catalogue import query, rnd, sql_rnd
from shopsight.plans.q_clean import SQL_HOLED, holed
from shopsight.plans.q_rfm import base
from shopsight.plans.retail import SQL_ORD, SQL_RFM_BASE, SQL_TX, lines_view, table
from shopsight.session import materialize

_COLUMNS = {"customer_id": "n", "order_id": "n", "amount": "n", "quantity": "n", "category": "t", "season": "t"}
_NUM = [c for c, k in _COLUMNS.items() if k == "n"]
_TEXT = [c for c, k in _COLUMNS.items() if k == "t"]


def measured(spark, sf):
    """The joined input, computed once for reports that pass over it several times."""
    return materialize(holed(spark, sf))


def _union(fn, columns) -> str:
    return f"WITH {SQL_HOLED} " + " UNION ALL ".join(fn(c) for c in columns)


def _pct(c: str) -> str:
    return sql_rnd(f"count(*) FILTER ({c} IS NULL) * 100.0 / count(*)", 4)


def _num(c: str, expr: str, digits: int = 4) -> str:
    return sql_rnd(expr.replace("@", f"{c}::DOUBLE"), digits) if _COLUMNS[c] == "n" else "NULL::DOUBLE"


def _cnt(c: str, cond: str) -> str:
    return f"count(*) FILTER ({c} {cond})" if _COLUMNS[c] == "n" else "NULL::BIGINT"


def _sql_mode(c: str, what: str, order: str = "DESC") -> str:
    return f"(SELECT {what} FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM holed WHERE {c} IS NOT NULL GROUP BY 1) ORDER BY n {order}, v LIMIT 1)"


def _round(df, digits: dict[str, int]):
    return df.select(*[rnd(c, digits[c]) if c in digits else c for c in df.columns])


@query(
    "i01_quality_report",
    _union(
        lambda c: f"""SELECT '{c}' AS "column", count(*) FILTER ({c} IS NULL) AS missing, {_pct(c)} AS missing_pct, count({c}) = 0 AS is_empty,
        count(DISTINCT {c}) = 1 AS is_single_valued, {_num(c, 'avg(@)')} AS mean, {_num(c, 'stddev_samp(@)')} AS std, {_num(c, 'min(@)')} AS min,
        {_num(c, 'max(@)')} AS max, {_cnt(c, '= 0')} AS zeros, {_cnt(c, '< 0')} AS negatives FROM holed""",
        _COLUMNS,
    ),
)
def i01(spark, sf):
    out = P.quality_report(measured(spark, sf)).drop("data_type")
    return _round(out, {c: 4 for c in ("missing_pct", "mean", "std", "min", "max")})


@query(
    "i01_quality_overview",
    f"""WITH {SQL_HOLED}, d AS (SELECT coalesce(sum(n - 1), 0)::BIGINT AS d FROM (SELECT count(*) AS n FROM holed GROUP BY ALL, customer_id, order_id, amount, quantity, category, season))
    SELECT count(*) AS rows, 6::BIGINT AS columns, ((count(*) - count(quantity)) + (count(*) - count(category)) + (count(*) - count(season)))::BIGINT AS missing_cells,
    {sql_rnd('(1 - ((count(*) - count(quantity)) + (count(*) - count(category)) + (count(*) - count(season))) / (count(*) * 6)) * 100', 6)} AS completeness_pct,
    (SELECT d FROM d) AS duplicate_rows FROM holed""".replace("GROUP BY ALL, ", "GROUP BY "),
)
def i01_overview(spark, sf):
    return _round(P.quality_overview(measured(spark, sf)), {"completeness_pct": 6})


@query(
    "i02_output_validation",
    f"""WITH {SQL_ORD}, {SQL_RFM_BASE} SELECT count(*) AS rows, 5::BIGINT AS columns, 0::BIGINT AS missing_cells, 0::BIGINT AS duplicate_rows,
    5::BIGINT AS numeric_columns, 0::BIGINT AS text_columns, 0::BIGINT AS datetime_columns, true AS has_clusters, count(DISTINCT frequency % 4) AS clusters FROM rfm""",
)
def i02(spark, sf):
    return P.output_validation(base(spark, sf).withColumn("cluster", F.col("frequency") % 4))


@query(
    "i03_quality_table",
    _union(
        lambda c: f"""SELECT '{c}' AS "column", count(*) FILTER ({c} IS NULL) AS missing, {_pct(c)} AS missing_pct, count(DISTINCT {c}) AS "unique" FROM holed""",
        _COLUMNS,
    ),
)
def i03(spark, sf):
    return _round(P.quality_table(measured(spark, sf)).drop("data_type"), {"missing_pct": 4})


def _sql_quartiles(c: str, digits: int) -> str:
    return ", ".join(
        f"{sql_rnd(f'quantile_cont({c}::DOUBLE, {p})', digits)} AS {n}" for n, p in (("q25", 0.25), ("median", 0.5), ("q75", 0.75))
    )


@query(
    "i04_describe_numeric",
    _union(
        lambda c: f"""SELECT '{c}' AS "column", count({c}) AS count, {_num(c, 'avg(@)')} AS mean, {_num(c, 'stddev_samp(@)')} AS std, {_num(c, 'min(@)')} AS min,
        {_num(c, 'max(@)')} AS max, {_sql_quartiles(c, 4)} FROM holed""",
        _NUM,
    ),
)
def i04(spark, sf):
    return _round(P.describe_numeric(measured(spark, sf)), {c: 4 for c in ("mean", "std", "min", "max", "q25", "median", "q75")})


@query(
    "i04_describe_text",
    _union(
        lambda c: f"""SELECT '{c}' AS "column", count({c}) AS count, count(DISTINCT {c}) AS "unique", {_sql_mode(c, 'v')} AS top, {_sql_mode(c, 'n')} AS freq FROM holed""",
        _TEXT,
    ),
)
def i04_text(spark, sf):
    return P.describe_text(measured(spark, sf))


@query(
    "i05_statistical_summary",
    _union(
        lambda c: f"""SELECT '{c}' AS "column", count({c}) AS count, {_num(c, 'avg(@)', 3)} AS mean, {_num(c, 'stddev_samp(@)', 3)} AS std, {_num(c, 'min(@)', 3)} AS min,
        {_num(c, 'max(@)', 3)} AS max, count(*) FILTER ({c} IS NULL) AS missing, {_pct(c)} AS missing_pct, count(DISTINCT {c}) AS "unique",
        {_num(c, 'skewness(@)', 3)} AS skewness, {_num(c, 'kurtosis(@)', 3)} AS kurtosis, {_sql_quartiles(c, 3)} FROM holed""",
        _NUM,
    ),
)
def i05(spark, sf):
    out = P.statistical_summary(measured(spark, sf))
    digits = {c: 3 for c in ("mean", "std", "min", "max", "skewness", "kurtosis", "q25", "median", "q75")}
    return _round(out, {**digits, "missing_pct": 4})


@query(
    "i06_data_profile",
    _union(
        lambda c: f"""SELECT '{c}' AS "column", count({c}) AS non_null, count(*) FILTER ({c} IS NULL) AS null_count, {_pct(c)} AS null_pct, count(DISTINCT {c}) AS "unique",
        {sql_rnd(f'count(DISTINCT {c}) * 100.0 / count(*)', 4)} AS unique_pct, {_num(c, 'min(@)')} AS min, {_num(c, 'max(@)')} AS max, {_num(c, 'avg(@)')} AS mean,
        {_num(c, 'stddev_samp(@)')} AS std, {'NULL::INTEGER' if c in _NUM else f'CAST(min(length({c})) AS INTEGER)'} AS min_length,
        {'NULL::INTEGER' if c in _NUM else f'CAST(max(length({c})) AS INTEGER)'} AS max_length,
        {'NULL::VARCHAR' if c in _NUM else _sql_mode(c, 'v')} AS most_frequent, {'NULL::BIGINT' if c in _NUM else _sql_mode(c, 'n')} AS most_count,
        {'NULL::VARCHAR' if c in _NUM else _sql_mode(c, 'v', 'ASC')} AS least_frequent, {'NULL::BIGINT' if c in _NUM else _sql_mode(c, 'n', 'ASC')} AS least_count FROM holed""",
        _COLUMNS,
    ),
)
def i06(spark, sf):
    return _round(P.data_profile(measured(spark, sf)), {c: 4 for c in ("null_pct", "unique_pct", "min", "max", "mean", "std")})


@query(
    "i07_feature_summary",
    _union(
        lambda c: f"""SELECT '{c}' AS "column", count(*) FILTER ({c} IS NULL) AS missing, count(DISTINCT {c}) AS "unique", {_num(c, 'avg(@)')} AS mean,
        {_num(c, 'stddev_samp(@)')} AS std, {_num(c, 'min(@)')} AS min, {_num(c, 'max(@)')} AS max, {_num(c, 'quantile_cont(@, 0.5)')} AS median,
        {'NULL::VARCHAR' if c in _NUM else _sql_mode(c, 'v')} AS most_frequent, {'NULL::BIGINT' if c in _NUM else _sql_mode(c, 'n')} AS frequency FROM holed""",
        _COLUMNS,
    ),
)
def i07(spark, sf):
    return _round(P.feature_summary(measured(spark, sf)), {c: 4 for c in ("mean", "std", "min", "max", "median")})


@query(
    "i08_feature_statistics",
    _union(
        lambda c: f"""SELECT '{c}' AS feature, '{'numeric' if c in _NUM else 'categorical'}' AS kind, {_pct(c)} AS missing_pct, count(DISTINCT {c}) AS "unique",
        {_num(c, 'avg(@)')} AS mean, {_num(c, 'stddev_samp(@)')} AS std, {_num(c, 'var_samp(@)', 1)} AS variance, {_num(c, 'skewness(@)')} AS skewness,
        {_num(c, 'kurtosis(@)')} AS kurtosis, {'NULL::VARCHAR' if c in _NUM else _sql_mode(c, 'v')} AS most_frequent FROM holed""",
        _COLUMNS,
    ),
)
def i08(spark, sf):
    out = P.feature_statistics(measured(spark, sf))
    return _round(out, {"missing_pct": 4, "mean": 4, "std": 4, "variance": 1, "skewness": 4, "kurtosis": 4})


@query(
    "i09_completeness",
    f"""WITH {SQL_HOLED} SELECT count(*) AS rows, 6::BIGINT AS columns, 4::BIGINT AS numeric_columns, 2::BIGINT AS text_columns,
    ((count(*) - count(quantity)) + (count(*) - count(category)) + (count(*) - count(season)))::BIGINT AS missing_cells,
    {sql_rnd('(1 - ((count(*) - count(quantity)) + (count(*) - count(category)) + (count(*) - count(season))) / (count(*) * 6)) * 100', 6)} AS completeness_pct FROM holed""",
)
def i09(spark, sf):
    return _round(P.completeness(holed(spark, sf)), {"completeness_pct": 6})


_CORR = ["amount", "quantity", "price", "age"]
_PAIRS = [(a, b) for i, a in enumerate(_CORR) for b in _CORR[i + 1 :]]


def corr_input(spark, sf):
    return lines_view(spark, sf, *_CORR).withColumn("quantity", F.nullif("quantity", F.lit(13.0)))


SQL_CORR = f"{SQL_TX}, cx AS (SELECT amount, nullif(quantity, 13) AS quantity, price, age::DOUBLE AS age FROM tx)"


@query(
    "i10_pearson_matrix",
    f"WITH {SQL_CORR} "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, {sql_rnd(f'corr({a}, {b})', 8)} AS correlation FROM cx"
        for a, b in _PAIRS + [(b, a) for a, b in _PAIRS]
    )
    + "".join(f" UNION ALL SELECT '{c}', '{c}', 1.0::DOUBLE" for c in _CORR),
)
def i10(spark, sf):
    out = S.full_matrix(S.pearson(corr_input(spark, sf), _CORR), _CORR)
    return out.select("column_a", "column_b", F.when(F.col("column_a") == F.col("column_b"), 1.0).otherwise(rnd(F.col("correlation"), 8)).alias("correlation"))


def _sql_spearman() -> str:
    ranks = ", ".join(
        f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2 AS r_{c}" for c in _CORR
    )
    pairs = " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, {sql_rnd(f'corr(r_{a}, r_{b})', 7)} AS correlation FROM rk" for a, b in _PAIRS
    )
    return f"WITH {SQL_CORR}, rk AS (SELECT {ranks} FROM cx WHERE quantity IS NOT NULL) {pairs}"


@query("i11_spearman", _sql_spearman())
def i11(spark, sf):
    return S.spearman(corr_input(spark, sf), _CORR).select("column_a", "column_b", rnd("correlation", 7))


@query(
    "i12_kendall",
    """WITH t AS (SELECT l_quantity AS a, l_tax AS b, count(*)::DOUBLE AS n FROM lineitem GROUP BY 1, 2),
    p AS (SELECT sum(CASE WHEN (x.a - y.a) * (x.b - y.b) > 0 THEN x.n * y.n ELSE 0 END) / 2 AS c,
      sum(CASE WHEN (x.a - y.a) * (x.b - y.b) < 0 THEN x.n * y.n ELSE 0 END) / 2 AS d FROM t x, t y),
    k AS (SELECT sum(n) AS n FROM t), ta AS (SELECT sum(n * (n - 1) / 2) AS t FROM (SELECT sum(n) AS n FROM t GROUP BY a)),
    tb AS (SELECT sum(n * (n - 1) / 2) AS t FROM (SELECT sum(n) AS n FROM t GROUP BY b))
    SELECT 'l_quantity' AS column_a, 'l_tax' AS column_b, """
    + sql_rnd("(c - d) / sqrt((n * (n - 1) / 2 - ta.t) * (n * (n - 1) / 2 - tb.t))", 8)
    + " AS correlation FROM p, k, ta, tb",
)
def i12(spark, sf):
    out = S.kendall_matrix(table(spark, sf, "lineitem"), ["l_quantity", "l_tax"])
    return out.select("column_a", "column_b", rnd("correlation", 8))


@query(
    "i12_kendall_continuous",
    """WITH c AS (SELECT o_custkey, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS a, max(o_totalprice) AS b FROM orders GROUP BY 1),
    p AS (SELECT count(*) FILTER ((x.a - y.a) * (x.b - y.b) > 0)::DOUBLE AS c, count(*) FILTER ((x.a - y.a) * (x.b - y.b) < 0)::DOUBLE AS d,
      count(*) FILTER (x.a <> y.a)::DOUBLE AS na, count(*) FILTER (x.b <> y.b)::DOUBLE AS nb FROM c x, c y)
    SELECT 'spent' AS column_a, 'largest' AS column_b, """
    + sql_rnd("(c - d) / sqrt(na * nb)", 8)
    + " AS correlation FROM p",
)
def i12_continuous(spark, sf):
    """Two columns whose values hardly ever repeat."""
    orders = table(spark, sf, "orders")
    spent = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("spent")
    per = orders.groupBy("o_custkey").agg(spent, F.max("o_totalprice").alias("largest"))
    return S.kendall_matrix(per, ["spent", "largest"]).select("column_a", "column_b", rnd("correlation", 8))


@query(
    "i13_strong_pairs",
    f"WITH {SQL_CORR}, c AS ("
    + " UNION ALL ".join(f"SELECT '{a}' AS column_a, '{b}' AS column_b, corr({a}, {b}) AS r FROM cx" for a, b in _PAIRS)
    + f") SELECT column_a, column_b, {sql_rnd('r', 8)} AS correlation FROM c WHERE abs(r) > 0.5",
)
def i13(spark, sf):
    return S.strong_pairs(S.pearson(corr_input(spark, sf), _CORR)).select("column_a", "column_b", rnd("correlation", 8))


def sql_t_p(t: str, dof: str) -> str:
    """Two-sided p-value of Student's t: Simpson's rule over the density from 0 to |t|."""
    density = f"exp(lgamma(({dof} + 1) / 2) - lgamma({dof} / 2)) / sqrt({dof} * pi()) * (1 + x * x / {dof}) ** (-({dof} + 1) / 2)"
    weight = "CASE WHEN k IN (0, 4000) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END"
    return (
        f"greatest(0, 1 - 2 * (SELECT sum({weight} * {density}) * abs({t}) / 12000 "
        f"FROM (SELECT k, k * abs({t}) / 4000.0::DOUBLE AS x FROM range(4001) r(k))))"
    )


@query(
    "i14_two_sample_t_test",
    f"""WITH {SQL_TX}, g AS (SELECT count(amount) FILTER (gender = 'Male') AS n1, avg(amount) FILTER (gender = 'Male') AS m1, var_samp(amount) FILTER (gender = 'Male') AS v1,
    count(amount) FILTER (gender = 'Female') AS n2, avg(amount) FILTER (gender = 'Female') AS m2, var_samp(amount) FILTER (gender = 'Female') AS v2 FROM tx)
    , t AS (SELECT *, (m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1 / n1 + 1 / n2)) AS t, (n1 + n2 - 2)::DOUBLE AS dof FROM g),
    p AS (SELECT *, {sql_t_p('t.t', 't.dof')} AS p FROM t)
    SELECT 'Male' AS group_a, 'Female' AS group_b, {sql_rnd('m1', 4)} AS mean_a, {sql_rnd('m2', 4)} AS mean_b,
    {sql_rnd('t', 6)} AS t_statistic, {sql_rnd('p', 6)} AS p_value, p < 0.05 AS significant FROM p""",
)
def i14(spark, sf):
    out = S.two_sample_t(lines_view(spark, sf, "amount", "gender"), "amount", "gender", "Male", "Female")
    return out.select(
        "group_a", "group_b", rnd("mean_a", 4), rnd("mean_b", 4), rnd("t_statistic", 6), rnd("p_value", 6), "significant"
    )


@query(
    "i15_pearson_test",
    f"""WITH {SQL_TX}, c AS (SELECT count(*) AS n, corr(age::DOUBLE, amount) AS r FROM tx), d AS (SELECT corr(quantity, price) AS r FROM tx),
    t AS (SELECT c.n, c.r, c.r * sqrt((c.n - 2) / (1 - c.r * c.r)) AS t, (c.n - 2)::DOUBLE AS dof FROM c), p AS (SELECT *, {sql_t_p('t.t', 't.dof')} AS p FROM t)
    SELECT p.n, {sql_rnd('p.r', 8)} AS age_amount, {sql_rnd('p.p', 6)} AS age_amount_p,
    CASE WHEN p.p < 0.05 AND abs(p.r) > 0.3 THEN 'strong' WHEN p.p < 0.05 AND abs(p.r) > 0.1 THEN 'weak' ELSE 'none' END AS age_amount_verdict,
    {sql_rnd('d.r', 8)} AS quantity_price,
    CASE WHEN d.r > 0.3 THEN 'strong positive' WHEN d.r > 0.1 THEN 'weak positive' ELSE 'none' END AS quantity_price_verdict FROM p, d""",
)
def i15(spark, sf):
    tx = lines_view(spark, sf, "age", "amount", "quantity", "price")
    strength = F.regexp_extract("verdict", "^\\w+", 0).alias("age_amount_verdict")
    a = S.pearson_test(tx, "age", "amount").select(
        "n", rnd("correlation", 8, "age_amount"), rnd("p_value", 6, "age_amount_p"), strength
    )
    b = S.pearson_test(tx, "quantity", "price").select(
        "n", rnd("correlation", 8, "quantity_price"), F.col("verdict").alias("quantity_price_verdict")
    )
    return a.join(b, "n")


@query(
    "i16_normality",
    f"""WITH {SQL_TX}, m AS (SELECT count(*)::DOUBLE AS n, avg(amount) AS u FROM tx),
    s AS (SELECT avg((amount - u) ** 2) AS m2, avg((amount - u) ** 3) AS m3, avg((amount - u) ** 4) AS m4 FROM tx, m),
    j AS (SELECT n, n / 6 * ((m3 / m2 ** 1.5) ** 2 + (m4 / m2 ** 2 - 3) ** 2 / 4) AS jb FROM m, s)
    SELECT 'amount' AS "column", n::BIGINT AS n, {sql_rnd('jb', 4)} AS statistic, exp(-jb / 2) > 0.05 AS is_normal FROM j""",
)
def i16(spark, sf):
    return S.normality(lines_view(spark, sf, "amount"), ["amount"]).select("column", "n", rnd("statistic", 4), "is_normal")


@query(
    "e_rfm_score_correlation",
    f"""WITH {SQL_ORD}, {SQL_RFM_BASE} SELECT 'recency' AS column_a, 'frequency' AS column_b, {sql_rnd('corr(recency, frequency)', 8)} AS correlation FROM rfm
    UNION ALL SELECT 'recency', 'monetary', {sql_rnd('corr(recency, monetary)', 8)} FROM rfm UNION ALL SELECT 'frequency', 'monetary', {sql_rnd('corr(frequency, monetary)', 8)} FROM rfm""",
)
def e_corr(spark, sf):
    return S.pearson(base(spark, sf), ["recency", "frequency", "monetary"]).select("column_a", "column_b", rnd("correlation", 8))
