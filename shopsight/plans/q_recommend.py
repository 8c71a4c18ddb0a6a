"""Recommendation queries: items are brands, ratings the quantity-based proxy."""

from __future__ import annotations

from pyspark.sql import functions as F

from shopsight.operators import recommend as L
from shopsight.plans.catalogue import query, rnd, sql_rnd
from shopsight.plans.q_rfm import segments, sql_segments
from shopsight.plans.retail import SQL_TX, lines_view, table
from shopsight.session import materialize

SQL_RATED = f"{SQL_TX}, rt AS (SELECT customer_id AS u, item AS i, avg(rating) AS r FROM tx GROUP BY 1, 2)"


def rated(spark, sf):
    """Mean rating per customer and brand, computed once for the jobs that follow."""
    return materialize(L.ratings(lines_view(spark, sf, "customer_id", "item", "rating")))


@query("l01_user_item_ratings", f"WITH {SQL_RATED} SELECT u AS \"user\", i AS item, {sql_rnd('r', 8)} AS rating FROM rt")
def l01(spark, sf):
    return L.ratings(lines_view(spark, sf, "customer_id", "item", "rating")).select("user", "item", rnd("rating", 8))


@query(
    "l01_matrix_statistics",
    f"""WITH {SQL_RATED} SELECT count(DISTINCT u) AS users, count(DISTINCT i) AS items, count(*) AS entries,
    {sql_rnd('count(*) / (count(DISTINCT u) * count(DISTINCT i))', 8)} AS density FROM rt""",
)
def l01_stats(spark, sf):
    out = L.matrix_statistics(L.ratings(lines_view(spark, sf, "customer_id", "item", "rating")))
    return out.select("users", "items", "entries", rnd("density", 8))


SQL_USER_SIM = f"""{SQL_RATED}, un AS (SELECT u, sqrt(sum(r * r)) AS n FROM rt GROUP BY 1),
ud AS (SELECT a.u AS u, b.u AS v, sum(a.r * b.r) AS d FROM rt a JOIN rt b ON a.i = b.i AND a.u <> b.u GROUP BY 1, 2),
us AS (SELECT ud.u, ud.v, d / (x.n * y.n) AS s FROM ud JOIN un x ON x.u = ud.u JOIN un y ON y.u = ud.v)"""


def sql_top(source: str, n: int = 5, group: str = "u", item: str = "i") -> str:
    return f"""(SELECT *, CAST(row_number() OVER (PARTITION BY {group} ORDER BY round(s, 12) DESC, {item}) AS INTEGER) AS rank FROM {source}) WHERE rank <= {n}"""


@query(
    "l02_user_based",
    f"""WITH {SQL_USER_SIM}, sc AS (SELECT us.u, rt.i, sum(s * r) / sum(s) AS s FROM us JOIN rt ON rt.u = us.v WHERE s > 0.1
      AND NOT EXISTS (SELECT 1 FROM rt o WHERE o.u = us.u AND o.i = rt.i) GROUP BY 1, 2)
    SELECT u AS "user", i AS item, {sql_rnd('s', 8)} AS score, rank FROM {sql_top('sc')}""",
)
def l02(spark, sf):
    return L.user_based(rated(spark, sf)).select("user", "item", rnd("score", 8), "rank")


@query(
    "l07_similar_users",
    f"""WITH {SQL_USER_SIM} SELECT u AS "user", v AS other, {sql_rnd('s', 8)} AS similarity, rank FROM {sql_top('us', 5, 'u', 'v')}""",
)
def l07(spark, sf):
    return L.similar_users(rated(spark, sf)).select("user", "other", rnd("similarity", 8), "rank")


@query(
    "l07_similar_users_jaccard",
    f"""WITH {SQL_RATED}, c AS (SELECT u, count(*) AS n FROM rt GROUP BY 1),
    p AS (SELECT a.u AS u, b.u AS v, count(*) AS k FROM rt a JOIN rt b ON a.i = b.i AND a.u <> b.u GROUP BY 1, 2),
    j AS (SELECT p.u, p.v, k, k / (x.n + y.n - k) AS s FROM p JOIN c x ON x.u = p.u JOIN c y ON y.u = p.v)
    SELECT u AS "user", v AS other, {sql_rnd('s', 8)} AS similarity, k AS common_items, rank FROM {sql_top('j', 3, 'u', 'v')}""",
)
def l07_jaccard(spark, sf):
    r = rated(spark, sf)
    out = L.similar_users_by_items(r, r.select("user").distinct(), 3)
    return out.select("user", "other", rnd("similarity", 8), "common_items", "rank")


SQL_ITEM_SIM = f"""{SQL_RATED}, nn AS (SELECT i, sqrt(sum(r * r)) AS n FROM rt GROUP BY 1),
sim AS (SELECT a.i AS a, b.i AS b, sum(a.r * b.r) / (any_value(x.n) * any_value(y.n)) AS s, count(*) AS common FROM rt a JOIN rt b ON a.u = b.u AND a.i <> b.i
  JOIN nn x ON x.i = a.i JOIN nn y ON y.i = b.i GROUP BY 1, 2)"""


@query(
    "l03_item_similarity",
    f"WITH {SQL_ITEM_SIM} SELECT a AS item_a, b AS item_b, {sql_rnd('s', 8)} AS cosine, common FROM sim WHERE a < b",
)
def l03_similarity(spark, sf):
    return L.item_similarity(rated(spark, sf)).select("item_a", "item_b", rnd("cosine", 8), "common")


def sql_item_scores(rt: str = "rt") -> str:
    return f"""(SELECT {rt}.u, sim.a AS i, sum(abs(sim.s) * r) / sum(abs(sim.s)) AS s FROM {rt} JOIN sim ON sim.b = {rt}.i
      WHERE NOT EXISTS (SELECT 1 FROM {rt} o WHERE o.u = {rt}.u AND o.i = sim.a) GROUP BY 1, 2)"""


SQL_L03 = f"WITH {SQL_ITEM_SIM}, sc AS {sql_item_scores()} SELECT u AS \"user\", i AS item, {sql_rnd('s', 8)} AS score, rank FROM {sql_top('sc')}"


@query("l03_item_based", SQL_L03)
def l03(spark, sf):
    return L.item_based(rated(spark, sf)).select("user", "item", rnd("score", 8), "rank")


@query("l03_item_based_by_join", SQL_L03)
def l03_join(spark, sf):
    return L.item_based(rated(spark, sf), None).filter("rank <= 5").select("user", "item", rnd("score", 8), "rank")


@query("l04_matrix_factorization")
def l04(spark, sf):
    return L.matrix_factorization(rated(spark, sf), 5, 10)


@query(
    "l04_full_rank_scores",
    f"""WITH {SQL_RATED}, u AS (SELECT DISTINCT u FROM rt), i AS (SELECT DISTINCT i FROM rt),
    sc AS (SELECT u.u, i.i, 0.0::DOUBLE AS s FROM u, i WHERE NOT EXISTS (SELECT 1 FROM rt WHERE rt.u = u.u AND rt.i = i.i))
    SELECT u AS "user", i AS item, 0.0::DOUBLE AS score FROM sc""",
)
def l04_full(spark, sf):
    """With every component kept the matrix is reproduced, so unrated items score zero."""
    out = L.matrix_factorization(rated(spark, sf), components=10_000, all_scores=True)
    return out.select("user", "item", F.abs(F.round("score", 6)).alias("score"))


def _sql_projector(name: str, gram: str, squarings: int = 14) -> str:
    """The projector on a Gram matrix's first eigenvector: the matrix is squared again and again."""
    return f"""{name}_steps AS (SELECT 0 AS step, i, j, v / (SELECT sum(v) FROM {gram} WHERE i = j) AS v FROM {gram}
      UNION ALL SELECT a.step + 1, a.i, b.j, sum(a.v * b.v) / sum(sum(CASE WHEN a.i = b.j THEN a.v * b.v ELSE 0 END)) OVER ()
      FROM {name}_steps a JOIN {name}_steps b ON a.j = b.i WHERE a.step < {squarings} GROUP BY a.step, a.i, b.j),
    {name} AS (SELECT i, j, v FROM {name}_steps WHERE step = {squarings})"""


@query(
    "l04_truncated_scores",
    f"""WITH RECURSIVE {SQL_RATED},
    g1 AS (SELECT a.i AS i, b.i AS j, sum(a.r * b.r) AS v FROM rt a JOIN rt b ON a.u = b.u GROUP BY 1, 2),
    {_sql_projector("p1", "g1")},
    g2 AS (SELECT g1.i, g1.j, g1.v - p1.v * (SELECT sum(g.v * p.v) FROM g1 g JOIN p1 p ON p.i = g.i AND p.j = g.j) AS v
      FROM g1 JOIN p1 ON p1.i = g1.i AND p1.j = g1.j),
    {_sql_projector("p2", "g2")},
    sc AS (SELECT rt.u, p1.j AS i, sum(rt.r * (p1.v + p2.v)) AS s FROM rt JOIN p1 ON p1.i = rt.i
      JOIN p2 ON p2.i = p1.i AND p2.j = p1.j
      WHERE NOT EXISTS (SELECT 1 FROM rt o WHERE o.u = rt.u AND o.i = p1.j) GROUP BY 1, 2)
    SELECT u AS "user", i AS item, {sql_rnd('s', 6)} AS score, rank FROM {sql_top('sc')}""",
)
def l04_truncated(spark, sf):
    """Scores from the first two factors."""
    return L.matrix_factorization(rated(spark, sf), 5, 2).select("user", "item", rnd("score", 6), "rank")


@query("l04_als_large_catalogue")
def l04_als(spark, sf):
    li = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    r = li.groupBy(F.col("o_custkey").cast("int").alias("user"), F.col("l_partkey").cast("int").alias("item")).agg(
        F.avg(1 + 4 * (F.col("l_quantity") - 1) / 49).alias("rating")
    )
    return L.als_recommendations(materialize(r), n=3, rank=5)


_CONTENT = ["item", "season", "color", "size"]


def content_tx(spark, sf):
    return lines_view(spark, sf, "customer_id", *_CONTENT)


SQL_CONTENT = f"""{SQL_TX}, tt AS (SELECT customer_id AS u, item AS cat, concat_ws(' ', item, season, color, size) AS t FROM tx),
txt AS (SELECT DISTINCT t, cat FROM tt), tok AS (SELECT t, w, count(*) AS tf FROM (SELECT t, unnest(regexp_extract_all(lower(t), '\\w{{2,}}')) AS w FROM txt) GROUP BY 1, 2),
dfq AS (SELECT w, ln((1 + (SELECT count(*) FROM txt)) / (1 + count(*))) + 1 AS idf FROM tok GROUP BY 1),
raw AS (SELECT t, tok.w, tf * idf AS x FROM tok JOIN dfq ON dfq.w = tok.w), ln AS (SELECT t, sqrt(sum(x * x)) AS n FROM raw GROUP BY 1),
tv AS (SELECT raw.t, w, x / n AS x FROM raw JOIN ln ON ln.t = raw.t)"""


@query("l05_tfidf_weights", f"WITH {SQL_CONTENT} SELECT t AS content, w AS token, {sql_rnd('x', 8)} AS weight FROM tv")
def l05_tfidf(spark, sf):
    texts = L.content_texts(content_tx(spark, sf), _CONTENT, "item")
    return L.tfidf(texts).select("content", "token", rnd("weight", 8))


SQL_CONTENT_SCORES = f"""{SQL_CONTENT}, cnt AS (SELECT u, t, count(*) AS c FROM tt GROUP BY 1, 2), pf AS (SELECT u, w, sum(c * x) AS x FROM cnt JOIN tv USING (t) GROUP BY 1, 2),
pn AS (SELECT u, sqrt(sum(x * x)) AS n FROM pf GROUP BY 1), bought AS (SELECT DISTINCT u, cat FROM tt), us AS (SELECT DISTINCT u FROM tt), cs AS (SELECT DISTINCT cat FROM txt),
todo AS (SELECT us.u, cs.cat FROM us, cs WHERE NOT EXISTS (SELECT 1 FROM bought b WHERE b.u = us.u AND b.cat = cs.cat)),
dots AS (SELECT todo.u, todo.cat, txt.t, sum(pf.x * tv.x) AS d FROM todo JOIN txt ON txt.cat = todo.cat JOIN tv ON tv.t = txt.t JOIN pf ON pf.u = todo.u AND pf.w = tv.w GROUP BY 1, 2, 3),
sc AS (SELECT dots.u, cat AS i, max(d / n) AS s FROM dots JOIN pn ON pn.u = dots.u GROUP BY 1, 2)"""


@query(
    "l05_content_based",
    f"WITH {SQL_CONTENT_SCORES} SELECT u AS \"user\", i AS item, {sql_rnd('s', 6)} AS score, rank FROM {sql_top('sc')}",
)
def l05(spark, sf):
    out = L.content_based(content_tx(spark, sf), 5, _CONTENT, "item")
    return out.select("user", "item", rnd("score", 6), "rank")


@query("l06_hybrid")
def l06(spark, sf):
    cf = L.item_based(rated(spark, sf), 10)
    return L.hybrid(cf, L.content_based(content_tx(spark, sf), 10, _CONTENT, "item"), 5)


@query(
    "l06_hybrid_of_two_lists",
    f"""WITH {SQL_ITEM_SIM}, sc AS {sql_item_scores()}, pop AS (SELECT i, avg(r) AS p FROM rt GROUP BY 1),
    b AS (SELECT sc.u, sc.i, pop.p AS s FROM sc JOIN pop ON pop.i = sc.i),
    ta AS (SELECT u, i, s FROM {sql_top('sc', 10)}), tb AS (SELECT u, i, s FROM {sql_top('b', 10)}),
    na AS (SELECT u, i, (s - min(s) OVER (PARTITION BY u)) / (max(s) OVER (PARTITION BY u) - min(s) OVER (PARTITION BY u) + 1e-6) AS x FROM ta),
    nb AS (SELECT u, i, (s - min(s) OVER (PARTITION BY u)) / (max(s) OVER (PARTITION BY u) - min(s) OVER (PARTITION BY u) + 1e-6) AS x FROM tb),
    h AS (SELECT u, i, 0.6::DOUBLE * coalesce(na.x, 0) + 0.4::DOUBLE * coalesce(nb.x, 0) AS s FROM na FULL JOIN nb USING (u, i))
    SELECT u AS "user", i AS item, {sql_rnd('s', 5)} AS score FROM h""",
)
def l06_lists(spark, sf):
    """All merged scores of the item-based list and a popularity list."""
    r = rated(spark, sf)
    cf = materialize(L.item_based(r, 10))
    popularity = r.groupBy("item").agg(F.avg("rating").alias("score"))
    everything = materialize(L.item_based(r, None))
    other = everything.select("user", "item").join(popularity, "item")
    return L.hybrid(cf, other, n=20, keep=10).select("user", "item", rnd("score", 5))


@query(
    "l08_segment_popularity",
    f"""{sql_segments('rules8', 5)}, {SQL_TX}, p AS (SELECT segment, category, avg(rating) AS r, avg(amount) AS a, count(*) AS n FROM tx JOIN seg USING (customer_id) GROUP BY 1, 2),
    q AS (SELECT segment, category AS i, 0.4::DOUBLE * r / 5 + 0.3::DOUBLE * n / max(n) OVER (PARTITION BY segment) + 0.3::DOUBLE * a / max(a) OVER (PARTITION BY segment) AS s FROM p)
    SELECT segment, i AS item, {sql_rnd('s', 8)} AS score, rank FROM {sql_top('q', 3, 'segment')}""",
)
def l08(spark, sf):
    tx = lines_view(spark, sf, "customer_id", "category", "rating", "amount")
    tagged = tx.join(segments(spark, sf).select("customer_id", "segment"), "customer_id")
    return L.segment_popularity(tagged, n=3).select("segment", "item", rnd("score", 8), "rank")


# The item-based lists learned from the training pairs, judged on the held-out ones.
SQL_LISTS = f"""{SQL_TX}, every AS (SELECT customer_id AS u, item AS i, avg(rating) AS r FROM tx GROUP BY 1, 2),
held AS (SELECT *, ('0x' || substr(md5(concat_ws('|', u, i, '42')), 1, 8))::BIGINT % 100 < 20 AS h FROM every), rt AS (SELECT u, i, r FROM held WHERE NOT h),
nn AS (SELECT i, sqrt(sum(r * r)) AS n FROM rt GROUP BY 1),
sim AS (SELECT a.i AS a, b.i AS b, sum(a.r * b.r) / (any_value(x.n) * any_value(y.n)) AS s FROM rt a JOIN rt b ON a.u = b.u AND a.i <> b.i
  JOIN nn x ON x.i = a.i JOIN nn y ON y.i = b.i GROUP BY 1, 2),
sc AS {sql_item_scores()}, rec AS (SELECT u, i, rank FROM {sql_top('sc', 5)}), act AS (SELECT u, i FROM held WHERE h),
lm AS (SELECT u, count(*) FILTER (rec.i IS NOT NULL AND act.i IS NOT NULL) AS hits, count(rec.i) AS l, count(act.i) AS a FROM rec FULL JOIN act USING (u, i) GROUP BY 1),
pr AS (SELECT *, CASE WHEN l > 0 THEN hits / l ELSE 0 END AS p, CASE WHEN a > 0 THEN hits / a ELSE 0 END AS r FROM lm)"""


def lists(spark, sf):
    train, test = L.holdout_split(rated(spark, sf))
    return test.select("user", "item"), materialize(L.item_based(train, 5))


@query(
    "l10_list_metrics",
    f"""WITH {SQL_LISTS} SELECT u AS "user", hits, {sql_rnd('p', 8)} AS precision, {sql_rnd('r', 8)} AS recall,
    {sql_rnd('CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END', 8)} AS f1_score, CASE WHEN l > 0 THEN 1.0::DOUBLE ELSE 0 END AS coverage FROM pr""",
)
def l10(spark, sf):
    out = L.list_metrics(*lists(spark, sf))
    return out.select("user", "hits", rnd("precision", 8), rnd("recall", 8), rnd("f1_score", 8), "coverage")


@query(
    "l09_evaluate_lists",
    f"""WITH {SQL_LISTS}, e AS (SELECT avg(p) AS p, avg(r) AS r, count(*) AS n FROM pr WHERE a >= 2 AND l > 0)
    SELECT {sql_rnd('p', 8)} AS precision, {sql_rnd('r', 8)} AS recall, n AS users_evaluated, {sql_rnd('2 * p * r / (p + r)', 8)} AS f1_score FROM e""",
)
def l09(spark, sf):
    return L.evaluate(*lists(spark, sf)).select(rnd("precision", 8), rnd("recall", 8), "users_evaluated", rnd("f1_score", 8))


@query("l11_method_evaluation")
def l11(spark, sf):
    tx = lines_view(spark, sf, "customer_id", "rating", *_CONTENT)
    return L.train_and_compare(tx)


@query("l12_multi_method_recommendations")
def l12(spark, sf):
    r = rated(spark, sf)
    lists_ = {"item_based": L.item_based(r, 5), "svd": L.matrix_factorization(r, 5, 10)}
    return L.multi_method(lists_)


@query(
    "l12_filtered_recommendations",
    f"""WITH {SQL_ITEM_SIM}, sc AS {sql_item_scores()}, ok AS (SELECT DISTINCT p_brand AS i FROM part WHERE p_type IN ('ECONOMY', 'PROMO') AND p_retailprice BETWEEN 900 AND 905)
    SELECT u AS "user", i AS item, {sql_rnd('s', 8)} AS score FROM {sql_top('sc')} AND i IN (SELECT i FROM ok)""",
)
def l12_filtered(spark, sf):
    items = table(spark, sf, "part").select(
        F.col("p_brand").alias("item"), F.col("p_type").alias("category"), F.col("p_retailprice").alias("price")
    )
    recs = L.item_based(rated(spark, sf), 5)
    out = L.with_item_filters(recs, items, ["ECONOMY", "PROMO"], (900, 905))
    return out.select("user", "item", rnd("score", 8))
