"""Content-based lists: few texts meet a user's purchases in one task, many texts meet users in blocks."""

import pytest

from shopsight.operators import recommend as L

ROWS = [
    (1, "red shoe", "north", "shoe"), (1, "red shoe", "north", "shoe"), (1, "blue hat", "south", "hat"),
    (2, "blue hat", "south", "hat"), (2, "blue hat", "south", "bag"), (2, None, None, "coat"),
    (3, "green coat", None, "coat"), (3, "green coat", "north", "coat"), (3, "red shoe", "north", None),
    (4, "x", "y", "ring"), (None, "red hat", "north", "hat"), (5, "red coat", "west", "coat"), (5, "x", "y", "ring"),
    *[(6, f"red {w}", "north", k) for w, k in (("shoe", "shoe"), ("hat", "hat"), ("bag", "bag"))] * 40,
    *[(u, f"w{u % 7} w{u % 5} red", "east", f"k{u % 6}") for u in range(10, 400)],
]
SCHEMA = "customer_id long, color string, season string, category string"


@pytest.fixture()
def tx(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(5)


def rows(df):
    found = df.select("user", "item", "score", "rank").collect()
    return sorted((r["user"], r["rank"], r["item"], round(r["score"], 9)) for r in found)


@pytest.mark.parametrize("n", [1, 3, 50])
def test_few_texts_give_the_lists_of_blocks(spark, tx, monkeypatch, n):
    some = spark.createDataFrame([(1,), (3,), (12,), (999,)], "user long")
    features = ["color", "season"]
    few, few_of_some = rows(L.content_based(tx, n, features)), rows(L.content_based(tx, n, features, targets=some))
    monkeypatch.setattr(L, "FEW_TEXTS", 0)
    assert few == rows(L.content_based(tx, n, features))
    assert few_of_some == rows(L.content_based(tx, n, features, targets=some)) == [r for r in few if r[0] in (1, 3, 12)]
    assert few and 4 not in {r[0] for r in few}  # none of whose texts has a word


def test_purchases_cross_batches(spark, tx, monkeypatch):
    want = rows(L.content_based(tx, 3, ["color", "season"]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    monkeypatch.setattr(L, "_USERS_AT_ONCE", 2)
    try:
        assert rows(L.content_based(tx, 3, ["color", "season"])) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_no_purchases_and_no_words(spark, tx):
    assert rows(L.content_based(tx.limit(0), 3, ["color", "season"])) == []
    assert rows(L.content_based(tx, 3, ["color", "season"], min_token_len=30)) == []


def test_few_texts_send_no_candidates(spark, tx):
    """Purchases are dealt by user, once; (user, category) candidates were shuffled and joined before."""
    plan = L.content_based(tx, 3, ["color", "season"])._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroups" not in plan and "LeftAnti" not in plan and plan.count("RepartitionByExpression") <= 1
