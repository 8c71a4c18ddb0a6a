"""RFM segment ladders and the strategy dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Thresholds on the combined score, highest first, and segment names.
SCORE_LADDERS: dict[str, tuple[list[tuple[int, str]], str]] = {
    "quartile10": (
        [
            (444, "Champions"),
            (334, "Loyal Customers"),
            (313, "Potential Loyalists"),
            (212, "New Customers"),
            (142, "Promising"),
            (122, "Need Attention"),
            (113, "About to Sleep"),
            (112, "At Risk"),
            (111, "Cannot Lose Them"),
        ],
        "Lost",
    ),
    "quintile6": (
        [
            (444, "Champions"),
            (334, "Loyal Customers"),
            (244, "Potential Loyalists"),
            (144, "At Risk"),
            (111, "Cannot Lose Them"),
        ],
        "Lost",
    ),
}


def _rules8(r: Column, f: Column, m: Column) -> list[tuple[Column, str]]:
    return [
        ((r >= 4) & (f >= 4) & (m >= 4), "Champions"),
        ((r >= 3) & (f >= 3) & (m >= 3), "Loyal Customers"),
        ((r >= 4) & (f <= 2), "New Customers"),
        ((r >= 3) & (f <= 2) & (m >= 3), "Potential Loyalists"),
        ((r <= 2) & (f >= 3) & (m >= 3), "At Risk"),
        ((r <= 2) & (f >= 2) & (m <= 2), "Cannot Lose Them"),
        ((r <= 2) & (f <= 2), "Lost Customers"),
        (F.lit(True), "Others"),
    ]


def _rules6(r: Column, f: Column, m: Column) -> list[tuple[Column, str]]:
    return [
        ((r >= 4) & (f >= 4) & (m >= 4), "Champions"),
        ((r >= 3) & (f >= 3), "Loyal Customers"),
        ((r >= 3) & (f <= 2), "Potential Loyalists"),
        ((r <= 2) & (f >= 2), "At Risk"),
        (r <= 2, "Lost Customers"),
        (F.lit(True), "Need Attention"),
    ]


def _documented(r: Column, f: Column, m: Column) -> list[tuple[Column, str]]:
    return [
        ((r == 5) & (f == 5) & (m == 5), "Champions"),
        (r.between(4, 5) & f.between(3, 5) & m.between(3, 5), "Loyal Customers"),
        (F.lit(True), "Others"),
    ]


RULE_LADDERS = {"rules8": _rules8, "rules6": _rules6, "documented": _documented}
LADDERS = (*SCORE_LADDERS, *RULE_LADDERS)


def segment_label(ladder: str, r: str = "r_score", f: str = "f_score", m: str = "m_score") -> Column:
    """Segment name from the three scores under the chosen ladder."""
    rc, fc, mc = F.col(r), F.col(f), F.col(m)
    if ladder in SCORE_LADDERS:
        steps, last = SCORE_LADDERS[ladder]
        score = rc * 100 + fc * 10 + mc
        rules = [(score >= t, name) for t, name in steps] + [(F.lit(True), last)]
    elif ladder in RULE_LADDERS:
        rules = RULE_LADDERS[ladder](rc, fc, mc)
    else:
        raise ValueError(f"unknown ladder: {ladder}")
    expr = None
    for cond, name in rules:
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr


# Description and strategy per segment.
STRATEGIES: list[tuple[str, str, str]] = [
    ("Champions", "Best customers - high value, frequent purchases, recent activity", "Reward and retain"),
    (
        "Loyal Customers",
        "Consistent customers with good value and regular engagement",
        "Maintain relationship and increase value",
    ),
    ("New Customers", "Recent customers with potential for growth", "Nurture and convert to loyal"),
    ("Potential Loyalists", "Customers showing signs of increased engagement", "Develop into loyal customers"),
    ("At Risk", "Previously good customers showing declining engagement", "Win-back campaigns"),
    ("Cannot Lose Them", "High-value customers at risk of churning", "Immediate intervention required"),
    ("Lost Customers", "Customers who have likely churned", "Reactivation or let go"),
]


def strategy_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(STRATEGIES, "segment STRING, description STRING, strategy STRING")


def with_strategy(df: DataFrame, segment: str = "segment") -> DataFrame:
    """Attach description and strategy; the dimension has a fixed handful of rows."""
    dim = strategy_table(df.sparkSession).withColumnRenamed("segment", segment)
    return df.join(F.broadcast(dim), segment, "left")
