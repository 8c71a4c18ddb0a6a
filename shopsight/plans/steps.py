"""Steps by name, for runs that are put together from configuration."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame

from shopsight.operators import clean, features, kpi, lifecycle, profile, rfm, transform

STEPS: dict[str, Callable[..., DataFrame]] = {
    "impute": clean.impute,
    "drop_duplicates": clean.drop_duplicate_rows,
    "standardize_names": clean.standardize_names,
    "parse_dates": clean.parse_dates,
    "label_encode": transform.label_encode,
    "one_hot": transform.one_hot,
    "flag_outliers": transform.flag_outliers,
    "standardize": transform.standardize,
    "interactions": transform.interactions,
    "customer_features": features.customer_features,
    "behavioral_features": features.behavioral_features,
    "time_features": features.time_features,
    "rfm_base": rfm.rfm_base,
    "rfm_segments": rfm.rfm_segments,
    "rfm_derived": rfm.rfm_derived,
    "churn_probability": rfm.churn_probability,
    "clv": rfm.clv,
    "segment_impact": rfm.segment_impact,
    "key_figures": kpi.key_figures,
    "category_performance": kpi.category_performance,
    "basket_pairs": lifecycle.basket_pairs,
    "cohort_revenue": lifecycle.cohort_revenue,
    "retention": lifecycle.retention,
    "quality_report": profile.quality_report,
}


def step(name: str) -> Callable[..., DataFrame]:
    if name not in STEPS:
        raise ValueError(f"unknown step: {name}")
    return STEPS[name]


def apply_steps(df: DataFrame, names: Sequence[str | tuple[str, Mapping[str, Any]]]) -> DataFrame:
    """Chain steps; an entry is a name or ``(name, arguments)``."""
    for entry in names:
        name, args = (entry, {}) if isinstance(entry, str) else entry
        df = df.transform(step(name), **args)
    return df
