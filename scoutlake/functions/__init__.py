"""Pure Column functions: no action, no Python UDF."""

from scoutlake.functions.dates import age_fraction, age_years, parse_date, utc_now_text
from scoutlake.functions.hashing import content_digest, content_hash, content_metrics, row_text, schema_hash, schema_text
from scoutlake.functions.metrics import (
    coalesce_zero,
    contributions_per_90,
    defensive_reliability,
    expected_goals,
    fee_diff,
    impact_score,
    in_millions,
    match_result,
    pct_change,
    per_90,
    ratio_or_zero,
    safe_div,
    score_goals,
    tendency,
    transfer_class,
    truncated_pct,
    upside_value,
)
from scoutlake.functions.text import blank_nulls, clean_name, contains_ci, contains_literal

__all__ = [
    "age_fraction", "age_years", "blank_nulls", "clean_name", "coalesce_zero", "contains_ci",
    "contains_literal", "content_digest", "content_hash", "content_metrics", "contributions_per_90", "defensive_reliability",
    "expected_goals", "fee_diff", "impact_score", "in_millions", "match_result", "parse_date",
    "pct_change", "per_90", "ratio_or_zero", "row_text", "safe_div", "schema_hash", "schema_text",
    "score_goals", "tendency", "transfer_class", "truncated_pct", "upside_value", "utc_now_text",
]
