"""Rates, guarded arithmetic and football metrics."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MILLION = 1_000_000.0


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def safe_div(x: Column | str, y: Column | str, digits: int | None = None) -> Column:
    """x / y as a double, null where y is 0 or null."""
    quotient = _column(x).cast("double") / F.nullif(_column(y).cast("double"), F.lit(0.0))
    return quotient if digits is None else F.round(quotient, digits)


def ratio_or_zero(x: Column | str, y: Column | str) -> Column:
    """x / y with a zero divisor taken as 1 and a null result taken as 0."""
    y = _column(y).cast("double")
    divisor = F.when(y == 0, F.lit(1.0)).otherwise(y)
    return F.coalesce(_column(x).cast("double") / divisor, F.lit(0.0))


def per_90(x: Column | str, minutes: Column | str, digits: int | None = None) -> Column:
    """Rate of x per 90 minutes, null without minutes."""
    rate = safe_div(x, minutes) * 90
    return rate if digits is None else F.round(rate, digits)


def in_millions(x: Column | str, digits: int | None = None) -> Column:
    scaled = _column(x) / F.lit(MILLION)
    return scaled if digits is None else F.round(scaled, digits)


def coalesce_zero(x: Column | str, kind: str = "int") -> Column:
    return F.coalesce(_column(x), F.lit(0)).cast(kind)


def pct_change(value: Column | str, previous: Column | str, digits: int | None = 2) -> Column:
    """Change against `previous` in percent; null unless `previous` is above 0."""
    value, previous = _column(value).cast("double"), _column(previous).cast("double")
    change = (value - previous) / previous * 100
    return F.when(previous > 0, change if digits is None else F.round(change, digits))


def truncated_pct(part: Column, whole: Column) -> Column:
    """Whole percent, fraction cut off: 2 of 3 is 66."""
    return F.call_function("div", part * 100, whole)


def match_result(own: Column | str, other: Column | str) -> Column:
    """win / loss seen from `own`; anything undecided, missing goals included, is a draw."""
    own, other = _column(own), _column(other)
    return F.when(own > other, "win").when(own < other, "loss").otherwise("draw")


def transfer_class(fee: Column | str) -> Column:
    fee = _column(fee)
    return F.when(fee.isNull(), "unknown").when(fee == 0, "free/loan").otherwise("paid")


def fee_diff(fee: Column | str, market: Column | str, digits: int = 2) -> Column:
    """Fee above market value; null when either is null."""
    return F.round(_column(fee) - _column(market), digits)


# Weights of the scouting metrics.
TACKLE_WEIGHT = 2.0
INTERCEPTION_WEIGHT = 1.5
PASS_WEIGHT = 2.0
KEEPER_PASS_WEIGHT = 5.0
KEEPER_RED_CARD_PENALTY = 3.0
ATTACK_WEIGHTS = {"goals": 2.0, "assists": 1.5}
MIDFIELD_WEIGHTS = {"goals": 1.5, "assists": 1.5}
LAST_AGE_WITH_UPSIDE = 29


def _weighted(goals: Column, assists: Column, weights: dict[str, float]) -> Column:
    return goals * weights["goals"] + assists * weights["assists"]


def defensive_reliability(
    tackles: Column | str, interceptions: Column | str, pass_pct: Column | str
) -> Column:
    """Unrounded; tackles and interceptions per 90 minutes, passes in percent."""
    return (
        _column(tackles) * TACKLE_WEIGHT
        + _column(interceptions) * INTERCEPTION_WEIGHT
        + _column(pass_pct) / 100.0 * PASS_WEIGHT
    )


def impact_score(
    position: Column | str,
    goals: Column | str,
    assists: Column | str,
    red_cards: Column | str,
    tackles: Column | str,
    interceptions: Column | str,
    pass_pct: Column | str,
) -> Column:
    """Unrounded score whose ingredients depend on the position."""
    position, goals, assists = _column(position), _column(goals), _column(assists)
    passes = _column(pass_pct) / 100.0
    by_position = {
        "Attack": _weighted(goals, assists, ATTACK_WEIGHTS),
        "Midfield": _weighted(goals, assists, MIDFIELD_WEIGHTS) + _column(tackles) + passes * PASS_WEIGHT,
        "Defender": defensive_reliability(tackles, interceptions, pass_pct),
        "Goalkeeper": passes * KEEPER_PASS_WEIGHT - _column(red_cards) * KEEPER_RED_CARD_PENALTY,
    }
    score = (goals + assists).cast("double")
    for name, formula in by_position.items():
        score = F.when(position == name, formula).otherwise(score)
    return score


def contributions_per_90(goals: Column | str, assists: Column | str, minutes: Column | str) -> Column:
    return per_90(_column(goals) + _column(assists), minutes, digits=2)


def upside_value(age: Column | str, highest: Column | str, market: Column | str) -> Column:
    """Distance to the highest value; 0 for older players and for an unknown age."""
    gap = _column(highest) - _column(market)
    return F.when(_column(age) <= LAST_AGE_WITH_UPSIDE, gap).otherwise(F.lit(0.0))


# Lower bounds of predicted goals per class.
OPEN_GAME_GOALS = 3.5
BALANCED_GAME_GOALS = 2.5


def tendency(predicted_goals: Column | str) -> Column:
    goals = _column(predicted_goals)
    return (
        F.when(goals >= OPEN_GAME_GOALS, "open")
        .when(goals >= BALANCED_GAME_GOALS, "balanced")
        .otherwise("closed")
    )


def expected_goals(attack: Column | str, conceded: Column | str, mean_conceded: Column | str) -> Column:
    """Own attack scaled by how leaky the opponent is against the league mean."""
    return _column(attack) * safe_div(conceded, mean_conceded)


def score_goals(expected: Column | str) -> Column:
    """Goals of the likeliest score line; halves go to the even neighbour."""
    return F.bround(_column(expected), 0).cast("int")
