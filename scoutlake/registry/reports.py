"""The published reports on gold tables derived from the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scoutlake.plans import reports
from scoutlake.registry import Query, gold
from scoutlake.registry.oracle import oracle, rounded

GEMS = f"""
    SELECT player_id, name, age, position, current_club_name AS club, country_of_citizenship AS country,
      total_goals + total_assists AS goal_contributions, total_minutes AS minutes,
      market_value_in_eur / 1e6 AS value_m,
      {rounded('CAST(total_goals + total_assists AS DOUBLE) / nullif(total_minutes, 0) * 90', 2)} AS contributions_per_90,
      {rounded('market_value_in_eur / nullif(total_goals + total_assists, 0)', 0)} AS cost_per_contribution
    FROM g_players
    WHERE age <= 25 AND total_minutes >= 2000 AND total_goals + total_assists >= 10
      AND market_value_in_eur > 0 AND market_value_in_eur <= 5000000
    ORDER BY contributions_per_90 DESC NULLS LAST, player_id LIMIT 15"""

APPRECIATION = f"""
    SELECT player_id, name, position, country, first_value / 1e6 AS first_value_m, last_value / 1e6 AS last_value_m,
      (last_value - first_value) / 1e6 AS gain_m,
      {rounded('(last_value - first_value) * 100.0::DOUBLE / first_value', 1)} AS gain_pct
    FROM (SELECT v.player_id, v.player_name AS name, v.position, v.country_of_citizenship AS country,
            min(CASE WHEN v.valuation_date = e.lo THEN v.market_value_in_eur END) AS first_value,
            max(CASE WHEN v.valuation_date = e.hi THEN v.market_value_in_eur END) AS last_value
          FROM g_valuations v
          JOIN (SELECT player_id, min(valuation_date) AS lo, max(valuation_date) AS hi
                FROM g_valuations GROUP BY player_id) e
            ON e.player_id = v.player_id AND (v.valuation_date = e.lo OR v.valuation_date = e.hi)
          GROUP BY ALL)
    WHERE first_value > 0 AND first_value <= 5000000 AND last_value > first_value
    ORDER BY gain_pct DESC, player_id LIMIT 15"""


def returns(n: int, digits: int | None) -> str:
    def amount(column: str) -> str:
        return rounded(f"{column} / 1e6", digits) if digits else f"{column} / 1e6"

    more = "" if digits else "country_of_citizenship AS country, transfer_season AS season, transfer_type,"
    return f"""
        SELECT player_id, player_name AS name, position, {more} age_at_transfer AS age, from_club_name AS from_club,
          to_club_name AS to_club, {amount('transfer_fee')} AS fee_m,
          {amount('market_value_in_eur')} AS market_value_m, {amount('fee_vs_market_diff')} AS diff_m
        FROM g_transfers WHERE transfer_fee > 0 AND market_value_in_eur > 0 AND fee_vs_market_diff > 0
        ORDER BY fee_vs_market_diff DESC, player_id, transfer_date_parsed, from_club_id, to_club_id, transfer_fee
        LIMIT {n}"""


def expiring(columns: str, n: int) -> str:
    return f"""
        SELECT player_id, name, age, position, current_club_name AS club,
          total_goals + total_assists AS goal_contributions, {columns}
        FROM g_players
        WHERE contract_expiration_date BETWEEN DATE '2026-01-01' AND DATE '2026-12-31'
          AND total_minutes >= 1000 AND total_goals + total_assists >= 5 AND market_value_in_eur >= 1000000
        ORDER BY market_value_in_eur DESC, player_id LIMIT {n}"""


SELLERS = """
    SELECT from_club_name AS club, count(*) AS sales, sum(transfer_fee) / 1e6 AS revenue_m,
      avg(transfer_fee) / 1e6 AS average_fee_m, sum(fee_vs_market_diff) / 1e6 AS total_diff_m
    FROM g_transfers WHERE transfer_type = 'paid' AND transfer_fee > 0
    GROUP BY from_club_name HAVING count(*) >= 3
    ORDER BY revenue_m DESC, club LIMIT 15"""

LEAGUES = f"""
    SELECT competition_id AS league, count(*) AS games, CAST(sum(total_goals) AS BIGINT) AS goals,
      {rounded('avg(total_goals)', 2)} AS mean_goals, {rounded('avg(attendance)', 0)} AS mean_attendance,
      CAST(count(*) FILTER (home_result = 'win') * 100 // count(*) AS BIGINT) AS home_win_pct
    FROM g_games WHERE competition_type = 'domestic_league' AND total_goals IS NOT NULL
    GROUP BY competition_id"""


def rising(columns: str, n: int) -> str:
    return f"""
        SELECT player_id, player_name AS name, position, value_change_pct AS change_pct, {columns}
        FROM (SELECT *, row_number() OVER (PARTITION BY player_id ORDER BY valuation_date DESC,
                market_value_in_eur DESC, value_change_pct DESC) AS rn
              FROM g_valuations WHERE value_change_pct IS NOT NULL)
        WHERE rn = 1 AND value_change_pct > 20 AND market_value_in_eur BETWEEN 500000 AND 10000000
        ORDER BY value_change_pct DESC, player_id LIMIT {n}"""


IMPACT = f"""
    SELECT player_id, player_name AS name, age, position, club_name AS club, nationality AS country, impact_score,
      defensive_reliability, total_minutes AS minutes, {rounded('market_value_in_eur / 1e6', 2)} AS value_m,
      cost_per_impact
    FROM scout WHERE age <= 25 AND total_minutes >= 2000 AND impact_score > 5
      AND market_value_in_eur > 0 AND market_value_in_eur <= 5000000
    ORDER BY cost_per_impact NULLS FIRST, player_id LIMIT 15"""

STAR = {
    "dim_clubs": "g_clubs",
    "dim_players": "g_players",
    "fact_matches": "g_matches",
    "fact_valuations": "g_valuations",
    "fact_transfers": "g_transfers",
    "fact_games": "g_games",
}


def counts(names: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{star}' AS table_name, count(*) AS row_count FROM {STAR[star]}" for star in names
    )


def star_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    builders = {
        "dim_clubs": gold.clubs,
        "dim_players": gold.players,
        "fact_matches": gold.matches,
        "fact_valuations": gold.valuations,
        "fact_transfers": gold.transfers,
        "fact_games": gold.games,
    }
    return {name: build(spark, sf) for name, build in builders.items()}


def published_gems(spark: SparkSession, sf: str) -> DataFrame:
    return reports.published(reports.undervalued_gems(gold.players(spark, sf)), "undervalued_gems")


PUBLISHED_GEMS = oracle(
    f"""SELECT name AS "Jogador", CAST(age AS VARCHAR) AS "Idade", coalesce(position, '') AS "Posicao",
            coalesce(club, '') AS "Clube", coalesce(country, '') AS "Pais",
            CAST(goal_contributions AS VARCHAR) AS "Participacoes_Gol", CAST(minutes AS VARCHAR) AS "Minutos",
            CAST(value_m AS VARCHAR) AS "Valor_Mi_EUR",
            coalesce(CAST(contributions_per_90 AS VARCHAR), '') AS "Gol_Assist_Per_90min",
            coalesce(CAST(cost_per_contribution AS VARCHAR), '') AS "Custo_Por_GA" FROM ({GEMS})"""
)

QUERIES = {
    "undervalued_gems": Query(lambda s, d: reports.undervalued_gems(gold.players(s, d)), oracle(GEMS)),
    "biggest_appreciation": Query(
        lambda s, d: reports.biggest_appreciation(gold.valuations(s, d)), oracle(APPRECIATION)
    ),
    "best_transfer_returns": Query(
        lambda s, d: reports.best_transfer_returns(gold.transfers(s, d)), oracle(returns(15, None))
    ),
    "transfer_returns_brief": Query(
        lambda s, d: reports.transfer_returns_brief(gold.transfers(s, d)), oracle(returns(10, 2))
    ),
    "expiring_contracts": Query(
        lambda s, d: reports.expiring_contracts(gold.players(s, d)),
        oracle(
            expiring(
                """country_of_citizenship AS country, total_minutes AS minutes, market_value_in_eur / 1e6 AS value_m,
                contract_expiration_date AS contract_until""", 15,
            )
        ),
    ),
    "expiring_contracts_brief": Query(
        lambda s, d: reports.expiring_contracts_brief(gold.players(s, d)),
        oracle(
            expiring(
                rounded("market_value_in_eur / 1e6", 2)
                + " AS value_m, CAST(contract_expiration_date AS VARCHAR) AS contract_until", 10,
            )
        ),
    ),
    "top_selling_clubs": Query(lambda s, d: reports.top_selling_clubs(gold.transfers(s, d)), oracle(SELLERS)),
    "league_stats": Query(lambda s, d: reports.league_stats(gold.games(s, d)), oracle(LEAGUES)),
    "rising_now": Query(
        lambda s, d: reports.rising_now(gold.valuations(s, d)),
        oracle(
            rising("country_of_citizenship AS country, market_value_in_eur / 1e6 AS value_m, valuation_date", 15)
        ),
    ),
    "rising_now_brief": Query(
        lambda s, d: reports.rising_now_brief(gold.valuations(s, d)),
        oracle(
            rising(
                rounded("market_value_in_eur / 1e6", 2)
                + " AS value_m, CAST(valuation_date AS VARCHAR) AS valuation_date", 10,
            )
        ),
    ),
    "undervalued_by_impact": Query(lambda s, d: reports.undervalued_by_impact(gold.scout(s, d)), oracle(IMPACT)),
    "star_row_counts": Query(
        lambda s, d: reports.row_counts(star_tables(s, d)), oracle(counts(list(STAR)))
    ),
    "api_row_counts": Query(
        lambda s, d: reports.row_counts(star_tables(s, d), include_matches=False),
        oracle(counts([t for t in STAR if t != "fact_matches"])),
    ),
    "published_gems": Query(published_gems, PUBLISHED_GEMS),
    "published_gems_whole": Query(published_gems, PUBLISHED_GEMS),
}
