"""Oracle texts: common table expressions for the shapes and the gold tables, in DuckDB's SQL.

Numbers are rounded through their printed form, because Spark rounds that half
up and DuckDB the binary value.
"""

from __future__ import annotations

import re

from scoutlake.registry.shapes import SHAPES, shape_sql

AS_OF = "DATE '2025-06-01'"


def rounded(expr: str, digits: int) -> str:
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def age(born: str, on: str) -> str:
    return f"CAST(floor(date_diff('day', {born}, {on}) / 365.25::DOUBLE) AS INT)"


def text_ids(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS VARCHAR) AS {c.split('.')[-1]}" for c in columns)


BORN = "TRY_CAST(p.date_of_birth AS DATE)"

GOLD_SQL = {
    "g_players": f"""
        SELECT CAST(p.player_id AS VARCHAR) AS player_id, p.name, p.first_name, p.last_name,
          {age(BORN, AS_OF)} AS age, {BORN} AS date_of_birth, p.country_of_citizenship, p.country_of_birth,
          p.position, p.sub_position, p.foot, p.height_in_cm,
          CAST(p.current_club_id AS VARCHAR) AS current_club_id, p.current_club_name,
          p.market_value_in_eur, p.highest_market_value_in_eur,
          CAST(coalesce(a.goals, 0) AS BIGINT) AS total_goals, CAST(coalesce(a.assists, 0) AS BIGINT) AS total_assists,
          CAST(coalesce(a.yellow, 0) AS BIGINT) AS total_yellow, CAST(coalesce(a.red, 0) AS BIGINT) AS total_red,
          CAST(coalesce(a.minutes, 0) AS BIGINT) AS total_minutes, CAST(coalesce(a.n, 0) AS BIGINT) AS total_appearances,
          TRY_CAST(p.contract_expiration_date AS DATE) AS contract_expiration_date, p.agent_name, p.image_url,
          coalesce(d.tackles_per_90, 0) AS tackles_per_90,
          coalesce(d.interceptions_per_90, 0) AS interceptions_per_90,
          coalesce(d.pass_completion_pct, 0) AS pass_completion_pct
        FROM players p
        LEFT JOIN (SELECT player_id, sum(goals) AS goals, sum(assists) AS assists, sum(yellow_cards) AS yellow,
                     sum(red_cards) AS red, sum(minutes_played) AS minutes, count(appearance_id) AS n
                   FROM appearances GROUP BY player_id) a ON a.player_id = p.player_id
        LEFT JOIN defense d ON d.player_id = p.player_id""",
    "squad": f"""
        SELECT p.current_club_id AS club_id, count(p.player_id) AS player_count,
          sum(p.market_value_in_eur) AS total_squad_value, avg(p.market_value_in_eur) AS avg_player_value,
          avg(date_diff('day', {BORN}, {AS_OF})) / 365.25::DOUBLE AS avg_age
        FROM players p GROUP BY p.current_club_id""",
    "club_positions": """
        SELECT c.name, min(t.position) AS league_position FROM table_rows t
        JOIN (SELECT trim(replace(lower(name), ' fc', '')) AS k, max(name) AS name FROM clubs GROUP BY 1) c
          ON c.k = lower(t.team_name)
        WHERE t.type = 'TOTAL' GROUP BY c.name""",
    "g_clubs": """
        SELECT CAST(c.club_id AS VARCHAR) AS club_id, c.club_code, c.name, c.stadium_name, c.stadium_seats,
          c.squad_size, c.average_age, CAST(s.player_count AS INT) AS player_count, s.total_squad_value,
          s.avg_player_value, s.avg_age, c.foreigners_number, c.foreigners_percentage, c.national_team_players,
          c.coach_name, c.net_transfer_record, p.league_position
        FROM clubs c LEFT JOIN squad s ON s.club_id = c.club_id LEFT JOIN club_positions p ON p.name = c.name""",
    "changes": f"""
        SELECT *, CASE WHEN prev_value > 0
            THEN {rounded('(market_value_in_eur - prev_value) / prev_value * 100', 2)} END AS value_change_pct
        FROM (SELECT *, CAST(date AS DATE) AS valuation_date,
                lag(market_value_in_eur) OVER (PARTITION BY player_id
                  ORDER BY CAST(date AS DATE), market_value_in_eur NULLS FIRST, current_club_id) AS prev_value
              FROM player_valuations)""",
    "g_valuations": f"""
        SELECT CAST(v.player_id AS VARCHAR) AS player_id, p.name AS player_name, v.valuation_date,
          v.market_value_in_eur, v.prev_value, v.value_change_pct, v.current_club_name,
          CAST(v.current_club_id AS VARCHAR) AS current_club_id, v.player_club_domestic_competition_id,
          p.position, p.sub_position, p.country_of_citizenship, {age(BORN, 'v.valuation_date')} AS age_at_valuation
        FROM changes v LEFT JOIN players p ON p.player_id = v.player_id""",
    "g_transfers": f"""
        SELECT CAST(t.player_id AS VARCHAR) AS player_id, t.player_name, p.position, p.country_of_citizenship,
          {age(BORN, 'CAST(t.transfer_date AS DATE)')} AS age_at_transfer,
          CAST(t.transfer_date AS DATE) AS transfer_date_parsed, t.transfer_season,
          {text_ids('t.from_club_id')}, t.from_club_name, {text_ids('t.to_club_id')}, t.to_club_name,
          t.transfer_fee, t.market_value_in_eur, t.transfer_fee - t.market_value_in_eur AS fee_vs_market_diff,
          CASE WHEN t.transfer_fee IS NULL THEN 'unknown' WHEN t.transfer_fee = 0 THEN 'free/loan' ELSE 'paid' END
            AS transfer_type
        FROM transfers t LEFT JOIN players p ON p.player_id = t.player_id""",
    "g_games": f"""
        SELECT CAST(g.game_id AS VARCHAR) AS game_id, g.competition_id, g.season, g.round,
          CAST(g.date AS DATE) AS game_date, {text_ids('g.home_club_id', 'g.away_club_id')}, g.home_club_name,
          g.away_club_name, g.home_club_goals, g.away_club_goals,
          coalesce(g.home_club_goals, 0) + coalesce(g.away_club_goals, 0) AS total_goals,
          CASE WHEN g.home_club_goals > g.away_club_goals THEN 'win'
               WHEN g.home_club_goals < g.away_club_goals THEN 'loss' ELSE 'draw' END AS home_result,
          g.stadium, g.attendance, g.referee, g.home_club_formation, g.away_club_formation,
          g.home_club_manager_name, g.away_club_manager_name,
          CAST(l.n AS INT) AS total_players_involved, g.competition_type
        FROM games g LEFT JOIN (SELECT game_id, count(DISTINCT player_id) AS n FROM game_lineups GROUP BY 1) l
          ON l.game_id = g.game_id""",
    "g_standings": """
        SELECT position, CAST(team_id AS VARCHAR) AS team_id, team_name, substr(team_name, 1, 3) AS team_short,
          CAST(NULL AS VARCHAR) AS team_crest, CAST(played AS INT) AS played, won, draw, lost, points, goals_for,
          goals_against, goal_difference, form
        FROM table_rows WHERE type = 'TOTAL'""",
    "g_matches": """
        SELECT CAST(m.match_id AS VARCHAR) AS match_id, m.matchday, CAST(substr(m.utc_date, 1, 10) AS DATE) AS utc_date,
          m.status, CAST(m.home_id AS VARCHAR) AS home_team_id, 'TEAM ' || m.home_id AS home_team,
          'T' || m.home_id AS home_team_short, CAST(NULL AS VARCHAR) AS home_team_crest,
          CAST(m.away_id AS VARCHAR) AS away_team_id, 'TEAM ' || m.away_id AS away_team,
          'T' || m.away_id AS away_team_short, CAST(NULL AS VARCHAR) AS away_team_crest,
          CAST(m.home_goals AS DOUBLE) AS home_score, CAST(m.away_goals AS DOUBLE) AS away_score, m.winner,
          CAST(m.season_start AS DATE) AS season_start, CAST(m.season_end AS DATE) AS season_end,
          CAST(g.game_id AS DOUBLE) AS tm_game_id, g.stadium, g.attendance, g.referee,
          g.home_club_formation AS home_formation, g.away_club_formation AS away_formation
        FROM match_rows m
        LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY date, home_club_name ORDER BY game_id) AS rn FROM games) g
          ON g.rn = 1 AND g.date = substr(m.utc_date, 1, 10) AND g.home_club_name = 'Team ' || m.home_id || ' FC'""",
    "impact": """
        SELECT *, CASE position
            WHEN 'Attack' THEN total_goals * 2.0::DOUBLE + total_assists * 1.5::DOUBLE
            WHEN 'Midfield' THEN total_goals * 1.5::DOUBLE + total_assists * 1.5::DOUBLE + tackles_per_90
              + pass_completion_pct / 100.0::DOUBLE * 2.0::DOUBLE
            WHEN 'Defender' THEN tackles_per_90 * 2.0::DOUBLE + interceptions_per_90 * 1.5::DOUBLE
              + pass_completion_pct / 100.0::DOUBLE * 2.0::DOUBLE
            WHEN 'Goalkeeper' THEN pass_completion_pct / 100.0::DOUBLE * 5.0::DOUBLE - total_red * 3.0::DOUBLE
            ELSE CAST(total_goals + total_assists AS DOUBLE) END AS score
        FROM g_players WHERE market_value_in_eur > 0""",
    "scout": f"""
        SELECT i.player_id, i.name AS player_name, i.age, i.position, i.country_of_citizenship AS nationality,
          c.name AS club_name, c.squad_size, i.market_value_in_eur, i.highest_market_value_in_eur,
          i.total_goals, i.total_assists, i.total_minutes, i.total_goals + i.total_assists AS goal_contributions,
          {rounded('i.tackles_per_90 * 2 + i.interceptions_per_90 * 1.5::DOUBLE + i.pass_completion_pct / 100 * 2', 2)}
            AS defensive_reliability,
          {rounded('i.score', 2)} AS impact_score,
          {rounded('i.market_value_in_eur / nullif(i.score, 0)', 0)} AS cost_per_impact,
          {rounded('i.market_value_in_eur / nullif(i.total_goals + i.total_assists, 0)', 0)} AS cost_per_contribution,
          {rounded('CAST(i.total_goals + i.total_assists AS DOUBLE) / nullif(i.total_minutes, 0) * 90', 2)}
            AS contributions_per_90,
          CASE WHEN i.age <= 29 THEN i.highest_market_value_in_eur - i.market_value_in_eur ELSE 0 END AS upside_value,
          i.contract_expiration_date, i.image_url, i.tackles_per_90, i.interceptions_per_90, i.pass_completion_pct
        FROM impact i LEFT JOIN g_clubs c ON c.club_id = i.current_club_id""",
    "strength": """
        SELECT h.*, a.avg_goals_scored_away, a.avg_goals_conceded_away, a.away_games,
          (h.avg_goals_scored_home + a.avg_goals_scored_away) / 2 AS overall_attack,
          (h.avg_goals_conceded_home + a.avg_goals_conceded_away) / 2 AS overall_defense
        FROM (SELECT home_club_id AS club_id, home_club_name AS club_name,
                avg(home_club_goals) AS avg_goals_scored_home, avg(away_club_goals) AS avg_goals_conceded_home,
                count(*) AS home_games
              FROM g_games WHERE competition_type = 'domestic_league' GROUP BY ALL) h
        JOIN (SELECT away_club_id AS club_id, avg(away_club_goals) AS avg_goals_scored_away,
                avg(home_club_goals) AS avg_goals_conceded_away, count(*) AS away_games
              FROM g_games WHERE competition_type = 'domestic_league' GROUP BY ALL) a ON a.club_id = h.club_id
        WHERE h.home_games >= 10 AND a.away_games >= 10""",
}


def _definition(name: str) -> str:
    return shape_sql(name) if name in SHAPES else GOLD_SQL[name]


def oracle(body: str, **extra: str) -> str:
    """`body` with the shapes, gold tables and `extra` expressions it mentions, directly or not."""
    known = {*SHAPES, *GOLD_SQL, *extra}
    ordered: list[str] = []

    def visit(text: str) -> None:
        for word in re.findall(r"(?:FROM|JOIN)\s+([a-z_]+)", text):
            if word in known and word not in ordered:
                inner = extra.get(word) or _definition(word)
                visit(inner)
                if word not in ordered:
                    ordered.append(word)

    visit(body)
    if not ordered:
        return body
    listed = ",\n".join(f"{name} AS ({extra.get(name) or _definition(name)})" for name in ordered)
    return f"WITH {listed}\n{body}"


def _double_text(x: str) -> str:
    """The canonical text of a double: mantissa and exponent."""
    s = f"(CASE WHEN abs({x}) < pow(2::DOUBLE, -960) THEN {x} * pow(2::DOUBLE, 120) ELSE {x} END)"
    near = f"CAST(floor(log2(abs({s}))) AS INT)"
    part = f"(abs({s}) * pow(2::DOUBLE, -{near}))"
    exponent = f"({near} + CASE WHEN {part} >= 2 THEN 1 WHEN {part} < 1 THEN -1 ELSE 0 END)"
    return f"""CASE WHEN isnan({x}) THEN 'nan' WHEN {x} = 'inf'::DOUBLE THEN 'inf' WHEN {x} = '-inf'::DOUBLE THEN '-inf'
      WHEN {x} = 0 THEN '0' ELSE CAST({s} * pow(2::DOUBLE, -{exponent}) * pow(2::DOUBLE, 52) AS BIGINT) || 'e' ||
        ({exponent} - CASE WHEN abs({x}) < pow(2::DOUBLE, -960) THEN 120 ELSE 0 END) END"""


_CELLS = {"DOUBLE": _double_text, "TIMESTAMP": lambda x: f"CAST(epoch_us({x}) AS VARCHAR)"}


def fingerprint_sql(table: str, columns: dict[str, str]) -> str:
    """Schema text and hash, rows and content hash of a table; `columns` has the SQL types by name."""
    names = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "TIMESTAMP": "timestamp_ntz"}
    whens = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in names.items())
    cells = " || ".join(
        f"coalesce(length({text}) || ':' || {text} || ';', 'n;')"
        for text in (f"({_CELLS.get(kind, lambda x: f'CAST({x} AS VARCHAR)')(name)})" for name, kind in columns.items())
    )
    return f"""SELECT '{table}' AS table_name, schema_text, sha256(schema_text) AS schema_hash, rows, content_hash
      FROM (SELECT string_agg(column_name || ':' || CASE column_type {whens} END, '|') AS schema_text
            FROM (DESCRIBE SELECT * FROM {table})),
           (SELECT rows, sha256(rows || '|' || high || '|' || low) AS content_hash FROM (
              SELECT count(*) AS rows, sum(('0x' || substr(h, 1, 16))::UBIGINT::HUGEINT) AS high,
                sum(('0x' || substr(h, 17, 16))::UBIGINT::HUGEINT) AS low
              FROM (SELECT md5({cells}) AS h FROM {table})))"""
