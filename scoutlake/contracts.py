"""Table contracts: raw inputs, gold outputs, keys and vocabularies."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(ddl: str) -> T.StructType:
    kinds = {
        "string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(),
        "double": T.DoubleType(), "date": T.DateType(), "timestamp": T.TimestampType(),
    }
    pairs = (item.split() for item in ddl.replace("\n", " ").split(",") if item.strip())
    return T.StructType([T.StructField(name, kinds[kind]) for name, kind in pairs])


# Raw CSV datasets in dependency order. Dates are read as text and parsed later,
# so that a malformed one becomes null instead of failing the scan.
RAW_CSV = {
    "competitions": _struct(
        "competition_id string, name string, type string, sub_type string, country_name string"
    ),
    "clubs": _struct(
        """club_id long, club_code string, name string, domestic_competition_id string,
        stadium_name string, stadium_seats int, squad_size int, average_age double,
        foreigners_number int, foreigners_percentage double, national_team_players int,
        coach_name string, net_transfer_record string"""
    ),
    "players": _struct(
        """player_id long, name string, first_name string, last_name string, date_of_birth string,
        country_of_citizenship string, country_of_birth string, position string, sub_position string,
        foot string, height_in_cm double, current_club_id long, current_club_name string,
        market_value_in_eur double, highest_market_value_in_eur double,
        contract_expiration_date string, agent_name string, image_url string"""
    ),
    "transfers": _struct(
        """player_id long, player_name string, transfer_date string, transfer_season string,
        from_club_id long, from_club_name string, to_club_id long, to_club_name string,
        transfer_fee double, market_value_in_eur double"""
    ),
    "player_valuations": _struct(
        """player_id long, date string, market_value_in_eur double, current_club_name string,
        current_club_id long, player_club_domestic_competition_id string"""
    ),
    "appearances": _struct(
        """appearance_id string, player_id long, goals int, assists int, yellow_cards int,
        red_cards int, minutes_played int"""
    ),
    "games": _struct(
        """game_id long, competition_id string, competition_type string, season string, round string,
        date string, home_club_id long, away_club_id long, home_club_name string, away_club_name string,
        home_club_goals int, away_club_goals int, stadium string, attendance int, referee string,
        home_club_formation string, away_club_formation string, home_club_manager_name string,
        away_club_manager_name string"""
    ),
    "game_lineups": _struct(
        "game_id long, club_id long, player_id long, type string, team_captain int"
    ),
}
DEFENSE_CSV = _struct(
    "player_id long, tackles_per_90 double, interceptions_per_90 double, pass_completion_pct double"
)

_TEAM = _struct("id long, name string, shortName string, crest string")
MATCH_ITEM = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("matchday", T.IntegerType()),
        T.StructField("utcDate", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("homeTeam", _TEAM),
        T.StructField("awayTeam", _TEAM),
        T.StructField(
            "score",
            T.StructType(
                [
                    T.StructField("winner", T.StringType()),
                    T.StructField("fullTime", _struct("home int, away int")),
                ]
            ),
        ),
        T.StructField("season", _struct("startDate string, endDate string")),
    ]
)
_TABLE_ROW = T.StructType(
    [T.StructField("position", T.IntegerType()), T.StructField("team", _TEAM)]
    + _struct(
        """playedGames int, won int, draw int, lost int, points int, goalsFor int, goalsAgainst int,
        goalDifference int, form string"""
    ).fields
)
STANDING_ITEM = T.StructType(
    [T.StructField("type", T.StringType()), T.StructField("table", T.ArrayType(_TABLE_ROW))]
)
# JSON endpoint -> array field that holds its payload (None: the document is the item).
JSON_ENDPOINTS = {
    "competition": None,
    "matches": "matches",
    "standings": "standings",
    "teams": "teams",
    "scorers": "scorers",
}

# Gold tables.
GOLD = {
    "clubs": _struct(
        """club_id string, club_code string, name string, stadium_name string, stadium_seats int,
        squad_size int, average_age double, player_count int, total_squad_value double,
        avg_player_value double, avg_age double, foreigners_number int, foreigners_percentage double,
        national_team_players int, coach_name string, net_transfer_record string, league_position int"""
    ),
    "players": _struct(
        """player_id string, name string, first_name string, last_name string, age int,
        date_of_birth date, country_of_citizenship string, country_of_birth string, position string,
        sub_position string, foot string, height_in_cm double, current_club_id string,
        current_club_name string, market_value_in_eur double, highest_market_value_in_eur double,
        total_goals long, total_assists long, total_yellow long, total_red long, total_minutes long,
        total_appearances long, contract_expiration_date date, agent_name string, image_url string,
        tackles_per_90 double, interceptions_per_90 double, pass_completion_pct double"""
    ),
    "matches": _struct(
        """match_id string, matchday int, utc_date date, status string, home_team_id string,
        home_team string, home_team_short string, home_team_crest string, away_team_id string,
        away_team string, away_team_short string, away_team_crest string, home_score double,
        away_score double, winner string, season_start date, season_end date, tm_game_id double,
        stadium string, attendance int, referee string, home_formation string, away_formation string"""
    ),
    "valuations": _struct(
        """player_id string, player_name string, valuation_date date, market_value_in_eur double,
        prev_value double, value_change_pct double, current_club_name string, current_club_id string,
        player_club_domestic_competition_id string, position string, sub_position string,
        country_of_citizenship string, age_at_valuation int"""
    ),
    "transfers": _struct(
        """player_id string, player_name string, position string, country_of_citizenship string,
        age_at_transfer int, transfer_date_parsed date, transfer_season string, from_club_id string,
        from_club_name string, to_club_id string, to_club_name string, transfer_fee double,
        market_value_in_eur double, fee_vs_market_diff double, transfer_type string"""
    ),
    "games": _struct(
        """game_id string, competition_id string, season string, round string, game_date date,
        home_club_id string, away_club_id string, home_club_name string, away_club_name string,
        home_club_goals int, away_club_goals int, total_goals int, home_result string, stadium string,
        attendance int, referee string, home_club_formation string, away_club_formation string,
        home_club_manager_name string, away_club_manager_name string, total_players_involved int,
        competition_type string"""
    ),
    "standings": _struct(
        """position int, team_id string, team_name string, team_short string, team_crest string,
        played int, won int, draw int, lost int, points int, goals_for int, goals_against int,
        goal_difference int, form string"""
    ),
}

# Gold table -> star table, its key and its required columns.
STAR_TABLES = {
    "clubs": "dim_clubs",
    "players": "dim_players",
    "matches": "fact_matches",
    "valuations": "fact_valuations",
    "transfers": "fact_transfers",
    "games": "fact_games",
}
STAR_KEYS = {
    "dim_clubs": ("club_id",),
    "dim_players": ("player_id",),
    "fact_matches": ("match_id",),
    "fact_valuations": ("player_id", "valuation_date"),
    "fact_games": ("game_id",),
}
STAR_REQUIRED = {"dim_clubs": ("name",), "dim_players": ("name",)}

AUDIT = T.StructType(
    _struct(
        """ingestion_id string, source string, endpoint string, execution_timestamp timestamp,
        rows_fetched long, rows_written long, status string, schema_hash string, content_hash string,
        error_message string, duration_seconds double"""
    ).fields
    + [T.StructField("metadata", T.MapType(T.StringType(), T.StringType()))]
)

# Competitions of interest, by source.
JSON_COMPETITIONS = ("PL", "PD", "SA", "BL1", "FL1", "BSA")
CSV_COMPETITIONS = ("GB1", "ES1", "IT1", "L1", "FR1", "BRA1")

# Detailed position names.
VALID_POSITIONS = (
    "Goalkeeper",
    "Right Back", "Right Wing Back", "Right Center Back", "Center Back", "Left Center Back", "Left Back",
    "Left Wing Back",
    "Right Defensive Midfield", "Center Defensive Midfield", "Left Defensive Midfield",
    "Right Midfield", "Right Center Midfield", "Center Midfield", "Left Center Midfield", "Left Midfield",
    "Right Attacking Midfield", "Center Attacking Midfield", "Left Attacking Midfield",
    "Right Wing", "Left Wing",
    "Right Center Forward", "Striker", "Left Center Forward", "Center Forward", "Secondary Striker",
)
SEVERITIES = ("CRITICAL", "ERROR", "WARNING")
DOMESTIC_LEAGUE = "domestic_league"
