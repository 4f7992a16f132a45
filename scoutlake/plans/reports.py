"""The scouting reports. Thresholds are parameters; ties are broken, so a report is reproducible."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from scoutlake.contracts import DOMESTIC_LEAGUE
from scoutlake.functions import contributions_per_90, in_millions, safe_div, truncated_pct
from scoutlake.functions.text import blank_nulls
from scoutlake.operators.aggregates import first_last, union_counts
from scoutlake.operators.relational import top_n
from scoutlake.operators.windows import latest_per_key

CONTRACT_WINDOW = (dt.date(2026, 1, 1), dt.date(2026, 12, 31))


def _contributions() -> Column:
    return F.col("total_goals") + F.col("total_assists")


def undervalued_gems(
    players: DataFrame,
    max_age: int = 25,
    min_minutes: int = 2000,
    min_contributions: int = 10,
    max_value: float = 5e6,
    n: int = 15,
) -> DataFrame:
    """Young, cheap, regular players by goal contributions per 90 minutes."""
    cheap = (F.col("market_value_in_eur") > 0) & (F.col("market_value_in_eur") <= max_value)
    regular = (F.col("age") <= max_age) & (F.col("total_minutes") >= min_minutes)
    rows = players.filter(regular & cheap & (_contributions() >= min_contributions)).select(
        "player_id",
        "name",
        "age",
        "position",
        F.col("current_club_name").alias("club"),
        F.col("country_of_citizenship").alias("country"),
        _contributions().alias("goal_contributions"),
        F.col("total_minutes").alias("minutes"),
        in_millions("market_value_in_eur").alias("value_m"),
        contributions_per_90("total_goals", "total_assists", "total_minutes").alias("contributions_per_90"),
        safe_div("market_value_in_eur", _contributions(), 0).alias("cost_per_contribution"),
    )
    return top_n(rows, "contributions_per_90", n, tie_break=["player_id"])


def biggest_appreciation(valuations: DataFrame, max_initial: float = 5e6, n: int = 15) -> DataFrame:
    """Players whose last value is furthest above their first one, in percent."""
    ends = first_last(
        valuations, "player_id", "valuation_date", "market_value_in_eur",
        labels=("player_name", "position", "country_of_citizenship"),
    )
    first, last = F.col("first_value"), F.col("last_value")
    grown = ends.filter((first > 0) & (first <= max_initial) & (last > first))
    rows = grown.select(
        "player_id",
        F.col("player_name").alias("name"),
        "position",
        F.col("country_of_citizenship").alias("country"),
        in_millions(first).alias("first_value_m"),
        in_millions(last).alias("last_value_m"),
        in_millions(last - first).alias("gain_m"),
        F.round((last - first) * 100.0 / first, 1).alias("gain_pct"),
    )
    return top_n(rows, "gain_pct", n, tie_break=["player_id"])


def _profitable(transfers: DataFrame) -> DataFrame:
    positive = F.lit(True)
    for column in ("transfer_fee", "market_value_in_eur", "fee_vs_market_diff"):
        positive = positive & (F.col(column) > 0)
    return transfers.filter(positive)


TRANSFER_TIES = ("player_id", "transfer_date_parsed", "from_club_id", "to_club_id", "transfer_fee")


def best_transfer_returns(transfers: DataFrame, n: int = 15) -> DataFrame:
    """Sales furthest above market value."""
    top = top_n(_profitable(transfers), "fee_vs_market_diff", n, tie_break=TRANSFER_TIES)
    return top.select(
        "player_id",
        F.col("player_name").alias("name"),
        "position",
        F.col("country_of_citizenship").alias("country"),
        F.col("age_at_transfer").alias("age"),
        F.col("from_club_name").alias("from_club"),
        F.col("to_club_name").alias("to_club"),
        F.col("transfer_season").alias("season"),
        in_millions("transfer_fee").alias("fee_m"),
        in_millions("market_value_in_eur").alias("market_value_m"),
        in_millions("fee_vs_market_diff").alias("diff_m"),
        "transfer_type",
    )


def transfer_returns_brief(transfers: DataFrame, n: int = 10) -> DataFrame:
    """The same ranking with rounded amounts."""
    full = best_transfer_returns(transfers, n)
    amounts = {c: F.round(c, 2) for c in ("fee_m", "market_value_m", "diff_m")}
    return full.withColumns(amounts).drop("country", "season", "transfer_type")


def expiring_contracts(
    players: DataFrame,
    window: tuple[dt.date, dt.date] = CONTRACT_WINDOW,
    min_minutes: int = 1000,
    min_contributions: int = 5,
    min_value: float = 1e6,
    n: int = 15,
) -> DataFrame:
    """Regular, valuable players whose contract ends inside the window, by value."""
    ends = F.col("contract_expiration_date").between(*window)
    useful = (F.col("total_minutes") >= min_minutes) & (F.col("market_value_in_eur") >= min_value)
    kept = players.filter(ends & useful & (_contributions() >= min_contributions))
    return top_n(kept, "market_value_in_eur", n, tie_break=["player_id"]).select(
        "player_id",
        "name",
        "age",
        "position",
        F.col("current_club_name").alias("club"),
        F.col("country_of_citizenship").alias("country"),
        _contributions().alias("goal_contributions"),
        F.col("total_minutes").alias("minutes"),
        in_millions("market_value_in_eur").alias("value_m"),
        F.col("contract_expiration_date").alias("contract_until"),
    )


def expiring_contracts_brief(
    players: DataFrame, window: tuple[dt.date, dt.date] = CONTRACT_WINDOW, n: int = 10
) -> DataFrame:
    """The same ranking with a rounded value and the date as text."""
    shown = {"value_m": F.round("value_m", 2), "contract_until": F.col("contract_until").cast("string")}
    return expiring_contracts(players, window, n=n).withColumns(shown).drop("country", "minutes")


def top_selling_clubs(transfers: DataFrame, min_sales: int = 3, n: int = 15) -> DataFrame:
    """Clubs by revenue from paid transfers."""
    paid = transfers.filter((F.col("transfer_type") == "paid") & (F.col("transfer_fee") > 0))
    clubs = paid.groupBy(F.col("from_club_name").alias("club")).agg(
        F.count("*").alias("sales"),
        in_millions(F.sum("transfer_fee")).alias("revenue_m"),
        in_millions(F.avg("transfer_fee")).alias("average_fee_m"),
        in_millions(F.sum("fee_vs_market_diff")).alias("total_diff_m"),
    )
    return top_n(clubs.filter(F.col("sales") >= min_sales), "revenue_m", n, tie_break=["club"])


def league_stats(games: DataFrame, competition_type: str = DOMESTIC_LEAGUE) -> DataFrame:
    """Goals, attendance and share of home wins per league."""
    played = games.filter((F.col("competition_type") == competition_type) & F.col("total_goals").isNotNull())
    wins = F.sum(F.when(F.col("home_result") == "win", 1).otherwise(0))
    stats = played.groupBy(F.col("competition_id").alias("league")).agg(
        F.count("*").alias("games"),
        F.sum("total_goals").alias("goals"),
        F.round(F.avg("total_goals"), 2).alias("mean_goals"),
        F.round(F.avg("attendance"), 0).alias("mean_attendance"),
        truncated_pct(wins, F.count("*")).alias("home_win_pct"),
    )
    return stats.orderBy(F.desc_nulls_last("mean_goals"), "league")


def rising_now(
    valuations: DataFrame,
    min_change: float = 20,
    min_value: float = 5e5,
    max_value: float = 1e7,
    n: int = 15,
) -> DataFrame:
    """Players whose latest known value change is the largest."""
    known = valuations.filter(F.col("value_change_pct").isNotNull())
    latest = latest_per_key(
        known, ["player_id"],
        [F.desc("valuation_date"), F.desc("market_value_in_eur"), F.desc("value_change_pct")],
    )
    value = F.col("market_value_in_eur")
    kept = latest.filter((F.col("value_change_pct") > min_change) & value.between(min_value, max_value))
    return top_n(kept, "value_change_pct", n, tie_break=["player_id"]).select(
        "player_id",
        F.col("player_name").alias("name"),
        "position",
        F.col("country_of_citizenship").alias("country"),
        in_millions(value).alias("value_m"),
        F.col("value_change_pct").alias("change_pct"),
        "valuation_date",
    )


def rising_now_brief(valuations: DataFrame, n: int = 10) -> DataFrame:
    """The same ranking with a rounded value and the date as text."""
    shown = {"value_m": F.round("value_m", 2), "valuation_date": F.col("valuation_date").cast("string")}
    return rising_now(valuations, n=n).withColumns(shown).drop("country")


def undervalued_by_impact(
    view: DataFrame,
    max_age: int = 25,
    min_minutes: int = 2000,
    min_impact: float = 5,
    max_value: float = 5e6,
    n: int = 15,
) -> DataFrame:
    """Young, cheap, regular players of the scout view by cost per impact point, cheapest first."""
    value = F.col("market_value_in_eur")
    regular = (F.col("age") <= max_age) & (F.col("total_minutes") >= min_minutes)
    kept = view.filter(regular & (F.col("impact_score") > min_impact) & (value > 0) & (value <= max_value))
    return top_n(kept, "cost_per_impact", n, descending=False, tie_break=["player_id"]).select(
        "player_id",
        F.col("player_name").alias("name"),
        "age",
        "position",
        F.col("club_name").alias("club"),
        F.col("nationality").alias("country"),
        "impact_score",
        "defensive_reliability",
        F.col("total_minutes").alias("minutes"),
        in_millions(value, 2).alias("value_m"),
        "cost_per_impact",
    )


SUMMARY_TABLES = ("dim_clubs", "dim_players", "fact_matches", "fact_valuations", "fact_transfers", "fact_games")


def row_counts(star: Mapping[str, DataFrame], include_matches: bool = True) -> DataFrame:
    """Rows per star table."""
    names = [t for t in SUMMARY_TABLES if include_matches or t != "fact_matches"]
    return union_counts({name: star[name] for name in names if name in star})


# Column headings of the published reports.
HEADINGS = {
    "undervalued_gems": {
        "name": "Jogador", "age": "Idade", "position": "Posicao", "club": "Clube", "country": "Pais",
        "goal_contributions": "Participacoes_Gol", "minutes": "Minutos", "value_m": "Valor_Mi_EUR",
        "contributions_per_90": "Gol_Assist_Per_90min", "cost_per_contribution": "Custo_Por_GA",
    },
    "biggest_appreciation": {
        "name": "Jogador", "position": "Posicao", "country": "Pais", "first_value_m": "Valor_Inicial_Mi",
        "last_value_m": "Valor_Final_Mi", "gain_m": "Ganho_Mi", "gain_pct": "Valorizacao_Pct",
    },
    "best_transfer_returns": {
        "name": "Jogador", "position": "Posicao", "country": "Pais", "age": "Idade_Na_Transf",
        "from_club": "De", "to_club": "Para", "season": "Temporada", "fee_m": "Fee_Mi_EUR",
        "market_value_m": "Valor_Mercado_Mi", "diff_m": "Lucro_Clube_Vendedor_Mi", "transfer_type": "Tipo",
    },
    "expiring_contracts": {
        "name": "Jogador", "age": "Idade", "position": "Posicao", "club": "Clube", "country": "Pais",
        "goal_contributions": "Participacoes_Gol", "minutes": "Minutos", "value_m": "Valor_Mi_EUR",
        "contract_until": "Contrato_Ate",
    },
    "top_selling_clubs": {
        "club": "Clube_Vendedor", "sales": "Total_Vendas", "revenue_m": "Total_Arrecadado_Mi",
        "average_fee_m": "Ticket_Medio_Mi", "total_diff_m": "Lucro_Total_Mi",
    },
    "league_stats": {
        "league": "Liga", "games": "Total_Jogos", "goals": "Total_Gols", "mean_goals": "Media_Gols_Jogo",
        "mean_attendance": "Media_Publico", "home_win_pct": "Pct_Vitoria_Mandante",
    },
    "rising_now": {
        "name": "Jogador", "position": "Posicao", "country": "Pais", "value_m": "Valor_Atual_Mi",
        "change_pct": "Ultima_Variacao_Pct", "valuation_date": "Data_Avaliacao",
    },
    "undervalued_by_impact": {
        "name": "Jogador", "age": "Idade", "position": "Posicao", "club": "Clube", "country": "Pais",
        "impact_score": "Score_Impacto", "defensive_reliability": "Indice_Defensivo", "minutes": "Minutos",
        "value_m": "Valor_Mi_EUR", "cost_per_impact": "Custo_Por_Impacto_EUR",
    },
    "transfer_returns_brief": {
        "name": "Jogador", "position": "Posicao", "age": "Idade", "from_club": "De_Clube",
        "to_club": "Para_Clube", "fee_m": "Fee_Mi_EUR", "market_value_m": "Valor_Mercado_Mi_EUR",
        "diff_m": "Lucro_Mi_EUR",
    },
    "expiring_contracts_brief": {
        "name": "Jogador", "age": "Idade", "position": "Posicao", "club": "Clube",
        "goal_contributions": "Participacoes_Gol", "value_m": "Valor_Mi_EUR", "contract_until": "Contrato_Ate",
    },
    "rising_now_brief": {
        "name": "Jogador", "position": "Posicao", "value_m": "Valor_Atual_Mi_EUR",
        "change_pct": "Variacao_Pct", "valuation_date": "Data_Avaliacao",
    },
}


def published(report: DataFrame, name: str) -> DataFrame:
    """Presentation copy under the published headings: ids left out, text only, nulls as ''."""
    headings = HEADINGS[name]
    return blank_nulls(report.select(*(F.col(c).alias(h) for c, h in headings.items())))
