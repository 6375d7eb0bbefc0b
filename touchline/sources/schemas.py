"""Explicit schemas of the input tables."""

from __future__ import annotations

SCHEMAS = {
    "matches": """match_id int, match_date string, kick_off string, competition_id int, season_id int,
        competition_name string, season string, home_team string, away_team string,
        home_score int, away_score int, home_team_gender string""",
    "events": """id string, match_id int, period int, minute int, second int, type string, team string,
        player string, player_id int, location string, play_pattern string,
        shot_statsbomb_xg string, pass_outcome string, duration double""",
    "lineups": """match_id int, player_id int, player_name string, team_name string, jersey_number int,
        positions array<struct<position:string,`from`:string,`to`:string>>,
        cards array<struct<card_type:string>>""",
    "lineups_flat": """match_id int, team_name string, player_name string, jersey_number int,
        position_name string, from_time string, to_time string, card_type string, card_reason string""",
    "three_sixty": """event_uuid string, match_id int, teammate boolean, actor boolean, keeper boolean,
        location_x double, location_y double, visible_area string""",
    "reference": "table_name string, id int, name string, extra_info string",
    "soccer_markets": """market_id long, question string, slug string, event_slug string, category string,
        volume double, active boolean, closed boolean, created_at timestamp, end_date timestamp""",
    "soccer_tokens": "market_id long, token_id long, outcome string",
    "soccer_trades": """trade_id string, market_id long, token_id long, timestamp timestamp, price double,
        size double, side string, maker_address string, taker_address string""",
    "soccer_odds_history": "market_id long, token_id long, timestamp timestamp, price double",
    "player_ratings": """player_id long, player_name string, nationality string, club string, league string,
        positions string, primary_position string, year int, overall int, age int, pace int, shooting int,
        passing_rating int, dribbling int, defending int, physical int,
        was_world_cup_squad_member boolean, world_cup_squad_tournament_year int""",
    "results": """date string, home_team string, away_team string, home_score int, away_score int,
        tournament string, city string, country string, neutral boolean""",
    "former_names": "current string, former string, start_date string, end_date string",
    "rankings": "country string, rank int, points double, confederation string, rank_date string",
    "cluster_labels": "cluster_id int, cluster_label string, description string",
    "competition_code_lookup": "competition_id int, competition_name string, competition_code string",
    "archetype_distribution": "archetype string, seasons long",
    "competition_archetype_counts": "competition_name string, archetype string, seasons long",
    "quadrant_distribution": "quadrant string, players long",
    "data_overview": "n_matches long, n_events long, n_lineups long, n_competitions long",
}
