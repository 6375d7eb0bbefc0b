"""Football-shaped raw tables computed from the given tables, row by row.

Orders become matches, line items become lineup entries and their actions,
orders become prediction markets as well, customers become rated players. Every column
is arithmetic on the source row, so the tables grow with the given ones, and
the raw quirks are there on purpose: text for missing values, stray blanks,
clock text, nested positions, broken timestamps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.constants import COUNTRY_ALIASES, POSITION_GROUPS, RANKING_ALIASES
from touchline.functions.labels import is_international
from touchline.sources.folders import size
from touchline.sources.readers import read_table

COMPETITIONS = (
    "La Liga", "Premier League", "1. Bundesliga", "Serie A", "Ligue 1",
    "FIFA World Cup", "UEFA Euro", "Copa America",
)
COMPETITION_CODES = ("lal", "epl", "bun", "sea", "fl1", "wcup", "euro", "copa")
ACTION_TYPES = (
    "Pass", "Pass", "Carry", "Pressure", "Pass", "Ball Receipt*", "Duel", "Shot", "Carry",
    "Ball Recovery", "Dribble", "Interception", "Clearance", "Block", "Foul Committed", "Tackle", "Shot", "Pass",
)
POSITIONS = tuple(POSITION_GROUPS)
TOURNAMENTS = ("FIFA World Cup", "FIFA World Cup qualification", "Friendly", "UEFA Euro", "Copa América")
ACTIONS_PER_ENTRY = 8
N_NATIONS = 25
#: bytes of line items up to which they are read as they lie, and bytes for each task beyond
SMALL_BYTES = 32 << 20
TASK_BYTES = 1 << 20
STINT = "array<struct<position:string,`from`:string,`to`:string>>"


def _array(names) -> str:
    return "array(" + ", ".join(f"'{n}'" for n in names) + ")"


def _nation_names() -> tuple[list[str], list[str], list[str]]:
    """Names of the 25 nations in results, player profiles and rankings: every published spelling occurs."""
    results = list(dict.fromkeys([*COUNTRY_ALIASES.values(), *RANKING_ALIASES.values()]))
    results += [f"NATION_{i}" for i in range(len(results), N_NATIONS)]
    in_profiles = {name: alias for alias, name in COUNTRY_ALIASES.items()}
    in_rankings = {**in_profiles, **{name: alias for alias, name in RANKING_ALIASES.items()}}
    profiles = [in_profiles.get(n, n) for n in results[:-1]] + ["ATLANTIS"]
    return results, profiles, [in_rankings.get(n, n) for n in results]


RESULT_NAMES, PROFILE_NAMES, RANKING_NAMES = _nation_names()


def _nation(names, number: str) -> str:
    return f"element_at({_array(names)}, cast({number} AS int) + 1)"


def line_parts(spark: SparkSession, folder: str) -> int | None:
    """Into how many tasks the line items of a large table are dealt, so that none grows with the table."""
    held = size(spark, f"{folder}/lineitem.parquet")
    if held <= SMALL_BYTES:
        return None
    return max(held // TASK_BYTES, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _lines(spark: SparkSession, folder: str, *columns: str, dealt_as: str = "bigint") -> DataFrame:
    """Line items. Those of a large table are dealt by match while they are narrow.

    The wide rows made of them then lie by match and are not exchanged again
    to be joined or grouped by it; ``dealt_as`` is the type that the match has there.
    """
    rows = read_table(spark, folder, "lineitem").select(*columns)
    parts = line_parts(spark, folder)
    return rows.repartition(parts, F.col("l_orderkey").cast(dealt_as)) if parts else rows


def raw_matches(spark: SparkSession, folder: str) -> DataFrame:
    return (
        read_table(spark, folder, "orders")
        .selectExpr("o_orderkey AS k", "o_orderkey * 37 % 200 AS t", "o_orderdate AS d", "o_totalprice AS p")
        .selectExpr("*", "cast((t div 4) % 8 AS int) AS ci", "t ^ (1 + k % 3) AS a", "year(d) + 4 AS y")
        .selectExpr(
            "k AS match_id",
            "date_format(d, 'yyyy-MM-dd') AS match_date",
            "concat(12 + k % 9, ':30') AS kick_off",
            "ci + 1 AS competition_id",
            "year(d) - 1990 AS season_id",
            f"element_at({_array(COMPETITIONS)}, ci + 1) AS competition_name",
            "if(ci < 5, concat(y, '/', y + 1), cast(y AS string)) AS season",
            "concat(if(k % 3 = 0, ' ', ''), 'Club ', t) AS home_team",
            "concat('Club ', a, if(k % 5 = 0, ' ', '')) AS away_team",
            "cast(floor(p) AS bigint) % 5 AS home_score",
            "(k div 3) % 4 AS away_score",
            "if((t div 4) % 20 = 7, 'female', 'male') AS home_team_gender",
        )
    )


def raw_events(spark: SparkSession, folder: str, dealt_as: str = "bigint") -> DataFrame:
    slots = F.array(*[F.lit(i) for i in range(ACTIONS_PER_ENTRY)])
    return (
        _lines(spark, folder, "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", dealt_as=dealt_as)
        .select("*", F.explode(slots).alias("slot"))
        .selectExpr(
            "*",
            "l_orderkey * 31 + l_linenumber * 17 + slot * 101 + l_partkey * 7 + l_suppkey * 13 AS h",
            "l_orderkey * 37 % 200 AS t",
        )
        .selectExpr(
            "*",
            f"element_at({_array(ACTION_TYPES)}, cast(h % (10 + l_suppkey % 9) AS int) + 1) AS type",
            "t ^ (1 + l_orderkey % 3) AS a",
        )
        .selectExpr(
            "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, slot) AS id",
            "l_orderkey AS match_id",
            "if(h % 95 >= 46, 2, 1) AS period",
            "h % 95 AS minute",
            "h % 60 AS second",
            "type",
            "if(l_linenumber % 2 = 1, concat('Club ', t), concat('Club ', a, ' ')) AS team",
            "if(h % 97 = 0, 'nan', concat('Player ', l_suppkey)) AS player",
            "l_suppkey AS player_id",
            """CASE WHEN h % 53 = 0 THEN 'nan'
                    WHEN h % 59 = 0 THEN concat('[-0.5, ', h % 81, ']')
                    ELSE concat('[', h % 121, '.', h % 10, ', ', h % 81, '.5]') END AS location""",
            "if(h % 6 = 0, 'Aerial', 'Regular Play') AS play_pattern",
            """CASE WHEN type <> 'Shot' THEN NULL WHEN h % 41 = 0 THEN 'nan'
                    ELSE concat('0.', lpad(cast(h % 1000 * 9765625 AS string), 10, '0')) END AS shot_statsbomb_xg""",
            """CASE WHEN type = 'Pass' AND h % 5 = 0 THEN 'Incomplete'
                    WHEN type = 'Pass' AND h % 7 = 0 THEN 'Assist'
                    WHEN type = 'Pass' AND h % 11 = 0 THEN 'None'
                    WHEN type = 'Shot' AND (h div 7) % 3 = 0 THEN 'Blocked' END AS pass_outcome""",
            "(h % 300) / 32D AS duration",
        )
    )


def raw_lineups(spark: SparkSession, folder: str) -> DataFrame:
    def stint(position: str, start: str, end: str) -> str:
        return f"named_struct('position', {position}, 'from', {start}, 'to', cast({end} AS string))"

    return (
        _lines(spark, folder, "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
        .selectExpr(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
            "l_orderkey + l_linenumber * 3 + l_suppkey AS g", "l_orderkey * 37 % 200 AS t",
        )
        .selectExpr(
            "*",
            f"element_at({_array(POSITIONS)}, cast((l_suppkey + if(g % 7 = 0, 1, 0)) % 27 AS int) + 1) AS p",
            "t ^ (1 + l_orderkey % 3) AS a",
        )
        .selectExpr(
            "l_orderkey AS match_id",
            "l_suppkey AS player_id",
            "concat('Player ', l_suppkey, if(l_suppkey % 25 = 3 AND l_orderkey % 2 = 0, ' Jr', '')) AS player_name",
            "if(l_linenumber % 2 = 1, concat('Club ', t), concat('Club ', a, ' ')) AS team_name",
            "l_partkey % 99 + 1 AS jersey_number",
            f"""CASE WHEN g % 13 = 0 THEN cast(array() AS {STINT})
                     WHEN g % 5 = 0 THEN array({stint('p', "'00:00'", 'NULL')}, {stint("'Left Wing'", "'60:00'", "'75:00'")})
                     WHEN g % 4 = 0 THEN array({stint('p', "concat(45 + g % 40, ':15')", 'NULL')})
                     WHEN g % 17 = 0 THEN array({stint('p', "'00:00'", "'125:00'")})
                     WHEN g % 7 = 0 THEN array({stint('p', "'00:00'", "concat(60 + g % 30, ':30')")})
                     ELSE array({stint('p', "'00:00'", 'NULL')}) END AS positions""",
            """if(g % 19 = 0, array(named_struct('card_type', 'Yellow Card')),
                  cast(array() AS array<struct<card_type:string>>)) AS cards""",
        )
    )


def raw_tracking(spark: SparkSession, folder: str) -> DataFrame:
    return (
        read_table(spark, folder, "lineitem")
        .selectExpr("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_orderkey * 7 + l_partkey * 3 + l_suppkey AS h")
        .selectExpr("*", "explode(sequence(0, cast(h % 5 AS int))) AS i")
        .selectExpr(
            "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, 0) AS event_uuid",
            "l_orderkey AS match_id",
            "(h + i) % 2 = 0 AS teammate",
            "i = 0 AS actor",
            "(h + i) % 11 = 0 AS keeper",
            "((h + i * 13) % 1200) / 10D AS location_x",
            "((h + i * 7) % 800) / 10D AS location_y",
        )
    )


def team_codes(matches: DataFrame) -> DataFrame:
    """Three-letter codes for the generated team names."""
    teams = matches.select(F.explode(F.array("home_team", "away_team")).alias("team")).distinct()
    number = "cast(substring(team, 6) AS int)"
    return teams.selectExpr(
        "team", f"concat(char(97 + {number} div 676), char(97 + {number} div 26 % 26), char(97 + {number} % 26)) AS code"
    )


#: markets on each order
MARKETS = 3


def _market_rows(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """A row for each market: ``market_id``, its number ``j`` on the order, and the columns of the order."""
    orders = read_table(spark, folder, "orders").selectExpr("o_orderkey", *columns, f"explode(sequence(0, {MARKETS - 1})) AS j")
    return orders.selectExpr(f"o_orderkey * {MARKETS} + j AS market_id", "*")


def markets(spark: SparkSession, folder: str) -> DataFrame:
    """Three markets for each match; one match in ten has markets on the winner of its competition instead."""

    def code(n: str) -> str:
        return f"concat(char(97 + {n} div 676), char(97 + {n} div 26 % 26), char(97 + {n} % 26))"

    rows = _market_rows(spark, folder, "o_orderdate", "o_totalprice", "o_custkey", "o_orderpriority")
    return (
        rows.selectExpr("*", "o_orderkey AS k", "o_orderdate AS d", "o_orderkey * 37 % 200 AS t", "cast((o_orderkey * 7 + j * 3) % 50 AS int) + 1 AS z")
        .selectExpr("*", "t ^ (1 + k % 3) AS a", f"element_at({_array(COMPETITION_CODES)}, cast((t div 4) % 8 AS int) + 1) AS c")
        .selectExpr(
            "market_id",
            "concat('Customer ', o_custkey, ' ', j) AS question",
            f"""if(k % 10 = 9, concat(c, '-winner-', year(d)),
                   concat(c, '-', {code('t')}, '-', {code('a')}, '-', date_format(d, 'yyyy-MM-dd'))) AS event_slug""",
            "o_orderpriority AS category",
            "floor(o_totalprice) * cast(z AS double) AS volume",
            "z % 2 = 0 AS active",
            "z % 5 = 0 AS closed",
            "cast(date_sub(cast(d AS date), z) AS timestamp) AS created_at",
            "d AS end_date",
        )
    )


def misspelled(stats: DataFrame) -> DataFrame:
    """Event slugs with wrong letters and kick-off days one off, by the day of the month; ``source_slug`` keeps the right one."""
    day = "cast(substring(source_slug, -2, 2) AS int)"
    parts = F.split("source_slug", "-")
    rows = stats.withColumnRenamed("event_slug", "source_slug").withColumn("p", parts)
    home = f"if({day} % 7 = 3, concat(substring(p[1], 1, 1), 'x', substring(p[1], 3, 1)), p[1])"
    away = f"if({day} % 5 = 2, concat(substring(p[2], 1, 2), 'q'), p[2])"
    date = f"date_add(to_date(concat_ws('-', p[3], p[4], p[5])), if({day} % 11 = 4, 1, 0))"
    slug = f"if(size(p) = 6, concat_ws('-', p[0], {home}, {away}, {date}), source_slug)"
    return rows.withColumn("event_slug", F.expr(slug)).drop("p")


def tokens(spark: SparkSession, folder: str) -> DataFrame:
    return (
        _market_rows(spark, folder)
        .drop("j")
        .selectExpr("market_id", "explode(sequence(0, if(market_id % 50 = 0, 2, 1))) AS j")
        .selectExpr(
            "market_id",
            "market_id * 10 + j AS token_id",
            """CASE WHEN j = 2 THEN 'Draw' WHEN market_id % 7 = 0 THEN if(j = 0, 'Over', 'Under')
                    ELSE if(j = 0, 'Yes', 'No') END AS outcome""",
        )
    )


def trades(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "lineitem").selectExpr(
        "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS trade_id",
        f"l_orderkey * {MARKETS} + l_partkey % {MARKETS} AS market_id",
        f"(l_orderkey * {MARKETS} + l_partkey % {MARKETS}) * 10 + l_linenumber % 2 AS token_id",
        "l_shipdate AS timestamp",
        "(l_quantity - 1) / 48D AS price",
        "l_extendedprice AS size",
        "if(l_linestatus = 'O', 'BUY', 'SELL') AS side",
        "concat('0x', l_orderkey) AS maker_address",
        "if(l_suppkey % 3 = 0, '', concat('0x', l_suppkey)) AS taker_address",
    )


def odds(spark: SparkSession, folder: str) -> DataFrame:
    """Price snapshots whose epoch seconds were stored as milliseconds; a user follows the first market of one order."""
    return read_table(spark, folder, "events").selectExpr(
        "event_id",
        f"user_id * {MARKETS} AS market_id",
        f"user_id * {MARKETS} * 10 + event_id % 2 AS token_id",
        "timestamp_millis(unix_seconds(cast(ts AS timestamp))) AS timestamp",
        "(event_id % 1006) / 1000D - 0.0025D AS price",
    )


def players(spark: SparkSession, folder: str) -> DataFrame:
    customers = read_table(spark, folder, "customer")
    nations = read_table(spark, folder, "nation").selectExpr("n_nationkey AS c_nationkey")
    return customers.join(nations, on="c_nationkey", how="inner").selectExpr(
        "c_custkey AS player_id",
        "c_name AS player_name",
        f"{_nation(PROFILE_NAMES, 'c_nationkey')} AS nationality",
        "c_mktsegment AS league",
        "element_at(array('GK', 'CB', 'FB', 'CM', 'AM', 'FW'), cast(c_custkey % 11 % 6 AS int) + 1) AS primary_position",
        "2022 + c_custkey % 5 AS year",
        "50 + c_custkey * 17 % 45 AS overall",
        "18 + c_custkey % 20 AS age",
        "if(c_custkey % 13 = 0, NULL, 40 + c_custkey * 3 % 55) AS pace",
        "40 + c_custkey * 5 % 55 AS shooting",
        "40 + c_custkey * 7 % 55 AS passing_rating",
        "40 + c_custkey * 9 % 55 AS dribbling",
        "40 + c_custkey * 11 % 55 AS defending",
        "40 + cast(floor(abs(c_acctbal)) AS bigint) % 55 AS physical",
        "c_custkey % 5 = 0 AND c_custkey % 3 = 0 AS was_world_cup_squad_member",
        "if(c_custkey % 5 = 0 AND c_custkey % 3 = 0, 2022, NULL) AS world_cup_squad_tournament_year",
    )


def results(spark: SparkSession, folder: str) -> DataFrame:
    def team(n: str) -> str:
        return f"concat(if({n} % 5 = 4 AND date <= DATE'2022-06-30', 'OLD_', ''), {_nation(RESULT_NAMES, n)})"

    return (
        read_table(spark, folder, "orders")
        .selectExpr(
            "o_orderkey AS k", "o_orderstatus AS s", "o_totalprice AS p", "o_orderpriority AS pr",
            "date_add(cast(o_orderdate AS date), 9131) AS date",
            "o_orderkey * 7 % 25 AS h", "(o_orderkey * 7 + 1 + o_orderkey % 24) % 25 AS a",
        )
        .selectExpr(
            "k AS match_id",
            "date",
            f"{team('h')} AS home_team",
            f"{team('a')} AS away_team",
            "if(s = 'P' AND k % 4 = 0, NULL, cast(floor(p) AS bigint) % 5) AS home_score",
            "if(s = 'P' AND k % 4 = 0, NULL, (k div 3) % 4) AS away_score",
            f"element_at({_array(TOURNAMENTS)}, cast(substring(pr, 1, 1) AS int)) AS tournament",
            "concat('City ', h) AS city",
            f"{_nation(RESULT_NAMES, 'h')} AS country",
            "k % 3 = 0 AS neutral",
        )
    )


def former_names(spark: SparkSession, folder: str) -> DataFrame:
    return (
        read_table(spark, folder, "nation")
        .filter("n_nationkey % 5 = 4")
        .selectExpr(f"{_nation(RESULT_NAMES, 'n_nationkey')} AS n_name")
        .selectExpr(
            "n_name AS current", "concat('OLD_', n_name) AS former",
            "DATE'2000-01-01' AS start_date", "DATE'2022-06-30' AS end_date",
        )
    )


def rankings(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly points per nation: what its customers ordered, shifted like the results."""
    return (
        read_table(spark, folder, "orders")
        .selectExpr(
            f"{_nation(RANKING_NAMES, 'o_custkey % 25')} AS country",
            "concat('CONF_', o_custkey % 25 % 5) AS confederation",
            "cast(date_trunc('month', cast(date_add(cast(o_orderdate AS date), 9131) AS timestamp)) AS date) AS rank_date",
            "cast(floor(o_totalprice) AS bigint) AS v",
        )
        .groupBy("country", "confederation", "rank_date")
        .agg((F.sum("v") % 997).cast("double").alias("points"))
    )


def clock_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Clock text of every kind, from the event log."""
    return read_table(spark, folder, "events").selectExpr(
        "event_id",
        """CASE event_id % 9
               WHEN 0 THEN concat(event_id % 95, ':', lpad(cast(event_id % 60 AS string), 2, '0'))
               WHEN 1 THEN concat('1:', lpad(cast(event_id % 60 AS string), 2, '0'), ':', lpad(cast(event_id % 59 AS string), 2, '0'))
               WHEN 2 THEN concat('90+', event_id % 9, ':', lpad(cast(event_id % 60 AS string), 2, '0'))
               WHEN 3 THEN '' WHEN 4 THEN 'nan' WHEN 5 THEN NULL WHEN 6 THEN 'abc'
               WHEN 7 THEN concat('90+', event_id % 9)
               ELSE concat(' ', event_id % 120, ':30 ') END AS clock""",
    )


def with_flags(matches: DataFrame) -> DataFrame:
    """Raw matches with the columns of the exploration layout."""
    return matches.withColumnRenamed("season", "season_name").select(
        "*",
        is_international("competition_name").alias("is_international"),
        F.col("home_team_gender").alias("gender"),
        F.lit(False).alias("is_youth"),
    )
