"""Reading, shaping and writing tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.plans import exploration, reports, staging
from touchline.session import new_folder
from touchline.sources import readers, writers
from touchline.workload import base, feeds
from touchline.workload.registry import query
from touchline.workload.tables_sql import with_tables


@query(
    "scan_pruned",
    ["A1", "A4"],
    "SELECT l_returnflag, count(*) AS n, sum(l_quantity) AS qty FROM lineitem WHERE l_quantity > 25 GROUP BY 1",
    doubles=["qty"],
)
def scan_pruned(spark, d):
    return readers.query_files(
        spark,
        f"{d}/lineitem.parquet",
        "SELECT l_returnflag, count(*) AS n, sum(l_quantity) AS qty FROM {src} WHERE l_quantity > 25 GROUP BY l_returnflag",
    )


_RESULT_COLUMNS = "date, home_team, away_team, home_score, away_score, tournament, city, country, neutral"


@query(
    "csv_results",
    ["A2"],
    with_tables(f"SELECT {_RESULT_COLUMNS} FROM results", "results"),
    texts=["date"],
)
def csv_results(spark, d):
    path = new_folder(spark, "results")
    feeds.results(spark, d).select(*[c.strip() for c in _RESULT_COLUMNS.split(",")]).write.option("header", True).csv(path)
    return readers.read_results(spark, path)


@query(
    "published_models",
    ["A3", "A11", "A13"],
    with_tables(
        "SELECT competition_name, count(*) AS n FROM stg_matches GROUP BY 1", "stg_matches"
    ),
)
def published_models(spark, d):
    writers.publish(feeds.raw_matches(spark, d), "touchline_raw_matches", "view")
    stored = staging.matches(readers.catalog_table(spark, "touchline_raw_matches"))
    writers.publish(stored, "touchline_matches", "table", new_folder(spark, "matches"))
    return readers.catalog_table(spark, "touchline_matches").groupBy("competition_name").agg(F.count(F.lit(1)).alias("n"))


@query(
    "flatten_and_clean",
    ["A5", "A6", "A7"],
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS props_k,
              nullif(event_type, 'error') AS "col_1st_type", user_id AS props_who_id
       FROM events""",
)
def flatten_and_clean(spark, d):
    nested = readers.read_table(spark, d, "events").select(
        "event_id",
        F.struct(
            F.from_json("props", "k long").getField("k").alias("k"), F.struct(F.col("user_id").alias("id")).alias("who")
        ).alias("props"),
        F.when(F.col("event_type") == "error", "nan").otherwise(F.col("event_type")).alias("1st-type"),
    )
    return readers.null_tokens(readers.clean_names(readers.flatten_structs(nested)))


@query(
    "competition_scope",
    ["A8"],
    with_tables(
        """SELECT DISTINCT competition_name, season AS season_name, home_team_gender AS competition_gender FROM raw_matches
           WHERE competition_name IN ('La Liga', 'FIFA World Cup') AND home_team_gender = 'male' AND substr(season, 1, 4)::INT >= 1970""",
        "raw_matches",
    ),
)
def competition_scope(spark, d):
    listed = feeds.raw_matches(spark, d).select(
        "competition_name", F.col("season").alias("season_name"), F.col("home_team_gender").alias("competition_gender")
    ).distinct()
    return staging.scope(listed, ["La Liga", "FIFA World Cup"], "male", 1970)


@query(
    "part_files",
    ["A9", "A10"],
    "SELECT l_returnflag, '2024-01-01' AS load_date, count(*) AS n, sum(l_quantity) AS qty FROM lineitem GROUP BY 1",
    doubles=["qty"],
    texts=["load_date"],
)
def part_files(spark, d):
    parts, landed = new_folder(spark, "parts"), new_folder(spark, "landing")
    rows = readers.read_table(spark, d, "lineitem").select("l_orderkey", "l_returnflag", "l_quantity")
    writers.write_parts(rows, parts, rows_per_file=5000)
    back = spark.read.schema(rows.schema).parquet(parts)
    for _ in range(2):
        writers.land(back, landed, "lines", "2024-01-01")
    return (
        spark.read.parquet(f"{landed}/lines")
        .groupBy("l_returnflag", "load_date")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("qty"))
    )


@query(
    "mart_sink",
    ["A12"],
    with_tables(
        "SELECT strftime(match_date, '%Y-%m') AS month, competition_id, count(*) AS n, min(match_date) AS first_day FROM stg_matches GROUP BY 1, 2",
        "stg_matches",
    ),
    longs=["competition_id"],
    texts=["first_day"],
)
def mart_sink(spark, d):
    path = new_folder(spark, "mart")
    table = base.Run(spark, d).stg_matches
    writers.write_mart(table, path)
    stored = spark.read.parquet(path)
    return stored.groupBy(F.date_format("match_date", "yyyy-MM").alias("month"), "competition_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("match_date").alias("first_day")
    )


@query(
    "clustered_scan",
    ["A4", "A12"],
    with_tables(
        "SELECT match_id, count(*) AS shots, sum(shot_xg) AS xg FROM stg_events WHERE event_type = 'Shot' GROUP BY 1",
        "stg_events",
    ),
    doubles=["xg"],
)
def clustered_scan(spark, d):
    """Shots by match, from actions stored so that a scan of one type skips the row groups of the others."""
    path = new_folder(spark, "clustered")
    writers.write_clustered(base.Run(spark, d).stg_events, path, ["event_type", "match_id"], files=feeds.line_parts(spark, d))
    shots = spark.read.parquet(path).where("event_type = 'Shot'")
    return shots.groupBy("match_id").agg(F.count(F.lit(1)).alias("shots"), F.sum("shot_xg").alias("xg"))


@query(
    "report_cache",
    ["A14", "A15"],
    with_tables("SELECT archetype, count(*) AS seasons FROM assignments GROUP BY 1", "assignments"),
)
def report_cache(spark, d):
    folder = new_folder(spark, "report")
    counts = reports.archetype_distribution(base.Run(spark, d).assignments)
    writers.export_summary(counts, f"{folder}/archetype_distribution", "csv", one_file=True)
    writers.export_summary(counts, f"{folder}/archetype_distribution_json", "json", one_file=True)
    return readers.read_summaries(spark, folder, ["archetype_distribution"])["archetype_distribution"]


@query(
    "seed_lookup",
    ["A16"],
    with_tables(
        """SELECT competition_name, upper(substr(competition_name, 1, 3)) AS competition_code, count(*) AS n
           FROM stg_matches GROUP BY 1, 2""",
        "stg_matches",
    ),
)
def seed_lookup(spark, d):
    path = new_folder(spark, "seed")
    matches = base.Run(spark, d).stg_matches
    codes = matches.select(
        F.col("competition_id").cast("int"), "competition_name", F.upper(F.substring("competition_name", 1, 3)).alias("competition_code")
    ).distinct()
    writers.export_summary(codes, path, one_file=True)
    seed = readers.read_seed(spark, path, "competition_code_lookup")
    counts = matches.groupBy("competition_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(seed, on="competition_id").select("competition_name", "competition_code", "n")


@query(
    "random_sample",
    ["A17"],
    "SELECT least(count(*), 50000) AS n, count(DISTINCT l_returnflag) AS flags FROM lineitem",
)
def random_sample(spark, d):
    rows = exploration.sample_rows(readers.read_table(spark, d, "lineitem").select("l_returnflag", "l_orderkey"), 50_000, seed=42)
    return rows.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("l_returnflag").alias("flags"))


@query(
    "schema_of_table",
    ["A18"],
    """SELECT column_name, CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
              WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' END AS column_type
       , (SELECT count(*) FROM lineitem) AS n_rows FROM (DESCRIBE SELECT * FROM lineitem)""",
)
def schema_of_table(spark, d):
    lines = readers.read_table(spark, d, "lineitem")
    shape = lines.agg(F.count(F.lit(1))).scalar()
    return exploration.describe(lines).select("column_name", "column_type", shape.alias("n_rows"))


@query(
    "adaptive_columns",
    ["A19", "A20"],
    with_tables("SELECT player_id, cluster AS cluster_id, archetype, CAST(NULL AS DOUBLE) AS pc1 FROM assignments", "assignments"),
    longs=["cluster_id"],
)
def adaptive_columns(spark, d):
    rows = base.Run(spark, d).assignments
    doubled = rows.select("*", F.col("player_id").alias("PLAYER_ID"), F.lit("x").alias("archetype"))
    single = readers.drop_dup_columns(doubled)
    return readers.adapt(
        single,
        {
            "player_id": ("long", ()),
            "cluster_id": ("int", ("cluster",)),
            "archetype": ("string", ("cluster_label",)),
            "pc1": ("double", ()),
        },
    )
