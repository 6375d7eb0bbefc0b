"""Clock, location, missing text, labels and bins."""

import pytest
from pyspark.sql import functions as F

from touchline.functions import labels, rates, text
from touchline.plans import exploration, players, staging
from touchline.sources import readers

STINT = "match_id int, player_id int, player_name string, team_name string, jersey_number int, positions array<struct<position:string,`from`:string,`to`:string>>, cards array<struct<card_type:string>>"


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "clock, plain, hms, stoppage",
    [
        ("45:30", 45.5, 45.5, 45.5),
        ("00:00", 0.0, 0.0, 0.0),
        ("1:30:00", None, 90.0, None),
        ("90+3:30", None, None, 93.5),
        ("90+3", None, None, 93.0),
        ("", None, None, None),
        ("nan", None, None, None),
        ("abc", None, None, None),
        (None, None, None, None),
    ],
)
def test_clock(spark, clock, plain, hms, stoppage):
    c = F.lit(clock).cast("string")
    assert one(spark, text.clock_minutes(c)) == plain
    assert one(spark, text.clock_minutes(c, hms=True)) == hms
    assert one(spark, text.clock_minutes(c, stoppage=True)) == stoppage


@pytest.mark.parametrize(
    "value, x, y",
    [("[61.0, 40.1]", 61.0, 40.1), ("[-0.5, 80]", -0.5, 80.0), (None, None, None), ("nan", None, None)],
)
def test_location(spark, value, x, y):
    got = text.parse_location(F.lit(value).cast("string"))
    assert (one(spark, got[0]), one(spark, got[1])) == (x, y)


def test_location_array(spark):
    got = text.location_xy(F.array(F.lit(61.0)))
    assert (one(spark, got[0]), one(spark, got[1])) == (61.0, None)


@pytest.mark.parametrize("token", ["nan", "None", ""])
def test_missing_text(spark, token):
    assert one(spark, text.null_if_token(F.lit(token))) is None
    assert one(spark, text.null_if_token(F.lit("x"))) == "x"


@pytest.mark.parametrize("value, flag", [("true", True), (" National", True), ("1", True), ("0", False), ("CLUB", False)])
def test_context_flag(spark, value, flag):
    assert one(spark, labels.context_flag(F.lit(value))) is flag


def test_context_flag_refuses_others(spark):
    with pytest.raises(Exception, match="not a context flag"):
        one(spark, labels.context_flag(F.lit("maybe")))


def test_slug(spark):
    parts = text.slug_parts(F.lit("epl-ars-che-2024-12-01"))
    assert one(spark, parts["home_code"]) == "ars"
    assert str(one(spark, parts["slug_date"])) == "2024-12-01"
    assert one(spark, text.slug_parts(F.lit("epl-winner-2025"))["home_code"]) is None


def test_event_type(spark):
    assert one(spark, text.event_type_key(F.lit(' {"name": " Shot "}'))) == "shot"
    assert one(spark, text.event_type_key(F.lit(" Pass "))) == "pass"


def test_positions(spark):
    assert one(spark, labels.position_group(F.lit("Left Wing Back"))) == "FB"
    assert one(spark, labels.position_group(F.lit("Unknown"))) is None
    assert one(spark, labels.broad_position(F.lit("Sweeper"))) == "Unknown"


def test_minute_bins(spark):
    minutes = spark.createDataFrame([(v,) for v in (None, 0.0, 14.9, 15.0, 90.0, 105.0, 105.1, 120.0)], "minutes_played double")
    got = {r["min_bin"]: r["n"] for r in exploration.minute_bins(minutes).collect()}
    assert got == {"null": 1, "0-15": 2, "15-30": 1, "90-105": 2, "105-120": 2}


def test_clamp_keeps_null(spark):
    assert one(spark, rates.clamp(F.lit(1.2), 0, 1)) == 1.0
    assert one(spark, rates.clamp(F.lit(None).cast("double"), 0, 1)) is None


def _lineup(spark, positions):
    raw = spark.createDataFrame([(1, 7, "A", "T ", 9, positions, [])], STINT)
    return players.lineup_minutes(staging.lineups(raw, spark.createDataFrame([(1,)], "match_id long"))).first()


@pytest.mark.parametrize(
    "positions, minutes, position",
    [
        ([("Left Wing", "00:00", None), ("Right Wing", "60:00", "75:00")], 75.0, "Left Wing"),
        ([], 90.0, "Unknown"),
        ([("Left Back", "00:00", "125:00")], 120.0, "Left Back"),
        ([("Left Back", "60:15", None)], 29.75, "Left Back"),
    ],
)
def test_minutes(spark, positions, minutes, position):
    row = _lineup(spark, positions)
    assert (row["minutes_played"], row["position_name"], row["team_name"]) == (minutes, position, "T")


def test_flatten_and_clean(spark):
    df = spark.sql("SELECT named_struct('b', named_struct('c', 1), 'd', 'nan') AS a, 2 AS `1x-y z`")
    out = readers.null_tokens(readers.clean_names(readers.flatten_structs(df)))
    assert out.columns == ["a_b_c", "a_d", "col_1x_y_z"]
    assert tuple(out.first()) == (1, None, 2)


def test_drop_duplicate_columns(spark):
    df = spark.sql("SELECT 1 AS a, 2 AS A, 3 AS b")
    assert readers.drop_dup_columns(df).columns == ["a", "b"]


def test_adapt(spark):
    df = spark.sql("SELECT 1 AS cluster")
    out = readers.adapt(df, {"cluster_id": ("long", ("cluster",)), "pc1": ("double", ())})
    assert tuple(out.first()) == (1, None)
