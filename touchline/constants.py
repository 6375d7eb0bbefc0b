"""Fixed values that the results depend on.

Everything here is a name list, a lookup table or a threshold, stated as is so
that results agree with the published ones.
"""

# --- fixed values: thresholds -------------------------------------------------
MIN_MINUTES = 270
MIN_MATCHES = 10
FORM_MATCHES = 5
FULL_MATCH_MINUTES = 90.0
MAX_MATCH_MINUTES = 120.0
ATTACKING_THIRD_X = 80.0
FIRST_SEASON = 2000
TOP_SQUAD = 11
DEPTH_RATING = 75
N_CLUSTERS = 5
N_STARTS = 10
SEED = 42
PCA_VARIANCE = 0.80
CLIP_QUANTILE = 0.99

# --- fixed values: text that stands for a missing value -------------------------
NULL_TOKENS = ("", "nan", "None")

# --- fixed values: competitions --------------------------------------------------
INTERNATIONAL_COMPETITIONS = (
    "FIFA World Cup",
    "UEFA Euro",
    "Copa America",
    "African Cup of Nations",
)
TOP5_COMPETITIONS = ("La Liga", "Serie A", "Ligue 1", "Premier League", "1. Bundesliga")
COMPETITION_LABELS = {
    "La Liga": "La Liga",
    "Premier League": "EPL",
    "English Premier League": "EPL",
    "1. Bundesliga": "Bundesliga",
    "Bundesliga": "Bundesliga",
    "Serie A": "Serie A",
    "Ligue 1": "Ligue 1",
}
COMPETITION_LABEL_ORDER = ("La Liga", "EPL", "Bundesliga", "Serie A", "Ligue 1")
REPORT_LABELS = {
    "La Liga": "La Liga",
    "Serie A": "Serie A",
    "Ligue 1": "Ligue 1",
    "Premier League": "Premier League",
    "English Premier League": "Premier League",
    "1. Bundesliga": "Bundesliga",
    "Bundesliga": "Bundesliga",
}

# --- fixed values: positions --------------------------------------------------------
POSITION_GROUPS = {
    "Goalkeeper": "GK",
    "Center Back": "CB",
    "Left Center Back": "CB",
    "Right Center Back": "CB",
    "Left Back": "FB",
    "Right Back": "FB",
    "Left Wing Back": "FB",
    "Right Wing Back": "FB",
    "Center Defensive Midfield": "CM",
    "Left Defensive Midfield": "CM",
    "Right Defensive Midfield": "CM",
    "Center Midfield": "CM",
    "Left Center Midfield": "CM",
    "Right Center Midfield": "CM",
    "Left Midfield": "CM",
    "Right Midfield": "CM",
    "Attacking Midfield": "AM",
    "Center Attacking Midfield": "AM",
    "Left Attacking Midfield": "AM",
    "Right Attacking Midfield": "AM",
    "Left Wing": "AM",
    "Right Wing": "AM",
    "Secondary Striker": "AM",
    "Center Forward": "FW",
    "Striker": "FW",
    "Left Center Forward": "FW",
    "Right Center Forward": "FW",
}
POSITION_ORDER = ("GK", "CB", "FB", "CM", "AM", "FW")
BROAD_POSITIONS = {
    "Goalkeeper": "Goalkeeper",
    "Center Back": "Defender",
    "Left Back": "Defender",
    "Right Back": "Defender",
    "Left Wing Back": "Defender",
    "Right Wing Back": "Defender",
    "Defensive Midfield": "Midfielder",
    "Center Midfield": "Midfielder",
    "Left Midfield": "Midfielder",
    "Right Midfield": "Midfielder",
    "Attacking Midfield": "Midfielder",
    "Left Wing": "Forward",
    "Right Wing": "Forward",
    "Center Forward": "Forward",
    "Secondary Striker": "Forward",
}

# --- fixed values: country spellings in player profiles -> international results -----
COUNTRY_ALIASES = {
    "Republic of Korea": "South Korea",
    "Korea DPR": "North Korea",
    "Türkiye": "Turkey",
    "Czechia": "Czech Republic",
    "Bosnia & Herzegovina": "Bosnia and Herzegovina",
    "Guinea Bissau": "Guinea-Bissau",
    "Antigua & Barbuda": "Antigua and Barbuda",
    "Trinidad & Tobago": "Trinidad and Tobago",
    "St Kitts Nevis": "Saint Kitts and Nevis",
    "St Lucia": "Saint Lucia",
    "St Vincent Grenadine": "Saint Vincent and the Grenadines",
    "Central African Rep.": "Central African Republic",
    "São Tomé & Príncipe": "São Tomé and Príncipe",
    "Chinese Taipei": "Taiwan",
}
RANKING_ALIASES = {
    "Korea Republic": "South Korea",
    "USA": "United States",
    "Türkiye": "Turkey",
    "Czechia": "Czech Republic",
    "IR Iran": "Iran",
}

# --- fixed values: playing-style features and their labels -----------------------------
FEATURES = (
    "xg_per_90",
    "shots_per_90",
    "passes_per_90",
    "passes_att_third_per_90",
    "pressures_per_90",
    "carries_per_90",
    "dribbles_per_90",
    "interceptions_per_90",
    "blocks_per_90",
    "clearances_per_90",
    "duels_per_90",
    "xg_per_shot",
    "pass_completion_pct",
)
ARCHETYPES = (
    "Low Activity",
    "Creative Playmaker",
    "Creative Winger",
    "Pressing Forward",
    "Defensive Anchor",
)
GOALKEEPER = "Goalkeeper"
QUADRANTS = ("Elite", "Club Specialist", "International Specialist", "Underperformer")
SHIFT_METRICS = (
    "xg_per_90",
    "shots_per_90",
    "passes_per_90",
    "carries_att_third_per_90",
    "carries_per_90",
    "passes_att_third_per_90",
    "pressures_per_90",
    "pass_completion_pct",
)
RATING_BLOCK = ("pace", "shooting", "passing_rating", "dribbling", "defending", "physical")

# --- fixed values: numbers of clusters scanned ----------------------------------------
K_RANGE = range(2, 11)
K_RANGE_RATES = range(3, 9)
