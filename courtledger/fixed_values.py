"""Values that have to be the same everywhere for results to agree.

Everything in this file is a fixed value: column names and their order in the scraped tables,
marker texts, codes and lookup tables. No logic lives here.
"""

# Columns of a player table, in page order.
PLAYER_COLUMNS = [
    "nom", "minute",
    "tir_reussi", "tir_tentes", "pct_tir",
    "trois_pt_r", "trois_pt_t", "pct_3_pt",
    "lanc_frc_r", "lanc_frc_t", "pct_lfrc",
    "rebonds_o", "rebonds_d", "rebonds",
    "passes_dec", "steal", "contres", "ball_perdu", "faute_p",
    "points", "plus_moins",
]

# Columns of a game table; overtime columns pr1, pr2, ... go before "final".
TEAM_COLUMN = "id_equipe"
REGULAR_PERIODS = ["q1", "q2", "q3", "q4"]
OVERTIME_PREFIX = "pr"
FINAL_PERIOD = "final"

# Columns of a team statistics table, in page order.
TEAM_STAT_COLUMNS = [
    "id_equipe", "pts_in_paint", "fastbreak_pts", "biggest_lead", "pts_banc",
    "tm_rebonds", "ball_perdu", "tm_ball_perdu", "pt_subi_ctrattaq",
]

# Columns of a stored player fact, in stored order (the game id is added last).
PLAYER_FACT_COLUMNS = [
    "minute", "points", "rebonds", "passes_dec", "steal", "contres",
    "tir_reussi", "tir_tentes", "pct_tir",
    "trois_pt_r", "trois_pt_t", "pct_3_pt",
    "lanc_frc_r", "lanc_frc_t", "pct_lfrc",
    "rebonds_o", "rebonds_d", "ball_perdu", "faute_p", "plus_moins",
    "score_ttfl", "id_joueur",
]

# What counts for and against a player in the score.
SCORE_COLUMN = "score_ttfl"
SCORE_GAINS = ["points", "rebonds", "passes_dec", "steal", "contres",
               "tir_reussi", "trois_pt_r", "lanc_frc_r"]
SCORE_LOSSES = ["ball_perdu"]
SCORE_MADE_ATTEMPTED = [("tir_reussi", "tir_tentes"),
                        ("trois_pt_r", "trois_pt_t"),
                        ("lanc_frc_r", "lanc_frc_t")]

# Texts in the minute column.
DID_NOT_PLAY_TEXTS = ["Pas en tenue", "N'a pas joué", "Pas avec l'équipe", "DNP", "NWT", "DND"]
INJURY_TEXT = "Injury/Illness"

# Generational suffixes of a name, lower-cased.
NAME_SUFFIXES = ["jr.", "sr.", "ii", "iii", "iv", "v"]

# Codes.
UNKNOWN_INJURY_TYPE = 99
REGULAR_SEASON = 0
DEFAULT_SEASON = 3
SLUG_SEPARATOR = "-vs-"
FULL_POSITIONS = ["Center", "Guard", "Forward"]
OTHER_POSITION = "NC"
STARTERS = 5

# Positions on the court.
POSITIONS = [
    ("F", "Forward ; 3 ; ailier"),
    ("G", "Guard ; 1 ou 2  ; meneur ou arriere"),
    ("C", "Center ; 5 ; Pivot"),
    ("C-F", "Power Forward ; 4 ; ailier Fort"),
    ("F-G", "Shooting Guard ; 2 ; arriere"),
    ("G-F", "Shooting Guard ; 2 ; arriere"),
    ("F-C", "Power Forward ; 4 ; ailier Fort"),
    ("NC", "Non connue"),
]

# Team names by code.
TEAM_NAMES = {
    "ATL": "Atlanta Hawks", "BKN": "Brooklyn Nets", "BOS": "Boston Celtics",
    "CHA": "Charlotte Hornets", "CHI": "Chicago Bulls", "CLE": "Cleveland Cavaliers",
    "DAL": "Dallas Mavericks", "DEN": "Denver Nuggets", "DET": "Detroit Pistons",
    "GSW": "Golden State Warriors", "HOU": "Houston Rockets", "IND": "Indiana Pacers",
    "LAC": "Los Angeles Clippers", "LAL": "LosAngeles Lakers", "MEM": "Memphis Grizzlies",
    "MIA": "Miami Heat", "MIL": "Milwaukee Bucks", "MIN": "Minessota TimberWolves",
    "NOP": "New-Orleans Pelicans", "NYK": "New-York Knicks", "OKC": "Oklahoma City Thunder",
    "ORL": "Orlando Magic", "PHI": "Philadelphia Sixers", "PHX": "Phoenix",
    "POR": "Portland TrailBlazzers", "SAC": "Sacramento Kings", "SAS": "San-Antonio Spurs",
    "TOR": "Toronto Raptors", "UTA": "Utah Jazz", "WAS": "Washington Wizards",
}

# Teams of each division, divisions of each conference.
DIVISIONS = {
    "Atlantic Division": ["BKN", "BOS", "NYK", "PHI", "TOR"],
    "Central Division": ["CHI", "CLE", "DET", "IND", "MIL"],
    "Northwest Division": ["DEN", "MIN", "OKC", "POR", "UTA"],
    "Pacific Division": ["GSW", "LAC", "LAL", "PHX", "SAC"],
    "Southeast Division": ["ATL", "CHA", "MIA", "ORL", "WAS"],
    "Southwest Division": ["DAL", "HOU", "MEM", "NOP", "SAS"],
}
CONFERENCES = {
    "Est": ["Atlantic Division", "Central Division", "Southeast Division"],
    "Ouest": ["Northwest Division", "Pacific Division", "Southwest Division"],
}
