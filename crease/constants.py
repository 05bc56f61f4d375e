"""Fixed values of the domain: names, bounds and thresholds results depend on."""

# Wicket kinds that count for the bowler.
BOWLER_CREDITED_KINDS = (
    "bowled",
    "caught",
    "caught and bowled",
    "lbw",
    "stumped",
    "hit wicket",
    "hit the ball twice",
)

# Phase name, first over, last over (0-based, inclusive).
PHASE_BOUNDS = (
    ("Powerplay", 0, 5),
    ("Middle", 6, 15),
    ("Death", 16, 19),
)
PHASES = tuple(name for name, _, _ in PHASE_BOUNDS)
OTHER_PHASE = "Other"

# Separator of multi-valued text columns.
LIST_SEPARATOR = "; "

# Smallest sample that enters an index or report.
MIN_IMPACT_BALLS = 600
MIN_DEATH_BALLS = 120
MIN_VENUE_MATCHES = 5
MIN_PHASE_INNINGS = 10
MIN_BEST_TEAM_MATCHES = 50
MIN_POWERPLAY_BALLS = 30
MIN_HALFWAY_BALLS = 55

# Lengths of an innings.
BALLS_PER_OVER = 6
OVERS_PER_INNINGS = 20
BALLS_PER_INNINGS = 120
WICKETS_PER_INNINGS = 10

# Weights of the composite scores.
BATTING_WEIGHTS = {"strike_rate": 0.45, "average": 0.35, "boundary": 0.20}
BOWLING_WEIGHTS = {"wicket_rate": 0.45, "economy": 0.35, "dot": 0.20}
DEATH_BATTING_WEIGHTS = {"strike_rate": 0.70, "boundary": 0.30}
ROLE_DOMINANCE = 1.4

# Model settings.
RANDOM_SEED = 42
SEASON_DECAY = 0.15

# Historic team name -> current team name.
TEAM_RENAMES = {
    "Royal Challengers Bangalore": "Royal Challengers Bengaluru",
    "Kings XI Punjab": "Punjab Kings",
    "Delhi Daredevils": "Delhi Capitals",
    "Deccan Chargers": "Sunrisers Hyderabad",
    "Gujarat Lions": "Gujarat Titans",
    "Rising Pune Supergiant": "Lucknow Super Giants",
    "Rising Pune Supergiants": "Lucknow Super Giants",
    "Pune Warriors": "Lucknow Super Giants",
}

# Current team -> home venue.
HOME_VENUES = {
    "Chennai Super Kings": "MA Chidambaram Stadium, Chepauk, Chennai",
    "Mumbai Indians": "Wankhede Stadium, Mumbai",
    "Royal Challengers Bengaluru": "M Chinnaswamy Stadium, Bengaluru",
    "Kolkata Knight Riders": "Eden Gardens, Kolkata",
    "Rajasthan Royals": "Sawai Mansingh Stadium, Jaipur",
    "Sunrisers Hyderabad": "Rajiv Gandhi International Stadium, Uppal, Hyderabad",
    "Delhi Capitals": "Arun Jaitley Stadium, Delhi",
    "Punjab Kings": "Punjab Cricket Association IS Bindra Stadium, Mohali",
    "Gujarat Titans": "Narendra Modi Stadium, Ahmedabad",
    "Lucknow Super Giants": "Bharat Ratna Shri Atal Bihari Vajpayee Ekana Cricket Stadium, Lucknow",
}
