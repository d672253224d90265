"""Fixed values.

Everything in this file is a stated value of the specification: changing one
changes results.  No logic lives here.
"""

# Periods searched for, in search order: (days, allowed error in days, name).
PERIODS = (
    (7, 2, "weekly"),
    (14, 2, "biweekly"),
    (30.5, 4, "monthly"),
    (61, 4, "bimonthly"),
    (91.5, 5, "quarterly"),
)
MIN_CYCLE_LENGTH = 3
MAX_CYCLES_PER_GROUP = 2

# Source selection.
APP_START_DATE = "2018-09-01"
APP_END_DATE = "2020-09-01"
APP_COUNTRIES = ("FR", "IT", "GB")
PARTNER_COUNTRIES = ("NL",)
APP_USERS_SAMPLE = 20000
PARTNER_USERS_SAMPLE = 5000
SAMPLE_SEED = 42

# Counterparty grouping: cosine distance <= 0.3, i.e. similarity >= 0.7.  On
# binary gram sets that is shared^2 * 100 >= 49 * n * m in whole numbers.
MIN_NEIGHBOUR_WEIGHT = 3
SIMILARITY_SQUARED_PERCENT = 49

# Transactions that never form a cycle.
NEVER_CYCLE_DESCRIPTION = (
    "apple pay|card purchase|contactless|daily od|google pay|samsung pay"
)
NEVER_CYCLE_COUNTERPARTIES = (
    "- THANK YOU", "AMZNMktplace", "ASOS", "Aldi", "Amazon Marketplace", "Asda",
    "Asda Petrol", "BMACH", "BP", "Bet365", "CARDTRONICS", "Caffe Nero",
    "Carrefour", "Cash Withdrawal", "Co-operative Group", "Costa Coffee",
    "Deliveroo", "Domino's Pizza", "Esso", "Greggs", "Home Bargains", "INTERNET",
    "Iceland", "J D Wetherspoon", "Just-Eat", "KFC", "LNK", "Lidl",
    "London Underground", "MOBILE XFER", "McDonald's", "Monzo Pot", "Morrisons",
    "Nando's", "Poundland", "Pret A Manger", "Primark", "Retrait DAB", "Revolut",
    "RingGo", "SAVETHECHANGE-", "SPAR", "Sainsbury's", "Shell",
    "Sky Betting and Gaming", "Starbucks", "Subway", "Superdrug", "Tesco Petrol",
    "Trainline", "Uber", "Uber Eats", "WHSmith", "Waitrose", "Wilko",
    "b&m retail", "eBay", "visa",
)
NEVER_CYCLE_UNLESS_DESCRIPTION = {
    "Tesco": "tesco bank",
    "Marks & Spencer": "personal loans|bank",
    "Amazon.com": "digital|music",
    "Boots": "rewardscheme",
    "Transport for London": "autopay|auto pay",
    "Post Office": "insurance",
}

# Training sets.
TEST_FRACTION = 0.1
VALIDATION_FRACTION = 0.1
EVALUATION_FRACTION = 0.02
HAS_CYCLE_TRAIN_ROWS = 900_000
HAS_CYCLE_VALIDATION_ROWS = 111_111
NEXT_DATE_MIN = 0
NEXT_DATE_MAX = 100
SIGNED_AMOUNT_MIN = -1000
CYCLES_PER_ACCOUNT_MAX = 30
MATCH_OFFSET_DAYS = 4

# Models.
HAS_CYCLE_THRESHOLD = 0.85
IS_NEXT_THRESHOLD = 0.95
TEXT_BUCKETS = 40_000
LOOKAHEAD_STEPS = 4
AMOUNT_DIFFERENCE_CLIP = 10
EARLY_STOPPING_ROUNDS = 10
BOOSTING_ROUNDS = 100
HAS_CYCLE_STEP = 0.1844995924535978
HAS_CYCLE_BINS = 60
HAS_CYCLE_LEAF_ROWS = 26
HAS_CYCLE_COLUMNS = 0.48506021034708374
HAS_CYCLE_L1 = 6.552391941686875e-07
HAS_CYCLE_L2 = 0.0001611143518293986
NEXT_DATE_STEP = 0.15664864795508857
NEXT_DATE_BINS = 215
NEXT_DATE_LEAF_ROWS = 649
NEXT_DATE_COLUMNS = 0.7899505481564448

# Replay and life cycle of a prediction.
WINDOW_DAYS = 4
HORIZON_DAYS = 28
SHIFT_DAYS = 3

# Release gate: each metric has to be above its floor.
METRIC_FLOORS = {
    "precision_overall": 0.65,
    "recall_overall": 0.50,
    "precision_first": 0.65,
    "recall_first": 0.50,
    "precision_subsequent": 0.80,
    "recall_subsequent": 0.70,
}
