"""Fixed values that results depend on: column lists, formats, bounds, keyword lists, holidays, targets, grids."""

# Landing file columns, upper case, in file order.
REQUIRED_COLUMNS = [
    "KIT_CODE", "MSISDN", "DEALER_ID", "OFFRE", "DEBIT", "CITY", "GOVERNORATE", "POSTAL_CODE",
    "LATITUDE", "LONGITUDE", "LOCALITY_NAME", "DELEGATION_NAME", "CREATION_DATE",
]
LANDING_COLUMNS = [name.lower() for name in REQUIRED_COLUMNS]
CRITICAL_COLUMNS = ["msisdn", "creation_date", "kit_code"]

# Texts that a CSV reader of data frames takes as missing.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Phone numbers: country prefix and full length.
MSISDN_PREFIX = "216"
MSISDN_LENGTH = 11

# Allowed years of a subscription and allowed coordinates, all inclusive.
MIN_YEAR, MAX_YEAR = 2020, 2026
LATITUDE_RANGE = (30.0, 38.0)
LONGITUDE_RANGE = (7.0, 12.0)

# Offer categories in order of precedence; an offer takes the first whose keyword it contains.
OFFER_KEYWORDS = [
    ("Pro", ["PRO", "OFFICE", "BUSINESS", "ENTERPRISE"]),
    ("Villa", ["VILLA", "RESIDENTIEL", "RESIDENTIAL"]),
    ("Promo", ["PROMO", "CAMPAIGN", "PROMOTION"]),
]
OFFER_DEFAULT, OFFER_MISSING = "Standard", "Other"

# Time dimension span and yearly public holidays as (month, day).
TIME_FIRST_YEAR, TIME_LAST_YEAR = 2024, 2026
YEARLY_HOLIDAYS = [(1, 1), (3, 20), (4, 9), (5, 1), (7, 25), (8, 13)]

# Dated holidays of the forecast features.
DATED_HOLIDAYS = [
    "2024-01-01", "2024-03-20", "2024-04-09", "2024-05-01", "2024-07-25", "2024-08-13", "2024-10-15",
    "2025-01-01", "2025-03-20", "2025-05-01", "2025-07-25", "2025-08-13", "2025-10-15",
]

# Quality targets in percent.
MAX_REJECT_RATE, MIN_VALID_RATE, MIN_LOAD_RATE = 1.0, 95.0, 95.0

# Feature frame.
LAGS = [1, 7, 14, 30]
WINDOWS = [7, 14, 30]
TOP_VALUES = 3

# Error metrics floor, rating limits and retrain limit in percent MAPE.
METRIC_FLOOR = 1e-8
RATING_EXCELLENT, RATING_GOOD = 15.0, 25.0
RETRAIN_MAPE = 25.0

# Forecast horizons in days, share of days flagged as anomalies, width of the simple band.
HORIZON, SHORT_HORIZON = 90, 30
ANOMALY_SHARE = 0.05
BAND = 0.15

# What-if rules: name, first day, last day, multiplier, addend.
WHAT_IF_RULES = [
    ("Baseline", 1, 30, 1.0, 0.0),
    ("Marketing Campaign (+25%, 14 days)", 1, 14, 1.25, 0.0),
    ("Ramadan Effect (+15%, 30 days)", 1, 30, 1.15, 0.0),
    ("New Dealer (+5/day)", 1, 30, 1.0, 5.0),
]

# Named seasonal configurations: name, (p, d, q), (P, D, Q, s).
SEASONAL_CONFIGS = [
    ("Baseline (Current)", (1, 1, 1), (1, 1, 1, 7)),
    ("Seasonal: 7 days", (1, 1, 1), (1, 1, 1, 7)),
    ("Seasonal: 14 days", (1, 1, 1), (1, 1, 1, 14)),
    ("Seasonal: 30 days", (1, 1, 1), (1, 1, 1, 30)),
    ("Low Order (0,1,1)", (0, 1, 1), (1, 1, 1, 7)),
    ("Low Order (1,0,1)", (1, 0, 1), (1, 1, 1, 7)),
    ("Low Order (1,1,0)", (1, 1, 0), (1, 1, 1, 7)),
    ("Higher Order (2,1,2)", (2, 1, 2), (1, 1, 1, 7)),
    ("Higher Order (2,2,2)", (2, 2, 2), (1, 1, 1, 7)),
    ("Higher Order (3,1,2)", (3, 1, 2), (1, 1, 1, 7)),
    ("Seasonal Order (1,0,1,7)", (1, 1, 1), (1, 0, 1, 7)),
    ("Seasonal Order (2,1,1,7)", (1, 1, 1), (2, 1, 1, 7)),
    ("Seasonal Order (1,1,2,7)", (1, 1, 1), (1, 1, 2, 7)),
    ("Seasonal Order (2,1,2,7)", (1, 1, 1), (2, 1, 2, 7)),
    ("Optimized 1 (2,1,1)(1,1,1,7)", (2, 1, 1), (1, 1, 1, 7)),
    ("Optimized 2 (1,1,2)(1,1,1,7)", (1, 1, 2), (1, 1, 1, 7)),
    ("Optimized 3 (2,1,2)(1,1,1,7)", (2, 1, 2), (1, 1, 1, 7)),
    ("Optimized 4 (1,1,1)(2,1,1,7)", (1, 1, 1), (2, 1, 1, 7)),
    ("Optimized 5 (2,1,1)(2,1,1,7)", (2, 1, 1), (2, 1, 1, 7)),
]
