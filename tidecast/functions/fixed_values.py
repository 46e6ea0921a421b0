"""Domain constants that must be equal everywhere for equal results."""

# -- fixed values: calendar -------------------------------------------------
RUSH_HOURS = [7, 8, 9, 16, 17, 18, 19]
EVENING_RUSH_HOURS = [16, 17, 18, 19]
EVENT_HOURS = [18, 19, 20, 21, 22, 23]
WEEKEND_DAYS = [5, 6]

# -- fixed values: zones ----------------------------------------------------
DOWNTOWN_ZONES = [113, 161, 162, 230]
BUSY_ZONES = [186, 230, 48, 79, 161, 142, 162, 236, 237, 170]

# -- fixed values: weather text ---------------------------------------------
OBSERVATION_FORMAT = "dd.MM.yyyy HH:mm"
PRECIPITATION_WORDS = {"Trace of precipitation": 0.1}
CLOUD_COVER = {
    "no clouds": 0.0,
    "20–30%.": 25.0,
    "50%.": 50.0,
    "70 – 80%.": 75.0,
    "100%.": 100.0,
    "Sky obscured by fog and/or other meteorological phenomena.": 100.0,
}
CLOUD_COVER_DEFAULT = 75.0
CLOUD_FRACTION = {
    "no clouds": 0.0,
    "20–30%.": 0.3,
    "50%.": 0.5,
    "70 – 80%.": 0.7,
    "100%.": 1.0,
    "Sky obscured by fog and/or other meteorological phenomena.": 1.0,
}

# -- fixed values: trip quality rules ---------------------------------------
VENDOR_CODES = [1, 2]
RATE_CODES = [1, 2, 3, 4, 5, 6]
PAYMENT_CODES = [1, 2, 3, 4, 5, 6]
MAX_DISTANCE = 100
MAX_PASSENGERS = 6
MAX_AMOUNT = 1000

# -- fixed values: series ---------------------------------------------------
DATASET_LAGS = [1, 2, 3, 6, 12, 24]
STORE_LAGS = [1, 2, 24]
ROLLING_HOURS = [3, 24]
WEEKLY_LAG = 168

# -- fixed values: evaluation and monitoring --------------------------------
DRIFT_RATIO = 1.2
MAP_RADIUS_DIVISOR = 20

# -- fixed values: published searches ---------------------------------------
# absolute loss: rates with the first settings, then trees x depths x samples x rows of a leaf
SEARCH_RATES = (0.3, 0.4, 0.5, 0.6, 0.7)
SEARCH_FIRST = {"maxIter": 200, "maxDepth": 6}
SEARCH_TREES = (200, 300)
SEARCH_DEPTHS = (7, 9)
SEARCH_SAMPLES = (0.8, 1.0)
SEARCH_LEAVES = (1, 3)
# minimum rows of a leaf: one grid of trees x depths x rates x samples x rows of a leaf
LEAFMIN_TREES = (100, 200)
LEAFMIN_DEPTHS = (7, 9)
LEAFMIN_RATES = (0.01, 0.1)
LEAFMIN_SAMPLES = (0.8, 1.0)
LEAFMIN_LEAVES = (20, 50)
# batch scoring: rates with the first settings, then the second grid with a least gain of a split
BATCH_RATES = (0.01, 0.05, 0.1, 0.2, 0.3)
BATCH_FIRST = {"maxIter": 200, "maxDepth": 7, "subsamplingRate": 0.8, "minInstancesPerNode": 1}
BATCH_TREES = (150, 200)
BATCH_DEPTHS = (7, 9)
BATCH_SAMPLES = (0.8, 1.0)
BATCH_LEAVES = (3, 5)
BATCH_GAINS = (0.0, 0.5)
