"""Fixed values that must equal the source system's for results to agree.

Everything here is a plain constant of the data model; the code that uses
them lives in the operator modules.
"""

# ---------------------------------------------------------------------------
# Fixed values (must not change: results depend on them)
# ---------------------------------------------------------------------------

# Positional order of the 18 fields of one state vector inside a snapshot.
# Note that longitude precedes latitude.
STATE_VECTOR_FIELDS = [
    "icao24", "callsign", "origin_country", "time_position", "last_contact",
    "longitude", "latitude", "baro_altitude", "on_ground", "velocity",
    "true_track", "vertical_rate", "sensors", "geo_altitude", "squawk",
    "spi", "position_source", "category",
]

# position_source code -> label; any other value (null included) is "Unknown".
POSITION_SOURCE_LABELS = {0: "ADS-B", 1: "ASTERIX", 2: "MLAT", 3: "FLARM"}
UNKNOWN_LABEL = "Unknown"

# Blank origin country becomes this label (null stays null).
BLANK_COUNTRY_LABEL = "Unknown"

# Event types from an on_ground transition (prev -> cur).
TAKEOFF = "TAKEOFF"   # True -> False
LANDING = "LANDING"   # False -> True

# Relationship types of flight edges, by event type.
DEPARTED_FROM = "DEPARTED_FROM"
ARRIVED_AT = "ARRIVED_AT"
REL_TYPE_BY_EVENT = {TAKEOFF: DEPARTED_FROM, LANDING: ARRIVED_AT}

# Match confidence bands on the rounded distance in km:
# null -> NONE, < 2 -> HIGH, < 10 -> MEDIUM, otherwise LOW.
CONF_HIGH, CONF_MEDIUM, CONF_LOW, CONF_NONE = "HIGH", "MEDIUM", "LOW", "NONE"
CONF_HIGH_BELOW_KM = 2.0
CONF_MEDIUM_BELOW_KM = 10.0
# Confidences that the airport queries count.
GOOD_CONFIDENCES = [CONF_HIGH, CONF_MEDIUM]

# Radii and the bounding-box margin rule (radius / 111 degrees, both axes).
AIRPORT_RADIUS_KM = 15.0
NEAR_RADIUS_KM = 50.0
KM_PER_DEGREE_BOX = 111.0
EARTH_RADIUS_KM = 6371.0

# Rounding of distances before comparison.
AIRPORT_DIST_DECIMALS = 3
NEAR_DIST_DECIMALS = 2

# Airport catalogue filter: types, ident length, region box (inclusive).
AIRPORT_TYPES = ["large_airport", "medium_airport"]
AIRPORT_IDENT_LENGTH = 4
# (lat_min, lon_min, lat_max, lon_max); None means the whole world.
REGION_BBOX = (34.0, -25.0, 72.0, 45.0)

# Snapshot id / time string format (time pinned to UTC, literal Z).
SNAPSHOT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
BATCH_ID_FORMAT = "yyyyMMdd'T'HHmmss'Z'"

# Retention (days) of state vectors and of flight events.
STATE_VECTOR_TTL_DAYS = 7
FLIGHT_EVENT_TTL_DAYS = 30

# Query defaults and bounds.
QUERY_LIMIT_MIN, QUERY_LIMIT_MAX = 1, 100
DEFAULT_LIMITS = {
    "q1": 10, "q2": 10, "q3": 10, "q5": 15, "q7": 20, "q8": 20, "q9": 25, "q10": 30,
}
DEFAULT_MIN_SNAPSHOTS = 3

# Ingest poll period and batch-job period (seconds).
POLL_PERIOD_SECONDS = 20
JOB_PERIOD_SECONDS = 300

# Synthetic load defaults.
LOAD_TEST_ROWS = 5000
LOAD_TEST_BATCH = 50
LOAD_TEST_ICAO_PREFIX = "stress-"
LOAD_TEST_CALLSIGN = "STRESS"
LOAD_TEST_COUNTRY = "TestLand"
