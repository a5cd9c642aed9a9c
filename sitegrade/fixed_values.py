"""They decide results, so they are stated once, as text, here.

Nothing in this module computes anything.  Operators, data checks and the
parity SQL all read these names.
"""

from __future__ import annotations

# ---------------------------------------------------------------- raw feeds

RESTAURANT_FEED_COLUMNS = [
    "camis", "dba", "boro", "building", "street", "zipcode", "phone", "inspection_date", "critical_flag",
    "record_date", "bin", "bbl", "nta", "cuisine_description", "action", "violation_code",
    "violation_description", "score", "grade", "grade_date", "latitude", "longitude", "inspection_type",
]

RAT_FEED_COLUMNS = [
    "inspection_type", "job_ticket_or_work_order_id", "job_id", "job_progress", "bbl", "boro_code", "block",
    "lot", "house_number", "street_name", "zip_code", "x_coord", "y_coord", "latitude", "longitude",
    "borough", "inspection_date", "result", "approved_date", "location", "community_board",
    "council_district", "census_tract", "bin", "nta", ":@computed_region_92fq_4b7q",
    ":@computed_region_f5dn_yrer", ":@computed_region_yeji_bk3q", ":@computed_region_efsh_h5xi",
    ":@computed_region_sbqj_enih",
]

# The one feed column that is not a string.
RAT_FEED_STRUCTS = {"location": ["human_address", "latitude", "longitude"]}

# ------------------------------------------------------------ model contracts

MART_RAT_DDL = """
inspection_type string, work_order_id int, job_id string, job_progress int,
bbl bigint, boro_code int, block string, lot string, house_number string,
street string, zipcode string, latitude double, longitude double,
borough string, inspection_date timestamp_ntz, result string,
approved_date timestamp_ntz, bin int, nta string, extract_date date
"""

MART_RESTAURANT_DDL = """
inspection_order_id string, camis int, dba string, dba_lower string,
boro string, building string, street string, zipcode string,
inspection_date timestamp_ntz, critical_flag string,
record_date timestamp_ntz, bin int, bbl string, nta string,
cuisine_description string, action string, violation_code string,
violation_description string, score int, computed_score double, grade string,
computed_grade string, grade_date timestamp_ntz, latitude decimal(18,12),
longitude decimal(18,12), extract_date date
"""

RISK_MODEL_DDL = """
camis int, dba string, boro string, building string, bin int,
cuisine_description string, latitude decimal(18,12),
longitude decimal(18,12), zipcode string,
most_recent_inspection_date timestamp_ntz, restaurant_risk_score double,
street_risk_score double, zip_risk_score double, bin_rat_score double,
street_rat_score double, zip_rat_score double, rat_risk_score double,
risk_category string, extract_date date
"""

# ------------------------------------------------------------- category sets

SEVERE_CODES = [
    "04A", "04B", "04C", "04D", "04E", "04F", "04H", "04I", "04J", "04K", "04L", "04M", "04N", "04O", "04P",
    "05A", "05B", "05C", "05D", "05E",
]

MODERATE_CODES = [
    "02A", "02B", "02C", "02D", "02E", "02F", "02G", "02H", "02I", "02J", "05F", "05H", "05I", "06A", "06B",
    "06C", "06D", "06E", "06F", "06G", "06H", "06I",
]

BOROUGHS = ["BRONX", "BROOKLYN", "MANHATTAN", "QUEENS", "STATEN ISLAND"]
RESULTS = ["PASSED", "FAILED", "FAILED FOR OTHER R", "RAT ACTIVITY"]
SOURCE_GRADES = ["A", "B", "C", "P", "Z", "N"]
COMPUTED_GRADES = ["A", "B", "C", "N"]
RISK_CATEGORIES = ["LOW RISK", "MODERATE RISK", "HIGH RISK", "VERY HIGH RISK"]

# ------------------------------------------------------------ dates and spans

EARLIEST_INSPECTION = "2000-01-01"
UNINSPECTED_SENTINEL = "1900-01-01 00:00:00"
RECENT_MONTHS = 1
TRAILING_MONTHS = 6

# ------------------------------------------------------------ bands and scores

SCORE_CAP = 100.0

# (upper bound inclusive, value), first match wins.
GRADE_BANDS = [(13, "A"), (27, "B"), (float("inf"), "C")]
GRADE_FLOOR = 0
GRADE_OTHERWISE = "N"

# (days inclusive, penalty), then base + slope per day past the last bound.
RESTAURANT_DAY_BANDS = [(90, 0), (180, 3), (365, 10)]
RESTAURANT_DAY_BASE = 18
BUILDING_DAY_BANDS = [(30, 0), (90, 2), (180, 5), (365, 12)]
BUILDING_DAY_BASE = 20
BUILDING_NO_DATE_PENALTY = 20
DAY_TAIL_SLOPE = 0.05
DAY_TAIL_CAP = 15

# (buildings inclusive, bonus), first match wins: the second never applies.
STREET_BUILDING_BANDS = [(2, 8), (1, 15)]
ZIP_BUILDING_BANDS = [(5, 5), (2, 10)]

# Thin-evidence penalties of a building.
NO_INSPECTION_PENALTY = 15
ONE_INSPECTION_WITH_RATS_PENALTY = 8
TWO_INSPECTIONS_WITH_TROUBLE_PENALTY = 5

BASE_INSPECTION_SCORE = 10

# Weight of each term, in summation order.
RESTAURANT_WEIGHTS = {
    "severe": 15, "moderate": 6, "score_over_base": 0.5,
    "grade_c": 8, "grade_b": 3, "grade_a": -2,
}
RESTAURANT_AREA_WEIGHTS = {
    "severe": 20, "moderate": 8, "score_over_base": 1.5,
    "share_c": 30, "share_b": 15, "share_a": -5,
}
BUILDING_WEIGHTS = {
    "rat_activity_rate": 35, "failure_rate": 25, "failed_share": 20,
    "initial_share": 15, "bait_share": 10, "compliance_share": 12,
}
RAT_AREA_WEIGHTS = {
    "rat_activity_rate": 40, "failure_rate": 20, "initial_rate": 15,
    "bait_rate": 12, "compliance_rate": 18,
}
COMBINED_WEIGHTS = {
    "restaurant_risk_score": 0.3, "street_risk_score": 0.15,
    "zip_risk_score": 0.05, "bin_rat_score": 0.3, "street_rat_score": 0.15,
    "zip_rat_score": 0.05,
}

# (lower bound inclusive, category), first match wins.
RISK_BANDS = [(75, "VERY HIGH RISK"), (55, "HIGH RISK"), (20, "MODERATE RISK")]
RISK_OTHERWISE = "LOW RISK"

# -------------------------------------------------------------- data checks

# table -> kind of check -> columns (and their allowed values or range).
DATA_CHECKS = {
    "raw_restaurant": {
        "not_null": ["camis", "inspection_date", "score", "boro"],
        "accepted_values": {"boro": BOROUGHS, "grade": SOURCE_GRADES},
    },
    "raw_rat": {
        "not_null": ["bin", "inspection_date", "result"],
        "accepted_values": {"result": RESULTS},
    },
    "clean_restaurant": {
        "not_null": ["camis", "inspection_date", "score", "boro", "bin", "zipcode"],
        "accepted_values": {"boro": BOROUGHS},
        "accepted_range": {"score": (0, 100)},
    },
    "clean_rat": {
        "not_null": ["bin", "inspection_date", "result", "inspection_type", "borough"],
        "accepted_values": {"result": RESULTS, "borough": BOROUGHS},
    },
    "stage_restaurant": {
        "not_null": ["camis", "inspection_date", "computed_score", "computed_grade",
                     "boro", "bin", "zipcode", "violation_code"],
        "accepted_values": {"computed_grade": COMPUTED_GRADES, "boro": BOROUGHS},
        "accepted_range": {"computed_score": (0, 100)},
    },
    "stage_rat": {
        "not_null": ["bin", "inspection_date", "result", "inspection_type", "borough"],
        "accepted_values": {"result": RESULTS, "borough": BOROUGHS},
    },
    "mart_restaurant": {
        "not_null": ["camis", "inspection_date", "computed_score", "computed_grade",
                     "boro", "bin", "zipcode"],
        "accepted_values": {"computed_grade": COMPUTED_GRADES, "boro": BOROUGHS},
        "accepted_range": {"computed_score": (0, 100)},
    },
    "mart_rat": {
        "not_null": ["bin", "inspection_date", "result", "inspection_type",
                     "borough", "latitude", "longitude"],
        "accepted_values": {"result": RESULTS, "borough": BOROUGHS},
    },
    "risk_model": {
        "not_null": ["rat_risk_score", "risk_category", "camis", "bin", "dba", "boro"],
        "accepted_values": {"risk_category": RISK_CATEGORIES, "boro": BOROUGHS},
        "accepted_range": {"rat_risk_score": (0, 100)},
        "unique": ["camis"],
        "row_count": (100, 100000),
    },
}

# Days of age after which a feed is late: (warn, error), and its load column.
FRESHNESS_DAYS = (1, 3)
FRESHNESS_COLUMN = "extract_date"
FRESHNESS_FEEDS = {"clean_restaurant": "extract_date", "clean_rat": "extract_date"}

# ------------------------------------------------------------------- serving

SERVING_BATCH_ROWS = 1000
