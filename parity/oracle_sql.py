"""The same results stated as DuckDB SQL, one common table expression per model.

Where Spark takes a shortcut the SQL does not: it really pairs visit variants,
removes repeats and runs each data check as a query of its own, so agreement
tests the shortcuts too.
"""

from __future__ import annotations

import math
import re

from parity import TIE_NUDGE
from sitegrade import fixed_values as fixed
from sitegrade.operators import building_risk, clean, restaurant_risk
from parity import star_feeds

AS_OF = f"DATE '{star_feeds.AS_OF}'"
_SITE = ", ".join(restaurant_risk.SITE_KEYS)
_BUILDING = ", ".join(building_risk.BUILDING_KEYS)

# ------------------------------------------------------------ text fragments


def _six(expr: str) -> str:
    """Six digits; the nudge keeps decimal ties from being decided by the last bit of a double."""
    return f"ROUND(CAST({expr} AS DOUBLE) + {TIE_NUDGE}, 6)"


def _quoted(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _literal(value) -> str:
    return f"'{value}'" if isinstance(value, str) else str(value)


def _band(expr: str, bands, otherwise: str) -> str:
    arms = [
        f"WHEN {expr} IS NOT NULL THEN {_literal(v)}" if math.isinf(b) else f"WHEN {expr} <= {b} THEN {_literal(v)}"
        for b, v in bands
    ]
    return f"CASE {' '.join(arms)} ELSE {otherwise} END"


def _weighted(terms: list[tuple[str, float]], *extras: str) -> str:
    parts = [f"COALESCE(({term}) * CAST({weight} AS DOUBLE), 0)" for term, weight in terms]
    return f"LEAST({fixed.SCORE_CAP}, {' + '.join([*parts, *extras])})"


def _days(expr: str) -> str:
    return f"DATE_DIFF('day', {expr}, {AS_OF})"


def _grade(expr: str) -> str:
    other = f"'{fixed.GRADE_OTHERWISE}'"
    return f"CASE WHEN {expr} < {fixed.GRADE_FLOOR} THEN {other} ELSE {_band(expr, fixed.GRADE_BANDS, other)} END"


def _day_penalty(date: str, bands, base: int) -> str:
    past = f"({_days(date)} - {bands[-1][0]}) * CAST({fixed.DAY_TAIL_SLOPE} AS DOUBLE)"
    return _band(_days(date), bands, f"{base} + LEAST({fixed.DAY_TAIL_CAP}, {past})")


def _restaurant_penalty(date: str) -> str:
    return _day_penalty(date, fixed.RESTAURANT_DAY_BANDS, fixed.RESTAURANT_DAY_BASE)


def _building_penalty(date: str) -> str:
    dated = _day_penalty(date, fixed.BUILDING_DAY_BANDS, fixed.BUILDING_DAY_BASE)
    return f"CASE WHEN {date} IS NULL THEN {fixed.BUILDING_NO_DATE_PENALTY} ELSE {dated} END"


def _evidence(total: str, failed: str, rats: str) -> str:
    return (
        f"CASE WHEN {total} = 0 THEN {fixed.NO_INSPECTION_PENALTY}"
        f" WHEN {total} <= 1 AND {rats} > 0 THEN {fixed.ONE_INSPECTION_WITH_RATS_PENALTY}"
        f" WHEN {total} <= 2 AND ({failed} > 0 OR {rats} > 0) THEN {fixed.TWO_INSPECTIONS_WITH_TROUBLE_PENALTY}"
        f" ELSE 0 END"
    )


def _ratio(part: str, whole: str) -> str:
    return f"CAST({part} AS DOUBLE) / NULLIF({whole}, 0)"


def _newest_first(*columns: str) -> str:
    return ", ".join(f"{c} DESC NULLS LAST" for c in columns)


def _recent(date: str) -> str:
    return f"{date} > {AS_OF} - INTERVAL {fixed.TRAILING_MONTHS} MONTH"


# ------------------------------------------------------------ score formulas

_W = fixed.RESTAURANT_WEIGHTS
_RESTAURANT_SCORE = _weighted(
    [
        ("avg_severe_vio_count_6m", _W["severe"]),
        ("avg_moderate_vio_count_6m", _W["moderate"]),
        (f"avg_score_orig_6m - {fixed.BASE_INSPECTION_SCORE}", _W["score_over_base"]),
        ("grade_C_count_6m", _W["grade_c"]),
        ("grade_B_count_6m", _W["grade_b"]),
        ("grade_A_count_6m", _W["grade_a"]),
    ],
    _restaurant_penalty("most_recent_inspection_date"),
)


def _restaurant_area_score(p: str) -> str:
    w = fixed.RESTAURANT_AREA_WEIGHTS
    graded = f"({p}_grade_A_count + {p}_grade_B_count + {p}_grade_C_count)"
    return _weighted(
        [
            (f"{p}_avg_severe_vio_count_6m", w["severe"]),
            (f"{p}_avg_moderate_vio_count_6m", w["moderate"]),
            (f"{p}_avg_score - {fixed.BASE_INSPECTION_SCORE}", w["score_over_base"]),
            (_ratio(f"{p}_grade_C_count", graded), w["share_c"]),
            (_ratio(f"{p}_grade_B_count", graded), w["share_b"]),
            (_ratio(f"{p}_grade_A_count", graded), w["share_a"]),
        ]
    )


_B = fixed.BUILDING_WEIGHTS
_BUILDING_SCORE = _weighted(
    [
        ("rat_activity_rate_6m", _B["rat_activity_rate"]),
        ("failure_rate_6m", _B["failure_rate"]),
        (_ratio("failed_inspections_6m", "total_inspections_6m"), _B["failed_share"]),
        (_ratio("initial_inspections_6m", "total_inspections_6m"), _B["initial_share"]),
        (_ratio("bait_inspections_6m", "total_inspections_6m"), _B["bait_share"]),
        (_ratio("compliance_inspections_6m", "total_inspections_6m"), _B["compliance_share"]),
    ],
    _building_penalty("most_recent_inspection_date"),
    _evidence("total_inspections_6m", "failed_inspections_6m", "rat_activities_6m"),
)


def _rat_area_score(p: str, buildings: str, bands) -> str:
    terms = [(f"{p}_{name}", weight) for name, weight in fixed.RAT_AREA_WEIGHTS.items()]
    return _weighted(terms, _band(buildings, bands, "0"))


_RAT_STREET_SCORE = _rat_area_score("street", "buildings_on_street", fixed.STREET_BUILDING_BANDS)
_RAT_ZIP_SCORE = _rat_area_score("zip", "buildings_in_zip", fixed.ZIP_BUILDING_BANDS)
_COMBINED = _weighted(list(fixed.COMBINED_WEIGHTS.items()))


def _category(expr: str) -> str:
    arms = " ".join(f"WHEN {expr} >= {low} THEN '{name}'" for low, name in fixed.RISK_BANDS)
    return f"CASE {arms} ELSE '{fixed.RISK_OTHERWISE}' END"


# ------------------------------------------------------------------ measures


def _restaurant_area(key: str, p: str) -> str:
    return f"""
SELECT {key},
  SUM(avg_severe_vio_count_6m) / NULLIF(COUNT(camis), 0) AS {p}_avg_severe_vio_count_6m,
  SUM(avg_moderate_vio_count_6m) / NULLIF(COUNT(camis), 0) AS {p}_avg_moderate_vio_count_6m,
  SUM(avg_score_orig_6m) / COUNT(*) AS {p}_avg_score,
  CAST(SUM(grade_A_count_6m) AS BIGINT) AS {p}_grade_A_count,
  CAST(SUM(grade_B_count_6m) AS BIGINT) AS {p}_grade_B_count,
  CAST(SUM(grade_C_count_6m) AS BIGINT) AS {p}_grade_C_count,
  AVG(latitude) AS {p}_latitude,
  AVG(longitude) AS {p}_longitude
FROM restaurant_stats_6m GROUP BY {key}"""


def _rat_area(key: str, p: str, buildings: str) -> str:
    ratios = {
        "failure_rate": "failed_inspections_6m", "rat_activity_rate": "rat_activities_6m",
        "initial_rate": "initial_inspections_6m", "bait_rate": "bait_inspections_6m",
        "compliance_rate": "compliance_inspections_6m",
    }
    area_ratios = ",\n  ".join(
        f"{_ratio(f'SUM({of})', 'SUM(total_inspections_6m)')} AS {p}_{name}" for name, of in ratios.items()
    )
    return f"""
SELECT {key},
  COUNT(DISTINCT bin) AS {buildings},
  AVG(failure_rate_6m) AS {p}_avg_failure_rate,
  AVG(rat_activity_rate_6m) AS {p}_avg_rat_activity_rate,
  {area_ratios},
  AVG(total_inspections_6m) AS {p}_avg_inspections,
  AVG(latitude) AS {p}_latitude,
  AVG(longitude) AS {p}_longitude
FROM building_stats_6m GROUP BY {key}"""


_OUTCOMES = """COUNT(*) AS total_inspections_6m,
  COUNT(CASE WHEN result = 'FAILED' THEN 1 END) AS failed_inspections_6m,
  COUNT(CASE WHEN result = 'PASSED' THEN 1 END) AS passed_inspections_6m,
  COUNT(CASE WHEN result = 'RAT ACTIVITY' THEN 1 END) AS rat_activities_6m"""
_RATES = """AVG(CASE WHEN result = 'FAILED FOR OTHER R' THEN 1.0 ELSE 0.0 END) AS failure_rate_6m,
  AVG(CASE WHEN result = 'RAT ACTIVITY' THEN 1.0 ELSE 0.0 END) AS rat_activity_rate_6m"""
_KINDS = ",\n  ".join(
    f"COUNT(CASE WHEN CONTAINS(LOWER(inspection_type), '{kind}') THEN 1 END) AS {kind}_inspections_6m"
    for kind in ("initial", "bait", "compliance")
)

# --------------------------------------------------------------- the models

_MODELS: dict[str, str] = {
    "raw_restaurant": star_feeds.RAW_RESTAURANT_SQL.format(
        lineitem="lineitem", orders="orders", customer="customer", nation="nation", region="region"
    ),
    "raw_rat": star_feeds.RAW_RAT_SQL.format(events="events"),
    "typed_restaurant": """
SELECT
  MD5(COALESCE(camis, '') || COALESCE(bin, '') || COALESCE(violation_code, '') || COALESCE(inspection_date, ''))
    AS inspection_order_id,
  CAST(camis AS INTEGER) AS camis, dba, UPPER(boro) AS boro, building, street, zipcode, phone,
  CAST(inspection_date AS TIMESTAMP) AS inspection_date, UPPER(critical_flag) AS critical_flag,
  CAST(record_date AS TIMESTAMP) AS record_date, CAST(bin AS INTEGER) AS bin, bbl, nta,
  cuisine_description, action, UPPER(violation_code) AS violation_code, violation_description,
  CAST(score AS INTEGER) AS score, grade, CAST(grade_date AS TIMESTAMP) AS grade_date,
  CAST(latitude AS DECIMAL(18, 12)) AS latitude, CAST(longitude AS DECIMAL(18, 12)) AS longitude
FROM raw_restaurant""",
    "latest_restaurant": f"""
SELECT *, ROW_NUMBER() OVER (
    PARTITION BY inspection_order_id
    ORDER BY {_newest_first("inspection_date", "record_date", *clean.RESTAURANT_TIE_BREAK)}) AS row_num
FROM typed_restaurant WHERE inspection_date IS NOT NULL
QUALIFY row_num = 1""",
    "clean_restaurant": f"""
SELECT *, LOWER(dba) AS dba_lower, {AS_OF} AS extract_date FROM latest_restaurant""",
    "latest_work_order": f"""
SELECT * FROM (
  SELECT * REPLACE (CAST(inspection_date AS TIMESTAMP) AS inspection_date,
                    CAST(approved_date AS TIMESTAMP) AS approved_date) FROM raw_rat)
QUALIFY ROW_NUMBER() OVER (
    PARTITION BY job_ticket_or_work_order_id
    ORDER BY {_newest_first("inspection_date", "approved_date", *clean.RAT_TIE_BREAK)}) = 1""",
    "clean_rat": f"""
SELECT UPPER(inspection_type) AS inspection_type, CAST(job_ticket_or_work_order_id AS INTEGER) AS work_order_id,
  job_id, CAST(job_progress AS INTEGER) AS job_progress, CAST(bbl AS BIGINT) AS bbl,
  CAST(boro_code AS INTEGER) AS boro_code, block, lot, house_number, street_name AS street,
  zip_code AS zipcode, CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude,
  UPPER(borough) AS borough, inspection_date, UPPER(result) AS result, approved_date,
  CAST(bin AS INTEGER) AS bin, nta, {AS_OF} AS extract_date
FROM latest_work_order
WHERE inspection_date >= TIMESTAMP '{fixed.EARLIEST_INSPECTION}' AND inspection_date <= {AS_OF}""",
    "visit_avg_score": """
SELECT camis, inspection_date, AVG(score) AS avg_score FROM clean_restaurant GROUP BY ALL""",
    "scored_restaurant": """
SELECT r.*, v.avg_score AS computed_score
FROM clean_restaurant r LEFT JOIN visit_avg_score v
  ON v.camis = r.camis AND v.inspection_date = r.inspection_date""",
    "stage_restaurant": f"""
SELECT DISTINCT * EXCLUDE (phone, row_num) REPLACE (
    CASE WHEN inspection_date >= {AS_OF} - INTERVAL {fixed.RECENT_MONTHS} MONTH THEN 'Z' ELSE 'N' END AS grade,
    COALESCE(grade_date, inspection_date) AS grade_date),
  {_grade('computed_score')} AS computed_grade
FROM scored_restaurant
WHERE inspection_date <> TIMESTAMP '{fixed.UNINSPECTED_SENTINEL}'
  AND bin IS NOT NULL AND zipcode IS NOT NULL AND violation_code IS NOT NULL""",
    "building_coordinates": """
SELECT DISTINCT bin, latitude, longitude FROM clean_restaurant
WHERE latitude IS NOT NULL AND longitude IS NOT NULL""",
    "stage_rat": f"""
SELECT DISTINCT r.* REPLACE (
    COALESCE(r.latitude, c.latitude) AS latitude, COALESCE(r.longitude, c.longitude) AS longitude)
FROM clean_rat r LEFT JOIN building_coordinates c
  ON c.bin = r.bin AND c.latitude = r.latitude AND c.longitude = r.longitude
WHERE r.bin IS NOT NULL
  AND r.inspection_date >= TIMESTAMP '{fixed.EARLIEST_INSPECTION}' AND r.inspection_date <= {AS_OF}""",
    "largest_coordinates": """
SELECT bin, CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude FROM building_coordinates
WHERE bin IS NOT NULL QUALIFY ROW_NUMBER() OVER (PARTITION BY bin ORDER BY latitude DESC, longitude DESC) = 1""",
    "stage_rat_by_bin": f"""
SELECT DISTINCT r.* REPLACE (
    CASE WHEN r.latitude IS NULL OR r.longitude IS NULL THEN COALESCE(c.latitude, r.latitude) ELSE r.latitude END AS latitude,
    CASE WHEN r.latitude IS NULL OR r.longitude IS NULL THEN COALESCE(c.longitude, r.longitude) ELSE r.longitude END AS longitude)
FROM clean_rat r LEFT JOIN largest_coordinates c ON c.bin = r.bin
WHERE r.bin IS NOT NULL
  AND r.inspection_date >= TIMESTAMP '{fixed.EARLIEST_INSPECTION}' AND r.inspection_date <= {AS_OF}""",
    "mart_restaurant": "SELECT * FROM stage_restaurant WHERE inspection_date IS NOT NULL",
    "mart_rat": "SELECT * FROM stage_rat WHERE inspection_date IS NOT NULL AND bin IS NOT NULL",
    "severe_violations": f"""
SELECT camis, dba, bin, inspection_date,
  COUNT(CASE WHEN violation_code IN ({_quoted(fixed.SEVERE_CODES)}) THEN 1 END) AS severe_vio_count
FROM mart_restaurant GROUP BY ALL""",
    "moderate_violations": f"""
SELECT camis, dba, bin, inspection_date,
  COUNT(CASE WHEN violation_code IN ({_quoted(fixed.MODERATE_CODES)}) THEN 1 END) AS moderate_vio_count
FROM mart_restaurant GROUP BY ALL""",
    "visit_stats": f"""
SELECT {", ".join("m." + c for c in restaurant_risk.SITE_KEYS)}, m.inspection_date,
  MAX(s.severe_vio_count) AS severe_vio_count, MAX(t.moderate_vio_count) AS moderate_vio_count,
  COUNT(CASE WHEN m.critical_flag = 'CRITICAL' THEN 1 END) AS total_critical_count,
  AVG(m.computed_score) AS avg_computed_score, MAX(m.computed_grade) AS computed_grade,
  MAX(m.latitude) AS latitude, MAX(m.longitude) AS longitude, MAX(m.extract_date) AS extract_date
FROM mart_restaurant m, severe_violations s, moderate_violations t
WHERE (s.camis, s.inspection_date) = (m.camis, m.inspection_date)
  AND (t.camis, t.inspection_date) = (m.camis, m.inspection_date)
GROUP BY ALL""",
    "restaurant_stats_6m": f"""
SELECT {_SITE}, MAX(inspection_date) AS most_recent_inspection_date,
  CAST(SUM(severe_vio_count) AS BIGINT) AS total_severe_vio_count_6m,
  CAST(SUM(severe_vio_count) AS DOUBLE) / COUNT(*) AS avg_severe_vio_count_6m,
  CAST(SUM(moderate_vio_count) AS BIGINT) AS total_moderate_vio_count_6m,
  CAST(SUM(moderate_vio_count) AS DOUBLE) / COUNT(*) AS avg_moderate_vio_count_6m,
  SUM(avg_computed_score) / COUNT(*) AS avg_score_orig_6m,
  COUNT(CASE computed_grade WHEN 'A' THEN 1 END) AS grade_A_count_6m,
  COUNT(CASE computed_grade WHEN 'B' THEN 1 END) AS grade_B_count_6m,
  COUNT(CASE computed_grade WHEN 'C' THEN 1 END) AS grade_C_count_6m,
  MAX(longitude) AS longitude, MAX(latitude) AS latitude, MAX(extract_date) AS extract_date
FROM visit_stats WHERE {_recent('inspection_date')} GROUP BY {_SITE}""",
    "restaurant_street_stats": _restaurant_area("street", "street"),
    "restaurant_zip_stats": _restaurant_area("zipcode", "zip"),
    "restaurant_risk": f"""
SELECT {", ".join("r." + c for c in restaurant_risk.SITE_KEYS)}, most_recent_inspection_date,
  avg_severe_vio_count_6m, avg_moderate_vio_count_6m, avg_score_orig_6m,
  grade_A_count_6m, grade_B_count_6m, grade_C_count_6m,
  {_days('most_recent_inspection_date')} AS days_since_inspection,
  {_RESTAURANT_SCORE} AS restaurant_risk_score,
  {_restaurant_area_score('street')} AS street_risk_score,
  {_restaurant_area_score('zip')} AS zip_risk_score,
  longitude, latitude, extract_date
FROM restaurant_stats_6m r
LEFT JOIN restaurant_street_stats s ON s.street = r.street
LEFT JOIN restaurant_zip_stats z ON z.zipcode = r.zipcode""",
    "building_stats_6m": f"""
SELECT {_BUILDING}, MAX(inspection_date) AS most_recent_inspection_date,
  MAX(approved_date) AS most_recent_approved_date,
  {_OUTCOMES},
  {_KINDS},
  {_RATES},
  MAX(latitude) AS latitude, MAX(longitude) AS longitude, {AS_OF} AS extract_date
FROM mart_rat WHERE {_recent('inspection_date')} GROUP BY {_BUILDING}""",
    "rat_street_stats": _rat_area("street", "street", "buildings_on_street"),
    "rat_zip_stats": _rat_area("zipcode", "zip", "buildings_in_zip"),
    "rat_risk": f"""
SELECT b.bin, b.street, b.zipcode, latitude, longitude,
  {_BUILDING_SCORE} AS bin_rr_score,
  {_RAT_STREET_SCORE} AS street_rr_score,
  {_RAT_ZIP_SCORE} AS zip_rr_score,
  extract_date
FROM building_stats_6m b
LEFT JOIN rat_street_stats s ON s.street = b.street
LEFT JOIN rat_zip_stats z ON z.zipcode = b.zipcode""",
    "visits": f"""
SELECT DISTINCT camis, bin, zipcode, inspection_date FROM clean_restaurant WHERE inspection_date <> TIMESTAMP '{fixed.UNINSPECTED_SENTINEL}'""",
    "newest_of_day": f"""
SELECT bin, inspection_date, work_order_id, result FROM clean_rat WHERE bin IS NOT NULL
QUALIFY ROW_NUMBER() OVER (PARTITION BY bin, inspection_date ORDER BY {_newest_first("approved_date", "work_order_id", "result")}) = 1""",
    "risk_model": f"""
SELECT *, {_category('rat_risk_score')} AS risk_category FROM (
  SELECT *, {_COMBINED} AS rat_risk_score FROM (
    SELECT r.camis, r.dba, r.boro, r.building, r.bin, r.cuisine_description, r.latitude, r.longitude,
      r.zipcode, r.most_recent_inspection_date, r.restaurant_risk_score, r.street_risk_score,
      r.zip_risk_score, b.bin_rr_score AS bin_rat_score, b.street_rr_score AS street_rat_score,
      b.zip_rr_score AS zip_rat_score, r.extract_date
    FROM restaurant_risk r LEFT JOIN rat_risk b ON b.bin = r.bin))""",
}


def _with_models(query: str) -> str:
    """The query behind the definitions of every model it reads, in order."""
    needed: set[str] = set()
    pending = [query]
    while pending:
        words = set(re.findall(r"\w+", pending.pop()))
        found = {name for name in _MODELS if name in words} - needed
        needed |= found
        pending += [_MODELS[name] for name in found]
    if not needed:
        return query
    parts = [f"{name} AS ({body.strip()})" for name, body in _MODELS.items() if name in needed]
    return f"WITH {', '.join(parts)}\nSELECT * FROM ({query})" if query.lstrip().startswith("WITH") else f"WITH {', '.join(parts)}\n{query}"


def _compare(source: str, doubles: str = "", columns: str = "*", dates: str = "extract_date") -> str:
    """All columns of a model, doubles to 6 digits and dates as text."""
    replaced = [f"{_six(c)} AS {c}" for c in doubles.split()]
    replaced += [f"CAST({c} AS VARCHAR) AS {c}" for c in dates.split()]
    replace = f" REPLACE ({', '.join(replaced)})" if replaced else ""
    return f"SELECT {columns}{replace} FROM {source}"


# --------------------------------------------------------------- data checks


def _check_rows(table: str, kinds: dict) -> list[str]:
    """One failing-rows count per check, each a query of its own."""
    rows = []

    def add(column: str, check: str, failing: str) -> None:
        rows.append(
            f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{check}' AS check_name, "
            f"COUNT(*) AS failures FROM ({failing})"
        )

    for c in kinds.get("not_null", []):
        add(c, "not_null", f"SELECT {c} FROM {table} WHERE {c} IS NULL")
    for c, values in kinds.get("accepted_values", {}).items():
        add(c, "accepted_values", f"SELECT DISTINCT {c} FROM {table} WHERE {c} NOT IN ({_quoted(values)})")
    for c, (low, high) in kinds.get("accepted_range", {}).items():
        add(c, "accepted_range", f"SELECT {c} FROM {table} WHERE {c} < {low} OR {c} > {high}")
    for c in kinds.get("unique", []):
        add(c, "unique", f"SELECT {c} FROM {table} WHERE {c} IS NOT NULL GROUP BY {c} HAVING COUNT(*) > 1")
    if "row_count" in kinds:
        low, high = kinds["row_count"]
        add("*", "row_count", f"SELECT COUNT(*) AS n FROM {table} HAVING n < {low} OR n > {high}")
    return rows


def _checks(chosen: dict[str, dict]) -> str:
    rows = [row for table, kinds in chosen.items() for row in _check_rows(table, kinds)]
    return (
        "SELECT *, CASE failures WHEN 0 THEN 'pass' ELSE 'warn' END AS status FROM ("
        + " UNION ALL ".join(rows) + ")"
    )


def _check_kind(kind: str) -> str:
    return _checks({t: {kind: kinds[kind]} for t, kinds in fixed.DATA_CHECKS.items() if kind in kinds})


def _freshness(*sources: tuple[str, str]) -> str:
    warn, error = fixed.FRESHNESS_DAYS
    newest = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, MAX(CAST({c} AS TIMESTAMP)) AS newest FROM {t}"
        for t, c in sources
    )
    return f"""
SELECT table_name, column_name, 'freshness' AS check_name, {_days('newest')} AS age_days,
  CASE WHEN newest >= {AS_OF} - INTERVAL {warn} DAY THEN 'pass'
       WHEN newest >= {AS_OF} - INTERVAL {error} DAY THEN 'warn' ELSE 'error' END AS status
FROM ({newest})"""


def _as_of(later: str) -> str:
    return f"""
SELECT v.*, r.inspection_date AS rat_inspection_date, r.work_order_id AS rat_work_order_id, r.result AS rat_result
FROM visits v ASOF LEFT JOIN newest_of_day r ON r.bin = v.bin AND v.inspection_date {later} r.inspection_date"""


_DESCRIPTION = "dba, boro, building, street, zipcode, cuisine_description"
_HISTORY = f"""
WITH seen AS (
  SELECT camis, inspection_date, {_DESCRIPTION} FROM clean_restaurant
  WHERE camis IS NOT NULL AND inspection_date <> TIMESTAMP '{fixed.UNINSPECTED_SENTINEL}'
  QUALIFY ROW_NUMBER() OVER (PARTITION BY camis, inspection_date ORDER BY {_newest_first(*_DESCRIPTION.split(", "))}) = 1),
islands AS (
  SELECT *, ROW({_DESCRIPTION}) IS DISTINCT FROM LAG(ROW({_DESCRIPTION})) OVER (PARTITION BY camis ORDER BY inspection_date) AS starts FROM seen)
SELECT camis, {_DESCRIPTION}, inspection_date AS valid_from, LEAD(inspection_date) OVER (PARTITION BY camis ORDER BY inspection_date) AS valid_to
FROM islands WHERE starts"""


def _subtotals(grouping: str) -> str:
    return f"""
SELECT boro, zipcode, street, cuisine_description, CAST(GROUPING_ID(boro, zipcode, street, cuisine_description) AS INTEGER) AS grouping_id,
  COUNT(*) AS violations, COUNT(DISTINCT bin) AS buildings
FROM clean_restaurant GROUP BY {grouping} (boro, zipcode, street, cuisine_description)"""


# ------------------------------------------------------------------- queries

_PLACE = "latitude longitude"
_AVERAGES = "avg_severe_vio_count_6m avg_moderate_vio_count_6m avg_score_orig_6m"
_RESTAURANT_SCORES = "restaurant_risk_score street_risk_score zip_risk_score"


def _unwindowed(measures: str) -> str:
    return measures.replace("_6m", "")


def _names(p: str, names: str) -> str:
    return " ".join(f"{p}_{n}" for n in names.split())


_RESTAURANT_AREA = "avg_severe_vio_count_6m avg_moderate_vio_count_6m avg_score latitude longitude"
_RAT_AREA = (
    "avg_failure_rate avg_rat_activity_rate failure_rate rat_activity_rate initial_rate bait_rate "
    "compliance_rate avg_inspections latitude longitude"
)

_QUERIES: dict[str, str] = {
    "clean_restaurant": _compare("clean_restaurant", _PLACE),
    "clean_rat": _compare("clean_rat", _PLACE),
    "stage_restaurant": _compare("stage_restaurant", f"computed_score {_PLACE}"),
    "stage_rat": _compare("stage_rat", _PLACE),
    "stage_rat_by_bin": _compare("stage_rat_by_bin", _PLACE),
    "mart_restaurant": _compare("mart_restaurant", f"computed_score {_PLACE}"),
    "mart_rat": _compare("mart_rat", _PLACE),
    "restaurant_risk": _compare("restaurant_risk", f"{_AVERAGES} {_RESTAURANT_SCORES} {_PLACE}"),
    "rat_risk": _compare("rat_risk", f"bin_rr_score street_rr_score zip_rr_score {_PLACE}"),
    "risk_model": _compare("risk_model", f"{' '.join(fixed.COMBINED_WEIGHTS)} rat_risk_score {_PLACE}"),
    "dedup_by_hash_key": _compare("latest_restaurant", _PLACE, dates=""),
    "dedup_latest_work_order": _compare("latest_work_order", dates=""),
    "visit_avg_score": _compare("visit_avg_score", "avg_score", dates=""),
    "attach_visit_score": f"""SELECT inspection_order_id, camis, inspection_date, score,
  {_six('computed_score')} AS computed_score FROM scored_restaurant""",
    "building_coordinates": _compare("building_coordinates", _PLACE, dates=""),
    "severe_violations": _compare("severe_violations", dates=""),
    "moderate_violations": _compare("moderate_violations", dates=""),
    "visit_stats": _compare("visit_stats", f"avg_computed_score {_PLACE}"),
    "restaurant_stats_6m": _compare("restaurant_stats_6m", f"{_AVERAGES} {_PLACE}"),
    "restaurant_street_stats": _compare("restaurant_street_stats", _names("street", _RESTAURANT_AREA), dates=""),
    "restaurant_zip_stats": _compare("restaurant_zip_stats", _names("zip", _RESTAURANT_AREA), dates=""),
    "building_stats_6m": _compare("building_stats_6m", f"failure_rate_6m rat_activity_rate_6m {_PLACE}"),
    "rat_street_stats": _compare("rat_street_stats", _names("street", _RAT_AREA), dates=""),
    "rat_zip_stats": _compare("rat_zip_stats", _names("zip", _RAT_AREA), dates=""),
    "serving_clean": """SELECT camis, street, violation_code, grade,
  CAST(record_date AS TIMESTAMP) AS record_date FROM raw_restaurant""",
    "hash_key": """SELECT camis, bin, violation_code, inspection_date,
  MD5(CONCAT_WS('', camis, bin, violation_code, inspection_date)) AS inspection_order_id FROM raw_restaurant""",
    "normalise_case": """SELECT dba, LOWER(dba) AS dba_lower, UPPER(boro) AS boro,
  UPPER(critical_flag) AS critical_flag, UPPER(violation_code) AS violation_code FROM raw_restaurant""",
    "typed_casts": f"""
SELECT l_orderkey, l_linenumber,
  CAST(CAST(l_extendedprice AS VARCHAR) AS INTEGER) AS price_int,
  CAST('-' || CAST(l_extendedprice AS VARCHAR) AS INTEGER) AS negative_price_int,
  CAST('10000' || CAST(l_orderkey AS VARCHAR) AS BIGINT) AS long_id,
  {_six('CAST(l_extendedprice AS VARCHAR)')} AS price_double,
  CAST(CAST(CAST(l_discount AS VARCHAR) AS DECIMAL(18, 12)) AS VARCHAR) AS discount_decimal,
  CAST(CAST(l_shipdate AS VARCHAR) AS TIMESTAMP) AS shipped_at
FROM lineitem""",
    "recency_days": f"""
SELECT o_orderkey, {_days('o_orderdate')} AS days,
  CAST({AS_OF} - INTERVAL {fixed.RECENT_MONTHS} MONTH AS TIMESTAMP) AS one_month_before,
  CAST({AS_OF} - INTERVAL {fixed.TRAILING_MONTHS} MONTH AS TIMESTAMP) AS six_months_before
FROM orders""",
    "safe_ratio": f"""
SELECT l_orderkey, {_six('returned / NULLIF(finished, 0)')} AS ratio
FROM (SELECT l_orderkey, SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS returned,
        SUM(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END) AS finished
      FROM lineitem GROUP BY l_orderkey)""",
    "capped_sum": f"""
SELECT o_orderkey, {_six(_weighted(
    [('o_totalprice / 1000', 0.2), ('CASE WHEN o_custkey % 7 <> 0 THEN o_totalprice / 1000 END', 0.5),
     ('o_totalprice / 1000 - 10', -0.5)],
    "CASE WHEN o_orderstatus = 'F' THEN 18 ELSE 0 END"))} AS score
FROM orders""",
    "date_range_filter": f"""
SELECT job_id, CAST(inspection_date AS TIMESTAMP) AS inspection_date FROM raw_rat
WHERE CAST(inspection_date AS TIMESTAMP) BETWEEN TIMESTAMP '{fixed.EARLIEST_INSPECTION}' AND {AS_OF}""",
    "sentinel_filter": f"""
SELECT inspection_order_id, camis, inspection_date FROM typed_restaurant
WHERE inspection_date <> TIMESTAMP '{fixed.UNINSPECTED_SENTINEL}'""",
    "trailing_window": f"SELECT o_orderkey, o_orderdate FROM orders WHERE {_recent('o_orderdate')}",
    "inspection_type_counts": f"SELECT bin, {_unwindowed(_KINDS)} FROM clean_rat GROUP BY bin",
    "outcome_counts": f"""SELECT * REPLACE ({_six('failure_rate')} AS failure_rate, {_six('rat_activity_rate')} AS rat_activity_rate)
FROM (SELECT bin, {_unwindowed(_OUTCOMES)}, {_unwindowed(_RATES)} FROM clean_rat GROUP BY bin)""",
    "top_risk_restaurants": _compare("restaurant_risk", f"{_AVERAGES} {_RESTAURANT_SCORES} {_PLACE}")
    + " ORDER BY restaurant_risk_score DESC NULLS LAST",
    "top_risk_buildings": _compare("rat_risk", f"bin_rr_score street_rr_score zip_rr_score {_PLACE}")
    + " ORDER BY bin_rr_score DESC NULLS LAST",
    "grade_bands": f"""
SELECT l_orderkey, {_six('mean')} AS mean, {_grade('mean')} AS grade
FROM (SELECT l_orderkey, AVG(CASE WHEN l_orderkey % 97 <> 0 THEN l_quantity - 5 END) AS mean
      FROM lineitem GROUP BY l_orderkey)""",
    "recency_flag": f"""
SELECT o_orderkey, CASE WHEN o_orderdate >= {AS_OF} - INTERVAL {fixed.RECENT_MONTHS} MONTH THEN 'Z' ELSE 'N' END AS grade
FROM orders""",
    "recency_penalty": f"""
SELECT o_orderkey, {_six(_restaurant_penalty('o_orderdate'))} AS penalty FROM orders""",
    "restaurant_score": f"SELECT {_SITE}, {_six(_RESTAURANT_SCORE)} AS restaurant_risk_score FROM restaurant_stats_6m",
    "restaurant_street_score": f"""
SELECT street, {_six(_restaurant_area_score('street'))} AS street_risk_score FROM restaurant_street_stats""",
    "restaurant_zip_score": f"""
SELECT zipcode, {_six(_restaurant_area_score('zip'))} AS zip_risk_score FROM restaurant_zip_stats""",
    "building_recency_penalty": f"""
SELECT o_orderkey, {_six(_building_penalty('seen'))} AS penalty
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 211 <> 0 THEN o_orderdate END AS seen FROM orders)""",
    "evidence_penalty": f"""
SELECT bin, inspection_date,
  {_evidence('total_inspections_6m', 'failed_inspections_6m', 'rat_activities_6m')} AS penalty
FROM (SELECT bin, inspection_date, {_OUTCOMES} FROM clean_rat GROUP BY bin, inspection_date)""",
    "building_score": f"SELECT {_BUILDING}, {_six(_BUILDING_SCORE)} AS bin_rr_score FROM building_stats_6m",
    "rat_street_score": f"SELECT street, {_six(_RAT_STREET_SCORE)} AS street_rr_score FROM rat_street_stats",
    "rat_zip_score": f"SELECT zipcode, {_six(_RAT_ZIP_SCORE)} AS zip_rr_score FROM rat_zip_stats",
    "combined_score": f"SELECT camis, dba, bin, {_six('rat_risk_score')} AS rat_risk_score FROM risk_model",
    "risk_category_counts": 'SELECT risk_category, COUNT(*) AS "rows" FROM risk_model GROUP BY risk_category',
    "event_windows": f"""
SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, event_type, COUNT(*) AS events, {_six('SUM(value)')} AS total
FROM (SELECT CAST(DATE_TRUNC('day', ts) AS TIMESTAMP) AS window_start, event_type, value FROM events)
WHERE window_start + INTERVAL 1 DAY <= (SELECT MAX(CAST(ts AS TIMESTAMP)) FROM events) - INTERVAL 2 DAY GROUP BY window_start, event_type""",
    "streamed_work_orders": _compare("latest_work_order", dates=""),
    "establishment_history": _HISTORY,
    "merged_establishment_history": _HISTORY,
    "trailing_visit_scores": f"""
WITH days AS (
  SELECT camis, inspection_date, COUNT(*) AS n, COUNT(score) AS scored, COALESCE(SUM(score), 0) AS score FROM clean_restaurant
  WHERE camis IS NOT NULL AND inspection_date <> TIMESTAMP '{fixed.UNINSPECTED_SENTINEL}' GROUP BY ALL),
sums AS (
  SELECT a.camis, a.inspection_date, CAST(SUM(b.n) AS BIGINT) AS rows_6m, CAST(SUM(b.scored) AS BIGINT) AS scored_6m, CAST(SUM(b.score) AS BIGINT) AS score_6m
  FROM days a JOIN days b ON b.camis = a.camis AND b.inspection_date <= a.inspection_date
    AND b.inspection_date > a.inspection_date - INTERVAL {fixed.TRAILING_MONTHS} MONTH
  GROUP BY ALL)
SELECT *, DATE_DIFF('day', LAG(inspection_date) OVER (PARTITION BY camis ORDER BY inspection_date), inspection_date) AS days_since_previous FROM sums""",
    "area_percentiles": f"""
SELECT camis, zipcode, inspection_date, score,
  {_six("PERCENT_RANK() OVER (PARTITION BY zipcode ORDER BY score NULLS FIRST)")} AS percentile
FROM (SELECT camis, zipcode, inspection_date, CAST(SUM(score) AS BIGINT) AS score FROM clean_restaurant
      WHERE inspection_date <> TIMESTAMP '{fixed.UNINSPECTED_SENTINEL}' GROUP BY ALL)""",
    "place_rollup": _subtotals("ROLLUP"),
    "place_cube": _subtotals("CUBE"),
    "sketched_buildings": f"""
WITH seen AS (SELECT DISTINCT zipcode, bin, CAST(DATE_TRUNC('month', inspection_date) AS DATE) AS month FROM clean_rat WHERE zipcode IS NOT NULL AND bin IS NOT NULL)
SELECT m.zipcode, CAST(m.month AS VARCHAR) AS month, COUNT(DISTINCT s.bin) AS buildings, TRUE AS estimate_is_close
FROM (SELECT DISTINCT zipcode, month FROM seen) m
JOIN seen s ON s.zipcode = m.zipcode AND s.month <= m.month AND s.month > m.month - INTERVAL {fixed.TRAILING_MONTHS} MONTH
GROUP BY ALL""",
    "incremental_risk_model": _compare("risk_model", f"{' '.join(fixed.COMBINED_WEIGHTS)} rat_risk_score {_PLACE}"),
    "rat_state_at_visit": _as_of(">="),
    "rat_state_before_visit": f"""
SELECT * EXCLUDE (recent) REPLACE (CASE WHEN recent THEN rat_inspection_date END AS rat_inspection_date,
  CASE WHEN recent THEN rat_work_order_id END AS rat_work_order_id, CASE WHEN recent THEN rat_result END AS rat_result)
FROM (SELECT *, rat_inspection_date >= inspection_date - INTERVAL 90 DAY AS recent FROM ({_as_of('>')}))""",
    "rat_findings_near_visits": """
SELECT v.*, r.inspection_date AS rat_inspection_date, r.work_order_id AS rat_work_order_id, r.bin AS rat_bin, r.street AS rat_street
FROM visits v JOIN clean_rat r ON r.zipcode = v.zipcode
  AND r.inspection_date BETWEEN v.inspection_date - INTERVAL 90 DAY AND v.inspection_date
WHERE r.result = 'RAT ACTIVITY'""",
    "dq_not_null": _check_kind("not_null"),
    "dq_accepted_values": _check_kind("accepted_values"),
    "dq_accepted_range": _check_kind("accepted_range"),
    "dq_unique": _check_kind("unique"),
    "dq_row_count": _check_kind("row_count"),
    "dq_freshness": _freshness(
        ("clean_restaurant", "extract_date"), ("clean_rat", "extract_date"), ("clean_rat", "inspection_date"), ("clean_rat", "approved_date"),
        ("orders", "o_orderdate"), ("events", "ts"),
    ),
    "dq_report": _checks(fixed.DATA_CHECKS),
}


def registry() -> dict[str, str]:
    return {name: _with_models(query) for name, query in _QUERIES.items()}
