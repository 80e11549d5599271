"""DuckDB SQL for every contract query (the correctness oracle).

The SQL runs on the driver's pre-registered views (``events``, ``part``).  It
first builds the same stand-in sources as ``sources/fixture.py`` and then
computes each step directly in SQL — plain windows, joins and aggregates over
whole tables — with the same tie-breaks, NULL order and rounding as the
Spark code.  All CTEs are defined once; each query is a final SELECT.
"""

from __future__ import annotations

from skylane.config import AIRCRAFT_TYPES, WEEKDAY_NAMES
from skylane.operators.quality import REFERENCE_CHECKS
from skylane.plans.contract import CONTRACT_RULES
from skylane.sources.fixture import (
    FIXTURE_CHART_OTHER_TYPE, FIXTURE_FLIGHT_OTHER_TYPE, FIXTURE_TYPES,
)


def _round(expr: str, digits: int) -> str:
    return f"round({expr}, {digits})"  # the engine's own, not the library's formula


def _type_case(col: str, other: str) -> str:
    whens = " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(FIXTURE_TYPES))
    return f"CASE {col} {whens} ELSE '{other}' END"


_TYPES = ", ".join(f"'{t}'" for t in AIRCRAFT_TYPES)
_DOW = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(WEEKDAY_NAMES))
_MIN_POINTS = CONTRACT_RULES.min_points
_PCT = CONTRACT_RULES.percentile
_HORIZON = CONTRACT_RULES.horizon_seconds

CTES: list[tuple[str, str]] = [
    # ---- stand-in sources (same projection as sources/fixture.py) ----
    ("radar_raw", """
        SELECT
          CASE WHEN event_id % 97 = 0 THEN 'NULL' WHEN event_id % 89 = 0 THEN NULL
               ELSE 'TAM' || CAST(user_id % 10 AS VARCHAR) END AS ds_registration,
          CASE WHEN event_id % 83 = 0 THEN NULL
               ELSE floor(least(value, 400.0) * 2) / 2 END AS nr_flightlevel,
          CASE WHEN event_id % 79 = 0 THEN NULL ELSE 150 + event_id % 300 END AS nr_speed,
          CAST(date_trunc('minute', ts) AS TIMESTAMP) AS dt_radar
        FROM events"""),
    ("flight_groups", """
        SELECT user_id % 10 AS k, CAST(ts AS DATE) AS d,
               CASE WHEN user_id % 10 < 2 AND extract(hour FROM ts) >= 12 THEN 1 ELSE 0 END AS leg,
               min(ts) AS t0, max(ts) AS t1, min(event_id) AS e
        FROM events GROUP BY 1, 2, 3"""),
    ("flights_raw", f"""
        SELECT 'TAM' || CAST(k AS VARCHAR) AS fltid,
          CASE WHEN e % 13 = 0 THEN 'KMIA' ELSE 'SB' || CAST(e % 4 AS VARCHAR) END AS adep,
          CASE WHEN e % 17 = 0 THEN 'SBSP' ELSE 'SBGR' END AS ades,
          {_type_case('k', FIXTURE_FLIGHT_OTHER_TYPE)} AS type,
          'PR-' || CAST(k AS VARCHAR) AS reg,
          CASE WHEN k = 3 AND e % 2 = 0 THEN NULL WHEN e % 5 = 0 THEN '10L' ELSE '28R' END
            AS drwy_validado,
          CASE WHEN e % 29 = 0 THEN NULL ELSE CAST(e * 37 % 360 AS DOUBLE) END AS bear,
          CASE WHEN e % 3 = 0 THEN CAST(floor((e * 37 % 360) / 60) * 60 AS DOUBLE) END AS setor,
          CAST(date_trunc('hour', t0) AS TIMESTAMP) AS c_time,
          CAST(CASE WHEN e % 11 = 0 THEN 40 ELSE 100 END AS INTEGER) AS c,
          CAST(CASE WHEN e % 23 = 0 THEN CAST(date_trunc('day', t1) AS TIMESTAMP) + INTERVAL 25 HOUR
                    ELSE date_trunc('hour', t1) END AS TIMESTAMP) AS aldt,
          CAST(600 + e % 900 AS DOUBLE) AS transito,
          '00:' || CAST(10 + e % 20 AS VARCHAR) || ':00' AS desimp,
          CASE WHEN e % 19 = 0 THEN NULL WHEN e % 7 = 0 THEN '-00:01:30'
               ELSE '00:' || lpad(CAST(e % 30 AS VARCHAR), 2, '0') || ':15' END AS kpi08
        FROM flight_groups"""),
    ("chart_raw", f"""
        SELECT {_type_case('a', FIXTURE_CHART_OTHER_TYPE)} AS aircraft,
               price / 10 AS tas_ms, CAST((p_size - 1) * 10 AS INTEGER) AS fl,
               price / 1000 AS fuel_flow_kg_s
        FROM (SELECT p_partkey % 10 AS a, p_size, min(p_retailprice) AS price
              FROM part GROUP BY 1, 2)"""),
    # ---- staging ----
    ("stg_flights", """
        SELECT CAST(aldt AS DATE) AS flight_date, fltid AS flight_id,
          CAST(adep AS VARCHAR) AS departure_airport, CAST(ades AS VARCHAR) AS arrival_airport,
          type AS aircraft_type, reg AS aircraft_registration, drwy_validado AS runway_validated,
          bear AS bearing, setor AS setor_raw, CAST(c_time AS TIMESTAMP) AS entry_time,
          c AS cylinder_radius, CAST(aldt AS TIMESTAMP) AS landing_time, transito AS transito_raw,
          CAST(desimp AS INTERVAL) AS desimp_raw, CAST(kpi08 AS INTERVAL) AS kpi08_interval
        FROM flights_raw"""),
    ("stg_radar", """
        SELECT CAST(dt_radar AS DATE) AS radar_date, nr_speed AS aircraft_speed,
          CAST(nr_flightlevel AS DECIMAL(18,3)) AS flight_level, ds_registration AS flight_id,
          CAST(dt_radar AS TIMESTAMP) AS radar_timestamp
        FROM radar_raw"""),
    ("stg_chart", """
        SELECT aircraft, tas_ms, CAST(fl AS INTEGER) AS fl,
               CAST(fuel_flow_kg_s AS DOUBLE) AS fuel_flow_kg_s
        FROM chart_raw"""),
    # ---- flights ----
    ("flights_enriched", """
        SELECT CAST(flight_date AS VARCHAR) || flight_id AS id, flight_date, flight_id,
          departure_airport, arrival_airport, aircraft_type, aircraft_registration,
          runway_validated, bearing,
          CASE WHEN setor_raw IS NOT NULL THEN CAST(CAST(setor_raw AS INTEGER) AS VARCHAR)
               WHEN bearing IS NOT NULL THEN CAST(CAST(floor(bearing / 60) * 60 AS INTEGER) AS VARCHAR)
          END AS setor,
          entry_time, cylinder_radius, landing_time, transito_raw AS transito,
          desimp_raw AS desimp, kpi08_interval AS kpi08, desimp_raw + kpi08_interval AS transit_tma
        FROM stg_flights"""),
    ("flights_filtered", f"""
        SELECT * FROM flights_enriched
        WHERE arrival_airport = 'SBGR' AND cylinder_radius = 100
          AND kpi08 IS NOT NULL AND setor IS NOT NULL
          AND departure_airport LIKE 'SB%' AND aircraft_type IN ({_TYPES})"""),
    ("flights_latest", """
        SELECT id, flight_id, flight_date, aircraft_type, entry_time, landing_time
        FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY landing_time DESC NULLS LAST,
                        entry_time ASC NULLS LAST, aircraft_type ASC NULLS LAST) AS rn
              FROM flights_filtered)
        WHERE rn = 1"""),
    ("dim_flight_identifiers", """
        SELECT id, departure_airport AS adep, arrival_airport AS ades, flight_id AS fltid,
               aircraft_type AS aircraft, aircraft_registration AS reg, flight_date AS date
        FROM flights_filtered"""),
    ("dim_flight_operational_attributes", """
        SELECT id, runway_validated AS drwy_validado, bearing AS bear, setor,
               entry_time AS c_time, landing_time AS aldt
        FROM flights_filtered"""),
    ("fct_flight_transit_metrics", """
        SELECT id, transito, desimp, kpi08, transit_tma FROM flights_filtered"""),
    # ---- radar in the terminal area ----
    ("radar_candidates", """
        SELECT r.*, f.id AS flight_key, f.aircraft_type, f.entry_time, f.landing_time,
               f.flight_date
        FROM stg_radar r JOIN flights_latest f ON r.flight_id = f.flight_id
        WHERE r.flight_id IS NOT NULL AND r.flight_id <> 'NULL'
          AND r.flight_level IS NOT NULL AND r.aircraft_speed IS NOT NULL
          AND r.radar_timestamp >= f.entry_time AND r.radar_timestamp <= f.landing_time"""),
    ("radar_in_terminal_area", """
        SELECT id, dt_radar, nr_speed, fl, aircraft_type, c_time, aldt FROM (
          SELECT CAST(radar_date AS VARCHAR) || flight_id AS id, radar_timestamp AS dt_radar,
                 aircraft_speed AS nr_speed, flight_level AS fl, aircraft_type,
                 entry_time AS c_time, landing_time AS aldt,
                 row_number() OVER (PARTITION BY flight_id, radar_date, flight_level
                                    ORDER BY radar_timestamp, aircraft_speed) AS rn
          FROM radar_candidates WHERE radar_date = flight_date)
        WHERE rn = 1"""),
    ("radar_cross_midnight", """
        SELECT id, dt_radar, nr_speed, fl, aircraft_type, c_time, aldt FROM (
          SELECT flight_key AS id, radar_timestamp AS dt_radar, aircraft_speed AS nr_speed,
                 flight_level AS fl, aircraft_type, entry_time AS c_time, landing_time AS aldt,
                 row_number() OVER (PARTITION BY flight_key, flight_level
                                    ORDER BY radar_timestamp, aircraft_speed) AS rn
          FROM radar_candidates
          WHERE radar_date BETWEEN least(CAST(entry_time AS DATE), flight_date) AND flight_date)
        WHERE rn = 1"""),
    # ---- fuel chart ----
    ("fuel_chart_interpolated", """
        SELECT s.aircraft, s.fl,
          lo.tas_ms + CAST(hi.tas_ms - lo.tas_ms AS DOUBLE) * (s.fl - s.fl_lower)
            / (s.fl_upper - s.fl_lower) AS tas_ms,
          lo.fuel_flow_kg_s + CAST(hi.fuel_flow_kg_s - lo.fuel_flow_kg_s AS DOUBLE)
            * (s.fl - s.fl_lower) / (s.fl_upper - s.fl_lower) AS fuel_flow_kg_s
        FROM (SELECT aircraft, fl, fl - fl % 10 AS fl_lower, fl - fl % 10 + 10 AS fl_upper
              FROM (SELECT aircraft, CAST(unnest(range(0, 401)) AS INTEGER) AS fl
                    FROM (SELECT DISTINCT aircraft FROM stg_chart))) s
        JOIN stg_chart lo ON lo.aircraft = s.aircraft AND lo.fl = s.fl_lower
        JOIN stg_chart hi ON hi.aircraft = s.aircraft AND hi.fl = s.fl_upper
        WHERE lo.tas_ms IS NOT NULL AND hi.tas_ms IS NOT NULL
          AND lo.fuel_flow_kg_s IS NOT NULL AND hi.fuel_flow_kg_s IS NOT NULL"""),
    ("fuel_at_points", """
        SELECT r.id, r.dt_radar, r.fl, r.aircraft_type, b.fuel_flow_kg_s AS fuel_flow
        FROM radar_in_terminal_area r
        JOIN fuel_chart_interpolated b
          ON b.aircraft = r.aircraft_type AND b.fl = CAST(r.fl AS INTEGER)"""),
    # ---- vertical profile ----
    ("profile_steps", """
        SELECT id, aircraft_type, c_time, dt_radar, nr_speed, fl,
               lag(fl) OVER w AS prev_fl, epoch(dt_radar - lag(dt_radar) OVER w) AS delta_s
        FROM radar_in_terminal_area
        WINDOW w AS (PARTITION BY id ORDER BY dt_radar, fl)"""),
    ("profile_flights", f"""
        SELECT id FROM radar_in_terminal_area GROUP BY id HAVING count(*) >= {_MIN_POINTS}"""),
    ("profile_points", f"""
        SELECT s.id, s.aircraft_type, s.c_time, s.dt_radar, s.nr_speed, s.fl,
          {_round('(CAST(100 * (s.fl - s.prev_fl) AS DOUBLE) / CAST(nullif(CAST(s.delta_s AS DECIMAL(18,3)), 0) AS DOUBLE))', 2)}
            AS avg_rocd,
          coalesce(s.delta_s, 0) AS elapsed
        FROM profile_steps s JOIN profile_flights q ON q.id = s.id
        WHERE coalesce(s.delta_s, 0) <> 0"""),
    ("vertical_profile", """
        SELECT p.*, fu.fuel_flow FROM profile_points p
        LEFT JOIN fuel_at_points fu ON fu.id = p.id AND fu.dt_radar = p.dt_radar"""),
    ("vertical_profile_own_level", """
        SELECT p.*, fu.fuel_flow FROM profile_points p
        LEFT JOIN fuel_at_points fu
          ON fu.id = p.id AND fu.dt_radar = p.dt_radar AND fu.fl = p.fl"""),
    # ---- occupancy ----
    ("occ_events", """
        SELECT DISTINCT id, c_time AS t, 1 AS delta FROM radar_in_terminal_area
        WHERE c_time IS NOT NULL
        UNION ALL
        SELECT DISTINCT id, aldt AS t, -1 AS delta FROM radar_in_terminal_area
        WHERE aldt IS NOT NULL"""),
    ("occ_sweep", """
        SELECT t, delta, any_exit,
          sum(delta) OVER (ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS settled,
          row_number() OVER (ORDER BY t) AS rn, lead(t) OVER (ORDER BY t) AS next_t
        FROM (SELECT t, sum(delta) AS delta,
                     max(CASE WHEN delta < 0 THEN 1 ELSE 0 END) AS any_exit
              FROM occ_events GROUP BY t)"""),
    ("occupancy", """
        SELECT CAST(rn AS BIGINT) AS id,
          CAST(settled - delta + CASE WHEN any_exit = 1 THEN -1 ELSE 1 END AS BIGINT)
            AS nr_aircraft_in_tma,
          t AS dt_valid_from, next_t AS dt_valid_to, next_t IS NULL AS is_current
        FROM occ_sweep"""),
    ("occupancy_settled", """
        SELECT CAST(rn AS BIGINT) AS id, CAST(settled AS BIGINT) AS nr_aircraft_in_tma,
          t AS dt_valid_from, next_t AS dt_valid_to, next_t IS NULL AS is_current
        FROM occ_sweep"""),
    # ---- consumption ----
    ("flight_fuel", """
        SELECT id, sum(elapsed * fuel_flow) AS consumption_kg FROM vertical_profile GROUP BY id"""),
    ("consumption_rows", """
        SELECT c.id AS fuel_id, k.id AS flight_id_key, k.landing_time AS aldt,
          k.entry_time AS c_time, k.flight_date AS date,
          CAST(extract(hour FROM k.entry_time) AS INTEGER) AS hour,
          k.departure_airport AS adep, k.aircraft_type AS aircraft,
          k.runway_validated AS drwy_validado, k.bearing AS bear, k.setor,
          epoch(k.kpi08) AS kpi08, epoch(k.transit_tma) AS transit_tma,
          CAST(NULL AS INTEGER) AS visibility, CAST(NULL AS INTEGER) AS ceiling,
          o.nr_aircraft_in_tma, c.consumption_kg
        FROM flights_filtered k
        LEFT JOIN flight_fuel c ON c.id = k.id
        LEFT JOIN occupancy o ON k.entry_time >= o.dt_valid_from AND k.entry_time < o.dt_valid_to"""),
    ("flight_consumption", """
        SELECT fuel_id AS id, * EXCLUDE (fuel_id, flight_id_key) FROM consumption_rows"""),
    ("flight_consumption_keep_id", """
        SELECT flight_id_key AS id, * EXCLUDE (fuel_id, flight_id_key) FROM consumption_rows"""),
    # ---- features ----
    ("feature_base", f"""
        SELECT *, CAST(extract(day FROM aldt) AS INTEGER) AS day,
          CAST(extract(month FROM aldt) AS INTEGER) AS month,
          CASE extract(dow FROM aldt) {_DOW} ELSE 'invalid' END AS dow
        FROM flight_consumption"""),
    ("fuel_p20", f"""
        SELECT adep, aircraft, drwy_validado,
               quantile_cont(consumption_kg, {_PCT}) AS consumption_20p
        FROM feature_base GROUP BY adep, aircraft, drwy_validado"""),
    ("transit_moving_avg", f"""
        SELECT id, aldt, drwy_validado, setor, transit_tma,
          avg(transit_tma) OVER (PARTITION BY drwy_validado, setor ORDER BY aldt
            RANGE BETWEEN INTERVAL {_HORIZON} SECOND PRECEDING AND CURRENT ROW)
            AS transit_tma_predicted
        FROM feature_base"""),
    ("features_with_p20", """
        SELECT b.*, p.consumption_20p FROM feature_base b
        LEFT JOIN fuel_p20 p
          ON p.adep = b.adep AND p.aircraft = b.aircraft AND p.drwy_validado = b.drwy_validado"""),
    ("ml_features_key_join", """
        SELECT b.*, t.transit_tma_predicted FROM features_with_p20 b
        LEFT JOIN transit_moving_avg t ON t.id = b.id"""),
    ("ml_features", f"""
        SELECT b.*, avg(b.transit_tma) OVER (PARTITION BY b.drwy_validado, b.setor ORDER BY b.aldt
            RANGE BETWEEN INTERVAL {_HORIZON} SECOND PRECEDING AND CURRENT ROW)
            AS transit_tma_predicted
        FROM features_with_p20 b"""),
]

_R4 = lambda c: f"{_round(c, 4)} AS {c}"
_R6 = lambda c: f"{_round(c, 6)} AS {c}"

_FLIGHT_OUT = """id, flight_date, flight_id, departure_airport, arrival_airport, aircraft_type,
  aircraft_registration, runway_validated, bearing, setor, entry_time,
  CAST(cylinder_radius AS BIGINT) AS cylinder_radius, landing_time, transito,
  epoch(desimp) AS desimp, epoch(kpi08) AS kpi08, epoch(transit_tma) AS transit_tma"""
_RADAR_OUT = """id, dt_radar, CAST(nr_speed AS BIGINT) AS nr_speed, CAST(fl AS DOUBLE) AS fl,
  aircraft_type, c_time, aldt"""
_PROFILE_OUT = f"""id, aircraft_type, c_time, dt_radar, CAST(nr_speed AS BIGINT) AS nr_speed,
  CAST(fl AS DOUBLE) AS fl, avg_rocd, elapsed, {_R6('fuel_flow')}"""
_CONSUMPTION_OUT = f"""id, aldt, c_time, date, CAST(hour AS BIGINT) AS hour, adep, aircraft,
  drwy_validado, bear, setor, kpi08, transit_tma, CAST(visibility AS BIGINT) AS visibility,
  CAST(ceiling AS BIGINT) AS ceiling, nr_aircraft_in_tma, {_R4('consumption_kg')}"""
_FEATURES_OUT = f"""id, date, adep, aircraft, drwy_validado, CAST(day AS BIGINT) AS day,
  CAST(month AS BIGINT) AS month, CAST(hour AS BIGINT) AS hour, dow, setor, kpi08, transit_tma,
  {_R4('transit_tma_predicted')}, CAST(visibility AS BIGINT) AS visibility,
  CAST(ceiling AS BIGINT) AS ceiling, {_R4('consumption_kg')}, {_R4('consumption_20p')},
  nr_aircraft_in_tma, {_round('(consumption_kg - consumption_20p)', 4)} AS kpi16"""


def _dq_report_sql() -> str:
    parts = []
    for c in REFERENCE_CHECKS:
        col = c.column
        if c.kind == "not_null":
            failed = f"count(*) FILTER (WHERE {col} IS NULL)"
        elif c.kind == "positive":
            failed = f"count(*) FILTER (WHERE {col} <= 0)"
        elif c.kind == "accepted_values":
            vals = ", ".join(f"'{v}'" for v in c.values)
            failed = f"count(*) FILTER (WHERE {col} IS NOT NULL AND CAST({col} AS VARCHAR) NOT IN ({vals}))"
        elif c.kind == "unique":
            failed = f"count({col}) - count(DISTINCT {col})"
        else:
            raise ValueError(c.kind)
        parts.append(f"SELECT '{c.table}' AS table_name, '{col}' AS column_name, "
                     f"'{c.kind}' AS check_name, CAST({failed} AS BIGINT) AS failed_rows "
                     f"FROM {c.table}")
    return ("SELECT table_name, column_name, check_name, failed_rows, failed_rows = 0 AS passed "
            "FROM (" + "\nUNION ALL\n".join(parts) + ")")


_DQ_CUSTOM = """
SELECT check_name, failed_rows, failed_rows = 0 AS passed FROM (
  SELECT 'transit_metrics_keys_in_dim' AS check_name, CAST(count(*) AS BIGINT) AS failed_rows
  FROM fct_flight_transit_metrics f
  WHERE NOT EXISTS (SELECT 1 FROM dim_flight_identifiers d WHERE d.id = f.id)
  UNION ALL
  SELECT 'vertical_profile_keys_in_dim', CAST(count(*) AS BIGINT)
  FROM vertical_profile f
  WHERE NOT EXISTS (SELECT 1 FROM dim_flight_identifiers d WHERE d.id = f.id)
  UNION ALL
  SELECT 'vertical_profile_non_empty', CAST(1 - count(*) AS BIGINT)
  FROM (SELECT 1 FROM vertical_profile LIMIT 1))"""

FINAL_SELECTS: dict[str, str] = {
    "stg_flights": """SELECT flight_date, flight_id, departure_airport, arrival_airport,
        aircraft_type, aircraft_registration, runway_validated, bearing, setor_raw, entry_time,
        CAST(cylinder_radius AS BIGINT) AS cylinder_radius, landing_time, transito_raw,
        epoch(desimp_raw) AS desimp_s, epoch(kpi08_interval) AS kpi08_s FROM stg_flights""",
    "stg_radar": """SELECT radar_date, CAST(aircraft_speed AS BIGINT) AS aircraft_speed,
        CAST(flight_level AS DOUBLE) AS flight_level, flight_id, radar_timestamp FROM stg_radar""",
    "stg_chart": """SELECT aircraft, tas_ms, CAST(fl AS BIGINT) AS fl, fuel_flow_kg_s
        FROM stg_chart""",
    "flights_enriched": f"SELECT {_FLIGHT_OUT} FROM flights_enriched",
    "flights_filtered": f"SELECT {_FLIGHT_OUT} FROM flights_filtered",
    "dim_flight_identifiers": "SELECT * FROM dim_flight_identifiers",
    "dim_flight_operational_attributes": "SELECT * FROM dim_flight_operational_attributes",
    "fct_flight_transit_metrics": """SELECT id, transito, epoch(desimp) AS desimp,
        epoch(kpi08) AS kpi08, epoch(transit_tma) AS transit_tma FROM fct_flight_transit_metrics""",
    "flights_latest": "SELECT * FROM flights_latest",
    "radar_in_terminal_area": f"SELECT {_RADAR_OUT} FROM radar_in_terminal_area",
    "radar_cross_midnight": f"SELECT {_RADAR_OUT} FROM radar_cross_midnight",
    "fuel_chart_interpolated": f"""SELECT aircraft, CAST(fl AS BIGINT) AS fl, {_R6('tas_ms')},
        {_R6('fuel_flow_kg_s')} FROM fuel_chart_interpolated""",
    "fuel_at_points": f"""SELECT id, dt_radar, CAST(fl AS DOUBLE) AS fl, aircraft_type,
        {_R6('fuel_flow')} FROM fuel_at_points""",
    "vertical_profile": f"SELECT {_PROFILE_OUT} FROM vertical_profile",
    "vertical_profile_own_level": f"SELECT {_PROFILE_OUT} FROM vertical_profile_own_level",
    "occupancy_first": "SELECT * FROM occupancy",
    "occupancy_settled": "SELECT * FROM occupancy_settled",
    "flight_fuel": f"SELECT id, {_R4('consumption_kg')} FROM flight_fuel",
    "occupancy_at_entry": """SELECT k.id, k.entry_time AS c_time, o.nr_aircraft_in_tma
        FROM flights_filtered k LEFT JOIN occupancy o
          ON k.entry_time >= o.dt_valid_from AND k.entry_time < o.dt_valid_to""",
    "flight_consumption": f"SELECT {_CONSUMPTION_OUT} FROM flight_consumption",
    "flight_consumption_keep_id": f"SELECT {_CONSUMPTION_OUT} FROM flight_consumption_keep_id",
    "fuel_p20": f"SELECT adep, aircraft, drwy_validado, {_R4('consumption_20p')} FROM fuel_p20",
    "fuel_p20_ranked": f"SELECT adep, aircraft, drwy_validado, {_R4('consumption_20p')} FROM fuel_p20",
    "transit_moving_avg": f"""SELECT id, aldt, drwy_validado, setor, transit_tma,
        {_R4('transit_tma_predicted')} FROM transit_moving_avg""",
    "ml_features": f"SELECT {_FEATURES_OUT} FROM ml_features",
    "ml_features_key_join": f"SELECT {_FEATURES_OUT} FROM ml_features_key_join",
    "dq_report": _dq_report_sql(),
    "dq_custom": _DQ_CUSTOM,
    "dq_entry_before_landing": """SELECT 'flights_filtered' AS table_name,
        'entry_time' AS column_name, 'row_rule' AS check_name, failed_rows,
        failed_rows = 0 AS passed
        FROM (SELECT CAST(count(*) FILTER (WHERE NOT coalesce(entry_time <= landing_time, true))
                          AS BIGINT) AS failed_rows FROM flights_filtered)""",
}


def oracle_sql() -> dict[str, str]:
    """Full SQL text per query: all CTEs, then the query's SELECT."""
    with_clause = "WITH " + ",\n".join(f"{name} AS ({body}\n)" for name, body in CTES)
    return {name: f"{with_clause}\n{select}" for name, select in FINAL_SELECTS.items()}
