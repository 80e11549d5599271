"""Declarative data-quality checks.

Column checks of one table are evaluated in a single aggregate, so each table
is scanned once whatever the number of checks.  Results are rows of
(table_name, column_name, check_name, failed_rows, passed).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from skylane.config import SECTORS
from skylane.plans.strategy import broadcast_within

CHECK_KINDS = ("not_null", "unique", "positive", "accepted_values", "row_rule")


@dataclass(frozen=True)
class ColumnCheck:
    """``kind``: not_null | unique | positive (> 0) | accepted_values (compared
    as text, NULL not counted) | row_rule (``predicate`` SQL must not be false)."""

    table: str
    column: str
    kind: str
    values: tuple[str, ...] = ()
    predicate: str | None = None

    def __post_init__(self):
        if self.kind not in CHECK_KINDS:
            raise ValueError(f"unknown check kind {self.kind!r}")


def _checks(table: str, not_null: Iterable[str] = (), unique: Iterable[str] = (),
            positive: Iterable[str] = (), accepted: Mapping[str, tuple[str, ...]] | None = None
            ) -> list[ColumnCheck]:
    out = [ColumnCheck(table, c, "not_null") for c in not_null]
    out += [ColumnCheck(table, c, "unique") for c in unique]
    out += [ColumnCheck(table, c, "positive") for c in positive]
    out += [ColumnCheck(table, c, "accepted_values", v) for c, v in (accepted or {}).items()]
    return out


# --- Fixed values: the column contracts declared by the reference, per layer ---
REFERENCE_CHECKS: list[ColumnCheck] = [
    *_checks("stg_flights", not_null=(
        "flight_date", "flight_id", "departure_airport", "arrival_airport",
        "aircraft_type", "aircraft_registration", "landing_time")),
    *_checks("flights_enriched", not_null=("id", "flight_date", "flight_id")),
    *_checks("flights_filtered", not_null=(
        "id", "flight_date", "flight_id", "departure_airport", "arrival_airport",
        "aircraft_type", "bearing", "setor", "landing_time", "transito", "desimp",
        "kpi08", "transit_tma"), accepted={"setor": SECTORS}),
    *_checks("radar_in_terminal_area", not_null=(
        "id", "dt_radar", "nr_speed", "fl", "aircraft_type", "c_time", "aldt")),
    *_checks("fuel_chart_interpolated", not_null=("aircraft", "fl", "tas_ms", "fuel_flow_kg_s")),
    *_checks("fuel_at_points", not_null=("id", "dt_radar", "fl", "aircraft_type")),
    *_checks("dim_flight_identifiers", not_null=("id", "adep", "ades", "fltid", "aircraft", "date")),
    *_checks("dim_flight_operational_attributes", not_null=(
        "id", "drwy_validado", "bear", "setor", "c_time", "aldt"), accepted={"setor": SECTORS}),
    *_checks("fct_flight_transit_metrics", not_null=(
        "id", "transito", "desimp", "kpi08", "transit_tma")),
    *_checks("vertical_profile", not_null=(
        "id", "aircraft_type", "c_time", "dt_radar", "nr_speed", "fl", "avg_rocd", "elapsed"),
        positive=("fl", "elapsed")),
    *_checks("occupancy", not_null=("dt_valid_from",), unique=("dt_valid_from",),
             accepted={"is_current": ("true", "false")}),
]
# --- end of fixed values ---

# Documented but not declared by the reference: entry precedes landing.
ENTRY_BEFORE_LANDING = ColumnCheck("flights_filtered", "entry_time", "row_rule",
                                   predicate="entry_time <= landing_time")


def _failed(check: ColumnCheck) -> Column:
    c = F.col(check.column)
    if check.kind == "not_null":
        bad = c.isNull()
    elif check.kind == "positive":
        bad = c <= 0
    elif check.kind == "accepted_values":
        bad = c.isNotNull() & ~c.cast("string").isin(list(check.values))
    elif check.kind == "row_rule":
        bad = ~F.coalesce(F.expr(check.predicate), F.lit(True))
    else:  # unique: rows beyond the first of each non-NULL value
        return F.count(c) - F.count_distinct(c)
    return F.sum(F.when(bad, 1).otherwise(0))


def observable_checks(table: str, checks: Iterable[ColumnCheck] | None = None
                      ) -> dict[ColumnCheck, Column]:
    """The table's checks that the tasks writing it can count (all kinds but
    ``unique``, which needs the values of all tasks together)."""
    checks = REFERENCE_CHECKS if checks is None else checks
    return {c: F.coalesce(_failed(c).cast("bigint"), F.lit(0).cast("bigint"))
            for c in checks if c.table == table and c.kind != "unique"}


def run_checks(tables: Mapping[str, DataFrame],
               checks: Iterable[ColumnCheck] = REFERENCE_CHECKS) -> DataFrame:
    """Evaluate column checks on the named tables (one aggregate per table)."""
    by_table: dict[str, list[ColumnCheck]] = {}
    for chk in checks:
        by_table.setdefault(chk.table, []).append(chk)
    parts = []
    for table, cs in by_table.items():
        agg = tables[table].agg(*[
            F.coalesce(_failed(c).cast("bigint"), F.lit(0).cast("bigint")).alias(f"_f{i}")
            for i, c in enumerate(cs)])
        rows = agg.select(F.explode(F.array(*[
            F.struct(F.lit(c.table).alias("table_name"), F.lit(c.column).alias("column_name"),
                     F.lit(c.kind).alias("check_name"), F.col(f"_f{i}").alias("failed_rows"))
            for i, c in enumerate(cs)])).alias("r")).select("r.*")
        parts.append(rows)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("passed", F.col("failed_rows") == 0)


def orphan_keys(fact: DataFrame, dim: DataFrame, key: str = "id",
                max_broadcast_rows: int = 1_000_000, dim_bound: int | None = None) -> DataFrame:
    """Rows of ``fact`` whose key is missing from ``dim`` (NULL keys count)."""
    keys = broadcast_within(dim.select(key).distinct(), dim_bound, max_broadcast_rows)
    return fact.select(key).join(keys, key, "left_anti").agg(
        F.count(F.lit(1)).cast("bigint").alias("failed_rows"))


def non_empty(df: DataFrame) -> DataFrame:
    """One row: failed_rows = 1 when ``df`` is empty, else 0 (reads one row)."""
    return df.limit(1).agg((F.lit(1) - F.count(F.lit(1))).cast("bigint").alias("failed_rows"))


def custom_report(named: Mapping[str, DataFrame]) -> DataFrame:
    """Stack one-row custom checks into (check_name, failed_rows, passed)."""
    parts = [df.select(F.lit(name).alias("check_name"), "failed_rows") for name, df in named.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("passed", F.col("failed_rows") == 0)
