"""The arrival pipeline: operators composed in dependency order.

    flights -> staged -> enriched -> filtered --------------------+
    radar  -> staged ----------------> radar_in_terminal_area --+ |
    chart  -> staged -> interpolated ---------+                 | |
                                              +-> fuel_at_points | |
                                              +-> vertical_profile |
                          radar_in_terminal_area -> occupancy      |
    filtered + profile + occupancy -> flight_consumption -> ml_features

The layers read by several consumers (filtered flights, interpolated chart,
terminal-area radar, profile, occupancy) are computed once: ``materialize``
``"table"`` (default) writes them as Parquet into the session's checkpoint
folder and reads them back (lineage cut, bounded recomputation after an
executor loss, column pruning for each consumer), ``"checkpoint"`` uses Spark's
reliable checkpoint there, ``"cache"`` keeps them in executor storage for one
session, ``"none"`` leaves one plan in which every consumer re-derives the
shared layers (for plan inspection only).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DayTimeIntervalType

from skylane.config import ArrivalRules
from skylane.functions.intervals import interval_seconds
from skylane.operators import (
    enrich_flights, filter_arrivals, flight_consumption, flight_identifiers,
    fuel_flow_at_points, interpolate_fuel_chart, ml_features, occupancy_intervals,
    operational_attributes, radar_in_terminal_area, stage_chart, stage_flights,
    stage_radar, transit_metrics, vertical_profile,
)
from skylane.operators.quality import (
    REFERENCE_CHECKS, custom_report, non_empty, observable_checks, orphan_keys, run_checks,
)
from skylane.plans.strategy import FlightBounds, materialize
from skylane.sources.published import Swap, Versions
from skylane.sources.readers import Sources
from skylane.sources.sinks import export_jdbc, write_table


class ArrivalLayers:
    """All tables of the pipeline, built on first access and memoised.

    ``layers["vertical_profile"]`` builds only what that table needs; shared
    layers are materialised once according to ``materialize``.  The row
    bound of the filtered flights (one aggregate job) is measured on first use
    and drives every flight-level broadcast decision.
    """

    NAMES = (
        "stg_flights", "stg_radar", "stg_chart", "flights_enriched", "flights_filtered",
        "fuel_chart_interpolated", "radar_in_terminal_area", "fuel_at_points",
        "vertical_profile", "occupancy", "dim_flight_identifiers",
        "dim_flight_operational_attributes", "fct_flight_transit_metrics",
        "flight_consumption", "ml_features",
    )

    def __init__(self, sources: Sources, rules: ArrivalRules, materialize: str = "table",
                 store: Versions | Swap | None = None, fail_on_check: bool = False):
        self.sources = sources
        self.rules = rules
        self.materialize = materialize
        self.store = store              # shared layers are written here as output tables
        self.fail_on_check = fail_on_check
        self.results: list[tuple] = []  # (table or None, column, check, failed rows)
        self.written: dict[str, int | None] = {}  # stored tables and their rows
        self._memo: dict[str, DataFrame] = {}
        self._bounds: FlightBounds | None = None
        self._chart_rows: int | None = None
        self._day_parts: int | None = None

    @property
    def chart_rows(self) -> int:
        """Rows of the staged fuel chart (one small count)."""
        if self._chart_rows is None:
            self._chart_rows = self["stg_chart"].count()
        return self._chart_rows

    @property
    def bounds(self) -> FlightBounds:
        if self._bounds is None:
            self._bounds = FlightBounds.measure(self["flights_filtered"])
        return self._bounds

    def keys(self):
        return list(self.NAMES)

    def __iter__(self):
        return iter(self.NAMES)

    # layers read by several consumers: computed once (see ``materialize``)
    SHARED = ("flights_filtered", "fuel_chart_interpolated", "radar_in_terminal_area",
              "vertical_profile", "occupancy", "flight_consumption")

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._memo:
            df = self.plan(name)
            if name not in self.SHARED:
                self._memo[name] = df
            elif self.store and name in OUTPUTS and not has_interval(df):
                self._memo[name] = self.write(name, df)
            else:
                self._memo[name] = materialize(df, self.materialize, name)
        return self._memo[name]

    def write(self, name: str, df: DataFrame) -> DataFrame:
        """Stage an output table and check it in the same pass, before anything
        reads it; returns the staged rows."""
        partition_by, order = OUTPUTS[name]
        day = DAY_PARTITIONED.get(name)
        stored = storable(df)
        if day:
            stored = stored.withColumn(DAY, F.to_date(day))
            partition_by = [DAY]
        checks = observable_checks(name)
        path = self.store.staged(name)
        got = write_table(stored, path, partition_by, sort_by=order,
                          parts=self.day_parts if day else None,
                          metrics={f"_c{i}": m for i, m in enumerate(checks.values())}
                          | {"_rows": F.count(F.lit(1))})
        back = self._read(path, stored.drop(DAY) if day else stored)
        declared = [c for c in REFERENCE_CHECKS if c.table == name]
        seen = {c: got[f"_c{i}"] for i, c in enumerate(checks)} if "_rows" in got else {}
        self.written[name] = got.get("_rows")
        self._record([(c.table, c.column, c.kind, seen[c]) for c in declared if c in seen])
        rest = [c for c in declared if c not in seen]  # one aggregate over their columns
        if rest:
            self._record([tuple(r)[:4] for r in run_checks({name: back}, rest).collect()])
        return back

    def _read(self, path: str, like: DataFrame) -> DataFrame:
        # in the original column order (partition columns come last)
        return like.sparkSession.read.schema(like.schema).parquet(path).select(*like.columns)

    def _record(self, results: list[tuple]) -> None:
        self.results += results
        failed = [r for r in results if r[-1]]
        if failed and self.fail_on_check:
            raise DataQualityError(f"{len(failed)} failing check(s): {failed}")

    def check_views(self) -> None:
        """The column checks of the layers that are not stored."""
        checks = [c for c in REFERENCE_CHECKS if c.table not in OUTPUTS]
        self._record([tuple(r)[:4] for r in run_checks(self, checks).collect()])

    def check_keys(self, name: str) -> None:
        """Every flight key of a stored table is in the flight dimension."""
        self._record([(None, None, f"{check}_keys_in_dim",
                       orphan_keys(self[table], self["dim_flight_identifiers"],
                                   max_broadcast_rows=self.rules.broadcast_max_rows,
                                   dim_bound=self.bounds.flights).first().failed_rows)
                      for table, check in KEYED.items() if table == name])

    def check_rows(self, name: str) -> None:
        """The profile holds rows."""
        if name == "vertical_profile":
            n = self.written[name]
            empty = self[name].isEmpty() if n is None else n == 0
            self._record([(None, None, f"{name}_non_empty", int(empty))])

    @property
    def day_parts(self) -> int:
        """Tasks that write one day of radar points, from the flights of the
        fullest day.  An estimate: it decides the number of files only."""
        if self._day_parts is None:
            peak = self["flights_filtered"].groupBy("flight_date").count().agg(F.max("count")).first()[0]
            self._day_parts = 1 + (peak or 0) * POINTS_PER_FLIGHT // self.rules.rows_per_file
        return self._day_parts

    def published(self) -> None:
        """Put the staged tables in force and read them from their place."""
        self.store.publish([*self.written, "dq_columns", "dq_custom"])
        for name in self.written:
            df = self._memo.get(name)
            if df is not None and not has_interval(df):
                self._memo[name] = self._read(self.store.location(name), df)

    def register_views(self, names=None, prefix: str = "") -> list[str]:
        """Register layers as temporary views for ad-hoc ``spark.sql`` queries
        (built lazily; nothing runs until a query reads a view)."""
        registered = []
        for name in names or self.NAMES:
            self[name].createOrReplaceTempView(prefix + name)
            registered.append(prefix + name)
        return registered

    def plan(self, name: str) -> DataFrame:
        """The layer's own (unmaterialised) plan over its materialised inputs."""
        if name not in self.NAMES:
            raise KeyError(name)
        return getattr(self, "_" + name)()

    # -- layer definitions -------------------------------------------------
    def _stg_flights(self):
        return stage_flights(self.sources.flights)

    def _stg_radar(self):
        return stage_radar(self.sources.radar)

    def _stg_chart(self):
        return stage_chart(self.sources.chart)

    def _flights_enriched(self):
        return enrich_flights(self["stg_flights"])

    def _flights_filtered(self):
        return filter_arrivals(self["flights_enriched"], self.rules)

    def _fuel_chart_interpolated(self):
        return interpolate_fuel_chart(self["stg_chart"], self.rules, chart_rows=self.chart_rows)

    def _radar_in_terminal_area(self):
        return radar_in_terminal_area(
            self["flights_filtered"], self["stg_radar"], self.rules, bounds=self.bounds)

    def _fuel_at_points(self):
        return fuel_flow_at_points(self["radar_in_terminal_area"],
                                   self["fuel_chart_interpolated"], self.rules,
                                   chart_rows=self.chart_rows)

    def _vertical_profile(self):
        return vertical_profile(
            self["radar_in_terminal_area"], self["fuel_chart_interpolated"], self.rules,
            bounds=self.bounds, chart_rows=self.chart_rows, mode=self.materialize)

    def _occupancy(self):
        return occupancy_intervals(self["radar_in_terminal_area"], self.rules, bounds=self.bounds)

    def _dim_flight_identifiers(self):
        return flight_identifiers(self["flights_filtered"])

    def _dim_flight_operational_attributes(self):
        return operational_attributes(self["flights_filtered"])

    def _fct_flight_transit_metrics(self):
        return transit_metrics(self["flights_filtered"])

    def _flight_consumption(self):
        return flight_consumption(self["flights_filtered"], self["vertical_profile"],
                                  self["occupancy"], self.rules, bounds=self.bounds)

    def _ml_features(self):
        return ml_features(self["flight_consumption"], self.rules, bounds=self.bounds)


def build_layers(sources: Sources, rules: ArrivalRules,
                 materialize: str = "table") -> ArrivalLayers:
    """All tables of the pipeline, keyed by layer name (built lazily)."""
    return ArrivalLayers(sources, rules, materialize)


def quality_report(layers: ArrivalLayers) -> tuple[DataFrame, DataFrame]:
    """The declared checks: column checks of every layer (one aggregate per
    table) and the custom checks (no orphan flight keys, non-empty profile)."""
    columns = run_checks(layers, REFERENCE_CHECKS)
    dim = layers["dim_flight_identifiers"]
    n, cap = layers.bounds.flights, layers.rules.broadcast_max_rows
    custom = custom_report({
        "transit_metrics_keys_in_dim": orphan_keys(layers["fct_flight_transit_metrics"], dim,
                                                   max_broadcast_rows=cap, dim_bound=n),
        "vertical_profile_keys_in_dim": orphan_keys(layers["vertical_profile"], dim,
                                                    max_broadcast_rows=cap, dim_bound=n),
        "vertical_profile_non_empty": non_empty(layers["vertical_profile"]),
    })
    return columns, custom


class DataQualityError(RuntimeError):
    """Raised by ``run_pipeline(fail_on_check=True)`` when a check fails."""


def storable(df: DataFrame) -> DataFrame:
    """Replace day-time interval columns by seconds (Parquet has no interval)."""
    return df.select(*[
        interval_seconds(F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, DayTimeIntervalType) else F.col(f.name)
        for f in df.schema.fields])


def has_interval(df: DataFrame) -> bool:
    return any(isinstance(f.dataType, DayTimeIntervalType) for f in df.schema.fields)


# Tables written by run_pipeline: (partition columns, sort columns).
OUTPUTS = {
    "flights_filtered": (["flight_date"], None),
    "dim_flight_identifiers": (["date"], None),
    "dim_flight_operational_attributes": (None, None),
    "fct_flight_transit_metrics": (None, None),
    "fuel_chart_interpolated": (None, None),
    "radar_in_terminal_area": (None, None),
    "fuel_at_points": (None, None),
    "vertical_profile": (None, None),
    "occupancy": (None, ["dt_valid_from"]),
    "flight_consumption": (["date"], None),
    "ml_features": (["date"], None),
}

# The largest tables, stored by the day of this instant in a further column.
DAY = "radar_date"
DAY_PARTITIONED = {"radar_in_terminal_area": "dt_radar", "fuel_at_points": "dt_radar",
                   "vertical_profile": "dt_radar"}
POINTS_PER_FLIGHT = 500

# Tables whose flight keys must be in the dimension, and the check's name.
KEYED = {"fct_flight_transit_metrics": "transit_metrics", "vertical_profile": "vertical_profile"}


def run_pipeline(sources: Sources, rules: ArrivalRules, out_dir: str, jdbc: dict | None = None,
                 fail_on_check: bool = False, versioned: bool = False) -> ArrivalLayers:
    """Build every layer, write and check it aside, then publish all tables
    together with the check results ``dq_columns`` and ``dq_custom`` and, if
    ``jdbc`` = {url, table, properties} is given, export the features.

    Checks are counted by the tasks that write a table; only uniqueness and
    flight keys read a written column again.  With ``fail_on_check`` the first
    table with a failing check raises ``DataQualityError`` before its consumers
    are built: nothing is published or exported, the previous tables stand.

    By default the tables lie in ``out_dir/<name>`` (replaced by renames); with
    ``versioned`` every run keeps its own folder and one marker file publishes
    it (``sources.published``: ``read_published``, ``Versions.vacuum``).
    """
    spark = sources.flights.sparkSession
    store = (Versions if versioned else Swap)(spark, out_dir)
    store.begin()
    layers = ArrivalLayers(sources, rules, store=store, fail_on_check=fail_on_check)
    try:
        layers.check_views()
        for name in OUTPUTS:
            df = layers[name]  # shared layers are written here once, as the output itself
            if name not in layers.written:
                back = layers.write(name, df)
                if not has_interval(df):
                    layers._memo[name] = back
            layers.check_keys(name)
            layers.check_rows(name)
    finally:  # a failed run leaves its report in its own folder
        _write_reports(spark, layers)
    layers.published()
    if jdbc:
        export_jdbc(layers["ml_features"], jdbc["url"], jdbc["table"], jdbc.get("properties"))
    return layers


def _write_reports(spark, layers: ArrivalLayers) -> None:
    """The check results so far (one small row per declared check)."""
    columns = [(*r, r[3] == 0) for r in layers.results if r[0] is not None]
    custom = [(r[2], r[3], r[3] == 0) for r in layers.results if r[0] is None]
    write_table(spark.createDataFrame(columns, "table_name string, column_name string, "
                                      "check_name string, failed_rows bigint, passed boolean").coalesce(1),
                layers.store.staged("dq_columns"))
    write_table(spark.createDataFrame(custom, "check_name string, failed_rows bigint, passed boolean")
                .coalesce(1), layers.store.staged("dq_custom"))
