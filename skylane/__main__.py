"""Run the whole arrival pipeline:
``python -m skylane --flights ... --radar ... --chart ... --out ...`` (or
``spark-submit --py-files skylane.zip skylane/__main__.py ...``).

Reads the three sources, builds every layer, writes the tables and the check
reports, published under ``--out`` (full rebuild), and optionally exports the feature
table over JDBC.  Session settings (checkpoint folder, shuffle partitions)
come from the cluster's Spark configuration.
"""

from __future__ import annotations

import argparse
import datetime as dt
from pathlib import Path

from pyspark.sql import SparkSession

from skylane.config import ArrivalRules
from skylane.plans.pipeline import run_pipeline
from skylane.plans.strategy import release_tables
from skylane.sources import Sources, read_flight_records, read_fuel_chart, read_radar_points


def _date(s: str | None) -> dt.date | None:
    return dt.date.fromisoformat(s) if s else None


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    p = argparse.ArgumentParser(prog="skylane", description=__doc__.split("\n\n")[0])
    p.add_argument("--flights", required=True, help="flight KPI Parquet dataset (base folder)")
    p.add_argument("--radar", required=True, help="radar Parquet dataset (base folder)")
    p.add_argument("--chart", required=True, help="fuel chart CSV")
    p.add_argument("--out", required=True, help="output folder")
    p.add_argument("--start", help="first ingestion_date to read (YYYY-MM-DD)")
    p.add_argument("--end", help="last ingestion_date to read (YYYY-MM-DD)")
    p.add_argument("--no-partitions", action="store_true",
                   help="sources are plain folders without ingestion_date partitions")
    p.add_argument("--destination", default=ArrivalRules.destination)
    p.add_argument("--min-points", type=int, default=ArrivalRules.min_points)
    p.add_argument("--jdbc-url")
    p.add_argument("--jdbc-table", default="flight_consumption_ml_ready")
    p.add_argument("--jdbc-user")
    p.add_argument("--jdbc-password-file", help="file with the password (an argument is visible to other users)")
    p.add_argument("--fail-on-check", action="store_true",
                   help="publish nothing when a check fails")
    p.add_argument("--versioned", action="store_true",
                   help="keep every run's tables, published by a marker file")
    a = p.parse_args(argv)

    spark = spark or SparkSession.builder.appName("skylane").getOrCreate()
    part = not a.no_partitions
    sources = Sources(
        read_flight_records(spark, a.flights, part, _date(a.start), _date(a.end)),
        read_radar_points(spark, a.radar, part, _date(a.start), _date(a.end)),
        read_fuel_chart(spark, a.chart))
    rules = ArrivalRules(destination=a.destination, min_points=a.min_points)
    jdbc = None
    if a.jdbc_url:
        password = Path(a.jdbc_password_file).read_text().strip() if a.jdbc_password_file else None
        props = {k: v for k, v in (("user", a.jdbc_user), ("password", password)) if v}
        jdbc = {"url": a.jdbc_url, "table": a.jdbc_table, "properties": props}
    run_pipeline(sources, rules, a.out, jdbc=jdbc, fail_on_check=a.fail_on_check,
                 versioned=a.versioned)
    release_tables(spark)


if __name__ == "__main__":
    main()
