"""Builders of small input tables in the source schemas."""

from __future__ import annotations

import datetime as dt

from skylane.sources.schemas import FLIGHT_RECORDS, FUEL_CHART, RADAR_POINTS

T = dt.datetime


def flight(**kw):
    row = dict(fltid="TAM1", adep="SBBR", ades="SBGR", type="A320", reg="PR-1",
               drwy_validado="28R", bear=10.0, setor=None, c_time=T(2024, 1, 1, 10, 0),
               c=100, aldt=T(2024, 1, 1, 11, 0), transito=600.0, desimp="00:10:00",
               kpi08="00:01:00")
    row.update(kw)
    return tuple(row[f.name] for f in FLIGHT_RECORDS.fields)


def radar(cs, level, speed, ts):
    return (cs, level, speed, ts)


def flights_df(spark, rows):
    return spark.createDataFrame(rows, FLIGHT_RECORDS)


def radar_df(spark, rows):
    return spark.createDataFrame(rows, RADAR_POINTS)


def chart_df(spark, rows):
    return spark.createDataFrame(rows, FUEL_CHART)
