"""Literal source rows for hand-made model cases (one tiny university)."""

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import types as T

from coursemart.sources.staging import SOURCE_SCHEMAS, stage_all

SF_SMALL = "/root/testdata/sf0.001"
TS0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def ts(s):
    return dt.datetime.fromisoformat(s)


def d(s):
    return dt.date.fromisoformat(s)


def with_ingested(schema: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField("_ingested_at", T.TimestampNTZType())])


def base_rows():
    """Programs, subjects, semesters, offerings, assessments, students."""
    return {
        "programs": [("P1", "Bachelor of X", "Science", "Bachelor's", 144, TS0),
                     ("P2", "Master of Y", "Law", "Master's", 96, TS0)],
        "subjects": [("S1", "Subject 1", 6, TS0), ("S2", "Subject 2", 12, TS0)],
        "semesters": [("SEM1", "S1", 2020, d("2020-02-01"), d("2020-06-01"), TS0),
                      ("SEM2", "S2", 2020, d("2020-07-01"), d("2020-11-01"), TS0),
                      ("SEM3", "S1", 2021, d("2021-02-01"), d("2021-06-01"), TS0)],
        "program_subjects": [(1, "P1", "S1", "Core", 1, TS0)],
        "students": [("U1", "Ann", "A", "a@x", TS0, TS0), ("U2", "Bob", "B", "b@x", TS0, TS0),
                     ("U3", "Cy", "C", "c@x", TS0, TS0), ("U4", "Di", "D", "d@x", TS0, TS0)],
        "subject_offerings": [(10, "S1", "SEM1", "Dr. A", TS0), (11, "S1", "SEM2", "Dr. A", TS0),
                              (12, "S1", "SEM3", "Dr. B", TS0), (20, "S2", "SEM1", "Dr. B", TS0)],
        "assessments": [(100, 10, "A1", D("50.00"), D("20.00"), TS0), (101, 10, "A2", D("50.00"), D("20.00"), TS0),
                        (200, 20, "B1", D("100.00"), D("10.00"), TS0)],
    }


def make_staged(spark, rows):
    out = {}
    for t, schema in SOURCE_SCHEMAS.items():
        out[t] = spark.createDataFrame(rows.get(t, []), with_ingested(schema))
    return stage_all(out)
