"""Reading a live source table over JDBC (the production input of landing).

A read is always split: by ranges of an integral column between two bounds, or by a list of predicates (for
string keys, see ``key_predicates``); a table read over one connection has to be asked for. An
incremental bound goes to the database as part of the query. No database is started here: tests check the options
that a read is given; landing is tested from Parquet with the same operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from coursemart.sources.staging import INCREMENTAL_TABLES, SOURCE_SCHEMAS, check_schema


def source_query(table: str, where: str | None) -> str:
    """The ``dbtable`` of a read: the table, or the rows of it that ``where`` selects."""
    return table if where is None else f"(select * from {table} where {where}) as bounded"


def cursor_bound(cursor: str, watermark, lookback_minutes: int) -> str | None:
    """The landing rule ``cursor > watermark - lookback`` as a predicate (None before the first load)."""
    return None if watermark is None else f"{cursor} > timestamp '{watermark}' - interval '{int(lookback_minutes)}' minute"


def key_predicates(column: str, parts: int) -> list[str]:
    """Predicates that split a table by the last two characters of a text key, and one for null keys."""
    tails = [f"{i:02d}" for i in range(100)]
    groups = [tails[i::parts] for i in range(min(parts, 100))]
    listed = ", ".join(f"'{t}'" for t in tails)
    return [f"right({column}, 2) in ({', '.join(repr(t) for t in g)})" for g in groups] + \
        [f"{column} is null or right({column}, 2) not in ({listed})"]


def scan_options(table: str, where: str | None = None, partition_column: str | None = None, lower: int | None = None,
                 upper: int | None = None, num_partitions: int = 64, single_connection: bool = False) -> dict[str, str]:
    """Reader options of a range-split read. Missing bounds are an error, not a read in one task."""
    options = {"dbtable": source_query(table, where)}
    if partition_column is None or lower is None or upper is None:
        if not single_connection:
            raise ValueError(f"{table}: give partition_column, lower and upper, or predicates, or single_connection=True")
        return options
    return options | {"partitionColumn": partition_column, "lowerBound": str(lower), "upperBound": str(upper),
                      "numPartitions": str(num_partitions)}


def scan_source(spark: SparkSession, url: str, table: str, properties: dict, where: str | None = None,
                predicates: list[str] | None = None, schema: T.StructType | None = None, **split) -> DataFrame:
    if predicates:
        df = spark.read.jdbc(url, source_query(table, where), predicates=predicates, properties=properties)
    else:
        df = spark.read.format("jdbc").option("url", url).options(**properties, **scan_options(table, where, **split)).load()
    expected = schema or SOURCE_SCHEMAS.get(table.split(".")[-1])
    if expected is not None:
        check_schema(df, expected)
    return df


def scan_sources(spark: SparkSession, url: str, properties: dict, splits: dict[str, dict], watermarks: dict | None = None,
                 lookback_minutes: int = 10) -> dict[str, DataFrame]:
    """All ten source tables for ``pipeline.run_pipeline``. ``splits``: table -> arguments of ``scan_source``;
    ``watermarks``: journal -> its landed watermark, whose bound is then pushed to the database."""
    out = {}
    for t in SOURCE_SCHEMAS:
        bound = None
        if t in INCREMENTAL_TABLES and watermarks:
            bound = cursor_bound(INCREMENTAL_TABLES[t]["cursor"], watermarks.get(t), lookback_minutes)
        out[t] = scan_source(spark, url, t, properties, where=bound, **splits.get(t, {}))
    return out
