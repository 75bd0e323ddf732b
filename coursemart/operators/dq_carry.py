"""The declared suite with carried failures: a load's rows are checked, what failed before is kept.

What fails is kept as entries (model, column, test, item, row_id, n). For a journal, whose rows stay, entries are counts by item;
for a fact, whose rows are replaced by id, each failing row is an entry. With a load

* row-level checks and accepted values read the load's rows alone; a fact's entries of replaced rows go;
* uniqueness is checked for the load's keys over the table's key columns (a semi join), other keys keep what they had;
* references of the load's rows and of the entries carried so far are looked up among the parents' keys.

This needs parents that lose no key (facts and journals do not; the caller checks the dimensions) and rows that change
only by being loaded again. The report is counted from the entries; a first run takes all rows for the load.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coursemart.operators.dq import _ROW_LEVEL, Check, _row_condition, dq_relationships
from coursemart.session import scratch_path

ENTRY = "model string, column_name string, test string, item string, row_id string, n long"
ITEMS = {"unique", "unique_combination", "accepted_values"}     # reported as the number of failing items, others of rows


@dataclass(frozen=True)
class Load:
    """A checked table: all its rows, those of this load, and the id by which rows are replaced (None: a journal)."""
    rows: DataFrame
    new: DataFrame
    id_col: str | None
    first: bool                # the load is the whole table


def _name(c: Check) -> str:
    return c.column if c.column else c.args["name"]


def _tag(c: Check) -> list:
    return [F.lit(c.model).alias("model"), F.lit(_name(c)).alias("column_name"), F.lit(c.test).alias("test")]


def _values(load: Load, cs: list[Check], bad: Callable[[Check], Column]) -> DataFrame:
    """One pass over the load: an entry for each check of ``cs`` whose condition ``bad`` a row meets. The item is the column's value
    where items are reported or looked up; a journal's entries are counted by item."""
    null = F.lit(None).cast("string")
    hits = F.array(*[F.when(bad(c), F.struct(*_tag(c), (F.col(c.column).cast("string") if c.test in ("accepted_values", "relationships") else null)
                                             .alias("item"))) for c in cs])
    row_id = F.col(load.id_col).cast("string") if load.id_col else null
    found = load.new.select(F.explode(F.filter(hits, lambda x: x.isNotNull())).alias("e"), row_id.alias("row_id"))
    found = found.select("e.*", "row_id", F.lit(1).cast("long").alias("n"))
    return found if load.id_col else _summed(found)


def _summed(entries: DataFrame) -> DataFrame:
    return entries.groupBy("model", "column_name", "test", "item", "row_id").agg(F.sum("n").alias("n"))


def _unique(load: Load, c: Check, carried: DataFrame) -> DataFrame:
    """Keys of the load that more than one row of the table holds, and the other keys' entries."""
    cols = c.column.split(",")
    keys, rows = load.new.select(*cols), load.rows.select(*cols)
    if c.test == "unique":                                      # NULLs are not checked; a combination's are values like others
        keys, rows = keys.na.drop(), rows.na.drop()
    text = F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
    if not load.first:
        seen = keys.distinct().select(*[F.col(x).alias(f"_{x}") for x in cols])
        rows = rows.join(seen, reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(f"_{x}")) for x in cols]), "left_semi")
    now = rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*_tag(c), text.alias("item"), F.lit(None).cast("string").alias("row_id"), "n")
    if load.first:
        return now
    old = carried.filter((F.col("test") == c.test) & (F.col("column_name") == _name(c)))
    return now.unionByName(old.join(keys.select(text.alias("item")).distinct(), "item", "left_anti").select(*now.columns))


def _orphans(load: Load, cs: list[Check], carried: DataFrame, models: Callable[[str], DataFrame]) -> DataFrame:
    """References without a parent, of the load's rows and of the entries so far; all of a model's in one join. Where all
    rows are the load, one anti join for each on the keys as they are, which a small parent answers by broadcast."""
    if load.first:
        row_id = F.col(load.id_col).cast("string") if load.id_col else F.lit(None).cast("string")
        found = []
        for c in cs:
            child = load.rows.select(*dict.fromkeys([c.column, *([load.id_col] if load.id_col else [])]))
            lost = dq_relationships(child, c.column, models(c.args["to"]), c.args["field"])
            found.append(lost.select(*_tag(c), F.col(c.column).cast("string").alias("item"), row_id.alias("row_id"), F.lit(1).cast("long").alias("n")))
        return reduce(DataFrame.unionByName, found)
    rows = _values(load, cs, lambda c: F.col(c.column).isNotNull())
    rows = rows.unionByName(carried.filter(F.col("test") == "relationships"))
    keys = reduce(DataFrame.unionByName, [models(c.args["to"]).select(F.lit(c.column).alias("column_name"), F.col(c.args["field"]).cast("string").alias("item"))
                                          for c in cs])
    on = ["column_name", "item"]
    keys = keys.join(rows.select(*on).distinct(), on, "left_semi")  # few of the parents' keys are asked for
    return rows.join(keys.distinct(), on, "left_anti").select(*rows.columns)


def failing(load: Load, checks: list[Check], carried: DataFrame, models: Callable[[str], DataFrame]) -> DataFrame:
    """The entries of one model after the load. ``carried``: the entries of all models before."""
    columns = ["model", "column_name", "test", "item", "row_id", "n"]
    carried = carried.filter(F.col("model") == checks[0].model)
    if load.id_col is not None and not load.first:              # a replaced row's entries go
        ids = load.new.select(F.col(load.id_col).cast("string").alias("row_id")).distinct()
        carried = carried.join(ids, "row_id", "left_anti").select(*columns)
    by_row = [c for c in checks if c.test in _ROW_LEVEL or c.test == "accepted_values"]

    def bad(c: Check) -> Column:
        if c.test == "accepted_values":
            return F.coalesce(~F.col(c.column).isin(*c.args["values"]), F.lit(False))
        return F.coalesce(_row_condition(c), F.lit(False))

    parts = [_values(load, by_row, bad)] if by_row else []
    parts += [_unique(load, c, carried) for c in checks if c.test in ("unique", "unique_combination")]
    references = [c for c in checks if c.test == "relationships"]
    if references:
        parts.append(_orphans(load, references, carried, models))
    if not load.first:
        parts.append(carried.filter(F.col("test").isin(*_ROW_LEVEL, "accepted_values")))
    return _summed(reduce(DataFrame.unionByName, [x.select(*columns) for x in parts]))


def carry(spark: SparkSession, loads: dict[str, Load], checks: list[Check], carried: DataFrame | None, models: Callable[[str], DataFrame],
          parallelism: int = 8) -> DataFrame:
    """The entries of all models after the load; each model is its own job, several at once."""
    before = carried if carried is not None else spark.createDataFrame([], ENTRY)
    paths = {m: scratch_path(spark, "dq_entries") for m in loads}

    def write(m: str) -> None:
        failing(loads[m], [c for c in checks if c.model == m], before, models).write.parquet(paths[m])
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        list(pool.map(write, loads))
    return spark.read.schema(ENTRY).parquet(*paths.values())


def report(entries: DataFrame, checks: list[Check]) -> DataFrame:
    """(model, column_name, test, failures) of the checks, one row each."""
    key = ["model", "column_name", "test"]
    counted = entries.groupBy(*key).agg(F.countDistinct("item").alias("items"), F.sum("n").alias("rows"))
    declared = entries.sparkSession.createDataFrame([(c.model, _name(c), c.test) for c in checks], "model string, column_name string, test string")
    x = declared.select(*key).join(F.broadcast(counted), key, "left")              # at most one row a check
    return x.select(*key, F.coalesce(F.when(F.col("test").isin(*ITEMS), F.col("items")).otherwise(F.col("rows")), F.lit(0)).cast("bigint").alias("failures"))
