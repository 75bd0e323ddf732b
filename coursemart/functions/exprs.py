"""Column expressions shared by all layers (JVM-side built-ins only, no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from coursemart.params import Params


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols, mode: str = "xxhash64") -> Column:
    """Surrogate key of one or more natural-key columns, as BIGINT.

    ``xxhash64``: integral keys are widened to LONG first so that an INT and a
    LONG of the same value hash alike. ``md5``: the first 60 bits of the md5 of
    the key text (``'|'``-joined for several columns), a form any SQL engine can
    reproduce. A NULL single key gives NULL in md5 mode, so callers take keys from
    joined parents and never hash a nullable foreign key.
    """
    cs = [col(c) for c in cols]
    if mode == "xxhash64":
        return F.xxhash64(*cs)
    if mode == "md5":
        text = cs[0].cast("string") if len(cs) == 1 else F.concat_ws("|", *[c.cast("string") for c in cs])
        return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
    raise ValueError(f"unknown key mode {mode!r}")


def _widen_typed(c: Column, dtype: str) -> Column:
    # xxhash64(1) != xxhash64(1L); hashing the LONG form keeps keys stable across INT/LONG sources.
    return c.cast("bigint") if dtype in ("tinyint", "smallint", "int", "bigint") else c


def surrogate_key_df(df, *names: str, mode: str = "xxhash64") -> Column:
    """``surrogate_key`` with integral widening driven by the DataFrame's schema."""
    types = dict(df.dtypes)
    if mode == "xxhash64":
        return F.xxhash64(*[_widen_typed(F.col(n), types[n]) for n in names])
    return surrogate_key(*names, mode=mode)


def key(df, *names: str, p: Params) -> Column:
    return surrogate_key_df(df, *names, mode=p.key_mode)


def round_half_away(x, digits: int = 2) -> Column:
    """round(x, d) on a DOUBLE the binary way: round(x * 10^d) / 10^d.

    ``round(1.005, 2)`` is 1.0 because 1.005 * 100 is 100.4999…; Spark's own
    ``round`` works on the decimal text and would give 1.01.
    """
    scale = float(10 ** digits)
    return F.round(col(x).cast("double") * F.lit(scale), 0) / F.lit(scale)


def safe_div(a, b) -> Column:
    """a / b as DOUBLE, NULL when b is 0 or NULL (never raises under ANSI)."""
    return col(a).cast("double") / F.nullif(col(b).cast("double"), F.lit(0.0))


def exact_avg(x) -> Column:
    """avg of a DECIMAL column as DOUBLE from the exact sum (aggregate expression)."""
    return F.sum(col(x)).cast("double") / F.nullif(F.count(col(x)), F.lit(0))


def cents_sum_count(x, digits: int = 2) -> tuple[Column, Column]:
    """Aggregate parts of an exact average of values that carry ``digits`` decimals:
    (sum of integer units, count). Finish with ``exact_round_avg``."""
    units = F.round(col(x).cast("double") * F.lit(float(10 ** digits)), 0).cast("bigint")
    return F.sum(units), F.count(units)


def exact_round_avg(s: str, c: str, digits: int = 2) -> Column:
    """round(avg, digits) from ``cents_sum_count`` parts (named columns ``s``, ``c``), half
    away from zero, in integer arithmetic: the result does not depend on the order the
    values were summed in (a DOUBLE sum can land either side of an .xx5 tie)."""
    units = F.expr(f"signum({s}) * ((2 * abs({s}) + {c}) div (2 * {c}))")
    return F.when(F.col(c) > 0, units / F.lit(float(10 ** digits)))


def completed_years(end, start) -> Column:
    """Whole calendar years from ``start`` to ``end`` (extract(year from age(end, start))).

    Truncates toward zero when ``end`` is before ``start``; Feb 29 → Feb 28 of the
    next year is 0 years.
    """
    e, s = col(end), col(start)

    def fwd(a, b):  # a >= b
        before = (F.month(a) < F.month(b)) | ((F.month(a) == F.month(b)) & (F.dayofmonth(a) < F.dayofmonth(b)))
        return F.year(a) - F.year(b) - F.when(before, 1).otherwise(0)

    return F.when(e >= s, fwd(e, s)).otherwise(-fwd(s, e))


def date_lit(s: str) -> Column:
    return F.to_date(F.lit(s))


def ts_lit(s: str) -> Column:
    """A TIMESTAMP_NTZ literal (time-zone free, like the source's TIMESTAMP)."""
    return F.to_timestamp_ntz(F.lit(s))


# Grade scales (threshold, grade), highest first.
POSTGRAD_SCALE = [(85, "A"), (80, "A-"), (75, "B+"), (70, "B"), (65, "B-"), (60, "C+"), (55, "C"), (0, "F")]
UNDERGRAD_SCALE = [(85, "A"), (80, "A-"), (75, "B+"), (70, "B"), (65, "B-"), (60, "C+"), (55, "C"),
                   (50, "C-"), (45, "D+"), (40, "D"), (35, "D-"), (0, "F")]
POSTGRAD_LEVELS = ["Master's", "Doctoral"]

# Degree result bands over the mean completed mark.
DEGREE_RESULT_BANDS = [(85, "High Distinction"), (75, "Distinction"), (65, "Merit")]
DEGREE_RESULT_OTHERWISE = "Pass"

# Accepted domains.
PROGRAM_STATUSES = ["Active", "Graduated", "Withdrawn", "Suspended", "Dismissed", "Leave of Absence"]
SUBJECT_ENROLLMENT_STATUSES = ["Enrolled", "Completed", "Dropped", "Withdrawn", "Transferred"]
DEGREE_RESULTS = ["High Distinction", "Distinction", "Merit", "Pass"]
STAGED_GRADES = ["A", "A-", "B+", "B", "B-", "C+", "C", "C-", "D+", "D", "D-", "F"]
SOURCE_GRADES = STAGED_GRADES + ["P", "S", "U", "CR", "NC", "I", "W"]
DEGREE_LEVELS = ["Associate", "Bachelor's", "Master's", "Doctoral", "Certificate"]
SUBJECT_TYPES = ["Core", "Major Requirement", "Elective", "General Education", "Prerequisite"]

# Expected programme length in years by degree level (default 4).
DEGREE_YEARS = {"Bachelor's": 4, "Master's": 2, "Doctoral": 5}
DEFAULT_DEGREE_YEARS = 4


def _scale(mark: Column, scale) -> Column:
    out = None
    for t, g in scale:
        cond = mark >= F.lit(t)
        out = F.when(cond, F.lit(g)) if out is None else out.when(cond, F.lit(g))
    return out.otherwise(F.lit("F"))


def grade_from_mark(mark, degree_level) -> Column:
    """Letter grade from a 0-100 mark; postgraduate levels use the shorter scale. NULL mark → NULL."""
    m, lvl = col(mark), col(degree_level)
    g = F.when(lvl.isin(*POSTGRAD_LEVELS), _scale(m, POSTGRAD_SCALE)).otherwise(_scale(m, UNDERGRAD_SCALE))
    return F.when(m.isNull(), F.lit(None).cast("string")).otherwise(g)


def score_band(frac, p: Params) -> Column:
    f = col(frac)
    return (F.when(f >= F.lit(p.score_band_excellent_pct), "Excellent")
            .when(f >= F.lit(p.score_band_satisfactory_pct), "Satisfactory")
            .when(f >= F.lit(p.pass_threshold_pct), "Needs Improvement")
            .otherwise("Fail"))


def trend(cur, prev) -> Column:
    c, pv = col(cur), col(prev)
    return (F.when(pv.isNull(), "First")
            .when(c > pv, "Improving")
            .when(c < pv, "Declining")
            .otherwise("Stable"))


def degree_years(level) -> Column:
    lv = col(level)
    out = None
    for k, y in DEGREE_YEARS.items():
        out = F.when(lv == F.lit(k), F.lit(y)) if out is None else out.when(lv == F.lit(k), F.lit(y))
    return out.otherwise(F.lit(DEFAULT_DEGREE_YEARS))
