"""Column-expression building blocks (all JVM-side, whole-stage codegen)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def mean(col) -> Column:
    """Null-skipping mean in full precision; null when there are no values."""
    return F.avg(_c(col))


def minute_floor(ts) -> Column:
    return F.date_trunc("minute", _c(ts)).cast("timestamp_ntz")


def time_floor(ts, unit: str) -> Column:
    return F.date_trunc(unit, _c(ts)).cast("timestamp_ntz")


def floor_minutes(ts, minutes: int) -> Column:
    """Floor a timestamp to a multiple of ``minutes`` within its hour (5, 30)."""
    t = _c(ts)
    hour = F.date_trunc("hour", t).cast("timestamp_ntz")
    m = (F.minute(t) / minutes).cast("int") * minutes
    return F.timestamp_add("MINUTE", m, hour)


def band(col, edges: Sequence[float], labels: Sequence[str], right_closed: bool = True,
         null_label: str | None = None) -> Column:
    """Generic banding (P17): ``labels[i]`` for the i-th interval of ``edges``.

    right_closed=True: x <= edges[0] -> labels[0], x <= edges[1] -> labels[1] ...
    right_closed=False: x < edges[0] -> labels[0] ...; beyond the last edge the
    last label. Null input -> ``null_label``.
    """
    assert len(labels) == len(edges) + 1
    x = _c(col)
    expr = F.when(x.isNull(), F.lit(null_label))
    for edge, label in zip(edges, labels):
        expr = expr.when(x <= edge if right_closed else x < edge, label)
    return expr.otherwise(labels[-1])


def banded(col, spec: Sequence[tuple[str, float | None]], null_label: str | None = None) -> Column:
    """Banding with a per-edge rule: ``spec`` is a list of (label, upper, inclusive)
    in ascending order; the last entry has upper None (everything above)."""
    x = _c(col)
    expr = F.when(x.isNull(), F.lit(null_label))
    for label, upper, inclusive in spec:
        if upper is None:
            return expr.otherwise(label)
        expr = expr.when(x <= upper if inclusive else x < upper, label)
    return expr


def decimal_text(col, digits: int) -> Column:
    """Number as text with a fixed number of decimals, rounded half up once
    (never prints a double directly); null when it has over 26 integer digits."""
    return F.round(_c(col).try_cast("decimal(38,12)"), digits).cast(f"decimal(38,{digits})").cast("string")


def dash_or(col, digits: int) -> Column:
    """Null -> '-', else fixed-decimal text."""
    return F.coalesce(decimal_text(col, digits), F.lit("-"))


def number_text(col) -> Column:
    """Limit values as the reference prints them: integral values without '.0'."""
    x = _c(col)
    return F.when(x == F.floor(x), x.cast("long").cast("string")).otherwise(x.cast("string"))


def title_case(col) -> Column:
    """'vehicle_count_per_min' -> 'Vehicle Count Per Min': underscores to
    spaces, first letter of each word upper-cased, the rest left as it is
    (unlike ``initcap``, which lower-cases it: 'sensorID' -> 'SensorID')."""
    words = F.split(F.replace(_c(col), F.lit("_"), F.lit(" ")), " ")
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)),
                                                              F.substring(w, 2, 1 << 30))), " ")
