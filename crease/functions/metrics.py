"""Metric and label expressions shared by batch and streaming jobs."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crease import schema as S


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def rate(num, den, factor: float, digits: int) -> Column:
    """``round(num / den * factor, digits)``; null when ``den`` is 0.

    Same operation order as the source jobs, Spark ``round`` (HALF_UP on the
    decimal form of the double).  ``try_divide`` keeps ANSI mode from raising.
    """
    return F.round(F.try_divide(_c(num), _c(den)) * F.lit(factor), digits)


def rate_or_zero(num, den, factor: float, digits: int) -> Column:
    """Like :func:`rate` but 0.0 for a zero divisor (warehouse / console tables)."""
    return F.coalesce(rate(num, den, factor, digits), F.lit(0.0))


def count_if(cond: Column) -> Column:
    """Conditional count as a BIGINT; partial-aggregates map-side."""
    return F.count(F.when(cond, F.lit(1)))


def batting_totals(runs: str, balls: str, fours: str, sixes: str) -> list[Column]:
    """Runs, balls with runs given, fours and sixes, under the given names."""
    scored = F.col("runs_off_bat")
    return [F.sum(scored).alias(runs), F.count(scored).alias(balls),
            count_if(scored == 4).alias(fours), count_if(scored == 6).alias(sixes)]


def is_present(col) -> Column:
    """Truthiness of a string: not null and not empty (blanks count as present)."""
    c = _c(col)
    return c.isNotNull() & (c != F.lit(""))


def phase(over, labels=S.PHASE_LONG, bounded: bool = False) -> Column:
    """Phase of a 0-based over; null when over is null (or outside 0..19 if bounded)."""
    o = _c(over)
    if bounded:
        return (F.when((o >= 0) & (o <= S.POWERPLAY_LAST_OVER), F.lit(labels[0]))
                .when((o > S.POWERPLAY_LAST_OVER) & (o <= S.MIDDLE_LAST_OVER), F.lit(labels[1]))
                .when((o > S.MIDDLE_LAST_OVER) & (o <= S.BOUNDED_LAST_OVER), F.lit(labels[2])))
    return (F.when(o <= S.POWERPLAY_LAST_OVER, F.lit(labels[0]))
            .when(o <= S.MIDDLE_LAST_OVER, F.lit(labels[1]))
            .when(o.isNotNull(), F.lit(labels[2])))


def phase_order(phase_col, labels=S.PHASE_LONG) -> Column:
    p = _c(phase_col)
    return (F.when(p == labels[0], F.lit(1)).when(p == labels[1], F.lit(2))
            .when(p == labels[2], F.lit(3)))


def over_ball(over, ball) -> Column:
    """``over.ball`` label, e.g. ``0.3``."""
    return F.concat_ws(".", _c(over).cast("string"), _c(ball).cast("string"))
