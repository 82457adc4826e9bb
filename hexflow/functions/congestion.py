"""Congestion index and traffic status (Column expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Status thresholds (strict ">") and labels.
GRIDLOCK_ABOVE = 0.8
HEAVY_ABOVE = 0.4
GRIDLOCK, HEAVY, CLEAR = "GRIDLOCK", "HEAVY", "CLEAR"

# The status is decided on the average rounded to this many decimals, so that
# the label does not depend on floating-point summation order (which differs
# between partitions, plans and engines): an average that is exactly 0.8 in
# rational terms stays HEAVY however its sum was associated.
STATUS_DECIMALS = 9


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def congestion_index(current="currentSpeed", free_flow="freeFlowSpeed") -> Column:
    """``1 - current/free_flow``, negative values capped to 0; NULL when
    free flow is 0 or either speed is NULL (ignored by ``avg``)."""
    raw = F.lit(1.0) - F.try_divide(_c(current), _c(free_flow))
    return F.when(raw < 0, F.lit(0.0)).otherwise(raw)


def stable_round(c, decimals: int) -> Column:
    """Round to ``decimals`` after first rounding at ``STATUS_DECIMALS``, so the
    last kept digit does not depend on float summation order."""
    return F.round(F.round(_c(c), STATUS_DECIMALS), decimals)


def traffic_status(avg_ci="avg_congestion_index", heavy: float = HEAVY_ABOVE,
                   gridlock: float = GRIDLOCK_ABOVE) -> Column:
    """GRIDLOCK above ``gridlock``, HEAVY above ``heavy``, else CLEAR (NULL is CLEAR)."""
    v = F.round(_c(avg_ci), STATUS_DECIMALS)
    return (F.when(v > F.lit(float(gridlock)), F.lit(GRIDLOCK))
            .when(v > F.lit(float(heavy)), F.lit(HEAVY))
            .otherwise(F.lit(CLEAR)))
