"""Small scalar helpers: limit clamp, role rank, premium gate, text formats."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from streamcharts.constants import EMAIL_PATTERN, MIN_PASSWORD_LENGTH, ROLE_RANK


def clamp_limit(limit, default: int, maximum: int) -> int:
    """``min(Number(limit) || default, maximum)``: 0, None, NaN or text -> default.

    Negative values are rejected instead of being passed to the top-k; a
    fraction below 1 becomes 1.
    """
    try:
        n = float(limit) if limit is not None else 0.0
    except (TypeError, ValueError):
        n = 0.0
    if math.isnan(n) or n == 0:
        n = default
    if n < 0:
        raise ValueError(f"limit must be positive, got {limit!r}")
    return int(max(1, math.floor(min(n, maximum))))  # +inf -> maximum; a fraction below 1 -> 1


def clamped_limit(limit: Column, default: int, maximum: int) -> Column:
    """``clamp_limit`` for a column of requested limits (text); a negative one, which a call refuses, is null."""
    asked = F.coalesce(F.nanvl(limit.try_cast("double"), F.lit(0.0)), F.lit(0.0))
    n = F.when(asked == 0, F.lit(float(default))).otherwise(asked)
    return F.when(n >= 0, F.greatest(F.lit(1), F.floor(F.least(n, F.lit(float(maximum)))).cast("int")))


def role_rank(role: Column) -> Column:
    expr = F.lit(None).cast("int")
    for name, rank in ROLE_RANK.items():
        expr = F.when(role == name, F.lit(rank)).otherwise(expr)
    return expr


def role_at_least(role: Column, required: str) -> Column:
    """True when ``role`` ranks at or above ``required``; unknown roles -> False."""
    return F.coalesce(role_rank(role) >= F.lit(ROLE_RANK[required]), F.lit(False))


def premium_allowed(premium_only: Column, role: Column) -> Column:
    """Deny only premium tracks for exactly the ``free`` role."""
    return ~(F.coalesce(premium_only, F.lit(False)) & F.coalesce(role == "free", F.lit(False)))


def valid_email(email: Column) -> Column:
    return F.coalesce(email.rlike(EMAIL_PATTERN), F.lit(False))


def valid_password(password: Column) -> Column:
    return F.coalesce(F.length(password) >= MIN_PASSWORD_LENGTH, F.lit(False))


def duration_text(seconds: Column) -> Column:
    """``m:ss`` as shown by the player."""
    s = seconds.cast("long")
    return F.concat(
        F.floor(s / 60).cast("string"), F.lit(":"), F.lpad((s % 60).cast("string"), 2, "0")
    )


def numbered(n: Column, width: int = 2) -> Column:
    """Filled up with zeros to ``width``; longer numbers stay whole (``lpad`` alone would cut them)."""
    text = n.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)
