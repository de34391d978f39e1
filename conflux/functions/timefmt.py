"""Time functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The timestamp text formats used in archive and stage names.
DAY_STAMP = "yyyy_MM_dd"                 # %Y_%m_%d
FILE_STAMP = "yyyyMMdd_HHmmss"           # %Y%m%d_%H%M%S
STAGE_STAMP = "yyyy_MM_dd_HH_mm_ss"      # %Y_%m_%d_%H_%M_%S

# Log order base per ETL phase.
PHASE_BASE = {"E": 120, "T": 220, "L": 320}

TERMINAL_STATUSES = ("failed", "succeeded")


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def day_stamp(ts: Column | str) -> Column:
    return F.date_format(_c(ts), DAY_STAMP)


def file_stamp(ts: Column | str) -> Column:
    return F.date_format(_c(ts), FILE_STAMP)


def stage_stamp(ts: Column | str) -> Column:
    return F.date_format(_c(ts), STAGE_STAMP)


def minus_days(ts: Column | str, days: int = 1) -> Column:
    """``ts - days``."""
    return _c(ts) - F.make_dt_interval(F.lit(days))


def end_date_on_terminal(status: Column | str, now: Column | str, previous: Column | str) -> Column:
    """The end date is set only when the status is terminal."""
    return F.when(_c(status).isin(*TERMINAL_STATUSES), _c(now)).otherwise(_c(previous))


def to_smalldatetime(ts: Column | str) -> Column:
    """``smalldatetime`` keeps minutes: up to 29.998 s rounds down,
    29.999 s and above rounds up."""
    return F.date_trunc("MINUTE", _c(ts) + F.expr("INTERVAL '30.001' SECOND")).cast("timestamp_ntz")


def log_order(step: Column | str, seq: Column | str) -> Column:
    """Log order number = phase base (E 120, T 220, L 320) + task
    offset; other steps keep the offset."""
    s, q = F.upper(_c(step)), _c(seq)
    base = F.when(s == "E", PHASE_BASE["E"]).when(s == "T", PHASE_BASE["T"]).when(
        s == "L", PHASE_BASE["L"]).otherwise(0)
    return base + q


def synthetic_digits(seed_col: Column | str, seed: int, digits: int = 5) -> Column:
    """Reproducible pseudo-random number of at most ``digits`` digits."""
    return F.pmod(F.xxhash64(_c(seed_col), F.lit(seed)), F.lit(10 ** digits))


def synthetic_id(seed_col: Column | str, seed: int) -> Column:
    """Reproducible uuid-shaped text (``uuid()`` is not replayable)."""
    h = F.sha2(F.concat_ws(":", F.lit(str(seed)), _c(seed_col).cast("string")), 256)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))
