"""Small column helpers shared by the plans."""

from __future__ import annotations

from collections.abc import Iterable
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwatch.config import DATA_LOSS, DEFAULT_RULE, REASONS, RiskRule
from millwatch.functions.rule import tier_case

# Time zero for slicing; earlier than any reading, so integer division is a floor.
ORIGIN = "TIMESTAMP_NTZ'0001-01-01 00:00:00'"

SEVERITY = {"LOW": 0, "MEDIUM": 1, "HIGH": 2, "CRITICAL": 3}


def seconds_between(start: str, end: str) -> Column:
    """Elapsed seconds with fractions; independent of the session time zone."""
    return F.expr(f"CAST(CAST(CAST({end} - {start} AS INTERVAL SECOND) AS DECIMAL(18,6)) AS DOUBLE)")


def time_slice(ts: str, seconds: int) -> Column:
    return F.expr(f"CAST(CAST({ts} - {ORIGIN} AS INTERVAL SECOND) AS BIGINT) DIV {seconds}L")


def hour_of(ts: str) -> Column:
    """Start of the hour, without a detour over the session time zone."""
    whole = f"CAST(CAST({ts} - {ORIGIN} AS INTERVAL SECOND) AS BIGINT) DIV 3600L"
    return F.expr(f"{ORIGIN} + make_dt_interval(0, CAST({whole} AS INT), 0, 0)")


def hours(n: float) -> Column:
    return F.expr(f"make_dt_interval(0, 0, 0, {n * 3600})")


def newest_time(rows: DataFrame, as_of=None) -> Column:
    """The moment "now" stands for: given, or else the newest reading (a scalar subquery)."""
    if as_of is None:
        return rows.select(F.max("reading_ts")).scalar()
    return as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("timestamp_ntz")


def clean_error(code: str = "error_code") -> Column:
    return F.expr(f"nullif(trim({code}), '')")


def derived_tier(score: str = "risk_score", rule: RiskRule = DEFAULT_RULE) -> Column:
    """Tier read back from the stored decimal; it knows no DATA_LOSS."""
    return F.expr(tier_case(score, rule, literal=lambda cut: f"{cut:.4f}BD"))


def tier_ranges(
    tiers: Iterable[str], score: str = "risk_score", rule: RiskRule = DEFAULT_RULE
) -> Column:
    """``derived_tier IN tiers`` as score ranges, which reach Parquet statistics."""
    wanted = set(clean_choices(tiers))
    stored = F.col(score)
    upper: Decimal | None = None
    condition = F.lit(False)
    for tier, cut in (*rule.thresholds(), ("LOW", None)):
        lower = None if cut is None else Decimal(f"{cut:.4f}")
        if tier in wanted:
            piece = stored.isNotNull() if lower is None else stored >= F.lit(lower)
            if upper is not None:
                piece = piece & (stored < F.lit(upper))
            condition = condition | piece
        upper = lower
    return condition


def clean_choices(values: Iterable[str]) -> list[str]:
    return [v for v in (str(x).strip().upper() for x in values) if v]


def in_choices(column: str, values: Iterable[str]) -> Column:
    """Case- and blank-insensitive membership; an empty choice selects nothing."""
    wanted = clean_choices(values)
    return F.upper(F.trim(column)).isin(wanted) if wanted else F.lit(False)


def reason(signal: str = "top_signal", tier: str = "risk_tier") -> Column:
    """Plain-language reason. Lost data is read from the tier: no signal names it."""
    known = " ".join(f"WHEN '{name}' THEN '{words}'" for name, words in REASONS.items())
    return F.expr(
        f"CASE WHEN {tier} = '{DATA_LOSS}' THEN '{REASONS[DATA_LOSS]}' "
        f"ELSE CASE {signal} {known} ELSE {signal} END END"
    )


def severity(tier: str) -> Column:
    levels = " ".join(f"WHEN '{name}' THEN {rank}" for name, rank in SEVERITY.items())
    return F.expr(f"CASE {tier} {levels} END")


def reading_key() -> Column:
    """A stable surrogate for the natural key; it never depends on storage order."""
    return F.xxhash64("machine_id", "reading_ts")


def minute_text(ts: str) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm")


def scaled(column: str, places: int) -> Column:
    """An exact integer for a decimal with ``places`` digits, so that sums stay exact."""
    return F.expr(f"CAST({column} * {10 ** places} AS BIGINT)")


def mean_of(total: Column, count: Column, places: int) -> Column:
    """Mean of scaled integers; NULL when nothing was counted."""
    return F.try_divide(total.cast("double"), count.cast("double") * F.lit(float(10**places)))


def mean_score(score: str = "risk_score") -> Column:
    """Mean of stored scores, rounded half up to four places in integer arithmetic."""
    total, count = f"sum(CAST({score} * 10000 AS BIGINT))", f"count({score})"
    return F.expr(
        f"CAST((2 * {total} + {count}) DIV nullif(2 * {count}, 0) AS DECIMAL(9,0)) * 0.0001BD"
    )


def upper_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])
