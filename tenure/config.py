"""All tunable values in one frozen object."""

from __future__ import annotations

from dataclasses import dataclass

# They decide results and must not change silently.
DATE_FORMATS = ("yyyy-MM-dd",)
PLAN_CORRECTIONS = (("baisc", "basic"),)
PRICE_CORRECTIONS = (("thirty", "30"),)
# Days outside this range are malformed: the days that nanosecond time stamps can hold.
FIRST_DAY, LAST_DAY = "1677-09-22", "2262-04-11"
GRACE_DAYS = 30
RETENTION_MONTHS = 3
IQR_FACTOR = 1.5
IQR_MIN_ROWS = 4
EXAMPLES_PER_RULE = 5
UNKNOWN_EXAMPLES = 10
WARNINGS_SHOWN = 10
TINY_COHORT = 5

STRICT = "strict"
LENIENT = "lenient"
FLAG = "flag"


@dataclass(frozen=True)
class Settings:
    """Formats, corrections and thresholds.

    ``hot_rows`` is the group size from which one customer's history is split over
    several tasks (see ``operators.ordered``). ``severities`` is the rule table: (rule_id,
    severity) pairs that decide what becomes of the rows a rule hits (see
    ``operators.dispositions``).
    """

    date_formats: tuple[str, ...] = DATE_FORMATS
    plan_corrections: tuple[tuple[str, str], ...] = PLAN_CORRECTIONS
    price_corrections: tuple[tuple[str, str], ...] = PRICE_CORRECTIONS
    na_values: tuple[str, ...] = ("",)
    grace_days: int = GRACE_DAYS
    retention_months: int = RETENTION_MONTHS
    iqr_factor: float = IQR_FACTOR
    iqr_min_rows: int = IQR_MIN_ROWS
    examples: int = EXAMPLES_PER_RULE
    unknown_examples: int = UNKNOWN_EXAMPLES
    warnings_shown: int = WARNINGS_SHOWN
    tiny_cohort: int = TINY_COHORT
    hot_rows: int = 1 << 20
    severities: tuple[tuple[str, str], ...] = ()

    def severity(self, rule_id: str, default: str) -> str:
        return dict(self.severities).get(rule_id, default)


DEFAULTS = Settings()
