"""Lenient loading of customer and subscription tables, raw text or typed silver.

Ids are taken as they are (no stripping), and no corrections are applied. A row that cannot
be used is left out with a finding; the first rule that fails names the reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenure.config import DEFAULTS, Settings
from tenure.functions import scalars as S
from tenure.operators import findings as Q
from tenure.operators.once import computed_once
from tenure.operators.ordered import first_per_key, positions
from tenure.operators.sequences import overlaps_adjacent
from tenure.operators.staging import staged
from tenure.plans.clean import Outcome, shown_text
from tenure.schemas import CUSTOMER_COLUMNS, PRICE, SUBSCRIPTION_COLUMNS, require_columns

STAGE_CUSTOMERS = "load_customers"
STAGE_SUBSCRIPTIONS = "load_subscriptions"
STAGE_OVERLAPS = "overlaps"


def number_lines(raw: DataFrame) -> DataFrame:
    """Add ``line_no`` as in a text file with a header line, in row id order."""
    return positions(raw, "row_id", "_position").withColumn("line_no", F.col("_position") + 2).drop("_position")


def _numbered(raw: DataFrame, lines: bool) -> DataFrame:
    return number_lines(raw) if lines and "line_no" not in raw.columns else raw


def _line(raw: DataFrame) -> Column:
    return F.col("line_no" if "line_no" in raw.columns else "row_id")


def _raw_text(df: DataFrame, name: str, settings: Settings) -> Column:
    """The text to show: the kept raw column if there is one."""
    return shown_text(f"{name}_raw" if f"{name}_raw" in df.columns else name, settings)


def _date(df: DataFrame, name: str, settings: Settings) -> Column:
    if df.schema[name].dataType == T.DateType():
        return S.in_range(F.col(name))
    return S.parse_date(F.col(name).cast("string"), settings.date_formats)


def _price(df: DataFrame, name: str) -> Column:
    if df.schema[name].dataType == PRICE:
        return F.col(name)
    text = F.col(name).cast("string")
    return F.coalesce(S.parse_price(text), F.when(S.price_out_of_range(text), S.stop_at_price(text)))


def _parse_customers(raw: DataFrame, settings: Settings) -> DataFrame:
    return computed_once(
        raw,
        costly={"signup_date": _date(raw, "signup_date", settings)},
        cheap={
            "row_id": F.col("row_id"),
            "customer_id": F.col("customer_id").cast("string"),
            "signup_date_raw": _raw_text(raw, "signup_date", settings),
            "country": F.coalesce(S.country_code("country"), F.lit("")),
            "line_no": _line(raw),
        },
    )


def load_customers(raw: DataFrame, settings: Settings = DEFAULTS, lines: bool = True) -> Outcome:
    """Valid customers: the first *valid* row of each id.

    Messages name text-file lines, counted for the warnings alone; row ids without ``lines``. Of
    the rule table only the severity of a missing country applies: ids and signup dates are what
    the metrics are made of.
    """
    require_columns(raw, CUSTOMER_COLUMNS, "customers")
    parsed = _parse_customers(raw, settings)
    valid = parsed.where("customer_id <> '' AND signup_date IS NOT NULL")
    rows = first_per_key(valid, "customer_id", "row_id")
    first_valid = valid.groupBy("customer_id").agg(F.min("row_id").alias("_first"))

    line, first = F.col("line_no"), F.col("_first")
    duplicate = F.coalesce(F.col("row_id") > first, F.lit(False))
    invalid = ~duplicate & (F.col("signup_date").isNull() | S.is_blank("customer_id"))
    reason = F.concat(F.lit("signup_date '"), F.coalesce("signup_date_raw", F.lit("")), F.lit("' is not a date"))
    kept = (F.col("row_id") == first) & (F.col("country") == "")
    rules = [
        Q.Rule("duplicate_customer_id", duplicate, Q.DROPPED, F.col("signup_date_raw"), Q.text("duplicate_customer_id", F.col("customer_id"), line)),
        Q.Rule("invalid_customer", invalid, Q.DROPPED, F.col("signup_date_raw"), Q.text("invalid_customer", line, reason)),
        Q.Rule("missing_country", kept, Q.MONITOR, F.lit(None), Q.text("missing_country", F.col("customer_id"))),
    ]
    rules = Q.with_severities(rules, _applied(settings, "missing_country"))
    if rules[-1].severity in (Q.FATAL, Q.DROPPED):
        rows = rows.where("country <> ''")
    return Outcome(
        rows.select("row_id", "customer_id", "signup_date", "country"),
        lambda: Q.findings(
            _parse_customers(_numbered(raw, lines), settings).join(
                staged(first_valid, "first_valid_rows"), "customer_id", "left"
            ),
            STAGE_CUSTOMERS,
            rules,
        ),
    )


def _applied(settings: Settings, *rules: str) -> list[tuple[str, str]]:
    """What the rule table says about these rules; the loader cannot raise, so fatal means dropped."""
    return [(r, Q.DROPPED if s == Q.FATAL else s) for r, s in settings.severities if r in rules]


def _parse_subscriptions(raw: DataFrame, settings: Settings) -> DataFrame:
    typed = raw.schema["start_date"].dataType == T.DateType()
    values = {
        "start_date": _date(raw, "start_date", settings),
        "end_date": _date(raw, "end_date", settings),
        "monthly_price": _price(raw, "monthly_price"),
    }
    shown = {
        "row_id": F.col("row_id"),
        "customer_id": F.col("customer_id").cast("string"),
        "start_date_raw": _raw_text(raw, "start_date", settings),
        "end_date_raw": _raw_text(raw, "end_date", settings),
        "plan": S.plan_name("plan"),
        "monthly_price_raw": _raw_text(raw, "monthly_price", settings),
        "line_no": _line(raw),
    }
    # Typed silver columns need no parsing, so filters on them may reach the scan.
    if typed:
        return raw.select(*[c.alias(n) for n, c in {**shown, **values}.items()])
    return computed_once(raw, costly=values, cheap=shown)


def load_subscriptions(
    raw: DataFrame, customers: DataFrame, settings: Settings = DEFAULTS, lines: bool = True
) -> Outcome:
    """Valid subscriptions of ``customers`` (unique customer_id), and a finding per problem.

    Pass ``customers`` as a stored table: Spark can then split the rows of a customer with
    very many subscriptions (see operators.staging). Messages name text-file lines, counted for
    the warnings alone; row ids without ``lines``. The rule table may keep unknown customers and
    negative prices (monitor) and drop malformed ends; a start, a price and an end that is not
    before the start are what the metrics are made of, so the rules about them always hold.
    """
    require_columns(raw, SUBSCRIPTION_COLUMNS, "subscriptions")
    parsed = _parse_subscriptions(raw, settings)
    ids = customers.select("customer_id")
    start, end, price = F.col("start_date"), F.col("end_date"), F.col("monthly_price")
    in_order = end.isNull() | (end >= start)
    given = dict(_applied(settings, "unknown_customer", "malformed_end_date", "negative_price"))
    priced = price.isNotNull() if given.get("negative_price") == Q.MONITOR else price >= 0
    malformed = F.col("end_date_raw").isNotNull() & end.isNull()
    rows = parsed.where(start.isNotNull() & priced & in_order)
    if given.get("malformed_end_date") == Q.DROPPED:
        rows = rows.where(~malformed)
    if given.get("unknown_customer") != Q.MONITOR:
        rows = rows.join(ids, "customer_id", "left_semi")

    line, customer = F.col("line_no"), F.col("customer_id")
    unknown = F.col("_known").isNull()
    owned = F.lit(True) if given.get("unknown_customer") == Q.MONITOR else ~unknown
    usable = owned & start.isNotNull()
    not_a_date = F.concat(F.lit("start_date '"), F.coalesce("start_date_raw", F.lit("")), F.lit("' is not a date"))
    rules = [
        Q.Rule("unknown_customer", unknown, Q.DROPPED, F.lit(None), Q.text("unknown_customer", customer, line)),
        Q.Rule("invalid_start_date", owned & start.isNull(), Q.DROPPED, F.col("start_date_raw"), Q.text("invalid_subscription", line, not_a_date)),
        Q.Rule("malformed_end_date", usable & malformed, Q.REPAIRED, F.col("end_date_raw"), Q.text("malformed_end_date", line), repair=(("end_date", end),)),
        Q.Rule("non_numeric_price", usable & price.isNull(), Q.DROPPED, F.col("monthly_price_raw"), Q.text("non_numeric_price", F.col("monthly_price_raw"), line)),
        Q.Rule("negative_price", usable & (price < 0), Q.DROPPED, F.col("monthly_price_raw"), Q.text("invalid_subscription", line, F.lit("monthly_price is negative"))),
        Q.Rule("end_before_start", usable & priced & (end < start), Q.DROPPED, F.concat_ws(" to ", start.cast("string"), end.cast("string")), Q.text("end_before_start", customer)),
    ]
    rules = Q.with_severities(rules, list(given.items()))

    def warnings() -> DataFrame:
        numbered = _parse_subscriptions(_numbered(raw, lines), settings)
        stated = numbered.join(ids.withColumn("_known", F.lit(True)), "customer_id", "left")
        return Q.findings(stated, STAGE_SUBSCRIPTIONS, rules)

    return Outcome(rows.select("row_id", "customer_id", "start_date", "end_date", "plan", "monthly_price"), warnings)


def overlap_warnings(subs: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """A finding per adjacent overlap of valid subscriptions."""
    rule = Q.Rule(
        "overlap",
        F.lit(True),
        Q.MONITOR,
        F.col("next_start"),
        Q.text(
            "overlap",
            F.col("customer_id"),
            F.col("start_date"),
            F.col("end_date"),
            F.col("next_start"),
            S.shown_end("next_end"),
        ),
    )
    return Q.findings(overlaps_adjacent(subs, settings), STAGE_OVERLAPS, [rule])
