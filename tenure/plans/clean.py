"""Bronze to silver.

Three policies for rows that break a fatal rule:

* ``strict``  - count every rule in one job and raise with all of them.
* ``lenient`` - drop (or repair) the rows, each with a finding.
* ``flag``    - keep the rows for the loader, each with a finding.

The rule catalogue is one table: its severities, which the settings may change, decide by
themselves what silver, quarantine, counts and findings hold (see operators.dispositions).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenure.config import DEFAULTS, FLAG, LENIENT, STRICT, Settings
from tenure.errors import DataQualityError
from tenure.functions import scalars as S
from tenure.operators import dispositions as D
from tenure.operators import findings as Q
from tenure.operators.observed import nulls, staged_with
from tenure.operators.once import computed_once, made
from tenure.operators.ordered import first_per_key
from tenure.operators.quantiles import exact_quantiles, value_counts
from tenure.operators.sequences import overlaps_running_max
from tenure.operators.staging import staged
from tenure.schemas import SUBSCRIPTION_COLUMNS, require_columns

OUT_OF_RANGE = "price_out_of_range"
EMPTY_ID, DUPLICATE_ID = "empty_customer_id", "duplicate_customer_id"
# Corrections that the rule table may forbid: corrected without a finding unless it says otherwise.
PLAN_TYPO, PRICE_WORD = "plan_typo", "price_word"
STAGE_CUSTOMERS = "clean_customers"
STAGE_SUBSCRIPTIONS = "clean_subscriptions"


class Outcome:
    """Cleaned rows; the findings are planned only when somebody asks for them."""

    def __init__(
        self,
        rows: DataFrame,
        warnings: Callable[[], DataFrame],
        removed: DataFrame | None = None,
        stated: DataFrame | None = None,
        counts: dict[str, int] | None = None,
    ):
        self.rows = rows
        self.removed = removed
        #: Subscriptions with the state of their customer, before any is left out.
        self.stated = stated
        #: Hits of every row rule, nulls (``nulls_<column>``) and ``rows``, counted while ``stated`` was written.
        self.counts = counts
        self._plan_warnings = warnings

    @cached_property
    def warnings(self) -> DataFrame:
        return self._plan_warnings()


def cleaned_text(name: str, settings: Settings) -> Column:
    """The stripped text, null for the configured missing-value words."""
    c = S.strip(F.col(name).cast("string"))
    words = [w for w in settings.na_values if w != ""]
    return F.when(c.isin(*words), None).otherwise(c) if words else c


def shown_text(name: str, settings: Settings) -> Column:
    """The same for showing: an empty text is null as well."""
    return S.blank_to_null(cleaned_text(name, settings))


def _check_policy(policy: str) -> None:
    if policy not in (STRICT, LENIENT, FLAG):
        raise ValueError(f"policy must be one of {STRICT}, {LENIENT}, {FLAG}: {policy!r}")


def _gate(table: str, hits: dict[str, int], warnings: DataFrame, settings: Settings) -> None:
    """Raise with every fatal rule that was hit; example rows are fetched only then."""
    hits = {rule: n for rule, n in hits.items() if n}
    shown = Q.examples(warnings.where(F.col("rule_id").isin(*hits)), settings.examples, settings.unknown_examples)
    by_rule: dict[str, list[str]] = {}
    for row in shown.orderBy("rule_id", "rank").collect():  # a few per rule
        by_rule.setdefault(row["rule_id"], []).append(f"{row['customer_id']}: {row['detail']}")
    lines = [
        f"{rule}: {n} rows, for example {by_rule.get(rule, [])}" for rule, n in hits.items()
    ]
    raise DataQualityError(f"Fatal findings in table {table}:\n" + "\n".join(lines))


# --- customers -----------------------------------------------------------------------


def standardise_customers(bronze: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Strip, upper-case the country, parse the signup date; keeps one output row per input row."""
    require_columns(bronze, ("customer_id", "signup_date"), "customers")
    has_country = "country" in bronze.columns
    return computed_once(
        bronze,
        costly={
            "customer_id": shown_text("customer_id", settings),
            "signup_date": _parsed_date("signup_date", settings),
        },
        cheap={
            "row_id": F.col("row_id"),
            "signup_date_raw": shown_text("signup_date", settings),
            "country": S.country_code("country") if has_country else F.lit(None).cast("string"),
        },
    )


def customer_rules(settings: Settings = DEFAULTS, has_country: bool = True) -> list[Q.Rule]:
    """Rules on the first row of each customer."""
    raw, parsed = F.col("signup_date_raw"), F.col("signup_date")
    rules = [
        Q.Rule(EMPTY_ID, S.is_blank("customer_id"), Q.FATAL, F.lit(None), F.lit("customer_id is empty")),
        Q.Rule(
            "empty_signup_date",
            raw.isNull(),
            Q.DROPPED,
            raw,
            F.lit("signup_date is empty - customer removed"),
        ),
        Q.Rule(
            "malformed_signup_date",
            raw.isNotNull() & parsed.isNull(),
            Q.DROPPED,
            raw,
            F.format_string("signup_date '%s' is not a date - customer removed", raw),
        ),
    ]
    if has_country:
        rules.append(
            Q.Rule(
                "missing_country",
                parsed.isNotNull() & F.col("country").isNull(),
                Q.MONITOR,
                F.lit(None),
                Q.text("missing_country", F.col("customer_id")),
            )
        )
    return Q.with_severities(rules, settings.severities)


def duplicate_customers(standard: DataFrame) -> DataFrame:
    """Every row of an id after its first one; one id may own most of the rows."""
    firsts = staged(
        standard.where(~S.is_blank("customer_id"))
        .groupBy("customer_id")
        .agg(F.min("row_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
        .select("customer_id", "_first"),
        "first_rows",
    )
    return standard.join(firsts, "customer_id").where(F.col("row_id") > F.col("_first")).drop("_first")


def clean_customers(
    bronze: DataFrame, policy: str = LENIENT, settings: Settings = DEFAULTS, extra: Sequence[Q.Rule] = ()
) -> Outcome:
    """Silver customers, the removed ids, and the findings. The first row of an id wins.

    ``extra`` rules see the standardised first row of each id. Ids must be there and unique, so
    the two rules about that cannot be turned into mere findings.
    """
    _check_policy(policy)
    for rule in (EMPTY_ID, DUPLICATE_ID):
        if settings.severity(rule, Q.DROPPED) not in (Q.FATAL, Q.DROPPED):
            raise ValueError(f"rule {rule} of the customer table must stay fatal or dropped")
    standard = standardise_customers(bronze, settings)
    first = first_per_key(standard, "customer_id", "row_id")
    rules = [*customer_rules(settings, "country" in bronze.columns), *Q.with_severities(extra, settings.severities)]

    def warnings() -> DataFrame:
        repeated = Q.Rule(
            DUPLICATE_ID,
            F.lit(True),
            settings.severity(DUPLICATE_ID, Q.DROPPED),
            F.col("signup_date_raw"),
            F.format_string("customer_id '%s' occurs again - first row kept", F.col("customer_id")),
        )
        # Rows without an id are no copies of each other: each one is reported.
        named = first.where(~S.is_blank("customer_id")).unionByName(standard.where(S.is_blank("customer_id")))
        return Q.union_all(
            [
                Q.findings(named, STAGE_CUSTOMERS, rules),
                Q.findings(duplicate_customers(standard), STAGE_CUSTOMERS, [repeated]),
            ]
        )

    named = first.where(~S.is_blank("customer_id"))
    if policy == STRICT:
        fatal = [r for r in rules if r.severity == Q.FATAL and r.rule_id != EMPTY_ID]
        hits = named.agg(*Q.counters(fatal)).first().asDict() if fatal else {}
        if settings.severity(EMPTY_ID, Q.FATAL) == Q.FATAL:
            hits[EMPTY_ID] = standard.agg(F.count_if(S.is_blank("customer_id")).alias("n")).first()["n"]
        if settings.severity(DUPLICATE_ID, Q.DROPPED) == Q.FATAL:
            hits[DUPLICATE_ID] = duplicate_customers(standard).count()
        if any(hits.values()):
            _gate("customers", hits, warnings(), settings)
    gone = D.dropping_rule(rules, policy)
    return Outcome(
        rows=D.disposed(named, rules, policy).select("row_id", "customer_id", "signup_date", "country"),
        removed=named.where(gone.isNotNull()).select("customer_id", "signup_date_raw"),
        warnings=warnings,
    )


def customer_reference(
    customers: DataFrame, excluded: DataFrame | None = None, settings: Settings = DEFAULTS
) -> DataFrame:
    """(customer_id, signup_date or null) of a raw or silver customer table, first row per non-empty id."""
    typed = dict(customers.dtypes).get("signup_date") == "date"
    signup = (
        F.col("signup_date") if typed else S.parse_date("signup_date", settings.date_formats)
    )
    ids = customers.select("row_id", S.strip(F.col("customer_id").cast("string")).alias("customer_id"), signup.alias("signup_date"))
    named = ids.where(~S.is_blank("customer_id"))
    reference = first_per_key(named, "customer_id", "row_id").select("customer_id", "signup_date")
    if excluded is not None:
        reference = reference.join(excluded.select("customer_id"), "customer_id", "left_anti")
    return reference


def customer_rule_counts(bronze: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """(rule_id, severity, hits) of the customer rules."""
    standard = standardise_customers(bronze, settings)
    rules = customer_rules(settings, "country" in bronze.columns)
    first = first_per_key(standard, "customer_id", "row_id")
    counted = first.where(~S.is_blank("customer_id")).agg(*Q.counters(rules[1:]))
    # Empty ids are counted on all rows: keeping the first row per id would leave one of them.
    per_id = standard.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
    blank, n = S.is_blank("customer_id"), F.col("n")
    ids = per_id.agg(
        F.coalesce(F.sum(F.when(blank, n)), F.lit(0)).alias("empty_customer_id"),
        F.coalesce(F.sum(F.when(~blank, n - 1)), F.lit(0)).alias("duplicate_customer_id"),
    )
    duplicate = Q.Rule("duplicate_customer_id", F.lit(True), Q.DROPPED, F.lit(None), F.lit(None))
    return Q.as_rows(ids, [rules[0], duplicate]).unionByName(Q.as_rows(counted, rules[1:]))


# --- subscriptions -------------------------------------------------------------------


def standardise_subscriptions(bronze: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Strip, correct and parse every field; keeps one output row per input row."""
    require_columns(bronze, SUBSCRIPTION_COLUMNS, "subscriptions")

    raw_price, end_raw = F.col("monthly_price").cast("string"), shown_text("end_date", settings)
    plans = settings.plan_corrections if _corrects(PLAN_TYPO, settings) else ()
    prices = settings.price_corrections if _corrects(PRICE_WORD, settings) else ()
    # What was there before, only where the rule table asks about it.
    before = {}
    if settings.severity(PLAN_TYPO, Q.SILENT) != Q.SILENT:
        before["plan_before"] = cleaned_text("plan", settings)
    if settings.severity(PRICE_WORD, Q.SILENT) != Q.SILENT:
        before["price_before"] = shown_text("monthly_price", settings)
    return computed_once(
        bronze,
        costly={
            "customer_id": shown_text("customer_id", settings),
            "start_date": _parsed_date("start_date", settings),
            "end_date": _parsed_date("end_date", settings),
            "monthly_price": S.parse_price(raw_price, prices),
        },
        cheap={
            "row_id": F.col("row_id"),
            "start_date_raw": shown_text("start_date", settings),
            "end_date_raw": end_raw,
            "end_date_malformed": end_raw.isNotNull() & made("end_date").isNull(),
            "plan": S.correct(cleaned_text("plan", settings), plans),
            "monthly_price_raw": S.correct(shown_text("monthly_price", settings), prices),
            "price_out_of_range": made("monthly_price").isNull() & S.price_out_of_range(raw_price, prices),
            **before,
        },
    )


def _corrects(rule: str, settings: Settings) -> bool:
    return settings.severity(rule, Q.SILENT) != Q.MONITOR


def _parsed_date(name: str, settings: Settings) -> Column:
    return S.parse_date(F.col(name).cast("string"), settings.date_formats)


def with_customer_state(
    subs: DataFrame,
    reference: DataFrame | None,
    excluded: DataFrame | None,
    stage: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """Add ``customer_state`` (known / unknown / excluded) and ``signup_date`` with one join.

    The lookup side has one row per customer. ``stage`` stores it first, so that Spark can
    split the rows of a customer with very many subscriptions (see operators.staging).
    """
    known = F.lit("known")
    if reference is None and excluded is None:
        return subs.withColumns({"customer_state": known, "signup_date": F.lit(None).cast("date")})
    sides = []
    if reference is not None:
        sides.append(reference.select("customer_id", "signup_date", F.lit(False).alias("_out")))
    if excluded is not None:
        sides.append(
            excluded.select("customer_id", F.lit(None).cast("date").alias("signup_date"), F.lit(True).alias("_out"))
        )
    lookup = sides[0]
    if len(sides) == 2:
        lookup = (
            sides[0].unionByName(sides[1])
            .groupBy("customer_id")
            .agg(F.max("signup_date").alias("signup_date"), F.bool_or("_out").alias("_out"))
        )
    if stage is not None:
        lookup = stage(lookup, "customer_lookup")
    absent = known if reference is None else F.lit("unknown")
    state = F.when(F.col("_out"), F.lit("excluded")).when(~F.col("_out"), known).otherwise(absent)
    return subs.join(lookup, "customer_id", "left").withColumn("customer_state", state).drop("_out")


def subscription_rules(
    null_end: bool = False, lenient: bool = False, settings: Settings = DEFAULTS, extra: Sequence[Q.Rule] = ()
) -> list[Q.Rule]:
    """The rule catalogue over standardised rows with a customer state, in checking order.

    A price too large to compute with is fatal under every policy: dropping it would falsify
    the sums. ``extra`` rules come last. Rows of excluded and unknown customers are checked
    further only if the settings keep them.
    """
    state = F.col("customer_state")
    known = state == "known"
    for kept, rule in (("excluded", "excluded_customer"), ("unknown", "unknown_customer")):
        if settings.severity(rule, Q.DROPPED) == Q.MONITOR:
            known = known | (state == kept)
    customer, start, end = F.col("customer_id"), F.col("start_date"), F.col("end_date")
    start_raw, end_raw, price_raw = F.col("start_date_raw"), F.col("end_date_raw"), F.col("monthly_price_raw")
    fatal = Q.DROPPED if lenient else Q.FATAL
    rules = [
        Q.Rule("excluded_customer", state == "excluded", Q.DROPPED, F.lit(None), F.lit("customer was removed")),
        Q.Rule(
            "empty_customer_id",
            S.is_blank(customer) & (state != "excluded"),
            fatal,
            F.lit(None),
            F.lit("customer_id is empty"),
        ),
        Q.Rule(
            "unknown_customer",
            (state == "unknown") & ~S.is_blank(customer),
            Q.DROPPED,
            F.lit(None),
            F.format_string("customer_id '%s' is not a known customer", customer),
            handed_on=True,
        ),
        Q.Rule("empty_start_date", known & start_raw.isNull(), fatal, start_raw, F.lit("start_date is empty"), handed_on=True),
        Q.Rule(
            "malformed_start_date",
            known & start_raw.isNotNull() & start.isNull(),
            fatal,
            start_raw,
            F.format_string("start_date '%s' is not a date", start_raw),
            handed_on=True,
        ),
        Q.Rule(
            "malformed_end_date",
            known & F.col("end_date_malformed"),
            Q.REPAIRED,
            end_raw,
            F.format_string("end_date '%s' is not a date - treated as open", end_raw),
            repair=(("end_date", F.lit(None).cast("date")),),
        ),
        Q.Rule(
            "non_numeric_price",
            known & F.col("monthly_price").isNull() & ~F.col("price_out_of_range"),
            fatal,
            price_raw,
            F.format_string("monthly_price '%s' is not a number", F.coalesce(price_raw, F.lit(""))),
            handed_on=True,
        ),
        Q.Rule(
            OUT_OF_RANGE,
            known & F.col("price_out_of_range"),
            Q.FATAL,
            price_raw,
            F.format_string("monthly_price '%s' is too large", price_raw),
            stop=(("monthly_price", S.stop_at_price("monthly_price_raw")),),
        ),
        Q.Rule(
            "end_before_start",
            known & (end < start),
            Q.REPAIRED if null_end else fatal,
            F.concat_ws(" to ", start.cast("string"), end.cast("string")),
            F.lit("end_date before start_date"),
            repair=(("end_date", F.lit(None).cast("date")),),
            handed_on=True,
        ),
        Q.Rule(
            "start_before_signup",
            known & (start < F.col("signup_date")),
            Q.MONITOR if lenient else Q.FATAL,
            F.concat_ws(" before ", start.cast("string"), F.col("signup_date").cast("string")),
            F.lit("start_date before customer signup_date"),
        ),
    ]
    for rule, column, corrections in (
        (PLAN_TYPO, "plan", settings.plan_corrections),
        (PRICE_WORD, "price", settings.price_corrections),
    ):
        if settings.severity(rule, Q.SILENT) != Q.SILENT:
            wrong = F.col(f"{column}_before")
            shown = F.format_string("'%s' is a known mistake", wrong)
            # Parsing has put the corrected value in place.
            there = (("plan", F.col("plan")),) if rule == PLAN_TYPO else (("monthly_price", F.col("monthly_price")),)
            rules.append(Q.Rule(rule, known & wrong.isin([w for w, _ in corrections]), Q.REPAIRED, wrong, shown, repair=there))
    return Q.with_severities([*rules, *extra], settings.severities)


def subscription_rule_counts(subject: DataFrame, settings: Settings = DEFAULTS, extra: Sequence[Q.Rule] = ()) -> DataFrame:
    """(rule_id, severity, hits), all rules in one aggregate over stated rows."""
    rules = subscription_rules(settings=settings, extra=extra)
    return Q.as_rows(subject.agg(*Q.counters(rules)), rules)


def price_outliers(subs: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Rows outside Q1 - f*IQR .. Q3 + f*IQR; none for too few prices or an IQR of zero."""
    quartiles = exact_quantiles(value_counts(subs, [], F.col("monthly_price")), [], (0.25, 0.75))
    iqr = F.col("q_1") - F.col("q_0")
    usable = (F.col("size") >= settings.iqr_min_rows) & (iqr > 0)
    found = F.struct(
        (F.col("q_0") - settings.iqr_factor * iqr).alias("lower"), (F.col("q_1") + settings.iqr_factor * iqr).alias("upper")
    )
    # One row, written: the plan above it refers to it several times.
    bounds = staged(quartiles.agg(F.max(F.when(usable, found)).alias("b")), "price_bounds").scalar()
    price = F.col("monthly_price").cast("double")
    return (
        subs.where((price < bounds["lower"]) | (price > bounds["upper"]))
        .select("row_id", "customer_id", "plan", "monthly_price")
        .withColumns({"lower_bound": F.round(bounds["lower"], 6), "upper_bound": F.round(bounds["upper"], 6)})
    )


def plan_price_spread(subs: DataFrame) -> DataFrame:
    """Plans with at least two priced rows and more than one distinct price."""
    counts = value_counts(subs.where("plan IS NOT NULL"), ["plan"], F.col("monthly_price"))
    return (
        counts.groupBy("plan")
        .agg(
            F.sum("n").alias("rows"),
            F.count(F.lit(1)).alias("distinct_prices"),
            F.min("value").cast("double").alias("min_price"),
            F.max("value").cast("double").alias("max_price"),
        )
        .where("rows >= 2 AND distinct_prices > 1")
    )


def _overlap_findings(known: DataFrame, severity: str, settings: Settings) -> DataFrame:
    overlaps = overlaps_running_max(known.where("start_date IS NOT NULL"), settings)
    shown = Q.text(
        "overlap",
        F.col("customer_id"),
        F.col("previous_start"),
        S.shown_end("previous_end"),
        F.col("current_start"),
        S.shown_end("current_end"),
    )
    rule = Q.Rule("overlap", F.lit(True), severity, F.col("current_start"), shown)
    return Q.findings(overlaps, STAGE_SUBSCRIPTIONS, [rule])


def _whole_table(settings: Settings, rule: str, default: str) -> str:
    """Severity of a rule that looks at several rows, so it cannot decide what becomes of one."""
    severity = settings.severity(rule, default)
    allowed = (Q.FATAL, Q.MONITOR, Q.SILENT) if rule == "overlap" else (Q.MONITOR, Q.SILENT)
    if severity not in allowed:
        raise ValueError(f"rule {rule} looks at several rows and can only be {' or '.join(allowed)}")
    return severity


def _diagnostics(known: DataFrame, overlap_severity: str, settings: Settings) -> list[DataFrame]:
    spread = plan_price_spread(known).select(
        F.lit(None).cast("long").alias("row_id"), F.lit(None).cast("string").alias("customer_id"), "*"
    )
    return [
        _overlap_findings(known, overlap_severity, settings),
        Q.findings(
            price_outliers(known, settings),
            STAGE_SUBSCRIPTIONS,
            [
                Q.Rule(
                    "price_outlier",
                    F.lit(True),
                    _whole_table(settings, "price_outlier", Q.MONITOR),
                    # Plain digits at any size, without the zeros of the scale.
                    F.regexp_replace(F.col("monthly_price").cast("string"), "([.][0-9]+?)0+$", "$1"),
                    F.format_string(
                        "monthly_price of plan '%s' outside [%.2f, %.2f]",
                        F.coalesce("plan", F.lit("")),
                        F.col("lower_bound"),
                        F.col("upper_bound"),
                    ),
                )
            ],
        ),
        Q.findings(
            spread,
            STAGE_SUBSCRIPTIONS,
            [
                Q.Rule(
                    "plan_price_spread",
                    F.lit(True),
                    _whole_table(settings, "plan_price_spread", Q.MONITOR),
                    F.col("plan"),
                    F.format_string(
                        "plan '%s' has %d distinct prices (%.2f to %.2f)",
                        F.col("plan"),
                        F.col("distinct_prices"),
                        F.col("min_price"),
                        F.col("max_price"),
                    ),
                )
            ],
        ),
    ]


def repair_date_ranges(subs: DataFrame) -> DataFrame:
    """Open the end of every row that ends before it starts, and say so in ``repaired``."""
    wrong = F.coalesce(F.col("end_date") < F.col("start_date"), F.lit(False))
    return subs.withColumns({"end_date": F.when(~wrong, F.col("end_date")), "repaired": wrong})


#: Columns whose nulls are counted.
PROFILED = ("customer_id", "start_date", "end_date", "plan", "monthly_price")

SILVER_COLUMNS = (
    "row_id",
    "customer_id",
    "start_date",
    "end_date",
    "end_date_raw",
    "end_date_malformed",
    "plan",
    "monthly_price",
)


def clean_subscriptions(
    bronze: DataFrame,
    reference: DataFrame | None = None,
    excluded: DataFrame | None = None,
    policy: str = STRICT,
    overlap_policy: str = "warn",
    range_policy: str = "drop",
    settings: Settings = DEFAULTS,
    stage: Callable[[DataFrame, str], DataFrame] | None = None,
    extra: Sequence[Q.Rule] = (),
) -> Outcome:
    """Silver subscriptions and findings.

    ``reference`` is (customer_id, signup_date), unique; without it no row is unknown.
    ``excluded`` is (customer_id), unique. ``overlap_policy`` "strict" makes overlaps fatal
    under the strict policy. ``range_policy`` "null_end" opens an end before its start
    instead of treating the row as broken. ``stage`` (see operators.staging) stores the
    rows with their customer state once for the rows, the gate and all findings, which
    otherwise plan the same join each for themselves. ``extra`` rules (see operators.findings)
    see the stated rows; they are counted, gated, reported and acted upon like the others.
    """
    _check_policy(policy)
    if overlap_policy not in ("warn", "strict"):
        raise ValueError(f"unknown overlap_policy {overlap_policy!r}: warn or strict")
    if range_policy not in ("drop", "null_end"):
        raise ValueError("range_policy must be 'drop' or 'null_end'")
    null_end = range_policy == "null_end"

    stated = with_customer_state(standardise_subscriptions(bronze, settings), reference, excluded, stage)
    rules = subscription_rules(null_end, lenient=policy != STRICT, settings=settings, extra=extra)
    counts = None
    if stage is not None:
        stated, counts = staged_with(stage, stated, "stated_subscriptions", [*Q.counters(rules), *nulls(PROFILED)])
    known = stated.where((F.col("customer_state") == "known") & ~S.is_blank("customer_id"))
    overlap_severity = _whole_table(settings, "overlap", Q.FATAL if overlap_policy == "strict" else Q.MONITOR)
    overlaps_fatal = overlap_severity == Q.FATAL

    def warnings() -> DataFrame:
        diagnostics = _diagnostics(known, overlap_severity, settings)
        return Q.union_all([Q.findings(stated, STAGE_SUBSCRIPTIONS, rules), *diagnostics])

    if policy == STRICT:
        fatal = [r for r in rules if r.severity == Q.FATAL]
        if counts is not None:
            hits = {r.rule_id: counts[r.rule_id] for r in fatal}
        else:
            hits = stated.agg(*Q.counters(fatal)).first().asDict() if fatal else {}
        shown = [Q.findings(stated, STAGE_SUBSCRIPTIONS, fatal)]
        if overlaps_fatal:
            shown.append(_overlap_findings(known, overlap_severity, settings))
            hits["overlap"] = shown[-1].count()
        if any(hits.values()):
            _gate("subscriptions", hits, Q.union_all(shown), settings)

    # Only the first price too large that is met stops the other policies: nobody has counted them.
    rows = D.disposed(stated, rules, policy)
    columns = [*SILVER_COLUMNS]
    if policy == FLAG:
        columns += ["start_date_raw", "monthly_price_raw"]
    return Outcome(rows=rows.select(*columns), warnings=warnings, stated=stated, counts=counts)


__all__ = [
    "Outcome",
    "clean_customers",
    "clean_subscriptions",
    "customer_reference",
    "customer_rule_counts",
    "duplicate_customers",
    "plan_price_spread",
    "price_outliers",
    "repair_date_ranges",
    "standardise_customers",
    "standardise_subscriptions",
    "subscription_rule_counts",
    "subscription_rules",
    "with_customer_state",
]
