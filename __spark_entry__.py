"""Entry points of the correctness and speed checks.

Every query runs over the whole derived tables (see tenure/sources/demo.py), which grow
with the parquet tables they come from.
"""

from __future__ import annotations

import importlib.util
import uuid
import warnings
from collections.abc import Callable
from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import oracles
from tenure.functions import scalars as S
from tenure.config import DEFAULTS, LENIENT
from tenure.operators import dispositions, findings, prefilter, sketches
from tenure.operators.clustered import Clustered, write_clustered
from tenure.operators.ordered import first_per_key
from tenure.operators.quantiles import QUARTILES
from tenure.operators.staging import staged, staging_folder
from tenure.operators.sequences import overlaps_adjacent, overlaps_running_max
from tenure.plans import clean, explore, gold, load, metrics, report, stored
from tenure.schemas import SUBSCRIPTION_COLUMNS
from tenure.session import configure
from tenure.sources import demo

AS_OF = oracles.AS_OF


class Tables:
    """The inputs of all queries, built lazily from one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir

    @cached_property
    def bronze_customers(self) -> DataFrame:
        return demo.bronze_customers(self.spark, self.sf_dir)

    @cached_property
    def bronze_subscriptions(self) -> DataFrame:
        return demo.bronze_subscriptions(self.spark, self.sf_dir)

    @cached_property
    def standard_customers(self) -> DataFrame:
        return clean.standardise_customers(self.bronze_customers)

    @cached_property
    def standard_subscriptions(self) -> DataFrame:
        return clean.standardise_subscriptions(self.bronze_subscriptions)

    @cached_property
    def cleaned_customers(self) -> clean.Outcome:
        return clean.clean_customers(self.bronze_customers)

    @cached_property
    def customers(self) -> DataFrame:
        """Silver customers, stored: they are the lookup side of every join."""
        return staged(self.cleaned_customers.rows, "customers")

    @cached_property
    def staged_cleaning(self) -> clean.Outcome:
        return clean.clean_subscriptions(
            self.bronze_subscriptions,
            reference=self.customers,
            excluded=self.cleaned_customers.removed,
            policy="lenient",
            stage=staged,
        )

    @cached_property
    def stated(self) -> DataFrame:
        """Standardised subscriptions with the state of their customer."""
        return clean.with_customer_state(
            self.standard_subscriptions, self.customers, self.cleaned_customers.removed, stage=staged
        )

    @cached_property
    def known(self) -> DataFrame:
        """Standardised subscriptions of silver customers, with the signup date."""
        return self.standard_subscriptions.join(self.customers.select("customer_id", "signup_date"), "customer_id")

    @cached_property
    def loaded(self) -> clean.Outcome:
        return load.load_subscriptions(self.standard_subscriptions, self.customers, lines=False)

    @cached_property
    def valid(self) -> DataFrame:
        """Subscriptions the metrics run on."""
        return self.loaded.rows

    @cached_property
    def repaired(self) -> DataFrame:
        """Known, dated and priced subscriptions, ends before the start opened."""
        usable = self.known.where("start_date IS NOT NULL AND monthly_price IS NOT NULL")
        return clean.repair_date_ranges(usable)

    # The same, written once for plans that read their input several times.

    @cached_property
    def staged_known(self) -> DataFrame:
        return staged(self.known.select("row_id", "customer_id", "start_date", "end_date", "plan", "monthly_price"), "known")

    @cached_property
    def staged_valid(self) -> DataFrame:
        return staged(self.valid, "valid")

    @cached_property
    def stored_valid(self) -> Clustered:
        """Valid subscriptions stored by customer."""
        return self._stored(self.staged_valid)

    @cached_property
    def stored_repaired(self) -> Clustered:
        return self._stored(self.staged_repaired)

    def _stored(self, rows: DataFrame) -> Clustered:
        path = f"{staging_folder(self.spark)}/tenure/clustered-{uuid.uuid4().hex}"
        return write_clustered(rows, path, ("start_date", "row_id"))

    @cached_property
    def staged_repaired(self) -> DataFrame:
        return staged(self.repaired.select("row_id", "customer_id", "start_date", "end_date", "plan", "monthly_price"), "repaired")


def _prices_as_double(df: DataFrame) -> DataFrame:
    return df.withColumn("monthly_price", F.col("monthly_price").cast("double"))


def _silver_subscriptions(t: Tables) -> DataFrame:
    # The stored silver customers are the only known ones, removed customers are not in it.
    cleaned = clean.clean_subscriptions(t.bronze_subscriptions, reference=t.customers, policy="lenient")
    return _prices_as_double(cleaned.rows)


def _silver_standalone(t: Tables) -> DataFrame:
    """Cleaned against the raw customer table: every id it names is known."""
    reference = staged(clean.customer_reference(t.bronze_customers), "bronze_reference")
    cleaned = clean.clean_subscriptions(t.bronze_subscriptions, reference=reference, policy="lenient")
    return _prices_as_double(cleaned.rows)


def _report_warnings(t: Tables) -> DataFrame:
    return findings.union_all(
        [load.load_customers(t.customers, lines=False).warnings, t.loaded.warnings, load.overlap_warnings(t.staged_valid)]
    )


def _dq_warnings(t: Tables) -> DataFrame:
    return findings.union_all(
        [t.cleaned_customers.warnings, t.staged_cleaning.warnings, load.overlap_warnings(t.staged_valid)]
    )


#: A rule table of one's own: two rules let rows pass, three leave out what is else repaired, kept or corrected.
RULE_TABLE = replace(
    DEFAULTS,
    severities=(
        ("end_before_start", findings.MONITOR),
        ("non_numeric_price", findings.MONITOR),
        ("malformed_end_date", findings.DROPPED),
        ("start_before_signup", findings.DROPPED),
        ("plan_typo", findings.DROPPED),
    ),
)


def _own_rules(t: Tables) -> clean.Outcome:
    return clean.clean_subscriptions(
        t.bronze_subscriptions,
        reference=t.customers,
        excluded=t.cleaned_customers.removed,
        policy=LENIENT,
        settings=RULE_TABLE,
        stage=staged,
    )


def _rule_table(t: Tables) -> DataFrame:
    rules = clean.subscription_rules(lenient=True, settings=RULE_TABLE)
    return dispositions.rule_table(_own_rules(t).stated, rules, LENIENT)


def _row_fates(t: Tables) -> DataFrame:
    rules = clean.subscription_rules(lenient=True, settings=RULE_TABLE)
    fate = dispositions.fate(rules, LENIENT).alias("fate")
    return _own_rules(t).stated.groupBy(fate).agg(F.count(F.lit(1)).alias("rows"))


def _sketched_prices(t: Tables) -> DataFrame:
    """Quartiles by sketches merged from months; are their ranks within the stated error."""
    months = t.staged_repaired.withColumn("month", S.month_key("start_date"))
    whole = sketches.merged(sketches.sketched(months, ["plan", "month"], "monthly_price"), ["plan"])
    ranks = sketches.with_true_ranks(t.staged_repaired, ["plan"], "monthly_price", sketches.quantiles(whole), QUARTILES)
    error = sketches.rank_error()
    within = (F.col("below") - error <= F.col("prob")) & (F.col("prob") <= F.col("up_to") + error)
    return ranks.select("plan", "prob", "size", within.alias("within_error"))


def _raw_loaded(t: Tables) -> clean.Outcome:
    """Subscriptions loaded straight from bronze, with line numbers in the messages."""
    known = staged(load.load_customers(t.bronze_customers).rows, "loaded_customers")
    return load.load_subscriptions(t.bronze_subscriptions, known)


def _raw_loaded_customers(t: Tables) -> clean.Outcome:
    return load.load_customers(t.bronze_customers)


QUERIES: dict[str, Callable[[Tables], DataFrame]] = {
    # scans and references
    "bronze_customers_scan": lambda t: t.bronze_customers,
    "bronze_subscriptions_scan": lambda t: t.bronze_subscriptions,
    "customer_reference": lambda t: clean.customer_reference(t.bronze_customers, t.cleaned_customers.removed),
    # scalar cleaning
    "clean_strip": lambda t: t.bronze_subscriptions.select(
        "row_id", *[S.strip(c).alias(c) for c in SUBSCRIPTION_COLUMNS]
    ),
    "clean_country": lambda t: t.bronze_customers.select("row_id", S.country_code("country").alias("country")),
    "clean_plan": lambda t: t.standard_subscriptions.select("row_id", "plan", F.lower("plan").alias("plan_lower")),
    "clean_price": lambda t: _prices_as_double(
        t.standard_subscriptions.select("row_id", "monthly_price_raw", "monthly_price")
    ),
    "clean_dates": lambda t: t.standard_subscriptions.select(
        "row_id",
        "start_date",
        "end_date",
        "end_date_malformed",
        S.month_start("start_date").alias("first_day"),
        S.month_end("start_date").alias("last_day"),
        S.is_active("end_date").alias("is_active"),
        S.shown_end("end_date").alias("shown_end"),
    ),
    "target_date_3m": lambda t: metrics.retention_targets(t.cleaned_customers.rows),
    # rules
    "dq_customer_rules": lambda t: clean.customer_rule_counts(t.bronze_customers),
    "customers_dedup": lambda t: first_per_key(t.standard_customers, "customer_id", "row_id").select(
        "row_id", "customer_id", "signup_date_raw", "country"
    ),
    "customers_removed": lambda t: t.cleaned_customers.removed.orderBy("customer_id"),
    "subscriptions_excluded": lambda t: t.stated.where("customer_state = 'excluded'")
    .groupBy("customer_id")
    .agg(F.count(F.lit(1)).alias("subscriptions")),
    "subscriptions_known": lambda t: t.standard_subscriptions.join(
        t.customers.select("customer_id"), "customer_id", "left_semi"
    ).select("row_id", "customer_id"),
    "subscriptions_orphans": lambda t: t.standard_subscriptions.join(
        t.customers.select("customer_id"), "customer_id", "left_anti"
    ).select("row_id", "customer_id", "start_date_raw", "plan"),
    "dq_subscription_rules": lambda t: clean.subscription_rule_counts(t.stated),
    "end_date_malformed": lambda t: t.known.where("end_date_malformed").select("row_id", "customer_id", "end_date_raw"),
    "invalid_date_ranges": lambda t: explore.invalid_date_ranges(t.known),
    "start_before_signup": lambda t: explore.start_before_signup(t.known),
    "negative_prices": lambda t: explore.negative_prices(t.known),
    "zero_prices": lambda t: explore.zero_prices(t.known),
    "overlaps_running_max": lambda t: overlaps_running_max(t.staged_known.where("start_date IS NOT NULL")),
    "overlaps_adjacent": lambda t: overlaps_adjacent(t.staged_valid),
    "price_outliers_iqr": lambda t: _prices_as_double(clean.price_outliers(t.staged_known)),
    "plan_price_spread": lambda t: clean.plan_price_spread(t.staged_known),
    "null_profile": lambda t: explore.null_profile(t.known.drop("row_id", "price_out_of_range")),
    "repair_date_ranges": lambda t: t.repaired.select("row_id", "customer_id", "start_date", "end_date", "repaired"),
    "dq_examples": lambda t: findings.examples(
        findings.findings(t.stated, clean.STAGE_SUBSCRIPTIONS, clean.subscription_rules(lenient=True)), 5, 10
    ).select("rule_id", "rank", "row_id", "customer_id", "detail"),
    "dq_warnings": _dq_warnings,
    "report_messages": lambda t: report.report_messages(_report_warnings(t)),
    "first_warnings": lambda t: report.first_warnings(_report_warnings(t)),
    # pipelines
    "silver_customers": lambda t: t.cleaned_customers.rows,
    "silver_subscriptions": _silver_subscriptions,
    "silver_subscriptions_standalone": _silver_standalone,
    "load_customers": lambda t: _raw_loaded_customers(t).rows,
    "load_customers_warnings": lambda t: _raw_loaded_customers(t).warnings,
    "load_subscriptions": lambda t: _prices_as_double(_raw_loaded(t).rows),
    "load_subscriptions_warnings": lambda t: _raw_loaded(t).warnings,
    "subscriptions_quarantine": lambda t: gold.quarantine(t.stated),
    "rule_table": _rule_table,
    "row_fates": _row_fates,
    "silver_by_rule_table": lambda t: _prices_as_double(_own_rules(t).rows),
    "quarantine_by_rule_table": lambda t: gold.quarantine(_own_rules(t).stated, RULE_TABLE),
    "stored_gaps": lambda t: stored.gaps(t.stored_repaired).select(
        "row_id", "customer_id", "start_date", "end_date", "next_start", "gap_days"
    ),
    "stored_overlaps_adjacent": lambda t: stored.overlaps_adjacent(t.stored_valid),
    "stored_churn": lambda t: stored.monthly_churn(t.stored_valid),
    "stored_retention": lambda t: stored.cohort_retention(t.customers, t.stored_valid),
    "prefiltered_known": lambda t: prefilter.known_rows(t.standard_subscriptions, t.customers, "customer_id").select(
        "row_id", "customer_id"
    ),
    "prefiltered_orphans": lambda t: prefilter.unknown_rows(t.standard_subscriptions, t.customers, "customer_id").select(
        "row_id", "customer_id", "start_date_raw", "plan"
    ),
    # metrics
    "metric_month_range": lambda t: metrics.month_range(t.valid),
    "monthly_mrr": lambda t: metrics.monthly_mrr(t.valid),
    "churn_events": lambda t: metrics.churn_events(t.valid),
    "monthly_churn": lambda t: metrics.monthly_churn(t.valid),
    "cohort_retention": lambda t: metrics.cohort_retention(t.customers, t.valid),
    "report_summary": lambda t: report.report_summary(t.customers, t.staged_valid, _report_warnings(t)),
    # exploration
    "open_subscriptions": lambda t: _prices_as_double(explore.open_subscriptions(t.repaired)),
    "multi_active_customers": lambda t: explore.multi_active_customers(t.repaired, AS_OF),
    "multi_active_details": lambda t: _prices_as_double(explore.multi_active_details(t.staged_repaired, AS_OF)),
    "subscription_gaps": lambda t: explore.subscription_gaps(t.staged_repaired),
    "gaps_exactly_30": lambda t: explore.gaps_exactly(t.staged_repaired, 30),
    "gap_stats": lambda t: explore.gap_stats(t.staged_repaired),
    "gap_histogram": lambda t: explore.gap_histogram(t.staged_repaired),
    "resubscription_shares": lambda t: explore.resubscription_shares(t.staged_repaired),
    "cohort_sizes": lambda t: explore.cohort_sizes(t.cleaned_customers.rows),
    "tiny_cohorts": lambda t: explore.tiny_cohorts(t.cleaned_customers.rows),
    "cohort_retention_exploratory": lambda t: explore.cohort_retention_exploratory(t.customers, t.repaired),
    "subscription_duration": lambda t: explore.subscription_duration(t.repaired, AS_OF),
    "duration_stats": lambda t: explore.duration_stats(t.repaired, AS_OF),
    "duration_histogram": lambda t: explore.duration_histogram(t.staged_repaired, AS_OF),
    "price_stats": lambda t: explore.price_stats(t.staged_repaired),
    "plan_price_stats": lambda t: explore.plan_price_stats(t.staged_repaired),
    "price_sketches": _sketched_prices,
    "price_histogram": lambda t: explore.price_histogram(t.staged_repaired),
    "country_counts": lambda t: explore.country_counts(t.bronze_customers),
    "country_variants": lambda t: explore.country_variants(t.bronze_customers),
    # gold
    "subscription_enriched": lambda t: gold.subscription_enriched(t.customers, t.staged_valid, AS_OF),
    "monthly_arpu": lambda t: gold.monthly_arpu(t.staged_valid),
    "monthly_aggregates": lambda t: gold.monthly_aggregates(t.staged_valid),
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: monthly recurring revenue, bronze to metric, at the smallest scale."""
    return QUERIES["monthly_mrr"](Tables(spark, "/root/testdata/sf0.001"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: build(Tables(spark, sf_dir))

    return {name: bind(build) for name, build in QUERIES.items()} | _training_data()[0]


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql() | _training_data()[1]


def _training_data() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    """Queries and SQL of the training-data operators, none where their folder is gone."""
    if not (importlib.util.find_spec("tenure.llm") and importlib.util.find_spec("tenure.llm.queries")):
        return {}, {}
    try:
        from tenure.llm import queries as training, sql
    except ImportError as missing:
        warnings.warn(f"the training-data queries are left out: {missing}", stacklevel=2)
        return {}, {}

    found = dict(training.QUERIES)
    if importlib.util.find_spec("corpus_pipeline"):
        import corpus_pipeline

        found["pipeline"] = corpus_pipeline.run
    return found, {name: text for name, text in sql.ORACLES.items() if name in found}
