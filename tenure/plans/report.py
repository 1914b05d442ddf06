"""The report document and the full run."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from datetime import datetime, timezone
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenure.config import DEFAULTS, FLAG, LENIENT, STRICT, Settings
from tenure.operators.clustered import each_part, read_whole, write_clustered
from tenure.operators.findings import union_all
from tenure.operators.ordered import positions
from tenure.operators.staging import staged, staging_root
from tenure.plans import clean, load, registry
from tenure.plans.gold import quarantine
from tenure.plans.metrics import METRICS
from tenure.plans.registry import Metric
from tenure.schemas import CUSTOMER_COLUMNS, SILVER_CUSTOMERS, SILVER_SUBSCRIPTIONS, SUBSCRIPTION_COLUMNS, require_types
from tenure.session import configure
from tenure.sources.files import current_run, new_run, publish, write_document
from tenure.sources.tables import READ, bad_row_findings, file_bytes, parse_table, require_no_bad_rows, require_rows, write_table

READ_STAGES = (f"{READ}_customers", f"{READ}_subscriptions")

# Order of the stages in the warning list.
STAGES = (
    *READ_STAGES,
    clean.STAGE_CUSTOMERS,
    clean.STAGE_SUBSCRIPTIONS,
    load.STAGE_CUSTOMERS,
    load.STAGE_SUBSCRIPTIONS,
    load.STAGE_OVERLAPS,
)


def report_summary(customers: DataFrame, subs: DataFrame, warnings: DataFrame) -> DataFrame:
    """One row: total_customers, total_subscriptions, warning_count."""

    def total(df: DataFrame) -> Column:
        return df.agg(F.count(F.lit(1))).scalar()

    return customers.agg(F.count(F.lit(1)).alias("total_customers")).select(
        "total_customers",
        total(subs).alias("total_subscriptions"),
        total(warnings).alias("warning_count"),
    )


def ordered_warnings(warnings: DataFrame) -> DataFrame:
    """Warnings in the order the stages produce them."""
    stage = F.array_position(F.array(*[F.lit(s) for s in STAGES]), F.col("stage"))
    # Overlaps belong to customers, all others to rows.
    owner = F.when(F.col("stage") == load.STAGE_OVERLAPS, F.col("customer_id"))
    return warnings.orderBy(stage, owner, "row_id", "rule_id")


def first_warnings(warnings: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The first few warnings; ``more`` tells how many others there are."""
    total = warnings.agg(F.count(F.lit(1))).scalar()
    more = F.greatest(total - settings.warnings_shown, F.lit(0).cast("long"))
    return ordered_warnings(warnings).limit(settings.warnings_shown).withColumn("more", more)


def report_messages(warnings: DataFrame) -> DataFrame:
    """(position, message) of all warnings in report order; a distributed sort, any number of rows."""
    stage = F.array_position(F.array(*[F.lit(s) for s in STAGES]), F.col("stage")).alias("_stage")
    owner = F.when(F.col("stage") == load.STAGE_OVERLAPS, F.col("customer_id")).alias("_owner")
    keyed = warnings.select(stage, owner, "row_id", "rule_id", "message")
    return positions(keyed, ["_stage", "_owner", "row_id", "rule_id", "message"], "position").select("position", "message")


def _json(c: Column) -> Column:
    """One value as JSON text."""
    text = F.to_json(F.array(c), {"ignoreNullFields": "false"})
    return F.substring(text, F.lit(2), F.length(text) - 2)


def _record(columns: list[str], indent: int) -> Column:
    """A row as a JSON object over several lines; it starts and ends with its braces."""
    pad = " " * indent
    inner = [F.concat(F.lit(f'{pad}  {json.dumps(c)}: '), _json(F.col(f"`{c}`"))) for c in columns]
    return F.concat(F.lit(f"{pad}{{\n"), F.concat_ws(",\n", *inner), F.lit(f"\n{pad}}}"))


def _fixed(spark: SparkSession, section: int, text: Column | str) -> DataFrame:
    value = F.lit(text) if isinstance(text, str) else text
    return spark.range(1).select(F.lit(section).alias("section"), F.lit(0).cast("long").alias("position"), value.alias("value"))


def report_lines(
    customers: DataFrame,
    subs: DataFrame,
    warnings: DataFrame,
    input_files: dict[str, str],
    generated_at: str | None = None,
    settings: Settings = DEFAULTS,
    metrics: Mapping[str, Metric] | None = None,
) -> DataFrame:
    """(section, position, value): an indented JSON document with metadata, all messages and all metrics.

    Every message and every row of a metric is an entry of its own, so the document grows with
    them and is never held in one row. Rows of a metric are in the order of its first column.
    """
    spark = customers.sparkSession
    metrics = METRICS if metrics is None else metrics
    stamp = generated_at or datetime.now(timezone.utc).isoformat()
    messages = staged(report_messages(warnings), "report_messages")
    parts: list[DataFrame] = []

    def fixed(text: Column | str) -> None:
        parts.append(_fixed(spark, len(parts), text))

    def listed(rows: DataFrame, value: Column) -> None:
        last = rows.agg(F.count(F.lit(1))).scalar() - 1
        comma = F.when(F.col("position") < last, ",").otherwise("")
        parts.append(rows.select(F.lit(len(parts)).alias("section"), "position", F.concat(value, comma).alias("value")))

    files = [f"      {json.dumps(k)}: {json.dumps(v)}" for k, v in input_files.items()]
    head = ["{", '  "metadata": {', f'    "generated_at": {json.dumps(stamp)},', '    "input_files": {', ",\n".join(files), "    },"]
    fixed("\n".join([*head, '    "data_quality_warnings": [']))
    listed(messages, F.concat(F.lit("      "), _json(F.col("message"))))
    fixed("    ],")
    summary = customers.agg(F.count(F.lit(1)).alias("total_customers")).select(
        "total_customers",
        subs.agg(F.count(F.lit(1))).scalar().alias("total_subscriptions"),
        messages.agg(F.count(F.lit(1))).scalar().alias("warning_count"),
    )
    shown = F.concat(F.lit('    "summary": '), F.ltrim(_record(summary.columns, 4)), F.lit("\n  }," if metrics else "\n  }"))
    parts.append(summary.select(F.lit(len(parts)).alias("section"), F.lit(0).cast("long").alias("position"), shown.alias("value")))
    for name, build in metrics.items():
        rows = staged(build(customers, subs, settings), f"metric_{name}")
        fixed(f"  {json.dumps(name)}: [")
        listed(staged(positions(rows, [rows.columns[0]], "position"), f"rows_{name}"), _record(rows.columns, 4))
        fixed("  ]" if name == [*metrics][-1] else "  ],")
    fixed("}")
    return union_all(parts)


def rule_counts(counts: dict[str, int], spark: SparkSession) -> DataFrame:
    """(name, n) rows of what was counted while a table was written."""
    return spark.createDataFrame(sorted(counts.items()), "name string, n long")


class Run(NamedTuple):
    """What a full run leaves behind; every frame reads a written table below ``path``."""

    path: str

    customers: DataFrame
    subscriptions: DataFrame
    warnings: DataFrame
    report: DataFrame


def run(spark: SparkSession, *paths: str, **options) -> Run:
    """``full_run`` with one staging folder, removed at the end; see there for the arguments."""
    with staging_root(spark):
        return full_run(spark, *paths, **options)


def full_run(
    spark: SparkSession,
    customers_path: str,
    subscriptions_path: str,
    output_path: str,
    policy: str = STRICT,
    overlap_policy: str = "warn",
    skip_preprocessing: bool = False,
    lines: bool = True,
    against_bronze: bool = False,
    multiline: bool = False,
    silver_format: str = "parquet",
    input_bytes: int | None = None,
    run_id: str | None = None,
    metrics: Mapping[str, Metric] | None = None,
    progress: Callable[[str], None] = lambda message: None,
    settings: Settings = DEFAULTS,
) -> Run:
    """Clean, load, measure and report.

    Writes ``silver/``, ``quarantine/``, ``loaded/``, ``warnings`` and ``report.json`` into a
    folder of the run below ``output_path`` and publishes it at the end (see sources.files), so a
    run that is killed leaves the former one as it was. Each step starts from the written table of
    the step before, so a lost executor costs at most one step. ``policy`` "strict" raises on
    fatal findings and on text rows that cannot be read; "lenient" makes findings of both and lets
    the loader drop the rows; both check every rule. Metrics and rules of the registry are part
    of every run; ``metrics`` gives others. ``skip_preprocessing`` takes the two paths as
    silver tables. ``lines`` puts text-file line numbers into the messages, row ids otherwise.
    ``against_bronze`` checks subscriptions against all customers of the raw table, removed ones
    included. ``multiline`` reads line breaks inside quotes. ``input_bytes`` sizes the shuffles
    (see session.configure); without it the sizes of the input files are added up.
    """
    if input_bytes is None:
        input_bytes = sum(file_bytes(spark, p) for p in (customers_path, subscriptions_path))
    configure(spark, input_bytes)
    given = {"customers": customers_path, "subscriptions": subscriptions_path}
    extra_customers = registry.built(clean.STAGE_CUSTOMERS, settings)
    extra_subs = registry.built(clean.STAGE_SUBSCRIPTIONS, settings)
    registry.check_severities(settings, [*extra_customers, *extra_subs])
    run_id = run_id or f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    root, output_path = output_path, new_run(output_path, run_id)
    # Text is split and parsed once, by the reader.
    sources = {
        "customers": parse_table(spark, customers_path, CUSTOMER_COLUMNS, "customers", multiline=multiline),
        "subscriptions": parse_table(spark, subscriptions_path, SUBSCRIPTION_COLUMNS, "subscriptions", multiline=multiline),
    }
    if policy == STRICT:
        for table, parsed in sources.items():
            require_no_bad_rows(parsed, given[table])
    cleaning = [bad_row_findings(p.bad, table) for table, p in sources.items() if p.bad is not None]
    raw_customers, raw_subs = sources["customers"].rows, sources["subscriptions"].rows
    bronze_customers = raw_customers

    if not skip_preprocessing:
        progress("cleaning customers")
        cleaned = clean.clean_customers(raw_customers, policy=policy, settings=settings, extra=extra_customers)
        silver_customers = f"{output_path}/silver/customers"
        removed = f"{output_path}/silver/customers_removed"
        write_table(cleaned.rows, silver_customers)
        write_table(cleaned.removed, removed)
        raw_customers = spark.read.parquet(silver_customers)
        require_types(raw_customers, SILVER_CUSTOMERS, "customers")
        excluded = spark.read.parquet(removed)

        progress("cleaning subscriptions")
        strict = policy == STRICT
        if against_bronze:
            reference, excluded = clean.customer_reference(bronze_customers, settings=settings), None
        else:
            reference = clean.customer_reference(raw_customers, excluded, settings)
        result = clean.clean_subscriptions(
            raw_subs,
            reference=reference,
            excluded=excluded,
            policy=STRICT if strict else FLAG,
            overlap_policy=overlap_policy,
            settings=settings,
            stage=staged,
            extra=extra_subs,
        )
        silver_subs = f"{output_path}/silver/subscriptions"
        write_table(result.rows, silver_subs)
        raw_subs = spark.read.parquet(silver_subs)
        require_types(raw_subs, SILVER_SUBSCRIPTIONS, "subscriptions")
        write_table(quarantine(result.stated, settings, extra=extra_subs), f"{output_path}/quarantine", partition_by=("rule_id",))
        write_table(rule_counts(result.counts, spark), f"{output_path}/counts")
        cleaning += [cleaned.warnings, result.warnings]
        if silver_format != "parquet":
            write_table(raw_customers, f"{silver_customers}_{silver_format}", silver_format)
            write_table(raw_subs, f"{silver_subs}_{silver_format}", silver_format)

    progress("loading")
    customers = load.load_customers(raw_customers, settings, lines)
    write_table(customers.rows, f"{output_path}/loaded/customers")
    loaded_customers = spark.read.parquet(f"{output_path}/loaded/customers")
    require_rows(loaded_customers, "customers")
    subs = load.load_subscriptions(raw_subs, loaded_customers, settings, lines)
    # Stored by customer: overlaps, and whoever opens the run, go along histories without a shuffle.
    stored = write_clustered(
        staged(subs.rows, "loaded_subscriptions"), f"{output_path}/loaded/subscriptions", ("start_date", "row_id"), settings=settings
    )
    loaded_subs = stored.ordinary.unionByName(stored.hot)
    require_rows(loaded_subs, "subscriptions")

    # One plan per stage: a single union would be planned again after each of its shuffles.
    overlaps = each_part(stored, load.overlap_warnings, settings)
    mode = "overwrite"
    for found in (*cleaning, customers.warnings, subs.warnings, overlaps):
        write_table(found, f"{output_path}/warnings", partition_by=("stage",), mode=mode)
        mode = "append"
    warnings = spark.read.parquet(f"{output_path}/warnings")

    progress("measuring")
    # The report lists what the loader saw; cleaning findings stay in the warnings table.
    listed = warnings.where(F.col("stage").isin(*READ_STAGES, load.STAGE_CUSTOMERS, load.STAGE_SUBSCRIPTIONS, load.STAGE_OVERLAPS))
    document = f"{output_path}/report.json"
    write_document(report_lines(loaded_customers, loaded_subs, listed, given, settings=settings, metrics=metrics), document)
    publish(spark, root, run_id)
    progress("done")
    return Run(output_path, loaded_customers, loaded_subs, warnings, spark.read.text(document))


def open_run(spark: SparkSession, output_path: str) -> Run:
    """The published run below ``output_path``."""
    path = current_run(spark, output_path)
    loaded = spark.read.parquet(f"{path}/loaded/customers"), read_whole(spark, f"{path}/loaded/subscriptions")
    return Run(path, *loaded, spark.read.parquet(f"{path}/warnings"), spark.read.text(f"{path}/report.json"))


__all__ = ["LENIENT", "Run", "first_warnings", "ordered_warnings", "report_lines", "report_messages", "report_summary", "full_run", "open_run", "run"]
