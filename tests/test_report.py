"""Full runs over a small dirty data set with known results."""

import json

import golden
import pytest
from pyspark.sql import functions as F

from tenure.config import DEFAULTS
from tenure.errors import DataQualityError
from tenure.operators.findings import DROPPED, Rule
from tenure.operators.sequences import overlaps_running_max
from tenure.plans import clean, explore, registry
from tenure.plans.report import first_warnings, open_run, run
from tenure.schemas import CUSTOMER_COLUMNS, SUBSCRIPTION_COLUMNS
from tenure.sources.files import current_run, publish
from tenure.sources.tables import bad_row_findings, parse_csv, read_csv, read_table, write_table


@pytest.fixture(scope="module")
def bronze(tmp_path_factory):
    folder = tmp_path_factory.mktemp("bronze")
    (folder / "customers.csv").write_text(golden.CUSTOMERS_CSV)
    (folder / "subscriptions.csv").write_text(golden.SUBSCRIPTIONS_CSV)
    return folder


def do_run(spark, bronze, out, **options):
    return run(spark, f"{bronze}/customers.csv", f"{bronze}/subscriptions.csv", str(out), **options)


def run_folder(out):
    return out / "runs" / json.loads((out / "current.json").read_text())["run"]


def read_document(out):
    return json.loads((run_folder(out) / "report.json").read_text())


@pytest.fixture(scope="module")
def lenient(spark, bronze, tmp_path_factory):
    out = tmp_path_factory.mktemp("lenient")
    result = do_run(spark, bronze, out, policy="lenient", silver_format="csv")
    return result, read_document(out), out


def test_report_document(lenient):
    _, report, _ = lenient
    assert [m["month"] for m in report["monthly_mrr"]] == golden.MONTHS
    assert [m["mrr"] for m in report["monthly_mrr"]] == golden.MRR
    assert [(m["month"], m["churned_count"]) for m in report["monthly_churn"]] == list(zip(golden.MONTHS, golden.CHURN))
    assert [(m["cohort_month"], m["retention_rate_3m"]) for m in report["cohort_retention"]] == list(zip(golden.MONTHS, golden.RETENTION))
    text = (run_folder(lenient[2]) / "report.json").read_text()
    assert text == json.dumps(report, indent=2, ensure_ascii=False) + "\n"
    assert list(report["cohort_retention"][0]) == ["cohort_month", "cohort_size", "active_after_3_months", "retention_rate_3m"]


def test_report_metadata(lenient):
    _, report, _ = lenient
    metadata = report["metadata"]
    assert metadata["summary"] == {"total_customers": 38, "total_subscriptions": 50, "warning_count": 7}
    assert metadata["data_quality_warnings"] == golden.WARNINGS
    assert set(metadata) == {"generated_at", "input_files", "data_quality_warnings", "summary"}
    assert metadata["input_files"]["customers"].endswith("customers.csv")


def test_warnings_table_also_holds_the_cleaning_findings(lenient):
    result, _, _ = lenient
    found = {(r["stage"], r["rule_id"], r["customer_id"]) for r in result.warnings.collect()}
    assert ("clean_customers", "malformed_signup_date", "C019") in found
    assert ("clean_customers", "duplicate_customer_id", "C038") in found
    assert ("clean_subscriptions", "excluded_customer", "C019") in found
    assert first_warnings(result.warnings).count() == 10


def test_silver_csv_can_be_loaded_without_preprocessing(spark, lenient, tmp_path):
    _, report, out = lenient
    silver = run_folder(out) / "silver"
    for name in ("customers", "subscriptions"):
        (tmp_path / f"{name}.csv").write_text(
            "\n".join(sorted({line for p in (silver / f"{name}_csv").glob("part-*") for line in p.read_text().splitlines()}, key=lambda l: not l.startswith("row_id")))
        )
    do_run(spark, tmp_path, tmp_path / "out", skip_preprocessing=True)
    again = read_document(tmp_path / "out")
    for part in ("monthly_mrr", "monthly_churn", "cohort_retention"):
        assert again[part] == report[part]


def test_strict_run_raises(spark, bronze, tmp_path):
    with pytest.raises(DataQualityError, match="end_before_start: 1 rows.*C026"):
        do_run(spark, bronze, tmp_path)


def test_a_long_warning_list_is_whole(spark, bronze, tmp_path):
    more = "".join(f"U{i},2024-01-01,,basic,10\n" for i in range(10_050))
    (tmp_path / "customers.csv").write_text(golden.CUSTOMERS_CSV)
    (tmp_path / "subscriptions.csv").write_text(golden.SUBSCRIPTIONS_CSV.rstrip("\n") + "\n" + more)
    do_run(spark, tmp_path, tmp_path / "out", skip_preprocessing=True)
    metadata = read_document(tmp_path / "out")["metadata"]
    listed = metadata["data_quality_warnings"]
    assert len(listed) == metadata["summary"]["warning_count"]
    found = {m for m in listed if "'U" in m}
    assert len(found) == 10_050


def test_a_killed_run_leaves_the_former_one(spark, bronze, lenient, tmp_path):
    first = do_run(spark, bronze, tmp_path, policy="lenient", run_id="one")
    before = read_document(tmp_path)

    def killed(customers, subs, settings):
        raise RuntimeError("lost")

    for broken in ("two", "three"):
        with pytest.raises(RuntimeError, match="lost"):
            do_run(spark, bronze, tmp_path, policy="lenient", run_id=broken, metrics={"broken": killed})
        again = open_run(spark, str(tmp_path))
        assert again.path == first.path and read_document(tmp_path) == before
        assert (again.customers.count(), again.subscriptions.count()) == (38, 50)
        assert again.warnings.count() == lenient[0].warnings.count()


def test_the_run_before_stays_and_older_ones_go(spark, tmp_path):
    for name in ("a", "b", "c"):
        folder = tmp_path / "runs" / name
        folder.mkdir(parents=True)
        (folder / "x").write_text(name)
        publish(spark, str(tmp_path), name)
    assert sorted(p.name for p in (tmp_path / "runs").iterdir()) == ["b", "c"]
    assert current_run(spark, str(tmp_path)).endswith("/runs/c")
    with pytest.raises(DataQualityError, match="No run"):
        current_run(spark, str(tmp_path / "none"))


def test_added_metrics_and_rules_reach_the_report(spark, bronze, tmp_path, monkeypatch):
    monkeypatch.setattr(registry, "METRICS", dict(registry.METRICS))
    monkeypatch.setattr("tenure.plans.report.METRICS", registry.METRICS)
    monkeypatch.setattr(registry, "RULES", {stage: [] for stage in registry.RULES})

    @registry.metric("plans")
    def plans(customers, subs, settings):
        return subs.groupBy("plan").agg(F.count(F.lit(1)).alias("n"), F.max("end_date").alias("last"))

    @registry.rule(clean.STAGE_SUBSCRIPTIONS)
    def dear(settings):
        return Rule("dear", F.col("monthly_price") >= 50, DROPPED, F.col("monthly_price_raw"), F.lit("too dear"))

    result = do_run(spark, bronze, tmp_path, policy="lenient")
    assert [list(r) for r in read_document(tmp_path)["plans"]] == [["plan", "n", "last"]]
    dropped = result.warnings.where("rule_id = 'dear'").count()
    assert dropped == 9 and spark.read.parquet(f"{result.path}/quarantine").where("rule_id = 'dear'").count() == dropped
    assert spark.read.parquet(f"{result.path}/silver/subscriptions").where("monthly_price >= 50").count() == 0
    with pytest.raises(ValueError, match="already"):
        registry.rule(clean.STAGE_SUBSCRIPTIONS)(lambda settings: dear(settings)._replace(rule_id="overlap"))
        registry.built(clean.STAGE_SUBSCRIPTIONS, DEFAULTS)


RAGGED = 'customer_id,signup_date,country\nC1,2024-01-01,NL\nC2,2024-01-01,NL,x\nC3,2024-01-01,"N\nL"\nC4,2024-01-01\nC5,2024-01-01,"a, b"\nC6,2024-01-01,5" pipe\n'


def test_bad_rows_are_findings_with_their_text(spark, tmp_path):
    (tmp_path / "customers.csv").write_text(RAGGED)
    path = f"{tmp_path}/customers.csv"
    parsed = parse_csv(spark, path, CUSTOMER_COLUMNS, "customers", dense_ids=True)
    assert [(r["row_id"], r["customer_id"], r["country"]) for r in parsed.rows.orderBy("row_id").collect()] == [
        (0, "C1", "NL"),
        (4, "C4", None),
        (5, "C5", "a, b"),
        (6, "C6", '5" pipe'),
    ]
    found = bad_row_findings(parsed.bad, "customers").orderBy("row_id").collect()
    assert [(r["rule_id"], r["row_id"], r["detail"]) for r in found] == [
        ("ragged_row", 1, "C2,2024-01-01,NL,x"),
        ("cut_quote", 2, 'C3,2024-01-01,"N'),
        ("cut_quote", 3, 'L"'),
    ]
    with pytest.raises(DataQualityError, match="2 rows have a line break.*1 rows have more fields"):
        read_csv(spark, path, CUSTOMER_COLUMNS, "customers")
    whole = parse_csv(spark, path, CUSTOMER_COLUMNS, "customers", multiline=True)
    assert {r["customer_id"]: r["country"] for r in whole.rows.collect()} == {"C1": "NL", "C3": "N\nL", "C4": None, "C5": "a, b", "C6": '5" pipe'}
    assert [r["raw"].strip() for r in whole.bad.collect()] == ["C2,2024-01-01,NL,x"]


def test_a_lenient_run_survives_bad_rows(spark, bronze, tmp_path):
    (tmp_path / "customers.csv").write_text(golden.CUSTOMERS_CSV.rstrip("\n") + "\nC900,2024-01-01,NL,more\n")
    (tmp_path / "subscriptions.csv").write_text(golden.SUBSCRIPTIONS_CSV)
    result = do_run(spark, tmp_path, tmp_path / "out", policy="lenient")
    assert result.customers.count() == 38
    assert result.warnings.where("stage = 'read_customers'").first()["detail"] == "C900,2024-01-01,NL,more"
    assert any("C900" in m for m in read_document(tmp_path / "out")["metadata"]["data_quality_warnings"])
    with pytest.raises(DataQualityError, match="1 rows have more fields"):
        do_run(spark, tmp_path, tmp_path / "strict")


def test_known_figures(spark, bronze):
    raw_c = read_csv(spark, f"{bronze}/customers.csv", CUSTOMER_COLUMNS, "customers")
    raw_s = read_csv(spark, f"{bronze}/subscriptions.csv", SUBSCRIPTION_COLUMNS, "subscriptions")
    assert (raw_c.count(), raw_s.count()) == (40, 54)
    people = clean.clean_customers(raw_c)
    assert people.rows.count() == 38 and [r["customer_id"] for r in people.removed.collect()] == ["C019"]
    assert people.rows.where("customer_id = 'C038'").first()["country"] == "NL"
    orphans = clean.standardise_subscriptions(raw_s).join(people.rows, "customer_id", "left_anti")
    assert {r["customer_id"] for r in orphans.collect()} == {"C019", "C999", "C050"}
    known = clean.standardise_subscriptions(raw_s).join(people.rows.select("customer_id", "signup_date"), "customer_id")
    assert known.count() == 51
    assert [r["customer_id"] for r in explore.invalid_date_ranges(known).collect()] == ["C026"]
    assert explore.start_before_signup(known).count() == 0
    assert {r["customer_id"] for r in overlaps_running_max(known).collect()} == {"C004", "C017", "C038"}
    outliers = clean.price_outliers(known).collect()
    assert len(outliers) == 9 and {r["plan"] for r in outliers} == {"pro"}
    assert (outliers[0]["lower_bound"], outliers[0]["upper_bound"]) == (5.0, 45.0)
    spread = {r["plan"]: tuple(r)[1:] for r in clean.plan_price_spread(known).collect()}
    assert spread == {"basic": (42, 6, 10.0, 30.0), "pro": (9, 3, 50.0, 60.0)}
    gaps = explore.gap_stats(clean.repair_date_ranges(known)).first()
    assert (gaps["count"], gaps["min"], gaps["max"]) == (12, -17.0, 15.0)


def test_reader(spark, tmp_path):
    (tmp_path / "s.csv").write_text('extra,customer_id,start_date,end_date,plan,monthly_price\nx," C1 ",2024-01-01,,"a ""b"", c",1\ny,NA,,,,\n')
    rows = read_csv(spark, f"{tmp_path}/s.csv", SUBSCRIPTION_COLUMNS, "subscriptions", dense_ids=True).orderBy("row_id").collect()
    assert [r["row_id"] for r in rows] == [0, 1]
    assert (rows[0]["customer_id"], rows[0]["plan"], rows[0]["end_date"]) == (" C1 ", 'a "b", c', None)
    assert rows[1]["customer_id"] == "NA"
    with pytest.raises(DataQualityError, match="Missing required columns"):
        read_csv(spark, f"{tmp_path}/s.csv", CUSTOMER_COLUMNS, "customers")
    with pytest.raises(DataQualityError, match="Failed to read"):
        read_table(spark, f"{tmp_path}/absent.csv", CUSTOMER_COLUMNS, "customers")
    with pytest.raises(DataQualityError, match="Failed to read"):
        read_table(spark, f"{tmp_path}/absent", CUSTOMER_COLUMNS, "customers")


def test_empty_results_stop_the_run(spark, bronze, tmp_path):
    (tmp_path / "customers.csv").write_text("customer_id,signup_date,country\nC1,never,NL\n")
    (tmp_path / "subscriptions.csv").write_text(golden.SUBSCRIPTIONS_CSV)
    with pytest.raises(DataQualityError, match="No valid customers"):
        do_run(spark, tmp_path, tmp_path / "a", skip_preprocessing=True)
    (tmp_path / "customers.csv").write_text("customer_id,signup_date,country\nC777,2024-01-01,NL\n")
    with pytest.raises(DataQualityError, match="No valid subscriptions"):
        do_run(spark, tmp_path, tmp_path / "b", skip_preprocessing=True)


def test_partitioned_write(spark, tmp_path):
    df = spark.range(4).select("id", F.when(F.col("id") < 2, "a").otherwise("b").alias("rule_id"))
    write_table(df, f"{tmp_path}/q", partition_by=("rule_id",))
    write_table(df, f"{tmp_path}/q", partition_by=("rule_id",))
    assert spark.read.parquet(f"{tmp_path}/q").where("rule_id = 'a'").count() == 2
