import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgermill.operators import dimensions, quality, reconcile
from ledgermill.operators.vocabulary import taxonomy_frame
from ledgermill.plans import gold, publish, silver
from ledgermill.scale import stage
from ledgermill.sinks.tables import SinkError, append_report, write_table
from tests.samples import CATEGORIES, FEBRUARY, JANUARY, PATTERNS, TRAINING, export, row


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("raw")
    (path / "jan.csv").write_bytes(export(JANUARY).encode("cp1250"))
    (path / "feb.csv").write_bytes(export(FEBRUARY).encode())
    return path


@pytest.fixture(scope="module")
def built(spark, folder):
    return silver.build_silver(spark, str(folder), PATTERNS)


@pytest.fixture(scope="module")
def tables(built):
    return gold.build_gold(built.rows, CATEGORIES, TRAINING)


def test_silver_types_and_classes(built):
    rows = {r.transaction_id: r for r in built.rows.collect()}
    assert len(rows) == 16
    assert {k: (r.payment_method, r.event_type, r.include_in_expense) for k, r in rows.items()} == {
        "123": ("card", "expense", True),
        "124": ("transfer", "income_salary", False),
        "125": ("card", "expense", True),
        "126": ("currency_exchange", "fx_swap", False),
        "127": ("transfer", "internal_transfer", False),
        "128": ("sepa_transfer", "investment_outflow", False),
        "129": ("blik", "expense", True),
        "130": ("card", "expense", True),
        "201": ("transfer", "income_consulting", False),
        "202": ("transfer", "income_sale", False),
        "203": ("transfer", "transfer_family", False),
        "204": ("transfer", "expense_tax", True),
        "205": ("pending", "pending_block", False),
        "206": ("card", "expense", True),
        "207": ("transfer", "loan_repayment", False),
        "208": ("transfer", "expense", True),
    }
    ikea = rows["123"]
    assert (ikea.transaction_date, ikea.posting_date) == (datetime.date(2025, 1, 2), datetime.date(2025, 1, 3))
    assert ikea.transaction_amount == Decimal("-1234.56") and ikea.balance_after_transaction == 100.0
    assert ikea.counterparty_details == "ikea kraków pol" and len(ikea.transaction_sk) == 32
    assert rows["205"].transaction_amount is None
    totals = {r._source_file: (r.declared, r.kept, r.difference) for r in built.totals.collect()}
    assert totals == {"jan.csv": (8, 8, 0), "feb.csv": (8, 8, 0)}


def test_facts_and_dimensions(tables):
    parties = {r.counterparty_sk: r.counterparty_details for r in tables["dim_counterparty"].collect()}
    assert parties["unknown"] == "" and "ikea" in parties.values() and "urzad skarbowy" in parties.values()
    expenses = {(r.date_sk, r.category_sk): r for r in tables["fact_expenses"].collect()}
    assert set(expenses) == {
        (20250102, "shopping_furniture"),
        (20250104, "food_groceries"),
        (20250108, "transport_fuel"),
        (20250109, "unclassified"),
        (20240213, "finance_taxes"),
        (20240215, "food_groceries"),
        (20240217, "transport_fuel"),
    }
    assert expenses[20250102, "shopping_furniture"].amount == Decimal("1234.56")
    assert expenses[20250108, "transport_fuel"].counterparty_sk == "unknown"
    income = {r.source: (r.amount, r.year) for r in tables["fact_income"].collect()}
    assert income == {
        "salary": (Decimal("5000.00"), 2025),
        "consulting": (Decimal("1000.00"), 2024),
        "sale": (Decimal("300.00"), 2024),
    }
    days = tables["dim_date"]
    assert days.count() == 366 + 365
    sunday = days.filter("date_sk = 20250615").first()
    assert (sunday.quarter, sunday.month, sunday.day_of_week, sunday.is_weekend) == (2, 6, 7, True)
    assert tables["dim_payment_method"].count() == 7


def test_gate_passes_and_lists_sixteen_checks(tables, built):
    checks = publish.run_checks(tables, built.rows)
    assert len(checks) == 16 and all(c.passed and c.violations == 0 for c in checks)
    more = {c.check_name: c.passed for c in quality.invariant_checks(tables, built.rows).collect()}
    assert more.pop("unclassified below 10%") is False
    assert len(more) == 4 and all(more.values())


BAD_FACT = "transaction_sk string, date_sk int, year int, counterparty_sk string, category_sk string, payment_method_sk string, amount decimal(18,2), currency string"


@pytest.mark.parametrize(
    "table, change, failing",
    [
        ("dim_category", lambda d: d.union(d.limit(1)), "dim_category.category_sk unique"),
        ("dim_date", lambda d: d.filter("year = 2024"), "fact_expenses.date_sk in dim_date"),
        ("dim_date", lambda d: d.filter("year = 2024"), "fact_income dates in dim_date"),
        ("dim_counterparty", lambda d: d.filter("counterparty_sk != 'unknown'"), "fact_expenses.counterparty_sk in dim_counterparty"),
        ("dim_payment_method", lambda d: d.filter("payment_method != 'card'"), "fact_expenses.payment_method_sk in dim_payment_method"),
        ("fact_expenses", lambda d: d.withColumn("category_sk", F.lit(None).cast("string")), "fact_expenses non-null (date_sk, counterparty_sk, category_sk, payment_method_sk)"),
        ("fact_expenses", lambda d: d.withColumn("category_sk", F.lit(None).cast("string")), "fact_expenses.category_sk in dim_category"),
        ("fact_income", lambda d: d.withColumn("date_sk", F.lit(None).cast("int")), "fact_income non-null (date_sk, counterparty_sk)"),
        ("fact_expenses", lambda d: d.withColumn("amount", -F.col("amount")), "fact_expenses.amount >= 0"),
        ("fact_expenses", lambda d: d.limit(3), "reconciliation"),
    ],
)
def test_gate_fails_on_each_broken_input(tables, built, table, change, failing):
    broken = {**tables, table: change(tables[table])}
    with pytest.raises(quality.DataQualityError) as error:
        publish.run_checks(broken, built.rows)
    assert failing + ":" in str(error.value)


def test_gate_fails_on_an_injected_orphan(spark, tables, built, tmp_path):
    bad = spark.createDataFrame(
        [("tx1", 20250101, 2025, "fake_cp", "fake_cat", "card", Decimal("10.00"), "PLN")], BAD_FACT
    )
    with pytest.raises(quality.DataQualityError, match="1 orphan rows"):
        publish.publish({**tables, "fact_expenses": bad}, built.rows, str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()


def test_empty_facts_pass_the_date_check(tables):
    empty = tables["fact_income"].limit(0)
    check = quality.dates_covered(empty, tables["dim_date"], "fact_income").first()
    assert check.passed and check.detail == "empty fact"
    assert dimensions.date_dimension(empty.selectExpr("cast(null as date) d"), "d").count() == 0


def test_invariants_notice_a_broken_sentinel(tables):
    twice = tables["dim_counterparty"].union(tables["dim_counterparty"])
    check = quality.one_sentinel(twice, "counterparty_sk", "unknown", "dim_counterparty").first()
    assert not check.passed and check.violations == 1


def test_pending_spending_is_reconciled_separately(spark, tmp_path):
    rows = [*JANUARY, row("2025-01-20", "Sklep", "blokada", "", "'900", "-5,00")]
    (tmp_path / "a.csv").write_text(export(rows))
    built = silver.build_silver(spark, str(tmp_path), PATTERNS)
    tables = gold.build_gold(built.rows, CATEGORIES, TRAINING)
    assert all(c.passed for c in publish.run_checks(tables, built.rows))


def test_repeated_rows_are_not_multiplied(spark, tmp_path):
    (tmp_path / "a.csv").write_text(export(JANUARY))
    (tmp_path / "b.csv").write_text(export(JANUARY, preamble='"Inny bank";'))
    built = silver.build_silver(spark, str(tmp_path), PATTERNS)
    tables = gold.build_gold(built.rows, CATEGORIES, TRAINING)
    assert tables["fact_expenses"].count() == 8
    assert all(c.passed for c in publish.run_checks(tables, built.rows))
    once = silver.build_silver(spark, str(tmp_path), PATTERNS, drop_duplicates=True)
    assert once.rows.count() == 8


def test_lookback_keeps_both_ends(spark, folder):
    kept = silver.build_silver(spark, str(folder), PATTERNS, lookback_days=3).rows
    assert sorted(str(r.transaction_date) for r in kept.collect()) == [f"2025-01-0{d}" for d in range(6, 10)]


def test_a_lost_row_with_a_real_date_stops_the_run(spark, tmp_path):
    (tmp_path / "a.csv").write_text(export([*JANUARY, row("2025-1-10", "Sklep")]))
    with pytest.raises(silver.DataLossError, match="2025-1-10"):
        silver.build_silver(spark, str(tmp_path), PATTERNS)


def test_losses_that_cancel_out_stop_the_run(spark, tmp_path):
    (tmp_path / "a.csv").write_text(export([*JANUARY, row("2025-1-10", "Sklep")]))
    (tmp_path / "b.csv").write_text(export(FEBRUARY, count=7))
    with pytest.raises(silver.DataLossError, match="1 rows .* 2025-1-10"):
        silver.build_silver(spark, str(tmp_path), PATTERNS)


@pytest.mark.parametrize("space", ["\t", "\u00a0", "\u2003 "])
def test_a_real_date_between_any_white_space_is_not_lost(spark, tmp_path, space):
    (tmp_path / "a.csv").write_text(export([*JANUARY, row(f"{space}2025-01-10{space}", "Sklep")]), encoding="utf-8")
    with pytest.raises(silver.DataLossError, match="2025-01-10"):
        silver.build_silver(spark, str(tmp_path), PATTERNS)


def test_a_count_that_is_too_high_is_only_reported(spark, tmp_path):
    (tmp_path / "a.csv").write_text(export(JANUARY, count=10))
    built = silver.build_silver(spark, str(tmp_path), PATTERNS)
    assert built.totals.first().difference == 2


@pytest.mark.parametrize("change", [{"amount": "12,x"}, {"posted": "2025-13-01"}, {"blocked": "--1"}])
def test_an_unreadable_value_stops_the_run(spark, tmp_path, change):
    (tmp_path / "a.csv").write_text(export([*JANUARY, row("2025-01-10", "Sklep", **change)]))
    with pytest.raises(silver.DataLossError, match="could not be read"):
        silver.build_silver(spark, str(tmp_path), PATTERNS)


def test_missing_pattern_is_an_error(built):
    from ledgermill.operators.rules import add_classification

    with pytest.raises(KeyError):
        add_classification(built.rows, {k: v for k, v in PATTERNS.items() if k != "spouse_like"})


def test_lost_rows_by_key(spark):
    raw = spark.createDataFrame([(1, "2025-01-01"), (2, "2025-1-2"), (3, "footer")], "k int, d string")
    kept = raw.filter("k = 1")
    assert [r.k for r in reconcile.lost_rows(raw, kept, ["k"], "d").collect()] == [2]


def test_colliding_category_keys_are_an_error(spark):
    taxonomy = taxonomy_frame(spark, {"X": ["Foo Bar", "Foo/Bar"]})
    with pytest.raises(dimensions.KeyCollision, match="x_foo_bar"):
        dimensions.require_unique_keys(dimensions.category_dimension(taxonomy), "category_sk")


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_publish_writes_partitioned_facts_and_single_file_dimensions(spark, tables, built, tmp_path, fmt):
    publish.publish(tables, built.rows, str(tmp_path), fmt)
    assert {p.name for p in (tmp_path / "fact_expenses").iterdir() if p.is_dir()} == {"year=2024", "year=2025"}
    assert len(list((tmp_path / "dim_date").glob(f"*.{fmt}"))) == 1
    back = spark.read.option("header", True).format(fmt).load(str(tmp_path / "fact_expenses"))
    assert back.count() == 7 and back.filter("year = 2024").count() == 3


def test_delta_without_its_package_is_a_clear_error(tables, tmp_path):
    with pytest.raises(SinkError, match="Delta"):
        write_table(tables["dim_payment_method"], str(tmp_path / "d"), "delta")
    with pytest.raises(SinkError, match="unknown format"):
        write_table(tables["dim_payment_method"], str(tmp_path / "d"), "orc")


def test_report_is_in_date_order_and_appends(spark, tables, tmp_path):
    report = publish.report_of(tables)
    rows = report.collect()
    assert [r.date for r in rows] == [
        "13/02/2024", "15/02/2024", "17/02/2024", "02/01/2025", "04/01/2025", "08/01/2025", "09/01/2025",
    ]
    assert rows[3].asDict() == {
        "date": "02/01/2025", "category": "Shopping", "subcategory": "Furniture", "blank": "",
        "amount": 1234.56, "description": "ikea",
    }
    for _ in range(2):
        append_report(report, str(tmp_path / "report"))
    back = spark.read.option("header", True).csv(str(tmp_path / "report"))
    assert back.count() == 14 and back.columns == report.columns


def test_a_failed_gate_leaves_what_was_published(spark, tables, built, tmp_path):
    out = tmp_path / "out"
    publish.publish(tables, built.rows, str(out))
    before = sorted(p.name for p in out.rglob("*"))
    broken = {**tables, "dim_date": tables["dim_date"].filter("year = 2024")}
    with pytest.raises(quality.DataQualityError) as error:
        publish.publish(broken, built.rows, str(out))
    assert {check.check_name for check in error.value.failures} >= {"fact_expenses.date_sk in dim_date"}
    assert sorted(p.name for p in out.rglob("*")) == before and [p.name for p in tmp_path.iterdir()] == ["out"]


def test_run_returns_and_logs_rejected_files(spark, tmp_path, caplog):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "good.txt").write_bytes(export(JANUARY, count=9).encode("iso-8859-2"))
    (raw / "bad.txt").write_text("no header\n")
    (raw / "other.csv").write_text(export(FEBRUARY))
    with caplog.at_level("INFO", logger="ledgermill.plans.publish"):
        done = publish.run(
            spark, str(raw), str(tmp_path / "out"), PATTERNS, CATEGORIES, TRAINING, pattern="*.txt", fallback="iso-8859-2"
        )
    assert {r.source_file: r.reason for r in done.files.collect()} == {
        "good.txt": None, "bad.txt": "header or row count not found",
    }
    assert [r.difference for r in done.totals.collect()] == [1]
    assert "rejected bad.txt: header or row count not found" in caplog.text
    assert "good.txt: declared and kept rows differ by 1" in caplog.text and "1 of 2 files accepted" in caplog.text
    names = {r.counterparty_details for r in done.tables["dim_counterparty"].collect()}
    assert "zupelnie nieznany" in names


def test_run_from_folder_to_tables(spark, folder, tmp_path):
    publish.run(spark, str(folder), str(tmp_path / "out"), PATTERNS, CATEGORIES, TRAINING)
    assert spark.read.parquet(str(tmp_path / "out" / "dim_category")).count() == 10
    publish.run(
        spark, str(folder), str(tmp_path / "none"), PATTERNS, CATEGORIES, TRAINING, report=str(tmp_path / "rep")
    )
    assert spark.read.parquet(str(tmp_path / "rep")).count() == 7 and not (tmp_path / "none").exists()


def test_only_the_columns_that_gold_reads_are_written(built, monkeypatch):
    written = {}

    def staged(df, name):
        written[name] = df.columns
        return stage(df, name)

    monkeypatch.setattr(gold, "stage", staged)
    narrow = gold.build_gold(built.rows.select(*gold.GOLD_INPUT), CATEGORIES, TRAINING)
    assert written["enriched"] == gold.ENRICHED
    wide = gold.build_gold(built.rows, CATEGORIES, TRAINING)
    for name, df in wide.items():
        assert narrow[name].columns == df.columns
        assert sorted(map(str, narrow[name].collect())) == sorted(map(str, df.collect()))
