"""Versioned publishing, incremental loads, streams and monthly reports."""

import pytest
from pyspark.sql import functions as F

from ledgermill.operators import facts, quality
from ledgermill.plans import incremental, publish, silver
from ledgermill.plans.gold import build_gold
from ledgermill.sinks import versions
from ledgermill.sources import exports
from ledgermill.streaming import transactions
from tests.samples import CATEGORIES, FEBRUARY, JANUARY, PATTERNS, TRAINING, export, row


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("in")
    (folder / "jan.csv").write_text(export(JANUARY), encoding="utf-8")
    (folder / "feb.csv").write_text(export(FEBRUARY), encoding="cp1250")
    return silver.build_silver(spark, str(folder), PATTERNS)


@pytest.fixture(scope="module")
def tables(built):
    return build_gold(built.rows, CATEGORIES, TRAINING)


def star(found):
    return {name: sorted(map(str, df.collect())) for name, df in found.items()}


def test_readers_see_whole_versions(spark, tables, built, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    with pytest.raises(versions.NoVersionError):
        versions.read_version(spark, out)
    publish.publish_version(tables, built.rows, out)
    first = star(versions.read_version(spark, out))
    assert set(first) == set(tables) and len(first["fact_expenses"]) == 7
    # A failed gate leaves no trace.
    before = sorted(p.name for p in (tmp_path / "out").rglob("*"))
    with pytest.raises(quality.DataQualityError):
        publish.publish_version({**tables, "dim_date": tables["dim_date"].filter("year = 2024")}, built.rows, out)
    assert sorted(p.name for p in (tmp_path / "out").rglob("*")) == before
    # A writer that stops at any table, or just before the pointer moves, changes nothing that readers see.
    fewer = {**tables, "dim_counterparty": tables["dim_counterparty"].withColumn("counterparty_details", F.upper("counterparty_details"))}
    write = publish._write
    for stop in [*fewer, None]:
        def failing(df, name, path, fmt, stop=stop):
            if name == stop:
                raise OSError("the machine is gone")
            write(df, name, path, fmt)

        with monkeypatch.context() as patch:
            patch.setattr(publish, "_write", failing)
            if stop is None:
                patch.setattr(publish, "commit_version", lambda *a: (_ for _ in ()).throw(OSError("the machine is gone")))
            with pytest.raises(OSError):
                publish.publish_version(fewer, built.rows, out)
        assert star(versions.read_version(spark, out)) == first
    # The next one is seen as a whole; the one before can still be read, older ones go.
    publish.publish_version(fewer, built.rows, out)
    second = star(versions.read_version(spark, out))
    assert second["dim_counterparty"] != first["dim_counterparty"] and second["fact_expenses"] == first["fact_expenses"]
    kept = versions.kept_versions(spark, out)
    assert len(kept) == 2 and star(versions.read_version(spark, out, kept[1])) == first
    oldest = kept[1]
    publish.publish_version(tables, built.rows, out)
    assert oldest not in versions.kept_versions(spark, out)
    assert not (tmp_path / "out" / "versions" / oldest).exists()
    assert star(versions.read_version(spark, out)) == first


def test_run_keeps_versions(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "jan.csv").write_text(export(JANUARY), encoding="utf-8")
    for _ in range(2):
        done = publish.run(spark, str(tmp_path / "in"), str(tmp_path / "out"), PATTERNS, CATEGORIES, TRAINING, keep_versions=1)
    assert len(versions.kept_versions(spark, str(tmp_path / "out"))) == 1 == len(list((tmp_path / "out" / "versions").iterdir()))
    assert done.tables["fact_expenses"].count() == 4


def test_a_profile_gives_the_same_checks_and_reads_the_fact_once(tables, built):
    expenses, dates = tables["fact_expenses"], tables["dim_date"]
    broken = expenses.withColumns(
        {"category_sk": F.when(F.col("amount") > 40, F.col("category_sk")), "amount": F.when(F.col("amount") < 100, -F.col("amount")).otherwise(F.col("amount"))}
    )
    keys = ["date_sk", "counterparty_sk", "category_sk", "payment_method_sk"]
    edges = [("category_sk", tables["dim_category"], "dim_category"), ("date_sk", dates.filter("year = 2024"), "dim_date")]
    for fact in (expenses, broken, expenses.filter("false")):
        profile = quality.FactProfile(fact, keys, "amount", "f")
        pairs = [
            (profile.no_orphans(edges), quality.no_orphans(fact, edges, "f")),
            (profile.no_nulls(), quality.no_nulls(fact, keys, "f")),
            (profile.non_negative(), quality.non_negative(fact, "amount", "f")),
            (profile.dates_covered(dates), quality.dates_covered(fact, dates, "f")),
            (profile.reconciled(built.rows), quality.reconciled(fact, built.rows)),
        ]
        for got, want in pairs:
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    plan = quality.FactProfile(expenses, keys, "amount", "f").rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and "fact-profile" in plan


def test_monthly_totals_and_calendar(tables):
    found = facts.monthly_totals(tables["fact_expenses"], tables["dim_date"], tables["dim_category"]).collect()
    by_level = {level: [r for r in found if r.level == level] for level in (0, 1, 3, 7)}
    assert len(by_level[7]) == 1 and by_level[7][0].n == 7 and len(by_level[3]) == 2
    total = by_level[7][0].amount
    assert all(sum(r.amount for r in rows) == pytest.approx(total) for rows in by_level.values())
    wide = facts.category_calendar(tables["fact_expenses"], tables["dim_date"], tables["dim_category"]).collect()
    assert sum(r[f"m{m}"] for r in wide for m in range(1, 13)) == pytest.approx(total)
    assert next(r for r in wide if (r.year, r.category) == (2025, "Shopping")).m1 == pytest.approx(1234.56)


def rows_of(spark, target):
    found = incremental.read_rows(spark, target).drop("_ingested_at", "_line_block", "_line_seq")
    return sorted(map(str, found.select(sorted(found.columns)).collect()))


def test_loads_of_new_files_equal_one_load(spark, tmp_path, monkeypatch):
    folder, target, whole = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "whole")
    folder.mkdir()
    (folder / "jan.csv").write_text(export(JANUARY), encoding="utf-8")
    done = incremental.load_new(spark, str(folder), target, PATTERNS)
    assert (done.found, done.read, done.loaded, done.years) == (1, 1, 1, [2025])
    first = rows_of(spark, target)
    assert incremental.load_new(spark, str(folder), target, PATTERNS).read == 0 and rows_of(spark, target) == first
    # A new file of another year, a copy under another name, and rows of the first year.
    (folder / "feb.csv").write_text(export(FEBRUARY), encoding="cp1250")
    (folder / "jan copy.csv").write_text(export(JANUARY), encoding="utf-8")
    more = [row("2025-03-01", "IKEA", "x", txn="'900", amount="-1,00")]
    (folder / "mar.csv").write_text(export(more), encoding="utf-8")
    january = tmp_path / "out" / "rows" / "year=2025"
    stamps = {p.name for p in january.iterdir()}
    # The machine stops after the rows are written and before the files are listed.
    with monkeypatch.context() as patch:
        patch.setattr(incremental.F, "current_timestamp", lambda: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            incremental.load_new(spark, str(folder), target, PATTERNS)
    done = incremental.load_new(spark, str(folder), target, PATTERNS)
    assert (done.found, done.read, done.loaded, done.years) == (4, 3, 2, [2024, 2025])
    assert {p.name for p in january.iterdir()} != stamps
    incremental.load_new(spark, str(folder), whole, PATTERNS)
    assert rows_of(spark, target) and len(rows_of(spark, target)) == len(JANUARY) + len(FEBRUARY) + 1
    drop_names = lambda rows: sorted(r.replace("jan copy.csv", "jan.csv") for r in rows)  # noqa: E731 - either name may stand for a copy
    assert drop_names(rows_of(spark, target)) == drop_names(rows_of(spark, whole))
    # A changed file replaces its rows; a year that loses its last row goes, others are not written.
    (folder / "feb.csv").write_text(export([row("2023-02-10", "Lidl", "", txn="'901", amount="-2,00")]), encoding="utf-8")
    done = incremental.load_new(spark, str(folder), target, PATTERNS)
    assert done.years == [2023, 2024] and done.loaded == 1
    assert {r.year for r in incremental.read_rows(spark, target).select("year").distinct().collect()} == {2023, 2025}
    assert len(rows_of(spark, target)) == len(JANUARY) + 2


def test_stream_equals_batch(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "jan.csv").write_text(export(JANUARY), encoding="utf-8")
    (folder / "feb.csv").write_text(export(FEBRUARY), encoding="utf-8")
    raw = exports.read_exports(spark, str(folder)).rows.select(*exports.BUSINESS_COLUMNS)
    raw = raw.filter(F.col("transaction_date").startswith("20"))  # without the footers
    assert raw.count() == len(JANUARY) + len(FEBRUARY)
    arriving, out, checkpoint = (str(tmp_path / n) for n in ("arriving", "out", "checkpoint"))
    january, february = raw.filter("transaction_date >= '2025'"), raw.filter("transaction_date < '2025'")
    february.coalesce(1).write.parquet(arriving)
    assert transactions.run_available(spark, arriving, out, checkpoint, PATTERNS, "400 days", 1) == 0
    january.coalesce(1).write.mode("append").parquet(arriving)
    january.limit(3).coalesce(1).write.mode("append").parquet(arriving)  # repeated
    february.coalesce(1).write.mode("append").parquet(arriving)  # late and repeated
    assert transactions.run_available(spark, arriving, out, checkpoint, PATTERNS, "400 days", 1) == 0
    got = transactions.read_stream_output(spark, out)
    want = silver.silver_rows(raw, PATTERNS).dropDuplicates(["transaction_sk"]).select(got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == len(JANUARY) + len(FEBRUARY)
    assert transactions.run_available(spark, arriving, out, checkpoint, PATTERNS, "400 days") == 0  # nothing new
    assert got.count() == transactions.read_stream_output(spark, out).count()


def test_stream_reports_rows_that_are_too_late_and_stops_on_bad_batches(spark, tmp_path):
    arriving, out, checkpoint = (str(tmp_path / n) for n in ("arriving", "out", "checkpoint"))

    def arrive(*days, amount="-1,00"):
        names = exports.BUSINESS_COLUMNS
        rows = [tuple({"transaction_date": d, "transaction_amount": amount, "transaction_id": str(k)}.get(c) for c in names) for k, d in enumerate(days)]
        spark.createDataFrame(rows, transactions.RAW_SCHEMA).coalesce(1).write.mode("append").parquet(arriving)

    arrive("2025-06-01", "2025-06-02")
    transactions.run_available(spark, arriving, out, checkpoint, PATTERNS, "10 days")
    arrive("2025-01-01", "2025-06-03")
    with pytest.raises(silver.DataLossError, match="1 rows came more than 10 days late"):
        transactions.run_available(spark, arriving, out, checkpoint, PATTERNS, "10 days")
    before = transactions.read_stream_output(spark, out).count()
    arrive("2025-06-04", amount="a lot")
    with pytest.raises(Exception, match="could not be read"):
        transactions.run_available(spark, arriving, out, checkpoint, PATTERNS, "10 days")
    assert transactions.read_stream_output(spark, out).count() == before
