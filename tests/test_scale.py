import pytest
from pyspark.sql import DataFrameWriter

from ledgermill import scale
from ledgermill.operators import naming
from ledgermill.scale import attach, fits_broadcast, spread_join


def test_attach_gives_the_same_rows_by_broadcast_and_by_salted_shuffle(spark):
    rows = spark.range(20_000).selectExpr(
        "id", "case when id % 3 = 0 then 'hot' when id % 3 = 1 then null else concat('k', id % 500) end as k"
    )
    table = rows.select("k").distinct().filter("k is not null and k != 'k5'").selectExpr("k", "length(k) as n")
    for how in ("left", "inner"):
        small = attach(rows, table, ["k"], how)
        large = attach(rows, table, ["k"], how, spread=["id"], limit=1)
        plain = rows.join(table, ["k"], how)
        assert large.columns == small.columns == plain.columns
        assert large.exceptAll(plain).isEmpty() and plain.exceptAll(large).isEmpty()
        assert small.count() == plain.count()
    plan = attach(rows, table, ["k"], spread=["id"], limit=1)._jdf.queryExecution().toString()
    assert "_salt" in plan


def test_fits_broadcast_measures_rows_and_bytes(spark):
    assert fits_broadcast(spark.range(10), 10)
    assert not fits_broadcast(spark.range(11), 10)
    assert fits_broadcast(spark.range(0))
    long = spark.range(4).selectExpr("id", "repeat('x', 1000) as s", "array(repeat('y', 1000)) as a")
    assert fits_broadcast(long, 10, 10_000)
    assert not fits_broadcast(long, 10, 8_000)
    assert fits_broadcast(long.select("id", "s"), 10, 5_000)


def test_spread_join_is_the_inner_join(spark):
    rows = spark.range(2_000).selectExpr("id", "id % 7 as k")
    table = spark.range(40).selectExpr("id % 10 as k", "id as t")
    spread = spread_join(rows, table, ["k"], ["id"])
    plain = rows.join(table, ["k"])
    assert spread.exceptAll(plain).isEmpty() and plain.exceptAll(spread).isEmpty()


def test_staged_tables_are_written_under_the_method_limit(spark, monkeypatch):
    seen, write = [], DataFrameWriter.parquet
    before = spark.conf.get(scale.METHOD_LIMIT)

    def recorded(self, *args, **kwargs):
        seen.append(spark.conf.get(scale.METHOD_LIMIT))
        return write(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", recorded)
    assert scale.stage(spark.range(3), "few").count() == 3
    assert seen == ["8000"] and spark.conf.get(scale.METHOD_LIMIT) == before
    with pytest.raises(ZeroDivisionError), scale.compiled(spark):
        raise ZeroDivisionError
    assert spark.conf.get(scale.METHOD_LIMIT) == before


def test_counted_keys_save_a_pass_over_the_rows(spark, monkeypatch):
    """Rows, with empty and missing texts, are not read again to find the texts that many of them hold."""
    text = "case id % 4 when 0 then 'hot' when 1 then '' when 2 then null else concat('k', id) end as t"
    rows = spark.range(20_000).selectExpr("id", text)
    texts = scale.stage(naming.counted_texts(rows, ["t"]), "texts")
    hits = texts.selectExpr("text_id", "length(text) as size")
    plans, stage = [], scale.stage

    def recorded(df, name):
        plans.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
        return stage(df, name)

    monkeypatch.setattr(scale, "stage", recorded)
    got = naming.attach_hits(rows, "t", hits, "hit", ["id"], False, texts).selectExpr("id", "t", "hit.size as size")
    assert [name for name, _ in plans] == ["hot-keys"] and "Range" not in plans[0][1]
    plain = rows.selectExpr("id", "t", "case when t != '' then length(t) end as size")
    assert got.exceptAll(plain).isEmpty() and plain.exceptAll(got).isEmpty()
