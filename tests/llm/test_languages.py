
import pytest
from pyspark.sql import functions as F

from ledgermill.llm import languages
from tests.llm.samples import awkward, empty, frame, row

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_held_out_accuracy(spark, docs):
    """Every second row has no declaration, so its language must come from its text and host."""
    hidden = docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, F.col("lang"))).withColumn("language", F.lit("x"))
    got = languages.identify_languages(hidden)
    assert got.columns == [*hidden.columns, "language_", "confidence", "rejected"]
    rows = got.drop("lang").join(docs.select("doc_id", "lang"), "doc_id").filter("doc_id % 2 = 1").collect()
    assert sum(r.language_ == r.lang for r in rows) >= 0.97 * len(rows)
    assert sum(r.rejected for r in rows) <= 0.02 * len(rows)


def test_declarations_and_hosts_tip_unclear_texts(spark, docs):
    base = docs.select("doc_id", "text", "lang", "source").collect()
    rows = [row(r.doc_id, r.text, r.lang, f"www.{r.lang}.example.{r.lang}") for r in base]
    rows += [row(10_000, "a", "fr", "www.fr.example.fr"), row(10_001, "a", "es", "www.es.example.es")]
    got = {r.doc_id: r for r in languages.identify_languages(frame(spark, rows)).filter("doc_id >= 10000").collect()}
    assert (got[10_000].language_, got[10_001].language_) == (None, None)  # one letter makes no trigram
    rows[-2:] = [row(10_000, "le la", "fr", "www.fr.example.fr"), row(10_001, "le la", "es", "www.es.example.es")]
    got = {r.doc_id: r for r in languages.identify_languages(frame(spark, rows)).filter("doc_id >= 10000").collect()}
    assert (got[10_000].language_, got[10_001].language_) == ("fr", "es")


def test_pages_by_markup_and_address(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    html, host = F.col("html"), languages.host_of(F.col("url"))
    got = languages.identify_languages(pages, "html", languages.declared_in(html), host, key="page_id").collect()
    assert len(got) == pages.count() and not any(r.rejected for r in got)
    assert all(r.language in r.html[:60] for r in got)


def test_awkward_rows(spark, docs):
    rows = [row(r.doc_id + 100, r.text, r.lang, r.source) for r in docs.collect()] + awkward() + [row(3, "one two")]
    got = languages.identify_languages(frame(spark, rows)).filter("doc_id < 100").collect()
    assert len(got) == 10 and all(0 <= r.confidence <= 1 for r in got if r.confidence is not None)
    without = {r.doc_id for r in got if r.language_ is None}
    assert {0, 1, 2, 8} <= without and all(r.rejected == (r.language_ is None) for r in got)
    kept = languages.kept_languages(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns and kept.filter("doc_id in (0, 1, 2, 8)").count() == 0


def test_texts_are_scored_once_per_pass(spark, docs, monkeypatch):
    plans, staged = {}, languages.stage

    def recorded(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return staged(df, name)

    monkeypatch.setattr(languages, "stage", recorded)
    rows = [row(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]
    rows += [row(10_000, None, "en", "a host without a letter"), row(10_001, "12", "en", "another")]
    got = {r.doc_id: r for r in languages.identify_languages(frame(spark, rows)).collect()}
    assert plans["language-counts"].count("ArrowEvalPython") == 1
    assert len(got) == len(rows) and all(got[k].rejected and got[k].language_ is None for k in (10_000, 10_001))


def test_empty_and_undeclared_tables(spark):
    assert languages.identify_languages(empty(spark)).collect() == []
    undeclared = languages.identify_languages(frame(spark, [row(1, "some text", None)] * 9)).collect()
    assert [r.rejected for r in undeclared] == [True] * 9


def test_addresses_and_markup(spark):
    urls = ["https://user@Www.Example.FR:80/x", "//a.b.de/", "ftp://localhost/x", "no address", None]
    rows = spark.createDataFrame([(u,) for u in urls], "u string").select(languages.host_of(F.col("u")).alias("h"))
    assert [r.h for r in rows.collect()] == ["www.example.fr", "a.b.de", "localhost", "", None]
    suffix = rows.select(languages.suffix_of(F.col("h")).alias("s")).collect()
    assert [r.s for r in suffix] == ["fr", "de", "", "", None]
    html = ['<!doctype html><HTML class=a lang="pt-BR">', "<html lang=de>", "<html><p lang=fr>", None]
    found = spark.createDataFrame([(h,) for h in html], "h string").select(languages.declared_in(F.col("h")).alias("d"))
    assert [r.d for r in found.collect()] == ["pt", "de", None, None]


def test_rows_of_languages_that_were_not_learned_are_kept(spark, docs):
    greek = "Το γρήγορο καφέ αλεπού πηδά πάνω από τον τεμπέλη σκύλο "
    rows = [row(r.doc_id + 100, r.text, r.lang, r.source) for r in docs.collect()]
    rare = [row(1, greek * 5, "el", "h"), row(2, greek * 5, None, "h"), row(3, "123 !", "el", "h"), row(4, None, "el", "h")]
    got = {r.doc_id: r for r in languages.identify_languages(frame(spark, rows + rare)).filter("doc_id < 100").collect()}
    assert (got[1].language_, got[1].confidence, got[1].rejected) == ("el", None, False)
    assert all(got[k].rejected and got[k].language_ is None for k in (2, 3, 4))
    few = {r.doc_id: r for r in languages.identify_languages(frame(spark, rare)).collect()}  # nothing learned
    assert [(few[k].language_, few[k].rejected) for k in (1, 2, 3, 4)] == [("el", False), *[(None, True)] * 3]
    assert [r.doc_id for r in languages.kept_languages(frame(spark, rare)).collect()] == [1]
