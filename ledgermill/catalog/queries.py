"""One query per operator, over whole driver tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.catalog import ledger
from ledgermill.catalog.ledger import ALIASES, CATEGORIES, PATTERNS, TRAINING, read
from ledgermill.functions import keys, parsing, text
from ledgermill.operators import dimensions, facts, matching, naming, quality, reconcile
from ledgermill.operators.vocabulary import (
    keyword_labels,
    name_candidates,
    repeated_keywords,
    taxonomy_frame,
    training_frame,
    unknown_subcategories,
)
from ledgermill.plans.gold import GOLD_INPUT, build_gold
from ledgermill.plans.incremental import load_new, read_rows
from ledgermill.plans.publish import publish_version, report_of
from ledgermill.plans.silver import silver_rows, strict_casts, type_rows
from ledgermill.scale import attach, folder_bytes, shared_dir, stage, widen
from ledgermill.sinks.tables import append_report, write_table
from ledgermill.sinks.versions import read_version
from ledgermill.sources import exports
from ledgermill.streaming import transactions

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Keywords looked for in conversation texts.
TEXT_KEYWORDS = [
    "avec", "nicht", "thention", "the of", "para los", "entrecion", "ununter",
    "eauxment", "is", "verschiedene", "of the and", "recherche",
]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def text_vocabulary(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(enumerate(TEXT_KEYWORDS)), "pos bigint, keyword string")


def labels(spark: SparkSession) -> DataFrame:
    return keyword_labels(taxonomy_frame(spark, CATEGORIES), training_frame(spark, TRAINING))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_rows(ledger.spark_ledger(spark, sf_dir), PATTERNS)


def staged_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(silver(spark, sf_dir), "silver")


def star(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    rows = stage(silver(spark, sf_dir).select(*GOLD_INPUT), "silver")  # written columns are not pruned by later readers
    return rows, build_gold(rows, CATEGORIES, TRAINING, ALIASES)


def as_double(df: DataFrame) -> DataFrame:
    decimals = [f.name for f in df.schema if f.dataType.typeName() == "decimal"]
    return df.withColumns({c: F.col(c).cast("double") for c in decimals})


# Reading exports


@query
def content_hash(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("hash"))


@query
def export_headers(spark, sf_dir):
    profile = exports.profile_files(ledger.spark_lines(spark, sf_dir))
    return profile.select(
        "source_file",
        F.col("header_at.seq").alias("header_seq"),
        "declared",
        "charset",
        F.size("names").alias("n_columns"),
    )


@query
def export_header_names(spark, sf_dir):
    profile = exports.profile_files(ledger.spark_lines(spark, sf_dir))
    return profile.select("source_file", F.posexplode("names").alias("at", "name"))


@query
def export_rows(spark, sf_dir):
    rows = exports.parse_lines(ledger.spark_lines(spark, sf_dir)).rows
    return rows.select(
        "_source_file", F.col("_line_seq").alias("o_orderkey"), *exports.BUSINESS_COLUMNS
    )


# Small files are read in splits of this size, larger ones in about so many splits in all.
LEAST_SPLIT_BYTES, MOST_SPLIT_BYTES, MOST_SPLITS = 64 * 1024, 128 * 1024 * 1024, 64


def read_files(spark: SparkSession, sf_dir: str) -> exports.Export:
    """The nations' export files written to the shared folder and read back, in several splits each."""
    folder = f"{shared_dir(spark).rstrip('/')}/exports-{uuid.uuid4().hex}"
    ledger.write_files(spark, sf_dir, folder)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    size = folder_bytes(spark, folder)
    if size < MOST_SPLITS * MOST_SPLIT_BYTES:  # beyond that the session's own splits are many enough
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(max(LEAST_SPLIT_BYTES, size // MOST_SPLITS)))
    try:
        return exports.read_exports(spark, folder, "nation_*.csv")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@query
def export_file_rows(spark, sf_dir):
    return read_files(spark, sf_dir).rows.select("_source_file", *exports.BUSINESS_COLUMNS)


@query
def export_files(spark, sf_dir):
    """Charset, control total and provenance of each file; typing passes the provenance on."""
    read_back = read_files(spark, sf_dir)
    typed = type_rows(read_back.rows).groupBy("_source_file").agg(
        F.count(F.lit(1)).alias("typed"), F.max("_hash").alias("hash"), F.count("_ingested_at").alias("stamped")
    )
    files = read_back.files.join(typed, F.col("source_file") == F.col("_source_file"))
    return files.select(
        "source_file", "charset", "declared", "accepted", "typed", "stamped", F.size("names").alias("n_columns"),
        F.when(F.col("charset") == "utf-8", F.col("hash")).alias("hash"),
    )


@query
def export_quarantine(spark, sf_dir):
    return exports.parse_lines(ledger.spark_lines(spark, sf_dir)).quarantine()


@query
def export_control_totals(spark, sf_dir):
    export = exports.parse_lines(ledger.spark_lines(spark, sf_dir))
    kept = type_rows(export.rows)
    declared = export.files.filter("accepted").select(F.col("source_file").alias("_source_file"), "declared")
    return reconcile.control_totals(kept, declared, "_source_file")


@query
def rows_by_sql_view(spark, sf_dir):
    ledger.spark_ledger(spark, sf_dir).createOrReplaceTempView("bronze_table")
    return spark.sql(
        "SELECT _source_file, transaction_currency, count(*) AS n FROM bronze_table "
        "GROUP BY _source_file, transaction_currency"
    )


@query
def batches_by_name(spark, sf_dir):
    raw = ledger.spark_ledger(spark, sf_dir)
    settled, other = raw.filter("transaction_id is not null"), raw.filter("transaction_id is null")
    both = settled.unionByName(other.drop("transaction_id"), allowMissingColumns=True)
    return both.groupBy("_source_file").agg(
        F.count(F.lit(1)).alias("n"), F.count("transaction_id").alias("n_ids")
    )


# Typing and classification


@query
def lenient_dates(spark, sf_dir):
    raw = ledger.spark_ledger(spark, sf_dir)
    return raw.select(
        F.col("_line_seq").alias("o_orderkey"),
        parsing.lenient_date("transaction_date").alias("transaction_date"),
        parsing.is_real_date("transaction_date").alias("is_real"),
    )


@query
def typed_rows(spark, sf_dir):
    typed = as_double(type_rows(ledger.spark_ledger(spark, sf_dir)))
    return typed.withColumnRenamed("_line_seq", "o_orderkey").drop("_ingested_at", "_hash", "_line_block")


@query
def content_keys(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem")
    parts = [F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")]
    return lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", keys.content_key(parts).alias("line_sk")
    )


@query
def rejected_casts(spark, sf_dir):
    raw = ledger.spark_ledger(spark, sf_dir)
    casts = {**strict_casts(), "transaction_date": parsing.exact_date("transaction_date")}
    return reconcile.rejected_casts(raw, casts)


@query
def classified_rows(spark, sf_dir):
    return silver(spark, sf_dir).select(
        F.col("_line_seq").alias("o_orderkey"), "payment_method", "event_type", "include_in_expense"
    )


@query
def latest_events(spark, sf_dir):
    events = read(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return reconcile.lookback(events, "day", 7).select("event_id", "day", "event_type", "value")


@query
def lost_rows(spark, sf_dir):
    raw = ledger.spark_ledger(spark, sf_dir)
    lost = reconcile.lost_rows(raw, type_rows(raw), ["_line_block", "_line_seq"], "transaction_date")
    return lost.select(F.col("_line_seq").alias("o_orderkey"), "transaction_date")


@query
def unparsed_dates(spark, sf_dir):
    raw = ledger.spark_ledger(spark, sf_dir)
    lost = reconcile.unparsed_dates(raw, "transaction_date", parsing.lenient_date("transaction_date"))
    return lost.groupBy("_source_file").agg(F.count(F.lit(1)).alias("n"))


@query
def single_lines(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem")
    parts = [F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber")]
    kept = reconcile.drop_repeats(lines.withColumn("line_sk", keys.content_key(parts)), "line_sk")
    return kept.select("line_sk", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


# Text and fuzzy matching


@query
def clean_documents(spark, sf_dir):
    documents = widen(read(spark, sf_dir, "documents"), "doc_id")
    return documents.select("doc_id", text.clean_name("text").alias("cleaned"))


@query
def plain_documents(spark, sf_dir):
    stripped = text.strip_diacritics(F.lower("text"))
    return widen(read(spark, sf_dir, "documents"), "doc_id").select("doc_id", stripped.alias("stripped"))


@query
def clean_parties(spark, sf_dir):
    raw = ledger.spark_ledger(spark, sf_dir)
    return raw.select(
        F.col("_line_seq").alias("o_orderkey"), text.clean_name("counterparty_details").alias("cleaned")
    )


@query
def canonical_names(spark, sf_dir):
    named = naming.add_canonical(
        staged_silver(spark, sf_dir),
        "counterparty_details",
        name_candidates(spark, ALIASES, labels(spark)),
        "canonical",
        ["_line_block", "_line_seq"],
    )
    return named.groupBy("counterparty_details", "canonical").agg(F.count(F.lit(1)).alias("n"))


def part_taxonomy(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Part types and brands as a taxonomy, part names as keywords of their brand."""
    parts = read(spark, sf_dir, "part")
    taxonomy = parts.select(
        F.col("p_type").alias("category"), F.col("p_brand").alias("subcategory"), F.col("p_partkey").alias("pos")
    )
    training = parts.select(
        F.col("p_brand").alias("subcategory"), F.col("p_name").alias("keyword"), F.col("p_partkey").alias("pos")
    )
    return taxonomy, training


@query
def vocabulary_labels(spark, sf_dir):
    return keyword_labels(*part_taxonomy(spark, sf_dir))


@query
def vocabulary_repeats(spark, sf_dir):
    return repeated_keywords(part_taxonomy(spark, sf_dir)[1])


@query
def vocabulary_unknown(spark, sf_dir):
    taxonomy, training = part_taxonomy(spark, sf_dir)
    segments = read(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("subcategory"))
    return unknown_subcategories(taxonomy, training.select("subcategory").unionByName(segments))


@query
def token_set_pairs(spark, sf_dir):
    parts, texts = read(spark, sf_dir, "part"), read(spark, sf_dir, "conversations")
    vocabulary = parts.groupBy(F.col("p_name").alias("keyword")).agg(F.min("p_partkey").alias("pos"))
    named = parts.select(F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("text"))
    both = named.unionByName(texts.select("text"))
    distinct = matching.distinct_texts(both, ["text"])
    scored = matching.token_set_join(matching.tokenise(distinct), vocabulary)
    best = scored.groupBy("text_id", "keyword").agg(F.max("score").alias("score"))
    return best


@query
def word_matches(spark, sf_dir):
    texts = read(spark, sf_dir, "conversations")
    words = texts.select(F.explode(text.word_tokens(F.col("text"))).alias("string")).distinct()
    return matching.ratio_join(words, text_vocabulary(spark)).distinct().drop("pos")


@query
def best_keywords(spark, sf_dir):
    texts = matching.distinct_texts(read(spark, sf_dir, "conversations"), ["text"])
    return matching.best_keywords(matching.tokenise(texts), text_vocabulary(spark))


@query
def row_categories(spark, sf_dir):
    rows = naming.add_category(
        staged_silver(spark, sf_dir), "counterparty_details", "description", labels(spark), ["_line_block", "_line_seq"]
    )
    return rows.select(F.col("_line_seq").alias("o_orderkey"), "category", "subcategory")


@query
def category_map(spark, sf_dir):
    rows = naming.add_category(
        staged_silver(spark, sf_dir), "counterparty_details", "description", labels(spark), ["_line_block", "_line_seq"]
    )
    taxonomy = taxonomy_frame(spark, CATEGORIES)
    mapped = naming.category_map(rows, dimensions.category_dimension(taxonomy), "_line_seq")
    return mapped.withColumnRenamed("_line_seq", "o_orderkey")


@query
def unclassified_rate(spark, sf_dir):
    return naming.unclassified_rate(star(spark, sf_dir)[1]["fact_expenses"])


# Dimensions


@query
def date_keys(spark, sf_dir):
    return read(spark, sf_dir, "orders").select("o_orderkey", keys.date_key(F.col("o_orderdate")).alias("date_sk"))


@query
def calendar(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))
    return dimensions.date_dimension(orders, "day")


@query
def method_groups(spark, sf_dir):
    joined = facts.resolve_key(
        silver(spark, sf_dir), dimensions.method_dimension(spark), ["payment_method"], "payment_category"
    )
    return joined.groupBy("payment_method", "payment_category").agg(F.count(F.lit(1)).alias("n"))


@query
def party_dimension(spark, sf_dir):
    names = silver(spark, sf_dir).select(text.clean_name("counterparty_details").alias("name"))
    return dimensions.party_dimension(names, "name")


@query
def category_dimension(spark, sf_dir):
    taxonomy = read(spark, sf_dir, "part").selectExpr("p_type as category", "concat(p_type, ' ', p_brand) as subcategory")
    return dimensions.category_dimension(taxonomy.distinct())


@query
def category_key_collisions(spark, sf_dir):
    parts = read(spark, sf_dir, "part")
    spaced = parts.selectExpr("p_brand as category", "p_name as subcategory")
    slashed = parts.selectExpr("p_brand as category", "replace(p_name, 'red ', 'red/') as subcategory")
    keyed = dimensions.category_dimension(spaced.union(slashed).distinct())
    return dimensions.key_collisions(keyed, "category_sk")


# Facts


@query
def party_keys(spark, sf_dir):
    rows = silver(spark, sf_dir).withColumn("canonical", text.clean_name("counterparty_details"))
    parties = dimensions.party_dimension(rows, "canonical").withColumnRenamed("counterparty_details", "canonical")
    keyed = facts.resolve_key(rows, parties, ["canonical"], "counterparty_sk", ["_line_block", "_line_seq"])
    return keyed.select(F.col("_line_seq").alias("o_orderkey"), "counterparty_sk")


@query
def fact_expenses(spark, sf_dir):
    return as_double(star(spark, sf_dir)[1]["fact_expenses"])


@query
def fact_income(spark, sf_dir):
    return as_double(star(spark, sf_dir)[1]["fact_income"])


def _sizes_of(tables: dict[str, DataFrame]) -> DataFrame:
    sizes = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n")) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, sizes)


@query
def star_sizes(spark, sf_dir):
    return _sizes_of(star(spark, sf_dir)[1])


@query
def expense_report(spark, sf_dir):
    return report_of(star(spark, sf_dir)[1])


@query
def monthly_totals(spark, sf_dir):
    tables = star(spark, sf_dir)[1]
    return facts.monthly_totals(tables["fact_expenses"], tables["dim_date"], tables["dim_category"])


@query
def category_calendar(spark, sf_dir):
    tables = star(spark, sf_dir)[1]
    return facts.category_calendar(tables["fact_expenses"], tables["dim_date"], tables["dim_category"])


@query
def order_report(spark, sf_dir):
    """Flagship: customer orders keyed to a calendar and a party dimension, by year and segment."""
    orders, customers = read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer")
    days = dimensions.date_dimension(orders.withColumn("day", F.to_date("o_orderdate")), "day")
    joined = orders.join(customers, orders.o_custkey == customers.c_custkey).select(
        keys.date_key(F.col("o_orderdate")).alias("date_sk"),
        F.col("c_mktsegment").alias("segment"),
        keys.name_key(F.col("c_name")).alias("party_sk"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
    )
    dated = attach(joined, days.select("date_sk", "year", "quarter"), ["date_sk"], "inner")
    totals = dated.groupBy("year", "quarter", "segment").agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_distinct("party_sk").alias("parties"),
        F.sum("amount").cast("double").alias("amount"),
    )
    return totals


# Quality


def verdicts(checks: DataFrame) -> DataFrame:
    return checks.select("check_name", "passed", "violations")


@query
def check_unique_keys(spark, sf_dir):
    orders = quality.unique_key(read(spark, sf_dir, "orders"), "o_orderkey", "orders")
    lines = read(spark, sf_dir, "lineitem").withColumn("line_key", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    return verdicts(orders.unionByName(quality.unique_key(lines, "line_key", "lineitem")))


@query
def check_foreign_keys(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem")
    orders, customers = read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer")
    parts, suppliers = read(spark, sf_dir, "part"), read(spark, sf_dir, "supplier")
    edges = [
        ("l_orderkey", orders.withColumnRenamed("o_orderkey", "l_orderkey"), "orders"),
        ("l_partkey", parts.withColumnRenamed("p_partkey", "l_partkey"), "part"),
        ("l_suppkey", suppliers.withColumnRenamed("s_suppkey", "l_suppkey"), "supplier"),
    ]
    active = [("c_custkey", orders.withColumnRenamed("o_custkey", "c_custkey"), "orders")]  # not every customer has one
    checks = quality.no_orphans(lines, edges, "lineitem").unionByName(quality.no_orphans(customers, active, "customer"))
    return verdicts(checks)


@query
def check_values(spark, sf_dir):
    raw = type_rows(ledger.spark_ledger(spark, sf_dir))
    customers = read(spark, sf_dir, "customer")
    checks = quality.no_nulls(raw, ["transaction_sk", "posting_date"], "ledger").unionByName(
        quality.non_negative(customers, "c_acctbal", "customer")
    )
    return verdicts(checks.unionByName(quality.non_negative(raw, "transaction_amount", "ledger")))


@query
def check_date_coverage(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))
    lines = read(spark, sf_dir, "lineitem").withColumn("date_sk", keys.date_key(F.col("l_shipdate")))
    days = dimensions.date_dimension(orders, "day")
    first_year = days.filter(F.col("year") == days.agg(F.min("year").alias("y")).scalar())
    checks = quality.dates_covered(lines, days, "lineitem").unionByName(
        quality.dates_covered(lines, first_year, "lineitem first year")
    )
    return checks.select("check_name", "passed", "violations", "detail")


@query
def check_reconciliation(spark, sf_dir):
    rows, tables = star(spark, sf_dir)
    passing = quality.reconciled(tables["fact_expenses"], rows)
    short = tables["fact_expenses"].filter("payment_method_sk != 'blik'")
    return passing.unionByName(quality.reconciled(short, rows)).select("check_name", "passed", "violations")


@query
def quality_gate(spark, sf_dir):
    rows, tables = star(spark, sf_dir)
    return verdicts(quality.gate_checks(tables, rows))


# What is broken in the star of `quality_gate_broken`, as SQL of Spark and DuckDB alike.
NULLED, NEGATED = "amount > 300000", "amount < 50000"
LOST_PARTIES, LOST_METHOD = "counterparty_sk < 'm'", "blik"


@query
def quality_gate_broken(spark, sf_dir):
    """The gate over a star with a fault for each of its checks."""
    rows, tables = star(spark, sf_dir)
    days = tables["dim_date"]

    def twice(df):
        return df.unionByName(df)

    faulty = {
        "fact_expenses": tables["fact_expenses"].withColumns(
            {
                "category_sk": F.when(~F.expr(NULLED), F.col("category_sk")),
                "amount": F.when(F.expr(NEGATED), -F.col("amount")).otherwise(F.col("amount")),
            }
        ),
        "fact_income": tables["fact_income"].withColumn("date_sk", F.when(~F.expr(NULLED), F.col("date_sk"))),
        "dim_category": twice(tables["dim_category"].filter("category_sk != 'unclassified'")),
        "dim_counterparty": twice(tables["dim_counterparty"].filter(f"NOT {LOST_PARTIES}")),
        "dim_date": twice(days.filter(F.col("year") == days.agg(F.min("year").alias("y")).scalar())),
        "dim_payment_method": twice(tables["dim_payment_method"].filter(F.col("payment_method_sk") != LOST_METHOD)),
    }
    return verdicts(quality.gate_checks(faulty, rows))


@query
def quality_invariants(spark, sf_dir):
    rows, tables = star(spark, sf_dir)
    return verdicts(quality.invariant_checks(tables, rows))


# Sinks


def _new_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/out-{uuid.uuid4().hex}"


def _by_year(table: DataFrame) -> DataFrame:
    return table.groupBy(F.col("year").cast("int").alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("amount").cast("decimal(18,2)")).cast("double").alias("amount")
    )


def _dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.year("o_orderdate").alias("year"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
    )


@query
def parquet_by_year(spark, sf_dir):
    folder = _new_folder(spark)
    write_table(_dated_orders(spark, sf_dir), folder, "parquet", "year")
    return _by_year(spark.read.parquet(folder))


@query
def csv_by_year(spark, sf_dir):
    folder = _new_folder(spark)
    write_table(_dated_orders(spark, sf_dir), folder, "csv", "year")
    return _by_year(spark.read.option("header", True).csv(folder))


@query
def single_file_tables(spark, sf_dir):
    folder = _new_folder(spark)
    write_table(read(spark, sf_dir, "part"), folder, "parquet", single_file=True)
    back = spark.read.parquet(folder).select("p_type", F.col("_metadata.file_name").alias("file"))
    return back.groupBy("p_type").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("file").cast("int").alias("files")
    )


@query
def published_star(spark, sf_dir):
    """The tables that readers see after a version was published and a broken one refused."""
    rows, tables = star(spark, sf_dir)
    folder = _new_folder(spark)
    publish_version(tables, rows, folder)
    broken = {**tables, "dim_counterparty": tables["dim_counterparty"].filter("counterparty_sk != 'unknown'").limit(1)}
    try:
        publish_version(broken, rows, folder)
    except quality.DataQualityError:
        pass
    found = read_version(spark, folder)
    return _sizes_of(found)


@query
def loaded_by_year(spark, sf_dir):
    """The nations' export files loaded in three runs: some, all, and nothing new."""
    files, target = _new_folder(spark), _new_folder(spark)
    ledger.write_files(spark, sf_dir, files)
    for pattern in ("nation_1*.csv", "nation_*.csv", "nation_*.csv"):
        load_new(spark, files, target, PATTERNS, pattern, strict=False)
    return _by_year(read_rows(spark, target).withColumn("amount", F.col("transaction_amount")))


@query
def streamed_by_year(spark, sf_dir):
    """The ledger's rows as three drops of files, the last of them with repeats, through the stream."""
    raw = ledger.spark_ledger(spark, sf_dir)
    arriving, out, checkpoint = (_new_folder(spark) for _ in range(3))
    for chosen in ("_line_seq % 3 = 0", "_line_seq % 3 != 0", "_line_seq % 5 = 0"):
        raw.filter(chosen).select(*exports.BUSINESS_COLUMNS).write.mode("append").parquet(arriving)
        transactions.run_available(spark, arriving, out, checkpoint, PATTERNS, "10000 days", strict=False)
    rows = transactions.read_stream_output(spark, out)
    return _by_year(rows.select(F.year("transaction_date").alias("year"), F.col("transaction_amount").alias("amount")))


@query
def appended_report(spark, sf_dir):
    folder = _new_folder(spark)
    orders = _dated_orders(spark, sf_dir)
    for year_filter in ("year < 1998", "year >= 1998"):
        append_report(orders.filter(year_filter), folder)
    return _by_year(spark.read.option("header", True).csv(folder))
