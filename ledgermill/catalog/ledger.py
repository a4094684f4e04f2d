"""Transaction exports rendered from the driver's tables.

Every order becomes one raw transaction of its customer, and every nation one
export file. The rendering is written once as SQL templates; `spark_ledger` and
the comparison SQL both use them, so both sides start from the same texts.
"""

from __future__ import annotations

import codecs

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.scale import discard, move, widen
from ledgermill.sources.exports import BUSINESS_COLUMNS, COLUMN_OF_HEADER, stage_lines

NBSP = " "

PATTERNS = {
    "own_name_investment_pattern": "%jan nowak%gdynia%",
    "own_name_rlike": "nowak.*jan|jan.*nowak",
    "investment_iban": "PL000007",
    "employer_name": "%acme works%",
    "consulting_client": "%bright client%",
    "spouse_like": "%anna nowak%",
    "spouse_like_alt": "%ania nowak%",
    "family_member_rlike": "ewa nowak",
}

CATEGORIES = {
    "Food": ["Groceries", "Restaurant", "Food Misc"],
    "Home": ["Utilities", "Home Maintenance"],
    "Transport": ["Fuel", "Taxi/Rideshare"],
    "Shopping": ["Furniture", "Media"],
    "Finance": ["Taxes"],
}
TRAINING = {
    "Groceries": ["biedronka", "zabka"],
    "Restaurant": ["mcdonald", "costa coffee"],
    "Fuel": ["orlen", "shell", "bp"],
    "Taxi/Rideshare": ["uber", "bolt"],
    "Furniture": ["ikea"],
    "Home Maintenance": ["castorama"],
    "Media": ["amazon", "notino"],
    "Utilities": ["t-mobile"],
    "Taxes": ["urząd skarbowy"],
}
ALIASES = ["manda konsulting", "bright client studio", "ing bank śląski"]

SPARK_FUNCTIONS = {
    "iso": "date_format(o_orderdate, 'yyyy-MM-dd')",
    "dmy": "date_format(o_orderdate, 'dd-MM-yyyy')",
    "loose": "date_format(o_orderdate, 'yyyy-M-d')",
    "later": "date_format(date_add(o_orderdate, 2), 'yyyy-MM-dd')",
    "price": "translate(format_number(o_totalprice, 2), ',.', ' ,')",
    "hard_price": f"translate(format_number(o_totalprice, 2), ',.', '{NBSP},')",
    "balance": "translate(format_number(c_acctbal, 2), ',.', ' ,')",
}
DUCKDB_FUNCTIONS = {
    "iso": "strftime(o_orderdate, '%Y-%m-%d')",
    "dmy": "strftime(o_orderdate, '%d-%m-%Y')",
    "loose": "strftime(o_orderdate, '%Y-%-m-%-d')",
    "later": "strftime(o_orderdate + INTERVAL 2 DAY, '%Y-%m-%d')",
    "price": "translate(format('{:,.2f}', o_totalprice), ',.', ' ,')",
    "hard_price": f"translate(format('{{:,.2f}}', o_totalprice), ',.', '{NBSP},')",
    "balance": "translate(format('{:,.2f}', c_acctbal), ',.', ' ,')",
}

RAW_TEMPLATES = {
    "transaction_date": """CASE
        WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN {dmy}
        WHEN o_orderstatus = 'P' AND o_orderpriority = '2-HIGH' THEN concat('  ', {iso}, ' ')
        WHEN o_orderstatus = 'P' AND o_orderpriority = '3-MEDIUM' THEN 'Razem'
        WHEN o_orderstatus = 'F' AND o_orderpriority = '5-LOW' THEN {loose}
        ELSE {iso} END""",
    "posting_date": "CASE WHEN o_orderstatus = 'O' THEN NULL ELSE {later} END",
    "counterparty_details": """CASE
        WHEN c_mktsegment = 'AUTOMOBILE' THEN concat('Shell ', n_name, ' sp. z o.o. Warszawa')
        WHEN c_mktsegment = 'BUILDING' THEN concat('Castorama ', c_name, ' ul. Długa 5')
        WHEN c_mktsegment = 'FURNITURE' THEN 'IKEA Kraków POL'
        WHEN c_mktsegment = 'HOUSEHOLD' THEN concat('  Sklep Łódź ', c_name, ' GmbH 30-001')
        WHEN o_orderpriority = '1-URGENT' THEN concat('Urząd Skarbowy ', n_name)
        WHEN o_orderpriority = '2-HIGH' THEN concat('Jan Nowak ', n_name, ' Gdynia')
        WHEN o_orderpriority = '3-MEDIUM' THEN 'Bright Client Studio S.A.'
        WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Ewa Nowak www.nowak.pl/x'
        ELSE '' END""",
    "description": """CASE
        WHEN o_orderpriority = '1-URGENT' THEN concat('Zakupy ', c_name)
        WHEN o_orderpriority = '2-HIGH' AND c_mktsegment = 'HOUSEHOLD' THEN 'Wynagrodzenie za miesiąc'
        WHEN o_orderpriority = '2-HIGH' THEN concat('Orlenn ', n_name)
        WHEN o_orderpriority = '3-MEDIUM' THEN ''
        WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'O' THEN 'Blokada środków'
        WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'F' THEN 'vendita'
        WHEN o_orderpriority = '5-LOW' AND c_mktsegment = 'BUILDING' THEN 'Rata kredytu 7'
        ELSE 'costa cofee' END""",
    "account_number": "concat('''PL ', lpad(cast(n_nationkey AS varchar(9)), 6, '0'), ' ')",
    "bank_name": "concat(' Bank ', n_name, ' ')",
    "details": """CASE
        WHEN o_orderstatus = 'P' THEN 'TR.KART 0'
        WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 'TR.KART 1'
        WHEN o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' THEN 'Przelew SEPA x'
        WHEN o_orderstatus = 'F' AND o_orderpriority = '3-MEDIUM' THEN 'Platnosc BLIK'
        WHEN o_orderstatus = 'F' AND o_orderpriority = '4-NOT SPECIFIED' THEN 'Przelew'
        WHEN o_orderstatus = 'F' THEN 'Przelew kurs 4.2'
        WHEN o_orderpriority = '1-URGENT' THEN 'Wymiana KANTOR'
        WHEN o_orderpriority = '2-HIGH' THEN 'Przelew zwykly'
        WHEN o_orderpriority = '3-MEDIUM' THEN NULL
        WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '  '
        ELSE 'Prowizja' END""",
    "transaction_id": "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE concat('''', o_orderkey, ' ') END",
    "transaction_amount": "CASE WHEN o_orderstatus = 'F' THEN concat('-', {price}) ELSE {hard_price} END",
    "transaction_currency": "CASE WHEN n_regionkey = 1 THEN ' EUR' ELSE 'PLN' END",
    "blocked_amount": "CASE WHEN o_orderstatus = 'P' THEN {price} ELSE NULL END",
    "blocked_currency": "'PLN '",
    "foreign_payment_amount": "CASE WHEN n_regionkey = 2 THEN {hard_price} ELSE NULL END",
    "foreign_payment_currency": "CASE WHEN n_regionkey = 2 THEN 'USD' ELSE NULL END",
    "account": "concat(' Konto ', c_mktsegment)",
    "balance_after_transaction": "{balance}",
    "balance_currency": "'PLN'",
}
SOURCE_FILE = "concat('nation_', lpad(cast(n_nationkey AS varchar(9)), 2, '0'), '.csv')"
QUOTED = ["counterparty_details", "description"]

# Files that deviate, by nation: how a real folder of exports goes wrong.
WITHOUT_TITLE, WITHOUT_COUNT, QUOTED_COUNT, WIDE_ROWS, HIGH_COUNT = 3, 5, 7, 13, 9
ROTATED = [1, 2, 10, 17, 21]  # account and details come first
WITHOUT_BALANCE = [4, 10, 20]  # the two optional columns are absent

HEADER_OF_COLUMN = {c: h.split("_")[0] for h, c in COLUMN_OF_HEADER.items()}


def raw_columns(functions: dict[str, str]) -> dict[str, str]:
    out = {}
    for name, template in RAW_TEMPLATES.items():
        for function, body in functions.items():
            template = template.replace("{" + function + "}", body)
        out[name] = template
    return out


def layouts() -> dict[str, tuple[list[int], list[str]]]:
    """Column layouts by name: (nations, columns in file order); nations [] means all others."""
    plain = BUSINESS_COLUMNS
    rotated = ["account", "details"] + [c for c in plain if c not in ("account", "details")]
    short = [c for c in plain if not c.startswith("balance")]
    both = [c for c in rotated if not c.startswith("balance")]
    return {
        "both": ([n for n in ROTATED if n in WITHOUT_BALANCE], both),
        "rotated": ([n for n in ROTATED if n not in WITHOUT_BALANCE], rotated),
        "short": ([n for n in WITHOUT_BALANCE if n not in ROTATED], short),
        "plain": ([], plain),
    }


def by_layout(render) -> str:
    """CASE over nations applying `render(columns)` of each layout."""
    *special, (_, plain) = layouts().values()
    whens = [f"WHEN n_nationkey IN ({', '.join(map(str, n))}) THEN {render(c)}" for n, c in special]
    return f"CASE {' '.join(whens)} ELSE {render(plain)} END"


def line_sql() -> str:
    def render(columns: list[str]) -> str:
        cells = [f"concat('\"', {c}, '\"')" if c in QUOTED else f"coalesce({c}, '')" for c in columns]
        return f"concat_ws(';', {', '.join(cells)})"

    extra = f"CASE WHEN n_nationkey = {WIDE_ROWS} THEN ';x' ELSE '' END"
    return f"concat({by_layout(render)}, {extra})"


def header_sql() -> str:
    def render(columns: list[str]) -> str:
        return "'" + ";".join(f'"{HEADER_OF_COLUMN[c]}"' for c in columns) + "'"

    return f"CASE WHEN n_nationkey = {WITHOUT_TITLE} THEN replace({by_layout(render)}, 'Tytuł', 'Opis') ELSE {by_layout(render)} END"


def count_line_sql() -> str:
    return f"""CASE
        WHEN n_nationkey = {WITHOUT_COUNT} THEN 'Bez liczby'
        WHEN n_nationkey = {QUOTED_COUNT} THEN concat('"Liczba transakcji:";"', n, '";')
        WHEN n_nationkey = {HIGH_COUNT} THEN concat('"Liczba transakcji:";', n + 1, ';')
        ELSE concat('"Liczba transakcji:"; ', n, ';') END"""


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def spark_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customer and nation; both lookups are left to the optimizer."""
    orders, customers = widen(read(spark, sf_dir, "orders"), "o_orderkey"), read(spark, sf_dir, "customer")
    nations = read(spark, sf_dir, "nation")
    joined = orders.join(customers, orders.o_custkey == customers.c_custkey)
    return joined.join(nations, joined.c_nationkey == nations.n_nationkey)


def spark_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-text raw transactions with provenance, shaped like parsed exports."""
    columns = [f"{body} AS {name}" for name, body in raw_columns(SPARK_FUNCTIONS).items()]
    return spark_orders(spark, sf_dir).selectExpr(
        *columns,
        f"{SOURCE_FILE} AS _source_file",
        "timestamp'2025-01-01 00:00:00' AS _ingested_at",
        f"sha2({SOURCE_FILE}, 256) AS _hash",
        "0L AS _line_block",
        "o_orderkey AS _line_seq",
    )


def spark_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The export files as lines: (path, source_file, block, seq, raw)."""
    orders = spark_orders(spark, sf_dir)
    columns = [f"{body} AS {name}" for name, body in raw_columns(SPARK_FUNCTIONS).items()]
    rows = orders.selectExpr("n_nationkey", "o_orderkey", f"{SOURCE_FILE} AS source_file", *columns)
    data = rows.selectExpr("source_file", "1L AS block", "o_orderkey AS seq", f"{line_sql()} AS line")
    counted = orders.groupBy("n_nationkey").agg(F.count(F.lit(1)).alias("n"))
    preamble = [("0L", "0L", "'\"Bank\";'"), ("0L", "1L", count_line_sql()), ("0L", "2L", header_sql())]
    footer = [("2L", "0L", "'Dokument ma charakter informacyjny;'")]
    framed = counted.selectExpr(
        f"{SOURCE_FILE} AS source_file",
        "inline(array("
        + ", ".join(f"struct({b} AS block, {s} AS seq, {line} AS line)" for b, s, line in preamble + footer)
        + "))",
    )
    lines = framed.unionByName(data).selectExpr(
        "source_file AS path", "source_file", "block", "seq", "encode(line, 'UTF-8') AS raw"
    )
    return stage_lines(lines)


# Real export files, one per nation: even nations in cp1250, every third one with an empty
# and an unknown header cell, some descriptions with a delimiter or a line feed in quotes.
ONE_BYTE = "n_nationkey % 2 = 0"
MORE_CELLS = "n_nationkey % 3 = 0"
FILE_DESCRIPTION = """CASE WHEN o_orderkey % 7 = 0 THEN concat('rata; ', c_name)
    WHEN o_orderkey % 11 = 0 THEN concat('pierwsza', chr(10), 'druga') ELSE description END"""
FOOTER_TEXT = "Dokument ma charakter informacyjny"


def file_lines() -> dict[str, str]:
    """SQL of the header, count line and row line of a real file; the same in Spark and DuckDB."""
    header = ";".join(f'"{HEADER_OF_COLUMN[c]}"' for c in BUSINESS_COLUMNS)
    cells = [f"concat('\"', {c}, '\"')" if c in QUOTED else f"coalesce({c}, '')" for c in BUSINESS_COLUMNS]
    return {
        "header": f"concat('{header}', CASE WHEN {MORE_CELLS} THEN ';;\"Uwagi\"' ELSE '' END)",
        "count": "concat('\"Liczba transakcji:\";', n, ';')",
        "row": f"concat(concat_ws(';', {', '.join(cells)}), CASE WHEN {MORE_CELLS} THEN ';;uwaga' ELSE '' END)",
        "footer": f"'{FOOTER_TEXT};'",
    }


def write_files(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """The export files themselves, in the shared folder."""
    sql = file_lines()
    orders = spark_orders(spark, sf_dir)
    raw = orders.selectExpr(
        "n_nationkey", "o_orderkey", "c_name", *[f"{body} AS {c}" for c, body in raw_columns(SPARK_FUNCTIONS).items()]
    ).withColumn("description", F.expr(FILE_DESCRIPTION))
    data = raw.selectExpr("n_nationkey", "1 AS part", "o_orderkey AS seq", f"{sql['row']} AS line")
    counted = orders.groupBy("n_nationkey").agg(F.count(F.lit(1)).alias("n"))
    framed = counted.selectExpr(
        "n_nationkey",
        f"""inline(array(struct(0 AS part, 0L AS seq, '"Bank";' AS line), struct(0 AS part, 1L AS seq, {sql['count']} AS line),
            struct(0 AS part, 2L AS seq, {sql['header']} AS line), struct(2 AS part, 0L AS seq, {sql['footer']} AS line)))""",
    )
    pairs = [(codecs.decode(bytes([b]), "cp1250", "replace"), chr(b)) for b in range(0x80, 0x100)]
    known = [(letter, byte) for letter, byte in pairs if letter != "\ufffd"]
    as_bytes = F.translate("line", "".join(x for x, _ in known), "".join(b for _, b in known))
    line = F.when(F.expr(ONE_BYTE), F.encode(as_bytes, "ISO-8859-1").cast("string")).otherwise(F.col("line"))
    rows = framed.unionByName(data).select(F.expr(SOURCE_FILE).alias("file"), "part", "seq", line.alias("line"))
    parted = rows.repartition("file").sortWithinPartitions("file", "part", "seq")
    parted.select("file", "line").write.partitionBy("file").text(f"{folder}.parts")
    storage = spark._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    for nation in storage.listStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}.parts")):
        if nation.isDirectory():  # one per nation, with one file each
            (part,) = [f.getPath() for f in storage.listStatus(nation.getPath()) if f.getPath().getName().startswith("part-")]
            move(spark, part.toString(), f"{folder}/{nation.getPath().getName().removeprefix('file=')}")
    discard(spark, f"{folder}.parts")
