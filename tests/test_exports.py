import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgermill.catalog import queries
from ledgermill.plans.silver import type_rows
from ledgermill.sources import exports
from tests.samples import FEBRUARY, FOOTER, HEADER, JANUARY, export, row


def write(folder, name, text, charset="utf-8"):
    (folder / name).write_bytes(text.encode(charset))
    return (folder / name).read_bytes()


@pytest.mark.parametrize(
    "line, names",
    [
        ("a;b;c", ["a", "b", "c"]),
        ("a;;b;", ["a", "column_1", "b", "column_2"]),
        ("a;a;a", ["a", "a_1", "a_2"]),
        ("A;;A;A", ["A", "column_1", "A_1", "A_2"]),
        ('"a:";"b"', ["a", "b"]),
        ("  a  ; b ;c", ["a", "b", "c"]),
        ("A;A;A_1", ["A", "A_1", "A_1_1"]),
        ("A;A_1;A", ["A", "A_1", "A_2"]),
    ],
)
def test_header_names(spark, line, names):
    df = spark.createDataFrame([(line,)], "line string")
    assert df.select(exports.header_names(F.col("line"))).first()[0] == names


def test_reads_files_of_both_charsets_and_column_orders(spark, tmp_path):
    first = write(tmp_path, "a.csv", export(JANUARY))
    write(tmp_path, "b.csv", export(FEBRUARY), "cp1250")
    shuffled = '"Waluta";"Konto";"Data transakcji";' + HEADER.replace('"Data transakcji";', "").replace(
        ';"Konto";"Saldo po transakcji";"Waluta"', ""
    ) + ';"Extra"'
    cells = "PLN;Konto;2025-03-01;;C;D;;;TR.KART;1;-1,00;EUR;;USD;;GBP;x"
    write(tmp_path, "c.csv", export([cells], header=shuffled))
    (tmp_path / "notes.txt").write_text("not an export")
    (tmp_path / "nested").mkdir()
    write(tmp_path / "nested", "d.csv", export(JANUARY))

    read = exports.read_exports(spark, str(tmp_path))
    assert {r.source_file: (r.charset, r.declared) for r in read.files.collect()} == {
        "a.csv": ("utf-8", 8),
        "b.csv": ("cp1250", 8),
        "c.csv": ("utf-8", 1),
    }
    assert read.declared_total().first().declared == 17
    rows = read.rows.orderBy("_source_file", "_line_block", "_line_seq").collect()
    assert [r.transaction_date for r in rows if r._source_file == "a.csv"] == [
        f"2025-01-0{d}" for d in range(2, 10)
    ] + [FOOTER.strip('";')]
    b = [r for r in rows if r._source_file == "b.csv"]
    assert b[3].counterparty_details == "Urząd Skarbowy"
    assert b[5].counterparty_details == "Lidl; sklep" and b[5].description == 'rata "0"'
    c = [r for r in rows if r._source_file == "c.csv"][0]
    assert (c.transaction_date, c.transaction_currency, c.blocked_currency) == ("2025-03-01", "PLN", "EUR")
    assert c.balance_after_transaction is None and c.balance_currency == "GBP"
    assert {r._hash for r in rows if r._source_file == "a.csv"} == {file_hash(first)}
    assert read.quarantine().count() == 0


def test_rejects_each_unusable_file_with_its_reason(spark, tmp_path):
    write(tmp_path, "good.csv", export(JANUARY))
    write(tmp_path, "noheader.csv", "x;y\n\"Liczba transakcji\";1\n2025-01-01;a\n")
    write(tmp_path, "nocount.csv", export(JANUARY, count=""))
    write(tmp_path, "badcount.csv", export(JANUARY, count='"8"'))
    write(tmp_path, "missing.csv", export(JANUARY, header=HEADER.replace('"Tytuł"', '"Inny"')))
    write(tmp_path, "wide.csv", export([*JANUARY, row("2025-01-01") + ";x"]))
    write(tmp_path, "quote.csv", export([*JANUARY, row("2025-01-01").replace('"Bank"', '"open')]))
    write(tmp_path, "empty.csv", "")
    read = exports.read_exports(spark, str(tmp_path))
    assert {r.source_file: r.reason for r in read.quarantine().collect()} == {
        "noheader.csv": "header or row count not found",
        "nocount.csv": "header or row count not found",
        "badcount.csv": "row count is not a number",
        "missing.csv": "missing mandatory columns: Tytuł",
        "wide.csv": "a row is wider than the header",
        "quote.csv": "unbalanced quotes",
    }
    assert {r[0] for r in read.rows.select("_source_file").distinct().collect()} == {"good.csv"}


def test_optional_columns_may_be_absent(spark, tmp_path):
    header = HEADER.removesuffix(';"Saldo po transakcji";"Waluta"')
    rows = [r.removesuffix(";100,00;PLN") for r in JANUARY]
    write(tmp_path, "a.csv", export(rows, header=header))
    read = exports.read_exports(spark, str(tmp_path))
    kept = read.rows.filter("transaction_date like '2025%'").collect()
    assert len(kept) == 8
    assert {(r.balance_after_transaction, r.balance_currency) for r in kept} == {(None, None)}


def test_quoted_cells_may_span_lines(spark, tmp_path):
    broken = row("2025-01-10", "Sklep\nna\nrogu", "a\nb")
    write(tmp_path, "a.csv", export([*JANUARY, broken, row("2025-01-11", "Po")]))
    read = exports.read_exports(spark, str(tmp_path))
    rows = {r.transaction_date: r for r in read.rows.collect()}
    assert rows["2025-01-10"].counterparty_details == "Sklep\nna\nrogu"
    assert rows["2025-01-10"].description == "a\nb"
    assert rows["2025-01-11"].counterparty_details == "Po"
    assert len(rows) == 11


def test_records_join_across_splits(spark, tmp_path):
    body = [row(f"2025-01-{d:02d}", f"Sklep {d}\nlinia\ndruga" if d % 2 else f"Sklep {d}") for d in range(1, 29)]
    write(tmp_path, "a.csv", export(body, footer=None))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "400")
    try:
        read = exports.read_exports(spark, str(tmp_path))
        rows = {r.transaction_date: r.counterparty_details for r in read.rows.collect()}
        blocks = read.rows.select("_line_block").distinct().count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert blocks > 3
    assert rows == {
        f"2025-01-{d:02d}": f"Sklep {d}\nlinia\ndruga" if d % 2 else f"Sklep {d}" for d in range(1, 29)
    }


def file_hash(raw, group=exports.HASH_LINES):
    digests = [hashlib.sha256(line).hexdigest() for line in raw.removesuffix(b"\n").split(b"\n")]
    groups = [hashlib.sha256("".join(digests[k : k + group]).encode()).hexdigest() for k in range(0, len(digests), group)]
    return hashlib.sha256("".join(groups).encode()).hexdigest()


def test_one_ordered_hash_at_every_size_and_split(spark, tmp_path, monkeypatch):
    raw = {
        "a.csv": write(tmp_path, "a.csv", export(JANUARY[:1])),
        "b.csv": write(tmp_path, "b.csv", export(JANUARY * 4)),
        "c.csv": write(tmp_path, "c.csv", export(list(reversed(JANUARY * 4)))),
        "d.csv": write(tmp_path, "d.csv", export(JANUARY * 4).replace("\n", "\r\n")),
        "e.csv": write(tmp_path, "e.csv", export(FEBRUARY), "cp1250"),
    }
    monkeypatch.setattr(exports, "HASH_LINES", 7)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in (before, "500"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            found = {r.path.rsplit("/", 1)[1]: r.hash for r in exports.file_hashes(spark, str(tmp_path)).collect()}
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        assert found == {name: file_hash(body, 7) for name, body in raw.items()}
    assert len(set(found.values())) == 5


def test_quotes_count_only_where_they_open_a_cell(spark, tmp_path):
    inch = row("2025-01-10").replace('"Bank"', '5" rura')
    twice = row("2025-01-11").replace('"Bank"', '5" x 6" y')
    write(tmp_path, "a.csv", export([*JANUARY, inch, twice]))
    wide = row("2025-01-12").replace('"Bank"', 'a" x;6" y')
    write(tmp_path, "b.csv", export([*JANUARY, wide]))
    inner = row("2025-01-13").replace('"Bank"', '"rura 5" cal"')
    write(tmp_path, "c.csv", export([*JANUARY, inner]))
    read = exports.read_exports(spark, str(tmp_path))
    rows = {r.transaction_date: r for r in read.rows.collect()}
    assert rows["2025-01-10"].bank_name == '5" rura' and rows["2025-01-11"].bank_name == '5" x 6" y'
    assert {r.source_file: r.reason for r in read.quarantine().collect()} == {
        "b.csv": "a row is wider than the header", "c.csv": "unbalanced quotes",
    }
    line = spark.createDataFrame([('a;5" x;6" y;b',), ('"a;b";c',), ('"a""b;c";d;"e',)], "line string")
    assert [r[0] for r in line.select(exports._width(F.col("line"))).collect()] == [4, 2, 3]


def test_a_record_of_very_many_lines_is_kept(spark, tmp_path):
    cell = "\n".join(f"linia {k}" for k in range(10_500))
    write(tmp_path, "a.csv", export([*JANUARY, row("2025-01-10", cell), row("2025-01-11", "Po")]))
    rows = {r.transaction_date: r for r in exports.read_exports(spark, str(tmp_path)).rows.collect()}
    assert rows["2025-01-10"].counterparty_details == cell and rows["2025-01-11"].counterparty_details == "Po"


def test_no_usable_file_is_an_error(spark, tmp_path):
    with pytest.raises(exports.IngestError):
        exports.read_exports(spark, str(tmp_path))
    write(tmp_path, "a.csv", "nothing;here\n")
    with pytest.raises(exports.IngestError, match="header or row count"):
        exports.read_exports(spark, str(tmp_path))


def test_byte_order_mark_before_the_header(spark, tmp_path):
    text = HEADER + "\n" + JANUARY[0] + '\n"Liczba transakcji";1;\n'
    write(tmp_path, "a.csv", "﻿" + text)
    read = exports.read_exports(spark, str(tmp_path))
    assert read.rows.first().transaction_date == "2025-01-02"


def test_lines_are_parsed_once_whatever_filters_follow(spark, tmp_path):
    write(tmp_path, "a.csv", export(JANUARY))
    typed = type_rows(exports.read_exports(spark, str(tmp_path)).rows)
    plan = typed.groupBy("_source_file").count()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv") == 1
    assert typed.count() == len(JANUARY)


def test_split_size_grows_with_the_files(spark, tmp_path, monkeypatch):
    seen = []

    def written(spark, sf_dir, folder):
        Path(folder).mkdir(parents=True)
        for name in ("nation_1.csv", "nation_2.csv"):
            (Path(folder) / name).write_text(export(JANUARY * 400))

    def read(spark, folder, pattern):
        size = sum(f.stat().st_size for f in Path(folder).glob(pattern))
        seen.append((size, int(spark.conf.get("spark.sql.files.maxPartitionBytes"))))

    monkeypatch.setattr(queries.ledger, "write_files", written)
    monkeypatch.setattr(exports, "read_exports", read)
    monkeypatch.setattr(queries, "LEAST_SPLIT_BYTES", 100)
    monkeypatch.setattr(queries, "shared_dir", lambda spark: str(tmp_path))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    queries.read_files(spark, "unused")
    ((size, split),) = seen
    assert size / queries.MOST_SPLITS - 1 < split < size / 2
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
