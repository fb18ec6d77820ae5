import pytest

from ledgerline.operators import contract
from ledgerline.schemas import ANSWER_KEY, CONTRACTS
from ledgerline.sources import csv_files
from ledgerline.sources.csv_files import read_drop, read_seed, write_seed

HEADER = "txn_id,order_id,gateway_status,amount,event_time,event_type\n"
GOOD = "T1,O1,success,5.00,2026-09-01T00:00:00,payment\n"


def drop(spark, tmp_path, content):
    path = tmp_path / "gateway.csv"
    path.write_text(content)
    return read_drop(spark, str(path), CONTRACTS["gateway"])


def reasons(df):
    return {r.txn_id: r.reason for r in contract.with_reason(df, CONTRACTS["gateway"]).collect()}


def test_missing_and_empty_files_have_no_rows(spark, tmp_path):
    missing = read_drop(spark, str(tmp_path / "nowhere.csv"), CONTRACTS["gateway"])
    assert missing.count() == 0 and missing.columns[:6] == CONTRACTS["gateway"].required
    assert drop(spark, tmp_path, "").count() == 0
    assert drop(spark, tmp_path, HEADER).count() == 0


def test_short_rows_are_filled_and_surplus_cells_are_marked(spark, tmp_path):
    text = HEADER + GOOD + "T2,O2,success\n" + "\n" + "T3,O3,success,5.00,2026-09-01,payment,more\n"
    text += '"T4",O4,success,5.00,2026-09-01,"a ""b"", c"\n' + ",O5,success,1,2026-09-01,payment\n"
    got = reasons(drop(spark, tmp_path, text))
    assert got == {
        "T1": None,
        "T2": "missing required field: amount",
        "T3": "more cells than header fields",
        "T4": None,
        None: "missing required field: txn_id",
    }


def test_quoted_newline_is_one_row(spark, tmp_path):
    df = drop(spark, tmp_path, HEADER + GOOD + 'T2,O2,success,5.00,2026-09-01,"two\nlines"\n')
    assert {r.txn_id: r.event_type for r in df.collect()} == {"T1": "payment", "T2": "two\nlines"}


def test_columns_go_by_header_name(spark, tmp_path):
    df = drop(spark, tmp_path, "event_type,order_id,txn_id,amount,gateway_status,event_time\n"
                               "payment,O1,T1,5,success,2026-09-01\n")
    assert reasons(df) == {"T1": None}


def test_unlisted_column_is_kept_out_of_the_table(spark, tmp_path):
    df = drop(spark, tmp_path, HEADER.strip() + ",note\n" + GOOD.strip() + ",hello\n")
    good = contract.valid(contract.with_reason(df, CONTRACTS["gateway"]))
    assert contract.typed(good, CONTRACTS["gateway"]).columns == CONTRACTS["gateway"].required


def test_seed_round_trip(spark, tmp_path):
    path = str(tmp_path / "key")
    rows = spark.sql("select 'O1' order_id, 'M1' merchant_id, cast(5 as decimal(12,2)) amount,"
                     " 'paid' order_status, 'clean' error_type, 'match' expected_result")
    write_seed(rows, path)
    assert read_seed(spark, path, ANSWER_KEY).collect() == rows.collect()


def test_stray_quote_does_not_hide_an_open_one(spark, tmp_path):
    df = drop(spark, tmp_path, HEADER + 'T"2,O2,success,5.00,2026-09-01,"two\nlines"\n' + GOOD)
    assert {r.txn_id: r.event_type for r in df.collect()} == {'T"2': "two\nlines", "T1": "payment"}


def test_a_quoted_newline_across_a_split(spark, tmp_path):
    """Splits of a few bytes: records with newlines in them stay whole wherever they are cut."""
    rows = [f'T{i},O{i},success,5.00,2026-09-01,"a {i}\nb ""{i}"", c"' if i % 3 == 0 else f"T{i},O{i},success,5.00,2026-09-01,p" for i in range(120)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        df = drop(spark, tmp_path, HEADER + "\n".join(rows) + "\n")
        got = {r.txn_id: r.event_type for r in df.collect()}
        assert spark.read.text(str(tmp_path / "gateway.csv")).rdd.getNumPartitions() > 30
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {f"T{i}": f'a {i}\nb "{i}", c' if i % 3 == 0 else "p" for i in range(120)}


def test_an_unclosed_quote_costs_its_own_row(spark, tmp_path):
    lines = [f"T{i},O{i},success,5.00,2026-09-01,payment" for i in range(50)]
    lines[20] = 'T20,O20,success,5.00,2026-09-01,"payment'
    got = reasons(drop(spark, tmp_path, HEADER + "\n".join(lines) + "\n"))
    assert len(got) == 50 and {k: v for k, v in got.items() if v} == {"T20": "quote is never closed"}


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_lines_behind_an_open_quote_are_not_gathered(spark, tmp_path, small_splits):
    """Records over several lines before the open quote, and very many lines behind it, in many splits."""
    lines = [f'T{i},O{i},success,5.00,2026-09-01,"a\n{i}"' if i < 30 and i % 3 == 0 else f"T{i},O{i},success,5.00,2026-09-01,p" for i in range(2000)]
    lines[40] = 'T40,O40,success,5.00,2026-09-01,"p'
    df = drop(spark, tmp_path, HEADER + "\n".join(lines) + "\n")
    assert {k: v for k, v in reasons(df).items() if v} == {"T40": "quote is never closed"}
    rows = {r.txn_id: r.event_type for r in df.collect()}
    assert len(rows) == 2000 and rows["T27"] == "a\n27" and rows["T41"] == "p"
    body = csv_files._lines(spark, str(tmp_path / "gateway.csv")).where("value NOT LIKE 'txn_id%'")
    parts = csv_files._records(body)
    assert parts.count() == 2000 and parts.where("unclosed").count() == 1


def test_a_record_of_too_many_lines(spark, tmp_path):
    text = 'T1,O1,success,5.00,2026-09-01,"one\ntwo"\nT2,O2,success,5.00,2026-09-01,"' + "x\n" * 30 + '"\n' + GOOD.replace("T1", "T3")
    (tmp_path / "gateway.csv").write_text(text)
    lines = csv_files._lines(spark, str(tmp_path / "gateway.csv"))
    rows = csv_files._records(lines, most=5).collect()
    assert sorted(r.value.split(",")[0] for r in rows if r.value.startswith("T")) == ["T1", "T2", "T3"]
    assert [r.value[:2] for r in rows if r.unclosed] == ["T2"] and len(rows) == 2 + 31


def test_files_with_headers_of_their_own(spark, tmp_path):
    folder = tmp_path / "drop"
    folder.mkdir()
    (folder / "a.csv").write_text(HEADER + GOOD)
    (folder / "b.csv").write_text("event_type,order_id,txn_id,amount,gateway_status,event_time,more\nr,O2,T2,5,success,2026-09-01,x\n")
    (folder / "c.csv").write_text("")
    df = read_drop(spark, str(folder), CONTRACTS["gateway"])
    assert reasons(df) == {"T1": None, "T2": None} and {r.txn_id: r.event_type for r in df.collect()} == {"T1": "payment", "T2": "r"}


def test_random_files_read_as_python_reads_them(spark, tmp_path):
    import csv
    import io
    import random

    rng = random.Random(5)
    for n in range(6):
        out = io.StringIO()
        writer = csv.writer(out, lineterminator="\n")
        cells = lambda: "".join(rng.choice('ab ,"\n') for _ in range(rng.randint(1, 6))).strip() or "z"
        rows = [[f"T{i}", cells(), "success", "5", "2026-09-01", cells()] for i in range(40)]
        writer.writerows(rows)
        df = drop(spark, tmp_path, HEADER + out.getvalue())
        assert sorted((r.txn_id, r.order_id, r.event_type) for r in df.collect()) == sorted((r[0], r[1], r[5]) for r in rows), n
