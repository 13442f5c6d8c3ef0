from __future__ import annotations

import pytest

from daybook import SchemaError
from daybook.contracts import AD_FIELDS, ORDER_FIELDS, POSITION, REASON, InputField
from daybook.operators import flag_ads, flag_missing, flag_orders
from daybook.sources import csv_files
from daybook.sources import (
    canonical_columns,
    match_header,
    normal_header,
    parse_failures,
    read_export,
)

HEADERS = [
    "Order ID",
    "Created At",
    "Financial Status",
    "Gross Amount",
    "Discount Amount",
    "Net Amount",
    "Taxes",
    "Shipping fees",
    "Currency",
]
CANONICAL = [f.name for f in ORDER_FIELDS]

TWO = (InputField("a"), InputField("b"), InputField("c", required=False))


@pytest.mark.parametrize(
    ("raw", "normal"),
    [
        ("Created At ", "created_at"),
        ("CREATED AT", "created_at"),
        ("created  at", "created_at"),
        ("Gross Amount ($)", "gross_amount"),
        ("  ORDER--ID  ", "order_id"),
        ("shipping-fees", "shipping_fees"),
        ("\ufeffOrder ID", "order_id"),
        ("", ""),
    ],
)
def test_normal_header(raw, normal):
    assert normal_header(raw) == normal


def test_headers_are_matched_and_reported():
    match = match_header([*HEADERS, "Promo Code"], ORDER_FIELDS)
    assert match.columns == (*CANONICAL, "Promo Code")
    assert match.renamed["Created At"] == "created_at"
    assert match.unexpected == ("Promo Code",)
    assert match_header(CANONICAL, ORDER_FIELDS).renamed == {}


def test_every_accepted_spelling_matches():
    for fields in (ORDER_FIELDS, AD_FIELDS):
        for field in fields:
            for spelling in field.also:
                headers = [spelling if f is field else f.name for f in fields]
                assert match_header(headers, fields).renamed == {spelling: field.name}


def test_header_problems_are_fatal():
    with pytest.raises(SchemaError, match="no column fits") as caught:
        match_header(HEADERS[:3], ORDER_FIELDS)
    assert "gross_amount" in caught.value.missing
    with pytest.raises(SchemaError, match="twice or more"):
        match_header([*HEADERS, "Taxes"], ORDER_FIELDS)
    with pytest.raises(SchemaError, match="cannot be told apart"):
        match_header([*HEADERS, "created_at"], ORDER_FIELDS)
    with pytest.raises(SchemaError, match="all fit the field"):
        match_header([*HEADERS, "Subtotal"], ORDER_FIELDS)


def test_absent_optional_columns_become_typed_nulls(spark):
    frame = spark.createDataFrame([("2026-09-01", "2026-09-01", "5")], ["Date Start", "end_date", "Cost"])
    mapped, match = canonical_columns(frame, AD_FIELDS)
    assert match.absent == ("campaign_name", "impressions", "link_clicks")
    assert set(mapped.columns) == {f.name for f in AD_FIELDS}
    assert {f.dataType.simpleString() for f in mapped.schema.fields} == {"string"}


def write(tmp_path, text, name="in.csv"):
    path = tmp_path / name
    path.parent.mkdir(exist_ok=True, parents=True)
    path.write_bytes(text.encode())
    return str(path)


def read(spark, path, **kw):
    rows, match = read_export(spark, path, TWO, **kw)
    with parse_failures(path):
        return flag_missing(rows, ["a"]).orderBy(*POSITION).collect(), match


def test_cells_stay_text_and_only_empty_is_null(spark, tmp_path):
    path = write(tmp_path, 'A,b,Extra x.y\n007,"say ""hi"", ok",N/A\n1.50, ,\n,"",null\n')
    rows, match = read(spark, path)
    assert [tuple(r)[:3] for r in rows] == [
        ("007", 'say "hi", ok', "N/A"),
        ("1.50", " ", None),
        (None, None, "null"),
    ]
    assert match.renamed == {"A": "a"} and match.unexpected == ("Extra x.y",)
    assert match.absent == ("c",) and rows[0].c is None


def test_blank_lines_are_skipped_and_short_rows_padded(spark, tmp_path):
    path = write(tmp_path, "a,b,x\r\n1,2,3\r\n\r\n   \r\n4\r\n,,\r\n")
    expected = [("1", "2", "3"), ("4", None, None), (None, None, None)]
    for multi_line in (False, True):
        rows, _ = read(spark, path, multi_line=multi_line)
        assert [tuple(r)[:3] for r in rows] == expected


def test_surplus_cells_fail_the_read(spark, tmp_path):
    path = write(tmp_path, "a,b\n1,2\n3,4,5\n")
    with pytest.raises(SchemaError, match="more cells than the header"):
        read(spark, path)


def test_quoted_line_breaks_are_read_or_refused(spark, tmp_path):
    path = write(tmp_path, 'a,b\n1,"two\nlines"\n2,x\n')
    with pytest.raises(SchemaError, match="spans lines"):
        read(spark, path, multi_line=False)
    for multi_line in (None, True):
        rows, _ = read(spark, path, multi_line=multi_line)
        assert [tuple(r)[:2] for r in rows] == [("1", "two\nlines"), ("2", "x")]


def test_only_torn_files_are_read_whole(spark, tmp_path):
    want = []
    for k in range(12):
        lines = [f"{k}-{i},{'x' * 30}" for i in range(300)]
        want += [tuple(line.split(",")) for line in lines]
        if k == 7:
            lines[4:4] = ['7-torn,"first, ""line""', ' second\r\n', '"']
            want.insert(7 * 300 + 4, ("7-torn", 'first, "line"\n second\r\n\n'))
        write(tmp_path, "a,b\n" + "\n".join(lines) + "\n", f"in [1]/part {k:02} {{x}}*%41.csv")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        rows, _ = read_export(spark, str(tmp_path / "in \\[1\\]"), TWO)
        ordered = rows.orderBy(*POSITION).collect()
        got = [tuple(r)[:2] for r in ordered]
        assert len({(r[POSITION[0]], r[POSITION[1]]) for r in ordered}) > 20
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [g[0] for g in got] == [w[0] for w in want]
    torn = dict(got)["7-torn"]
    assert torn.replace("\r\n", "\n") == dict(want)["7-torn"].replace("\r\n", "\n")


def test_a_cell_that_never_ends_is_refused(spark, tmp_path):
    with pytest.raises(SchemaError, match="never ends"):
        read(spark, write(tmp_path, 'a,b\n1,"open\n2,x\n3,y\n', "open.csv"))


def test_unusable_files(spark, tmp_path):
    with pytest.raises(SchemaError, match="no CSV data"):
        read(spark, str(tmp_path / "none.csv"))
    with pytest.raises(SchemaError, match="empty"):
        read(spark, write(tmp_path, "", "zero.csv"))
    with pytest.raises(SchemaError, match="no column fits"):
        read(spark, write(tmp_path, "x,y\n1,2\n", "other.csv"))


def test_torn_cells_never_become_rows(spark, tmp_path):
    text = 'a,b\n1,"two\nlines, more"\n'
    rows, _ = read(spark, write(tmp_path, text, "torn.csv"))
    assert [tuple(r)[:2] for r in rows] == [("1", "two\nlines, more")]
    rows, _ = read(spark, write(tmp_path, 'a,b\n1,5" pipe\n2,"x ""y"" z"\n', "quotes.csv"))
    assert len(rows) == 2


def test_header_without_rows(spark, tmp_path):
    rows, _ = read(spark, write(tmp_path, "a,b\n"))
    assert rows == []


def test_unnamed_columns_are_kept(spark, tmp_path):
    rows, match = read(spark, write(tmp_path, "a,,b,\n1,2,3,4\n"))
    assert match.unexpected == ("Unnamed: 1", "Unnamed: 3")
    assert tuple(rows[0])[:4] == ("1", "2", "3", "4")


def test_a_folder_is_one_input_and_must_agree_on_the_header(spark, tmp_path):
    write(tmp_path, "a,b\n1,x\n2,x\n", "in/part-0.csv")
    write(tmp_path, "A,b\n3,x\n", "in/part-1.csv")
    rows, _ = read(spark, str(tmp_path / "in"))
    assert [r.a for r in rows] == ["1", "2", "3"]
    write(tmp_path, "b,a\nx,4\n", "in/part-2.csv")
    with pytest.raises(SchemaError, match="header does not conform"):
        read(spark, str(tmp_path / "in"))


def test_positions_follow_the_file_across_splits(spark, tmp_path):
    lines = [f"{i},{'x' * 40}" for i in range(4000)]
    path = write(tmp_path, "a,b\n" + "\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows, _ = read_export(spark, path, TWO)
        assert rows.rdd.getNumPartitions() > 4
        ordered = [int(r.a) for r in rows.orderBy(*POSITION).select("a").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert ordered == list(range(4000))


def test_unexpected_columns_count_for_emptiness(spark, tmp_path):
    text = ",".join([*HEADERS, "Note"]) + "\n" + "," * 9 + "\n" + "," * 9 + "hello\n"
    rows, _ = read_export(spark, write(tmp_path, text), ORDER_FIELDS)
    reasons = [r[REASON] for r in flag_orders(rows).orderBy(*POSITION).collect()]
    assert reasons == ["empty_row", "missing_required_value"]


def test_a_column_called_like_a_derived_one_does_no_harm(spark, tmp_path):
    text = "reporting_start,reporting_end,cost,rejection_reason\n2026-09-01,2026-09-01,5,no\n"
    rows, _ = read_export(spark, write(tmp_path, text), AD_FIELDS)
    assert [r[REASON] for r in flag_ads(rows).collect()] == [None]


def test_quotes_are_counted_in_torn_files_only(spark, tmp_path, monkeypatch):
    whole = write(tmp_path, 'a,b\n1,"x, ""y"""\n2,z"z\n', "whole.csv")
    torn = write(tmp_path, 'a,b\n1,"x\ny"\n', "torn.csv")
    assert csv_files._torn_files(spark, str(tmp_path)) == [f"file:{torn}"]
    monkeypatch.setattr(csv_files.F, "replace", None)  # what counting needs
    assert csv_files._torn_files(spark, whole) == []
