"""Scalar rules on their edge cases."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidelog.functions import numeric as nm, temporal as tp, text as tx, typemap as tm
from tidelog.operators.images import delete_sign


def test_time_text(values):
    us = [0, 1, 1_500_000, 3_723_000_100, 86_399_999_999, 86_400_000_000, 100 * 3_600_000_000, -1_000_000, -1, None]
    assert values("x bigint", us, tp.time_text(F.col("x"))) == [
        "00:00:00", "00:00:00.000001", "00:00:01.5", "01:02:03.0001", "23:59:59.999999", "24:00:00", "100:00:00",
        "-00:00:01", "-00:00:00.000001", None]


def test_date_text(values):
    assert values("x int", [0, -1, 19723, None], tp.date_text(F.col("x"))) == [
        "1970-01-01", "1969-12-31", "2024-01-01", None]


def test_timestamp_text_moves_to_the_source_zone(values):
    at = dt.datetime(2024, 12, 31, 20, 0, 0, 1)
    text = values("x timestamp_ntz", [at], tp.timestamp_text(F.col("x").cast("timestamp")))
    assert text == ["2025-01-01 04:00:00.000001"]
    assert values("x timestamp_ntz", [at], tp.timestamp_text(F.col("x").cast("timestamp"), "-02:00")) == [
        "2024-12-31 18:00:00.000001"]


def test_pad_datetime(values):
    full = "2024-01-02 03:04:05.123456"
    cases = {
        "2024-01-02": "2024-01-02", full[:18]: full[:18], full[:19]: full[:19] + ".000000", full[:20]: full[:20] + "000000",
        full[:21]: full[:21] + "00000", full[:25]: full[:25] + "0", full: full, full + "9": full + "9", "": "",
    }
    assert values("x string", list(cases), tp.pad_datetime(F.col("x"))) == list(cases.values())


def test_parse_datetime(values):
    got = values("x string", ["2024-01-02", "2024-01-02 03:04:05", "2024-01-02 03:04:05.000006", "2024-01-02 03:04:05.1", None],
                 tp.parse_datetime(F.col("x")))
    day = dt.datetime(2024, 1, 2)
    second = dt.datetime(2024, 1, 2, 3, 4, 5)
    assert got == [day, second, second.replace(microsecond=6), second.replace(microsecond=100_000), None]


def test_epoch_boundaries(values):
    numbers = [0, 9_999_999_999, 10_000_000_000, 9_999_999_999_999, 10_000_000_000_000]
    got = values("x bigint", numbers, tp.datetime_text(tp.epoch_to_timestamp(F.col("x"))))
    assert got == [
        "1970-01-01 00:00:00.000000", "2286-11-20 17:46:39.000000", "1970-04-26 17:46:40.000000",
        "2286-11-20 17:46:39.999000", "1970-04-26 17:46:40.000000"]


def test_timestamp_literal(values):
    at = [dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 1, 2, 3, 4, 5, 60)]
    assert values("x timestamp_ntz", at, tp.timestamp_literal(F.col("x"))) == [
        "'2024-01-02 03:04:05'", "'2024-01-02 03:04:05.000060'"]


def test_ipv4(values):
    assert values("x bigint", [0, 1, 2**32 - 1, 3232235777, None], nm.ipv4_text(F.col("x"))) == [
        "0.0.0.0", "0.0.0.1", "255.255.255.255", "192.168.1.1", None]


IPV6 = {
    "0": "::", "1": "::1", "65535": "::ffff", "65536": "::0.1.0.0", "131072": "::2:0", "196609": "::0.3.0.1",
    str(0xFFFF00000000 + 0xC0A80101): "::ffff:192.168.1.1",
    str(0xFFFFFFFF): "::255.255.255.255",
    str(0x100000000): "::1:0:0",
    str(2**127): "8000::",
    str(2**128 - 1): "ffff:ffff:ffff:ffff:ffff:ffff:ffff:ffff",
    str(0x20010DB8000000000000000000000001): "2001:db8::1",
    str(0x20010DB8000000010000000000000001): "2001:db8:0:1::1",
    # Two runs of the same length: the first is shortened.
    str(0x20010000000000010000000000010001): "2001::1:0:0:1:1",
    # A single zero group is written out.
    str(0x20010000000100010001000100010001): "2001:0:1:1:1:1:1:1",
    "fe80::1": "fe80::1",
    # Bit 16 set and the low half negative as a signed number.
    str(2**63 + 65536): "::0.1.0.0",
    None: None,
}


def test_ipv6(values):
    assert values("x string", list(IPV6), nm.ipv6_text(F.col("x"))) == list(IPV6.values())
    loose = values("x string", [str(2**63 + 65536)], nm.ipv6_text(F.col("x"), strict_compat=False))
    assert loose == ["::8000:0:1:0"]


def test_strip_zeros(values):
    cases = {"1.500": "1.5", "2.000": "2", "100": "100", "0.000": "0", "-0.10": "-0.1", "10.0": "10", None: None}
    assert values("x string", list(cases), nm.strip_zeros(F.col("x"))) == list(cases.values())


@settings(max_examples=1, deadline=None)
@given(st.lists(st.integers(-(10**38) + 1, 10**38 - 1), min_size=60, max_size=60))
def test_wide_integer_round_trip(values, numbers):
    numbers += [0, -1, 1, 2**63, -(2**63), 2**64, 10**38 - 1, -(10**38) + 1]
    raw = [bytearray(n.to_bytes(16, "little", signed=True)) for n in numbers]
    assert values("x binary", raw, nm.wide_integer(F.col("x"))) == [Decimal(n) for n in numbers]


def test_wide_integer_out_of_range_is_null(values):
    raw = [bytearray((2**127 - 1).to_bytes(16, "little")), bytearray((-(2**127)).to_bytes(16, "little", signed=True)), None]
    assert values("x binary", raw, nm.wide_integer(F.col("x"))) == [None, None, None]


def test_strip_quotes(values):
    cases = {"''a''": "a", '"a"': "a", "'\"a\"'": "a", "'": "'", '"': '"', "''": "", "it's": "it's", "'a": "a", None: None}
    assert values("x string", list(cases), tx.strip_quotes(F.col("x"))) == list(cases.values())


def test_quoting(values):
    assert values("x string", ["a", '"a"'], tx.quote_identifier(F.col("x"))) == ['"a"', '"a"']
    assert values("x string", ["Current_Timestamp", "NULL", "0"], tx.quote_default(F.col("x"))) == [
        "Current_Timestamp", "NULL", "'0'"]
    assert values("x string", ["it's", None], tx.escape_comment(F.col("x"))) == ["it\\'s", ""]


def test_batch_label(values):
    ok, long, odd = values("x string", ["db.t", "t" * 130, "täble"], tx.batch_label("p", F.col("x"), F.lit(7)))
    assert ok == "p_db_t_7"
    assert len(long) < 50 and long.startswith("p_") and long.endswith("_7")
    assert odd != long and odd.isascii()


def test_json_valid(values):
    cases = ["{}", "[1]", "1", '"a"', "{", "", "  ", None]
    assert values("x string", cases, tx.json_valid(F.col("x"))) == [True, True, True, True, False, False, False, False]


def test_delete_sign(values):
    kinds = ["INSERT", "UPDATE_AFTER", "DELETE", "UPDATE_BEFORE"]
    assert values("x string", kinds, delete_sign(F.col("x"))) == ["0", "0", "1", "1"]
    with pytest.raises(PySparkException):
        values("x string", ["OTHER"], delete_sign(F.col("x")))


TYPES = [
    ("bit", 1, None, "BOOLEAN"), ("BOOL", None, None, "BOOLEAN"), ("tinyint", None, None, "TINYINT"),
    ("TINYINT UNSIGNED ZEROFILL", None, None, "SMALLINT"), ("SMALLINT UNSIGNED", None, None, "INTEGER"),
    ("MEDIUMINT UNSIGNED", None, None, "INTEGER"), ("YEAR", None, None, "INTEGER"), ("INT UNSIGNED", None, None, "INTEGER"),
    ("BIGINT UNSIGNED ZEROFILL", None, None, "BIGINT"), ("SERIAL", None, None, "BIGINT"),
    ("REAL UNSIGNED ZEROFILL", None, None, "FLOAT"), ("double precision", None, None, "DOUBLE"),
    ("DECIMAL", None, None, "DECIMAL(10, 0)"), ("DECIMAL", 0, -1, "DECIMAL(10, 0)"), ("NUMERIC", 38, 4, "DECIMAL(38, 4)"),
    ("FIXED UNSIGNED", 65, 30, "VARCHAR"), ("DATE", None, None, "DATE"), ("TIME", 10, None, "TIME"),
    ("DATETIME", None, None, "TIMESTAMP"), ("DATETIME", 0, None, "TIMESTAMP"), ("DATETIME", 3, None, "TIMESTAMP(3)"),
    ("DATETIME", 19, None, "TIMESTAMP"), ("TIMESTAMP", 23, None, "TIMESTAMP(3)"), ("DATETIME", 26, None, "TIMESTAMP(6)"),
    ("DATETIME", 30, None, "TIMESTAMP(6)"), ("CHAR", None, None, "CHAR(1)"), ("CHAR", 9, None, "CHAR(9)"),
    ("VARCHAR", 50, None, "VARCHAR(50)"), ("tinytext", None, None, "VARCHAR"), ("VARBINARY", 9, None, "BLOB"),
    ("JSON", None, None, "JSON"), ("SET", None, None, "VARCHAR"),
]


def test_target_type(values):
    rows = [t[:3] for t in TYPES]
    got = values("t string, l int, s int", rows, tm.target_type(F.col("t"), F.col("l"), F.col("s")))
    assert got == [t[3] for t in TYPES]


@pytest.mark.parametrize("row", [("GEOMETRY", None, None), ("VARCHAR", None, None), ("TEXT UNSIGNED", None, None)])
def test_unknown_source_types_fail_or_are_null(values, row):
    cols = F.col("t"), F.col("l"), F.col("s")
    with pytest.raises(PySparkException):
        values("t string, l int, s int", [row], tm.target_type(*cols))
    assert values("t string, l int, s int", [row], tm.target_type(*cols, strict=False)) == [None]


def test_spark_type_widens_unsigned(values):
    cases = [
        ("INT UNSIGNED", None, None, "bigint"), ("BIGINT UNSIGNED", None, None, "decimal(20,0)"), ("BLOB", None, None, "binary"),
        ("TIME", None, None, "string"), ("DECIMAL", 65, 30, "string"), ("DATETIME", 3, None, "timestamp_ntz"),
        ("VARCHAR", 5, None, "string"), ("DECIMAL", None, None, "decimal(10,0)"),
    ]
    assert [tm.spark_type(*c[:3]) for c in cases] == [c[3] for c in cases]
    expr = tm.spark_type_text(F.col("t"), F.col("l"), F.col("s"))
    assert values("t string, l int, s int", [c[:3] for c in cases], expr) == [c[3] for c in cases]
    with pytest.raises(ValueError, match="shop.geo"):
        tm.spark_type("GEOMETRY", column="shop.geo")


def test_warehouse_types(values):
    rows = [("TINYINT", 0, 0), ("tinyint", 3, 0), ("DECIMALV3", 9, 2), ("LARGEINT", 0, 0), ("DATETIMEV2", 6, 3)]
    expr = tm.warehouse_to_spark(F.col("t"), F.col("p"), F.col("s"))
    assert values("t string, p int, s int", rows, expr) == ["boolean", "tinyint", "decimal(9,2)", "string", "timestamp_ntz"]
    with pytest.raises(PySparkException):
        values("t string, p int, s int", [("HLL", 0, 0)], expr)


def test_engine_to_warehouse(values):
    rows = [
        ("CHAR", 85, 0, 0), ("CHAR", 86, 0, 0), ("VARCHAR", 21844, 0, 0), ("VARCHAR", 21845, 0, 0), ("VARCHAR", 2147483647, 0, 0),
        ("DECIMAL", 0, 38, -2), ("DECIMAL", 0, 39, 2), ("TIMESTAMP", 0, 9, 0), ("TIMESTAMP_LTZ", 0, -1, 0), ("MAP", 0, 0, 0),
    ]
    expr = tm.engine_to_warehouse(F.col("t"), F.col("l"), F.col("p"), F.col("s"))
    assert values("t string, l int, p int, s int", rows, expr) == [
        "CHAR(255)", "VARCHAR(258)", "VARCHAR(65532)", "STRING", "STRING", "DECIMALV3(38,0)", "STRING", "DATETIMEV2(6)",
        "DATETIMEV2(0)", "STRING"]


def test_varchar_widen(values):
    cases = {"varchar(10)": "varchar(30)", "VARCHAR(21845)": "varchar(65533)", "varchar(0)": "varchar(0)", "int": "int", "": "", None: ""}
    assert values("x string", list(cases), tm.widen_varchar(F.col("x"))) == list(cases.values())


def test_nested_values(spark):
    df = spark.sql("""SELECT map('a', 1, 'b', CAST(NULL AS INT)) AS m, named_struct('d', DATE'2024-01-02', 'n', CAST(NULL AS INT)) AS s,
                      array(array(1, 2), array(3)) AS a, CAST(NULL AS map<string,int>) AS none, map(DATE'2024-01-02', 1) AS dm""")
    got = df.select(*[tx.nested_json(df, c).alias(c) for c in df.columns]).first()
    assert got.m == '{"a":"1","b":null}'
    assert got.s == '{"d":"2024-01-02","n":null}'
    assert got.a == '[["1","2"],["3"]]'
    assert got.dm == '{"2024-01-02":"1"}'
    assert got.none is None


def test_struct_json(spark):
    df = spark.sql("""SELECT CAST('hi' AS BINARY) AS b, CAST('12345678901234567890.120' AS DECIMAL(38,3)) AS d, CAST(NULL AS INT) AS n,
                      map(1, array('x')) AS pairs, map('k', CAST('hi' AS BINARY)) AS named, array(named_struct('b', CAST('hi' AS BINARY))) AS deep""")
    got = df.select(tx.struct_json(df, df.columns).alias("j")).first().j
    assert got == ('{"b":"aGk=","d":12345678901234567890.120,"n":null,"pairs":[[1,["x"]]],"named":{"k":"aGk="},'
                   '"deep":[{"b":"aGk="}]}')


def test_row_text_forms(spark):
    df = spark.sql("SELECT 1 AS a, CAST(NULL AS STRING) AS b, 'x' AS c")
    got = df.select(
        tx.row_json(["a", "b"], F.lit("1")).alias("j"), tx.row_delimited(["a", "b", "c"], ",", F.lit("0")).alias("d")
    ).first()
    assert got.j == '{"a":"1","b":null,"__DELETE_SIGN__":"1"}'
    assert got.d == "1,\\N,x,0"
