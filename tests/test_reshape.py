"""Hand fixtures 1-4: headers, cells, duplicates, case."""

from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Row

from metamart.operators import reshape as R
from metamart.operators.silver import silver, unmapped_columns, column_pairs
from tests.helpers import key_map, mapping

KEYS = [Row(SourceColumn="Werk", TargetColumn="Plant", DataType="text"),
        Row(SourceColumn="Monat", TargetColumn="Month", DataType="date")]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_header_trim_rename_and_text_trim(spark):
    df = spark.createDataFrame([(" \tP1 ", "2020-01-01", 3)], ["Werk", "Monat", " \tMenge A "])
    out = R.wide_to_bronze(df, 2, KEYS)
    assert out.columns == ["SourceID", "Plant", "Month", "SourceColumn", "Value"]
    assert rows(out) == [(2, "P1", date(2020, 1, 1), "Menge A", 3)]


def test_missing_key_header_is_an_error(spark):
    df = spark.createDataFrame([("P1", 3)], ["Werk", "Menge A"])
    with pytest.raises(R.MissingHeaderError):
        R.wide_to_bronze(df, 2, KEYS)


def test_cells_null_zero_fraction_negative(spark):
    df = spark.createDataFrame(
        [("P1", "2020-01-01", None, "0", "2.5", "-4", None),
         ("P2", "2020-01-01", "3.5", "1", "7", "5", None)],
        "Werk string, Monat string, a string, b string, c string, d string, allnull string")
    out = R.wide_to_bronze(df, 1, KEYS)
    got = {(r.Plant, r.SourceColumn): r.Value for r in out.collect()}
    assert ("P1", "a") not in got                  # null cell: no row
    assert got[("P1", "b")] == 0                   # zero kept
    assert got[("P1", "c")] == 2                   # 2.5 -> 2 (half to even)
    assert got[("P2", "a")] == 4                   # 3.5 -> 4
    assert got[("P1", "d")] == -4                  # negative kept (range rule reports it)
    assert not any(c == "allnull" for _, c in got)  # all-null column: no rows at all


def test_non_numeric_value_raises(spark):
    df = spark.createDataFrame([("P1", "2020-01-01", "abc")], ["Werk", "Monat", "a"])
    with pytest.raises(PySparkException):
        R.wide_to_bronze(df, 1, KEYS).collect()


def test_duplicate_headers_get_suffix(spark):
    df = spark.createDataFrame([("P1", "2020-01-01", 1, 2)], ["Werk", "Monat", "X", "X"])
    out = R.wide_to_bronze(df, 1, KEYS)
    assert rows(out.select("SourceColumn", "Value")) == [("X", 1), ("X_1", 2)]


def test_fifth_column_and_case_difference_are_unmapped(spark):
    df = spark.createDataFrame([("P1", "2020-01-01", 1, 2, 3)], ["Werk", "Monat", "Qty A", "qty a", "Extra"])
    b = R.wide_to_bronze(df, 1, KEYS)
    m = mapping(spark, [(1, 1, "Qty A", "Internal", "A", True)])
    assert rows(unmapped_columns(column_pairs(b), m)) == [(1, "Extra"), (1, "qty a")]
    assert silver(b, m).count() == 1


def test_same_header_after_trim_both_kept(spark):
    df = spark.createDataFrame([("P1", "2020-01-01", 1, 2)], ["Werk", "Monat", "X", " X"])
    out = R.wide_to_bronze(df, 1, KEYS)
    assert rows(out.select("SourceColumn", "Value")) == [("X", 1), ("X", 2)]


def test_ingest_several_sources_one_frame(spark):
    from metamart.sources.landing import ingest
    km = key_map(spark, [(1, "Plant", "Plant", "text"), (1, "Month", "Month", "date"),
                         (2, "Werk", "Plant", "text"), (2, "Monat", "Month", "date")])
    a = spark.createDataFrame([("P1", "2020-01-01", 1)], ["Plant", "Month", "Qty A"])
    b = spark.createDataFrame([("P2", "2020-02-01", 5)], ["Werk", "Monat", "Menge A"])
    out = ingest({1: a, 2: b}, km)
    assert rows(out) == [(1, "P1", date(2020, 1, 1), "Qty A", 1), (2, "P2", date(2020, 2, 1), "Menge A", 5)]


def test_read_wide_csv_keeps_exact_headers(spark, tmp_path):
    from metamart.sources.landing import read_wide
    p = tmp_path / "src.csv"
    p.write_text("Werk,Monat,Qty A,qty a,Qty A\nP1,2020-01-01,1,2,3\n", encoding="utf-8")
    df = read_wide(spark, str(p))
    assert df.columns == ["Werk", "Monat", "Qty A", "qty a", "Qty A"]
    out = R.wide_to_bronze(df, 1, KEYS)
    assert rows(out.select("SourceColumn", "Value")) == [("Qty A", 1), ("Qty A_1", 3), ("qty a", 2)]


def test_read_wide_csv_with_byte_order_mark(spark, tmp_path):
    from metamart.sources.landing import read_wide
    p = tmp_path / "bom.csv"
    p.write_bytes("\ufeffWerk,Monat,Qty A\r\nP1,2020-01-01,1\r\n".encode("utf-8"))
    out = R.wide_to_bronze(read_wide(spark, str(p)), 1, KEYS)
    assert rows(out.select("Plant", "SourceColumn", "Value")) == [("P1", "Qty A", 1)]
