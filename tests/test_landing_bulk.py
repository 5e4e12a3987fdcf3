"""One-job ingest of many CSV landing files equals the per-source path."""

import csv as _csv
import datetime
import os

import pytest

from metamart import schemas
from metamart.operators.reshape import MissingHeaderError
from metamart.plans import binding as B
from metamart.sources import landing, warehouse as W
from tests.conftest import SF0001


def write_csv(path, header, rows):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = _csv.writer(f)
        w.writerow(header)
        for r in rows:
            w.writerow(["" if v is None else v for v in r])


def test_bulk_csv_ingest_matches_per_source(spark, tmp_path):
    wides = B.wide_sources(spark, SF0001)
    reg = []
    for sid, df in wides.items():
        p = tmp_path / "landing" / f"source_{sid}.csv"
        os.makedirs(p.parent, exist_ok=True)
        pdf = df.toPandas()
        pdf.iloc[:, 1] = pdf.iloc[:, 1].astype(str)
        write_csv(p, list(df.columns), pdf.astype(object).where(pdf.notna(), None).values.tolist())
        reg.append((sid, f"landing/source_{sid}.csv"))
    sources = spark.createDataFrame(reg, "SourceId int, FilePath string")
    bulk = landing.ingest_landing(spark, sources, B.key_map(spark), str(tmp_path))
    ref = landing.ingest(wides, B.key_map(spark))
    assert sorted(map(tuple, bulk.collect())) == sorted(map(tuple, ref.collect()))


def test_bulk_edge_cases_and_replace(spark, tmp_path, root):
    d = tmp_path / "in"
    os.makedirs(d)
    write_csv(d / "a.csv", ["Plant", "Month", "Qty A", "qty a", "Qty A", " X\t"],
              [[" P1\t", "2020-01-01", "2.5", "1", None, "-3"], ["P2", "2020-02-01", None, None, "7", "0"]])
    write_csv(d / "b.csv", ["Werk", "Monat", "Menge, A"], [["W", "2021-01-01", "3.5"]])
    write_csv(d / "c.csv", ["Werk", "Monat", "Menge, A"], [])
    keys = spark.createDataFrame([(1, "Plant", "Plant", "text"), (1, "Month", "Month", "date"),
                                  (2, "Werk", "Plant", "text"), (2, "Monat", "Month", "date"),
                                  (3, "Werk", "Plant", "text"), (3, "Monat", "Month", "date")],
                                 schemas.KEY_COLUMN_MAPPING)
    sources = spark.createDataFrame([(1, "a.csv"), (2, "b.csv"), (3, "c.csv")], "SourceId int, FilePath string")
    rows = sorted((r.SourceID, r.Plant, r.SourceColumn, r.Value)
                  for r in landing.ingest_landing(spark, sources, keys, str(d)).collect())
    assert rows == [(1, "P1", "Qty A", 2), (1, "P1", "X", -3), (1, "P1", "qty a", 1),
                    (1, "P2", "Qty A_1", 7), (1, "P2", "X", 0), (2, "W", "Menge, A", 4)]
    wh = W.Warehouse(spark, root)
    W.replace_sources(wh, {3: landing.ingest({3: spark.createDataFrame(
        [("W", "2020-01-01", 1)], ["Werk", "Monat", "Menge, A"])}, keys)})
    emptied = W.replace_sources_bulk(wh, landing.ingest_landing(spark, sources, keys, str(d)), [1, 2, 3])
    assert emptied == [3]
    per = {r.SourceID: r["count"] for r in W.load_bronze(wh).groupBy("SourceID").count().collect()}
    assert per == {1: 5, 2: 1}


def test_bulk_odd_file_names_and_part_folders(spark, tmp_path):
    d = tmp_path / "odd dir+x"
    os.makedirs(d / "folder")
    write_csv(d / "a+b c%.csv", ["Plant", "Month", "Q"], [["P", "2020-01-01", "1"]])
    write_csv(d / "folder" / "part-0.csv", ["Plant", "Month", "Q"], [["P", "2020-02-01", "2"]])
    write_csv(d / "folder" / "part-1.csv", ["Plant", "Month", "R"], [["P", "2020-03-01", "3"]])
    (d / "folder" / "_SUCCESS").write_text("")
    keys = spark.createDataFrame([(s, c, c, t) for s in (1, 2) for c, t in (("Plant", "text"), ("Month", "date"))],
                                 schemas.KEY_COLUMN_MAPPING)
    sources = spark.createDataFrame([(1, "a+b c%.csv"), (2, "folder")], "SourceId int, FilePath string")
    got = sorted((r.SourceID, r.SourceColumn, r.Value)
                 for r in landing.ingest_landing(spark, sources, keys, str(d)).collect())
    assert got == [(1, "Q", 1), (2, "Q", 2), (2, "R", 3)]


def test_bulk_csv_with_byte_order_mark_and_crlf(spark, tmp_path):
    d = tmp_path / "bom"
    os.makedirs(d)
    (d / "a.csv").write_bytes("\ufeffPlant,Month,Q\r\nP,2020-01-01,4\r\n".encode("utf-8"))
    keys = spark.createDataFrame([(1, "Plant", "Plant", "text"), (1, "Month", "Month", "date")],
                                 schemas.KEY_COLUMN_MAPPING)
    sources = spark.createDataFrame([(1, "a.csv")], "SourceId int, FilePath string")
    got = [(r.Plant, r.SourceColumn, r.Value) for r in landing.ingest_landing(spark, sources, keys, str(d)).collect()]
    assert got == [("P", "Q", 4)]


KEYS = [(s, c, c, t) for s in (1, 2) for c, t in (("Plant", "text"), ("Month", "date"))]


def one_file(spark, folder, header, rows, keys=KEYS, name="a.csv"):
    os.makedirs(folder, exist_ok=True)
    write_csv(folder / name, header, rows)
    sources = spark.createDataFrame([(1, name)], "SourceId int, FilePath string")
    return landing.ingest_landing(spark, sources, spark.createDataFrame(keys, schemas.KEY_COLUMN_MAPPING), str(folder))


def test_header_longer_than_a_mebibyte(spark, tmp_path):
    heads = [f"Q{i} " + "x" * 12_000 for i in range(100)]
    got = one_file(spark, tmp_path / "w", ["Plant", "Month", *heads], [["P", "2020-01-01", *range(100)]])
    assert sorted(r.Value for r in got.collect()) == list(range(100))


def test_whole_numbers_above_double_precision_stay_exact(spark, tmp_path):
    got = one_file(spark, tmp_path / "n", ["Plant", "Month", "Q"],
                   [["P", "2020-01-01", 9007199254740993], ["P", "2020-02-01", "2.5"], ["P", "2020-03-01", "-3.5"]])
    assert sorted(r.Value for r in got.collect()) == [-4, 2, 9007199254740993]


def test_cells_behind_the_last_header_raise(spark, tmp_path):
    with pytest.raises(Exception, match="behind the last header"):
        one_file(spark, tmp_path / "x", ["Plant", "Month", "Q"], [["P", "2020-01-01", "5", "77"]]).collect()


def test_unclosed_quote_raises(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Plant,Month,Q\n"P,2020-01-01,5\n')
    sources = spark.createDataFrame([(1, "a.csv")], "SourceId int, FilePath string")
    with pytest.raises(Exception, match="unexpected end of data"):
        landing.ingest_landing(spark, sources, spark.createDataFrame(KEYS, schemas.KEY_COLUMN_MAPPING), str(tmp_path)).collect()


def test_key_headers_must_be_there_and_unique(spark, tmp_path):
    keys = [(1, "Werk", "Plant", "text"), (1, "Month", "Month", "date")]
    for header in (["Plant", "Month", "Q"], ["Werk", "Plant", "Month"]):
        with pytest.raises(Exception, match="MissingHeaderError"):
            one_file(spark, tmp_path / header[1], header, [["P", "2020-01-01", "5"]], keys).collect()


def both_ways(spark, folder, files, keys):
    """Rows of the one-scan ingest and of the per-source path, which must agree."""
    key_map = spark.createDataFrame(keys, schemas.KEY_COLUMN_MAPPING)
    sources = spark.createDataFrame([(s, f) for s, f in files.items()], "SourceId int, FilePath string")
    rows = sorted(map(tuple, landing.ingest_landing(spark, sources, key_map, str(folder)).collect()), key=str)
    each = landing.ingest({s: landing.read_wide(spark, str(folder / f)) for s, f in files.items()}, key_map)
    assert rows == sorted(map(tuple, each.collect()), key=str)
    return rows


def test_quoted_line_breaks_blank_headers_and_languages(spark, tmp_path):
    write_csv(tmp_path / "a.csv", ["Plant", "Month", "Q", "", "", "two\nlines"],
              [["P\nX", "2020-01-01", "5", "6", None, "1"], ['say "hi", you', "2020-02-01", None, None, "7", None]])
    write_csv(tmp_path / "b.csv", ["Werk", "", "Monat", "Menge"], [["W", "9", "2020-01-01", "2.5"], ["", "1", "", ""]])
    write_csv(tmp_path / "c.csv", ["Mois", "Usine", "Quantité", "Column4", ""], [["2020-03-01", " U\t", "-1.5", "3", "4"]])
    keys = [(1, "Plant", "Plant", "text"), (1, "Month", "Month", "date"), (2, "Werk", "Plant", "text"),
            (2, "Monat", "Month", "date"), (3, "Usine", "Plant", "text"), (3, "Mois", "Month", "date")]
    rows = both_ways(spark, tmp_path, {1: "a.csv", 2: "b.csv", 3: "c.csv"}, keys)
    assert [(r[0], r[1], r[3], r[4]) for r in rows] == [
        (1, "P\nX", "Column4", 6), (1, "P\nX", "Q", 5), (1, "P\nX", "two\nlines", 1), (1, 'say "hi", you', "Column5", 7),
        (2, "W", "Column2", 9), (2, "W", "Menge", 2), (2, None, "Column2", 1),
        (3, "U", "Column4", 3), (3, "U", "Column5", 4), (3, "U", "Quantité", -2)]


def test_keys_are_typed_by_their_metadata(spark, tmp_path):
    # source 1: Month is text, Plant untyped; source 2: an identifying column that bronze lacks
    write_csv(tmp_path / "a.csv", ["Plant", "Month", "Q"], [[" P ", " 2020-01-01 ", "5"]])
    write_csv(tmp_path / "b.csv", ["Werk", "Land", "Monat", "Menge"], [[" W ", "DE", "2020-01-01", "7"]])
    keys = [(1, "Plant", "Plant", "any"), (1, "Month", "Month", "text"), (2, "Werk", "Plant", "text"),
            (2, "Land", "Country", "text"), (2, "Monat", "Month", "date")]
    rows = both_ways(spark, tmp_path, {1: "a.csv", 2: "b.csv"}, keys)
    day = datetime.date(2020, 1, 1)
    assert rows == [(1, " P ", day, "Q", 5), (2, "W", day, "Menge", 7)]


def test_short_rows_and_blank_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Plant,Month,Q,R\n\nP,2020-01-01,4\n\nP,2020-02-01\n")
    rows = both_ways(spark, tmp_path, {1: "a.csv"}, KEYS[:2])
    assert [(r[3], r[4]) for r in rows] == [("Q", 4)]


def test_one_file_registered_twice_raises(spark, tmp_path):
    write_csv(tmp_path / "a.csv", ["Plant", "Month", "Q"], [["P", "2020-01-01", "5"]])
    sources = spark.createDataFrame([(1, "a.csv"), (2, "./a.csv")], "SourceId int, FilePath string")
    with pytest.raises(ValueError, match="same file"):
        landing.ingest_landing(spark, sources, spark.createDataFrame(KEYS, schemas.KEY_COLUMN_MAPPING), str(tmp_path))


def test_wide_reader_keeps_quoted_line_breaks(spark, tmp_path):
    write_csv(tmp_path / "q.csv", ["Plant", "Month", "Q"], [["P\nX", "2020-01-01", "5"], ["Y", "2020-02-01", "6"]])
    got = landing.ingest({1: landing.read_wide(spark, str(tmp_path / "q.csv"))}, spark.createDataFrame(KEYS[:2], schemas.KEY_COLUMN_MAPPING))
    assert sorted((r.Plant, r.Value) for r in got.collect()) == [("P\nX", 5), ("Y", 6)]
