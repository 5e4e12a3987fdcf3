"""The landing files of the untidy binding."""

from pyspark.sql import functions as F

from metamart.plans import binding as B, dirty as D
from tests.conftest import SF0001


def test_written_cells_come_back_as_they_were(spark, tmp_path):
    rows = [("", "1995-01-01", "1.5"), ("   ", "1995-02-01", None), ('A\nAnnex "B"', None, "-2.0"), ("x, y", "1994-12-01", "3")]
    cells = spark.createDataFrame(rows, "p string, m string, v string").toDF("Plant", "Month", "")
    D._write(cells.repartition(2), str(tmp_path / "t"))
    back = D._written(spark, str(tmp_path / "t"), cells.columns)
    assert back.columns == cells.columns
    got = {tuple(c or "" for c in r) for r in back.collect()}
    assert got == {tuple(c or "" for c in r) for r in rows}


def test_the_reload_is_the_later_part_of_the_first_file(spark):
    wh = D.loaded(spark, SF0001)
    wide = D.files(spark, SF0001)[1]
    month = B.SOURCES[1][4]

    def rows(df):
        return sorted(tuple(str(c or "") for c in r) for r in df.collect())

    texts = wide.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in wide.columns])
    kept = texts.filter(F.col(month).isNull() | (F.col(month) >= D.RELOAD_FROM))
    assert rows(D._written(spark, wh.path("again", "source_1"), wide.columns)) == rows(kept)
