"""Point grids: a sheet's box and step in one pass over its lines."""

import pytest

from strataspark.sources import ascii as texts


def _lines(spark, rows):
    return spark.createDataFrame([(name, n, text) for n, (name, text) in enumerate(rows)], "plik string, line_no int, text string")


def test_lines_are_read_once_for_the_sheets(spark, tmp_path):
    _lines(spark, [("a.xyz", f"{k % 4} {k // 4} {k}") for k in range(16)]).write.parquet(str(tmp_path / "lines"))
    meta = texts.read_xyz(spark.read.parquet(str(tmp_path / "lines")))[0]
    assert meta._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    row = meta.head()
    assert (row.plik, row.res, row.left, row.top, row.ncols, row.nrows) == ("a.xyz", 1.0, -0.5, 3.5, 4, 4)


def test_box_is_of_the_coordinates_and_step_of_their_rounded_values(spark):
    rows = [("a.xyz", "0.0004 0 1"), ("a.xyz", "\t1.0003 0 2 "), ("a.xyz", "2.0001\x0b 0\f3"), ("a.xyz", "2.0004 0.01 4")]  # two x that are one when rounded; y too close
    rows += [("b.xyz", "5 7 1"), ("b.xyz", "5 7.5 2"), ("b.xyz", "5 9 3")]  # one x: the step is that of y
    rows += [("c.xyz", "1 1 1"), ("c.xyz", "1 1 2")]  # no step, no sheet
    rows += [("d.xyz", "1 2"), ("d.xyz", "1 2 x"), ("d.xyz", "1 2 3 4"), ("e_l.xyz", "1 1 1"), ("e_l.xyz", "2 2 2")]
    got = {r.plik: r for r in texts.extent_and_step(texts.xyz_points(_lines(spark, rows))).collect()}
    assert set(got) == {"a.xyz", "b.xyz", "c.xyz", "e_l.xyz"}
    assert tuple(got["a.xyz"])[1:] == pytest.approx((0.0004, 2.0004, 0.0, 0.01, 1.0), abs=1e-12)
    assert tuple(got["b.xyz"])[1:] == (5.0, 5.0, 7.0, 9.0, 0.5) and got["c.xyz"].step is None
    meta, cells = texts.read_xyz(_lines(spark, rows))
    assert {r.plik for r in meta.collect()} == {r.plik for r in cells.collect()} == {"a.xyz", "b.xyz"}
