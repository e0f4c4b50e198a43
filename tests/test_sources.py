"""Delimited readers: quoting, trimming, null / sentinel rejection, typed casts."""

from airmesh.sources import delimited
from airmesh.sources.schemas import AIRPORT_FIELDS, Field, pick
from pyspark.sql import types as T

GOLDEN = '1,"Goroka, Airport","X ""q"" Y",PG,\\N,"",-6.08,145.39\n2, Madang ,c,,"\\N",ZZ,notnum,1\n3,short\n'


def _write(tmp_dir, text, name="airports.dat"):
    path = f"{tmp_dir}/{name}"
    with open(path, "w") as f:
        f.write(text)
    return path


def test_raw_csv_options(spark, tmp_dir):
    path = _write(tmp_dir, GOLDEN)
    raw = spark.read.options(**delimited.CSV_OPTIONS).schema(delimited.text_schema(8)).csv(path)
    rows = sorted(tuple(r) for r in raw.collect())
    assert rows[0] == ("1", "Goroka, Airport", 'X "q" Y', "PG", "\\N", None, "-6.08", "145.39")
    assert rows[1] == ("2", "Madang", "c", None, "\\N", "ZZ", "notnum", "1")
    assert rows[2] == ("3", "short", None, None, None, None, None, None)


def test_reject_then_cast(spark, tmp_dir):
    path = _write(tmp_dir, GOLDEN)
    fields = (Field(0, "id", T.LongType()), Field(6, "latitude", T.DoubleType()))
    got = sorted(tuple(r) for r in delimited.read_delimited(spark, path, fields).collect())
    # row 3 has a null latitude → dropped; 'notnum' survives the filter and casts to null
    assert got == [(1, -6.08), (2, None)]


def test_sentinel_only_checked_on_selected_columns(spark, tmp_dir):
    path = _write(tmp_dir, GOLDEN)
    with_iata = delimited.read_airports(spark, path, pick(AIRPORT_FIELDS, "id", "iata"))
    without = delimited.read_airports(spark, path, pick(AIRPORT_FIELDS, "id", "name"))
    assert with_iata.count() == 0  # both rows carry the sentinel as IATA, row 3 has no IATA
    assert sorted(r.id for r in without.collect()) == [1, 2, 3]


def test_headered_sensor_read(spark, tmp_dir):
    text = "Subject,Position,Session,A_x,A_y,A_z,G_x,G_y,G_z,C_1,Workout\n1,wrist,2,0.1,0.2,0.3,1,2,3,9.5,Squat\n2,leg,x,bad,,0,0,0,0,0,Null\n"
    path = _write(tmp_dir, text, "sensor.csv")
    rows = delimited.read_headered(spark, path).orderBy("Subject").collect()
    assert rows[0].A_x == 0.1 and rows[0].Workout == "Squat" and rows[0].Session == 2
    assert rows[1].Session is None and rows[1].A_x is None and rows[1].A_y is None
