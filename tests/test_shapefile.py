import datetime as dt
import glob
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterline.functions.geometry import area
from meterline.plans.warehouse import TripWarehouse
from meterline.sources.shapefile import polygons_of, read_shapefile, write_shapefile

SQUARE = [[0.0, 0.0], [10.0, 0.0], [10.0, 10.0], [0.0, 10.0], [0.0, 0.0]]
HOLE = [[1.0, 1.0], [1.0, 2.0], [2.0, 2.0], [2.0, 1.0], [1.0, 1.0]]
FAR = [[20.0, 20.0], [24.0, 20.0], [24.0, 24.0], [20.0, 24.0]]  # open
SCHEMA = "id BIGINT, zone STRING, share DOUBLE, day DATE, live BOOLEAN, polygons ARRAY<ARRAY<ARRAY<ARRAY<DOUBLE>>>>"


def rows():
    return [(1, "Bronx é", 0.1, dt.date(2024, 2, 29), True, [[SQUARE, HOLE]]),
            (2, None, None, None, None, [[SQUARE], [FAR]]),
            (-2 ** 63, "", -1.7976931348623157e308, dt.date(1999, 1, 1), False, None),
            (4, " x ", 5e-324, None, True, [])]


def test_round_trip_keeps_attributes_and_areas(spark, tmp_path):
    path = str(tmp_path / "zones")
    write_shapefile(spark.createDataFrame(rows(), SCHEMA), path)
    got = {r.id: r for r in read_shapefile(spark, path).withColumn("area", area(F.col("polygons"))).collect()}
    assert len(got) == 4
    assert (got[1].zone, got[1].share, got[1].day, got[1].live) == ("Bronx é", 0.1, dt.date(2024, 2, 29), True)
    assert (got[2].zone, got[2].share, got[2].day, got[2].live) == (None, None, None, None)
    assert (got[-2 ** 63].zone, got[-2 ** 63].share, got[4].zone, got[4].share) == (None, -1.7976931348623157e308, " x", 5e-324)
    assert (got[1].geom_type, got[1].area, [len(p) for p in got[1].polygons]) == ("Polygon", 99.0, [2])
    assert (got[2].geom_type, got[2].area, [len(p) for p in got[2].polygons]) == ("MultiPolygon", 116.0, [1, 1])
    assert got[-2 ** 63].polygons is None and got[4].polygons is None and got[4].geom_type is None


@pytest.mark.parametrize("partition_bytes", [64, 137, 1000, 1 << 20])
def test_every_cut_gives_each_record_once(spark, tmp_path, partition_bytes):
    path = str(tmp_path / "many")
    df = spark.range(200).select("id", F.expr("transform(sequence(1, cast(1 + id % 3 as int)), k -> array(array(array(id * 10D, k * 1D), "
                                              "array(id * 10D, k + 1D), array(id * 10D + 1D, k + 1D), array(id * 10D + 1D, k * 1D))))").alias("polygons"))
    write_shapefile(df.repartition(3), path, file_bytes=9000)
    assert len(glob.glob(path + "/*.shp")) > 3
    back = read_shapefile(spark, path, partition_bytes)
    assert back.rdd.getNumPartitions() >= len(glob.glob(path + "/*.shp"))
    assert sorted((r.id, r.a) for r in back.select("id", area(F.col("polygons")).alias("a")).collect()) == [(i, 1.0 + i % 3) for i in range(200)]


def test_one_file_of_another_writer(spark, tmp_path):
    """A file laid out by hand: z values behind the points, a deleted row, a numeric field with decimals."""
    ring = np.array([[0, 0], [0, 4], [4, 4], [4, 0], [0, 0]], "<f8")
    content = struct.pack("<i4dii", 15, 0, 0, 4, 4, 1, 5) + struct.pack("<i", 0) + ring.tobytes() + bytes(16 + 40)
    record = lambda n: struct.pack(">ii", n, len(content) // 2) + content
    head = lambda size: struct.pack(">i20xi", 9994, size // 2) + struct.pack("<ii8d", 1000, 15, 0, 0, 4, 4, 0, 0, 0, 0)
    body = record(1) + record(2)
    (tmp_path / "a.shp").write_bytes(head(100 + len(body)) + body)
    (tmp_path / "a.shx").write_bytes(head(116) + struct.pack(">4i", 50, len(content) // 2, 50 + len(record(1)) // 2, len(content) // 2))
    fields = struct.pack("<11sc4xBB14x", b"AREA", b"N", 8, 2) + struct.pack("<11sc4xBB14x", b"NAME", b"C", 4, 0)
    (tmp_path / "a.dbf").write_bytes(struct.pack("<4BIHH20x", 3, 100, 1, 1, 2, 32 + 64 + 1, 13) + fields + b"\r" + b" " + b"   16.50" + b"ab  " + b"*" + b"    1.00" + b"cd  ")
    got = read_shapefile(spark, str(tmp_path / "a.shp")).collect()
    assert [(r.AREA, r.NAME, r.geom_type, r.polygons) for r in got] == [(16.5, "ab", "Polygon", [[ring.tolist()]])]


def test_holes_go_to_the_smallest_shell_around_them():
    turn = lambda ring: np.array(ring[::-1])  # noqa: E731  clockwise
    inner = [[3.0, 3.0], [9.0, 3.0], [9.0, 9.0], [3.0, 9.0], [3.0, 3.0]]
    deep = np.array([[4.0, 4.0], [5.0, 4.0], [5.0, 5.0], [4.0, 5.0], [4.0, 4.0]])  # counterclockwise: a hole of inner
    lone = np.array([[50.0, 50.0], [51.0, 50.0], [51.0, 51.0], [50.0, 50.0]])
    got = polygons_of([deep, turn(SQUARE), turn(inner), lone])
    assert [[len(r) for r in p] for p in got] == [[5], [5, 5], [4]]
    assert got[1][1] == deep.tolist()


def test_empty_tables_overwrites_and_refusals(spark, tmp_path):
    path = str(tmp_path / "zones")
    df = spark.createDataFrame(rows(), SCHEMA)
    write_shapefile(df, path)
    write_shapefile(df, path, mode="append")
    assert read_shapefile(spark, path).count() == 8
    write_shapefile(df.where("id = 1"), path)
    assert read_shapefile(spark, path).count() == 1
    assert not glob.glob(path + "/_job_*")
    with pytest.raises(FileNotFoundError):
        read_shapefile(spark, str(tmp_path / "none"))
    with pytest.raises(Exception, match="10 ASCII"):
        write_shapefile(df.withColumnRenamed("zone", "longer_than_ten"), path)
    with pytest.raises(Exception, match="its field"):
        write_shapefile(df, path, text_bytes=2)
    assert read_shapefile(spark, path).count() == 1


def test_a_warehouse_reads_its_zones_from_a_shapefile(spark, tmp_path):
    df = spark.createDataFrame(rows(), SCHEMA).where("id = 1").select(F.col("id").alias("LocationID"), "polygons").coalesce(1)
    write_shapefile(df, str(tmp_path / "shp"))
    shp, = glob.glob(str(tmp_path / "shp" / "*.shp"))
    spark.range(1).write.parquet(str(tmp_path / "trips"))
    (tmp_path / "zones.csv").write_text("LocationID,Borough,Zone,service_zone\n1,B,Z,S\n")
    wh = TripWarehouse.from_files(spark, str(tmp_path / "trips"), str(tmp_path / "zones.csv"), shp, zones_schema=None)
    zone, = wh.dim_zones_geo().collect()
    assert (zone.LocationID, zone.zone_area_sq_meters) == ("1", 99.0) and zone.geometry_wkt.startswith("POLYGON ((")
