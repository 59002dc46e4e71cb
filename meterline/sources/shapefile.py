"""Polygon shapefiles as a Spark data source (``.shp`` + ``.shx`` + ``.dbf``).

``read_shapefile`` reads one ``.shp`` or a folder of them, ``write_shapefile``
writes a folder of them. Files are opened in tasks through ``pyarrow.fs``
(local and mounted paths, ``hdfs:``, ``s3:``, ``gs:``), never on one machine's
temporary folder.

A read is cut by bytes of the ``.shp``: a partition owns the records that start
in its range, finds them by binary search in the ``.shx`` and reads only those
ranges of the three files, a few megabytes at a time.
"""

from __future__ import annotations

import datetime as dt
import struct
import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from meterline.sources.files import require_files

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the package

GEOMETRY = "polygons"

# fixed values of the file format
FILE_CODE, VERSION, HEADER_BYTES, INDEX_BYTES = 9994, 1000, 100, 8
NULL_SHAPE, POLYGON = 0, 5
POLYGON_KINDS = (5, 15, 25)  # plain, with z, with m: all start with the same x, y block
DBF_HEADER, DBF_FIELD, DBF_END, DBF_LIVE, DBF_DELETED = 32, 32, b"\r", b" ", b"*"

READ_BYTES = 4 << 20  # records decoded at a time
FILE_BYTES = 64 << 20  # a writer's file is closed at this size


def _open(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _shapes(path: str) -> list[str]:
    """The ``.shp`` files of a folder, or the one file."""
    files, at = _open(path)
    if at.lower().endswith(".shp"):
        return [at]
    found = files.get_file_info(fs.FileSelector(at))
    return sorted(f.path for f in found if f.is_file and f.path.lower().endswith(".shp"))


def _beside(shp: str, ending: str) -> str:
    return shp[:-4] + (ending.upper() if shp.endswith(".SHP") else ending)


# --- attributes -------------------------------------------------------------

class Table:
    """The layout of a ``.dbf``: rows of fixed width after a header of fields."""

    def __init__(self, source: pa.NativeFile):
        head = source.read(DBF_HEADER)
        self.rows, self.header, self.width = struct.unpack("<IHH", head[4:12])
        self.fields: list[tuple[str, DataType, int, int]] = []  # name, type, place in the row, width
        place = 1
        for raw in (source.read(DBF_FIELD) for _ in range((self.header - DBF_HEADER - 1) // DBF_FIELD)):
            if raw[:1] == DBF_END:
                break
            kind, width, decimals = chr(raw[11]), raw[16], raw[17]
            of = {"D": DateType(), "L": BooleanType(), "F": DoubleType()}.get(kind, StringType())
            if kind == "N":
                of = LongType() if decimals == 0 and width <= 20 else DoubleType()
            self.fields.append((raw[:11].split(b"\0")[0].decode("ascii", "replace"), of, place, width))
            place += width


def _value(raw: bytes, of: DataType, encoding: str):
    text = raw.decode(encoding, "replace").rstrip(" \0")
    if isinstance(of, StringType):
        return text or None
    text = text.strip()
    if not text or text.startswith("*"):  # blank, or a number that did not fit
        return None
    if isinstance(of, BooleanType):
        return {"T": True, "Y": True, "F": False, "N": False}.get(text.upper())
    if isinstance(of, DateType):
        return dt.date(int(text[:4]), int(text[4:6]), int(text[6:8])) if text.isdigit() and int(text) else None
    return int(text) if isinstance(of, LongType) else float(text)


# --- rings ------------------------------------------------------------------

def _doubled_area(ring: np.ndarray) -> float:
    """Twice the signed area, positive where the ring runs counterclockwise."""
    x, y = (ring - ring[0]).T if len(ring) else ring.T
    return float(np.sum(x * np.roll(y, -1) - np.roll(x, -1) * y))


def _share_inside(points: np.ndarray, ring: np.ndarray) -> float:
    """The share of the points inside the ring, by crossings of a ray."""
    a, b = ring, np.roll(ring, -1, axis=0)
    rise = np.where(b[:, 1] == a[:, 1], 1.0, b[:, 1] - a[:, 1])
    odd = 0
    for x, y in points:
        crosses = (a[:, 1] > y) != (b[:, 1] > y)
        at = a[:, 0] + (y - a[:, 1]) * (b[:, 0] - a[:, 0]) / rise
        odd += int(np.count_nonzero(crosses & (x < at)) % 2)
    return odd / max(1, len(points))


def polygons_of(rings: list[np.ndarray]) -> list[list[list[list[float]]]]:
    """Rings of one record as polygons: clockwise rings are shells, the others
    holes of the smallest shell around them. A hole outside of all shells becomes
    a shell, so no ring is lost."""
    turns = [_doubled_area(r) for r in rings]
    shells = [i for i, t in enumerate(turns) if t <= 0]
    members: dict[int, list[int]] = {i: [i] for i in shells}
    for i, turn in enumerate(turns):
        if turn <= 0:
            continue
        lo, hi = rings[i].min(axis=0), rings[i].max(axis=0)
        middles = (rings[i] + np.roll(rings[i], -1, axis=0)) / 2
        around = [s for s in shells if (rings[s].min(axis=0) <= lo).all() and (rings[s].max(axis=0) >= hi).all()
                  and _share_inside(middles[:64], rings[s]) > 0.5]
        members.setdefault(min(around, key=lambda s: -turns[s], default=i), []).append(i)
    return [[rings[i].tolist() for i in group] for _, group in sorted(members.items())]


def _decode(content: bytes) -> list | None:
    kind, = struct.unpack_from("<i", content)
    if kind == NULL_SHAPE:
        return None
    if kind not in POLYGON_KINDS:
        raise ValueError(f"shape type {kind} is no polygon")
    parts, points = struct.unpack_from("<ii", content, 36)
    starts = np.frombuffer(content, "<i4", parts, 44)
    xy = np.frombuffer(content, "<f8", 2 * points, 44 + 4 * parts).reshape(-1, 2)
    return polygons_of([r for r in np.split(xy, starts[1:]) if len(r)])


def _encode(polygons: list | None) -> tuple[bytes, tuple[float, float, float, float] | None]:
    """Record content and its box: shells clockwise, holes counterclockwise, rings closed."""
    rings = []
    for polygon in polygons or []:
        for at, points in enumerate(polygon or []):
            ring = np.asarray(points, "<f8").reshape(-1, 2)
            if not len(ring):
                continue
            if (ring[0] != ring[-1]).any():
                ring = np.vstack([ring, ring[:1]])
            rings.append(ring[::-1] if (_doubled_area(ring) > 0) == (at == 0) else ring)
    if not rings:
        return struct.pack("<i", NULL_SHAPE), None
    xy = np.vstack(rings)
    box = (*xy.min(axis=0).tolist(), *xy.max(axis=0).tolist())
    starts = np.cumsum([0] + [len(r) for r in rings[:-1]]).astype("<i4")
    return struct.pack("<i4dii", POLYGON, *box, len(rings), len(xy)) + starts.tobytes() + xy.tobytes(), box


# --- reading ----------------------------------------------------------------

class Cut(InputPartition):
    """The records of ``shp`` that start at byte ``first`` or later, before ``last``."""

    def __init__(self, shp: str, first: int, last: int):
        super().__init__((shp, first, last))
        self.shp, self.first, self.last = shp, first, last


class ShapefileReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.schema, self.path = schema, options["path"]
        self.encoding = options.get("encoding", "utf-8")
        self.bytes = int(options.get("partitionBytes", 64 << 20))

    def partitions(self) -> list[Cut]:
        files, _ = _open(self.path)
        sizes = {f.path: f.size for f in files.get_file_info(_shapes(self.path))}
        return [Cut(shp, at, at + self.bytes) for shp, size in sorted(sizes.items()) for at in range(0, max(size, 1), self.bytes)]

    def read(self, partition: Cut) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        files, _ = _open(self.path)
        arrow = to_arrow_schema(self.schema)
        with (files.open_input_file(partition.shp) as shp, files.open_input_file(_beside(partition.shp, ".shx")) as shx,
              files.open_input_file(_beside(partition.shp, ".dbf")) as dbf):
            table = Table(dbf)
            fields = {f[0].lower(): f for f in table.fields}
            records = (shx.size() - HEADER_BYTES) // INDEX_BYTES

            def index(first: int, n: int) -> np.ndarray:
                """Bytes (start, content length) of ``n`` records."""
                return np.frombuffer(shx.read_at(n * INDEX_BYTES, HEADER_BYTES + first * INDEX_BYTES), ">i4").reshape(-1, 2).astype(np.int64) * 2

            def starting(at: int) -> int:
                """The first record that starts at byte ``at`` or later."""
                lo, hi = 0, records
                while lo < hi:
                    mid = (lo + hi) // 2
                    lo, hi = (mid + 1, hi) if index(mid, 1)[0, 0] < at else (lo, mid)
                return lo

            at, end = starting(partition.first), starting(partition.last)
            while at < end:
                places = index(at, min(end - at, 4096))
                upto = max(1, int(np.searchsorted(places[:, 0] + places[:, 1], places[0, 0] + READ_BYTES)))
                places = places[:upto]
                start = int(places[0, 0])
                data = shp.read_at(int(places[-1].sum()) + 8 - start, start)
                rows = dbf.read_at(table.width * upto, table.header + at * table.width)
                keep = [i for i in range(upto) if rows[i * table.width:i * table.width + 1] != DBF_DELETED]
                columns = []
                for field in arrow:
                    if field.name == GEOMETRY:
                        values = [_decode(data[p + 8 - start:p + 8 - start + n]) for p, n in places[keep].tolist()]
                    elif field.name.lower() in fields:
                        _, of, place, width = fields[field.name.lower()]
                        values = [_value(rows[i * table.width + place:i * table.width + place + width], of, self.encoding) for i in keep]
                    else:
                        values = [None] * len(keep)
                    columns.append(pa.array(values, field.type))
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)
                at += upto


# --- writing ----------------------------------------------------------------

class Written(WriterCommitMessage):
    def __init__(self, stems: list[str]):
        self.stems = stems


ENDINGS = (".shp", ".shx", ".dbf", ".cpg")


class ShapefileWriter(DataSourceWriter):
    """Tasks write whole files into a folder of this job's; the commit moves those of
    the successful attempts to the target, so a repeated or lost task leaves nothing."""

    def __init__(self, schema: StructType, options: dict, overwrite: bool):
        self.schema, self.overwrite, self.path = schema, overwrite, options["path"].rstrip("/")
        self.file_bytes = int(options.get("fileBytes", FILE_BYTES))
        self.width = int(options.get("textBytes", 254))
        self.job = "_job_" + uuid.uuid4().hex
        self.columns = [f for f in schema.fields if f.name != GEOMETRY]
        kinds = {StringType: ("C", self.width), LongType: ("N", 20), IntegerType: ("N", 11), DoubleType: ("F", 24), BooleanType: ("L", 1), DateType: ("D", 8)}
        for f in self.columns:
            if type(f.dataType) not in kinds:
                raise ValueError(f"a shapefile cannot hold {f.name} of type {f.dataType.simpleString()}")
            if len(f.name.encode()) > 10 or not f.name.isascii():
                raise ValueError(f"a shapefile's column names have at most 10 ASCII characters: {f.name}")
        self.kinds = [kinds[type(f.dataType)] for f in self.columns]

    def _cell(self, value, field: StructField, kind: str, width: int) -> bytes:
        if value is None:
            return b" " * width
        text = {"C": str, "N": str, "F": repr, "L": lambda v: "T" if v else "F", "D": lambda v: v.strftime("%Y%m%d")}[kind](value)
        out = text.encode()
        if len(out) > width:
            raise ValueError(f"a value of {field.name} has {len(out)} bytes, its field {width}")
        return out.ljust(width) if kind == "C" else out.rjust(width)

    def write(self, iterator) -> Written:
        files, at = _open(self.path)
        files.create_dir(f"{at}/{self.job}", recursive=True)
        stems: list[str] = []
        shapes, index, rows = bytearray(), [], bytearray()
        box = [float("inf")] * 2 + [float("-inf")] * 2

        def close() -> None:
            stem = f"part-{uuid.uuid4().hex}"
            bounds = box if box[0] <= box[2] else [0.0] * 4

            def head(size: int) -> bytes:
                return struct.pack(">i20xi", FILE_CODE, size // 2) + struct.pack("<ii8d", VERSION, POLYGON, *bounds, 0, 0, 0, 0)

            names = b"".join(struct.pack("<11sc4xBB14x", f.name.encode(), k.encode(), w, 0) for f, (k, w) in zip(self.columns, self.kinds, strict=True))
            today = dt.date.today()
            table = struct.pack("<4BIHH20x", 3, today.year - 1900, today.month, today.day, len(index), DBF_HEADER + len(names) + 1,
                                1 + sum(w for _, w in self.kinds)) + names + DBF_END + bytes(rows) + b"\x1a"
            data = [head(HEADER_BYTES + len(shapes)) + bytes(shapes),
                    head(HEADER_BYTES + INDEX_BYTES * len(index)) + np.array(index, ">i4").tobytes(), table, b"UTF-8"]
            for ending, content in zip(ENDINGS, data, strict=True):
                with files.open_output_stream(f"{at}/{self.job}/{stem}{ending}") as out:
                    out.write(content)
            stems.append(stem)
            shapes.clear(), index.clear(), rows.clear()
            box[:] = [float("inf")] * 2 + [float("-inf")] * 2

        for row in iterator:
            content, bounds = _encode(row[GEOMETRY])
            index.append(((HEADER_BYTES + len(shapes)) // 2, len(content) // 2))
            shapes += struct.pack(">ii", len(index), len(content) // 2) + content
            rows += DBF_LIVE + b"".join(self._cell(row[f.name], f, *k) for f, k in zip(self.columns, self.kinds, strict=True))
            if bounds:
                box[:] = [*map(min, box[:2], bounds[:2]), *map(max, box[2:], bounds[2:])]
            if len(shapes) + len(rows) >= self.file_bytes:
                close()
        if index:
            close()
        return Written(stems)

    def commit(self, messages: list[Written | None]) -> None:
        files, at = _open(self.path)
        if self.overwrite:
            for shp in _shapes(self.path):
                for ending in ENDINGS:
                    if files.get_file_info(_beside(shp, ending)).is_file:
                        files.delete_file(_beside(shp, ending))
        for message in messages:
            for stem in message.stems if message else []:
                for ending in reversed(ENDINGS):  # the .shp last: a reader lists those
                    files.move(f"{at}/{self.job}/{stem}{ending}", f"{at}/{stem}{ending}")
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        files, at = _open(self.path)
        if files.get_file_info(f"{at}/{self.job}").type == fs.FileType.Directory:
            files.delete_dir(f"{at}/{self.job}")


class Shapefile(DataSource):
    @classmethod
    def name(cls) -> str:
        return "polygon_shapefile"

    def schema(self) -> StructType:
        files, _ = _open(self.options["path"])
        shapes = _shapes(self.options["path"])
        fields: list[StructField] = []
        if shapes:
            with files.open_input_file(_beside(shapes[0], ".dbf")) as dbf:
                fields = [StructField(n, of) for n, of, _, _ in Table(dbf).fields]
        points = ArrayType(ArrayType(DoubleType()))
        return StructType([*fields, StructField(GEOMETRY, ArrayType(ArrayType(points)))])

    def reader(self, schema: StructType) -> ShapefileReader:
        return ShapefileReader(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> ShapefileWriter:
        return ShapefileWriter(schema, self.options, overwrite)


def read_shapefile(spark: SparkSession, path: str, partition_bytes: int = 64 << 20, encoding: str = "utf-8") -> DataFrame:
    """The attributes of a ``.shp`` (or of all in a folder) and their ``polygons``
    (null shape: null), with ``geom_type``.

    The columns are those of the first file; others are matched by name. Blank
    cells are null, rows marked as deleted are left out; a file without polygons
    raises. The ``.shx`` must list the records in the order of the ``.shp``."""
    require_files(spark, path)
    spark.dataSource.register(Shapefile)
    df = (spark.read.format(Shapefile.name()).option("path", path).option("partitionBytes", partition_bytes)
          .option("encoding", encoding).load())
    kind = F.when(F.size(GEOMETRY) == 1, "Polygon").when(F.size(GEOMETRY) > 1, "MultiPolygon")
    return df.withColumn("geom_type", kind)


def read_zone_shapefile(spark: SparkSession, path: str, id_column: str = "LocationID") -> DataFrame:
    """Zone boundaries for the models: LocationID text, geom_type, polygons."""
    return read_shapefile(spark, path).select(F.col(id_column).cast("string").alias("LocationID"), "geom_type", GEOMETRY)


def write_shapefile(df: DataFrame, path: str, mode: str = "overwrite", file_bytes: int = FILE_BYTES, text_bytes: int = 254) -> None:
    """Write attribute columns (text, integers, doubles, booleans, dates; names of
    at most 10 ASCII characters) and ``polygons`` as shapefiles of about
    ``file_bytes`` in the folder ``path``.

    Shells are turned clockwise, holes counterclockwise, open rings closed.
    Null or empty polygons become null shapes; empty texts come back as null.
    Texts over ``text_bytes`` bytes raise. ``mode`` is overwrite or append."""
    df.sparkSession.dataSource.register(Shapefile)
    (df.write.format(Shapefile.name()).mode(mode).option("path", path).option("fileBytes", file_bytes)
       .option("textBytes", text_bytes).save())
