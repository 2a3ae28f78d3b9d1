"""GeoPackage layers as a Spark data source: ``spark.read.format("geopackage")`` after ``register(spark)``.

A path is one file, or a folder of files of the same layer, as the writer leaves it.
The files have to be on a file system that the driver and all executors mount.
"""

from __future__ import annotations

import os
import shutil
import sqlite3
import struct
import uuid
from collections.abc import Iterator
from contextlib import closing, suppress
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampType

from quadrille.functions.geometry import RINGS_TYPE, nested, unnested
from quadrille.functions.systems import System, defined
from quadrille.functions.systems import system as numbered_system
from quadrille.kernel import wkb
from quadrille.kernel.wkb import alike

# Names, numbers and flags of the format; fixed values.
MAGIC, APPLICATION, VERSION = b"GP", 0x47504B47, 10300
ENVELOPE_BYTES = (0, 32, 48, 48, 64)
SQL_TYPES = {"BOOLEAN": BooleanType(), "TINYINT": IntegerType(), "SMALLINT": IntegerType(), "MEDIUMINT": IntegerType(), "INT": LongType(), "INTEGER": LongType(), "FLOAT": DoubleType(), "DOUBLE": DoubleType(), "REAL": DoubleType(), "BLOB": BinaryType()}
ROWS, BATCH = 50_000, 2_000
#: A file is cut to no more tasks than if its rows took so many bytes each.
ROW_BYTES = 100
#: Layers that one pass may deal rows to.
MOST_LAYERS = 64


def files_of(path: str) -> list[str]:
    path = path.removeprefix("file://").removeprefix("file:")
    found = sorted(f"{path}/{f}" for f in os.listdir(path) if f.endswith(".gpkg")) if os.path.isdir(path) else [path]
    if not found or not all(os.path.isfile(f) for f in found):
        raise FileNotFoundError(f"{path}: no GeoPackage")
    return found


def opened(file: str) -> sqlite3.Connection:
    con = sqlite3.connect(f"file:{file}?mode=ro&immutable=1", uri=True)
    con.text_factory = lambda b: b.decode("utf-8", "replace")
    return con


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


@dataclass
class Layer:
    """The table of a layer: its key, its geometry column (None without one) and its columns."""

    name: str
    key: str
    geom: str | None
    srid: int | None
    columns: list[tuple[str, object]]

    @classmethod
    def of(cls, con: sqlite3.Connection, name: str | None) -> Layer:
        tables = [r[0] for r in con.execute("SELECT table_name FROM gpkg_contents WHERE data_type IN ('features', 'attributes') ORDER BY rowid")]
        if not tables or (name is not None and name not in tables):
            raise ValueError(f"no layer {name or ''} among {tables}")
        name = name or tables[0]
        shape = con.execute("SELECT column_name, srs_id FROM gpkg_geometry_columns WHERE table_name = ?", [name]).fetchone() or (None, None)
        info = con.execute(f"PRAGMA table_info({quoted(name)})").fetchall()
        key = next((r[1] for r in info if r[5]), "rowid")
        columns = [(r[1], SQL_TYPES.get(r[2].upper().partition("(")[0], StringType())) for r in info if r[1] not in (key, shape[0])]
        return cls(name, key, *shape, columns)


def bare_wkb(blob: bytes | None) -> bytes | None:
    """Well-known binary out of a geometry blob; null for an empty geometry."""
    if blob is None or blob[:2] != MAGIC or blob[3] & 0x10:
        return None
    return blob[8 + ENVELOPE_BYTES[(blob[3] >> 1) & 7] :]


def geometry_blob(wkb: bytes, srid: int, box: tuple[float, ...]) -> bytes:
    """``box``: minx, maxx, miny, maxy."""
    return MAGIC + struct.pack("<BBi4d", 0, 0b11, srid, *box) + wkb


@dataclass
class Rows(InputPartition):
    file: str
    first: int
    last: int


class Reader(DataSourceReader):
    OPERATORS = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}

    def __init__(self, path: str, layer: str | None, schema: StructType, rows: int):
        self.path, self.layer, self.schema, self.rows = path, layer, schema, rows
        self.where: list[tuple[str, list]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Comparisons and lists on attributes are SQLite's to check; Spark checks the others."""
        with closing(opened(files_of(self.path)[0])) as con:
            layer = Layer.of(con, self.layer)
        names = {c for c, kind in layer.columns if not isinstance(kind, (BooleanType, BinaryType))}
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            column = layer.key if column == "fid" else column if column in names else None
            values = list(f.value) if isinstance(f, In) else [getattr(f, "value", None)]
            if column is None or not (type(f) in self.OPERATORS or isinstance(f, In)) or not all(type(v) in (int, float, str) for v in values):
                yield f
            elif isinstance(f, In):
                self.where.append((f"{quoted(column)} IN ({', '.join('?' * len(values))})", values))
            else:
                self.where.append((f"{quoted(column)} {self.OPERATORS[type(f)]} ?", values))

    def partitions(self) -> list[InputPartition]:
        """Ranges of row ids, no more of them than the file's bytes hold of ``rows``: ids of a file among many are far apart."""
        out = []
        for file in files_of(self.path):
            with closing(opened(file)) as con:
                name = quoted(Layer.of(con, self.layer).name)
                low, high = con.execute(f"SELECT min(rowid), max(rowid) FROM {name}").fetchone()
            if low is not None:
                most = -(-os.path.getsize(file) // (self.rows * ROW_BYTES))
                step = max(self.rows, -(-(high - low + 1) // most))
                out += [Rows(file, a, min(a + step - 1, high)) for a in range(low, high + 1, step)]
        return out or [Rows(files_of(self.path)[0], 0, -1)]

    def read(self, part: Rows) -> Iterator[pa.RecordBatch]:
        wanted = to_arrow_schema(self.schema)
        with closing(opened(part.file)) as con:
            layer = Layer.of(con, self.layer)
            kinds = dict(layer.columns)
            sources = [layer.key if f.name == "fid" else layer.geom if f.name == "geom" else f.name for f in self.schema.fields]
            where = " AND ".join(["rowid BETWEEN ? AND ?", *[w for w, _ in self.where]])
            values = [part.first, part.last, *[v for _, some in self.where for v in some]]
            cursor = con.execute(f"SELECT {', '.join(map(quoted, sources))} FROM {quoted(layer.name)} WHERE {where} ORDER BY rowid", values)
            while rows := cursor.fetchmany(BATCH):
                arrays = []
                for f, kind, column in zip(self.schema.fields, wanted, zip(*rows, strict=True), strict=True):
                    if f.name == "geom":
                        column = list(map(bare_wkb, column))
                        if isinstance(f.dataType, ArrayType):
                            arrays.append(nested(wkb.decoded(column)).cast(kind.type))
                            continue
                    elif isinstance(kinds.get(f.name), BooleanType):
                        column = (None if v is None else bool(v) for v in column)
                    elif isinstance(f.dataType, StringType):
                        column = (None if v is None else str(v) for v in column)
                    arrays.append(pa.array(list(column), kind.type))
                yield pa.RecordBatch.from_arrays(arrays, schema=wanted)


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class LayerFile:
    """One file with one layer, written batch by batch."""

    def __init__(self, file: str, layer: str, srid: int, schema: StructType, skip: str | None):
        self.layer, self.srid = layer, srid
        self.plain = [f for f in schema.fields if f.name not in ("fid", "geom", skip)]
        self.has_fid, self.has_geom = ("fid" in schema.names), ("geom" in schema.names)
        sql = lambda t: next((k for k in ("BOOLEAN", "INTEGER", "DOUBLE", "BLOB") if SQL_TYPES[k] == t), "INTEGER" if t.simpleString() in ("int", "smallint", "tinyint") else "DOUBLE" if t.simpleString() == "float" else "TEXT")
        self.whole, self.index = [float("inf"), -float("inf")] * 2, quoted(f"rtree_{layer}_geom")
        self.con = sqlite3.connect(file)
        self.con.executescript(f"PRAGMA application_id = {APPLICATION}; PRAGMA user_version = {VERSION}; PRAGMA journal_mode = OFF; PRAGMA synchronous = OFF;" + TABLES)
        self.con.executemany("INSERT INTO gpkg_spatial_ref_sys VALUES (?, ?, ?, ?, ?, ?)", [(f"system {i}", i, "NONE" if i < 1 else "EPSG", i, "undefined", None) for i in {-1, 0, 4326, srid}])
        columns = [f"{quoted(f.name)} {sql(f.dataType)}" for f in self.plain]
        self.con.execute(f"CREATE TABLE {quoted(layer)} (fid INTEGER PRIMARY KEY, {', '.join(['geom MULTIPOLYGON'] * self.has_geom + columns)})".replace(", )", ")"))
        if self.has_geom:
            self.con.execute(f"CREATE VIRTUAL TABLE {self.index} USING rtree(id, minx, maxx, miny, maxy)")
        self.insert = f"INSERT INTO {quoted(layer)} VALUES ({', '.join('?' * (1 + self.has_geom + len(self.plain)))})"

    def add(self, columns: dict[str, pa.Array]) -> None:
        """Rows by their columns; ids that are not given go on from the highest."""
        values = {f.name: columns[f.name].to_pylist() for f in self.plain}
        for f in self.plain:
            if isinstance(f.dataType, TimestampType):
                values[f.name] = [None if v is None else v.astimezone().replace(tzinfo=None) for v in values[f.name]]
        n = len(next(iter(columns.values())))
        fids = columns["fid"].to_pylist() if self.has_fid else [None] * n
        blobs, there = [], []
        if self.has_geom:
            geom = columns["geom"]
            data = geom.to_pylist() if pa.types.is_binary(geom.type) or pa.types.is_large_binary(geom.type) else wkb.encoded(unnested(geom))[0]
            data, boxes = wkb.encoded(wkb.decoded(data))
            there = (boxes[:, 0] == boxes[:, 0]).tolist()
            blobs = [geometry_blob(d, self.srid, box) if known else None for d, box, known in zip(data, boxes.tolist(), there, strict=True)]
        rows = list(zip(fids, *[blobs] * self.has_geom, *values.values(), strict=True))
        if None in fids:
            fids = [self.con.execute(self.insert, row).lastrowid for row in rows]
        else:
            self.con.executemany(self.insert, rows)
        if any(there):
            self.con.executemany(f"INSERT INTO {self.index} VALUES (?, ?, ?, ?, ?)", [(at, *box) for at, box, known in zip(fids, boxes.tolist(), there, strict=True) if known])
            low, high = np.nanmin(boxes, axis=0).tolist(), np.nanmax(boxes, axis=0).tolist()
            w = self.whole
            self.whole = [min(w[0], low[0]), max(w[1], high[1]), min(w[2], low[2]), max(w[3], high[3])]

    def close(self) -> None:
        con, layer = self.con, self.layer
        extent = [self.whole[k] if self.whole[0] <= self.whole[1] else None for k in (0, 2, 1, 3)]
        con.execute("INSERT INTO gpkg_contents VALUES (?, ?, ?, '', strftime('%Y-%m-%dT%H:%M:%fZ', 'now'), ?, ?, ?, ?, ?)", [layer, "features" if self.has_geom else "attributes", layer, *extent, self.srid if self.has_geom else None])
        if self.has_geom:
            con.execute("INSERT INTO gpkg_geometry_columns VALUES (?, 'geom', 'MULTIPOLYGON', ?, 0, 0)", [layer, self.srid])
            con.execute("INSERT INTO gpkg_extensions VALUES (?, 'geom', 'gpkg_rtree_index', 'http://www.geopackage.org/spec120/#extension_rtree', 'write-only')", [layer])
        con.commit()
        con.close()


class Writer(DataSourceArrowWriter):
    """Files per task in a folder of their own; all are moved into place when all are done.

    With ``by``, rows are dealt to layers by that column's value, each layer a folder of
    its name; one renaming puts all of them in place. A task holds a file open for each.
    """

    def __init__(self, path: str, layer: str, srid: int, schema: StructType, overwrite: bool, by: str | None):
        self.path, self.layer, self.srid, self.schema, self.overwrite, self.by = path.removeprefix("file://").removeprefix("file:"), layer, srid, schema, overwrite, by
        if by is not None and by not in schema.names:
            raise ValueError(f"no column {by} to deal rows to layers by")
        if os.path.exists(self.path) and not overwrite:
            raise FileExistsError(f"{self.path} is there already; overwrite it or name another folder")
        self.draft = f"{self.path}.draft-{uuid.uuid4().hex}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        name, open_files = f"part-{uuid.uuid4().hex}.gpkg", {}

        def opened_for(layer: str) -> LayerFile:
            if layer not in open_files:
                if len(open_files) >= MOST_LAYERS or not layer or "/" in layer or layer.startswith("."):
                    raise ValueError(f"no layer can be called {layer!r}, or there are more than {MOST_LAYERS}")
                folder = f"{self.draft}/{layer}" if self.by else self.draft
                os.makedirs(folder, exist_ok=True)
                open_files[layer] = LayerFile(f"{folder}/{name}", layer, self.srid, self.schema, self.by)
            return open_files[layer]

        if not self.by:
            opened_for(self.layer)
        for part in (b.slice(at, BATCH) for b in batches for at in range(0, b.num_rows, BATCH)):
            layers = alike(map(str, part.column(self.by).to_pylist())) if self.by else {self.layer: None}
            for layer, at in layers.items():
                opened_for(layer).add(dict(zip(part.schema.names, (part if at is None else part.take(pa.array(at))).columns, strict=True)))
        for file in open_files.values():
            file.close()
        return Written([f"{layer}/{name}" if self.by else name for layer in open_files])

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        """Files of attempts that did not count are left out."""
        ready, old = f"{self.draft}.ready", f"{self.draft}.old"
        os.makedirs(ready)
        for file in (f for m in messages if m is not None for f in m.files):
            os.makedirs(os.path.dirname(f"{ready}/{file}"), exist_ok=True)
            os.rename(f"{self.draft}/{file}", f"{ready}/{file}")
        os.makedirs(os.path.dirname(self.path) or ".", exist_ok=True)
        if self.overwrite and os.path.exists(self.path):
            os.rename(self.path, old)
        os.rename(ready, self.path)
        if os.path.exists(old):
            (shutil.rmtree if os.path.isdir(old) else os.remove)(old)
        shutil.rmtree(self.draft, ignore_errors=True)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        shutil.rmtree(self.draft, ignore_errors=True)


TABLES = """
CREATE TABLE gpkg_spatial_ref_sys (srs_name TEXT NOT NULL, srs_id INTEGER PRIMARY KEY, organization TEXT NOT NULL, organization_coordsys_id INTEGER NOT NULL, definition TEXT NOT NULL, description TEXT);
CREATE TABLE gpkg_contents (table_name TEXT PRIMARY KEY, data_type TEXT NOT NULL, identifier TEXT UNIQUE, description TEXT DEFAULT '', last_change DATETIME NOT NULL, min_x DOUBLE, min_y DOUBLE, max_x DOUBLE, max_y DOUBLE, srs_id INTEGER);
CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT, geometry_type_name TEXT NOT NULL, srs_id INTEGER NOT NULL, z TINYINT NOT NULL, m TINYINT NOT NULL, PRIMARY KEY (table_name, column_name));
CREATE TABLE gpkg_extensions (table_name TEXT, column_name TEXT, extension_name TEXT NOT NULL, definition TEXT NOT NULL, scope TEXT NOT NULL, UNIQUE (table_name, column_name, extension_name));
"""


class GeoPackage(DataSource):
    """Options: ``layer`` (the first, or ``layer`` on writing), ``includeGeometry``, ``geometry``, ``rowsPerTask``; on writing ``srid`` and ``layerColumn``.

    Rows are fid, the attributes and ``geom`` as well-known binary (see ``geometry.from_wkb``),
    or as the rings of its polygons where ``geometry`` is ``rings``, by the same process
    that reads the file. The writer takes either.
    """

    @classmethod
    def name(cls) -> str:
        return "geopackage"

    def schema(self) -> StructType:
        with closing(opened(files_of(self.options["path"])[0])) as con:
            layer = Layer.of(con, self.options.get("layer"))
        kind = RINGS_TYPE if self.options.get("geometry", "wkb") == "rings" else BinaryType()
        shape = [StructField("geom", kind)] if layer.geom and self.options.get("includeGeometry", "true").lower() != "false" else []
        return StructType([StructField("fid", LongType()), *[StructField(c, kind) for c, kind in layer.columns], *shape])

    def reader(self, schema: StructType) -> DataSourceReader:
        return Reader(self.options["path"], self.options.get("layer"), schema, int(self.options.get("rowsPerTask", ROWS)))

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return Writer(self.options["path"], self.options.get("layer", "layer"), int(self.options.get("srid", 5070)), schema, overwrite, self.options.get("layerColumn"))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(GeoPackage)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def system_of(path: str, layer: str | None = None) -> int:
    """The reference system of a layer; it is an error if it has none."""
    with closing(opened(files_of(path)[0])) as con:
        srid = Layer.of(con, layer).srid
    if srid is None or srid < 1:
        raise ValueError(f"{path}: the layer has no reference system")
    return srid


def definition_of(path: str, layer: str | None = None) -> System:
    """The reference system of a layer by its number where that is known, else by the definition that the file holds."""
    srid = system_of(path, layer)
    with suppress(ValueError):
        return numbered_system(srid)
    with closing(opened(files_of(path)[0])) as con:
        (text,) = con.execute("SELECT definition FROM gpkg_spatial_ref_sys WHERE srs_id = ?", [srid]).fetchone()
    return defined(text)
