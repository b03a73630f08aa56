"""Parquet files whose footer says which column holds shapes, in what coordinates and where they lie.

Spark's own Parquet writer has no place for such a footer. Here every task writes one file under a staging
folder and adds the footer when it knows what the file holds; the files move to their place when all tasks
are done, and go when one has failed for good.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from addrspark.functions.wkb import _Reader, decode_shapes, encode_wkb

FORMAT = "addrspark_geoparquet"
# Names that the footer's layout prescribes.
VERSION = "1.1.0"
KEY = b"geo"


def _system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI or an absolute path; Hadoop writes local URIs with one slash."""
    if path.startswith("file:/") and not path.startswith("file:///"):
        path = "file://" + path.removeprefix("file:")
    return fs.FileSystem.from_uri(path)


@dataclass
class FileWritten(WriterCommitMessage):
    file: str | None


class _Extent:
    """Kinds and bounds of the shapes of a file."""

    def __init__(self) -> None:
        self.kinds: set[str] = set()
        self.low, self.high = np.full(2, np.inf), np.full(2, -np.inf)

    def add(self, column: pa.Array) -> None:
        for value in column.to_pylist():
            if value is None:
                continue
            kind, parts = _Reader(value).shape()
            self.kinds.add(kind)
            for ring in (r for part in parts for r in part if len(r)):
                self.low, self.high = np.minimum(self.low, ring.min(axis=0)), np.maximum(self.high, ring.max(axis=0))

    def described(self, crs: str | None) -> dict:
        # The keys of a column's description.
        out = {"encoding": "WKB", "geometry_types": sorted(self.kinds), "crs": json.loads(crs) if crs else None}
        if np.isfinite(self.low).all():
            out["bbox"] = [*map(float, self.low), *map(float, self.high)]
        return out


class GeoParquetWriter(DataSourceArrowWriter):
    def __init__(self, path: str, geometry: str, crs: str | None, overwrite: bool):
        self.path, self.geometry, self.crs, self.overwrite = path, geometry, crs, overwrite
        self.staging = f"_staging-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> FileWritten:
        system, root = _system(self.path)
        # A name of its own for every attempt: a repeated task leaves the first one's file to be cleared.
        name, writer, extent = f"part-{uuid.uuid4().hex}.parquet", None, _Extent()
        place = f"{root}/{self.staging}/{name}"
        try:
            for batch in iterator:
                if writer is None:
                    system.create_dir(f"{root}/{self.staging}", recursive=True)
                    # Without a stored schema, readers take the file's own keys for the schema's.
                    writer = pq.ParquetWriter(place, batch.schema.remove_metadata(), filesystem=system, store_schema=False)
                extent.add(batch.column(self.geometry))
                writer.write_batch(batch)
            if writer is None:
                return FileWritten(None)
            footer = {"version": VERSION, "primary_column": self.geometry, "columns": {self.geometry: extent.described(self.crs)}}
            writer.add_key_value_metadata({KEY: json.dumps(footer).encode()})
            writer.close()
            return FileWritten(name)
        except BaseException:
            if writer is not None:
                writer.close()
                system.delete_file(place)
            raise

    def commit(self, messages: list[FileWritten | None]) -> None:
        system, root = _system(self.path)
        system.create_dir(root, recursive=True)
        if self.overwrite:
            for old in system.get_file_info(fs.FileSelector(root)):
                if old.is_file:
                    system.delete_file(old.path)
        for message in messages:
            if message is not None and message.file:
                system.move(f"{root}/{self.staging}/{message.file}", f"{root}/{message.file}")
        self._clear(system, root)

    def abort(self, messages: list[FileWritten | None]) -> None:
        self._clear(*_system(self.path))

    def _clear(self, system: fs.FileSystem, root: str) -> None:
        """Remove the staging folder with what attempts have left there."""
        place = f"{root}/{self.staging}"
        if system.get_file_info(place).type == fs.FileType.Directory:
            system.delete_dir(place)


class GeoParquetSource(DataSource):
    """Writes only; the files are read as Parquet, see ``read_geoparquet``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: T.StructType, overwrite: bool) -> GeoParquetWriter:
        return GeoParquetWriter(self.options["path"], self.options["geometry"], self.options.get("crs"), overwrite)


def write_geoparquet(df: DataFrame, path: str, geometry: str = "geometry", crs: str | None = None, mode: str = "errorifexists") -> None:
    """Write shapes (or WKB bytes) with a footer; ``crs`` is PROJJSON text, null bytes are null shapes.

    ``path`` is a URI that every machine can write to. Modes are errorifexists, append and overwrite. Bytes that are
    no shape fail the job, which then leaves no file.
    """
    if mode not in ("errorifexists", "append", "overwrite"):
        raise ValueError(f"unknown mode {mode!r}")
    system, root = _system(path)
    if mode == "errorifexists" and system.get_file_info(root).type != fs.FileType.NotFound:
        raise FileExistsError(path)
    if isinstance(df.schema[geometry].dataType, T.StructType):
        df = df.withColumn(geometry, encode_wkb(F.col(geometry)))
    df.sparkSession.dataSource.register(GeoParquetSource)
    writer = df.write.format(FORMAT).mode("overwrite" if mode == "overwrite" else "append").option("path", path).option("geometry", geometry)
    (writer.option("crs", crs) if crs else writer).save()


def geo_metadata(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: file, version, primary_column, encoding, kinds, crs (PROJJSON text), xmin, ymin, xmax, ymax.

    Footers are read in tasks; a file without one has nulls.
    """

    def footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for file in batch.column("path").to_pylist():
                system, place = _system(file)
                geo = json.loads((pq.read_metadata(place, filesystem=system).metadata or {}).get(KEY, b"{}"))
                main = geo.get("columns", {}).get(geo.get("primary_column"), {})
                box = main.get("bbox") or [None] * 4
                crs = json.dumps(main["crs"], sort_keys=True) if main.get("crs") else None
                rows.append((place.rsplit("/", 1)[-1], geo.get("version"), geo.get("primary_column"), main.get("encoding"),
                             main.get("geometry_types"), crs, *box[:2], *box[len(box) // 2 :][:2]))
            kinds = [*[pa.string()] * 4, pa.list_(pa.string()), pa.string(), *[pa.float64()] * 4]
            columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    names = ["file", "version", "primary_column", "encoding", "kinds", "crs", "xmin", "ymin", "xmax", "ymax"]
    ddl = (
        "file string, version string, primary_column string, encoding string, kinds array<string>, crs string, "
        "xmin double, ymin double, xmax double, ymax double"
    )
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select("path")
    return files.mapInArrow(footers, ddl)


def read_geoparquet(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, str | None]:
    """(rows with the shapes decoded, rows with invalid bytes, the coordinates' PROJJSON text).

    The shape column is the one that the footers name. Footers that disagree, or are absent, are an error.
    """
    named = geo_metadata(spark, path).select("primary_column", "crs", "encoding").distinct().limit(2).collect()
    if len(named) != 1 or named[0]["primary_column"] is None:
        raise ValueError(f"the files in {path} name no shape column, or not the same: {named}")
    if named[0]["encoding"] != "WKB":
        raise ValueError(f"unsupported encoding {named[0]['encoding']!r}")
    good, bad = decode_shapes(spark.read.parquet(path), named[0]["primary_column"])
    return good, bad, named[0]["crs"]

