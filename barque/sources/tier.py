"""The bar tier as a data source: one Parquet file for each series, its identity and session in the file's own footer
(SRC1, SNK1).

    register(spark)
    bars.repartition(*SERIES).sortWithinPartitions(*SERIES, "ts").write.format("bar_tier").mode("append").save(root)
    spark.read.format("bar_tier").option("fallback_session", "24x7").load(root)

Footers are read by the tasks that read the files. Filters on source, market and frequency prune folders while the files are
listed; a filter on the symbol or the session skips a file behind its footer, before any page is read. A writer puts files under names of its
own and the driver renames them when all tasks have ended, so that a task that is run again, or a job that fails, leaves
nothing that a reader sees. Paths are what pyarrow.fs can open: local or shared mounts, hdfs, s3.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, WriterCommitMessage

from barque.sources.bars import FIELDS, SERIES

IDENTITY = ["source", "market", "asset_class", "symbol", "frequency", "session_id"]
FOLDERS = ["source", "market", "frequency"]
ROWS = 65_536  # of a row group
SCHEMA = ", ".join(f"{c} string" for c in IDENTITY) + ", " + FIELDS
_ARROW = pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "double": pa.float64()}[k]) for n, k in (x.split() for x in SCHEMA.split(", "))])
_VALUES = pa.schema([f for f in _ARROW if f.name not in IDENTITY])


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


@dataclass
class OneFile(InputPartition):
    path: str


class BarReader(DataSourceReader):
    def __init__(self, root: str, fallback: str | None):
        self.root, self.fallback, self.wanted = root.rstrip("/"), fallback, {}

    def pushFilters(self, filters: list[Filter]):  # noqa: N802
        """Equalities on what identifies a file are settled here; the rest is left to Spark."""
        for f in filters:
            name = f.attribute[0] if isinstance(f, EqualTo | In) and len(f.attribute) == 1 else None
            if name not in IDENTITY:
                yield f
                continue
            values = {f.value} if isinstance(f, EqualTo) else set(f.value)
            self.wanted[name] = values & self.wanted.get(name, values)

    def partitions(self) -> list[OneFile]:
        fs, root = opened(self.root)
        found = fs.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True))
        paths = sorted(x.path for x in found if x.is_file and x.path.endswith(".parquet"))
        return [OneFile(p) for p in paths if all(f"/{c}=" not in p or p.partition(f"/{c}=")[2].partition("/")[0] in self.wanted[c] for c in FOLDERS if c in self.wanted)]

    def read(self, partition: OneFile) -> Iterator[pa.RecordBatch]:
        fs, _ = opened(self.root)
        with fs.open_input_file(partition.path) as f:
            file = pq.ParquetFile(f)
            noted = {k.decode(): v.decode() for k, v in (file.schema_arrow.metadata or {}).items()}
            identity = {c: noted.get(c) for c in IDENTITY}
            if identity["session_id"] is None:
                identity["session_id"] = self.fallback
            if missing := [c for c in IDENTITY if identity[c] is None]:
                raise ValueError(f"{partition.path}: no {', '.join(missing)} in its footer")
            if any(identity[c] not in v for c, v in self.wanted.items()):
                return
            for batch in file.iter_batches(ROWS, columns=_VALUES.names):
                n = batch.num_rows
                columns = [pa.repeat(pa.scalar(identity[c]), n) for c in IDENTITY] + [batch.column(c).cast(_VALUES.field(c).type) for c in _VALUES.names]
                yield pa.RecordBatch.from_arrays(columns, schema=_ARROW)


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str]]


class BarWriter(DataSourceArrowWriter):
    def __init__(self, root: str, row_group: int):
        self.root, self.row_group, self.job = root.rstrip("/"), row_group, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = opened(self.root)
        files, now, writer, held = [], None, None, []

        def flush(all_of_it: bool) -> None:
            rows = pa.Table.from_batches(held, _VALUES)
            whole = len(rows) if all_of_it else len(rows) // self.row_group * self.row_group
            if whole:
                writer.write_table(rows.slice(0, whole), self.row_group)
            held[:] = rows.slice(whole).to_batches()

        def close() -> None:
            if writer:
                flush(True)
                writer.close()

        for batch in iterator:
            keys = list(zip(*(batch.column(c).to_pylist() for c in IDENTITY), strict=True))
            start = 0
            for i in range(1, len(keys) + 1):
                if i < len(keys) and keys[i] == keys[start]:
                    continue
                if keys[start] != now:
                    close()
                    now = keys[start]
                    named = dict(zip(IDENTITY, now, strict=True))
                    folder = "/".join([root, *(f"{c}={named[c]}" for c in FOLDERS)])
                    fs.create_dir(folder, recursive=True)
                    name = hashlib.sha256("\\0".join(named[c] for c in SERIES).encode()).hexdigest()[:16]
                    staged = f"{folder}/.{self.job}-{uuid.uuid4().hex}"
                    if any(f == f"{folder}/{name}.parquet" for _, f in files):
                        raise ValueError("bars of a series must come together: repartition and sort by series first")
                    files.append((staged, f"{folder}/{name}.parquet"))
                    writer = pq.ParquetWriter(fs.open_output_stream(staged), _VALUES.with_metadata({k: v for k, v in named.items() if v is not None}), compression="zstd")
                part = batch.slice(start, i - start)
                held.append(pa.RecordBatch.from_arrays([part.column(c).cast(_VALUES.field(c).type) for c in _VALUES.names], schema=_VALUES))
                if sum(b.num_rows for b in held) >= self.row_group:
                    flush(False)
                start = i
        close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        fs, _ = opened(self.root)
        every = [f for m in messages if m for f in m.files]
        if len({new for _, new in every}) < len(every):
            self.abort(messages)
            raise ValueError("bars of a series must come together: repartition and sort by series first")
        for staged, new in every:
            fs.move(staged, new)

    def abort(self, messages: list[Written | None]) -> None:
        fs, _ = opened(self.root)
        for m in messages:
            for staged, _ in m.files if m else []:
                if fs.get_file_info(staged).is_file:
                    fs.delete_file(staged)


class BarTier(DataSource):
    """Options: path; fallback_session for files whose footer names none; row_group, the rows of a row group."""

    @classmethod
    def name(cls) -> str:
        return "bar_tier"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> BarReader:
        return BarReader(self.options["path"], self.options.get("fallback_session"))

    def writer(self, schema, overwrite: bool) -> BarWriter:
        return BarWriter(self.options["path"], int(self.options.get("row_group", ROWS)))


def register(spark: SparkSession) -> None:
    """Make the format known to a session, filters included."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(BarTier)
