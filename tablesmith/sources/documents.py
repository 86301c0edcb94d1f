"""A document collection as a Spark data source: ``spark.read.format("documents")`` over JSON-lines files.

Files are cut into byte ranges, a task per range, whatever their sizes; a document belongs to the range in which its
line begins. A task reads on in batches of a stated number of documents and returns them as Arrow batches; filters on
top-level fields are applied to each batch before it leaves the task.
"""

from __future__ import annotations

import io
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyarrow import json as arrow_json
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Documents in a batch, and bytes of them that close a batch earlier.
BATCH_SIZE = 1_000
BATCH_BYTES = 8 * 1024 * 1024
#: Bytes of a file that one task reads.
SPLIT_BYTES = 64 * 1024 * 1024

_COMPARED = {ds.EqualTo: pc.equal, ds.GreaterThan: pc.greater, ds.GreaterThanOrEqual: pc.greater_equal,
             ds.LessThan: pc.less, ds.LessThanOrEqual: pc.less_equal}


class FileRange(NamedTuple):
    path: str
    begin: int
    end: int


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path on it."""
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(path)


def lines_of(file, begin: int, end: int) -> Iterator[bytes]:
    """The lines of a file that begin at a place from ``begin`` on and before ``end``, without blank ones."""
    file.seek(max(begin - 1, 0))
    if begin > 0:
        file.readline()  # the rest of a line that belongs to the range before; only its line end if none does
    while file.tell() < end:
        line = file.readline()
        if not line:
            return
        if line.strip():
            yield line


def batches_of(lines: Iterable[bytes], size: int, most_bytes: int) -> Iterator[list[bytes]]:
    """Runs of at most ``size`` lines, ended early by the line that brings them to ``most_bytes``."""
    run, held = [], 0
    for line in lines:
        run.append(line)
        held += len(line)
        if len(run) >= size or held >= most_bytes:
            yield run
            run, held = [], 0
    if run:
        yield run


def passes(batch: pa.RecordBatch, f: ds.Filter) -> pa.Array:
    """For each row whether the filter holds; null where SQL's comparison is NULL."""
    column = batch.column(f.attribute[0])
    if isinstance(f, ds.IsNull):
        return pc.is_null(column)
    if isinstance(f, ds.IsNotNull):
        return pc.is_valid(column)
    if isinstance(f, ds.In):
        found = pc.is_in(column, value_set=pa.array([v for v in f.value if v is not None], column.type))
        return pc.if_else(pc.is_valid(column), found, None)
    return _COMPARED[type(f)](column, pa.scalar(f.value, column.type))


class DocumentReader(ds.DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.schema = schema
        self.path = options["path"]
        self.batch_size = int(options.get("batchSize", BATCH_SIZE))
        self.split_bytes = int(options.get("splitBytes", SPLIT_BYTES))
        if self.batch_size < 1 or self.split_bytes < 1:
            raise ValueError("batchSize and splitBytes must be positive")
        self.filters: list[ds.Filter] = []

    def pushFilters(self, filters: list[ds.Filter]) -> Iterable[ds.Filter]:
        """Comparisons with a value, lists of values and null tests of top-level integer and string fields are
        applied here; Spark applies the others."""
        simple = {f.name for f in self.schema.fields if f.dataType.typeName() in ("byte", "short", "integer", "long", "string")}
        for f in filters:
            known = type(f) in _COMPARED or isinstance(f, (ds.In, ds.IsNull, ds.IsNotNull))
            if known and len(f.attribute) == 1 and f.attribute[0] in simple:
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[ds.InputPartition]:
        store, path = located(self.path)
        found = store.get_file_info(path)
        if found.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        files = [found] if found.is_file else store.get_file_info(fs.FileSelector(path, recursive=True))
        data = [f for f in files if f.is_file and not f.base_name.startswith(("_", "."))]
        return [ds.InputPartition(FileRange(f.path, at, min(at + self.split_bytes, f.size)))
                for f in sorted(data, key=lambda f: f.path) for at in range(0, f.size, self.split_bytes)]

    def read(self, partition: ds.InputPartition) -> Iterator[pa.RecordBatch]:
        if partition is None:  # what Spark passes for a collection without ranges
            return
        wanted = to_arrow_schema(self.schema)
        options = arrow_json.ParseOptions(explicit_schema=wanted, unexpected_field_behavior="ignore")
        store, _ = located(self.path)
        with store.open_input_file(partition.value.path) as file:
            reader = io.BufferedReader(file, 1024 * 1024)
            for run in batches_of(lines_of(reader, *partition.value[1:]), self.batch_size, BATCH_BYTES):
                block = b"".join(line if line.endswith(b"\n") else line + b"\n" for line in run)
                blocks = arrow_json.ReadOptions(use_threads=False, block_size=len(block) + 1)
                table = arrow_json.read_json(io.BytesIO(block), read_options=blocks, parse_options=options)
                for batch in table.select(wanted.names).cast(wanted).to_batches():
                    for f in self.filters:
                        batch = batch.filter(passes(batch, f))
                    if batch.num_rows:
                        yield batch


class DocumentSource(ds.DataSource):
    """Options: ``path`` (a file or folder on storage that every executor reads), ``batchSize``, ``splitBytes``. The
    schema is given by the caller: documents have none, and one guessed from some of them could be wrong."""

    @classmethod
    def name(cls) -> str:
        return "documents"

    def schema(self) -> StructType:
        raise ValueError('the "documents" source needs a schema: spark.read.format("documents").schema(...)')

    def reader(self, schema: StructType) -> DocumentReader:
        return DocumentReader(schema, self.options)


def scan_documents(spark: SparkSession, path: str, schema: StructType | str, batch_size: int = BATCH_SIZE,
                   split_bytes: int = SPLIT_BYTES, id_field: str = "_id") -> DataFrame:
    """A document collection in batches of ``batch_size`` documents, every field of ``schema`` but the store's id.

    A field that a document lacks is NULL, one that ``schema`` lacks isn't read; a line that isn't a document, or a
    value that doesn't fit its type, ends the job with an error. An empty collection gives an empty table. Turns on the
    session's ``spark.sql.python.filterPushdown.enabled``, which Spark asks for where a source takes filters.
    """
    spark.dataSource.register(DocumentSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return (spark.read.format("documents").schema(schema).option("batchSize", batch_size)
            .option("splitBytes", split_bytes).load(path).drop(id_field))
