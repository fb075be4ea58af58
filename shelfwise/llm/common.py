"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from types import ModuleType

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_KEPT = "shelfwise_kept_by_worker"
# Documents handled together inside a task; a batch is cut by rows and by bytes.
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Cuts record batches so that the text column of each holds about ``BATCH_BYTES`` at most.

    A single longer text stays whole in a batch of its own.
    """
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        size = batch.column(column).nbytes
        step = max(1, min(rows, rows * BATCH_BYTES // max(1, size)))
        for at in range(0, rows, step):
            yield batch.slice(at, step)


def map_text(
    df: DataFrame,
    column: str,
    schema: StructType | str,
    build: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]],
) -> DataFrame:
    """``mapInArrow`` with one output batch for each bounded slice of the input.

    ``build`` is called once in a task and returns the function for its slices.
    """

    names = df.columns

    def run(batches):
        function = build()
        for part in slices((b.rename_columns(names) for b in batches), column):
            yield function(part)

    # Spark looks the columns up by names that it does not quote.
    return df.toDF(*[f"c{i}" for i in range(len(names))]).mapInArrow(run, schema)


def utf8(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The column's texts as UTF-8; null is the empty text."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def strings(batch: pa.RecordBatch, column: str) -> list[str]:
    """The column's texts; null is the empty text."""
    return [x or "" for x in batch.column(column).to_pylist()]


def fresh_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"{name}_"
    return name


def kept(kind: str, key, build: Callable[[], object]):
    """What ``build`` gives, made once in a worker process for each kind: the value for the last key
    stays. Code is sent to workers by value, so a module's own names would not last from one task
    to the next.
    """
    held = vars(sys.modules.setdefault(_KEPT, ModuleType(_KEPT)))
    if kind not in held or held[kind][0] != key:
        held[kind] = key, build()
    return held[kind][1]


def freed() -> None:
    """Drops what ``kept`` holds, in tasks of stages that need the memory for themselves."""
    vars(sys.modules.setdefault(_KEPT, ModuleType(_KEPT))).clear()


def unlike(names: list[str]) -> list[str]:
    """The names, where one that an earlier one has gets underscores."""
    taken, out = set(), []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def write_file(folder: str, name: str, data: bytes) -> str:
    """Writes a file into a folder named by a path or URI, whole or not at all; gives its URI.

    For use inside tasks. The folder has to be one that all executors reach.
    """
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)
    with system.open_output_stream(f"{path}/.{name}", compression=None) as out:
        out.write(data)
    system.move(f"{path}/.{name}", f"{path}/{name}")
    return f"{folder}/{name}"


def read_range(uri: str, start: int = 0, size: int | None = None) -> bytes:
    """Bytes of a file written by ``write_file``; a negative start counts from its end."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    with system.open_input_file(path) as file:
        at = start if start >= 0 else max(0, file.size() + start)
        return file.read_at(file.size() - at if size is None else size, at)
