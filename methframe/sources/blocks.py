"""Text in block-compressed files: written in parts by tasks, read by any gzip program, and by sequence.fastq in ranges."""

from __future__ import annotations

import contextlib
import io
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from . import bgzf, files

ENDINGS = (".gz", ".bgz")


class Text(io.RawIOBase):
    """The text of a file from the first block at or after *start*; limit: where in it the first block at or after *end* begins, once read."""

    def __init__(self, file, start: int, end: int):
        first = bgzf.first_block(file, start, end) if start else 0
        self.empty, self.end, self.limit = first >= end, end, None
        self.parts, self.held, self.taken = bgzf.blocks(file, first), b"", 0

    def readable(self) -> bool:
        return True

    def readinto(self, room) -> int:
        while not self.held:
            offset, self.held = next(self.parts, (None, b""))
            if offset is None:
                return 0
            if offset >= self.end and self.limit is None:
                self.limit = self.taken
        n = min(len(room), len(self.held))
        room[:n], self.held = self.held[:n], self.held[n:]
        self.taken += n
        return n


def blocked(path: str) -> bool:
    """Whether a file consists of blocks, told by its first bytes."""
    if not path.endswith(ENDINGS):
        return False
    with files.opened(path) as f:
        return bgzf.block_size(f.read(1 << 10)) > 0


@dataclass
class _Part(WriterCommitMessage):
    """The files of a task, one for each column, and how many lines each has."""

    number: int
    names: list[str]
    rows: list[int]


class BlockWriter(DataSourceArrowWriter):
    """Each task writes a file for each column, under a name of its own; the driver only renames those of the tasks that count."""

    def __init__(self, options: dict):
        self.folders, self.run, self.level = [at.rstrip("/") for at in json.loads(options["folders"])], uuid.uuid4().hex, int(options["level"])

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Part:
        from pyspark import TaskContext

        number, names, rows = TaskContext.get().partitionId(), [], [0] * len(self.folders)
        with contextlib.ExitStack() as opened:
            sinks, outs = [], []
            for folder in self.folders:
                store, at = files.located(folder)
                store.create_dir(at, recursive=True)
                names.append(f"_{self.run}-{number}-{uuid.uuid4().hex}")
                sinks.append(opened.enter_context(store.open_output_stream(f"{at}/{names[-1]}")))
                outs.append(bgzf.Writer(sinks[-1], self.level))
            for batch in iterator:
                for k, out in enumerate(outs):
                    values = batch.column(k).drop_null()
                    if len(values):
                        out.write(pc.binary_join(pa.ListArray.from_arrays([0, len(values)], values), "\n")[0].as_buffer().to_pybytes() + b"\n")
                        rows[k] += len(values)
            for sink, out in zip(sinks, outs, strict=True):
                out.flush()
                sink.write(bgzf.END)
        return _Part(number, names, rows)

    def commit(self, messages: list[_Part | None]) -> None:
        parts = sorted((m for m in messages if m is not None), key=lambda m: m.number)
        for k, folder in enumerate(self.folders):
            store, at = files.located(folder)
            full = [m for m in parts if m.rows[k]] or parts[:1]
            for m in parts:
                if m not in full:
                    store.delete_file(f"{at}/{m.names[k]}")
            for n, m in enumerate(full):
                store.move(f"{at}/{m.names[k]}", f"{at}/part-{n:05d}-{self.run}.gz")

    def abort(self, messages: list[_Part | None]) -> None:
        for k, folder in enumerate(self.folders):
            store, at = files.located(folder)
            for m in messages:
                if m is not None:
                    store.delete_file(f"{at}/{m.names[k]}")


class BlockSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "block_text"

    def schema(self) -> str:
        return "value string"

    def writer(self, schema, overwrite: bool) -> BlockWriter:
        return BlockWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(BlockSource)


def write(lines: DataFrame, folder: str) -> None:
    """The column value as lines of block-compressed parts in a new folder, in the order of the partitions; nulls are left out."""
    write_columns(lines, {"value": folder})


def write_columns(df: DataFrame, folders: dict[str, str], level: int = 6) -> None:
    """Each of these columns as write has it, in a folder of its own, in one pass; level: of compression, 1 (fastest) to 9."""
    register(df.sparkSession)
    source = df.select(*folders).write.format("block_text").option("folders", json.dumps(list(folders.values()))).option("level", level)
    source.mode("append").save()
