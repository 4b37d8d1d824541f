"""Data sources for FASTQ and FASTA files: spark.read.format("fastq"), ("fasta") and ("fasta_pieces") after register(spark).

Plain files are read in byte ranges, and so are FASTQ files in block-compressed form (a kind of gzip); other compressed files,
which cannot be split, are read by one task each.  A list of files is read in its order.  Paths may lie on any storage that pyarrow reaches, and patterns are expanded.
"""

from __future__ import annotations

import bisect
import bz2
import gzip
import io
import itertools
import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from . import blocks, files
from .files import expand

CHUNK = 1 << 19  # bytes of FASTQ text that are cut into records together
RANGES = 256  # ranges that are smaller than files.SPLIT, at most: each is a task
PIECE = 1 << 20  # bases of a piece of a sequence
HEADING = 1 << 16  # bytes of a FASTA heading at most, where a range begins within one


def _compressed(path: str) -> bool:
    return path.endswith((*blocks.ENDINGS, ".bz2"))


def _stream(path: str) -> io.BufferedReader:
    raw = files.opened(path)
    if path.endswith(blocks.ENDINGS):
        return io.BufferedReader(gzip.GzipFile(fileobj=raw))
    return io.BufferedReader(bz2.BZ2File(raw)) if path.endswith(".bz2") else io.BufferedReader(raw, 1 << 20)


class _Range(InputPartition):
    def __init__(self, file: int, split: int, path: str, start: int, end: int | None, blocked: bool = False):
        self.file, self.split, self.path, self.start, self.end, self.blocked = file, split, path, start, end, blocked


class _Reader(DataSourceReader):
    splits, splits_blocks = True, False

    def __init__(self, options: dict):
        self.paths = expand(options.get("path") or options["paths"])
        self.size = int(options.get("splitBytes") or files.SPLIT)
        self.counts = str(options.get("content") or "").lower() == "counts"

    def partitions(self) -> list[_Range]:
        """Ranges of the size asked for; where these were more than RANGES, longer ones of files.SPLIT at most."""
        out, cut = [], []
        for k, path in enumerate(self.paths):
            blocked = self.splits_blocks and blocks.blocked(path)
            if _compressed(path) and not blocked or not self.splits:
                out.append(_Range(k, 0, path, 0, None))
            else:
                cut.append((k, path, files.size(path), blocked))
        size = max(self.size, min(files.SPLIT, sum(total for _, _, total, _ in cut) // RANGES))
        for k, path, total, blocked in cut:
            out += [_Range(k, n, path, at, min(total, at + size), blocked) for n, at in enumerate(range(0, max(total, 1), size))]
        return out


def _chunks(part: _Range) -> Iterator[tuple[bytes, np.ndarray]]:
    """(text, where its lines begin and the last one ends) of the records whose id line begins in the range, four lines each.

    A line is an id if it begins with '@' and the second line after it with '+': a quality line may begin with '@', but
    two lines after it come bases, which begin with a letter.  In block-compressed files a range is the text of its
    blocks; whether a line begins with a block is told by the block before, whose range takes that record.
    """
    if part.blocked:
        with files.opened(part.path) as raw:
            text = blocks.Text(raw, part.start, part.end)
            if not text.empty:
                f = io.BufferedReader(text, 1 << 16)
                at = len(f.readline()) if part.start else 0
                yield from _from(part.path, f, at, bool(part.start), lambda: None if text.limit is None else text.limit + 1)
        return
    with _stream(part.path) as f:
        at = part.start
        if at:
            f.seek(at - 1)
            at += len(f.readline()) - 1  # the rest of a line that began before
        yield from _from(part.path, f, at, part.start > 0, lambda: part.end)


def _from(path: str, f: io.BufferedReader, at: int, search: bool, bound: Callable[[], int | None]) -> Iterator[tuple[bytes, np.ndarray]]:
    """The records of a text from its byte *at* on, where a line begins (search: not always a record's first), up to one that begins at the bound (null: not known yet)."""

    def ended(at: int) -> bool:
        return (end := bound()) is not None and at >= end

    ahead: list[bytes] = []
    while search:
        while len(ahead) < 3 and (line := f.readline()):
            ahead.append(line)
        if len(ahead) < 3 or ended(at):
            return
        if ahead[0].startswith(b"@") and ahead[2].startswith(b"+"):
            break
        at += len(ahead.pop(0))
    held = b"".join(ahead)
    while not ended(at):
        more = f.read(max(CHUNK, len(held)))
        text = held + more
        codes = np.frombuffer(text, np.uint8)
        begins = np.concatenate([[0], np.flatnonzero(codes == ord("\n")) + 1])
        if not more and begins[-1] < len(text):
            begins = np.append(begins, len(text))  # a last line without its end
        n = (len(begins) - 1) // 4
        ids = begins[: 4 * n : 4]
        end = bound()
        full = n if end is None else int(np.searchsorted(ids, end - at))
        strange = np.flatnonzero(codes[ids[:full]] != ord("@"))
        good = int(strange[0]) if len(strange) else full
        if good:
            yield text, begins[: 4 * good + 1]
        if good == n and more:
            held, at = text[begins[4 * n] :], at + int(begins[4 * n])
            continue
        # Here the range ends, or the text does, or its records do.
        rest = text[begins[4 * good] :]
        at += int(begins[4 * good])
        if good < full or (full == n and not ended(at)):
            if rest.split(b"\n", 1)[0].strip():
                raise ValueError(f"{path}: no FASTQ record at byte {at} of the text")
        return


def _columns(text: bytes, begins: np.ndarray) -> list[pa.Array]:
    """(id, bases, qualities) of a text's records, without line ends."""
    lines = pa.Array.from_buffers(pa.binary(), len(begins) - 1, [None, pa.py_buffer(begins.astype(np.int32)), pa.py_buffer(text)])
    return [pc.ascii_rtrim(lines.take(pa.array(range(k, len(lines), 4), pa.int64())).cast(pa.string()), "\r\n") for k in (0, 1, 3)]


def _records(part: _Range) -> Iterator[tuple[bytes, bytes, bytes]]:
    """(id, bases, qualities) of the range's records one by one."""
    for text, begins in _chunks(part):
        yield from zip(*(c.cast(pa.binary()).to_pylist() for c in _columns(text, begins)), strict=True)


class FastqReader(_Reader):
    splits_blocks = True

    def read(self, part: _Range) -> Iterator[pa.RecordBatch]:
        if self.counts:
            records = sum((len(begins) - 1) // 4 for _, begins in _chunks(part))
            yield pa.RecordBatch.from_pydict({"file": pa.array([part.file], pa.int32()), "split": pa.array([part.split], pa.int32()), "records": [records]})
            return
        number = 0
        for text, begins in _chunks(part):
            n = (len(begins) - 1) // 4
            yield pa.RecordBatch.from_arrays(
                [pa.array([part.file] * n, pa.int32()), pa.array([part.split] * n, pa.int32()), pa.array(range(number, number + n), pa.int64()), *_columns(text, begins)],
                names=["file", "split", "record", "id", "seq", "qual"],
            )
            number += n


class _Pairs(InputPartition):
    """A range of mate 1, its first number, and the ranges of mate 2 that have its numbers, each with its own first one."""

    def __init__(self, one: _Range | None = None, first: int = 0, twos: list[tuple[_Range, int]] = ()):
        self.one, self.first, self.twos = one, first, list(twos)


class PairReader(DataSourceReader):
    """Mates of equal number, read side by side: a task reads a range of mate 1 and, of mate 2, the ranges with the same numbers, up to the last of these."""

    def __init__(self, options: dict):
        self.sides = [FastqReader({"path": options[f"path{mate}"], "splitBytes": options.get("splitBytes")}) for mate in (1, 2)]
        self.records = [{(file, split): n for file, split, n in side} for side in json.loads(options["records"])]

    def partitions(self) -> list[_Pairs]:
        ranges = [sorted(side.partitions(), key=lambda p: (p.file, p.split)) for side in self.sides]
        if any({(p.file, p.split) for p in parts} != set(records) for parts, records in zip(ranges, self.records, strict=True)):
            raise ValueError("files have changed since their records were counted")
        befores = [list(itertools.accumulate((records[p.file, p.split] for p in parts), initial=0)) for parts, records in zip(ranges, self.records, strict=True)]
        out = []
        for one, first, end in zip(ranges[0], befores[0], befores[0][1:], strict=False):
            low = bisect.bisect_right(befores[1], first) - 1
            twos = [(p, a) for p, a, z in zip(ranges[1][low:], befores[1][low:], befores[1][low + 1 :], strict=False) if a < z] if first < end else []
            twos = list(itertools.takewhile(lambda x: x[1] < end, twos))  # noqa: B023
            if twos:
                out.append(_Pairs(one, first, twos))
        return out or [_Pairs()]

    def read(self, part: _Pairs) -> Iterator[pa.RecordBatch]:
        if part.one is None:
            return
        twos, held, number = self._from_number(part.twos, part.first), None, part.first
        for chunk in _chunks(part.one):
            ones, pieces, need = _columns(*chunk), [], (len(chunk[1]) - 1) // 4
            while need:
                if held is None or not len(held[0]):
                    held = next(twos, None)
                    if held is None:
                        break
                pieces.append([c[:need] for c in held])
                held = [c[need:] for c in held]
                need -= len(pieces[-1][0])
            if not pieces:
                return
            mates = [pa.concat_arrays(c) for c in zip(*pieces, strict=True)]
            n = len(mates[0])
            yield pa.RecordBatch.from_arrays([pa.array(range(number, number + n), pa.int64()), *(c[:n] for c in ones), *mates], names=["read_no", *(f"{c}{mate}" for mate in (1, 2) for c in ("id", "seq", "qual"))])
            number += n

    def _from_number(self, ranges: list[tuple[_Range, int]], first: int) -> Iterator[list[pa.Array]]:
        """The columns of the ranges' records from number first on."""
        for part, number in ranges:
            for text, begins in _chunks(part):
                n = (len(begins) - 1) // 4
                if number + n > first:
                    yield [c[max(0, first - number) :] for c in _columns(text, begins)]
                number += n


class PairSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fastq_pairs"

    def schema(self) -> str:
        return "read_no long, id1 string, seq1 string, qual1 string, id2 string, seq2 string, qual2 string"

    def reader(self, schema) -> PairReader:
        return PairReader(self.options)


class FastqSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        if str(self.options.get("content") or "").lower() == "counts":
            return "file int, split int, records long"
        return "file int, split int, record long, id string, seq string, qual string"

    def reader(self, schema) -> FastqReader:
        return FastqReader(self.options)


class FastaReader(_Reader):
    splits = False  # a sequence is a row

    def read(self, part: _Range) -> Iterator[tuple]:
        name, parts = None, []
        with _stream(part.path) as f:
            for line in f:
                if line.startswith(b">"):
                    if name is not None:
                        yield name, "".join(parts)
                    name, parts = _title(line), []
                else:
                    parts.append(line.strip().decode())
        if name is not None:
            yield name, "".join(parts)


def _title(line: bytes) -> str:
    return (line[1:].decode().split() or [""])[0]


class FastaSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fasta"

    def schema(self) -> str:
        return "chr string, seq string"

    def reader(self, schema) -> FastaReader:
        return FastaReader(self.options)


class PieceReader(_Reader):
    """(file, split, piece, name, bases): name where a sequence begins with this piece, else null."""

    def read(self, part: _Range) -> Iterator[tuple]:
        for k, (name, bases) in enumerate(self._pieces(part)):
            yield part.file, part.split, k, name, len(bases) if self.counts else bases.decode()

    def _pieces(self, part: _Range) -> Iterator[tuple[str | None, bytes]]:
        with _stream(part.path) as f:
            at = part.start
            if at:
                back = min(at, HEADING)
                f.seek(at - back)
                begun = f.read(back).rpartition(b"\n")[2]
                if begun.startswith(b">"):
                    at += len(f.readline())  # the rest of a heading that began before
                starts = not begun
            else:
                starts = True
            held, name = bytearray(), None
            while part.end is None or at < part.end:
                line = f.readline(PIECE if part.end is None else min(PIECE, part.end - at))
                if not line:
                    break
                if starts and line.startswith(b">"):
                    while not line.endswith(b"\n") and (more := f.readline(PIECE)):
                        line += more
                    if held or name is not None:
                        yield name, bytes(held)
                    held, name = bytearray(), _title(line)
                else:
                    held += bytes(line).translate(None, b" \t\r\n")
                at += len(line)
                starts = line.endswith(b"\n")
                if len(held) >= PIECE:
                    yield name, bytes(held)
                    held, name = bytearray(), None
            if held or name is not None:
                yield name, bytes(held)


class PieceSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fasta_pieces"

    def schema(self) -> str:
        return "file int, split int, piece int, name string, " + ("n long" if str(self.options.get("content") or "").lower() == "counts" else "bases string")

    def reader(self, schema) -> PieceReader:
        return PieceReader(self.options)


def register(spark: SparkSession) -> None:
    for source in (FastqSource, PairSource, FastaSource, PieceSource):
        spark.dataSource.register(source)


def _load(spark: SparkSession, kind: str, paths: str, split: int | None, content: str = "") -> DataFrame:
    register(spark)
    source = spark.read.format(kind).option("path", paths).option("content", content)
    return (source.option("splitBytes", split) if split else source).load()


def fastq(spark: SparkSession, paths: str, split: int | None = None) -> DataFrame:
    """(read_no, id, seq, qual): read_no counts from 0 over all files in their order.

    Ranges are counted first, a number for each, and their sums tell where each range's numbers begin.
    """
    sizes = _load(spark, "fastq", paths, split, "counts")  # a row a range
    before = F.coalesce(F.sum("records").over(Window.orderBy("file", "split").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = F.broadcast(sizes.select("file", "split", before.alias("before")))
    rows = _load(spark, "fastq", paths, split)
    return rows.join(starts, ["file", "split"]).select((F.col("before") + F.col("record")).alias("read_no"), "id", "seq", "qual")


def fastq_pairs(spark: SparkSession, paths1: str, paths2: str, split: int | None = None) -> DataFrame:
    """Mates of equal number, both cut to the shorter one's length; both lists must have as many files."""
    if len(expand(paths1)) != len(expand(paths2)):
        raise ValueError("both mates need the same number of files")
    return mates(spark, paths1, paths2, split)


def mates(spark: SparkSession, paths1: str, paths2: str, split: int | None = None) -> DataFrame:
    """(read_no, id1, seq1, qual1, id2, seq2, qual2): mates of equal number over all files of either list, both cut to the shorter one's length.

    Ranges are counted first, a number for each; then each range of mate 1 is read together with those of mate 2 that have
    its numbers, so no read is shuffled.  Where files that cannot be split are fewer than the session's tasks, pairs are dealt anew.
    """
    from ..operators.preprocess import equal_mates

    counts = [_load(spark, "fastq", paths, split, "counts").withColumn("mate", F.lit(mate)) for mate, paths in ((1, paths1), (2, paths2))]
    sizes = counts[0].unionByName(counts[1]).collect()  # a row a range
    records = [[(x["file"], x["split"], x["records"]) for x in sizes if x["mate"] == mate] for mate in (1, 2)]
    source = spark.read.format("fastq_pairs").options(path1=paths1, path2=paths2, records=json.dumps(records))
    pairs = (source.option("splitBytes", split) if split else source).load()
    whole = any(_compressed(p) and not blocks.blocked(p) for p in expand(paths1))
    if whole and len(records[0]) < spark.sparkContext.defaultParallelism:
        pairs = pairs.repartition("read_no")
    return equal_mates(pairs)


def fasta(spark: SparkSession, paths: str) -> DataFrame:
    """(chr, seq): a row a sequence, for genomes of small chromosomes; others are read by fasta_tiles."""
    register(spark)
    return spark.read.format("fasta").option("path", paths).load()


def fasta_pieces(spark: SparkSession, paths: str, split: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(pieces (chr, start, bases), chromosomes (chr, length)) of FASTA files read in ranges; start is the first base's place, from 1.

    Where a piece lies is told by the pieces' lengths, which are counted first, a number for each PIECE bases.
    """
    counts = _load(spark, "fasta_pieces", paths, split, "counts")
    order = Window.orderBy("file", "split", "piece")
    marked = counts.withColumn("own", F.sum(F.when(F.col("name").isNotNull(), 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    along = Window.partitionBy("own").orderBy("file", "split", "piece")
    placed = marked.where("own > 0").select(
        "file", "split", "piece", F.first("name", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, 0)).alias("chr"),
        (F.coalesce(F.sum("n").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + 1).alias("start"), "n",
    )
    chromosomes = placed.groupBy("chr").agg(F.max(F.col("start") + F.col("n") - 1).alias("length"))
    rows = _load(spark, "fasta_pieces", paths, split)
    return rows.join(F.broadcast(placed.drop("n")), ["file", "split", "piece"]).where("bases <> ''").select("chr", "start", "bases"), chromosomes


def fasta_tiles(spark: SparkSession, paths: str, tile: int | None = None, span: int | None = None, split: int | None = None, named: Column | None = None) -> DataFrame:
    """(chr, tile, piece, length): the tiles of a genome (operators.genome.tiles) without a row that holds a chromosome.

    Bases are turned to upper case; named: an expression for chr over the names as read.  length is the chromosome's.
    """
    from ..operators import genome as G

    tile, span = tile or G.TILE, span or G.SPAN
    pieces, chromosomes = fasta_pieces(spark, paths, split)
    if named is not None:
        pieces, chromosomes = (df.withColumn("chr", named) for df in (pieces, chromosomes))
    rows = pieces.join(F.broadcast(chromosomes), "chr").withColumn("end", F.col("start") + F.length("bases") - 1)
    # Tile t holds the places t * tile + 1 - LEAD to (t + 1) * tile + span + LEAD.
    low = f"cast(greatest(0, ceil((start - {tile + span + G.LEAD}) / {tile})) as bigint)"
    high = f"least((length - 1) div {tile}, (end + {G.LEAD} - 1) div {tile})"
    cut = rows.where(f"{low} <= {high}").withColumn("tile", F.explode(F.expr(f"sequence({low}, {high})")))
    first, last = f"greatest(start, tile * {tile} + {1 - G.LEAD})", f"least(end, (tile + 1) * {tile} + {span + G.LEAD})"
    cut = cut.select("chr", "tile", "length", F.expr(first).alias("at"), F.expr(f"substr(bases, cast({first} - start + 1 as int), cast({last} - {first} + 1 as int))").alias("part"))
    # A tile's parts are as long as the tile together.
    joined = cut.groupBy("chr", "tile", "length").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "part"))), lambda p: p["part"]), "").alias("bases"))
    lead = F.when(F.col("tile") == 0, F.lit("X" * G.LEAD)).otherwise("")
    return joined.select("chr", "tile", F.concat(lead, F.upper("bases")).cast("binary").alias("piece"), "length")
