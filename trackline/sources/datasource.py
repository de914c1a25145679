"""``spark.read.format("positions")``: position files and archive members as one data source.

Planning makes one partition for every stretch of a plain file, for every compressed
file and for every CSV member of a ZIP archive (found in the archive's central
directory, which is all that is read of it then); small files share a partition.
A task opens its files itself, so a file's header is read where its rows are, and
files of any number of layouts need one scan and no list of headers.  Members are
inflated as they stream, whatever their archive's size.

A line is a record (a quoted field does not span lines).  Lines with quotes, or with
another number of fields than the header, go through Python's ``csv`` one by one; all
others are parsed block by block by Arrow.  Rows with more fields than their header
are skipped, short ones padded with NULL.

Columns: the 17 canonical ones as text, then ``source_file``, ``source_offset`` (where
the stretch begins) and ``ingest_seq`` (number of the line in it).
"""

from __future__ import annotations

import csv
import fnmatch
import json
import sys
import zipfile
import zlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.csv as pa_csv
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from trackline.schema import CANONICAL_COLUMNS, SOURCE_COLUMNS, STANDARD_ALIASES

PROVENANCE = ["source_file", "source_offset", "ingest_seq"]
ROW_DDL = ", ".join([*(f"{c} string" for c in CANONICAL_COLUMNS), "source_file string", "source_offset long", "ingest_seq long"])
_ARROW = pa.schema([*((c, pa.string()) for c in CANONICAL_COLUMNS), ("source_file", pa.string()), ("source_offset", pa.int64()),
                    ("ingest_seq", pa.int64())])
FIRST_LINE_CHUNK = 1 << 16  # bytes read per step while looking for the end of a first line
BLOCK = 1 << 22
SPLIT_BYTES = 64 << 20
OPEN_BYTES = 1 << 20  # what opening a file counts as when small ones are put together
COMPRESSED = (".gz", ".bz2", ".zst", ".lz4")
LISTERS = 16


# ---------------------------------------------------------------- files

def file_system(path: str):
    """(Arrow file system, path within it) of a path or URI."""
    import pyarrow.fs as pafs

    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    if path.startswith("/"):
        return pafs.LocalFileSystem(), path
    for hadoop_scheme, arrow_scheme in (("s3a://", "s3://"), ("s3n://", "s3://")):
        if path.startswith(hadoop_scheme):
            path = arrow_scheme + path[len(hadoop_scheme):]
    return pafs.FileSystem.from_uri(path)


def open_stream(path: str):
    """A decompressing input stream."""
    fs, inner = file_system(path)
    return fs.open_input_stream(inner, compression="detect")


def first_line(path: str) -> str | None:
    """The whole first line of a (possibly compressed) text file; None for an empty file.

    Reads chunk by chunk until the first line break, so only the head of the
    file is read however large the file is.
    """
    parts: list[bytes] = []
    with open_stream(path) as stream:
        while chunk := stream.read(FIRST_LINE_CHUNK):
            ends = [i for i in (chunk.find(b"\n"), chunk.find(b"\r")) if i >= 0]
            parts.append(chunk[:min(ends)] if ends else chunk)
            if ends:
                break
    return b"".join(parts).decode("utf-8", errors="replace") if parts else None


def readable(path: str) -> bool:
    """Whether this Python environment can reach ``path``'s file system."""
    import pyarrow.fs as pafs
    try:
        fs, inner = file_system(path)
        wild = min((i for i in map(inner.find, "*?[{") if i >= 0), default=-1)
        return wild >= 0 or fs.get_file_info(inner).type != pafs.FileType.NotFound
    except Exception:  # noqa: BLE001 -- unknown scheme or missing client library
        return False


def list_files(paths: list[str]) -> list[tuple[str, int]]:
    """(URI, size) of the non-empty files under files, folders and glob patterns; names with ``_`` or ``.`` in front are hidden."""
    import pyarrow.fs as pafs

    out: dict[str, int] = {}
    for path in paths:
        fs, inner = file_system(path)
        scheme = path.split("://")[0] + "://" if "://" in path and not path.startswith("file:") else "file://"
        wild = min((i for i in map(inner.find, "*?[") if i >= 0), default=-1)
        root = inner if wild < 0 else inner[:inner.rfind("/", 0, wild)] or "/"
        info = fs.get_file_info(root)
        found = [info] if info.type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(root, recursive=True))
        for f in found:
            parts = f.path.rstrip("/").split("/")
            pattern = inner.rstrip("/").split("/")
            below = parts[len(pattern):] if wild >= 0 else parts[len(root.rstrip("/").split("/")):]
            fits = wild < 0 or len(parts) >= len(pattern) and all(fnmatch.fnmatchcase(a, b) for a, b in zip(parts, pattern))
            if f.type == pafs.FileType.File and f.size and fits and not any(p[:1] in "_." for p in [*below, parts[-1]]):
                out[scheme + f.path] = f.size
    return sorted(out.items())


# ---------------------------------------------------------------- lines and fields

def header_names(line: str) -> list[str]:
    """Column names of a header line, quotes, blanks and a byte-order mark removed."""
    csv.field_size_limit(sys.maxsize)
    return [name.strip() for name in next(csv.reader([line.lstrip("\ufeff")]), [])]


def header_mapping(names: list[str]) -> dict[int, str]:
    """Field number -> canonical column, by name; the first of equal names counts, unknown names are left out."""
    taken: dict[str, int] = {}
    for i, name in enumerate(names):
        dst = STANDARD_ALIASES.get(name.lower())
        if dst:
            taken.setdefault(dst, i)
    return {i: dst for dst, i in taken.items()}


def classify(line: str) -> str:
    """``noaa``, ``standard`` or ``noaa_no_header``, by a file's first line."""
    low = line.lower()
    if "mmsi" in low and "basedatetime" in low:
        return "noaa"
    return "standard" if "mmsi" in low and "time" in low else "noaa_no_header"


def is_header(line: str, header: str) -> bool:
    """``header`` is ``true``, ``false``, ``auto`` (by format) or ``member`` (a line that names mmsi)."""
    if header == "member":
        return "mmsi" in line.lower()
    return header == "true" or header == "auto" and classify(line) != "noaa_no_header"


def line_blocks(stream, start: int = 0, end: int | None = None) -> Iterator[list[bytes]]:
    """Lines, without their ends, that begin at a byte of [start, end), in lists; ``stream`` stands at ``start`` - 1 (at 0 if that is 0)."""
    at, skip, held = max(start - 1, 0), start > 0, []
    size = 0  # of held: the beginning of a line whose end is not read yet
    while chunk := stream.read(BLOCK):
        if skip:  # the line before belongs to the stretch before
            ends = [i for i in (chunk.find(b"\n"), chunk.find(b"\r")) if i >= 0]
            if not ends:
                at += len(chunk)
                continue
            at, chunk, skip = at + min(ends) + 1, chunk[min(ends) + 1:], False
        if end is not None and at - size >= end:
            return
        last = max(chunk.rfind(b"\n"), chunk.rfind(b"\r"))
        if end is not None and at + len(chunk) >= end:  # the last line is the one that holds byte end - 1
            from_ = max(end - 1 - at, 0)
            ends = [i for i in (chunk.find(b"\n", from_), chunk.find(b"\r", from_)) if i >= 0]
            if ends:
                yield b"".join([*held, chunk[:min(ends)]]).splitlines()
                return
        if last < 0:
            held.append(chunk)
            size += len(chunk)
        else:
            yield b"".join([*held, chunk[:last + 1]]).splitlines()
            held, size = [chunk[last + 1:]], len(chunk) - last - 1
        at += len(chunk)
    if size:
        yield b"".join(held).splitlines()


def parse_lines(lines: list[bytes], numbered: range | list[int], names: list[str], file: str, offset: int) -> Iterator[pa.RecordBatch]:
    """Rows of lines of one file, blank ones left out; ``numbered`` gives the lines' numbers."""
    n, plain, odd, kept = len(names), [], [], []
    for i, line in enumerate(lines):
        if not line:
            continue
        if b'"' in line or line.count(b",") != n - 1:
            odd.append(i)
        else:
            plain.append(i)
            kept.append(line)
    place = {c: i for i, c in header_mapping(names).items()}

    def batch(column, numbers: list[int]) -> pa.RecordBatch:
        own = [column(place[c]) if c in place else pa.nulls(len(numbers), pa.string()) for c in CANONICAL_COLUMNS]
        return pa.RecordBatch.from_arrays([*own, pa.repeat(file, len(numbers)), pa.repeat(pa.scalar(offset, pa.int64()), len(numbers)),
                                           pa.array([numbered[i] for i in numbers], pa.int64())], schema=_ARROW)

    if kept:
        data = b"\n".join(kept) + b"\n"
        try:
            data.decode()
        except UnicodeDecodeError:
            data = data.decode("utf-8", "replace").encode()
        fields = [f"f{i}" for i in range(n)]
        table = pa_csv.read_csv(
            pa.BufferReader(data), pa_csv.ReadOptions(use_threads=False, block_size=len(data) + 1, column_names=fields),
            pa_csv.ParseOptions(quote_char=False, double_quote=False, newlines_in_values=False, ignore_empty_lines=False),
            pa_csv.ConvertOptions(column_types=dict.fromkeys(fields, pa.string()), include_columns=[fields[i] for i in sorted(place.values())] or fields[:1],
                                  strings_can_be_null=False)).combine_chunks()
        yield batch(lambda i: table.column(f"f{i}").chunk(0), plain)
    rows, numbers = [], []
    csv.field_size_limit(sys.maxsize)
    for i in odd:
        row = next(csv.reader([lines[i].decode("utf-8", "replace")]), [])
        if len(row) <= n:
            rows.append(row)
            numbers.append(i)
    if rows:
        yield batch(lambda i: pa.array([r[i] if i < len(r) else None for r in rows], pa.string()), numbers)


def file_rows(stream, file: str, header: str, start: int = 0, end: int | None = None, head: str | None = None) -> Iterator[pa.RecordBatch]:
    """Rows of one stretch; ``head`` is the file's first line where the stretch begins further down."""
    names = None if head is None else header_names(head) if is_header(head, header) else SOURCE_COLUMNS
    number = 0
    for lines in line_blocks(stream, start, end):
        if names is None:
            line = lines[0].removeprefix(b"\xef\xbb\xbf")
            text = line.decode("utf-8", "replace")
            if is_header(text, header):
                names, lines[0] = header_names(text), b""
            else:
                names, lines[0] = SOURCE_COLUMNS, line
        yield from parse_lines(lines, range(number, number + len(lines)), names, file, start)
        number += len(lines)


# ---------------------------------------------------------------- the source

@dataclass
class Stretch:
    """What a partition reads of one file: bytes, all of a compressed file, or a member of an archive."""

    path: str
    start: int = 0
    end: int | None = None
    member: str | None = None


@dataclass
class Stretches(InputPartition):
    parts: tuple[Stretch, ...]

    def __init__(self, parts):
        super().__init__(tuple(parts))
        self.parts = tuple(parts)


def members(path: str) -> list[zipfile.ZipInfo]:
    """The CSV members of an archive, from its central directory; none if it is no archive."""
    fs, inner = file_system(path)
    try:
        with fs.open_input_file(inner) as f, zipfile.ZipFile(f) as archive:
            return [m for m in archive.infolist() if m.filename.lower().endswith(".csv")]
    except (zipfile.BadZipFile, pa.ArrowInvalid):  # the latter: shorter than any archive
        return []


def member_rows(path: str, member: str, header: str) -> Iterator[pa.RecordBatch]:
    """Rows of one member; of a damaged one those before the damage."""
    import warnings

    fs, inner = file_system(path)
    with fs.open_input_file(inner) as f, zipfile.ZipFile(f) as archive:
        try:
            with archive.open(member) as stream:
                yield from file_rows(stream, f"{path}!{member}", header)
        except (zipfile.BadZipFile, zlib.error, EOFError, RuntimeError, NotImplementedError) as e:
            warnings.warn(f"{path}!{member}: {e}", stacklevel=2)


class PositionsReader(DataSourceReader):
    def __init__(self, options) -> None:
        given = options.get("paths")
        self.paths = json.loads(given) if given else [options["path"]]
        self.header = options.get("header", "auto").lower()
        self.archives = options.get("archives", "also")  # also, only or skip
        self.split_bytes = int(options.get("splitbytes", SPLIT_BYTES))

    def partitions(self) -> list[InputPartition]:
        files = list_files(self.paths)
        zipped = [p for p, _ in files if p.lower().endswith(".zip")] if self.archives != "skip" else []
        with ThreadPoolExecutor(LISTERS) as pool:
            inside = dict(zip(zipped, pool.map(members, zipped)))
        pieces: list[tuple[Stretch, int]] = []
        for path, size in files:
            low = path.lower()
            if low.endswith(".zip"):
                pieces += [(Stretch(path, member=m.filename), m.file_size) for m in inside.get(path, [])]
            elif self.archives == "only":
                continue
            elif low.endswith(COMPRESSED):
                pieces.append((Stretch(path), size))
            else:
                step = self.split_bytes
                pieces += [(Stretch(path, a, min(a + step, size)), min(step, size - a)) for a in range(0, size, step)]
        out: list[InputPartition] = []
        group: list[Stretch] = []
        total = 0
        for piece, size in pieces:
            if group and total + size + OPEN_BYTES > self.split_bytes:
                out.append(Stretches(group))
                group, total = [], 0
            group.append(piece)
            total += size + OPEN_BYTES
        return [*out, Stretches(group)]

    def read(self, partition: Stretches) -> Iterator[pa.RecordBatch]:
        for s in partition.parts:
            if s.member is not None:
                yield from member_rows(s.path, s.member, "member")
            elif s.end is None:
                with open_stream(s.path) as stream:
                    yield from file_rows(stream, s.path, self.header)
            else:
                fs, inner = file_system(s.path)
                with fs.open_input_file(inner) as f:
                    head = first_line(s.path) if s.start else None
                    f.seek(max(s.start - 1, 0))
                    yield from file_rows(f, s.path, self.header, s.start, s.end, head)


class PositionsDataSource(DataSource):
    """Options: ``path`` or ``paths`` (a JSON list), ``header`` (auto, true, false), ``archives`` (also, only, skip), ``splitBytes``."""

    @classmethod
    def name(cls) -> str:
        return "positions"

    def schema(self) -> str:
        return ROW_DDL

    def reader(self, schema) -> PositionsReader:
        return PositionsReader(self.options)


def read_files(spark: SparkSession, paths: str | list[str], header: str = "auto", archives: str = "also",
               split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Raw rows of the given files."""
    if not getattr(spark, "_positions_registered", False):
        spark.dataSource.register(PositionsDataSource)
        spark._positions_registered = True
    listed = [paths] if isinstance(paths, str) else list(paths)
    return (spark.read.format("positions").option("paths", json.dumps(listed)).option("header", header).option("archives", archives)
            .option("splitBytes", split_bytes).load())
