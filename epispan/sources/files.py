"""Files as rows: listed and opened by tasks as streams, so no file has to fit in memory.

Listing reads no contents, and each task gets its share of the files by size. Paths
may have any scheme pyarrow knows; what is read of a file is bounded by a chunk, a line, a
footer or one element of a JSON list.
"""

from __future__ import annotations

import codecs
import csv
import gzip
import hashlib
import io
import json
import os
import re
import zipfile
import zlib
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import islice
from typing import Any, BinaryIO

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType, _parse_datatype_string

from ..session import materialize

CHUNK_BYTES = 4 << 20
BATCH_ROWS = 20_000
TASKS_PER_CORE = 4
#: Longest header line that is looked for.
HEADER_BYTES = 1 << 20
_WILD = re.compile(r"[{}\[\]*?\\]")
UNREADABLE = (ValueError, OSError, EOFError, zipfile.BadZipFile, zlib.error, NotImplementedError)


#: What a level of the walk below given paths holds: files with their bytes, and folders (bytes null) still to be opened.
#: ``steps`` are patterns for the names of the next levels, ``inner`` says whether a folder below the path lies on the way,
#: and ``base`` is the folder above one on the way that is named like key=value.
_LEVEL = "given int, path string, bytes bigint, steps array<string>, inner boolean, base string"


def list_files(spark: SparkSession, path: str | list[str], recursive: bool = False) -> DataFrame:
    """(path, bytes) of the files at a path, folder or glob, those that Spark's readers take; contents are not read.

    Tasks open the folders, level by level, and keep what they find in tables of the shared folder, so the driver
    holds neither files nor folders. Hidden and empty files are left out. Without ``recursive`` the files right in
    a folder count, or, where folders in it are named like key=value, the files in those; key=value folders
    beside others with files raise. A few tasks for each core get the files, dealt by size.

    A store that pyarrow does not know is listed by Spark's own reader, on the driver.
    """
    tasks = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    starts = [(number, *start) for number, given in enumerate([path] if isinstance(path, str) else path) for start in _starts(spark, given)]
    if not all(_reachable(at) for _, at, _ in starts):
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
        return reader.load(path).selectExpr("path", "length AS bytes").coalesce(tasks)
    level = spark.createDataFrame([(number, at, size, steps, False, None) for number, at, steps in starts for size in _stat(at, steps)], _LEVEL)
    levels, files, bases, keyed, met = [level], 0, set(), False, set()
    own = F.when(F.col("bytes").isNotNull(), F.coalesce("base", F.regexp_replace("path", "/[^/]*$", "")))
    while True:
        facts = level.agg(
            F.count_if(F.expr("bytes IS NULL")).alias("folders"), F.count_if(F.expr("bytes > 0")).alias("files"), F.min(own).alias("least"), F.max(own).alias("most"),
            F.bool_or(F.expr("base IS NOT NULL AND bytes IS NOT NULL")).alias("keyed"), F.collect_set(F.when(F.size("steps") == 0, F.col("given"))).alias("met"),
        ).first()
        files, keyed = files + facts["files"], keyed or bool(facts["keyed"])
        bases, met = bases | {facts["least"], facts["most"]} - {None}, met.union(facts["met"])
        if not facts["folders"]:
            break
        level = materialize(level.where("bytes IS NULL").repartition(min(tasks, facts["folders"])).mapInArrow(_open_folders, _LEVEL), "_listed-files")
        levels.append(level)
    if lacking := {number for number, _, _ in starts} - met:
        raise FileNotFoundError(f"nothing at {path if isinstance(path, str) else [path[n] for n in sorted(lacking)]}")
    found = reduce(DataFrame.unionByName, levels).where("bytes > 0")
    if not recursive:
        if keyed and len(bases) > 1:
            raise ValueError(f"key=value folders beside others at {path}: {', '.join(sorted(bases))}")
        found = found.where("base IS NOT NULL" if keyed else "NOT inner")
    dealt = max(1, min(tasks, files))
    sized = found.select("path", "bytes").orderBy(F.desc("bytes"), "path").withColumn("_task", (F.monotonically_increasing_id() % dealt).cast("int"))
    return sized.repartitionById(dealt, "_task").drop("_task")


def _starts(spark: SparkSession, path: str) -> list[tuple[str, list[str]]]:
    """Where the walk for a path begins, as Hadoop names it, and patterns for the names of the levels below."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    given = hadoop.Path(path)
    whole = given.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(given).toString()
    if not _WILD.search(whole):
        return [(whole, [])]
    starts = []
    for one in hadoop.GlobExpander.expand(whole):
        parts = one.split("/")
        fixed = next((i for i, part in enumerate(parts) if _WILD.search(part)), len(parts))
        steps = [hadoop.GlobPattern(part).compiled().pattern() for part in parts[fixed:]]
        starts.append(("/".join(parts[:fixed]) + "/" * bool(steps), steps))
    return starts


def _stat(path: str, steps: list[str]) -> list[int | None]:
    """Bytes of what lies at a path: one number, null for a folder, nothing if there is none."""
    system, name = _located(path)
    info = system.get_file_info([name])[0]
    if info.type == pafs.FileType.Directory:
        return [None]
    return [] if steps or info.type == pafs.FileType.NotFound else [0 if _hidden(info.base_name) else info.size]


def _hidden(name: str) -> bool:
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _entries(path: str) -> Iterator[tuple[str, int | None]]:
    """Name and bytes (null: a folder) of what a folder holds; a local folder is streamed."""
    system, name = _located(path)
    if isinstance(system, pafs.LocalFileSystem):
        with os.scandir(name) as found:
            for entry in found:
                if entry.is_dir():
                    yield entry.name, None
                elif os.path.exists(entry.path):  # no link that leads nowhere
                    yield entry.name, entry.stat().st_size
    else:
        for info in system.get_file_info(pafs.FileSelector(name)):
            yield info.base_name, None if info.type == pafs.FileType.Directory else info.size


def _children(folder: dict[str, Any]) -> Iterator[dict[str, Any]]:
    """The next level below a folder; a hidden file that a pattern names counts as an empty one."""
    steps = folder["steps"]
    for name, size in _entries(folder["path"]):
        if steps:
            if not re.fullmatch(steps[0], name, re.DOTALL) or (size is not None and steps[1:]):
                continue
            size = 0 if size and _hidden(name) else size
        elif _hidden(name):
            continue
        below, base = size is None and not steps, folder["base"]
        if below and "=" in name and not (base and "=" in folder["path"].rpartition("/")[2]):
            base = folder["path"].rstrip("/")
        yield folder | {"path": f"{folder['path'].rstrip('/')}/{name}", "bytes": size, "steps": steps[1:], "inner": folder["inner"] or below, "base": base}


def _open_folders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        children = (child for folder in batch.to_pylist() for child in _children(folder))
        while held := list(islice(children, BATCH_ROWS)):
            yield pa.RecordBatch.from_pylist(held, schema=batch.schema)


def _located(path: str) -> tuple[pafs.FileSystem, str]:
    local = re.fullmatch(r"(?:file:/*(?=/))?(/.*)", path)
    return (pafs.LocalFileSystem(), local[1]) if local else pafs.FileSystem.from_uri(path)


def _reachable(path: str) -> bool:
    try:
        return bool(_located(path))
    except UNREADABLE:
        return False


class _Opened(io.RawIOBase):
    """A file of any file system that behaves as Python's own do, also when asked for places it does not have."""

    def __init__(self, opened: pa.NativeFile):
        self.opened = opened

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.opened.tell()

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        target = offset + {io.SEEK_SET: 0, io.SEEK_CUR: self.opened.tell(), io.SEEK_END: self.opened.size()}[whence]
        if target < 0:
            raise OSError("seek before the start of the file")
        self.opened.seek(target)
        return target

    def readinto(self, buffer: bytearray) -> int:
        return self.opened.readinto(buffer)

    def close(self) -> None:
        self.opened.close()
        super().close()


def open_file(path: str) -> BinaryIO:
    """A file for reading, with random access."""
    system, name = _located(path)
    return io.BufferedReader(_Opened(system.open_input_file(name)), 1 << 16)


def create_file(path: str) -> BinaryIO:
    """A new file for writing; its folder is made."""
    system, name = _located(path)
    system.create_dir(name.rpartition("/")[0], recursive=True)
    return system.open_output_stream(name)


def chunks(handle: BinaryIO, size: int = CHUNK_BYTES) -> Iterator[bytes]:
    while chunk := handle.read(size):
        yield chunk


def per_file(files: DataFrame, describe: Callable[[str, int], Iterator[dict]], schema: str) -> DataFrame:
    """Rows that ``describe(path, bytes)`` gives for each listed file, in batches of bounded size."""
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[dict] = []
            for path, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for row in describe(path, size):
                    held.append(row)
                    if len(held) == BATCH_ROWS:
                        yield pa.RecordBatch.from_pylist(held, schema=arrow)
                        held = []
            if held:
                yield pa.RecordBatch.from_pylist(held, schema=arrow)

    return files.select("path", "bytes").mapInArrow(run, schema)


# --- Headers and footers

def first_line(handle: BinaryIO) -> bytes:
    return handle.read(HEADER_BYTES).split(b"\n", 1)[0].rstrip(b"\r")


def line_fields(line: str, separator: str = ";") -> list[str]:
    """Field names of a header line, quotes and blanks around them dropped."""
    return [f.strip().strip('"') for f in next(csv.reader([line.strip()], delimiter=separator), [])]


def csv_headers(files: DataFrame) -> DataFrame:
    """(path, header): the first line of each text file, the only part of it that is read."""
    def describe(path: str, _: int) -> Iterator[dict]:
        with open_file(path) as handle:
            yield {"path": path, "header": first_line(handle).decode("latin1")}

    return per_file(files, describe, "path string, header string")


def parquet_footers(files: DataFrame) -> DataFrame:
    """path, rows, row_groups, fields (name, type) and error of each file, from its footer alone."""
    def describe(path: str, _: int) -> Iterator[dict]:
        try:
            with open_file(path) as handle:
                footer = pq.ParquetFile(handle)
                fields = [{"name": f.name, "type": str(f.type)} for f in footer.schema_arrow]
                yield {"path": path, "rows": footer.metadata.num_rows, "row_groups": footer.metadata.num_row_groups, "fields": fields}
        except UNREADABLE as error:
            yield {"path": path, "error": type(error).__name__}

    return per_file(files, describe, "path string, rows bigint, row_groups int, fields array<struct<name: string, type: string>>, error string")


# --- Zip archives

class ZippedRows(DataSource):
    """Rows of zipped CSV files, one task an archive; each archive holds exactly one CSV member.

    Options: ``paths``, a JSON list. The schema is source_file, source_row_number and the fields
    wanted; a field the member lacks is empty text. The member is streamed, never held.
    """

    @classmethod
    def name(cls) -> str:
        return "zipped_rows"

    def reader(self, schema: StructType) -> ZippedRowsReader:
        return ZippedRowsReader(schema, self.options)


class ZippedRowsReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        self.schema, self.fields = schema, schema.names[2:]
        self.paths = json.loads(options["paths"])
        self.required = json.loads(options.get("required", "[]"))

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(path) for path in self.paths]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        path, arrow = partition.value, to_arrow_schema(self.schema)
        with open_file(path) as handle, zipfile.ZipFile(handle) as archive:
            members = csv_members(archive)
            if len(members) != 1:
                raise ValueError(f"expected one CSV member in {path}, found {len(members)}")
            with archive.open(members[0]) as member:
                rows = csv.reader(io.TextIOWrapper(member, "latin1", newline=""), delimiter=";")
                header = next(rows, [])
                if lacking := sorted(set(self.required) - set(header)):
                    raise ValueError(f"{path}: missing fields {lacking}")
                places = [header.index(f) if f in header else None for f in self.fields]
                held: list[list[str]] = []
                number = 0
                for row in rows:
                    if not row:
                        continue
                    number += 1
                    if len(row) != len(header):
                        raise ValueError(f"{path}: row {number} has {len(row)} fields, its header {len(header)}")
                    held.append(row)
                    if len(held) == BATCH_ROWS:
                        yield self._batch(path, held, number, places, arrow)
                        held = []
                if held:
                    yield self._batch(path, held, number, places, arrow)

    @staticmethod
    def _batch(path: str, rows: list[list[str]], last: int, places: list[int | None], arrow: pa.Schema) -> pa.RecordBatch:
        texts = [[row[p] for row in rows] if p is not None else [""] * len(rows) for p in places]
        numbers = list(range(last - len(rows) + 1, last + 1))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for f, c in zip(arrow, [[path] * len(rows), numbers, *texts], strict=True)], schema=arrow)


def csv_members(archive: zipfile.ZipFile) -> list[str]:
    return [m for m in archive.namelist() if m.lower().endswith(".csv")]


def scan_archives(spark: SparkSession, paths: list[str], fields: list[str], required: list[str]) -> DataFrame:
    """source_file, source_row_number and ``fields`` of every row of the archives at ``paths``."""
    spark.dataSource.register(ZippedRows)
    schema = _parse_datatype_string("source_file string, source_row_number bigint")
    schema = StructType([*schema.fields, *[StructField(f, StringType()) for f in fields]])
    reader = spark.read.format(ZippedRows.name()).schema(schema)
    return reader.option("paths", json.dumps(paths)).option("required", json.dumps(required)).load()


# --- Digests and formats, in one reading

class JsonStream:
    """The outline of a JSON text read in pieces: elements of its outermost list, or of chosen lists of its outermost object.

    Only one element is held at a time.
    """

    def __init__(self, pieces: Iterator[str]):
        self.pieces, self.text, self.at, self.ended = pieces, "", 0, False
        self.decoder = json.JSONDecoder()

    def _more(self) -> None:
        """Reads on; what is held at least doubles, so parsing an element again stays cheap."""
        wanted = max(1, len(self.text) - self.at)
        fresh: list[str] = []
        while wanted > 0 and not self.ended:
            piece = next(self.pieces, None)
            self.ended = piece is None
            fresh.append(piece or "")
            wanted -= len(fresh[-1])
        self.text, self.at = self.text[self.at:] + "".join(fresh), 0

    def _next(self) -> str:
        """The next character that is not blank, not taken; empty at the end."""
        while True:
            while self.at < len(self.text) and self.text[self.at] in " \t\n\r":
                self.at += 1
            if self.at < len(self.text) or self.ended:
                return self.text[self.at:self.at + 1]
            self._more()

    def _take(self, allowed: str) -> str:
        found = self._next()
        if not found or found not in allowed:
            raise ValueError(f"expected one of {allowed!r}, found {found!r}")
        self.at += 1
        return found

    def _value(self) -> Any:
        self._next()
        while True:
            try:
                value, end = self.decoder.raw_decode(self.text, self.at)
            except ValueError:
                if self.ended:
                    raise
            else:
                # A number may go on behind the end of what is held.
                if end < len(self.text) or self.ended:
                    self.at = end
                    return value
            self._more()

    def _elements(self) -> int:
        self._take("[")
        n = 0
        if self._next() == "]":
            self.at += 1
            return n
        while True:
            self._value()
            n += 1
            if self._take(",]") == "]":
                return n

    def outline(self, lists: tuple[str, ...] = ()) -> tuple[str, Any]:
        """Name of the outermost type with the number of list elements, or the object's members as far as chosen.

        Of an object the members in ``lists`` are counted where they are lists, other members are kept if
        they are text or numbers.
        """
        first = self._next()
        kept: Any
        if first == "[":
            kind, kept = "list", self._elements()
        elif first == "{":
            kind, kept = "dict", self._members(lists)
        else:
            value = self._value()
            kind, kept = type(value).__name__, value
        if self._next():
            raise ValueError("text behind the end of the value")
        return kind, kept

    def _members(self, lists: tuple[str, ...]) -> dict[str, Any]:
        kept: dict[str, Any] = {}
        self._take("{")
        if self._next() == "}":
            self.at += 1
            return kept
        while True:
            if self._next() != '"':
                raise ValueError("a member without a name")
            name = self._value()
            self._take(":")
            if name in lists and self._next() == "[":
                kept[name] = [self._elements()]
            else:
                value = self._value()
                kept[name] = value if isinstance(value, str | int | float) else None
            if self._take(",}") == "}":
                return kept


def digest(handle: BinaryIO) -> str:
    found = hashlib.sha256()
    for chunk in chunks(handle):
        found.update(chunk)
    return found.hexdigest()


def file_digests(files: DataFrame) -> DataFrame:
    """path, bytes and sha256 of each listed file."""
    def describe(path: str, size: int) -> Iterator[dict]:
        with open_file(path) as handle:
            yield {"path": path, "bytes": size, "sha256": digest(handle)}

    return per_file(files, describe, "path string, bytes bigint, sha256 string")


Verdict = tuple[bool, dict[str, Any], list[str]]


def json_format(handle: BinaryIO) -> Verdict:
    kind, _ = JsonStream(codecs.iterdecode(chunks(handle), "utf-8")).outline()
    return kind in ("list", "dict"), {"json_type": kind}, []


def shape_format(handle: BinaryIO) -> Verdict:
    """A feature collection, packed or not."""
    packed = handle.read(2) == b"\x1f\x8b"
    handle.seek(0)
    plain = gzip.GzipFile(fileobj=handle) if packed else handle
    kind, members = JsonStream(codecs.iterdecode(chunks(plain), "utf-8")).outline(("features",))
    members = members if kind == "dict" else {}
    features = members.get("features")
    fine = members.get("type") == "FeatureCollection" and isinstance(features, list)
    details = {"json_type": kind, "geojson_type": members.get("type"), "features": features[0] if isinstance(features, list) else 0}
    return fine, details, [] if fine else ["invalid_geojson_feature_collection"]


def archive_format(handle: BinaryIO) -> Verdict:
    with zipfile.ZipFile(handle) as archive:
        names, broken = archive.namelist(), archive.testzip()
    details = {"members": len(names), "first_members": names[:10]}
    return broken is None, details, [f"corrupt_zip_member:{broken}"] if broken else []


def columnar_format(handle: BinaryIO) -> Verdict:
    footer = pq.ParquetFile(handle).metadata
    return True, {"rows": footer.num_rows, "columns": footer.num_columns, "row_groups": footer.num_row_groups}, []


def header_format(required: list[str], registry_field: str) -> Callable[[BinaryIO], Verdict]:
    def check(handle: BinaryIO) -> Verdict:
        fields = set(line_fields(first_line(handle).decode("latin1")))
        details: dict[str, Any] = {"delimiter": ";", "columns": len(fields)}
        if len(fields) == 2 and registry_field in fields:
            return True, details | {"fields": sorted(fields)}, []
        lacking = sorted(set(required) - fields)
        details |= {"required_fields_present": sorted(set(required) & fields), "missing_required_fields": lacking}
        return not lacking, details, [f"missing_required_fields:{','.join(lacking)}"] if lacking else []

    return check


def page_format(marks: list[str]) -> Callable[[BinaryIO], Verdict]:
    def check(handle: BinaryIO) -> Verdict:
        wanted = {m: m.encode("latin1") for m in marks}
        seen, tail, overlap = dict.fromkeys(marks, False), b"", max(map(len, marks))
        for chunk in chunks(handle):
            window = tail + chunk
            seen = {m: found or wanted[m] in window for m, found in seen.items()}
            tail = window[-overlap:]
        fine = all(seen.values())
        return fine, seen, [] if fine else ["unexpected_page_marks"]

    return check


def document_format(handle: BinaryIO) -> Verdict:
    head = handle.read(5)
    return head == b"%PDF-", {"header": head.decode("ascii", "replace")}, []


def file_verdicts(files: DataFrame, checks: dict[str, Callable[[BinaryIO], Verdict]]) -> DataFrame:
    """path, bytes, sha256, format_ok, format_details (JSON, keys sorted) and format_errors of each listed file.

    The suffix chooses the check. Each file is opened once, digested and judged from that handle.
    """
    def describe(path: str, size: int) -> Iterator[dict]:
        name, dot, suffix = path.rpartition("/")[2].rpartition(".")
        check = checks.get(suffix.lower()) if dot else None
        with open_file(path) as handle:
            found = {"path": path, "bytes": size, "sha256": digest(handle)}
            if check is None:
                fine, details, errors = False, {}, [f"unsupported_format:{dot}{suffix.lower()}" if dot else "unsupported_format:"]
            else:
                handle.seek(0)
                try:
                    fine, details, errors = check(handle)
                except UNREADABLE as error:
                    fine, details, errors = False, {}, [type(error).__name__]
        yield found | {"format_ok": fine, "format_details": json.dumps(details, sort_keys=True, ensure_ascii=False), "format_errors": errors}

    return per_file(files, describe, "path string, bytes bigint, sha256 string, format_ok boolean, format_details string, format_errors array<string>")
