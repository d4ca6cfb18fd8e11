"""Archives of report files to texts: ZIPs in ZIPs, decoders, and file and error logs."""

from __future__ import annotations

import io
import re
import zipfile
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

ENTRY_SUFFIX, ARCHIVE_SUFFIXES = "esr.pdf", (".zip", ".zp")
ENTRIES = "archive string, entry string, content binary, error string"
ZIP_GLOB = "*.[zZ][iI][pP]"
#: Parts in which the entries of one name are counted.
LOG_PARTS = 256
MAX_DEPTH, MAX_ENTRY_BYTES, MAX_ENTRIES = 8, 256 << 20, 100_000


class TextDecoder(Protocol):
    """Bytes of a file to (text, whether all of it was read). Instances are sent to the Python workers."""

    def decode(self, content: bytes) -> tuple[str, bool]: ...


class PlainTextDecoder:
    """UTF-8 text files."""

    def decode(self, content: bytes) -> tuple[str, bool]:
        try:
            return content.decode(), True
        except UnicodeDecodeError:
            return content.decode(errors="replace"), False


class SimplePdfDecoder:
    """The text operators of plain or deflated PDF streams, by the standard library alone.

    It reads literal and hexadecimal strings in simple encodings, a line for
    each text positioning. For other files plug in a decoder around a PDF library.
    """

    _string = re.compile(rb"\((?:\\.|[^\\()])*\)|<[0-9A-Fa-f\s]*>|\b(?:Td|TD|Tm|T\*|BT|ET)\b|['\"]", re.DOTALL)
    _escape = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}

    def decode(self, content: bytes) -> tuple[str, bool]:
        if not content.startswith(b"%PDF"):
            return "", False
        pages, ok = [], True
        for m in re.finditer(rb"stream\r?\n(.*?)\r?\n?endstream", content, re.DOTALL):
            raw = m[1]
            if b"FlateDecode" in content[max(0, m.start() - 300) : m.start()]:
                try:
                    raw = zlib.decompress(raw)
                except zlib.error:
                    ok = False
                    continue
            if b"BT" in raw:
                pages.append(self._page(raw))
        return "".join(pages), ok and bool(pages)

    def _page(self, raw: bytes) -> str:
        out: list[str] = []
        for m in self._string.finditer(raw):
            token = m[0]
            if token[:1] == b"(":
                text = re.sub(rb"\\(\d{1,3}|.|\n)", lambda e: bytes([int(e[1], 8) & 255]) if e[1].isdigit() else self._escape.get(e[1], e[1]), token[1:-1], flags=re.DOTALL)
                out.append(text.decode("latin-1"))
            elif token[:1] == b"<":
                digits = re.sub(rb"\s", b"", token[1:-1])
                out.append(bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode()).decode("latin-1"))
            elif out and not out[-1].endswith("\n"):
                out.append("\n")
        return "".join(out)


@dataclass
class Limits:
    """What an archive may hold; beyond it the archive's rest is an error row."""

    depth: int = MAX_DEPTH
    entry_bytes: int = MAX_ENTRY_BYTES
    entries: int = MAX_ENTRIES


def walk_archive(content: bytes, suffix: str = ENTRY_SUFFIX, limits: Limits | None = None) -> Iterator[tuple[str, bytes | None, str | None]]:
    """(path inside, bytes, error) of every wanted entry, archives in archives included; nothing touches a disk."""
    limits, seen = limits or Limits(), 0

    def walk(raw: bytes, prefix: str, depth: int) -> Iterator[tuple[str, bytes | None, str | None]]:
        nonlocal seen
        if depth > limits.depth:
            yield prefix, None, f"archives are nested deeper than {limits.depth}"
            return
        try:
            archive = zipfile.ZipFile(io.BytesIO(raw))
        except (zipfile.BadZipFile, OSError) as e:
            yield prefix, None, f"not a readable archive: {e}"
            return
        for info in archive.infolist():
            name, nested = info.filename, info.filename.lower().endswith(ARCHIVE_SUFFIXES)
            if info.is_dir() or not (nested or name.lower().endswith(suffix)):
                continue
            seen += 1
            if seen > limits.entries or info.file_size > limits.entry_bytes:
                yield prefix + name, None, "beyond the limits of entries or size"
                if seen > limits.entries:
                    return
                continue
            try:
                own = archive.read(info)
            except (zipfile.BadZipFile, RuntimeError, OSError, zlib.error, NotImplementedError) as e:
                yield prefix + name, None, f"not readable: {e}"
                continue
            if nested:
                yield from walk(own, f"{prefix}{name}!", depth + 1)
            else:
                yield prefix + name, own, None

    yield from walk(content, "", 0)


def read_archives(spark: SparkSession, paths: str | Iterable[str], glob: str | None = ZIP_GLOB) -> DataFrame:
    """(path, content) of archive files. A folder is listed without its subfolders; explicit files need no glob."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.format("binaryFile")
    if glob and not all(p.lower().endswith(ARCHIVE_SUFFIXES) for p in paths):
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(paths).select("path", "content")


def expand_archives(archives: DataFrame, suffix: str = ENTRY_SUFFIX, limits: Limits | None = None) -> DataFrame:
    """(path, content) to (archive, entry, content, error), one row per wanted file or failure; a task per split of files."""

    def expand(batches):
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                for entry, own, error in walk_archive(content.as_py() or b"", suffix, limits):
                    yield pa.RecordBatch.from_arrays([pa.array([path], pa.string()), pa.array([entry], pa.string()), pa.array([own], pa.binary()), pa.array([error], pa.string())], ["archive", "entry", "content", "error"])

    return archives.select("path", "content").mapInArrow(expand, ENTRIES)


def decode_entries(entries: DataFrame, decoder: TextDecoder) -> DataFrame:
    """(archive, source_path, text, pdf_ok) of the entries that were read."""

    def decode(batches):
        for batch in batches:
            found = [decoder.decode(c) for c in batch.column("content").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("archive"), batch.column("entry"), pa.array([t for t, _ in found], pa.string()), pa.array([ok for _, ok in found], pa.bool_())], ["archive", "source_path", "text", "pdf_ok"])

    return entries.where("error IS NULL").select("archive", "entry", "content").mapInArrow(decode, "archive string, source_path string, text string, pdf_ok boolean")


def file_log(entries: DataFrame) -> DataFrame:
    """(ZIP, File, stored_as): base names, with _1, _2 … where several entries have one name.

    All entries may have one name, so the numbers are counted in LOG_PARTS parts
    of a name, by hash of archive and entry, and start where the part before ends.
    """
    base = lambda c: F.regexp_extract(c, r"([^/!]*)$", 1)
    named = entries.where("error IS NULL").select(base(F.col("archive")).alias("ZIP"), base(F.col("entry")).alias("File"), "archive", "entry")
    # one entry is one part, so that a name of few entries is counted in the order of archive and entry
    many = named.groupBy("File").agg(F.when(F.count(F.lit(1)) > LOG_PARTS, LOG_PARTS).otherwise(1).alias("_parts"))
    parted = named.join(many, "File").withColumn("_part", F.pmod(F.xxhash64("archive", "entry"), F.col("_parts")).cast("int"))
    sizes = parted.groupBy("File", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("File").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("File", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    rank = F.row_number().over(Window.partitionBy("File", "_part").orderBy("archive", "entry")) - 1
    named = parted.withColumn("_rank", rank).join(firsts, ["File", "_part"])
    k = F.col("_first") + F.col("_rank")
    stem, ext = F.regexp_extract("File", r"^(.*?)(\.[^.]*)?$", 1), F.regexp_extract("File", r"^(.*?)(\.[^.]*)?$", 2)
    return named.select("ZIP", "File", F.when(k == 0, F.col("File")).otherwise(F.concat(stem, F.lit("_"), k.cast("string"), ext)).alias("stored_as"), "archive", "entry")


def error_log(entries: DataFrame) -> DataFrame:
    """(ts, zip, file, code, message) of what couldn't be read."""
    return entries.where("error IS NOT NULL").select(F.current_timestamp().alias("ts"), F.col("archive").alias("zip"), F.col("entry").alias("file"), F.lit(1).alias("code"), F.col("error").alias("message"))


def copy_files(entries: DataFrame, folder: str) -> DataFrame:
    """Writes the entries as files under their ``stored_as`` names to a folder that all executors share; returns (stored_as, bytes)."""

    def write(batches):
        import os

        os.makedirs(folder, exist_ok=True)
        for batch in batches:
            names, sizes = batch.column("stored_as").to_pylist(), []
            for name, content in zip(names, batch.column("content").to_pylist(), strict=True):
                # a retried task writes the same file again, and no reader sees a part of it
                part = os.path.join(folder, f".{name}.part")
                with open(part, "wb") as f:
                    f.write(content)
                os.replace(part, os.path.join(folder, name))
                sizes.append(len(content))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sizes, pa.int64())], ["stored_as", "bytes"])

    named = file_log(entries).select("archive", "entry", "stored_as").join(entries.where("error IS NULL"), ["archive", "entry"])
    return named.select("stored_as", "content").mapInArrow(write, "stored_as string, bytes long")
