"""Source files: listing, hashing and text extraction."""

from __future__ import annotations

import io
import multiprocessing
import resource
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .pdf import pdf_text

# The folders that hold sources, and those that are passed over.
ROOTS = ("00_GPT_CONFIGURATION", "01_POLICY", "02_LAW", "03_PROCUREMENT", "04_FUNDING", "05_COMPANIES")
IGNORED = ("node_modules", ".git", ".vscode", "dist", "build", "index")
GLOB, EXTENSION = "*.{[pP][dD][fF],[dD][oO][cC][xX]}", r"(?i)\.(pdf|docx)$"
#: Seconds that one file may take: default and least.
TIMEOUT, LEAST_TIMEOUT = 300, 30
#: Files whose texts a task passes on together.
AT_ONCE = 32
#: Megabytes that a reader in a child process may take beyond what its parent holds.
MEMORY_MB = 1024


def relative_path(path: Column, root: str) -> Column:
    """Path below the root, with forward slashes."""
    plain = F.replace(F.regexp_replace(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), "^file:/+", "/"), F.lit("\\"), F.lit("/"))
    below = root.replace("\\", "/").rstrip("/") + "/"
    return F.when(plain.startswith(below), F.substring(plain, F.lit(len(below) + 1), F.length(plain))).otherwise(plain)


def is_source(file: Column) -> Column:
    """Whether the extension is a source's and no folder on the way is passed over."""
    return file.rlike(EXTENSION) & ~F.exists(F.slice(F.split(file, "/"), 1, F.size(F.split(file, "/")) - 1), lambda p: p.isin(*IGNORED))


def list_files(spark: SparkSession, folder: str, root: str | None = None) -> DataFrame:
    """file, absolute_path, size, content of the sources below a folder; a missing folder has none."""
    root = root or folder
    empty = spark.createDataFrame([], "file string, absolute_path string, size long, content binary")
    # A file that can't be read, or goes meanwhile, is left out.
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", GLOB).option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True)
    try:
        found = reader.load(folder)
    except Exception as error:  # the analyser names the missing path
        if "PATH_NOT_FOUND" in str(error):
            return empty
        raise
    named = found.select(relative_path(F.col("path"), root).alias("file"), F.col("path").alias("absolute_path"), F.col("length").alias("size"), "content")
    return named.where(is_source(F.col("file")))


def discover(spark: SparkSession, root: str, roots: tuple[str, ...] = ROOTS) -> DataFrame:
    """The sources below all fixed roots. `in_ingest_order` ranks them by collated path, without moving their bytes."""
    out = None
    for folder in roots:
        own = list_files(spark, f"{root.rstrip('/')}/{folder}", root)
        out = own if out is None else out.unionByName(own)
    return out


def source_map(files: DataFrame) -> DataFrame:
    """file, absolute_path, sha256, size; files that can't be read drop out with their row."""
    return files.where(F.col("content").isNotNull()).select("file", "absolute_path", F.sha2("content", 256).alias("sha256"), "size")


def read_docx(content: bytes) -> str:
    """Raw text of a DOCX: a paragraph a line, tabs and breaks kept."""
    w = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        body = ElementTree.fromstring(z.read("word/document.xml"))
    lines = []
    for paragraph in body.iter(f"{w}p"):
        parts = {f"{w}t": lambda e: e.text or "", f"{w}tab": lambda e: "\t", f"{w}br": lambda e: "\n"}
        lines.append("".join(parts[e.tag](e) for e in paragraph.iter() if e.tag in parts))
    return "\n\n".join(lines)


#: The readers by extension; any function of bytes can stand in for one.
READERS: dict[str, Callable[[bytes], str]] = {"docx": read_docx, "pdf": pdf_text}


def _in_child(reader: Callable[[bytes], str], content: bytes, pipe, memory_mb: int) -> None:
    try:
        with open("/proc/self/statm") as f:
            held = int(f.read().split()[0]) * resource.getpagesize()
        most = held + (memory_mb << 20)
        resource.setrlimit(resource.RLIMIT_AS, (most, most))
    except OSError:  # no such figures on this system: the time limit alone holds
        pass
    try:
        pipe.send((True, reader(content)))
    except MemoryError:
        pipe.send((False, f"out of memory beyond {memory_mb} MB"))
    except BaseException as error:
        pipe.send((False, str(error) or type(error).__name__))


def extract_one(file: str, content: bytes | None, readers: dict[str, Callable[[bytes], str]] = READERS, timeout: float | None = None, memory_mb: int = MEMORY_MB) -> tuple[bool, str | None, str | None]:
    """(ok, text, reason). With a timeout the reader runs in a child process, which is ended when time is up or memory used up."""
    reader = readers.get(file.rpartition(".")[2].lower())
    if reader is None:
        return False, None, "Unsupported file type"
    if timeout is None:
        try:
            return True, reader(content or b""), None
        except Exception as error:
            return False, None, str(error) or type(error).__name__
    near, far = multiprocessing.Pipe(False)
    child = multiprocessing.get_context("fork").Process(target=_in_child, args=(reader, content or b"", far, memory_mb), daemon=True)
    child.start()
    far.close()
    try:
        ok, out = near.recv() if near.poll(timeout) else (False, f"timed out after {timeout:g} s")
    except EOFError:
        ok, out = False, "the reader died"
    if child.is_alive():
        child.terminate()
        child.join(5)
        child.kill()
    child.join()
    return ok, out if ok else None, None if ok else out


def extract(files: DataFrame, readers: dict[str, Callable[[bytes], str]] = READERS, timeout: float | None = None) -> DataFrame:
    """file, ok, text, reason of each file; a file that fails never fails the job. A task holds a batch of bytes and the texts of AT_ONCE files."""
    limit = None if timeout is None else max(LEAST_TIMEOUT, timeout)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, AT_ONCE):
                part = batch.slice(at, AT_ONCE)
                out = [extract_one(f.as_py(), c.as_py(), readers, limit) for f, c in zip(part.column(0), part.column(1), strict=True)]
                columns = [pa.array([o[k] for o in out], t) for k, t in enumerate((pa.bool_(), pa.string(), pa.string()))]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=["file", "ok", "text", "reason"])

    return files.select("file", "content").mapInArrow(run, "file string, ok boolean, text string, reason string")
