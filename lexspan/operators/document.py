"""Reading a document back from its chunks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import clamp_int, requested_file, slice_page

# The overlaps that are sought, and the bounds of a page.
MOST_OVERLAP, LEAST_OVERLAP = 1000, 20
DEFAULT_LIMIT, LEAST_LIMIT, MOST_LIMIT = 40000, 1000, 60000


def join_overlapping(text: str, chunk: str) -> str:
    """Appends a chunk without the longest overlap of 20 to 1000 characters; with none, behind a space."""
    if not text or not chunk:
        return text or chunk
    # An overlap begins where the chunk's first characters stand in the text's end; the first such place gives the longest.
    end = text[-min(MOST_OVERLAP, len(chunk)) :]
    head = chunk[:LEAST_OVERLAP]
    at = end.find(head) if len(head) == LEAST_OVERLAP else -1
    while at >= 0 and not chunk.startswith(end[at:]):
        at = end.find(head, at + 1)
    return f"{text} {chunk}" if at < 0 else text + chunk[len(end) - at :]


#: Chunks that are Python strings at a time, and characters after which a task passes on the documents that it has joined.
ROWS, PASSED_ON = 256, 1 << 20
DOCUMENT = "file string, chunk_count long, text string"


def reassemble(chunks: DataFrame) -> DataFrame:
    """file, chunk_count, text of every document, by overlap as the chunks stand.

    A fold in order has no built-in. The chunks are sorted by file and number and streamed through
    tasks, which hold one document and PASSED_ON characters of others. Where text repeats
    itself the longest overlap may be too long; `reassemble_exactly` isn't misled.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple[str, int, str]] = []
        held, file, n, pieces, end = 0, None, 0, [], ""
        passed_on = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), (pa.string(), pa.int64(), pa.string()), strict=True)], names=["file", "chunk_count", "text"])
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                for own, content in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    if n and own != file:
                        done.append((file, n, "".join(pieces)))
                        held += len(done[-1][2])
                        n, pieces, end = 0, [], ""
                        if held >= PASSED_ON:
                            yield passed_on()
                            done, held = [], 0
                    joined = join_overlapping(end, content or "")
                    pieces.append(joined[len(end) :])
                    # An overlap never reaches beyond the end, so the text isn't copied for each chunk.
                    file, n, end = own, n + 1, joined[-MOST_OVERLAP:]
        if n:
            done.append((file, n, "".join(pieces)))
        if done:
            yield passed_on()

    rows = chunks.select("file", "chunk_no", "content").repartition("file").sortWithinPartitions("file", F.asc_nulls_last("chunk_no"))
    return rows.select("file", "content").mapInArrow(fold, DOCUMENT)


def reassemble_exactly(chunks: DataFrame) -> DataFrame:
    """The same from where the windows begin, without looking at the text: exactly the cleaned text.

    Each window gives what precedes the next one; a space that trimming took at its end is
    put back.
    """
    w = F.array_sort(F.collect_list(F.struct("start", "content")))
    ahead = lambda i: F.element_at(F.col("w"), i + 2)["start"]
    pieces = F.transform(
        F.col("w"),
        lambda c, i: F.when(i == F.size("w") - 1, c["content"]).otherwise(F.rpad(c["content"], ahead(F.least(i, F.size("w") - 2)) - c["start"], F.lit(" "))),
    )
    return chunks.groupBy("file").agg(F.count(F.lit(1)).alias("chunk_count"), w.alias("w")).select("file", "chunk_count", F.concat_ws("", pieces).alias("text"))


def read_document(chunks: DataFrame, file: str, offset: object = 0, limit: object = DEFAULT_LIMIT) -> DataFrame:
    """One row for a page of a document, none if it isn't there. The file filter reaches the scan."""
    wanted = requested_file(file)
    if not wanted:
        raise ValueError("a file is required")
    offset = max(0, clamp_int(offset, 0, 0, 2**31 - 1))
    limit = clamp_int(limit, DEFAULT_LIMIT, LEAST_LIMIT, MOST_LIMIT)
    whole = reassemble(chunks.where((F.col("file") == wanted) & F.col("content").isNotNull()))
    page = slice_page(F.col("text"), offset, limit)
    return whole.select("file", page["offset"].alias("offset"), page["returned_characters"].alias("returned_characters"), page["total_characters"].alias("total_characters"),
                        "chunk_count", page["has_more"].alias("has_more"), page["next_offset"].alias("next_offset"), page["text"].alias("text"))
