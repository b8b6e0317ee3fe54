"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.session import checkpoint_dir


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor then costs a re-read, and what several later
    jobs need is computed once. The path is new on each call, so callers never
    overwrite each other.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just ``doc_id`` and ``text`` (null text: empty). Any other column, whatever its
    name, is left behind here, so it can't clash with an operator's own columns."""
    return df.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))


def give_back() -> None:
    """Return freed memory of this process to the system, where it can be."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def tidy(run):
    """``run`` for ``mapInArrow``, giving its memory back at the end of each task: workers
    live on, and what one task has used would count against the next one's."""
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            give_back()
    return wrapped


def own_name(columns: list[str], name: str) -> str:
    """``name``, lengthened until it clashes with none of a caller's columns."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def blocks(batches, column: str, target_bytes: int):
    """Regroup Arrow batches into tables holding at most ``target_bytes`` of ``column``.

    A block ends before the row that would overflow it, wherever batches end, so the
    blocks depend on the rows alone; one longer row is a block of its own. What a block
    has used is given back to the system before the next, as workers live on between
    tasks.
    """
    held, size = [], 0
    for batch in batches:
        lens = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64)
        start, ends = 0, np.cumsum(lens)
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = int(np.searchsorted(ends, before + target_bytes - size, side="right"))
            if stop <= start and held:
                yield pa.Table.from_batches(held)
                held, size = [], 0
                give_back()
                continue
            stop = max(start + 1, stop)
            held.append(batch.slice(start, stop - start))
            size += int(ends[stop - 1] - before)
            start = stop
    if held:
        yield pa.Table.from_batches(held)
        give_back()


def column(table: pa.Table, name: str) -> pa.Array:
    col = table.column(name).combine_chunks()
    return col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col


def spread(lens: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Indices ``starts[i], starts[i]+1, ...`` (``lens[i]`` of them) for all i, in order."""
    ends = np.cumsum(lens)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lens), lens)


def word_lists(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words of each text, split at ASCII white space (``[\\x20\\x09-\\x0D]``).

    Returns (ends per text, code per word, dictionary of the distinct words).
    """
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    offsets = np.asarray(lists.offsets).astype(np.int64)
    offsets = offsets - offsets[0]
    coded = flat.dictionary_encode()
    codes, words = np.asarray(coded.indices).astype(np.int64), coded.dictionary
    empty = pc.index(words, pa.scalar("", words.type)).as_py()
    if empty >= 0:  # before leading and after trailing white space
        keep = codes != empty
        offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
        codes = codes[keep]
    return offsets[1:], codes, words


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (public splitmix64 constants), element by element."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
