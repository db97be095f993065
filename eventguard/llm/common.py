"""Helpers of the text operators: words, free column names, shared tables, learning splits."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventguard.config import work_dir

# The characters between words: blank, tab, line feed, vertical tab, form feed, return.
SPACE = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder, for results that are used several times."""
    path = work_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Column names that the frame does not use, whatever columns it came with."""
    used = {name.lower() for name in df.columns}
    found = []
    for name in wanted:
        while name.lower() in used:
            name = f"_{name}"
        used.add(name.lower())
        found.append(name)
    return found


def beside(keep: list[str], *results: str) -> list[str]:
    """The kept columns without those that are called like a result, whatever the case of letters."""
    return [name for name in keep if name.lower() not in {r.lower() for r in results}]


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once per row, however often `use` names it."""
    return F.transform(F.array(value), use)[0]


def held_out(key: Column, parts: int) -> Column:
    """Rows left out of learning: crc32 of the key as text, modulo `parts`, is 2."""
    return F.coalesce(F.crc32(key.cast("string")) % parts == 2, F.lit(False))


def utf8(text: Column) -> Column:
    """The bytes of a text, empty for null."""
    return F.coalesce(text, F.lit("")).cast("binary")


def _bytes(column: pa.Array) -> list[bytes]:
    return [b"" if v is None else v.encode() if isinstance(v, str) else v for v in column.to_pylist()]


def in_chunks(
    texts: pa.RecordBatch, name: str, limit: int = 4 << 20
) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Pieces of a batch with about `limit` bytes of text each, one row at least.

    The texts come as bytes, empty for null.
    """
    start, size = 0, 0
    lengths = pc.fill_null(pc.binary_length(texts.column(name)), 0).to_pylist()
    for i, n in enumerate(lengths):
        if i > start and size + n > limit:
            part = texts.slice(start, i - start)
            yield part, _bytes(part.column(name))
            start, size = i, 0
        size += n
    if start < len(lengths):
        part = texts.slice(start)
        yield part, _bytes(part.column(name))


def distinct(values: np.ndarray) -> np.ndarray:
    """The different values, sorted; by sorting, which is much faster than `np.unique` by hashing."""
    values = np.sort(values)
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return values[new]


def buckets_for(df: DataFrame, text: str, size: int = 64 << 20, least: int = 64) -> int:
    """Power of two that gives each bucket of a counting exchange about `size` bytes of text."""
    total = df.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    return max(least, 1 << (total // size).bit_length())


def packed_texts(docs: DataFrame) -> DataFrame:
    """_chunk, rids, sizes, texts: the texts (_text, _rid) of a chunk compressed together, to be moved cheaply.

    Rows of a chunk lie behind each other; where a batch ends inside a chunk, it takes two rows.
    """

    def pack(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            chunks = part.column("_chunk").to_numpy()
            heads = np.flatnonzero(np.diff(chunks, prepend=-1) != 0).tolist()
            rows = []
            for a, b in zip(heads, [*heads[1:], len(chunks)]):
                texts = _bytes(part.column("_text").slice(a, b - a))
                sizes = np.array([len(t) for t in texts], np.int64)
                body = pa.compress(b"".join(texts), codec="zstd", asbytes=True)
                rows.append((int(chunks[a]), part.column("_rid").slice(a, b - a).to_numpy().tobytes(), sizes.tobytes(), body))
            kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)],
                names=["_chunk", "rids", "sizes", "texts"],
            )

    return docs.select("_chunk", "_rid", "_text").mapInArrow(pack, "_chunk long, rids binary, sizes binary, texts binary")


def unpacked_texts(rows: pd.DataFrame) -> tuple[np.ndarray, list[bytes]]:
    """The numbers and texts of a chunk from its packed rows, by number."""
    rids, texts = [np.zeros(0, np.int64)], []
    for rid, size, body in zip(rows["rids"], rows["sizes"], rows["texts"]):
        sizes = np.frombuffer(size, np.int64)
        flat = pa.decompress(body, decompressed_size=int(sizes.sum()), codec="zstd", asbytes=True)
        ends = np.cumsum(sizes).tolist()
        texts += [flat[e - n:e] for e, n in zip(ends, sizes.tolist())]
        rids.append(np.frombuffer(rid, np.int64))
    every = np.concatenate(rids)
    order = np.argsort(every)
    return every[order], [texts[i] for i in order.tolist()]
