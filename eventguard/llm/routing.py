"""Brings together the parts of texts that may hold a repeated window of fixed length.

Every window of `window` symbols is represented by its smallest k-gram, its anchor; equal
windows have equal anchors at equal places. Occurrences of anchors are counted per chunk of
texts first; only anchors that occur again somewhere are followed up. The stretch of text
around such an anchor, which holds all windows it represents, goes to the shard of the
anchor, equal stretches of a chunk once with their number. Where one anchor is very
frequent its windows go one by one to shards of their own content, so no anchor fills a shard.

What a shard finds repeated comes back as intervals of the texts.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from eventguard.llm.common import buckets_for, in_chunks, packed_texts, stored, unpacked_texts, utf8
from eventguard.llm.ngramjoin import _chunk_numbers, _filled, _pack, _unpack, mix

_A = np.uint64(0x9E3779B97F4A7C15)
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _A)


@dataclass(frozen=True)
class RouteConfig:
    window: int
    gram: int
    # Symbols are words between ASCII white space, or else bytes.
    words: bool
    # Occurrences from which an anchor's windows are sent one by one.
    hot: int = 20_000
    chunk: int = 4 << 20
    # Symbols in a shard, about.
    shard: int = 1_000_000


class Symbols:
    """Symbols of some texts behind each other: a hash of each, the number in each text."""

    def __init__(self, texts: list[bytes], words: bool):
        self.words = words
        if words:
            self.split = [t.split() for t in texts]
            self.sizes = np.array([len(s) for s in self.split], np.int64)
            self.flat = [w for s in self.split for w in s]
            known = {w: xxhash.xxh3_64_intdigest(w) for w in set(self.flat)}
            self.hashes = np.fromiter((known[w] for w in self.flat), np.uint64, len(self.flat))
        else:
            self.sizes = np.array([len(t) for t in texts], np.int64)
            self.flat = b"".join(texts)
            self.hashes = _BYTES[np.frombuffer(self.flat, np.uint8)]
        self.starts = np.cumsum(self.sizes) - self.sizes

    def content(self, a: int, b: int) -> bytes:
        return b" ".join(self.flat[a:b]) if self.words else self.flat[a:b]


def _grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k symbols from each place on, by doubling."""
    width, out, power = 1, hashes, _A
    while width < k:
        step = min(width, k - width)
        n = len(out) - step
        if n <= 0:
            return np.zeros(0, np.uint64)
        # The two halves may overlap; with all symbols covered the hash is still of the gram.
        out = out[:n] * power + out[step:]
        power = mix(np.array([power]))[0] | np.uint64(1)
        width += step
    return mix(out)


def anchors(symbols: Symbols, cfg: RouteConfig) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places of anchors, their hashes, and the first and last window start of each."""
    none = np.zeros(0, np.int64)
    total = len(symbols.hashes)
    grams = _grams(symbols.hashes, cfg.gram)
    span = cfg.window - cfg.gram + 1
    n = total - cfg.window + 1
    if n <= 0:
        return none, none.view(np.uint64), none, none
    # Ordered by hash, then place; so the leftmost of equal grams is taken.
    bits = np.uint64(max(int(total).bit_length(), 1))
    low = (grams >> bits << bits) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while width < span:
        step = min(width, span - width)
        low = np.minimum(low[:len(low) - step], low[step:])
        width += step
    places = (low[:n] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    owner = np.repeat(np.arange(len(symbols.sizes)), symbols.sizes)
    inside = np.flatnonzero(owner[:n] == owner[cfg.window - 1:])
    places = places[inside]
    head = np.ones(len(places), bool)
    head[1:] = places[1:] != places[:-1]
    first = np.flatnonzero(head)
    last = np.append(first[1:], len(places)) - 1 if len(places) else first
    at = places[head]
    return at, grams[at], inside[first], inside[last]


_SCHEMA = (
    "_chunk long, _rid long, _text binary, _bucket int, _numbers binary, _times binary, _count long"
)
_NAMES = [f.split()[0] for f in _SCHEMA.split(", ")]
_KINDS = (pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.int64())


def _chunked(df: DataFrame, keep: list[str], text: str, buckets: int, cfg: RouteConfig) -> DataFrame:
    """Texts in chunks with a number each, and each chunk's counts of anchors."""
    rows = df.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], utf8(F.col(text)).alias("_raw"))
    inner = [f"k{i}" for i in range(len(keep))]

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, count = TaskContext.get().partitionId() << 33, 0
        for part in parts:
            for chunk, texts in in_chunks(part, "_raw", cfg.chunk):
                _, hashes, _, _ = anchors(Symbols(texts, cfg.words), cfg)
                keys, back = _chunk_numbers(hashes, buckets)
                times, own = np.bincount(back, minlength=len(keys)).astype(np.uint32), _filled(keys)
                n, m, number = len(texts), len(own), base + count
                count += n
                low = (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                values = (
                    [number] * (n + m), [*range(number, number + n), *[None] * m], [*texts, *[None] * m],
                    [*[None] * n, *[k for k, _, _ in own]],
                    [*[None] * n, *[_pack(low[a:b]) for _, a, b in own]],
                    [*[None] * n, *[pa.compress(times[a:b].tobytes(), codec="zstd", asbytes=True) for _, a, b in own]],
                    [*[None] * n, *[int(b - a) for _, a, b in own]],
                )
                take = pa.array([*range(n), *[None] * m], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*[chunk.column(c).take(take) for c in inner], *[pa.array(v, k) for v, k in zip(values, _KINDS)]],
                    names=[*inner, *_NAMES],
                )

    fields = [f"{k} {df.schema[c].dataType.simpleString()}" for k, c in zip(inner, keep)]
    return stored(rows.mapInArrow(cut, ", ".join([*fields, _SCHEMA])), "chunks")


def _occurrences(rows: pd.DataFrame) -> pd.DataFrame:
    """For each chunk of a bucket, how often each of its anchors occurs in all chunks."""
    sizes = rows["_count"].astype(int).tolist()
    numbers = [_unpack(blob, n) for blob, n in zip(rows["_numbers"], sizes)]
    times = [
        np.frombuffer(pa.decompress(blob, decompressed_size=4 * n, codec="zstd", asbytes=True), np.uint32)
        for blob, n in zip(rows["_times"], sizes)
    ]
    _, back = np.unique(np.concatenate(numbers), return_inverse=True)
    total = np.minimum(np.bincount(back, np.concatenate(times)), 2**32 - 1).astype(np.uint32)[back]
    ends = np.cumsum(sizes)
    return pd.DataFrame({
        "_chunk": rows["_chunk"], "_bucket": rows["_bucket"],
        "_found": [
            pa.compress(total[e - n:e].tobytes(), codec="zstd", asbytes=True) for e, n in zip(ends, sizes)
        ],
    })


def arithmetic_runs(places: list[tuple[int, int]]) -> bytes:
    """Rows (text, first, stride, number) for sorted (text, place), as few as strides allow, as bytes.

    A text that repeats itself has its stretches at equal distances, so it takes few rows.
    """
    if len(places) < 8:
        return struct.pack(f"={4 * len(places)}q", *(x for text, at in places for x in (text, at, 0, 1)))
    text, at = np.array(places, np.int64).T
    step = np.append(np.where(text[1:] == text[:-1], np.diff(at), 0), 0)  # to the next place; 0: none
    changes = np.append(np.flatnonzero(step[1:] != step[:-1]) + 1, len(step)).tolist()
    out, i, k = [], 0, 0
    while i < len(at):
        while changes[k] <= i:
            k += 1
        last = changes[k] if step[i] else i  # steps from here up to the change are alike
        out.append((text[i], at[i], step[i], last - i + 1))
        i = last + 1
    return np.array(out, np.int64).tobytes()


def _stretches(buckets: int, cfg: RouteConfig):
    """Different stretches of a chunk whose anchor occurs again, with how often and where they are."""

    def cut(docs: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        rids, texts = unpacked_texts(docs)
        symbols = Symbols(texts, cfg.words)
        at, hashes, first, last = anchors(symbols, cfg)
        out: dict[tuple[int, bytes], list[tuple[int, int]]] = {}
        if len(at):
            keys, back = _chunk_numbers(hashes, buckets)
            times, lie = np.ones(len(keys), np.uint32), {k: (a, b) for k, a, b in _filled(keys)}
            for bucket, blob in zip(found["_bucket"], found["_found"]):
                a, b = lie[bucket]
                times[a:b] = np.frombuffer(
                    pa.decompress(blob, decompressed_size=4 * int(b - a), codec="zstd", asbytes=True), np.uint32
                )
            times = times[back]
            text = np.searchsorted(symbols.starts, at, side="right") - 1
            for i in np.flatnonzero(times > 1).tolist():
                start, rid = int(symbols.starts[text[i]]), int(rids[text[i]])
                if times[i] < cfg.hot:
                    content = symbols.content(first[i], last[i] + cfg.window)
                    out.setdefault((int(hashes[i]), content), []).append((rid, int(first[i]) - start))
                else:
                    for s in range(first[i], last[i] + 1):
                        content = symbols.content(s, s + cfg.window)
                        key = xxhash.xxh3_64_intdigest(content)
                        out.setdefault((key, content), []).append((rid, s - start))
        chunk = int(docs["_chunk"].iloc[0])
        return pd.DataFrame([
            (chunk, key - (1 << 63), len(where), content, arithmetic_runs(where)) for (key, content), where in out.items()
        ], columns=["_chunk", "key", "n", "content", "places"])

    return cut


Finder = Callable[[list[bytes], np.ndarray], list[list[tuple[int, int]]]]


def _spread(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The intervals of each text from the places of stretches and the intervals in them, joined where they meet."""

    def flat(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
        blobs = column.to_pylist()
        return np.frombuffer(b"".join(blobs), np.int64).reshape(-1, width), np.array([len(b) for b in blobs]) // (8 * width)

    for part in parts:
        runs, n_runs = flat(part.column("places"), 4)
        spans, n_spans = flat(part.column("spans"), 2)
        # Every run of a stretch with every interval in it.
        stretch = np.repeat(np.arange(part.num_rows), n_runs)
        times = n_spans[stretch]
        run = np.repeat(np.arange(len(runs)), times)
        nth = np.arange(len(run)) - np.repeat(np.cumsum(times) - times, times)
        a, b = spans[(np.cumsum(n_spans) - n_spans)[stretch[run]] + nth].T
        chunk = part.column("_chunk").to_numpy()[stretch[run]]
        rid, first, stride, n = runs[run].T
        near = stride <= b - a  # the run's intervals meet
        rows = [np.column_stack([rid, first + a, first + b + (n - 1) * stride])[near]]
        for i in np.flatnonzero(~near).tolist():
            starts = first[i] + np.arange(n[i]) * stride[i]
            rows.append(np.column_stack([np.full(len(starts), rid[i]), starts + a[i], starts + b[i]]))
        every = np.concatenate(rows)
        out = joined(every[np.lexsort((every[:, 1], every[:, 0]))])
        texts, at = np.unique(rid, return_index=True)  # a text is of one chunk
        of = chunk[at][np.searchsorted(texts, out[:, 0])] if len(out) else out[:, 0]
        yield pa.RecordBatch.from_arrays([pa.array(of), *[pa.array(c) for c in out.T]], names=["_chunk", "_rid", "a", "b"])


def _whole_chunks(docs: DataFrame, inner: list[str]) -> DataFrame:
    """_chunk, rows: the rows of a chunk with what is kept of them, compressed together, to be moved cheaply."""

    def pack(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for part in parts:
            chunks = part.column("_chunk").to_numpy()
            heads = np.flatnonzero(np.diff(chunks, prepend=-1) != 0).tolist()
            blobs = []
            for a, b in zip(heads, [*heads[1:], len(chunks)]):
                sink = pa.BufferOutputStream()
                rows = part.slice(a, b - a).select([*inner, "_rid", "_text"])
                with pa.ipc.new_stream(sink, rows.schema, options=options) as out:
                    out.write_batch(rows)
                blobs.append(sink.getvalue().to_pybytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(chunks[heads]), pa.array(blobs, pa.binary())], names=["_chunk", "rows"]
            )

    return docs.select("_chunk", *inner, "_rid", "_text").mapInArrow(pack, "_chunk long, rows binary")


def _with_spans(packed: pa.Table, spans: pa.Table) -> pa.Table:
    """The rows of a chunk, each with the intervals of its text."""
    rows = pa.concat_tables([pa.ipc.open_stream(blob).read_all() for blob in packed.column("rows").to_pylist()])
    own = np.column_stack([spans.column(c).to_numpy() for c in ("_rid", "a", "b")]).astype(np.int64)
    own = joined(own[np.lexsort((own[:, 1], own[:, 0]))])
    rids = rows.column("_rid").to_numpy()
    low, high = (np.searchsorted(own[:, 0], rids, side=side) for side in ("left", "right"))
    n = high - low
    take = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
    pairs = pa.StructArray.from_arrays([pa.array(own[take, 1]), pa.array(own[take, 2])], names=["a", "b"])
    lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)), pa.int32()), pairs)
    return rows.drop_columns(["_rid"]).append_column("_spans", lists)


def joined(rows: np.ndarray) -> np.ndarray:
    """Rows (text, start, end), sorted by text and start, with those that touch or overlap as one."""
    if not len(rows):
        return rows
    # The furthest end so far within each text.
    far = np.maximum.accumulate(rows[:, 2] + (np.cumsum(np.diff(rows[:, 0], prepend=rows[0, 0]) != 0) << 40))
    head = np.ones(len(rows), bool)
    head[1:] = (rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] > far[:-1] & ((1 << 40) - 1))
    last = np.append(np.flatnonzero(head)[1:], len(rows)) - 1
    return np.column_stack([rows[head, 0], rows[head, 1], far[last] & ((1 << 40) - 1)])


def repeated_intervals(df: DataFrame, keep: list[str], text: str, cfg: RouteConfig, finder: Finder) -> DataFrame:
    """The `keep` columns (as k0, k1, ...), `_text` and `_spans` of every row.

    `finder` gets the different stretches of a shard and how often each occurs, and gives for
    each the intervals (start, end) of symbols that windows which occur again cover. A shard
    gets a stretch once, however many texts hold it; what was found goes back to its places.
    `_spans` holds the intervals of a text.
    """
    buckets = buckets_for(df, text)
    table = _chunked(df, keep, text, buckets, cfg)
    docs = table.filter("_bucket IS NULL")
    found = table.filter("_bucket IS NOT NULL").select("_chunk", "_bucket", "_numbers", "_times", "_count").groupBy(
        "_bucket"
    ).applyInPandas(_occurrences, "_chunk long, _bucket int, _found binary")
    stretches = stored(
        packed_texts(docs).groupBy("_chunk").cogroup(found.groupBy("_chunk")).applyInPandas(
            _stretches(buckets, cfg),
            "_chunk long, key long, n long, content binary, places binary",
        ), "stretches",
    )
    size = stretches.agg(F.sum(F.octet_length("content"))).first()[0] or 0
    shards = max(1, size // (cfg.shard * (6 if cfg.words else 1)))

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("content")
        contents = [bytes(c) for c in rows["content"]]
        spans = finder(contents, rows["n"].to_numpy())
        return pd.DataFrame([
            (key, name, np.array(own, np.int64).tobytes()) for key, name, own in zip(rows["key"], rows["name"], spans) if own
        ], columns=["key", "name", "spans"])

    # A stretch is named by its anchor and a hash of its content.
    name, shard = F.xxhash64("content").alias("name"), F.pmod("key", F.lit(int(shards))).alias("shard")
    different = stretches.groupBy("key", "content").agg(F.sum("n").alias("n"))
    answers = different.select(shard, "key", name, "content", "n").groupBy("shard").applyInPandas(
        search, "key long, name long, spans binary"
    )
    spans = stretches.select("_chunk", "key", name, "places").join(answers, ["key", "name"]).select(
        "_chunk", "places", "spans"
    ).mapInArrow(_spread, "_chunk long, _rid long, a long, b long")
    inner = [f"k{i}" for i in range(len(keep))]
    fields = [f"{k} {df.schema[c].dataType.simpleString()}" for k, c in zip(inner, keep)]
    return _whole_chunks(docs, inner).groupBy("_chunk").cogroup(spans.groupBy("_chunk")).applyInArrow(
        _with_spans, ", ".join([*fields, "_text binary, _spans array<struct<a: long, b: long>>"])
    )


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Sorted intervals with those that touch or overlap joined."""
    out: list[tuple[int, int]] = []
    for span in spans or ():
        a, b = span["a"], span["b"]
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out
