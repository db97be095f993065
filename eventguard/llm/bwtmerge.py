"""Repeated byte strings by merging Burrows-Wheeler transforms.

The stretches of a shard are dealt to a few parts, and each part's suffixes are sorted into
its transform. The transforms are then merged by refining how their rows interleave: the
rows of all parts start in one bucket, and each round deals the rows of a bucket by the
symbols in front of them, each part's rows staying in their order. A bucket of depth d holds
the suffixes with equal first d symbols, so the round in which a row is left alone in its
bucket gives its longest common prefix with any other row. Rows left alone stay alone and
take no part in later rounds, nor do rows too near the start of their stretch for a string
of the length sought; no suffix of one part is compared with one of another.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from eventguard.llm.common import beside
from eventguard.llm.fmindex import suffix_order
from eventguard.llm.routing import RouteConfig, merged, repeated_intervals


@dataclass(frozen=True)
class ByteConfig:
    length: int = 200
    gram: int = 32
    # Transforms that are merged in a shard.
    parts: int = 4

    @property
    def route(self) -> RouteConfig:
        return RouteConfig(self.length, self.gram, words=False)


@dataclass(frozen=True)
class Transform:
    """Rows of sorted suffixes: the byte in front (any, where a stretch begins), the row of the
    suffix that begins with it, and where in the stretches the row's own suffix begins."""

    front: np.ndarray
    previous: np.ndarray
    stretch: np.ndarray
    place: np.ndarray


def transform(stretches: list[bytes], numbers: list[int], length: int) -> Transform:
    """The transform of some stretches, known outside by `numbers`; sorted by `length` bytes."""
    n = len(stretches)
    sizes = np.array([len(s) for s in stretches], np.int64)
    ends = np.cumsum(sizes + 1) - 1
    flat = np.zeros(int(sizes.sum()) + n, np.int64)  # an end is 0, below all bytes
    inside = np.ones(len(flat), bool)
    inside[ends] = False
    flat[inside] = np.frombuffer(b"".join(stretches), np.uint8).astype(np.int64) + 1
    # The first seven symbols in one number; behind an end nothing counts.
    packed = flat
    for k in range(1, 7):
        packed = (flat << (9 * k)) | np.where(flat > 0, np.append(packed[1:], 0), 0)
    order = suffix_order(packed, length, 7)
    row = np.empty(len(order), np.int32)
    row[order] = np.arange(len(order), dtype=np.int32)
    owner = np.repeat(np.arange(n), sizes + 1)
    front = np.maximum(flat[order - 1] - 1, 0).astype(np.uint8)
    return Transform(
        front, row[order - 1], np.array(numbers, np.int64)[owner[order]], order - (ends - sizes)[owner[order]]
    )


def common_prefixes(parts: list[Transform], most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretch, place and longest common prefix with another suffix, up to `most`, of suffixes.

    In each round a row moves to the suffix two symbols longer (one in the first round if
    `most` is odd), so only rows that start with `most` symbols of their stretch in front of
    them get far enough; the others stay at 0. Prefixes are known to the length of a round.
    """
    offsets = np.cumsum([0, *[len(p.front) for p in parts]])
    front = np.concatenate([p.front for p in parts]).astype(np.uint16)
    previous = np.concatenate([p.previous + np.int32(at) for p, at in zip(parts, offsets)])
    stretch, place = np.concatenate([p.stretch for p in parts]), np.concatenate([p.place for p in parts])
    steps = {1: (front, previous), 2: (front[previous] << np.uint16(8) | front, previous[previous])}
    common = np.zeros(len(front), np.int32)
    # The interleave: rows in the order of what is known of them, and where buckets begin.
    rows = np.flatnonzero(place >= most).astype(np.int32)
    begins = np.zeros(len(rows), bool)
    begins[:1] = True
    depth = 0
    while depth < most and len(rows):
        step = 1 + (most - depth + 1) % 2
        symbols, target = steps[step]
        symbol = symbols[rows]
        bucket = np.cumsum(begins, dtype=np.int32)
        deal = np.argsort(symbol, kind="stable")
        symbol, bucket = symbol[deal], bucket[deal]
        begins = np.ones(len(rows), bool)
        begins[1:] = (symbol[1:] != symbol[:-1]) | (bucket[1:] != bucket[:-1])
        alone = begins.copy()
        alone[:-1] &= begins[1:]
        rows, begins = target[rows[deal[~alone]]], begins[~alone]
        depth += step
        common[rows] = depth
    return stretch, place, common


def repeated_strings(contents: list[bytes], counts: np.ndarray, cfg: ByteConfig) -> list[list[tuple[int, int]]]:
    """Intervals of each stretch that strings occurring again cover. A repeated stretch is covered whole."""
    # Like stretches follow each other, so dealing in turn parts them.
    parts = [
        transform(contents[k::cfg.parts], list(range(k, len(contents), cfg.parts)), cfg.length)
        for k in range(min(cfg.parts, len(contents)))
    ]
    found: list[list[tuple[int, int]]] = [[] for _ in contents]
    if parts:
        stretch, place, common = common_prefixes(parts, cfg.length)
        hit = np.flatnonzero(common >= cfg.length)
        hit = hit[np.lexsort((place[hit], stretch[hit]))]
        # Starts that follow each other make one interval.
        s, p = stretch[hit], place[hit]
        head = np.ones(len(hit), bool)
        head[1:] = (s[1:] != s[:-1]) | (p[1:] > p[:-1] + cfg.length)
        last = np.append(np.flatnonzero(head)[1:], len(hit)) - 1 if len(hit) else np.zeros(0, np.int64)
        for k, a, b in zip(s[head].tolist(), p[head].tolist(), p[last].tolist()):
            found[k].append((a, b + cfg.length))
    return [
        [(0, len(content))] if n > 1 else own for content, n, own in zip(contents, counts.tolist(), found)
    ]


def remove_repeated_bytes(
    df: DataFrame, keep: list[str], text: str = "text", cfg: ByteConfig = ByteConfig()
) -> DataFrame:
    """The `keep` columns of each row, n_bytes, n_removed, n_spans, `kept` and kept_sha256.

    A byte goes if a string of `length` bytes that covers it starts more than once, counting
    the same text. A null text counts as empty. Rows that are equal are repeats of each other.
    A kept column that is called like a result gives way to it.
    """
    keep = beside(keep, "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256")
    found = repeated_intervals(df, keep, text, cfg.route, lambda c, n: repeated_strings(c, n, cfg))
    fields = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, int, bytes, str]] = []
            for raw, spans in zip(batch.column("_text").to_pylist(), batch.column("_spans").to_pylist()):
                gone, at, kept = merged(spans), 0, []
                for a, b in gone:
                    kept.append(raw[at:a])
                    at = b
                rest = b"".join([*kept, raw[at:]])
                out.append((len(raw), len(raw) - len(rest), len(gone), rest, hashlib.sha256(rest).hexdigest()))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string())
            yield pa.RecordBatch.from_arrays([
                *batch.columns[:len(keep)], *[pa.array([o[k] for o in out], kind) for k, kind in enumerate(kinds)],
            ], names=[*keep, "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    return found.mapInArrow(cut, ", ".join([
        *fields, "n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string",
    ]))
