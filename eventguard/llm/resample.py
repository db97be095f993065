"""Draws the documents that look most like a target set, by importance resampling.

Every document gets the sum of the log ratios of its hashed features in the target and in
the whole corpus, looked up in one array of gains, plus Gumbel noise made from its id, so the
highest scores are a draw without replacement in proportion to the importance weights.

Exact ranks come from parallel sorting by regular sampling. Each task's rows are sorted and
stored as a run; rows at regular distances in the runs give splitters, which cut every run
into slices; the slices of a segment meet in one task and are merged there; and the number
of rows in the segments before gives the ranks. Rows are ordered by score, id and place in
their run, so even rows that are equal are cut apart where they are many.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import floor, log

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from eventguard.llm.common import in_chunks, stored, utf8
from eventguard.llm.terms import terms

_RUN_BITS = 33  # of monotonically_increasing_id: the partition lies above, the row below
_LAST = 2**63 - 1


@dataclass(frozen=True)
class ResampleConfig:
    # Longest run of words that makes a feature.
    ngram: int = 1
    buckets: int = 10_000
    seed: int = 2024
    # Documents with fewer words are never drawn.
    least_words: int = 20
    # Documents drawn, in percent of those with enough words.
    percent: int = 10
    # Rows sampled for splitters, about; they come to the driver.
    samples: int = 100_000
    # Rows of a segment, about, and the most segments; beyond that, segments get larger.
    segment: int = 50_000
    segments: int = 10_000


class FeatureBuckets(dict):
    """Bucket of a feature, remembered; forgotten all at once when a million are known."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= 1_000_000:
            self.clear()
        found = self[feature] = zlib.crc32(feature) % self.buckets
        return found


def feature_buckets(words: list[bytes], known: FeatureBuckets, ngram: int) -> np.ndarray:
    """Buckets of all runs of 1 to `ngram` words."""
    runs = [words, *[
        [b" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] for k in range(2, ngram + 1)
    ]]
    n = sum(len(r) for r in runs)
    return np.fromiter((known[f] for run in runs for f in run), np.int64, n)


def bucket_counts(texts: DataFrame, text: str, cfg: ResampleConfig) -> np.ndarray:
    """How many features of all texts lie in each bucket; each task sends its sums only."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = FeatureBuckets(cfg.buckets), np.zeros(cfg.buckets, np.int64)
        for part in parts:
            for _, raws in in_chunks(part, "_raw"):
                for raw in raws:
                    found = feature_buckets(terms(raw), known, cfg.ngram)
                    total += np.bincount(found, minlength=cfg.buckets)
        filled = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(filled), pa.array(total[filled])], names=["bucket", "n"])

    sums = texts.select(utf8(F.col(text)).alias("_raw")).mapInArrow(count, "bucket long, n long")
    out = np.zeros(cfg.buckets, np.int64)
    for row in sums.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row a bucket
        out[row["bucket"]] = row["n"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the ratio of smoothed shares, target to source, per bucket."""
    n, s, t = len(source), int(source.sum()), int(target.sum())
    return np.array([
        floor(1000 * log(float(b + 1) * float(s + n) / (float(a + 1) * float(t + n))))
        for a, b in zip(source.tolist(), target.tolist())
    ], np.int64)


def gumbel(key: Column, seed: int) -> Column:
    """Noise in thousandths, from a hash of the seed and the id alone."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def weighted(docs: DataFrame, key: str, text: str, gains: np.ndarray, cfg: ResampleConfig) -> DataFrame:
    """id, n_words, n_features and weight of every row."""

    def weigh(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = FeatureBuckets(cfg.buckets)
        for part in parts:
            for chunk, raws in in_chunks(part, "_raw"):
                out = np.zeros((3, len(raws)), np.int64)
                for i, raw in enumerate(raws):
                    words = terms(raw)
                    found = feature_buckets(words, known, cfg.ngram)
                    out[:, i] = len(words), len(found), gains[found].sum()
                yield pa.RecordBatch.from_arrays(
                    [chunk.column("id"), *[pa.array(row) for row in out]],
                    names=["id", "n_words", "n_features", "weight"],
                )

    return docs.select(F.col(key).cast("long").alias("id"), utf8(F.col(text)).alias("_raw")).mapInArrow(
        weigh, "id long, n_words long, n_features long, weight long"
    )


def packed_order(score: np.ndarray, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Strings of 24 bytes that sort as score (highest first), id and place do."""
    key = np.empty((len(score), 3), ">u8")
    top = np.uint64(1 << 63)
    key[:, 0] = ~(score.astype(np.int64).view(np.uint64) ^ top)
    key[:, 1] = ids.astype(np.int64).view(np.uint64) ^ top
    key[:, 2] = at.astype(np.int64).view(np.uint64)
    return key.view("S24").reshape(-1)


_CARRIED = ["id", "n_words", "n_features", "weight", "score", "nulls"]


def _numbers(part: pa.RecordBatch, names: list[str]) -> list[np.ndarray]:
    return [part.column(name).to_numpy(zero_copy_only=False).astype(np.int64) for name in names]


def _in_order(part: pa.RecordBatch) -> np.ndarray:
    return packed_order(*_numbers(part, ["score", "id", "at"]))


def _splitters(runs: DataFrame, n: int, cfg: ResampleConfig) -> np.ndarray:
    """Keys that cut the sorted rows into segments, from rows at regular distances in the runs."""
    segments = min(cfg.segments, -(-n // cfg.segment))
    step = max(1, n // cfg.samples)
    run, place = F.shiftright("at", _RUN_BITS), F.col("at").bitwiseAND(F.lit((1 << _RUN_BITS) - 1))
    # A drawn first place, so that many short runs are sampled as well as few long ones.
    regular = F.pmod(place + F.xxhash64(run), F.lit(step)) == 0
    found = runs.filter(regular).select("score", "id", "at").toPandas()
    keys = np.sort(packed_order(*[found[c].to_numpy() for c in ("score", "id", "at")]))
    at = np.unique(len(keys) * np.arange(1, segments) // max(segments, 1))
    return np.unique(keys[at]) if len(keys) else keys


def ranked_runs(runs: DataFrame, take: int, n: int, cfg: ResampleConfig) -> DataFrame:
    """The rows of the first segments with their rank, null beyond `take`; and all others, null."""
    splitters = _splitters(runs, n, cfg)
    cuts = splitters.tobytes()

    def segments_of(part: pa.RecordBatch) -> np.ndarray:
        return np.searchsorted(np.frombuffer(cuts, "S24"), _in_order(part), side="right")

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(splitters) + 1, np.int64)
        for part in parts:
            total += np.bincount(segments_of(part), minlength=len(total))
        filled = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(filled), pa.array(total[filled])], names=["segment", "n"])

    sizes = np.zeros(len(splitters) + 1, np.int64)
    counted = runs.select("score", "id", "at").mapInArrow(count, "segment long, n long")
    for row in counted.groupBy("segment").agg(F.sum("n").alias("n")).collect():  # one row a segment
        sizes[row["segment"]] = row["n"]
    before = np.cumsum(sizes) - sizes
    needed = int(np.searchsorted(before, take))  # segments that begin within the draw

    def slices(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted slices of a run; those of one batch and segment travel as one row."""
        for part in parts:
            segment = segments_of(part)  # rises within a run
            table = np.stack(_numbers(part, [*_CARRIED, "at"]))
            heads = np.flatnonzero(np.diff(segment, prepend=-1))
            cut = [(int(segment[a]), table[:, a:b].tobytes())
                   for a, b in zip(heads, [*heads[1:], len(segment)]) if segment[a] < needed]
            yield pa.RecordBatch.from_arrays([
                pa.array([s for s, _ in cut], pa.int64()), pa.array([blob for _, blob in cut], pa.binary()),
            ], names=["segment", "slice"])

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        width = len(_CARRIED) + 1
        table = np.concatenate([np.frombuffer(s, np.int64).reshape(width, -1) for s in rows["slice"]], axis=1)
        found = pd.DataFrame(dict(zip(_CARRIED, table)))
        # A stable sort merges the sorted slices that lie behind each other.
        order = np.argsort(packed_order(table[4], table[0], table[-1]), kind="stable")
        rank = int(before[rows["segment"].iloc[0]]) + 1 + np.arange(len(order))
        found = found.iloc[order]
        found["rank"] = pd.array(np.where(rank <= take, rank, 0), "Int64")
        return found

    fields = ", ".join(f"{c} long" for c in [*_CARRIED, "rank"])
    none = F.lit(None).cast("long").alias("rank")
    if not needed:
        return runs.select(*_CARRIED, none)
    head, rest = runs, None
    if needed <= len(splitters):
        score, first, at = _unpacked(splitters[needed - 1])
        behind = (F.col("score") < score) | (F.col("score") == score) & (
            (F.col("id") > first) | (F.col("id") == first) & (F.col("at") >= at)
        )
        head, rest = runs.filter(~behind), runs.filter(behind).select(*_CARRIED, none)
    merged = head.mapInArrow(slices, "segment long, slice binary").groupBy("segment").applyInPandas(merge, fields)
    merged = merged.withColumn("rank", F.when(F.col("rank") > 0, F.col("rank")))
    return merged if rest is None else merged.unionByName(rest)


def _unpacked(key: bytes) -> tuple[int, int, int]:
    """Score, id and place of a key of packed_order."""
    score, ident, at = np.frombuffer(bytes(key).ljust(24, b"\0"), ">u8").astype(np.uint64)
    top = np.uint64(1 << 63)
    return int((~score ^ top).view(np.int64)), int((ident ^ top).view(np.int64)), int(at)


def resample(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text",
    target_text: str = "text", cfg: ResampleConfig = ResampleConfig(),
) -> DataFrame:
    """The key of every row, n_features, weight, score, rank (null: not drawn) and n_words.

    Features are runs of 1 to `ngram` words, repeats counted. Of the rows with `least_words`
    words or more, `percent` in a hundred (floor) with the highest scores are drawn; equal
    scores go by the key, lowest first, a null key last, and rows equal in both get different
    ranks in no stated order. A null or empty text has no features and weight 0; a row
    without key takes its noise from the empty id. Keys are integers. With an empty target
    or corpus the counts are 0, and the gains follow from the smoothing alone. Other columns
    of either table play no part.
    """
    source = bucket_counts(docs, text, cfg)
    gains = bucket_gains(source, bucket_counts(target, target_text, cfg))
    rows = weighted(docs, key, text, gains, cfg)
    rows = rows.select(
        F.coalesce("id", F.lit(_LAST)).alias("id"), "n_words", "n_features", "weight",
        (F.col("weight") + gumbel(F.col("id"), cfg.seed)).alias("score"),
        F.col("id").isNull().cast("long").alias("nulls"),
        (F.col("n_words") >= cfg.least_words).alias("enough"),
    )
    runs = stored(
        rows.sortWithinPartitions(F.desc("enough"), F.desc("score"), "id")
        .withColumn("at", F.monotonically_increasing_id()), "runs",
    )
    able = runs.filter("enough")
    n = able.count()
    found = ranked_runs(able, n * cfg.percent // 100, n, cfg).unionByName(
        runs.filter("NOT enough").select(*_CARRIED, F.lit(None).cast("long").alias("rank"))
    )
    return found.select(
        F.when(F.col("nulls") == 0, F.col("id")).alias(key), "n_features", "weight", "score", "rank", "n_words"
    )
