"""Exact top-k search by inner product as a Voronoi join.

With a further component that makes all data vectors equally long, the largest inner
products belong to the smallest Euclidean distances, so triangle inequalities hold. Data and
queries are dealt to the cells of the same pivots. A summary per cell (its farthest query,
its k + 1 nearest data vectors' distances) gives each cell of queries a distance within which
all of them have k neighbours; a data vector is sent to a group of cells only if it can lie
that near to one of their queries. Groups are solved apart, block against block, and the
best k of a query's blocks are the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from eventguard.llm.common import stored

_ITEM = {"tinyint": np.int8, "smallint": np.int16, "int": np.int32, "double": np.float64}


@dataclass(frozen=True)
class KnnConfig:
    k: int = 20
    # Components are multiplied by this and floored.
    scale: float = 64.0
    # Cells, and groups of cells that are solved together.
    pivots: int = 64
    groups: int = 8
    # Rows from which pivots are drawn; they come to the driver.
    sample: int = 4096
    # Most queries and data vectors, about, that one task holds.
    queries: int = 100_000
    data: int = 200_000
    # Data vectors and queries multiplied with each other at a time.
    block: int = 2048
    asked: int = 2048


@dataclass(frozen=True)
class Shape:
    """Width and number of the vectors, the largest square sum, how a component is stored."""

    width: int
    rows: int
    square: float
    kind: str

    @property
    def exact(self) -> type:
        """Whole numbers are exact in single precision up to 2^24, in double up to 2^53."""
        return np.float32 if self.kind == "tinyint" and self.width * 128 * 128 < 2**24 else np.float64

    def rows_of(self, blobs: list[bytes]) -> np.ndarray:
        """Vectors as rows of doubles, shorter ones filled up with zeros."""
        out = np.zeros((len(blobs), self.width))
        for row, blob in zip(out, blobs):
            own = np.frombuffer(blob, _ITEM[self.kind])
            row[:len(own)] = own
        return out


def scaled(df: DataFrame, key: str, vector: str, query: Column, cfg: KnnConfig) -> DataFrame:
    """id, is_query, v: the scaled vectors without those that are null or hold a bad component."""
    rows = df.select(
        F.col(key).cast("long").alias("id"), F.coalesce(query, F.lit(False)).alias("is_query"),
        F.col(vector).cast("array<double>").alias("v"),
    )
    big = F.lit(float("inf"))
    fine = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < big), F.lit(False)))
    return rows.filter(F.col("v").isNotNull() & fine).withColumn(
        "v", F.transform("v", lambda x: F.floor(x * cfg.scale).cast("double"))
    )


def _packed(rows: DataFrame) -> tuple[DataFrame, Shape]:
    """The vectors as bytes, in the smallest kind of number that holds all components."""
    largest = F.array_max(F.transform("v", F.abs))
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    found = rows.agg(F.max(F.size("v")), F.count("*"), F.max(squares), F.max(largest)).first()
    width, n, square, top = (v or 0 for v in found)
    kind = next((k for k, most in (("tinyint", 127), ("smallint", 32767), ("int", 2**31 - 1)) if top <= most), "double")

    def pack(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            column = part.column("v")
            flat, at = column.flatten().to_numpy(zero_copy_only=False).astype(_ITEM[kind]), column.offsets.to_numpy()
            at = at - at[0]
            blobs = [flat[a:b].tobytes() for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("is_query"), pa.array(blobs, pa.binary())],
                names=["id", "is_query", "v"],
            )

    packed = stored(rows.mapInArrow(pack, "id long, is_query boolean, v binary"), "vectors")
    # Every row is data; a query is asked once, however often its row is repeated.
    queries = packed.filter("is_query").select("id", "v").distinct().withColumn("ask", F.lit(True))
    data = packed.select("id", "v", F.lit(False).alias("ask"))
    return data.unionByName(queries), Shape(int(width), int(n), float(square), kind)


def pivots_of(vectors: DataFrame, shape: Shape, cfg: KnnConfig) -> np.ndarray:
    """Vectors far from each other among a sample of different ones drawn by hash."""
    vectors = vectors.filter("NOT ask").select("v")
    drawn = vectors.filter(
        F.pmod(F.xxhash64("v"), F.lit(max(1, shape.rows // cfg.sample))) == 0
    ).distinct().orderBy(F.xxhash64("v")).limit(cfg.sample)
    points = lifted(shape.rows_of([bytes(r["v"]) for r in drawn.collect()]), shape)
    if not len(points):
        points = lifted(shape.rows_of([bytes(r["v"]) for r in vectors.limit(cfg.pivots).collect()]), shape)
    chosen = [0] if len(points) else []
    nearest = ((points - points[:1]) ** 2).sum(axis=1)
    while 0 < len(chosen) < min(cfg.pivots, len(points)) and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    return points[chosen]


def lifted(points: np.ndarray, shape: Shape) -> np.ndarray:
    """Data vectors with the component that gives all of them the largest length."""
    rest = np.sqrt(np.maximum(shape.square - (points ** 2).sum(axis=1), 0))
    return np.column_stack([points, rest])


def raised(points: np.ndarray) -> np.ndarray:
    """Queries with a component of 0, so that their inner products stay the same."""
    return np.column_stack([points, np.zeros(len(points))])


def distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (points ** 2).sum(axis=1)[:, None] + (pivots ** 2).sum(axis=1) - 2 * points @ pivots.T
    return np.sqrt(np.maximum(square, 0))


@dataclass(frozen=True)
class Plan:
    """Which cells of queries form a group, and how far data may lie from each cell's pivot."""

    pivots: np.ndarray
    group: np.ndarray
    reach: np.ndarray
    slices: np.ndarray


def _summaries(vectors: DataFrame, pivots: np.ndarray, shape: Shape, cfg: KnnConfig) -> tuple:
    """Per cell: queries, their largest distance, and the distances of the nearest data vectors."""

    def measure(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            points, ask = shape.rows_of(part.column("v").to_pylist()), np.array(part.column("ask"), bool)
            kinds = ((False, lifted(points[~ask], shape)), (True, raised(points[ask])))
            for is_query, own in kinds:
                far = distances(own, pivots)
                cell = far.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([
                    pa.array(cell, pa.int32()), pa.array(far[np.arange(len(cell)), cell]),
                    pa.array([is_query] * len(cell), pa.bool_()),
                ], names=["cell", "d", "ask"])

    found = vectors.select("ask", "v").mapInArrow(measure, "cell int, d double, ask boolean")
    asked = found.filter("ask").groupBy("cell").agg(F.count("*").alias("n"), F.max("d").alias("far")).collect()
    place = F.row_number().over(Window.partitionBy("cell").orderBy("d"))
    near = found.filter("NOT ask").withColumn("place", place).filter(F.col("place") <= cfg.k + 1)
    return asked, near.select("cell", "d").collect()  # k + 1 distances a cell


def plan(vectors: DataFrame, shape: Shape, cfg: KnnConfig) -> Plan:
    pivots = pivots_of(vectors, shape, cfg)
    asked, near = _summaries(vectors, pivots, shape, cfg)
    n, far = np.zeros(len(pivots), np.int64), np.zeros(len(pivots))
    for row in asked:
        n[row["cell"]], far[row["cell"]] = row["n"], row["far"]
    between = distances(pivots, pivots)
    cells, gaps = np.array([r["cell"] for r in near], np.int64), np.array([r["d"] for r in near])
    reach = np.full(len(pivots), -np.inf)
    for i in np.flatnonzero(n):
        # k + 1 data vectors, one of which may be the query's own, lie within this distance.
        bound = np.sort(far[i] + between[i, cells] + gaps)
        within = bound[cfg.k] if len(bound) > cfg.k else np.inf
        # Distances are off by no more than this share of the vectors' length.
        reach[i] = within + far[i] + 1e-6 * (1 + np.sqrt(shape.square))
    # Groups of like size: the cell with most queries opens one, the others join the smallest.
    group, size = np.full(len(pivots), -1), np.zeros(min(cfg.groups, max(1, (n > 0).sum())), np.int64)
    for i in np.argsort(-n, kind="stable"):
        if n[i]:
            group[i] = size.argmin()
            size[group[i]] += n[i]
    return Plan(pivots, group, reach, np.maximum(1, -(-size // cfg.queries)))


def _sent(vectors: DataFrame, plan: Plan, shape: Shape, parts_of_data: int) -> DataFrame:
    """Blocks of queries and of the data each group needs; a task's key is group, slice, part.

    Every slice of a group's queries meets every part of its data.
    """

    def send(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        turn = TaskContext.get().partitionId()
        for part in parts:
            ids, blobs = part.column("id").to_numpy(zero_copy_only=False), part.column("v").to_pylist()
            points, mask = shape.rows_of(blobs), np.array(part.column("ask"), bool)
            ask, data = np.flatnonzero(mask), np.flatnonzero(~mask)
            rows = []

            def add(key: tuple[int, int, int], is_query: bool, which: np.ndarray) -> None:
                body = pa.compress(
                    points[which].astype(_ITEM[shape.kind]).tobytes(), codec="zstd", asbytes=True
                )
                rows.append((*key, is_query, len(which), ids[which].tobytes(), body))

            group = plan.group[distances(raised(points[ask]), plan.pivots).argmin(axis=1)]
            for g in np.unique(group):
                own = ask[group == g]
                for j in range(parts_of_data):
                    add((int(g), turn % int(plan.slices[g]), j), True, own)
            near = distances(lifted(points[data], shape), plan.pivots) <= plan.reach
            for g in np.unique(plan.group[plan.group >= 0]):
                own = data[near[:, plan.group == g].any(axis=1)]
                for s in range(int(plan.slices[g]) if len(own) else 0):
                    add((int(g), s, turn % parts_of_data), False, own)
            turn += 1
            yield pa.RecordBatch.from_arrays([
                pa.array([r[k] for r in rows], kind) for k, kind in enumerate((
                    pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.binary(), pa.binary()
                ))
            ], names=["g", "s", "j", "ask", "n", "ids", "body"])

    return vectors.mapInArrow(send, "g int, s int, j int, ask boolean, n long, ids binary, body binary")


def _best_in_block(table: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of each row's k largest entries above its floor; of equal ones the first."""
    if table.shape[1] <= k:
        return np.nonzero(table > floor[:, None])
    least = np.partition(table, -k, axis=1)[:, -k][:, None]
    above, level = table > least, table == least
    level &= level.cumsum(axis=1, dtype=np.int32) <= k - above.sum(axis=1)[:, None]
    return np.nonzero((above | level) & (table > floor[:, None]))


def best_of(
    asked: np.ndarray, queries: np.ndarray, ids: np.ndarray, data: np.ndarray, cfg: KnnConfig
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row of the query, id and score of the k best data vectors of every query, its own left out.

    Equal scores go by the smaller id. `ids` rise, so a later block of data enters only with
    higher scores than the k-th so far.
    """
    rows, found, scores = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    floor = np.full(len(queries), -np.inf)
    for start in range(0, len(ids), cfg.block):
        own = ids[start:start + cfg.block]
        table = queries @ data[start:start + cfg.block].T
        low, high = np.searchsorted(own, asked, "left"), np.searchsorted(own, asked, "right")
        mine = np.repeat(np.arange(len(asked)), high - low)
        ends = np.cumsum(high - low)
        table[mine, np.arange(len(mine)) - np.repeat(ends - high, high - low)] = -np.inf
        better = np.flatnonzero(table.max(axis=1) > floor)
        if not len(better):
            continue
        r, c = _best_in_block(table[better], floor[better], cfg.k)
        rows, found = np.concatenate([rows, better[r]]), np.concatenate([found, own[c]])
        scores = np.concatenate([scores, table[better[r], c].astype(np.float64)])
        order = np.lexsort((found, -scores, rows))
        rows, found, scores = rows[order], found[order], scores[order]
        keep = np.arange(len(rows)) - np.searchsorted(rows, rows) < cfg.k
        rows, found, scores = rows[keep], found[keep], scores[keep]
        full = np.flatnonzero(np.bincount(rows, minlength=len(queries)) >= cfg.k)
        floor[full] = scores[np.searchsorted(rows, full, side="right") - 1]
    return rows, found, scores


def nearest(
    df: DataFrame, query: Column, key: str = "vec_id", vector: str = "embedding", cfg: KnnConfig = KnnConfig()
) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest inner products of every query row.

    Components are floor(scale * x). Queries are the rows for which `query` holds; all rows
    with another id are candidates. Equal scores go by the smaller id. Rows whose vector is
    null or has a null or non-finite component take no part, nor do rows with a null id;
    shorter vectors count as filled up with zeros; an empty vector scores 0 with all. Query
    rows that repeat an id with the same vector are one; with another vector both are
    answered, under the same id. Data rows that repeat an id count each. Keys are integers;
    other columns play no part. Scores are exact up to 2^53.
    """
    rows = scaled(df, key, vector, query, cfg).filter("id IS NOT NULL")
    vectors, shape = _packed(rows)
    found = plan(vectors, shape, cfg)
    parts = max(1, -(-shape.rows // cfg.data))

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        def joined(own: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
            ids = [np.frombuffer(b, np.int64) for b in own["ids"]]
            size = shape.width * np.dtype(_ITEM[shape.kind]).itemsize
            body = b"".join(
                pa.decompress(b, decompressed_size=n * size, codec="zstd", asbytes=True)
                for b, n in zip(own["body"], own["n"].tolist())
            )
            ids = np.concatenate([np.zeros(0, np.int64), *ids])
            return ids, np.frombuffer(body, _ITEM[shape.kind]).reshape(len(ids), shape.width)

        asked, queries = joined(rows[rows["ask"]])
        ids, data = joined(rows[~rows["ask"]])
        if not len(asked) or not len(ids):
            return pd.DataFrame({"query_id": [], "h": [], "vec_id": [], "score": []}).astype("int64")
        hashes = pd.util.hash_array(np.array([q.tobytes() for q in queries], object)).view(np.int64)
        exact, order = shape.exact, np.argsort(ids, kind="stable")
        ids, data = ids[order], data[order].astype(exact)
        out = []
        for at in range(0, len(asked), cfg.asked):
            some, own = asked[at:at + cfg.asked], queries[at:at + cfg.asked].astype(exact)
            row, vec, score = best_of(some, own, ids, data, cfg)
            out.append(pd.DataFrame({
                "query_id": some[row], "h": hashes[at:at + cfg.asked][row], "vec_id": vec,
                "score": score.astype(np.int64),
            }))
        return pd.concat(out)

    met = _sent(vectors, found, shape, parts).groupBy("g", "s", "j").applyInPandas(
        solve, "query_id long, h long, vec_id long, score long"
    )
    rank = F.row_number().over(Window.partitionBy("query_id", "h").orderBy(F.desc("score"), "vec_id"))
    return met.withColumn("rank", rank).filter(F.col("rank") <= cfg.k).select("query_id", "rank", "vec_id", "score")
