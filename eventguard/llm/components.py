"""Connected components of a link table by union-find in tasks and alternating stars.

Each task first contracts the links it reads to stars by union-find, so a component that one
task sees whole is done. What is left goes through rounds that point every node's larger
neighbours, then its smaller ones, at the smallest node it knows, contracted again after each
round, until all links form stars. Rounds are joins and minima with map-side combine; their
results are tables in the shared folder, so lineage stays short and nothing is collected.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eventguard.llm.common import stored

# Links contracted at a time in a task.
_HELD = 500_000


def roots(links: list[tuple]) -> dict:
    """The smallest node of its component for every node that is not the smallest."""
    parent: dict = {}

    def root(x):
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    for a, b in links:
        x, y = root(a), root(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
    return {x: root(x) for x in [n for link in links for n in link] if root(x) != x}


def _contracted(links: DataFrame) -> DataFrame:
    """Links (a, b) of the same components, as stars of what a task holds at a time."""
    kind = links.schema["a"].dataType.simpleString()

    def contract(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for part in parts:
            of = part.schema.field("a").type
            held += zip(part.column("a").to_pylist(), part.column("b").to_pylist())
            if len(held) >= _HELD:
                yield _stars(held, of)
                held = []
        if held:
            yield _stars(held, of)

    return links.select("a", "b").mapInArrow(contract, f"a {kind}, b {kind}")


def _stars(links: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    found = roots(links)
    sides = (found.keys(), found.values())
    return pa.RecordBatch.from_arrays([pa.array(list(side), kind) for side in sides], names=["a", "b"])


def _are_stars(links: DataFrame) -> bool:
    """Whether every node points once at most, and none that points is pointed at."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        links.select(F.col("b").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into"))
    ).groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return ends.filter((F.col("out") > 1) | ((F.col("out") > 0) & (F.col("into") > 0))).isEmpty()


def _smallest(links: DataFrame) -> DataFrame:
    return links.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    joined = both.join(_smallest(both), "a").filter("b > a")
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    # Links point from the larger node to the smaller one.
    joined = links.join(_smallest(links), "a")
    down = joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = joined.select("a", F.col("m").alias("b"))
    return down.unionByName(own).filter("a > b").distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """node, component: the smallest node reachable. Nodes without a link do not occur.

    Links are of one orderable type; null ends and links of a node to itself are ignored.
    """
    x, y = F.col(a), F.col(b)
    ends = links.filter(x.isNotNull() & y.isNotNull() & (x != y)).select(
        F.greatest(x, y).alias("a"), F.least(x, y).alias("b")
    )
    now = stored(_contracted(ends).distinct(), "links")
    while not _are_stars(now):
        now = stored(_contracted(_small_star(_large_star(now))).distinct(), "links")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
