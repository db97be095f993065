"""Ranked search: the best documents for each item, found without scoring all of them.

Documents are indexed in shards, in the order of their ids: a posting list per term, with
each posting's impact on the score, and over every list a sparse table that gives the highest
impact in any range. For an item, an interval of documents is bounded by the sum of the
highest impacts of the item's terms in it. The intervals with the highest bounds are taken
first; the document with the highest single impact is scored exactly and splits its interval
in two, whose bounds come from the sparse tables again. An interval whose bound lies below
the k-th score so far is left, so what is found is exact.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from eventguard.llm.common import in_chunks, stored, utf8
from eventguard.llm.terms import terms

_LAST = 2**63 - 1


@dataclass(frozen=True)
class SearchConfig:
    top: int = 20
    # Share of a document's length in its norm, in percent, and how soon repeats saturate, in tenths.
    length: int = 25
    saturation: int = 12
    # Different terms of the items that are searched in one pass over the documents, about.
    # They and the items come to the driver and go to all tasks.
    block_terms: int = 200_000
    # Postings and documents of a shard.
    postings: int = 1_000_000
    documents: int = 100_000
    # Most tasks that search; beyond that, a task gets several shards and keeps the best of all.
    tasks: int = 20_000
    # Most intervals split at a time.
    batch: int = 512


@dataclass(frozen=True)
class Items:
    """Some items: their ids and the numbers and repeats of their terms in `vocabulary`."""

    ids: list[int | None]
    counts: list[dict[int, int]]
    vocabulary: dict[bytes, int]


def _blocks(items: DataFrame, key: str, text: str, cfg: SearchConfig) -> Iterator[Items]:
    """Items read one by one, cut where their terms are many; one item is never cut."""
    block = Items([], [], {})
    for row in items.select(F.col(key).cast("long"), utf8(F.col(text))).toLocalIterator():
        own = Counter(terms(bytes(row[1])))
        if not own:
            continue
        numbers = {block.vocabulary.setdefault(t, len(block.vocabulary)): n for t, n in own.items()}
        block.ids.append(row[0])
        block.counts.append(numbers)
        if len(block.vocabulary) + sum(map(len, block.counts)) >= cfg.block_terms:
            yield block
            block = Items([], [], {})
    if block.ids:
        yield block


_INDEX = "n_docs long, n_terms long, ids binary, lengths binary, term binary, doc binary, tf binary"


def build_index(docs: DataFrame, key: str, text: str, vocabulary: dict[bytes, int], cfg: SearchConfig) -> DataFrame:
    """One row a shard: its documents with a term, and their postings of the vocabulary's terms.

    Postings lie by term, then by document; documents by id, a null id last.
    """

    def shard(rows: list[tuple[int, int, np.ndarray, np.ndarray]], n_docs: int, n_terms: int) -> pa.RecordBatch:
        rows = sorted(rows, key=lambda r: r[0])
        none = np.zeros(0, np.int32)
        doc = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r[2]) for r in rows])
        term, tf = (np.concatenate([none, *[r[k] for r in rows]]) for k in (2, 3))
        order = np.argsort(term, kind="stable")
        columns = [
            np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64),
            *[v[order].astype(np.int32) for v in (term, doc, tf)],
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array([n_docs]), pa.array([n_terms]), *[pa.array([c.tobytes()]) for c in columns]],
            names=[f.split()[0] for f in _INDEX.split(", ")],
        )

    def index(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.get
        rows, held, n_docs, n_terms = [], 0, 0, 0
        for part in parts:
            for chunk, raws in in_chunks(part, "_raw"):
                for ident, raw in zip(chunk.column("id").to_pylist(), raws):
                    words = terms(raw)
                    n_docs += bool(words)
                    n_terms += len(words)
                    found = [v for v in map(known, words) if v is not None]
                    if not found:
                        continue
                    numbers, tf = np.unique(np.array(found, np.int32), return_counts=True)
                    rows.append((ident, len(words), numbers, tf.astype(np.int32)))
                    held += len(numbers)
                    if held >= cfg.postings or len(rows) >= cfg.documents:
                        yield shard(rows, n_docs, n_terms)
                        rows, held, n_docs, n_terms = [], 0, 0, 0
        if n_docs:
            yield shard(rows, n_docs, n_terms)

    source = docs.select(
        F.coalesce(F.col(key).cast("long"), F.lit(_LAST)).alias("id"), utf8(F.col(text)).alias("_raw")
    )
    return stored(source.mapInArrow(index, _INDEX), "index")


def document_counts(index: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term; a task sends one row a term."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for part in parts:
            for blob in part.column("term").to_pylist():
                total += np.bincount(np.frombuffer(blob, np.int32), minlength=size)
        filled = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(filled), pa.array(total[filled])], names=["term", "n"])

    out = np.zeros(size, np.int64)
    found = index.select("term").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    for row in found.collect():  # one row a term of the block
        out[row["term"]] = row["n"]
    return out


class Shard:
    """Posting lists with their impacts and a sparse table of the places of range maxima."""

    def __init__(self, row: dict, docs: int, words: int, cfg: SearchConfig):
        self.ids = np.frombuffer(row["ids"], np.int64)
        term, self.doc, tf = (np.frombuffer(row[c], np.int32) for c in ("term", "doc", "tf"))
        lengths = np.frombuffer(row["lengths"], np.int64)
        norm = 100 - cfg.length + cfg.length * lengths * docs // max(words, 1)
        tf = tf.astype(np.int64)
        self.impact = 1_000_000_000 * tf // (1000 * tf + cfg.saturation * norm[self.doc])
        # A posting's list and document in one number, which rises along the postings.
        self.place = term.astype(np.int64) * len(self.ids) + self.doc
        heads = np.flatnonzero(np.diff(term, prepend=-1))
        self.lists = {
            t: (a, b) for t, a, b in zip(term[heads].tolist(), heads.tolist(), [*heads[1:].tolist(), len(term)])
        }
        longest = max((b - a for a, b in self.lists.values()), default=1)
        self.table = [np.arange(len(term), dtype=np.int32)]
        while 2 << (len(self.table) - 1) <= longest:
            step, last = 1 << (len(self.table) - 1), self.table[-1]
            left, right = last[:-step], last[step:]
            best = last.copy()
            best[:-step] = np.where(self.impact[left] >= self.impact[right], left, right)
            self.table.append(best)
        self.table = np.stack(self.table)
        self.level = np.zeros(longest + 1, np.int8)
        for n in range(2, longest + 1):
            self.level[n] = self.level[n >> 1] + 1

    def maxima(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Place of the highest impact in each range of postings; any place for an empty one."""
        level = self.level[high - low].astype(np.int64)
        last = len(self.impact) - 1
        a = self.table[level, np.minimum(low, last)]
        b = self.table[level, np.clip(high - (1 << level), 0, last)]
        return np.where(self.impact[a] >= self.impact[b], a, b)

    def search(self, numbers: np.ndarray, weights: np.ndarray, best: "Best", cfg: SearchConfig) -> None:
        """Enters the documents of this shard that belong to the best for some weighted terms."""
        lists = [self.lists.get(t) for t in numbers.tolist()]
        held = [i for i, own in enumerate(lists) if own and weights[i] > 0]
        if not held:
            return
        weights, first = weights[held], numbers[held].astype(np.int64) * len(self.ids)
        low = np.array([[lists[i][0] for i in held]])
        high = np.array([[lists[i][1] for i in held]])
        peak = self.maxima(low, high)
        value = weights * self.impact[peak]
        bound, begin = value.sum(axis=1), np.zeros(1, np.int64)
        batch = 8
        while True:
            alive = best.admits(bound, self.ids[begin])
            if not alive.all():
                low, high, peak, bound, begin = (v[alive] for v in (low, high, peak, bound, begin))
            if not len(bound):
                return
            taken = np.arange(len(bound))
            if len(bound) > batch:
                taken = np.argpartition(-bound, batch)[:batch]
            # Split at the document with the highest impact of all terms in the interval.
            lo, hi, top = low[taken], high[taken], peak[taken]
            value = np.where(hi > lo, weights * self.impact[top], -1)
            doc = self.doc[top[np.arange(len(taken)), value.argmax(axis=1)]].astype(np.int64)
            at = np.searchsorted(self.place, first + doc[:, None])
            there = at < hi
            there &= self.doc[np.minimum(at, len(self.doc) - 1)] == doc[:, None]
            score = np.where(there, weights * self.impact[np.minimum(at, len(self.doc) - 1)], 0).sum(axis=1)
            best.enter(score, self.ids[doc])
            left, right = np.concatenate([lo, at + there]), np.concatenate([at, hi])
            starts = np.concatenate([begin[taken], np.minimum(doc + 1, len(self.ids) - 1)])
            tops = self.maxima(left, right)
            bounds = np.where(right > left, weights * self.impact[tops], 0).sum(axis=1)
            rest = np.ones(len(bound), bool)
            rest[taken] = False
            new = best.admits(bounds, self.ids[starts])
            low, high, peak, bound, begin = (
                np.concatenate([old[rest], own[new]]) for old, own in (
                    (low, left), (high, right), (peak, tops), (bound, bounds), (begin, starts)
                )
            )
            batch = min(2 * batch, cfg.batch)


class Best:
    """The `top` highest scores above 0 with their ids; of equal scores the smaller ids."""

    def __init__(self, top: int):
        self.top = top
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def admits(self, bound: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Which intervals may hold a document that enters, from their bound and first id."""
        if len(self.scores) < self.top:
            return bound > 0
        least, last = self.scores[-1], self.ids[-1]
        return (bound > least) | ((bound == least) & (first < last))

    def enter(self, scores: np.ndarray, ids: np.ndarray) -> None:
        new = self.admits(scores, ids)
        if new.any():
            scores, ids = np.concatenate([self.scores, scores[new]]), np.concatenate([self.ids, ids[new]])
            order = np.lexsort((ids, -scores))[:self.top]
            self.scores, self.ids = scores[order], ids[order]


def _best_documents(index: DataFrame, items: Items, cfg: SearchConfig) -> DataFrame:
    """item, id, score: the best documents of all shards of a task, for each item."""
    docs, words, shards = (v or 0 for v in index.agg(F.sum("n_docs"), F.sum("n_terms"), F.count("*")).first())
    held = document_counts(index, len(items.vocabulary))
    weight = np.array([floor(1000 * log((2 * docs + 2) / (2 * n + 1))) for n in held.tolist()], np.int64)
    queries = [
        (numbers := np.fromiter(own, np.int64, len(own)), weight[numbers] * np.fromiter(own.values(), np.int64, len(own)))
        for own in items.counts
    ]

    def search(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(cfg.top) for _ in queries]
        for part in parts:
            for row in part.to_pylist():
                if row["ids"]:
                    shard = Shard(row, docs, words, cfg)
                    for own, (numbers, weights) in zip(best, queries):
                        shard.search(numbers, weights, own, cfg)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(np.arange(len(best)), [len(b.ids) for b in best])),
            pa.array(np.concatenate([b.ids for b in best])), pa.array(np.concatenate([b.scores for b in best])),
        ], names=["item", "id", "score"])

    # Few shards a task, as each is searched for all items; small files would come many to a task.
    dealt = index.select("ids", "lengths", "term", "doc", "tf").repartition(max(1, min(shards, cfg.tasks)))
    found = dealt.mapInArrow(search, "item long, id long, score long")
    # In two steps, so that no task gets a row of each task for an item.
    parted = found.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(256)))
    return _highest(_highest(parted, ["item", "part"], cfg).drop("rank"), ["item"], cfg)


def _highest(found: DataFrame, by: list[str], cfg: SearchConfig) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= cfg.top)


def search(
    spark: SparkSession, docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text", cfg: SearchConfig = SearchConfig(),
) -> DataFrame:
    """item_id, rank, doc_id, score: the `top` documents with a score above 0 for every item.

    Terms are runs of ASCII letters and digits and of any characters beyond ASCII, A-Z
    lower-cased. Equal scores go by the smaller document id, a null id last. Null and empty
    texts have no terms: such documents do not count, such items have no rows. Every row of
    `docs` is a document of its own and every row of `items` an item of its own, also where
    ids repeat. Ids are integers; other columns play no part.
    """
    results = []
    for block in _blocks(items, item_key, item_text, cfg):
        index = build_index(docs, key, text, block.vocabulary, cfg)
        found = _best_documents(index, block, cfg)
        ids = spark.createDataFrame(list(enumerate(block.ids)), "item long, item_id long")
        results.append(stored(found.join(ids, "item").select(
            "item_id", "rank", F.nullif("id", F.lit(_LAST)).alias("doc_id"), "score"
        ), "found"))
    empty = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, results) if results else empty
