"""Probability of a text over all its segmentations into subword pieces.

A word's lattice has an arc for each vocabulary piece that spells a part of it; the forward
recursion sums all paths in log space. The vocabulary's own scores weigh the segmentations
from which piece probabilities are estimated, once per different word of the learning texts
since pieces have to spell words not seen before. A word seen in learning has one more arc,
the whole word, with its discounted frequency; what the discount frees goes to the spelled
paths. A text is its words and one end.

Words are counted before anything is shuffled, and each different word is spelled once,
wherever it occurs. Documents look up frequent words in a table of bounded size; all other
words are joined, so no part of the lexicon has to fit in a task.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eventguard.llm.common import beside, fresh, in_chunks, stored, utf8
from eventguard.llm.pieces import (
    MARK, PIECE_MODEL, PieceTrie, expected_pieces, load_vocabulary, marginals, zipf_log,
)

# The token that ends every text; words are never empty.
END = b""


@dataclass(frozen=True)
class LatticeConfig:
    model: str = PIECE_MODEL
    # Words sent to all tasks: at most so many, the most frequent ones.
    frequent: int = 100_000
    # Different words a task counts before it passes them on.
    words_held: int = 400_000
    rounds: int = 3
    # Share of the vocabulary's own scores in the pieces' weights, against their estimated counts as 1.
    prior: float = 0.05


@dataclass(frozen=True)
class LatticeModel:
    """lexicon: every word of all texts with its count in learning (n) and spelling (log10)."""

    lexicon: DataFrame
    tokens: int
    types: int
    discount: float
    end_count: int
    end_spelled: float

    def log10(self, n: np.ndarray, spelled: np.ndarray) -> np.ndarray:
        if not self.tokens:
            return np.asarray(spelled, float)
        free = self.discount * self.types / self.tokens
        known = np.maximum(np.asarray(n) - self.discount, 0.0) / self.tokens
        return np.log10(known + free * np.power(10.0, np.maximum(spelled, -290.0))) + np.minimum(
            np.where(known > 0, 0.0, np.asarray(spelled) + 290.0), 0.0
        )

    def base(self, n: np.ndarray) -> np.ndarray:
        return np.log10((np.asarray(n) + 1.0) / (self.tokens + 1.0 * (self.types + 1)))


def tokens(text: bytes) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return text.lower().split()


def word_counts(df: DataFrame, text: str, learning: str, cfg: LatticeConfig) -> DataFrame:
    """word, n (in learning texts); words of other texts have n = 0. Counted in tasks first."""
    raw, learn = fresh(df, "raw", "learn")
    rows = df.select(utf8(F.col(text)).alias(raw), F.col(learning).alias(learn))

    def flush(counts: Counter, others: set) -> pa.RecordBatch:
        words = [*counts, *others]
        return pa.RecordBatch.from_arrays([
            pa.array(words, pa.binary()), pa.array([*counts.values(), *[0] * len(others)], pa.int64()),
        ], names=["word", "n"])

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        others: set = set()
        for part in parts:
            for chunk, texts in in_chunks(part, raw):
                for text, learned in zip(texts, chunk.column(learn).to_pylist()):
                    (counts if learned else others).update(tokens(text))
                if len(counts) + len(others) > cfg.words_held:
                    yield flush(counts, others)
                    counts.clear()
                    others.clear()
        yield flush(counts, others)

    counted = rows.mapInArrow(count, "word binary, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def learn(df: DataFrame, text: str, learning: str, cfg: LatticeConfig = LatticeConfig()) -> LatticeModel:
    """Lexicon and probabilities from the rows of df where `learning` is true."""
    spark = df.sparkSession
    counted = stored(word_counts(df, text, learning, cfg), "words")
    seen = counted.agg(
        F.sum("n").alias("n"), F.count_if(F.col("n") > 0).alias("types"),
        F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice"),
    ).first()
    ends = df.filter(F.col(learning)).count()
    total, types = (seen["n"] or 0) + ends, seen["types"] + (1 if ends else 0)
    once, twice = seen["once"], seen["twice"]
    discount = once / (once + 2 * twice) if once else 0.5

    vocabulary = load_vocabulary(cfg.model)
    trie = PieceTrie(vocabulary)
    logp = start = zipf_log(vocabulary)
    shared = spark.sparkContext.broadcast(trie)
    for _ in range(cfg.rounds):
        used = _piece_counts(counted, shared, logp)
        if vocabulary.end >= 0:
            used[vocabulary.end] += min(ends, 1)
        with np.errstate(divide="ignore"):
            logp = np.log(used + cfg.prior * max(used.sum(), 1.0) * np.exp(start))
        logp -= np.logaddexp.reduce(logp)
    lexicon = stored(_spelled(counted, shared, logp), "lexicon")
    end = logp[vocabulary.end] / math.log(10) if vocabulary.end >= 0 else -10.0
    return LatticeModel(lexicon, total, types, discount, ends, end)


def _piece_counts(counted: DataFrame, trie, logp: np.ndarray) -> np.ndarray:
    def expect(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(logp))
        for part in parts:
            words = [MARK + w for w in part.column("word").to_pylist()]
            total += expected_pieces(trie.value, logp, words, np.ones(len(words)))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array(total[used], pa.float64())], names=["piece", "n"]
        )

    sums = counted.filter("n > 0").mapInArrow(expect, "piece long, n double")
    found = np.zeros(len(logp))
    for row in sums.groupBy("piece").agg(F.sum("n").alias("n")).collect():  # a row per piece
        found[row["piece"]] = row["n"]
    return found


def _spelled(counted: DataFrame, trie, logp: np.ndarray) -> DataFrame:
    def spell(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = marginals(trie.value, logp, [MARK + w for w in part.column("word").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(found / math.log(10), pa.float64())],
                names=["word", "n", "spelled"],
            )

    return counted.mapInArrow(spell, "word binary, n long, spelled double")


def _frequent(lexicon: DataFrame, most: int) -> dict[bytes, tuple[int, float]]:
    """The words with at least so many occurrences that there are no more than `most` of them."""
    rank = F.floor(F.log2(F.col("n").cast("double")) * 4)
    sizes = lexicon.filter("n > 0").groupBy(rank.alias("k")).agg(F.count("*").alias("words")).collect()
    held, least = 0, None
    for row in sorted(sizes, key=lambda r: -r["k"]):  # four rows for each doubling of a count
        held += row["words"]
        if held > most:
            break
        least = row["k"]
    if least is None:
        return {}
    top = lexicon.filter("n > 0").filter(rank >= least).toArrow()
    return dict(zip(
        top.column("word").to_pylist(),
        zip(top.column("n").to_pylist(), top.column("spelled").to_pylist()),
    ))


RESULT = ["n_tokens", "n_known", "base_score", "score"]


def score_texts(
    df: DataFrame, model: LatticeModel, keep: list[str], text: str = "text",
    cfg: LatticeConfig = LatticeConfig(),
) -> DataFrame:
    """The `keep` columns of each row with n_tokens, n_known, base_score and score (log10).

    `model` must come from a frame that holds these texts. A null text counts as empty and
    is one token, the end. Rows that are repeated are scored each; a kept column that is called
    like a result gives way to it.
    """
    keep = beside(keep, *RESULT)
    raw, rid, word, times = fresh(df.select(*keep), "raw", "rid", "word", "times")
    rows = df.select(*keep, utf8(F.col(text)).alias(raw))
    top = _frequent(model.lexicon, cfg.frequent)
    words = list(top)
    n = np.array([top[w][0] for w in words], np.int64)
    spelled = np.array([top[w][1] for w in words])
    scores = dict(zip(words, zip(model.base(n).tolist(), model.log10(n, spelled).tolist())))
    end = (
        float(model.base(np.array([model.end_count]))[0]),
        float(model.log10(np.array([model.end_count]), np.array([model.end_spelled]))[0]),
    )
    sent = df.sparkSession.sparkContext.broadcast(scores)
    kept = [df.schema[name] for name in keep]
    schema = ", ".join([
        *[f"`{f.name}` {f.dataType.simpleString()}" for f in kept],
        f"`{rid}` string, n_tokens long, n_known long, base_score double, score double,"
        f" `{word}` binary, `{times}` long",
    ])
    end_known = 1 if model.end_count else 0

    def look_up(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, row, table = TaskContext.get().partitionId(), 0, sent.value
        for part in parts:
            for chunk, texts in in_chunks(part, raw):
                ids, sums, at, rest, count = [], [], [], [], []
                for i, text in enumerate(texts):
                    own = tokens(text)
                    known, base, score = end_known, end[0], end[1]
                    for w, c in Counter(own).items():
                        found = table.get(w)
                        if found is None:
                            at.append(i)
                            rest.append(w)
                            count.append(c)
                        else:
                            known += c
                            base += c * found[0]
                            score += c * found[1]
                    ids.append(f"{task}-{row}")
                    sums.append((len(own) + 1, known, base, score))
                    row += 1
                take = pa.array([*range(len(texts)), *at], pa.int64())
                columns = [chunk.column(name).take(take) for name in keep]
                columns.append(pa.array(ids, pa.string()).take(take))
                none = [None] * len(at)
                for k, kind in enumerate((pa.int64(), pa.int64(), pa.float64(), pa.float64())):
                    columns.append(pa.array([*[s[k] for s in sums], *none], kind))
                blank = [None] * len(texts)
                columns.append(pa.array([*blank, *rest], pa.binary()))
                columns.append(pa.array([*blank, *count], pa.int64()))
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, rid, *RESULT, word, times])

    found = stored(rows.mapInArrow(look_up, schema), "lookups")
    rest = found.filter(F.col(word).isNotNull()).select(rid, word, times)
    lexicon = model.lexicon.select(F.col("word").alias(word), "n", "spelled")

    def add_up(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            n, c = part.column("n").to_numpy(), part.column(times).to_numpy()
            yield pa.RecordBatch.from_arrays([
                part.column(rid),
                pa.array(np.where(n > 0, c, 0), pa.int64()),
                pa.array(c * model_base(n), pa.float64()),
                pa.array(c * model_log10(n, part.column("spelled").to_numpy()), pa.float64()),
            ], names=[rid, "k", "b", "s"])

    small = LatticeModel(None, model.tokens, model.types, model.discount, 0, 0.0)
    model_base, model_log10 = small.base, small.log10
    sums = rest.join(lexicon, word).mapInArrow(add_up, f"`{rid}` string, k long, b double, s double")
    sums = sums.groupBy(rid).agg(F.sum("k").alias("k"), F.sum("b").alias("b"), F.sum("s").alias("s"))
    firsts = found.filter(F.col(word).isNull())
    zero = F.lit(0)
    return firsts.join(sums, rid, "left").select(
        *keep, "n_tokens",
        (F.col("n_known") + F.coalesce("k", zero)).alias("n_known"),
        (F.col("base_score") + F.coalesce("b", zero)).alias("base_score"),
        (F.col("score") + F.coalesce("s", zero)).alias("score"),
    )
