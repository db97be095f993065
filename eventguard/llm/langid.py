"""Language of a text by prediction by partial matching.

For each language a tree of byte contexts, none to `order` bytes long, is counted on a
sample of its texts. A byte is coded in the longest context of the tree; where that context
has not seen the byte, an escape is coded and a context shorter by one byte is tried, down
to a uniform code. Escapes have the weight of the context's number of different bytes
(method C, without exclusions). Counts are frozen, so a text's code length in a language is
an exact sum over its bytes; the language with the shortest code is predicted.

The trees are the only thing sent to all tasks. Their size is bounded by the sample at any
input size: about `sample_docs` different texts a language, as texts are drawn by a hash and
a text counts once however often it occurs, of up to `longest` bytes each.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from eventguard.llm.common import beside, fresh, in_chunks, stored, utf8

UNKNOWN = "und"


@dataclass(frozen=True)
class LangConfig:
    order: int = 4
    # Bound of the learning sample: texts per language.
    sample_docs: int = 1500
    # Longest text, in bytes, that takes part in learning; all texts are predicted.
    longest: int = 100_000
    # Positions coded at a time in a task.
    block: int = 1 << 21


def _lower(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def _joined(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts, each behind `order` zero bytes; the places of text bytes; their text."""
    gap = b"\0" * order
    data = _lower(np.frombuffer(gap + gap.join(texts), dtype=np.uint8))
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    owner = np.repeat(np.arange(len(texts)), lengths)
    places = np.arange(len(owner)) + order * (owner + 1)
    return data, places, owner


def _grams(data: np.ndarray, places: np.ndarray, order: int) -> np.ndarray:
    """The byte at each place behind the `order` bytes before it, as one number."""
    keys = np.zeros(len(places), dtype=np.uint64)
    for back in range(order, -1, -1):
        keys = (keys << np.uint64(8)) | data[places - back].astype(np.uint64)
    return keys


def grow_tree(texts: Iterator[list[bytes]], order: int, block: int) -> list[dict[str, np.ndarray]]:
    """Per context length: known grams and their code lengths, known contexts and the escape's."""
    keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for some in texts:
        data, places, _ = _joined(some, order)
        for at in range(0, len(places), block):
            k, c = np.unique(_grams(data, places[at:at + block], order), return_counts=True)
            keys, back = np.unique(np.concatenate([keys, k]), return_inverse=True)
            counts = np.bincount(back, np.concatenate([counts, c]), len(keys)).astype(np.int64)
    levels = []
    for length in range(order + 1):
        shorter = keys & np.uint64((1 << 8 * (length + 1)) - 1)
        grams, back = np.unique(shorter, return_inverse=True)
        seen = np.bincount(back, counts, len(grams))
        contexts, of = np.unique(grams >> np.uint64(8), return_inverse=True)
        total = np.bincount(of, seen, len(contexts))
        kinds = np.bincount(of, minlength=len(contexts))
        levels.append({
            "grams": grams, "bits": np.log2((total + kinds)[of] / seen).astype(np.float32),
            "contexts": contexts, "escape": np.log2((total + kinds) / kinds).astype(np.float32),
        })
    return levels


def _find(sorted_keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(sorted_keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(sorted_keys, wanted), len(sorted_keys) - 1)
    return at, sorted_keys[at] == wanted


def code_bits(keys: np.ndarray, levels: list[dict[str, np.ndarray]]) -> np.ndarray:
    """Code length in bits of the last byte of each gram."""
    bits = np.zeros(len(keys), np.float64)
    left = np.arange(len(keys))
    for length in range(len(levels) - 1, -1, -1):
        level = levels[length]
        gram = keys[left] & np.uint64((1 << 8 * (length + 1)) - 1)
        at, known = _find(level["grams"], gram)
        bits[left[known]] += level["bits"][at[known]]
        left, gram = left[~known], gram[~known]
        at, known = _find(level["contexts"], gram >> np.uint64(8))
        bits[left[known]] += level["escape"][at[known]]
    bits[left] += 8.0
    return bits


def learn(df: DataFrame, text: str, lang: str, cfg: LangConfig) -> dict[str, list[dict[str, np.ndarray]]]:
    """A tree per language from rows with a text and a language.

    Different texts of up to `longest` bytes are drawn by a hash of their content, the same
    ones on every run.
    """
    known = df.select(F.col(lang).alias("lang"), F.col(text).alias("text")).dropna()
    share = (F.lit(float(cfg.sample_docs)) / F.col("n")).alias("share")
    # A small table with known size, so that Spark joins it without moving texts.
    sizes = stored(known.groupBy("lang").agg(F.count("*").alias("n")).select("lang", share), "sizes")
    drawn = (F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / float(1 << 30)) < F.col("share")
    short = F.octet_length("text") <= cfg.longest
    sample = known.filter(short).join(sizes, "lang").filter(drawn).select(
        "lang", utf8(F.col("text")).alias("text")
    ).distinct()

    def tree(rows: pd.DataFrame) -> pd.DataFrame:
        texts = [bytes(t) for t in rows["text"]]
        parts = (texts[at:at + 256] for at in range(0, len(texts), 256))
        grown = grow_tree(parts, cfg.order, cfg.block)
        return pd.DataFrame({"lang": [rows["lang"].iloc[0]], "tree": [pickle.dumps(grown)]})

    trees = sample.groupBy("lang").applyInPandas(tree, "lang string, tree binary")
    return {row["lang"]: pickle.loads(row["tree"]) for row in trees.toLocalIterator()}


def _scores(
    texts: list[bytes], names: list[str], trees: list[list[dict[str, np.ndarray]]], cfg: LangConfig
) -> tuple[list[str], list[float]]:
    data, places, owner = _joined(texts, cfg.order)
    total = np.zeros((len(names), len(texts)))
    for at in range(0, len(places), cfg.block):
        keys = _grams(data, places[at:at + cfg.block], cfg.order)
        mine = owner[at:at + cfg.block]
        first, width = mine[0], mine[-1] - mine[0] + 1
        distinct, back = np.unique(keys, return_inverse=True)
        for k, tree in enumerate(trees):
            bits = code_bits(distinct, tree)[back]
            total[k, first:first + width] += np.bincount(mine - first, bits, width)
    best = total.argmin(axis=0)
    # Posterior share of the best language, all equally likely beforehand.
    odds = np.exp2(-np.minimum(total - total.min(axis=0), 1000.0)).sum(axis=0)
    return [names[k] for k in best], (1.0 / odds).tolist()


def predict_language(
    df: DataFrame,
    model: dict[str, list[dict[str, np.ndarray]]],
    keep: list[str],
    text: str = "text",
    names: tuple[str, str] = ("lang_pred", "score"),
    cfg: LangConfig = LangConfig(),
) -> DataFrame:
    """The `keep` columns of every row with the language of its text and a score from 0 to 1.

    A text that is null or has no letter is `und` with score 0, as is every text if nothing
    was learned. Ties go to the language first in name order. A kept column that is called
    like a result gives way to it.
    """
    keep = beside(keep, *names)
    letters, raw = fresh(df.select(*keep), "letters", "raw")
    has_letter: Column = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    rows = df.select(*keep, has_letter.alias(letters), utf8(F.col(text)).alias(raw))
    langs = sorted(model)
    sent = df.sparkSession.sparkContext.broadcast([model[name] for name in langs])
    fields = [f"`{n}` {df.schema[n].dataType.simpleString()}" for n in keep]
    schema = ", ".join([*fields, f"`{names[0]}` string", f"`{names[1]}` double"])

    def predict(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for rows, texts in in_chunks(part, raw):
                spoken = rows.column(letters).to_pylist()
                found, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
                asked = [i for i, yes in enumerate(spoken) if yes]
                if asked and langs:
                    best = _scores([texts[i] for i in asked], langs, sent.value, cfg)
                    for i, name, s in zip(asked, *best):
                        found[i], score[i] = name, s
                kept = [rows.column(n) for n in keep]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(found, pa.string()), pa.array(score, pa.float64())],
                    names=[*keep, *names],
                )

    return rows.mapInArrow(predict, schema)
