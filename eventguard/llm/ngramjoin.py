"""Jaccard join of texts on word n-grams by prefixes of token combinations.

A token is one n-gram. Tokens are ordered by the number of texts they occur in, and a text
is indexed by a prefix in that order: tokens that occur nowhere else first, then rare ones,
each an index key of its own, then frequent ones, which fall into classes and are indexed
by pairs within a class. A prefix is extended until, whichever tokens a partner may lack,
one rare token or two frequent ones of one class must still be shared; two texts that are
similar enough therefore meet under some key. What meets is verified exactly.

Occurrences are counted per chunk of texts first, so a token costs one entry a chunk however
frequent it is, and only its class travels back to the chunk. A text with more tokens of its
own than a partner may lack is out at once. Sets are equal for copies, which count as one text.
Texts that meet form clusters; each text is sent once to its cluster, or, where a cluster is
larger than a block, once to every pair of blocks it takes part in.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from eventguard.llm.common import buckets_for, distinct, fresh, in_chunks, packed_texts, stored, unpacked_texts, utf8
from eventguard.llm.components import components

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


@dataclass(frozen=True)
class JoinConfig:
    ngram: int = 5
    similarity_pct: int = 80
    # Occurrences in chunks from which a token is frequent.
    frequent: int = 32
    # Frequent tokens of a prefix that share a class, about.
    class_tokens: int = 12
    # Neighbouring sizes that are indexed together, as a ratio.
    size_step: float = 1.25
    # Bytes of text in a chunk; texts compared in a task at a time.
    chunk: int = 4 << 20
    block: int = 1500
    words_held: int = 400_000


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _B
    return x ^ (x >> np.uint64(29))


class Shingler:
    """Distinct n-grams of texts as sorted hashes. A shorter text is one n-gram of all its words."""

    def __init__(self, cfg: JoinConfig):
        self.width, self.held = cfg.ngram, cfg.words_held
        self.words: dict[bytes, int] = {}

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The sets behind each other, and their sizes."""
        words, width = self.words, self.width
        if len(words) > self.held:
            words.clear()
        split = [text.lower().split() for text in texts]
        for own in split:
            for w in own:
                if w not in words:
                    words[w] = xxhash.xxh3_64_intdigest(w)
        sizes = np.array([len(own) for own in split], np.int64)
        ids = np.fromiter((words[w] for own in split for w in own), np.uint64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(texts)), sizes)
        n = max(len(ids) - width + 1, 0)
        grams = np.zeros(n, np.uint64)
        for k in range(width):
            grams = grams * _A + mix(ids[k:k + n] + _C)
        whole = owner[:n] == owner[width - 1:]
        grams, owner = mix(grams[whole]), owner[:n][whole]
        short = np.flatnonzero((sizes > 0) & (sizes < width))
        if len(short):
            ends = np.cumsum(sizes)
            extra = [
                xxhash.xxh3_64_intdigest(ids[ends[i] - sizes[i]:ends[i]].tobytes()) for i in short
            ]
            grams, owner = np.append(grams, np.array(extra, np.uint64)), np.append(owner, short)
        order = np.lexsort((grams, owner))
        grams, owner = grams[order], owner[order]
        first = np.ones(len(grams), bool)
        first[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
        grams, owner = grams[first], owner[first]
        return grams, np.bincount(owner, minlength=len(texts))


def _classes(grams: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and number in the bucket by which occurrences of a token are counted."""
    bits = int(math.log2(buckets))
    return (grams >> np.uint64(64 - bits)).astype(np.int64), (
        (grams << np.uint64(bits)) >> np.uint64(32)
    ).astype(np.uint32)


def _pack(numbers: np.ndarray) -> bytes:
    """Rising numbers in little space: differences, byte by byte, compressed."""
    steps = np.diff(numbers, prepend=numbers.dtype.type(0))
    raw = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, steps.itemsize).T).tobytes()
    return pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(blob: bytes, n: int) -> np.ndarray:
    raw = pa.decompress(blob, decompressed_size=4 * n, codec="zstd", asbytes=True)
    planes = np.frombuffer(raw, np.uint8).reshape(4, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint32).reshape(-1), dtype=np.uint32)


def _chunk_numbers(grams: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct bucket numbers of a chunk, each behind its bucket, and each token's place."""
    bucket, number = _classes(grams, buckets)
    return np.unique((bucket.astype(np.uint64) << np.uint64(32)) | number, return_inverse=True)


def _filled(keys: np.ndarray) -> list[tuple[int, int, int]]:
    """The buckets that have numbers in a chunk, and where these lie."""
    bucket, first = np.unique(keys >> np.uint64(32), return_index=True)
    return list(zip(bucket.astype(np.int64).tolist(), first.tolist(), [*first[1:].tolist(), len(keys)]))


def _distinct_sets(grams: np.ndarray, sizes: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """A checksum of each set, and the tokens with repeated sets left out."""
    ends = np.cumsum(sizes)
    sums = [xxhash.xxh3_128_digest(grams[e - n:e].tobytes()) for e, n in zip(ends, sizes)]
    seen: set[bytes] = set()
    new = [s not in seen and not seen.add(s) for s in sums]
    return sums, grams[np.repeat(new, sizes)]


def _documents(df: DataFrame, keep: list[str], text: str, buckets: int, cfg: JoinConfig) -> DataFrame:
    """Texts in chunks with number, size and checksum of their sets, and the chunks' counts."""
    raw, = fresh(df.select(*keep), "raw")
    rows = df.select(*keep, utf8(F.col(text)).alias(raw))

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shingler, base, count = Shingler(cfg), TaskContext.get().partitionId() << 33, 0
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.int64())
        for part in parts:
            for chunk, texts in in_chunks(part, raw, cfg.chunk):
                grams, sizes = shingler(texts)
                sums, counted = _distinct_sets(grams, sizes)
                keys, back = _chunk_numbers(counted, buckets)
                times = np.minimum(np.bincount(back, minlength=len(keys)), 255).astype(np.uint8)
                own = _filled(keys)
                n, m = len(texts), len(own)
                number = base + count
                count += n
                values = (
                    [number] * (n + m),
                    [*range(number, number + n), *[None] * m],
                    [*sizes.tolist(), *[None] * m],
                    [*sums, *[None] * m],
                    [*texts, *[None] * m],
                    [*[None] * n, *[k for k, _, _ in own]],
                    [*[None] * n, *[_pack((keys[a:b] & np.uint64(0xFFFFFFFF)).astype(np.uint32)) for _, a, b in own]],
                    [*[None] * n, *[pa.compress(times[a:b].tobytes(), codec="zstd", asbytes=True) for _, a, b in own]],
                    [*[None] * n, *[int(b - a) for _, a, b in own]],
                )
                take = pa.array([*range(n), *[None] * m], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*[chunk.column(c).take(take) for c in keep], *[pa.array(v, k) for v, k in zip(values, kinds)]],
                    names=[*keep, *_NAMES],
                )

    fields = [f"`{n}` {df.schema[n].dataType.simpleString()}" for n in keep]
    return rows.mapInArrow(cut, ", ".join([*fields, _SCHEMA]))


_SCHEMA = (
    "_chunk long, _rid long, _size long, _sum binary, _text binary, _bucket int, _numbers binary,"
    " _times binary, _count long"
)
_NAMES = [field.split()[0] for field in _SCHEMA.split(", ")]


def _occurrences(rows: pd.DataFrame) -> pd.DataFrame:
    """For each chunk of a bucket, how often each of its numbers occurs in all chunks, at most 255."""
    numbers = [_unpack(blob, n) for blob, n in zip(rows["_numbers"], rows["_count"])]
    times = [
        np.frombuffer(pa.decompress(blob, decompressed_size=int(n), codec="zstd", asbytes=True), np.uint8)
        for blob, n in zip(rows["_times"], rows["_count"])
    ]
    _, back = np.unique(np.concatenate(numbers), return_inverse=True)
    total = np.bincount(back, np.concatenate(times))
    found = np.minimum(total[back], 255).astype(np.uint8)
    ends = np.cumsum([len(n) for n in numbers])
    return pd.DataFrame({
        "_chunk": rows["_chunk"], "_bucket": rows["_bucket"],
        "_found": [pa.compress(found[e - len(n):e].tobytes(), codec="zstd", asbytes=True) for e, n in zip(ends, numbers)],
    })


def _levels(size: int, cfg: JoinConfig) -> list[int]:
    """Size levels that this text may share with a similar one."""
    share, step = cfg.similarity_pct / 100, math.log(cfg.size_step)
    low, high = math.log(size * share - 1e-9 if size * share > 1 else 1), math.log(size / share + 1e-9)
    return list(range(math.floor(low / step + 1e-9 - 1e-6), math.floor(high / step + 1e-6) + 1))


def index_keys(grams: np.ndarray, times: np.ndarray, cfg: JoinConfig) -> np.ndarray:
    """Index keys of one text: of rare tokens and of pairs of frequent ones in its prefix."""
    size = len(grams)
    lacks = size - -(-cfg.similarity_pct * size // 100)  # tokens that a partner may lack
    order = np.lexsort((grams, times))
    grams, times = grams[order], times[order]
    alone = int(np.searchsorted(times, 2))
    if alone > lacks:
        return np.zeros(0, np.uint64)
    rare = int(np.searchsorted(times, cfg.frequent))
    singles = grams[alone:min(rare, lacks + 1)]
    keys = []
    for level in _levels(size, cfg):
        tag = np.uint64((level + 100) * int(_C) % (1 << 64))
        keys.append(mix(singles ^ tag))
        if rare > lacks:
            continue
        classes = max(1, int(cfg.size_step ** level * (100 - cfg.similarity_pct) / 100 / cfg.class_tokens))
        rest = grams[rare:]
        kind = (mix(rest) % np.uint64(classes)).astype(np.int64)
        # Each class covers one token less than it has.
        seen = np.zeros(len(rest), bool)
        _, firsts = np.unique(kind, return_index=True)
        seen[firsts] = True
        covered = rare + np.cumsum(~seen)
        end = int(np.searchsorted(covered, lacks + 1)) + 1
        rest, kind = rest[:end], kind[:end]
        by = np.argsort(kind, kind="stable")
        rest, kind = rest[by], kind[by]
        for a, b in zip(*_runs(kind)):
            i, j = np.triu_indices(b - a, 1)
            keys.append(mix((rest[a:b][i] * _A + rest[a:b][j]) ^ tag ^ np.uint64(1)))
    return distinct(np.concatenate(keys))


def _runs(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(sorted_values)) + 1
    return np.append(0, edges)[:len(sorted_values)], np.append(edges, len(sorted_values))


def _indexed(cfg: JoinConfig, buckets: int):
    def index(docs: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        rids, texts = unpacked_texts(docs)
        grams, sizes = Shingler(cfg)(texts)
        _, counted = _distinct_sets(grams, sizes)
        keys, _ = _chunk_numbers(counted, buckets)
        times, places = np.ones(len(keys), np.uint8), {k: (a, b) for k, a, b in _filled(keys)}
        for bucket, blob in zip(found["_bucket"], found["_found"]):
            a, b = places[bucket]
            times[a:b] = np.frombuffer(
                pa.decompress(blob, decompressed_size=int(b - a), codec="zstd", asbytes=True), np.uint8
            )
        bucket, number = _classes(grams, buckets)
        at = np.searchsorted(keys, (bucket.astype(np.uint64) << np.uint64(32)) | number)
        times = times[at]
        out, end = [], 0
        for rid, size in zip(rids.tolist(), sizes):
            own = slice(end, end + size)
            end += size
            if size:
                k = index_keys(grams[own], times[own], cfg)
                if len(k):
                    out.append((rid, int(size), grams[own].tobytes(), k.view(np.int64)))
        return pd.DataFrame(out, columns=["rid", "size", "grams", "keys"])

    return index


def compared(
    sets: list[np.ndarray], times: np.ndarray, part: np.ndarray, across: bool, cfg: JoinConfig
) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Links that connect whatever sets are similar, through others or directly; and how many links each has.

    `times`: texts that each set stands for. In a comparison `across` two parts only links
    between them count, as those within a part are counted where it is compared with itself.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    tokens, back = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(back, kind="stable")
    members, starts = owner[order], np.searchsorted(back[order], np.arange(len(tokens) + 1))
    parent = list(range(len(sets)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links, degree, end = [], np.zeros(len(sets), np.int64), 0
    for i, size in enumerate(sizes.tolist()):
        own = back[end:end + size]
        end += size
        lists = [members[starts[t]:starts[t + 1]] for t in own.tolist()]
        common = np.bincount(np.concatenate(lists), minlength=len(sets))[:i]
        near = np.flatnonzero(100 * common >= cfg.similarity_pct * (size + sizes[:i] - common))
        counted = near[part[near] != part[i]] if across else near
        degree[i] += times[counted].sum()
        degree[counted] += times[i]
        for j in near.tolist():
            a, b = root(i), root(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
                links.append((i, j))
    return links, degree


def _grouped(df: DataFrame, keep: list[str], text: str, cfg: JoinConfig) -> tuple[DataFrame, list[str], DataFrame]:
    """Rows of df; the kept columns' names there; `_root`, a number that the texts of a component
    share, and `_links`, the number of similar other texts, of every row."""
    inner = [f"k{i}" for i in range(len(keep))]  # whatever they are called outside
    source = df.select(*[F.col(c).alias(k) for c, k in zip(keep, inner)], F.col(text).alias("text"))
    docs, found, reps = _links(source, inner, "text", cfg)
    links, degrees = found.filter("b IS NOT NULL"), found.filter("b IS NULL")
    roots = components(links, "a", "b").select(F.col("node").alias("_rep"), F.col("component").alias("_root"))
    linked = degrees.groupBy(F.col("a").alias("_rep")).agg(F.sum("n").alias("_linked"))
    # Copies are named by the one that stands for them; blank texts stand for themselves.
    named = stored(
        docs.select("_rid", "_size", "_sum").join(reps, "_sum")
        .withColumn("_rep", F.when(F.col("_size") > 0, F.col("_rep")).otherwise(F.col("_rid")))
        .join(roots, "_rep", "left").join(linked, "_rep", "left").select(
            "_rid", F.coalesce("_root", "_rep").alias("_root"),
            F.when(F.col("_size") > 0, F.coalesce("_linked", F.lit(0)) + F.col("_times") - 1).otherwise(0).alias("_links"),
        ), "roots",
    )
    return docs, inner, named


def similar_groups(
    df: DataFrame, key: str = "doc_id", text: str = "text",
    names: tuple[str, str, str] = ("n_shingles", "component_id", "n_links"), cfg: JoinConfig = JoinConfig(),
) -> DataFrame:
    """The key of each row, its set's size, its component, and the number of rows it is linked to.

    A component is named by the smallest key in it, found through links of any length. Null
    and blank texts have size 0 and are linked to nothing, not even to each other. Rows that
    are repeated are copies of each other.
    """
    docs, (inner,), roots = _grouped(df, [key], text, cfg)
    named = stored(docs.select(inner, "_rid", "_size").join(roots, "_rid"), "named")
    several = named.groupBy("_root").agg(F.min(inner).alias("_first"), F.count("*").alias("_n")).filter("_n > 1")
    return named.join(several.select("_root", "_first"), "_root", "left").select(
        F.col(inner).alias(key), F.col("_size").alias(names[0]),
        F.coalesce("_first", inner).alias(names[1]), F.col("_links").alias(names[2]),
    )


def drop_similar(
    df: DataFrame, key: str = "doc_id", text: str = "text", cfg: JoinConfig = JoinConfig()
) -> DataFrame:
    """The rows of df of which no similar one has a smaller key, with all their columns.

    Of each component one row stays, among equal keys any one. Null and blank texts stay.
    """
    others = [c for c in df.columns if c != text]
    (null,) = fresh(df, "no_text")
    docs, inner, roots = _grouped(df.withColumn(null, F.col(text).isNull()), [*others, null], text, cfg)
    place = F.struct(inner[others.index(key)], "_rid")
    ranked = docs.select("_rid", inner[others.index(key)]).join(roots, "_rid")
    stays = ranked.groupBy("_root").agg(F.min(place).alias("_first")).select(F.col("_first._rid").alias("_rid"))
    rows = docs.join(stays, "_rid", "left_semi")
    back = {c: F.col(k).alias(c) for c, k in zip(others, inner)}
    back[text] = F.when(~F.col(inner[-1]), F.col("_text").cast("string")).alias(text)
    return rows.select(*[back[c] for c in df.columns])


def _links(df: DataFrame, keep: list[str], text: str, cfg: JoinConfig) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows; links (a, b) and numbers of links (a, null, n) of different sets; what stands for equal sets."""
    buckets = buckets_for(df, text)
    table = stored(_documents(df, keep, text, buckets, cfg), "sets")
    counts = table.filter("_bucket IS NOT NULL").select("_chunk", "_bucket", "_numbers", "_times", "_count")
    found = counts.groupBy("_bucket").applyInPandas(_occurrences, "_chunk long, _bucket int, _found binary")
    docs = table.filter("_bucket IS NULL")
    indexed = stored(
        packed_texts(docs).groupBy("_chunk").cogroup(found.groupBy("_chunk")).applyInPandas(
            _indexed(cfg, buckets), "rid long, size long, grams binary, keys array<long>"
        ), "index",
    )
    # One text stands for all with the same set.
    reps = stored(docs.groupBy("_sum").agg(F.min("_rid").alias("_rep"), F.count("*").alias("_times")), "reps")
    index = indexed.join(reps.select(F.col("_rep").alias("rid")), "rid", "left_semi")
    entries = stored(index.select("rid", F.explode("keys").alias("key")), "entries")
    # Only texts that share a key with another one go on.
    keyed = entries.groupBy("key").agg(F.min("rid").alias("first"), F.count("*").alias("n")).filter("n > 1")
    led = stored(entries.join(keyed, "key"), "led")
    sets = stored(indexed.select("rid", "grams").join(led.select("rid").distinct(), "rid", "left_semi"), "met")
    clusters = _clusters(led, sets, cfg)
    sized = clusters.groupBy("component").agg(F.count("*").alias("n"))
    members = _placed(clusters.join(sized, "component"), "component", "n", clusters.count(), cfg).join(
        reps.select(F.col("_rep").alias("rid"), "_times"), "rid"
    ).join(sets, "rid")

    def verify(rows: pd.DataFrame) -> pd.DataFrame:
        out, blocks = [], rows["task"].iloc[0].split("-")[1:]
        across = len(set(blocks)) == 2
        # Small clusters share a task.
        for _, own in rows.groupby("component", sort=False):
            own = own.sort_values("rid")
            rids = own["rid"].tolist()
            pairs, degree = compared(
                [np.frombuffer(g, np.uint64) for g in own["grams"]], own["_times"].to_numpy(), own["part"].to_numpy(), across, cfg
            )
            out += [(rids[i], rids[j], None) for i, j in pairs]
            out += [(rids[i], None, int(degree[i])) for i in np.flatnonzero(degree).tolist()]
        return pd.DataFrame(out, columns=["a", "b", "n"]).astype("Int64")

    links = members.select("task", "component", "part", "rid", "_times", "grams").groupBy("task").applyInPandas(
        verify, "a long, b long, n long"
    )
    return docs, stored(links, "setlinks"), reps


def _placed(rows: DataFrame, group: str, n: str, total: int, cfg: JoinConfig) -> DataFrame:
    """The rows (rid) of groups of `n` with the tasks that compare them: task, group, part, rid.

    Small groups share a task; a large one is compared block by block.
    """
    blocks = F.ceil(F.col(n) / F.lit(cfg.block)).cast("int")
    packs = max(1, total // cfg.block)
    mine = F.pmod(F.xxhash64("rid"), blocks.cast("long")).cast("int")
    others = F.transform(F.sequence(F.lit(0), blocks - 1), lambda j: F.concat_ws(
        "-", F.col(group).cast("string"), F.least(mine, j).cast("string"), F.greatest(mine, j).cast("string")
    ))
    pack = F.array(F.pmod(F.xxhash64(group), F.lit(packs)).cast("string"))
    return rows.select(
        F.explode(F.when(blocks > 1, others).otherwise(pack)).alias("task"), group, mine.alias("part"), "rid"
    )


def _clusters(led: DataFrame, sets: DataFrame, cfg: JoinConfig) -> DataFrame:
    """rid, component: texts with others that they are, or may be, similar to.

    `led`: key, rid, the first text of the key, and how many it has. A key's texts are held
    against the first one. What that is similar to forms groups. Only where a key's texts then
    lie in several groups, these are put together, so texts that merely share keys make
    clusters no larger than such keys do; a pair that is alone under its keys makes none.
    """
    pairs = led.filter("rid > first").select("rid", "first").distinct()
    sized = pairs.groupBy("first").agg(F.count("*").alias("n"))
    # A leader's texts in parts of a block each; its own set goes to all of them.
    placed = pairs.join(sized, "first").withColumn(
        "part", F.pmod(F.xxhash64("rid"), F.ceil(F.col("n") / F.lit(cfg.block)).cast("long"))
    )
    packs = max(1, pairs.count() // cfg.block)
    task = F.when(F.col("n") > cfg.block, F.concat_ws("-", "first", "part")).otherwise(
        F.pmod(F.xxhash64("first"), F.lit(packs)).cast("string")
    ).alias("task")
    both = placed.select(task, "first", "rid").unionByName(
        placed.select(task, "first").distinct().withColumn("rid", F.col("first"))
    )

    def check(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for first, own in rows.groupby("first", sort=False):
            lead = np.frombuffer(own.loc[own["rid"] == first, "grams"].iloc[0], np.uint64)
            for rid, grams in zip(own["rid"].tolist(), own["grams"]):
                if rid != first:
                    text = np.frombuffer(grams, np.uint64)
                    at = np.minimum(np.searchsorted(lead, text), len(lead) - 1)
                    common = int((lead[at] == text).sum())
                    like = 100 * common >= cfg.similarity_pct * (len(lead) + len(text) - common)
                    out.append((rid, first, like))
        return pd.DataFrame(out, columns=["rid", "first", "alike"])

    checked = stored(both.join(sets, "rid").select("task", "first", "rid", "grams").groupBy("task").applyInPandas(
        check, "rid long, first long, alike boolean"
    ), "checked")
    groups = components(checked.filter("alike"), "rid", "first").select(F.col("node").alias("rid"), F.col("component").alias("group"))
    # Keys of two texts have been compared; of others those count whose texts lie in several groups.
    grouped = led.filter("n > 2").select("key", "rid").join(groups, "rid", "left").select(
        "key", F.coalesce("group", "rid").alias("group")
    ).distinct()
    apart = grouped.groupBy("key").agg(F.min("group").alias("low"), F.max("group").alias("high")).filter("low < high")
    meets = grouped.join(apart.select("key", "low"), "key").filter("group > low").select("group", "low").distinct()
    joined = components(stored(meets, "meets"), "group", "low").select(
        F.col("node").alias("group"), F.col("component").alias("component")
    )
    # Texts of a group of one that meet nobody any more have no links.
    every = led.select("rid").distinct().join(groups, "rid", "left").withColumn("group", F.coalesce("group", "rid"))
    return stored(
        every.join(joined, "group", "left").join(groups.select(F.col("rid").alias("in_group")), F.col("rid") == F.col("in_group"), "left")
        .filter("component IS NOT NULL OR in_group IS NOT NULL")
        .select("rid", F.coalesce("component", "group").alias("component")), "clusters",
    )
