"""Near-duplicate lines: of each group of like lines only the first one stays.

Lines are compared by their sets of character shingles. One-permutation MinHash signatures
are cut into many short bands, so that like lines share one with high probability; pairs
that do are verified by exact Jaccard similarity, and the links form components in which
the first line in document order is kept.

Equal lines count as one line from the start. Within a task, lines that share a band are
linked to one of them, and only that one meets those of other tasks, so a band that very
many lines share is neither gathered nor paired out. Where such a link does not hold and
leaves its lines in different components, the other lines of their bands are compared with
each other too, a large band block by block. What shares a band is thus either compared or
in one component already.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from eventguard.llm.common import distinct, fresh, in_chunks, let, stored, utf8
from eventguard.llm.components import components

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))

_SPACE = " \t\n\v\f\r"


@dataclass(frozen=True)
class LineConfig:
    shingle: int = 8
    similarity: float = 0.8
    bands: int = 12
    rows: int = 4
    # Shorter lines are never compared by shingles.
    least_chars: int = 30
    # Whether shorter lines that are not blank go when they repeat exactly; else they always stay.
    short_repeats: bool = False
    # Bands in one bucket of the exchange, about.
    bucket: int = 400_000
    # Lines of a band compared in a task at a time; bands of few lines are compared pair by pair.
    block: int = 1500
    few: int = 60
    # Entries of smaller bands that a task gets, about.
    packed: int = 4_000

    @property
    def size(self) -> int:
        return self.bands * self.rows


def shingle_hashes(points: np.ndarray, width: int) -> np.ndarray:
    """Hash of the `width` characters from each place on, by doubling."""
    if len(points) < width:
        return np.zeros(0, np.uint64)
    out, have, power = points, 1, int(_A)
    while have < width:
        # The two halves may overlap; with all characters covered the hash is still of the shingle.
        step = min(have, width - have)
        out = out[:len(out) - step] * np.uint64(power) + out[step:]
        power = (power * power + 2 * have) % (1 << 64) | 1
        have += step
    out = out ^ (out >> np.uint64(32))
    out *= _B
    out ^= out >> np.uint64(29)
    return out


def _minima(lines: list[str], cfg: LineConfig, table: np.ndarray) -> None:
    """Puts the minimum of the shingle hashes in each bin of each line into a table of rows."""
    sizes = np.array([len(line) for line in lines], np.int64)
    points = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    hashes = shingle_hashes(points, cfg.shingle)
    owner = np.repeat(np.arange(len(lines)), sizes)
    inside = owner[:len(hashes)] == owner[cfg.shingle - 1:]
    hashes, owner = hashes[inside], owner[:len(inside)][inside]
    bins = ((hashes >> np.uint64(32)) * np.uint64(cfg.size)) >> np.uint64(32)
    np.minimum.at(table.reshape(-1), owner * cfg.size + bins.astype(np.int64), hashes)


def signatures(lines: list[str], cfg: LineConfig) -> np.ndarray:
    """Minimum of the shingle hashes that fall in each of `size` bins, per line.

    A bin without a shingle takes the value of a bin drawn by a hash of its number, the
    same draws for every line, so equal bins stay as likely as the sets are like.
    """
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    table = np.full((len(lines), cfg.size), empty)
    # Some lines at a time, so that what is computed on the way stays in the processor's cache.
    start, held = 0, 0
    for k, line in enumerate(lines):
        held += len(line)
        if held > 30_000 or k == len(lines) - 1:
            _minima(lines[start:k + 1], cfg, table[start:k + 1])
            start, held = k + 1, 0
    own, draw = table.copy(), 0
    rows = np.flatnonzero((table == empty).any(axis=1))
    places = np.arange(1, cfg.size + 1, dtype=np.uint64) * _B
    while len(rows):
        draw += 1
        turn = np.uint64(draw * int(_C) % (1 << 64))
        other = ((places + turn) >> np.uint64(20)) % np.uint64(cfg.size)
        if draw > 40 * cfg.size:  # every bin will have been drawn long before
            other = (np.arange(cfg.size) + draw) % cfg.size
        held, drawn = table[rows], own[rows][:, other.astype(np.int64)]
        np.copyto(held, drawn, where=held == empty)
        table[rows] = held
        rows = rows[(held == empty).any(axis=1)]
    return table


def band_values(table: np.ndarray, cfg: LineConfig) -> np.ndarray:
    """One number per band, which also tells the bands apart."""
    parts = table.reshape(len(table), cfg.bands, cfg.rows)
    out = np.broadcast_to(np.arange(1, cfg.bands + 1, dtype=np.uint64) * _C, parts.shape[:2]).copy()
    for k in range(cfg.rows):
        out = (out ^ (out >> np.uint64(31))) * _A + parts[:, :, k]
    out ^= out >> np.uint64(32)
    out *= _B
    return out ^ (out >> np.uint64(29))


def _line_table(docs: DataFrame, rid: str, raw: str, order: list[str], cfg: LineConfig) -> DataFrame:
    """rid, line, h and the order columns (k0, ...): every line that may go; bands: of lines to
    be compared, with their first occurrence in a task's chunk."""
    keys = [f"k{i}" for i in range(len(order))]

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for chunk, texts in in_chunks(part, "_raw"):
                rows, places, found, lines, seen = [], [], [], [], set()
                first: list[int] = []
                for row, text in enumerate(texts):
                    for k, line in enumerate(text.decode().split("\n")):
                        short = len(line) < cfg.least_chars
                        if short and not (cfg.short_repeats and line.strip(_SPACE)):
                            continue
                        h = xxhash.xxh3_64_intdigest(line.encode())
                        if not short and h not in seen:
                            seen.add(h)
                            first.append(len(rows))
                            lines.append(line)
                        rows.append(row)
                        places.append(k)
                        found.append(h)
                if not rows:
                    continue
                bands: list[bytes | None] = [None] * len(rows)
                if lines:
                    values = band_values(signatures(lines, cfg), cfg)
                    for at, own in zip(first, values):
                        bands[at] = own.tobytes()
                take = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays([
                    *[chunk.column(c).take(take) for c in [*keys, "rid"]], pa.array(places, pa.int32()),
                    pa.array(np.array(found, np.uint64).view(np.int64)), pa.array(bands, pa.binary()),
                ], names=[*keys, "rid", "line", "h", "bands"])

    kinds = [f"{k} {docs.schema[c].dataType.simpleString()}" for k, c in zip(keys, order)]
    source = docs.select(
        *[F.col(c).alias(k) for k, c in zip(keys, order)], F.col(rid).alias("rid"), F.col(raw).alias("_raw")
    )
    return source.mapInArrow(cut, ", ".join([*kinds, "rid long, line int, h long, bands binary"]))


def _leaders(band: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct bands with one of their lines each, and links from it to the others.

    Which line leads is drawn per band, so that different bands link through different lines.
    """
    order = np.lexsort(((ids ^ band) * _B, band))
    band, ids = band[order], ids[order]
    head = np.ones(len(band), bool)
    head[1:] = band[1:] != band[:-1]
    leader = ids[np.maximum.accumulate(np.where(head, np.arange(len(ids)), 0))]
    linked = ~head & (leader != ids)
    return band[head], ids[head], leader[linked], ids[linked]


def candidate_links(lines: DataFrame, buckets: int, cfg: LineConfig) -> DataFrame:
    """a, b: lines that share a band, linked through one of them; every pair once per bucket."""

    def links(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0) if len(a) else (
            np.zeros((0, 2), np.uint64)
        )
        return pairs[:, 0].view(np.int64), pairs[:, 1].view(np.int64)

    def spread(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def send(ids: list[np.ndarray], bands: list[np.ndarray]) -> pa.RecordBatch:
            h, own = np.unique(np.concatenate(ids), return_index=True)
            band = np.concatenate(bands)[own].reshape(-1)
            band, who, a, b = _leaders(band, np.repeat(h, cfg.bands))
            place = (band >> np.uint64(16)) % np.uint64(buckets)
            order = np.argsort(place, kind="stable")
            filled, first = np.unique(place[order], return_index=True)
            blobs = [np.stack([band[o], who[o]]).tobytes() for o in np.split(order, first[1:])]
            a, b = links(a, b)
            none, blank = [None] * len(a), [None] * len(blobs)
            return pa.RecordBatch.from_arrays([
                pa.array([*filled.tolist(), *none], pa.int32()), pa.array([*blobs, *none], pa.binary()),
                pa.array([*blank, *a.tolist()], pa.int64()), pa.array([*blank, *b.tolist()], pa.int64()),
            ], names=["bucket", "blob", "a", "b"])

        ids, bands, held = [], [], 0
        for part in parts:
            if not part.num_rows:
                continue
            ids.append(part.column("h").to_numpy().view(np.uint64))
            raw = b"".join(part.column("bands").to_pylist())
            bands.append(np.frombuffer(raw, np.uint64).reshape(-1, cfg.bands))
            held += part.num_rows
            if held > 200_000:
                yield send(ids, bands)
                ids, bands, held = [], [], 0
        if held:
            yield send(ids, bands)

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        both = [np.frombuffer(blob, np.uint64).reshape(2, -1) for blob in rows["blob"]]
        band, ids = np.concatenate(both, axis=1)
        _, _, a, b = _leaders(band, ids)
        a, b = links(a, b)
        return pd.DataFrame({"a": a, "b": b})

    # Cheap enough to be done twice, once for what stays in the task and once for the rest.
    sent = lines.filter(F.col("bands").isNotNull()).select("h", "bands").mapInArrow(
        spread, "bucket int, blob binary, a long, b long"
    )
    met = sent.filter("bucket IS NOT NULL").select("bucket", "blob").groupBy("bucket").applyInPandas(
        meet, "a long, b long"
    )
    local = sent.filter("bucket IS NULL").select("a", "b")
    return local.unionByName(met).distinct()


def _shingle_sets(lines: list[str], cfg: LineConfig) -> np.ndarray:
    """The different shingles of each line as sorted numbers, the line's number above 44 bits of hash."""
    sizes = np.array([len(line) for line in lines], np.int64)
    points = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    hashes = shingle_hashes(points, cfg.shingle)
    owner = np.repeat(np.arange(len(lines), dtype=np.uint64), sizes)
    inside = owner[:len(hashes)] == owner[cfg.shingle - 1:]
    return distinct(owner[:len(hashes)][inside] << np.uint64(44) | hashes[inside] >> np.uint64(20))


def similar(xs: list[str], ys: list[str], cfg: LineConfig) -> np.ndarray:
    """Whether the lines of each pair have a Jaccard similarity of `similarity` or more."""
    found, start, held = [np.zeros(0, bool)], 0, 0
    for k in range(len(xs)):
        held += len(xs[k]) + len(ys[k])
        if held > 300_000 or k == len(xs) - 1 or k - start > 100_000:
            n = k + 1 - start
            x, y = _shingle_sets(xs[start:k + 1], cfg), _shingle_sets(ys[start:k + 1], cfg)
            both = np.sort(np.concatenate([x, y]))
            both = both[1:][both[1:] == both[:-1]]
            shared, nx, ny = (np.bincount((v >> np.uint64(44)).astype(np.int64), minlength=n) for v in (both, x, y))
            found.append(shared >= cfg.similarity * (nx + ny - shared))
            start, held = k + 1, 0
    return np.concatenate(found)


def _places(lines: DataFrame) -> DataFrame:
    """h, first, n: where a line occurs first by the order of rows, and how often, per different line."""
    order = [c for c in lines.columns if c.startswith("k")]
    first = F.min(F.struct(*order, "rid", "line")).alias("first")
    return stored(lines.groupBy("h").agg(first, F.count("*").alias("n")), "places")


def _texts(pairs: DataFrame, places: DataFrame, docs: DataFrame, rid: str, text: str) -> DataFrame:
    """h, text: the lines that occur in pairs."""
    need = pairs.select(F.col("a").alias("h")).unionByName(pairs.select(F.col("b").alias("h"))).distinct()
    wanted = places.join(need, "h").groupBy(F.col("first.rid").alias(rid)).agg(
        F.collect_list(F.struct(F.col("first.line").alias("line"), "h")).alias("wanted")  # lines of one text
    )
    cut = let(F.split(F.col(text), "\n"), lambda ls: F.transform(
        F.col("wanted"), lambda w: F.struct(w["h"].alias("h"), F.get(ls, w["line"]).alias("text"))
    ))
    return stored(
        docs.select(rid, text).join(wanted, rid).select(F.explode(cut).alias("l")).select("l.*")
        .dropDuplicates(["h"]), "linetexts",
    )


def _checked(pairs: DataFrame, texts: DataFrame, cfg: LineConfig) -> DataFrame:
    """The pairs, and whether they are similar."""
    both = pairs.join(texts.select(F.col("h").alias("a"), F.col("text").alias("ta")), "a").join(
        texts.select(F.col("h").alias("b"), F.col("text").alias("tb")), "b"
    )

    def check(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            like = similar(part.column("ta").to_pylist(), part.column("tb").to_pylist(), cfg)
            yield part.select(["a", "b"]).append_column("like", pa.array(like))

    return both.select("a", "b", "ta", "tb").mapInArrow(check, "a long, b long, like boolean")


def links_between(texts: list[str], groups: list[int], cfg: LineConfig) -> list[tuple[int, int]]:
    """Links of similar texts that connect whatever groups have such texts."""
    sets = [distinct(shingle_hashes(
        np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64), cfg.shingle
    )) for t in texts]
    sizes = np.array([len(s) for s in sets], np.int64)
    tokens, back = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(back, kind="stable")
    members, starts = owner[order], np.searchsorted(back[order], np.arange(len(tokens) + 1))
    ends = np.cumsum(sizes)
    parent = {g: g for g in groups}

    def root(g: int) -> int:
        while parent[g] != g:
            parent[g] = parent[parent[g]]
            g = parent[g]
        return g

    # Of two texts of different groups, one at least is outside the largest.
    largest = Counter(groups).most_common(1)[0][0]
    links = []
    for i, group in enumerate(groups):
        if group == largest or not sizes[i]:
            continue
        own = back[ends[i] - sizes[i]:ends[i]].tolist()
        common = np.bincount(np.concatenate([members[starts[t]:starts[t + 1]] for t in own]), minlength=len(sets))
        near = np.flatnonzero(common / (sizes[i] + sizes - common) >= cfg.similarity)
        for j in near.tolist():
            a, b = root(group), root(groups[j])
            if a != b:
                parent[max(a, b)] = min(a, b)
                links.append((i, j))
    return links


def _pairs_of_band(bands: np.ndarray, at: int, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of lines of different groups for which this band, the one at place `at`, is the first they share."""
    first = (bands[:, None, :] == bands[None, :, :]).argmax(axis=2)
    return np.nonzero(np.triu((first == at) & (groups[:, None] != groups[None, :]), 1))


def _others_linked(parted: DataFrame, groups: DataFrame, texts: DataFrame, cfg: LineConfig) -> DataFrame | None:
    """Links between the groups of `parted` (a, b) by whatever lines of theirs share a band.

    A band of two lines is left out: its one pair has been compared already.
    """
    open_groups = parted.select(F.col("a").alias("group")).unionByName(
        parted.select(F.col("b").alias("group"))
    ).distinct()
    members = stored(
        texts.join(groups, "h", "left").withColumn("group", F.coalesce("group", "h"))
        .join(open_groups, "group", "left_semi"), "openlines",
    )

    def each(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if part.num_rows:
                values = band_values(signatures(part.column("text").to_pylist(), cfg), cfg)
                take = pa.array(np.repeat(np.arange(part.num_rows), cfg.bands))
                yield pa.RecordBatch.from_arrays([
                    pa.array(values.reshape(-1).view(np.int64)), pa.array(np.tile(np.arange(cfg.bands), part.num_rows), pa.int32()),
                    part.column("h").take(take), part.column("group").take(take),
                ], names=["band", "at", "h", "group"])

    entries = stored(members.mapInArrow(each, "band long, at int, h long, group long"), "bands")
    # Only bands in which several groups meet; the larger ones are compared block by block.
    several = stored(entries.groupBy("band").agg(
        F.count("*").alias("n"), F.min("group").alias("low"), F.max("group").alias("high")
    ).filter("low < high AND n > 2").select("band", "n"), "openbands")
    total = several.agg(F.sum("n")).first()[0]
    if not total:
        return None
    blocks = F.ceil(F.col("n") / F.lit(cfg.block)).cast("int")
    mine = F.pmod(F.xxhash64("h"), blocks.cast("long")).cast("int")
    parts = F.transform(F.sequence(F.lit(0), blocks - 1), lambda j: F.concat_ws(
        "-", F.col("band").cast("string"), F.least(mine, j).cast("string"), F.greatest(mine, j).cast("string")
    ))
    packs = max(1, total // cfg.packed)
    tasks = F.when(blocks > 1, parts).otherwise(
        F.array(F.pmod(F.xxhash64("band"), F.lit(packs)).cast("string"))
    )
    placed = entries.join(several, "band").select("band", "at", "h", F.explode(tasks).alias("task")).join(members, "h")

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("band", kind="stable")
        hs, which = np.unique(rows["h"].to_numpy(), return_index=True)
        own = band_values(signatures(rows["text"].iloc[which].tolist(), cfg), cfg)
        line, band, at = np.searchsorted(hs, rows["h"].to_numpy()), rows["band"].to_numpy(), rows["at"].to_numpy()
        groups, texts = rows["group"].to_numpy(), rows["text"].tolist()
        heads = np.flatnonzero(np.diff(band, prepend=band[0] - 1) != 0)
        left, right, found = [], [], []
        for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(band)]):
            if b - a <= cfg.few:
                i, j = _pairs_of_band(own[line[a:b]], int(at[a]), groups[a:b])
                left += (i + a).tolist()
                right += (j + a).tolist()
            else:
                found += [(groups[a + i], groups[a + j]) for i, j in links_between(texts[a:b], groups[a:b].tolist(), cfg)]
        like = similar([texts[i] for i in left], [texts[j] for j in right], cfg)
        found += [(groups[i], groups[j]) for i, j, yes in zip(left, right, like) if yes]
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    return placed.select("task", "band", "at", "h", "group", "text").groupBy("task").applyInPandas(
        compare, "a long, b long"
    )


def similar_components(
    pairs: DataFrame, places: DataFrame, docs: DataFrame, rid: str, text: str, cfg: LineConfig
) -> DataFrame:
    """node, component: of the lines that are similar, through others or directly."""
    texts = _texts(pairs, places, docs, rid, text)
    checked = stored(_checked(pairs, texts, cfg), "checked")
    found = components(checked.filter("like"), "a", "b")
    groups = found.select(F.col("node").alias("h"), F.col("component").alias("group"))
    of = lambda end: groups.select(F.col("h").alias(end), F.col("group").alias(f"g{end}"))
    parted = stored(
        checked.filter("NOT like").join(of("a"), "a", "left").join(of("b"), "b", "left")
        .select(F.coalesce("ga", "a").alias("a"), F.coalesce("gb", "b").alias("b")).filter("a != b"), "parted",
    )
    more = _others_linked(parted, groups, texts, cfg)
    if more is None:
        return found
    # Links between groups join components; a line without any link before is a group by itself.
    joined = components(stored(more, "grouplinks"), "a", "b")
    moved = joined.select(F.col("node").alias("component"), F.col("component").alias("to"))
    return found.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component")).unionByName(
        joined.join(found.select("node"), "node", "left_anti")
    )


def repeated_lines(df: DataFrame, order: list[str], text: str, cfg: LineConfig) -> tuple[DataFrame, DataFrame, str]:
    """The rows of df with a hash of order columns and text, and which of their lines repeat.

    The second frame has that hash (`rid`) and `removed`, the sorted numbers of the lines
    that go; rows without any do not occur. Of a component the line stays whose row is first
    by the `order` columns (nulls first), within it the uppermost. The hash names a row
    however often and in whatever parts the rows are read.
    """
    (rid,) = fresh(df, "rid")
    docs = df.withColumn(rid, F.xxhash64(*order, text))
    raw = fresh(docs, "raw")[0]
    lines = stored(_line_table(docs.withColumn(raw, utf8(F.col(text))), rid, raw, order, cfg), "lines")
    n = lines.count()
    buckets = max(16, n * cfg.bands // cfg.bucket)
    pairs = stored(candidate_links(lines, buckets, cfg), "pairs")
    places = _places(lines.drop("bands"))
    found = similar_components(pairs, places, docs, rid, text, cfg)
    named = places.join(found.withColumnRenamed("node", "h"), "h", "left").withColumn(
        "group", F.coalesce("component", "h")
    )
    firsts = named.groupBy("group").agg(F.sum("n").alias("n"), F.min("first").alias("first")).filter("n > 1")
    stays = stored(named.select("h", "group").join(firsts, "group").select(
        "h", F.col("first.rid").alias("first_rid"), F.col("first.line").alias("first_line")
    ), "stays")
    gone = lines.select("rid", "line", "h").join(stays, "h").filter(
        (F.col("rid") != F.col("first_rid")) | (F.col("line") != F.col("first_line"))
    )
    removed = gone.groupBy("rid").agg(F.array_sort(F.collect_set("line")).alias("removed"))  # of one text
    return docs, removed, rid


def find_repeated_lines(
    df: DataFrame, key: str = "doc_id", text: str = "text", cfg: LineConfig = LineConfig()
) -> DataFrame:
    """Per row: the key, `n_lines` (0 for a null or empty text) and `removed`, the lines that go.

    Lines are numbered from 0. Rows that are equal in key and text count as one row, and each
    of them gets that row's result.
    """
    docs, removed, rid = repeated_lines(df.select(key, text), [key], text, cfg)
    n = F.when(F.coalesce(F.length(text), F.lit(0)) > 0, F.size(F.split(text, "\n"))).otherwise(0)
    rows = docs.select(key, F.col(rid).alias("rid"), n.cast("long").alias("n_lines"))
    none = F.array().cast("array<int>")
    return rows.join(removed, "rid", "left").select(
        key, "n_lines", F.coalesce("removed", none).alias("removed")
    )


def drop_repeated_lines(
    df: DataFrame, key: str = "doc_id", text: str = "text", length: str | None = None,
    cfg: LineConfig = LineConfig(),
) -> DataFrame:
    """The rows of df without their repeated lines; rows of which nothing is left go.

    `length` names a column that holds the number of characters and is brought up to date.
    Null and empty texts stay as they are.
    """
    docs, removed, rid = repeated_lines(df, [key], text, cfg)
    (gone,) = fresh(docs, "removed")
    rows = docs.join(removed.withColumnsRenamed({"rid": rid, "removed": gone}), rid, "left")
    kept = let(F.struct(F.split(F.col(text), "\n").alias("lines"), F.col(gone).alias("gone")), lambda s: F.array_join(
        F.filter(s["lines"], lambda line, i: ~F.array_contains(s["gone"], i)), "\n"
    ))
    changed = F.col(gone).isNotNull()
    rows = rows.withColumn(text, F.when(changed, kept).otherwise(F.col(text)))
    if length:
        rows = rows.withColumn(length, F.when(changed, F.length(text).cast("long")).otherwise(F.col(length)))
    blank = F.coalesce(~F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(True))
    return rows.filter(~(changed & blank)).select(*df.columns)
