"""Resampling, ranked search and exact top-k against brute force and SQL."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from eventguard.llm import queries, resample as resampling
from eventguard.llm.knn import KnnConfig, nearest
from eventguard.llm.ranked import Best, SearchConfig, search
from eventguard.llm.resample import ResampleConfig, _unpacked, packed_order, resample
from tests.llm import brute

TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_against_sql(spark, small, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    done = con.execute(queries.oracle_sql()[name])
    names = [d[0] for d in done.description]
    df = queries.queries()[name](spark, small)
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(repr, (tuple(r) for r in df.select(*names).collect()))) == sorted(map(repr, done.fetchall()))


# resampling

def drawn(texts, target, cfg):
    """[(id, n_features, weight, score, rank)] of (id, text) rows; ids differ."""
    def features(text):
        w = terms(text)
        return [" ".join(w[i:i + k]) for k in range(1, cfg.ngram + 1) for i in range(len(w) - k + 1)]

    bucket = lambda f: zlib.crc32(f.encode()) % cfg.buckets
    s, t = (Counter(bucket(f) for x in side for f in features(x)) for side in ([x for _, x in texts], target))
    ss, tt = sum(s.values()), sum(t.values())
    rows = []
    for key, text in texts:
        own = features(text)
        weight = sum(math.floor(1000 * math.log(
            (t[b] + 1) * (ss + cfg.buckets) / ((s[b] + 1) * (tt + cfg.buckets))
        )) for b in map(bucket, own))
        name = f"{cfg.seed}:{'' if key is None else key}"
        h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        rows.append([key, len(own), weight, score, None, len(terms(text))])
    able = sorted((r for r in rows if r[5] >= cfg.least_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, row in enumerate(able[:len(able) * cfg.percent // 100]):
        row[4] = k + 1
    return [tuple(r[:5]) for r in rows]


def resampled(spark, texts, target, cfg, **more):
    df = brute.documents(spark, [t for _, t in texts], [k for k, _ in texts]).withColumns({
        n: F.lit(1) for n in ("id", "rank", "score", "_raw", "at", "weight")
    }).repartition(5)
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    out = resample(df, bench, cfg=cfg, **more)
    return [tuple(r) for r in out.select("doc_id", "n_features", "weight", "score", "rank").collect()]


def prose_rows(seed=5, n=300):
    rng = random.Random(seed)
    rows = [(k, " ".join(brute.prose(rng, rng.randrange(1, 60), 90))) for k in range(n)]
    odd = [None, "", " \n", "É日本 x1-Y2", "ABC abc Abc " * 10, "word " * 100_000]
    return rows + [(n + k, t) for k, t in enumerate(odd)] + [(None, "lone words " * 20)]


@pytest.mark.parametrize("more", [{}, {"ngram": 3, "buckets": 50}, {"segment": 7, "samples": 60, "percent": 60}])
def test_resampling_against_brute_force(spark, more):
    rows, target = prose_rows(), ["w1 w2 w3 w1", None, "", "w5 w6 w7 w8 É日本"]
    cfg = ResampleConfig(**more)
    found = resampled(spark, rows, target, cfg)
    assert sorted(found, key=repr) == sorted(drawn(rows, target, cfg), key=repr)


def test_resampling_of_repeated_rows(spark):
    """Half of the rows are one and the same: ranks are still 1, 2, 3, ... and segments cut through them."""
    text = "some words that come again " * 8
    rows = [(7, text)] * 200 + prose_rows(n=200)[:200]
    cfg = ResampleConfig(segment=10, samples=1000, percent=70)
    found = resampled(spark, rows, [text], cfg)
    n = sum(len(terms(t)) >= 20 for _, t in rows)
    assert len(found) == len(rows)
    ranks = sorted((r[4], -r[3], r[0]) for r in found if r[4])
    assert [r[0] for r in ranks] == list(range(1, n * 70 // 100 + 1))
    assert [r[1:] for r in ranks] == sorted(r[1:] for r in ranks)


def test_resampling_of_nothing(spark):
    rows = prose_rows(n=30)
    cfg = ResampleConfig()
    assert sorted(resampled(spark, rows, [], cfg), key=repr) == sorted(drawn(rows, [], cfg), key=repr)
    assert resampled(spark, [], ["a"], cfg) == []
    assert all(r[4] is None for r in resampled(spark, rows[:5], ["a"], cfg))


def test_order_of_packed_keys():
    rng = random.Random(1)
    rows = [(rng.choice([-5, 0, 3, 2**62, -2**62]), rng.choice([-9, 0, 4, 2**63 - 1]), rng.randrange(2**40)) for _ in range(300)]
    keys = packed_order(*(np.array(c) for c in zip(*rows)))
    assert [_unpacked(k) for k in keys] == rows
    order = np.argsort(keys, kind="stable")
    assert [rows[i] for i in order] == sorted(rows, key=lambda r: (-r[0], r[1], r[2]))


def test_few_rows_reach_the_driver(spark, monkeypatch):
    """Splitters come from a sample of about the size set, however many rows there are."""
    seen = []
    real = resampling._splitters
    monkeypatch.setattr(resampling, "_splitters", lambda runs, n, cfg: seen.append(real(runs, n, cfg)) or seen[-1])
    rows = [(k, "one two three four five six seven eight nine ten " * 2) for k in range(2000)]
    resampled(spark, rows, ["one"], ResampleConfig(segment=10, samples=50))
    assert 20 < len(seen[0]) < 100


# ranked search

def ranked(docs, items, top=20):
    """[(item, rank, id, score)] of (id, text) rows, every row on its own."""
    own = [(key, Counter(terms(text))) for key, text in docs if terms(text)]
    n, total = len(own), sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    out = []
    for item, text in items:
        hits = []
        for key, tf in own:
            m = 75 + 25 * sum(tf.values()) * n // total
            score = sum(
                k * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 12 * m))
                for t, k in Counter(terms(text)).items() if t in tf
            )
            if score > 0:
                hits.append((-score, key is None, key or 0, key))
        out += [(item, r + 1, key, -s) for r, (s, _, _, key) in enumerate(sorted(hits)[:top])]
    return out


def searched(spark, docs, items, **more):
    df = brute.documents(spark, [t for _, t in docs], [k for k, _ in docs]).withColumns({
        n: F.lit(1) for n in ("id", "item", "item_id", "score", "_raw", "rank")
    }).repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string").withColumns({n: F.lit(2) for n in ("doc_id", "item")})
    return [tuple(r) for r in search(spark, df, bench, cfg=SearchConfig(**more)).collect()]


@pytest.mark.parametrize("more", [
    {}, {"postings": 40, "batch": 1}, {"documents": 3, "top": 3}, {"block_terms": 5, "batch": 2}, {"tasks": 1, "postings": 100},
])
def test_search_against_brute_force(spark, more):
    rng = random.Random(len(more))
    docs = [(k, " ".join(brute.prose(rng, rng.randrange(1, 80), 60))) for k in range(120)]
    docs += [(200 + k, docs[3][1]) for k in range(40)]  # ties, which go by id
    docs += [(None, docs[4][1]), (9, docs[4][1]), (9, docs[4][1]), (500, None), (501, ""), (502, "--"), (503, "É日本 W1 w1")]
    docs.append((600, "w3 filler " * 100_000))
    items = [(k, " ".join(brute.prose(rng, rng.randrange(1, 30), 70))) for k in range(12)]
    items += [(50, None), (51, ""), (52, "nowhere"), (0, docs[3][1]), (None, "w1 w1 É日本"), (53, docs[3][1])]
    found = searched(spark, docs, items, **more)
    assert sorted(found, key=repr) == sorted(ranked(docs, items, more.get("top", 20)), key=repr)


def test_search_of_nothing(spark):
    assert searched(spark, [], [(1, "a")]) == [] and searched(spark, [(1, "a")], []) == []
    assert searched(spark, [(1, None)], [(1, "a")]) == []


def test_intervals_below_the_best_are_left():
    """Documents are not all scored: what can not enter is never split."""
    best = Best(2)
    best.enter(np.array([5, 9, 7]), np.array([1, 2, 3]))
    assert best.scores.tolist() == [9, 7] and best.ids.tolist() == [2, 3]
    assert best.admits(np.array([8, 7, 7, 6]), np.array([9, 2, 4, 0])).tolist() == [True, True, False, False]


# top-k

def closest(rows, k=20, scale=64):
    """[(query, rank, id, score)] of (id, vector) rows; queries have ids divisible by 20."""
    fine = {}
    for key, vector in rows:
        if key is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            fine.setdefault((key, tuple(math.floor(scale * x) for x in vector)), []).append(key)
    every = [(key, v) for (key, v), copies in fine.items() for _ in copies]
    out = []
    for key, q in fine:
        if key % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v)), other) for other, v in every if other != key)
            out += [(key, r + 1, other, -s) for r, (s, other) in enumerate(scores[:k])]
    return out


def vectors(seed, n=260, width=9, spread=1.0):
    """Some clusters, one of very many copies, and far-off vectors."""
    rng = random.Random(seed)
    centres = [[rng.gauss(0, spread) for _ in range(width)] for _ in range(6)]
    rows = [(k, [float(np.float32(x + rng.gauss(0, 0.1))) for x in rng.choice(centres)]) for k in range(n)]
    rows += [(n + k, rows[0][1]) for k in range(90)]
    odd = [None, [], [1.0] * 3, [None] * width, [math.nan] * width, [math.inf] * width, [0.0] * width, [-3.0] * width]
    rows += [(1000 + k, v) for k, v in enumerate(odd)]
    return [*rows, (20, rows[20][1]), (40, rows[41][1]), (7, rows[7][1]), (None, rows[1][1])]


@pytest.mark.parametrize("more", [
    {}, {"pivots": 3, "groups": 2, "k": 4}, {"pivots": 12, "queries": 3, "data": 40, "block": 16, "asked": 2, "sample": 30},
    {"pivots": 1, "groups": 1, "block": 7},
])
@pytest.mark.parametrize("spread", [1.0, 60.0])
def test_top_k_against_brute_force(spark, more, spread):
    rows = vectors(len(more), spread=spread)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({n: F.lit(1) for n in ("v", "id", "rank", "ask")})
    found = nearest(df.repartition(4), F.col("vec_id") % 20 == 0, cfg=KnnConfig(**more)).collect()
    expected = closest([(k, v) for k, v in rows], k=more.get("k", 20))
    assert sorted(map(tuple, found)) == sorted(expected)


def test_top_k_of_nothing(spark):
    df = spark.createDataFrame([(20, [1.0, 2.0]), (21, None)], "vec_id long, embedding array<float>")
    assert nearest(df, F.col("vec_id") % 20 == 0).count() == 0  # its own row only
    assert nearest(df.limit(0), F.lit(True)).count() == 0 and nearest(df, F.lit(False)).count() == 0
