import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from eventguard.llm.quality import (
    BAD, GOOD, WAYS, QualityConfig, counts, fit, keep_good, score_quality, votes,
)
from tests.llm import brute

CFG = QualityConfig()


def texts(seed=1):
    rng = random.Random(seed)
    good = [" ".join(rng.choice("the of and walking house river".split()) + rng.choice("abcdefgh") * 2
                     for _ in range(90)) + "." for _ in range(30)]
    symbols = [" ".join(w + "###" for w in t.split()) for t in good[:5]]
    shouted = [" ".join(w.upper() + "!!" for w in t.split()) for t in good[5:9]]
    odd = [None, "", " \n\t ", "a", "x " * 30_000, "a b c a b c", "one\ntwo\none\n\n one", "日本 語 é\U0001F600 " * 30,
           "w\x0bx\x0cy\rz\x1cq", "l\n" * 60]
    return good + symbols + shouted + odd


def test_counts_against_brute_force(spark):
    rows = texts()
    found = {r["doc_id"]: r for r in score_quality(brute.documents(spark, rows)).collect()}
    for k, text in enumerate(rows):
        r = found[k]
        expected = brute.counts(text)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == expected
        n, *_, again = expected
        assert r["base_failed"] == (n < 50 or 100 * again > 50 * n)
        assert not (r["base_failed"] and r["kept"])


def test_junk_goes_and_prose_stays(spark):
    kept = {r["doc_id"]: r["kept"] for r in score_quality(brute.documents(spark, texts())).collect()}
    assert all(kept[k] for k in range(30)) and not any(kept[k] for k in range(30, 39))


def test_estimate_against_plain_python(spark):
    df = brute.documents(spark, texts(2))
    names = [f"v{j}" for j in range(8)]
    cast = df.select(counts(F.col("text")).alias("c")).select(
        *[v.alias(n) for n, v in zip(names, votes(F.col("c"), CFG))]
    )
    model = fit(cast.groupBy(*names).agg(F.count("*").alias("n")), names, "n", CFG)
    patterns = Counter(tuple(r) for r in cast.collect())
    before = {GOOD: dict(zip(WAYS, CFG.on_good)), BAD: dict(zip(WAYS, CFG.on_bad))}
    share, rates = 0.5, {y: [before[y]] * 8 for y in (GOOD, BAD)}
    total = sum(patterns.values())
    for _ in range(CFG.rounds):
        sums = {y: [Counter() for _ in names] for y in (GOOD, BAD)}
        size = Counter()
        for pattern, n in patterns.items():
            odds = math.log(share / (1 - share))
            for j, v in enumerate(pattern):
                w = math.log(rates[GOOD][j][v] / rates[BAD][j][v])
                odds += max(w, 0) if v == GOOD else min(w, 0) if v == BAD else w
            good = 1 / (1 + math.exp(-odds))
            for y, p in ((GOOD, good), (BAD, 1 - good)):
                size[y] += n * p
                for j, v in enumerate(pattern):
                    sums[y][j][v] += n * p
        prior = CFG.prior_weight * total
        rates = {y: [{v: (sums[y][j][v] + prior * before[y][v]) / (size[y] + prior) for v in WAYS}
                     for j in range(8)] for y in (GOOD, BAD)}
        old, share = share, (size[GOOD] + prior / 2) / (total + prior)
        if abs(old - share) < CFG.settled:
            break
    assert model.share == pytest.approx(share)
    for y in (GOOD, BAD):
        for j in range(8):
            assert model.rates[y][j] == pytest.approx(rates[y][j])


def test_no_python_in_the_plan(spark):
    plan = score_quality(brute.documents(spark, ["a"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_columns_repeats_and_empty_tables(spark):
    rows = texts()
    df = brute.documents(spark, [*rows, rows[0]], [*range(len(rows)), 0])
    df = df.withColumns({"quality": F.lit("mine"), "_quality": F.lit(1), "n_words": F.lit(2), "v0": F.lit(3)})
    kept = keep_good(df)
    assert kept.columns == df.columns
    assert [r["doc_id"] for r in kept.filter("doc_id = 0").collect()] == [0, 0]
    assert kept.select("quality").distinct().collect()[0][0] == "mine"
    assert keep_good(df.limit(0)).count() == 0 and score_quality(df.limit(0)).count() == 0
    assert score_quality(brute.documents(spark, [None, rows[0]], [None, None])).count() == 2
