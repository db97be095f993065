"""Lines, sets of n-grams, and repeated windows against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from eventguard.llm import bwtmerge, fmindex, ngramjoin
from eventguard.llm.components import components
from eventguard.llm.linededup import LineConfig, drop_repeated_lines, find_repeated_lines
from eventguard.llm.ngramjoin import JoinConfig, drop_similar, similar_groups
from eventguard.llm.queries import op5_line_dedup
from eventguard.llm.routing import RouteConfig, arithmetic_runs, joined
from tests.llm import brute


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 440)]
    edges += [(None, 3), (5, None), (7, 7)]
    found = components(spark.createDataFrame(edges, "x long, y long"), "x", "y").collect()
    real = [(x, y) for x, y in edges if None not in (x, y) and x != y]
    assert {r["node"]: r["component"] for r in found} == brute.components({k for e in real for k in e}, real)
    assert len(found) == len({r["node"] for r in found})
    assert components(spark.createDataFrame([], "x long, y long"), "x", "y").count() == 0


# lines

def line_texts(seed=4):
    rng = random.Random(seed)
    bases = [" ".join(brute.prose(rng, rng.randint(8, 40))) for _ in range(25)]
    texts = []
    for _ in range(60):
        lines = []
        for _ in range(rng.randint(1, 6)):
            line = rng.choice(bases) if rng.random() < 0.5 else " ".join(brute.prose(rng, 15))
            if rng.random() < 0.5:
                at = rng.randrange(len(line))
                line = line[:at] + rng.choice("xyzéж") + line[at + 1:]
            lines.append(line)
        texts.append("\n".join(lines))
    return [*texts, None, "", "\n\n", "short\nshort", texts[0], "é" * 40 + "\n" + "é" * 41]


def test_lines_against_brute_force(spark):
    texts = dict(enumerate(line_texts()))
    cfg = LineConfig()
    expected = brute.repeated_lines(texts, cfg.shingle, cfg.similarity, cfg.least_chars)
    found = find_repeated_lines(brute.documents(spark, list(texts.values()))).collect()
    assert {r["doc_id"]: r["removed"] for r in found} == expected
    assert {r["doc_id"]: r["n_lines"] for r in found} == {k: len(t.split("\n")) if t else 0 for k, t in texts.items()}


def test_lines_are_dropped(spark):
    texts = line_texts()
    df = brute.documents(spark, texts).withColumns({n: F.lit(1) for n in ("rid", "removed", "h", "_rid")})
    gone = brute.repeated_lines(dict(enumerate(texts)), 8, 0.8, 30)
    out = drop_repeated_lines(df, length="n_chars")
    assert out.columns == df.columns
    rows = {r["doc_id"]: r for r in out.collect()}
    for k, text in enumerate(texts):
        if not gone[k]:
            assert rows[k]["text"] == text
            continue
        kept = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone[k])
        if kept.strip():
            assert rows[k]["text"] == kept and rows[k]["n_chars"] == len(kept)
        else:
            assert k not in rows
    assert drop_repeated_lines(df.limit(0)).count() == 0 and find_repeated_lines(df.limit(0)).count() == 0


def test_equal_rows_count_as_one(spark):
    line = "a line that is long enough to take part in this"
    rows = find_repeated_lines(brute.documents(spark, [line, line, line], [None, None, 4])).collect()
    assert sorted((r["doc_id"] is None, r["removed"]) for r in rows) == [(False, [0]), (True, []), (True, [])]


def templated_lines(seed=13, families=160):
    """Lines of one template, mostly at similarity 0.6 to 0.7, of which some have a near copy."""
    rng = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyz "
    base = "".join(rng.choices(letters, k=240))

    def edited(line, places):
        for at in rng.sample(range(len(line)), places):
            line = line[:at] + rng.choice("0123456789") + line[at + 1:]
        return line

    lines = [edited(base, 3) for _ in range(families)]
    lines += [edited(line, 2) for line in lines[:families // 4]]
    rng.shuffle(lines)
    return lines


@pytest.mark.parametrize("block", [1500, 7])
def test_near_copies_among_lines_of_one_template(spark, block):
    """Lines that share a band are compared even if neither is similar to the line that leads it."""
    texts = dict(enumerate(templated_lines()))
    cfg = LineConfig(block=block)
    expected = brute.repeated_lines(texts, cfg.shingle, cfg.similarity, cfg.least_chars)
    found = find_repeated_lines(brute.documents(spark, list(texts.values())), cfg=cfg).collect()
    assert {r["doc_id"]: r["removed"] for r in found} == expected


def test_short_lines_repeat_exactly(spark, tmp_path):
    texts = ["All rights reserved.\na\n\n \t\nb", "a\nAll rights reserved!\n\nAll rights reserved.", "a", "\n \t"]
    brute.documents(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    rows = op5_line_dedup(spark, str(tmp_path)).collect()
    assert {r["doc_id"]: r["removed"] for r in rows} == {0: [], 1: [0, 3], 2: [0], 3: []}
    stage = dict(corpus_pipeline.STAGES)["line dedup"]
    kept = stage(spark, brute.documents(spark, texts), "").collect()
    assert {r["doc_id"]: r["text"] for r in kept} == {0: texts[0], 1: "All rights reserved!\n", 3: texts[3]}


# sets of n-grams

@pytest.mark.parametrize("ngram, pct", [(3, 90), (5, 80)])
@pytest.mark.parametrize("more", [{}, {"frequent": 4, "class_tokens": 3, "block": 5, "chunk": 2000}])
def test_similar_texts_against_brute_force(spark, ngram, pct, more):
    texts = brute.near_copies(seed=ngram)
    cfg = JoinConfig(ngram=ngram, similarity_pct=pct, **more)
    found = similar_groups(brute.documents(spark, texts), cfg=cfg).collect()
    expected = brute.similar(dict(enumerate(texts)), ngram, pct)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == expected
    assert len(found) == len(texts)
    assert {r["doc_id"]: r["n_links"] for r in found} == brute.link_counts(dict(enumerate(texts)), ngram, pct)


def test_candidates_that_are_not_similar_make_no_clusters(spark):
    """A chain of texts that share keys, no two of them similar: its pairs are checked, the chain is no cluster."""
    sets = {i: np.arange(50 * i, 50 * i + 100, dtype=np.uint64) for i in range(40)}
    sets[100] = np.append(sets[0][:-1], np.uint64(10**6))
    keys = {i: [i, i + 1] for i in range(39)} | {1000: [0, 100], 2000: [5, 6, 7]}
    led = spark.createDataFrame(
        [(k, rid, rids[0], len(rids)) for k, rids in keys.items() for rid in rids], "key long, rid long, first long, n long"
    )
    grams = spark.createDataFrame([(k, bytearray(v.tobytes())) for k, v in sets.items()], "rid long, grams binary")
    for block in (1500, 2):
        found = ngramjoin._clusters(led, grams, JoinConfig(block=block)).collect()
        assert {r["rid"]: r["component"] for r in found} == {0: 0, 100: 0, 5: 5, 6: 5, 7: 5}


def test_one_of_similar_texts_stays(spark):
    texts = brute.near_copies(seed=9)
    df = brute.documents(spark, texts).withColumns({n: F.lit(1) for n in ("_rid", "k0", "no_text", "_sum", "rid")})
    out = drop_similar(df)
    assert out.columns == df.columns
    groups = brute.similar(dict(enumerate(texts)), 5, 80)
    rows = {r["doc_id"]: r["text"] for r in out.collect()}
    assert rows == {k: texts[k] for k, (_, root) in groups.items() if k == root}
    assert drop_similar(df.limit(0)).count() == 0 and similar_groups(df.limit(0)).count() == 0


def test_repeated_and_null_keys(spark):
    text = "some words that are the same in all of these"
    rows = similar_groups(brute.documents(spark, [text, text, text, None], [7, 7, None, None])).collect()
    assert sorted(r["component_id"] for r in rows if r["n_shingles"]) == [7, 7, 7]
    assert len(drop_similar(brute.documents(spark, [text, text], [7, 7])).collect()) == 1


# windows

def stretches(rng, kind):
    symbols, base = rng.choice([2, 3, 60]), [rng.randrange(60) for _ in range(60)]
    found = []
    for _ in range(rng.randrange(1, 9)):
        at = rng.randrange(40)
        own = [x % symbols for x in base[at:at + rng.randrange(2, 40)]]
        for _ in range(rng.randrange(3)):
            own[rng.randrange(len(own))] = rng.randrange(symbols)
        found.append(bytes(own) if kind == "bytes" else b" ".join(b"w%d" % x for x in own))
    return Counter(found)


@pytest.mark.parametrize("kind", ["words", "bytes"])
def test_shards_against_brute_force(kind):
    rng = random.Random(11)
    for _ in range(150):
        times, length = stretches(rng, kind), rng.choice([3, 5, 9])
        contents = sorted(times)
        n = np.array([times[c] for c in contents])
        if kind == "words":
            found = fmindex.repeated_windows(contents, n, fmindex.SubstringConfig(length, probe=rng.choice([2, 8])))
        else:
            found = bwtmerge.repeated_strings(contents, n, bwtmerge.ByteConfig(length, parts=rng.choice([1, 2, 4])))
        split = [c.split() if kind == "words" else c for c in contents]
        every = [s for s, c in zip(split, contents) for _ in range(times[c])]
        gone = brute.repeated(every, length)
        first = np.cumsum([0, *[times[c] for c in contents[:-1]]])
        for c, own, spans, at in zip(contents, split, found, first):
            covered = {i for a, b in spans for i in range(a, b)}
            if times[c] > 1:
                assert covered == set(range(len(own)))
            else:
                assert covered == {i for i, g in enumerate(gone[at]) if g}


def window_texts(seed=12):
    rng = random.Random(seed)
    passage = brute.prose(rng, 60, 5000)
    texts = []
    for k in range(60):
        own = brute.prose(rng, rng.choice([5, 40, 150]), 5000)
        if k % 3 == 0:
            at = rng.randrange(len(own))
            own[at:at] = passage[rng.randrange(8):60 - rng.randrange(8)]
        if k % 10 == 1:
            own += own
        texts.append(rng.choice([" ", "\n", " \t "]).join(own))
    return [*texts, texts[3], None, "", "\x0b", "the " * 300, "é日本 " * 90]


@pytest.mark.parametrize("hot", [20_000, 3])
def test_words_against_brute_force(spark, hot, monkeypatch):
    texts = window_texts()
    monkeypatch.setattr(fmindex.SubstringConfig, "route", property(
        lambda self: RouteConfig(self.window, self.gram, True, hot=hot, chunk=4000, shard=800)
    ))
    cfg = fmindex.SubstringConfig(window=35)
    split = [brute.words(t) for t in texts]
    gone = brute.repeated(split, 35)
    found = {r["doc_id"]: r for r in fmindex.remove_repeats(brute.documents(spark, texts), ["doc_id"], cfg=cfg).collect()}
    assert len(found) == len(texts)
    for k, (own, g) in enumerate(zip(split, gone)):
        kept = b" ".join(w for w, x in zip(own, g) if not x)
        r = found[k]
        assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == (len(own), sum(g), hashlib.sha256(kept).hexdigest())


@pytest.mark.parametrize("hot", [20_000, 3])
def test_bytes_against_brute_force(spark, hot, monkeypatch):
    texts = window_texts(13)
    monkeypatch.setattr(bwtmerge.ByteConfig, "route", property(
        lambda self: RouteConfig(self.length, self.gram, False, hot=hot, chunk=9000, shard=9000)
    ))
    raw = [(t or "").encode() for t in texts]
    gone = brute.repeated(raw, 200)
    df = brute.documents(spark, texts)
    found = {r["doc_id"]: r for r in bwtmerge.remove_repeated_bytes(df, ["doc_id"]).collect()}
    for k, (own, g) in enumerate(zip(raw, gone)):
        kept = bytes(x for x, y in zip(own, g) if not y)
        runs = sum(1 for i, x in enumerate(g) if x and (i == 0 or not g[i - 1]))
        r = found[k]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (len(own), sum(g), runs)
        assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest()


def test_arithmetic_runs():
    rng = random.Random(3)
    for _ in range(200):
        places = sorted({(rng.randrange(2), rng.choice([rng.randrange(40), 3 * rng.randrange(12)])) for _ in range(rng.randrange(40))})
        runs = np.frombuffer(arithmetic_runs(places), np.int64).reshape(-1, 4).tolist()
        assert [(t, a + k * step) for t, a, step, n in runs for k in range(n)] == places
    assert len(arithmetic_runs([(0, 3 * k) for k in range(1000)])) == 4 * 8


def test_joined_intervals():
    rng = random.Random(4)
    for _ in range(200):
        rows = sorted((rng.randrange(3), a := rng.randrange(60), a + rng.randrange(1, 9)) for _ in range(rng.randrange(20)))
        found = joined(np.array(rows, np.int64).reshape(-1, 3)).tolist()
        expected = {(t, x) for t, a, b in rows for x in range(a, b)}
        assert {(t, x) for t, a, b in found for x in range(a, b)} == expected
        assert all(t != u or b < c for (t, _, b), (u, c, _) in zip(found, found[1:]))


def test_periodic_and_shared_long_texts(spark):
    """Texts of a megabyte that repeat themselves, and a passage in very many texts."""
    passage = " ".join(brute.prose(random.Random(5), 60, 5000))
    texts = ["a" * 1_000_000, "ab cd " * 150_000, *[f"{passage} x{k}" for k in range(3000)]]
    df = brute.documents(spark, texts).withColumns({n: F.lit(1) for n in ("k0", "_text", "n_words", "kept", "places")})
    keep = ["doc_id", "k0", "_text", "places"]
    words = {r["doc_id"]: r for r in fmindex.remove_repeats(df, keep, cfg=fmindex.SubstringConfig(window=35)).collect()}
    assert [words[k]["n_removed"] for k in (0, 1)] == [0, 300_000]
    assert {words[k]["n_removed"] for k in range(2, 3002)} == {60} and {words[k]["places"] for k in words} == {1}
    found = {r["doc_id"]: r for r in bwtmerge.remove_repeated_bytes(df, keep).collect()}
    assert [found[k]["n_removed"] for k in (0, 1)] == [1_000_000, 900_000]
    for k in range(2, 3002):  # the blank and the x behind the passage are in all of them, the digits not all
        assert len(passage.encode()) + 2 <= found[k]["n_removed"] <= found[k]["n_bytes"]


def test_windows_of_empty_and_keyless_tables(spark):
    df = brute.documents(spark, ["a b", None], [None, None])
    for remove in (fmindex.remove_repeats, bwtmerge.remove_repeated_bytes):
        assert remove(df.limit(0), ["doc_id"]).count() == 0
        assert [r["n_removed"] for r in remove(df, ["doc_id", "lang"]).collect()] == [0, 0]
