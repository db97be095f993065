"""Language, lattice, codec, pages and benchmark passages."""

import math
import random
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventguard.llm import decontaminate, lattice
from eventguard.llm.bwtmerge import remove_repeated_bytes
from eventguard.llm.codec import Encoder, decode_ids, encode_texts
from eventguard.llm.common import held_out
from eventguard.llm.decontaminate import LeakConfig, drop_leaks, find_leaks
from eventguard.llm.fmindex import remove_repeats
from eventguard.llm.html import extract_text, main_text
from eventguard.llm.langid import LangConfig, code_bits, grow_tree, learn, predict_language, _grams, _joined
from eventguard.llm.linededup import find_repeated_lines
from eventguard.llm.ngramjoin import similar_groups
from eventguard.llm.pieces import MARK, PieceTrie, load_vocabulary, marginals, expected_pieces, zipf_log
from tests.llm import brute

ODD = [None, "", "  a  b \n\n c▁d ▁", "日本 ẞ\U0001F600\x00\t x", "▁", " ", "\n", "wörd " * 3, "z" * 5000]


def test_held_out(spark):
    rows = spark.range(200).select("id", held_out(F.col("id"), 7).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 7 == 2) for r in rows)
    assert spark.range(1).select(held_out(F.lit(None).cast("long"), 7)).first()[0] is False


# language

def test_code_lengths_against_plain_python():
    texts = [b"the river and the house", b"", b"Then the end", "rivière été".encode()]
    levels = grow_tree(iter([texts[:2], texts[2:3]]), 4, 7)
    trees = brute.context_trees(texts[:3], 4)
    for text in texts:
        data, places, _ = _joined([text], 4)
        bits = code_bits(_grams(data, places, 4), levels).sum() if text else 0.0
        assert bits == pytest.approx(brute.ppm_bits(text, trees, 4), rel=1e-5)


def language_rows(seed=3):
    rng = random.Random(seed)
    parts = {"xx": "the th er on an re he in ed nd".split(), "yy": "ción que ado mente ar es la de os".split()}
    rows = []
    for k in range(200):
        lang = rng.choice(["xx", "yy"])
        text = " ".join("".join(rng.choices(parts[lang], k=rng.randint(1, 3))) for _ in range(20))
        rows.append((k, text, lang))
    return rows


def test_language_of_held_out_texts(spark):
    rows = language_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = learn(df.filter("doc_id % 4 != 2"), "text", "lang", LangConfig(sample_docs=60))
    found = predict_language(df, model, ["doc_id"]).collect()
    truth = {k: lang for k, _, lang in rows}
    assert all(r["lang_pred"] == truth[r["doc_id"]] and 0.5 <= r["score"] <= 1 for r in found)


def test_language_of_odd_texts(spark):
    df = spark.createDataFrame(language_rows(), "doc_id long, text string, lang string")
    nothing = learn(df.limit(0), "text", "lang", LangConfig())
    model = learn(df.withColumn("lang", F.when(F.col("doc_id") > 9, F.col("lang"))), "text", "lang", LangConfig())
    odd = brute.documents(spark, [*ODD, "12 34 !!", "12 34 !!"]).withColumns({"raw": F.lit(1), "letters": F.lit(2)})
    rows = predict_language(odd, model, ["doc_id", "raw", "letters"]).collect()
    assert len(rows) == len(ODD) + 2
    none = {r["doc_id"] for r in rows if r["lang_pred"] == "und"}
    assert none == {0, 1, 4, 5, 6, len(ODD), len(ODD) + 1}
    assert all(r["score"] == 0 for r in rows if r["doc_id"] in none)
    assert {r["lang_pred"] for r in predict_language(odd, nothing, ["doc_id"]).collect()} == {"und"}
    assert predict_language(odd.limit(0), model, ["doc_id"]).count() == 0


# lattice

def spellings(word, pieces):
    """All segmentations, as lists of log probabilities with the piece."""
    if not word:
        yield []
    for size in range(1, len(word) + 1):
        for piece in pieces.get(word[:size], ()):
            for rest in spellings(word[size:], pieces):
                yield [piece, *rest]


def test_lattice_sums_all_segmentations():
    vocabulary = load_vocabulary()
    trie, logp = PieceTrie(vocabulary), zipf_log(vocabulary)
    arcs = {}
    for i, piece in enumerate(vocabulary.pieces):
        if vocabulary.spells[i]:
            arcs.setdefault(piece, []).append((i, logp[i]))
    for i in vocabulary.byte_ids:
        arcs.setdefault(vocabulary.pieces[i], []).append((int(i), logp[i]))
    words = [MARK + w.encode() for w in ("a", "tion", "house", "é", "qzx")]
    every = [list(spellings(w, arcs)) for w in words]
    sums = [np.logaddexp.reduce([sum(p for _, p in s) for s in own]) for own in every]
    assert marginals(trie, logp, words) == pytest.approx(sums)
    used = expected_pieces(trie, logp, words, np.ones(len(words)))
    expected = Counter()
    for own, total in zip(every, sums):
        for s in own:
            for i, _ in s:
                expected[i] += math.exp(sum(p for _, p in s) - total)
    assert all(used[i] == pytest.approx(n) for i, n in expected.items())
    assert used.sum() == pytest.approx(sum(expected.values()))


def test_scores_against_plain_python(spark):
    rng = random.Random(5)
    texts = [" ".join(brute.prose(rng, rng.randint(1, 40), 60)) for _ in range(60)] + [None, "", "New\x0bWord İ"]
    df = brute.documents(spark, texts).withColumn("learning", ~held_out(F.col("doc_id"), 7))
    # A table of two words, so that nearly all go the way of a join.
    cfg = lattice.LatticeConfig(frequent=2, words_held=20)
    model = lattice.learn(df, "text", "learning", cfg)
    found = {r["doc_id"]: r for r in lattice.score_texts(df, model, ["doc_id"], cfg=cfg).collect()}
    tokens = {k: [*brute.words((t or "").encode().lower().decode()), b""] for k, t in enumerate(texts[:-1])}
    tokens[len(texts) - 1] = [b"new", b"word", "İ".encode(), b""]
    seen = Counter(w for k, own in tokens.items() if zlib.crc32(str(k).encode()) % 7 != 2 for w in own)
    n, v = sum(seen.values()), len(seen)
    assert model.tokens == n and model.types == v
    spelled = {bytes(r["word"]): r["spelled"] for r in model.lexicon.collect()} | {b"": model.end_spelled}
    for k, own in tokens.items():
        r = found[k]
        assert r["n_tokens"] == len(own) and r["n_known"] == sum(seen[w] > 0 for w in own)
        assert r["base_score"] == pytest.approx(sum(math.log10((seen[w] + 1) / (n + v + 1)) for w in own))
        score = sum(math.log10(
            max(seen[w] - model.discount, 0) / n + model.discount * v / n * 10 ** spelled[w]
        ) for w in own)
        assert r["score"] == pytest.approx(score)
    wide = lattice.score_texts(df, lattice.learn(df, "text", "learning"), ["doc_id"]).collect()
    assert all(r["score"] == pytest.approx(found[r["doc_id"]]["score"]) for r in wide)


def test_scores_without_texts(spark):
    df = brute.documents(spark, ["a b"]).withColumn("learning", F.lit(False))
    row = lattice.score_texts(df, lattice.learn(df, "text", "learning"), ["doc_id"]).first()
    assert row["n_known"] == 0 and math.isfinite(row["score"]) and math.isfinite(row["base_score"])
    empty = df.limit(0)
    assert lattice.score_texts(empty, lattice.learn(empty, "text", "learning"), ["doc_id"]).count() == 0


# codec

def test_round_trip(spark):
    df = brute.documents(spark, [*ODD, *ODD]).withColumns({"raw": F.lit(1), "ids2": F.lit(2)})
    encoded = encode_texts(df, ["doc_id", "raw", "ids2"])
    back = decode_ids(encoded, ["doc_id", "ids", "n_pieces"]).collect()
    for r in back:
        text = ODD[r["doc_id"] % len(ODD)]
        assert r["text"] == text
        assert (r["ids"] is None) == (text is None) and r["n_pieces"] == len(r["ids"] or [])
    assert encode_texts(df.limit(0), ["doc_id"]).count() == 0


def test_best_segmentation():
    encoder = Encoder(load_vocabulary())
    scores = {i: s for s, i in encoder.pieces.values()}
    rng = random.Random(6)
    words = sorted({" " * rng.randint(0, 2) + "".join(rng.choices("thenationéж日", k=rng.randint(1, 12))) for _ in range(200)})
    for word, ids in encoder.encode_words(words):
        text = word.replace(" ", "▁")
        best = [0.0]
        for end in range(1, len(text) + 1):
            ways = [best[i] + encoder.pieces[text[i:end]][0] for i in range(end) if text[i:end] in encoder.pieces]
            if text[end - 1] not in encoder.pieces:
                ways.append(best[end - 1] + encoder.byte_score * len(text[end - 1].encode()))
            best.append(max(ways))
        assert sum(scores.get(i, encoder.byte_score) for i in ids) == pytest.approx(best[-1])


# pages

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var a="</p>";</script></head>
<body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav>
<div class="ad">Buy now, this is a long advert that goes on and on without end in sight at all.</div><!-- x -->
<article><header><h1>Title &amp;
 more</h1></header><p><b>First   &eacute;&nbsp;text.<br><p>Of.<ul><li>one<li>two</ul><form><label>Mail</label><input></form>
<p>Last</p><section class="comments"><p>Great article, thank you for it, I have read it twice.</p></section></article>
<aside>Side</aside><footer>&copy; me</footer></body></html>"""


def test_main_text():
    assert main_text(PAGE) == "Title & more\n\nFirst é text.\n\nOf.\n\none\n\ntwo\n\nLast"
    assert main_text("") == "" and main_text("<p>") == "" and main_text("<script>x") == ""
    for cut in range(0, len(PAGE), 7):
        main_text(PAGE[:cut])  # cut off anywhere


def test_surge_and_dive_without_marked_article():
    long = "A sentence of some length that is the body of this page, with more words to follow."
    page = (
        f"<div id=menu><a>Home</a> | <a>News</a></div><div>Mon 3</div><h2>Head</h2><div>{long}</div><div>Short.</div>"
        f"<div>{long}</div><div class='cookie-notice'>We use cookies</div><ul><li><a>Link one</a></li><li><a>Link two</a>"
        "</li><li><a>Link three</a></li></ul><div class=footer>(c)</div>"
    )
    assert main_text(page) == "\n\n".join(["Head", long, "Short.", long])
    assert main_text("just text") == "just text"


def test_body_beside_marked_teasers():
    """The window sums decide on pages with a mark, too: a dense body outside of it is kept, stray lines are not."""
    long = "A sentence of some length that is the body of this page, with more words to follow."
    page = (
        f"<div>Mon 3</div><div><h2>Head</h2><p>{long}</p><p>Short.</p><p>{long}</p></div>"
        "<div><article><h3>Teaser</h3>More here</article><article>Other</article></div><div>Stray line</div>"
        "<p><a>Link that is long enough to weigh something if it were text and not all of it a link</a></p>"
    )
    assert main_text(page) == "\n\n".join(["Head", long, "Short.", long, "Teaser", "More here", "Other"])
    page = f"<div><p>{long}</p><p>{long}</p><article>An aside of its own</article><p>The end.</p></div>"
    assert main_text(page) == "\n\n".join([long, long, "An aside of its own", "The end."])


def test_surge_and_dive_in_marked_parts():
    """A marked part is kept where its weight surges, from there to where it dives."""
    long = "A sentence of some length that is the body of this page, with more words to follow."
    stray = f"<article><p>Hi</p></article><div><p>{long}</p><p>{long}</p></div>"
    assert main_text(stray) == "\n\n".join([long, long])
    menu = "<ul class=menu><li>One</li><li>Two</li><li>Three</li><li>Four</li></ul>"
    page = f"<main><p>Ad</p>{menu}<p>{long}</p><p>So.</p>{menu}<p>Up</p></main>"
    assert main_text(page) == "\n\n".join([long, "So."])
    # The same page without its mark.
    assert main_text(page.replace("main>", "div>")) == "\n\n".join([long, "So."])


@pytest.mark.parametrize("page", [
    "<a \"" * 100_000, "<div>x" * 20_000, "<b>" * 20_000 + "<p>x" * 20_000, "<i>" * 20_000 + "</b>x" * 20_000,
    "<script>" + "</script " * 50_000, "<" * 500_000, "<a " + "b='c " * 100_000, "<h1><b>x<p>" * 20_000,
    "&" * 500_000, "<a '\"" * 100_000, "<table><tr><td>x" * 10_000, "word " * 200_000,
], ids=range(12))
def test_long_broken_pages(page):
    begin = time.process_time()
    main_text(page)
    assert time.process_time() - begin < 5


def test_pages_with_clashing_columns(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, PAGE)], "page_id long, raw long, _raw long, other long, html string")
    row = extract_text(df, ["page_id", "raw", "_raw", "other"]).first()
    assert tuple(row)[:4] == (1, 2, 3, 4) and row["text"] == main_text(PAGE)


def test_pages_table(spark):
    df = spark.createDataFrame(
        [(1, "u", PAGE), (2, None, None), (None, "u", ""), (1, "u", PAGE)], "page_id long, url string, html string"
    )
    rows = extract_text(df, ["page_id", "url"]).collect()
    assert sorted(r["n_chars"] for r in rows) == sorted([0, 0, len(main_text(PAGE)), len(main_text(PAGE))])
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    assert extract_text(df.limit(0), ["page_id"]).count() == 0


# benchmark passages

ITEM = "Alice Smith buys 5 apples at the shop for 3 dollars and later gives Bob 2 of her apples; how many does she have left?"
OTHER = "Today Clara Jones buys 7 apples at the shop for 4 euros and later gives Dan 2 of her apples; how many does she have left?"
MIXED = "Today Clara Jones buys 7 apples at the shop for 4 euros and later gives Clara 2 of her apples; how many does she have left?"


def test_leaks(spark):
    rng = random.Random(8)
    noise = [" ".join(brute.prose(rng, 60)) for _ in range(20)]
    texts = [*noise, f"{noise[0]}\n{ITEM} {noise[1]}", OTHER, None, "", ITEM[:40], f"{noise[3]} {OTHER}"]
    bench = spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (4, "plain words"), (5, ITEM)], "item_id long, text string")
    df = brute.documents(spark, texts).withColumns({"raw": F.lit(1), "item": F.lit(2)})
    found = {(r["doc_id"], r["item_id"]): r["changed_slots"] for r in find_leaks(df, bench, ["doc_id", "raw"]).collect()}
    assert set(found) == {(k, i) for k in (20, 21, 25) for i in (1, 5)}
    assert found[20, 1] == 0 and found[21, 1] == 5
    for cfg in (LeakConfig(), LeakConfig(filter_bits=(1 << 16, 1 << 16), packed=1)):
        clean = drop_leaks(df, bench, cfg=cfg)
        assert clean.columns == df.columns
        assert {r["doc_id"] for r in clean.collect()} == set(range(len(texts))) - {20, 21, 25}
    assert drop_leaks(df.limit(0), bench).count() == 0
    assert find_leaks(df, bench.limit(0), ["doc_id"]).count() == 0 and drop_leaks(df, bench.limit(0)).count() == len(texts)


LISTS = (decontaminate._PUNCTUATION, decontaminate._NUMBERS, decontaminate._UNITS)


def questions(seed):
    """Items with slots, and texts that hold them whole, in part, with other values, or mixed up."""
    rng = random.Random(seed)
    names, units = ["Ann", "Bob", "Eve", "Dan"], ["km", "kg", "euros"]

    def word():
        kind = min(int(rng.expovariate(1.2)), 3)
        plain = rng.choice(["red", "the", "was", "old", "to", "far", "sees", "and"])
        return [plain, str(rng.randint(1, 9)), rng.choice(names), f"{rng.randint(1, 99)} {rng.choice(units)}"][kind]

    items = {k: " ".join(word() for _ in range(rng.choice([3, 5, 9, 16, 30]))) for k in range(25)}

    def changed(text):
        swap = dict(zip(names, rng.sample(names, 4)))
        out = [swap.get(w, str(int(w) + 1) if w.isdigit() and rng.random() < 0.9 else w) for w in text.split()]
        if rng.random() < 0.4:
            out[rng.randrange(len(out))] = rng.choice(["Ann", "7", "new"])
        return " ".join(out)

    texts = []
    for text in items.values():
        part = text.split()[rng.randrange(3):]
        texts += [changed(text), f"so {text.upper()} it.", "Then " + " ".join(part) + ".\n" + changed(text)]
    rng.shuffle(texts)
    return items, dict(enumerate([*texts, *texts[:5], None, "", "word"]))


@pytest.mark.parametrize("seed", [1, 2])
def test_leaks_against_brute_force(spark, seed):
    items, texts = questions(seed)
    expected = brute.leaks(texts, items, LISTS)
    assert len(expected) > 40
    bench = spark.createDataFrame([*items.items(), (77, None), (78, "")], "item_id long, text string")
    rows = find_leaks(brute.documents(spark, list(texts.values())), bench, ["doc_id"]).collect()
    found = {(r["doc_id"], r["item_id"]): (pytest.approx(r["share"]), r["changed_slots"]) for r in rows}
    assert len(rows) == len(found) and expected == found
    clean = drop_leaks(brute.documents(spark, list(texts.values())), bench).collect()
    assert sorted(r["doc_id"] for r in clean) == sorted(set(texts) - {d for d, _ in expected})


def test_leaks_with_odd_columns_and_long_texts(spark):
    """Clashing names, repeated rows, and a text of a million words in which an item lies."""
    bench = spark.createDataFrame([(1, ITEM), (1, ITEM)], "item_id long, text string")
    long = "so it goes " * 330_000 + ITEM
    df = brute.documents(spark, [long, long, "plain"]).withColumns({n: F.lit(1) for n in ("t1", "t2", "i1", "h", "maybe", "windows")})
    rows = find_leaks(df, bench, ["doc_id", "t1", "t2", "i1", "h"]).collect()
    assert sorted(r["doc_id"] for r in rows) == [0, 0, 1, 1] and {r["t1"] for r in rows} == {1}
    clean = drop_leaks(df, bench)
    assert clean.columns == df.columns and [r["doc_id"] for r in clean.collect()] == [2]
    named = find_leaks(df.withColumn("share", F.lit(-1)), bench, ["doc_id", "share"])
    assert named.columns == ["doc_id", "item_id", "share", "changed_slots"] and {r["share"] for r in named.collect()} == {1.0}


def test_results_go_before_kept_columns(spark):
    """A kept column with the name of a result gives way, in any case of letters."""
    df = brute.documents(spark, ["some text of words", "some text of words", None]).withColumns({
        n: F.lit(-1) for n in ("n_words", "SCORE", "n_pieces", "ids", "kept", "lang_pred", "n_bytes", "n_chars2", "learning")
    }).withColumn("learning", F.lit(True))
    keep = [c for c in df.columns if c not in ("text", "lang", "learning")]
    model = lattice.learn(df, "text", "learning")
    trees = learn(df, "text", "lang", LangConfig())
    results = {
        "score": lattice.score_texts(df, model, keep), "n_pieces": encode_texts(df, keep),
        "lang_pred": predict_language(df, trees, keep), "n_words": remove_repeats(df, keep), "n_bytes": remove_repeated_bytes(df, keep),
        "n_chars": extract_text(df, keep, html="text"),
    }
    for name, out in results.items():
        assert len({c.lower() for c in out.columns}) == len(out.columns)
        assert out.count() == 3 and -1 not in {r[name] for r in out.select(name).collect()}


def test_long_texts(spark):
    """Words of up to a million characters and a line of a million words."""
    texts = ["x" * 1_000_000, "日本" * 300_000, "ab cd ef " * 300_000, "the end"]
    df = brute.documents(spark, texts)
    begin = time.monotonic()
    back = decode_ids(encode_texts(df, ["doc_id"]), ["doc_id"]).collect()
    assert {r["doc_id"]: r["text"] for r in back} == dict(enumerate(texts))
    langs = predict_language(df, learn(df.filter("doc_id = 3"), "text", "lang", LangConfig()), ["doc_id"])
    assert {r["lang_pred"] for r in langs.collect()} == {"en"}
    cut = df.withColumn("text", F.when(F.col("doc_id") < 2, F.substring("text", 1, 10_000)).otherwise(F.col("text")))
    cut = cut.withColumn("learning", F.lit(True))
    scores = lattice.score_texts(cut, lattice.learn(cut, "text", "learning"), ["doc_id"]).collect()
    assert all(math.isfinite(r["score"]) for r in scores)
    assert {r["doc_id"]: r["n_tokens"] for r in scores} == {0: 2, 1: 2, 2: 900_001, 3: 3}
    assert {r["doc_id"]: r["removed"] for r in find_repeated_lines(df).collect()} == {k: [] for k in range(4)}
    groups = similar_groups(df.unionByName(df.withColumn("doc_id", F.col("doc_id") + 10))).collect()
    assert all(r["component_id"] == r["doc_id"] % 10 and r["n_links"] == 1 for r in groups)
    assert time.monotonic() - begin < 300


def test_slots_must_be_consistent(spark):
    """Names that are two in the item and one in the text are no renaming."""
    bench = spark.createDataFrame([(1, "we saw Ann meet Bob at the big old market in town before noon today")], "item_id long, text string")
    rows = ["we saw Eve meet Dan at the big old market in town before noon today",
            "we saw Eve meet Eve at the big old market in town before noon today"]
    found = find_leaks(brute.documents(spark, rows), bench, ["doc_id"], cfg=LeakConfig(share=0.9)).collect()
    assert [r["doc_id"] for r in found] == [0]


def test_copies_of_items_full_of_slots(spark):
    """Items of numbers or names are found as copies, and copies in other capitals."""
    items = ["What is 12 + 45 * 3?", "Who Painted The Mona Lisa In The Louvre",
             "the Haus by the Wald and the Berg by the See near the Dorf and the Wiese"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    texts = [f"so then {items[0]} is asked", f"we ask: {items[1]} today", items[1].lower(), items[2].lower(),
             "What is 13 + 46 * 4?", "When did Anna Visit The Tower In The City"]
    rows = find_leaks(brute.documents(spark, texts), bench, ["doc_id"]).collect()
    assert {(r["doc_id"], r["item_id"], r["changed_slots"]) for r in rows} == {
        (0, 0, 0), (1, 1, 0), (2, 1, 0), (3, 2, 0), (4, 0, 3),  # other numbers in all of the first item
    }


def test_runs_of_long_items(spark):
    """A part of an item is found from 13 words on, also beside a slot that does not fit."""
    rng = random.Random(12)
    words = brute.prose(rng, 60, 10**6)
    named = ["we", "saw", "Ann", "meet", "Bob", *brute.prose(rng, 30, 10**6)]
    bench = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(named))], "item_id long, text string")
    texts = ["x y " + " ".join(words[20:50]) + " z", " ".join(words[5:18]), " ".join(words[5:17]),
             " ".join(named).replace("Ann", "Eve").replace("Bob", "Eve")]
    rows = {(r["doc_id"], r["item_id"]): r["share"] for r in find_leaks(brute.documents(spark, texts), bench, ["doc_id"]).collect()}
    assert set(rows) == {(0, 1), (1, 1), (3, 2)}
    assert rows[0, 1] == pytest.approx(23 / 53) and rows[1, 1] == pytest.approx(6 / 53)
    assert {r["doc_id"] for r in drop_leaks(brute.documents(spark, texts), bench).collect()} == {2}
