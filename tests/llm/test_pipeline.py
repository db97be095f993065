"""Each stage of the pipeline against brute force on what the stage before kept."""

import random

import corpus_pipeline
from eventguard.llm import decontaminate
from eventguard.llm.codec import decode_ids
from tests.llm import brute


def corpus(seed=21):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices(["tha", "on", "er", "ing", "re", "st"], k=rng.randint(1, 3))) for _ in range(900)]

    def prose(n):
        own = rng.choices(vocabulary, k=n)
        return "\n".join(" ".join(own[i:i + 12]) + "." for i in range(0, n, 12))

    items = [(i, " ".join(rng.choices(vocabulary, k=25))) for i in range(4)]
    clean = [prose(120) for _ in range(25)]
    near = [clean[k].replace(" ", " x ", 1) for k in range(4)]
    moved = ["\n".join(reversed(clean[k].split("\n"))) for k in range(4, 6)]
    leaked = [f"{prose(60)}\n{text}\n{prose(30)}" for _, text in items]
    shouted = " ".join(w.upper() + "!!" for w in prose(80).split())
    junk = [" ".join(w + "###" for w in prose(80).split()), shouted, "too short", "", None]
    return [*clean, *clean[:3], *near, *moved, *leaked, *junk], items


def test_stages(spark, tmp_path):
    texts, items = corpus()
    sf = str(tmp_path)
    brute.documents(spark, texts).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, kept = docs.columns, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        assert k == 4 or out.columns == columns
        out.write.parquet(f"{sf}/{k}")
        docs = spark.read.parquet(f"{sf}/{k}")
        kept.append({r["doc_id"]: r["text"] for r in docs.collect()} if k < 4 else None)
    good, lined, single, clean, _ = kept
    # Junk and short texts go, prose stays.
    assert good == {i: t for i, t in enumerate(texts) if i < len(texts) - 5}
    gone = brute.repeated_lines(good, 8, 0.8, 30)
    expected = {
        i: "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[i]) for i, t in good.items()
    }
    assert lined == {i: t for i, t in expected.items() if t.strip()}
    groups = brute.similar(lined, 5, 80)
    assert single == {i: t for i, t in lined.items() if groups[i][1] == i}
    lists = (decontaminate._PUNCTUATION, decontaminate._NUMBERS, decontaminate._UNITS)
    leaks = {d for d, _ in brute.leaks(single, dict(items), lists)}
    assert clean == {i: t for i, t in single.items() if i not in leaks}
    found = set(single) - set(clean)
    assert found == {i for i, t in enumerate(texts) if t and any(x in t for _, x in items)}
    back = {r["doc_id"]: r["text"] for r in decode_ids(docs, ["doc_id"]).collect()}
    assert back == clean
    assert {tuple(r) for r in corpus_pipeline.run(spark, sf).select("doc_id", "n_pieces").collect()} == {
        tuple(r) for r in docs.select("doc_id", "n_pieces").collect()
    }
