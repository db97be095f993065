"""The operators worked out one text at a time in plain Python."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").encode())


def documents(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, SCHEMA)


def prose(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def near_copies(seed, groups=12, vocabulary=2000):
    """Texts with exact and near copies in groups of very different size, and short ones."""
    rng = random.Random(seed)
    passage = prose(rng, 30, vocabulary)
    texts = [None, "", " \n ", "One", "one", "two words", "Two Words", "a b c", "A b c"]
    for g in range(groups):
        base = prose(rng, rng.choice([12, 40, 90, 200]), vocabulary)
        if g % 3 == 0:
            base = base[:10] + passage + base[10:]
        for _ in range(rng.choice([1, 2, 5, 25])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(copy))
    rng.shuffle(texts)
    return texts


def shingles(text, n):
    w = words((text or "").encode().lower().decode())
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} - {()}


def components(keys, linked):
    """The smallest key that each key reaches."""
    parent = {k: k for k in keys}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in linked:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {k: root(k) for k in keys}


def similar(texts, n, pct):
    """doc -> (size, component); texts: {doc: text}."""
    sets = {k: shingles(t, n) for k, t in texts.items()}
    keys = sorted(sets)
    linked = [
        (a, b) for i, a in enumerate(keys) for b in keys[:i]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= pct * len(sets[a] | sets[b])
    ]
    found = components(keys, linked)
    return {k: (len(sets[k]), found[k]) for k in keys}


def link_counts(texts, n, pct):
    """doc -> number of other documents it is linked to."""
    sets = {k: shingles(t, n) for k, t in texts.items()}
    return {
        a: sum(1 for b in sets if b != a and x and sets[b] and 100 * len(x & sets[b]) >= pct * len(x | sets[b]))
        for a, x in sets.items()
    }


def repeated(sequences, length):
    """Which places of each sequence a window covers that starts more than once."""
    count = Counter(tuple(s[i:i + length]) for s in sequences for i in range(len(s) - length + 1))
    out = []
    for s in sequences:
        gone = [False] * len(s)
        for i in range(len(s) - length + 1):
            if count[tuple(s[i:i + length])] > 1:
                gone[i:i + length] = [True] * length
        out.append(gone)
    return out


def counts(text):
    w = [x.decode() for x in words(text)]
    text = text or ""
    three = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i in range(len(w) - 2) if three[tuple(w[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if words(x)]
    return (
        len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)
    )


def repeated_lines(texts, shingle, similarity, least):
    """{doc: lines that go}; texts: {doc: text}."""
    places = defaultdict(list)
    for doc in sorted(texts):
        for k, line in enumerate((texts[doc] or "").split("\n")):
            if len(line) >= least:
                places[line].append((doc, k))
    lines = sorted(places)
    sets = [{x[i:i + shingle] for i in range(len(x) - shingle + 1)} for x in lines]
    linked = [
        (a, b) for a in range(len(lines)) for b in range(a)
        if len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b])
    ]
    groups = defaultdict(list)
    for k, root in components(range(len(lines)), linked).items():
        groups[root] += places[lines[k]]
    gone = defaultdict(list)
    for members in groups.values():
        for doc, k in sorted(members)[1:]:
            gone[doc].append(k)
    return {doc: sorted(gone[doc]) for doc in texts}


def ppm_bits(text, trees, order):
    """Code length of a text from {context: Counter of next bytes}."""
    data, total = b"\0" * order + text.lower(), 0.0
    for i in range(order, len(data)):
        for k in range(order, -1, -1):
            seen = trees.get(data[i - k:i])
            if seen is None:
                continue
            n, kinds = sum(seen.values()), len(seen)
            if data[i] in seen:
                total += math.log2((n + kinds) / seen[data[i]])
                break
            total += math.log2((n + kinds) / kinds)
        else:
            total += 8
    return total


def context_trees(texts, order):
    trees = defaultdict(Counter)
    for text in texts:
        data = b"\0" * order + text.lower()
        for i in range(order, len(data)):
            for k in range(order + 1):
                trees[data[i - k:i]][data[i]] += 1
    return trees


def template(text, marks, numbers, units):
    """(word, kind) of a text, kind one of w, number, name, unit; by the rules of the operator's description."""
    out, opens, after_number = [], True, False
    for line in (text or "").split("\n"):
        for raw in line.split():
            bare = raw.strip(marks)
            ends = raw[-1] in ".!?:"
            if bare:
                low = bare.lower()
                if low in numbers or re.fullmatch(r"\d[\d.,:/]*[a-z%°]{0,4}", low):
                    kind = "number"
                elif len(bare) > 1 and bare[0].isupper() and bare[1:] == bare[1:].lower() and not opens:
                    kind = "name"
                elif low in units and after_number:
                    kind = "unit"
                else:
                    kind = "w"
                out.append((low, kind))
                after_number = kind == "number"
                opens = ends
            else:
                opens = ends
        opens = True
    return out


def leaks(texts, items, lists, window=8, share=0.5, run=13, least=4, plain=2):
    """{(text, item): (share, changed slots)}; texts, items: {key: text}. Every place is tried."""
    shapes = {k: template(t, *lists) for k, t in texts.items()}
    found = {}
    for i, item in items.items():
        own = template(item, *lists)
        if len(own) < least:
            continue
        width = min(window, len(own))
        starts = range(len(own) - width + 1)
        slots = [sum(kind != "w" for _, kind in own[s:s + width]) for s in starts]
        usable = [s for s in starts if 2 * slots[s] <= width]
        words = sum(kind == "w" for _, kind in own)
        for d, shape in shapes.items():
            good, same, best, changed, whole = set(), set(), 0, 0, False
            for shift in range(-len(own), len(shape)):
                def fits(s, alike):
                    a, b = own[s:s + width], shape[max(s + shift, 0):s + shift + width]
                    return s + shift >= 0 and len(b) == width and all(alike(x, y) for x, y in zip(a, b))
                equal = {s for s in starts if fits(s, lambda x, y: x[0] == y[0])}
                alike = {s for s in starts if fits(s, lambda x, y: x[1] == y[1] and (x[1] != "w" or x[0] == y[0]))}
                entire = len(alike) == len(starts) and words >= plain
                if not entire:
                    alike &= set(usable)
                pairs = {
                    (own[k], shape[k + shift]) for s in alike for k in range(s, s + width) if own[k][1] != "w"
                }
                if len({a for a, _ in pairs}) == len(pairs) == len({b for _, b in pairs}) and alike:
                    changed = max(changed, sum(a[0] != b[0] for a, b in pairs))
                    whole |= entire
                    held = equal | alike
                else:
                    held = equal
                good |= held & set(usable)
                same |= equal
                covered = {k for s in held for k in range(s, s + width)}
                length = 0
                for k in range(len(own) + 1):
                    length = length + 1 if k in covered else 0
                    best = max(best, length)
            part = 1.0 if whole else max(len(good) / len(usable) if usable else 0.0, len(same) / len(starts))
            if part >= share or best >= run:
                found[d, i] = (part, changed)
    return found
