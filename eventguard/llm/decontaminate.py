"""Benchmark passages in texts, also with other numbers, names or units.

Texts and benchmark items are brought to templates: words in lower case without outer
punctuation, with placeholders for numbers, for names (capitalised inside a sentence) and
for units behind a number. Windows of templates, and of the words themselves beside them,
are named by hashes in tasks on both sides and joined by hash. Where text and item line up,
the slots are compared: one value of the item must stand for one value of the text
throughout. An item is found in a text if enough of its windows are, a run of words that is
long enough, or all of an item that has few words besides its slots.

Before the join a filter of fixed size, made of the items' window hashes, leaves out nearly
all windows of texts that no item has; only texts with such windows go on, equal ones once.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from eventguard.llm.common import beside, fresh, in_chunks, stored, utf8

# Marks around words, units of measure, numbers in words, sentence ends; in
# English, German, French and Spanish.
_PUNCTUATION = " .,;:!?\"'()[]{}<>«»“”‘’„…*_`~|#&%$€£^=+/\\-–—¡¿·"
_UNITS = frozenset(
    "mm cm m km in ft inch inches foot feet yard yards mile miles meter meters metre metres kilometer"
    " kilometers g kg mg gram grams kilogram kilograms ton tons tonne tonnes oz lb lbs pound pounds"
    " ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hour"
    " hours day days week weeks month months year years cent cents dollar dollars euro euros percent"
    " degree degrees mph kmh km/h m/s w kw v a j kj mb gb tb kb"
    " sekunde sekunden minuten stunde stunden tag tage tagen woche wochen monat monate monaten jahr jahre"
    " jahren meile meilen gramm kilogramm kilo kilos tonnen prozent grad zoll pfund"
    " seconde secondes heure heures jour jours semaine semaines mois an ans année années mètre mètres"
    " kilomètre kilomètres gramme grammes kilogramme kilogrammes degré degrés pour-cent livre livres"
    " segundo segundos minuto minutos hora horas día días semana semanas mes meses año años metro metros"
    " kilómetro kilómetros gramo gramos kilogramo kilogramos litro litros tonelada toneladas grado grados"
    " milla millas libra libras".split()
)
_NUMBERS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
    " sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety"
    " hundred thousand million billion dozen"
    " null zwei drei vier fünf sechs sieben acht neun zehn elf zwölf dreizehn vierzehn fünfzehn sechzehn"
    " siebzehn achtzehn neunzehn zwanzig dreißig vierzig fünfzig sechzig siebzig achtzig neunzig hundert"
    " tausend dutzend"
    " deux trois quatre cinq sept huit neuf dix onze douze treize quatorze quinze seize vingt trente"
    " quarante cinquante soixante cent mille douzaine"
    " dos tres cuatro cinco seis siete ocho nueve diez once doce trece catorce quince dieciséis veinte"
    " treinta cuarenta cincuenta sesenta setenta ochenta noventa cien ciento mil docena".split()
)
_ENDS = (".", "!", "?", ":", "\0")
_NUMBER = re.compile(r"\d[\d.,:/]*(?:[a-z%°]{0,4})")
_BREAK = " \0 "
WORD, NUM, NAME, UNIT = 0, 1, 2, 3
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class LeakConfig:
    window: int = 8
    # Items with fewer words than this are too plain to be told from ordinary text.
    least_words: int = 4
    # Share of an item's windows that must be found.
    share: float = 0.5
    # Words on end of which an item is found whatever its share.
    run: int = 13
    # Words besides slots that an item needs to be found by its template where that is mostly slots.
    plain: int = 2
    words_held: int = 400_000
    # Bits of the filter: least and most. Beyond the most, more windows go to the join in vain.
    filter_bits: tuple[int, int] = (1 << 24, 1 << 29)
    # Windows of texts in one task of the comparison, about.
    packed: int = 20_000


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text)


_SLOT_HASH = {NUM: _hash("\0num"), NAME: _hash("\0name"), UNIT: _hash("\0unit")}


class Templates:
    """Turns texts into arrays of template words, remembering the words seen."""

    def __init__(self, held: int):
        self.held = held
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.values: list[str] = []
        self.hashes: list[int] = []
        self.literal: list[int] = []  # of the values, also where a placeholder stands
        self.kinds: list[int] = []
        self.flags: list[int] = []  # 1: may be a name, 2: may be a unit, 4: ends a sentence, 8: no word

    def _learn(self, raw: str) -> None:
        bare = raw.strip(_PUNCTUATION)
        value = bare.lower()
        kind, flags = WORD, 0
        if not bare or bare == "\0":
            flags |= 8
        elif value in _NUMBERS or _NUMBER.fullmatch(value):
            kind = NUM
        else:
            if value in _UNITS:
                flags |= 2
            if len(bare) > 1 and bare[0].isupper() and bare[1:] == bare[1:].lower():
                flags |= 1
        if raw.endswith(_ENDS):
            flags |= 4
        self.place[raw] = len(self.values)
        self.values.append(value)
        self.literal.append(_hash(value))
        self.hashes.append(_SLOT_HASH[NUM] if kind == NUM else self.literal[-1])
        self.kinds.append(kind)
        self.flags.append(flags)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of all texts behind each other: word places, template hashes, kinds, owners."""
        if len(self.place) > self.held:
            self._forget()
        split = [text.replace("\n", _BREAK).split() for text in texts]
        place = self.place
        for words in split:
            for raw in words:
                if raw not in place:
                    self._learn(raw)
        sizes = [len(words) for words in split]
        ids = np.fromiter((place[w] for words in split for w in words), np.int64, sum(sizes))
        owner = np.repeat(np.arange(len(texts)), sizes)
        flags = np.array(self.flags, np.int8)[ids]
        # The first word of a text and one behind a sentence end may be capitalised anyway.
        opens = np.ones(len(ids), bool)
        opens[1:] = ((flags[:-1] & 4) > 0) | (owner[1:] != owner[:-1])
        real = (flags & 8) == 0
        ids, owner, flags, opens = ids[real], owner[real], flags[real], opens[real]
        kinds = np.array(self.kinds, np.int8)[ids]
        kinds[((flags & 1) > 0) & ~opens & (kinds == WORD)] = NAME
        behind = np.zeros(len(ids), bool)
        behind[1:] = (kinds[:-1] == NUM) & (owner[1:] == owner[:-1])
        kinds[((flags & 2) > 0) & behind & (kinds == WORD)] = UNIT
        hashes = np.array(self.hashes, np.uint64)[ids]
        for kind in (NAME, UNIT):
            hashes[kinds == kind] = np.uint64(_SLOT_HASH[kind])
        return ids, hashes, kinds, owner


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of the `width` words from each place on."""
    n = max(len(hashes) - width + 1, 0)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = (out ^ (out >> np.uint64(29))) * _MIX + hashes[k:k + n]
    return out


def _kinds_of_windows(
    templates: Templates, ids: np.ndarray, hashes: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the windows of template words, and of the words themselves; no two kinds or widths share any."""
    literal = np.array(templates.literal, np.uint64)[ids]
    salts = [np.uint64((2 * width + k) * int(_MIX) % (1 << 64)) for k in (0, 1)]
    return window_hashes(hashes, width) ^ salts[0], window_hashes(literal, width) ^ salts[1]


_NAME = "i1 long, i2 long"
_ITEM_WINDOWS = f"{_NAME}, h long, literal boolean, start int, width int, usable boolean, n_usable int, n int, plain int, slots array<string>"


def item_windows(benchmark: DataFrame, text: str, cfg: LeakConfig) -> DataFrame:
    """A row for every window of every different item, with what of the item its text is held against.

    A window is usable unless it is mostly placeholders; `plain` counts an item's other words.
    """
    texts = benchmark.select(F.col(text).alias("text")).dropna().distinct().select(*_named("text"), utf8(F.col("text")).alias("_raw"))

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = Templates(cfg.words_held)
        for part in parts:
            for chunk, raws in in_chunks(part, "_raw"):
                for i1, i2, raw in zip(chunk.column("i1").to_pylist(), chunk.column("i2").to_pylist(), raws):
                    ids, hashes, kinds, _ = templates([raw.decode()])
                    if len(ids) < cfg.least_words:
                        continue
                    width = min(cfg.window, len(ids))
                    slot = kinds != WORD
                    usable = 2 * np.convolve(slot, np.ones(width, int), "valid") <= width
                    n, plain, n_usable = len(usable), int((~slot).sum()), int(usable.sum())
                    rows = []
                    for literal, keys in zip((False, True), _kinds_of_windows(templates, ids, hashes, width)):
                        for at, key in enumerate(keys.view(np.int64).tolist()):
                            slots = [] if literal else _slots(templates, ids, kinds, at, width)
                            rows.append((i1, i2, key, literal, at, width, bool(usable[at]), n_usable, n, plain, slots))
                    yield _batch(rows, _ITEM_KINDS)

    return stored(texts.mapInArrow(cut, _ITEM_WINDOWS), "itemwindows")


_ITEM_KINDS = {
    "i1": pa.int64(), "i2": pa.int64(), "h": pa.int64(), "literal": pa.bool_(), "start": pa.int32(), "width": pa.int32(),
    "usable": pa.bool_(), "n_usable": pa.int32(), "n": pa.int32(), "plain": pa.int32(), "slots": pa.list_(pa.string()),
}


def _batch(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds.values())]
    return pa.RecordBatch.from_arrays(columns, names=list(kinds))


def _named(text: str, a: str = "i1", b: str = "i2") -> list[Column]:
    """Two hashes that name a text."""
    return [F.xxhash64(text).alias(a), F.xxhash64(F.lit("again"), F.col(text)).alias(b)]


def _slots(templates: Templates, ids: np.ndarray, kinds: np.ndarray, at: int, width: int) -> list[str]:
    """The values behind a window's placeholders, each with its kind in front."""
    own = kinds[at:at + width]
    return [f"{own[k]}{templates.values[ids[at + k]]}" for k in np.flatnonzero(own != WORD).tolist()]


def _probes(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    mask = np.uint64(bits - 1)
    return [hashes & mask, (hashes >> np.uint64(17)) & mask, (hashes >> np.uint64(34)) & mask]


class Filter:
    """Which window hashes may be among those of the items."""

    def __init__(self, words: np.ndarray, bits: int):
        self.words, self.bits = words, bits

    def maybe(self, hashes: np.ndarray) -> np.ndarray:
        """Places of the hashes that may be known."""
        left = np.arange(len(hashes))
        mixed = (hashes ^ (hashes >> np.uint64(31))) * _MIX
        for probe in _probes(mixed, self.bits):
            at = probe[left]
            left = left[(self.words[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1]
        return left


def window_filter(windows: DataFrame, n: int, cfg: LeakConfig) -> Filter:
    """The filter of all window hashes, of a size between the given bounds; made in parts by tasks."""
    least, most = cfg.filter_bits
    bits = min(most, max(least, 1 << (32 * n).bit_length()))
    size = 1 << 13  # bytes of a part

    def fill(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros(bits // 8, np.uint8)
        for part in parts:
            hashes = part.column("h").to_numpy().view(np.uint64)
            for probe in _probes((hashes ^ (hashes >> np.uint64(31))) * _MIX, bits):
                np.bitwise_or.at(words, probe >> np.uint64(3), np.uint8(1) << (probe & np.uint64(7)).astype(np.uint8))
        blocks = words.reshape(-1, size)
        filled = np.flatnonzero(blocks.any(axis=1))
        for some in np.array_split(filled, len(filled) // 1000 + 1):
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()), pa.array([blocks[k].tobytes() for k in some], pa.binary())], names=["part", "bits"]
            )

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        both = np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in rows["bits"]])
        return pd.DataFrame({"part": [rows["part"].iloc[0]], "bits": [both.tobytes()]})

    words = np.zeros((bits // 8 // size, size), np.uint8)
    made = windows.select("h").mapInArrow(fill, "part int, bits binary").groupBy("part").applyInPandas(join, "part int, bits binary")
    for row in made.toLocalIterator():
        words[row["part"]] = np.frombuffer(row["bits"], np.uint8)
    return Filter(words.reshape(-1), bits)


class _Texts:
    """The windows of texts that pass the filter."""

    def __init__(self, sent: Broadcast, widths: list[int], cfg: LeakConfig):
        self.sent, self.widths, self.templates = sent, widths, Templates(cfg.words_held)

    def windows(self, raws: list[bytes]) -> tuple[np.ndarray, list[tuple]]:
        """The text of each such window, and its hash, kind, place and slots."""
        ids, hashes, kinds, owner = self.templates([raw.decode() for raw in raws])
        first = np.searchsorted(owner, np.arange(len(raws)))
        owners, found = [np.zeros(0, np.int64)], []
        for width in self.widths:
            if len(ids) < width:
                continue
            inside = owner[:len(owner) - width + 1] == owner[width - 1:]
            for literal, keys in zip((False, True), _kinds_of_windows(self.templates, ids, hashes, width)):
                at = self.sent.value.maybe(keys)
                at = at[inside[at]]
                owners.append(owner[at])
                for place, key in zip(at.tolist(), keys[at].view(np.int64).tolist()):
                    slots = [] if literal else _slots(self.templates, ids, kinds, place, width)
                    found.append((key, literal, place - int(first[owner[place]]), slots))
        return np.concatenate(owners), found


_WINDOW = pa.struct([("h", pa.int64()), ("literal", pa.bool_()), ("place", pa.int32()), ("slots", pa.list_(pa.string()))])


def _candidates(texts: DataFrame, sent: Broadcast, widths: list[int], cfg: LeakConfig) -> DataFrame:
    """t1, t2, windows: the different texts with windows that may be an item's, and those windows."""
    rows = texts.select(*_named("text", "t1", "t2"), utf8(F.col("text")).alias("_raw"))

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = _Texts(sent, widths, cfg)
        for part in parts:
            for chunk, raws in in_chunks(part, "_raw"):
                owner, found = mine.windows(raws)
                lists: dict[int, list] = defaultdict(list)
                for k, window in zip(owner.tolist(), found):
                    lists[k].append(dict(zip(("h", "literal", "place", "slots"), window)))
                take = pa.array(list(lists), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [chunk.column("t1").take(take), chunk.column("t2").take(take), pa.array(list(lists.values()), pa.list_(_WINDOW))],
                    names=["t1", "t2", "windows"],
                )

    kind = "array<struct<h: long, literal: boolean, place: int, slots: array<string>>>"
    return rows.mapInArrow(cut, f"t1 long, t2 long, windows {kind}").dropDuplicates(["t1", "t2"])


def _consistent(windows: list[tuple[list[str], list[str]]]) -> tuple[bool, int]:
    """Whether values map one to one over (item's slots, text's slots) of windows, and how many changed."""
    there: dict[str, str] = {}
    back: dict[str, str] = {}
    for mine, other in windows:
        for a, b in zip(mine, other):
            if there.setdefault(a, b) != b or back.setdefault(b, a) != a:
                return False, 0
    return True, sum(a != b for a, b in there.items())


def _longest_run(starts: set[int], width: int) -> int:
    """Words on end that windows from these places cover."""
    longest, first, end = 0, 0, -1
    for at in sorted(starts):
        if at > end:
            first = at
        end = at + width
        longest = max(longest, end - first)
    return longest


def judged(
    windows: list[tuple], width: int, n_usable: int, n: int, plain: int, cfg: LeakConfig
) -> tuple[float, int] | None:
    """Share of an item's windows in a text and changed slots, or None if the item is not in it.

    `windows`: (shift, start, literal, usable, item's slots, text's slots) of those that meet.
    Windows of one shift line up; those that read the same hold whatever the others do.
    """
    shifts: dict[int, list[tuple]] = defaultdict(list)
    for shift, *window in windows:
        shifts[shift].append(window)
    good: set[int] = set()
    same: set[int] = set()
    slots = longest = 0
    whole = False
    for own in shifts.values():
        equal = {start for start, literal, _, _, _ in own if literal}
        alike = [w for w in own if not w[1]]
        starts = {w[0] for w in alike}
        # Windows that are mostly slots count only where the whole item lines up.
        all_there = len(starts) == n and plain >= cfg.plain
        if not all_there:
            alike = [w for w in alike if w[2]]
        fits, changed = _consistent([(w[3], w[4]) for w in alike])
        held = set(equal)
        if fits and alike:
            held |= {w[0] for w in alike}
            slots = max(slots, changed)
            whole |= all_there
        same |= equal
        good |= {start for start, _, usable, _, _ in own if usable and start in held}
        longest = max(longest, _longest_run(held, width))
    share = 1.0 if whole else max(len(good) / n_usable if n_usable else 0.0, len(same) / n)
    return (share, slots) if share >= cfg.share or longest >= cfg.run else None


def _found(texts: DataFrame, windows: DataFrame, cfg: LeakConfig) -> DataFrame:
    """t1, t2, i1, i2, share, changed_slots: the items in each different text."""
    context = texts.sparkSession.sparkContext
    widths = sorted(r["width"] for r in windows.select("width").distinct().collect())  # at most `window` of them
    n = windows.count()
    sent = context.broadcast(window_filter(windows, n, cfg))
    candidates = stored(_candidates(texts, sent, widths, cfg), "candidates")
    each = candidates.select("t1", "t2", F.explode("windows").alias("w")).select("t1", "t2", "w.*")
    met = each.withColumnRenamed("slots", "other").join(windows, ["h", "literal"])
    total = candidates.agg(F.sum(F.size("windows"))).first()[0] or 0
    packs = max(1, total // cfg.packed)
    packed = met.withColumn("pack", F.pmod(F.xxhash64("t1", "i1"), F.lit(packs)))
    names = ["t1", "t2", "i1", "i2"]

    def judge(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for name, own in rows.groupby(names, sort=False):
            one = own.iloc[0]
            verdict = judged(
                list(zip(own["place"] - own["start"], own["start"], own["literal"], own["usable"], own["slots"], own["other"])),
                int(one["width"]), int(one["n_usable"]), int(one["n"]), int(one["plain"]), cfg,
            )
            if verdict:
                out.append((*name, *verdict))
        return pd.DataFrame(out, columns=[*names, "share", "changed_slots"])

    return packed.groupBy("pack").applyInPandas(judge, f"t1 long, t2 long, {_NAME}, share double, changed_slots int")


def find_leaks(
    df: DataFrame, benchmark: DataFrame, keep: list[str], text: str = "text",
    item: str = "item_id", item_text: str = "text", cfg: LeakConfig = LeakConfig(),
) -> DataFrame:
    """A row for each text and item found in it.

    The `keep` columns, item_id, `share` of the item's windows found and `changed_slots`, the
    number of its numbers, names and units that read differently. The share is below
    `cfg.share` where a run of `cfg.run` words was found. Null and empty texts have
    no items; null, empty and too short items (`least_words`) are found nowhere, and items of
    fewer than `plain` words besides their slots only as copies or by windows that are not
    mostly slots. Equal items are all named, and repeated rows of df each get their rows.
    A kept column that is called like a result gives way to it.
    """
    keep = beside(keep, "item_id", "share", "changed_slots")
    windows = item_windows(benchmark, item_text, cfg)
    texts = df.select(F.col(text).alias("text"))
    found = stored(_found(texts, windows, cfg), "leaks")
    items = benchmark.select(F.col(item).alias("item_id"), *_named(item_text))
    t1, t2 = fresh(df.select(*keep), "t1", "t2")
    named = found.join(items, ["i1", "i2"]).select(
        F.col("t1").alias(t1), F.col("t2").alias(t2), "item_id", "share", "changed_slots"
    )
    rows = df.select(*keep, *_named(text, t1, t2))
    return rows.join(named, [t1, t2]).select(*keep, "item_id", "share", "changed_slots")


def drop_leaks(
    df: DataFrame, benchmark: DataFrame, text: str = "text",
    item: str = "item_id", item_text: str = "text", cfg: LeakConfig = LeakConfig(),
) -> DataFrame:
    """The rows of df whose text holds no item of the benchmark, with all their columns."""
    windows = item_windows(benchmark, item_text, cfg)
    found = stored(_found(df.select(F.col(text).alias("text")), windows, cfg).select("t1", "t2").distinct(), "leaks")
    t1, t2, maybe = fresh(df, "t1", "t2", "maybe")
    sent = df.sparkSession.sparkContext.broadcast(window_filter(found.select(F.col("t1").alias("h")), found.count(), cfg))

    @F.pandas_udf("boolean")
    def passes(names: pd.Series) -> pd.Series:
        out = np.zeros(len(names), bool)
        out[sent.value.maybe(names.to_numpy().view(np.uint64))] = True
        return pd.Series(out)

    # Texts that the filter clears stay where they are; only the others move for the join.
    rows = df.select("*", *_named(text, t1, t2)).withColumn(maybe, passes(t1))
    rest = rows.filter(maybe).join(found.withColumnsRenamed({"t1": t1, "t2": t2}), [t1, t2], "left_anti")
    return rows.filter(~F.col(maybe)).select(*df.columns).unionByName(rest.select(*df.columns))
