"""Quality by weak supervision: rules vote or abstain, and their votes are weighed.

Each rule looks at one count of a text and votes good, bad or not at all. How often a rule
votes which way on good and on bad texts is estimated from all texts by
expectation-maximisation (no labels); a text's posterior probability of being good decides.
Everything is column code. The estimation works on counts of vote patterns, of which there
are at most 3 to the number of rules, whatever the number of texts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from eventguard.llm.common import SPACE, fresh, let, stored

GOOD, BAD, NONE = 1, -1, 0
WAYS = (GOOD, BAD, NONE)
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_clean", "n_letters", "n_upper", "n_marks", "n_lines"]


@dataclass(frozen=True)
class QualityConfig:
    shortest: int = 50
    most_repeated_pct: int = 50
    # Most rounds of estimation; it ends sooner when the share of good texts moves less than this.
    rounds: int = 20
    settled: float = 1e-6
    # What is believed before any text was seen, with the weight of this share of the texts:
    # how often a rule votes good, bad or not at all on texts of either class.
    prior_weight: float = 0.01
    on_good: tuple[float, float, float] = (0.60, 0.01, 0.39)
    on_bad: tuple[float, float, float] = (0.40, 0.30, 0.30)
    keep_from: float = 0.5


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def _without(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, "")).cast("long")


def _repeated(w: Column) -> Column:
    """Words that lie in a window of three words found at least twice in the text.

    Windows are compared by their 64-bit hash. They are sorted with their places, so
    that equal ones are neighbours.
    """
    places = F.when(F.size(w) > 2, F.sequence(F.lit(0), F.size(w) - 3)).otherwise(
        F.array().cast("array<int>")
    )
    windows = F.array_sort(F.transform(places, lambda i: F.struct(
        F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")
    )))
    twice = let(windows, lambda s: F.array_sort(F.transform(
        F.filter(s, lambda e, i: (e["h"] == F.get(s, i - 1)["h"]) | (e["h"] == F.get(s, i + 1)["h"])),
        lambda e: e["i"],
    )))
    return let(twice, lambda p: F.aggregate(
        F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3)))),
        F.lit(0).cast("long"), lambda total, x: total + x,
    ))


def counts(text: Column) -> Column:
    """The counts of a text as one struct. A null text counts as empty."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))

    def of_words(w: Column) -> Column:
        clean = F.filter(w, lambda x: x.rlike(r"^\p{L}+[.,;:]?$"))
        return F.struct(
            F.size(w).cast("long").alias("n"), _repeated(w).alias("r"),
            F.size(clean).cast("long").alias("c"),
        )

    def of_lines(ls: Column) -> Column:
        n = F.size(ls)
        return F.struct(n.cast("long").alias("n"), (n - F.size(F.array_distinct(ls))).cast("long").alias("d"))

    return let(
        F.struct(let(words(text), of_words).alias("w"), let(lines, of_lines).alias("l"),
                 F.length(text).cast("long").alias("n")),
        lambda c: F.struct(
            c["w"]["n"].alias("n_words"),
            _without(text, SPACE + "+").alias("word_chars"),
            (c["n"] - _without(text, r"[#*$%&|<>]+")).alias("n_symbols"),
            c["l"]["d"].alias("n_dup_lines"),
            c["w"]["r"].alias("n_repeat_words"),
            c["w"]["c"].alias("n_clean"),
            (c["n"] - _without(text, r"\p{L}+")).alias("n_letters"),
            (c["n"] - _without(text, r"\p{Lu}+")).alias("n_upper"),
            (c["n"] - _without(text, r"[!?]+")).alias("n_marks"),
            c["l"]["n"].alias("n_lines"),
        ),
    )


def base_failed(c: Column, cfg: QualityConfig) -> Column:
    return (c["n_words"] < cfg.shortest) | (
        100 * c["n_repeat_words"] > cfg.most_repeated_pct * c["n_words"]
    )


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, F.lit(BAD)).when(good, F.lit(GOOD)).otherwise(F.lit(NONE))


def votes(c: Column, cfg: QualityConfig) -> list[Column]:
    """One vote per rule; several look at the same kind of fault. An empty text gets none good."""
    w, chars, lines = c["n_words"], c["word_chars"], c["n_lines"]

    def above(part: Column, whole: Column, good_below: int, bad_from: int) -> Column:
        return _vote(100 * part > bad_from * whole, (whole > 0) & (100 * part < good_below * whole))

    return [
        above(c["n_repeat_words"], w, 10, 30),
        above(c["n_symbols"], w, 5, 20),
        above(chars - c["n_letters"], chars, 8, 20),
        above(w - c["n_clean"], w, 15, 50),
        above(c["n_upper"], c["n_letters"], 15, 35),
        above(c["n_marks"], w, 10, 30),
        above(c["n_dup_lines"], lines, 10, 50),
        _vote((chars < 2 * w) | (chars > 15 * w), (chars >= 3 * w) & (chars <= 10 * w) & (w > 0)),
    ]


@dataclass(frozen=True)
class QualityModel:
    """share: of good texts; rates[y][j]: how often rule j votes each way on texts of class y.

    A vote never counts against what it says.
    """

    share: float
    rates: dict[int, list[dict[int, float]]]

    def posterior(self, cast: list[Column]) -> Column:
        odds = F.lit(math.log(self.share) - math.log1p(-self.share))
        for vote, good, bad in zip(cast, self.rates[GOOD], self.rates[BAD]):
            weight = {v: F.lit(math.log(good[v]) - math.log(bad[v])) for v in WAYS}
            odds += F.when(vote == GOOD, F.greatest(weight[GOOD], F.lit(0.0))).when(
                vote == BAD, F.least(weight[BAD], F.lit(0.0))
            ).otherwise(weight[NONE])
        return 1 / (1 + F.exp(-odds))


def fit(patterns: DataFrame, names: list[str], weight: str, cfg: QualityConfig) -> QualityModel:
    """Expectation-maximisation over vote patterns and their number of texts.

    Abstaining is an outcome like the two votes, so that rules which speak up only against
    a text carry weight. Without texts the belief held before stays.
    """
    before = {GOOD: dict(zip(WAYS, cfg.on_good)), BAD: dict(zip(WAYS, cfg.on_bad))}
    model = QualityModel(0.5, {y: [before[y]] * len(names) for y in (GOOD, BAD)})
    n = F.col(weight).cast("double")
    for _ in range(cfg.rounds):
        good = model.posterior([F.col(name) for name in names])
        sums = [F.sum(n * good).alias("good"), F.sum(n).alias("all")]
        for name in names:
            for v, way in enumerate(WAYS):
                cast = F.col(name) == way
                sums.append(F.sum(F.when(cast, n * good)).alias(f"good_{name}_{v}"))
                sums.append(F.sum(F.when(cast, n)).alias(f"all_{name}_{v}"))
        found = patterns.agg(*sums).first()
        if not found["all"]:
            break
        prior = cfg.prior_weight * found["all"]
        size = {GOOD: found["good"], BAD: max(found["all"] - found["good"], 0.0)}
        rates: dict[int, list[dict[int, float]]] = {GOOD: [], BAD: []}
        for name in names:
            seen = {
                GOOD: [found[f"good_{name}_{v}"] or 0.0 for v in range(len(WAYS))],
            }
            seen[BAD] = [
                max((found[f"all_{name}_{v}"] or 0.0) - g, 0.0) for v, g in enumerate(seen[GOOD])
            ]
            for y in (GOOD, BAD):
                rates[y].append({
                    way: (seen[y][v] + prior * before[y][way]) / (size[y] + prior)
                    for v, way in enumerate(WAYS)
                })
        share = (size[GOOD] + prior / 2) / (found["all"] + prior)
        settled = abs(share - model.share) < cfg.settled
        model = QualityModel(share, rates)
        if settled:
            break
    return model


def judged(df: DataFrame, text: str, columns: list[str], cfg: QualityConfig) -> tuple[DataFrame, str]:
    """The given columns with one more, a struct of counts, quality and the two verdicts.

    The counts are stored once; patterns and verdicts are taken from the stored table.
    """
    (name,) = fresh(df, "quality")
    kept = stored(df.select(*columns, counts(F.col(text)).alias(name)), "quality")
    c = F.col(name)
    cast = votes(c, cfg)
    names = [f"v{j}" for j in range(len(cast))]
    patterns = stored(
        kept.select(*[v.alias(n) for v, n in zip(cast, names)]).groupBy(*names)
        .agg(F.count("*").alias("n")), "patterns",
    )
    posterior = fit(patterns, names, "n", cfg).posterior(cast)
    fails = base_failed(c, cfg)
    return kept.withColumn(name, F.struct(
        *[c[k].alias(k) for k in COUNTS + MORE],
        posterior.alias("quality"),
        fails.alias("base_failed"),
        (~fails & (posterior >= cfg.keep_from)).alias("kept"),
    )), name


def score_quality(
    df: DataFrame, key: str = "doc_id", text: str = "text", cfg: QualityConfig = QualityConfig()
) -> DataFrame:
    """One row per row of df: the key, the counts, `quality` and the verdicts.

    Null and empty texts have zero counts and fail. Rows that are repeated stay repeated.
    An empty table gives an empty one.
    """
    rows, name = judged(df, text, [key], cfg)
    c = F.col(name)
    fields = [*COUNTS, "base_failed", "kept", "quality"]
    return rows.select(key, *[c[k].alias(k) for k in fields])


def keep_good(df: DataFrame, text: str = "text", cfg: QualityConfig = QualityConfig()) -> DataFrame:
    """The rows of df whose text is kept, with all their columns."""
    rows, name = judged(df, text, df.columns, cfg)
    return rows.filter(F.col(name)["kept"]).select(*df.columns)
