"""Quality by weak supervision, in DataFrame operations only.

Each rule votes good or bad or abstains; most only object. Rules whose votes coincide are merged into one
voter. Expectation-maximisation over the table of vote patterns (at most 3 to the number of rules) estimates
without labels how each voter speaks of good and of bad documents, hence how often it is right; a document
stays when its posterior probability of being good reaches a half. No rule knows a language.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import configure, materialize

SPACES = " \t\n\x0b\f\r"
SPLIT = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"  # fixed values of the contract
LEAST_WORDS = 50
MOST_REPEATED = 50  # percent
ENDS = "[.!?\u2026\u061F\u0964\u3002\uFF01\uFF1F][\"')\\]\u00BB\u201D]*([\\x20\\x09-\\x0D]|$)"  # ends of sentences in several scripts
SPEAKS_BOTH = {0}  # rules that also vote good; their silence says nothing, that of the others that they don't object
ROUNDS, CLOSE = 60, 1e-4
PRIOR_GOOD = 0.8
PRIOR_VOTES = 20.0  # documents' worth of belief in the following shares, which break ties and keep logarithms finite
PRIOR_BOTH = {"good": (0.15, 0.0, 0.85), "bad": (0.85, 0.0, 0.15)}  # share of votes -1, 0, 1
PRIOR_OBJECTS = {"good": (0.05, 0.95, 0.0), "bad": (0.4, 0.6, 0.0)}
SAME = 0.9  # correlation of two rules' votes from which on they are one voter


def measures(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the base counts of each text as columns ``__n_words`` and so on; a null text has no words.

    Repeated three-word windows are found by sorting one 64-bit number per window, hash above and place
    below; equal neighbours are confirmed word by word. The number of bits for the place follows the number of words.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    df = docs.withColumn("__t", F.btrim(whole, F.lit(SPACES)))
    df = df.withColumn("__w", F.when(F.col("__t") == "", F.array().cast("array<string>")).otherwise(F.split("__t", SPLIT)))
    df = df.withColumn("__n_words", F.size("__w").cast("long"))
    df = df.withColumn("__word_chars", F.length(F.array_join("__w", "")).cast("long"))
    symbols = sum((F.length(whole) - F.length(F.replace(whole, F.lit(s), F.lit(""))) for s in SYMBOLS), F.lit(0))
    df = df.withColumn("__n_symbols", symbols.cast("long"))
    df = df.withColumn("__lines", F.filter(F.split(whole, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != ""))
    df = df.withColumn("__n_lines", F.size("__lines").cast("long"))
    df = df.withColumn("__n_dup_lines", (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"))
    df = df.withColumn("__n_distinct", F.size(F.array_distinct("__w")).cast("long"))
    df = df.withColumn("__n_ends", F.regexp_count(whole, F.lit(ENDS)).cast("long"))
    df = df.withColumn("__letters", F.length(F.regexp_replace(whole, "[^\\p{L}\\p{M}]+", "")).cast("long"))
    df = df.withColumn("__n_marked", F.regexp_count(whole, F.lit("[#*$%&|<>!]([\\x20\\x09-\\x0D]|$)")).cast("long"))
    df = df.withColumn("__upper", (F.length(whole) - F.length(F.regexp_replace(whole, "[A-Z]", ""))).cast("long"))
    bits = F.ceil(F.log2(F.col("__n_words") + 1)).cast("int")
    window = lambda i: F.xxhash64(F.get("__w", i), F.get("__w", i + 1), F.get("__w", i + 2))
    packed = F.transform(F.sequence(F.lit(0), F.col("__n_words").cast("int") - 3), lambda i: window(i).bitwiseAND(-F.col("__unit")).bitwiseOR(i.cast("long")))
    df = df.withColumn("__unit", F.expr("shiftleft(1L, cast(ceil(log2(__n_words + 1)) as int))"))
    df = df.withColumn("__p", F.when(F.col("__n_words") >= 4, F.sort_array(packed)).otherwise(F.array().cast("array<bigint>")))
    place = lambda v: v.bitwiseAND(F.col("__unit") - 1).cast("int")
    head = lambda v: v.bitwiseAND(-F.col("__unit"))
    same = lambda a, b: (F.get("__w", a) == F.get("__w", b)) & (F.get("__w", a + 1) == F.get("__w", b + 1)) & (F.get("__w", a + 2) == F.get("__w", b + 2))
    equal = lambda v, u: (head(v) == head(u)) & same(place(v), place(u))
    near = lambda v, i: F.coalesce(equal(v, F.get("__p", i - 1)), F.lit(False)) | F.coalesce(equal(v, F.get("__p", i + 1)), F.lit(False))
    df = df.withColumn("__r", F.transform(F.filter("__p", near), place))
    covered = F.size(F.array_distinct(F.concat("__r", F.transform("__r", lambda i: i + 1), F.transform("__r", lambda i: i + 2))))
    df = df.withColumn("__n_repeat_words", covered.cast("long"))
    return df.drop("__t", "__w", "__lines", "__p", "__r", "__unit")


def base_failed() -> Column:
    return (F.col("__n_words") < LEAST_WORDS) | (100 * F.col("__n_repeat_words") > MOST_REPEATED * F.col("__n_words"))


def votes() -> list[Column]:
    """1 good, -1 bad, 0 no opinion. Shares are of words, characters or lines of the document."""
    words, chars, lines = F.greatest(F.col("__n_words"), F.lit(1)), F.greatest(F.col("__word_chars"), F.lit(1)), F.greatest(F.col("__n_lines"), F.lit(1))

    symbols, letters, repeats = F.col("__n_symbols") / chars, F.col("__letters") / chars, F.col("__n_repeat_words") / words
    dup, upper, fresh = F.col("__n_dup_lines") / lines, F.col("__upper") / chars, F.col("__n_distinct") / words
    ends, word = F.col("__n_ends") / words, F.col("__word_chars") / words
    enough = F.col("__n_words") >= LEAST_WORDS
    rules = [
        (enough & ((ends > 0.5) | ((ends == 0) & (words >= 200))), enough & (ends >= 0.02) & (ends <= 0.25)),
        ((word < 2) | (word > 30), None),
        (symbols > 0.05, None),
        (letters < 0.85, None),
        (F.col("__n_marked") > 0.1 * words, None),
        (repeats > 0.4, None),
        ((F.col("__n_lines") >= 3) & (dup > 0.3), None),
        (upper > 0.5, None),
        ((F.col("__n_words") >= 100) & (fresh < 0.1), None),
    ]
    return [(F.when(bad, -1) if good is None else F.when(bad, -1).when(good, 1)).otherwise(0) for bad, good in rules]


def vote_patterns(voted: DataFrame, columns: list[str]) -> DataFrame:
    """Rows ``votes`` (array), ``count``: at most 3 to the number of rules."""
    return materialize(voted.groupBy(F.array(*columns).alias("votes")).agg(F.count(F.lit(1)).alias("count")), "patterns")


def voters(patterns: DataFrame, n_rules: int) -> list[list[int]]:
    """The rules grouped into voters: those whose votes correlate by ``SAME`` or more over all documents are one.

    One row of sums reaches the driver. Rules that are right for different reasons stay far below that, as
    each errs on its own; two forms of one rule would otherwise count twice.
    """
    vote = lambda j: F.col("votes")[j]
    pairs = [(j, k) for j in range(n_rules) for k in range(j, n_rules)]
    sums = [F.sum("count").alias("n"), *[F.sum(F.col("count") * vote(j)).alias(f"s{j}") for j in range(n_rules)],
            *[F.sum(F.col("count") * vote(j) * vote(k)).alias(f"s{j}_{k}") for j, k in pairs]]
    r = patterns.coalesce(1).agg(*sums).first()
    group = list(range(n_rules))
    if not r["n"]:
        return [[j] for j in group]
    spread = lambda j, k: r[f"s{j}_{k}"] / r["n"] - r[f"s{j}"] * r[f"s{k}"] / r["n"] ** 2
    for j, k in pairs:
        if j < k and spread(j, k) > 0 and spread(j, k) >= SAME * math.sqrt(spread(j, j) * spread(k, k)):
            old, new = group[k], group[j]
            group = [new if g == old else g for g in group]
    return [[j for j in range(n_rules) if group[j] == g] for g in sorted(set(group))]


def _merged(votes: Column, groups: list[list[int]]) -> Column:
    """One vote per voter: bad if a rule of it objects, else good if one says so, else none."""
    one = lambda g: F.array(*[votes[j] for j in g])
    return F.array(*[F.when(F.array_min(one(g)) == -1, -1).otherwise(F.array_max(one(g))) if len(g) > 1 else votes[g[0]] for g in groups])


@dataclass(frozen=True)
class Trust:
    """What expectation-maximisation found: ``good`` is the share of good documents, ``says`` holds per class and voter
    the shares of votes -1, 0, 1."""

    good: float
    groups: list[list[int]]
    both: list[bool]
    says: dict[str, list[tuple[float, float, float]]]

    def weights(self) -> list[float]:
        """Log-odds of good by voter and vote (place 3 x voter + vote + 1); the silence of a voter of both kinds weighs nothing."""
        return [math.log(g / b) if g > 0 and b > 0 else 0.0 for gs, bs in zip(self.says["good"], self.says["bad"]) for g, b in zip(gs, bs)]

    def accuracies(self) -> list[float]:
        """Per voter the probability that a vote of it, good or bad, is right."""
        out = []
        for (g_bad, _, g_good), (b_bad, _, b_good) in zip(self.says["good"], self.says["bad"]):
            right = self.good * g_good + (1 - self.good) * b_bad
            out.append(right / (right + self.good * g_bad + (1 - self.good) * b_good))
        return out

    def posterior(self, votes: Column) -> Column:
        """Probability of good given the rules' votes."""
        weights = F.array(*[F.lit(w) for w in self.weights()])
        spots = F.transform(_merged(votes, self.groups), lambda v, j: 3 * j + v + 1)
        odds = F.aggregate(spots, F.lit(math.log(self.good / (1 - self.good))), lambda total, s: total + F.get(weights, s))
        return 1 / (1 + F.exp(-odds))


def _shares(mass: list[float], prior: tuple[float, float, float], both: bool) -> tuple[float, float, float]:
    mass = [m + PRIOR_VOTES * p for m, p in zip(mass, prior)]
    if both:
        mass[1] = 0.0
    return tuple(m / sum(mass) for m in mass)


def estimate(patterns: DataFrame, n_rules: int, speaks_both: set[int] = SPEAKS_BOTH) -> Trust:
    """Shares of good documents and of votes per class, by expectation-maximisation over :func:`vote_patterns`.

    Every round is one aggregation of that bounded table; a row per voter and vote reaches the driver. It starts
    from the prior shares, by which an objection speaks for bad, and is free from there on: nothing is clamped. The
    prior is worth ``PRIOR_VOTES`` documents, so a table without rows gives the prior itself.
    """
    patterns = patterns.coalesce(1)  # one small partition needs no shuffle
    groups = voters(patterns, n_rules)
    both = [bool(set(g) & speaks_both) for g in groups]
    priors = [PRIOR_BOTH if b else PRIOR_OBJECTS for b in both]
    trust = Trust(PRIOR_GOOD, groups, both, {c: [_shares([0.0] * 3, p[c], b) for p, b in zip(priors, both)] for c in ("good", "bad")})
    for _ in range(ROUNDS):
        belief = patterns.select("count", trust.posterior(F.col("votes")).alias("p"), F.posexplode(_merged(F.col("votes"), groups)).alias("voter", "vote"))
        sums = belief.groupBy("voter", "vote").agg(F.sum(F.col("count") * F.col("p")).alias("good"), F.sum(F.col("count") * (1 - F.col("p"))).alias("bad"))
        found = {(r["voter"], r["vote"]): r for r in sums.collect()}  # at most three rows per voter
        mass = {c: [[found[j, v][c] if (j, v) in found else 0.0 for v in (-1, 0, 1)] for j in range(len(groups))] for c in ("good", "bad")}
        good, bad = (sum(mass[c][0]) for c in ("good", "bad"))
        says = {c: [_shares(m, p[c], b) for m, p, b in zip(mass[c], priors, both)] for c in ("good", "bad")}
        share = (good + PRIOR_VOTES * PRIOR_GOOD) / (good + bad + PRIOR_VOTES)
        change = max(abs(x - y) for c in says for a, b in zip(says[c], trust.says[c]) for x, y in zip(a, b))
        change, trust = max(change, abs(share - trust.good)), Trust(share, groups, both, says)
        if change < CLOSE:
            break
    return trust


def judged(docs: DataFrame) -> DataFrame:
    """``docs`` with the counts and the votes ``__v0``, ``__v1``, ...; the texts are measured in one scan per use."""
    configure(docs.sparkSession)
    return measures(docs).select("*", *[v.alias(f"__v{j}") for j, v in enumerate(votes())])


def _verdict(voted: DataFrame) -> DataFrame:
    """``voted`` with ``__quality`` (posterior) and ``__kept``."""
    columns = [f"__v{j}" for j in range(len(votes()))]
    trust = estimate(vote_patterns(voted, columns), len(columns))
    voted = voted.withColumn("__quality", trust.posterior(F.array(*columns)))
    return voted.withColumn("__kept", ~base_failed() & (F.col("__quality") >= 0.5))


def quality(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed, kept and quality (posterior) per row.

    A null text has no words and fails. Repeated rows are judged alike and count as often as they occur; an empty
    table gives no rows. The counts are written once, as the patterns and the verdicts both need them.
    """
    voted = materialize(judged(docs.select("doc_id", "text")).drop("text"), "voted")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return _verdict(voted).select(
        "doc_id", *[F.col(f"__{n}").alias(n) for n in names], base_failed().alias("base_failed"),
        F.col("__kept").alias("kept"), F.col("__quality").alias("quality"),
    )


def drop_poor(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that the verdict rejects, judged beside the text, without a join."""
    voted = materialize(judged(docs), "voted")
    return _verdict(voted).where("__kept").select(*docs.columns)
