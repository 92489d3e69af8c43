"""Mixing to target weights with soft domain membership.

Domains come from a labelled table.  A classifier fitted to it (naive
Bayes over the telling words a document holds) gives every document a posterior for each domain, and
each document gets a rate, the number of times it is expected to be taken.
The expected tokens of a domain are the sum over documents of rate x tokens
x posterior; projected-gradient least squares moves the rates, from 1, to
where those sums match the targets, projecting onto ``rate >= 0`` (and
``rate <= most``, where that is given) after every step.  A step needs the sums of all documents and nothing else
of them: one aggregation, a handful of numbers.

The least squares weigh a domain's residual by 1 / target (by 1 / what the
domain has, if rates are not bounded above), and the gradient
is taken in the metric of the documents' tokens, so a step changes a rate by
a combination of the document's posteriors and long documents do not move
faster than short ones.

The targets are shares.  If a mix of at least ``WHOLE`` of the tokens meets
them with nothing repeated, that is the total and rates go up to 1;
otherwise the total is all tokens, and rates go as far as scarce domains have
to be repeated.  A domain that would have to be repeated over ``REPEAT``
times is not aimed at: it keeps the tokens it has, and the others share the
rest.  With ``most`` given, the total is the largest at which no domain has
to give more than ``most`` times what it has.  Everything here is DataFrame expressions; what reaches the
driver are sums by domain and at most ``TELLING`` words.

The priors are the domains' shares of those labelled documents that the
table holds.  The classifier is fitted on a sample by hash of about ``SAMPLE`` of them, which bounds the broadcast of their ids; everything else covers
all documents.

Defined results: NULL and empty texts have no token, the domains' shares as
posteriors and a rate like any other; rows of the labelled
table with a NULL domain are not used; a target for a domain that no
labelled document of the table has is left out, a domain without a target
aims at 0; without labels every rate is ``most`` or 1, the smaller.  Repeated rows are
kept, each with the same rate.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Places of the table of telling words.
PLACES = 1 << 15
#: Letters of a word that count.
STEM = 5
SAMPLE = 5000
#: The evidence of a whole text for or against a domain goes at most this far (in log-odds), which keeps membership soft.
EVIDENCE = 8.0
#: A word tells if in some domain the number of documents that hold it is at least so many deviations off, and at least
#: this share of the most that any word is; at most so many words tell; smaller log-odds say nothing.
DEVIATIONS, STAND_OUT, TELLING, ODDS = 4.0, 0.15, 4000, 0.7
STEPS, CUT_EVERY = 24, 8
#: Share of the tokens that a mix without repetition must hold; a domain is repeated at most about so many times.
WHOLE, REPEAT = 0.9, 10.0
#: Relative residual at which the steps end.
CLOSE = 1e-3


def words_of(text: str) -> Column:
    """Words in lower case between white space."""
    return F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"\s+"), lambda w: w != "")


def stem(word: Column) -> Column:
    """Hash of a word's first letters: forms of a word tell the same."""
    return F.xxhash64(F.substring(word, 1, STEM))


def _array(values: list, kind: str) -> Column:
    """A constant array, which the optimiser folds into one literal."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


class Classifier(NamedTuple):
    """Domains, logarithms of their shares, what the absence of all telling
    words says for each, and the telling words: by place their hash (0:
    none) and, for each domain, how much more their presence says."""

    domains: list[str]
    priors: list[float]
    absent: list[float]
    hashes: list[int]
    odds: list[list[float]]


def fit_classifier(docs: DataFrame, labelled: DataFrame, sample: int = SAMPLE) -> Classifier:
    """Naive Bayes over the telling words a document holds.  ``labelled``
    has doc_id and domain."""
    labelled = (labelled.where(F.col("doc_id").isNotNull() & F.col("domain").isNotNull()).select("doc_id", "domain")
                .join(docs.select("doc_id"), "doc_id", "left_semi"))
    shares = {r["domain"]: r["n"] for r in labelled.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    domains, n, wide = sorted(shares), sum(shares.values()), 1 << 30
    if not shares:
        return Classifier([], [], [], [], [])
    priors = [math.log(shares[d] / n) for d in domains]
    some = labelled.where(F.pmod(F.xxhash64("doc_id", F.lit("mixing")), F.lit(wide)) < min(wide, wide * sample // n))
    # about ``sample`` ids: bounded, so it is broadcast and texts are not shuffled; copies of a text count once
    texts = cut(docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").select("domain", "text").distinct())
    docs_of = {r["domain"]: r["n"] for r in texts.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    total, k = sum(docs_of.values()), range(len(domains))
    hashes, odds, absent = [0] * PLACES, [[0.0] * PLACES for _ in domains], [0.0 for _ in domains]
    if not total:
        return Classifier(domains, priors, absent, hashes, odds)
    seen = texts.select("domain", F.explode(F.array_distinct(F.transform(words_of("text"), stem))).alias("x"))
    held = seen.groupBy("x").agg(*[F.count(F.when(F.col("domain") == d, 1)).alias(f"n{i}") for i, d in zip(k, domains)])
    whole = sum((F.col(f"n{i}") for i in k), F.lit(0))
    for i, d in zip(k, domains):
        expected = whole * F.lit(docs_of.get(d, 0) / total)
        held = (held.withColumn(f"e{i}", expected)
                .withColumn(f"off{i}", F.when(F.col(f"e{i}") > 0, F.abs(F.col(f"n{i}") - F.col(f"e{i}")) / F.sqrt(f"e{i}"))
                            .otherwise(0.0)))
    held = cut(held)
    most = held.agg(*[F.max(f"off{i}") for i in k]).first()
    tells = [F.col(f"off{i}") >= max(DEVIATIONS, STAND_OUT * (most[i] or 0.0)) for i in k]
    far = F.greatest(F.lit(0.0), *[F.col(f"off{i}") for i in k])
    found = held.where(reduce(or_, tells)).orderBy(far.desc(), "x").limit(TELLING).collect()
    for r in found:  # of two words with one place the one that is farther off
        place = r["x"] % PLACES
        ratio = lambda a, b: math.log((a + 0.5) / (b + 0.5))
        held_by = [ratio(r[f"n{i}"], r[f"e{i}"]) for i in k]
        if r["x"] and not hashes[place] and max(map(abs, held_by)) > ODDS:
            hashes[place] = r["x"]
            for i, d in zip(k, domains):
                if abs(held_by[i]) > ODDS:
                    m = docs_of.get(d, 0)
                    lacked_by = ratio(max(m - r[f"n{i}"], 0), max(m - r[f"e{i}"], 0))
                    absent[i] += lacked_by
                    odds[i][place] = round(held_by[i] - lacked_by, 9)
    return Classifier(domains, priors, absent, hashes, odds)


def _place(x: Column) -> Column:
    return F.pmod(x, F.lit(PLACES)).cast("int")


def _telling(hashes: list[int], words: Column | None = None) -> Column:
    """The different telling words (by hash) among a text's."""
    known = _array(hashes, "bigint")
    words = F.transform(words_of("text"), stem) if words is None else words
    return F.array_distinct(F.filter(words, lambda x: F.get(known, _place(x)) == x))


def posteriors(docs: DataFrame, model: Classifier) -> DataFrame:
    """``doc_id``, ``text_hash``, ``tokens`` (words) and ``p``, the posterior
    of every domain in order."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.transform(words_of("text"), stem).alias("w"))
    rows = rows.select("doc_id", "text_hash", F.size("w").cast("long").alias("tokens"), _telling(model.hashes, F.col("w")).alias("b"))

    def evidence(table: list[float], absent: float) -> Column:
        odds = _array(table, "double")
        said = F.aggregate("b", F.lit(absent), lambda a, x: a + F.get(odds, _place(x)))
        return F.lit(EVIDENCE) * F.tanh(said / F.lit(EVIDENCE))

    fit = [F.lit(prior) + evidence(table, absent)
           for prior, absent, table in zip(model.priors, model.absent, model.odds)]
    rows = rows.select("doc_id", "text_hash", "tokens", F.array(*fit).alias("f"))
    rows = rows.withColumn("top", F.array_max("f"))
    rows = rows.withColumn("e", F.transform("f", lambda x: F.exp(x - F.col("top"))))
    total = F.aggregate("e", F.lit(0.0), lambda a, x: a + x)
    return rows.withColumn("total", total).select("doc_id", "text_hash", "tokens",
                                                  F.transform("e", lambda x: x / F.col("total")).alias("p"))


def _largest_eigenvalue(m: list[list[float]]) -> float:
    """Of a small symmetric matrix with non-negative entries, by powers,
    rounded up."""
    v, size = [1.0] * len(m), 0.0
    for _ in range(100):
        w = [sum(a * x for a, x in zip(row, v)) for row in m]
        size = math.sqrt(sum(x * x for x in w))
        if not size:
            return 1.0
        v = [x / size for x in w]
    return size * 1.01


def goals(mass: list[float], share: list[float]) -> tuple[list[float], float | None]:
    """Tokens to aim at for every domain, and the largest rate (None: any)."""
    whole = sum(mass)
    scarce = [m * REPEAT < s * whole for m, s in zip(mass, share)]
    rest = whole - sum(m for m, low in zip(mass, scarce) if low)
    aimed = sum(s for s, low in zip(share, scarce) if not low) or 1.0
    once = min((m * aimed / s for m, s, low in zip(mass, share, scarce) if s > 0 and not low), default=rest)
    total, most = (once, 1.0) if once >= WHOLE * rest else (rest, None)
    return [m if low else total * s / aimed for m, s, low in zip(mass, share, scarce)], most


def fit_rates(members: DataFrame, domains: list[str], targets: dict[str, float], most: float | None = 1.0,
              steps: int = STEPS) -> DataFrame:
    """Add ``rate`` to ``members`` (doc_id, tokens, p).  Without ``most``
    rates go as far as scarce domains have to be repeated."""
    k = len(domains)
    first = 1.0 if most is None else min(1.0, most)
    wanted = [max(targets.get(d, 0.0), 0.0) for d in domains]
    if not k or not sum(wanted):
        return members.withColumn("rate", F.lit(first))
    p = [F.get("p", F.lit(i)) for i in range(k)]
    masses = members.agg(*[F.sum(F.col("tokens") * x).alias(f"m{i}") for i, x in enumerate(p)]).first()
    mass = [masses[i] or 0.0 for i in range(k)]
    share = [w / sum(wanted) for w in wanted]
    have = [(m, s) for m, s in zip(mass, share) if s > 0 and m > 0]
    if not have:
        return members.withColumn("rate", F.lit(first))
    if most is None:
        goal, most = goals(mass, share)
    else:
        total = min(most * m / s for m, s in have)
        goal = [total * s if m > 0 else 0.0 for m, s in zip(mass, share)]
    # a domain that aims at nothing is weighed by what it has; so are all where goals lie far over that (steps would be short)
    scale = [m or 1.0 for m in mass] if most is None else [g or m or 1.0 for g, m in zip(goal, mass)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    gram = members.agg(*[F.sum(F.col("tokens") * p[i] * p[j]).alias(f"g{i}_{j}") for i, j in pairs]).first()
    matrix = [[(gram[f"g{min(i, j)}_{max(i, j)}"] or 0.0) / math.sqrt(scale[i] * scale[j]) for j in range(k)]
              for i in range(k)]
    step = 1.0 / _largest_eigenvalue(matrix)
    rates = members.withColumn("rate", F.lit(first))
    for n in range(1, steps + 1):
        sums = rates.agg(*[F.sum(F.col("rate") * F.col("tokens") * x).alias(f"s{i}") for i, x in enumerate(p)]).first()
        residual = [(sums[i] or 0.0) - goal[i] for i in range(k)]
        if max(abs(r) / s for r, s in zip(residual, scale)) < CLOSE:
            break
        move = sum((x * F.lit(-step * r / s) for x, r, s in zip(p, residual, scale)), F.lit(0.0))
        moved = F.col("rate") + move
        rates = rates.withColumn("rate", F.greatest(F.lit(0.0), moved if most is None else F.least(F.lit(float(most)), moved)))
        if n % CUT_EVERY == 0:
            rates = cut(rates)
    return rates


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float],
        most: float | None = None) -> tuple[DataFrame, list[str]]:
    """``doc_id``, ``text_hash``, ``tokens``, ``p`` and ``rate`` of every document, and the
    domains in the order of ``p``."""
    model = fit_classifier(docs, labelled)
    if not model.domains:
        members = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.size(words_of("text")).cast("long").alias("tokens"),
                              F.array().cast("array<double>").alias("p"))
    else:
        members = posteriors(docs, model)
    members = cut(members)
    return fit_rates(members, model.domains, targets, most), model.domains


def copies(rate: Column, *key: Column) -> Column:
    """How often a row is taken: the whole part of its rate, and once more
    with the chance of the rest, decided by a hash of ``key``."""
    chance = F.pmod(F.xxhash64(*key, F.lit("take")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return (F.floor(rate) + F.when(chance < rate - F.floor(rate), 1).otherwise(0)).cast("int")
