"""Mixing sources to target weights by soft membership (operator 2).

A naive Bayes classifier over words, fitted on a table of labelled documents, gives each document posterior probabilities
p of the domains.  With n tokens and a rate r >= 0 a document brings n p_k r expected tokens of domain k; the rates are
those of least squares: the totals' squared distance from the targets' shares of the budget, and PULL times the rates'
squared distance from 1, which makes the answer unique.

Rates come from lazy projected gradient: steps along the gradient are summed and the sum is projected on rates >= 0, so a
rate is max(0, 1 - p l) with one coefficient l for each domain, and nothing is written between steps.  A step
is weighed by the inverse Gram matrix of the documents with rates above 0, and one pass over the documents tries LENGTHS of
it at once.  The fit ends where the gradient is below CLOSE of the budget.  Totals that miss a target by more than that
(no rates can meet it) or a fit of STEPS passes are told by a warning with the gap; :func:`gaps` gives the totals.  Only
DataFrame functions are used.

The classifier is fitted on at most ``most`` labelled rows, all words of theirs that are evidence of a domain; how far
evidence is scaled down, as words of one document are not independent, is chosen by the likelihood of a quarter of them
that is kept apart for it.  Token counts and totals cover all documents.

Defined cases: null and empty texts have no tokens and take the domains' posteriors by shape alone; labels of unknown
domains and null ones are ignored; a domain without labelled rows has posterior 0, and the other targets share its part;
without any label all posteriors are 0 and rates stay 1; repeated rows each get a row; an empty table gives an empty
result; columns that are not asked for are ignored.
"""

from __future__ import annotations

import math
import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import dropped, stored, table

#: Domains of the label table and their shares of the mixture's tokens.
TARGETS = {"high": 0.97, "low": 0.01, "toxic": 0.02}
MOST = 6000
#: Scales of evidence that are tried.
TEMPERS = (0.05, 0.08, 0.12, 0.18, 0.25, 0.35, 0.5, 0.7, 1.0)
#: Passes of the fit at most, the gradient at which it ends, and the weight of the rates' distance from 1.
STEPS, CLOSE, PULL = 60, 1e-6, 1e-9
#: Parts of a step that one pass tries.
LENGTHS = (1.0, 0.6, 0.3, 0.1, 0.03, 0.01)
#: Targets missed by more than this share of the budget are told.
MISSED = 1e-4
#: Features below this log-likelihood gain are left out as chance.
SURE = 25.0
#: Features must be so many times as frequent in some domain as in all.
LIFT = 2.0
#: Bins of shares, and what the names of those of repetition and of capitals begin with.
_BINS, _REPEATS, _CAPITALS = 10, "\x01r", "\x01c"
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _bin(name: str, part: Column, whole: Column) -> Column:
    share = F.when(whole == 0, 0).otherwise(F.least(F.lit(_BINS - 1), F.floor(part * _BINS / whole)))
    return F.concat(F.lit(name), share.cast("string"))


def features(docs: DataFrame) -> DataFrame:
    """``(columns of docs but text, _row, n_tokens, word)``: each distinct feature of ``text``.

    Features are runs of letters and digits in lower case, runs of other signs, and two bins: of the share of distinct words
    and of capitals.  So every document has rows.
    """
    kept = [c for c in docs.columns if c != "text"]
    text = F.coalesce("text", F.lit(""))
    plain = text
    for c in ("\n", "\t", "\r"):
        plain = F.replace(plain, F.lit(c), F.lit(" "))
    split = docs.select(*kept, F.monotonically_increasing_id().alias("_row"), text.alias("_text"), F.array_remove(F.split(plain, " "), "").alias("_words"))
    repeats = _bin(_REPEATS, F.size(F.array_distinct("_words")), F.size("_words"))
    capitals = F.length("_text") - F.length(F.translate("_text", _ALPHABET, ""))
    runs = F.regexp_extract_all(F.lower("_text"), F.lit(r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]+"), F.lit(0))
    every = F.concat(F.array_distinct(runs), F.array(repeats, _bin(_CAPITALS, capitals, F.length("_text"))))
    return split.select(*kept, "_row", F.size("_words").cast("long").alias("n_tokens"), F.explode(every).alias("word"))


def _evidence(known: DataFrame, domains: list[str]) -> tuple[DataFrame, list[float | None], list[float]]:
    """From ``known(_row, domain, word)``: ``(word, w_0, w_1, ...)``, the evidence of a word for each domain, each domain's
    evidence of no word at all, and the logarithms of the domains' shares (None for those without rows)."""
    # every document has one bin of repetition
    each = {r["domain"]: r["n"] for r in known.where(F.startswith("word", F.lit(_REPEATS))).groupBy("domain").agg(F.count("*").alias("n")).collect()}
    total = sum(each.values())
    priors = [math.log(each[d] / total) if each.get(d) else None for d in domains]
    there = [F.sum(F.when(F.col("domain") == d, 1).otherwise(0)).alias(f"n_{k}") for k, d in enumerate(domains)]
    counts = known.groupBy("word").agg(F.count("*").alias("n"), *there)
    # every bin has an entry, so every document meets one
    bins = known.sparkSession.range(_BINS).select(F.explode(F.array(*(F.concat(F.lit(x), F.col("id").cast("string")) for x in (_REPEATS, _CAPITALS)))).alias("word"))
    counts = bins.join(counts, "word", "full").fillna(0)
    everywhere = (F.col("n") + 0.5) / (total + 1.0)
    evidence, value = [], F.lit(0.0)
    for k, d in enumerate(domains):
        own = each.get(d, 0)
        p = F.least(F.lit(0.999), (F.col(f"n_{k}") + everywhere) / (own + 1.0))
        evidence += [F.log(p / (1 - p)).alias(f"w_{k}"), F.log(1 - p).alias(f"v_{k}")]
        # twice the log-likelihood gain of knowing the domain; words of all domains say more of a text's length
        value = F.greatest(value, F.when(p >= LIFT * everywhere, 2 * F.col(f"n_{k}") * F.log(p / everywhere)).otherwise(0.0))
    bin_ = F.startswith("word", F.lit(_REPEATS)) | F.startswith("word", F.lit(_CAPITALS))
    best, _ = stored(counts.where(bin_ | (value >= SURE)).select("word", *evidence), "mixing-words")
    missing = best.agg(*(F.sum(f"v_{k}").alias(f"v_{k}") for k in range(len(domains)))).collect()[0]
    return best.drop(*(f"v_{k}" for k in range(len(domains)))), [missing[f"v_{k}"] for k in range(len(domains))], priors


def _posteriors(sums: list[Column], missing: list[float], priors: list[float | None], temper: float) -> list[Column]:
    """The posteriors of all domains from the sums of words' evidence."""
    logits = [None if p is None else F.lit(p) + temper * (F.lit(m) + x) for x, m, p in zip(sums, missing, priors, strict=True)]
    live = [x for x in logits if x is not None]
    if not live:
        return [F.lit(0.0) for _ in sums]
    top = F.greatest(*live) if len(live) > 1 else live[0]
    bottom = sum((F.exp(x - top) for x in live), F.lit(0.0))
    return [F.lit(0.0) if x is None else F.exp(x - top) / bottom for x in logits]


def _temper(known: DataFrame, domains: list[str]) -> float:
    """The scale of evidence under which labelled rows kept apart are most likely, by words of the others."""
    apart = known.where(F.col("apart"))
    words, missing, priors = _evidence(known.where(~F.col("apart")), domains)
    live = [d for d, p in zip(domains, priors, strict=True) if p is not None]
    if len(live) < 2:
        return TEMPERS[-1]
    sums = [F.col(f"s_{k}") for k in range(len(domains))]
    rows = apart.join(words, "word").groupBy("_row", "domain").agg(*(F.sum(f"w_{k}").alias(f"s_{k}") for k in range(len(domains))))
    losses = []
    for j, t in enumerate(TEMPERS):
        p = F.lit(0.0)
        for d, x in zip(domains, _posteriors(sums, missing, priors, t), strict=True):
            p = F.when(F.col("domain") == d, x).otherwise(p)
        losses.append(F.sum(-F.log(F.greatest(p, F.lit(1e-300)))).alias(f"l_{j}"))
    found = rows.where(F.col("domain").isin(live)).agg(*losses).collect()[0]
    return min((found[f"l_{j}"], t) for j, t in enumerate(TEMPERS))[1] if found["l_0"] is not None else TEMPERS[-1]


def vocabulary(docs: DataFrame, labels: DataFrame, domains: list[str], most: int = MOST) -> tuple[DataFrame, list[float], list[float | None], float]:
    """The classifier: words with their evidence, each domain's of no word, the domains' priors and the scale of evidence."""
    chosen = (
        labels.where(F.col("domain").isin(domains) & F.col("doc_id").isNotNull())
        .select("doc_id", "domain")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "domain")
        .limit(most)
    )
    # at most ``most`` rows of an id and a domain
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    apart = (F.pmod(F.xxhash64(F.lit("apart"), F.col("doc_id")), F.lit(4)) == 0).alias("apart")
    known, path = stored(features(sample.select(apart, "domain", "text")).select("apart", "_row", "domain", "word"), "mixing-labelled")
    temper = _temper(known, domains)
    words, missing, priors = _evidence(known, domains)
    dropped(docs.sparkSession, path)
    return words, missing, priors, temper


def posteriors(docs: DataFrame, words: DataFrame, missing: list[float], priors: list[float | None], temper: float) -> DataFrame:
    """``docs`` without ``text``, with ``n_tokens`` and ``p_0, p_1, ...``; a pre-aggregated row for each row of ``docs``."""
    kept = [c for c in docs.columns if c != "text"]
    lines = features(docs.select("text", *(F.col(c).alias(f"_{i}") for i, c in enumerate(kept))))
    keys = ["_row", "n_tokens", *(f"_{i}" for i in range(len(kept)))]
    # the planner broadcasts the words where their table is small; all but a few words of texts fall out in the join
    one = lines.join(words, "word").groupBy(*keys).agg(*(F.sum(f"w_{k}").alias(f"s_{k}") for k in range(len(priors))))
    ps = _posteriors([F.col(f"s_{k}") for k in range(len(priors))], missing, priors, temper)
    return one.select(*(F.col(f"_{i}").alias(c) for i, c in enumerate(kept)), "n_tokens", *(p.alias(f"p_{k}") for k, p in enumerate(ps)))


def fitted_rate(ps: list[Column], l: list[float]) -> Column:  # noqa: E741
    """A document's rate: the summed steps, taken off 1 along its posteriors and projected on rates of 0 or more."""
    return F.greatest(F.lit(0.0), F.lit(1.0) - sum((p * F.lit(x) for p, x in zip(ps, l, strict=True)), F.lit(0.0)))


def _inverse(m: list[list[float]]) -> list[list[float]]:
    """The inverse of a small positive definite matrix."""
    k = len(m)
    rows = [[*r, *(float(i == j) for j in range(k))] for i, r in enumerate(m)]
    for c in range(k):
        at = max(range(c, k), key=lambda r: abs(rows[r][c]))
        rows[c], rows[at] = rows[at], rows[c]
        rows[c] = [x / rows[c][c] for x in rows[c]]
        for r in range(k):
            if r != c:
                rows[r] = [x - rows[r][c] * y for x, y in zip(rows[r], rows[c], strict=True)]
    return [r[k:] for r in rows]


def wanted(reached: list[bool], targets: list[float], total: float) -> list[float]:
    """Tokens wanted of each domain; those that no document reaches leave their part to the others."""
    live = [t if ok else 0.0 for t, ok in zip(targets, reached, strict=True)]
    return [t / sum(live) * total for t in live] if sum(live) else [0.0 for _ in live]


def fit_rates(soft: DataFrame, targets: list[float], budget: float | None = None) -> list[float]:
    """The coefficients of :func:`fitted_rate` over ``soft(n_tokens, p_0, ...)``; warns where targets stay missed."""
    k = len(targets)
    ps = [F.col(f"p_{i}") for i in range(k)]
    n = F.col("n_tokens").cast("double")
    pairs = [(i, j) for i in range(k) for j in range(i, k)]

    def looked(tries: list[list[float]]) -> list[tuple[float, list[float], list[list[float]]]]:
        """For each of several coefficients: half the weighed squares of rates, totals, and the Gram matrix of rates above 0."""
        rows = soft.select(n.alias("n"), *ps, *(fitted_rate(ps, x).alias(f"r_{t}") for t, x in enumerate(tries)))
        sums = []
        for t in range(len(tries)):
            r, live = F.col(f"r_{t}"), F.when(F.col(f"r_{t}") > 0, F.col("n")).otherwise(0.0)
            sums += [F.sum(F.col("n") * r * r).alias(f"q_{t}")] + [F.sum(F.col("n") * ps[i] * r).alias(f"a_{t}_{i}") for i in range(k)]
            sums += [F.sum(live * ps[i] * ps[j]).alias(f"g_{t}_{i}_{j}") for i, j in pairs]
        got = rows.agg(*sums).collect()[0]
        return [
            (
                (got[f"q_{t}"] or 0.0) / 2,
                [got[f"a_{t}_{i}"] or 0.0 for i in range(k)],
                [[got[f"g_{t}_{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(k)] for i in range(k)],
            )
            for t in range(len(tries))
        ]

    l = [0.0] * k  # noqa: E741
    squares, totals, gram = looked([l])[0]
    total = budget if budget is not None else 2 * squares  # rates are 1
    want = wanted([gram[i][i] > 0 for i in range(k)], targets, total)
    if not total or not sum(want):
        return l
    pull = PULL * total

    def cost(x: list[float], squares: float) -> float:
        return squares + sum(a * b for a, b in zip(x, want, strict=True)) + pull / 2 * sum(a * a for a in x)

    for _ in range(STEPS):
        slope = [want[i] - totals[i] + pull * l[i] for i in range(k)]
        if max(map(abs, slope)) <= CLOSE * total:
            break
        ridge = max(pull, 1e-9 * sum(gram[i][i] for i in range(k)))
        weight = _inverse([[gram[i][j] + ridge * (i == j) for j in range(k)] for i in range(k)])
        way = [sum(weight[i][j] * slope[j] for j in range(k)) for i in range(k)]
        tries = [[a - t * b for a, b in zip(l, way, strict=True)] for t in LENGTHS]
        best = min(zip(tries, looked(tries), strict=True), key=lambda x: cost(x[0], x[1][0]))
        if cost(best[0], best[1][0]) >= cost(l, squares) - 1e-15 * abs(cost(l, squares)):
            break  # as close as sums in double precision tell
        l, (squares, totals, gram) = best  # noqa: E741
    gap = max(abs(a - b) for a, b in zip(totals, want, strict=True)) / total
    if gap > MISSED:
        warnings.warn(f"a domain's total is off its target by {gap:.2g} of the budget", stacklevel=2)
    return l


def gaps(rates: DataFrame, targets: dict[str, float], budget: float | None = None) -> DataFrame:
    """``(domain, wanted, expected)``: tokens wanted and expected of each domain under the rates of :func:`mixed`."""
    domains = sorted(targets)
    n = F.col("n_tokens").cast("double")
    sums = [F.sum(n * F.col(f"p_{d}") * F.col("rate")).alias(f"a_{k}") for k, d in enumerate(domains)]
    reach = [F.max(n * F.col(f"p_{d}")).alias(f"m_{k}") for k, d in enumerate(domains)]
    got = rates.agg(F.sum(n).alias("all"), *sums, *reach).collect()[0]
    total = budget if budget is not None else got["all"] or 0.0
    want = wanted([(got[f"m_{k}"] or 0.0) > 0 for k in range(len(domains))], [targets[d] for d in domains], total)
    rows = [(d, w, float(got[f"a_{k}"] or 0.0)) for k, (d, w) in enumerate(zip(domains, want, strict=True))]
    return rates.sparkSession.createDataFrame(rows, "domain string, wanted double, expected double")


def mixed(
    docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, budget: float | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """``doc_id``, the columns ``keep``, ``n_tokens``, the posteriors ``p_<domain>`` and ``rate`` of every row of ``docs``.

    ``labels(doc_id, domain)`` is the labelled table.  ``budget``: tokens of the mixture, by default as many as there are.
    """
    domains = sorted(targets)
    docs = docs.select("doc_id", *keep, "text")
    soft, _ = stored(posteriors(docs, *vocabulary(docs, labels, domains)), "mixing-soft")
    rate = fitted_rate([F.col(f"p_{k}") for k in range(len(domains))], fit_rates(soft, [targets[d] for d in domains], budget))
    return soft.withColumn("rate", rate).withColumnsRenamed({f"p_{k}": f"p_{d}" for k, d in enumerate(domains)})


def label_domains(labels: DataFrame) -> DataFrame:
    """``labels(doc_id, quality, toxic)`` as ``(doc_id, domain)``."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").when(F.col("quality") == 1, "high")
    return labels.select("doc_id", domain.alias("domain")).where("domain is not null")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents"), label_domains(table(spark, sf_dir, "labels")), keep=("source",))
