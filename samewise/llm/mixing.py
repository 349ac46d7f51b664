"""Mixing to target weights with soft membership, in DataFrame functions alone.

Domains come from the labelled table (plain, poor, toxic). A naive Bayes classifier over the hashed terms
that occur in a document (its words, and tokens for its length, its shares of marks, distinct and
repeated words, and whether all is in capitals; each counts once) gives each document domain posteriors p. It is fitted by aggregation on a bounded sample
of labelled rows; only in terms that more of its documents hold, by SURPRISE
standard errors or more, than of the first one has a domain (but the first) an estimate of its own. Half of the sample is set aside first to measure the confusion.

Rates r >= 0 are then sought for which the expected tokens sum(r * tokens * p) of each domain match the
targets: least squares, each domain's residual divided by those of its tokens whose rate is above 0, by
projected gradient steps from r = 1. In that scaling a step of length 1 never overshoots; longer ones follow
from the last two gradients, and a step that does not lessen the loss is taken back. A step is one small vector, so the rate
of a document follows from its posteriors and the list of steps; each iteration is one aggregation over
the table of posteriors that brings a few numbers to the driver. The report names what is left of the
residual and the domains that have no model; a fit that misses its targets, or lacks a domain, warns. A domain that no document belongs to cannot be filled: its target is 0.

Defined results: null and empty texts have no tokens and the posteriors of their terms; null
labels and labels of other documents are not learned from, nor is a doc_id labelled for two domains; a domain with fewer than LEAST_ROWS labelled rows has posterior 0, and without any
modelled domain all have the same; repeated rows are separate rows with equal rates; an empty table gives an
empty result; further columns are not read, except that mix() returns them.
"""

from __future__ import annotations

import warnings

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_slot, remove, slots, stored, work_dir

DOMAINS = ("plain", "poor", "toxic")
#: Shares of tokens aimed at; the first domain keeps its present tokens and so sets the budget.
TARGETS = {"plain": 0.97, "poor": 0.015, "toxic": 0.015}
SAMPLE_PER_DOMAIN, STEPS, TOLERANCE = 1500, 60, 1e-7
#: A residual beyond which a fit warns.
LOOSE = 1e-3
#: Marks whose share of a text is a term; each costs a pass over it.
MARKS = "|$%&*#!"
#: Columns of hashed terms, standard errors and rows that make a term count, and what the evidence is divided by, as words are not independent.
BUCKETS, SURPRISE, LEAST_TERM, TEMPERATURE = 1 << 16, 6.0, 5, 1.0
#: A term that fewer of a domain's documents hold says more of a group of copies than of the domain.
LEAST_SHARE = 0.1
#: A domain with fewer labelled rows among the documents is not modelled.
LEAST_ROWS = 10


def domain_of() -> Column:
    return F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "plain").when(F.col("quality") == 0, "poor")


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[\s.,;:?]+"), "")


def _known(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of the labelled rows whose document is among docs."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), domain_of().alias("domain")).filter("doc_id IS NOT NULL AND domain IS NOT NULL")
    known = known.groupBy("doc_id").agg(F.min("domain").alias("domain"), F.max("domain").alias("other")).filter("domain = other").drop("other")
    return known.join(docs.select(F.col("doc_id").cast("long").alias("doc_id")), "doc_id", "left_semi")


def _chosen(known: DataFrame) -> DataFrame:
    """The labelled rows that are learned from: SAMPLE_PER_DOMAIN of each domain, by hash of doc_id."""
    parts = [known.filter(F.col("domain") == d).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_PER_DOMAIN) for d in DOMAINS]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionAll(part)
    return whole


def terms(text: Column, words: Column) -> Column:
    """n, the number of words, and terms, the columns of a document's terms: those of its distinct words, then those of its tokens."""
    plain = text
    for mark in MARKS:
        plain = F.replace(plain, F.lit(mark), F.lit(""))
    marks, column = F.length(text) - F.length(plain), lambda term: F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")

    def with_own(hashes: Column) -> Column:
        n, distinct = F.size(hashes), F.array_distinct(hashes)
        again = F.size(F.filter(hashes, lambda h, i: F.get(hashes, i + 1) == h))
        length = F.floor(F.log2(n + F.lit(1.0)))
        each = lambda name, count: F.concat(F.lit(f"\u0001{name}:"), F.floor(F.log2(1 + 64 * count / F.greatest(n, F.lit(1)))).cast("string"))
        tokens = [
            each("marks", marks),
            each("again", again),
            F.concat(F.lit("\u0001capitals:"), (F.upper(text) == text).cast("string")),
            F.concat(F.lit("\u0001length:"), length.cast("string")),
            F.concat(F.lit("\u0001distinct:"), F.floor(16 * F.log1p(F.size(distinct)) / F.greatest(F.log1p(n), F.lit(0.7))).cast("string")),
        ]
        return F.struct(n.cast("long").alias("n"), F.concat(distinct, F.array(*map(column, tokens))).alias("terms"))

    # a variable of one value keeps Spark from working the words out again for each use
    return F.get(F.transform(F.array(F.transform(words, column)), with_own), F.lit(0))


def _learn(sample: DataFrame) -> dict:
    """Rows of each domain; for each but the first modelled one the weights of terms and the sum for a text without any, from rows (domain, terms)."""
    found = sample.groupBy("domain").count().filter(F.col("count") >= LEAST_ROWS).collect()
    sizes = {r["domain"]: r["count"] for r in found}
    used = [d for d in DOMAINS if d in sizes]
    if not used:
        return {"sizes": {}, "weights": {}, "base": {}}
    each = sample.filter(F.col("domain").isin(used)).select("domain", F.explode(F.array_distinct("terms")).alias("term")).groupBy("term").pivot("domain", used).count().na.fill(0)
    everywhere = sum((F.col(d) for d in used), F.lit(0))
    surprises = [F.lit(0.0)]  # the first domain is what the others stand out from
    for d in used[1:]:
        first, pooled = used[0], (F.col(d) + F.col(used[0])) / (sizes[d] + sizes[used[0]])
        surprises.append((F.col(d) / sizes[d] - F.col(first) / sizes[first]) / F.sqrt(pooled * (1 - pooled) * (1.0 / sizes[d] + 1.0 / sizes[first]) + 1e-9))
    apart = F.array(*[(s >= SURPRISE) & (F.col(d) >= LEAST_SHARE * sizes[d]) for d, s in zip(used, surprises)])
    telling = each.filter((everywhere >= LEAST_TERM) & F.array_contains(apart, True))
    rows = telling.select("term", apart.alias("apart"), *used).orderBy("term").collect()  # at most BUCKETS rows
    # domains that do not stand out in a term share one estimate of it
    apart = np.array([r["apart"] for r in rows], dtype=bool).reshape(-1, len(used))
    counts, each_size = np.array([[r[d] for d in used] for r in rows], dtype=float).reshape(-1, len(used)), np.array([sizes[d] for d in used])
    together = ((counts * ~apart).sum(axis=1) + 0.5) / ((~apart * each_size).sum(axis=1) + 1)
    share = {d: np.where(apart[:, i], (counts[:, i] + 0.5) / (sizes[d] + 1), together) for i, d in enumerate(used)}
    weights, base = {}, {}
    for d in used[1:]:
        weights[d] = np.zeros(BUCKETS)
        weights[d][[r["term"] for r in rows]] = np.log(share[d] / (1 - share[d])) - np.log(share[used[0]] / (1 - share[used[0]]))
        base[d] = float((np.log(1 - share[d]) - np.log(1 - share[used[0]])).sum())
    return {"sizes": sizes, "weights": weights, "base": base}


def _held(values, kind: str) -> Column:
    """An array literal of any length in one step: folded before the query runs."""
    if not len(values):
        return F.array().cast(f"array<{kind}>")
    return F.split(F.lit(",".join("0" if not v else f"{v:.12g}" for v in values)), ",").cast(f"array<{kind}>")


def _evidence(learned: dict) -> tuple[Column, dict[str, Column]]:
    """The telling ones among the column terms, and what these, named telling, say for each domain against the first modelled one.

    Only terms with a weight stand in the literals: the driver writes a plan's literals out whenever the plan changes.
    """
    weights = learned["weights"]
    if not weights:
        return F.lit(None).cast("array<int>"), {}
    named = np.flatnonzero(np.any([w != 0 for w in weights.values()], axis=0))
    known = _held(named, "int")
    return F.array_intersect("terms", known), {d: _summed(known, _held(w[named], "double"), learned["base"][d]) for d, w in weights.items()}


def _summed(known: Column, held: Column, base: float) -> Column:
    return F.aggregate("telling", F.lit(base), lambda total, b: total + F.get(held, F.array_position(known, b).cast("int") - 1))


def _softmax(used: list[str], counts: dict, evidence: dict[str, Column]) -> dict[str, Column]:
    """p of the used domains from their evidence against the first, divided by TEMPERATURE, and their counts."""
    logit = {d: (evidence[d] / F.lit(TEMPERATURE) if d in evidence else F.lit(0.0)) + F.lit(float(np.log(counts[d]))) for d in used}
    return {d: F.lit(1.0) / sum((F.exp(F.least(logit[k] - logit[d], F.lit(500.0))) for k in used if k != d), F.lit(1.0)) for d in used}


def _posteriors(model: dict, evidence: dict[str, Column]) -> dict[str, Column]:
    """p of each domain; domains that are not modelled have 0."""
    used = [d for d in DOMAINS if d in model["stats"]]
    if not used:
        return {d: F.lit(1.0 / len(DOMAINS)) for d in DOMAINS}
    p = _softmax(used, model["counts"], evidence)
    return {d: p.get(d, F.lit(0.0)) for d in DOMAINS}


def fit(docs: DataFrame, labels: DataFrame, home: str) -> dict:
    """Weights of terms and class counts; and the confusion on the half of the sample set aside: {(domain, predicted): rows}."""
    labelled = stored(_known(docs, labels), f"{home}/known")
    text = F.coalesce("text", F.lit(""))
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).join(F.broadcast(_chosen(labelled)), "doc_id")
    aside = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(2)) == 1
    sample = stored(sample.select("domain", aside.alias("aside"), terms(F.col("text"), words_of(F.col("text")))["terms"].alias("terms")), f"{home}/sample")
    counts = {r["domain"]: r["count"] for r in labelled.groupBy("domain").count().collect()}
    half, model, confusion = _learn(sample.filter("NOT aside")), {"counts": counts}, {}
    used = [d for d in DOMAINS if d in half["sizes"]]
    if used:
        telling, evidence = _evidence(half)
        judged = sample.filter(F.col("aside") & F.col("domain").isin(used)).withColumn("telling", telling).select("domain", *[e.alias(f"e_{d}") for d, e in evidence.items()])
        p = _posteriors(model | {"stats": half["sizes"]}, {d: F.col(f"e_{d}") for d in used[1:]})
        predicted = F.coalesce(*[F.when(p[d] == F.greatest(*p.values()), d) for d in used])
        confusion = {(r["domain"], r["predicted"]): r["count"] for r in judged.groupBy("domain", predicted.alias("predicted")).count().collect()}
    learned = _learn(sample)
    for done in ("known", "sample"):
        remove(docs.sparkSession, f"{home}/{done}")
    return model | {"stats": learned["sizes"], "learned": learned, "confusion": confusion}


def membership(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, text, n_tokens, p_<domain>) of rows (doc_id, text)."""
    df = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    df = df.withColumn("read", terms(F.col("text"), words_of(F.col("text")))).select("doc_id", "text", "read.*")
    telling, evidence = _evidence(model["learned"])
    df = df.withColumn("telling", telling).select("doc_id", "text", F.col("n").alias("n_tokens"), *[e.alias(f"e_{d}") for d, e in evidence.items()])
    found = _posteriors(model, {d: F.col(f"e_{d}") for d in evidence})
    return df.select("doc_id", "text", "n_tokens", *[found[d].alias(f"p_{d}") for d in DOMAINS])


def rate(steps: list[list[float]], p: list[Column]) -> Column:
    """The rate that projected steps from 1 lead to."""
    if not steps:
        return F.lit(1.0)
    path = F.array(*[F.array(*[F.lit(float(v)) for v in y]) for y in steps])
    return F.aggregate(path, F.lit(1.0), lambda r, y: F.greatest(F.lit(0.0), r - sum((c * F.get(y, F.lit(i)) for i, c in enumerate(p)), F.lit(0.0))))


def fit_rates(table: DataFrame, targets: dict[str, float], steps_most: int = STEPS) -> tuple[list[list[float]], dict]:
    """Steps of the projected gradient on a stored table (n_tokens, p_*); and a report: targets, totals, loss before and after each step, and the residual left."""
    p = [F.col(f"p_{d}") for d in DOMAINS]
    tokens = F.col("n_tokens").cast("double")

    def measure(steps):
        """Totals of the domains, and the part of their tokens (at rate 1) whose rate is above 0."""
        rows = table.select(tokens.alias("t"), rate(steps, p).alias("r"), *p)
        free = F.when(F.col("r") > 0, F.col("t")).otherwise(0.0)
        got = [float(x or 0) for x in rows.agg(*[F.sum(F.col("r") * F.col("t") * c) for c in p], *[F.sum(free * c) for c in p]).first()]
        return np.array(got[: len(p)]), np.maximum(got[len(p) :], 1e-9)

    totals, held = measure([])
    weights = np.array([targets[d] for d in DOMAINS], dtype=float)
    goal = np.where(totals > 0, weights / weights[0] * totals[0] if weights[0] > 0 else weights * totals.sum(), 0.0)
    steps: list[list[float]] = []
    scale, length, losses = max(1.0, goal.sum()), 1.0, []
    for _ in range(steps_most):
        if np.abs(totals - goal).max() <= TOLERANCE * scale:
            break
        y = length * (totals - goal) / held
        ahead, ahead_held = measure([*steps, y.tolist()])
        loss, ahead_loss = (float(((x - goal) ** 2 / held).sum()) for x in (totals, ahead))
        if ahead_loss < loss:
            # the next length: how much of this step's size its change of the gradient amounts to
            change = float((y * (totals - ahead)).sum())
            length = min(64.0, max(1.0, float((held * y * y).sum()) / change)) if change > 0 else 1.0
            steps, totals, held = [*steps, y.tolist()], ahead, ahead_held
            losses.append((loss, ahead_loss))
        elif length <= 2.0**-20:
            break
        else:
            length = min(1.0, length / 2)
    named = lambda values: dict(zip(DOMAINS, values.tolist()))
    return steps, {"targets": named(goal), "totals": named(totals), "losses": losses, "residual": float(np.abs(totals - goal).max() / scale)}


def row_key(doc_id: Column, text: Column) -> Column:
    """A hash of doc_id and text; its last bits also serve as the number in [0, 1) that a rate is held against."""
    return F.xxhash64(doc_id.cast("long"), F.coalesce(text, F.lit("")), F.lit(2))


def rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, home: str | None = None) -> tuple[DataFrame, dict]:
    """(doc_id, n_tokens, p_*, row_key, u, rate, copies) of every row, and the fit's report; copies = the rate rounded at random."""
    home = home or work_dir(docs.sparkSession, "mixing")
    model = fit(docs, labels, home)
    soft = membership(docs, model)
    table = stored(soft.select(F.col("doc_id").cast("long").alias("doc_id"), "n_tokens", *[f"p_{d}" for d in DOMAINS], row_key(F.col("doc_id"), F.col("text")).alias("row_key")), f"{home}/posteriors")
    table = table.withColumn("u", F.pmod("row_key", F.lit(1 << 20)) / F.lit(float(1 << 20)))
    steps, report = fit_rates(table, targets)
    r = rate(steps, [F.col(f"p_{d}") for d in DOMAINS])
    found = table.withColumn("rate", r).withColumn("copies", (F.floor("rate") + (F.col("u") < F.col("rate") - F.floor("rate")).cast("int")).cast("long"))
    report |= {"model": model, "steps": steps, "unmodelled": [d for d in DOMAINS if d not in model["stats"]]}
    if report["residual"] > LOOSE or report["unmodelled"]:
        warnings.warn(f"targets missed by {report['residual']:.3g} of the tokens, domains without a model: {report['unmodelled']}", stacklevel=2)
    return found, report


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS) -> DataFrame:
    """The rows of docs drawn at their rates: each as often as its copies say, so a rate above 1 repeats rows.

    The choice is read from the stored table, so texts are not taken apart a second time.
    """
    drawn = rates(docs, labels, targets)[0]
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col("doc_id").cast("long").alias("__doc_id"), row_key(F.col("doc_id"), F.col("text")).alias("__key"))
    # rows that are surely drawn once do not move
    sure, others = by_slot(packed, F.col("__key"), slots(drawn.filter("copies <> 1"), F.col("row_key")))
    chosen = drawn.filter("copies > 0").select(F.col("doc_id").alias("__id"), F.col("row_key").alias("__key"), F.col("copies").cast("int").alias("__copies")).distinct()
    tried = others.join(chosen, "__key").filter(F.col("__doc_id").eqNullSafe(F.col("__id")))
    return sure.select("__row.*").unionAll(tried.select("__row", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select("__row.*"))
