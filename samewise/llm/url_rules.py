"""URL filters by association rules.

Spark's FP-growth mines combinations of URL tokens (host suffixes, path segments with digits made
equal) together with the label of the page. Rules whose consequent is a label and whose support and
confidence suffice are kept; a rule that a shorter one with at least its confidence implies goes.
Rules match by an inverted index: each rule hangs at one of its tokens, a page looks up its own
tokens there and tests the few rules found. The page takes the label of its best rule (confidence,
then support), else the default. Explicit rules (host, path) come before mined ones; the longest
that fits decides.

Defined results: a null url, or one without ://, has an empty host and path, fits no explicit rule
and has no tokens, so it gets the default; rows are judged one by one, so repeated rows and null ids
keep their rows; unlabelled pages are not learned from; empty tables give empty results.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, stored, work_dir

MIN_SUPPORT, MIN_CONFIDENCE = 0.01, 0.6
#: Up to so many rules are held in the plan; more are joined as a table.
INLINE_RULES = 1000


@dataclass(frozen=True)
class Rule:
    """verdict for a host with all its subdomains where the path starts with path."""

    verdict: str
    host: str
    path: str


#: The explicit list of the registered query.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) between the first :// and the next of / ? #; path from there to ? or #."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def explicit(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """The longest rule that fits, as a struct (rule, verdict), or null. Rules are few and named in the call."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.host + r.path)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.host + rule.path).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def tokens(host: Column, path: Column) -> Column:
    """Distinct tokens of a URL: each suffix of the host, each path segment, its digits made equal."""
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    suffixes = F.transform(labels, lambda x, i: F.concat(F.lit("host:"), F.array_join(F.slice(labels, i + 1, F.greatest(F.size(labels), F.lit(1))), ".")))
    segments = F.transform(F.filter(F.split(path, "/"), lambda x: x != ""), lambda x: F.concat(F.lit("path:"), F.regexp_replace(x, "[0-9]+", "0")))
    return F.array_distinct(F.concat(suffixes, segments))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules (tokens, verdict, confidence, support) from rows (tokens array, verdict string): all that reach both limits."""
    spark = labelled.sparkSession
    rows = labelled.filter("verdict IS NOT NULL").select(F.concat("tokens", F.array(F.concat(F.lit("label:"), "verdict"))).alias("items"))
    empty = spark.createDataFrame([], "tokens array<string>, verdict string, confidence double, support double")
    if rows.isEmpty():
        return empty
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(rows)
    rules = model.associationRules.filter(F.col("consequent")[0].startswith("label:"))
    return rules.select(F.array_sort("antecedent").alias("tokens"), F.substring(F.col("consequent")[0], 7, 100).alias("verdict"), "confidence", "support")


def essential(rules: DataFrame) -> DataFrame:
    """pruned() on a table: a rule goes that a more general one of its verdict and at least its confidence implies."""
    general = rules.select(F.col("tokens")[0].alias("at"), "verdict", F.col("tokens").alias("few"), F.col("confidence").alias("least"))
    each = rules.withColumn("at", F.explode("tokens"))
    implied = each.join(general, ["at", "verdict"]).filter((F.size("few") < F.size("tokens")) & (F.col("least") >= F.col("confidence")) & (F.size(F.array_except("few", "tokens")) == 0))
    return rules.join(implied.select("tokens", "verdict").distinct(), ["tokens", "verdict"], "left_anti")


def pruned(rules: list[dict]) -> list[dict]:
    """Without rules that a more general rule of the same verdict and at least their confidence implies. Inner rules without tokens never occur."""
    kept: list[dict] = []
    for rule in sorted(rules, key=lambda r: (len(r["tokens"]), -r["confidence"], r["tokens"])):
        if not any(k["verdict"] == rule["verdict"] and k["confidence"] >= rule["confidence"] and set(k["tokens"]) <= set(rule["tokens"]) for k in kept):
            kept.append(rule)
    return kept


def mined_verdict(own: Column, rules: list[dict], default: str) -> Column:
    """Verdict of the best rule whose tokens are all among own, by an index from one token of each rule."""
    if not rules:
        return F.lit(default)
    held: dict[str, list[dict]] = {}
    often: dict[str, int] = {}
    for rule in rules:
        for token in rule["tokens"]:
            often[token] = often.get(token, 0) + 1
    for rule in rules:
        held.setdefault(min(rule["tokens"], key=lambda t: (often[t], t)), []).append(rule)
    literal = lambda r: F.struct(F.lit(r["confidence"]).alias("confidence"), F.lit(r["support"]).alias("support"), F.lit(r["verdict"]).alias("verdict"), F.array(*map(F.lit, r["tokens"])).alias("tokens"))
    index = F.create_map(*[x for token, rs in held.items() for x in (F.lit(token), F.array(*map(literal, rs)))])
    found = F.flatten(F.filter(F.transform(own, lambda t: F.element_at(index, t)), lambda x: x.isNotNull()))
    fits = F.filter(found, lambda r: F.size(F.array_except(r["tokens"], own)) == 0)
    return F.coalesce(F.array_max(fits)["verdict"], F.lit(default))


def with_best_rule(read: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    """read with the column mined, as mined_verdict() gives it, by joins: any number of rules. Each set of tokens is judged once."""
    sets = read.select("tokens").distinct()
    held = rules.select(F.col("tokens")[0].alias("at"), F.struct("confidence", "support", "verdict", "tokens").alias("r"))
    fits = sets.withColumn("at", F.explode("tokens")).join(held, "at").filter(F.size(F.array_except("r.tokens", "tokens")) == 0)
    best = fits.groupBy("tokens").agg(F.max("r")["verdict"].alias("mined"))
    return read.join(best, "tokens", "left").withColumn("mined", F.coalesce("mined", F.lit(default)))


def judge(pages: DataFrame, labels: DataFrame, rules: tuple[Rule, ...] = RULES, default: str = "allow", **limits) -> DataFrame:
    """page_id, host, path, rule, verdict of every page. labels: (page_id, verdict) of some pages."""
    home = work_dir(pages.sparkSession, "url-rules")
    host, path = host_and_path(F.col("url"))
    read = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("tokens", tokens(F.col("host"), F.col("path")))
    known = read.select("page_id", "tokens").join(labels.select("page_id", "verdict"), "page_id")
    mined = stored(essential(stored(mine(known, **limits), f"{home}/mined")), f"{home}/rules")
    few = [r.asDict() for r in mined.limit(INLINE_RULES + 1).collect()]
    many = len(few) > INLINE_RULES
    read = with_best_rule(read, mined, default) if many else read.withColumn("mined", mined_verdict(F.col("tokens"), few, default))
    return read.withColumn("explicit", explicit(F.col("host"), F.col("path"), rules)).select(
        "page_id", "host", "path", F.col("explicit.rule").alias("rule"), F.coalesce(F.col("explicit.verdict"), F.col("mined")).alias("verdict")
    )
