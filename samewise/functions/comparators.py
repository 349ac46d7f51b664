"""Pair comparators and their registry.

A comparator takes two columns and gives a score column: signed ones lie in [-1, 1] and unsigned in
[0, 1]; 0 also stands for a side that is missing, which valid() tells apart.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import identifiers as ids
from . import strings, text


@dataclass(frozen=True)
class Comparator:
    name: str
    build: Callable[..., Column]
    signed: bool


REGISTRY: dict[str, Comparator] = {}


def register(name: str, signed: bool = True):
    """Decorator: adds a function of two columns to the registry."""

    def add(f):
        REGISTRY[name] = Comparator(name, f, signed)
        return f

    return add


def valid(a: Column, b: Column) -> Column:
    return ~text.is_missing(a.cast("string")) & ~text.is_missing(b.cast("string"))


def _known(a: Column, b: Column, score: Column) -> Column:
    return F.when(valid(a, b), score).otherwise(0.0)


def _sign(c: Column) -> Column:
    return F.when(c, 1.0).otherwise(-1.0)


def _clip(c: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


@register("exact_signed")
def exact_signed(a, b):
    return _known(a, b, _sign(a == b))


@register("categorical_signed")
def categorical_signed(a, b):
    return _known(a, b, _sign(F.upper(F.trim(a)) == F.upper(F.trim(b))))


@register("exact_or_zero", signed=False)
def exact_or_zero(a, b):
    return _known(a, b, (a == b).cast("double"))


@register("categorical", signed=False)
def categorical(a, b):
    one = text.is_missing(a) != text.is_missing(b)
    return F.when(one, 0.5).otherwise(_known(a, b, (F.upper(a) == F.upper(b)).cast("double")))


@register("exact_with_check_digit")
def exact_with_check_digit(a, b):
    x, y = ids.digits(a), ids.digits(b)
    long = (F.length(x) >= 8) & (F.length(y) >= 8)
    nine = (F.length(x) >= 9) & (F.length(y) >= 9) & (F.substring(x, 1, 9) == F.substring(y, 1, 9))
    return F.when(long, _sign((x == y) | nine)).otherwise(0.0)


@register("jaro_winkler_signed")
def jaro_winkler_signed(a, b):
    return _known(a, b, 2 * strings.jaro_winkler_udf(F.upper(a), F.upper(b)) - 1)


@register("token_set_signed")
def token_set_signed(a, b):
    return _known(a, b, 2 * strings.token_set_udf(F.upper(a), F.upper(b)) - 1)


@register("token_sort_signed")
def token_sort_signed(a, b):
    return _known(a, b, 2 * strings.token_sort_udf(F.upper(a), F.upper(b)) - 1)


@register("token_set_ratio", signed=False)
def token_set_ratio(a, b):
    return _known(a, b, strings.token_set_udf(F.upper(a), F.upper(b)))


@register("levenshtein_signed")
def levenshtein_signed(a, b):
    return _known(a, b, 2 * (1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b))) - 1)


@register("phone_signed")
def phone_signed(a, b, n: int = 7):
    x, y = ids.phone_key(a, n), ids.phone_key(b, n)
    return F.when((x != "") & (y != ""), _sign(x == y)).otherwise(0.0)


@register("document_signed")
def document_signed(a, b):
    x, y = ids.document_key(a), ids.document_key(b)
    return F.when((x != "") & (y != ""), _sign(x == y)).otherwise(0.0)


@register("email_signed")
def email_signed(a, b):
    """Other domain -1, same address 1, else 2 * Indel of the local parts - 1."""
    x, y = ids.email_parts(a), ids.email_parts(b)
    score = F.when(x["domain"] != y["domain"], -1.0).when(x["local"] == y["local"], 1.0).otherwise(2 * strings.indel_ratio_udf(x["local"], y["local"]) - 1)
    return F.when((x["domain"] != "") & (y["domain"] != ""), score).otherwise(0.0)


@register("city_signed")
def city_signed(a, b):
    x, y = text.normal_city(a), text.normal_city(b)
    return F.when((x != "") & (y != ""), _sign(x == y)).otherwise(0.0)


@register("address_token_set")
def address_token_set(a, b):
    x, y = text.normal_address(a), text.normal_address(b)
    return F.when((F.length(x) >= 5) & (F.length(y) >= 5), 2 * strings.token_set_udf(x, y) - 1).otherwise(0.0)


@register("date_delta")
def date_delta(a, b, days: float = 30):
    return F.coalesce(_clip(1 - F.abs(F.datediff(a, b)) / days, -1, 1), F.lit(0.0))


@register("geo_haversine", signed=False)
def geo_haversine(a, b, km: float = 5.0):
    """a and b are structs of lat and lon."""
    p, q = F.radians(a["lat"]), F.radians(b["lat"])
    h = F.pow(F.sin((q - p) / 2), 2) + F.cos(p) * F.cos(q) * F.pow(F.sin((F.radians(b["lon"]) - F.radians(a["lon"])) / 2), 2)
    return F.coalesce(_clip(1 - 2 * 6371.0088 * F.asin(F.sqrt(F.least(h, F.lit(1.0)))) / km, 0, 1), F.lit(0.0))


@register("number_relative", signed=False)
def number_relative(a, b, tolerance: float = 0.1):
    top = F.greatest(F.abs(a), F.abs(b))
    return F.coalesce(F.when(top == 0, 1.0).otherwise(_clip(1 - F.abs(a - b) / top / tolerance, 0, 1)), F.lit(0.0))


@register("number_absolute", signed=False)
def number_absolute(a, b, tolerance: float = 1.0):
    return F.coalesce(_clip(1 - F.abs(a - b) / tolerance, 0, 1), F.lit(0.0))


@register("phonetic_signed")
def phonetic_signed(a, b):
    key = lambda c: F.array_sort(F.array_distinct(F.split(text.phonetic_es(c), " ")))
    return _known(a, b, _sign(key(a) == key(b)))


@register("prefix_levels")
def prefix_levels(a, b, levels: tuple[int, ...] = (1, 2, 4)):
    """Share of the levels that the longer code covers at which both start alike; none: -1."""
    covered = sum((F.when(F.greatest(F.length(a), F.length(b)) >= n, 1).otherwise(0) for n in levels), F.lit(0))
    alike = sum((F.when((F.length(a) >= n) & (F.length(b) >= n) & (F.substring(a, 1, n) == F.substring(b, 1, n)), 1).otherwise(0) for n in levels), F.lit(0))
    return _known(a, b, F.when(alike == 0, -1.0).otherwise(alike / covered))


@register("set_jaccard", signed=False)
def set_jaccard(a, b):
    x, y = text.normal_set(a), text.normal_set(b)
    return _known(a, b, F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y)))


@register("set_overlap_signed")
def set_overlap_signed(a, b):
    x, y = text.normal_set(a), text.normal_set(b)
    return _known(a, b, 2 * F.size(F.array_intersect(x, y)) / F.least(F.size(x), F.size(y)) - 1)


@register("tolerant_category_signed")
def tolerant_category_signed(a, b):
    words = lambda c: F.array_except(F.split(text.ascii_upper(c), " "), F.array(*map(F.lit, text.CONNECTORS)))
    x, y = words(a), words(b)
    return _known(a, b, _sign((F.size(F.array_except(x, y)) == 0) | (F.size(F.array_except(y, x)) == 0)))


def nit_similarity(a: Column, b: Column) -> Column:
    n = F.greatest(F.length(a), F.length(b))
    s = 1 - F.levenshtein(a, b) / n
    return F.when((a == "") | (b == ""), 0.0).when(a == b, 1.0).otherwise(s * F.when(F.abs(F.length(a) - F.length(b)) > 2, 0.5).otherwise(1.0))


def nit_distance(a: Column, b: Column) -> Column:
    return F.when((a == "") | (b == ""), -1).otherwise(F.levenshtein(a, b))


def name_similarity(a: Column, b: Column) -> Column:
    """Identical 1, lengths too unlike 0, else token set ratio; the strings without spaces raise it where their Jaro-Winkler reaches 0.95."""
    ratio = F.least(F.length(a), F.length(b)) / F.greatest(F.length(a), F.length(b))
    near = strings.jaro_winkler_udf(F.replace(a, F.lit(" "), F.lit("")), F.replace(b, F.lit(" "), F.lit("")))
    s = strings.token_set_udf(a, b)
    return F.when((a == "") | (b == ""), 0.0).when(a == b, 1.0).when(ratio < 0.1, 0.0).otherwise(F.greatest(s, F.when(near >= 0.95, near).otherwise(0.0)))


def idf_jaccard(a: Column, b: Column, weight: Column) -> Column:
    """Weighted Jaccard of word arrays; weight is a map from word to its inverse document frequency."""
    total = lambda words: F.aggregate(words, F.lit(0.0), lambda s, w: s + F.coalesce(F.element_at(weight, w), F.lit(0.0)))
    whole = total(F.array_union(a, b))
    return F.when(whole > 0, total(F.array_intersect(a, b)) / whole).otherwise(0.0)
