"""How two company names resemble each other: words aligned one to one, abbreviations, and the fifteen traits of a pair.

All column expressions: a pair costs its own words, and nothing leaves the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text
from .identifiers import let


@dataclass(frozen=True)
class Rules:
    """max_edits: of a word, 0 to 2; generic: words that never identify; given_names: first names, which alone are no identity."""

    max_edits: int = 1
    locale: str = "ES"
    generic: tuple[str, ...] = text.GENERIC
    given_names: tuple[str, ...] = ()

    def __post_init__(self):
        if self.max_edits not in (0, 1, 2):
            raise ValueError("a word may differ by two edits at most")


def _cuts(w: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(w)), lambda i: F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, F.length(w))))


def same_word(t: Column, u: Column, max_edits: int) -> Column:
    """Equal, or max_edits edits apart at most; words under eight letters may only gain or lose letters, those under four are to be equal."""
    if not max_edits:
        return t == u
    short, gap = F.least(F.length(t), F.length(u)), F.abs(F.length(t) - F.length(u))
    edits = F.levenshtein(t, u, max_edits)  # -1 beyond
    swapped = F.lit(False) if max_edits < 2 else (edits == 2) & (gap == 0) & F.arrays_overlap(_cuts(t), _cuts(u))
    return (t == u) | ((short >= 4) & (edits > 0) & ((short >= 8) | (gap == edits) | swapped))


_ACC = "struct<free:array<int>,pairs:array<struct<k:int,j:int,kind:string>>>"


def align(ta: Column, tb: Column, max_edits: int = 1, cut_a: Column | None = None, cut_b: Column | None = None) -> Column:
    """struct(rest_a, rest_b, pairs (a, b, kind)): each word of ta, in its order, takes a free word of tb: an equal one (exact), else the nearest
    within max_edits (typo), else, for the last word of a name that was cut off, one that begins with it (cut), on either side.

    Where the last word of a name that was cut off has a partner, what the other name holds behind that partner is no difference.
    """

    cut_a, cut_b = (F.lit(False) if c is None else c for c in (cut_a, cut_b))

    def pair(t: Column, k: Column, free: Column) -> Column:
        word = lambda j: F.get(tb, j)
        last = F.size(tb) - 1
        exact = F.get(F.filter(free, lambda j: word(j) == t), F.lit(0))
        near = F.array_min(F.transform(F.filter(free, lambda j: same_word(t, word(j), max_edits)), lambda j: F.struct(F.levenshtein(t, word(j)).alias("d"), word(j).alias("w"), j.alias("j"))))["j"]
        begun = F.get(F.filter(free, lambda j: word(j).startswith(t) & (word(j) != t)), F.lit(0))
        mine = F.when(cut_a & (k == F.size(ta) - 1) & (F.length(t) >= 2), begun)
        theirs = F.when(cut_b & (F.length(t) >= 3) & F.array_contains(free, last) & (F.length(word(last)) >= 2) & t.startswith(word(last)), last)
        kinds = ((exact, "exact"), (F.when(F.length(t) >= 4, near) if max_edits else F.lit(None).cast("int"), "typo"), (F.coalesce(mine, theirs), "cut"))
        return F.coalesce(*[F.when(j.isNotNull(), F.struct(k.alias("k"), j.cast("int").alias("j"), F.lit(kind).alias("kind"))) for j, kind in kinds])

    def step(acc: Column, x: Column) -> Column:
        taken = lambda p: F.when(p.isNull(), acc).otherwise(F.struct(F.array_remove(acc["free"], F.coalesce(p["j"], F.lit(-1))).alias("free"), F.array_append(acc["pairs"], p).alias("pairs")).cast(_ACC))
        return let(pair(x["t"], x["k"], acc["free"]), taken)

    def finish(acc: Column) -> Column:
        pairs = acc["pairs"]
        rest_a = F.filter(F.transform(ta, lambda t, i: i), lambda i: ~F.exists(pairs, lambda p: p["k"] == i))
        ends = lambda side, n: F.get(F.filter(pairs, lambda p: p[side] == n - 1), F.lit(0))
        lost_b = F.when(cut_a, ends("k", F.size(ta))["j"])
        lost_a = F.when(cut_b, ends("j", F.size(tb))["k"])
        kept = lambda rest, lost: F.filter(rest, lambda i: lost.isNull() | (i < lost))
        words = lambda of, at: F.transform(at, lambda i: F.get(of, i))
        return F.struct(
            words(ta, kept(rest_a, lost_a)).alias("rest_a"),
            words(tb, kept(acc["free"], lost_b)).alias("rest_b"),
            F.transform(pairs, lambda p: F.struct(F.get(ta, p["k"]).alias("a"), F.get(tb, p["j"]).alias("b"), p["kind"].alias("kind"))).alias("pairs"),
        )

    places = F.transform(tb, lambda w, i: i)
    start = F.struct(places.alias("free"), F.array().alias("pairs")).cast(_ACC)
    return F.aggregate(F.transform(ta, lambda t, i: F.struct(i.alias("k"), t.alias("t"))), start, step, finish)


def is_subsequence(short: Column, long: Column) -> Column:
    """short (three letters or more) is long with letters left out, but for the first."""
    pattern = F.concat(F.lit("^"), F.array_join(F.split(short, ""), ".*"))
    return (F.length(short) >= 3) & (F.length(short) < F.length(long)) & F.regexp_like(long, pattern)


def abbreviates(a: Column, b: Column, generic: tuple[str, ...] = text.GENERIC, subsequence: bool = False) -> Column:
    """Whether the words a abbreviate the words b (letters and digits): each word of a, in order, begins a word of b, or is the initials of several in a row,
    or, if asked, a subsequence of one; the first starts at the first of b, later ones may skip words, and one that is really shorter stands for a word that is not generic.

    What is reached after each word of a is a set of states (next word of b, something shortened, something distinctive), so a state counts once.
    """
    plain = lambda w: w.isin(*generic)
    initials = F.array_join(F.transform(b, lambda w: F.substring(w, 1, 1)), "")
    state = lambda j, short, own: F.struct(j.cast("int").alias("j"), short.alias("short"), own.alias("own"))

    def word(states: Column, x: Column) -> Column:
        t, n = x["t"], F.length(x["t"])
        # later words may start at any place from the state on
        places = F.array_distinct(F.flatten(F.transform(states, lambda s: F.transform(F.filter(F.transform(b, lambda w, i: i), lambda i: F.when(x["k"] == 0, i == s["j"]).otherwise(i >= s["j"])), lambda i: state(i, s["short"], s["own"])))))

        def moves(s: Column) -> Column:
            w, j = F.get(b, s["j"]), s["j"]
            less = n < F.length(w)
            several = (n >= 2) & (n <= F.size(b) - j) & (F.substring(initials, j + 1, n) == t)
            found = [
                F.when(w.startswith(t), state(j + 1, s["short"] | less, s["own"] | (less & ~plain(w)))),
                F.when(several, state(j + n, F.lit(True), s["own"] | F.exists(F.slice(b, j + 1, n), lambda y: ~plain(y)))),
            ]
            if subsequence:
                found.append(F.when(is_subsequence(t, w), state(j + 1, F.lit(True), s["own"] | ~plain(w))))
            return F.array(*found)

        return F.array_distinct(F.filter(F.flatten(F.transform(places, moves)), lambda s: s.isNotNull()))

    start = F.array(state(F.lit(0), F.lit(False), F.lit(False)))
    numbered = F.transform(a, lambda t, i: F.struct(i.alias("k"), t.alias("t")))
    ends = F.aggregate(numbered, start, word, lambda states: F.exists(states, lambda s: s["short"] & s["own"]))
    sized = (F.size(a) >= 2) | (F.length(F.get(a, F.lit(0))) >= 3)
    first = F.substring(F.get(a, F.lit(0)), 1, 1) == F.substring(F.get(b, F.lit(0)), 1, 1)
    return F.coalesce(F.when((F.size(a) > 0) & (F.size(b) > 0) & first & sized, ends), F.lit(False))


def short_forms(name: Column, locale: str = "ES") -> Column:
    """Word lists to seek abbreviations with: without legal forms, connectors and a single last letter; and, if the last word ends in a legal form, without that too."""
    forms = sorted((f for f in text.LEGAL_FORMS[locale] if " " not in f and len(f) >= 2), key=lambda f: (-len(f), f))
    words = F.filter(F.split(name, " "), lambda w: (w != "") & ~w.isin(*forms, *text.CONNECTORS))
    # the single letters at the end go, but the first word stays
    whole = let(words, lambda w: F.slice(w, F.lit(1), F.greatest(F.lit(1), F.coalesce(F.array_max(F.transform(w, lambda x, i: F.when(F.length(x) > 1, i + 1))), F.lit(1)))))

    def variants(w: Column) -> Column:
        last = F.element_at(w, -1)
        glued = F.coalesce(*[F.when(last.endswith(f) & (F.length(last) - len(f) >= 2), F.substring(last, F.lit(1), F.length(last) - len(f))) for f in forms])
        shorter = F.when(glued.isNotNull(), F.array_append(F.slice(w, F.lit(1), F.size(w) - 1), glued))
        return F.when(F.size(w) == 0, F.array().cast("array<array<string>>")).otherwise(F.filter(F.array(w, shorter), lambda v: v.isNotNull()))

    return let(whole, variants)


def marks(name: Column, cut: Column, locale: str = "ES") -> Column:
    """Sorted single letters and numbers of a name, connectors and legal forms apart; of a name that was cut off without a single last letter."""
    forms = tuple(f for f in text.LEGAL_FORMS[locale] if " " not in f)
    words = F.filter(F.split(name, " "), lambda w: (w != "") & ~w.isin(*forms, *text.CONNECTORS))
    kept = let(words, lambda w: F.when(cut & (F.length(F.try_element_at(w, F.lit(-1))) == 1), F.slice(w, F.lit(1), F.greatest(F.size(w) - 1, F.lit(0)))).otherwise(w))
    return F.array_sort(F.filter(kept, lambda w: F.regexp_like(w, F.lit("^([A-Z]|[0-9]+)$"))))


def pair_traits(a: Column, b: Column, rules: Rules = Rules(), cut_a: Column | None = None, cut_b: Column | None = None, subsequence: bool = False) -> Column:
    """The fifteen traits of two folded names as a struct; null names count as empty."""
    a, b = F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))
    cut_a, cut_b = (F.lit(False) if c is None else c for c in (cut_a, cut_b))
    plain = lambda w: w.isin(*rules.generic)
    named = (lambda w: w.isin(*rules.given_names)) if rules.given_names else (lambda w: F.lit(False))

    def of(x: Column) -> Column:
        ua, ub = x["ua"], x["ub"]

        def read(found: Column) -> Column:
            pairs, rest = found["pairs"], F.concat(found["rest_a"], found["rest_b"])
            shared = F.filter(pairs, lambda p: ~plain(p["a"]) & ~plain(p["b"]) & (F.length(p["a"]) >= 3) & (F.length(p["b"]) >= 3))
            by_cut = F.filter(pairs, lambda p: (p["kind"] == "cut") & ~plain(p["b"]))
            strong = F.filter(pairs, lambda p: (p["kind"] == "exact") & ~plain(p["a"]) & (F.length(p["a"]) >= 3) & ~named(p["a"]))
            n_shared = F.when(F.size(shared) > 0, F.size(shared)).otherwise(F.size(by_cut))
            compact_a, compact_b = F.array_join(ua, ""), F.array_join(ub, "")
            compact = (compact_a != "") & (compact_a == compact_b)
            va, vb = short_forms(a, rules.locale), short_forms(b, rules.locale)
            either = F.exists(va, lambda v: F.exists(vb, lambda w: abbreviates(v, w, rules.generic, subsequence) | abbreviates(w, v, rules.generic, subsequence)))
            return F.struct(
                F.size(ua).alias("UTILES_A"),
                F.size(ub).alias("UTILES_B"),
                F.array_join(found["rest_a"], " ").alias("SOBRA_A"),
                F.array_join(found["rest_b"], " ").alias("SOBRA_B"),
                F.array_join(F.array_sort(F.array_distinct(F.transform(shared, lambda p: p["b"]))), " ").alias("COMPARTIDAS"),
                n_shared.alias("N_COMPARTIDAS"),
                F.size(strong).alias("N_FUERTES"),
                ((F.size(shared) > 0) & F.forall(shared, lambda p: named(p["a"]))).alias("SOLO_NOMBRE_PILA"),
                F.forall(rest, plain).alias("SOBRAS_GENERICAS"),
                (F.size(rest) == 0).alias("SIN_SOBRAS"),
                F.exists(pairs, lambda p: p["kind"] == "typo").alias("ERRATA"),
                F.exists(pairs, lambda p: p["kind"] == "cut").alias("TRUNCADA"),
                (marks(a, cut_a, rules.locale) == marks(b, cut_b, rules.locale)).alias("MARCAS_OK"),
                compact.alias("COMPACTO_IGUAL"),
                F.when((n_shared == 0) & ~compact, either).otherwise(F.lit(False)).alias("ABREVIATURA"),
            )

        return let(align(ua, ub, rules.max_edits, cut_a, cut_b), read)

    return let(F.struct(text.useful_words(a, rules.locale).alias("ua"), text.useful_words(b, rules.locale).alias("ub")), of)
