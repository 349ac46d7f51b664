"""Dedup of the two sides of a linking before they are linked.

Anchors are grouped by spelling (country and name as they come); spellings of one country are united by ordered rules,
or proposed to a person where a rule nearly holds. Destinations are grouped by the root of their identifier, or by the same name
in the same countries. Human decisions come first; a decision that two are different is a veto.

Pairs are sought by what any rule needs: equal names or compact names, a distinctive word in common (but for a typo or the cut of
a name), an abbreviation, or the likeness of letters that the least score implies. No pair that a rule would take is left out, and no
country's spellings meet in one task.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import repair, text, traits
from . import names
from .clusters import components
from .pairs import restricted_components
from .similar import jaro_winkler_join
from .tables import shuffled, spread_join, stored


@dataclass(frozen=True)
class AnchorRules:
    """merge: least score of an automatic union by words; alike: least score that is proposed without a common word; proposed: least score with one."""

    merge: float = 0.84
    alike: float = 0.88
    proposed: float = 0.75
    words: traits.Rules = traits.Rules()
    names: names.NameRules = names.NameRules()
    families: dict[str, str] = field(default_factory=dict)
    strict_families: bool = False


def spellings(rows: DataFrame, families: dict[str, str], locale: str = "ES") -> DataFrame:
    """One row per spelling of rows (country, name, cut): rec_id, key, country, name, norm, alias, form (legal family), cut, n_rows.

    name may carry an alias in parentheses; norm and alias are folded, without legal forms.
    """
    each = rows.groupBy(F.coalesce("country", F.lit("")).alias("country"), F.coalesce("name", F.lit("")).alias("name")).agg(F.max(F.coalesce("cut", F.lit(False))).alias("cut"), F.count(F.lit(1)).alias("n_rows"))
    key = F.concat_ws("|", "country", "name")
    parts = text.split_alias(F.col("name"))
    form = repair.legal_family(F.col("name"), families) if families else F.lit("")
    return each.select(F.xxhash64("country", "name").alias("rec_id"), key.alias("key"), "country", "name", text.clean_name(parts["name"], locale).alias("norm"), text.clean_name(parts["alias"], locale).alias("alias"), form.alias("form"), "cut", "n_rows")


def _surfaces(found: DataFrame) -> DataFrame:
    """(rec_id, country, t, by_alias, cut): names and aliases that are not empty."""
    each = lambda c, alias: found.select("rec_id", "country", F.col(c).alias("t"), F.lit(alias).alias("by_alias"), "cut")
    return each("norm", False).unionByName(each("alias", True)).filter("t <> ''")


def _met(keyed: DataFrame, other: DataFrame | None = None) -> DataFrame:
    """(country, x, y), x < y, of texts (country, t, key) with equal keys; other: the other side's, where it has keys of its own."""
    left, right = keyed.toDF("country", "x", "key"), (keyed if other is None else other).toDF("country", "y", "key")
    found = spread_join(left.distinct(), right.distinct(), ["country", "key"]).filter("x <> y")
    return found.select("country", F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))


def text_pairs(surfaces: DataFrame, rules: AnchorRules) -> DataFrame:
    """(country, x, y), x < y, of different texts of one country that some rule may take."""
    locale, generic, edits = rules.words.locale, rules.words.generic, rules.words.max_edits
    texts = stored(surfaces.groupBy("country", "t").agg(F.max("cut").alias("cut")), "texts")
    own, useful = ("country", "t"), text.useful_words(F.col("t"), locale)
    compact = texts.select(*own, text.compact_form(F.col("t"), locale).alias("key")).filter("key <> ''")
    word = texts.select(*own, "cut", F.explode(F.filter(useful, lambda w: ~w.isin(*generic))).alias("w"))
    # words an edit apart have a form with a letter less in common, those two apart one with two less
    forms = word.filter("length(w) >= 3").select(*own, F.explode(text.deletion_variants(F.col("w"), 4)).alias("key"))
    if edits == 2:
        forms = forms.unionByName(forms.filter("length(key) >= 4").select(*own, F.explode(text.deletion_variants(F.col("key"), 4)).alias("key")))
    begun = word.filter("length(w) >= 2").select(*own, F.explode(F.transform(F.sequence(F.lit(2), F.length("w")), lambda n: F.substring("w", F.lit(1), n))).alias("key"))
    last = texts.filter("cut").select(*own, F.element_at(F.concat(F.array(F.lit("")), useful), -1).alias("key")).filter("length(key) >= 2")
    # an abbreviation begins as the first word does, or with the initials of the first words, or with two letters of the first word
    short = texts.select(*own, F.explode(traits.short_forms(F.col("t"), locale)).alias("v"))
    first, initials = F.get("v", F.lit(0)), F.array_join(F.transform("v", lambda w: F.substring(w, 1, 1)), "")
    heads = lambda c: F.transform(F.sequence(F.lit(1), F.length(c)), lambda n: F.substring(c, F.lit(1), n))
    pair = lambda a, b: F.concat(F.lit("~"), a, b)
    letters = F.transform(F.filter(F.split(first, ""), lambda c: c != ""), lambda c: pair(F.substring(first, 1, 1), c))
    long_keys = short.select(*own, F.explode(F.array_distinct(F.concat(heads(first), heads(initials), letters))).alias("key"))
    short_keys = short.select(*own, F.explode(F.array(first, pair(F.substring(first, 1, 1), F.substring(first, 2, 1)))).alias("key")).filter("length(key) > 0")
    found = _met(compact).unionByName(_met(forms)).unionByName(_met(last, begun)).unionByName(_met(short_keys, long_keys))
    # score = alpha words + (1 - alpha) letters: beyond this likeness of letters no score reaches alike
    least = (rules.alike - rules.names.alpha) / (1 - rules.names.alpha)
    alike, _ = jaro_winkler_join(texts.select(F.col("t").alias("text")), texts.select(F.col("t").alias("text")), least)
    near = alike.filter("l < r").join(shuffled(texts.select("country", F.col("t").alias("l"))), "l").join(shuffled(texts.select("country", F.col("t").alias("r"))), ["country", "r"])
    return stored(found.unionByName(near.select("country", F.col("l").alias("x"), F.col("r").alias("y"))).distinct(), "text-pairs")


def verdict(same: Column, by_alias: Column, t: Column, score: Column, agree: Column, form_x: Column, form_y: Column, rules: AnchorRules) -> Column:
    """struct(motive, automatic) of two surfaces: the first rule that holds decides; null motive where none does. Only the first four rules may unite by themselves, and only where the legal families agree."""
    forms = F.concat(F.lit("forma legal distinta ("), F.when(form_x == "", "—").otherwise(form_x), F.lit(" ≠ "), F.when(form_y == "", "—").otherwise(form_y), F.lit(")"))
    shown = F.format_number(score, 2)
    words, cut = t["SIN_SOBRAS"] & (t["N_COMPARTIDAS"] > 0), t["TRUNCADA"] & ~t["ERRATA"] & (score >= 0.75)
    said = lambda motive, auto=None: F.struct((F.lit(motive) if isinstance(motive, str) else motive).alias("motive"), (F.lit(False) if auto is None else auto).alias("automatic"))
    kind = F.when(t["TRUNCADA"], "truncamiento").otherwise("errata")
    return (
        F.when(same & ~by_alias, said(F.when(agree, "mismo nombre normalizado").otherwise(F.concat(F.lit("mismo nombre, "), forms)), agree))
        .when(by_alias & (t["SIN_SOBRAS"] | t["COMPACTO_IGUAL"]), said("coincide con el nombre entre paréntesis (¿marca?)"))
        .when(t["COMPACTO_IGUAL"] & t["MARCAS_OK"], said(F.when(agree, "mismas letras, otros espacios").otherwise("mismas letras, forma legal distinta"), agree))
        .when(t["COMPACTO_IGUAL"], said("mismas letras, pero difieren las iniciales o los números (¿otra persona o sucursal?)"))
        .when(words & t["MARCAS_OK"] & ((score >= rules.merge) | cut), said(F.when(agree, F.concat(F.lit("mismas palabras con "), kind)).otherwise(F.concat(F.lit("mismas palabras, "), forms)), agree))
        .when(words, said(F.concat(F.lit("mismas palabras (score "), shown, F.lit(")"))))
        .when((t["N_COMPARTIDAS"] > 0) & t["SOBRAS_GENERICAS"], said("un nombre contiene al otro; lo que sobra es genérico"))
        .when(t["ABREVIATURA"], said("posible sigla o abreviatura"))
        .when((t["N_COMPARTIDAS"] > 0) & (score >= rules.proposed), said(F.concat(F.lit("comparten palabra distintiva ("), t["COMPARTIDAS"], F.lit(")"))))
        .when(score >= rules.alike, said(F.concat(F.lit("nombres muy parecidos (score "), shown, F.lit(")"))))
    )


@dataclass
class Deduped:
    """spellings with group (text), unions (id_l, id_r, REGLA) that were applied, pending (id_l, id_r, MOTIVO) for review, unknown decisions."""

    spellings: DataFrame
    unions: DataFrame
    pending: DataFrame
    unknown: DataFrame


def text_traits(pairs: DataFrame, rules: AnchorRules) -> DataFrame:
    """(x, y, cut_x, cut_y, t) of the distinct rows of pairs."""
    each = pairs.select("x", "y", "cut_x", "cut_y").distinct()
    return stored(each.withColumn("t", traits.pair_traits(F.col("x"), F.col("y"), rules.words, F.col("cut_x"), F.col("cut_y"), subsequence=True)), "traits")


def judged_pairs(found: DataFrame, rules: AnchorRules) -> DataFrame:
    """(id_l, id_r, motive, automatic, score) of the spellings of one country that a rule takes; of several surfaces the automatic one, then that of the names."""
    surfaces = stored(_surfaces(found.filter("country <> ''")), "surfaces")
    pairs = text_pairs(surfaces, rules)
    weights, n = names.name_words(found.select("norm").unionByName(found.select(F.col("alias").alias("norm"))), rules.names, "norm")
    scored = names.name_similarity(pairs.select(F.col("x").alias("l"), F.col("y").alias("r")).distinct(), stored(weights, "words"), n, rules.names)
    scored = stored(scored.select(F.col("l").alias("x"), F.col("r").alias("y"), F.col("SCORE").alias("score")), "scored")
    form = found.select("rec_id", "form")
    side = lambda x: surfaces.select("country", F.col("t").alias(x), F.col("rec_id").alias(f"id_{x}"), F.col("by_alias").alias(f"alias_{x}"), F.col("cut").alias(f"cut_{x}"))
    # traits depend on two texts and whether they are cut: they are worked out once, however many countries and spellings hold these
    useful = lambda c: F.size(text.useful_words(F.col(c), rules.words.locale)) > 0
    cuts = lambda x: surfaces.select("country", F.col("t").alias(x), F.col("cut").alias(f"cut_{x}")).distinct()
    kinds = pairs.filter(useful("x") & useful("y")).join(shuffled(scored), ["x", "y"]).join(shuffled(cuts("x")), ["country", "x"]).join(shuffled(cuts("y")), ["country", "y"])
    kinds = stored(kinds.select("country", "x", "y", "cut_x", "cut_y", "score"), "kinds")
    alone = surfaces.select(F.col("t").alias("x"), F.col("t").alias("y"), F.lit(False).alias("cut_x"), F.lit(False).alias("cut_y"))
    traited = text_traits(kinds.select("x", "y", "cut_x", "cut_y").unionByName(alone), rules)
    # whether a rule takes two texts hangs on neither form nor spelling: only what one takes is spread to the spellings
    taken = lambda by_alias: verdict(F.lit(False), F.lit(by_alias), F.col("t"), F.col("score"), F.lit(True), F.lit(""), F.lit(""), rules)["motive"].isNotNull()
    met = kinds.join(shuffled(traited), ["x", "y", "cut_x", "cut_y"]).filter(taken(False) | taken(True))
    different = spread_join(spread_join(met, side("x"), ["country", "x", "cut_x"]), side("y"), ["country", "y", "cut_y"]).filter("id_x <> id_y")
    # a third of a country's spellings may have one text: those of one legal family hang on one of them, and these meet
    formed = stored(surfaces.join(shuffled(form), "rec_id"), "formed")
    heads = stored(formed.groupBy("country", "t", "form").agg(F.min(F.struct("by_alias", "rec_id")).alias("h")), "heads")
    own = spread_join(formed, heads, ["country", "t", "form"]).select("country", "t", "h", F.struct("by_alias", "rec_id").alias("o"))
    across = heads.alias("a").join(shuffled(heads.alias("b")), ["country", "t"]).filter("a.form < b.form").select("country", "t", F.col("a.h").alias("h"), F.col("b.h").alias("o"))
    equal = own.unionByName(across).filter("h.rec_id <> o.rec_id")
    equal = equal.select("country", F.col("t").alias("x"), F.col("t").alias("y"), F.lit(1.0).alias("score"), F.col("h.rec_id").alias("id_x"), F.col("h.by_alias").alias("alias_x"), F.lit(False).alias("cut_x"), F.col("o.rec_id").alias("id_y"), F.col("o.by_alias").alias("alias_y"), F.lit(False).alias("cut_y"))
    equal = equal.join(shuffled(traited), ["x", "y", "cut_x", "cut_y"])
    each = different.unionByName(equal).join(shuffled(form.toDF("id_x", "form_x")), "id_x").join(shuffled(form.toDF("id_y", "form_y")), "id_y")
    each = each.withColumn("agree", repair.families_agree(F.col("form_x"), F.col("form_y"), rules.strict_families))
    by_alias = F.col("alias_x") | F.col("alias_y")
    said = verdict(F.col("x") == F.col("y"), by_alias, F.col("t"), F.col("score"), F.col("agree"), F.col("form_x"), F.col("form_y"), rules)
    each = each.withColumn("v", said).filter("v.motive IS NOT NULL").select(F.least("id_x", "id_y").alias("id_l"), F.greatest("id_x", "id_y").alias("id_r"), "v.motive", "v.automatic", "score", by_alias.alias("by_alias"), "x", "y")
    best = each.groupBy("id_l", "id_r").agg(F.min(F.struct((~F.col("automatic")).alias("last"), "by_alias", "x", "y", "motive", "automatic", "score")).alias("b"))
    return best.select("id_l", "id_r", "b.motive", "b.automatic", "b.score")


def _decided(decisions: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id_l, id_r, same, author) by the last decision on each pair, and the decisions (key_a, key_b, why) that name no spelling or one twice.

    decisions: key_a, key_b, decision (MISMA_ENTIDAD unites, else a veto), author, number (the last one rules).
    """
    side = lambda x: keys.select(F.col("key").alias(f"key_{x}"), F.col("rec_id").alias(f"id_{x}"))
    wide = decisions.join(shuffled(side("a")), "key_a", "left").join(shuffled(side("b")), "key_b", "left")
    why = F.when(F.col("id_a").isNull() | F.col("id_b").isNull(), "desconocida").when(F.col("id_a") == F.col("id_b"), "consigo misma")
    good = wide.filter(why.isNull()).select(F.least("id_a", "id_b").alias("id_l"), F.greatest("id_a", "id_b").alias("id_r"), "decision", "author", "number")
    last = good.groupBy("id_l", "id_r").agg(F.max_by(F.struct((F.col("decision") == "MISMA_ENTIDAD").alias("same"), "author"), "number").alias("d"))
    return last.select("id_l", "id_r", "d.*"), wide.withColumn("why", why).filter("why IS NOT NULL").select("key_a", "key_b", "why")


NO_DECISIONS = "key_a string, key_b string, decision string, author string, number int"


def dedupe_anchors(rows: DataFrame, rules: AnchorRules = AnchorRules(), decisions: DataFrame | None = None) -> Deduped:
    """Groups of the spellings of rows (country, name, cut), the unions that made them and the pairs left to a person.

    Unions go by decision first, then by score (best first, ties by rec_id); one that a veto or a second legal family forbids is refused and proposed with its reason.
    """
    spark = rows.sparkSession
    found = stored(spellings(rows, rules.families, rules.words.locale), "spellings")
    decided, unknown = _decided(spark.createDataFrame([], NO_DECISIONS) if decisions is None else decisions, found)
    decided = stored(decided, "decided")
    vetoes = decided.filter("NOT same").select("id_l", "id_r")
    judged = stored(judged_pairs(found, rules).join(shuffled(vetoes), ["id_l", "id_r"], "left_anti"), "judged")
    human = decided.filter("same").select("id_l", "id_r", F.concat(F.lit("decisión: "), F.coalesce("author", F.lit(""))).alias("REGLA"), F.lit(True).alias("human"), F.lit(0).cast("long").alias("number"))
    # within a component the order of the numbers settles who comes first
    own = judged.filter("automatic").select("id_l", "id_r", F.col("motive").alias("REGLA"), F.lit(False).alias("human"), (F.lit(1) + F.round((1 - F.col("score")) * 1_000_000)).cast("long").alias("number"))
    unions = stored(human.unionByName(own), "unions")
    groups, verdicts = restricted_components(found.select("rec_id", "form"), unions.select("number", "id_l", "id_r", "human"), vetoes)
    groups = stored(groups, "groups")
    said = stored(unions.join(shuffled(verdicts.drop("number")), ["id_l", "id_r", "human"]), "verdicts")
    reasons = F.when(F.col("reason") == "veto", "una decisión DISTINTA separa a miembros de ambas empresas").otherwise("la empresa mezclaría formas legales distintas")
    refused = said.filter("NOT accepted").select("id_l", "id_r", F.concat(F.col("REGLA"), F.lit("; no se une sola: "), reasons).alias("MOTIVO"))
    pending = judged.filter("NOT automatic").select("id_l", "id_r", F.col("motive").alias("MOTIVO")).unionByName(refused)
    side = lambda x: groups.toDF(f"id_{x}", f"g{x}")
    open_pairs = pending.join(shuffled(side("l")), "id_l").join(shuffled(side("r")), "id_r").filter("gl <> gr").select("id_l", "id_r", "MOTIVO")
    return Deduped(found.join(shuffled(groups), "rec_id"), said.filter("accepted").select("id_l", "id_r", "REGLA"), open_pairs.join(shuffled(vetoes), ["id_l", "id_r"], "left_anti"), unknown)


def root_of(identifier: Column) -> Column:
    """Without what follows the first dash (a branch); of a French fourteen-digit number its company's nine digits."""
    head = F.trim(F.substring_index(identifier.cast("string"), "-", 1))
    return F.when(F.regexp_like(head, F.lit(r"^FR\d{14}$")), F.substring(head, 1, 11)).otherwise(head)


def dedupe_destinations(rows: DataFrame, by_identifier: bool, decisions: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(rec_id, group, n_in_group) and unions (id_l, id_r, REGLA) of rows (rec_id, key, name, countries).

    By identifier: rows with one root of key. Else: the same name but for case and spaces, in the same countries, where it has useful words.
    Decisions unite or forbid single pairs of keys; a veto drops the union of that pair.
    """
    spark = rows.sparkSession
    folded = F.lower(text.squeeze(F.coalesce("name", F.lit(""))))
    if by_identifier:
        keyed, rule = rows.select("rec_id", root_of(F.col("key")).alias("k")), "mismo identificador raíz"
    else:
        usable = (folded != "") & (F.size(text.useful_words(text.clean_name(F.col("name")))) > 0)
        keyed, rule = rows.filter(usable).select("rec_id", F.struct(folded.alias("n"), F.coalesce("countries", F.lit("")).alias("c")).alias("k")), "mismo nombre exacto y mismo país"
    first = keyed.groupBy("k").agg(F.min("rec_id").alias("id_l"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    own = spread_join(keyed.withColumnRenamed("rec_id", "id_r"), first.drop("n"), ["k"]).filter("id_l <> id_r").select("id_l", "id_r", F.lit(rule).alias("REGLA"))
    decided, _ = _decided(spark.createDataFrame([], NO_DECISIONS) if decisions is None else decisions, rows)
    decided = stored(decided, "decided")
    unions = own.unionByName(decided.filter("same").select("id_l", "id_r", F.concat(F.lit("decisión: "), F.coalesce("author", F.lit(""))).alias("REGLA")))
    unions = stored(unions.join(shuffled(decided.filter("NOT same")), ["id_l", "id_r"], "left_anti"), "unions")
    groups = components(rows, unions)
    sizes = groups.groupBy("group").agg(F.count(F.lit(1)).alias("n_in_group"))
    return spread_join(groups, sizes, ["group"]), unions
