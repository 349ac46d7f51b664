"""Repairs of texts and identifiers before comparison, as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .identifiers import check_digit, let

#: Letters that are UTF-8 read as Latin-1: each letter stands for its own two bytes (fixed values).
BROKEN_LETTERS = "ÑÓÉÍÚÁñóéíúá"
#: Digits that scanned texts confuse with letters (fixed values).
OCR_DIGITS, OCR_LETTERS = "012345678", "OIZEASGTB"
#: Signs that reports do not print, from arrows to the last block of pictographs (fixed values).
SIGNS = r"[\x{2190}-\x{21FF}\x{2300}-\x{23FF}\x{2460}-\x{24FF}\x{25A0}-\x{25FF}\x{2600}-\x{26FF}\x{2700}-\x{27BF}\x{2B00}-\x{2BFF}\x{FE00}-\x{FE0F}\x{1F000}-\x{1F02F}\x{1F0A0}-\x{1F0FF}\x{1F100}-\x{1F1FF}\x{1F200}-\x{1F2FF}\x{1F300}-\x{1F5FF}\x{1F600}-\x{1F64F}\x{1F650}-\x{1F67F}\x{1F680}-\x{1F6FF}\x{1F700}-\x{1F77F}\x{1F780}-\x{1F7FF}\x{1F800}-\x{1F8FF}\x{1F900}-\x{1F9FF}\x{1FA00}-\x{1FA6F}\x{1FA70}-\x{1FAFF}]+"


def broken(letter: str) -> str:
    """The two characters that a letter's UTF-8 bytes show as in Latin-1."""
    return letter.encode("utf-8").decode("latin-1")


def repair_encoding(c: Column) -> Column:
    """Spanish letters whose UTF-8 bytes were read as Latin-1, mended."""
    return reduce(lambda text, letter: F.replace(text, F.lit(broken(letter)), F.lit(letter)), BROKEN_LETTERS, c)


def strip_quote_artifacts(c: Column) -> Column:
    """Runs of equal quotes become a space, quotes at the ends go; single quotes inside stay."""
    runs = F.regexp_replace(F.regexp_replace(c, "'{2,}", " "), '"{2,}', " ")
    return F.trim(F.regexp_replace(F.regexp_replace(runs, r"""^[\s'"]+|[\s'"]+$""", ""), r"\s+", " "))


def ocr_letters(c: Column) -> Column:
    """Digits replaced by the letters that scans take for them; null: empty."""
    return F.translate(F.coalesce(c, F.lit("")), OCR_DIGITS, OCR_LETTERS)


def consonant_keys(c: Column) -> Column:
    """struct(consonants, initials): the first 10 letters that are no capital vowels, and the initials of the first 6 words."""
    text = F.coalesce(c, F.lit(""))
    initials = F.transform(F.filter(F.split(text, r"\s+"), lambda w: w != ""), lambda w: F.substring(w, 1, 1))
    return F.struct(F.substring(F.regexp_replace(text, r"[^\p{L}]|[AEIOU]", ""), 1, 10).alias("consonants"), F.substring(F.array_join(initials, ""), 1, 6).alias("initials"))


def strip_signs(c: Column) -> Column:
    """Without emoji and other signs, white space squeezed."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, SIGNS, ""), r"\s+", " "))


def fix_nit(c: Column) -> Column:
    """struct(base, ok, origin): identifiers with letters stay whole (none); nine digits get their check digit (computed);
    others stay whole, declared where they hold ten digits or more or end in a dash and a digit."""

    def typed(x: Column) -> Column:
        raw, d = x["raw"], x["d"]
        declared = F.regexp_like(raw, F.lit(r"^\d{9,}-\d$")) | (F.length(d) >= 10)
        made = lambda base, ok, origin: F.struct(base.alias("base"), ok.alias("ok"), F.lit(origin).alias("origin"))
        whole = lambda origin: made(d, d, origin)
        return (
            F.when(F.regexp_like(raw, F.lit("[A-Za-z]")), made(raw, raw, "none"))
            .when(d == "", made(F.lit(""), F.lit(""), "none"))
            .when(F.length(d) == 9, made(d, F.concat(d, check_digit(d).cast("string")), "computed"))
            .when(declared, whole("declared"))
            .otherwise(whole("computed"))
        )

    raw = F.trim(F.coalesce(c.cast("string"), F.lit("")))
    return let(F.struct(raw.alias("raw"), F.regexp_replace(F.substring_index(raw, ".", 1), r"\D", "").alias("d")), typed)


def nit_code(c: Column) -> Column:
    """length * 10**16 + value of up to 15 digits; -1 for anything else. Leading zeros tell codes apart."""
    good = F.regexp_like(F.coalesce(c, F.lit("")), F.lit(r"^\d{1,15}$"))
    return F.when(good, F.length(c).cast("long") * F.lit(10**16) + F.when(good, c).cast("long")).otherwise(F.lit(-1).cast("long"))


def legal_family(c: Column, families: dict[str, str]) -> Column:
    """The first family (in their order) whose pattern the name holds, '' for none. Parentheses and marks go, single letters join."""
    name = F.upper(F.coalesce(c, F.lit("")))
    name = F.regexp_replace(F.regexp_replace(name, r"\([^()]*\)?", " "), r"[.,;:/\-]", " ")
    name = F.trim(F.regexp_replace(F.regexp_replace(name, r"\s+", " "), r"\b([A-Z]) (?=[A-Z]\b)", "$1"))
    return let(name, lambda n: reduce(lambda rest, item: F.when(F.regexp_like(n, F.lit(item[1])), F.lit(item[0])).otherwise(rest), reversed(families.items()), F.lit("")))


def families_agree(a: Column, b: Column, strict: bool = False) -> Column:
    """Equal families, or one unknown; if strict only equal ones."""
    return a == b if strict else (a == b) | (a == "") | (b == "")
