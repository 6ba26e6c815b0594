"""Cell text and number rules as Column expressions; all stay inside the JVM.

White space is Unicode-aware (``(?U)``), as cells may be bilingual.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values
CID = r"\(cid:\d+\)"
BLANKS = "[\u00a0\u2000-\u200a\u202f\u205f\u3000\t]+"
DASHES = "[\u2013\u2014\u2212\u2010\u2011\u2012\u2015]+"
DEVANAGARI = "[ऀ-ॿ]+"
DOUBLE_QUOTES = "“”„‟"
SINGLE_QUOTES = "‘’‚‛"
YEAR_LABEL = r"\b20\d{2}-\d{2}\b"
SECTION_WORDS = {"EHT": r"\beht\b|extra high", "LT": r"\blt\b|low tension", "HT": r"\bht\b|high tension"}
UNIT_RULES = [
    ("paise/kWh", ["paise/kwh", "p/kwh"]),
    ("Rs/kW/month", ["rs/kw/month", "rs/kw/m", "rs./kw/month"]),
    ("Rs/kVA/month", ["rs/kva/month", "rs/kva/m"]),
    ("Rs/MW/month", ["rs/mw/month", "rs/mw/m"]),
    ("Rs/MW/day", ["rs/mw/day", "rs/mw/d"]),
    ("Rs/MWh", ["rs/mwh"]),
    ("%", ["%", "percent"]),
    ("Rs Cr.", ["rs cr", "rs. cr"]),
    ("Rs/kWh", ["rs/kwh", "rs./kwh"]),
]
ZERO_WORDS = ["nil", "zero", "0"]
MISSING_WORDS = ["n/a", "na", "not applicable", "not available", "--"]


def strip(c: Column) -> Column:
    # one match from the start on; a search for either end tries every letter
    return F.regexp_extract(c, r"(?Us)\A\s*(.*\S)?", 1)


def is_blank(c: Column) -> Column:
    return ~c.rlike(r"(?U)\S")


def _squeeze(c: Column) -> Column:
    c = F.regexp_replace(c, r"(?U)\s+", " ")
    c = F.regexp_replace(c, r"(?U)^[\s/]+", "")
    c = F.regexp_replace(c, r"(?U)[\s/]+$", "")
    return strip(F.regexp_replace(c, r"\*+$", ""))


def clean_text(c: Column) -> Column:
    """E5: drop NULs and OCR tokens, unify spaces, dashes and quotes, squeeze and strip."""
    c = F.regexp_replace(F.coalesce(c, F.lit("")), "\x00", "")
    c = F.regexp_replace(c, CID, "")
    c = F.regexp_replace(F.regexp_replace(c, BLANKS, " "), DASHES, "-")
    c = F.translate(F.translate(c, DOUBLE_QUOTES, '"' * 4), SINGLE_QUOTES, "'" * 4)
    return _squeeze(c)


def extract_english(c: Column) -> Column:
    """Drop Devanagari, squeeze and strip."""
    return _squeeze(F.regexp_replace(F.coalesce(c, F.lit("")), DEVANAGARI, ""))


def clean_cell(c: Column) -> Column:
    """E5 and E6 together.

    Most cells are plain, that is printable ASCII between single spaces, without OCR tokens
    and without marks or slashes at their ends; no rule changes those, so they skip the rules.
    """
    plain = c.rlike(r"\A(?:[!-.0-~][ -~]*)?[!-)+-.0-~]\z") & ~F.contains(c, F.lit("  ")) & ~F.contains(c, F.lit("(cid:"))
    return F.when((c == "") | plain, c).otherwise(extract_english(clean_text(c)))


def latin_tokens(c: Column) -> Column:
    """E6, variant: only the tokens with a Latin letter."""
    return F.array_join(F.filter(F.split(F.coalesce(c, F.lit("")), " "), lambda t: t.rlike("[A-Za-z]")), " ")


def after_last_slash(c: Column) -> Column:
    """E6, variant: the text after the last slash."""
    return strip(F.element_at(F.split(F.coalesce(c, F.lit("")), "/"), -1))


def count_artifacts(c: Column) -> Column:
    """Number of OCR tokens in a cell."""
    return F.coalesce(F.regexp_count(c, F.lit(CID)), F.lit(0))


def normalize_key(c: Column) -> Column:
    """Comparison key without marks; ``&`` is ``and``."""
    c = F.regexp_replace(F.coalesce(c, F.lit("")), CID, "")
    c = F.regexp_replace(F.lower(c), "[/*]", "")
    c = F.regexp_replace(c, "&", " and ")
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def compress_row(cells: Column) -> Column:
    """The non-blank cells of a row, trimmed."""
    return F.filter(F.transform(cells, strip), lambda c: c != "")


def extract_unit(c: Column, default: str = "Rs/kWh") -> Column:
    """First unit rule that the text contains."""
    low = F.lower(F.coalesce(c, F.lit("")))
    out = F.lit(default)
    for unit, words in reversed(UNIT_RULES):
        hit = F.lit(False)
        for w in words:
            hit = hit | low.contains(w)
        out = F.when(hit, unit).otherwise(out)
    return out


def extract_voltage(c: Column) -> Column:
    """EHT, LT, HT with its level, a bare level, or ``all``; words count whole."""
    low = F.lower(F.coalesce(c, F.lit("")))
    level = F.regexp_extract(low, r"\b(\d+)\s*kv\b", 1)
    return (
        F.when(low.rlike(SECTION_WORDS["EHT"]), "EHT")
        .when(low.rlike(SECTION_WORDS["LT"]), "LT")
        .when(low.rlike(SECTION_WORDS["HT"]) & (level != ""), F.concat(F.lit("HT - "), level, F.lit(" kV")))
        .when(low.rlike(SECTION_WORDS["HT"]), "HT")
        .when(level != "", F.concat(level, F.lit(" kV")))
        .otherwise("all")
    )


def parse_number(c: Column, annotation: Column | None = None) -> Column:
    """H6: first signed decimal, commas ignored; null where the cell is annotated as no number."""
    bare = F.replace(F.coalesce(c, F.lit("")), F.lit(","), F.lit(""))
    number = F.regexp_extract(bare, r"[-+]?\d+(?:\.\d+)?", 0).try_cast("double")
    if annotation is None:
        return number
    return F.when(~F.coalesce(annotation, F.lit("")).isin("year", "voltage", "state", "utility", "serial", "header"), number)


def parse_sentinel_number(c: Column) -> Column:
    """Nil is 0, n/a is null, else the first decimal, else what digits and points leave."""
    text = F.coalesce(c, F.lit(""))
    word = F.lower(strip(text))
    decimal = F.regexp_extract(text, r"\b\d+\.\d+\b", 0)
    digits = F.regexp_replace(text, r"[^\d.]", "")
    return (
        F.when(word.isin(ZERO_WORDS), F.lit(0.0))
        .when(word.isin(MISSING_WORDS), F.lit(None).cast("double"))
        .when(decimal != "", decimal.try_cast("double"))
        .otherwise(digits.try_cast("double"))
    )


def record_id(*parts: Column) -> Column:
    """First 16 hex digits of the SHA-256 of the lower-cased parts."""
    joined = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.substring(F.sha2(F.lower(joined), 256), 1, 16)
