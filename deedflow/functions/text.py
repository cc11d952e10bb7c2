"""Name, number, postcode and list normalisers, as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Company-form endings, in matching order.
NAME_ENDINGS = r"(LIMITED LIABILITY PARTNERSHIP|LIMITED|COMPANY|LTD\.|LLP|LTD|PLC|CO\.|CO)"
NAME_ENDINGS_ANCHORED = r"(LIMITED LIABILITY PARTNERSHIP|LIMITED|COMPANY|LTD\.|LLP|LTD|PLC|CO\.|CO|LP|L\.P\.)"
# Short forms and what they stand for.
LONG_FORMS = {"LTD": "LIMITED", "CO": "COMPANY", "PLC": "PUBLIC LIMITED COMPANY", "LLP": "LIMITED LIABILITY PARTNERSHIP"}

_EDGES = r"(?U)^\s+|\s+$"


def strip(c: Column) -> Column:
    """Drop Unicode white space from both ends."""
    return F.regexp_replace(c, _EDGES, "")


def blank(c: Column) -> Column:
    return c.isNull() | (strip(c) == "")


def present(c: Column) -> Column:
    """Neither null nor empty."""
    return c.isNotNull() & (c != "")


def clean(c: Column) -> Column:
    """Collapse white space; empty becomes null."""
    # What is left of outer white space is one blank: no second search is needed to drop it.
    return F.nullif(F.trim(F.regexp_replace(c, r"(?U)\s+", " ")), F.lit(""))


def clean_none(c: Column) -> Column:
    """clean(), with the word NONE in any case as null."""
    tidy = clean(c)
    return F.when(F.upper(tidy) != "NONE", tidy)


def strip_nul(c: Column) -> Column:
    """Drop NUL characters and outer white space; null becomes empty."""
    return F.coalesce(strip(F.replace(c, F.lit("\u0000"), F.lit(""))), F.lit(""))


def _alnum(c: Column) -> Column:
    return F.regexp_replace(c, r"[^\p{L}\p{N}]", "")


def _joined(c: Column) -> Column:
    """Upper case without the words that join names."""
    return reduce(lambda x, w: F.replace(x, F.lit(w), F.lit(" ")), (" AND ", " & "), strip(F.upper(c)))


def name_key(c: Column, mode: str = "reference") -> Column:
    """Matching key of a company name.

    "reference": everything from the first ending on goes, with no word boundary, so any CO cuts a name short.
    "strict": only a whole word at the end of the name counts as an ending.
    """
    if mode == "reference":
        # White space before the ending goes with the rest below; leaving it out of the pattern keeps the search cheap.
        cut = F.regexp_replace(_joined(c), NAME_ENDINGS + r".*$", "")
    elif mode == "strict":
        cut = F.regexp_replace(_joined(c), r"(?U)(^|\s+)" + NAME_ENDINGS_ANCHORED + r"\s*$", "")
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return F.coalesce(_alnum(cut), F.lit(""))


def name_key_anchored(c: Column) -> Column:
    """Key with punctuation dropped first and one ending removed at the end, with or without a boundary."""
    flat = reduce(lambda x, w: F.replace(x, F.lit(w), F.lit("")), (".", ","), _joined(c))
    return F.coalesce(_alnum(F.regexp_replace(flat, r"(?U)\s*" + NAME_ENDINGS_ANCHORED + "$", "")), F.lit(""))


def name_key_full(c: Column) -> Column:
    """Key that keeps the company form, written out."""
    flat = F.regexp_replace(_joined(c), r"[.,\-()/\\]", "")
    long = reduce(lambda x, kv: F.regexp_replace(x, rf"(?U)\b{kv[0]}\b", kv[1]), LONG_FORMS.items(), flat)
    return F.coalesce(_alnum(long), F.lit(""))


def name_key_ascii(c: Column) -> Column:
    """Key of ASCII letters and digits, one anchored ending removed."""
    return F.regexp_replace(F.regexp_replace(F.upper(c), r"\s*" + NAME_ENDINGS_ANCHORED + "$", ""), "[^A-Z0-9]", "")


def number_key(c: Column) -> Column:
    """Registration number without punctuation; digits alone are padded to eight, longer ones kept."""
    flat = F.regexp_replace(F.upper(strip(c)), "[^A-Z0-9]", "")
    padded = F.when(flat.rlike("^[0-9]+$") & (F.length(flat) < 8), F.lpad(flat, 8, "0")).otherwise(flat)
    return F.coalesce(padded, F.lit(""))


def number_spellings(c: Column) -> Column:
    """Distinct spellings under which a registration number may be filed."""
    flat = F.upper(strip(c))
    bare = F.regexp_replace(flat, "^[A-Z]+", "")
    core = F.regexp_replace(bare, "^0+", "")
    return F.array_distinct(F.filter(F.array(flat, number_key(c), bare, F.when(F.length(core) < 8, F.lpad(core, 8, "0")).otherwise(core), core), lambda x: present(x)))


def outward_postcode(c: Column) -> Column:
    """The part before the first space; the whole where there is none."""
    return F.split_part(c, F.lit(" "), F.lit(1))


def find_postcode(c: Column) -> Column:
    """The first UK postcode in a text, or null."""
    return F.nullif(F.regexp_extract(c, r"\b([A-Z]{1,2}[0-9][A-Z0-9]?\s*[0-9][A-Z]{2})\b", 1), F.lit(""))


def sic_codes(c: Column, most: int = 4) -> Column:
    """The first five-digit codes of a text."""
    return F.slice(F.coalesce(F.regexp_extract_all(c, F.lit(r"\b(\d{5})\b"), F.lit(1)), F.array().cast("array<string>")), 1, most)


def split_list(c: Column, distinct: bool = True, sep: str = "|") -> Column:
    """Trimmed non-empty items, in order, each once unless distinct is off."""
    items = F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), "[" + sep + "]"), strip), lambda x: x != "")
    return F.array_distinct(items) if distinct else items


def search_meta(c: Column) -> Column:
    """struct(number, company_type, status) of 'number - type, status' or 'number - Dissolved on ...' lines."""
    rest = F.when(F.instr(c, " - ") > 0, F.expr("''")).isNotNull()
    number = strip(F.split_part(c, F.lit(" - "), F.lit(1)))
    after = F.regexp_extract(c, r"(?s)^.*? - (.*)$", 1)
    listed = F.instr(after, ", ") > 0
    kind = F.when(listed, strip(F.regexp_extract(after, r"(?s)^(.*), ", 1))).when(after.rlike("Dissolved|Liquidation"), "Company")
    status = F.when(listed, strip(F.regexp_extract(after, r"(?s)^.*, (.*)$", 1))).otherwise(strip(after))
    return F.struct(F.when(rest, number).alias("number"), F.when(rest, kind).alias("company_type"), F.when(rest, status).alias("status"))
