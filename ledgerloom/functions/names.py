"""Column functions on entity names: the four sameness keys, annotations, legal forms, filters and dates. All native."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that mark another name, or a remark, in an annotation.
OTHER_NAME = r"(?:name\s+as\s+per\s+mca|as\s+per\s+mca|formerly(?:\s+known\s+as)?|formely(?:\s+known\s+as)?|also\s+known\s+as|now\s+known\s+as|erstwhile|previously(?:\s+known\s+as)?)\s*[-–—:,]*\s*"
REMARK = r"name\s+as\s+per|as\s+per\s+mca|formerly|formely|also\s+known|now\s+known|erstwhile|previously|under\s+liquidation|in\s+liquidation"
BARE_FORMER = r"\s*[,;(-]?\s*\b(?:formerly(?:\s+known\s+as)?|formely(?:\s+known\s+as)?|now\s+known\s+as|erstwhile(?:\s+known\s+as)?|previously(?:\s+known\s+as)?)\b\s*[-–—:,]*\s*"
MERGED = r"(?i)[\s,;(-]*\b(?:merged\s+with|amalgamated\s+with|under\s+liquidation|in\s+liquidation)\b.*$"
LEGAL_WORDS = ("LIMITED", "PRIVATE")


def _sub(c: Column, *pairs: tuple[str, str]) -> Column:
    for pattern, to in pairs:
        c = F.regexp_replace(c, pattern, to)
    return c


def normalize_name(c: Column) -> Column:
    """Legacy key: upper case, no . , ( ), short legal words, single spaces. Null: null."""
    return F.trim(_sub(F.translate(F.upper(c), ".,()", ""), (r"\bPRIVATE\b", "PVT"), (r"\bLIMITED\b", "LTD"), (r"\s+", " ")))


def canonical_key(c: Column) -> Column:
    """Key blind to case, spacing, punctuation, & or and, M/s, a leading The and the ways to write the legal form. Null: ''."""
    s = F.translate(F.upper(F.coalesce(c, F.lit(""))), "‘’`", "'''")
    s = _sub(s, (r"^\s*(?:M/S\.?|MESSRS\.?)\s+", ""), ("&", " AND "), ("'", ""), (r"[.,;:/\\\-–—_\"“”()\[\]]", " "), (r"\s+", " "))
    s = _sub(F.trim(s), (r"^THE\s+", ""), (r"(?:\bP|PRIVATE|PVT)\s*(?:LIMITED|LTD)\s*$", "PVTLTD"), (r"\bPRIVATE\b", "PVT"), (r"\s*\bLIMITED\s*$", " LTD"))
    return _sub(s, ("[^A-Z0-9]", ""))


def split_annotations(c: Column) -> Column:
    """struct(primary, aliases): bracketed remarks go, the names they hold become aliases; other brackets stay."""
    s = _sub(F.translate(F.coalesce(c, F.lit("")), "‘’`", "'''"), (r"(?i)\(\s*P\s*\)", " PVT "))
    closed = F.regexp_extract_all(s, F.lit(r"\(([^()]*)\)"), F.lit(1))
    rest = _sub(s, (rf"(?i)\([^()]*(?:{REMARK})[^()]*\)", " "))
    tail = F.regexp_extract(rest, r"\(([^()]*)$", 1)
    inner = F.filter(F.concat(closed, F.array(tail)), lambda x: x.rlike(f"(?i){REMARK}"))
    named = F.transform(inner, lambda x: F.struct(F.trim(x).alias("whole"), F.trim(F.regexp_replace(x, f"(?i)^.*?{OTHER_NAME}", "")).alias("name")))
    aliases = F.transform(F.filter(named, lambda x: (x["name"] != "") & (x["name"] != x["whole"])), lambda x: x["name"])
    primary = F.when(tail.rlike(f"(?i){REMARK}"), F.regexp_replace(rest, r"\([^()]*$", "")).otherwise(rest)
    return F.struct(F.trim(F.regexp_replace(primary, r"\s+", " ")).alias("primary"), aliases.alias("aliases"))


def _tidy(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"[)\s,;]+$", ""))


def entity_names(c: Column) -> Column:
    """struct(primary, aliases) with merger notes cut, and former names without brackets split off too."""
    a = split_annotations(c)
    p = _tidy(F.regexp_replace(a["primary"], MERGED, ""))
    whole = f"(?i)^(.*?){BARE_FORMER}(.*)$"
    before = F.trim(F.regexp_replace(F.regexp_extract(p, whole, 1), r"[\s,;(-]+$", ""))
    after = F.when(before != "", _tidy(F.regexp_replace(F.regexp_extract(p, whole, 2), MERGED, ""))).otherwise("")
    aliases = F.filter(F.concat(F.transform(a["aliases"], _tidy), F.array(after)), lambda x: x != "")
    return F.struct(F.when(before != "", before).otherwise(p).alias("primary"), aliases.alias("aliases"))


def repair_legal_form(c: Column) -> Column:
    """Runs of five to eight letters within one edit of a legal word become that word."""

    def fixed(w: Column) -> Column:
        u, out = F.upper(w), w
        for word in reversed(LEGAL_WORDS):
            out = F.when((F.length(w) >= 5) & (F.levenshtein(u, F.lit(word), 1) == 1), F.lit(word)).otherwise(out)
        return out

    return F.array_join(F.transform(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"[A-Za-z]{5,8}|[A-Za-z]{1,4}|[^A-Za-z]+"), F.lit(0)), fixed), "")


def is_english_name(c: Column) -> Column:
    return ~c.rlike(r"[^\x{0000}-\x{024F}\x{2000}-\x{206F}\x{20A0}-\x{20CF}]") & (F.regexp_count(c, F.lit("[A-Za-z]")) >= 3)


def digits_of(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def within_one_edit(a: Column, b: Column) -> Column:
    return (F.levenshtein(a, b, 1) >= 0) & (F.levenshtein(a, b, 1) <= 1)


def long_date(c: Column) -> Column:
    """Date of 'March 5, 2024', '5 March 2024' or '5-Mar-2024', months whole or in three letters; null for anything else."""
    words = F.initcap(F.trim(F.regexp_replace(c, r"[\s,\-]+", " ")))
    forms = ("MMMM d yyyy", "MMM d yyyy", "d MMMM yyyy", "d MMM yyyy")
    return F.coalesce(*[F.try_to_timestamp(words, F.lit(f)) for f in forms]).cast("date")


def master_list_date(c: Column) -> Column:
    """Date after 'as on' or 'as of', in either order of day and month; null if there is none."""
    return long_date(F.regexp_extract(c, r"(?i)as\s+(?:on|of)\s+([A-Za-z]+\s+\d{1,2},?\s+\d{4}|\d{1,2}[\s\-][A-Za-z]+[\s\-]\d{4})", 1))


def category_key(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(F.lower(F.coalesce(c, F.lit(""))), "()", ""), r"\s+", " "))
