"""Text cleaning and formatting as Column expressions."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace is the Unicode property and the four ASCII separators. As characters:
WHITESPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same as the body of a regex class.
WHITESPACE = r"\p{IsWhite_Space}\x1c-\x1f"

# A whitespace run, unless it is a single plain space, which would only be replaced by itself.
WHITESPACE_RUN = rf"(?! [^{WHITESPACE}])[{WHITESPACE}]+"

# Control and format characters; the last four items are format characters that the
# Unicode version of JDK 17 does not know yet.
CONTROLS = r"\p{Cc}\p{Cf}\x{890}\x{891}\x{13439}-\x{1343F}"

# Emoji blocks.
EMOJI = (
    r"\x{1F300}-\x{1F5FF}\x{1F600}-\x{1F64F}\x{1F680}-\x{1FAFF}"
    r"\x{2600}-\x{26FF}\x{2700}-\x{27BF}"
)

# Cleaning rules and their defaults.
DEFAULT_RULES: dict[str, Any] = {
    "normalize_unicode_nfkc": True,
    "remove_control_chars": True,
    "remove_emojis": False,
    "remove_urls": True,
    "remove_mentions": False,
    "remove_hashtags": False,
    "collapse_whitespace": True,
    "strip": True,
    "lowercase_latin": False,
    "max_length": 0,
}

# "intended" does what the rule names say. "literal" keeps the exact output of a rule set whose
# patterns double every backslash, so that they only match texts holding a backslash.
PATTERNS: dict[str, dict[str, str]] = {
    "intended": {
        "remove_urls": rf"(?:[hH][tT][tT][pP][sS\x{{17F}}]?://|[wW]{{3}}\.)[^{WHITESPACE}]+",
        "remove_mentions": r"@[\p{L}\p{N}_]+",
        "remove_hashtags": r"#[\p{L}\p{N}_]+",
        "collapse_whitespace": WHITESPACE_RUN,
    },
    "literal": {
        "remove_urls": r"(?iu)(https?://\\S+|www\\.\\S+)",
        "remove_mentions": r"@\\w+",
        "remove_hashtags": r"#\\w+",
        "collapse_whitespace": r"\\s+",
    },
}

# Characters that NFKC leaves alone and that never combine with a neighbour of the same set: ASCII,
# composed Latin, Greek and Cyrillic letters, kana, common Han, Hangul syllables, general quotes.
NFKC_STABLE = (
    r"\x00-\x7F\x{C0}-\x{131}\x{134}-\x{13E}\x{141}-\x{148}\x{14A}-\x{17E}"
    r"\x{391}-\x{3A1}\x{3A3}-\x{3CE}\x{400}-\x{481}\x{2013}\x{2014}\x{2018}-\x{201E}"
    r"\x{3001}-\x{3002}\x{3041}-\x{3096}\x{30A1}-\x{30FA}\x{4E00}-\x{9FFF}\x{AC00}-\x{D7A3}"
)

# ASCII is settled by the first class, before the list of ranges is looked at.
NFKC_UNSTABLE = rf"[[^\x00-\x7F]&&[^{NFKC_STABLE}]]"


def nfkc(text: Column) -> Column:
    """Unicode NFKC, in the JVM: Spark ships the ICU library for its collations, and ``reflect`` calls it.

    Only texts that the character test finds unstable are normalised. The tables are those of ICU's
    Unicode version; characters that it assigns and an older Python does not are the only difference.
    """
    folded = F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), text, F.lit(True))
    return F.when(text.rlike(NFKC_UNSTABLE), folded).otherwise(text)


def strip(text: Column) -> Column:
    """Strip Unicode whitespace on both sides."""
    return F.btrim(text, F.lit(WHITESPACE_CHARS))


def or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def non_empty(text: Column) -> Column:
    """True unless the text is null or only whitespace."""
    return or_empty(text).rlike(rf"[^{WHITESPACE}]")


def clean_text(
    text: Column, rules: Mapping[str, Any] | None = None, patterns: str = "intended"
) -> Column:
    """The cleaning rules in their fixed order; a key that is missing takes its default."""
    if patterns not in PATTERNS:
        raise ValueError(f"patterns must be one of {sorted(PATTERNS)}, got {patterns!r}")
    wanted = {**DEFAULT_RULES, **(rules or {})}
    regex = PATTERNS[patterns]
    out = or_empty(text)
    if wanted["normalize_unicode_nfkc"]:
        out = nfkc(out)
    if wanted["remove_control_chars"]:
        out = F.regexp_replace(out, rf"[\p{{C}}&&[{CONTROLS}]]+", "")
    for rule in ("remove_urls", "remove_mentions", "remove_hashtags"):
        if wanted[rule]:
            out = F.regexp_replace(out, regex[rule], " ")
    if wanted["remove_emojis"]:
        out = F.regexp_replace(out, rf"[[^\x00-\x{{25FF}}]&&[{EMOJI}]]+", " ")
    if wanted["lowercase_latin"]:
        out = F.lower(out)
    if wanted["collapse_whitespace"]:
        out = F.regexp_replace(out, regex["collapse_whitespace"], " ")
    if wanted["strip"]:
        out = strip(out)
    max_length = int(wanted["max_length"] or 0)
    if max_length > 0:
        out = F.substring(out, 1, max_length)
    return out


def single_line(text: Column) -> Column:
    """Every whitespace run becomes one space, ends stripped: one text per output line."""
    return strip(F.regexp_replace(text, WHITESPACE_RUN, " "))


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def file_stem(path: Column) -> Column:
    """File name without its last suffix; a name that only starts with a dot keeps it."""
    return F.regexp_replace(file_name(path), r"(?s)^(\.*[^.].*)\.[^.]*$", "$1")


def media_url(item_id: Column, prefix: str) -> Column:
    return F.concat(F.lit(prefix + "/"), item_id, F.lit(".mp4"))


def item_label(item_id: Column, title: Column) -> Column:
    """``id  (title)``, or the id alone where the title is empty."""
    return F.when(title != "", F.concat(item_id, F.lit("  ("), title, F.lit(")"))).otherwise(item_id)
