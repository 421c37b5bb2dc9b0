"""Scalar column functions (O-13 .. O-23). All are built-in JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from billflow.schema import HOSTILE_CHARS, PAYOR_RECODE_FROM, PAYOR_RECODE_TO

NL = "\n"
# Python's str.split() / str.strip() treat every str.isspace() character as blank;
# Spark's trim() only removes ' '. The set is derived by rule from Python itself.
WS_CHARS = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())
_WS = "[" + "".join(f"\\u{ord(ch):04x}" for ch in WS_CHARS) + "]+"


def strip_ws(c: Column) -> Column:
    """Python ``str.strip()``: remove leading/trailing whitespace of any kind."""
    return F.btrim(c, F.lit(WS_CHARS))


def recode_contains(c: Column, needles=PAYOR_RECODE_FROM, label: str = PAYOR_RECODE_TO) -> Column:
    """O-13: any case-sensitive substring hit -> ``label``; NULL stays NULL."""
    hit = F.lit(False)
    for n in needles:
        hit = hit | F.coalesce(c.contains(n), F.lit(False))
    return F.when(hit, F.lit(label)).otherwise(c)


def code_prefix(c: Column) -> Column:
    """O-14: text before the first ':'; NULL when there is no ':'."""
    return F.when(F.instr(c, ":") > 0, F.substring_index(c, ":", 1))


def code_head(c: Column) -> Column:
    """Text before the first ':' (whole text when there is none), as a form field."""
    return F.substring_index(c, ":", 1)


def date_text(c: Column) -> Column:
    """O-15: the date part of 'MM/dd/yyyy, hh:mm AM ET' (text before ',')."""
    return F.substring_index(c, ",", 1)


def first10(c: Column) -> Column:
    return F.substring(c, 1, 10)


def strip_zone(c: Column, zone: str = " ET") -> Column:
    """'… 10:00 AM ET' -> '… 10:00 AM' (zone removed, then stripped)."""
    return strip_ws(F.replace(c, F.lit(zone), F.lit("")))


def to_service_date(c: Column) -> Column:
    """Typed date of the date text; unparseable text gives NULL (ANSI-safe)."""
    return F.try_to_date(first10(c), "MM/dd/yyyy")


def list_head(c: Column, sep: str = ",") -> Column:
    """O-16: first element of a separated list, stripped."""
    return strip_ws(F.substring_index(c, sep, 1))


def path_tail(c: Column, sep: str = "/") -> Column:
    """O-16: text after the last separator (e.g. an id at the end of a URL)."""
    return F.substring_index(c, sep, -1)


def first_token(c: Column) -> Column:
    """O-16: first whitespace-separated token (Python ``str.split()[0]``)."""
    return F.split(strip_ws(c), _WS).getItem(0)


def normalise_name(*parts: Column) -> Column:
    """O-17: join name parts with spaces, collapse runs of whitespace, strip."""
    return F.trim(F.regexp_replace(F.concat_ws(" ", *parts), _WS, " "))


def extract_codes(c: Column) -> Column:
    """O-18: every '(...)' group, dots removed, joined by ',' in order."""
    groups = F.regexp_extract_all(c, F.lit(r"\(([^)]+)\)"), 1)
    return F.array_join(F.transform(groups, lambda g: F.replace(g, F.lit("."), F.lit(""))), ",")


def sanitise(c: Column) -> Column:
    """O-20: remove file-name-hostile characters."""
    return F.translate(c, HOSTILE_CHARS, "")


def split_lines(c: Column) -> Column:
    return F.split(c, NL)


def doc_name(*parts: Column, ext: str = ".pdf") -> Column:
    """O-21: 'a_b_c_d.pdf'; NULL parts count as '' so the field count is stable."""
    return F.concat(F.concat_ws("_", *[F.coalesce(p, F.lit("")) for p in parts]), F.lit(ext))


def note_text(prefix: str, value: Column) -> Column:
    """O-22: fixed sentence + value; NULL when the value is missing."""
    return F.when(value.isNotNull(), F.concat(F.lit(prefix), value))
