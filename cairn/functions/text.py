"""Text functions as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[ \t\n\x0B\f\r]+"


def collapse(c: Column, unicode: bool = False) -> Column:
    """White space runs become one space, ends are trimmed; null is empty.  `unicode` takes all of Unicode's white space."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+" if unicode else SPACE, " "))


def before_first(c: Column, mark: str) -> Column:
    """The text before the first mark, or all of it."""
    return F.substring_index(c, mark, 1)


def after_first(c: Column, mark: str) -> Column:
    """The text after the first mark, or nothing."""
    at = F.instr(c, mark)
    return F.when(at > 0, F.substr(c, at + F.lit(len(mark)))).otherwise(F.lit(""))


def reverse_complement(c: Column) -> Column:
    return F.reverse(F.translate(c, "ACGTUacgtu", "TGCAAtgcaa"))


def geo(c: Column) -> Column:
    """country, admin1, locality and basis of `Country: Admin1, detail`.

    Detail after a comma makes the whole remainder the locality; without one the remainder is the
    first-order division; no remainder and no text are told apart.
    """
    text = collapse(c)
    rest = F.trim(after_first(text, ":"))
    detailed = F.instr(rest, ",") > 0
    return F.struct(
        F.trim(before_first(text, ":")).alias("country"),
        F.trim(before_first(rest, ",")).alias("admin1"),
        F.when(detailed, rest).otherwise("").alias("locality"),
        F.when(text == "", "no_geography_deposited").when(rest == "", "no_admin1_deposited").when(detailed, "deposited_locality").otherwise("admin1_only").alias("basis"),
    )


#: names of virus types, first match wins: (pattern, prefix)
TYPE_LADDER = (
    (r"(?i)\bpoliovirus\s+(?:type\s+)?([123])(?![0-9])", "PV"),
    (r"(?i)\bcoxsackievirus\s+([ab][0-9]+)\b", "CV"),
    (r"(?i)\bechovirus\s+(?:type\s+)?([0-9]+)\b", "E"),
    (r"(?i)\benterovirus\s+([a-d][0-9]+)\b", "EV-"),
    (r"(?i)\brhinovirus\s+([a-c][0-9]+)\b", "RV-"),
)


def virus_type(c: Column) -> Column:
    """The type that a name states, by an ordered ladder; empty if it states none."""
    out = F.lit("")
    for pattern, prefix in reversed(TYPE_LADDER):
        got = F.upper(F.regexp_extract(c, pattern, 1))
        out = F.when(got != "", F.concat(F.lit(prefix), got)).otherwise(out)
    return out


def family(c: Column) -> Column:
    """The family of a type by its prefix."""
    return F.when(c == "", "unknown").when(c.startswith("PV"), "Poliovirus").when(c.startswith("CVA"), "Coxsackie A").when(c.startswith("CVB"), "Coxsackie B").when(c.startswith("EV-"), "Enterovirus").when(c.startswith("RV-"), "Rhinovirus").otherwise("Echovirus")


def labelled(c: Column) -> Column:
    """The map of a `k=v; k=v` text; blank parts are skipped."""
    parts = F.filter(F.transform(F.split(c, ";"), lambda p: F.trim(p)), lambda p: p != "")
    return F.map_from_entries(F.transform(parts, lambda p: F.struct(F.trim(F.substring_index(p, "=", 1)).alias("key"), F.trim(after_first(p, "=")).alias("value"))))
