"""Column helpers for text."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from faultline.config import ACCENTS_FROM, ACCENTS_TO


def blank_to_null(col: Column) -> Column:
    """Trim spaces (only spaces, as SQL TRIM does) and turn an empty text into null."""
    return F.nullif(F.trim(col), F.lit(""))


def fold_text(col: Column) -> Column:
    """Upper-case text without accents and with single blanks, for comparisons."""
    plain = F.translate(F.upper(F.trim(col)), ACCENTS_FROM, ACCENTS_TO)
    return F.regexp_replace(plain, r"\s+", " ")


def matches_folded(col: Column, folded: str) -> Column:
    """``fold_text(col) == folded`` as one regular expression that gives up at the first letter.

    Every letter becomes the class of its accented forms; blanks stand for runs of white space.
    """
    accented: dict[str, str] = {}
    for source, target in zip(ACCENTS_FROM, ACCENTS_TO):
        accented[target] = accented.get(target, "") + source
    letters = "".join(r"\s+" if c == " " else f"[{c}{accented[c]}]" if c in accented else re.escape(c) for c in folded)
    return col.rlike(rf"(?iu)\A *{letters} *\z")


def yes_no_flag(col: Column) -> Column:
    """SIM -> true, NAO -> false, anything else -> null, ignoring case."""
    answer = F.upper(col)
    return F.when(answer == "SIM", True).when(answer == "NAO", False)


def stable_key(prefix: str, *parts: Column) -> Column:
    """Short identifier that depends only on its parts: prefix plus 12 hex digits."""
    digest = F.sha2(F.concat_ws("|", *parts), 256)
    return F.concat(F.lit(prefix), F.upper(F.substring(digest, 1, 12)))
