"""Date parsing expressions.

``try_to_date`` returns NULL for text that does not fit a format, under ANSI
mode too, so a ``coalesce`` over formats tries them in order. A failed parse
costs a Java exception, though, so each format is first tested against a
cheap regex of its shape (a superset of what the parser accepts); text of
another shape skips the parser.
"""

from __future__ import annotations

import re

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from regstar.domain import registrations as R


def shape_guard(fmt: str) -> str | None:
    """Regex of the text shapes ``fmt`` can parse, for all-numeric formats.

    One pattern letter: one or more digits; two: exactly two digits; a year of
    three or more letters: that many digits or more. Every field may carry a
    '+' sign (the guard only has to be a superset of what parses).
    Formats with text fields or quotes get no guard (None).
    """
    if "'" in fmt:
        return None
    out = []
    for run in re.finditer(r"([A-Za-z])\1*|[^A-Za-z]", fmt):
        tok = run.group(0)
        letter = tok[0]
        if not letter.isalpha():
            out.append(re.escape(tok))
        elif letter not in "yMdHmsSu" or (letter == "M" and len(tok) > 2):
            return None
        elif letter in "yu" and len(tok) >= 3:
            out.append(rf"\+?\d{{{len(tok)},}}")
        elif len(tok) == 1:
            out.append(r"\+?\d+")
        else:
            out.append(rf"\+?\d{{{len(tok)}}}")
    return "^" + "".join(out) + "$"


def try_parse(norm: Column, fmt: str) -> Column:
    guard = shape_guard(fmt)
    parsed = F.try_to_date(norm, fmt)
    return parsed if guard is None else F.when(norm.rlike(guard), parsed)


def normalize_date_text(c: Column, separators: str = R.DATE_SEPARATORS) -> Column:
    """Trim, and turn '-', '.' and '\\' into '/'."""
    return F.regexp_replace(F.trim(c.cast("string")), separators, "/")


def parse_normalized(norm: Column, formats: Sequence[str] = R.DATE_FORMATS) -> Column:
    """The first format that parses already normalised text."""
    return F.coalesce(*[try_parse(norm, f) for f in formats], F.lit(None).cast("date"))


def parse_dates(c: Column, formats: Sequence[str] = R.DATE_FORMATS,
                separators: str = R.DATE_SEPARATORS) -> Column:
    """Trim, turn '-', '.' and '\\' into '/', then the first format that parses."""
    return parse_normalized(normalize_date_text(c, separators), formats)


def century_fix(d: Column) -> Column:
    """Years below 100 move forward 2000 years (0023 -> 2023)."""
    return F.when(F.year(d) < 100, F.add_months(d, 2000 * 12)).otherwise(d)


def parse_dates_fixed(c: Column, formats: Sequence[str] = R.DATE_FORMATS) -> Column:
    return century_fix(parse_dates(c, formats))


def with_parsed_dates(df, sources: dict, formats: Sequence[str] = R.DATE_FORMATS):
    """Add parsed, century-fixed dates {out: source column} in three projections.

    Computing the normalised text and the raw parse as their own columns keeps
    each expression small (one regex per row, not one per format branch).
    """
    df = df.withColumns({f"_{o}_n": normalize_date_text(F.col(s)) for o, s in sources.items()})
    df = df.withColumns({f"_{o}_p": parse_normalized(F.col(f"_{o}_n"), formats) for o in sources})
    df = df.withColumns({o: century_fix(F.col(f"_{o}_p")) for o in sources})
    return df.drop(*[f"_{o}_{x}" for o in sources for x in "np"])


def effective_date(*dates: Column, default: str = R.DEFAULT_DATE) -> Column:
    return F.coalesce(*dates, F.lit(default).cast("date"))


def date_id(d: Column) -> Column:
    """yyyyMMdd as an int."""
    return F.date_format(d, "yyyyMMdd").try_cast("int")
