"""Header harmonisation: drifting source headers -> one fixed (golden) schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regstar.domain import registrations as R


def alias_groups(headers: Sequence[str], aliases: Mapping[str, str]) -> dict[str, list[int]]:
    """Target -> positions of the source columns that map to it, in source order.

    Headers are compared lower-cased and stripped.
    """
    groups: dict[str, list[int]] = {}
    for i, h in enumerate(headers):
        target = aliases.get(h.lower().strip())
        if target is not None:
            groups.setdefault(target, []).append(i)
    return groups


def harmonize_columns(df: DataFrame, aliases: Mapping[str, str] = R.HEADER_ALIASES,
                      golden: Sequence[str] = R.GOLDEN_COLUMNS,
                      headers: Sequence[str] | None = None) -> DataFrame:
    """One projection onto ``golden``.

    A target fed by several source columns takes the first non-NULL value in
    source column order; a target with no source is a NULL string; source
    columns that map to nothing are dropped. ``headers`` gives the original
    header text per column when the frame's own names had to be made unique
    (duplicate or case-variant headers); by default the column names are used.
    Names are back-quoted so dots are not read as struct fields.
    """
    names = df.columns
    headers = list(headers) if headers is not None else names
    groups = alias_groups(headers, aliases)
    out = []
    for target in golden:
        pos = groups.get(target)
        if pos:
            out.append(F.coalesce(*[F.col(f"`{names[i]}`").cast("string") for i in pos]).alias(target))
        else:
            out.append(F.lit(None).cast("string").alias(target))
    return df.select(*out)
