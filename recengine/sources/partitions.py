"""Key ranges of equal row counts for JDBC scans, from a sampled histogram.

Equal-width ranges (``partition_column`` with bounds) need a number and give uneven scans when its values are. ``key_ranges`` takes the cut points
from a sample of the keys, of any ordered type; a key that fills several ranges alone is a range of its own, and can be split further by a
second column. ``range_predicates`` writes them as SQL conditions for ``predicates=`` of a JDBC read: every row meets exactly one of them, rows
with a null key the first.
"""

from __future__ import annotations

import datetime as dt
import decimal
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys that a histogram is read from at most: the driver sorts them.
SAMPLE_KEYS = 100_000


@dataclass(frozen=True)
class KeyRange:
    """Keys between ``low`` (inclusive unless ``behind``) and ``high`` (exclusive); None: no bound. Equal bounds: that key alone.

    part, parts: the part of the range's rows by the split column's remainder. nulls: rows with a null key belong to it."""

    low: object = None
    high: object = None
    nulls: bool = False
    behind: bool = False
    part: int = 0
    parts: int = 1

    @property
    def one_key(self) -> bool:
        return self.low is not None and self.low == self.high


def sample_keys(keys: DataFrame, column: str, rows: int | None = None, seed: int = 1) -> list:
    """At most ``SAMPLE_KEYS`` non-null keys drawn at random. ``rows``: the number of rows, counted here if not given."""
    k = keys.where(F.col(column).isNotNull()).select(column)
    rows = k.count() if rows is None else rows
    if rows > SAMPLE_KEYS:
        k = k.sample(False, min(1.0, 0.9 * SAMPLE_KEYS / rows), seed).limit(SAMPLE_KEYS)
    return [r[0] for r in k.collect()]


def key_ranges(sample: Sequence, ranges: int, *, split_heavy: bool = False) -> list[KeyRange]:
    """About ``ranges`` ranges that hold equally many of the sampled keys. A key at two or more cut points is a range of its own, with
    ``split_heavy`` in as many parts as it has cut points."""
    if ranges < 1:
        raise ValueError("ranges must be at least 1")
    keys = sorted(sample)
    cuts = [keys[len(keys) * i // ranges] for i in range(1, ranges)] if keys else []
    bounds = sorted(set(cuts))
    if not bounds:
        return [KeyRange(nulls=True)]
    out, low, behind = [], None, False
    for b in bounds:
        out.append(KeyRange(low, b, nulls=low is None, behind=behind))
        low, behind = b, cuts.count(b) > 1
        if behind:
            n = cuts.count(b) if split_heavy else 1
            out += [KeyRange(b, b, part=i, parts=n) for i in range(n)]
    return [*out, KeyRange(low, None, behind=behind)]


def literal(value: object) -> str:
    """A SQL literal of a key."""
    if isinstance(value, bool) or value is None:
        raise TypeError(f"no key: {value!r}")
    if isinstance(value, (int, decimal.Decimal)):
        return str(value)
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, dt.datetime):
        return f"timestamp '{value:%Y-%m-%d %H:%M:%S.%f}'"
    if isinstance(value, dt.date):
        return f"date '{value:%Y-%m-%d}'"
    return "'" + str(value).replace("'", "''") + "'"


def range_predicates(column: str, ranges: Sequence[KeyRange], split_column: str | None = None) -> list[str]:
    """One SQL condition per range; ``split_column`` (an integer) deals the parts of a heavy key by its remainder, nulls as 0.

    The bounds must be in the database's own order of the column: for text, that of a binary collation."""
    out = []
    for r in ranges:
        if r.one_key:
            terms = [f"{column} = {literal(r.low)}"]
            if r.parts > 1:
                if split_column is None:
                    raise ValueError("parts of a heavy key need a split column")
                terms.append(f"mod(abs(coalesce({split_column}, 0)), {r.parts}) = {r.part}")
        else:
            low = [] if r.low is None else [f"{column} {'>' if r.behind else '>='} {literal(r.low)}"]
            terms = low + ([] if r.high is None else [f"{column} < {literal(r.high)}"])
        one = " and ".join(terms)
        out.append(f"({one} or {column} is null)" if r.nulls and one else f"({one or '1 = 1'})")
    return out
