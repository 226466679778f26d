"""Content hashes: one text, or a whole table without ordering or collecting it."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two seeds and the lane width of the table fingerprint.
SEEDS = (0, 1)
LANE_BITS = 21
LANES = 3
N_LANES = 1 + len(SEEDS) * LANES


def text_hash(text: Column) -> Column:
    """MD5 of one whole text, as 32 hex digits. A missing text counts as an empty one.

    That makes the hash non-null, so a join on it adds no null filter that would
    hash every text a second time.
    """
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def lane_columns(columns: Sequence[str], keep: Column | None = None) -> list[Column]:
    """Aggregates whose values add up over disjoint sets of rows: their number, and lane sums.

    Every row is hashed twice to 64 bits, each hash is cut into lanes of 21 bits, and the lanes are
    summed as longs: no lane sum can overflow below 2**42 rows and all of it is combined map-side.
    `keep` restricts it to the rows for which the condition holds.
    """
    parts = [F.count(F.lit(1)) if keep is None else F.count_if(keep)]
    mask = F.lit(2**LANE_BITS - 1)
    for seed in SEEDS:
        row = F.xxhash64(F.lit(seed), *[F.col(c) for c in columns])
        if keep is not None:
            row = F.when(keep, row)
        for lane in range(LANES):
            value = F.shiftrightunsigned(row, lane * LANE_BITS).bitwiseAND(mask)
            parts.append(F.coalesce(F.sum(value), F.lit(0)))
    return parts


def lane_sums(columns: Sequence[str], keep: Column | None = None) -> Column:
    """Aggregate: the lane columns as one array."""
    return F.array(*lane_columns(columns, keep))


def added_lanes(lanes: Column) -> Column:
    """Aggregate: the lane sums of the union of disjoint sets of rows."""
    return F.array(*[F.coalesce(F.sum(lanes[i]), F.lit(0)) for i in range(N_LANES)])


def fingerprint(lanes: Column) -> Column:
    """32 hex digits of lane sums."""
    return F.md5(F.concat_ws(",", lanes.cast("array<string>")).cast("binary"))


def fingerprint_of(groups: Iterable[Sequence[int]]) -> str:
    """The fingerprint of the union of disjoint sets of rows, of which the lane sums are known."""
    total = [0] * N_LANES
    for lanes in groups:
        total = [a + b for a, b in zip(total, lanes, strict=True)]
    return hashlib.md5(",".join(map(str, total)).encode()).hexdigest()


def table_fingerprint(columns: Sequence[str], keep: Column | None = None) -> Column:
    """Aggregate: 32 hex digits that depend on the set of rows and on how often each occurs.

    Row order and partitioning do not matter. It is the fingerprint of the rows' lane sums, so
    groups that were summed apart give that of the whole without another pass.
    """
    return fingerprint(lane_sums(columns, keep))
