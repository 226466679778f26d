"""Upsert: update matched rows, insert the rest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Keys up to this size, counted and not estimated, are sent to every executor.
BROADCAST_BYTES = 64 << 20


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    key_bytes: int | None = None,
    lead_bytes: int | None = None,
) -> DataFrame:
    """`target` after `source` was merged into it on `keys`.

    Rows of the target whose key the source has give way to the source's row, which brings all
    its values, also null ones; a key that the target repeats is one row afterwards. A null key
    matches nothing. `source` must hold each key once (see operators.checks.require_unique).

    `key_bytes` is the size of the source's keys if the caller has counted it. It chooses the
    join and not the result: small keys are broadcast, and the target is not shuffled at all;
    large ones are shuffled with the target and merged by sorting. It is not left to guess from
    file sizes: tens of millions of keys may compress below Spark's threshold.

    `lead_bytes` is the counted size of the distinct values of the first key. Where the keys are
    large and these are small (the days of many sales), the values are broadcast: target rows whose
    value the source lacks stay where they are, and only the others are shuffled.
    """
    merged_keys = source.select(*keys)
    small = key_bytes is not None and key_bytes <= BROADCAST_BYTES
    merged_keys = F.broadcast(merged_keys) if small else merged_keys.hint("merge")
    if small or lead_bytes is None or lead_bytes > BROADCAST_BYTES:
        kept = target.join(merged_keys, list(keys), "left_anti")
    else:
        lead = F.broadcast(source.select(keys[0]).distinct())
        meeting = target.join(lead, keys[0], "left_semi").join(merged_keys, list(keys), "left_anti")
        kept = target.join(lead, keys[0], "left_anti").unionByName(meeting)
    return kept.select(*target.columns).unionByName(source.select(*target.columns))
