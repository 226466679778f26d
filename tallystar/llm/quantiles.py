"""Exact quantiles of all rows of large tables, by narrowing ranges of values."""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Parts that a range is cut into by one pass, and rows of a range that come to the driver at once.
PARTS, FEW = 1024, 10_000


class Quantile(NamedTuple):
    """The two neighbours of a quantile's place, and how far it lies from the first to the second."""

    below: float
    above: float
    part: float

    @property
    def linear(self) -> float:
        return self.below + (self.above - self.below) * self.part

    @property
    def midpoint(self) -> float:
        return self.below if not self.part else (self.below + self.above) / 2


class _Range(NamedTuple):
    name: str
    least: float
    most: float
    before: int  # rows of the name with smaller values
    rows: int


def quantiles(
    values: DataFrame, wanted: dict[str, list[float]]
) -> tuple[dict[str, int], dict[tuple[str, float], Quantile]]:
    """The number of rows of each wanted name, and its quantiles, of `name, x` (finite doubles).

    Each pass counts the rows of PARTS parts of the ranges that still hold a wanted place, and keeps
    the parts that hold them. A range of FEW rows is read. So the driver gets a bounded table from each
    pass, no task gets a group whole, and the values are those that sorting all rows would give.
    `values` is read several times; save it before.
    """
    ends = values.groupBy("name").agg(F.count("x").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    whole = {
        r["name"]: _Range(r["name"], r["lo"], r["hi"], 0, r["n"])
        for r in ends.where(F.col("name").isin(list(wanted))).collect()
        if r["n"]
    }
    places = {(name, q): q * (whole[name].rows - 1) for name in whole for q in wanted[name]}
    at = {
        (name, place): whole[name]
        for (name, _), p in places.items()
        for place in (math.floor(p), math.ceil(p))
    }
    while ranges := list(dict.fromkeys(r for r in at.values() if r.least < r.most and r.rows > FEW)):
        number, part = F.lit(None).cast("int"), F.lit(None).cast("int")
        for i, r in enumerate(ranges):
            inside = (F.col("name") == r.name) & F.col("x").between(F.lit(r.least), F.lit(r.most))
            share = (F.col("x") - F.lit(r.least)) / F.lit(r.most - r.least)
            number = F.when(inside, F.lit(i)).otherwise(number)
            part = F.when(inside, F.least(F.floor(share * PARTS), F.lit(PARTS - 1)).cast("int")).otherwise(part)
        cut = (
            values.select(number.alias("i"), part.alias("part"), "x").where("i is not null")
            .groupBy("i", "part").agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
        )
        parts: dict[_Range, list] = {r: [] for r in ranges}
        for row in sorted(cut.collect()):
            parts[ranges[row["i"]]].append(row)
        for (name, place), r in list(at.items()):
            before = r.before
            for row in parts.get(r, []):
                if place < before + row["n"]:
                    at[name, place] = _Range(name, row["lo"], row["hi"], before, row["n"])
                    break
                before += row["n"]
    # What is left: one value, or few rows.
    found = {key: r.least for key, r in at.items()}
    few = list(dict.fromkeys(r for r in at.values() if r.least < r.most))
    if few:
        held = F.lit(False)
        for r in few:
            held |= (F.col("name") == r.name) & F.col("x").between(F.lit(r.least), F.lit(r.most))
        table = values.where(held).select("name", "x").toArrow()
        names, x = np.array(table["name"].to_pylist()), table["x"].to_numpy()
        for r in few:
            own = np.sort(x[(names == r.name) & (x >= r.least) & (x <= r.most)])
            for (name, place), other in at.items():
                if other == r:
                    found[name, place] = float(own[place - r.before])
    return {name: r.rows for name, r in whole.items()}, {
        (name, q): Quantile(found[name, math.floor(p)], found[name, math.ceil(p)], p - math.floor(p))
        for (name, q), p in places.items()
    }
