"""Small wide files for the state tests."""

from __future__ import annotations

import os

HEADER = ",Date,Q-P1,S-P1,Q-P2,S-P2\n"


def write_file(folder, name, rows, header=HEADER, modified=None):
    """`rows` are (date text, units 1, revenue 1, units 2, revenue 2)."""
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{name}"
    with open(path, "w") as out:
        out.write(header)
        for i, row in enumerate(rows):
            out.write(",".join(str(v) for v in (i, *row)) + "\n")
    if modified is not None:
        os.utime(path, (modified, modified))
    return path


def facts(df):
    """{(date text, product): (units, revenue)}; fails on a repeated key."""
    rows = df.collect()
    found = {
        (str(r["date_key"]), r["product_key"]): (r["total_units_sold"], r["total_revenue"])
        for r in rows
    }
    assert len(found) == len(rows)
    return found
