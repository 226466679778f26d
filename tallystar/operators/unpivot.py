"""Wide daily rows to one row per date and product, in a single scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystar.functions.dates import date_parts, parse_date
from tallystar.schemas import DATE_COLUMN, REVENUE_PREFIX, UNITS_PREFIX


def product_ids(columns: Sequence[str]) -> list[str]:
    """Products named by the `Q-x` / `S-x` column pairs, in header order."""
    units = [c.removeprefix(UNITS_PREFIX) for c in columns if c.startswith(UNITS_PREFIX)]
    revenue = [c.removeprefix(REVENUE_PREFIX) for c in columns if c.startswith(REVENUE_PREFIX)]
    unpaired = sorted(set(units) ^ set(revenue))
    if unpaired:
        raise ValueError(f"products with only one of units and revenue: {unpaired}")
    if not units:
        raise ValueError("no product columns found")
    for names in (units, revenue):
        if len(set(names)) != len(names):
            raise ValueError("a product column occurs twice")
    return units


def _common_type(types: Sequence[T.DataType]) -> T.DataType:
    if all(t == types[0] for t in types):
        return types[0]
    if any(isinstance(t, T.StringType) for t in types):
        return T.StringType()
    if all(isinstance(t, T.IntegralType) for t in types):
        return T.LongType()
    return T.DoubleType()


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _same_type(schema: T.StructType, prefix: str, products: Sequence[str]) -> list[str]:
    types = [schema[prefix + p].dataType for p in products]
    target = _common_type(types)
    columns = [_quoted(prefix + p) for p in products]
    return [
        c if t == target else f"CAST({c} AS {target.simpleString()})"
        for c, t in zip(columns, types)
    ]


def _stack(schema: T.StructType, products: Sequence[str]) -> Column:
    """One expression text: hundreds of products cost no call into the JVM each."""
    units = _same_type(schema, UNITS_PREFIX, products)
    revenue = _same_type(schema, REVENUE_PREFIX, products)
    cells = [f"{_text(p)}, {u}, {r}" for p, u, r in zip(products, units, revenue)]
    return F.expr(f"stack({len(products)}, {', '.join(cells)})")


def to_long(
    wide: DataFrame, extra_formats: Sequence[str] = (), carry: Sequence[str] = ()
) -> DataFrame:
    """`date, year, month, day, product_id, total_units_sold, total_revenue` per product.

    Columns other than the date, the product pairs and `carry` are dropped,
    which also prunes them from the scan.
    """
    products = product_ids(wide.columns)
    date_type = wide.schema[DATE_COLUMN].dataType
    if isinstance(date_type, T.StringType):
        date = parse_date(F.col(DATE_COLUMN), extra_formats)
    else:
        date = F.col(DATE_COLUMN).cast("date")
    rows = _stack(wide.schema, products)
    dated = wide.withColumn("date", date) if DATE_COLUMN != "date" else wide
    return dated.select(
        *carry,
        "date",
        *date_parts(F.col("date")),
        rows.alias("product_id", "total_units_sold", "total_revenue"),
    )
