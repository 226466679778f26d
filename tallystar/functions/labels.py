"""Product labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallystar.schemas import PRODUCT_LABEL


def product_label(product_key: Column, width: int | None = None) -> Column:
    """'P7' to 'Product 7'. `width` cuts the label to that many characters of the key."""
    if width is None:
        number = F.substr(product_key, F.lit(2))
    else:
        number = F.substr(product_key, F.lit(2), F.lit(width))
    return F.concat(F.lit(PRODUCT_LABEL), number)
