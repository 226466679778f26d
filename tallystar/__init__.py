"""Daily sales files to a star schema and its sales reports, as Spark plans."""

__version__ = "1.0"
