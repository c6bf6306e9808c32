"""hiermatch: batch text matching against a hierarchical catalog, as Spark DataFrame plans."""

__version__ = "0.1.0"
