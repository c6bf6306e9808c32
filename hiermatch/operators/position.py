"""Row position of a table: what "first row" and "last row" mean in lookups by name or code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Column with the position that the CSV readers add.
ROW_POS = "row_pos"


def row_position(catalog: DataFrame, pos_col: str | None = None) -> Column:
    """``pos_col`` if given, else the readers' position if the table has it, else the commodity code."""
    return F.col(pos_col or (ROW_POS if ROW_POS in catalog.columns else "commodity_code"))
