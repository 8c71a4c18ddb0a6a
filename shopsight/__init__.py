"""Customer and transaction analytics on Spark DataFrames."""

from shopsight.schemas import ColumnMap
from shopsight.session import build_session

__all__ = ["ColumnMap", "build_session"]
