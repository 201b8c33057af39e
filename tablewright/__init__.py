"""Tablewright: building and maintaining analytics tables with Spark DataFrames."""

from tablewright.naming import TableRef
from tablewright.session import build_session
from tablewright.tables import Storage

__all__ = ["Storage", "TableRef", "build_session"]
