"""Tabular analytics and regression on Spark DataFrames."""

from tabforge.session import materialize, work_dir

__all__ = ["materialize", "work_dir"]
