"""Spatial regression workflows as PySpark jobs.

Tables in, tables out: every operator takes DataFrames and returns DataFrames,
and leaves the physical plan to Catalyst.
"""

__version__ = "0.1.0"
