"""Reporting on denial-of-service alerts and their mitigations, built on Spark DataFrames.

Landed JSON documents are flattened into two keyed fact tables and one
dimension, and reported through eight views.  Every step is a function from
DataFrame to DataFrame; only ``store`` and ``plans.loads`` write.
"""

from floodmark.store import Store

__all__ = ["Store"]
