"""Spark-native analytics for retail-banking data.

Raw feeds -> quality checks and quarantine -> typed staging -> star schema with
history -> KPI tables and reports, with column lineage, catalog and retention
beside them.  Every public function takes and returns DataFrames.
"""

from tellerframe.config import Rules

__all__ = ["Rules"]
