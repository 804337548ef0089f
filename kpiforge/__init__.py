"""kpiforge: marketplace order analytics as Spark DataFrame jobs.

Staging loads with lineage and fingerprints, a conformed star schema with a
change-aware keyed upsert, quarterly KPIs, period-over-period comparisons,
mix and concentration analyses, experiment read-outs and data-quality rules.
"""

__version__ = "0.1.0"
