"""pitwall — live race-timing analytics on Spark.

Raw feed messages (tables, files or streams) are normalised into laps, gaps and
weather, a per-driver rolling ridge fit predicts the next lap, and a small set
of dashboard queries answer "latest pace / race lap / gaps / weather /
predictions" as plain DataFrames.

Layout:
  functions/  column expressions (lap text, numeric text, clock numbers, JSON)
  sources/    readers: line capture, concatenated JSON, roster, bus, fixtures
  operators/  envelope parsing and routing, laps, regression, pacing, dashboard
  plans/      skew-safe per-key sequencing, bounded joins, lineage cuts
  streaming/  keyed-state predictor, three-way split, sinks
"""

__version__ = "0.1.0"
