"""tessera: a PySpark metrics-and-ML analytics package.

Sub-packages:
  sources    readers, writers, catalog listings
  functions  column-expression helpers (dates, text, arrays)
  operators  DataFrame -> DataFrame operators (joins, windows, calendar,
             batching, series, forecasting, segmentation)
  plans      the metric layer: model tables, relationships, measures,
             evaluate, drill, time intelligence
  streaming  (the workload has no streams; see its docstring)
  suite      the registered queries and their SQL oracles
"""
__all__ = ["session"]
