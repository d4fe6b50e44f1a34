"""civgraph — a Spark-native medallion pipeline from public open data to a property graph.

Layers:
  sources/    raw file contracts, readers and raw preparation steps (S*, R*, P*)
  functions/  Column -> Column helpers (X*)
  operators/  DataFrame -> DataFrame operators: relational (A*, J*, U*, T*),
              graph (N*, E*, J08, K05), quality (Q*), catalog / refresh planning (C*)
  plans/      bronze (B*), silver (V*), gold (N*, E*) model builders and the
              end-to-end pipeline; driver queries over the benchmark tables
"""

__version__ = "0.1.0"
