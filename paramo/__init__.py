"""paramo — Spark-native analytics over measurement star schemas.

Two families of operators, both plain lazy ``DataFrame -> DataFrame`` functions:

* the dashboard over a long-form star schema (fact of readings joined to
  station, place, month, period and parameter dimensions) —
  :mod:`paramo.operators.dashboard`;
* the deep analysis of a wide station x month table — cleaning, descriptive
  statistics, scaling, PCA, K-Means, DBSCAN, Ward, Isolation Forest, LOF,
  random forest, profiles and chart data — :mod:`paramo.operators`.

Sources and sinks live in :mod:`paramo.sources`, scalar column builders in
:mod:`paramo.functions`, whole-pipeline plans in :mod:`paramo.plans`.
"""

__version__ = "0.1.0"
