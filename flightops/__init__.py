"""flightops: flight on-time analytics as Spark DataFrame plans.

Raw flight records -> audited, cleaned, pre-departure table -> point-in-time
("strictly prior") feature tables and nearest-prior weather -> profiling,
chronological split, Spark ML classifiers, exact evaluation metrics and
risk-tier scoring. Every public function takes and returns DataFrames; no
operator depends on row position and no data passes through the driver
except bounded metadata (schemas, a handful of quantile bounds, metric rows).
"""

__version__ = "0.1.0"
