"""ratewise: ratings and recommendation analytics written as Spark DataFrame plans.

Sub-packages
------------
functions   column expressions (Java-style trim/split, typed field parsing, encoders, dot product)
sources     text / catalog-table / JDBC / Kafka / model readers and writers
operators   parsers, splits, popularity, metrics, factor scoring and top-k, upsert, ALS
streaming   Structured Streaming recommendation job (foreachBatch) and its controls
plans       views derived from the benchmark tables, the query catalog and its SQL oracle
"""

from ratewise.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
