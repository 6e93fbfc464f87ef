"""tasteflow: rating analytics and suggestions on Spark DataFrames.

Every operator is a plain ``DataFrame(s) -> DataFrame`` function with
keyword parameters; nothing is executed until an action runs.

Subpackages
-----------
sources     text parsing with quarantine, adapters over the test tables, table IO
functions   column expressions (JVM trim, strict numbers, month keys, list formatting)
operators   statistics, catalogue roll-up, top-k, vector kernels, ALS, real-time scoring
plans       the batch jobs that chain operators and write tables
streaming   Structured Streaming queries: log filter, event parsing, real-time upsert
"""

from tasteflow.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
