"""legworks — delay and route-network analytics for flight-leg tables on Spark.

Every public operator is a ``DataFrame -> DataFrame`` function built from the
DataFrame API so Catalyst can prune, push down and plan it.  Sub-packages:

* ``sources``   — leg ingest (CSV/Parquet), the star-schema test mapping, sinks
* ``functions`` — reusable column expressions (clock parsing, safe division, …)
* ``operators`` — recovery, propagation, routes, paths, report, ml families
* ``plans``     — the query catalogue (Spark side) and its DuckDB oracle SQL
* ``streaming`` — incremental landing of monthly leg files
"""

import sys

from pyspark import cloudpickle

from legworks.session import checkpoint_dir, get_session, materialize

__all__ = ["checkpoint_dir", "get_session", "materialize"]
__version__ = "0.1.0"

# Functions that Spark ships to executors carry their code with them, so
# executors need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
