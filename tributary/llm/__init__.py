"""Training-data operators and their registered queries."""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry their code, so these need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules["tributary"])

from tributary.llm.queries import ORACLE, QUERIES  # noqa: E402

__all__ = ["ORACLE", "QUERIES"]
