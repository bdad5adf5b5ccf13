"""Table-level analytics operators for Spark: every operator is DataFrame -> DataFrame."""

import sys

from pyspark import cloudpickle

from tablewright.session import build_session, scratch_path

# Helpers of pandas functions travel with the job, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session", "scratch_path"]
