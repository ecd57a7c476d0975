"""quire: question/answer dataset preparation and scoring on Spark.

Operators take DataFrames and return DataFrames; see README.md.  The three
stages of the original workflow are plain functions:

    from quire import preprocess, load_training_data, evaluate
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

__version__ = "0.1.0"

# Python workers on executors may not have this package installed: ship the
# few functions that run there (pandas UDFs, mapInPandas bodies) by value.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

from quire.plans.evaluate import evaluate, evaluate_rows  # noqa: E402
from quire.plans.preprocess import preprocess, preprocess_lines  # noqa: E402
from quire.plans.training import load_training_data, training_tables, validation_check  # noqa: E402
from quire.session import build_session  # noqa: E402

__all__ = ["build_session", "evaluate", "evaluate_rows", "load_training_data", "preprocess", "preprocess_lines",
           "training_tables", "validation_check"]
