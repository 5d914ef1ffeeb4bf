"""Support-corpus engine on Spark: DataFrame operators that turn raw support
conversations into training and evaluation data, and score model replies."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# The few Python functions travel inside the job, so executors need no copy of this
# package and a job may be started from any folder.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
