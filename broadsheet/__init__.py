"""Quality checks, clean-up, features and linear classifiers for tables of articles, as Spark jobs."""

import sys

from pyspark import cloudpickle

# Ship the package's functions inside the tasks, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
