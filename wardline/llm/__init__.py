"""Operators of a training-data pipeline, each a Spark job over whole tables.

Nothing outside this subpackage imports it; ``__spark_entry__.py`` adds the
queries of :mod:`wardline.llm.queries` when the subpackage is present.
"""

import sys

from pyspark import cloudpickle

# Task functions travel by value: executors need the installed libraries, but
# no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
