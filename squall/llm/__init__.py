"""Operators a training-data pipeline needs, each a Spark job.

Nothing else in the package imports this subpackage.  ``queries()`` and
``oracle_sql()`` list the registered ``opN_<name>`` queries.
"""

import sys

from pyspark import cloudpickle

# tasks get the functions themselves, so workers need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
