"""Operators of a training-data pipeline over large text corpora.

One module per operator; ``queries`` registers them and nothing outside this
package imports it.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the Python workers whole, so the executors
# need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
