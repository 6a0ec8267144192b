"""Operators of a training-data pipeline: quality rules, exact, substring and
SimHash dedup, secret scans, language-model scoring, tokenisation, packing and
chat formatting. Nothing else in the library imports this subpackage.

Functions that run inside tasks are sent to the executors by value, so the
package need not be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
