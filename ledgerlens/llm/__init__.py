"""Operators for preparing training data: filtering, de-duplication, search, sharding, packing.

Nothing outside this package imports it.  Each module holds one operator with
its own interface; ``queries.py`` registers the thin ``opN_*`` queries.
"""

import sys

from pyspark import cloudpickle

# Python workers need not have this package installed: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
