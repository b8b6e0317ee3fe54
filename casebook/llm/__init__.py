"""Training-data operators: tokenisation, deduplication, filtering, search, packing.

Nothing else in the library imports this subpackage; ``__spark_entry__.py`` adds its
queries only when it is present. General helpers come from ``casebook.session`` and
``casebook.sources``.
"""

import sys

from pyspark import cloudpickle

# What runs inside tasks travels with them, so executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
