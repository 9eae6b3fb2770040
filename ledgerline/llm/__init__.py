"""Training-data operators over documents, pages and benchmarks.

Nothing else in the library imports this subpackage; its queries are in
``queries.py`` and the corpus pipeline is ``corpus_pipeline.py`` at the top of
the repository.
"""

import sys

from pyspark import cloudpickle

# functions of this package travel to the executors by value: no installation there
cloudpickle.register_pickle_by_value(sys.modules[__name__])
