"""rivulet: stream and table operators written on Spark DataFrames, SQL and Structured Streaming.

Every operator is a ``DataFrame -> DataFrame`` transform.  Where the same logic can run on a
batch frame and on a streaming frame it is written once; operators that keep per-key state
have a batch twin (window functions, joins) that defines the result and a streaming form
(``transformWithState``) that is tested against it.
"""

import sys as _sys

from rivulet.session import build_session, checkpoint_root, configure

# Ship the library's Python code (mapInPandas functions, data source readers, stateful
# processors) to the Python workers by value, so executors need no installed copy.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except (ImportError, AttributeError, ValueError):  # older cloudpickle: install the package instead
    pass

__all__ = ["build_session", "checkpoint_root", "configure"]
