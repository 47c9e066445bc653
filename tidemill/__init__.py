"""Record, stream and table operators for keyed event data on PySpark.

Every operator takes a ``DataFrame`` and returns a ``DataFrame``.  The packages are

* ``sources``   topic / file / change-event scans and the sinks,
* ``functions`` column expressions (no ``DataFrame`` in, none out),
* ``operators`` the operators proper,
* ``plans``     skew, ordering and size-checked broadcast helpers,
* ``streaming`` running operators on Structured Streaming,
* ``queries``   the registered queries and their SQL twins.
"""

import sys

from pyspark import cloudpickle

from tidemill.session import configure, local_session

# the few functions that run in Python tasks travel with the job: executors need no install
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["configure", "local_session"]
