"""Crawl archives to annotation and entity tables, as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Executors get the few Python helpers inside the task closure, so a job needs no
# package installed on the workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
