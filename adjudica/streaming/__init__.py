"""Streaming forms of the operators."""

from pyspark import cloudpickle

from . import alerts, monitor

# Their Python helpers travel inside the task, so executors need no copy of the package.
for _module in (alerts, monitor):
    cloudpickle.register_pickle_by_value(_module)
