"""cohorta: population segmentation over tabular measurements, written as Spark jobs."""

from pyspark import cloudpickle

from cohorta.functions import kernels

# Task-side kernels travel inside the plan, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(kernels)
