"""Operators for training-data pipelines.

Every operator takes a table with the columns of ``documents`` (or ``pages``, ``conversations``) and
gives a DataFrame. Functions that run inside tasks travel with the job.
"""

import gleanwork
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(gleanwork)
