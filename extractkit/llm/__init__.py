"""Operators for preparing training text; nothing else in the package imports them.

Functions of the package travel to the workers by value, so the workers need not have it.
"""

from pyspark import cloudpickle

import extractkit

cloudpickle.register_pickle_by_value(extractkit)
