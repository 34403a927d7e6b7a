"""ledgerline: vendor invoice lines -> normalized service inventory, on Spark."""

from pyspark import cloudpickle as _cloudpickle

# Functions of this package that run inside Python workers (the per-file
# header reader) are shipped by value, so workers need no installed copy.
_cloudpickle.register_pickle_by_value(__import__(__name__))
