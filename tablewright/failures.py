"""What a step over one table may fail with: recorded for that table, so that the others go on."""

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException

# a job that aborts on the executors surfaces as a Java error
FAILURES = (PySparkException, Py4JError, ValueError, TypeError, StopIteration)
