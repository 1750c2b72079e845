"""lexiflow: labelled text to model-ready sequences and scores, on Spark.

Every operator is a function from DataFrame(s) to DataFrame built on the
public PySpark API.  See README.md for the operator map.
"""

__version__ = "0.1.0"
