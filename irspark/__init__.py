"""irspark: text-retrieval analytics as ordinary Spark DataFrame jobs.

Every operator takes DataFrames (and Column expressions) and returns lazy
DataFrames.  Nothing is collected to the driver inside an operator.
"""

__version__ = "0.1.0"
