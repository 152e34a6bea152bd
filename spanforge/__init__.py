"""spanforge — annotated-text corpus analytics as Spark DataFrame operators.

Every public operator is a ``DataFrame -> DataFrame`` (or ``Column``) function
built from Spark SQL built-ins; Python workers are used only where a
user-supplied callable must run (bulk model calls, opaque row/batch maps).
"""

__version__ = "0.1.0"
