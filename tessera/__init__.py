"""tessera: Spark-native text analytics and recommendation operators.

Every operator is a ``DataFrame -> DataFrame`` function built from Catalyst
expressions; ``tessera.plans`` binds them to the test tables and pairs each
with an equivalent DuckDB query.
"""

__version__ = "0.1.0"
