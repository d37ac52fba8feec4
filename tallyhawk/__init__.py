"""tallyhawk: a Spark-native fraud-data engine.

Raw transfer, user, recipient and flag documents plus partner chargeback
sheets become a pseudonymised, point-in-time-correct training table; the table
is split, encoded, scored and evaluated in money terms. Every operator is a
DataFrame -> DataFrame function over Spark SQL expressions, window functions,
Spark ML and Structured Streaming.
"""

__version__ = "0.1.0"
