"""Spark-native sales, customer, product, supply-chain, profitability and
geographic analytics.

Every operator takes canonical DataFrames (see ``ledgerlens.sources``) plus
explicit parameters and returns a lazy DataFrame built from native Spark
expressions.
"""

__version__ = "0.1.0"
