"""adspark: retail-advertising report ingestion and catalog sync on Spark DataFrames.

Every operator is a lazy ``DataFrame -> DataFrame`` (or ``Column -> Column``) function built from
Spark SQL built-ins; nothing is collected to the driver and no Python UDF is used.
"""

__version__ = "0.1.0"
