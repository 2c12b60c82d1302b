"""strata: a Spark-native medallion lake for trip records (raw -> bronze -> silver -> gold).

Entry points: ``strata.lake.open_lake`` builds or reuses a lake for a table
directory; ``strata.plans`` holds the reports; ``strata.registry.QUERIES`` maps
every operator to a ``(spark, tables_dir) -> DataFrame`` callable.
"""

__version__ = "0.1.0"
