"""txlake: a Spark-native collector and analysis kit for transaction envelopes.

Layout
------
``functions``  column expressions (ids, event time, status rank, envelopes)
``sources``    batch / streaming readers (Parquet, JSON text, Kafka options)
``operators``  DataFrame -> DataFrame transforms, batch and streaming alike
``streaming``  watermark dedup, idempotent sinks, the collector query
``plans``      the registered queries over the driver's test tables
"""

__version__ = "0.1.0"
