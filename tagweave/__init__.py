"""tagweave: word-level annotated corpora as Spark DataFrame operators.

Subpackages
-----------
functions  Column-level building blocks (ids, labels, tag decoders, JSON).
operators  DataFrame -> DataFrame operators (explode, ordinals, batching,
           entity shapes, dictionary decode, payload profile).
sources    File sources (tagged lines, nested JSON books, manifests).
sinks      JSON Lines, JDBC and the ``kvbatch`` Python data source.
plans      End-to-end corpus plans and the queries over the driver tables.
streaming  Incremental arrival of corpus files with Structured Streaming.
"""

__version__ = "0.1.0"
