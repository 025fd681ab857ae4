"""topiclake: message topics as tables on Spark.

Bounded scans of partitioned topic logs, partition watermarks and metadata, a schema
registry kept as a change log, bulk wire-format encode/decode of JSON messages, JSON
Schema to Spark types, writes back to topics with dense offsets, and batch plus
Structured Streaming analytics over the same data.
"""

__version__ = "0.1.0"
