"""tidemark: real-time warehouse operators as Spark DataFrame functions.

Every operator is a plain ``DataFrame -> DataFrame`` function that serves a
batch table and a Structured Streaming frame alike; jobs in ``plans`` and
``streaming`` only wire sources to sinks.
"""

__version__ = "0.1.0"
