"""quarry — document-to-table analytics expressed as Spark DataFrame jobs.

Layout:
  sources/    file and table scans, payload ingest, sinks, the test fixture
  functions/  Column-level building blocks (field rules, variant reads, text)
  operators/  DataFrame -> DataFrame operators (parse, extract, score, ask, ...)
  plans/      named end-to-end queries and their SQL oracles
  streaming/  Structured Streaming runners around the same operators
"""

__version__ = "0.1.0"
