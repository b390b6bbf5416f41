"""sifter: full-text indexing and ranked search as Spark DataFrame / Streaming jobs.

Subpackages: ``functions`` (Column → Column text and URL functions),
``operators`` (DataFrame → DataFrame index, search, link and merge operators),
``sources`` (dump files, page store, file-system helpers), ``plans`` (index
build / publish / refresh and the registered queries), ``streaming`` (ingest).
"""

__version__ = "0.1.0"
