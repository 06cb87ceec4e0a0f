"""loomgate: a Spark engine for moving families of foreign-key-linked tables.

Core subpackages: ``plans`` (table hierarchy, mapping and execution plans),
``sources`` (scans and sinks), ``operators`` (re-keying, filtering, coercion,
validation, reporting and the large-scale data-quality operators),
``functions`` (column expressions) and ``streaming`` (incremental loads).
``llm`` is optional and is never imported by the rest.
"""

__version__ = "0.1.0"
