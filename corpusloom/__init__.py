"""corpusloom: document-corpus analytics as PySpark DataFrame operators.

Subpackages
-----------
sources    readers and writers (MARC XML, CSV links, taxonomy JSON, text corpora, record tables)
functions  Column-level building blocks (no actions, no shuffles)
operators  DataFrame -> DataFrame operators
streaming  incremental jobs on Structured Streaming
plans      the registered queries with their oracle SQL
"""

__version__ = "0.1.0"
