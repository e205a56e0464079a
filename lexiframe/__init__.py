"""lexiframe: corpus analytics and ranked-retrieval evaluation as Spark DataFrame jobs.

Sub-packages:
  functions  - column expressions (tokenizer, line slices, shingles, statistics series)
  sources    - readers: parquet tables, file trees, SMART text, judgements, CSV
  operators  - index build/append/upsert/merge, term statistics, similarity, search,
               evaluation, significance tests, k-means
  plans      - the registered queries over the driver tables and their SQL oracles
  streaming  - incremental indexing of a growing file tree with Structured Streaming
"""

__version__ = "0.1.0"
