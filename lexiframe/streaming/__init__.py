from lexiframe.streaming.file_indexer import (  # noqa: F401
    current_documents,
    load_incremental_index,
    start_incremental_index,
    start_file_ingest,
    stream_file_tree,
)
