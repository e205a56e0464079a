from lexiframe.sources.tables import read_table, TABLES  # noqa: F401
from lexiframe.sources.filetree import read_file_tree, DEFAULT_EXTENSIONS  # noqa: F401
from lexiframe.sources.smart import read_smart, parse_smart, render_smart  # noqa: F401
from lexiframe.sources.judgements import read_qrels  # noqa: F401
from lexiframe.sources.csv import read_numeric_csv, read_metric_csv  # noqa: F401
