"""File-tree source: every regular file below the first-level subdirectories of a root.

* files directly in the root are ignored (one unit of work per first-level subdirectory);
* ``depth``: -1 unlimited, 0 nothing, n > 0 at most n levels below the subdirectory
  (a file directly inside ``root/a`` is at level 1);
* extension whitelist, case-sensitive, taken from the last '.' of the file name; a name
  without '.' has no extension and is skipped (it never stops its siblings);
* whole-file read with newlines normalised to LF; optional head/tail line slice.

Each file is one row, and the work is spread over files, not over subdirectories (one huge subdirectory
is not one task). On a local (or mounted) file system tasks list the folders, level by level, and read the
files: nothing about a single file reaches the driver. Elsewhere Spark's reader does, whose list of all files is
held by the driver.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator, Sequence
from itertools import groupby
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiframe.functions.text import line_slice, normalize_newlines
from lexiframe.operators.sizing import saved

# Fixed value: the default extension whitelist.
DEFAULT_EXTENSIONS = (".java", ".c", ".txt", ".odt", ".doc", ".pdf")
FILES_PER_TASK = 2000      # that a task reads, at most about
BYTES_PER_TASK = 32 << 20
LISTING_TASKS_CONF = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def relative_path(path_col, root: str):
    """Path relative to ``root`` (both as URIs; ``file:`` prefixes are normalised)."""
    root_uri = root.rstrip("/")
    # _metadata.file_path is a URI: percent-encoded (spaces as %20) and prefixed with file:
    p = F.url_decode(F.regexp_replace(path_col, r"^file:(//)?", ""))
    r = root_uri.removeprefix("file://").removeprefix("file:")
    return F.substring(p, len(r) + 2, 1 << 30)


def filter_paths(df: DataFrame, rel: str = "rel_path", extensions: Sequence[str] | None = DEFAULT_EXTENSIONS,
                 depth: int = -1) -> DataFrame:
    """Apply the subdirectory rule, depth limit and extension whitelist to a ``rel_path`` column."""
    parts = F.split(F.col(rel), "/")
    level = F.size(parts) - 1
    cond = level >= 1
    if depth == 0:
        return df.limit(0)
    if depth > 0:
        cond = cond & (level <= depth)
    if extensions is not None:
        name = F.element_at(parts, -1)
        ext = F.regexp_extract(name, r"(\.[^.]*)$", 1)
        cond = cond & ext.isin(list(extensions))
    return df.where(cond)


def _local_folder(spark: SparkSession, root: str) -> str | None:
    """The folder's plain path if it lies on the local (or a mounted) file system, else None."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    uri = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def _all_files(spark: SparkSession, root: str) -> Iterator[str]:
    """Paths of all files below ``root``, hidden ones included, relative to it."""
    jvm, sc = spark.sparkContext._jvm, spark.sparkContext
    top = jvm.org.apache.hadoop.fs.Path(root)
    found = top.getFileSystem(sc._jsc.hadoopConfiguration()).listFiles(top, True)
    start = len(top.toUri().getPath().rstrip("/"))
    while found.hasNext():
        yield found.next().getPath().toUri().getPath()[start:].strip("/")


def _local_files(spark: SparkSession, local: str, extensions: Sequence[str] | None) -> DataFrame:
    """``rel, size, modified, refused, listed`` of the wanted files below a local folder. ``refused``: the path has
    a name that starts with ``_`` or ``.``; ``listed``: Spark's readers would show it. One job per level of the
    tree; a level's folders are dealt over the tasks, which write what they find to the shared folder."""
    wanted = None if extensions is None else tuple(extensions)

    def scan(batches):
        import pyarrow as pa

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (
                pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_()))],
                ["rel", "folder", "size", "modified", "refused", "listed"])

        rows = []
        for b in batches:
            for rel, refused, listed in zip(*(b.column(n).to_pylist() for n in ("rel", "refused", "listed"))):
                with os.scandir(f"{local}/{rel}" if rel else local) as entries:
                    for e in entries:
                        n = e.name
                        if n.startswith(".") and n.endswith(".crc"):  # Hadoop's checksum files
                            continue
                        hidden = n.startswith("_") and "=" not in n or n.startswith(".") or n.endswith("._COPYING_")
                        folder = e.is_dir()
                        shown = listed and (not hidden or folder and n.startswith(("_metadata", "_common_metadata")))
                        if not folder and wanted is not None and not n.endswith(wanted):
                            continue
                        try:
                            st = e.stat()
                        except FileNotFoundError:  # a link to nothing
                            continue
                        rows.append((f"{rel}/{n}" if rel else n, folder, st.st_size, st.st_mtime_ns // 1_000_000, refused or n[0] in "_.", shown))
                        if len(rows) >= 10_000:
                            yield batch(rows)
                            rows = []
        if rows:
            yield batch(rows)

    schema = "rel string, folder boolean, size bigint, modified bigint, refused boolean, listed boolean"
    level = spark.range(1).selectExpr("'' AS rel", "false AS refused", "true AS listed")
    files = None
    while True:
        found = saved(level.mapInArrow(scan, schema), "tree-level")
        here = found.where("NOT folder").drop("folder")
        files = here if files is None else files.unionByName(here)
        folders = found.where("folder")
        n = folders.count()
        if not n:
            return files
        tasks = min(4 * spark.sparkContext.defaultParallelism, n) if n < 4 * FILES_PER_TASK * spark.sparkContext.defaultParallelism else -(-n // FILES_PER_TASK)
        level = folders.select("rel", "refused", "listed").repartition(tasks)


def _read_local(files: DataFrame, local: str) -> DataFrame:
    """``path, raw, size_bytes, modified`` of the files, as Spark's text reader and its metadata columns give
    them; empty files have no row."""
    def uri(path: str) -> str:  # quotes what java.net.URI quotes
        return re.sub(r"[^A-Za-z0-9\-_.!~*'():@&=+$,;/\x80-\U0010ffff]|[\x80-\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]",
                      lambda m: quote(m[0], safe=""), path)

    def read(batches):
        import pyarrow as pa

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (
                pa.string(), pa.binary(), pa.int64(), pa.int64()))], ["path", "raw", "size_bytes", "modified"])

        rows, held = [], 0
        for b in batches:
            for rel, size, modified in zip(*(b.column(n).to_pylist() for n in ("rel", "size", "modified"))):
                with open(f"{local}/{rel}", "rb") as f:
                    rows.append((f"file:{uri(f'{local}/{rel}')}", f.read(), size, modified))
                held += size
                if held >= 4 << 20 or len(rows) >= 1000:
                    yield batch(rows)
                    rows, held = [], 0
        if rows:
            yield batch(rows)

    n, size = files.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    tasks = max(files.sparkSession.sparkContext.defaultParallelism, -(-n // FILES_PER_TASK), -(-size // BYTES_PER_TASK))
    found = files.select("rel", "size", "modified").repartition(tasks)
    return found.mapInArrow(read, "path string, raw binary, size_bytes bigint, modified bigint").select(
        "path", F.col("raw").cast("string").alias("raw"), "size_bytes", F.timestamp_millis("modified").alias("modified"))


def _not_listed(root: str, path: str) -> ValueError:
    return ValueError(f"Spark does not list {root.rstrip('/')}/{path}; rename it or read with hidden='skip'")


def _refuse_hidden(spark: SparkSession, root: str, extensions: Sequence[str] | None) -> None:
    """Raises if a wanted file lies below the root under a name that Spark does not list."""
    for path in _all_files(spark, root):
        parts = path.split("/")
        ext = "." + parts[-1].rpartition(".")[2] if "." in parts[-1] else None
        if len(parts) > 1 and any(p[0] in "_." for p in parts) and (extensions is None or ext in extensions):
            raise _not_listed(root, path)


def _read_by_spark(spark: SparkSession, root: str, extensions: Sequence[str] | None, hidden: str) -> DataFrame:
    """``path, raw, size_bytes, modified`` by Spark's text reader."""
    if hidden == "error":
        _refuse_hidden(spark, root, extensions)
    reader = spark.read
    if extensions is not None:  # other files are neither listed nor opened
        reader = reader.option("pathGlobFilter", "*{" + ",".join(extensions) + "}")
    # folders of many folders are listed by Spark jobs: a few tasks per core, not one per folder
    before = spark.conf.get(LISTING_TASKS_CONF)
    spark.conf.set(LISTING_TASKS_CONF, str(min(int(before), 4 * spark.sparkContext.defaultParallelism)))
    try:
        raw = reader.text(root, wholetext=True, recursiveFileLookup=True)
    finally:
        spark.conf.set(LISTING_TASKS_CONF, before)
    return raw.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("value").alias("raw"),
        F.col("_metadata.file_size").alias("size_bytes"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def write_file_tree(df: DataFrame, root: str, folders: Sequence[str], value: str) -> None:
    """Write ``value`` of every row, and a final newline, to a text file of its own in the folder
    ``root/column=value/...`` of the columns ``folders``; a task's rows of one folder share a file.

    Spark's writer starts a process and several renames per file on a local file system; there the
    tasks write the files themselves, and a task that runs again writes the same files."""
    local = _local_folder(df.sparkSession, root)
    if local is None:
        df.select(*folders, value).write.partitionBy(*folders).text(root)
        return

    def folder(row) -> str:
        names = ["__HIVE_DEFAULT_PARTITION__" if row[c] in (None, "") else quote(row[c], safe="") for c in folders]
        return "/".join(f"{c}={name}" for c, name in zip(folders, names))

    def write(rows) -> None:
        from pyspark import TaskContext

        name = f"part-{TaskContext.get().partitionId():05d}.txt"
        for at, same in groupby(rows, folder):
            os.makedirs(f"{local}/{at}", exist_ok=True)
            with open(f"{local}/{at}/{name}", "wb") as out:
                for row in same:
                    out.write((row[value] or b"") + b"\n")

    os.makedirs(local, exist_ok=True)
    rows = df.select(*[F.col(c).cast("string").alias(c) for c in folders], F.col(value).cast("binary").alias(value))
    rows.sortWithinPartitions(*folders).foreachPartition(write)


def read_file_tree(spark: SparkSession, root: str, extensions: Sequence[str] | None = DEFAULT_EXTENSIONS,
                   depth: int = -1, top_lines: int = 0, bottom_lines: int = 0,
                   provenance: bool = False, hidden: str = "error") -> DataFrame:
    """Read a directory tree into ``path, rel_path, text, size_bytes, modified, last_modified_fmt``.

    Spark's file sources do not show files or folders whose names start with ``_`` or ``.``. With
    ``hidden="error"`` a wanted file among them fails the read; ``"skip"`` leaves them out.

    ``provenance``: add ``task`` (the Spark partition that read the file), the counterpart of
    the worker-thread field of a thread-pool indexer.
    """
    local = _local_folder(spark, root)
    if local is not None and os.path.isdir(local):
        local = local.rstrip("/")
        files = _local_files(spark, local, extensions)
        if hidden == "error":
            ext = F.regexp_extract(F.element_at(F.split("rel", "/"), -1), r"(\.[^.]*)$", 1)
            odd = files.where(F.col("refused") & F.contains("rel", F.lit("/")) & (F.lit(True) if extensions is None else ext.isin(list(extensions)))).first()
            if odd is not None:
                raise _not_listed(root, odd["rel"])
        df = _read_local(files.where(F.col("listed") & (F.col("size") > 0)), local)
    else:
        df = _read_by_spark(spark, root, extensions, hidden)
    df = df.withColumn("rel_path", relative_path(F.col("path"), root))
    df = filter_paths(df, "rel_path", extensions, depth)
    text = normalize_newlines(F.col("raw"))
    if top_lines or bottom_lines:
        text = line_slice(text, top_lines, bottom_lines)
    extra = [F.spark_partition_id().alias("task")] if provenance else []
    return df.select(
        "path", "rel_path", text.alias("text"), "size_bytes", "modified", *extra,
        F.date_format("modified", "yyyy-MM-dd HH:mm:ss").alias("last_modified_fmt"),
        F.date_format(F.to_utc_timestamp("modified", spark.conf.get("spark.sql.session.timeZone")),
                      "yyyyMMddHHmmssSSS").alias("last_modified_ms_fmt"),
        F.lit("isRegularFile").alias("type"),
    )
