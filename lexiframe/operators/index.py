"""The corpus index: ``docs`` (stored fields) + ``postings`` + per-document field lengths.

* ``docs``        one row per document: the key column plus the stored source columns.
* ``postings``    ``field, doc_id, term, tf, doc_len`` — one row per (field, document, term).
                  ``doc_len`` (tokens of that document in that field) travels with the
                  posting so rankers need no join back to the documents.
* ``doc_fields``  ``field, doc_id, n_terms, n_tokens, tf_sq`` — per-document field lengths
                  (the role of norms): field statistics and vector norms come from here
                  without a distinct-count or a pass over all postings.

Everything is built inside the row: a document's tokens are in one row, so term counting,
lengths and positions need no shuffle.

On disk an index is a list of segments, named by the last commit. A segment holds

* ``term_vectors``  the term arrays, range-partitioned by document: one document is a pushed range;
* ``postings``      range-partitioned by (field, term, block) into folders ``field=/bucket=``, the largest
                    tf / doc_len of a term's block first (``peak``), with
                    ``ranges`` (first and last term of every bucket). A look-up maps its terms to
                    buckets and joins on (bucket, term), so that Spark prunes the other folders at
                    run time; a term in very many documents spreads over several buckets;
* ``impacts``       per term of at least ``DENSE_DF`` documents and block the largest tf / doc_len. A block
                    holds documents of about one length, some ``BLOCK_DOCS`` of them, so that the few short
                    documents with high shares do not lift the bound of all others;
* ``docs``, ``doc_fields``, ``terms`` as above, and ``tombstones``: the keys of earlier segments that
                    this segment replaces. Readers leave them out by an anti-join; the dictionary of
                    the segment takes their counts off.

Write modes: create (replace), append (key-checked), update by key (latest version wins; writes the
batch only), merge of segments, merge of partial indexes (union + key check). A commit names the
version it follows and fails if another writer was first.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexiframe.functions.text import keyword_terms, tokens, with_term_counts
from lexiframe.operators.sizing import broadcast_if_small, saved, small_count, small_splits, spread


@dataclass(frozen=True)
class FieldSpec:
    """How one source column feeds the index."""

    name: str
    tokenized: bool = True  # analysed text (word tokens) vs keyword (whole value is one term)
    stored: bool = True     # kept in ``docs``


# Fields of the driver ``documents`` table: text is analysed, lang and source are keywords.
DOCUMENT_FIELDS = (FieldSpec("text", True), FieldSpec("lang", False), FieldSpec("source", False))


RANGE_ROWS = 1_000_000    # postings per task that writes them: some 170 MB to sort
SPLIT_BYTES = 8 << 20     # of term vectors or postings per task that reads them, and row groups: some 1.5 million postings
LEAST_RANGES = 32         # and buckets of a segment, at least
MOST_BUCKETS = 4096       # folders per segment and field; beyond it several files lie in a folder
BLOCK_DOCS = 512          # documents of a block, about
DENSE_DF = 32             # terms in fewer documents have no impacts; their postings are as few
MERGE_SEGMENTS = 8        # an update or append that would make more merges small segments


class DuplicateKeyError(ValueError):
    pass


class ConcurrentWriteError(RuntimeError):
    """Another writer committed the version that this one was to become."""


@dataclass(frozen=True)
class Segment:
    """Postings of one segment with their bucket, and the term range of each bucket."""

    postings: DataFrame  # field, bucket, key, term, block, tf, doc_len
    impacts: DataFrame   # field, bucket, term, block, top
    ranges: DataFrame    # field, bucket, lo, hi
    dead: DataFrame | None  # keys that later segments replace


@dataclass
class CorpusIndex:
    docs: DataFrame
    postings: DataFrame
    doc_fields: DataFrame
    key: str = "doc_id"
    fields: tuple[FieldSpec, ...] = field(default=DOCUMENT_FIELDS)
    # per-document term arrays (``field, key, terms, n_tokens``) the two tables above derive from
    forward: DataFrame | None = None
    # term dictionary ``field, term, df, cf`` when materialised (see ``with_term_dictionary``)
    terms: DataFrame | None = None
    # of an index on disk: its segments, folder and version
    segments: tuple[Segment, ...] = ()
    path: str | None = None
    version: int = 0
    # whether ``forward`` is the analysis of ``docs`` and of nothing else
    from_docs: bool = False

    def lookup(self, wanted: DataFrame, name: str = "text") -> DataFrame:
        """Postings of the terms in ``wanted`` (``term`` and any other columns, which come along).

        On disk, every wanted term is mapped to the buckets whose range holds it, and the join on
        (bucket, term) lets Spark skip all other folders (dynamic partition pruning)."""
        if not self.segments:
            return self.field_postings(name).join(wanted, "term")
        found = [self.segment_rows(s, s.postings, wanted, name).drop("block") for s in self.segments]
        return reduce(DataFrame.unionByName, found)

    def segment_rows(self, s: Segment, table: DataFrame, wanted: DataFrame, name: str) -> DataFrame:
        """The same for one segment's postings or impacts, with their block."""
        # one row per bucket: at most MOST_BUCKETS
        ranges = s.ranges.where(F.col("field") == name).select(F.collect_list(F.struct("bucket", "lo", "hi"))).scalar()
        staged = wanted.where(F.length("term") > 0).withColumn("_ranges", ranges)
        own = F.filter("_ranges", lambda r: (r["lo"] <= F.col("term")) & (F.col("term") <= r["hi"]))
        dealt = staged.select(*wanted.columns, F.explode(own).alias("_b")).select(*wanted.columns, F.col("_b.bucket").alias("bucket"))
        rows = table.where(F.col("field") == name).drop("field").join(dealt, ["bucket", "term"]).drop("bucket")
        return rows if s.dead is None or self.key not in rows.columns else rows.join(s.dead, self.key, "left_anti")

    def vector(self, doc_id, name: str = "text") -> DataFrame:
        """``term, tf`` of one document: a pushed range of the term vectors where they are at hand."""
        if self.forward is None:
            return self.field_postings(name).where(F.col(self.key) == F.lit(doc_id)).select("term", "tf")
        own = self.forward.where((F.col("field") == name) & (F.col(self.key) == F.lit(doc_id)))
        return own.select(F.inline_outer("terms")).where(F.col("term").isNotNull()).select("term", "tf")

    def stored(self, name: str, table: DataFrame) -> DataFrame:
        """A table derived from this version of an index on disk: written once beside the segments and
        read back by later calls. It carries the version's number, so that the next version, with
        other document frequencies, gets its own. An index in memory computes it."""
        if self.path is None:
            return table
        spark = self.docs.sparkSession
        at = f"{self.path}/derived/v{self.version:012d}-{name}"
        done = spark._jvm.org.apache.hadoop.fs.Path(f"{at}/_SUCCESS")
        fs = done.getFileSystem(spark._jsc.hadoopConfiguration())
        if not fs.exists(done):
            try:
                table.write.parquet(at)
            except AnalysisException as e:  # another writer is at it, or one was lost
                if e.getCondition() != "PATH_ALREADY_EXISTS":
                    raise
                return table
        return spark.read.parquet(at)

    def term_dictionary(self) -> DataFrame:
        """``field, term, df, cf`` — the stored dictionary, or one aggregate over the postings."""
        if self.terms is not None:
            return self.terms
        return self.postings.groupBy("field", "term").agg(
            F.count(F.lit(1)).alias("df"), F.sum("tf").cast("bigint").alias("cf"))

    def with_term_dictionary(self, level=None) -> "CorpusIndex":
        from pyspark import StorageLevel

        self.terms = self.term_dictionary().persist(level or StorageLevel.MEMORY_AND_DISK)
        return self

    def persisted(self, level=None) -> "CorpusIndex":
        """Materialise postings and lengths in the cache from ONE tokenizer pass (eager).

        A lost cached block is recomputed from the source by lineage."""
        from pyspark import StorageLevel

        if self.forward is None:
            self.postings = self.postings.persist(level or StorageLevel.MEMORY_AND_DISK)
            self.doc_fields = self.doc_fields.persist(level or StorageLevel.MEMORY_AND_DISK)
            return self
        level = level or StorageLevel.MEMORY_AND_DISK
        fwd = self.forward.persist(level)
        postings = _postings_from(fwd, self.key).persist(level)
        lengths = _lengths_from(fwd, self.key).persist(level)
        # materialise both from one tokenizer pass, then drop the per-document arrays
        postings.count()
        lengths.count()
        fwd.unpersist()
        return CorpusIndex(self.docs, postings, lengths, self.key, self.fields, None, self.terms)

    # ---- views ---------------------------------------------------------------------------
    def field_postings(self, name: str = "text") -> DataFrame:
        return self.postings.where(F.col("field") == name).drop("field")

    def field_lengths(self, name: str = "text") -> DataFrame:
        return self.doc_fields.where(F.col("field") == name).drop("field")

    def num_docs(self):
        """Scalar-subquery column: number of documents (no driver round trip)."""
        return self.docs.select(F.count(F.lit(1))).scalar()

    def total_tokens(self, name: str = "text"):
        return self.field_lengths(name).select(F.sum("n_tokens")).scalar()

    # ---- persistence ---------------------------------------------------------------------
    def save(self, path: str) -> None:
        """Write the index as one new segment folder below ``path`` and make it the current version.

        A reader sees the version named by the last commit, written when the segment is complete:
        a crash before leaves the old version (or none), never half of the new one.
        """
        spark = self.docs.sparkSession
        before = _last_commit(spark, path)
        _commit(spark, path, before, [_write_segment(self, path)])

    @classmethod
    def load(cls, spark: SparkSession, path: str, key: str = "doc_id",
             fields: Sequence[FieldSpec] = DOCUMENT_FIELDS) -> "CorpusIndex":
        """The version of the last commit; FileNotFoundError if there is none."""
        last = _last_commit(spark, path)
        if last is None:
            raise FileNotFoundError(f"no index at {path}")
        return _open(spark, path, last["n"], last["segments"], key, tuple(fields))


def _open(spark: SparkSession, path: str, version: int, segments: list[dict], key: str, fields: tuple[FieldSpec, ...]) -> CorpusIndex:
    base = path.rstrip("/")
    # tables without a row have no files that tell their schema
    kinds = {"impacts": "term string, block bigint, top double, field string, bucket int"}

    def read(i: int, name: str) -> DataFrame:
        return spark.read.schema(kinds[name]).parquet(f"{base}/{segments[i]['name']}/{name}") if name in kinds else spark.read.parquet(
            f"{base}/{segments[i]['name']}/{name}")

    at = range(len(segments))
    dead: list[DataFrame | None] = []
    for i in at:
        later = [read(j, "tombstones") for j in at if j > i and segments[j]["tombstones"]]
        dead.append(reduce(DataFrame.unionByName, later).distinct() if later else None)

    def part(name: str, *columns: str) -> DataFrame:
        tables = [read(i, name) if dead[i] is None else read(i, name).join(dead[i], key, "left_anti") for i in at]
        rows = reduce(DataFrame.unionByName, tables)
        return rows.select(*columns) if columns else rows

    terms = [read(i, "terms").select("field", "term", "df", "cf") for i in at]
    # df and cf add up over disjoint document sets; a term whose documents are all replaced goes
    dictionary = terms[0] if len(terms) == 1 else sum_dictionaries(terms).where("df > 0")
    forward = part("term_vectors", key, "field", "terms", "n_tokens") if all(s["vectors"] for s in segments) else None
    postings = tuple(Segment(read(i, "postings").select("field", "bucket", key, "term", "block", "tf", "doc_len"),
                             read(i, "impacts").select("field", "bucket", "term", "block", "top"), read(i, "ranges"), dead[i]) for i in at)
    return CorpusIndex(part("docs"), part("postings", "field", key, "term", "tf", "doc_len"),
                       part("doc_fields", "field", key, "n_terms", "n_tokens", "tf_sq"), key, fields, forward, dictionary,
                       postings, base, version)


def _write_segment(index: CorpusIndex, path: str, replaced: DataFrame | None = None, lost: DataFrame | None = None) -> dict:
    """All tables of a segment in a new folder. ``replaced``: the keys of earlier segments that it
    takes the place of; ``lost``: their dictionary rows, which are taken off.

    When the per-document term arrays are at hand, they are written once as ``term_vectors`` and
    postings / lengths are derived from that written table: the tokenizer runs once, without caching
    the collection, and the lineage is cut there. Those of a new index come from its written documents,
    which are dealt by key before they are analysed: texts are smaller than their term arrays, and
    the sample that finds the ranges needs no analysis.
    """
    spark, key = index.docs.sparkSession, index.key
    name = f"seg-{uuid.uuid4().hex[:12]}"
    base = f"{path.rstrip('/')}/{name}"
    postings, doc_fields = index.postings, index.doc_fields
    groups = {"parquet.block.size": str(SPLIT_BYTES)}  # a split is no smaller than a row group
    if index.from_docs:
        parts = max(LEAST_RANGES, 2 * index.docs.rdd.getNumPartitions())
        index.docs.repartitionByRange(parts, key).sortWithinPartitions(key).write.options(**groups).parquet(f"{base}/docs")
        # a task may read several of these files: put in order again, one document is a page of each file at most
        own_docs = spark.read.parquet(f"{base}/docs").sortWithinPartitions(key)
        with small_splits(spark, SPLIT_BYTES):
            for spec in index.fields:  # a folder per field
                _field_rows(own_docs, key, spec).drop("field").write.options(**groups).parquet(f"{base}/term_vectors/field={spec.name}")
    else:
        index.docs.write.parquet(f"{base}/docs")
        if index.forward is not None:
            parts = max(1, index.forward.rdd.getNumPartitions())
            # neighbours in key order share files: one document, or a range of keys, is a pushed range
            index.forward.repartitionByRange(parts, "field", key).sortWithinPartitions("field", key).write.options(**groups).partitionBy(
                "field").parquet(f"{base}/term_vectors")
    if index.forward is not None:
        fwd = spark.read.parquet(f"{base}/term_vectors")
        postings, doc_fields = _postings_from(fwd, key), _lengths_from(fwd, key)
    docs = spark.read.parquet(f"{base}/docs").count()
    doc_fields.write.partitionBy("field").parquet(f"{base}/doc_fields")
    total = spark.read.parquet(f"{base}/doc_fields").agg(F.sum("n_terms")).first()[0] or 0
    with small_splits(spark, SPLIT_BYTES):
        ranged = _ranged(postings, key, docs, total)
        ranged.write.partitionBy("field", "bucket").parquet(f"{base}/postings")
        stored = spark.read.schema(ranged.schema).parquet(f"{base}/postings")
        # one pass; the buckets of a term follow each other
        own = saved(stored.groupBy("field", "term").agg(
            F.count(F.lit(1)).alias("df"), F.sum("tf").cast("bigint").alias("cf"), F.min("bucket").alias("b0"), F.max("bucket").alias("b1")), "own-terms")
        # from the dictionary: the first and last of strings are found by a sort, which all postings must not go through
        own.select("field", F.explode(F.sequence("b0", "b1")).alias("bucket"), "term").groupBy("field", "bucket").agg(
            F.min("term").alias("lo"), F.max("term").alias("hi")).coalesce(1).write.parquet(f"{base}/ranges")
        dense = saved(own.where(F.col("df") >= DENSE_DF).select("field", "term"), "dense-terms")
        few = small_count(dense) is not None
        tops = stored.where("peak").join(F.broadcast(dense) if few else dense, ["field", "term"], "left_semi").select(
            "field", "bucket", "term", "block", (F.col("tf") / F.col("doc_len")).alias("top"))
        # a task that reads postings has few buckets; those of a shuffle by term have all
        tops = tops if few else tops.repartition("field", "bucket")
        tops.sortWithinPartitions("field", "bucket", "term").write.partitionBy("field", "bucket").parquet(f"{base}/impacts")
        terms = own if index.terms is None else index.terms
        terms = terms.select("field", "term", "df", "cf")
        if lost is not None:
            terms = sum_dictionaries([terms, lost.select("field", "term", (-F.col("df")).alias("df"), (-F.col("cf")).alias("cf"))])
        terms.sortWithinPartitions("field", "term").write.partitionBy("field").parquet(f"{base}/terms")
    if replaced is not None:
        replaced.write.parquet(f"{base}/tombstones")
    return {"name": name, "vectors": index.forward is not None, "tombstones": replaced is not None, "docs": docs}


def _ranged(postings: DataFrame, key: str, docs: int, total: int) -> DataFrame:
    """Postings with ``block``, ``bucket`` and ``peak``, in ranges of about ``RANGE_ROWS`` and in order.

    The rows of a term and block, of bounded number, stay in one range, so that the window that marks
    their largest tf / doc_len (``peak``) needs the sort that the files need and no other shuffle."""
    tasks = max(LEAST_RANGES, -(-total // RANGE_ROWS))
    deal = F.lit(-(-docs // (16 * BLOCK_DOCS)) or 1)  # blocks of a class of lengths; some 16 classes hold most documents
    block = (F.floor(4 * F.log2(F.col("doc_len").cast("double"))) * deal + F.pmod(F.xxhash64(key), deal)).cast("bigint")
    ranged = postings.withColumn("block", block).repartitionByRange(tasks, "field", "term", "block").withColumn(
        "bucket", F.floor(F.spark_partition_id() / -(-tasks // MOST_BUCKETS)).cast("int"))
    # the folder columns first: the writer then needs no sort of its own
    first = Window.partitionBy("field", "bucket", "term", "block").orderBy((F.col("tf") / F.col("doc_len")).desc(), key)
    return ranged.withColumn("peak", F.row_number().over(first) == 1)


def _last_commit(spark: SparkSession, path: str) -> dict | None:
    """The newest commit, or None where nothing was ever committed. Any other failure to read it is
    raised: an index that cannot be read is not an absent one."""
    try:
        lines = spark.read.text(f"{path.rstrip('/')}/commits").collect()  # one short line per write
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return max((json.loads(r["value"]) for r in lines), key=lambda c: c["n"], default=None)


def _commit(spark: SparkSession, path: str, before: dict | None, segments: list[dict]) -> None:
    """One small file per version, made by a create that fails if the file is there: of two writers
    that follow the same version the second one gets ConcurrentWriteError, and nothing is lost."""
    n = (before["n"] + 1) if before else 1
    hadoop = spark._jvm.org.apache.hadoop.fs
    at = hadoop.Path(f"{path.rstrip('/')}/commits/part-{n:012d}")
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(at):
        raise ConcurrentWriteError(f"version {n} of {path} was written by another writer")
    try:
        out = fs.create(at, False)
    except Py4JJavaError as e:
        if "AlreadyExists" not in e.java_exception.getClass().getName():
            raise
        raise ConcurrentWriteError(f"version {n} of {path} was written by another writer") from e
    try:
        out.write(bytearray((json.dumps({"n": n, "segments": segments}) + "\n").encode()))
    finally:
        out.close()


def _field_rows(docs: DataFrame, key: str, spec: FieldSpec) -> DataFrame:
    """``key, field, terms ARRAY<STRUCT<term, tf>>, n_tokens`` for one field, in-row."""
    if spec.tokenized:
        staged = docs.select(F.col(key), F.lit(spec.name).alias("field"), tokens(F.col(spec.name)).alias("_toks"))
        return with_term_counts(staged, "_toks", "terms").select(
            key, "field", "terms", F.size("_toks").cast("bigint").alias("n_tokens"))
    kw = keyword_terms(F.col(spec.name).cast("string"))
    return docs.select(
        F.col(key), F.lit(spec.name).alias("field"),
        F.transform(kw, lambda t: F.struct(t.alias("term"), F.lit(1).cast("bigint").alias("tf"))).alias("terms"),
        F.size(kw).cast("bigint").alias("n_tokens"))


def build_index(docs: DataFrame, key: str = "doc_id", fields: Sequence[FieldSpec] = DOCUMENT_FIELDS,
                min_partitions: int | None = None) -> CorpusIndex:
    """Build the index of a documents DataFrame (lazy; nothing runs until an action).

    ``min_partitions``: when the source has fewer input splits than this (a single large
    file), spread the documents round-robin first so tokenization uses every core.
    """
    if min_partitions:
        docs = spread(docs, min_partitions)
    per_field = None
    for spec in fields:
        rows = _field_rows(docs, key, spec)
        per_field = rows if per_field is None else per_field.unionByName(rows)
    # inline_outer: a plain inline makes the optimizer infer `size(terms) > 0` and push it below
    # the projections, re-running the tokenizer inside the array lambdas (quadratic per row).
    stored = [key] + [s.name for s in fields if s.stored and s.name != key]
    extra = [c for c in docs.columns if c not in stored]
    return CorpusIndex(docs.select(*stored, *extra), _postings_from(per_field, key), _lengths_from(per_field, key),
                       key, tuple(fields), per_field, from_docs=all(s.stored or s.name == key for s in fields))


def _postings_from(per_field: DataFrame, key: str) -> DataFrame:
    # inline_outer: a plain inline makes the optimizer infer `size(terms) > 0` and push it below
    # the projections, re-running the tokenizer inside the array lambdas (quadratic per row).
    return per_field.select(
        "field", key, F.inline_outer("terms"), F.col("n_tokens").alias("doc_len")).where(F.col("term").isNotNull())


def _lengths_from(per_field: DataFrame, key: str) -> DataFrame:
    return per_field.where(F.col("n_tokens") > 0).select(
        "field", key,
        F.size("terms").cast("bigint").alias("n_terms"),
        "n_tokens",
        F.aggregate("terms", F.lit(0).cast("bigint"), lambda acc, x: acc + x["tf"] * x["tf"]).alias("tf_sq"),
    )


def postings_with_positions(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, term, tf, positions ARRAY<INT>, first_pos, last_pos`` (0-based token positions).

    In-row: sort (token, position) pairs, cut them into runs of equal tokens.
    """
    staged = docs.select(F.col(key), tokens(F.col(text)).alias("_toks"))
    staged = staged.select(key, F.sort_array(F.transform("_toks", lambda t, i: F.struct(
        t.alias("t"), i.alias("p")))).alias("_pairs"))
    pairs = F.col("_pairs")
    n = F.size(pairs)
    staged = staged.withColumn("_ends", F.filter(
        F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
        lambda i: (n > 0) & ((i == n) | (F.element_at(pairs, i)["t"] != F.element_at(pairs, i + 1)["t"]))))
    ends = F.col("_ends")
    runs = F.transform(ends, lambda e, k: F.struct(
        F.element_at(pairs, e)["t"].alias("term"),
        F.transform(
            F.slice(pairs, F.when(k == 0, F.lit(1)).otherwise(F.element_at(ends, k) + 1),
                    e - F.when(k == 0, F.lit(0)).otherwise(F.element_at(ends, k))),
            lambda x: x["p"]).alias("positions")))
    return (staged.select(key, runs.alias("runs"))
            .select(key, F.inline_outer("runs")).where(F.col("term").isNotNull())
            .select(key, "term", F.size("positions").cast("bigint").alias("tf"), "positions",
                    F.element_at("positions", 1).cast("bigint").alias("first_pos"),
                    F.element_at("positions", -1).cast("bigint").alias("last_pos")))


def token_offsets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, pos, term, start_offset, end_offset``: 0-based character offsets of every token
    in the lower-cased text (``substring(lower(text), start + 1, end - start) == term``).

    The text splits into tokens and the gaps between them (same pattern, same scan), so a
    token starts after all earlier gaps and tokens: a running sum per document.
    """
    from lexiframe.functions.text import JAVA_TOKEN_PATTERN, chopped

    lt = F.lower(F.col(text))
    staged = docs.select(F.col(key), F.regexp_extract_all(lt, F.lit(JAVA_TOKEN_PATTERN), 0).alias("_t"),
                         F.split(lt, JAVA_TOKEN_PATTERN, -1).alias("_g"))
    pairs = staged.select(key, F.arrays_zip(F.col("_t").alias("term"),
                                            F.slice("_g", 1, F.greatest(F.size("_t"), F.lit(1))).alias("gap"))
                          .alias("_p"))
    # the pieces of a long token follow each other without a gap
    pairs = pairs.select(key, F.flatten(F.transform("_p", lambda x: F.transform(chopped(x["term"]), lambda t, i: F.struct(
        t.alias("term"), F.when(i == 0, x["gap"]).otherwise("").alias("gap"))))).alias("_p"))
    rows = (pairs.select(key, F.posexplode_outer("_p").alias("pos", "p"))
            .where(F.col("p.term").isNotNull())
            .select(key, F.col("pos").cast("bigint").alias("pos"), F.col("p.term").alias("term"),
                    (F.length("p.gap") + F.length("p.term")).alias("_step"), F.length("p.term").alias("_len")))
    w = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum("_step").over(w)
    return rows.select(key, "pos", "term", (end - F.col("_len")).cast("bigint").alias("start_offset"),
                       end.cast("bigint").alias("end_offset"))


# ---- write modes ------------------------------------------------------------------------------

def _keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct()


def append_docs(index: CorpusIndex, new_docs: DataFrame, on_duplicate: str = "error",
                min_partitions: int | None = None) -> CorpusIndex:
    """Append documents; a key already in the index is an error (or skipped with ``'skip'``).

    Re-running an append therefore never duplicates documents.
    """
    key = index.key
    new_keys = broadcast_if_small(_keys(new_docs, key))
    clash = index.docs.select(key).join(new_keys, key, "left_semi")
    if on_duplicate == "error":
        if clash.limit(1).count() > 0:
            raise DuplicateKeyError(f"append: {key} values already indexed")
    elif on_duplicate == "skip":
        new_docs = new_docs.join(broadcast_if_small(clash), key, "left_anti").dropDuplicates([key])
    else:
        raise ValueError(on_duplicate)
    dup = new_docs.groupBy(key).count().where("count > 1")
    if on_duplicate == "error" and dup.limit(1).count() > 0:
        raise DuplicateKeyError(f"append: duplicate {key} inside the batch")
    add = build_index(new_docs.select(*index.docs.columns), key, index.fields, min_partitions)
    return CorpusIndex(index.docs.unionByName(add.docs), index.postings.unionByName(add.postings),
                       index.doc_fields.unionByName(add.doc_fields), key, index.fields)


def latest_per_key(batch: DataFrame, key: str, order_col: str) -> DataFrame:
    """Keep the newest row per key (largest ``order_col``).

    An aggregate (``max_by``), not a window: partial aggregation keeps one row per key per task
    before the shuffle, so a key with very many versions never gathers them in one task.
    """
    cols = [c for c in batch.columns if c != key]
    best = F.max_by(F.struct(*cols), F.col(order_col)).alias("_b")
    return batch.groupBy(key).agg(best).select(key, *[F.col(f"_b.{c}").alias(c) for c in cols])


def upsert_docs(index: CorpusIndex, updates: DataFrame, order_col: str | None = None,
                min_partitions: int | None = None) -> CorpusIndex:
    """Replace every document whose key appears in ``updates`` and add the new ones.

    The old postings of replaced documents are removed with an anti-join on the key
    (broadcast when the batch is small, a shuffle anti-join otherwise).
    """
    key = index.key
    if order_col is not None:
        updates = latest_per_key(updates, key, order_col)
    upd = updates.select(*index.docs.columns)
    keys = broadcast_if_small(_keys(upd, key))
    add = build_index(upd, key, index.fields, min_partitions)
    forward = None
    if index.forward is not None:
        forward = index.forward.join(keys, key, "left_anti").unionByName(add.forward)
    return CorpusIndex(
        index.docs.join(keys, key, "left_anti").unionByName(add.docs),
        index.postings.join(keys, key, "left_anti").unionByName(add.postings),
        index.doc_fields.join(keys, key, "left_anti").unionByName(add.doc_fields),
        key, index.fields, forward)


def sum_dictionaries(dicts: Sequence[DataFrame]) -> DataFrame:
    """Merge term dictionaries of disjoint document sets: df and cf are sums."""
    u = dicts[0]
    for d in dicts[1:]:
        u = u.unionByName(d)
    return u.groupBy("field", "term").agg(F.sum("df").cast("bigint").alias("df"),
                                          F.sum("cf").cast("bigint").alias("cf"))


def merge_indexes(parts: Sequence[CorpusIndex], check_keys: bool = True) -> CorpusIndex:
    """Union partial indexes (e.g. one per subdirectory); keys must not repeat across parts."""
    if not parts:
        raise ValueError("no partial index")
    key = parts[0].key
    docs, postings, doc_fields = parts[0].docs, parts[0].postings, parts[0].doc_fields
    for p in parts[1:]:
        docs = docs.unionByName(p.docs)
        postings = postings.unionByName(p.postings)
        doc_fields = doc_fields.unionByName(p.doc_fields)
    if check_keys:
        if docs.groupBy(key).count().where("count > 1").limit(1).count() > 0:
            raise DuplicateKeyError(f"merge: {key} present in more than one partial index")
    merged = CorpusIndex(docs, postings, doc_fields, key, parts[0].fields)
    if all(p.terms is not None for p in parts):
        merged.terms = sum_dictionaries([p.terms for p in parts])  # partial statistics add up
    return merged


# ---- open modes on a persisted index -----------------------------------------------------------

OPEN_MODES = ("create", "append", "create_or_append", "update")


def index_exists(spark: SparkSession, path: str) -> bool:
    """Whether a version was committed; folders without a commit are no index."""
    return _last_commit(spark, path) is not None


def write_index(spark: SparkSession, docs: DataFrame, path: str, mode: str = "create", key: str = "doc_id",
                fields: Sequence[FieldSpec] = DOCUMENT_FIELDS, on_duplicate: str = "error",
                order_col: str | None = None) -> CorpusIndex:
    """Index ``docs`` into ``path``: create (replace), append, create_or_append or update.

    Append writes a segment with the new documents only. A key that the index or the batch itself
    already has is an error, or with ``on_duplicate="skip"`` left out (of a key that the batch
    repeats, one row is taken), so re-running an append never duplicates documents. Update replaces
    documents by key and adds the others; it writes the batch and the keys it replaces, whatever the
    size of the index. A batch with repeated keys needs ``order_col`` there (the newest row wins). Each
    write becomes visible by one commit at its end, which fails (ConcurrentWriteError) if another writer
    committed since this one began. Beyond ``MERGE_SEGMENTS`` segments the newest ones are merged.
    """
    if mode not in OPEN_MODES:
        raise ValueError(f"mode must be one of {OPEN_MODES}")
    before = _last_commit(spark, path)
    if before is None and mode == "append":
        raise FileNotFoundError(f"no index at {path}")
    if mode == "update" and order_col is not None:
        docs = latest_per_key(docs, key, order_col)
    if mode in ("append", "create_or_append") and on_duplicate == "skip":
        docs = docs.dropDuplicates([key])
    elif docs.groupBy(key).count().where("count > 1").limit(1).count() > 0:
        raise DuplicateKeyError(f"{mode}: duplicate {key} inside the batch")
    if before is None or mode == "create":
        build_index(docs, key, fields).save(path)
        return CorpusIndex.load(spark, path, key, fields)
    base = _open(spark, path, before["n"], before["segments"], key, tuple(fields))
    if mode == "update":
        add = build_index(saved(docs.select(*base.docs.columns), "update-batch"), key, fields)
        # the batch's keys that the index has: the tombstones of this segment
        replaced = saved(base.docs.select(key).join(add.docs.select(key), key, "left_semi"), "replaced-keys")
        segment = _write_segment(add, path, replaced, _lost(base, replaced))
    else:
        clash = base.docs.select(key).join(_keys(docs, key), key, "left_semi")
        if on_duplicate == "error" and clash.limit(1).count() > 0:
            raise DuplicateKeyError(f"append: {key} values already indexed")
        add = docs.join(clash, key, "left_anti") if on_duplicate == "skip" else docs
        segment = _write_segment(build_index(add.select(*base.docs.columns), key, fields), path)
    _commit(spark, path, before, [*before["segments"], segment])
    if len(before["segments"]) >= MERGE_SEGMENTS:
        merge_segments(spark, path, key, fields)
    return CorpusIndex.load(spark, path, key, fields)


def _lost(base: CorpusIndex, replaced: DataFrame) -> DataFrame:
    """Dictionary rows of the documents that are replaced, from their term vectors: files whose keys
    lie outside the replaced ones are not read."""
    key = base.key
    low, high = replaced.agg(F.min(key), F.max(key)).first()
    if base.forward is None:
        rows = base.postings.join(replaced, key, "left_semi")
    else:
        near = base.forward.where(F.col(key).between(F.lit(low), F.lit(high)))
        rows = near.join(replaced, key, "left_semi").select("field", F.inline_outer("terms")).where(F.col("term").isNotNull())
    return rows.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").cast("bigint").alias("cf"))


def merge_segments(spark: SparkSession, path: str, key: str = "doc_id", fields: Sequence[FieldSpec] = DOCUMENT_FIELDS) -> bool:
    """Write the newest segments that together hold no more documents than the one before them as one
    segment; whether there was anything to merge. Older segments stay untouched, so that a document
    is rewritten a logarithmic number of times. Fails like any writer if another one was first."""
    before = _last_commit(spark, path)
    if before is None:
        raise FileNotFoundError(f"no index at {path}")
    segments = before["segments"]
    first, size = len(segments) - 1, segments[-1]["docs"]
    while first > 0 and segments[first - 1]["docs"] <= max(size, 1):
        first -= 1
        size += segments[first]["docs"]
    if len(segments) - first < 2:
        first = max(0, len(segments) - 2)
    if len(segments) - first < 2:
        return False
    some = segments[first:]
    part = _open(spark, path, before["n"], some, key, tuple(fields))
    base = path.rstrip("/")
    # counts that these segments take off earlier ones stay taken off
    part.terms = sum_dictionaries([spark.read.parquet(f"{base}/{s['name']}/terms").select("field", "term", "df", "cf") for s in some])
    dead = [spark.read.parquet(f"{base}/{s['name']}/tombstones") for s in some if s["tombstones"]]
    replaced = reduce(DataFrame.unionByName, dead).distinct() if dead and first else None
    if not first:
        part.terms = part.terms.where("df > 0")
    segment = _write_segment(part, path, replaced)
    _commit(spark, path, before, [*segments[:first], segment])
    return True
