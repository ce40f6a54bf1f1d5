"""Text, JSON and listing sources, the sinks that go with them, and small state files.

Paths go through Spark's readers and Hadoop's file systems, so any store that the session knows will do.
"""

from __future__ import annotations

import contextlib
import fnmatch
import tempfile
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _session(spark: SparkSession, **settings: str) -> SparkSession:
    """A session with the settings of ``spark`` and further ones."""
    own = spark.newSession()
    for name, value in (spark.conf.getAll | settings).items():
        if own.conf.isModifiable(name):
            own.conf.set(name, value)
    return own


def many_files(spark: SparkSession) -> SparkSession:
    """A session in which many small files share a task, and many folders a task of the listing."""
    return _session(spark, **{"spark.sql.files.openCostInBytes": str(64 << 10), "spark.sql.sources.parallelPartitionDiscovery.parallelism": "256"})


def whole_texts(spark: SparkSession, path: str, suffix: str = "*.txt", recursive: bool = False) -> DataFrame:
    """``path, doc, text`` of whole files, with all line ends as line feeds."""
    rows = many_files(spark).read.option("pathGlobFilter", suffix).option("recursiveFileLookup", str(recursive).lower()).text(path, wholetext=True)
    text = F.regexp_replace("value", "\r\n?", "\n")
    return rows.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("doc"), text.alias("text"))


def numbered_lines(spark: SparkSession, path: str, suffix: str = "*", split_bytes: int = 128 << 20) -> DataFrame:
    """``path, line_no, value``: every line of the files below ``path``, blank ones included, numbered from 1
    in each file; a file of any size is read by many tasks.

    Files are read in byte ranges of ``split_bytes``; a line belongs to the range it starts in.  Lines are
    counted by range, and a line's number is the sum of the counts before its range plus its place in it.
    The reader gets a session of its own with fixed split settings, as both passes must see the same ranges
    even if executors come or go in between.  Line ends are LF, CR LF or CR.  A compressed file is one range.
    """
    own = _session(spark, **{"spark.sql.sources.parallelPartitionDiscovery.parallelism": "256", "spark.sql.files.minPartitionNum": "1", "spark.sql.files.maxPartitionBytes": str(split_bytes)})
    raw = own.read.option("pathGlobFilter", suffix).option("recursiveFileLookup", "true").text(path)
    place = F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("low")
    lines = raw.select(*place, F.monotonically_increasing_id().alias("id"), "value")
    ranges = raw.rdd.getNumPartitions()
    tasks = max(8 * spark.sparkContext.defaultParallelism, -(-ranges * split_bytes // (128 << 20)))
    if ranges > tasks:  # a task reads several ranges, whose rows are numbered before
        lines = lines.coalesce(tasks)
    counts = lines.groupBy("path", "low").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("path").orderBy("low").rowsBetween(Window.unboundedPreceding, -1))
    folder = work_folder(spark, "line-counts")  # a row for each range; Spark broadcasts it while it is small
    counts.select("path", "low", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift")).write.parquet(folder)
    shifts = own.read.schema("path string, low bigint, shift bigint").parquet(folder)
    return lines.join(shifts, ["path", "low"]).select("path", (F.col("id") + F.col("shift") + 1).alias("line_no"), "value")


def listed(spark: SparkSession, path: str, suffix: str = "*", recursive: bool = True) -> DataFrame:
    """``path, file, bytes``: names and sizes alone, the content is not read."""
    rows = many_files(spark).read.format("binaryFile").option("pathGlobFilter", suffix).option("recursiveFileLookup", str(recursive).lower()).load(path)
    return rows.select("path", F.substring_index("path", "/", -1).alias("file"), F.col("length").alias("bytes"))


FOLDERS_AT_ONCE = 500  # which one task lists
FILES_AT_ONCE = 2000  # which one task reads
BATCH_BYTES = 16 << 20  # of texts that a task holds


def found(spark: SparkSession, path: str, suffix: str = "*") -> DataFrame:
    """``path, bytes`` of the files below a folder, listed by tasks: those of one round list the folders that the round
    before has found.  No name comes to the driver, so there may be any number of files; a single folder
    is listed by one task (see ``spread`` of :func:`write_texts`).  Hidden names are left out, as by Spark."""
    path = path.rstrip("/")

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(path)
        for batch in batches:
            for at in batch.column(0).to_pylist():
                infos = [i for i in store.get_file_info(pyarrow.fs.FileSelector(f"{root.rstrip('/')}{at}")) if i.base_name[0] != "." and (i.base_name[0] != "_" or "=" in i.base_name)]
                infos = [i for i in infos if i.type == pyarrow.fs.FileType.Directory or fnmatch.fnmatchcase(i.base_name, suffix)]
                columns = [f"{at}/{i.base_name}" for i in infos], [i.type == pyarrow.fs.FileType.Directory for i in infos], [i.size or 0 for i in infos]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.bool_(), pa.int64()), strict=True)], names=["at", "folder", "bytes"])

    listing = work_folder(spark, "listing")
    folders, turn = spark.createDataFrame([("",)], "at string"), 0
    count = 1
    while count:
        folders.repartition(-(-count // FOLDERS_AT_ONCE)).mapInArrow(entries, "at string, folder boolean, bytes bigint").write.parquet(f"{listing}/turn={turn}")
        folders = spark.read.schema("at string, folder boolean, bytes bigint").parquet(f"{listing}/turn={turn}").filter("folder").select("at")
        count, turn = folders.count(), turn + 1
    rows = spark.read.schema("at string, folder boolean, bytes bigint, turn int").parquet(listing).filter("not folder")
    return rows.select(F.concat(F.lit(path), "at").alias("path"), "bytes")


def texts_of(rows: DataFrame, folder: str) -> DataFrame:
    """``path, value``: whole contents of files below ``folder`` that ``rows`` name by ``path``, read by tasks."""
    folder = folder.rstrip("/")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        pack = lambda paths, texts: pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(texts, pa.binary())], names=["path", "value"])
        for batch in batches:
            paths, texts, held = [], [], 0
            for path in batch.column(0).to_pylist():
                with store.open_input_stream(root.rstrip("/") + path[len(folder) :]) as file:
                    texts.append(file.read())
                paths.append(path)
                held += len(texts[-1])
                if held >= BATCH_BYTES:
                    yield pack(paths, texts)
                    paths, texts, held = [], [], 0
            yield pack(paths, texts)

    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // FILES_AT_ONCE))
    return rows.select("path").repartition(tasks).mapInArrow(read, "path string, value binary").select("path", F.col("value").cast("string").alias("value"))


def snapshot(files: DataFrame) -> DataFrame:
    """``path``: of a listing, the last snapshot folder by name; null without one."""
    return files.agg(F.max(F.nullif(F.regexp_extract("path", "^(.*/snapshots/[^/]+)/", 1), F.lit(""))).alias("path"))


def config(spark: SparkSession, path: str) -> DataFrame:
    """A row for each JSON file, which holds one object."""
    return spark.read.option("multiLine", "true").json(path)


def work_folder(spark: SparkSession, label: str) -> str:
    """A new folder below the one that the session shares; a temporary one only in a local session."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = "file://" + tempfile.gettempdir()
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


# What Spark's own writer escapes in the name of a folder, and its name for none.
_ESCAPED = frozenset(map(chr, range(1, 32))) | set("\"#%'*/:=?\\\x7f{[]^")
_NO_NAME = "__HIVE_DEFAULT_PARTITION__"
NAMES_AT_ONCE = 100_000  # whose files one task puts in place
SPREAD = 1024  # folders that those of very many names are dealt into


def open_store(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a URI for use in tasks, and the path in it."""
    return pyarrow.fs.FileSystem.from_uri(uri) if "://" in uri else (pyarrow.fs.LocalFileSystem(), uri.removeprefix("file:"))


def _folder_name(column: str, value) -> str:
    return f"{column}={''.join(f'%{ord(c):02X}' if c in _ESCAPED else c for c in str(value)) if value not in (None, '') else _NO_NAME}"


_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def _cleaning(spark: SparkSession):
    """Shuffle files of the jobs inside go once they are done, and not when the driver collects garbage."""
    before = spark.conf.get(_CLEAN)
    spark.conf.set(_CLEAN, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEAN, before)


def _replace_folders(rows: DataFrame, folder: str, name: str, single: bool, spread: int = 1) -> None:
    """``name`` and ``value`` of rows as files below one folder for each name, which is replaced as a whole; with
    ``single`` a row is a file, else the rows of a name and task are.  Folders of names lie in ``spread`` folders, so that no
    folder holds all of them.

    Tasks write files to a folder of the job and a table of those that count, then tasks put the files of each
    name in place, so no step goes through the driver file by file.  Both steps may be repeated.
    """
    spark = rows.sparkSession
    job = f"{folder.rstrip('/')}/_staged-{uuid.uuid4().hex}"
    column = name

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(job)
        own, made, last = f"{root}/files/{uuid.uuid4().hex}", 0, None
        store.create_dir(own, recursive=True)
        out = None
        for batch in batches:
            names, files = [], []
            for value, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                at = _folder_name(column, value)
                if single or out is None or at != last:
                    if out is not None:
                        out.close()
                    file = f"{own}/part-{made:08d}-{uuid.uuid4().hex}.txt"
                    out, last, made = store.open_output_stream(file), at, made + 1
                    names.append(at)
                    files.append(file)
                out.write((text.as_buffer().to_pybytes() if text.is_valid else b"") + b"\n")
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(files, pa.string())], names=["name", "file"])
        if out is not None:
            out.close()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        for batch in batches:
            for at, staged in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                among = f"/among={zlib.crc32(at.encode()) % spread:04d}" if spread > 1 else ""
                target = f"{root.rstrip('/')}{among}/{at}"
                new = {f"{target}/{x.rsplit('/', 1)[-1]}": x for x in staged}
                there = {i.path for i in store.get_file_info(pyarrow.fs.FileSelector(target, allow_not_found=True))}
                if not there:
                    store.create_dir(target, recursive=True)
                for old in there - new.keys():
                    store.delete_file(old)
                for path in new.keys() - there:
                    store.move(new[path], path)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    sorted_rows = rows if single else rows.sortWithinPartitions(name)
    with _cleaning(spark):
        sorted_rows.select(F.col(name).cast("string"), F.col("value").cast("string")).mapInArrow(stage, "name string, file string").write.parquet(f"{job}/names")
        staged = spark.read.schema("name string, file string").parquet(f"{job}/names")
        parts = max(spark.sparkContext.defaultParallelism, -(-staged.count() // NAMES_AT_ONCE))
        staged.repartition(parts, "name").groupBy("name").agg(F.collect_list("file").alias("files")).mapInArrow(place, "n bigint").agg(F.sum("n")).collect()
    at, store = _store(spark, job)
    store.delete(at, True)


def write_texts(rows: DataFrame, folder: str, name: str = "doc", text: str = "text", spread: int = 1) -> None:
    """Texts as files below one folder for each name; a folder is replaced as a whole, so no file of an
    earlier, longer version stays.  ``spread`` is for very many names: their folders are dealt into so many."""
    _replace_folders(rows.select(F.col(name), F.col(text).alias("value")), folder, name, single=False, spread=spread)


def corpus(paragraphs: DataFrame) -> DataFrame:
    """``doc, text``: the paragraphs of each document in order, with an empty line between them."""
    ordered = F.array_sort(F.collect_list(F.struct("para_no", "text")))
    return paragraphs.groupBy("doc").agg(F.array_join(F.transform(ordered, lambda p: p["text"]), "\n\n").alias("text"))


def write_chunks(chunks: DataFrame, folder: str, ordered: bool = False, spread: int = 1) -> None:
    """``doc, chunk_no, chunk`` as one file each, in order below the document's folder, which is replaced
    as a whole: of a document that has fewer chunks now, none of the earlier ones stays.  With ``ordered``, chunks of a
    document follow each other already and are not moved again; ``spread`` is that of :func:`write_texts`."""
    rows = chunks if ordered else chunks.repartition("doc").sortWithinPartitions("doc", "chunk_no")
    _replace_folders(rows.select("doc", F.col("chunk").alias("value")), folder, "doc", single=True, spread=spread)


def append_jsonl(rows: DataFrame, folder: str) -> None:
    """Rows as JSON lines, nulls and non-ASCII characters kept, added to what is there."""
    rows.write.mode("append").option("ignoreNullFields", "false").json(folder)


def write_json(rows: DataFrame, folder: str, per_file: int = 0) -> None:
    """Rows as JSON lines in place of what is there; at most ``per_file`` of them in a file, if given."""
    rows.write.mode("overwrite").option("ignoreNullFields", "false").option("maxRecordsPerFile", str(per_file)).json(folder)


def append_log(spark: SparkSession, folder: str, stage: str, message: str) -> None:
    """One more ``at, stage, message`` of a run's log."""
    spark.range(1).select(F.current_timestamp().alias("at"), F.lit(stage).alias("stage"), F.lit(message).alias("message")).coalesce(1).write.mode("append").json(folder)


def tail(lines: DataFrame, n: int = 12) -> DataFrame:
    """The last ``n`` of ``line_no, value``, in order."""
    return lines.orderBy(F.desc("line_no")).limit(n).orderBy("line_no")


def targets(wanted: DataFrame, files: DataFrame, on: str = "file") -> DataFrame:
    """``wanted`` with ``found``: whether a file of that name is there."""
    there = files.select(on).distinct().withColumn("found", F.lit(True))
    return wanted.join(there, on, "left").withColumn("found", F.coalesce("found", F.lit(False)))


def first_usable(candidates: DataFrame, usable: Column, order: str) -> DataFrame:
    """The first candidate in order that is usable; no row without one."""
    return candidates.filter(usable).orderBy(order).limit(1)


def _store(spark: SparkSession, path: str):
    """Hadoop's path and the file context that serves it."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    at = hadoop.Path(path)
    return at, hadoop.FileContext.getFileContext(at.toUri(), spark._jsc.hadoopConfiguration()) if at.toUri().getScheme() else hadoop.FileContext.getFileContext(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, store = _store(spark, path)
    return store.util().exists(at)


def copy_first(spark: SparkSession, names: list[str], sources: list[str], target: str) -> list[str]:
    """Copy each name from the first source folder that has it; returns the names that were found."""
    done = []
    for name in names:
        for source in sources:
            at, store = _store(spark, f"{source}/{name}")
            if store.util().exists(at):
                store.util().copy(at, spark._jvm.org.apache.hadoop.fs.Path(f"{target}/{name}"), False, True)
                done.append(name)
                break
    return done


PROGRESS = "last_chunk"  # fixed value: the key that holds the index


def load_progress(path: str, total: int | None = None) -> int:
    """Saved index, at most ``total``; 0 if there is no file or no whole number from 0 in it."""
    spark = SparkSession.active()
    at, store = _store(spark, str(path))
    if not store.util().exists(at):
        return 0
    saved = F.try_variant_get(F.try_parse_json("value"), f"$.{PROGRESS}", "variant")
    whole = F.when(F.schema_of_variant(saved) == "BIGINT", F.try_variant_get(saved, "$", "bigint"))
    index = F.greatest(F.coalesce(whole, F.lit(0)), F.lit(0))
    bound = index if total is None else F.least(index, F.lit(total))
    return spark.read.text(str(path), wholetext=True).agg(F.coalesce(F.max(bound), F.lit(0))).first()[0]


def save_progress(index: int, path: str) -> None:
    """Save an index: a new file takes the place of the old one in one rename of the store."""
    if isinstance(index, bool) or not isinstance(index, int) or index < 0:
        raise ValueError("the index must be a whole number from 0")
    spark = SparkSession.active()
    at, store = _store(spark, str(path))
    fs = spark._jvm.org.apache.hadoop.fs
    new = fs.Path(at.getParent(), f".{at.getName()}.{uuid.uuid4().hex}")
    out = new.getFileSystem(spark._jsc.hadoopConfiguration()).create(new, True)
    out.write(bytearray(f'{{"{PROGRESS}": {index}}}', "utf-8"))
    out.close()
    replace = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    replace[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    store.rename(new, at, replace)
