"""Text records: headered CSV/TSV, headerless TSV and folders of text files."""

from __future__ import annotations

import csv
import os
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphvec.functions.order import natural_key
from glyphvec.functions.text import file_name, file_stem, or_empty
from glyphvec.operators.ordinals import assign_index_id, number_split_rows
from glyphvec.session import (
    copy_hidden,
    count_files,
    file_uri,
    is_directory,
    listed_files,
    materialise,
    mounted_path,
    planned_bytes,
)

ID = "video_id"
TEXT = "video_title"
TSV_SUFFIXES = (".tsv", ".txt")
TEXT_FILE_GLOB = "*.[tT][xX][tT]"
#: Spark puts few small files into a split, a task takes several splits up to as many files or bytes.
FILES_PER_TASK, BYTES_PER_TASK = 1000, 64 * 1024 * 1024
#: The same where tasks get names: few enough tasks that the keys which set their ranges suit the driver.
NAMES_PER_TASK = 10_000
#: Rows of a batch, and of a file, of a folder's names; bytes of contents that a task holds at once, or one file.
NAMES_PER_BATCH, NAMES_PER_FILE, BYTES_PER_BATCH = 5_000, 20_000, 8 * 1024 * 1024


def _is_tsv(path: str) -> bool:
    return os.path.splitext(path)[1].lower() in TSV_SUFFIXES


def first_fields(spark: SparkSession, path: str, sep: str, quote: str) -> list[str]:
    """Fields of the first line that is not blank; an empty list for an empty input."""
    line = spark.read.text(path).filter(F.length(F.trim("value")) > 0).head(1)
    if not line:
        return []
    quoting = {"quotechar": quote} if quote else {"quoting": csv.QUOTE_NONE}
    return next(csv.reader([line[0]["value"].removeprefix("\ufeff")], delimiter=sep, **quoting))


def breaks_in_quotes(spark: SparkSession, path: str, quote: str) -> bool:
    """Whether some line has an odd number of quotes: a quoted field goes on in the next line, or a
    quote stands by itself, which parsing across lines reads alike."""
    if not quote:
        return False
    line = F.col("value")
    quotes = F.length(line) - F.length(F.replace(line, F.lit(quote), F.lit("")))
    return not spark.read.text(path).filter(quotes % 2 == 1).isEmpty()


def read_tabular(
    spark: SparkSession,
    path: str,
    *,
    sep: str | None = None,
    header: bool | None = None,
    quote: str = '"',
    multi_line: bool | None = None,
    ordered: bool = False,
) -> DataFrame:
    """Records of a delimited file, or of a folder of delimited part files.

    ``sep`` and ``header`` default by suffix: ``.tsv``/``.txt`` is tab-separated and has a header if
    a field of its first line is named ``video_title``; anything else is comma-separated with header.
    All fields are read as text. ``quote=""`` reads files that were written without quoting.
    ``multi_line`` accepts line breaks inside quotes, at the price of unsplittable files; by default a
    scan for lines with an open quote decides.
    ``ordered`` adds ``index_id``, the position in the input.
    """
    tsv = _is_tsv(path) if sep is None else sep == "\t"
    sep = sep or ("\t" if tsv else ",")
    fields = first_fields(spark, path, sep, quote)
    if header is None:
        header = not tsv or TEXT in fields
    if header:
        if fields and TEXT not in fields:
            raise ValueError(f"missing required column {TEXT!r} in {path}")
        names = fields or [ID, TEXT]
    else:
        if len(fields) == 1:
            raise ValueError(f"expected id<TAB>text, two columns, in {path}")
        names = [ID, TEXT]

    # The header is already checked, so the columns are positional; the spare one catches surplus.
    labels = [f"_c{i}" for i in range(len(names))] + ["_surplus"]
    scan = (
        spark.read.schema(", ".join(f"`{c}` STRING" for c in labels))
        .option("sep", sep)
        .option("header", header)
        .option("quote", quote)
        .option("escape", quote or "\\")
        .option("multiLine", breaks_in_quotes(spark, path, quote) if multi_line is None else multi_line)
        .csv(path)
    )
    text = or_empty(F.col(labels[names.index(TEXT)]))
    if header:
        surplus = F.raise_error(F.lit(f"a line has more than {len(names)} fields in {path}"))
        text = F.when(F.col("_surplus").isNotNull(), surplus.cast("string")).otherwise(text)
    columns = [text.alias(TEXT)]
    if ID in names:
        columns.insert(0, or_empty(F.col(labels[names.index(ID)])).alias(ID))
    if not ordered:
        return scan.select(*columns)
    return number_split_rows(scan, columns)


def _scan_folder(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", TEXT_FILE_GLOB)
        .option("recursiveFileLookup", True)
        .load(path)
    )


def _directly_in(spark: SparkSession, path: str, uri: Column) -> tuple[Column, Column]:
    """The file's URI in one spelling, and whether the file stands in the folder itself."""
    uri = F.regexp_replace(uri, "^file:/+", "file:/")
    return uri, F.regexp_extract(uri, "^(.*)/[^/]*$", 1) == file_uri(spark, path)


def _scanned_files(spark: SparkSession, path: str) -> DataFrame:
    """(file_uri, path, content) by Spark's own scan, whose driver holds the names of all files.

    A condition on ``file_uri`` selects files while the scan is planned, before any is opened, and
    without ``content`` no file is opened at all.
    """
    scan = _scan_folder(spark, path)
    n_files, cores = count_files(scan), spark.sparkContext.defaultParallelism
    tasks = max(4 * cores, n_files // FILES_PER_TASK, planned_bytes(scan) // BYTES_PER_TASK)
    uri, here = _directly_in(spark, path, F.col("_metadata.file_path"))
    files = scan.filter(here).select(uri.alias("file_uri"), "path", "content").coalesce(tasks)
    hidden = copy_hidden(spark, path, ".txt")
    if hidden:
        copies, names = hidden
        known = spark.createDataFrame(names, "copy STRING, file_uri STRING, path STRING")
        found = spark.read.format("binaryFile").load(copies).withColumn("copy", file_name(F.col("path")))
        content = F.coalesce("content", F.lit("").cast("binary")).alias("content")
        kept = known.join(found.select("copy", "content"), "copy", "left")
        files = files.unionByName(kept.select("file_uri", "path", content))
    # Spark scans leave out files without a byte. Where the listing has more files than the scan,
    # they are taken from the listing, which the driver holds for the scan anyway.
    if n_files == scan.select("path").coalesce(tasks).count():
        return files
    listed = listed_files(scan)
    uri, here = _directly_in(spark, path, F.col("value"))
    names = listed.filter(here).select(
        uri.alias("file_uri"),
        F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B"))).alias("path"),
        F.lit("").cast("binary").alias("content"),
    )
    return files.unionByName(names.join(files.select("file_uri"), "file_uri", "left_anti"))


def _text_file(entry: os.DirEntry) -> tuple[bytes, int] | None:
    """Name and size of an entry that is a text file."""
    try:
        if entry.name[-4:].lower() == b".txt" and entry.is_file():
            return entry.name, entry.stat().st_size
    except FileNotFoundError:  # it went meanwhile
        pass
    return None


def _listed_files(spark: SparkSession, path: str, folder: str) -> DataFrame:
    """(file_uri, path, file, size) of the files in a mounted folder, ``file`` being the path in bytes.

    One task lists the folder and writes the names as it goes, so neither it nor the driver holds them.
    """

    def names(ones: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in ones:
            with os.scandir(os.fsencode(folder) or b"/") as entries:
                found = filter(None, map(_text_file, entries))
                while some := list(islice(found, NAMES_PER_BATCH)):
                    columns = [pa.array(c, t) for c, t in zip(zip(*some), (pa.binary(), pa.int64()))]
                    yield pa.RecordBatch.from_arrays(columns, ["name", "size"])

    listing = spark.range(0, 1, 1, 1).mapInArrow(names, "name BINARY, size BIGINT")
    listing = materialise(listing, "names", maxRecordsPerFile=NAMES_PER_FILE)
    name = F.make_valid_utf8(F.col("name").cast("string"))
    return listing.select(
        F.concat(F.lit(file_uri(spark, path) + "/"), F.replace(F.url_encode(name), F.lit("+"), F.lit("%20"))).alias("file_uri"),
        F.concat(F.lit(f"file:{folder}/"), name).alias("path"),
        F.concat(F.lit(os.fsencode(folder + "/")), "name").alias("file"),
        "size",
    )


def text_names(spark: SparkSession, path: str) -> DataFrame:
    """(file_uri, path) of each text file directly in the folder, and what ``with_content`` takes its content
    from. Sub-folders are not entered, and no file is opened."""
    folder = mounted_path(spark, path)
    if folder is None or not is_directory(spark, path):
        return _scanned_files(spark, path)
    return _listed_files(spark, path, folder)


def _tasks(names: DataFrame) -> int:
    """Number of tasks that read the files of these names."""
    n_files, size = names.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).head()
    cores = names.sparkSession.sparkContext.defaultParallelism
    return max(1, min(n_files, max(4 * cores, n_files // NAMES_PER_TASK, size // BYTES_PER_TASK)))


def with_content(names: DataFrame, *order: Column) -> DataFrame:
    """Rows of ``text_names`` with ``content``; in this order, if one is given.

    Names are dealt out, by ranges of the first key, and sorted; files are read where their names have come to.
    No content is shuffled. Where Spark's scan reads the files, it has dealt them out, and they are sorted with
    their content.
    """
    if "content" in names.columns:
        return names.orderBy(*order) if order else names
    if order:
        dealt = names.repartitionByRange(_tasks(names), order[0]).sortWithinPartitions(*order)
    else:
        dealt = names.repartition(_tasks(names), "file_uri")
    kept = [c for c in names.columns if c not in ("file", "size")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, contents, held = batch.select(kept), [], 0
            for i, file in enumerate(batch.column("file").to_pylist(), 1):
                with open(file, "rb", buffering=0) as source:
                    contents.append(source.read())
                held += len(contents[-1])
                if held >= BYTES_PER_BATCH or i == batch.num_rows:
                    part = rows.slice(i - len(contents), len(contents))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(contents, pa.binary())], [*kept, "content"])
                    contents, held = [], 0

    schema = names.select(*kept).schema.add("content", "binary")
    return dealt.mapInArrow(read, schema)


def file_text(content: Column) -> Column:
    """Bytes as UTF-8 text, bad bytes replaced, line ends as newlines."""
    return F.regexp_replace(F.make_valid_utf8(content.cast("string")), "\r\n?", "\n")


def read_text_folder(spark: SparkSession, path: str, *, ordered: bool = False) -> DataFrame:
    """One record per ``.txt`` file: the stem is the id, trailing line ends are dropped.

    ``ordered`` numbers the files in natural name order. Only the names are ranked.
    """
    names = text_names(spark, path)
    record = [
        file_stem(F.col("path")).alias(ID),
        F.regexp_replace(file_text(F.col("content")), "[\r\n]+$", "").alias(TEXT),
    ]
    if not ordered:
        return with_content(names).select(*record)
    name = file_name(F.col("path"))
    keyed = names.drop("content").withColumns({"_key": natural_key(name), "_name": name})
    if "content" in names.columns:
        ranks = assign_index_id(keyed, ["_key", "_name"]).select("file_uri", "index_id")
        return names.join(ranks, "file_uri").select("index_id", *record)
    ranks = assign_index_id(keyed, ["_key", "_name"], _tasks(names)).drop("_key", "_name")
    return with_content(ranks).select("index_id", *record)


def read_texts(
    spark: SparkSession,
    path: str,
    *,
    ordered: bool = False,
    tabular: bool | None = None,
    **options,
) -> DataFrame:
    """A folder is read as text files, anything else as a delimited file. ``tabular=True`` reads a
    folder as delimited part files, such as another job's output."""
    if tabular is None:
        tabular = not is_directory(spark, path)
    if tabular:
        return read_tabular(spark, path, ordered=ordered, **options)
    return read_text_folder(spark, path, ordered=ordered)


def count_records(spark: SparkSession, path: str, **options) -> int:
    """Number of records; for a folder the file contents are not read."""
    if is_directory(spark, path):
        return text_names(spark, path).select("path").count()
    return read_tabular(spark, path, **options).count()

