"""Text cleaning, scalar text functions, readers and writers of text records."""

from __future__ import annotations

import os
import uuid
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import Catalogue, table
from glyphvec.functions.order import natural_key, numeric_first_key
from glyphvec.functions.slugs import dataset_slug, model_slug, model_slug_from_path, slug
from glyphvec.functions.text import (
    clean_text,
    file_stem,
    item_label,
    media_url,
    nfkc,
    non_empty,
    single_line,
)
from glyphvec.operators.embed import HashingProvider
from glyphvec.operators.ordinals import assign_index_id
from glyphvec.plans.embedding import embed_texts
from glyphvec.plans.prepare import merged_texts
from glyphvec.session import is_directory, make_folder, materialise, mounted_path, planned_bytes, widen, work_path
from glyphvec.sinks.tables import format_of, text_lines, write_text_table
from glyphvec.sources.texts import BYTES_PER_TASK, count_records, read_tabular, read_text_folder, read_texts
from glyphvec.sources.vectors import read_vectors
from glyphvec.streaming.embedding import embed_stream
from glyphvec.streaming.ordinals import number_batches, number_stream

C = Catalogue()
QUERIES, SQL = C.queries, C.sql

WS = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
EMOJI = r"\x{1F300}-\x{1F5FF}\x{1F600}-\x{1F64F}\x{1F680}-\x{1FAFF}\x{2600}-\x{27BF}"
ALL_OFF = dict.fromkeys(
    (
        "normalize_unicode_nfkc",
        "remove_control_chars",
        "remove_urls",
        "collapse_whitespace",
        "strip",
    ),
    False,
)


def sql_sub(text: str, pattern: str, by: str = " ") -> str:
    return f"regexp_replace({text}, '{pattern}', '{by}', 'g')"


def sql_controls(text: str) -> str:
    return sql_sub(text, r"[\p{Cc}\p{Cf}]", "")


def sql_urls(text: str) -> str:
    return sql_sub(text, rf"(?i)(https?://[^{WS}]+|www\.[^{WS}]+)")


def sql_strip(text: str) -> str:
    return sql_sub(text, rf"^[{WS}]+|[{WS}]+$", "")


def sql_line(text: str) -> str:
    return sql_strip(sql_sub(text, rf"[{WS}]+"))


def sql_clean(text: str) -> str:
    """The default rules, but for NFKC, which DuckDB lacks and these texts do not need."""
    return sql_line(sql_urls(sql_controls(text)))


def cleaned(spark: SparkSession, sf_dir: str, text, rules, patterns="intended") -> DataFrame:
    docs = widen(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    return docs.select("doc_id", clean_text(text, rules, patterns).alias("cleaned"))


@C.add("SELECT count(*) AS n_records FROM documents")
def row_count(spark, sf_dir):
    return table(spark, sf_dir, "documents").agg(F.count(F.lit(1)).alias("n_records"))


@C.add(f"SELECT doc_id, {sql_clean('text')} AS cleaned FROM documents")
def clean_default(spark, sf_dir):
    return cleaned(spark, sf_dir, F.col("text"), None)


@C.add(f"SELECT doc_id, {sql_controls('text')} AS cleaned FROM documents")
def clean_controls(spark, sf_dir):
    return cleaned(spark, sf_dir, F.col("text"), {**ALL_OFF, "remove_control_chars": True})


@C.add(f"SELECT page_id, {sql_urls('url || chr(10) || html')} AS cleaned FROM pages")
def clean_urls(spark, sf_dir):
    text = F.concat("url", F.lit("\n"), "html")
    rules = {**ALL_OFF, "remove_urls": True}
    return table(spark, sf_dir, "pages").select("page_id", clean_text(text, rules).alias("cleaned"))


MENTION = r"@[\p{L}\p{N}_]+"


@C.add(f"""SELECT doc_id, {sql_sub("'@' || source || ' ' || text", MENTION)} AS cleaned FROM documents""")
def clean_mentions(spark, sf_dir):
    text = F.concat(F.lit("@"), "source", F.lit(" "), "text")
    return cleaned(spark, sf_dir, text, {**ALL_OFF, "remove_mentions": True})


HASHTAG = r"#[\p{L}\p{N}_]+"


@C.add(f"""SELECT doc_id, {sql_sub("text || ' #' || lang || '_1 # end'", HASHTAG)} AS cleaned FROM documents""")
def clean_hashtags(spark, sf_dir):
    text = F.concat("text", F.lit(" #"), "lang", F.lit("_1 # end"))
    return cleaned(spark, sf_dir, text, {**ALL_OFF, "remove_hashtags": True})


EMOJI_TEXT = "chr(128054) || chr(128640) || text || chr(10084) || lang || chr(128592)"


@C.add(f"SELECT doc_id, {sql_sub(EMOJI_TEXT, f'[{EMOJI}]+')} AS cleaned FROM documents")
def clean_emojis(spark, sf_dir):
    text = F.concat(
        F.lit("\U0001f436\U0001f680"), "text", F.lit("❤"), "lang", F.lit("\U0001f650")
    )
    return cleaned(spark, sf_dir, text, {**ALL_OFF, "remove_emojis": True})


@C.add("SELECT doc_id, lower(text) AS cleaned FROM documents")
def clean_lower(spark, sf_dir):
    return cleaned(spark, sf_dir, F.col("text"), {**ALL_OFF, "lowercase_latin": True})


@C.add(f"SELECT doc_id, substr({sql_clean('text')}, 1, 80) AS cleaned FROM documents")
def clean_truncate(spark, sf_dir):
    # max_length is a cleaning rule of its own; this query is about that rule.
    return cleaned(spark, sf_dir, F.col("text"), {"max_length": 80})


EVERYTHING = "'@' || source || ' #' || lang || ' www.x.org/' || lang || ' ' || chr(128054) || text"


def sql_every_rule(text: str) -> str:
    out = sql_urls(sql_controls(text))
    out = sql_sub(sql_sub(out, MENTION), HASHTAG)
    return sql_line(f"lower({sql_sub(out, f'[{EMOJI}]+')})")


@C.add(f"SELECT doc_id, {sql_every_rule(EVERYTHING)} AS cleaned FROM documents")
def clean_every_rule(spark, sf_dir):
    text = F.concat(
        F.lit("@"),
        "source",
        F.lit(" #"),
        "lang",
        F.lit(" www.x.org/"),
        "lang",
        F.lit(" \U0001f436"),
        "text",
    )
    names = ("remove_mentions", "remove_hashtags", "remove_emojis", "lowercase_latin")
    return cleaned(spark, sf_dir, text, dict.fromkeys(names, True))


@C.add(
    r"""SELECT doc_id, """
    + sql_strip(
        sql_sub(
            sql_sub(
                sql_controls(r"text || 'https://\s www.a\s\s  b'"),
                r"(?i)(https?://\\S+|www\\.\\S+)",
            ),
            r"\\s+",
        )
    )
    + " AS cleaned FROM documents"
)
def clean_literal(spark, sf_dir):
    text = F.concat("text", F.lit(r"https://\s www.a\s\s  b"))
    return cleaned(spark, sf_dir, text, None, "literal")


@C.add("SELECT doc_id, lang || text || 'fi1' AS normal FROM documents")
def nfkc_compatibility(spark, sf_dir):
    # Only the appended ligature and circled digit change.
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", nfkc(F.concat("lang", "text", F.lit("ﬁ①"))).alias("normal"))


@C.add("SELECT doc_id, text || 'fi' || chr(233) || 'kg' || chr(44032) AS normal FROM documents")
def nfkc_forms(spark, sf_dir):
    # All of a text in full-width forms, then what becomes two letters, and what composes to one.
    printable = [chr(i) for i in range(0x21, 0x7F)]
    wide = F.translate("text", "".join(printable), "".join(chr(ord(c) + 0xFEE0) for c in printable))
    forms = F.concat(wide, F.lit("ﬁe\u0301㎏\u1100\u1161"))
    return table(spark, sf_dir, "documents").select("doc_id", nfkc(forms).alias("normal"))


BLANKED = "CASE WHEN doc_id % 3 = 0 THEN '  ' || chr(12288) WHEN doc_id % 3 = 1 THEN NULL ELSE text END"


@C.add(
    f"SELECT doc_id, length({sql_strip(f'coalesce({BLANKED}, {chr(39)*2})')}) > 0 AS has_text FROM documents"
)
def non_empty_mask(spark, sf_dir):
    third = F.col("doc_id") % 3
    text = F.when(third == 0, F.lit("  　")).when(third == 2, F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", non_empty(text).alias("has_text"))


@C.add(f"SELECT doc_id || chr(9) || {sql_line('text')} AS value FROM documents")
def merge_lines(spark, sf_dir):
    docs = widen(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return text_lines(docs.select("doc_id", single_line(F.col("text")).alias("text")), "doc_id", "text")


def sql_natural(name: str) -> str:
    digits = f"regexp_extract_all({name}, '[0-9]+')"
    return f"""list_transform(
        list_zip(string_split_regex(lower({name}), '[0-9]+'), {digits}),
        lambda p: {{'t': p[1], 'n': coalesce(CAST(p[2] AS HUGEINT), -1)}})"""


@C.add(
    f"""SELECT page_id, url,
        row_number() OVER (ORDER BY {sql_natural('url')}, url, page_id) - 1 AS index_id
        FROM pages"""
)
def natural_order(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    keyed = pages.withColumn("_key", natural_key(F.col("url")))
    return assign_index_id(keyed, ["_key", "url", "page_id"]).drop("_key")


@C.add(
    """SELECT p_partkey, stem, row_number() OVER
        (ORDER BY TRY_CAST(stem AS BIGINT) IS NULL, TRY_CAST(stem AS BIGINT),
                  CASE WHEN TRY_CAST(stem AS BIGINT) IS NULL THEN stem END, p_partkey) - 1 AS index_id
       FROM (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN CAST(p_partkey * 7919 % 1000 AS VARCHAR)
                    WHEN 1 THEN '-0' || CAST(p_partkey AS VARCHAR)
                    ELSE p_name || CAST(p_partkey AS VARCHAR) END AS stem FROM part)"""
)
def numeric_first_order(spark, sf_dir):
    key = F.col("p_partkey")
    stem = (
        F.when(key % 3 == 0, (key * 7919 % 1000).cast("string"))
        .when(key % 3 == 1, F.concat(F.lit("-0"), key.cast("string")))
        .otherwise(F.concat("p_name", key.cast("string")))
    )
    named = table(spark, sf_dir, "part").select("p_partkey", stem.alias("stem"))
    keyed = named.withColumn("_key", numeric_first_key(F.col("stem")))
    return assign_index_id(keyed, ["_key", "p_partkey"]).drop("_key")


def sql_slug(value: str) -> str:
    bare = sql_sub(sql_sub(sql_strip(value), "[^A-Za-z0-9._-]+", "-"), "^[-._]+|[-._]+$", "")
    return f"CASE WHEN {bare} = '' THEN 'unknown' ELSE {bare} END"


URL_TAIL = r"regexp_extract(regexp_replace(url, '/+$', ''), '([^/]*)$', 1)"


@C.add(
    f"""SELECT page_id, {sql_slug('url')} AS slug,
        {sql_slug(URL_TAIL)} AS model,
        {sql_slug(f"regexp_replace({URL_TAIL}, '^(.+)[.][^.]+$', '{chr(92)}1')")} AS dataset
        FROM pages"""
)
def slugs(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        slug(url).alias("slug"),
        model_slug(url).alias("model"),
        dataset_slug(url).alias("dataset"),
    )


@C.add(
    f"""SELECT p_partkey, {sql_slug('p_name')} AS part_slug, {sql_slug('p_brand')} AS model,
        'unknown-model' AS unknown FROM part"""
)
def model_path_slugs(spark, sf_dir):
    path = F.concat(F.lit("output/models/"), "p_brand", F.lit("/embeddings/"), "p_name")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        slug(F.col("p_name")).alias("part_slug"),
        model_slug_from_path(path).alias("model"),
        model_slug_from_path(F.col("p_name")).alias("unknown"),
    )


@C.add(
    """SELECT p_partkey, 'https://x.org/v/' || p_partkey || '.mp4' AS url,
        CASE WHEN p_size > 25 THEN p_partkey || '  (' || p_name || ')' ELSE CAST(p_partkey AS VARCHAR) END AS label,
        p_name || '.v' || p_size AS stem FROM part"""
)
def item_labels(spark, sf_dir):
    key = F.col("p_partkey").cast("string")
    title = F.when(F.col("p_size") > 25, F.col("p_name")).otherwise(F.lit(""))
    path = F.concat(F.lit("s3://b/a.b/"), "p_name", F.lit(".v"), "p_size", F.lit(".TXT"))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        media_url(key, "https://x.org/v").alias("url"),
        item_label(key, title).alias("label"),
        file_stem(path).alias("stem"),
    )


DOC_LINES = f"SELECT CAST(doc_id AS VARCHAR) AS video_id, {sql_line('text')} AS video_title FROM documents"


def documents_as_records(spark, sf_dir) -> DataFrame:
    docs = widen(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select(
        F.col("doc_id").cast("string").alias("video_id"),
        single_line(F.col("text")).alias("video_title"),
    )


@C.add(DOC_LINES)
def headerless_tsv(spark, sf_dir):
    path = work_path(spark, "headerless")
    write_text_table(documents_as_records(spark, sf_dir), path)
    return read_tabular(spark, path, sep="\t", quote="")


@C.add(DOC_LINES)
def headered_tsv(spark, sf_dir):
    path = work_path(spark, "headered")
    docs = documents_as_records(spark, sf_dir)
    docs.write.option("sep", "\t").option("header", True).option("escape", '"').csv(path)
    return read_tabular(spark, path, sep="\t")


@C.add("SELECT CAST(doc_id AS VARCHAR) AS video_id, text AS video_title FROM documents")
def headered_csv_multi_line(spark, sf_dir):
    # Quoted line breaks; the reader keeps each text as it was written.
    path = work_path(spark, "multi-line")
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("video_id"), F.col("text").alias("video_title")
    )
    docs.write.option("header", True).option("escape", '"').option("quoteAll", True).option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(path)
    return read_tabular(spark, path, sep=",", multi_line=True)


@C.add(
    f"""SELECT row_number() OVER (ORDER BY doc_id) - 1 AS index_id, CAST(doc_id AS VARCHAR) AS video_id,
        {sql_line('text')} AS video_title FROM documents"""
)
def ordered_tsv(spark, sf_dir):
    # The position in the input files, over several files and splits.
    path = work_path(spark, "ordered")
    docs = table(spark, sf_dir, "documents").repartitionByRange(5, "doc_id")
    lines = docs.sortWithinPartitions("doc_id").select(
        F.col("doc_id").cast("string").alias("video_id"),
        single_line(F.col("text")).alias("video_title"),
    )
    write_text_table(lines, path)
    return read_tabular(spark, path, sep="\t", quote="", ordered=True)


def _one_file_per_row(folder: str, job: str):
    """Writes a file for each (doc_id, text): the text and a line end, as Spark's writer does."""

    def write(batches):
        tail, n = f"{job}-{TaskContext.get().partitionId():05d}", 0
        # Files come into place whole; a task that runs again writes the same ones. Many tasks that create
        # files in one folder wait for each other far longer than for moves.
        own = f"{folder}/_temporary/{uuid.uuid4().hex}"
        os.makedirs(own)
        for batch in batches:
            for number, text in zip(*((v.as_py() for v in c) for c in batch.columns)):
                # From 1 on in the order of the ids, rows without an id first.
                head = 0 if number is None else number + 2**63 + 1
                name = f"part-{head:020d}-{tail}-c{n:03d}.txt"
                with open(f"{own}/{name}", "wb") as out:
                    out.write((text or b"") + b"\n")
                os.replace(f"{own}/{name}", f"{folder}/{name}")
                n += 1
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["files"])
        os.rmdir(own)

    return write


def one_file_per_document(spark, sf_dir) -> str:
    path = work_path(spark, "text-files")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = mounted_path(spark, path)
    if folder is None:
        # Part numbers lead the file names, so the order of the names is the order of the ids.
        tasks = max(4 * spark.sparkContext.defaultParallelism, planned_bytes(docs) // BYTES_PER_TASK)
        texts = docs.repartitionByRange(tasks, "doc_id").sortWithinPartitions("doc_id").select("text")
        # Tasks move their files into place themselves.
        version = "mapreduce.fileoutputcommitter.algorithm.version"
        texts.write.option("maxRecordsPerFile", 1).option(version, "2").text(path)
        return path
    # Hadoop's local file system starts a chmod process for every file, unless it has its native code. Here ids
    # lead the names, so no text is shuffled; the sort gives a task that runs again the same order.
    make_folder(spark, path)
    rows = widen(docs).sortWithinPartitions("doc_id", "text").select("doc_id", F.col("text").cast("binary"))
    rows.mapInArrow(_one_file_per_row(folder, str(uuid.uuid4())), "files BIGINT").write.format("noop").mode("overwrite").save()
    return path


@C.add(
    r"""SELECT md5(regexp_replace(regexp_replace(text, '\r\n?', chr(10), 'g'), '[\r\n]+$', '')) AS digest,
        true AS has_id FROM documents"""
)
def text_folder(spark, sf_dir):
    # File names are Spark's own, so only their presence is compared.
    records = read_texts(spark, one_file_per_document(spark, sf_dir))
    return records.select(
        F.md5("video_title").alias("digest"), (F.length("video_id") > 0).alias("has_id")
    )


@C.add(
    r"""SELECT row_number() OVER (ORDER BY doc_id) - 1 AS index_id, count(*) OVER () AS n_files,
        md5(regexp_replace(regexp_replace(text, '\r\n?', chr(10), 'g'), '[\r\n]+$', '')) AS digest FROM documents"""
)
def text_folder_ordered(spark, sf_dir):
    path = one_file_per_document(spark, sf_dir)
    records = read_text_folder(spark, path, ordered=True)
    return records.select(
        "index_id", F.lit(count_records(spark, path)).alias("n_files"), F.md5("video_title").alias("digest")
    )


@C.add(f"SELECT md5({sql_line('text')}) AS digest FROM documents")
def merged_folder(spark, sf_dir):
    records = merged_texts(spark, one_file_per_document(spark, sf_dir))
    return records.select(F.md5("video_title").alias("digest"))


def refused(action, message: str) -> bool:
    """Whether ``action`` fails, and says why."""
    try:
        action()
    except Exception as error:  # noqa: BLE001: any failure counts, if it says the right thing
        return message in str(error)
    return False


@C.add(
    """SELECT unnest(['csv', 'embeddings', 'ordered tsv', 'tsv', 'vectors']) AS form, count(*) AS n_rows,
       unnest(['video_id,video_title', 'video_id,video_title,embedding', 'index_id,video_id,video_title',
               'video_id,video_title', 'index_id,embedding']) AS names FROM documents WHERE doc_id < 0"""
)
def empty_inputs(spark, sf_dir):
    """Files without a byte, and outputs without a row, have their columns."""
    none = documents_as_records(spark, sf_dir).filter(F.col("video_id").cast("long") < 0)
    path = work_path(spark, "empty")
    write_text_table(none, path)
    found = {
        "csv": read_tabular(spark, path, sep=","),
        "tsv": read_tabular(spark, path, sep="\t", quote=""),
        "ordered tsv": read_tabular(spark, path, sep="\t", quote="", ordered=True),
    }
    for form, fmt in (("embeddings", "parquet"), ("vectors", "vectors")):
        output = work_path(spark, form)
        options = {"tabular": True, "sep": "\t", "quote": "", "header": False}
        embed_texts(spark, path, output, HashingProvider, fmt=fmt, **options)
        found[form] = spark.read.parquet(output)
    parts = [
        df.agg(F.lit(form).alias("form"), F.count(F.lit(1)).alias("n_rows"), F.lit(",".join(df.columns)).alias("names"))
        for form, df in found.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@C.add(
    """SELECT unnest(['.parquet', '.vectors', '']) AS suffix, count(*) AS n_rows,
       unnest(['video_id,video_title,embedding', 'index_id,embedding', 'video_id,video_title,embedding']) AS names,
       TRUE AS refuses_others FROM documents"""
)
def suffix_dispatch(spark, sf_dir):
    """The suffix of the output decides its form."""
    path = work_path(spark, "records")
    write_text_table(documents_as_records(spark, sf_dir), path)
    options = {"tabular": True, "sep": "\t", "quote": "", "header": False}
    strict = refused(lambda: format_of("out/table.csv"), "unsupported output suffix")
    parts = []
    for suffix in (".parquet", ".vectors", ""):
        output = work_path(spark, "by-suffix") + suffix
        embed_texts(spark, path, output, HashingProvider, **options)
        rows = spark.read.parquet(output)
        names = F.lit(",".join(rows.columns)).alias("names")
        count = F.count(F.lit(1)).alias("n_rows")
        parts.append(rows.agg(F.lit(suffix).alias("suffix"), count, names, F.lit(strict).alias("refuses_others")))
    return reduce(DataFrame.unionByName, parts)


@C.add(
    """SELECT unnest(['a record needs two fields', 'a table needs its text column', 'vectors need their column'])
       AS rule, count(*) AS n_rows, TRUE AS refused FROM documents"""
)
def required_columns(spark, sf_dir):
    """Inputs that lack a column are refused before any work."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("other"), F.col("lang").alias("name"))
    headed, single = work_path(spark, "no-text"), work_path(spark, "one-field")
    docs.write.option("header", True).csv(headed)
    docs.select(F.col("other").cast("string")).write.text(single)
    vectors = work_path(spark, "no-vectors")
    docs.write.parquet(vectors)
    found = {
        "a table needs its text column": refused(lambda: read_tabular(spark, headed, sep=","), "missing required column"),
        "a record needs two fields": refused(
            lambda: read_tabular(spark, single, sep="\t", header=False, quote=""), "two columns"
        ),
        "vectors need their column": refused(lambda: read_vectors(spark, vectors), "missing embedding column"),
    }
    parts = [
        docs.agg(F.lit(rule).alias("rule"), F.count(F.lit(1)).alias("n_rows"), F.lit(flag).alias("refused"))
        for rule, flag in found.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@C.add(
    """SELECT count(*) AS n_rows, count(*) AS n_distinct, 0 AS lowest, count(*) - 1 AS highest, TRUE AS in_order,
       TRUE AS replayed_alike FROM documents"""
)
def stream_ordinals(spark, sf_dir):
    """Ordinals over a stream of several batches; the last batch runs once more and gets the same."""
    source, output, state = (work_path(spark, label) for label in ("stream-in", "stream-out", "stream-state"))
    docs = table(spark, sf_dir, "documents").select("doc_id", F.length("text").alias("n"))
    docs.repartition(3, "doc_id").write.parquet(source)
    stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 1).parquet(source)
    number_stream(stream, output, state, ["doc_id"], available_now=True).awaitTermination()
    before = materialise(spark.read.parquet(output), "before")
    last = before.agg(F.max("batch_id")).first()[0]
    again = before.filter(F.col("batch_id") == last).select("doc_id", "n")
    number_batches(output, f"{state}/ordinals", ["doc_id"])(again, last)
    after = spark.read.parquet(output)
    moved = after.exceptAll(before.select(*after.columns)).isEmpty() and before.count() == after.count()
    follows = F.lag("doc_id").over(Window.partitionBy("batch_id").orderBy("index_id")) < F.col("doc_id")
    return after.withColumn("follows", F.coalesce(follows, F.lit(True))).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("index_id").alias("n_distinct"),
        F.min("index_id").cast("int").alias("lowest"),
        F.max("index_id").alias("highest"),
        F.bool_and("follows").alias("in_order"),
        F.lit(moved).alias("replayed_alike"),
    )


@C.add(f"SELECT doc_id, {sql_clean('text')} AS video_title, 64 AS dim FROM documents")
def streamed_embedding(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    path = f"{sf_dir}/documents.parquet"
    files = spark.readStream.schema(T.StructType(docs.schema.fields))
    # A stream reads folders: a table of one file is picked from the folder around it.
    if not is_directory(spark, path):
        files, path = files.option("pathGlobFilter", "documents.parquet"), sf_dir
    stream = files.parquet(path).select("doc_id", F.col("text").alias("video_title"))
    output = work_path(spark, "stream")
    embed_stream(
        stream, HashingProvider, output, f"{output}-state", rules={}, available_now=True
    ).awaitTermination()
    return spark.read.parquet(output).select(
        "doc_id", "video_title", F.size("embedding").alias("dim")
    )
