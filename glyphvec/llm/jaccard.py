"""N-gram Jaccard join: MinHash bands find candidates, full n-gram sets decide.

1. Every text gets its set of hashed word n-grams, a digest of its words and its band hashes. Texts with
   the same words form one class; only its smallest id goes on.
2. Classes that share a band hash are candidates. A bucket is never turned into pairs: each class notes
   the smallest class of its buckets as its *home*, homes are cut into blocks of bounded size, and a
   bucket names pairs of blocks. Blocks hold some hundred classes, so even a bucket with a third of all
   rows names few pairs of them.
3. A task gets the texts of two blocks, builds their n-gram sets again and counts common n-grams of all
   pairs at once. It returns one row per class with the list of its links.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphvec.llm.common import NOT_SPACE, bind, slices, table, words
from glyphvec.llm.components import components
from glyphvec.session import materialise, settled

WIDTH = 5
#: Links have a similarity of at least UPPER / LOWER.
UPPER, LOWER = 4, 5
RECALL = 0.9998
ROWS = 8
BLOCK_DOCS, BLOCK_NGRAMS = 512, 1_000_000
#: Ids of 8 bytes that are broadcast to pick out texts.
BROADCAST_IDS = 2_000_000
#: Values hashed at a time; they fit a core's cache.
SLICE = 1 << 17
#: Columns with more owners than this are multiplied as a dense matrix.
SPARSE = 6


def bands_for(similarity: float, rows: int = ROWS, recall: float = RECALL) -> int:
    """Bands of ``rows`` rows with which a pair at ``similarity`` meets with probability ``recall``."""
    return ceil(log(1 - recall) / log(1 - similarity**rows))


def ngrams(w: Column, width: int = WIDTH) -> Column:
    """Distinct hashed n-grams of the word list ``w``; a shorter list is one n-gram, an empty one none."""

    def joined(h: Column) -> Column:
        return F.transform(h, lambda x, i: F.xxhash64(x, *(F.get(h, i + k) for k in range(1, width))))

    hashed = bind(F.transform(w, lambda x: F.xxhash64(x)), joined)
    count = F.greatest(F.size(w) - (width - 1), F.least(F.size(w), F.lit(1)))
    return F.array_distinct(F.slice(hashed, 1, count))


def normalised(text: Column) -> Column:
    """Words in lower case; n-grams are made of these."""
    return words(F.lower(text))


def band_hashes(bands: int, rows: int = ROWS):
    """Column function: list of n-gram hashes -> one hash per band; no bands for an empty list."""
    random = np.random.default_rng(20240607)
    factors = (random.integers(0, 2**32, bands * rows, np.uint64) | 1).astype(np.uint32)
    shifts = random.integers(0, 2**32, bands * rows, np.uint64).astype(np.uint32)

    def of_lists(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
        mixed = (values ^ (values >> np.uint64(32))).astype(np.uint32)
        found = np.empty((len(starts), bands), np.uint64)
        for band in range(bands):
            key = np.full(len(starts), band + 1, np.uint64)
            for k in range(band * rows, (band + 1) * rows):
                least = np.minimum.reduceat(mixed * factors[k] + shifts[k], starts)
                key = (key ^ least) * np.uint64(0x9E3779B97F4A7C15)
                key ^= key >> np.uint64(29)
            found[:, band] = key
        return found

    @F.arrow_udf("array<bigint>")
    def hashes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in batches:
            sizes = np.diff(lists.offsets.to_numpy())
            values = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            filled = np.flatnonzero(sizes)
            out = np.empty((len(filled), bands), np.uint64)
            at = np.concatenate([[0], np.cumsum(sizes[filled])])
            for a, b in slices(sizes[filled], SLICE):
                out[a:b] = of_lists(values[at[a] : at[b]], at[a:b] - at[a])
            lengths = np.zeros(len(lists), np.int32)
            lengths[filled] = bands
            offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(out.ravel().view(np.int64)))

    return hashes


def common_counts(lists: list[np.ndarray]) -> np.ndarray:
    """Matrix of how many values each two of the (duplicate-free) lists have in common."""
    n = len(lists)
    counts = np.zeros((n, n), np.int64)
    owner = np.repeat(np.arange(n), [len(x) for x in lists])
    values = np.concatenate(lists) if n else np.zeros(0, np.int64)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, int)
    length = np.diff(np.append(first, len(values)))
    for m in range(2, SPARSE + 1):
        rows = owner[first[length == m][:, None] + np.arange(m)]
        for i in range(m):
            for j in range(i + 1, m):
                counts += np.bincount(rows[:, i] * n + rows[:, j], minlength=n * n).reshape(n, n)
    many = np.flatnonzero(length > SPARSE)
    for a, b in slices([1] * len(many), 4096):
        dense = np.zeros((n, b - a), np.float32)
        for column, k in enumerate(many[a:b]):
            dense[owner[first[k] : first[k] + length[k]], column] = 1
        product = np.rint(dense @ dense.T).astype(np.int64)
        counts += np.triu(product, 1)
    return counts + counts.T


def _verify(rows: pa.Table) -> pa.Table:
    """Links among the classes of each task; across its two sides only, if it has two."""
    task = rows["task"].to_numpy()
    side = rows["side"].to_numpy()
    ids = rows["rep"].to_numpy()
    lists = rows["ngrams"].combine_chunks()
    offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
    order = np.lexsort((ids, side, task))
    out: tuple[list, list, list] = ([], [], [])
    bounds = np.flatnonzero(np.append(True, task[order][1:] != task[order][:-1]))
    for own in np.split(order, bounds[1:]):
        sets = [values[offsets[i] : offsets[i + 1]] for i in own]
        sizes = np.array([len(s) for s in sets])
        shared = common_counts(sets)
        union = sizes[:, None] + sizes[None, :] - shared
        linked = (LOWER * shared >= UPPER * union) & (union > 0)
        sides, names = side[own], ids[own]
        linked &= names[:, None] != names[None, :]
        if sides.any():
            linked &= sides[:, None] != sides[None, :]
        root = names.copy()
        while True:
            seen = np.where(linked, root[None, :], np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max)
            new = np.minimum(root, seen)
            if (new == root).all():
                break
            root = new
        for i in np.flatnonzero(linked.any(axis=1)):
            out[0].append(names[i])
            out[1].append(names[linked[i]])
            out[2].append(root[i])
    return pa.table(
        {
            "rep": pa.array(out[0], pa.int64()),
            "links": pa.array(out[1], pa.list_(pa.int64())),
            "root": pa.array(out[2], pa.int64()),
        }
    )


@settled("tasks-in-bins")
def _tasks(reps: DataFrame) -> DataFrame:
    """(rep, task, side, bin): which classes are compared with which.

    A class is in as many tasks as its buckets name pairs of blocks, so bins are sized by all rows of the
    tasks: a large task is a bin of its own, small ones share bins.
    """
    bands = reps.select("rep", F.explode("bands").alias("bucket"))
    leads = bands.groupBy("bucket").agg(F.min("rep").alias("lead"), F.count("*").alias("n"))
    members = materialise(bands.join(leads.filter("n > 1").drop("n"), "bucket"), "members")

    homes = members.groupBy("rep").agg(F.min("lead").alias("home")).join(reps.select("rep", "n_ngrams"), "rep")
    homes = materialise(homes, "homes")
    # The home of the home: one family has few homes, so few pairs of blocks.
    further = homes.select(F.col("rep").alias("home"), F.col("home").alias("further"))
    homes = materialise(homes.join(further, "home").select("rep", "n_ngrams", F.col("further").alias("home")), "merged-homes")
    parts = homes.groupBy("home").agg(
        F.ceil(F.greatest(F.count("*") / BLOCK_DOCS, F.sum("n_ngrams") / BLOCK_NGRAMS)).alias("parts")
    )
    block = F.xxhash64("home", F.pmod(F.xxhash64("rep"), F.col("parts")))
    placed = materialise(homes.join(parts, "home").select("rep", "n_ngrams", block.alias("block")), "blocks")

    within = placed.select("rep", F.col("block").alias("task"), F.lit(0).alias("side"), "n_ngrams")
    at = members.select("bucket", "rep").join(placed, "rep")
    named = at.select("bucket", "block").distinct()
    several = named.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket")
    named = named.join(several, "bucket").withColumnRenamed("block", "other")
    across = (
        at.join(named, "bucket")
        .filter(F.col("block") != F.col("other"))
        .select(
            "rep",
            F.xxhash64(F.least("block", "other"), F.greatest("block", "other")).alias("task"),
            F.when(F.col("block") < F.col("other"), 1).otherwise(2).alias("side"),
            "n_ngrams",
        )
        .groupBy("rep", "task", "side")
        .agg(F.max("n_ngrams").alias("n_ngrams"))
    )
    tasks = materialise(within.unionByName(across), "tasks")
    sizes = tasks.groupBy("task").agg(F.sum("n_ngrams").alias("size"))
    small = F.col("size") < BLOCK_NGRAMS // 4
    bins = 1 + (sizes.filter(small).agg(F.sum("size")).first()[0] or 0) // BLOCK_NGRAMS
    shared = F.when(small, F.pmod(F.xxhash64("task"), F.lit(bins))).otherwise(F.col("task"))
    return tasks.join(sizes.select("task", shared.alias("bin")), "task").select("rep", "task", "side", "bin")


@settled("links")
def _links(base: DataFrame, signed: DataFrame, classes: DataFrame) -> DataFrame:
    """(rep, links, root) of each class in a task that has links there, found on whole n-gram sets."""
    reps = signed.join(classes.withColumnRenamed("rep", "doc_id"), ["digest", "doc_id"]).select(
        F.col("doc_id").alias("rep"), "n_ngrams", "bands"
    )
    tasks = _tasks(materialise(reps.dropDuplicates(["rep", "bands"]), "representatives"))
    texts = base.filter(F.col("text").isNotNull()).withColumnRenamed("doc_id", "rep")
    wanted = tasks.select("rep").distinct()
    if wanted.count() <= BROADCAST_IDS:
        # Texts of classes without a candidate stay where they are; beyond the bound the join moves them.
        texts = texts.join(F.broadcast(wanted), "rep", "left_semi")
    full = texts.join(tasks, "rep").withColumn("ngrams", bind(normalised(F.col("text")), lambda w: ngrams(w)))
    return (
        full.select("bin", "task", "side", "rep", "ngrams")
        .groupBy("bin")
        .applyInArrow(_verify, "rep bigint, links array<bigint>, root bigint")
    )


def similar(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, copy_id, class_id, n_links, links): one row for each row of ``docs``.

    ``copy_id`` is the smallest id with the same words, ``links`` the ``copy_id`` of every other class
    with a similarity of 0.8 or more, ``class_id`` the smallest id reachable over copies and links.

    Texts without a word, null ones included, and rows with a null id are classes of their own without
    links (``class_id`` is their id). Texts with fewer words than an n-gram are one n-gram. Rows that
    repeat an id come out once each; if their texts differ, the id stands for either. Other columns are
    not looked at. Ids are whole numbers.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    hashes = band_hashes(bands_for(UPPER / LOWER))

    def described(w: Column) -> Column:
        joined = F.array_join(w, " ")
        return F.struct(F.when(F.size(w) > 0, F.md5(joined)).alias("digest"), ngrams(w).alias("ngrams"))

    signed = base.withColumn("d", bind(normalised(F.col("text")), described)).select(
        "doc_id",
        F.when(F.col("doc_id").isNotNull(), F.col("d.digest")).alias("digest"),
        F.size("d.ngrams").alias("n_ngrams"),
        hashes("d.ngrams").alias("bands"),
    )
    signed = materialise(signed, "signed")
    with_words = signed.filter(F.col("digest").isNotNull())
    classes = with_words.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    classes = materialise(classes, "classes")
    found = _links(base, signed, classes)
    links = found.groupBy("rep").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("links")))).alias("links"))
    roots = components(found.select(F.col("rep").alias("u"), F.col("root").alias("v")))

    of_class = classes.join(links, "rep", "left").join(
        roots.select(F.col("u").alias("rep"), F.col("v").alias("root")), "rep", "left"
    )
    return signed.select("doc_id", "digest").join(of_class, "digest", "left").select(
        "doc_id",
        F.coalesce("rep", "doc_id").alias("copy_id"),
        F.coalesce("root", "rep", "doc_id").alias("class_id"),
        F.coalesce(F.size("links"), F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("links", F.array().cast("array<bigint>")).alias("links"),
    )


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each class, the one with the smallest id; columns unchanged.

    Rows without a word or without an id stay. Rows that repeat an id are one document and stay or go
    together.
    """
    found = similar(docs, text, doc_id)
    gone = found.filter(F.col("doc_id") != F.col("class_id")).select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs[doc_id] == gone["__gone"], "left_anti")


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document."""
    return similar(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "copy_id", "n_links")


#: Every pair that shares an n-gram, compared; no sketches.
OP8_SQL = f"""
WITH RECURSIVE b AS (
  SELECT doc_id, ws, array_to_string(ws, ' ') AS body
  FROM (SELECT doc_id, regexp_extract_all(lower(text), '{NOT_SPACE}+') AS ws FROM documents WHERE doc_id IS NOT NULL)
  WHERE len(ws) > 0
),
k AS (SELECT body, min(doc_id) AS rep, any_value(ws) AS ws FROM b GROUP BY body),
g AS MATERIALIZED (
  SELECT DISTINCT rep, array_to_string(ws[i:i + {WIDTH - 1}], ' ') AS gram
  FROM (SELECT rep, ws, unnest(range(1, greatest(len(ws) - {WIDTH - 1}, 1) + 1)) AS i FROM k)
),
z AS MATERIALIZED (SELECT rep, count(*) AS n FROM g GROUP BY rep),
c AS (SELECT x.rep AS a, y.rep AS b, count(*) AS m FROM g x JOIN g y USING (gram) WHERE x.rep <> y.rep GROUP BY ALL),
e AS MATERIALIZED (
  SELECT a, c.b FROM c JOIN z p ON p.rep = a JOIN z q ON q.rep = c.b WHERE {LOWER} * m >= {UPPER} * (p.n + q.n - m)
),
r AS (SELECT rep, rep AS root FROM z UNION SELECT r.rep, e.b FROM r JOIN e ON e.a = r.root),
u AS (SELECT rep, min(root) AS class_id FROM r GROUP BY rep),
n AS (SELECT a AS rep, count(*) AS n_links FROM e GROUP BY a)
SELECT doc_id, coalesce(class_id, doc_id) AS class_id, coalesce(rep, doc_id) AS copy_id, coalesce(n_links, 0) AS n_links
FROM documents LEFT JOIN (SELECT DISTINCT doc_id, body FROM b) USING (doc_id) LEFT JOIN k USING (body)
LEFT JOIN u USING (rep) LEFT JOIN n USING (rep)
"""

QUERIES = {"op8_ngram_jaccard": op8_ngram_jaccard}
SQL = {"op8_ngram_jaccard": OP8_SQL}
