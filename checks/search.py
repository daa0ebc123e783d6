"""Embedding, vector arithmetic, nearest neighbours, index and sampling."""

from __future__ import annotations

import io
import json
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import Catalogue, table
from checks.texts import refused, sql_clean, sql_line
from glyphvec.functions.text import clean_text, single_line
from glyphvec.functions.vectors import l2_normalize as unit_length
from glyphvec.functions.vectors import score, zero_vector
from glyphvec.operators.embed import HashingProvider, RetryingProvider, embed, embed_once
from glyphvec.operators.ivf import build_index, query_index
from glyphvec.operators.knn import knn_join, query_bytes
from glyphvec.operators.lookup import attach_metadata, checked_ids, vector_at, vectors_at
from glyphvec.operators.ordinals import file_directory, number_parquet_rows, row_at
from glyphvec.operators.sampling import report_lines
from glyphvec.plans.embedding import embed_texts, run_metrics
from glyphvec.plans.search import sample_index, sample_neighbours, search_index
from glyphvec.session import widen, work_path, write_bytes
from glyphvec.sinks.tables import write_embeddings, write_partitioned, write_results, write_text_table
from glyphvec.sources.vectors import parse_vectors, query_vector, read_index_metadata, read_manifest

C = Catalogue()
QUERIES, SQL = C.queries, C.sql

DIM = 64
URL_PREFIX = "https://x.org/v"


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors with ordinal, id and title."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("index_id"),
        F.concat(F.lit("v"), "vec_id").alias("video_id"),
        F.concat(F.lit("label "), "label").alias("video_title"),
        "embedding",
    )


def exploded(df: DataFrame, key: str) -> DataFrame:
    """(key, pos, value) with values that compare across engines."""
    return df.select(key, F.posexplode("embedding").alias("pos", "value")).select(
        key, "pos", (F.round(F.col("value").cast("double"), 6) + 0.0).alias("value")
    )


def spread(vector):
    """One number to which every value adds with a weight of its own."""
    weighted = F.transform(vector, lambda x, i: x.cast("double") * (i + 1))
    return F.round(F.aggregate(weighted, F.lit(0.0), lambda a, x: a + x), 3) + 0.0


E = "(SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings)"
SCORES = {
    "cosine": "list_dot_product(q.v, e.v) / (sqrt(list_dot_product(q.v, q.v)) * sqrt(list_dot_product(e.v, e.v)))",
    "l2": "-list_sum(list_transform(list_zip(q.v, e.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))",
    "ip": "list_dot_product(q.v, e.v) - 1",
}


def rounded(found: DataFrame, decimals: int = 6) -> DataFrame:
    """Scores that print alike in both engines; ranks are by the scores as they are."""
    return found.withColumn("score", F.round("score", decimals) + 0.0)


def sql_knn(metric: str, k: int, without_self: bool = False, queries: str = E, corpus: str = E, decimals: int = 6) -> str:
    skip = "WHERE q.vec_id <> e.vec_id" if without_self else ""
    ranked = SCORES[metric].removesuffix(" - 1")
    shown = "score - 1" if metric == "ip" else "score"
    return f"""SELECT query_id, CAST(rank AS INTEGER) AS rank, index_id, round({shown}, {decimals}) + 0.0 AS score FROM (
        SELECT query_id, index_id, score,
               row_number() OVER (PARTITION BY query_id ORDER BY score DESC, index_id) AS rank
        FROM (SELECT q.vec_id AS query_id, e.vec_id AS index_id, {ranked} AS score
              FROM {queries} q, {corpus} e {skip})) WHERE rank <= {k}"""


def knn_of(metric: str):
    def run(spark, sf_dir):
        rows = vectors(spark, sf_dir)
        return rounded(knn_join(rows, rows, 10, metric, query_id="index_id"))

    return run


for _metric in SCORES:
    C.add(sql_knn(_metric, 10), f"knn_{_metric}")(knn_of(_metric))


@C.add(sql_knn("cosine", 10, without_self=True))
def knn_no_self(spark, sf_dir):
    rows = vectors(spark, sf_dir)
    return rounded(knn_join(rows, rows, 10, query_id="index_id", self_col="index_id"))


@C.add(sql_knn("l2", 10, without_self=True))
def knn_blocks(spark, sf_dir):
    # Query sets beyond the broadcast bound: here the bound is a third of this one.
    rows = vectors(spark, sf_dir)
    bound = rows.count() * query_bytes(DIM, 10) // 3
    return rounded(
        knn_join(rows, rows, 10, "l2", query_id="index_id", self_col="index_id", broadcast_bytes=bound)
    )


SMALL = "(SELECT vec_id, list_transform(embedding, lambda x: CAST(x::DOUBLE * 1e-4::DOUBLE AS FLOAT)::DOUBLE) AS v FROM embeddings)"


@C.add(sql_knn("l2", 10, queries=SMALL, corpus=SMALL, decimals=14))
def knn_l2_small(spark, sf_dir):
    """Distances far below the sixth decimal still rank."""
    rows = vectors(spark, sf_dir).withColumn(
        "embedding", F.transform("embedding", lambda x: (x.cast("double") * F.lit(1e-4)).cast("float"))
    )
    return rounded(knn_join(rows, rows, 10, "l2", query_id="index_id"), 14)


@C.add(
    f"""SELECT k.*, 'v' || e.vec_id AS video_id, 'label ' || e.label AS video_title
        FROM ({sql_knn('cosine', 10, without_self=True)}) k JOIN embeddings e ON k.index_id = e.vec_id"""
)
def knn_with_metadata(spark, sf_dir):
    rows = vectors(spark, sf_dir)
    found = knn_join(rows, rows, 10, query_id="index_id", self_col="index_id")
    return attach_metadata(rounded(found), rows.drop("embedding"))


@C.add(f"SELECT k.*, '' AS video_id, '' AS video_title FROM ({sql_knn('cosine', 3)}) k")
def knn_without_metadata(spark, sf_dir):
    # Metadata columns that do not exist come back as empty text.
    rows = vectors(spark, sf_dir).select("index_id", "embedding")
    return attach_metadata(rounded(knn_join(rows, rows, 3, query_id="index_id")), rows)


SCALED = "list_transform(embedding::DOUBLE[], lambda x: x * (vec_id % 5))"


@C.add(
    f"""SELECT vec_id, CAST(pos - 1 AS INTEGER) AS pos,
        round(CASE WHEN n = 0 THEN 0.0 ELSE v[pos] / n END, 6) + 0.0 AS value
        FROM (SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS n, unnest(range(1, len(v) + 1)) AS pos
              FROM (SELECT vec_id, {SCALED} AS v FROM embeddings))"""
)
def l2_normalize(spark, sf_dir):
    scale = F.col("vec_id") % 5
    scaled = F.transform("embedding", lambda x: x.cast("double") * scale)
    df = table(spark, sf_dir, "embeddings").select("vec_id", unit_length(scaled).alias("embedding"))
    return exploded(df, "vec_id")


@C.add(
    f"""SELECT q.vec_id, round({SCORES['cosine']}, 6) + 0.0 AS cosine,
        round({SCORES['l2']}, 6) + 0.0 AS l2, round({SCORES['ip']}, 6) + 0.0 AS ip, 0.0::DOUBLE AS zero
        FROM {E} q JOIN {E} e ON e.vec_id = q.vec_id + 1"""
)
def pair_scores(spark, sf_dir):
    a = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("a"))
    b = a.select((F.col("vec_id") - 1).alias("vec_id"), F.col("a").alias("b"))
    scores = [
        (F.round(score(F.col("a"), F.col("b"), m), 6) + 0.0).alias(m) for m in ("cosine", "l2", "ip")
    ]
    zero = score(F.col("a"), zero_vector(DIM), "cosine").alias("zero")
    return a.join(b, "vec_id").select("vec_id", *scores, zero)


WORD = r"[\p{L}\p{N}]+"


def sql_hash_embed(source: str, key: str, text: str, dim: int = DIM) -> str:
    """(key, pos, value) of every position, unit length, unrounded."""
    return f"""(SELECT d.{key}, p.pos, CASE WHEN n.norm IS NULL THEN 0.0
                 ELSE coalesce(c.hits, 0) / n.norm END AS value
        FROM (SELECT {key} FROM {source}) d CROSS JOIN (SELECT unnest(range({dim})) AS pos) p
        LEFT JOIN (SELECT {key}, pos, count(*) AS hits FROM (
            SELECT {key}, CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % {dim} AS pos
            FROM (SELECT {key}, unnest(regexp_extract_all(lower({text}), '{WORD}')) AS w FROM {source}))
            GROUP BY {key}, pos) c ON c.{key} = d.{key} AND c.pos = p.pos
        LEFT JOIN (SELECT {key}, sqrt(sum(hits * hits)) AS norm FROM (
            SELECT {key}, pos, count(*) AS hits FROM (
            SELECT {key}, CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % {dim} AS pos
            FROM (SELECT {key}, unnest(regexp_extract_all(lower({text}), '{WORD}')) AS w FROM {source}))
            GROUP BY {key}, pos) GROUP BY {key}) n ON n.{key} = d.{key})"""


@C.add(
    f"""SELECT doc_id, CAST(pos AS INTEGER) AS pos, round(CAST(value AS FLOAT)::DOUBLE, 6) + 0.0 AS value
        FROM {sql_hash_embed('documents', 'doc_id', sql_clean('text'))}"""
)
def hash_embed(spark, sf_dir):
    docs = widen(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return exploded(embed(docs, HashingProvider, text_col="text", rules={}), "doc_id")


def sql_word_counts(source: str, key: str) -> str:
    """(key, pos, hits, norm): word counts by position, and the length of the row's vector."""
    return f"""(SELECT *, sqrt(sum(hits * hits) OVER (PARTITION BY {key})) AS norm FROM (
            SELECT {key}, CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % {DIM} AS pos, CAST(count(*) AS DOUBLE) AS hits
            FROM (SELECT {key}, unnest(regexp_extract_all(lower(text), '{WORD}')) AS w FROM {source}) GROUP BY ALL))"""


@C.add(
    f"""SELECT query_id, CAST(rank AS INTEGER) AS rank, index_id, round(score, 6) + 0.0 AS score FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, index_id) AS rank FROM (
        SELECT q.item_id AS query_id, d.doc_id AS index_id,
               sum(q.hits * d.hits) / (any_value(q.norm) * any_value(d.norm)) AS score
        FROM {sql_word_counts('benchmark', 'item_id')} q JOIN {sql_word_counts('documents', 'doc_id')} d ON q.pos = d.pos
        GROUP BY q.item_id, d.doc_id)) WHERE rank <= 5"""
)
def search_documents(spark, sf_dir):
    """The five documents nearest to each benchmark passage."""
    # Unnormalised counts are exact in single precision; the cosine score normalises in double.
    docs = widen(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("index_id"), "text"))
    asked = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    corpus = embed(docs, HashingProvider, text_col="text", normalize=False)
    queries = embed(asked, HashingProvider, text_col="text", normalize=False)
    return rounded(knn_join(queries, corpus, 5))


@dataclass
class LengthProvider:
    """A stand-in for a remote client: the text's length plus the position."""

    dim: int = 4

    def encode(self, texts: list[str]) -> np.ndarray:
        lengths = np.array([len(t) for t in texts], dtype=np.float64)
        return lengths[:, None] + np.arange(self.dim)


CLIENT_SQL = """SELECT doc_id, CAST(pos AS INTEGER) AS pos, round(CAST((length(text) + pos) / sqrt(list_sum(
        list_transform(range(4), lambda i: (length(text) + i) * (length(text) + i)))) AS FLOAT)::DOUBLE, 6) + 0.0 AS value
    FROM documents, (SELECT unnest(range(4)) AS pos)"""


@C.add(CLIENT_SQL)
def client_embed(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exploded(embed(docs, LengthProvider, text_col="text", batch_size=16), "doc_id")


class Busy(Exception):
    """A remote side that has no time."""


class FlakyProvider(LengthProvider):
    """Fails before every call that it answers."""

    failed = True

    def encode(self, texts: list[str]) -> np.ndarray:
        FlakyProvider.failed = not FlakyProvider.failed
        if not FlakyProvider.failed:
            raise Busy("later")
        return super().encode(texts)


class ClosedProvider(LengthProvider):
    def encode(self, texts: list[str]) -> np.ndarray:
        raise Busy("the provider is closed")


def no_wait(seconds: float) -> None:
    pass


def retrying(provider):
    return lambda: RetryingProvider(provider(), (Busy,), max_retries=2, sleep=no_wait)


@C.add(f"SELECT *, TRUE AS gives_up FROM ({CLIENT_SQL})")
def retried_calls(spark, sf_dir):
    """Every call of the provider fails once; one that always fails ends the job."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    closed = embed(docs.limit(1), retrying(ClosedProvider), text_col="text")
    gives_up = refused(lambda: closed.collect(), "the provider is closed")
    found = embed(docs, retrying(FlakyProvider), text_col="text", batch_size=16)
    return exploded(found, "doc_id").withColumn("gives_up", F.lit(gives_up))


REPEATED = "concat(lang, ':', CAST(doc_id % 50 AS VARCHAR))"


@C.add(CLIENT_SQL.replace("FROM documents", f"FROM (SELECT doc_id, {REPEATED} AS text FROM documents)"))
def client_embed_once(spark, sf_dir):
    """Texts that many rows share are encoded once, at most three calls at a time."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.expr(REPEATED.replace("VARCHAR", "STRING")).alias("text"))
    return exploded(embed_once(docs, LengthProvider, text_col="text", batch_size=16, max_calls=3), "doc_id")


@C.add(
    """SELECT unnest(['an ordinal beyond the table', 'an ordinal in a list', 'the last ordinal']) AS ordinal,
       count(*) AS n_rows, unnest([TRUE, TRUE, FALSE]) AS refused FROM embeddings"""
)
def range_check(spark, sf_dir):
    rows = vectors(spark, sf_dir)
    n = rows.count()
    stray = rows.select("index_id").union(spark.range(n, n + 1).select(F.col("id")))
    found = {
        "an ordinal beyond the table": refused(lambda: vector_at(rows, n), f"index_id out of range: {n}"),
        "an ordinal in a list": refused(lambda: checked_ids(stray, rows), f"index_id out of range: {n}"),
        "the last ordinal": refused(lambda: vector_at(rows, n - 1), "out of range"),
    }
    parts = [
        rows.agg(F.lit(name).alias("ordinal"), F.count(F.lit(1)).alias("n_rows"), F.lit(flag).alias("refused"))
        for name, flag in found.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@C.add("SELECT count(*) AS n_written, TRUE AS mismatch_refused, count(*) AS n_indexed, count(*) AS n_described FROM embeddings")
def row_reconciliation(spark, sf_dir):
    """Rows are counted where they are written and compared with what was read."""
    rows = vectors(spark, sf_dir)
    n = rows.count()
    written = write_embeddings(rows, work_path(spark, "counted"), dim=DIM, total_rows=n)
    short = refused(
        lambda: write_embeddings(rows, work_path(spark, "short"), dim=DIM, total_rows=n + 1),
        f"row count mismatch: expected {n + 1}, wrote {n}",
    )
    index = indexed(spark, sf_dir, "l2")
    stored = spark.read.parquet(f"{index}/vectors").agg(F.count(F.lit(1)).alias("n_indexed"))
    described = spark.read.parquet(f"{index}/metadata").agg(F.count(F.lit(1)).alias("n_described"))
    flags = stored.select("*", F.lit(written).cast("long").alias("n_written"), F.lit(short).alias("mismatch_refused"))
    return flags.crossJoin(described)


@C.add(
    """SELECT unnest(['a null vector', 'a query of another length', 'a shorter vector', 'no fault']) AS fault,
       count(*) AS n_rows, unnest([TRUE, TRUE, TRUE, FALSE]) AS refused FROM embeddings"""
)
def dimension_check(spark, sf_dir):
    rows = vectors(spark, sf_dir)
    last = F.col("index_id") == rows.agg(F.max("index_id")).first()[0]

    def store(vector):
        return lambda: write_embeddings(rows.withColumn("embedding", vector), work_path(spark, "faulty"), dim=DIM)

    short = F.slice("embedding", 1, DIM - 1)
    found = {
        "a shorter vector": refused(store(F.when(last, short).otherwise(F.col("embedding"))), "expected 64, got 63"),
        "a null vector": refused(store(F.when(~last, F.col("embedding"))), "expected 64, got null"),
        "a query of another length": refused(
            lambda: knn_join(rows.withColumn("embedding", short), rows, 1, query_id="index_id").collect(),
            "embedding dimension mismatch",
        ),
        "no fault": refused(store(F.col("embedding")), "mismatch"),
    }
    parts = [
        rows.agg(F.lit(name).alias("fault"), F.count(F.lit(1)).alias("n_rows"), F.lit(flag).alias("refused"))
        for name, flag in found.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@C.add(
    """SELECT form, CAST(pos - 1 AS INTEGER) AS pos, round(embedding[pos]::DOUBLE, 6) + 0.0 AS value
       FROM (SELECT embedding, unnest(range(1, 65)) AS pos FROM embeddings WHERE vec_id = 7),
            (SELECT unnest(['file.json', 'file.npy', 'literal', 'table', 'table without ids']) AS form)"""
)
def query_vector_forms(spark, sf_dir):
    """One vector of the table, handed over in every form that a query may take."""
    rows = vectors(spark, sf_dir)
    values = np.array(vector_at(rows, 7).head()["embedding"], np.float32)
    literal, raw = json.dumps(values.astype(float).tolist()), io.BytesIO()
    np.save(raw, values)
    plain, bare = work_path(spark, "with-ids"), work_path(spark, "without-ids")
    rows.write.parquet(plain)
    rows.repartitionByRange(3, "index_id").sortWithinPartitions("index_id").select("embedding").write.parquet(bare)
    forms = {
        "literal": {"literal": literal},
        "file.json": {"file": write_bytes(spark, work_path(spark, "query") + ".json", literal.encode())},
        "file.npy": {"file": write_bytes(spark, work_path(spark, "query") + ".npy", raw.getvalue())},
        "table": {"table": plain, "index_id": 7},
        "table without ids": {"table": bare, "index_id": 7},
    }
    parts = [query_vector(spark, **given).select(F.lit(form).alias("form"), "embedding") for form, given in forms.items()]
    return exploded(reduce(DataFrame.unionByName, parts), "form")


@C.add("SELECT vec_id AS index_id, CAST(pos - 1 AS INTEGER) AS pos, round(embedding[pos]::DOUBLE, 6) + 0.0 AS value, 1 AS n_files FROM (SELECT vec_id, embedding, unnest(range(1, 65)) AS pos FROM embeddings WHERE vec_id IN (0, 7, (SELECT max(vec_id) FROM embeddings)))")
def ordinal_lookup(spark, sf_dir):
    """Rows of a table without ids, by a directory of its files; each lookup reads one file."""
    path = work_path(spark, "several-files")
    rows = vectors(spark, sf_dir).repartitionByRange(4, "index_id").sortWithinPartitions("index_id")
    rows.select("embedding").write.parquet(path)
    directory = file_directory(spark, path)
    found = [row_at(spark, path, i, directory) for i in (0, 7, rows.count() - 1)]
    parts = [exploded(df, "index_id").withColumn("n_files", F.lit(len(df.inputFiles()))) for df in found]
    return reduce(DataFrame.unionByName, parts)


@C.add("SELECT vec_id, CAST(pos - 1 AS INTEGER) AS pos, round(embedding[pos]::DOUBLE, 6) + 0.0 AS value FROM (SELECT vec_id, embedding, unnest(range(1, 65)) AS pos FROM embeddings WHERE vec_id = 7)")
def point_lookup(spark, sf_dir):
    return exploded(vector_at(vectors(spark, sf_dir), 7).withColumnRenamed("index_id", "vec_id"), "vec_id")


@C.add("SELECT vec_id AS index_id, CAST(pos - 1 AS INTEGER) AS pos, round(embedding[pos]::DOUBLE, 6) + 0.0 AS value FROM (SELECT vec_id, embedding, unnest(range(1, 65)) AS pos FROM embeddings WHERE vec_id IN (SELECT doc_id FROM labels))")
def batch_lookup(spark, sf_dir):
    rows = vectors(spark, sf_dir)
    wanted = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("index_id"))
    known = wanted.join(rows, "index_id", "left_semi")
    return exploded(vectors_at(rows, checked_ids(known, rows), DIM), "index_id")


def sql_sample(n: int, k: int, seed: int, include_self: bool = False) -> str:
    return f"""WITH drawn AS (
        SELECT vec_id, row_number() OVER (ORDER BY md5('{seed}:' || vec_id), vec_id) AS draw
        FROM embeddings QUALIFY draw <= {n}),
        found AS ({sql_knn('cosine', k, not include_self, f"(SELECT * FROM {E} WHERE vec_id IN (SELECT vec_id FROM drawn))")})
        SELECT CAST(d.draw AS INTEGER) AS draw, f.query_id AS query_index_id, 'v' || q.vec_id AS query_video_id,
               'label ' || q.label AS query_video_title, f.rank, f.index_id, f.score,
               'v' || e.vec_id AS video_id, 'label ' || e.label AS video_title
        FROM found f JOIN drawn d ON d.vec_id = f.query_id JOIN embeddings q ON q.vec_id = f.query_id
        JOIN embeddings e ON e.vec_id = f.index_id"""


@C.add(sql_sample(5, 10, 0))
def sample_neighbors(spark, sf_dir):
    rows = vectors(spark, sf_dir)
    return rounded(sample_neighbours(rows, rows.drop("embedding"), n=5, k=10, seed=0))


def sql_report(mode: str, sample: str) -> str:
    if mode == "video":
        head = f"'Query: ' || query_video_id || '  {URL_PREFIX}/' || query_video_id || '.mp4' || chr(10) || '  Title: ' || query_video_title"
        line = f"video_id || '  {URL_PREFIX}/' || video_id || '.mp4  score=' || printf('%.6f', score) || chr(10) || '      ' || video_title"
    else:
        head = "'Query: ' || query_video_id || '  (' || query_video_title || ')'"
        line = "video_id || '  (' || video_title || ')  score=' || printf('%.6f', score)"
    return f"""WITH r AS ({sample})
        SELECT draw, 0 AS line_no, {head} AS line FROM r WHERE rank = 1
        UNION ALL SELECT draw, rank, '  ' || lpad(CAST(rank AS VARCHAR), 2, '0') || '. ' || {line} FROM r"""


@C.add(sql_report("video", sql_sample(5, 10, 3, include_self=True)))
def neighbor_report_video(spark, sf_dir):
    rows = vectors(spark, sf_dir)
    found = sample_neighbours(rows, rows.drop("embedding"), n=5, k=10, seed=3, include_self=True)
    return report_lines(found, "video", URL_PREFIX)


@C.add(sql_report("text", sql_sample(5, 10, 0)))
def neighbor_report_text(spark, sf_dir):
    # Over a written index, all clusters probed.
    index = indexed(spark, sf_dir, "cosine")
    return sample_index(spark, index, mode="text", n=5, k=10, seed=0, nprobe=10**6)


def indexed(spark: SparkSession, sf_dir: str, metric: str) -> str:
    index = work_path(spark, "index")
    build_index(spark, vectors(spark, sf_dir), index, metric=metric)
    return index


@C.add(sql_knn("l2", 10))
def ivf_knn_full_probe(spark, sf_dir):
    index = indexed(spark, sf_dir, "l2")
    return rounded(query_index(spark, index, vectors(spark, sf_dir), 10, query_id="index_id", nprobe=10**6))


@C.add(sql_knn("cosine", 10, without_self=True))
def ivf_knn_blocks(spark, sf_dir):
    index = indexed(spark, sf_dir, "cosine")
    rows = vectors(spark, sf_dir)
    found = query_index(
        spark,
        index,
        rows,
        10,
        query_id="index_id",
        self_col="index_id",
        nprobe=10**6,
        broadcast_bytes=rows.count() * query_bytes(DIM, 10) // 2,
    )
    return rounded(found)


TREE = {"nlist": 64, "max_centres": 16}


@C.add(sql_knn("l2", 10))
def ivf_tree_full_probe(spark, sf_dir):
    """More clusters than one table of centres may hold; all probed, in tiles."""
    index = work_path(spark, "tree")
    rows = vectors(spark, sf_dir)
    build_index(spark, rows, index, metric="l2", nprobe=64, **TREE)
    bound = rows.count() * query_bytes(DIM, 10) // 2
    return rounded(
        query_index(spark, index, rows, 10, query_id="index_id", nprobe=10**6, broadcast_bytes=bound)
    )


@C.add(
    """SELECT count(*) AS n_rows, count(*) AS n_indexed, TRUE AS beyond_one_level, TRUE AS every_cluster_below_its_top,
       TRUE AS enough FROM embeddings"""
)
def ivf_tree_recall(spark, sf_dir):
    """Two levels of centres with default probing: rows kept, and at least 93 of 100 neighbours found by
    the rows that measure."""
    index = work_path(spark, "tree")
    manifest = build_index(spark, vectors(spark, sf_dir), index, metric="cosine", **TREE)
    leaves = spark.read.parquet(f"{index}/centroids")
    stored = spark.read.parquet(f"{index}/vectors").select("index_id", "cluster_id", "top")
    placed = stored.join(leaves.select("cluster_id", F.col("top").alias("own_top")), "cluster_id", "left")
    sums = leaves.agg(F.sum("n_rows").alias("n_indexed"), (F.count("*") > TREE["max_centres"]).alias("beyond_one_level"))
    kept = placed.agg(
        F.count("index_id").alias("n_rows"),
        F.bool_and(F.coalesce(F.col("top") == F.col("own_top"), F.lit(False))).alias("every_cluster_below_its_top"),
    )
    return kept.crossJoin(sums).withColumn("enough", F.lit(float(manifest["recall"]) >= 0.93))


@C.add("SELECT unnest(['cosine', 'ip', 'l2']) AS metric, count(*) AS n_queries, TRUE AS enough FROM embeddings")
def ivf_recall(spark, sf_dir):
    """Default probing aims at 95 of 100 true neighbours, as some hundred rows tell; over all rows at
    least 93 of 100 are found, by every metric."""
    rows = vectors(spark, sf_dir)
    parts = []
    for metric in sorted(SCORES):
        asked = {"query_id": "index_id", "self_col": "index_id"}
        found = query_index(spark, indexed(spark, sf_dir, metric), rows, 10, **asked)
        exact = knn_join(rows, rows, 10, metric, **asked)
        hits = exact.join(found.select("query_id", "index_id", F.lit(1).alias("hit")), ["query_id", "index_id"], "left")
        parts.append(
            hits.agg(
                F.lit(metric).alias("metric"),
                F.count_distinct("query_id").alias("n_queries"),
                (F.avg(F.coalesce("hit", F.lit(0))) >= 0.93).alias("enough"),
            )
        )
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@C.add("SELECT vec_id AS query_id, 10 AS n_found, 1 AS found_self FROM embeddings")
def ivf_knn(spark, sf_dir):
    """Default probing: approximate, so the check is on completeness and on finding oneself."""
    index = indexed(spark, sf_dir, "cosine")
    found = search_index(spark, index, vectors(spark, sf_dir), 10, query_id="index_id")
    own = (F.col("query_id") == F.col("index_id")) & (F.col("rank") == 1) & (
        F.col("video_id") == F.concat(F.lit("v"), "query_id")
    )
    return found.groupBy("query_id").agg(
        F.count(F.lit(1)).cast("int").alias("n_found"), F.count_if(own).cast("int").alias("found_self")
    )


@C.add("SELECT vec_id AS index_id, 'v' || vec_id AS video_id, 'label ' || label AS video_title FROM embeddings")
def index_metadata(spark, sf_dir):
    return read_index_metadata(spark, indexed(spark, sf_dir, "cosine"))


@C.add(
    """SELECT 'ip' AS space, 64 AS dimensions, count(*) AS n_rows, CAST(round(sqrt(count(*))) AS INTEGER) AS nlist,
       0 AS seed, 'embedding' AS embedding_col, TRUE AS accurate, 'vectors' AS index_file FROM embeddings"""
)
def index_manifest(spark, sf_dir):
    """``accurate``: rows that did not choose the number of probes find all but five in a hundred of the
    share that was aimed at."""
    manifest = read_manifest(spark, indexed(spark, sf_dir, "ip"))
    numbers = [int(manifest[key]) for key in ("dimensions", "count", "nlist", "seed")]
    accurate = float(manifest["recall"]) >= float(manifest["recall_target"]) - 0.05
    row = (manifest["space"], *numbers, manifest["embedding_col"], accurate, manifest["index_file"])
    schema = "space STRING, dimensions INT, n_rows BIGINT, nlist INT, seed INT, embedding_col STRING, accurate BOOLEAN"
    return spark.createDataFrame([row], f"{schema}, index_file STRING")


@C.add("SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS index_id FROM embeddings")
def parquet_ordinals(spark, sf_dir):
    path = work_path(spark, "several-files")
    rows = table(spark, sf_dir, "embeddings").repartitionByRange(4, "vec_id")
    rows.sortWithinPartitions("vec_id").write.parquet(path)
    return number_parquet_rows(spark, path).select("vec_id", "index_id")


@C.add("SELECT vec_id, CAST(pos - 1 AS INTEGER) AS pos, round(embedding[pos]::DOUBLE, 6) + 0.0 AS value FROM (SELECT vec_id, embedding, unnest(range(1, 65)) AS pos FROM embeddings)")
def vector_export(spark, sf_dir):
    # Vectors only; their order in the files gives the ordinal back.
    path = work_path(spark, "vectors")
    write_embeddings(vectors(spark, sf_dir).orderBy("video_id"), path, dim=DIM, fmt="vectors")
    rows = number_parquet_rows(spark, path)
    return exploded(rows.withColumnRenamed("index_id", "vec_id"), "vec_id")


ALL_VALUES = "SELECT vec_id, CAST(pos - 1 AS INTEGER) AS pos, round(embedding[pos]::DOUBLE, 6) + 0.0 AS value FROM (SELECT vec_id, embedding, unnest(range(1, 65)) AS pos FROM embeddings)"


@C.add(ALL_VALUES)
def json_query_vectors(spark, sf_dir):
    literal = F.to_json("embedding").alias("literal")
    rows = parse_vectors(table(spark, sf_dir, "embeddings").select("vec_id", literal), "literal")
    return exploded(rows, "vec_id")


@C.add(sql_knn("ip", 5))
def json_results(spark, sf_dir):
    rows = vectors(spark, sf_dir)
    path = work_path(spark, "results")
    write_results(rounded(knn_join(rows, rows, 5, "ip", query_id="index_id")), path)
    return spark.read.schema("query_id BIGINT, rank INT, index_id BIGINT, score DOUBLE").json(path)


@C.add(
    f"""SELECT CAST(doc_id AS VARCHAR) AS video_id, {sql_clean(sql_line('text'))} AS video_title,
        64 AS dim, CAST(length({sql_clean('text')}) > 0 AS INTEGER) AS norm, spread FROM documents
        JOIN (SELECT doc_id, round(sum(CAST(value AS FLOAT)::DOUBLE * (pos + 1)), 3) + 0.0 AS spread
              FROM {sql_hash_embed('documents', 'doc_id', sql_clean(sql_line('text')))} GROUP BY doc_id) USING (doc_id)"""
)
def embedded_table(spark, sf_dir):
    """Texts from a TSV through cleaning and embedding into Parquet, and back."""
    source, output = work_path(spark, "texts"), work_path(spark, "embeddings")
    docs = widen(table(spark, sf_dir, "documents").select("doc_id", "text"))
    lines = docs.select("doc_id", single_line(F.col("text")).alias("text"))
    write_text_table(lines.toDF("video_id", "video_title"), source)
    embed_texts(
        spark, source, output, HashingProvider, rules={}, sep="\t", header=False, quote="", tabular=True
    )
    length = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x))
    return spark.read.parquet(output).select(
        "video_id",
        "video_title",
        F.size("embedding").alias("dim"),
        F.round(length, 3).cast("int").alias("norm"),
        spread(F.col("embedding")).alias("spread"),
    )


@C.add("SELECT count(*) AS rows, CAST(64 AS BIGINT) AS dim FROM conversations")
def embedding_metrics(spark, sf_dir):
    path = work_path(spark, "embeddings")
    turns = table(spark, sf_dir, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("video_id"), F.col("text").alias("video_title")
    )
    write_embeddings(embed(turns, HashingProvider), path, dim=DIM)
    return run_metrics(spark, path)


@C.add(
    """SELECT 'model-x' AS model, 'vectors.v1' AS dataset, vec_id AS index_id, label,
       round(list_sum(embedding::DOUBLE[]), 6) + 0.0 AS total FROM embeddings"""
)
def artifact_layout(spark, sf_dir):
    root = work_path(spark, "artifacts")
    rows = table(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "index_id")
    for _ in range(2):  # a rerun replaces its own rows
        write_partitioned(rows, root, "embeddings", "acme/model-x", " vectors.v1/")
    write_partitioned(rows, root, "embeddings", "acme/other", "vectors.v1")
    kept = spark.read.parquet(f"{root}/embeddings").filter(F.col("model") == "model-x")
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x)
    return kept.select("model", "dataset", "index_id", "label", (F.round(total, 6) + 0.0).alias("total"))


@C.add(
    f"""SELECT turn_id, length({sql_clean("text")}) > 0 AS has_text,
        {sql_clean("text")} AS text FROM (SELECT conv_id || '-' || turn AS turn_id, text FROM conversations)"""
)
def clean_conversations(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("turn_id"), clean_text(F.col("text")).alias("text")
    )
    return turns.withColumn("has_text", F.length("text") > 0)

