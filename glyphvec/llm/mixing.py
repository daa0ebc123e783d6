"""Mixing sources to target weights.

Every source gets a target of words: sources share a budget by weight, no target exceeds a multiple of
the source's own words, and what the limit takes from one source goes to the others by weight. The rate
of a source is its target by its words; every document is emitted floor(rate) times, and once more if a
draw from a hash of the document falls below the fraction.

A hash draws for each of sixteen seeds. Each source takes the seed whose draws bring its words nearest
its target, so that long documents and small sources do not pull it off.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphvec.llm.common import free_name, table, words
from glyphvec.operators.ordinals import assign_index_id
from glyphvec.session import materialise

#: Weights of the sources in their order, repeating; budget in parts of all words; most copies of a document.
WEIGHTS = (5, 2, 1)
BUDGET = (3, 2)
MOST = 2
#: A hash of 64 hex digits holds eight draws of 32 bits.
HASHES, DRAWS = 2, 8
SEEDS = HASHES * DRAWS


def _text(column: str) -> Column:
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def _measures(doc_id: str, text: str, source: str) -> dict[str, Column]:
    return {
        "source": F.col(f"`{source}`").cast("string"),
        "size": F.size(words(F.col(f"`{text}`"))).cast("bigint"),
        "key": F.md5(F.concat(_text(doc_id), F.lit(":"), F.md5(_text(text)))),
    }


def measure(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, source, size, key): words of each text and what its draws are made of; written once."""
    columns = [c.alias(name) for name, c in _measures(doc_id, text, source).items()]
    return materialise(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), *columns), "measured")


def _draws(key: Column) -> list[Column]:
    """For each seed a whole number below 2^32."""
    hashes = [F.sha2(F.concat(F.lit(f"{h}:"), key), 256) for h in range(HASHES)]
    return [F.conv(F.substring(hashes[k // DRAWS], k % DRAWS * 8 + 1, 8), 16, 10).cast("double") for k in range(SEEDS)]


def _copies(draw: Column, rate: Column) -> Column:
    """floor(rate), and one more if the draw falls below the fraction."""
    more = draw < (rate - F.floor(rate)) * F.lit(float(1 << 32))
    return F.floor(rate) + F.when(more, 1).otherwise(0)


def _rate() -> Column:
    return F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)


def targets(
    measured: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    budget: tuple[int, int] = BUDGET,
    most: int = MOST,
) -> DataFrame:
    """(source, source_size, target): one row per source, null among them.

    Sources take the weights in the order of their code points, null last. Targets above ``most`` times
    a source's words are held there and the excess is shared again, until none is above; each round is
    an aggregate over the sources that returns one row.
    """
    per_source = measured.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = assign_index_id(per_source, [F.col("source").isNull(), F.col("source")])
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("index_id") % len(weights) + 1).cast("int"))
    sources = materialise(placed.withColumn("weight", weight), "sources")
    part, whole = budget
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("source_size", "weight")]
    total, open_weight = map(int, sources.agg(*sums).first())
    held, above = 0, F.lit(False)
    while open_weight:
        rest = part * total - whole * most * held
        share = F.col("weight") * F.lit(Decimal(rest))
        limit = F.col("source_size").cast("decimal(19,0)") * F.lit(Decimal(whole * most * open_weight))
        above = share > limit
        now = sources.agg(
            F.coalesce(F.sum(F.when(above, F.col("source_size"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)),
        ).first()
        done = int(now[0]) == held
        held, open_weight = int(now[0]), int(now[1])
        if done:
            break
    full = (F.col("source_size") * most).cast("double")
    if not open_weight:
        return sources.select("source", "source_size", full.alias("target"))
    rest = part * total - whole * most * held
    shared = F.col("weight").cast("double") * F.lit(float(rest)) / F.lit(float(whole * open_weight))
    return sources.select("source", "source_size", F.when(above, full).otherwise(shared).alias("target"))


def rates(measured: DataFrame, **shares) -> DataFrame:
    """(source, source_size, target, rate, seed); ``shares`` as for ``targets``."""
    wanted = targets(measured, **shares).withColumn("rate", _rate())
    own = wanted.select(F.col("source").alias("own"), "rate")
    taken = [F.sum(F.col("size") * _copies(d, F.col("rate"))).alias(f"t{k}") for k, d in enumerate(_draws(F.col("key")))]
    drawn = measured.join(own, measured["source"].eqNullSafe(F.col("own"))).groupBy("source").agg(*taken)
    drawn = drawn.withColumnRenamed("source", "own")
    gaps = [F.struct(F.abs(F.col(f"t{k}") - F.col("target")).alias("gap"), F.lit(k).alias("seed")) for k in range(SEEDS)]
    seed = F.array_min(F.array(*gaps))["seed"]
    found = wanted.join(drawn, wanted["source"].eqNullSafe(F.col("own")))
    return materialise(found.select("source", "source_size", "target", "rate", seed.alias("seed")), "rates")


def _drawn(rows: DataFrame, key: Column, of_source: Column, rate: DataFrame) -> DataFrame:
    """``rows`` with the columns of their source's rate and ``copies``; names must be free."""
    draw = F.element_at(F.array(*_draws(key)), F.col("seed") + 1)
    copies = _copies(draw, F.col("rate")).cast("int")
    return rows.join(rate, of_source.eqNullSafe(F.col("own"))).withColumn("copies", copies)


def plan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **shares) -> DataFrame:
    """(doc_id, size, source_size, target, copies): how often each row of ``docs`` is taken.

    Null texts and texts without a word have size 0; rows of a source without a word are taken no time.
    A null source is a source of its own. Rows that repeat an id are drawn each; rows that agree in id
    and text are drawn alike, null ids are told apart by their texts. Other columns are not looked at.
    """
    measured = measure(docs, doc_id, text, source)
    rate = rates(measured, **shares).withColumnRenamed("source", "own")
    found = _drawn(measured, F.col("key"), F.col("source"), rate)
    return found.select("doc_id", "size", "source_size", "target", "copies")


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **shares) -> DataFrame:
    """The mixed documents: rows of ``docs`` with all their columns, each as often as ``plan`` says."""
    rate = rates(measure(docs, doc_id, text, source), **shares)
    rate = rate.select(*[F.col(c).alias(free_name(docs, f"mix_{c}")) for c in rate.columns])
    name = free_name(docs, "mix_own")
    own = _measures(doc_id, text, source)
    rows = docs.withColumn(name, F.struct(own["source"].alias("source"), own["key"].alias("key")))
    found = rows.join(rate, F.col(name)["source"].eqNullSafe(rate[0]))
    draw = F.element_at(F.array(*_draws(F.col(name)["key"])), rate[4] + 1)
    copies = _copies(draw, rate[3]).cast("int")
    repeats = F.when(copies > 0, F.sequence(F.lit(1), copies))
    return found.withColumn(name, F.explode(repeats)).select(*[F.col(f"`{c}`") for c in docs.columns])


def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes."""
    found = plan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


_DRAWS_SQL = ", ".join(
    f"CAST(('0x' || substr(sha256('{k // DRAWS}:' || key), {k % DRAWS * 8 + 1}, 8)) AS BIGINT)" for k in range(SEEDS)
)

OP13_SQL = f"""
WITH m AS MATERIALIZED (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS key
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS n,
         ([{", ".join(map(str, WEIGHTS))}])[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)}] AS w
  FROM m GROUP BY source
), o AS (
  SELECT *, row_number() OVER q AS k, sum(n) OVER () AS total,
         coalesce(sum(n) OVER (ORDER BY n / w, w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
         sum(w) OVER (ORDER BY n / w, w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
  FROM s WINDOW q AS (ORDER BY n / w, w, source)
), f AS (
  SELECT k, held, open FROM o
  WHERE w * ({BUDGET[0]} * total - {BUDGET[1] * MOST} * held) <= {BUDGET[1] * MOST} * n * open ORDER BY k LIMIT 1
), t AS (
  SELECT source, n AS source_size,
         CASE WHEN o.k < f.k THEN CAST({MOST} * n AS DOUBLE)
              ELSE CAST(w * ({BUDGET[0]} * total - {BUDGET[1] * MOST} * f.held) AS DOUBLE)
                   / CAST({BUDGET[1]} * f.open AS DOUBLE) END AS target,
         CASE WHEN n > 0 THEN target / CAST(n AS DOUBLE) ELSE 0 END AS rate
  FROM o, f
), d AS MATERIALIZED (
  SELECT doc_id, m.source, size, source_size, target,
         list_transform([{_DRAWS_SQL}],
           lambda x: floor(rate) + CASE WHEN x < (rate - floor(rate)) * 4294967296.0 THEN 1 ELSE 0 END) AS copies
  FROM m JOIN t ON m.source IS NOT DISTINCT FROM t.source
), g AS (
  SELECT source, k, abs(sum(size * copies[k]) - any_value(target)) AS gap
  FROM d, range(1, {SEEDS} + 1) r(k) GROUP BY source, k
), b AS (SELECT source, k FROM g QUALIFY row_number() OVER (PARTITION BY source ORDER BY gap, k) = 1)
SELECT doc_id, size, source_size, target, CAST(size * copies[b.k] AS BIGINT) AS taken
FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source
"""

QUERIES = {"op13_source_mix": op13_source_mix}
SQL = {"op13_source_mix": OP13_SQL}
