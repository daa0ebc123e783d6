"""Category paths over the region / nation / supplier tree."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import Catalogue, table
from glyphvec.operators.categories import category_combos, category_stats
from glyphvec.plans.prepare import write_category_paths
from glyphvec.session import work_path
from glyphvec.sources.categories import read_categories, valid_categories

C = Catalogue()
QUERIES, SQL = C.queries, C.sql

# A three-level tree with the usual dirt: nation 3 has no name, nation 4 no entry, suppliers 5 mod 11
# no parent, 7 mod 13 a bad level, 9 mod 17 come twice, the second time under another name.
TREE_SQL = """
    SELECT '1' AS category_level, 'r' || r_regionkey AS category_id, '' AS parent_id,
           '' AS root_id, r_name AS name, r_regionkey AS row_ord FROM region
    UNION ALL
    SELECT ' 2 ', 'n' || n_nationkey, 'r' || n_regionkey, 'r' || n_regionkey,
           CASE WHEN n_nationkey = 3 THEN ' ' ELSE ' ' || n_name END, 1000 + n_nationkey FROM nation
    WHERE n_nationkey <> 4
    UNION ALL
    SELECT CASE WHEN s_suppkey % 13 = 7 THEN '3.0' ELSE '3' END, 's' || s_suppkey,
           CASE WHEN s_suppkey % 11 = 5 THEN '' ELSE 'n' || s_nationkey END, 'r' || n_regionkey,
           s_name, 10000 + s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey
    UNION ALL
    SELECT '+3', 's' || s_suppkey, CASE WHEN s_suppkey % 11 = 5 THEN '' ELSE 'n' || s_nationkey END,
           'r' || n_regionkey, 'again', 1000000000 + s_suppkey
    FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 17 = 9"""

ROWS_SQL = f"""SELECT TRY_CAST(trim(category_level) AS INTEGER) AS level, category_id, parent_id, root_id,
    trim(name) AS name, row_ord FROM ({TREE_SQL})
    WHERE trim(category_level) NOT LIKE '%.%' AND TRY_CAST(trim(category_level) AS INTEGER) > 0
      AND category_id <> ''"""

PATHS_SQL = f"""WITH c AS ({ROWS_SQL}),
    names AS (SELECT category_id, arg_min(name, row_ord) AS name FROM c GROUP BY category_id),
    paths AS (SELECT c.*, coalesce(a.name, '') AS n1, coalesce(b.name, '') AS n2, coalesce(d.name, '') AS n3,
              root_id <> '' AND parent_id <> '' AS has_path
      FROM c LEFT JOIN names a ON a.category_id = c.root_id LEFT JOIN names b ON b.category_id = c.parent_id
      LEFT JOIN names d ON d.category_id = c.category_id WHERE level = 3),
    complete AS (SELECT root_id || '_' || parent_id || '_' || category_id AS combo_id,
      n1 || ' > ' || n2 || ' > ' || n3 AS combo_name FROM paths
      WHERE has_path AND n1 <> '' AND n2 <> '' AND n3 <> '')"""

COMBOS_SQL = f"{PATHS_SQL} SELECT DISTINCT combo_id, combo_name FROM complete"

STATS_SQL = f"""{PATHS_SQL} SELECT (SELECT count(*) FROM c) AS rows,
    (SELECT count(DISTINCT combo_id) FROM complete) AS written,
    (SELECT count(*) FROM paths WHERE NOT has_path) AS skipped,
    (SELECT count(*) FROM paths WHERE has_path) - (SELECT count(*) FROM complete) AS missing_names"""


def tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    region, nation = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    supplier = table(spark, sf_dir, "supplier").join(
        nation.select("n_nationkey", "n_regionkey"), F.col("s_nationkey") == F.col("n_nationkey")
    )

    def rows(df, level, key, parent, root, name, order):
        return df.select(
            level.alias("category_level"),
            key.alias("category_id"),
            parent.alias("parent_id"),
            root.alias("root_id"),
            name.alias("name"),
            order.cast("long").alias("row_ord"),
        )

    def tag(letter, column):
        return F.concat(F.lit(letter), F.col(column))

    none = F.lit("")
    supp = F.col("s_suppkey")
    parent = F.when(supp % 11 == 5, none).otherwise(tag("n", "s_nationkey"))
    level = F.when(supp % 13 == 7, F.lit("3.0")).otherwise(F.lit("3"))
    nation_name = F.when(F.col("n_nationkey") == 3, F.lit(" ")).otherwise(tag(" ", "n_name"))
    root = tag("r", "n_regionkey")
    leaves = rows(supplier, level, tag("s", "s_suppkey"), parent, root, F.col("s_name"), 10000 + supp)
    again = rows(
        supplier.filter(supp % 17 == 9),
        F.lit("+3"),
        tag("s", "s_suppkey"),
        parent,
        root,
        F.lit("again"),
        1_000_000_000 + supp,
    )
    inner = rows(
        nation.filter("n_nationkey <> 4"),
        F.lit(" 2 "),
        tag("n", "n_nationkey"),
        root,
        root,
        nation_name,
        1000 + F.col("n_nationkey"),
    )
    roots = rows(
        region,
        F.lit("1"),
        tag("r", "r_regionkey"),
        none,
        none,
        F.col("r_name"),
        F.col("r_regionkey"),
    )
    return roots.union(inner).union(leaves).union(again)


@C.add(COMBOS_SQL)
def category_paths(spark, sf_dir):
    return category_combos(valid_categories(tree(spark, sf_dir))).select("combo_id", "combo_name")


@C.add(STATS_SQL, "category_stats")
def stats(spark, sf_dir):
    return category_stats(valid_categories(tree(spark, sf_dir)))


def category_file(spark: SparkSession, sf_dir: str) -> str:
    path = work_path(spark, "categories")
    df = tree(spark, sf_dir).withColumnRenamed("name", "category_name_en")
    df.repartitionByRange(3, "row_ord").sortWithinPartitions("row_ord").drop("row_ord").write.option(
        "header", True
    ).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


@C.add(f"SELECT level, category_id, parent_id, root_id, name FROM ({ROWS_SQL})")
def category_rows(spark, sf_dir):
    return read_categories(spark, category_file(spark, sf_dir)).drop("row_ord")


@C.add(COMBOS_SQL)
def category_table(spark, sf_dir):
    """The whole job: CSV in, TSV out, read back."""
    output = work_path(spark, "combos")
    write_category_paths(spark, category_file(spark, sf_dir), output)
    schema = "combo_id STRING, combo_name STRING"
    return spark.read.schema(schema).option("sep", "\t").option("escape", '"').csv(output)


@C.add(STATS_SQL)
def category_table_stats(spark, sf_dir):
    counts = write_category_paths(spark, category_file(spark, sf_dir), work_path(spark, "combos"))
    names = ("rows", "written", "skipped", "missing_names")
    schema = ", ".join(f"{n} BIGINT" for n in names)
    return spark.createDataFrame([tuple(counts[n] for n in names)], schema)
