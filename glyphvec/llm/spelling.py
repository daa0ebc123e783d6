"""Spelling variants: words one edit apart, compared in dense tiles of padded code-point matrices.

Two different words are one inserted, deleted or replaced code point apart exactly if their common prefix
and common suffix together reach the longer length minus one. Such a pair differs in one place of the
longer word. That word is cut into four zones; outside the zone of the place both words agree, so what a
word has outside a zone names a group, and only words of a group meet. A pair counts in the zone that
holds the end of its common prefix, hence once.

A task turns the words of a group into two matrices, aligned left and right, and compares block with
block: the first column that differs gives the prefix and the suffix of all pairs of a tile. It returns
one row per word, never pairs. A group beyond a bound is cut into blocks, and tasks get two blocks each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphvec.llm.common import table
from glyphvec.session import materialise, settled

#: The letters of a run, as code points in a pattern.
LETTERS = r"[A-Za-zÀ-ÿ]"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LENGTH, LEAST_COUNT = 7, 2
DROP_ONE_IN = 31
#: A form is at least so many times as frequent as its variant.
FACTOR = 10
ZONES = 4
#: Words of a group that one task compares; larger groups go in pairs of blocks of at most about this size.
GROUP = 4096
#: Bytes of words in a task, and cells (pairs times code points) in a tile.
TASK_BYTES = 4 << 20
CELLS = 1 << 21


def runs(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least: int = LEAST_LENGTH) -> DataFrame:
    """(word): one row per run of letters that has at least ``least`` code points in the end.

    A-Z become small. Where 31 divides the crc32 of ``id:run``, the run loses one code point. A null text
    has no runs, a null id counts as an empty one.
    """
    found = F.regexp_extract_all(F.col(f"`{text}`"), F.lit(f"{LETTERS}{{{least},}}"), F.lit(0))
    key = F.concat(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")), F.lit(":")).alias("key")
    each = docs.select(key, F.explode(found).alias("run")).select("key", F.translate("run", CAPITALS, SMALL).alias("run"))
    h, at = F.crc32(F.concat("key", "run")), F.col("h") % F.length("run")
    shorter = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    word = F.when(F.col("h") % DROP_ONE_IN == 0, shorter).otherwise(F.col("run"))
    return each.withColumn("h", h).select(word.alias("word")).filter(F.length("word") >= least)


def vocabulary(each: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """(word, n): the words that occur at least ``least`` times; null is no word."""
    return each.filter(F.col("word").isNotNull()).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def _keys() -> Column:
    """For both lengths the longer word of a pair may have, and each zone: (longest, zone, key)."""
    length, found = F.length("word"), []
    for more in (0, 1):
        for zone in range(ZONES):
            longest = length + more
            start, end = F.floor(longest * zone / ZONES), F.floor(longest * (zone + 1) / ZONES)
            head = F.substring(F.col("word"), F.lit(1), start.cast("int"))
            kept = (longest - end).cast("int")
            tail = F.when(kept > 0, F.substring(F.col("word"), length - kept + 1, kept)).otherwise("")
            key = F.xxhash64(longest, F.lit(zone), head, tail)
            found.append(F.struct(longest.alias("longest"), F.lit(zone).cast("int").alias("zone"), key.alias("key")))
    return F.array(*found)


def _codes(words: list[str], width: int, right: bool) -> np.ndarray:
    """Code points of the words, padded with zeros at the right or the left."""
    aligned = [w.rjust(width, "\0") if right else w.ljust(width, "\0") for w in words]
    return np.frombuffer("".join(aligned).encode("utf-32-le"), np.uint32).reshape(len(words), width)


def _agreeing(a: np.ndarray, b: np.ndarray, right: bool) -> np.ndarray:
    """Columns in which rows of ``a`` agree with rows of ``b`` from the left (right) end on."""
    same = a[:, :, None, :] == b[:, None, :, :]
    if right:
        same = same[..., ::-1]
    return np.where(same.all(axis=-1), same.shape[-1], same.argmin(axis=-1))


def single_edits(left: list[str], right: list[str], groups: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, place): words ``left[i]`` and ``right[j]`` one edit apart, and the end of their common prefix.

    With several ``groups`` both lists hold equally many words of each, group by group, and words meet
    only within their group. No word is empty.
    """
    a, b = len(left) // groups, len(right) // groups
    width = max(map(len, left + right))
    sizes_a = np.array([len(w) for w in left]).reshape(groups, a, 1)
    sizes_b = np.array([len(w) for w in right]).reshape(groups, 1, b)
    longest, shortest = np.maximum(sizes_a, sizes_b), np.minimum(sizes_a, sizes_b)
    ends = []
    for end in (False, True):
        x, y = (_codes(w, width, end).reshape(groups, -1, width) for w in (left, right))
        # Padding agrees with padding, so agreement counts up to the shorter word only.
        ends.append(np.minimum(_agreeing(x, y, end), shortest))
    prefix, suffix = ends
    near = (longest - shortest <= 1) & (prefix + suffix >= longest - 1) & (prefix < longest)
    g, i, j = np.nonzero(near)
    return g * a + i, g * b + j, prefix[g, i, j]


class _Best:
    """For each word: near words so far, and the most frequent of them (ties: the smallest)."""

    def __init__(self, words: list[str], n: np.ndarray) -> None:
        self.words, self.n = words, n
        self.count = np.zeros(len(words), np.int64)
        self.form = np.full(len(words), -1)
        self.order = np.empty(len(words), np.int64)
        self.order[np.lexsort((np.argsort(np.argsort(np.array(words, object))), -n))] = np.arange(len(words))

    def add(self, word: np.ndarray, near: np.ndarray) -> None:
        np.add.at(self.count, word, 1)
        by_form = np.lexsort((self.order[near], word))
        word, near = word[by_form], near[by_form]
        first = np.flatnonzero(np.append(True, word[1:] != word[:-1])) if len(word) else np.zeros(0, int)
        word, near = word[first], near[first]
        old = self.form[word]
        better = (old < 0) | (self.order[near] < self.order[old])
        self.form[word[better]] = near[better]

    def rows(self) -> pa.Table:
        own = np.flatnonzero(self.count)
        form = self.form[own]
        columns = {
            "word": pa.array([self.words[i] for i in own], pa.string()),
            "n_near": pa.array(self.count[own]),
            "form_n": pa.array(self.n[form]),
            "form": pa.array([self.words[i] for i in form], pa.string()),
        }
        return pa.table(columns)


def _tiles(size: int, longest: int) -> Iterator[tuple[slice, slice]]:
    """Pairs of row blocks that cover all pairs of ``size`` rows, each within the cells of a tile."""
    step = max(1, int((CELLS / longest) ** 0.5))
    for lo in range(0, size, step):
        for other in range(lo, size, step):
            yield slice(lo, lo + step), slice(other, other + step)


def _compare(rows: pa.Table) -> pa.Table:
    """Near words of each word of a task, as far as the task's groups tell."""
    keys = rows.select(["longest", "zone", "key", "low", "high"]).to_pandas()
    words, n = rows["word"].to_pylist(), rows["n"].to_numpy()
    side = rows["side"].to_numpy()
    longest, zone = keys["longest"].to_numpy(), keys["zone"].to_numpy()
    # Longer words of a group first: shorter ones are compared with longer ones, not among themselves.
    sizes = np.array([len(w) for w in words], np.int64)
    group = keys.groupby(list(keys.columns), sort=False).ngroup().to_numpy()
    order = np.lexsort((side, longest - sizes, group))
    starts = np.flatnonzero(np.append(True, group[order][1:] != group[order][:-1]))
    bounds = np.append(starts, len(order))
    place_of = np.empty(len(order), np.int64)
    place_of[order] = np.arange(len(order))
    best = _Best(words, n)

    def meet(left: np.ndarray, right: np.ndarray, groups: int = 1) -> None:
        i, j, place = single_edits([words[r] for r in left], [words[r] for r in right], groups)
        i, j = left[i], right[j]
        whole, z = longest[i], zone[i]
        here = (place >= whole * z // ZONES) & (place < whole * (z + 1) // ZONES)
        here &= (np.maximum(sizes[i], sizes[j]) == whole) & (place_of[i] < place_of[j])
        here &= (side[i] == 0) | (side[i] != side[j])
        i, j = i[here], j[here]
        best.add(np.append(i, j), np.append(j, i))

    lengths = np.diff(bounds)
    first = longest[order[starts]]
    # Groups of one size and width that fit a tile are stacked; larger ones are cut into tiles.
    small = (lengths > 1) & (lengths**2 * first <= CELLS)
    for size, width in sorted(set(zip(lengths[small].tolist(), first[small].tolist()))):
        own = starts[small & (lengths == size) & (first == width)]
        for some in np.split(own, range(step := CELLS // (size * size * width), len(own), step)):
            stacked = order[some[:, None] + np.arange(size)].ravel()
            meet(stacked, stacked, len(some))
    for g in np.flatnonzero((lengths > 1) & ~small):
        own = order[bounds[g] : bounds[g + 1]]
        for a, b in _tiles(len(own), int(first[g])):
            meet(own[a], own[b])
    return best.rows()


@settled("near-words")
def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, form_n, form): for each word of ``words(word, n)`` with near words, how many there
    are and which of them is most frequent, ties to the smallest in code-point order.

    Words are distinct and of at least four code points. Groups of words that agree outside a zone are
    dealt to tasks by hash; one of more than 4096 words is cut into blocks, and each two blocks are a
    task, so rows grow with the square only of such a group's blocks.
    """
    keyed = words.select("word", "n", F.explode(_keys()).alias("k")).select("word", "n", "k.*")
    sizes = keyed.groupBy("longest", "zone", "key").agg(F.count("*").alias("size"))
    large = materialise(sizes.filter(F.col("size") > GROUP), "large-groups")
    told = words.agg(F.coalesce(F.sum(F.length("word") + 24), F.lit(0))).first()[0]
    bins = 1 + 2 * ZONES * int(told) // TASK_BYTES
    none = F.lit(0).cast("bigint")
    tasks = keyed.withColumns({"low": none, "high": none, "side": F.lit(0)})
    tasks = tasks.withColumn("bin", F.pmod("key", F.lit(bins)))
    if not large.isEmpty():
        names = ["longest", "zone", "key"]
        tasks = tasks.join(large, names, "left_anti").select(*tasks.columns)
        parts = F.ceil(F.col("size") / GROUP)
        split = keyed.join(large, names).withColumn("parts", parts)
        split = split.withColumn("block", F.pmod(F.xxhash64("word"), F.col("parts")))
        split = split.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
        low, high = F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
        side = F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), 1).otherwise(2)
        split = split.select("word", "n", *names, low, high, side.alias("side"))
        tasks = tasks.unionByName(split.withColumn("bin", F.xxhash64("key", "low", "high")))
    schema = "word string, n_near bigint, form_n bigint, form string"
    found = tasks.groupBy("bin").applyInArrow(_compare, schema)
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best")
    merged = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return merged.select("word", "n_near", (-F.col("best.less")).alias("form_n"), F.col("best.form").alias("form"))


@settled("ends")
def _roots(links: DataFrame) -> DataFrame:
    """(word, root): for each row of ``links(word, form)`` the end of its chain of forms.

    Every step of a chain multiplies the count, so chains are short; each round doubles the distance.
    """
    roots = materialise(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        following = roots.select(F.col("word").alias("at"), F.col("root").alias("next"))
        if roots.join(following, roots["root"] == following["at"], "left_semi").isEmpty():
            return roots
        moved = roots.join(following, roots["root"] == following["at"], "left")
        roots = materialise(moved.select("word", F.coalesce("next", "root").alias("root")), "roots")


def variants(words: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n, root): ``words(word, n)`` with their more usual spelling.

    ``form`` is the most frequent near word if it is at least ten times as frequent, else null with
    ``form_n``; ``root`` is the end of the chain of forms, the word itself where there is none. Without
    rows the result is empty.
    """
    words = materialise(words, "vocabulary")
    near = near_words(words).withColumnRenamed("word", "near_word")
    found = words.join(near, words["word"] == near["near_word"], "left")
    usual = F.col("form_n") >= FACTOR * F.col("n")
    found = found.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(usual, F.col("form")).alias("form"),
        F.when(usual, F.col("form_n")).alias("form_n"),
    )
    found = materialise(found, "forms")
    roots = _roots(found.filter(F.col("form").isNotNull())).withColumnRenamed("word", "linked")
    ends = found.join(roots, found["word"] == roots["linked"], "left")
    return ends.select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form, root and near words of every word of the documents."""
    return variants(vocabulary(runs(table(spark, sf_dir, "documents"))))


#: crc32 by its table, itself made by its rule; near words by what they are without one code point.
OP12_SQL = f"""
WITH RECURSIVE z AS MATERIALIZED (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)
              ORDER BY i) AS t FROM range(256) r(i)
), x AS (
  SELECT id, run, hex(id || ':' || run) AS bytes, count(*) AS n FROM (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
           translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{{{LEAST_LENGTH},}}')), '{CAPITALS}', '{SMALL}') AS run
    FROM documents
  ) GROUP BY ALL
), h AS MATERIALIZED (
  SELECT run, n, xor(list_reduce(
      list_transform(range(1, len(bytes) // 2 + 1), lambda i: CAST('0x' || substr(bytes, 2 * i - 1, 2) AS BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS h
  FROM x, z
), w AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT n, CASE WHEN h % {DROP_ONE_IN} = 0
                   THEN substr(run, 1, h % len(run)) || substr(run, h % len(run) + 2) ELSE run END AS word
    FROM h
  ) WHERE len(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}
), d AS MATERIALIZED (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, unnest(range(1, len(word) + 1)) AS i FROM w)
), e AS (
  SELECT a.word, b.word AS near FROM d a JOIN d b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT d.word, w.word FROM d JOIN w ON d.rest = w.word
  UNION SELECT w.word, d.word FROM d JOIN w ON d.rest = w.word
), f AS MATERIALIZED (
  SELECT a.word, count(*) AS n_near, first(e.near ORDER BY b.n DESC, e.near) AS form, max(b.n) AS form_n
  FROM e JOIN w a ON a.word = e.word JOIN w b ON b.word = e.near GROUP BY a.word
), g AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN form_n >= {FACTOR} * n THEN form END AS form, CASE WHEN form_n >= {FACTOR} * n THEN form_n END AS form_n
  FROM w LEFT JOIN f USING (word)
), c AS (
  SELECT word, form AS root FROM g WHERE form IS NOT NULL
  UNION ALL SELECT c.word, g.form FROM c JOIN g ON g.word = c.root WHERE g.form IS NOT NULL
), r AS (SELECT c.word, c.root FROM c JOIN g ON g.word = c.root WHERE g.form IS NULL)
SELECT g.word, g.form, coalesce(r.root, g.word) AS root, g.n, g.n_near, g.form_n FROM g LEFT JOIN r USING (word)
"""

QUERIES = {"op12_spelling_variants": op12_spelling_variants}
SQL = {"op12_spelling_variants": OP12_SQL}
