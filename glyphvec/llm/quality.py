"""Quality rules as weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Everything is DataFrame expressions: the statistics of a text are higher-order functions over its words
within one row, and the label model works on the counts of vote patterns, at most 3 to the power of the
number of rules however large the corpus is.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphvec.llm.common import NOT_SPACE, bind, table, words
from glyphvec.session import materialise

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
ROUNDS = 12
#: Weight of the prior belief in a rule, as votes: right and wrong ones.
RIGHT, WRONG = 80, 20
START_PRIOR = 0.8
#: Decimals kept of a parameter between rounds, so that the order of summing does not matter.
DIGITS = 6

#: Common words of the languages that the rule for function words knows.
FUNCTION_WORDS = (
    "a an and are as at be by for from has he in is it of on or that the this to was were will with "
    "auf aus bei das dem den der des die ein eine einer ist mit nicht sich sie und von zu zum "
    "au aux avec ce dans de des du elle en est et il la le les ne par pas pour que qui sur un une "
    "al como con del el es la las lo los más no para pero por que se su un una y"
).split()
#: The letters of those languages.
LETTERS = "A-Za-zÀÂÄÆÇÈÉÊËÎÏÔÖÙÛÜŸŒÁÍÓÚÑàâäæçèéêëîïôöùûüÿœáíóúñßẞ"


def _chars(text: Column, pattern: str) -> Column:
    """How many characters of ``text`` match the class ``pattern``."""
    return F.length(F.regexp_replace(text, f"[^{pattern}]+", "")).cast("bigint")


def _repeated(w: Column) -> Column:
    """Words of ``w`` within three-word windows that occur twice or more."""
    hashed = F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
    windows = F.slice(hashed, 1, F.greatest(F.size(w) - 2, F.lit(0)))

    def covered(h: Column) -> Column:
        def positions(s: Column) -> Column:
            same = F.filter(
                s,
                lambda x, i: F.coalesce(x["h"] == F.get(s, i - 1)["h"], F.lit(False))
                | F.coalesce(x["h"] == F.get(s, i + 1)["h"], F.lit(False)),
            )
            return F.sort_array(F.transform(same, lambda x: x["i"]))

        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
        return F.aggregate(
            bind(ordered, positions),
            start,
            lambda a, p: F.struct((p + 3).alias("end"), (a["n"] + p + 3 - F.greatest(p, a["end"])).alias("n")),
            lambda a: a["n"],
        )

    return bind(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h)))


def statistics(text: Column) -> Column:
    """What the rules look at, as one struct; each part is computed once per row.

    Null texts count as empty; every statistic of an empty text is 0. ``n_known`` (function words, bare of
    what is no letter) and ``n_foreign`` (letters of other languages) are counted if function words are few.
    """
    body = F.coalesce(text, F.lit(""))

    def of_words(w: Column) -> Column:
        common = F.filter(w, lambda x: F.lower(x).isin(FUNCTION_WORDS))
        plain = F.filter(w, lambda x: F.rlike(x, F.lit(r"[\p{L}\p{N}]")))
        return F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
            F.size(F.array_distinct(w)).cast("bigint").alias("n_distinct"),
            _repeated(w).cast("bigint").alias("n_repeat_words"),
            F.size(common).cast("bigint").alias("n_function_words"),
            (F.size(w) - F.size(plain)).cast("bigint").alias("n_bare"),
        )

    def of_lines(lines: Column) -> Column:
        return F.struct(
            F.size(lines).cast("bigint").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
        )

    lines = F.filter(F.split(body, "\n"), lambda line: F.rlike(line, F.lit(NOT_SPACE)))
    parts = F.struct(
        bind(words(text), of_words).alias("words"),
        bind(lines, of_lines).alias("lines"),
        _chars(body, SYMBOLS).alias("n_symbols"),
        _chars(body, "!?").alias("n_shouts"),
        _chars(body, "A-Z").alias("n_capitals"),
    )
    names = {"words": WORD_STATISTICS, "lines": ("n_lines", "n_dup_lines")}

    def known(w: Column) -> Column:
        return F.size(F.filter(w, lambda x: F.lower(F.regexp_replace(x, r"[^\p{L}]+", "")).isin(FUNCTION_WORDS)))

    def of_few(p: Column, count: Column) -> Column:
        few = 100 * p["words"]["n_function_words"] < 2 * p["words"]["n_words"]
        return F.when(few, count.cast("bigint")).otherwise(F.lit(0).cast("bigint"))

    foreign = F.length(F.regexp_replace(body, rf"[^\p{{L}}]+|[{LETTERS}]+", ""))
    return bind(
        parts,
        lambda p: F.struct(
            *(p[group][name].alias(name) for group, own in names.items() for name in own),
            *(p[name].alias(name) for name in ("n_symbols", "n_shouts", "n_capitals")),
            of_few(p, known(words(text))).alias("n_known"),
            of_few(p, foreign).alias("n_foreign"),
        ),
    )


WORD_STATISTICS = ("n_words", "word_chars", "n_distinct", "n_repeat_words", "n_function_words", "n_bare")


def _listed(s: Column) -> Column:
    """Whether a text is in one of the languages of FUNCTION_WORDS: by its letters, and by some of the words.

    Texts that fail for their length anyway need not show such words.
    """
    shown = (100 * s["n_known"] >= s["n_words"]) | (s["n_words"] < MIN_WORDS)
    return (100 * s["n_foreign"] <= s["word_chars"]) & shown


#: (name, bad if, good if) over the statistics; neither: the rule abstains. Not to have one fault is no
#: sign of quality, so most rules can only vote against a text.
RULES = (
    ("symbols", lambda s: 100 * s["n_symbols"] > 10 * s["n_words"], lambda s: 100 * s["n_symbols"] <= s["n_words"]),
    ("bare_tokens", lambda s: 100 * s["n_bare"] > 10 * s["n_words"], None),
    ("repetition", lambda s: 100 * s["n_repeat_words"] > 30 * s["n_words"], None),
    ("variety", lambda s: 100 * s["n_distinct"] < 20 * s["n_words"], None),
    ("lines", lambda s: 100 * s["n_dup_lines"] > 30 * s["n_lines"], None),
    ("shouting", lambda s: 100 * s["n_shouts"] > 20 * s["n_words"], None),
    ("capitals", lambda s: 100 * s["n_capitals"] > 30 * s["word_chars"], None),
    (
        "function_words",
        lambda s: (100 * s["n_function_words"] < 2 * s["n_words"]) & _listed(s),
        lambda s: 100 * s["n_function_words"] > 8 * s["n_words"],
    ),
    ("word_length", lambda s: (s["word_chars"] < 2 * s["n_words"]) | (s["word_chars"] > 15 * s["n_words"]), None),
)


def votes(stats: Column) -> Column:
    """One vote per rule: -1 bad, 1 good, 0 abstains; texts without words get no vote."""

    def vote(bad, good) -> Column:
        cast = F.when(stats["n_words"] == 0, 0).when(bad(stats), -1)
        return (cast.when(good(stats), 1) if good else cast).otherwise(0)

    return F.array(*(vote(bad, good) for _, bad, good in RULES))


def base_failed(stats: Column) -> Column:
    """Too few words, or more than half of them in repeated windows."""
    return (stats["n_words"] < MIN_WORDS) | (100 * stats["n_repeat_words"] > 50 * stats["n_words"])


@dataclass(frozen=True)
class LabelModel:
    """Prior share of good texts and the accuracy of each rule."""

    prior: float
    accuracy: tuple[float, ...]

    def weights(self) -> list[float]:
        """Log odds: of the prior, then what a vote of each rule adds."""
        return [math.log(p / (1 - p)) for p in (self.prior, *self.accuracy)]

    def probability(self, pattern: tuple[int, ...]) -> float:
        return 1 / (1 + math.exp(-sum(v * w for v, w in zip((1, *pattern), self.weights()))))

    def posterior(self, votes: Column) -> Column:
        """Probability that a text is good, given its votes."""
        weights = F.array(*map(F.lit, self.weights()))
        cast = F.concat(F.array(F.lit(1)), votes)
        odds = F.aggregate(F.zip_with(cast, weights, lambda v, w: v * w), F.lit(0.0), lambda a, x: a + x)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def fit(voted: DataFrame, rounds: int = ROUNDS) -> LabelModel:
    """Expectation-maximisation over the patterns in column ``votes`` of ``voted``.

    Spark counts the patterns of the whole corpus, of which there are at most 3 ** rules; the rounds are
    sums over those counts. Without any vote the start values stay.
    """
    counts = voted.groupBy("votes").agg(F.count("*").alias("n"))
    patterns = sorted((tuple(r["votes"]), r["n"]) for r in counts.collect())
    total = sum(n for _, n in patterns)
    model = LabelModel(START_PRIOR, (RIGHT / (RIGHT + WRONG),) * len(RULES))
    for _ in range(rounds if total else 0):
        good = [model.probability(pattern) for pattern, _ in patterns]
        accuracy = []
        for i in range(len(RULES)):
            cast = [(n, p if pattern[i] > 0 else 1 - p) for (pattern, n), p in zip(patterns, good) if pattern[i]]
            right = sum(n * p for n, p in cast)
            accuracy.append(_within((right + RIGHT) / (sum(n for n, _ in cast) + RIGHT + WRONG), 0.55, 0.99))
        share = sum(n * p for (_, n), p in zip(patterns, good))
        prior = _within((share + RIGHT) / (total + RIGHT + WRONG), 0.05, START_PRIOR)
        model = LabelModel(prior, tuple(accuracy))
    return model


def _within(x: float, low: float, high: float) -> float:
    return min(high, max(low, round(x, DIGITS)))


def kept(stats: Column, model: LabelModel) -> Column:
    """Not failed by the base rules, and good with a posterior of one half or more.

    Texts that are null, empty or blank fail.
    """
    good = bind(votes(stats), lambda v: model.posterior(v) >= 0.5)
    return ~base_failed(stats) & good


def filter_quality(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, columns unchanged.

    Rows are judged one by one: repeated rows and rows with null ids stay or go like any other. The
    texts are read twice, once to weigh the rules, and never shuffled. The verdict is one expression,
    as a filter over several columns would compute the statistics for each time it names them.
    """
    stats = statistics(F.col(f"`{text}`"))
    model = fit(docs.select(bind(stats, votes).alias("votes")))
    return docs.filter(bind(stats, lambda s: kept(s, model)))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", statistics(F.col("text")).alias("stats"))
    small = materialise(docs, "statistics")
    model = fit(small.select(votes(F.col("stats")).alias("votes")))
    return small.select(
        "doc_id", "stats.n_words", "stats.word_chars", "stats.n_symbols", "stats.n_dup_lines",
        "stats.n_repeat_words", base_failed(F.col("stats")).alias("base_failed"),
        kept(F.col("stats"), model).alias("kept"),
    )


#: The rules again, for DuckDB.
_RULES_SQL = (
    ("100 * n_symbols > 10 * n_words", "100 * n_symbols <= n_words"),
    ("100 * n_bare > 10 * n_words", None),
    ("100 * n_repeat_words > 30 * n_words", None),
    ("100 * n_distinct < 20 * n_words", None),
    ("100 * n_dup_lines > 30 * n_lines", None),
    ("100 * n_shouts > 20 * n_words", None),
    ("100 * n_capitals > 30 * word_chars", None),
    (
        "100 * n_function_words < 2 * n_words AND 100 * n_foreign <= word_chars"
        f" AND (100 * n_known >= n_words OR n_words < {MIN_WORDS})",
        "100 * n_function_words > 8 * n_words",
    ),
    ("word_chars < 2 * n_words OR word_chars > 15 * n_words", None),
)


def _sql() -> str:
    """The same in DuckDB: a round of expectation-maximisation is one link in a chain of CTEs."""
    numbers = range(len(_RULES_SQL))

    def vote(bad: str, good: str | None) -> str:
        also = f"WHEN {good} THEN 1 " if good else ""
        return f"CASE WHEN n_words = 0 THEN 0 WHEN {bad} THEN -1 {also}ELSE 0 END"

    def chars(pattern: str) -> str:
        return f"length(regexp_replace(body, '[^{pattern}]+', '', 'g'))"

    def within(x: str, low: float, high: float) -> str:
        return f"least({high}, greatest({low}, round(({x}), {DIGITS})))"

    listed = ", ".join(f"'{w}'" for w in sorted(set(FUNCTION_WORDS)))
    odds = "ln(prior / (1 - prior))" + "".join(f" + v{i} * ln(a{i} / (1 - a{i}))" for i in numbers)
    right = RIGHT / (RIGHT + WRONG)
    start = ", ".join(f"CAST({right} AS DOUBLE) AS a{i}" for i in numbers)
    chain = [f"t0 AS (SELECT CAST({START_PRIOR} AS DOUBLE) AS prior, {start})"]
    for k in range(ROUNDS):
        share = within(f"(sum(n * good) + {RIGHT}) / (sum(n) + {RIGHT + WRONG})", 0.05, START_PRIOR)
        accuracy = ", ".join(
            within(
                f"(sum(CASE v{i} WHEN 1 THEN n * good WHEN -1 THEN n * (1 - good) ELSE 0 END) + {RIGHT})"
                f" / (sum(n * abs(v{i})) + {RIGHT + WRONG})",
                0.55,
                0.99,
            )
            + f" AS a{i}"
            for i in numbers
        )
        chain.append(f"g{k} AS (SELECT p.*, 1 / (1 + exp(-({odds}))) AS good FROM p, t{k})")
        chain.append(f"t{k + 1} AS (SELECT {share} AS prior, {accuracy} FROM g{k})")
    cast = ", ".join(f"{vote(bad, good)} AS v{i}" for i, (bad, good) in enumerate(_RULES_SQL))
    names = ", ".join(f"v{i}" for i in numbers)
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS body FROM documents),
w AS MATERIALIZED (
  SELECT r, i, ws[i] AS w FROM (
    SELECT r, ws, unnest(range(1, len(ws) + 1)) AS i FROM (
      SELECT r, regexp_extract_all(body, '{NOT_SPACE}+') AS ws FROM d))
),
t AS (
  SELECT r, i, w, lead(w, 1) OVER x AS w2, lead(w, 2) OVER x AS w3 FROM w WINDOW x AS (PARTITION BY r ORDER BY i)
),
c AS (SELECT r, i, count(*) OVER (PARTITION BY r, w, w2, w3) AS n FROM t WHERE w3 IS NOT NULL),
q AS (SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM c, range(3) AS x(k) WHERE n > 1 GROUP BY r),
a AS (
  SELECT r, count(*) AS n_words, sum(length(w)) AS word_chars, count(DISTINCT w) AS n_distinct,
         count(*) FILTER (lower(w) IN ({listed})) AS n_function_words,
         count(*) FILTER (lower(regexp_replace(w, '[^\\p{{L}}]+', '', 'g')) IN ({listed})) AS n_known,
         count(*) FILTER (NOT regexp_matches(w, '[\\p{{L}}\\p{{N}}]')) AS n_bare
  FROM w GROUP BY r
),
l AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(body, chr(10))) AS line FROM d) WHERE regexp_matches(line, '{NOT_SPACE}') GROUP BY r
),
s AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
         coalesce(n_distinct, 0) AS n_distinct, coalesce(n_function_words, 0) AS n_function_words,
         coalesce(n_bare, 0) AS n_bare, coalesce(n_known, 0) AS n_known,
         length(regexp_replace(body, '[^\\p{{L}}]+|[{LETTERS}]+', '', 'g')) AS n_foreign, coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
         {chars(SYMBOLS)} AS n_symbols, {chars("!?")} AS n_shouts, {chars("A-Z")} AS n_capitals
  FROM d LEFT JOIN a USING (r) LEFT JOIN q USING (r) LEFT JOIN l USING (r)
),
v AS MATERIALIZED (SELECT *, {cast} FROM s),
p AS MATERIALIZED (SELECT {names}, count(*) AS n FROM v GROUP BY ALL),
{", ".join(chain)},
f AS (SELECT v.*, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed, {odds} AS odds FROM v, t{ROUNDS})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 1 / (1 + exp(-odds)) >= 0.5 AS kept
FROM f
"""


QUERIES = {"op5_quality_rules": op5_quality_rules}
SQL = {"op5_quality_rules": _sql()}
