"""Secret scan over a trigram index.

1. Each rule's pattern becomes a Boolean query over the trigrams that every match must hold.
2. The index has a posting (trigram, document) for each trigram that some rule asks for; others are never
   looked up and not stored. Postings stay flat, so a trigram of a third of all documents is no long list.
3. Clauses are intersected by counting: a document with all trigrams of a clause is a candidate.
4. Patterns run over candidates only; rules without mandatory trigrams run over every text.

Everything is DataFrame expressions.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import product
from re import _constants as node
from re import _parser as parser

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphvec.llm.common import bind, free_name, table
from glyphvec.session import materialise


@dataclass(frozen=True)
class Rule:
    """A pattern that Java, RE2 and Python read alike; matches count if ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: The base rules in their order, then further kinds.
BASE = (
    Rule(
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{5,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("url_login", r"[a-z]{2,10}://[A-Za-z0-9._-]{1,64}:[^\x20\x09-\x0D/@:]{3,64}@"),
)

#: Strings and clauses that the derivation keeps apart; beyond them a query gets weaker, never wrong.
MANY = 64
#: Candidate rows up to which their table is broadcast: some 16 MB.
BROADCAST_ROWS = 200_000
#: Matches of a text that are placed together.
RUN = 256
SPANS = "array<struct<start:bigint,end:bigint,ord:int,kind:string,size:int>>"

Clause = frozenset[str]


def _grams(text: str) -> Clause:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def _clauses(strings: set[str]) -> list[Clause] | None:
    """One clause for each string; None (no demand) if one is shorter than a trigram."""
    found = {_grams(s) for s in strings}
    return None if frozenset() in found else sorted(found, key=sorted)


def _strings(item) -> set[str] | None:
    """The strings that a node matches, in lower case, if they are few."""
    kind, value = item
    if kind is node.LITERAL:
        return {chr(value).lower()}
    if kind is node.IN:
        chars: set[str] = set()
        for sort, x in value:
            if sort is node.LITERAL:
                chars.add(chr(x).lower())
            elif sort is node.RANGE and x[1] - x[0] < 8:
                chars |= {chr(c).lower() for c in range(x[0], x[1] + 1)}
            else:
                return None
        return chars if len(chars) <= 8 else None
    if kind is node.SUBPATTERN:
        return _sequence_strings(value[-1])
    if kind is node.BRANCH:
        parts = [_sequence_strings(option) for option in value[1]]
        return None if None in parts else set().union(*parts)
    if kind in (node.MAX_REPEAT, node.MIN_REPEAT):
        low, high, inner = value
        one = _sequence_strings(inner) if high <= 4 else None
        if one is None:
            return None
        return {"".join(p) for n in range(low, high + 1) for p in product(sorted(one), repeat=n)}
    return None


def _sequence_strings(items) -> set[str] | None:
    found = {""}
    for item in items:
        more = _strings(item)
        if more is None or len(found) * len(more) > MANY:
            return None
        found = {a + b for a in found for b in more}
    return found


def _demands(items) -> list[list[Clause]]:
    """Lists of clauses; a match satisfies one clause of each list."""
    demands: list[list[Clause]] = []
    run = {""}

    def flush() -> None:
        nonlocal run
        if clauses := _clauses(run):
            demands.append(clauses)
        run = {""}

    for item in items:
        more = _strings(item)
        if more is not None and len(run) * len(more) <= MANY:
            run = {a + b for a in run for b in more}
            continue
        flush()
        kind, value = item
        if more is not None:
            run = more
        elif kind is node.SUBPATTERN:
            demands += _demands(value[-1])
        elif kind is node.BRANCH:
            options = [_all_of(_demands(option)) for option in value[1]]
            if all(options):
                demands.append([c for option in options for c in option])
        elif kind in (node.MAX_REPEAT, node.MIN_REPEAT) and value[0] > 0:
            demands += _demands(value[2])
    flush()
    return demands


def _all_of(demands: list[list[Clause]]) -> list[Clause]:
    """Clauses of which one must hold; none if nothing is demanded."""
    found: set[Clause] = set()
    for clauses in sorted(demands, key=len):
        joined = {a | b for a in found for b in clauses} if found else set(clauses)
        if len(joined) <= MANY:
            found = joined
    return [c for c in found if not any(d < c for d in found)]


def trigram_query(pattern: str) -> list[Clause]:
    """Clauses of lower-case trigrams; every text with a match holds all of one clause. Empty: no demand."""
    return sorted(_all_of(_demands(parser.parse(pattern))), key=sorted)


def postings(docs: DataFrame, trigrams: Sequence[str], text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(trigram, doc_id) for each of ``trigrams`` that a text holds, letters in either case."""
    body = F.lower(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    held = bind(body, lambda b: F.filter(F.array(*map(F.lit, trigrams)), lambda t: F.contains(b, t)))
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.explode(held).alias("trigram"))


def candidates(index: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(doc_id, kinds): documents that hold a clause of a rule, and the kinds of those rules."""
    spark = index.sparkSession
    wanted = [
        (rule.kind, number, trigram, len(clause))
        for rule in rules
        for number, clause in enumerate(trigram_query(rule.pattern))
        for trigram in sorted(clause)
    ]
    clauses = spark.createDataFrame(wanted, "kind string, clause int, trigram string, size int")
    met = (
        index.join(F.broadcast(clauses), "trigram")
        .groupBy("doc_id", "kind", "clause", "size")
        .agg(F.count_distinct("trigram").alias("n"))
        .filter(F.col("n") == F.col("size"))
    )
    return met.groupBy("doc_id").agg(F.collect_set("kind").alias("kinds"))


def _matches(text: Column, rule: Rule, order: int) -> Column:
    """The spans of a rule's matches: text between matches gives their places."""
    # Of one repeated class, runs too short to count are no matches from the start; the others are the same.
    least = rule.pattern.removesuffix("+") + f"{{{rule.least},}}" if re.fullmatch(r"\[[^]]+\]\+", rule.pattern) else rule.pattern
    pattern = F.lit(least)

    def placed(parts: Column) -> Column:
        between, whole, held = parts["between"], parts["whole"], parts["held"]
        sizes = F.transform(
            whole,
            lambda w, i: F.struct(
                F.length(F.get(between, i)).cast("bigint").alias("gap"),
                F.length(w).cast("bigint").alias("width"),
                F.length(F.get(held, i)).alias("size"),
            ),
        )
        return F.when(F.size(whole) > 0, bind(sizes, _spans)).otherwise(none)

    def _spans(sizes: Column) -> Column:
        # Appending to an array copies it, so spans grow within a run of matches only.
        runs = F.transform(F.sequence(F.lit(0), (F.size(sizes) - 1).cast("int"), F.lit(RUN)), lambda i: F.slice(sizes, i + 1, RUN))

        def of_runs(runs: Column) -> Column:
            zero = F.lit(0).cast("bigint")
            lengths = F.transform(runs, lambda r: F.aggregate(r, zero, lambda n, s: n + s["gap"] + s["width"]))
            begin = F.struct(zero.alias("at"), F.array().cast("array<bigint>").alias("starts"))
            starts = F.aggregate(
                lengths,
                begin,
                lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["starts"], F.array(acc["at"])).alias("starts")),
                lambda acc: acc["starts"],
            )
            return F.flatten(F.zip_with(runs, starts, of_run))

        return F.filter(bind(runs, of_runs), lambda s: s["size"] >= rule.least)

    def of_run(run: Column, begin: Column) -> Column:
        def step(acc: Column, s: Column) -> Column:
            start = acc["at"] + s["gap"]
            end = start + s["width"]
            span = F.struct(
                start.alias("start"),
                end.alias("end"),
                F.lit(order).alias("ord"),
                F.lit(rule.kind).alias("kind"),
                s["size"].alias("size"),
            )
            return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

        return F.aggregate(run, F.struct(begin.alias("at"), none.alias("spans")), step, lambda acc: acc["spans"])

    none = F.array().cast(SPANS)
    parts = F.struct(
        F.split(text, least, -1).alias("between"),
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("whole"),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("held"),
    )
    return bind(parts, placed)


def scan(
    docs: DataFrame, rules: Sequence[Rule] = BASE + MORE, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """``docs`` with ``secrets``, its matches as (start, end, ord, kind, size) by start and order of rules.

    Null texts count as empty. Rows with a null id are not in the index, all rules run over them; rows
    that repeat an id share their candidates. A column ``secrets`` of ``docs`` is replaced.
    """
    demanding = [rule for rule in rules if trigram_query(rule.pattern)]
    trigrams = sorted({t for rule in demanding for clause in trigram_query(rule.pattern) for t in clause})
    found = materialise(candidates(postings(docs, trigrams, text, doc_id), demanding), "candidates")
    own, kinds = free_name(docs, "candidate"), free_name(docs, "kinds")
    found = found.withColumnsRenamed({"doc_id": own, "kinds": kinds})
    if found.count() <= BROADCAST_ROWS:
        found = F.broadcast(found)
    joined = docs.drop("secrets").join(found, F.col(f"`{doc_id}`") == F.col(own), "left")

    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    none = F.array().cast(SPANS)
    spans = []
    for order, rule in enumerate(rules):
        if rule in demanding:
            concerned = F.array_contains(kinds, rule.kind) | F.col(f"`{doc_id}`").isNull()
        else:
            concerned = F.rlike(body, F.lit(at_least(rule)))
        spans.append(F.when(concerned, _matches(body, rule, order)).otherwise(none))
    return joined.withColumn("secrets", F.array_sort(F.concat(*spans))).drop(own, kinds)


def at_least(rule: Rule) -> str:
    """A pattern that finds the rule's shortest counting match where it is one repeated class."""
    return rule.pattern.removesuffix("+") + f"{{{rule.least}}}" if rule.pattern.endswith("]+") else rule.pattern


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_of(kind: str) -> Column:
    return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document."""
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [count_of(rule.kind).alias(f"n_{rule.kind}") for rule in BASE]
    base = F.filter("secrets", lambda s: s["ord"] < len(BASE))
    return found.select(
        "doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("secrets")).alias("spans")
    )


def _sql() -> str:
    def quoted(pattern: str) -> str:
        return "'" + pattern.replace("'", "''") + "'"

    finds = "\nUNION ALL\n".join(
        f"""SELECT r, {order} AS ord, '{rule.kind}' AS kind, string_split_regex(body, {quoted(rule.pattern)}) AS between_,
       regexp_extract_all(body, {quoted(rule.pattern)}) AS whole, regexp_extract_all(body, {quoted(rule.pattern)}, {rule.group}) AS held,
       {rule.least} AS least FROM d"""
        for order, rule in enumerate(BASE + MORE)
    )
    counts = ", ".join(f"count(*) FILTER (kind = '{rule.kind}') AS n_{rule.kind}" for rule in BASE)
    line = "string_agg(kind || ':' || begin_ || ':' || end_, ',' ORDER BY begin_, ord)"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS body FROM documents),
f AS ({finds}),
n AS (SELECT *, unnest(range(1, len(whole) + 1)) AS i FROM f),
p AS (
  SELECT r, ord, kind, least, length(held[i]) AS size,
         list_sum(list_transform(between_[1:i], lambda x: length(x)))
           + coalesce(list_sum(list_transform(whole[1:i - 1], lambda x: length(x))), 0) AS begin_,
         length(whole[i]) AS width
  FROM n
),
s AS (SELECT r, ord, kind, CAST(begin_ AS BIGINT) AS begin_, CAST(begin_ + width AS BIGINT) AS end_ FROM p WHERE size >= least),
g AS (SELECT r, {counts}, {line} FILTER (ord < {len(BASE)}) AS base, {line} AS spans FROM s GROUP BY r)
SELECT doc_id, {", ".join(f"coalesce(n_{rule.kind}, 0) AS n_{rule.kind}" for rule in BASE)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (r)
"""


QUERIES = {"op3_secret_scan": op3_secret_scan}
SQL = {"op3_secret_scan": _sql()}
