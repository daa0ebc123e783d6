"""URL filters as a temporal list join.

A list is a history: dated entries add a key (a host or a host with a path prefix) to a list or remove it.
Entries become validity intervals, and every capture is judged by the entries that were active when it was
fetched: an equality join on the key with the interval as a further condition. Everything is DataFrame
expressions; page bodies never take part in the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from glyphvec.llm.common import table
from glyphvec.session import materialise

ADD, REMOVE = "add", "remove"
#: Captures of one key that meet its intervals in one task; a key with more is dealt to several parts.
PART_ROWS = 200_000
#: Keys of more parts than one, at most; beyond that the parts grow.
HOT_KEYS = 100_000

#: A host follows the scheme and a user; an IPv6 address stands in brackets.
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:@\[\]]+)"


def host_of(url: Column) -> Column:
    """Host in lower case, without user, port and final dot; null if there is none."""
    host = F.regexp_extract(url, HOST, 1)
    return F.nullif(F.lower(F.regexp_replace(host, r"\.+$", "")), F.lit(""))


def path_of(url: Column) -> Column:
    """Path without query and fragment; '/' if there is none."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.when(path == "", F.lit("/")).otherwise(path)


def segments_of(url: Column) -> Column:
    """The segments of the path; empty ones do not count."""
    return F.filter(F.split(path_of(url), "/"), lambda s: s != "")


def keys_of(url: Column) -> Column:
    """What an entry may name to concern ``url``: its host and all parent domains of two labels or more, and
    the host with the first segments of its path, down to the last. An address in brackets has no parents.
    No keys for null and malformed urls."""
    host = host_of(url)
    labels = F.when(host.startswith("["), F.array(host)).otherwise(F.split(host, r"\."))
    counts = F.filter(F.sequence(F.lit(1), F.size(labels)), lambda n: (n >= 2) | (F.size(labels) == 1))
    domains = F.transform(counts, lambda n: F.array_join(F.slice(labels, -n, n), "."))
    segments = segments_of(url)
    depths = F.sequence(F.lit(1), F.greatest(F.size(segments), F.lit(1)))
    depths = F.filter(depths, lambda n: n <= F.size(segments))
    prefixes = F.transform(depths, lambda n: F.concat(host, F.lit("/"), F.array_join(F.slice(segments, F.lit(1), n), "/")))
    none = F.array().cast("array<string>")
    return F.when(host.isNull(), none).otherwise(F.array_distinct(F.concat(domains, prefixes)))


def listed_key(entry: Column) -> Column:
    """The key that a list entry names, spelled as ``keys_of`` does; null if it names no host.

    Lists also write hosts in capitals, with a leading or final dot, and with scheme, port, empty
    segments or a final slash; query and fragment do not count.
    """
    bare = F.regexp_replace(F.trim(entry), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//|^\.+", "")
    url = F.concat(F.lit("any://"), F.regexp_replace(bare, r"^\.+", ""))
    host = host_of(url)
    return F.when(host.isNotNull(), F.array_join(F.concat(F.array(host), segments_of(url)), "/"))


def intervals(entries: DataFrame) -> DataFrame:
    """(list, key, active_from, active_to): when each key was on each list; the end is exclusive or null.

    ``entries``: list, key, action (add or remove), at. Keys are taken as ``listed_key`` spells them. Nulls
    in any of them, keys without a host and other actions do not count. Of entries of one list and key at one time a removal wins. Entries that repeat the state
    before them change nothing.
    """
    named = entries.withColumn("key", listed_key(F.col("key")))
    valid = named.filter(
        F.col("list").isNotNull() & F.col("key").isNotNull() & F.col("at").isNotNull() & F.col("action").isin(ADD, REMOVE)
    )
    states = valid.groupBy("list", "key", "at").agg(F.min(F.col("action") == ADD).alias("on"))
    history = Window.partitionBy("list", "key").orderBy("at")
    changed = states.withColumn("before", F.lag("on", 1, False).over(history)).filter(F.col("on") != F.col("before"))
    return (
        changed.withColumn("active_to", F.lead("at").over(history))
        .filter("on")
        .select("list", "key", F.col("at").alias("active_from"), "active_to")
    )


def hot_keys(captures: DataFrame, valid: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """(key, parts): listed keys of more than ``part_rows`` captures; at most HOT_KEYS rows.

    Counts are added up on the map side, so no hot key passes a task whole.
    """
    keys = captures.filter("fetched_at IS NOT NULL").select(F.explode(keys_of(F.col("url"))).alias("key"))
    counts = keys.groupBy("key").agg(F.count("*").alias("n")).join(valid.select("key").distinct(), "key", "left_semi")
    counts = materialise(counts, "key-counts")
    total = counts.agg(F.sum("n")).head()[0] or 0
    most = max(part_rows, -(-total // HOT_KEYS))
    return counts.filter(F.col("n") > most).select("key", F.ceil(F.col("n") / most).cast("int").alias("parts"))


def judge(captures: DataFrame, entries: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """``captures`` with ``blocked``, ``lists`` and ``n_active``; columns of these names are replaced.

    ``captures`` has page_id, url and fetched_at. ``lists`` are the lists, in order, with an entry for
    one of the url's keys active at that time, ``n_active`` the number of such entries. Captures with a
    null or malformed url or no time are not blocked. Rows with the same url and time share a verdict;
    repeated rows and null ids stay. The captures of a hot key are dealt to parts, and only the
    intervals of such keys are repeated, once for each part.
    """
    captures = captures.drop("blocked", "lists", "n_active")
    valid = materialise(intervals(entries), "intervals")
    hot = F.broadcast(hot_keys(captures, valid, part_rows))
    wanted = captures.select("url", "fetched_at").filter("url IS NOT NULL AND fetched_at IS NOT NULL").distinct()
    asked = wanted.withColumn("key", F.explode(keys_of(F.col("url")))).join(hot, "key", "left")
    parts = F.coalesce("parts", F.lit(1))
    asked = asked.withColumn("part", F.pmod(F.xxhash64("url", "fetched_at"), parts).cast("int")).drop("parts")
    spread = valid.join(hot, "key", "left")
    spread = spread.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    met = asked.join(spread, ["key", "part"]).filter(
        (F.col("active_from") <= F.col("fetched_at"))
        & (F.col("active_to").isNull() | (F.col("fetched_at") < F.col("active_to")))
    )
    found = met.groupBy("url", "fetched_at").agg(
        F.array_sort(F.collect_set("list")).alias("lists"), F.count("*").alias("n_active")
    )
    joined = captures.join(found, ["url", "fetched_at"], "left")
    return joined.select(
        *captures.columns,
        F.col("n_active").isNotNull().alias("blocked"),
        F.coalesce("lists", F.array().cast("array<string>")).alias("lists"),
        F.coalesce("n_active", F.lit(0)).cast("bigint").alias("n_active"),
    )


def captures_of(pages: DataFrame) -> DataFrame:
    """Pages with a fetch day of a year, which the table lacks: it follows from the id."""
    return pages.select("page_id", "url", (F.col("page_id") * 37 % 365).cast("int").alias("fetched_at"))


def _digit(text: Column, place: int) -> Column:
    """The hexadecimal digit at ``place`` of the digest of ``text``, as a number."""
    return F.instr(F.lit("0123456789abcdef"), F.substring(F.md5(text), place, 1)) - 1


def entries_of(pages: DataFrame) -> DataFrame:
    """A dated list history over the hosts, first path segments and some whole paths of ``pages``.

    The digest of a key decides whether, when and onto which list it comes, and when it goes again.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    section = F.concat(host, F.lit("/"), F.split(path, "/")[1])
    whole = F.concat(host, F.lit("/"), F.array_join(segments_of(F.col("url")), "/"))
    deep = F.when((F.size(segments_of(F.col("url"))) > 1) & (_digit(whole, 20) < 4), whole)
    keys = pages.select(F.explode(F.array(host, F.when(F.split(path, "/")[1] != "", section), deep)).alias("key"))
    keys = keys.filter(F.col("key").isNotNull()).distinct()
    key = F.col("key")
    first = _digit(key, 1) * 20
    steps = (
        ("ads", ADD, first, 3), ("ads", REMOVE, first + 5 + _digit(key, 2) * 6, 3),
        ("ads", ADD, first + 150, 3), ("spam", ADD, _digit(key, 4) * 15, 4), ("spam", ADD, _digit(key, 4) * 15 + 9, 4),
    )
    made = F.array(
        *(
            F.struct(
                F.lit(name).alias("list"), F.lit(action).alias("action"), at.cast("int").alias("at"),
                (_digit(key, 4 + every) % every == 0).alias("taken"),
            )
            for name, action, at, every in steps
        )
    )
    return keys.select("key", F.inline(made)).filter("taken").select("list", "key", "action", "at")


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page at its fetch time."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = judge(captures_of(pages), entries_of(pages))
    return judged.select("page_id", "fetched_at", "blocked", F.array_join("lists", ",").alias("lists"), "n_active")


def _sql() -> str:
    host = rf"nullif(lower(regexp_replace(regexp_extract(url, '{HOST}', 1), '\.+$', '')), '')"
    path = r"regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"

    def digit(place: int) -> str:
        return f"(instr('0123456789abcdef', substring(md5(key), {place}, 1)) - 1)"

    first = f"({digit(1)} * 20)"
    steps = (
        ("ads", ADD, first, 3), ("ads", REMOVE, f"{first} + 5 + {digit(2)} * 6", 3), ("ads", ADD, f"{first} + 150", 3),
        ("spam", ADD, f"{digit(4)} * 15", 4), ("spam", ADD, f"{digit(4)} * 15 + 9", 4),
    )
    made = "\nUNION ALL\n".join(
        f"SELECT '{name}' AS list, key, '{action}' AS action, {at} AS day FROM k WHERE {digit(4 + every)} % {every} = 0"
        for name, action, at, every in steps
    )
    return f"""
WITH p AS (
  SELECT page_id, url, page_id * 37 % 365 AS fetched_at, {host} AS host,
         list_filter(string_split({path}, '/'), lambda s: s <> '') AS segs, string_split({path}, '/') AS parts
  FROM pages
),
k AS (
  SELECT DISTINCT key FROM (
    SELECT host AS key FROM p UNION ALL SELECT host || '/' || parts[2] FROM p WHERE parts[2] <> ''
    UNION ALL SELECT key FROM (SELECT host || '/' || array_to_string(segs, '/') AS key FROM p WHERE len(segs) > 1)
    WHERE {digit(20)} < 4)
  WHERE key IS NOT NULL
),
e AS ({made}),
s AS (SELECT list, key, day, bool_and(action = '{ADD}') AS present FROM e GROUP BY ALL),
c AS (SELECT *, lag(present, 1, false) OVER (PARTITION BY list, key ORDER BY day) AS before FROM s),
i AS (
  SELECT * FROM (
    SELECT list, key, day AS active_from, present, lead(day) OVER (PARTITION BY list, key ORDER BY day) AS active_to
    FROM c WHERE present <> before)
  WHERE present
),
x AS (
  SELECT DISTINCT url, fetched_at, string_split(host, '.') AS labels, host, segs FROM p WHERE host IS NOT NULL
),
a AS (
  SELECT DISTINCT url, fetched_at, key FROM (
    SELECT url, fetched_at, unnest(list_transform(range(2, len(labels) + 1),
             lambda n: array_to_string(labels[len(labels) - n + 1:], '.'))) AS key
    FROM x WHERE host[1] <> '['
    UNION ALL SELECT url, fetched_at, host FROM x
    UNION ALL SELECT url, fetched_at, unnest(list_transform(range(1, len(segs) + 1),
             lambda n: host || '/' || array_to_string(segs[1:n], '/'))) FROM x)
),
m AS (
  SELECT url, fetched_at, string_agg(DISTINCT list, ',' ORDER BY list) AS lists, count(*) AS n_active
  FROM a JOIN i USING (key)
  WHERE active_from <= fetched_at AND (active_to IS NULL OR fetched_at < active_to) GROUP BY ALL
)
SELECT page_id, CAST(p.fetched_at AS INTEGER) AS fetched_at, n_active IS NOT NULL AS blocked,
       coalesce(lists, '') AS lists, coalesce(n_active, 0) AS n_active
FROM p LEFT JOIN m ON p.url = m.url AND p.fetched_at = m.fetched_at
"""


QUERIES = {"op2_url_filters": op2_url_filters}
SQL = {"op2_url_filters": _sql()}
