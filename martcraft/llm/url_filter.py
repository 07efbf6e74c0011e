"""URL filters: host-suffix and path-prefix expressions looked up by short hash prefixes.

A rule (host, path, verdict) fits the URLs of its host and of all subdomains
whose path starts with the rule's path. A rule's expression is its host and path,
written one after the other; its shape is the number of its host's labels, of its
path's slashes and of the characters behind the last slash. A URL has at most one
expression of each shape that the rules have: its host's last labels and the
beginning of its path. So every rule that fits is found by equality, and what a
URL expands to is bounded by the shapes of the rules, not by its own length.

Expressions meet the rules on the first 8 hexadecimal digits of their SHA-256; the
rows that meet are then confirmed by the whole digest. Of the rules that fit, the
longest expression wins, then the longest host. Of two rules with one expression,
"block" wins. Every different (host, path) is looked up once, so a URL that many
rows share, or a host that holds a third of them, is reduced before it is joined.

Host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z
lower-cased. Path: what follows, up to ``?``, ``#`` or the end, as it is.

Defined cases: a null URL, or one without ``://``, has an empty host and path. No
rule fits an empty host, and a rule with path ``/`` doesn't fit an empty path. URLs
that no rule fits get a null rule and the default verdict. Rules with a null
column, an empty host, a path that is neither empty nor begins with ``/``, or
another verdict than "allow" and "block" are an error of the caller and raise, so
that no rule is left out in silence; an empty rule table is allowed. Repeated rows
are judged each; all columns of the pages stay, and a new column whose name is
taken gets ``_`` behind it. An empty table gives an empty one. URLs of any length
are judged whole.
"""
from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martcraft.llm.tables import fresh, saved

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY_DIGITS = 8
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    """Rules given as (host, path, verdict), as a table whose size the planner knows."""
    rows = list(rules)
    schema = pa.schema([("host", pa.string()), ("path", pa.string()), ("verdict", pa.string())])
    return spark.createDataFrame(pa.table([pa.array([r[i] for r in rows], pa.string()) for i in range(3)], schema=schema))


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = url.cast("string")
    part = [F.coalesce(F.regexp_extract(url, _URL, i), F.lit("")) for i in (1, 2)]
    return F.translate(part[0], UPPER, LOWER), part[1]


def _count(column: str, mark: str) -> str:
    return f"length({column}) - length(replace({column}, '{mark}', ''))"


def _checked(rules: DataFrame) -> DataFrame:
    """One row per expression with its shape, digest and priority; bad rules raise."""
    r = rules.select(F.translate(F.col("host").cast("string"), UPPER, LOWER).alias("host"), F.col("path").cast("string").alias("path"), F.col("verdict").cast("string").alias("verdict"))
    good = "host <> '' and not contains(host, '/') and (path = '' or startswith(path, '/')) and verdict in ('allow', 'block')"
    bad = r.where(f"not coalesce({good}, false)").limit(3).collect()
    if bad:
        raise ValueError(f"not a rule: {[tuple(b) for b in bad]}")
    r = r.groupBy("host", "path").agg(F.max((F.col("verdict") == "block").cast("long")).alias("block"))
    return r.selectExpr(
        f"{_count('host', '.')} + 1 as labels", f"{_count('path', '/')} as slashes", "if(path = '', 0, length(substring_index(path, '/', -1))) as rest",
        "sha2(concat(host, path), 256) as digest",
        "shiftleft(cast(length(host) + length(path) as bigint), 32) + length(host) * 2L + block as priority")


def filter_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """The rows of ``pages`` and the columns ``host, path, rule, verdict``, all strings.

    ``rules`` has the columns ``host, path, verdict``. The rule is written as its host and path.
    """
    spark = pages.sparkSession
    checked = _checked(rules)
    # Distinct triples of small numbers: as many as the rules have kinds of form, not as many as rules.
    shapes = [tuple(r) for r in checked.select("labels", "slashes", "rest").distinct().collect()]
    names = list(pages.columns)
    new = []
    for c in ("host", "path", "rule", "verdict"):
        new.append(fresh(c, [*names, *new]))
    host, path = host_and_path(F.col(url_col))
    best = _best(pages.select(host.alias("h"), path.alias("p")), checked, shapes) if shapes else spark.createDataFrame([], "h string, p string, priority long")
    length, of_host = "cast(shiftright(priority, 32) as int)", "cast(shiftright(priority, 1) & 2147483647 as int)"
    best = best.selectExpr(
        "h", "p", f"concat(substr(h, length(h) - {of_host} + 1), substr(p, 1, {length} - {of_host})) as found", "if(priority & 1 = 1, 'block', 'allow') as says")
    judged = pages.withColumn(new[0], host).withColumn(new[1], path)
    judged = judged.join(best, (judged[new[0]] == best["h"]) & (judged[new[1]] == best["p"]), "left")
    return judged.select(*(judged[c] for c in [*names, *new[:2]]), best["found"].alias(new[2]), F.coalesce(best["says"], F.lit(default)).alias(new[3]))


def _best(urls: DataFrame, checked: DataFrame, shapes: list[tuple[int, int, int]]) -> DataFrame:
    """``h, p, priority`` of the winning rule for every (h, p) that a rule fits."""
    shape = F.explode(F.array(*(F.struct(*(F.lit(v).alias(c) for c, v in zip(("labels", "slashes", "rest"), s, strict=True))) for s in sorted(shapes)))).alias("s")
    made = urls.where("h <> ''").distinct().select("h", "p", shape).select("h", "p", "s.*")
    made = made.where(f"{_count('h', '.')} + 1 >= labels and {_count('p', '/')} >= slashes")
    made = made.withColumn("at", F.expr("if(slashes = 0, 0, length(substring_index(p, '/', slashes)) + 1) + rest")).where("length(p) >= at")
    made = made.selectExpr("h", "p", "sha2(concat(substring_index(h, '.', -labels), substr(p, 1, at)), 256) as made")
    short = lambda c: F.substring(c, 1, KEY_DIGITS)
    # The planner broadcasts the rules below its size threshold; beyond it both sides are shuffled and a
    # common expression's part can be split.
    met = made.withColumn("key", short("made")).join(checked.select("digest", "priority").withColumn("key", short("digest")), "key").where("made = digest")
    # Written, so that both sides of the join back are plain shuffles and a common URL's part can be split.
    return saved(met.groupBy("h", "p").agg(F.max("priority").alias("priority")), "urls")
