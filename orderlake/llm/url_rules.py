"""URL rules by a sort-merge range join of hosts with nested intervals.

The labels of a host are reversed, so a domain and all its subdomains are one interval of keys and
the intervals of all rules are nested or apart. Hosts and interval limits are
sorted together and swept once: the begin of an interval puts its rules on the stack
of those around it, its end restores what was there before, and a URL takes
the stack that is up when it comes. Its path then picks the longest rule of the stack.

URLs are dealt over sweeps at random, so no host is swept in one task however many
URLs it has, and each sweep gets all limits. There are as many sweeps as make that
copying small next to the URLs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm.common import Work, whole_text

ALLOW, BLOCK = "allow", "block"
# URLs per sweep at least, and times the limits of intervals.
LEAST_PER_SWEEP, TIMES_LIMITS = 5_000, 20
# A label separator, and the character after it: keys of a domain lie between the two.
_DOT, _AFTER = ".", "/"
RULES = "host string, path string, verdict string"
_STACK = "array<struct<length: int, host_length: int, rule: string, path: string, verdict: string>>"


def host(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?`` or ``#``, in small letters."""
    rest = _after_scheme(url)
    return F.translate(
        F.regexp_extract(rest, "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    )


def path(url: Column) -> Column:
    """What follows the host, up to ``?`` or ``#``."""
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    found = F.locate("://", url)
    return F.when(found > 0, F.substring(url, found + 3, F.length(url))).otherwise("")


def key(host_name: Column) -> Column:
    """Reversed labels, each followed by a dot."""
    return F.concat(F.array_join(F.reverse(F.split(host_name, r"\.")), _DOT), F.lit(_DOT))


def _domains(host_name: Column) -> Column:
    """A host and all domains that it lies in."""
    labels = F.split(host_name, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), _DOT),
    )


def stacks(rules: DataFrame) -> DataFrame:
    """``(host, stack, outer)``: the rules on a host and its domains, and those of its domains only."""
    rule = F.struct(
        (F.length("host") + F.length("path")).alias("length"),
        F.length("host").alias("host_length"),
        F.concat("host", "path").alias("rule"),
        "path",
        "verdict",
    )
    clean = rules.select(F.lower("host").alias("host"), "path", "verdict").dropna().distinct()
    own = clean.groupBy("host").agg(F.sort_array(F.collect_list(rule), asc=False).alias("own"))
    around = (
        own.select(F.col("host").alias("inner"), F.explode(_domains(F.col("host"))).alias("host"))
        .join(own, "host")
        .groupBy("inner")
        .agg(
            F.sort_array(F.flatten(F.collect_list("own")), asc=False).alias("stack"),
            F.sort_array(
                F.flatten(F.collect_list(F.when(F.col("host") != F.col("inner"), F.col("own")))),
                asc=False,
            ).alias("outer"),
        )
    )
    return around.select(F.col("inner").alias("host"), "stack", "outer")


def limits(rules: DataFrame) -> DataFrame:
    """``(key, stack)``: what is on the stack from this key on."""
    held = stacks(rules)
    begin = key(F.col("host"))
    end = F.concat(F.expr("substring(key, 1, length(key) - 1)"), F.lit(_AFTER))
    opened = held.select(begin.alias("key"), "stack", "outer")
    return opened.select("key", "stack").unionAll(
        opened.select(end, F.coalesce("outer", F.array().cast(_STACK)))
    )


def swept(urls: DataFrame, rules: DataFrame, sweeps: int) -> DataFrame:
    """``urls`` (any columns, with host and key) with the ``stack`` of rules around their host."""
    columns = urls.columns
    points = urls.select(
        F.floor(F.rand(7) * sweeps).cast("int").alias("sweep"), "key", F.lit(1).alias("kind"),
        F.lit(None).cast(_STACK).alias("opens"), F.struct(*columns).alias("url"),
    )
    dealt = limits(rules).select(
        F.explode(F.sequence(F.lit(0), F.lit(sweeps - 1))).alias("sweep"), "key", F.lit(0).alias("kind"),
        F.col("stack").alias("opens"), F.lit(None).cast(points.schema["url"].dataType).alias("url"),
    )
    order = Window.partitionBy("sweep").orderBy("key", "kind")
    up = F.last("opens", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return (
        points.unionAll(dealt)
        .withColumn("stack", up)
        .where("kind = 1")
        .select("url.*", "stack")
    )


def judge(
    pages: DataFrame,
    rules: DataFrame,
    default: str = ALLOW,
    sweeps: int | None = None,
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    ``rules`` has host, path and verdict; rules with a NULL are left out. A rule fits its host and all its subdomains
    where the path starts with its own. The longest rule wins, of equal ones that with the
    longer host, then the greater by code points; rules that differ in the verdict only block.
    No rule gives ``default``. A url that is NULL or has no ``://`` has an empty host and path.
    Repeated pages are judged each; no pages give no rows.
    """
    work = Work(pages.sparkSession)
    url = whole_text("url")
    parts = pages.select("page_id", host(url).alias("host"), path(url).alias("path"))
    urls = work.table(parts.withColumn("key", key(F.col("host"))), "urls")
    if sweeps is None:
        n_limits = 2 * rules.select("host").distinct().count()
        sweeps = max(1, urls.count() // max(LEAST_PER_SWEEP, TIMES_LIMITS * n_limits))
    fits = F.filter(
        F.coalesce("stack", F.array().cast(_STACK)), lambda r: F.startswith(F.col("path"), r["path"])
    )
    found = swept(urls, rules, sweeps).withColumn("found", F.get(fits, F.lit(0)))
    return found.select(
        "page_id", "host", "path",
        F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", F.lit(default)).alias("verdict"),
    )


def rules_table(spark, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rules given as (host, path, verdict)."""
    return spark.createDataFrame(list(rules), RULES)
