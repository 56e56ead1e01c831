"""Secrets in texts: fixed patterns, and strings that pass for random.

Long strings of an encoding's alphabet get a battery of tests of randomness: an even use of
the alphabet (chi-squared), the number of runs of letters and digits, and the
correlation of neighbours. The p-values are combined. A string of prose or of a pattern fails the
battery; among all strings of one encoding and about the same length, those that
fail at a controlled false-discovery rate are discarded as not random. The rest are random strings.

Everything is built-in functions. Texts that hold no candidate are passed over early.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm.common import Work, bound, whole_text

# Fixed patterns. Letters of the first word are taken in either case.
WORDS = ("password", "passwd", "secret", "token", "api_?key")
VALUE = "[A-Za-z0-9+/_.=-]+"
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")

# Strings that are tested: of at least this many characters, with letters and digits.
LEAST_RANDOM = 20
CANDIDATE = "[A-Za-z0-9+/_-]{20,}"
# Share of random strings that may be discarded among those discarded.
RATE = 0.01
# Steps of p-values per decade when they are ranked, and the smallest decade.
STEPS, DECADES = 50, 30


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


ASSIGN = (
    f"({'|'.join(map(_either_case, WORDS))})[\"']?\\x20*[:=]\\x20*[\"']?({VALUE})"
)


# Running folds go block by block, so that no array is copied once per element.
FOLD = 256


def running(values: Column, step, first) -> Column:
    """For each element the fold of ``step`` over all elements up to it; ``first`` is neutral."""
    kind = "array<int>"

    def fold(items, begin):
        return F.aggregate(items, begin, lambda done, x: step(done, x))

    def listed(items, begin):
        """``begin`` and the fold up to each item, for few items."""
        return F.aggregate(
            items, F.array(begin).cast(kind), lambda done, x: F.concat(done, F.array(step(F.element_at(done, -1), x)))
        )

    def by_blocks(v):
        last = F.floor((F.size(v) - 1) / FOLD).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(v, i * FOLD + 1, FOLD))

        def joined_blocks(blocks):
            before = listed(F.transform(blocks, lambda b: fold(b, first)), first)
            return bound(
                before,
                lambda before: F.flatten(
                    F.transform(blocks, lambda b, i: F.slice(listed(b, F.get(before, i)), 2, FOLD))
                ),
            )

        return bound(blocks, joined_blocks)

    return bound(values, lambda v: F.when(F.size(v) == 0, F.array().cast(kind)).otherwise(by_blocks(v)))


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """``array<(from, until, value)>`` of all matches, leftmost first, in code points.

    A match ends after all that lies before it, itself included: a running sum of lengths.
    """
    whole = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    value = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(group + 1))
    before = F.transform(F.split(text, pattern, -1), F.length)

    def placed(parts):
        whole, value, before = parts["whole"], parts["value"], parts["before"]
        steps = F.transform(whole, lambda w, i: F.get(before, i) + F.length(w))
        ends = running(steps, lambda done, x: done + x, F.lit(0))
        return F.transform(
            F.arrays_zip(whole.alias("whole"), value.alias("value"), ends.alias("until")),
            lambda m: F.struct(
                (m["until"] - F.length(m["whole"])).alias("from"), m["until"].alias("until"), m["value"].alias("value")
            ),
        )

    return bound(F.struct(whole.alias("whole"), value.alias("value"), before.alias("before")), placed)


def apart(base: Column, more: Column) -> Column:
    """The spans of ``more`` that overlap none of ``base``.

    All are sorted by their start. A span overlaps an earlier one of the base if the greatest end so far lies behind its start, and
    a later one if the next start lies before its end: two running folds instead of every span against every other.
    """
    far = 2**31 - 1

    def event(s, own):
        return F.struct(s["from"].alias("from"), F.lit(own).alias("own"), s["until"].alias("until"), s["nth"].alias("nth"), s["value"].alias("value"))

    # Of equal starts the base comes first.
    merged = F.array_sort(F.concat(F.transform(base, lambda s: event(s, 0)), F.transform(more, lambda s: event(s, 1))))

    def judged(spans):
        ends = F.transform(spans, lambda s: F.when(s["own"] == 0, s["until"]).otherwise(0))
        starts = F.transform(F.reverse(spans), lambda s: F.when(s["own"] == 0, s["from"]).otherwise(far))
        reached = running(ends, lambda done, x: F.greatest(done, x), F.lit(0))
        coming = F.reverse(running(starts, lambda done, x: F.least(done, x), F.lit(far)))
        free = F.filter(
            F.arrays_zip(spans.alias("s"), reached.alias("reached"), coming.alias("coming")),
            lambda z: (z["s"]["own"] == 1) & (z["reached"] <= z["s"]["from"]) & (z["coming"] >= z["s"]["until"]),
        )
        return F.transform(
            free,
            lambda z: F.struct(
                z["s"]["from"].alias("from"), z["s"]["nth"].alias("nth"), z["s"]["until"].alias("until"), z["s"]["value"].alias("value")
            ),
        )

    return F.when((F.size(base) == 0) | (F.size(more) == 0), more).otherwise(bound(merged, judged))


def _spans(text: Column, kind: str, pattern: str, group: int = 0) -> Column:
    """Spans of one kind; none, without a further look, where the pattern does not occur."""
    nth = KINDS.index(kind)
    spans = F.transform(
        matches(text, pattern, group),
        lambda m: F.struct(
            m["from"].alias("from"), F.lit(nth).alias("nth"), m["until"].alias("until"),
            m["value"].alias("value"),
        ),
    )
    empty = F.array().cast("array<struct<from: int, nth: int, until: int, value: string>>")
    return F.when(text.rlike(pattern), spans).otherwise(empty)


def base_spans(text: Column) -> Column:
    """The spans of the fixed patterns, by start and then kind. Matches that are too short are dropped."""
    assigned = F.filter(
        _spans(text, "assign", ASSIGN, 2), lambda s: F.length(s["value"]) >= LEAST_VALUE
    )
    return F.array_sort(
        F.concat(assigned, _spans(text, "access", ACCESS), _spans(text, "hex", HEX))
    )


def candidates(text: Column) -> Column:
    """Long strings with letters and digits."""
    return F.filter(
        _spans(text, "random", CANDIDATE),
        lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]"),
    )


def joined(spans: Column) -> Column:
    """``kind:start:end`` of all spans, with commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.get(names, s["nth"]), s["from"], s["until"])
        ),
        ",",
    )


# Tests of randomness


def encoding(value: Column) -> Column:
    """The narrowest alphabet that a string fits, as the number of its characters."""
    return (
        F.when(value.rlike("^([0-9a-f]+|[0-9A-F]+)$"), 16)
        .when(value.rlike("^([0-9a-z]+|[0-9A-Z]+)$"), 36)
        .when(value.rlike("^[0-9A-Za-z]+$"), 62)
        .otherwise(64)
    )


def upper_normal(z: Column) -> Column:
    """The chance of a standard normal variable above z, by a logistic curve."""
    return 1 / (1 + F.exp(1.5976 * z + 0.07056 * z * z * z))


def _two_sided(z: Column) -> Column:
    return bound(z, lambda z: F.least(F.lit(1.0), 2 * upper_normal(F.abs(z))))


def chi_squared_p(value: Column, size: Column) -> Column:
    """The chance of an alphabet used less evenly, after Wilson and Hilferty.

    Short strings use few of the characters, so variance is that of the exact statistic.
    """
    letters = F.filter(F.split(value, ""), lambda c: c != "")
    counts = F.transform(
        F.array_distinct(letters), lambda c: F.length(value) - F.length(F.replace(value, c, F.lit("")))
    )
    n = F.length(value).cast("double")
    squares = F.aggregate(counts, F.lit(0.0), lambda s, k: s + k * k)
    statistic = squares * size / n - n
    mean = size - F.lit(1.0)
    variance = 2 * mean * (n - 1) / n
    degrees = 2 * mean * mean / variance
    ratio = F.greatest(statistic / mean, F.lit(0.0))
    z = (F.pow(ratio, F.lit(1 / 3)) - (1 - 2 / (9 * degrees))) / F.sqrt(2 / (9 * degrees))
    return bound(z, upper_normal)


def _classes(value: Column, size: Column) -> tuple[Column, Column]:
    """The string as digits (1) and others (0), and the expected share of digits."""
    return F.regexp_replace(F.regexp_replace(value, "[0-9]", "1"), "[^1]", "0"), 10.0 / size


def runs_p(value: Column, size: Column) -> Column:
    """Too few or too many changes between digits and other characters."""
    ones, share = _classes(value, size)
    n = F.length(value).cast("double")
    changes = F.length(F.regexp_replace(ones, "(0+|1+)", "x")) - 1
    each = 2 * share * (1 - share)
    # Changes at neighbouring places depend on each other.
    variance = (n - 1) * each * (1 - each) + 2 * (n - 2) * (share * (1 - share) - each * each)
    return _two_sided((changes - (n - 1) * each) / F.sqrt(F.greatest(variance, F.lit(1e-9))))


def serial_p(value: Column, size: Column) -> Column:
    """Correlation of the codes of neighbours."""
    def correlated(codes):
        n = F.size(codes).cast("double")

        def about(mean):
            var = F.aggregate(codes, F.lit(0.0), lambda s, c: s + (c - mean) * (c - mean))
            pairs = F.zip_with(
                F.slice(codes, 1, F.size(codes) - 1),
                F.slice(codes, 2, F.size(codes) - 1),
                lambda c, d: (c - mean) * (d - mean),
            )
            both = F.aggregate(pairs, F.lit(0.0), lambda s, x: s + x)
            return _two_sided((both / F.greatest(var, F.lit(1e-9)) + 1 / n) * F.sqrt(n))

        return bound(F.aggregate(codes, F.lit(0.0), lambda s, c: s + c) / n, about)

    letters = F.filter(F.split(value, ""), lambda c: c != "")
    return bound(F.transform(letters, lambda c: F.ascii(c).cast("double")), correlated)


def battery_p(value: Column) -> Column:
    """The combined p-value of the three tests, after Fisher."""
    size = encoding(value)

    def tested(size):
        ps = [test(value, size) for test in (chi_squared_p, runs_p, serial_p)]
        half = -sum((F.log(F.greatest(p, F.lit(1e-300))) for p in ps), F.lit(0.0))
        # Twice that is chi-squared with six degrees of freedom.
        return bound(half, lambda half: F.exp(-half) * (1 + half + half * half / 2))

    return bound(size, tested)


def _length_class(value: Column) -> Column:
    return F.floor(F.log2(F.length(value)) * 2)


def discarded(tested: DataFrame) -> DataFrame:
    """``(alphabet, long, step)``: up to which step of p-values strings are not random.

    Benjamini and Hochberg's rule within each encoding and length, on p-values rounded up to steps, so
    that their ranks come from counts per step.
    """
    group = Window.partitionBy("alphabet", "long")
    upto = F.sum("n").over(group.orderBy("step"))
    total = F.sum("n").over(group)
    counts = tested.groupBy("alphabet", "long", "step").agg(F.count(F.lit(1)).alias("n"))
    p = F.pow(F.lit(10.0), F.col("step") / STEPS)
    return (
        counts.select("*", upto.alias("upto"), total.alias("total"))
        .where(p <= F.col("upto") / F.col("total") * RATE)
        .groupBy("alphabet", "long")
        .agg(F.max("step").alias("worst"))
    )


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, spans and base spans as arrays of (from, nth, until).

    ``nth`` counts the kinds. Added spans never overlap base spans. NULL texts are empty and have no
    spans. Repeated rows are scanned each; no documents give no rows. The work grows in proportion to a text's length
    and a little faster than its matches, so texts of a hundred thousand matches are scanned whole.
    """
    work = Work(docs.sparkSession)
    text = whole_text()
    found = docs.select("doc_id", base_spans(text).alias("base"), candidates(text).alias("more"))
    def judged(c):
        p = F.least(F.greatest(battery_p(c["value"]), F.lit(10.0**-DECADES)), F.lit(1.0))
        return F.struct(
            c["from"].alias("from"), c["nth"].alias("nth"), c["until"].alias("until"),
            encoding(c["value"]).alias("alphabet"), _length_class(c["value"]).alias("long"),
            F.ceil(F.log10(p) * STEPS).alias("step"),
        )

    slim = F.transform("base", lambda s: F.struct(s["from"].alias("from"), s["nth"].alias("nth"), s["until"].alias("until")))
    rows = work.table(
        found.select("doc_id", "base", apart(F.col("base"), F.col("more")).alias("more")).select(
            "doc_id", slim.alias("base"), F.transform("more", judged).alias("more")
        ),
        "rows",
    )
    tested = rows.where(F.size("more") > 0).select(F.explode("more").alias("m")).select("m.*")
    limits = work.table(discarded(tested), "limits")
    # One entry per encoding and class of length: a few dozen, however much text there is.
    worst = limits.agg(
        F.map_from_entries(
            F.collect_list(F.struct(F.concat_ws(":", "alphabet", "long"), "worst"))
        ).alias("worst")
    )
    limit = worst.first()["worst"] or {}
    known = F.create_map(*(F.lit(x) for k, v in limit.items() for x in (k, v))) if limit else None

    def random(m):
        if known is None:
            return F.lit(True)
        at = F.try_element_at(known, F.concat_ws(":", m["alphabet"], m["long"]))
        return at.isNull() | (m["step"] > at)

    kept = F.transform(
        F.filter("more", random),
        lambda m: F.struct(m["from"].alias("from"), m["nth"].alias("nth"), m["until"].alias("until")),
    )
    return rows.select("doc_id", "base", F.array_sort(F.concat("base", kept)).alias("spans"))
