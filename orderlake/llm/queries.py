"""The registered queries of the operators, and their results in SQL where SQL can say them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.llm import centroids, passages, quality_rules, secret_scan, toxicity, url_rules
from orderlake.llm.alignment import Tokenizers, align
from orderlake.llm.exact_dedup import exact_groups
from orderlake.llm.language import identify
from orderlake.llm.mixing import mix
from orderlake.llm.near_dedup import near_groups
from orderlake.llm.pieces import Pieces, decode, encode
from orderlake.llm.token_files import round_trip

Query = Callable[[SparkSession, str], DataFrame]

# The tokenizer files are given by name; where they lie is the business of their package.
PIECES = "piece_bpe_32k.model"
WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"
# A document of this quality score or more counts as good.
GOOD = 0.3

URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the driver. Python workers of a local session find this package by the path."""
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([*filter(None, paths), ROOT])
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_groups(table(spark, sf_dir, "documents"))
    return groups.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(tokenizer_file(WORD_TOKENIZER), encoding="utf-8") as file:
        return round_trip(table(spark, sf_dir, "documents"), file.read())


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("copies")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of spans of each fixed pattern, and the places of these and of all spans."""
    found = secret_scan.scan(table(spark, sf_dir, "documents"))

    def count(kind: str):
        nth = secret_scan.KINDS.index(kind)
        return F.size(F.filter("base", lambda s: s["nth"] == nth)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, ("assign", "access", "hex")),
        F.sha2(secret_scan.joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        secret_scan.joined(F.col("spans")).alias("spans"),
    )


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = url_rules.rules_table(spark, URL_RULES)
    return url_rules.judge(table(spark, sf_dir, "pages"), rules)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model's own ids of every document, and the digest of what they decode to."""
    pieces = Pieces.of_file(tokenizer_file(PIECES))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decode(encode(docs, pieces).drop("text"), pieces).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids_crc32",
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op11_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = passages.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select(
        "doc_id", "held_out", "score", (F.col("score") >= GOOD).cast("int").alias("predicted"), "top_passage"
    )


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.clusters(table(spark, sf_dir, "embeddings"))
    listed = F.concat_ws(",", F.col("centroid").cast("array<string>"))
    return found.withColumn("centroid_sha256", F.sha2(listed.cast("binary"), 256)).drop("centroid")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizers = Tokenizers.of_files(tokenizer_file(BYTE_TOKENIZER), tokenizer_file(PIECES))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    return align(table(spark, sf_dir, "documents"), tokenizers, {"groups_sha256": digest}).documents


OP1_SQL = """
    select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
           doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
    from documents window same as (partition by coalesce(text, ''))
"""

OP6_SQL = r"""
    with rows as (
        select doc_id, source,
               cast(length(regexp_replace(regexp_replace(coalesce(text, ''),
                    '[^\x20\x09-\x0D]+', 'w', 'g'), '[\x20\x09-\x0D]+', '', 'g')) as bigint) as size,
               (cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), '')), 1, 13) as bigint) + 0.5::double)
                   / 4503599627370496::double as u
        from documents),
    sizes as (select source, cast(sum(size) as bigint) as source_size from rows group by source),
    ranked as (
        select *, case row_number() over (order by source nulls last) % 3
                       when 1 then 3 when 2 then 1 else 2 end as weight
        from sizes),
    levels as (
        select *, row_number() over (order by source_size::double / weight, source) as nth,
               (1.5::double * sum(source_size) over ()
                   - coalesce(sum(2 * source_size) over (
                         order by source_size::double / weight, source
                         rows between unbounded preceding and 1 preceding), 0))
                  / sum(weight) over (order by source_size::double / weight, source
                         rows between current row and unbounded following) as level
        from ranked),
    shares as (
        select source, source_size,
               case when 2 * source_size <= level * weight then (2 * source_size)::double
                    else weight * arg_min(level, nth) filter (2 * source_size > level * weight)
                                      over () end as target
        from levels),
    parts as (
        select *, least(floor(case when source_size > 0 then target / source_size else 0 end), 2) as whole
        from shares),
    drawn as (
        select r.*, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size as rest
        from rows r join parts p on r.source is not distinct from p.source),
    odds as (
        select *, u / (1 - u) / (share / (1 - share)) as rank
        from (select *, least(greatest(rest / greatest(source_size, 1)::double, 1e-9), 1 - 1e-9) as share
              from drawn)),
    summed as (
        select *, sum(size) over (partition by source
                                  order by rank, coalesce(doc_id, -9223372036854775808), size) as until
        from odds)
    select doc_id, size, source_size, target,
           cast(size * (whole + case when rest > 0 and (until <= rest
                or until - rest <= rest - (until - size)) then 1 else 0 end) as bigint) as taken
    from summed
"""

OP8_SQL = r"""
    with rules(rule_host, rule_path, rule_verdict) as (
        values ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
               ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
    rests as (
        select row_number() over () as nth, page_id,
               case when contains(url, '://') then substr(url, position('://' in url) + 3) else '' end as rest
        from pages),
    parts as (
        select nth, page_id,
               translate(regexp_extract(rest, '^[^/?#]*'),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
               regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
        from rests),
    fits as (
        select nth, arg_max(rule_host || rule_path, length(rule_host || rule_path)) as rule,
               arg_max(rule_verdict, length(rule_host || rule_path)) as verdict
        from parts join rules
          on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
        group by nth)
    select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict
    from parts left join fits using (nth)
"""

OP9_SQL = r"""
    with texts as (
        select row_number() over () as nth, doc_id, lang, source, coalesce(text, '') as text
        from documents),
    parts as (
        select nth, doc_id, lang, source, text,
               regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words,
               list_filter(string_split(text, chr(10)),
                           lambda line: regexp_matches(line, '[^\x20\x09-\x0D]')) as lines
        from texts),
    windows as (
        select nth, i, words[i:i + 2] as w
        from (select nth, words, unnest(range(1, len(words) - 1)) as i from parts where len(words) > 2)),
    twice as (
        select nth, i from windows
        qualify count(*) over (partition by nth, w) > 1),
    covered as (
        select nth, count(distinct i + k) as n_repeat_words
        from twice, (values (0), (1), (2)) as reach(k) group by nth),
    counted as (
        select p.nth, doc_id, lang, source, cast(len(words) as bigint) as n_words,
               cast(coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) as bigint) as word_chars,
               cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
               cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
               cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words,
               len(lines) as n_lines
        from parts p left join covered using (nth)),
    judged as (
        select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from counted),
    measures as (
        select nth, lang, source, base_failed, unnest([
            {'measure': 'word_length', 'margin': 3.0::double, 'value': word_chars / greatest(n_words, 1)::double},
            {'measure': 'symbols', 'margin': 0.15::double, 'value': n_symbols / greatest(word_chars, 1)::double},
            {'measure': 'dup_lines', 'margin': 0.3::double, 'value': n_dup_lines / greatest(n_lines, 1)::double},
            {'measure': 'repeats', 'margin': 0.3::double, 'value': n_repeat_words / greatest(n_words, 1)::double}],
            recursive := true)
        from judged),
    buckets as (
        select lang, source, measure, margin,
               case when value <= 0 then 0.0::double
                    else 2 / (1.02::double + 1) * pow(1.02::double, ceil(ln(value) / ln(1.02::double))) end as held
        from measures where not base_failed),
    own as (
        select lang, source, measure, margin, count(*) as size,
               quantile_disc(held, 0.25) as q1, quantile_disc(held, 0.75) as q3
        from buckets group by all),
    by_lang as (
        select lang, measure, margin, count(*) as size,
               quantile_disc(held, 0.25) as q1, quantile_disc(held, 0.75) as q3
        from buckets group by all),
    whole as (
        select measure, margin, quantile_disc(held, 0.25) as q1, quantile_disc(held, 0.75) as q3
        from buckets group by all),
    chosen as (
        select m.nth, m.value, m.margin,
               case when o.size >= 200 then o.q1 when l.size >= 200 then l.q1 else w.q1 end as q1,
               case when o.size >= 200 then o.q3 when l.size >= 200 then l.q3 else w.q3 end as q3
        from measures m
        left join own o on m.lang is not distinct from o.lang
                       and m.source is not distinct from o.source and m.measure = o.measure
        left join by_lang l on m.lang is not distinct from l.lang and m.measure = l.measure
        left join whole w on m.measure = w.measure),
    within as (
        select nth, bool_and(coalesce(value between q1 - greatest((q3 - q1) * 6, margin)
                                                and q3 + greatest((q3 - q1) * 6, margin), true)) as within
        from chosen group by nth)
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           not base_failed and within as kept
    from judged join within using (nth)
"""



def _op12_sql(rounds: int = centroids.ROUNDS) -> str:
    """Rounds one after the other: distances, nearest centroids, floors of the means."""
    parts = [
        """
    kept as materialized (
        select row_number() over () as nth, vec_id, embedding from embeddings
        where len(embedding) = 64
          and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))),
    comps as materialized (
        select nth, j, cast(floor(1024 * embedding[j]::double) as bigint) as x
        from kept, range(1, 65) as dims(j)),
    begun as (
        select nth, row_number() over (order by sha256('3:' || vec_id)) - 1 as c
        from kept qualify c < 8),
    c0 as materialized (select c, j, x from begun join comps using (nth))"""
    ]
    for r in range(rounds + 1):
        parts.append(f"""
    a{r} as materialized (
        select nth, arg_min(c, d * 8 + c) as c, min(d) as d
        from (select nth, c, cast(sum((v.x - m.x) * (v.x - m.x)) as hugeint) as d
              from comps v join c{r} m using (j) group by nth, c)
        group by nth)""")
        if r < rounds:
            parts.append(f"""
    c{r + 1} as materialized (
        select o.c, o.j, coalesce(m.x, o.x) as x
        from c{r} o left join (
            select c, j, cast((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) as bigint) as x
            from comps join a{r} using (nth) group by c, j) m using (c, j))""")
    return f"""
    with {",".join(parts)},
    named as (select c, sha256(string_agg(x::varchar, ',' order by j)) as centroid_sha256 from c{rounds} group by c)
    select vec_id, cast(c as integer) as cluster, cast(d as bigint) as distance,
           cast(sum(d) over (partition by c) as bigint) as cluster_inertia,
           cast(sum(d) over () as bigint) as inertia, centroid_sha256
    from a{rounds} join kept using (nth) join named using (c)
"""


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_exact_dedup,
        op2_toxicity,
        op3_near_dedup,
        op4_language,
        op5_token_files,
        op6_mixing,
        op7_secrets,
        op8_url_rules,
        op9_quality_rules,
        op10_pieces,
        op11_passages,
        op12_centroids,
        op13_alignment,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op1_exact_dedup": OP1_SQL,
    "op6_mixing": OP6_SQL,
    "op8_url_rules": OP8_SQL,
    "op9_quality_rules": OP9_SQL,
    "op12_centroids": _op12_sql(),
}
