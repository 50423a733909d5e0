"""The registered queries of the operators, each over its whole table.

A query derives the digest columns of its contract from the operator's real
output (spans, items, pieces); the work is the operator's.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (
    bestfit_packing,
    decontaminate,
    html_extract,
    jaccard_join,
    language_id,
    license_scan,
    pii_crf,
    quality_rules,
    suffix_dedup,
    toxicity,
    url_filter,
    va_clusters,
    whitening,
)
from tessera.llm.rowwise import ROW, unpacked
from tessera.llm.session import ready, tokenizer_path
from tessera.sources.tables import read_table
from tessera.util import ensure_checkpoint_dir


def fold(n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(n))


def op1_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    got = jaccard_join.jaccard_components(read_table(spark, sf_dir, "documents"), n=3, num=90, den=100, count_links=False)
    return got.select("doc_id", "n_shingles", "component_id")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(fold(5) != 0))
    got = unpacked(toxicity.score(docs.select("doc_id", "text"), model), "score")
    return got.select(
        "doc_id", (fold(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def _joined(spans: str) -> Column:
    line = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, line), ",")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    got = unpacked(pii_crf.pii_spans(read_table(spark, sf_dir, "documents")), "spans", "base")
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return got.select(
        "doc_id",
        *[count(k) for k in pii_crf.BASE_KINDS],
        F.sha2(_joined("base"), 256).alias("base_sha256"),
        _joined("spans").alias("spans"),
    )


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return unpacked(html_extract.extract(read_table(spark, sf_dir, "pages")), "text", "n_chars")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    book = quality_rules.apply_policy(quality_rules.ledger(read_table(spark, sf_dir, "documents")))
    base = quality_rules.rejects(quality_rules.POLICIES["base"]).alias("base_failed")
    return book.select(
        f"{ROW}.doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base,
        "kept",
        F.col("failed").cast("long").alias("failed_rules"),
    )


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = license_scan.scan(read_table(spark, sf_dir, "documents"))
    return got.select(
        F.col("id").alias("doc_id"), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    got = suffix_dedup.dedup(read_table(spark, sf_dir, "documents"))
    n_spans = F.size("spans").cast("long").alias("n_spans")
    return got.select(f"{ROW}.doc_id", "n_bytes", "n_removed", n_spans, "kept_sha256")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    docs = read_table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(fold(4) != 2))
    got = unpacked(language_id.identify(docs.select("doc_id", "text"), model), "lang_pred", "score", "spans")
    return got.select(
        "doc_id",
        (fold(4) == 2).alias("held_out"),
        "lang_pred",
        "score",
        F.size("spans").cast("long").alias("n_spans"),
    )


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    docs, items = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    got = decontaminate.decontaminate(docs, items)
    return got.select(
        f"{ROW}.doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    got = bestfit_packing.best_fit_pack(read_table(spark, sf_dir, "documents"), tokenizer_path())
    return unpacked(got, "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


#: host, path and verdict of the query's rules
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op11_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    got = url_filter.judge(pages, spark.createDataFrame(URL_RULES, "host string, path string, verdict string"))
    return got.select(f"{ROW}.page_id", "host", "path", "rule", "verdict")


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    ensure_checkpoint_dir(spark)
    got, centroids = va_clusters.clusters(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    got = va_clusters.report(got.select(f"{ROW}.vec_id", "cluster", "distance").checkpoint(), centroids)
    return got.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    got = whitening.whiten(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return unpacked(got, "component", "n", "deviation", "whitened", "explained", "identity_error")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_jaccard,
        op2_toxicity,
        op3_pii,
        op4_html,
        op5_quality,
        op6_licenses,
        op7_suffix_dedup,
        op8_language,
        op9_decontaminate,
        op10_packing,
        op11_urls,
        op12_clusters,
        op13_whitening,
    )
}

#: words of a text, as DuckDB lists
_PLAIN_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_ALNUM_WORDS = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

#: k-means with exact integers; three rounds and the last assignment, written out
_ASSIGN = """
), a{0} as (
  select r, arg_min(c, d * 64 + c) as c, min(d) as d from (
    select x.r, m.c, list_sum(list_transform(range(1, 65), lambda i: (x.v[i] - m.v[i]) * (x.v[i] - m.v[i])))::hugeint as d
    from x, m{0} as m
  ) group by r
"""
_MOVE = """
), m{1} as (
  select m{0}.c, coalesce(t.v, m{0}.v) as v from m{0} left join (
    select c, list(((s - ((s % n) + n) % n) // n)::bigint order by i) as v from (
      select a{0}.c, i, sum(x.v[i]) as s, count(*) as n from x join a{0} using (r), (select unnest(range(1, 65)) as i)
      group by a{0}.c, i
    ) group by c
  ) as t using (c)
"""
_KMEANS = (
    """
with x as (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda e: floor(64 * e::double)::bigint) as v
  from embeddings where len(embedding) = 64 and len(list_filter(embedding, lambda e: e is not null and isfinite(e))) = 64
), m0 as (
  select (row_number() over (order by h, v)) - 1 as c, v from (
    select sha256('1:' || vec_id) as h, v from x where vec_id is not null order by h, v limit 16
  )
"""
    + "".join(_ASSIGN.format(k) + _MOVE.format(k, k + 1) for k in range(3))
    + _ASSIGN.format(3)
    + """
)
select vec_id, a3.c::int as cluster, d::bigint as distance, (sum(d) over (partition by a3.c))::bigint as cluster_inertia,
  (sum(d) over ())::bigint as inertia, sha256(array_to_string(m3.v, ',')) as centroid_sha256
from x join a3 using (r) join m3 using (c)
"""
)

ORACLES: dict[str, str] = {
    "op1_jaccard": r"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents
), s as (
  select distinct doc_id, array_to_string(w[i : i + least(len(w), 3) - 1], chr(31)) as g
  from (select doc_id, w, unnest(range(1, len(w) - least(len(w), 3) + 2)) as i from d where len(w) > 0)
), n as (
  select doc_id, count(*) as n from s group by doc_id
), pair as (
  select a.doc_id as x, b.doc_id as y, count(*) as k from s a join s b on a.g = b.g and a.doc_id <> b.doc_id
  group by 1, 2
), link as (
  select x, y from pair join n a on a.doc_id = x join n b on b.doc_id = y where 100 * k >= 90 * (a.n + b.n - k)
), reach as (
  select doc_id, doc_id as c from documents
  union
  select link.x, reach.c from reach join link on link.y = reach.doc_id
)
select reach.doc_id, any_value(coalesce(n.n, 0))::bigint as n_shingles, min(c) as component_id
from reach left join n using (doc_id) group by reach.doc_id
""",
    "op5_quality": rf"""
with d as (
  select row_number() over () as r, doc_id, coalesce(text, '') as t, {_PLAIN_WORDS} as w from documents
), windows as (
  select r, i, w[i] || chr(31) || w[i + 1] || chr(31) || w[i + 2] as g
  from (select r, w, unnest(range(1, len(w) - 1)) as i from d)
), twice as (
  select r, i from windows qualify count(*) over (partition by r, g) >= 2
), repeated as (
  select r, count(distinct i + j) as n from twice, (select unnest([0, 1, 2]) as j) group by r
), line as (
  select r, unnest(string_split(t, chr(10))) as l from d
), lines as (
  select r, count(*) as n, count(*) - count(distinct l) as dup
  from line where regexp_matches(l, '[^\x20\x09-\x0D]') group by r
), m as (
  select d.doc_id, len(w) as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]')) as n_symbols, coalesce(lines.n, 0) as n_lines,
    coalesce(lines.dup, 0) as n_dup_lines, coalesce(repeated.n, 0) as n_repeat_words,
    len(regexp_extract_all(t, '\|')) as n_bars,
    octet_length(encode(regexp_replace(t, '[\x00-\x40\x5B-\x60\x7B-\x7F]', '', 'g')))
      - length(regexp_replace(t, '[\x00-\x7F]', '', 'g'))
      - coalesce(len(regexp_extract_all(t, '[\x{{800}}-\x{{FFFF}}]')), 0)
      - 2 * coalesce(len(regexp_extract_all(t, '[\x{{10000}}-\x{{10FFFF}}]')), 0) as n_letters
  from d left join repeated using (r) left join lines using (r)
), f as (
  select *, (n_words < 50)::int + 2 * (100 * n_repeat_words > 50 * n_words)::int
    + 4 * (100 * n_symbols > 30 * n_words)::int + 8 * (100 * n_bars > 30 * n_words)::int
    + 16 * (100 * n_dup_lines > 50 * n_lines and n_lines >= 4)::int + 32 * (word_chars > 25 * n_words)::int
    + 64 * (100 * n_letters < 30 * word_chars)::int as failed from m
)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
  n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words, (failed & 3) <> 0 as base_failed,
  (failed & 119) = 0 as kept, failed::bigint as failed_rules
from f
""",
    "op9_decontaminate": rf"""
with d as (
  select row_number() over () as r, doc_id, {_ALNUM_WORDS} as w from documents
), item as (
  select item_id, {_ALNUM_WORDS} as w from benchmark
), pattern as (
  select distinct item_id, n, array_to_string(w[i : i + n - 1], ' ') as g
  from (select item_id, w, least(len(w), 10) as n, unnest(range(1, len(w) - least(len(w), 10) + 2)) as i
        from item where len(w) > 0)
), size as (
  select distinct n from pattern
), run as (
  select r, n, i, array_to_string(w[i : i + n - 1], ' ') as g
  from (select r, w, n, unnest(range(1, len(w) - n + 2)) as i from d, size)
), hit as (
  select r, run.n, i, item_id from run join pattern on run.n = pattern.n and run.g = pattern.g
), words as (
  select r, count(distinct p) as n from (select r, unnest(range(i, i + n)) as p from hit) group by r
), items as (
  select r, count(distinct item_id) as n, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as s
  from hit group by r
)
select doc_id, len(w)::bigint as n_words, coalesce(words.n, 0)::bigint as n_hit, coalesce(items.n, 0)::bigint as n_items,
  sha256(coalesce(items.s, '')) as items_sha256, coalesce(words.n, 0) > 0 as contaminated
from d left join words using (r) left join items using (r)
""",
    "op11_urls": r"""
with u as (
  select page_id, case when instr(coalesce(url, ''), '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest
  from pages
), p as (
  select row_number() over () as r, page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from u
), rules (h, s, v) as (
  values ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), best as (
  select r, arg_max(h || s, length(h || s)) as rule, arg_max(v, length(h || s)) as v
  from p join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, s) group by r
)
select page_id, host, path, rule, coalesce(v, 'allow') as verdict from p left join best using (r)
""",
    "op12_clusters": _KMEANS,
}
