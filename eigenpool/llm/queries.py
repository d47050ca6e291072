"""Registered queries of the numbered operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eigenpool.llm import (
    divergence, fill_middle, langid, licenses, minmax, mixing, packing, periodic_runs, secret_scan, simhash, surrogates, token_counts, toxicity,
)
from eigenpool.llm.common import documents, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return register


def _of(kind: str):
    return lambda span: span["kind"] == kind


@query()
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "copies")


@query()
def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    part = langid.remainder(F.col("doc_id"), 4)
    found = langid.identify(docs, langid.fit(docs.where(part != 2)))
    return found.select("doc_id", F.coalesce(part == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "ambiguous")


@query("""with recursive words as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as w from documents),
sets as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end as s from words),
one as (select min(doc_id) as node, list_sort(s) as s, len(s) as n from sets where len(s) > 0 group by 2, 3),
shingles as (select node, n, unnest(s) as x from one),
links as (
  select a.node as a, b.node as b from shingles a join shingles b on a.x = b.x and a.node <> b.node
    and 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  group by a.node, b.node, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach as (select node, node as root from one union select l.b, r.root from reach r join links l on l.a = r.node),
roots as (select node, min(root) as root from reach group by node)
select s.doc_id, len(s.s) as n_shingles, coalesce(r.root, s.doc_id) as component_id, s.doc_id = coalesce(r.root, s.doc_id) as kept
from sets s left join one o on list_sort(s.s) = o.s left join roots r on r.node = o.node""")
def op8_minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax.near_duplicates(documents(spark, sf_dir))


@query()
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir).select("doc_id", "text"), table(spark, "labels", sf_dir).select("doc_id", "toxic")
    part = langid.remainder(F.col("doc_id"), 3)
    model = toxicity.fit(docs.join(F.broadcast(toxicity.sample(labels.where(part != 1))), "doc_id"))
    found = toxicity.score(docs, model)
    return found.select("doc_id", F.coalesce(part == 1, F.lit(False)).alias("held_out"), "score", "predicted")


@query()
def op3_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.replace(documents(spark, sf_dir))


@query()
def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))[0].drop("row")


@query()
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.fingerprint(documents(spark, sf_dir))


@query()
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(documents(spark, sf_dir))


@query("""
with docs as (select doc_id, coalesce(text, '') as t from documents),
rules(kind, place, re, grp, least) as (values
  ('assign', 0, '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 8),
  ('access', 1, '(AKIA[A-Z0-9]+)', 1, 16),
  ('hex', 2, '([0-9a-f]{32,})', 1, 1),
  ('github', 3, '(gh[pousr]_[A-Za-z0-9]{36,})', 1, 1),
  ('slack', 4, '(xox[abprs]-[A-Za-z0-9-]{10,})', 1, 1),
  ('google', 5, '(AIza[0-9A-Za-z_-]{35})', 1, 1),
  ('jwt', 6, '(eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,})', 1, 1),
  ('pem', 7, '(-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----)', 1, 1)),
hits as (
  select doc_id, t, kind, place, least, regexp_extract_all(t, re, 0) as hit, regexp_extract_all(t, re, grp) as inner_hit, string_split_regex(t, re) as gap
  from docs, rules where regexp_matches(t, re)),
each as (select *, unnest(range(1, len(hit) + 1)) as i from hits),
spans as (
  select doc_id, t, kind, place, list_sum(list_transform(gap[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hit[1:i - 1], lambda x: length(x))), 0) as a,
    length(hit[i]) as n from each where length(inner_hit[i]) >= least),
found as (
  select doc_id, t, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access, count(*) filter (kind = 'hex') as n_hex,
    string_agg(kind || ':' || a::bigint || ':' || (a + n)::bigint, ',' order by a, place) as spans,
    string_agg(kind || ':' || a::bigint || ':' || (a + n)::bigint, ',' order by a, place) filter (place < 3) as base
  from (select distinct * from spans) group by doc_id, t)
select d.doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from docs d left join found f on f.doc_id is not distinct from d.doc_id and f.t = d.t
""")
def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(documents(spark, sf_dir), secret_scan.ledger_path(spark))
    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in secret_scan.BASE]))
    counts = [F.size(F.filter("spans", _of(r.kind))).cast("long").alias(f"n_{r.kind}") for r in secret_scan.BASE]
    return found.select("doc_id", *counts, F.sha2(secret_scan.listed(base), 256).alias("base_sha256"), secret_scan.listed(F.col("spans")).alias("spans"))


@query()
def op9_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.judge(documents(spark, sf_dir))


@query()
def op11_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count(documents(spark, sf_dir))


@query()
def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find(periodic_runs.looped(documents(spark, sf_dir)))
    best = periodic_runs.longest(F.col("runs"))
    found = found.withColumn("best", best).withColumn("exponent_milli", F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long"))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", "exponent_milli",
        F.sha2(periodic_runs.listed(F.col("runs")), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query("""
with docs as (select doc_id, coalesce(text, '') as t, sha256('1:' || coalesce(doc_id::varchar, '')) as d from documents),
cut as (select doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') as u,
  ('0x' || d[1:8])::bigint as h1, ('0x' || d[9:16])::bigint as h2, ('0x' || d[17:24])::bigint as h3, ('0x' || d[25:32])::bigint as h4 from docs),
placed as (select *, len(u)::bigint as n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) as a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) as b from cut),
parts as (select *, array_to_string(u[1:a], '') as p, array_to_string(u[a + 1:b], '') as m, array_to_string(u[b + 1:], '') as s,
  case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain'
    when h4 % 100 < 20 then 'spm' else 'psm' end as form from placed)
select doc_id, n, form, case when form <> 'plain' then length(p)::bigint end as prefix_chars, case when form <> 'plain' then length(m)::bigint end as middle_chars,
  sha256(case form when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m when 'spm' then '<S>' || s || '<P>' || p || '<M>' || m else t end) as output_sha256,
  sha256(t) as restored_sha256
from parts
""")
def op13_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.transform(documents(spark, sf_dir))
    restored = fill_middle.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored, 256).alias("restored_sha256"))
