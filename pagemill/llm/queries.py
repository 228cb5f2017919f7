"""The queries op1 to op13 and pipeline over the tables of a data folder, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audit, decontaminate, infill, languages, packing, quality, restaurants, secrets, simhash, substrings, suffixes, vectors, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, ("assign", "access", "hex")), F.sha2(secrets.joined_spans(base).cast("binary"), 256).alias("base_sha256"), secrets.joined_spans("spans").alias("spans"))


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeated_bytes(table(spark, sf_dir, "documents"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def op5_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_read(table(spark, sf_dir, "pages")).drop("block")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeated_words(table(spark, sf_dir, "documents"))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def fold(id_col: str, of: int) -> Column:
    """crc32 of an id as text, modulo ``of``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % of


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), learn=fold("id", 5) != 0)
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = languages.fit(docs.where(fold("doc_id", 3) != 1))
    found = languages.identify(docs.select("doc_id", "text"), model, spans=False)
    return found.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vectors.link_vectors(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "n_links", F.col("component").alias("component_id"), (F.col("vec_id") == F.col("component")).alias("kept"))


def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null id draws as an empty one, which is learned from."""
    learn = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 != 2
    return restaurants.score_texts(table(spark, sf_dir, "documents"), learn)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    def digest(text: Column) -> Column:
        return F.sha2(text.cast("binary"), 256)

    cut = infill.fill_in_middle(table(spark, sf_dir, "documents"))
    again = infill.restored(F.col("output"), F.col("form"))
    return cut.select("doc_id", "n", "form", F.length("prefix").cast("long").alias("prefix_chars"), F.length("middle").cast("long").alias("middle_chars"), digest(F.col("output")).alias("output_sha256"), digest(again).alias("restored_sha256"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (op1_secret_scan, op2_suffix_array_dedup, op3_best_fit_packing, op4_simhash_near_dedup, op5_warc_archive, op6_substring_dedup, op7_benchmark_decontamination, op8_quality_classifier, op9_language_id, op10_embedding_near_dedup, op11_lm_scoring, op12_fill_in_middle, op13_filter_audit)}


def _spans_sql() -> str:
    """SQL of all spans (doc_id, k, kind, x, y) of the rules: matches and the gaps between them give their places."""
    # Fixed patterns: the rules as the other engine's expressions, spelled out again.
    assign = """(?i:password|passwd|secret|token|api_?key)["']?\\x20*[:=]\\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    kinds = (
        ("assign", assign.replace("'", "''"), 1, 6), ("access", "AKIA[A-Z0-9]+", 0, 20), ("hex", "[0-9a-f]+", 0, 24), ("pem", "-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----[A-Za-z0-9+/=\\s]+-----END (?:[A-Z]+ )*PRIVATE KEY-----", 0, 1),
        ("jwt", "eyJ[A-Za-z0-9_-]{8,}\\.eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}", 0, 1), ("forge", "gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    )
    each = " union all ".join(f"select doc_id, {k} as k, '{kind}' as kind, {least} as least, regexp_extract_all(text, '{p}') as m, regexp_extract_all(text, '{p}', {group}) as g, regexp_split_to_array(text, '{p}') as gap from t" for k, (kind, p, group, least) in enumerate(kinds))
    return f"""t as (select doc_id, coalesce(text, '') as text from documents), found as ({each}),
 flat as (select doc_id, k, kind, least, unnest(m) as m, unnest(g) as g, unnest(gap[1:len(m)]) as gap, generate_subscripts(m, 1) as i from found where len(m) > 0),
 placed as (select *, sum(length(gap)) over w + sum(length(m)) over w - length(m) as x from flat window w as (partition by doc_id, k order by i)),
 spans as (select doc_id, k, kind, x::bigint as x, (x + length(m))::bigint as y from placed where length(g) >= least)"""


_JOINED = "string_agg(kind || ':' || x || ':' || y, ',' order by x, k)"

#: What SQL can say; the others rest on fingerprints, models, tokens or 400-byte strings and have brute-force tests.
ORACLE_SQL: dict[str, str] = {
    "op1_secret_scan": f"""with {_spans_sql()} select t.doc_id, count(*) filter (where kind = 'assign') as n_assign, count(*) filter (where kind = 'access') as n_access, count(*) filter (where kind = 'hex') as n_hex,
 sha256(coalesce({_JOINED} filter (where k < 3), '')) as base_sha256, coalesce({_JOINED} filter (where kind is not null), '') as spans from t left join spans using (doc_id) group by t.doc_id""",
    "op5_warc_archive": """with d as (select page_id, strlen(coalesce(html, ''))::bigint as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages),
 f as (select payload_digest, min(page_id) as first from d where payload_bytes >= 100 group by 1)
 select page_id, payload_bytes, payload_digest, case when page_id > first then 'revisit' else 'response' end as record_type, case when page_id > first then first end as refers_to from d left join f using (payload_digest)""",
    "op6_substring_dedup": r"""with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents), p as (select doc_id, len(words) as n, unnest(words) as word, generate_subscripts(words, 1) as i from w),
 s as (select *, case when i + 49 <= n then md5(string_agg(word, ' ') over (partition by doc_id order by i rows between current row and 49 following)) end as win from p), f as (select win, min(doc_id) as first from s where win is not null group by win),
 c as (select s.doc_id, i, word, max((coalesce(f.first < s.doc_id, false))::int) over (partition by s.doc_id order by i rows between 49 preceding and current row) as gone from s left join f using (win)),
 g as (select doc_id, count(*) as n_words, sum(gone)::bigint as n_removed, string_agg(word, ' ' order by i) filter (where gone = 0) as kept from c group by doc_id)
 select w.doc_id, coalesce(n_words, 0) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256 from w left join g using (doc_id)""",
    "op10_embedding_near_dedup": """with recursive v as (select vec_id, embedding::double[] as e from embeddings), ok as (select * from v where e is not null and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(e, lambda x: x <> 0)) > 0),
 l as (select a.vec_id as a, b.vec_id as b from ok a join ok b on a.vec_id <> b.vec_id and len(a.e) = len(b.e) and list_cosine_similarity(a.e, b.e) >= 0.95), r(n, c) as (select vec_id, vec_id from v union select l.b, r.c from r join l on l.a = r.n)
 select vec_id, (select count(*) from l where l.a = vec_id) as n_links, (select min(c) from r where n = vec_id) as component_id, (select min(c) from r where n = vec_id) = vec_id as kept from v""",
    "op12_fill_in_middle": r"""with t as (select doc_id, coalesce(text, '') as text, sha256('7:' || coalesce(doc_id::varchar, '')) as h from documents),
 u as (select *, regexp_extract_all(text, '[^\n]*\n|[^\n]+') as units, [('0x' || h[1 + 8 * k : 8 + 8 * k])::bigint for k in range(4)] as d from t),
 c as (select *, len(units)::bigint as n, least(d[1] % (len(units) + 1), d[2] % (len(units) + 1)) as lo, greatest(d[1] % (len(units) + 1), d[2] % (len(units) + 1)) as hi from u),
 f as (select *, case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or d[3] % 100 >= 100 then 'plain' when d[4] % 100 < 50 then 'spm' else 'psm' end as form,
  array_to_string(units[1:lo], '') as pre, array_to_string(units[lo + 1 : hi], '') as mid, array_to_string(units[hi + 1 :], '') as suf from c)
 select doc_id, n, form, case when form <> 'plain' then length(pre) end as prefix_chars, case when form <> 'plain' then length(mid) end as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid else '<S>' || suf || '<P>' || pre || '<M>' || mid end) as output_sha256, sha256(text) as restored_sha256 from f""",
    "op13_filter_audit": r"""with recursive t as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as text from documents), w as (select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words, min(doc_id) over (partition by text) as first from t),
 l as (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by 1),
 d as (select part, (case when len(words) < 200 then 'A' else '' end) || (case when 100 * list_unique(words) < 50 * len(words) then 'B' else '' end) || (case when 100 * len(regexp_extract_all(text, '[A-Z]')) > 2 * length(text) then 'C' else '' end)
  || (case when regexp_matches(text, '[#$%&*|]') then 'D' else '' end) || (case when doc_id > first then 'E' else '' end) as fails, coalesce(good, false) as good, coalesce(toxic, false) as toxic from w left join l using (doc_id)),
 g as (select part, fails, count(*) as n, count(*) filter (where good) as good, count(*) filter (where toxic) as toxic from d group by all),
 o(ord) as (select '' union all select ord || f from o, unnest(['A', 'B', 'C', 'D', 'E']) as x(f) where not contains(ord, f)), p as (select ord, unnest(range(1, 6))::int as step from o where length(ord) = 5),
 e as (select part, ord, step, n, good, toxic, fails, contains(fails, ord[step]) as fail, len(list_filter(string_split(ord[1 : step - 1], ''), lambda f: f <> '' and contains(fails, f))) > 0 as gone from g, p),
 r as (select part, ord, step, sum(case when fail or gone then 0 else n end) as kept, sum(case when fail and not gone then n else 0 end) as removed, sum(case when fail and gone then n else 0 end) as redundant, sum(case when fails = ord[step] then n else 0 end) as unique_fails,
  sum(case when fail and not gone then good else 0 end) as good_lost, sum(case when fail and not gone then toxic else 0 end) as toxic_lost from e group by all),
 s as (select part, ord[step] as f, sum(removed) as shapley from r group by all)
 select r.part, r.ord as filter_order, step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant, unique_fails::bigint as unique_fails, good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost, shapley::bigint as shapley from r join s on s.part = r.part and s.f = r.ord[step]""",
}
