"""The registered corpus queries ``opN_<name>``: each operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm import langid, pii, quality
from lodestar.llm.common import read_table, shuffle_width, staged, word_count
from lodestar.llm.embed_dedup import near_duplicate_vectors
from lodestar.llm.hard_negatives import hard_negatives
from lodestar.llm.license_scan import scan_licenses
from lodestar.llm.merkle import audit
from lodestar.llm.minhash import fingerprint_report
from lodestar.llm.mixing import curriculum
from lodestar.llm.packing import pack_documents
from lodestar.llm.sharding import balanced_shards
from lodestar.llm.simhash import near_duplicates
from lodestar.llm.token_count import token_counts

TOKENIZER = "byte_bpe_50k.json"


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read_table(spark, sf_dir, "documents"))


def op2_balanced_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = balanced_shards(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op3_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op4_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(docs, public_tokenizers.path(TOKENIZER)).drop("text")


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(read_table(spark, sf_dir, "embeddings"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, read_table(spark, sf_dir, "labels"))
    return quality.scored(docs, model).select(
        "doc_id", (quality.fold(F.col("doc_id"), quality.FOLDS) == quality.HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= quality.CUT).cast("int").alias("predicted"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = docs.select("doc_id", langid.language(F.col("text"), langid.fit(docs)).alias("found"))
    return found.select(
        "doc_id", (quality.fold(F.col("doc_id"), langid.FOLDS) == langid.HELD_OUT).alias("held_out"),
        F.col("found.lang").alias("lang_pred"), "found.score", "found.languages")


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    mixed = curriculum(staged(docs, "mix-sizes"), F.col("size"))
    parts = shuffle_width(spark)
    out = mixed.select("doc.doc_id", "size", "source_size", "target", "taken",
                       F.try_element_at("positions", F.lit(1)).alias("position"), "key")
    # documents that are not taken follow in the order of their hash
    late = F.lit(1.0) + F.conv(F.substring("key", 1, 8), 16, 10).cast("double")
    return (out.repartitionByRange(parts, F.coalesce("position", late), "key")
            .sortWithinPartitions(F.coalesce("position", late), "key").drop("key"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_report(read_table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", label), F.col("vec_id") % 50 == 0)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row checked against the manifest; rows whose id's CRC 7 divides are presented with n_chars + 1."""
    return audit(read_table(spark, sf_dir, "documents"), {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1},
                 F.crc32(F.col("doc_id").cast("string")) % 7 == 0)


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest are of the patterns' spans; ``spans`` and ``n_learned`` hold the network's, too."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = docs.select("doc_id", pii.personal_data(F.col("text"), pii.train(docs)).alias("all"))
    base = F.filter("all", lambda s: ~s["learned"])
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [F.size(F.array_remove(kinds, other)) for other in pii.KINDS]
    counts = [(F.size("base") - n).cast("long").alias(f"n_{kind}") for n, kind in zip(counts, pii.KINDS)]
    return found.withColumn("base", base).select(
        "doc_id", *counts, F.sha2(pii.span_text(F.col("base")), 256).alias("base_sha256"),
        pii.span_text(F.col("all")).alias("spans"), (F.size("all") - F.size("base")).cast("long").alias("n_learned"))


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_balanced_shards": op2_balanced_shards,
    "op3_pack": op3_pack,
    "op4_token_count": op4_token_count,
    "op5_embedding_dedup": op5_embedding_dedup,
    "op6_quality": op6_quality,
    "op7_language": op7_language,
    "op8_simhash_dedup": op8_simhash_dedup,
    "op9_mix": op9_mix,
    "op10_minhash": op10_minhash,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_personal_data": op13_personal_data,
}

ORACLE: dict[str, str] = {
    "op5_embedding_dedup": """
with recursive v as (
  select vec_id, list_transform(embedding, lambda x: x::double) as e from embeddings
  where len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
u as (select *, sqrt(list_dot_product(e, e)) as norm from v),
l as (select a.vec_id as a, b.vec_id as b from u a join u b on a.vec_id <> b.vec_id and len(a.e) = len(b.e)
      where list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.9),
r as (select vec_id as id, vec_id as reached from embeddings union select r.id, l.b from r join l on l.a = r.reached),
c as (select id, min(reached) as component_id from r group by id),
n as (select a as id, count(*) as n_links from l group by a)
select vec_id, coalesce(n_links, 0) as n_links, component_id, vec_id = component_id as kept
from embeddings left join c on c.id = vec_id left join n on n.id = vec_id""",
    "op9_mix": r"""
with d as (select doc_id, source, md5(coalesce(cast(doc_id as varchar), '')) as key,
                  cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size
           from documents),
s as (select source, cast(sum(size) as bigint) as source_size from d group by source),
n as (select *, row_number() over (order by source asc nulls last) - 1 as no from s),
w as (select *, (case no % 3 when 0 then 5 when 1 then 2 else 1 end)::double as weight,
             (case no % 3 when 0 then 0 when 1 then 0.5 else -0.5 end)::double as tilt,
             3::double * source_size as most from n),
f as (select *, (sum(source_size) over () - coalesce(sum(most) over (order by most / weight, no
               rows between unbounded preceding and 1 preceding), 0))
             / sum(weight) over (order by most / weight, no rows between current row and unbounded following) as level
      from w),
l as (select level from f where most / weight >= level order by most / weight, no limit 1),
t as (select f.* exclude (level), least(most, l.level * weight) as target from f, l),
x as (select d.*, source_size, target, tilt, d.size * 64 > source_size as large
      from d join t on d.source is not distinct from t.source),
c as (select *, coalesce(sum(size) over (partition by source, large order by key, doc_id, size
                  rows between unbounded preceding and 1 preceding), 0) as before,
             coalesce(sum(size) filter (large) over (partition by source), 0) as large_size from x),
g as (select *, case when source_size > 0 then target * large_size / source_size else 0 end as large_target from c),
h as (select *, (2 * before + size < 2 * large_target)::int + (2 * (large_size + before) + size < 2 * large_target)::int
             + (2 * (2 * large_size + before) + size < 2 * large_target)::int as large_copies from g),
k as (select *, greatest(0, least(target - coalesce(sum(size * large_copies) filter (large) over (partition by source), 0),
                                  3 * (source_size - large_size)))::double as small_target,
             source_size - large_size as small_size from h),
m as (select *, case when large then large_copies else (2 * before + size < 2 * small_target)::int
               + (2 * (small_size + before) + size < 2 * small_target)::int
               + (2 * (2 * small_size + before) + size < 2 * small_target)::int end as copies,
             before::double / case when large then large_target else small_target end as u from k)
select doc_id, size, source_size, target, cast(size * copies as bigint) as taken,
       case when copies > 0 then least(1, round(2 * u / ((1 - tilt) + sqrt((1 - tilt) * (1 - tilt) + 4 * tilt * u)), 9)) end
         as position
from m""",
    "op11_hard_negatives": r"""
with v as (select vec_id, case when vec_id % 7 = 0 then (label::bigint + 1) % 10 else label end as label,
        list_transform(embedding, lambda x: floor(256 * x::double)) as q from embeddings
   where vec_id is not null and label is not null and embedding is not null
     and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as same, list_dot_product(a.q, b.q)::bigint as score
      from v a join v b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id),
p as (select * from s where same qualify row_number() over (partition by anchor_id order by score desc, id) <= 5),
n as (select p.anchor_id, p.id as positive_id, p.score as positive_score, s.id as negative_id, s.score as negative_score,
        row_number() over (partition by p.anchor_id, p.id order by s.score desc, s.id)::int as rank
      from p join s on s.anchor_id = p.anchor_id and not s.same
       and 50 * p.score <= 100 * s.score and 100 * s.score <= 95 * p.score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from n where rank <= 3""",
    "op12_merkle_manifest": r"""
with recursive crc_table as (
  select list(list_reduce(list_concat([b], range(8)), lambda c, x: case when c & 1 = 1
         then xor(c >> 1, 3988292384) else c >> 1 end) order by b) as crc from (select unnest(range(256)) as b)),
d as (select *, concat(case when doc_id is null then '-' else strlen(doc_id::varchar) || ':' || doc_id end,
          case when source is null then '-' else strlen(source) || ':' || source end,
          case when lang is null then '-' else strlen(lang) || ':' || lang end) as head,
        case when text is null then '-' else strlen(text) || ':' || text end as tail,
        xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)),
            lambda a, b: xor(a >> 8, crc[(xor(a, b) & 255) + 1]))) % 7 = 0 as tampered
   from documents, crc_table),
l as (select doc_id, lang, tampered, sha256(concat(head, case when n_chars is null then '-' else strlen(n_chars::varchar) || ':' || n_chars end, tail)) as leaf,
        sha256(concat(head, case when n_chars is null then '-' else strlen((n_chars + 1)::varchar) || ':' || (n_chars + 1) end, tail)) as altered from d),
r as (select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as pos,
        count(*) over (partition by lang) as n from l),
t as (select lang, 0 as lvl, pos, n, leaf as h from r
  union all
  select lang, lvl + 1, pos // 2, any_value((n + 1) // 2), sha256(string_agg(h, '' order by pos)) from t where n > 1
  group by lang, lvl, pos // 2),
s as (select lang, h as subroot, row_number() over (order by lang nulls first) - 1 as pos, count(*) over () as n from t where n = 1),
u as (select 0 as lvl, pos, n, subroot as h from s
  union all
  select lvl + 1, pos // 2, any_value((n + 1) // 2), sha256(string_agg(h, '' order by pos)) from u where n > 1 group by lvl, pos // 2),
f as (select doc_id, lang, leaf, 0 as lvl, pos, pos as place, n, '' as proof, case when tampered then altered else leaf end as h from r
  union all
  select f.doc_id, f.lang, f.leaf, f.lvl + 1, f.pos // 2, f.place, (f.n + 1) // 2, f.proof || coalesce(t.h, ''),
         sha256(case when f.pos % 2 = 1 then t.h || f.h else f.h || coalesce(t.h, '') end)
  from f left join t on t.lang is not distinct from f.lang and t.lvl = f.lvl and t.pos = xor(f.pos, 1)
  where f.n > 1),
g as (select f.doc_id, f.leaf, s.subroot, 0 as lvl, s.pos, s.n, f.proof, f.h from f join s on s.lang is not distinct from f.lang
      where f.n = 1
  union all
  select g.doc_id, g.leaf, g.subroot, g.lvl + 1, g.pos // 2, (g.n + 1) // 2, g.proof || coalesce(u.h, ''),
         sha256(case when g.pos % 2 = 1 then u.h || g.h else g.h || coalesce(u.h, '') end)
  from g left join u on u.lvl = g.lvl and u.pos = xor(g.pos, 1) where g.n > 1)
select doc_id, leaf, subroot, u.h as root, sha256(proof) as proof_sha256, g.h as folded_root, g.h = u.h as verified
from g, u where g.n = 1 and u.n = 1""",
}
