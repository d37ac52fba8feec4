"""The registered queries: thin wrappers that put the operators on the test
tables and reduce their results to the columns asked for."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhawk.llm.catalog import query
from tallyhawk.llm.common import table


@query("op6_mixing", r"""
with s as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
         md5(coalesce(doc_id::varchar, '')) as digest from documents),
t as (select source, sum(size)::bigint as source_size,
             (row_number() over (order by source nulls last) - 1) % 3 as place from s group by source),
c as (select *, 2 * source_size as cap, case place when 0 then 5 when 1 then 2 else 1 end as weight,
             row_number() over (order by source nulls last) as nth from t),
l as (select *, (sum(source_size) over () * 1.5::double
                 - coalesce(sum(cap) over (order by cap::double / weight, nth rows between unbounded preceding and 1 preceding), 0))
             / (sum(weight) over ()
                - coalesce(sum(weight) over (order by cap::double / weight, nth rows between unbounded preceding and 1 preceding), 0))
             as level from c),
g as (select source, source_size, least(cap::double, weight * max(level) over ()) as target,
             ('0x' || substr(md5('7:' || coalesce('s' || source, 'n')), 1, 8))::bigint::double / 4294967296.0 as u from l),
r as (select s.doc_id, s.size, g.source_size, g.target, g.u,
             row_number() over (partition by s.source order by s.size, s.digest, s.doc_id nulls first) as k
      from s join g on s.source is not distinct from g.source)
select doc_id, size, source_size, target,
       (size * case when source_size = 0 then 0 when target >= 2 * source_size then 2
             else floor(k * target / source_size + u) - floor((k - 1) * target / source_size + u) end)::bigint as taken
from r""")
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyhawk.llm.mixing import with_copies
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    out, c = with_copies(docs)
    return out.select("doc_id", F.col(c["size"]).alias("size"), F.col(c["source_size"]).alias("source_size"),
                      F.col(c["target"]).alias("target"),
                      (F.col(c["size"]) * F.col(c["copies"])).alias("taken"))


@query("op4_urls", r"""
with u as (select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
p as (select page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from u),
g as (select doc_id as page_id, min(quality) as good from labels where doc_id is not null and quality is not null group by 1),
h as (select host, count(good) as n, coalesce(sum(good), 0)::bigint as good,
             regexp_extract(host, '([^.]*\.[^.]*)$', 1) in ('co.uk', 'org.uk', 'ac.uk', 'com.au', 'com.br', 'co.jp', 'co.in', 'co.nz') as long
      from p left join g using (page_id) group by host),
hh as (select host, n, good, case when long then regexp_extract(host, '((?:[^.]*\.){0,2}[^.]*)$', 1) else regexp_extract(host, '((?:[^.]*\.)?[^.]*)$', 1) end as domain,
              case when long then regexp_extract(host, '([^.]*\.[^.]*)$', 1) else regexp_extract(host, '([^.]*)$', 1) end as suffix from h),
d0 as (select domain, suffix, sum(n) as n, sum(good) as good from hh group by 1, 2),
s0 as (select suffix, sum(n) as n, sum(good) as good from d0 group by 1),
s1 as (select *, (select (coalesce(sum(good), 0) + 1)::double / (coalesce(sum(n), 0) + 2) from s0) as prior from s0),
s2 as (select sum(case when n > 0 then (good - n * prior) * (good - n * prior) / n - prior * (1 - prior) end) as ov,
              sum(case when n > 0 then prior * (1 - prior) * (n - 1) end) as sc from s1),
s3 as (select 1 / coalesce(case when sc > 0 then greatest(0.001, least(0.999, ov / sc)) end, 0.5) - 1 as k from s2),
s4 as (select suffix, (good + k * prior) / (n + k) as prior from s1, s3),
d1 as (select d0.*, s4.prior from d0 join s4 using (suffix)),
d2 as (select sum(case when n > 0 then (good - n * prior) * (good - n * prior) / n - prior * (1 - prior) end) as ov,
              sum(case when n > 0 then prior * (1 - prior) * (n - 1) end) as sc from d1),
d3 as (select 1 / coalesce(case when sc > 0 then greatest(0.001, least(0.999, ov / sc)) end, 0.5) - 1 as k from d2),
d4 as (select domain, suffix, (good + k * prior) / (n + k) as prior from d1, d3),
h1 as (select hh.*, d4.prior from hh join d4 using (domain, suffix)),
h2 as (select sum(case when n > 0 then (good - n * prior) * (good - n * prior) / n - prior * (1 - prior) end) as ov,
              sum(case when n > 0 then prior * (1 - prior) * (n - 1) end) as sc from h1),
h3 as (select 1 / coalesce(case when sc > 0 then greatest(0.001, least(0.999, ov / sc)) end, 0.5) - 1 as k from h2),
h4 as (select host, n, k, (good + k * prior) / (n + k) as mean from h1, h3),
h5 as (select host, least(1.0, mean + 1.645 * sqrt(mean * (1 - mean) / (n + k + 1))) as upper from h4)
select page_id, host, path,
       case when (host = 'www.example.com' or ends_with(host, '.www.example.com')) and starts_with(path, '/en/') then 'www.example.com/en/'
            when (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/en/') then 'example.com/en/'
            when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/es/') then 'net/es/'
            when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/fr/') then 'net/fr/'
            when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/') then 'com/' end as rule,
       case rule when 'www.example.com/en/' then 'allow' when 'com/' then 'allow' when 'example.com/en/' then 'block'
                 when 'net/es/' then 'block' when 'net/fr/' then 'block'
                 else case when upper < 0.85 then 'block' else 'allow' end end as verdict
from p join h5 using (host)""")
def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome of a page: the quality label with the page's id."""
    from tallyhawk.llm.urls import filter_urls
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.col("quality").alias("good"))
    return filter_urls(table(spark, sf_dir, "pages"), labels).select("page_id", "host", "path", "rule", "verdict")


@query("op9_chat", r"""
with c as (
  select conv_id, turn, role, text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
t as (select conv_id, turn, role as r0, text as t0, coalesce(role, '') as role, coalesce(text, '') as text from c),
f as (select *, '### ' || replace(replace(replace(replace(role, '\', '\b'), '#', '\h'), '<', '\l'), ':', '\c') || ': '
             || replace(replace(replace(text, '\', '\b'), '#', '\h'), '<', '\l') || '</turn>' || chr(10) as fmt from t)
select conv_id, count(*)::bigint as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
       sum(length(fmt))::bigint as formatted_chars
from f group by conv_id""")
def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyhawk.llm.chat import format_chats, read_turn, unescape
    odd = "\\### Assistant: </turn> ok"
    chats = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    chats = chats.unionByName(spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)], chats.schema))
    nodes, members = format_chats(chats)
    role, text = read_turn(F.col("content"))
    loss = F.when(F.col("loss_start").isNotNull(), unescape(F.substr(
        F.col("content"), (F.col("loss_start") - F.col("start") + 1).cast("int"),
        (F.col("loss_end") - F.col("loss_start")).cast("int"))))
    read = nodes.select("node_id", F.concat(role, F.lit("\n"), text, F.lit("\n")).alias("said"),
                        F.coalesce(loss, F.lit("")).alias("loss"), (F.col("end") - F.col("start")).alias("len"))
    turns = members.join(read, "node_id").select("conv_id", "turn", "said", "loss", "len")
    return (turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn")
            .mapInArrow(chat_digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                      "loss_sha256 string, formatted_chars long"))


def chat_digests(batches):
    """Rows (conv_id, turn, said, loss, len) sorted by conversation and turn to
    one row per conversation. A turn is hashed as it comes, so a conversation
    of any length is never held."""
    open_, out, begun = None, [], False

    def row():
        conv, n, said, chars, loss, size = open_
        return conv, n, said.hexdigest(), chars, loss.hexdigest(), size

    def table():
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    for batch in batches:
        for conv, _, said, loss, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if not begun or conv != open_[0]:
                if begun:
                    out.append(row())
                open_, begun = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0], True
            open_[1] += 1
            open_[2].update(said.encode())
            open_[3] += len(loss)
            open_[4].update(loss.encode())
            open_[5] += size
        if out:
            yield table()
            out = []
    if begun:
        out.append(row())
        yield table()


@query("op3_simhash")
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyhawk.llm.simhash import simhash_groups
    out = simhash_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                      F.col("component").alias("component_id"))


@query("op8_embeddings", r"""
with v as (select vec_id, label, embedding::double[] as e from embeddings
           where label is not null and embedding is not null and len(embedding) > 0
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
             and len(list_filter(embedding, lambda x: x <> 0)) > 0),
l as (select a.vec_id as u, b.vec_id as v from v a join v b on a.label = b.label and len(a.e) = len(b.e) and a.vec_id <> b.vec_id
      where list_cosine_similarity(a.e, b.e) >= 0.93),
n as (select u, count(*) as n from l group by u),
r as (with recursive reach(u, v) as (select u, v from l union select reach.u, l.v from reach join l on reach.v = l.u)
      select u, min(v) as least from reach group by u)
select e.vec_id, coalesce(n.n, 0)::bigint as n_links, least(e.vec_id, coalesce(r.least, e.vec_id)) as component_id,
       e.vec_id = least(e.vec_id, coalesce(r.least, e.vec_id)) as kept
from embeddings e left join n on e.vec_id = n.u left join r on e.vec_id = r.u""")
def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyhawk.llm.vectors import near_duplicates
    out = near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    return out.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept")


def digests(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, ids, text: the decoded text) to the digest columns."""
    return rows.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"))


@query("op5_bpe")
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from tallyhawk.llm.bpe import encode
    path = public_tokenizers.path("word_bpe_49k.json")
    return digests(encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path, decoded_col="text"))


@query("op7_quality")
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyhawk.llm.quality import classify
    return classify(table(spark, sf_dir, "documents").select("doc_id", "text"),
                    table(spark, sf_dir, "labels").select("doc_id", "quality"))


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyhawk.llm.toxicity import tag
    return tag(table(spark, sf_dir, "documents").select("doc_id", "text"),
               table(spark, sf_dir, "labels").select("doc_id", "toxic")).drop("spans")


@query("op10_suffix")
def op10_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyhawk.llm.suffixes import remove_repeats
    out, c = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col(c["n_bytes"]).alias("n_bytes"),
                      F.aggregate(c["removed"], F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("n_removed"),
                      F.size(c["removed"]).cast("long").alias("n_spans"),
                      F.sha2(c["kept"], 256).alias("kept_sha256"))


@query("op1_topk", r"""
with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as e from embeddings
           where vec_id is not null and embedding is not null
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, c.vec_id, list_dot_product(q.e, c.e)::bigint as score
      from v q join v c on q.vec_id <> c.vec_id and len(q.e) = len(c.e) where q.vec_id % 50 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from s)
select query_id, rank, vec_id, score from r where rank <= 5""")
def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyhawk.llm.topk import top_k
    out = top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("id") % 50 == 0)
    return out.withColumnRenamed("id", "vec_id")


@query("op11_substring")
def op11_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyhawk.llm.blocks import remove_repeated
    out, c = remove_repeated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col(c["n_words"]).alias("n_words"),
                      F.aggregate(c["removed"], F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("n_removed"),
                      F.sha2(c["kept"], 256).alias("kept_sha256"))


@query("op13_whitening")
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deviation that passes 64 bits is null."""
    from tallyhawk.llm.whitening import whiten
    out = whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return out.withColumnRenamed("id", "vec_id").withColumn("deviation", F.expr("try_cast(deviation as bigint)"))


@query("op12_trie", r"""
with t as (
  select conv_id as conv, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id order by turn nulls first,
                            md5(strlen(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 as pos
  from conversations where conv_id is not null),
z as (select conv, count(*) as size from t group by conv),
h as (select z.conv, z.conv - z.conv % 5 as source,
             xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(z.conv::varchar, ''), lambda x: ascii(x)::bigint)),
                             lambda a, x: list_reduce([xor(a, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, s: xor(v >> 1, (v & 1) * 3988292384))),
                 4294967295) % 9 as most from z),
g as (select h.*, least(most, coalesce(z.size, 0)) as taken from h left join z on z.conv = h.source),
r as (select g.conv, t.pos, t.role, t.text from g join t on t.conv = g.source where t.pos < g.most
      union all select g.conv, g.taken + t.pos - g.most, t.role, t.text from g join t on t.conv = g.conv where t.pos >= g.most),
p as (select conv, pos + 1 as depth, strlen(text) as bytes,
             md5(string_agg(strlen(role)::varchar || ':' || strlen(text)::varchar || ':' || role || text, '') over (partition by conv order by pos)) as name,
             lag(pos) over (partition by conv order by pos desc) is null as last from r
      union all select conv, 0, 0, '', conv not in (select conv from r) from g),
n as (select name, min(conv) as conv, any_value(depth) as depth, count(*) as n_convs, any_value(bytes) as bytes,
             sha256(coalesce(string_agg(conv::varchar, ',' order by conv) filter (where last), '')) as ends_sha256 from p group by name),
m as (select n.*, b.name as parent from n left join p b on b.conv = n.conv and b.depth = n.depth - 1),
c as (select parent as name, count(*) as n_children from m where parent is not null group by parent),
v as (select m.*, coalesce(c.n_children, 0) as n_children from m left join c using (name)),
s as (select a.name, sum((v.n_convs - 1) * v.bytes) as saved, sum((v.n_children = 0)::bigint) as leaves
      from v join p a on a.conv = v.conv and a.depth <= v.depth group by a.name)
select v.conv as conv_id, v.depth::bigint as depth, b.conv as parent_conv_id, v.n_convs::bigint as n_convs, v.n_children::bigint as n_children,
       s.leaves::bigint as n_leaves, s.saved::bigint as saved_tokens, v.ends_sha256
from v join s using (name) left join n b on b.name = v.parent""")
def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyhawk.llm.trie import prefix_trie, turns_of, with_heads
    conv = F.col("conv")
    turns, members = with_heads(turns_of(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")),
                                conv - conv % 5, F.crc32(conv.cast("string").cast("binary")) % 9, 8)
    return prefix_trie(turns, members)
