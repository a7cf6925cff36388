"""Queries of the operators that build structures over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.ordering import numbered
from . import merkle, prefix_trie, recompression

# CRC-32 of a text's bytes in DuckDB, bit by bit over the reflected polynomial
CRC_SQL = """xor(4294967295::ubigint, list_reduce(
      list_concat([4294967295::ubigint], list_transform(range(1, strlen({0}) + 1), lambda i: ascii(substr({0}, i, 1))::ubigint)),
      lambda s, b: list_reduce(list_concat([xor(s, b)], [0::ubigint, 0, 0, 0, 0, 0, 0, 0]),
        lambda x, z: xor(x >> 1, 3988292384::ubigint * (x & 1::ubigint)))))"""


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .queries import table

    docs = table(spark, sf_dir, "documents").select(*FIELDS)
    tampered = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0) & F.col("n_chars").isNotNull()
    changed = merkle.record_digest(*["_changed" if c == "n_chars" else c for c in FIELDS])
    manifest = merkle.build_manifest(
        docs.withColumn("_changed", F.col("n_chars") + 1), "doc_id", "lang", merkle.record_digest(*FIELDS), F.when(tampered, changed))
    return merkle.prove(manifest).select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root", F.col("proof").alias("proof_sha256"),
        F.col("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))


def _field_sql(value: str) -> str:
    return f"coalesce(strlen({value}::varchar) || ':' || {value}::varchar, '-')"


LEAF_SQL = "sha256(concat({}))"
OP11_SQL = f"""
with recursive given as (
  select doc_id, lang, case when doc_id is not null and {CRC_SQL.format("doc_id::varchar")} % 7 = 0 then 1 else 0 end as added,
         {LEAF_SQL.format(", ".join(map(_field_sql, FIELDS)))} as leaf, source, n_chars, text
  from documents),
presented as (
  select doc_id, lang, leaf, {LEAF_SQL.format(", ".join(_field_sql("(n_chars + added)" if c == "n_chars" else c) for c in FIELDS))} as shown
  from given),
leaves as (
  select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as place,
         count(*) over (partition by lang) as n, row_number() over (order by lang nulls first, doc_id nulls first, leaf) as id
  from presented),
nodes(lang, level, place, n, digest) as (
  select lang, 0, place, n, leaf from leaves
  union all
  select lang, level + 1, place // 2, (n + 1) // 2, sha256(string_agg(digest, '' order by place))
  from nodes where n > 1 group by lang, level + 1, place // 2, (n + 1) // 2),
subroots as (
  select lang, digest as subroot, row_number() over (order by encode(lang) nulls first) - 1 as place, count(*) over () as n
  from nodes where n = 1),
tops(level, place, n, digest) as (
  select 0, place, n, subroot from subroots
  union all
  select level + 1, place // 2, (n + 1) // 2, sha256(string_agg(digest, '' order by place))
  from tops where n > 1 group by level + 1, place // 2, (n + 1) // 2),
steps as (  -- the sibling of every node, by tree
  select a.lang, false as top, a.level, a.place, b.digest as sibling
  from nodes a left join nodes b on a.lang is not distinct from b.lang and a.level = b.level and b.place = xor(a.place, 1) where a.n > 1
  union all
  select null, true, a.level, a.place, b.digest
  from tops a left join tops b on a.level = b.level and b.place = xor(a.place, 1) where a.n > 1),
walks(id, lang, top, level, place, folded, proof, digest) as (
  select id, lang, false, 0, place, shown, '', null from leaves
  union all
  select w.id, w.lang, w.top or s.sibling is null and s.level is null,
         case when s.level is null then 0 else w.level + 1 end,
         case when s.level is null then r.place else w.place // 2 end,
         case when s.level is null then w.folded
              else sha256(case when w.place % 2 = 1 then s.sibling || w.folded else w.folded || coalesce(s.sibling, '') end) end,
         w.proof || coalesce(s.sibling, ''), null
  from walks w
  left join steps s on s.top = w.top and (w.top or s.lang is not distinct from w.lang) and s.level = w.level and s.place = w.place
  left join subroots r on r.lang is not distinct from w.lang
  where not (w.top and s.level is null)),
ended as (
  select id, folded, proof from walks w
  where top and not exists (select 1 from steps s where s.top and s.level = w.level and s.place = w.place))
select l.doc_id, l.leaf, r.subroot, t.digest as root, sha256(e.proof) as proof_sha256, e.folded as folded_root,
       e.folded = t.digest as verified
from leaves l join ended e using (id)
join subroots r on r.lang is not distinct from l.lang
join tops t on t.n = 1
"""


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .queries import hex_digest, table

    kept = recompression.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", hex_digest("text").alias("kept_sha256"))


OP12_SQL = """
with texts as (
  select doc_id, coalesce(doc_id, -9223372036854775808) as key, row_number() over () as id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as words
  from documents),
places as (select key, id, words, unnest(range(1, len(words) - 48)) as place from texts where len(words) >= 50),
windows as (select key, id, place, md5(array_to_string(words[place:place + 49], ' ')) as name from places),
judged as (select *, min(key) over (partition by name) as least from windows),
gone as (
  select id, list_distinct(flatten(list(range(place, place + 50)))) as places from judged where least < key group by id),
kept as (
  select t.doc_id, len(t.words) as n_words, coalesce(len(g.places), 0) as n_removed,
         case when g.places is null then t.words
              else list_filter(t.words, lambda w, i: not list_contains(g.places, i)) end as words
  from texts t left join gone g using (id))
select doc_id, n_words, n_removed::bigint as n_removed, sha256(array_to_string(words, ' ')) as kept_sha256 from kept
"""


def rebuilt_conversations(talks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every conversation c with the first h turns of conversation c - c % 20 in place of its own first h; h = crc32(c) % 4.

    Turns of one place number are ordered by role, then text. Returns the turns (``conv_id``, ``place``, ``role``, ``text``) and
    the conversations.
    """
    plain = talks.where("conv_id is not null").select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    placed = numbered(plain, ["conv_id"], ["turn", "role", "text"], "place").select("conv_id", "place", "role", "text")
    convs = placed.groupBy("conv_id").agg(F.max("place").alias("length"))
    convs = convs.select(
        "conv_id", (F.col("conv_id") - F.col("conv_id") % 20).alias("base"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).alias("h"), "length")
    bases = convs.select(F.col("conv_id").alias("base"), F.col("length").alias("base_length"))
    taken = F.least("h", F.coalesce("base_length", F.lit(0)))
    convs = convs.join(bases, "base", "left").withColumn("taken", taken)
    heads = placed.where("place <= 3").withColumnRenamed("conv_id", "base").join(convs, "base").where("place <= h")
    own = placed.join(convs, "conv_id").where("place > h").withColumn("place", F.col("place") - F.col("h") + F.col("taken"))
    names = ["conv_id", "place", "role", "text"]
    return heads.select(*names).unionByName(own.select(*names)), convs.select("conv_id")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .queries import table

    turns, members = rebuilt_conversations(table(spark, sf_dir, "conversations"))
    trie = prefix_trie.conversation_trie(turns, members)
    return trie.select(
        F.col("seq").alias("conv_id"), "depth", F.col("parent_seq").alias("parent_conv_id"), F.col("n_members").alias("n_convs"),
        "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))


OP13_SQL = f"""
with placed as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as place
  from conversations where conv_id is not null),
lengths as (select conv_id, max(place) as length from placed group by conv_id),
convs as (
  select c.conv_id, ({CRC_SQL.format("c.conv_id::varchar")} % 4)::bigint as h, c.conv_id - c.conv_id % 20 as base,
         coalesce(b.length, 0) as base_length
  from lengths c left join lengths b on b.conv_id = c.conv_id - c.conv_id % 20),
turns as (
  select c.conv_id, p.place, p.role, p.text from convs c join placed p on p.conv_id = c.base where p.place <= c.h
  union all
  select c.conv_id, p.place - c.h + least(c.h, c.base_length), p.role, p.text
  from convs c join placed p on p.conv_id = c.conv_id where p.place > c.h),
prefixes as (
  select conv_id, place as depth, text,
         list(struct_pack(role := role, text := text)) over (partition by conv_id order by place) as path
  from turns
  union all select conv_id, 0, '', [] from convs),
members as (select conv_id, depth, text, min(conv_id) over (partition by depth, path) as node from prefixes),
nodes as (
  select node, depth, count(*) as n_convs, (count(*) - 1) * len(regexp_extract_all(any_value(text), '[^\\x20\\x09-\\x0D]+')) as own
  from members group by node, depth),
parents as (
  select n.node, n.depth, p.node as parent from nodes n left join members p on p.conv_id = n.node and p.depth = n.depth - 1),
children as (select parent, depth - 1 as depth, count(*) as n_children from parents where parent is not null group by all),
valued as (
  select n.*, p.parent, coalesce(c.n_children, 0) as n_children
  from nodes n join parents p using (node, depth)
  left join children c on c.parent = n.node and c.depth = n.depth),
totals as (
  select m.node, m.depth, count(*) filter (where v.n_children = 0) as n_leaves, sum(v.own)::bigint as saved_tokens
  from valued v join members m on m.conv_id = v.node and m.depth <= v.depth group by m.node, m.depth),
lasts as (select conv_id, max(depth) as depth from prefixes group by conv_id),
ends as (
  select m.node, m.depth, string_agg(m.conv_id::varchar, ',' order by m.conv_id) as ids
  from members m join lasts using (conv_id, depth) group by m.node, m.depth)
select v.node as conv_id, v.depth::bigint as depth, v.parent as parent_conv_id, v.n_convs, v.n_children, t.n_leaves, t.saved_tokens,
       sha256(coalesce(e.ids, '')) as ends_sha256
from valued v join totals t using (node, depth) left join ends e using (node, depth)
"""

QUERIES = {"op11_merkle_manifest": op11_merkle_manifest, "op12_substring_dedup": op12_substring_dedup, "op13_prefix_trie": op13_prefix_trie}
ORACLES = {"op11_merkle_manifest": OP11_SQL, "op12_substring_dedup": OP12_SQL, "op13_prefix_trie": OP13_SQL}
