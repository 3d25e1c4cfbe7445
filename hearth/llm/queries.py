"""The operators over the given tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.llm.bpe import decode_ids, encode_texts
from hearth.llm.exact_dedup import exact_groups
from hearth.llm.html_text import extract_main_text
from hearth.llm.lattice_dedup import embedding_groups
from hearth.llm.license_scan import scan_licenses
from hearth.llm.license_sql import LICENSE_SQL
from hearth.llm.line_dedup import line_dedup
from hearth.llm.merkle_manifest import build_manifest, digest, fold, leaf_paths, siblings
from hearth.llm.mixing import mix_sources
from hearth.llm.periodic_runs import periodic_runs
from hearth.llm.simhash import simhash_components
from hearth.llm.substring_dedup import substring_dedup
from hearth.llm.token_files import read_token_files, write_token_files
from hearth.llm.toxicity import toxicity_score, train_toxicity
from hearth.session import fresh_subdir

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
END_ID = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id="doc_id"):
    """Rows that no classifier learns from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def toxicity_of(spark: SparkSession, docs: DataFrame, sf_dir: str):
    """The score of a text of ``docs``, learnt from the labels that aren't held out."""
    weights = train_toxicity(docs, table(spark, sf_dir, "labels"), learn=~held_out())
    return toxicity_score(weights, F.col("text"))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.array_join("sentence_ids", ",").alias("sentence_ids"),
                        F.array_join("licenses", ",").alias("licenses"),
                        F.array_join("unmatched", ",").alias("unmatched"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = docs.select("doc_id", toxicity_of(spark, docs, sf_dir).alias("score"))
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(table(spark, sf_dir, "documents"), shingle=3, radius=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_subdir(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, WORD_TOKENIZER, END_ID)
    return read_token_files(spark, path).select("doc_id", "start", "n_tokens",
                                                F.crc32("ids").alias("ids_crc32"))


def bpe_digests(docs: DataFrame) -> DataFrame:
    ids = encode_texts(docs.select("doc_id", "text"), BYTE_RANKS, public_tokenizers.PATTERN)
    back = decode_ids(ids, BYTE_RANKS)
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(joined, 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = extract_main_text(table(spark, sf_dir, "pages"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup(table(spark, sf_dir, "documents"), window=13)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op10_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embedding_groups(table(spark, sf_dir, "embeddings"), least=0.95)
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def planted_runs(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeats of op11's contract: where h = crc32(doc_id) is a multiple
    of 10, the words from ``a`` on repeat the ``p`` words there (a null doc_id: none)."""
    words = F.regexp_extract_all("text", F.lit("[^\\x20\\x09-\\x0D]+"), F.lit(0))
    h, n = F.crc32(F.col("doc_id").cast("string")), F.size("w")
    g = F.expr("h div 10")
    begun = docs.select("doc_id", "text", h.alias("h")).withColumn(
        "w", F.when(F.col("h") % 10 == 0, words))
    placed = (begun.withColumn("a", F.when(n > 0, F.pmod(g, n)))
              .withColumn("p", F.when(n > 0, 1 + F.floor((n - F.col("a")) / (3 + F.pmod(g, F.lit(8)))))))
    repeated = F.transform("w", lambda word, i: F.when(i < F.col("a"), word).otherwise(
        F.element_at("w", (F.col("a") + F.pmod(i - F.col("a"), F.col("p")) + 1).cast("int"))))
    return placed.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(repeated, " "))
                         .otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(planted_runs(table(spark, sf_dir, "documents")), least=6, copies=4)
    # greatest length, then smallest start, then smallest period
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(
        ",", r["start"], r["length"], r["period"])), "\n")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise(""), 256)
        .alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup(table(spark, sf_dir, "documents"), least=10, chars=1)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    changed = [F.col(c) + 1 if c == "n_chars" else F.col(c) for c in fields]
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, digest(*changed))
    manifest = build_manifest(docs, fields, "lang", "doc_id",
                              doc_id=F.col("doc_id"), tampered=tampered)
    found = leaf_paths(manifest)
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"),
        fold(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES = {f.__name__: f for f in (
    op1_license_scan, op2_toxicity, op3_simhash, op4_token_files, op5_byte_bpe, op6_mixing,
    op7_exact_dedup, op8_html_text, op9_substring_dedup, op10_lattice_dedup, op11_periodic_runs,
    op12_line_dedup, op13_merkle_manifest)}

_MIX_SIZES = r"""
with sized as (
  select doc_id, source, text,
         cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size,
         md5('42:' || coalesce(cast(doc_id as varchar), '')) as ticket
  from documents),
sources as (
  select source, cast(sum(size) as bigint) as source_size,
         [1, 2, 3][((row_number() over (order by encode(source) nulls last) - 1) % 3) + 1] as weight
  from sized group by source),
ordered as (  -- by the level at which a source reaches its cap
  select *, row_number() over (order by 3 * source_size / weight, source nulls last) as k from sources),
levels as (   -- the level left when the sources before k stand at their caps
  select *, cast(sum(source_size) over () as bigint)
            - coalesce(sum(3 * source_size) over (order by k rows between unbounded preceding and 1 preceding), 0) as rest,
         sum(weight) over (order by k rows between current row and unbounded following) as open_weight
  from ordered),
first_open as (
  select min(k) as k from levels
  where weight * cast(rest as double) / cast(open_weight as double) <= 3 * source_size),
level as (select rest, open_weight, k from levels where k = (select k from first_open)),
targets as (
  select s.source, s.source_size,
         case when l.k is null or s.k < l.k then cast(3 * s.source_size as double)
              else s.weight * cast(l.rest as double) / cast(l.open_weight as double) end as target
  from ordered s left join level l on true),
plan as (
  select *, case when source_size > 0 then cast(round(target) as bigint) // source_size else 0 end as whole,
         case when source_size > 0 then cast(round(target) as bigint) % source_size else 0 end as quota
  from targets)
"""


# unsigned CRC-32 of the decimal doc_id, a byte at a time by the table of its polynomial
_CRC = r"""
with crc_table as (
  select list(list_reduce([i::bigint, 0, 0, 0, 0, 0, 0, 0, 0],
              lambda a, _: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end) order by i) as t
  from range(256) r(i)),
crc as (
  select d.*, row_number() over () as r,
         xor(list_reduce(list_prepend(4294967295::bigint,
               list_transform(string_split(doc_id::varchar, ''), lambda c: ord(c)::bigint)),
               lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) as h
  from documents d, crc_table)
"""

ORACLE_SQL = {
    "op11_periodic_runs": _CRC + r"""
, given as (
  select r, doc_id, h, h // 10 as g,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from crc),
places as (
  select *, len(w) as n, case when h % 10 = 0 and len(w) > 0 then g % len(w) end as a from given),
periods as (
  select *, case when a is not null then 1 + (n - a) // (3 + g % 8) end as p from places),
planted as (
  select r, doc_id, n, case when a is null then w else
         list_transform(range(n), lambda i: w[(case when i < a then i else a + (i - a) % p end) + 1]) end as w
  from periods),
words as (select r, n, unnest(w) as word, generate_subscripts(w, 1) - 1 as i from planted),
matches as (  -- words that equal the one q before
  select x.r, x.i, x.i - y.i as q from words x join words y
         on x.r = y.r and x.word = y.word and y.i < x.i and 4 * (x.i - y.i) <= x.n),
islands as (
  select r, q, i, i - row_number() over (partition by r, q order by i) as island from matches),
stretches as (
  select r, q, min(i) - q as start, count(*) + q as length from islands group by r, q, island
  having count(*) + q >= greatest(6, 4 * q)),
runs as (     -- a multiple of the period has the same stretch
  select r, start, length, min(q) as period from stretches group by r, start, length),
digests as (
  select r, count(*) as n_runs,
         first(start order by length desc, start, period) as start,
         max(length) as length, first(period order by length desc, start, period) as period,
         string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as listed
  from runs group by r),
gone as (
  select distinct r, unnest(range(start + period, start + length)) as i from runs),
collapsed as (
  select r, string_agg(word, ' ' order by i) as t from words anti join gone using (r, i) group by r)
select doc_id, coalesce(n_runs, 0) as n_runs, start, length, period,
       1000 * length // period as exponent_milli, sha256(coalesce(listed, '')) as runs_sha256,
       sha256(coalesce(t, '')) as collapsed_sha256
from planted left join digests using (r) left join collapsed using (r)""",
    "op12_line_dedup": r"""
with texts as (
  select row_number() over () as r, doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents),
lines as (
  select r, unnest(l) as line, generate_subscripts(l, 1) as pos from texts),
keyed as (
  select *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k from lines),
common as (
  select k from keyed where length(k) >= 1 group by k having count(distinct r) >= 10),
kept as (
  select r, count(*) as n, string_agg(line, chr(10) order by pos) as t
  from keyed anti join common using (k) group by r)
select doc_id, len(l) as n_lines, len(l) - coalesce(n, 0) as n_dropped,
       sha256(coalesce(t, '')) as kept_sha256
from texts left join kept using (r)""",
    "op13_merkle_manifest": _CRC.replace("with ", "with recursive ", 1) + r"""
, fields as (
  select r, doc_id, lang, h % 7 = 0 as odd, n_chars,
         coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-')
         || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') as before,
         coalesce(strlen(text) || ':' || text, '-') as after from crc),
hashed as (
  select r, doc_id, lang,
         sha256(before || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') || after) as leaf,
         case when odd then sha256(before || coalesce(strlen((n_chars + 1)::varchar) || ':' || (n_chars + 1), '-')
                                   || after) end as changed
  from fields),
ranked as (
  select *, dense_rank() over (order by encode(lang) nulls first) - 1 as tree,
         row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as rank from hashed),
nodes as (
  select tree, 0 as level, rank, leaf as digest, count(*) over (partition by tree) as n from ranked
  union all
  select tree, level + 1, rank // 2, sha256(string_agg(digest, '' order by rank)), any_value(n + 1) // 2
  from nodes where n > 1 group by tree, level, rank // 2),
subroots as (select tree, digest as subroot from nodes where n = 1),
tops as (
  select 0 as level, tree as rank, subroot as digest, count(*) over () as n from subroots
  union all
  select level + 1, rank // 2, sha256(string_agg(digest, '' order by rank)), any_value(n + 1) // 2
  from tops where n > 1 group by level, rank // 2),
ways as (   -- the node of a level that a leaf is under, and the one beside it
  select r, l.level, x.rank // (1::bigint << l.level) as own, other.rank as beside, other.digest
  from ranked x join (select distinct tree, level from nodes where n > 1) l using (tree)
  left join nodes other on other.tree = x.tree and other.level = l.level
       and other.rank = xor(x.rank // (1::bigint << l.level), 1)
  union all
  select r, 1000 + l.level, x.tree // (1::bigint << l.level), other.rank, other.digest
  from ranked x cross join (select distinct level from tops where n > 1) l
  left join tops other on other.level = l.level and other.rank = xor(x.tree // (1::bigint << l.level), 1)),
paths as (
  select r, list({'b': case when beside < own then digest else '' end,
                  'a': case when beside > own then digest else '' end} order by level) as path,
         string_agg(digest, '' order by level) as joined from ways group by r),
folds as (
  select r, coalesce(changed, leaf) as folded, path, 1 as k from ranked left join paths using (r)
  union all
  select r, sha256(path[k].b || folded || path[k].a), path, k + 1 from folds where k <= len(path))
select doc_id, leaf, subroot, root, sha256(coalesce(joined, '')) as proof_sha256,
       folded as folded_root, folded = root as verified
from ranked join subroots using (tree) left join paths using (r)
join (select r, folded from folds where path is null or k > len(path)) using (r),
(select digest as root from tops where n = 1)""",
    "op1_license_scan": LICENSE_SQL,
    "op6_mixing": _MIX_SIZES + r"""
, before as (
  select d.doc_id, d.size, p.source_size, p.target, p.whole, p.quota,
         sum(d.size) over (partition by d.source order by d.ticket, cast(d.doc_id as varchar), d.size
                           rows between unbounded preceding and current row) - d.size as words_before
  from sized d join plan p on d.source is not distinct from p.source)
select doc_id, size, source_size, target,
       cast(whole * size + greatest(0, least(size, quota - words_before)) as bigint) as taken
from before""",
    "op7_exact_dedup": r"""
with normal as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents)
select doc_id, min(doc_id) over (partition by t) as keep_id,
       count(*) over (partition by t) as group_size,
       row_number() over (partition by t order by doc_id) = 1 as kept,
       sha256(t) as text_sha256
from normal""",
}
