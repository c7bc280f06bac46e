"""Registered queries of this subpackage and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, chat, decontaminate, fingerprint, html_main, mixing, sanitise, sharding, simhash, suffix, superkmer, toxicity, whitening
from .common import table

SHARDS = 40
#: Tokenizer files of op11: byte-level BPE (A), sentence pieces (B).
TOKENIZERS = ("/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model")


def op1_html_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.extract(table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_removed"
    )


def op2_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.dedup(table(spark, sf_dir, "documents")).drop("removed")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_with_edit(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_superkmer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superkmer.dedup(table(spark, sf_dir, "documents")).drop("removed")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies")


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)], "conv_id long, turn long, role string, text string")
    messages = rows.unionByName(more).select("conv_id", "turn", "role", chat.text_part(F.col("text")).alias("content"))
    return chat.read_back(chat.format_chat(messages))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = sharding.shard(table(spark, sf_dir, "documents"), SHARDS)
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), *TOKENIZERS)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitise.counts_and_digests(sanitise.personal_data(table(spark, sf_dir, "documents")))


QUERIES = {
    f.__name__: f
    for f in (
        op1_html_main, op2_suffix, op3_toxicity, op4_decontaminate, op5_fingerprint, op6_simhash, op7_superkmer, op8_mixing,
        op9_chat, op10_sharding, op11_alignment, op12_whitening, op13_sanitise,
    )
}
#: The same results in DuckDB SQL. Trained models, html, sketches, random rounding and packing have none.
ORACLES = {
    "op2_suffix": r"""
with d as (select doc_id, hex(encode(coalesce(text, ''))) h, octet_length(encode(coalesce(text, ''))) n from documents),
win as (select doc_id, s, substr(h, 2 * s + 1, 100) t from (select doc_id, h, unnest(range(n - 49)) s from d where n >= 50)),
dup as (select doc_id, s from (select *, min(doc_id) over (partition by t) f from win) where f < doc_id),
gone as (select distinct doc_id, unnest(range(s, s + 50)) p from dup),
cut as (select g.doc_id, count(*) n_removed, count(*) filter (where b.p is null) n_spans
        from gone g left join gone b on g.doc_id = b.doc_id and g.p = b.p + 1 group by g.doc_id),
bytes as (select doc_id, h, unnest(range(n)) p from d),
kept as (select doc_id, string_agg(substr(h, 2 * p + 1, 2), '' order by p) k
         from bytes anti join gone using (doc_id, p) group by doc_id)
select doc_id, cast(n as bigint) n_bytes, coalesce(n_removed, 0) n_removed, coalesce(n_spans, 0) n_spans,
       sha256(unhex(coalesce(k, ''))) kept_sha256
from d left join cut using (doc_id) left join kept using (doc_id)""",
    "op4_decontaminate": decontaminate.oracle(),
    "op7_superkmer": r"""
with d as (select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') w from documents),
win as (select doc_id, s, array_to_string(w[s + 1 : s + 35], ' ') t
        from (select doc_id, w, unnest(range(len(w) - 34)) s from d where len(w) >= 35)),
dup as (select doc_id, s from (select *, count(*) over (partition by t) c from win) where c > 1),
gone as (select distinct doc_id, unnest(range(s, s + 35)) p from dup),
cut as (select doc_id, count(*) n_removed from gone group by doc_id),
words as (select doc_id, unnest(w) x, unnest(range(len(w))) p from d),
kept as (select doc_id, string_agg(x, ' ' order by p) k from words anti join gone using (doc_id, p) group by doc_id)
select doc_id, len(w) n_words, coalesce(n_removed, 0) n_removed, sha256(coalesce(k, '')) kept_sha256
from d left join cut using (doc_id) left join kept using (doc_id)""",
    "op9_chat": r"""
with rows as (select conv_id, turn, coalesce(role, '') role, coalesce(text, '') text from conversations
              union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
escaped as (select *, regexp_replace(text, '([<\[])(\\*)(/?(?:s|INST|ROLE|image|audio|document)[>\]])', '\1\2\\\3', 'g') e from rows),
pieces as (select *, case role when 'user' then '[INST] ' || e || ' [/INST]' when 'assistant' then e || '</s>'
                     else '[ROLE] ' || role || ' [/ROLE] ' || e || '</s>' end piece from escaped)
select conv_id, count(*) n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn)) turns_sha256,
       cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn) filter (where role = 'assistant'), '')) loss_sha256,
       cast(sum(length(piece)) as bigint) formatted_chars
from pieces group by conv_id""",
}
