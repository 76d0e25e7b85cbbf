"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import backoff, bpe, decontaminate, divergence, language, licences, pii, repeats, simhash, tokencount, toxicity, trie, vectors
from millrace.llm.scratch import Scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Vocabulary of the token queries; a parameter of the operators.
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Its free id, which ends documents in token files.
END = 50256


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@query("op1_decontaminate")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.hits(table(spark, folder, "documents"), ["doc_id"], "text", table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
    )


@query("op2_language")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    net = language.learn(docs, "text", "lang", ~language.held_out(docs["doc_id"]))
    found = language.predict(docs, ["doc_id"], "text", net)
    return found.select("doc_id", language.held_out("doc_id").alias("held_out"), "lang_pred", "score")


@query("op3_token_counts")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    ids = bpe.encode(table(spark, folder, "documents"), [], "text", RANKS, public_tokenizers.PATTERN)
    path = f"{Scratch(spark, 'tokens').base}/files"
    tokencount.write_tokens(ids, "ids", path, END)
    return tokencount.count_tokens(spark, path, END)


@query("op4_licences", licences.scan_sql())
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scan(table(spark, folder, "documents"), "doc_id", "text", licences.known(spark, licences.list_texts()),
                         licences.known(spark, licences.list_notices()))


@query("op5_bpe")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digest_rows(table(spark, folder, "documents"), RANKS, public_tokenizers.PATTERN)


@query("op6_simhash")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    rows = simhash.grouped(spark, table(spark, folder, "documents"), shingle=4, radius=4)
    fingerprint = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return rows.select("doc_id", fingerprint, "component_id")


@query("op7_toxicity")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = toxicity.learn(docs, "doc_id", "text", labels, "doc_id", "toxic", ~language.held_out(labels["doc_id"], 5, 0))
    found = toxicity.score(docs, ["doc_id"], "text", model)
    return found.select("doc_id", language.held_out("doc_id", 5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op8_repeats")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    found = repeats.without_repeats(spark, table(spark, folder, "documents"), ["doc_id"], length=400)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op9_backoff", backoff.SQL)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    found = backoff.scores(spark, table(spark, folder, "documents"), "doc_id", "text", order=3)
    return found.select("doc_id", "n_words", F.round("score", 4).alias("score"))


@query("op10_vectors")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_copies(spark, table(spark, folder, "embeddings"), "vec_id", "embedding", "label", least=0.98)


@query("op11_personal")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = pii.find(docs, ["doc_id"], "text", pii.learn(docs, "text"))
    return found.withColumn("base_sha256", F.sha2(F.col("base").cast("binary"), 256)).drop("base")


@query("op12_divergence", divergence.SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(spark, table(spark, folder, "documents"), "lang", "source", "text", least=30, top=50)


#: Unsigned CRC-32 of the decimal digits of c, in DuckDB's SQL: bit by bit.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(c::varchar, ''), lambda x: ascii(x)::bigint)),
  lambda a, x: list_reduce(list_prepend(xor(a, x), range(8)), lambda b, i: xor(b >> 1, (b & 1) * 3988292384))))"""

TRIE_SQL = f"""
with o as (select conv_id c, coalesce(role, '') r, coalesce(text, '') t,
             row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) p
           from conversations where conv_id is not null),
ids as (select c, {_CRC} % 6 h from (select distinct c from o)),
lent as (select ids.c, o.p, o.r, o.t from ids join o on o.c = ids.c - ids.c % 100 and o.p <= ids.h),
many as (select c, count(*) n from lent group by 1),
own as (select o.c, o.p - ids.h + coalesce(many.n, 0) p, o.r, o.t from o join ids using (c) left join many using (c) where o.p > ids.h),
w as (select ids.c, list({{'r': r, 't': t}} order by p) filter (p is not null) s
      from ids left join (select * from lent union all select * from own) x using (c) group by 1),
m as (select c, coalesce(len(s), 0) n, d, coalesce(s[1:d], []) path from (select c, s, unnest(range(0, coalesce(len(s), 0) + 1)) d from w)),
nodes as (select path, d, min(c) c, count(*) n_convs, sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (n = d), '')) ends_sha256
          from m group by 1, 2),
kids as (select path[1:d - 1] up, count(*) n_children from nodes where d > 0 group by 1),
full_nodes as (select nodes.*, coalesce(n_children, 0) n_children, case when d > 0 then (n_convs - 1) * length(path[d].t) else 0 end saved
               from nodes left join kids on kids.up = nodes.path),
sums as (select path[1:k] path, sum(saved)::bigint saved_tokens, count(*) filter (n_children = 0) n_leaves
         from (select *, unnest(range(0, d + 1)) k from full_nodes) group by 1)
select f.c conv_id, f.d::bigint as depth, u.c parent_conv_id, f.n_convs, f.n_children, s.n_leaves, s.saved_tokens, f.ends_sha256
from full_nodes f join sums s on s.path = f.path left join nodes u on f.d > 0 and u.path = f.path[1:f.d - 1]
"""


@query("op13_conversations", TRIE_SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    scratch = Scratch(spark, "turns")
    turns = scratch.write(trie.numbered(table(spark, folder, "conversations"), "conv_id", "turn", "role", "text"), "numbered")
    taken = F.crc32(F.col("conv").cast("string").cast("binary")) % 6
    return trie.trie(spark, trie.spliced(turns, F.col("conv") - F.col("conv") % 100, taken, 5))
