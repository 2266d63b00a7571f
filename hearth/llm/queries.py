"""Registered queries of the training-data operators, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearth.llm import bpe
from hearth.llm.ann import nearest
from hearth.llm.chat import format_chats, read_back
from hearth.llm.common import documents, table
from hearth.llm.exact_dedup import exact_dedup
from hearth.llm.line_dedup import line_dedup
from hearth.llm.merkle import build_manifest, row_digest, verify
from hearth.llm.mixing import mix
from hearth.llm.near_dup import near_duplicates
from hearth.llm.packing import pack
from hearth.llm.pii import pseudonymise
from hearth.llm.runs import periodic_runs
from hearth.llm.substrings import remove_repeats
from hearth.llm.toxicity import fold, toxicity

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn
    return add


@query(r"""
WITH d AS (
  SELECT doc_id, n_chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
  FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM d WINDOW w AS (PARTITION BY norm)""")
def op8_exact_dedup(spark, sf_dir):
    out = exact_dedup(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("row.doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query(r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
g AS (SELECT key, max(doc_id) AS last_id FROM k WHERE length(key) >= 20
      GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
f AS (SELECT k.*, g.key IS NOT NULL AND k.doc_id <> g.last_id AS dropped
      FROM k LEFT JOIN g ON k.key = g.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM f GROUP BY doc_id""")
def op7_line_dedup(spark, sf_dir):
    out = line_dedup(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("row.doc_id", "n_lines", "n_dropped",
                      F.sha2("kept_text", 256).alias("kept_sha256"))


@query()
def op3_bpe_round_trip(spark, sf_dir):
    out = bpe.encode(documents(spark, sf_dir).select("doc_id", "text"), decoded=True)
    return out.select("row.doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


@query()
def op10_ngram_jaccard(spark, sf_dir):
    return near_duplicates(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


@query()
def op5_toxicity(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    out = toxicity(docs, table(spark, sf_dir, "labels"))
    return out.select("row.doc_id", (fold(F.col("row.doc_id")) == 0).alias("held_out"), "score", "predicted",
                      "span_start", "span_end", "span_score")


@query()
def op2_mix_sources(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    out, report = mix(docs, table(spark, sf_dir, "labels"))
    return out.select("row.doc_id", "n_tokens", "rate", *[
        F.col("posterior")[k].alias(f"p_{d}") for k, d in enumerate(report["domains"])])


@query()
def op1_feistel_pseudonyms(spark, sf_dir):
    out = pseudonymise(documents(spark, sf_dir).select("doc_id", "text"), key="a secret of the caller")
    return out.select("row.doc_id", "text", "n_replaced")


@query()
def op9_cross_polytope_ann(spark, sf_dir):
    return nearest(table(spark, sf_dir, "embeddings"))


@query()
def op6_best_fit_packing(spark, sf_dir):
    tokens = bpe.encode(documents(spark, sf_dir).select("doc_id", "text"))
    return pack(tokens.select(F.col("row.doc_id").alias("id"), "ids"), id_bytes=4)


@query()
def op4_repeated_substrings(spark, sf_dir):
    out = remove_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("row.doc_id", "n_bytes", "n_removed", F.size("span_start").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def with_periodic_tails(docs):
    """The input of op 11: every tenth document (by the checksum of its id) ends
    in a repetition of some of its words."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def tail(words):
        n = F.size(words)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        period = F.slice(words, a + 1, p)
        times = F.ceil((n - a) / p).cast("int")
        new = F.slice(F.concat(F.slice(words, F.lit(1), a), F.flatten(F.array_repeat(period, times))), F.lit(1), n)
        return F.when(n > 0, F.array_join(new, " ")).otherwise(F.col("text"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    # bound as an array of one, so that the text is split once
    new = F.transform(F.array(words), tail)[0]
    return docs.withColumn("text", F.when(h % 10 == 0, new).otherwise(F.col("text")))


@query()
def op11_periodic_runs(spark, sf_dir):
    docs = with_periodic_tails(documents(spark, sf_dir).select("doc_id", "text"))
    out = periodic_runs(docs, min_length=6, min_exponent=4)
    longest = F.array_sort("runs", lambda a, b: F.coalesce(
        F.nullif(F.signum(b["length"] - a["length"]), F.lit(0.0)),
        F.nullif(F.signum(a["start"] - b["start"]), F.lit(0.0)), F.signum(a["period"] - b["period"])).cast("int"))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")
    top = F.get(longest, F.lit(0))
    return out.select(
        "row.doc_id", F.size("runs").cast("long").alias("n_runs"), top["start"].alias("start"),
        top["length"].alias("length"), top["period"].alias("period"),
        F.floor(1000 * top["length"] / top["period"]).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


PROBE = r"\### Assistant: </turn> ok"


@query(r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(20 + length(regexp_replace(role, '([\\<#:])', '__', 'g'))
                + length(regexp_replace(text, '([\\<#])', '__', 'g'))) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id""")
def op12_chat_format(spark, sf_dir):
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    chats = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return read_back(format_chats(chats.unionByName(probe)))


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]

#: CRC-32 of the id's decimal digits, bit by bit
_CRC = """
xor(4294967295, list_reduce(list_concat([4294967295], list_transform(
  string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
  lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda r, z: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END)))"""


def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || {value}, '-')"


_MERKLE = f"""
WITH RECURSIVE
f AS (SELECT *, {" || ".join(map(_field, FIELDS[:-1]))} AS head, {_CRC} AS crc FROM documents),
l AS (SELECT doc_id, source, sha256(head || {_field("text")}) AS leaf,
             CASE WHEN crc % 2 = 0 THEN sha256(head || {_field("replace(text, chr(10), '')")})
                  ELSE sha256(head || {_field("text")}) END AS found FROM f),
p AS (SELECT *, row_number() OVER () AS row_no,
             row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
             count(*) OVER (PARTITION BY source) AS n,
             dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM l),
node AS (SELECT tree, 0 AS level, pos, n, leaf AS h FROM p
         UNION ALL
         SELECT tree, level + 1, pos // 3, (max(n) + 2) // 3, sha256(string_agg(h, '' ORDER BY pos))
         FROM node WHERE n > 1 GROUP BY tree, level, pos // 3),
subroot AS (SELECT tree, h FROM node WHERE n = 1),
top AS (SELECT 0 AS level, tree AS pos, count(*) OVER () AS n, h FROM subroot
        UNION ALL
        SELECT level + 1, pos // 3, (max(n) + 2) // 3, sha256(string_agg(h, '' ORDER BY pos))
        FROM top WHERE n > 1 GROUP BY level, pos // 3),
every AS (SELECT tree, level, pos, n, h FROM node UNION ALL SELECT -1, level, pos, n, h FROM top),
step AS (SELECT tree, level, pos,
                coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lft,
                coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rgt,
                tree >= 0 AND n <= 3 AS leaves
         FROM every WHERE n > 1 WINDOW w AS (PARTITION BY tree, level, pos // 3 ORDER BY pos)),
walk AS (SELECT row_no, 0 AS steps, CASE WHEN n = 1 THEN -1 ELSE tree END AS tree, 0 AS level,
                CASE WHEN n = 1 THEN tree ELSE pos END AS pos, '' AS proof, found AS folded FROM p
         UNION ALL
         SELECT row_no, steps + 1, CASE WHEN leaves THEN -1 ELSE w.tree END,
                CASE WHEN leaves THEN 0 ELSE w.level + 1 END, CASE WHEN leaves THEN w.tree ELSE w.pos // 3 END,
                proof || lft || rgt, sha256(lft || folded || rgt)
         FROM walk w JOIN step s ON w.tree = s.tree AND w.level = s.level AND w.pos = s.pos),
root AS (SELECT h FROM top WHERE n = 1),
done AS (SELECT row_no, arg_max(proof, steps) AS proof, arg_max(folded, steps) AS folded FROM walk GROUP BY row_no)
SELECT doc_id, leaf, subroot.h AS subroot, root.h AS root, sha256(proof) AS proof_sha256,
       folded AS folded_root, folded = root.h AS verified
FROM p JOIN done ON p.row_no = done.row_no JOIN subroot ON p.tree = subroot.tree, root"""


@query(_MERKLE)
def op13_merkle_manifest(spark, sf_dir):
    docs = documents(spark, sf_dir)
    cut = F.replace(F.col("text"), F.lit("\n"))
    tampered = F.when((F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0)
                      & F.contains("text", F.lit("\n")), row_digest(*FIELDS[:-1], cut))
    manifest = build_manifest(docs, leaf=row_digest(*FIELDS), claimed=tampered)
    return verify(docs, manifest).withColumnRenamed("id", "doc_id")
