"""Lines shared by several documents (operator 7).

Lines are exploded, normalised and hashed inside Arrow batches; Spark counts
the documents of each hash, joins the hashes over the threshold back to the
lines, and gathers for each document the positions that go. The documents
are then put together again by position.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import stage

SPACE = " \t\n\x0b\x0c\r"


def line_key(line: str) -> bytes | None:
    """The line without ASCII white space at its ends, A-Z in lower case."""
    return line.strip(SPACE).encode().lower()


def _hash_lines(min_chars: int):
    def run(batches):
        for batch in batches:
            ids, tags, owner, pos, digests, first = (
                batch.column(0), batch.column(1), [], [], [], [])
            for row, text in enumerate(batch.column(2).to_pylist()):
                seen = set()
                for k, line in enumerate(text.split("\n")):
                    key = line.strip(SPACE)
                    if len(key) >= min_chars:
                        d = xxhash.xxh3_128_digest(key.encode().lower())
                        owner.append(row)
                        pos.append(k)
                        digests.append(d)
                        first.append(0 if d in seen else 1)
                        seen.add(d)
            h = np.frombuffer(b"".join(digests), dtype=">u8").astype(np.uint64).view(np.int64)
            take = pa.array(owner, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [ids.take(take), tags.take(take), pa.array(pos, pa.int32()),
                 pa.array(h[0::2]), pa.array(h[1::2]), pa.array(first, pa.int32())],
                ["id", "tag", "pos", "h1", "h2", "first"])
    return run


def _assemble(batches):
    for batch in batches:
        n_lines, n_dropped, kept = [], [], []
        for text, drop in zip(batch.column("t").to_pylist(), batch.column("drop").to_pylist()):
            lines = text.split("\n")
            gone = set(drop or ())
            n_lines.append(len(lines))
            n_dropped.append(len(gone))
            kept.append("\n".join(x for k, x in enumerate(lines) if k not in gone) if gone else text)
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()),
             pa.array(kept, pa.string())], ["row", "n_lines", "n_dropped", "kept_text"])


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """One row per input row: ``row`` (the input row without its text),
    ``n_lines``, ``n_dropped``, ``kept_text``.

    A null or empty text is one empty line. Lines whose key has at least
    ``min_chars`` code points and occurs in at least ``min_docs`` documents go,
    except in the document with the largest id holding it. Rows that repeat an
    id are one document: a line they share counts once, and all of them keep
    it if their id is the largest. Rows without id are together one document
    that is smaller than all others. A document that loses all its lines keeps
    an empty text. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row"),
                      text.alias("t"))
    keyed = own.withColumns({"id": F.col(f"row.`{id_col}`"), "tag": F.xxhash64("t")})
    id_type = keyed.schema["id"].dataType.simpleString()
    lines = keyed.select("id", "tag", "t").mapInArrow(
        _hash_lines(min_chars), f"id {id_type}, tag long, pos int, h1 long, h2 long, first int")
    # an upper bound first: a document counts once for each row that holds it
    often = (lines.groupBy("h1", "h2").agg(F.sum("first").alias("rows"))
             .filter(F.col("rows") >= min_docs).select("h1", "h2"))
    shared = stage(lines.select("id", "tag", "pos", "h1", "h2").join(often, ["h1", "h2"]), "line-dedup")
    over = (shared.select("h1", "h2", "id").distinct().groupBy("h1", "h2")
            .agg(F.count("*").alias("n_docs"), F.max("id").alias("last_id"))
            .filter(F.col("n_docs") >= min_docs))
    drops = (shared.join(over, ["h1", "h2"]).filter(~F.col("id").eqNullSafe(F.col("last_id")))
             .groupBy("id", "tag").agg(F.collect_set("pos").alias("drop"))
             .select(F.col("id").alias("drop_id"), F.col("tag").alias("drop_tag"), "drop"))
    joined = keyed.join(drops, F.col("id").eqNullSafe(F.col("drop_id"))
                        & (F.col("tag") == F.col("drop_tag")), "left").select("row", "t", "drop")
    out = joined.select("row").schema
    return joined.mapInArrow(_assemble, f"row {out['row'].dataType.simpleString()}, "
                             "n_lines long, n_dropped long, kept_text string")
