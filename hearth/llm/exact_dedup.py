"""Exact duplicates by stateful streaming (operator 8, DataFrame operations only).

The documents are written once, with a row locator and the SHA-256 of the
normalised text, to a content table in the shared folder. A structured stream
reads that table; its RocksDB state keeps, for every digest and without
expiry, the stable identifier and content locator of the first document and
the number of documents. The state is then read as a table. A document that
hits a digest held by another one is a copy only if the full normalised texts
agree; documents whose digests collide are regrouped by their texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import shared_folder, stage

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    # a store is closed once its task has committed: its files live in the checkpoint
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
}


def normalised(text: Column) -> Column:
    """Each run of ASCII white space becomes one space; null becomes empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _first(id_col: Column, locator: Column) -> Column:
    # the smallest id wins; null ids come last; the locator settles repeated ids
    return F.min(F.struct(id_col.isNull().alias("no_id"), id_col.alias("id"),
                          locator.alias("locator")))


def _stream_state(spark, path: str, schema, id_col: str, files_per_batch: int) -> DataFrame:
    """Run the stream over the content table; its final state as a table
    (digest, first, n)."""
    checkpoint = shared_folder(spark, "exact-dedup-state")
    saved = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
         .parquet(path)
         .select("digest", F.col(f"row.`{id_col}`").alias("id"), "locator")
         .groupBy("digest")
         .agg(_first(F.col("id"), F.col("locator")).alias("first"), F.count("*").alias("n"))
         .writeStream.outputMode("update").format("noop")
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start().awaitTermination())
        state = spark.read.format("statestore").load(checkpoint)
        buffers = state.schema["value"].dataType.fieldNames()
        kinds = [f.dataType.typeName() for f in state.schema["value"].dataType.fields]
        if kinds != ["struct", "long"]:     # Spark names the buffers, in the order of the aggregates
            raise RuntimeError(f"unexpected state of the stream: {kinds}")
        return stage(state.select("key.digest", F.col(f"value.`{buffers[0]}`").alias("first"),
                                  F.col(f"value.`{buffers[1]}`").alias("n")), "exact-dedup-groups")
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                digest_chars: int = 64, files_per_batch: int = 500) -> DataFrame:
    """One row per input row: ``row`` (the input row), ``keep_id``,
    ``group_size``, ``kept``, ``text_sha256``.

    Null texts count as empty, and empty texts equal each other. Of equal
    texts the row with the smallest id stays; null ids come after all others;
    of rows that repeat an id exactly one stays. An empty table gives an empty
    result. Extra columns, whatever their names, travel inside ``row``.
    ``digest_chars`` shortens the digest (for tests of collisions); the result
    doesn't depend on it.
    """
    spark = docs.sparkSession
    sha = F.sha2(normalised(F.col(f"`{text_col}`")), 256)
    content = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                          F.monotonically_increasing_id().alias("locator"), sha.alias("sha"),
                          F.substring(sha, 1, digest_chars).alias("digest"))
    path = shared_folder(spark, "exact-dedup-content")
    content.write.option("compression", "zstd").parquet(path)
    store = spark.read.schema(content.schema).parquet(path)
    groups = _stream_state(spark, path, content.schema, id_col, files_per_batch)

    keys = store.select("locator", F.col(f"row.`{id_col}`").alias("id"), "digest")
    hits = (keys.join(groups.filter("n > 1"), "digest")
            .filter(F.col("locator") != F.col("first.locator"))
            .select("locator", "id", "digest", F.col("first.locator").alias("keeper")))
    needed = hits.select("locator").union(hits.select("keeper").distinct())
    texts = stage(store.select("locator", normalised(F.col(f"row.`{text_col}`")).alias("norm"))
                  .join(needed, "locator", "left_semi"), "exact-dedup-texts")
    keeper_texts = texts.select(F.col("locator").alias("keeper"), F.col("norm").alias("keeper_norm"))
    misses = stage(hits.join(texts, "locator").join(keeper_texts, "keeper")
                   .filter(F.col("norm") != F.col("keeper_norm"))
                   .select("locator", "id", "digest", "norm"), "exact-dedup-misses")
    regrouped = (misses.groupBy("digest", "norm")
                 .agg(_first(F.col("id"), F.col("locator")).alias("own_first"),
                      F.count("*").alias("own_n")))
    moved = misses.join(regrouped, ["digest", "norm"]).select("locator", "own_first", "own_n")
    lost = misses.groupBy("digest").agg(F.count("*").alias("n_lost"))

    first = F.coalesce("own_first", "first")
    groups = groups.join(lost, "digest", "left")
    return (store.join(groups, "digest").join(moved, "locator", "left")
            .select("row", first["id"].alias("keep_id"),
                    F.coalesce("own_n", F.col("n") - F.coalesce("n_lost", F.lit(0))).alias("group_size"),
                    (first["locator"] == F.col("locator")).alias("kept"),
                    F.col("sha").alias("text_sha256")))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input rows that stay, with the input's columns."""
    return exact_dedup(docs, id_col, text_col).filter("kept").select("row.*")
