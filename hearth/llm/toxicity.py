"""Toxicity by multiple-instance learning (operator 5).

Only documents carry labels; a document is a bag of sentences. Each sentence
has a score from a linear model over its words, and the document's score is
the noisy-or of them: 1 - (1 - leak) * prod(1 - p_sentence). The likelihood
of the document labels is maximised over the word weights, so the model
learns which sentences make a document toxic and can point at them.

Training uses a bounded sample of the labelled documents, of each label the
same number at most. Word statistics of the sample, counted in Spark, choose
the features; the weights are fitted to it; all documents are then scored in
one pass, without a shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import stage, text_or_empty

# a sentence ends at a line end, or at . ! ? ; followed by white space
SENTENCE = regex.compile(r"[^\n]*?(?:[.!?;]+(?=\s)|\n|$)")
WORD = regex.compile(r"\w+").findall
MAX_WORD_CHARS = 40
PIECE_WORDS = 64        # a sentence longer than this counts as several


def sentences(text: str) -> list[tuple[int, int]]:
    """Spans (start, end) of the sentences that hold a word."""
    return [m.span() for m in SENTENCE.finditer(text) if m.end() > m.start() and not m[0].isspace()]


def bags(text: str, index: dict[str, int]) -> tuple[list[tuple[int, int]], list[list[int]]]:
    """The spans of sentences with at least one feature word, and these words'
    numbers. A long sentence is cut every ``PIECE_WORDS`` words."""
    spans, found = [], []
    low = text.lower()
    if len(low) != len(text):       # a character that lower() spells out
        low = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
    get = index.get
    for a, b in sentences(low):
        words = WORD(low, a, b)
        for k in range(0, len(words), PIECE_WORDS):
            hit = {j for w in words[k:k + PIECE_WORDS] if (j := get(w)) is not None}
            if hit:
                spans.append((a, b))
                found.append(sorted(hit))
    return spans, found


def _count(batches):
    """For each label: documents, and documents by word."""
    for batch in batches:
        words, labels = [], []
        for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            seen = {w for w in set(WORD(text.lower())) if len(w) <= MAX_WORD_CHARS}
            words += seen
            labels += [y] * len(seen)
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(labels, pa.int32())], ["word", "y"])


def _count_sentences(index: dict[str, int]):
    """Word number, label and hash of each sentence that holds a word of the index."""
    def run(batches):
        for batch in batches:
            ks, ys, hs = [], [], []
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                low = text.lower()
                spans, found = bags(low, index)
                for (a, b), hit in zip(spans, found):
                    h = xxhash.xxh3_64_intdigest(low[a:b].strip()) - (1 << 63)
                    ks += hit
                    ys += [y] * len(hit)
                    hs += [h] * len(hit)
            yield pa.RecordBatch.from_arrays([pa.array(ks, pa.int32()), pa.array(ys, pa.int32()), pa.array(hs, pa.int64())],
                                             ["k", "y", "s"])
    return run


def choose_words(train: DataFrame, max_words: int, min_docs: int, min_z: float, min_lift: float) -> list[str]:
    """Words whose share among toxic training documents is over that among
    clean ones by ``min_z`` standard errors and ``min_lift`` times, at most
    ``max_words``."""
    n = {r.y: r.n for r in train.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    if not n1 or not n0:
        return []
    counts = (train.select("t", "y").mapInArrow(_count, "word string, y int").groupBy("word")
              .agg(F.sum("y").alias("k1"), F.count("*").alias("k")).filter(F.col("k") >= min_docs))
    p = (F.col("k") + 1) / (n1 + n0 + 2)
    z = (F.col("k1") / n1 - (F.col("k") - F.col("k1")) / n0) / F.sqrt(p * (1 - p) * (1 / n1 + 1 / n0))
    lift = F.col("k1") / n1 >= min_lift * (F.col("k") - F.col("k1")) / n0
    best = counts.withColumn("z", z).filter((F.col("z") >= min_z) & lift).orderBy(F.desc("z"), "word").limit(max_words)
    words = [r.word for r in best.select("word").collect()]
    # copies of a document repeat its words: a word must also stand out by the
    # number of different sentences it occurs in
    base = n1 / (n1 + n0)
    found = (train.select("t", "y").mapInArrow(_count_sentences({w: k for k, w in enumerate(words)}), "k int, y int, s long")
             .distinct().groupBy("k").agg(F.sum("y").alias("k1"), F.count("*").alias("n"))
             .filter((F.col("k1") - base * F.col("n")) >= min_z * F.sqrt(F.col("n") * base * (1 - base))))
    return [words[r.k] for r in found.orderBy("k").collect()]


def fit_noisy_or(docs: list[list[list[int]]], y: np.ndarray, weight: np.ndarray, n_words: int, steps: int = 400,
                 rate: float = 0.1, l2: float = 1e-3) -> dict:
    """Maximum likelihood of the document labels under the noisy-or.

    ``docs``: of each document its sentences' word numbers; ``weight``: how many
    documents each stands for. Adam on the word weights, one bias of all
    sentences, and the leak; deterministic.
    """
    sent_doc = np.array([d for d, s in enumerate(docs) for _ in s], np.int64)
    flat = [w for s in docs for x in s for w in x]
    word = np.array(flat, np.int64)
    sent = np.repeat(np.arange(len(sent_doc)), [len(x) for s in docs for x in s]) if len(flat) else np.zeros(0, np.int64)
    y = np.asarray(y, float)
    weight = weight / max(weight.sum(), 1e-9)
    base = float(np.clip((y * weight).sum() if len(y) else 0.0, 1e-3, 1 - 1e-3))
    theta = np.concatenate([np.zeros(n_words), [-3.0, np.log(base / (1 - base)) - 1.0]])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        w, bias, leak = theta[:n_words], theta[-2], theta[-1]
        s = bias + np.bincount(sent, w[word], len(sent_doc)) if len(flat) else np.zeros(0)
        # log(1 - p) of a logistic is -softplus
        log_not = -np.logaddexp(0, s)
        total = -np.logaddexp(0, leak) + np.bincount(sent_doc, log_not, len(y))
        miss = np.clip(np.exp(total), 1e-12, 1 - 1e-9)      # P(not toxic)
        slope = weight * (y * miss / (1 - miss) - (1 - y))         # of the log likelihood by -total
        gs = slope[sent_doc] / (1 + np.exp(-s)) if len(flat) else np.zeros(0)
        grad = np.concatenate([np.bincount(word, gs[sent], n_words) if len(flat) else np.zeros(n_words),
                               [gs.sum(), (slope / (1 + np.exp(-leak))).sum()]])
        grad[:n_words] -= l2 * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        theta = theta + rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return {"weights": theta[:n_words], "bias": theta[-2], "leak": theta[-1]}


def score_text(text: str, index: dict[str, int], model: dict):
    """The document's score, and its sentences' spans and scores, best first."""
    spans, found = bags(text, index)
    if not found:
        return float(1 / (1 + np.exp(-model["leak"]))), []
    s = model["bias"] + np.array([model["weights"][x].sum() for x in found])
    score = float(-np.expm1(-np.logaddexp(0, model["leak"]) - np.logaddexp(0, s).sum()))
    top = sorted(zip((1 / (1 + np.exp(-s))).tolist(), spans), key=lambda x: (-x[0], x[1]))
    return score, top


def _score_batches(index: dict[str, int], model: dict, threshold: float):
    def run(batches):
        for batch in batches:
            scores, starts, ends, ps = [], [], [], []
            for text in batch.column("t").to_pylist():
                score, top = score_text(text, index, model)
                scores.append(score)
                hit = [x for x in top if x[0] >= threshold] if score >= threshold else []
                hit = hit or (top[:1] if score >= threshold else [])
                starts.append([x[1][0] for x in hit])
                ends.append([x[1][1] for x in hit])
                ps.append([x[0] for x in hit])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(scores, pa.float64()),
                 pa.array([int(x >= threshold) for x in scores], pa.int32()),
                 pa.array(starts, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int32())),
                 pa.array(ps, pa.list_(pa.float64()))],
                ["row", "score", "predicted", "span_start", "span_end", "span_score"])
    return run


def fold(id_col: Column) -> Column:
    """crc32 of the id as text, modulo 5; 0 is held out."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 5


def train_model(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                label_col: str = "toxic", max_words: int = 2000, min_docs: int = 5, min_z: float = 6.0,
                min_lift: float = 3.0, sample_docs: int = 20_000) -> tuple[dict[str, int], dict]:
    """Choose words and fit on at most about ``sample_docs`` labelled documents
    of each label (those with the smallest hashes of the id).

    Rows without label, and held-out ids, take no part. With labels of one
    kind only, or none, the model has no words and answers the base rate.
    """
    pairs = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("y"))
    pairs = (pairs.filter(F.col("y").isin(0, 1) & F.col("id").isNotNull()).filter(fold(F.col("id")) != 0)
             .groupBy("id").agg(F.max("y").alias("y")))
    sizes = {r.y: r.n for r in pairs.groupBy("y").agg(F.count("*").alias("n")).collect()}
    share = {y: min(1.0, sample_docs / n) for y, n in sizes.items()}
    bound = F.coalesce(*[F.when(F.col("y") == y, F.lit(x)) for y, x in share.items()], F.lit(0.0))
    picked = pairs.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < bound * (1 << 20))
    # at most about 2 * sample_docs rows of two numbers: small enough to send to every task
    train = stage(docs.select(F.col(f"`{id_col}`").alias("id"), text_or_empty(f"`{text_col}`").alias("t"))
                  .join(F.broadcast(picked), "id"), "toxicity-train")
    words = choose_words(train, max_words, min_docs, min_z, min_lift)
    index = {w: k for k, w in enumerate(words)}

    def featurise(batches):
        for batch in batches:
            found = [bags(t, index)[1] for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array(found, pa.list_(pa.list_(pa.int32())))], ["id", "y", "bags"])
    rows = train.select("t", "id", "y").mapInArrow(featurise, "id " + train.schema["id"].dataType.simpleString()
                                                   + ", y int, bags array<array<int>>").toArrow().to_pylist()
    rows.sort(key=lambda r: (r["id"], r["y"], r["bags"]))
    y = np.array([r["y"] for r in rows], np.int64)
    weight = np.array([1 / share[k] for k in y.tolist()], float)
    return index, fit_noisy_or([r["bags"] for r in rows], y, weight, len(index))


def score_documents(docs: DataFrame, index: dict[str, int], model: dict, text_col: str = "text",
                    threshold: float = 0.5) -> DataFrame:
    """One row per input row: ``row`` (the whole input row), ``score``,
    ``predicted``, and the offending sentences' ``span_start``, ``span_end``
    (code points) and ``span_score``, best first (empty unless predicted).

    Null and empty texts get the score of a text without any known word.
    Texts of any length are scored whole. Repeated rows get equal scores.
    """
    src = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                      text_or_empty(f"`{text_col}`").alias("t"))
    kind = src.schema["row"].dataType.simpleString()
    return src.mapInArrow(_score_batches(index, model, threshold),
                          f"row {kind}, score double, predicted int, span_start array<int>, "
                          "span_end array<int>, span_score array<double>")


def toxicity(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Train on the labelled documents that aren't held out and score all."""
    index, model = train_model(docs, labels, **options)
    return score_documents(docs, index, model)
