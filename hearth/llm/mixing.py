"""Mixing to target weights by soft membership (operator 2, DataFrame operations only).

Domains are classes of the label table. A multinomial logistic model, fitted
on a bounded sample of the labelled documents, gives every document its domain
posteriors p. Rates r >= 0 of the documents are then fitted so that the
expected token totals a_d = sum_i r_i n_i p_id meet the targets t_d: least
squares of the relative errors, sum_d (a_d - t_d)^2 / T_d with T_d the totals
at rate 1, by projected gradient in the metric of the token counts n_i,

    r_i <- max(0, r_i - sum_d p_id (a_d - t_d) / T_d).

In this metric the largest curvature is exactly 1, so the unit step is safe.
Each step needs one distributed sum per domain; only these sums reach the
driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import stage, text_or_empty

SHAPE = ("f_len", "f_odd", "f_space", "f_lines", "f_distinct")
RESTAGE = 8     # the rates are written once in so many steps


def with_features(docs: DataFrame) -> DataFrame:
    """Columns for the classifier from the text ``t``, and its token count
    (runs between ASCII white space) ``n_tokens``."""
    words = F.filter(F.split("t", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    chars = F.greatest(F.length("t"), F.lit(1))
    odd = F.length(F.regexp_replace("t", r"[\p{L}\s]+", ""))
    return (docs.withColumn("words", words).withColumn("n_tokens", F.size("words").cast("long"))
            .withColumn("terms", F.array_distinct("words"))
            .withColumns({"f_len": F.log1p(F.col("n_tokens").cast("double")), "f_odd": odd / chars,
                          "f_space": F.col("n_tokens") / chars,
                          "f_lines": F.log1p(F.size(F.split("t", "\n")).cast("double")),
                          "f_distinct": F.size("terms") / F.greatest(F.col("n_tokens"), F.lit(1))}))


@dataclass
class DomainModel:
    domains: list[str]
    present: list[str]              # those with labelled documents
    pipeline: PipelineModel | None

    def posteriors(self, docs: DataFrame) -> DataFrame:
        """Adds ``n_tokens`` and ``posterior`` (array, in the order of ``domains``;
        0 for those without documents)."""
        keep = docs.columns
        scored = with_features(docs)
        if self.pipeline is None:       # one domain, or no label: equal shares
            among = self.present or self.domains
            p = F.array(*[F.lit(1.0 / len(among) if d in among else 0.0) for d in self.domains])
            return scored.select(*keep, "n_tokens", p.alias("posterior"))
        out = self.pipeline.transform(scored).withColumn("p", vector_to_array("probability"))
        p = F.array(*[F.col("p")[self.present.index(d)] if d in self.present else F.lit(0.0) for d in self.domains])
        return out.select(*keep, "n_tokens", p.alias("posterior"))


def fit_domains(docs: DataFrame, labelled: DataFrame, sample_docs: int = 2000, n_features: int = 4096) -> DomainModel:
    """``docs``: id, t; ``labelled``: id, domain. Labels without a document don't
    count. At most about ``sample_docs`` documents of each domain (the smallest
    hashes of the id) are fitted, weighted back to the domain's share. Rows
    without id or domain take no part."""
    known = docs.select("id").distinct().withColumn("has_doc", F.lit(True))
    labelled = stage(labelled.filter("domain IS NOT NULL").join(known, "id", "left"), "mixing-labels")
    sizes = {r.domain: r.n for r in labelled.groupBy("domain").agg(F.count("has_doc").alias("n")).orderBy("domain").collect()}
    domains, present = list(sizes), [d for d, n in sizes.items() if n]
    if len(present) < 2:
        return DomainModel(domains, present, None)
    fraction = F.coalesce(*[F.when(F.col("domain") == d, F.lit(min(1.0, sample_docs / sizes[d]))) for d in present])
    picked = (labelled.filter("has_doc").select("id", "domain", fraction.alias("fraction"))
              .filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < F.col("fraction") * (1 << 20)))
    number = F.coalesce(*[F.when(F.col("domain") == d, F.lit(float(k))) for k, d in enumerate(present)])
    # at most about sample_docs rows of each domain: small enough to send to every task
    train = stage(with_features(docs.join(F.broadcast(picked), "id")).withColumns({"label": number, "weight": 1 / F.col("fraction")})
                  .drop("t", "words"), "mixing-train")
    steps = [HashingTF(inputCol="terms", outputCol="tf", numFeatures=n_features, binary=True),
             VectorAssembler(inputCols=[*SHAPE, "tf"], outputCol="features"),
             LogisticRegression(family="multinomial", weightCol="weight", regParam=0.003, maxIter=40)]
    return DomainModel(domains, present, Pipeline(stages=steps).fit(train.coalesce(8)))


def rate_after(posterior: Column, steps: list[list[float]], now: Column | None = None,
               before: Column | None = None) -> Column:
    """(now, before): the rate after the given steps and the one before, from 1
    unless given. A step is [momentum, move of each domain]."""
    def double(x):
        return F.lit(float(x))
    start = F.struct((double(1) if now is None else now).alias("now"),
                     (double(1) if before is None else before).alias("before"))
    if not steps:
        return start
    moves = F.array(*[F.struct(double(s[0]).alias("b"), F.array(*[double(x) for x in s[1:]]).alias("m")) for s in steps])

    def step(r, s):
        dot = F.aggregate(F.zip_with(posterior, s["m"], lambda p, x: p * x), double(0), lambda a, b: a + b)
        return F.struct(F.greatest(double(0), r["now"] + s["b"] * (r["now"] - r["before"]) - dot).alias("now"),
                        r["now"].alias("before"))
    return F.aggregate(moves, start, step)


def fit_rates(scored: DataFrame, domains: list[str], targets: dict[str, float], tol: float = 0.002,
              max_steps: int = 200) -> tuple[list[list[float]], dict[str, float]]:
    """The steps whose sequence gives every document its rate (``rate_after``),
    and the expected totals reached. ``scored``: n_tokens, posterior.

    Projected gradient with momentum, which restarts when the error grows. As
    totals are linear in the rates, those at the extrapolated point need no
    pass of their own. Ends when every total is within ``tol`` of its target
    (of all tokens where the target is 0), or no longer changes: a target may
    be out of reach.
    """
    size = len(domains)
    want = [float(targets.get(d, 0.0)) for d in domains]

    def totals(df: DataFrame, rate: Column) -> list[float]:
        sums = df.select((rate * F.col("n_tokens")).alias("w"), "posterior").agg(
            *[F.sum(F.col("w") * F.col("posterior")[k]).alias(f"s{k}") for k in range(size)]).first()
        return [float(x or 0.0) for x in sums]

    def error(at: list[float]) -> float:
        return sum((a - t) ** 2 / b for a, t, b in zip(at, want, base) if b > 1e-12 * everything)
    base = totals(scored, F.lit(1.0))
    everything = sum(base)
    if everything == 0:
        return [], dict(zip(domains, base))
    work = scored.withColumn("rate", rate_after(F.col("posterior"), []))
    steps, pending, now, before, age = [], [], base, base, 0
    for _ in range(max_steps):
        momentum = age / (age + 3)
        ahead = [a + momentum * (a - b) for a, b in zip(now, before)]
        step = [momentum] + [(a - t) / b if b > 1e-12 * everything else 0.0 for a, t, b in zip(ahead, want, base)]
        steps.append(step)
        pending.append(step)
        rate = rate_after(F.col("posterior"), pending, F.col("rate.now"), F.col("rate.before"))
        if len(pending) == RESTAGE:
            work = stage(work.withColumn("rate", rate), "mixing-rates")
            pending, rate = [], F.col("rate")
        before, now = now, totals(work, rate["now"])
        age = 0 if error(now) > error(before) else age + 1
        met = all(abs(a - t) <= tol * (t or everything) for a, t in zip(now, want))
        if met or max(abs(a - b) for a, b in zip(now, before)) <= 1e-7 * everything:
            break
    return steps, dict(zip(domains, now))


def domain_labels(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, domain) from the label table: toxic, else good or poor by quality;
    null labels give no domain. Of repeated ids the smallest domain counts."""
    domain = (F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good")
              .when(F.col("quality") == 0, "poor"))
    return (labels.select(F.col(f"`{id_col}`").alias("id"), domain.alias("domain")).filter("id IS NOT NULL")
            .groupBy("id").agg(F.min("domain").alias("domain")))


#: shares of the token budget
WEIGHTS = {"good": 0.90, "poor": 0.08, "toxic": 0.02}


def mix(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        weights: dict[str, float] | None = None, budget: float = 1.1, keep_text: bool = False,
        sample_docs: int = 2000) -> tuple[DataFrame, dict]:
    """Fit the rates; ``budget`` is the wanted token total as a multiple of the
    input's. Returns one row per input row, ``row`` (the input row, its text
    only if ``keep_text``), ``n_tokens``, ``posterior``, ``rate``, and a report
    (domains, targets, totals reached).

    Null and empty texts have no tokens and the rate their posterior gives
    them. Repeated rows get equal rates. A domain none of whose labelled
    documents is in ``docs`` has posterior 0 everywhere, and the others share
    its weight; without any labelled document all posteriors are equal and rates
    are the budget. An empty table gives an empty result.
    """
    weights = WEIGHTS if weights is None else weights
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if keep_text or c != text_col]).alias("row"),
                      F.col(f"`{id_col}`").alias("id"), text_or_empty(f"`{text_col}`").alias("t"))
    labelled = domain_labels(labels, id_col)
    model = fit_domains(own.select("id", "t"), labelled, sample_docs)
    if not model.domains:
        model.domains = sorted(weights)
    reachable = model.present or model.domains
    scored = stage(model.posteriors(own).select("row", "n_tokens", "posterior"), "mixing-scored")
    all_tokens = float(scored.agg(F.sum("n_tokens")).first()[0] or 0)
    share = sum(weights.get(d, 0.0) for d in reachable) or 1.0
    targets = {d: budget * all_tokens * weights.get(d, 0.0) / share if d in reachable else 0.0 for d in model.domains}
    steps, reached = fit_rates(scored.select("n_tokens", "posterior"), model.domains, targets)
    out = scored.withColumn("rate", rate_after(F.col("posterior"), steps)["now"])
    return out, {"domains": model.domains, "targets": targets, "reached": reached, "steps": len(steps)}


def draw_copies(mixed: DataFrame, id_col: str = "doc_id", seed: int = 11) -> DataFrame:
    """Rows of ``row`` as often as the rate says: its whole part, and once more
    with the rest as the chance, drawn from a hash of the id."""
    u = F.pmod(F.xxhash64(F.col(f"row.`{id_col}`"), F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    n = F.floor("rate") + (u < F.col("rate") - F.floor("rate")).cast("long")
    return (mixed.withColumn("copies", n.cast("int")).filter("copies > 0")
            .select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select("row.*"))
