"""Problem 9: mix sources so that each contributes a target share of the tokens, with capped repeats.

Method: entropy balancing. Among all document rates r the one nearest in relative entropy to an even
rate q is sought that meets each source's tokens, sum(r * t) = share * T. The dual is convex, and its
solution tilts the even rate exponentially by the document's tokens: r = min(cap, q * exp(lambda * t / mean)).
Newton's iteration finds each source's lambda; every iteration is one aggregation over all
documents. The total T is the largest for which no source needs more than its cap. Rates become
whole copies by a hash of the id against the fraction; a cutoff for each source and size class, from
one aggregation into bins, then brings the rounded tokens to the target, large documents first.

Scale: an iteration sends one row of sums per source and task; only the multipliers, one per target
source, are held by the driver. There is no group by source and no ordering of documents.

Defined cases: sources without a target (or with share 0, or null) get 0 copies; documents without
tokens get 0 copies, as they can't change a share; a target source without any token can't be met
and is left out, its share being shared out among the others in proportion; repeated rows of an id
count once; null caps mean 1; with no usable target all copies are 0. Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumix.storage import written

from .tokens import sized

ROUNDS, TOLERANCE = 40, 1e-9
BINS = 256


def _rate(q: float) -> Column:
    return F.least(F.col("cap"), F.lit(q) * F.exp(F.least(F.col("lam") * F.col("tokens") / F.col("mean"), F.lit(50.0))))


def balanced(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """(id, source, tokens, rate, copies) for docs (id, source, tokens) and targets (source, target_share, max_repeats)."""
    spark = docs.sparkSession
    wish = {r.source: (float(r.target_share), float(r.max_repeats if r.max_repeats is not None else 1)) for r in targets.filter("source IS NOT NULL AND target_share > 0").collect()}  # one row per source of the target list
    have = {r.source: (r.n, float(r.t)) for r in docs.filter("tokens > 0").join(F.broadcast(targets.select("source").distinct()), "source", "left_semi").groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("t")).collect()}
    wish = {s: w for s, w in wish.items() if s in have and w[1] > 0}
    if not wish:
        return docs.select("id", "source", "tokens", F.lit(0.0).alias("rate"), F.lit(0).alias("copies"))
    whole = sum(w[0] for w in wish.values())
    share = {s: w[0] / whole for s, w in wish.items()}
    total = min(wish[s][1] * have[s][1] / share[s] for s in wish)
    q = total / sum(have[s][1] for s in wish)
    goal = {s: share[s] * total for s in wish}
    lam = {s: 0.0 for s in wish}
    bound = {s: goal[s] >= wish[s][1] * have[s][1] * (1 - 1e-9) for s in wish}  # every document at its cap

    def with_state(**more) -> DataFrame:
        rows = [(s, wish[s][1], have[s][1] / have[s][0], 1e9 if bound[s] else lam[s], goal[s], *(m[s] for m in more.values())) for s in wish]
        state = spark.createDataFrame(rows, "source string, cap double, mean double, lam double, goal double" + "".join(f", {k} double" for k in more))
        return docs.filter("tokens > 0").join(F.broadcast(state), "source")

    low, high = {s: -60.0 for s in wish}, {s: 60.0 for s in wish}
    for _ in range(ROUNDS):
        r = _rate(q)
        seen = with_state().groupBy("source").agg(F.sum(r * F.col("tokens")).alias("got"), F.sum(F.when(r < F.col("cap"), r * F.col("tokens") * F.col("tokens") / F.col("mean")).otherwise(0.0)).alias("slope")).collect()
        worst = 0.0
        for row in seen:
            s = row.source
            if bound[s]:
                continue
            gap = row.got - goal[s]
            worst = max(worst, abs(gap) / goal[s])
            low[s], high[s] = (low[s], min(high[s], lam[s])) if gap > 0 else (max(low[s], lam[s]), high[s])
            step = lam[s] - gap / row.slope if row.slope > 0 else math.nan
            lam[s] = step if low[s] < step < high[s] else (low[s] + high[s]) / 2  # Newton, kept within its bracket
        if worst < TOLERANCE:
            break
    rated = written(with_state().select("id", "source", "tokens", F.least(F.col("cap"), _rate(q)).alias("rate"), "cap", "goal"), "rated")
    # rounding: one copy more where the fraction exceeds the hash of the id by the cutoff of its size class
    chance = F.pmod(F.xxhash64(F.lit(9), "id"), F.lit(1 << 40)).cast("double") / float(1 << 40)
    edge = F.col("rate") - F.floor("rate") - chance
    slot = F.when(F.floor("rate") < F.col("cap"), F.least(F.lit(BINS - 1), F.floor((edge + 1) * (BINS // 2)))).otherwise(-1).cast("int")
    rows = rated.select("id", "source", "tokens", "rate", F.floor("rate").cast("int").alias("base"), F.floor(F.log2("tokens")).cast("int").alias("cls"), slot.alias("slot"))
    sums: dict[tuple[str, int], list] = {}
    for r in rows.groupBy("source", "cls", "slot").agg(F.sum(F.col("rate") * F.col("tokens")).alias("want"), F.sum(F.col("base") * F.col("tokens")).alias("base"), F.sum("tokens").alias("extra")).collect():  # sources x classes x bins
        sums.setdefault((r.source, r.cls), []).append(r)
    cut: list[tuple[str, int, int]] = []
    carry = dict.fromkeys(wish, 0.0)
    for s, c in sorted(sums, key=lambda k: -k[1]):  # what large documents miss is made up by smaller ones
        group = sorted(sums[s, c], key=lambda r: -r.slot)
        open_ = carry[s] + sum(r.want for r in group) - sum(r.base for r in group)
        best, at = abs(open_), BINS
        got = 0
        for r in group:
            if r.slot >= 0:
                got += r.extra
                if abs(open_ - got) < best:
                    best, at = abs(open_ - got), r.slot
        carry[s] = open_ - sum(r.extra for r in group if r.slot >= at)
        cut.append((s, c, at))
    state = spark.createDataFrame(cut, "source string, cls int, cutoff int")
    done = rows.join(F.broadcast(state), ["source", "cls"]).select("id", "source", "tokens", "rate", (F.col("base") + F.when(F.col("slot") >= F.col("cutoff"), 1).otherwise(0)).alias("copies"))
    state = spark.createDataFrame([(s,) for s in wish], "source string")
    idle = docs.join(F.broadcast(state.select("source", F.lit(True).alias("wanted"))), "source", "left").filter("wanted IS NULL OR tokens <= 0 OR tokens IS NULL")
    return done.unionByName(idle.select("id", "source", "tokens", F.lit(0.0).alias("rate"), F.lit(0).alias("copies")))


def mixture(df: DataFrame, targets: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Copies of every document, by token count."""
    rows = df.select(F.col(id_col).alias("id"), "source", F.col(text).alias("text")).filter("id IS NOT NULL")
    docs = sized(rows, ["id", "source"], "text", **options).groupBy("id").agg(F.max(F.struct("tokens", "source")).alias("d")).select("id", "d.source", "d.tokens")
    return balanced(written(docs, "sizes"), targets).withColumnRenamed("id", id_col)


def shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """Target and reached share of each source, its tokens once and in the mixture, and its largest number of copies."""
    by = mixed.groupBy("source").agg(F.sum("tokens").alias("source_tokens"), F.sum(F.col("copies") * F.col("tokens")).alias("mixed_tokens"), F.max("copies").alias("most_copies"))
    total = by.agg(F.sum("mixed_tokens")).first()[0] or 1
    wish = targets.select("source", "target_share", "max_repeats")
    return by.join(F.broadcast(wish), "source", "full").select("source", "target_share", (F.coalesce("mixed_tokens", F.lit(0)) / F.lit(total)).alias("reached_share"), "source_tokens", "mixed_tokens", "most_copies", "max_repeats")
