"""Mixing sources to target weights by temperature, realised as block permutations.

A source's weight is its share of all tokens, raised to an exponent and normalised.
Exponent 1 keeps the shares, 0 makes all sources equal. The exponent is bisected to meet
a target entropy, or to keep the repetition of small sources below a limit: six
bisection steps are one aggregate over the sources, which answers for 64 exponents.

A source's weight gives it a quota of the token budget. It is used whole as many times
as the quota allows; of one more pass, the documents that come first in that pass's
permutation are used until the quota is reached. A pass permutes the blocks of a source
(documents dealt to blocks by hash) and the documents in a block, both by hash of seed
and pass, so a pass needs no sort of the source: sums over blocks find the block that the
quota ends in, and only its documents are put in order.

Tokens are words here. Null texts count as empty, null sources as a source; a source
without tokens has weight 0 and is not used. Rows that repeat a doc_id are used alike.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reviewtide.llm.common import free, text_or_empty
from reviewtide.operators.sizing import checked_broadcast
from reviewtide.session import Workspace

BLOCK_DIGITS = 3  # a source has up to 4096 blocks
STEPS_AT_ONCE = 6
ROUNDS = 6  # 36 bisection steps


@dataclass(frozen=True)
class Mix:
    """What to aim at.

    ``entropy``: at least this part of the largest possible entropy of the weights.
    ``max_repeats``: no source is used more often than this; it has priority.
    ``budget``: tokens as a multiple of all tokens; None: the fewest for which every
    document is used at least once.
    """

    entropy: float | None = None
    max_repeats: float | None = None
    budget: float | None = None
    seed: int = 0

    def __post_init__(self):
        if self.budget is not None and self.max_repeats is not None and self.budget > self.max_repeats:
            raise ValueError("a budget above max_repeats repeats every source too often")


def n_tokens(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def source_tokens(sized: DataFrame) -> DataFrame:
    return sized.groupBy("source").agg(F.sum("n_tokens").alias("tokens"))


def _figures(exponents: list[float], sources: DataFrame, total: int) -> list[tuple]:
    """For each exponent: sum of powers, entropy, the largest w/p, the smallest w/p."""
    share = F.col("tokens") / F.lit(float(total))
    used = sources.filter("tokens > 0").select(share.alias("p"), F.log(share).alias("ln"))
    aggregates = []
    for k, a in enumerate(exponents):
        power = F.exp(F.lit(a) * F.col("ln"))
        aggregates += [
            F.sum(power).alias(f"z{k}"),
            F.sum(power * F.lit(a) * F.col("ln")).alias(f"e{k}"),
            F.max(power / F.col("p")).alias(f"most{k}"),
            F.min(power / F.col("p")).alias(f"least{k}"),
        ]
    row = used.agg(*aggregates).first()
    figures = []
    for k in range(len(exponents)):
        z, e, most, least = (row[f"{n}{k}"] for n in ("z", "e", "most", "least"))
        entropy = 0.0 if not z else log(z) - e / z
        figures.append((z, entropy, most, least))
    return figures


def bisected(sources: DataFrame, total: int, enough, low: float = 0.0, high: float = 1.0) -> float:
    """The largest exponent (to 36 bits) at which ``enough`` holds; it holds below, not above."""
    for _ in range(ROUNDS):
        n = 1 << STEPS_AT_ONCE
        grid = [low + (high - low) * k / n for k in range(n + 1)]
        holds = [enough(f) for f in _figures(grid[1:], sources, total)]
        k = holds.index(False) if False in holds else n
        if k == n:
            return high
        low, high = grid[k], grid[k + 1]
    return low


def exponent(sources: DataFrame, mix: Mix) -> float:
    """Between 0 and 1: the largest exponent of enough entropy, or the smallest of few enough repeats."""
    total, n = sources.filter("tokens > 0").agg(
        F.coalesce(F.sum("tokens"), F.lit(0)), F.count(F.lit(1))
    ).first()
    if n < 2:
        return 1.0
    found = 1.0
    if mix.entropy is not None:
        target = mix.entropy * log(n)
        found = bisected(sources, total, lambda f: f[1] >= target)
    if mix.max_repeats is not None:

        def too_often(f) -> bool:
            z, _, most, least = f
            repeats = most / least if mix.budget is None else mix.budget * most / z
            return repeats > mix.max_repeats

        if mix.entropy is None or too_often(_figures([found], sources, total)[0]):
            low = found if mix.entropy is not None else 0.0
            if low == 0.0 and not too_often(_figures([0.0], sources, total)[0]):
                return 0.0
            at = bisected(sources, total, too_often, low)
            found = min(1.0, at + (1.0 - low) / (1 << STEPS_AT_ONCE * ROUNDS)) if at < 1.0 else 1.0
    return found


def quotas(sources: DataFrame, mix: Mix) -> DataFrame:
    """Per source: tokens, exponent, weight, quota (tokens to use), passes, remainder."""
    a = exponent(sources, mix)
    total, = sources.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()
    used = sources.filter("tokens > 0")
    z, _, _, least = _figures([a], sources, total)[0] if total else (1.0, 0.0, 1.0, 1.0)
    power = F.exp(F.lit(a) * F.log(F.col("tokens") / F.lit(float(total))))
    # Without a budget the least repeated source is used once: w * budget = tokens for it.
    budget = float(total) * (z / least if mix.budget is None else mix.budget)
    weight = F.when(F.col("tokens") > 0, power / F.lit(z)).otherwise(F.lit(0.0))
    quota = F.round(weight * F.lit(budget)).cast("bigint")
    return sources.select("source", "tokens", F.lit(a).alias("exponent"), weight.alias("weight"), quota.alias("quota")).select(
        "*",
        F.when(F.col("tokens") > 0, F.expr("quota div tokens")).otherwise(0).cast("bigint").alias("passes"),
        F.when(F.col("tokens") > 0, F.col("quota") % F.col("tokens")).otherwise(0).cast("bigint").alias("remainder"),
    )


def _hash(*parts: Column) -> Column:
    return F.md5(F.concat_ws(":", *(F.coalesce(p.cast("string"), F.lit("null")) for p in parts)))


def block_of(seed: int) -> Column:
    return F.substring(_hash(F.lit(seed), F.col("doc_id")), 1, BLOCK_DIGITS)


def block_key(seed: int, pass_: Column) -> Column:
    return _hash(F.lit(seed), pass_, F.col("source"), block_of(seed))


def document_key(seed: int, pass_: Column) -> Column:
    return _hash(F.lit(seed), pass_, F.col("doc_id"))


def _same_source(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def last_used(sized: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """Per source, where its last pass ends: (source, cut_block, cut_document), keys included.

    A cut at ('', '') uses nothing; the key of the block before the one that the quota
    ends in, if no document of that block fits.
    """
    narrow = sized.withColumn("block", block_of(seed))
    sums = narrow.groupBy("source", "block").agg(F.sum("n_tokens").alias("tokens"))
    p = plan.select(F.col("source").alias("of"), "passes", "remainder")
    keyed = sums.join(p, _same_source("source", "of")).withColumn(
        "block_key", _hash(F.lit(seed), F.col("passes"), F.col("source"), F.col("block"))
    )
    order = Window.partitionBy("source").orderBy("block_key")
    running = keyed.withColumn("upto", F.sum("tokens").over(order))
    ends_in = running.filter(
        (F.col("upto") > F.col("remainder")) & (F.col("upto") - F.col("tokens") <= F.col("remainder"))
    ).groupBy("source").agg(
        F.min(F.struct("block_key", "block", "passes", (F.col("remainder") - F.col("upto") + F.col("tokens")).alias("room"))).alias("b")
    ).select(F.col("source").alias("of"), "b.*")
    inside = (
        narrow.withColumnRenamed("block", "own_block")
        .join(ends_in, _same_source("source", "of") & (F.col("own_block") == F.col("block")))
        .withColumn("document_key", document_key(seed, F.col("passes")))
    )
    by_document = Window.partitionBy("source").orderBy("document_key")
    fitting = inside.withColumn("upto", F.sum("n_tokens").over(by_document))
    return fitting.groupBy("source").agg(
        F.min("block_key").alias("cut_block"),
        F.coalesce(
            F.max(F.when(F.col("upto") <= F.col("room"), F.col("document_key"))), F.lit("")
        ).alias("cut_document"),
    )


def mixture(docs: DataFrame, ws: Workspace, mix: Mix) -> DataFrame:
    """``docs`` with n_tokens, exponent, weight, copies; a row of ``docs`` each.

    The table of sources is measured before it is broadcast; beyond the limit the join
    shuffles, and adaptive execution splits the hot sources.
    """
    added = ("n_tokens", "exponent", "weight", "copies")
    names = [f"`{c}`" for c in docs.columns if c not in added]
    sized = ws.write(
        docs.select("doc_id", "source", n_tokens(text_or_empty()).alias("n_tokens")), "sized"
    )
    plan = ws.write(quotas(ws.write(source_tokens(sized), "sources"), mix), "quotas")
    cuts = last_used(sized, plan, mix.seed).withColumnRenamed("source", "of")
    own_source, plan_ = free(docs, "_source", "_plan")
    whole = F.struct("exponent", "weight", "passes", "remainder", "cut_block", "cut_document")
    decided = ws.write(
        plan.join(cuts, _same_source("source", "of"), "left").select(
            F.col("source").alias(own_source), whole.alias(plan_)
        ),
        "decided",
    )

    def of(name: str) -> Column:
        return F.col(f"{plan_}.{name}")

    block = block_key(mix.seed, of("passes"))
    document = document_key(mix.seed, of("passes"))
    in_last_pass = (of("remainder") > 0) & (
        (block < of("cut_block")) | ((block == of("cut_block")) & (document <= of("cut_document")))
    )
    copies = of("passes") + F.when(F.coalesce(in_last_pass, F.lit(False)), 1).otherwise(0)
    return (
        docs.select(*names)
        .join(checked_broadcast(decided), _same_source("source", own_source), "left")
        .select(
            *names,
            n_tokens(text_or_empty()).alias("n_tokens"),
            of("exponent").alias("exponent"),
            of("weight").alias("weight"),
            copies.cast("bigint").alias("copies"),
        )
    )


def realised(docs: DataFrame, ws: Workspace, mix: Mix) -> DataFrame:
    """The mixture itself: a row for each use of a document, with ``pass`` and its place.

    Sorting by (pass, block_key, document_key) gives a source's permutation of that pass.
    """
    used = mixture(docs, ws, mix).filter("copies > 0")
    each = used.withColumn("pass", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    return each.withColumn("block_key", block_key(mix.seed, F.col("pass"))).withColumn(
        "document_key", document_key(mix.seed, F.col("pass"))
    )
