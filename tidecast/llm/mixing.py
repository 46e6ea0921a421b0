"""Mixing sources to target weights by temperature.

The token share p of each source is raised to an exponent a and normalised: w = p^a / sum(p^a). The
exponent is bisected to the largest one (nearest to the natural shares) whose weights reach a target
entropy; if some source would then be repeated too often, it is raised until none is. The weights
become token quotas of the budget, and a quota becomes draws: whole passes over the source, then the
beginning of one more. Each pass has its own permutation, made of blocks: documents fall into blocks
by a hash and are ordered by it inside, so a pass is cut at a (block, hash) border that is found from
block totals and one block's documents.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.llm.common import text_or_empty
from tidecast.sources.storage import materialise

#: Share of the largest possible entropy (all sources equal) that the mix must reach.
TARGET_ENTROPY = 0.95
#: Passes over a source that no source exceeds (unless the natural shares need more).
MAX_PASSES = 4.0
SEED = 11
BLOCK_DOCS = 4096
#: Exponents are multiples of 2^-BISECTION_BITS; a pass over the totals narrows by SECTIONS.
BISECTION_BITS, SECTIONS = 20, 32


def words_in(text: Column) -> Column:
    """Number of words between ASCII white space, and one for the end of the text."""
    parts = F.split(text, "[ \\t\\n\\x0B\\f\\r]+")
    empty = (F.element_at(parts, 1) == "").cast("long") + ((F.size(parts) > 1) & (F.element_at(parts, -1) == "")).cast("long")
    return F.size(parts).cast("long") - empty + 1


def source_totals(docs: DataFrame) -> DataFrame:
    """``mix_source, total, members``: tokens and documents of each source (null is a source of its own)."""
    counted = docs.select(F.col("source").cast("string").alias("mix_source"), words_in(text_or_empty()).alias("tokens"))
    return counted.groupBy("mix_source").agg(F.sum("tokens").alias("total"), F.count(F.lit(1)).alias("members"))


def _measure(shares: DataFrame, exponents: list[float], spread: bool) -> list[tuple[float, float]]:
    """Of each exponent: entropy of the weights, and the most passes over a source.

    With ``spread`` passes are counted so that no source has less than one; else of a budget of all tokens.
    """
    log_p = F.log(F.col("share"))
    columns = []
    for k, a in enumerate(exponents):
        power = F.exp(log_p * a)
        columns += [F.sum(power).alias(f"z{k}"), F.sum(power * log_p).alias(f"s{k}")]
        columns += [F.max(power / F.col("share")).alias(f"hi{k}"), F.min(power / F.col("share")).alias(f"lo{k}")]
    row = shares.agg(*columns, F.max(F.log("share")).alias("_")).select(
        *[F.log(f"z{k}") - a * F.col(f"s{k}") / F.col(f"z{k}") for k, a in enumerate(exponents)],
        *[F.col(f"hi{k}") / (F.col(f"lo{k}") if spread else F.col(f"z{k}")) for k in range(len(exponents))],
    ).first()
    return list(zip(row[: len(exponents)], row[len(exponents) :], strict=True))


def _border(holds, low_holds: bool) -> int:
    """Bisect 0 .. 2^BITS, SECTIONS parts at a time: the last number for which ``holds`` says what it says at 0.

    ``holds`` takes a list of numbers and is monotone; ``low_holds`` is its value at 0.
    """
    low, high = 0, 2**BISECTION_BITS
    if holds([high])[0] == low_holds:
        return high
    while high - low > 1:
        step = max(1, (high - low) // SECTIONS)
        inner = list(range(low + step, high, step))
        for at, said in zip(inner, holds(inner), strict=True):
            if said == low_holds:
                low = at
            else:
                high = at
                break
    return low


def exponent(totals: DataFrame, target_entropy: float, max_passes: float, budget_tokens: int | None) -> float:
    """The exponent for :func:`quotas`; at 1 the shares stay as they are, at 0 all sources weigh the same."""
    whole = totals.agg(F.sum("total"), F.count(F.lit(1))).first()
    if not whole[1]:
        return 1.0
    shares = totals.select((F.col("total") / F.lit(whole[0])).alias("share"))
    unit = 2.0**-BISECTION_BITS
    scale = 1.0 if budget_tokens is None else budget_tokens / whole[0]
    floor = target_entropy * math.log(whole[1])
    spread = budget_tokens is None
    # entropy falls as the exponent grows: the last one that still reaches the target
    flat = _border(lambda ks: [h >= floor - 1e-12 for h, _ in _measure(shares, [k * unit for k in ks], spread)], True)
    # passes fall as well: the first one that keeps the limit
    within = [r * scale <= max_passes + 1e-12 for _, r in _measure(shares, [0.0, 1.0], spread)]
    if within[0] or not within[1]:
        often = 0 if within[0] else 2**BISECTION_BITS
    else:
        often = 1 + _border(lambda ks: [r * scale > max_passes + 1e-12 for _, r in _measure(shares, [k * unit for k in ks], spread)], True)
    return max(flat, often) * unit


def quotas(docs: DataFrame, target_entropy: float, max_passes: float, budget_tokens: int | None) -> DataFrame:
    """A row for each source: weight, quota, whole passes, and the border of the last, partial pass."""
    totals = materialise(source_totals(docs), "source-totals")
    a = exponent(totals, target_entropy, max_passes, budget_tokens)
    power = F.exp(F.log("total") * a)
    sums = totals.agg(F.sum(power).alias("z"), F.max(F.col("total") / power).alias("most"))
    # without a budget: as many tokens as draw the most underweighted source exactly once
    budget = F.lit(float(budget_tokens)) if budget_tokens is not None else F.col("most") * F.col("z")
    wanted = F.floor(F.col("weight") * F.col("budget") + 1e-6).cast("long")
    planned = (
        totals.join(sums)
        .select("*", (power / F.col("z")).alias("weight"), budget.alias("budget"))
        .withColumn("quota", wanted if budget_tokens is not None else F.greatest(wanted, "total"))
        .select("mix_source", "members", "total", "weight", "quota", F.expr("quota div total").alias("passes"), F.lit(a).alias("exponent"))
        .withColumn("rest", F.col("quota") - F.col("passes") * F.col("total"))
    )
    return materialise(planned, "quotas")


def _placed(rows: DataFrame) -> DataFrame:
    """Hash and block of each draw; needs doc_id, pass and members."""
    mixed = F.xxhash64(F.lit(SEED), F.col("pass"), F.col("doc_id"))
    blocks = F.greatest(F.lit(1), F.ceil(F.col("members") / BLOCK_DOCS)).cast("long")
    return rows.withColumn("place", mixed).withColumn("block", F.pmod(F.shiftright("place", 16), blocks))


def borders(counted: DataFrame, plan: DataFrame) -> DataFrame:
    """``mix_source, cut_block, cut_place``: draws of the last pass up to this border fill its quota.

    ``counted`` has ``mix_source, doc_id, tokens``. Sums are combined in tasks, so a source with a third
    of all rows is a few block totals; only the block at the border is looked at document by document.
    """
    last = plan.where("rest > 0").select("mix_source", "members", "rest", F.col("passes").alias("pass"))
    rows = _placed(
        counted.alias("c").join(last.alias("l"), F.expr("c.mix_source <=> l.mix_source")).select("c.*", "l.members", "l.rest", "l.pass")
    )
    totals = rows.groupBy("mix_source", "block", "rest").agg(F.sum("tokens").alias("tokens"))
    by_block = Window.partitionBy("mix_source").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    running = totals.withColumn("after", F.sum("tokens").over(by_block)).where("after - tokens <= rest")
    at = running.groupBy("mix_source").agg(F.max("block").alias("cut_block"), F.max_by(F.col("after") - F.col("tokens"), "block").alias("before"))
    inside = (
        rows.alias("r").join(at.alias("t"), F.expr("r.mix_source <=> t.mix_source and r.block = t.cut_block"))
        .select("r.mix_source", "r.place", "r.rest", "r.tokens", "t.cut_block", "t.before")
        .groupBy("mix_source", "place", "rest", "cut_block", "before")
        .agg(F.sum("tokens").alias("tokens"))
    )
    by_place = Window.partitionBy("mix_source").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    taken = inside.withColumn("after", F.col("before") + F.sum("tokens").over(by_place)).withColumn("in", F.col("after") <= F.col("rest"))
    return taken.groupBy("mix_source", "cut_block").agg(F.max(F.when(F.col("in"), F.col("place"))).alias("cut_place"))


def draws(docs: DataFrame, target_entropy: float = TARGET_ENTROPY, max_passes: float = MAX_PASSES, budget_tokens: int | None = None) -> DataFrame:
    """A row for each draw: ``row`` (struct of all columns of ``docs``) and ``mix`` (struct).

    ``mix`` holds ``source, pass`` (from 0), ``block``, ``place`` (order inside the block), ``passes`` (whole
    ones), ``quota`` and ``weight`` of the source. ``docs`` needs ``doc_id``, ``text`` and ``source``. Tokens are
    words and one end. Without ``budget_tokens`` every document is drawn at least once, and sources with
    a raised weight more often. Rows of one ``doc_id`` in a source stand and fall together; null ids are
    one such id, a null source is a source, null text has the end only. An empty table gives no draws.
    The texts are not shuffled unless there are more sources than a broadcast join takes.
    """
    own = docs.columns
    plan = quotas(docs, target_entropy, max_passes, budget_tokens)
    counted = docs.select(
        F.col("source").cast("string").alias("mix_source"), F.col("doc_id").cast("long").alias("doc_id"), words_in(text_or_empty()).alias("tokens")
    )
    cut = borders(counted, plan)
    plan = materialise(
        plan.alias("p").join(cut.alias("c"), F.expr("p.mix_source <=> c.mix_source"), "left").select("p.*", "c.cut_block", "c.cut_place"), "mix-plan"
    )
    packed = docs.select(F.struct(*own).alias("row"))
    joined = packed.alias("d").join(plan.alias("p"), F.expr("cast(d.row.source as string) <=> p.mix_source"))
    rows = _placed(
        joined.select("row", "p.*", F.col("row.doc_id").cast("long").alias("doc_id"), F.explode(F.expr("sequence(0L, passes)")).alias("pass"))
    )
    whole = F.col("pass") < F.col("passes")
    partial = (F.col("block") < F.col("cut_block")) | ((F.col("block") == F.col("cut_block")) & (F.col("place") <= F.col("cut_place")))
    kept = rows.where(whole | F.coalesce(partial, F.lit(False)))
    mix = F.struct(F.col("mix_source").alias("source"), "pass", "block", "place", "passes", "quota", "weight", "exponent")
    return kept.select("row", mix.alias("mix"))


def mixture(docs: DataFrame, target_entropy: float = TARGET_ENTROPY, max_passes: float = MAX_PASSES, budget_tokens: int | None = None) -> DataFrame:
    """One row per draw: ``doc_id, source, n_tokens, pass, block, block_rank, mix_position, weight``.

    ``mix_position`` (0 to 1) is the share of the source's quota before the draw: in its order every
    beginning of the mix holds the sources by their weights. See :func:`draws` for the cases.
    """
    slim = docs.select("doc_id", "source", "text")
    drawn = draws(slim, target_entropy, max_passes, budget_tokens).select(
        F.col("row.doc_id").cast("long").alias("doc_id"), "mix.*", words_in(text_or_empty("row.text")).alias("n_tokens")
    )
    drawn = materialise(drawn, "draws")
    order = Window.partitionBy("source", "pass", "block").orderBy("place", "doc_id", "n_tokens")
    earlier = Window.partitionBy("source").orderBy("pass", "block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = drawn.groupBy("source", "pass", "block").agg(F.sum("n_tokens").alias("tokens"))
    blocks = blocks.withColumn("before", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)))
    ranked = drawn.withColumn("block_rank", F.row_number().over(order).cast("long")).withColumn(
        "inside", F.sum("n_tokens").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_tokens")
    )
    return ranked.alias("d").join(blocks.alias("b"), F.expr("d.source <=> b.source and d.pass = b.pass and d.block = b.block")).select(
        "d.doc_id", "d.source", "d.n_tokens", "d.pass", "d.block", "d.block_rank",
        ((F.col("b.before") + F.col("d.inside")) / F.col("d.quota")).alias("mix_position"), "d.weight",
    )
