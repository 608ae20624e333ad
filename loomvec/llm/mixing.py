"""Mix sources to target weights: budgets down a tree of domain, language and source.

A total of tokens is divided among domains by weight, each domain's among its languages, each
language's among its sources. A node can take at most its tokens times the number of allowed
epochs. What a node cannot take goes to its siblings by weight; only what no sibling can take
is missing in the parent's own capacity, and so goes to the parent's siblings. A source
then gets whole epochs of its documents and, in seeded order of one more epoch, the
prefix that its remaining tokens pay for. Built-in functions only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomvec.session import materialise

LEVELS = ("domain", "language", "leaf_source")
_BITS = 60


@dataclass(frozen=True)
class Mix:
    """Whole-number weights by name for each level (``other`` for names not listed), and the size of the mix.

    ``domains`` maps a source to its domain. ``share`` is the wanted part of all tokens, in hundredths.
    """

    domains: Mapping[str, Sequence[str]] = field(default_factory=dict)
    domain_weights: Mapping[str, int] = field(default_factory=dict)
    language_weights: Mapping[str, int] = field(default_factory=dict)
    source_weights: Mapping[str, int] = field(default_factory=dict)
    other: int = 1
    share: int = 60
    epochs: int = 3
    seed: int = 17
    # Bits of the seeded order that each narrowing step of the prefix search fixes.
    step_bits: int = 12
    steps: int = 2


def tokens_of(text: Column) -> Column:
    """Estimated tokens: UTF-8 bytes in groups of four, rounded up."""
    return F.coalesce(F.ceil(F.octet_length(text) / 4), F.lit(0)).cast("long")


def _named(value: Column, weights: Mapping[str, int], other: int) -> Column:
    out = F.lit(other)
    for name, weight in weights.items():
        out = F.when(value == name, F.lit(weight)).otherwise(out)
    return out.cast("long")


def _domain(source: Column, mix: Mix) -> Column:
    out = F.lit("other")
    for domain, sources in mix.domains.items():
        out = F.when(source.isin(list(sources)), F.lit(domain)).otherwise(out)
    return out


def order_of(doc_id: Column, epoch: Column, seed: int) -> Column:
    """A document's place in the seeded order of an epoch: 60 bits of an MD5."""
    text = F.concat_ws("/", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def fill(children: DataFrame, parent: Sequence[str], name: str) -> DataFrame:
    """Add ``budget`` to ``children``: the parent's ``given`` divided by ``weight``, none above its ``most``.

    Children are taken by rising ``most / weight``. One is full if giving all later ones as much per weight
    as it takes would still fit into what is given; the others share the rest by weight, rounded down.
    """
    order = Window.partitionBy(*parent).orderBy(F.col("most") / F.col("weight"), name)
    before = F.coalesce(F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    later = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    full = before * F.col("weight") + F.col("most") * later <= F.col("given") * F.col("weight")
    rows = children.withColumn("full", full)
    everyone = Window.partitionBy(*parent)
    taken = F.sum(F.when(F.col("full"), F.col("most")).otherwise(0)).over(everyone)
    open_weight = F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(everyone)
    rows = rows.withColumn("taken", taken).withColumn("open", open_weight)
    part = F.expr("(given - taken) * weight div greatest(open, 1)")
    return rows.withColumn("budget", F.when(F.col("full"), F.col("most")).otherwise(F.least("most", part)).cast("long")).drop("full", "taken", "open")


def budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """``(domain, language, leaf_source, tokens, budget)`` of leaves ``(..., tokens)``; one row per source, not per document."""
    leaves = leaves.withColumn("most", F.col("tokens") * mix.epochs)
    languages = leaves.groupBy("domain", "language").agg(F.sum("most").alias("most"))
    domains = languages.groupBy("domain").agg(F.sum("most").alias("most"))
    total = leaves.agg((F.sum("tokens") * mix.share).alias("all")).select(F.expr("all div 100").alias("given"))
    rooted = domains.withColumn("root", F.lit(0)).join(total.withColumn("root", F.lit(0)), "root")
    rooted = fill(rooted.withColumn("weight", _named(F.col("domain"), mix.domain_weights, mix.other)), ["root"], "domain")
    languages = languages.join(rooted.select("domain", F.col("budget").alias("given")), "domain")
    languages = fill(languages.withColumn("weight", _named(F.col("language"), mix.language_weights, mix.other)), ["domain"], "language")
    leaves = leaves.join(languages.select("domain", "language", F.col("budget").alias("given")), ["domain", "language"])
    leaves = fill(leaves.withColumn("weight", _named(F.col("leaf_source"), mix.source_weights, mix.other)), ["domain", "language"], "leaf_source")
    return leaves.select(*LEVELS, "tokens", "budget")


def _cuts(rows: DataFrame, plan: DataFrame, mix: Mix) -> DataFrame:
    """``(leaf..., cut)``: the last place in the partial epoch's order whose prefix of tokens fits, or -1.

    Tokens are summed per group of places with the same leading bits; only the group that the limit falls into
    is looked into further, so no task orders a whole source.
    """
    keys = list(LEVELS)
    state = plan.select(*keys, "rest", F.lit(-1).cast("long").alias("cut"), F.lit(0).cast("long").alias("low"))
    width = _BITS
    places = rows.groupBy(*keys, "place").agg(F.sum("tokens").alias("tokens")) if mix.steps == 0 else None
    for step in range(mix.steps):
        width -= mix.step_bits
        if step:
            inside = rows.join(state.where("low is not null").select(*keys, "low"), keys)
            inside = inside.where(F.shiftright("place", width + mix.step_bits) == F.shiftright("low", width + mix.step_bits))
        else:
            inside = rows
        sums = inside.groupBy(*keys, F.shiftright("place", width).alias("group")).agg(F.sum("tokens").alias("tokens"))
        state = materialise(_narrow(sums, state, keys, width), "cuts")
    # Places left in the open group of each leaf: a few rows.
    inside = rows.join(state.where("low is not null").select(*keys, "low"), keys)
    inside = inside.where(F.shiftright("place", width) == F.shiftright("low", width)) if mix.steps else inside
    sums = inside.groupBy(*keys, F.col("place").alias("group")).agg(F.sum("tokens").alias("tokens"))
    return _narrow(sums, state, keys, 0).select(*keys, "cut")


def _narrow(sums: DataFrame, state: DataFrame, keys: list[str], width: int) -> DataFrame:
    """Take all groups that fit whole; the first that does not becomes the open one."""
    size = 1 << width
    up_to = F.sum("tokens").over(Window.partitionBy(*keys).orderBy("group"))
    found = sums.withColumn("up_to", up_to).join(state.select(*keys, "rest", "cut"), keys)
    fits = F.col("up_to") <= F.col("rest")
    found = found.groupBy(*keys).agg(
        F.max(F.when(fits, F.struct("group", "up_to"))).alias("last"), F.min(F.when(~fits, F.col("group"))).alias("first")
    )
    last_cut = (F.col("last.group") + 1) * size - 1
    return state.join(found, keys, "left").select(
        *keys,
        (F.col("rest") - F.coalesce("last.up_to", F.lit(0))).alias("rest"),
        F.coalesce(F.greatest("cut", last_cut), "cut").alias("cut"),
        (F.col("first") * size).alias("low"),
    )


def mix_documents(docs: DataFrame, mix: Mix) -> DataFrame:
    """The columns of ``docs (doc_id, text, lang, source, ...)`` and ``_mix (domain, language, source, tokens, epoch)``.

    One row per document and epoch in which it is used; documents beyond their source's budget give none. A null
    source or language is named ``none``, a source outside ``mix.domains`` is in domain ``other``. Texts
    without tokens (null, empty) are never selected. Rows of one doc_id and source share their place in the
    order and are taken together or not at all; an empty table gives no rows. Other columns of any name
    pass through, except one named ``_mix``.
    """
    source = F.coalesce(F.col("source").cast("string"), F.lit("none"))
    fields = {
        "domain": _domain(source, mix),
        "language": F.coalesce(F.col("lang").cast("string"), F.lit("none")),
        "leaf_source": source,
        "tokens": tokens_of(F.col("text").cast("string")),
    }
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *[c.alias(n) for n, c in fields.items()]).where("tokens > 0")
    leaves = materialise(narrow.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens")), "leaves")
    plan = budgets(leaves, mix).select(
        *LEVELS, F.expr("budget div tokens").alias("whole"), F.expr("budget % tokens").alias("rest")
    )
    plan = materialise(plan, "plan")
    placed = narrow.join(plan.select(*LEVELS, "whole"), list(LEVELS))
    placed = placed.select(*LEVELS, "tokens", order_of(F.col("doc_id"), F.col("whole"), mix.seed).alias("place"))
    placed = materialise(placed, "places")
    chosen = materialise(plan.join(_cuts(placed, plan, mix), list(LEVELS)).select(*[F.col(k).alias(f"_{k}") for k in LEVELS], F.col("whole").alias("_whole"), F.col("cut").alias("_cut")), "chosen")
    held = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != "_mix"], F.struct(*[c.alias(n) for n, c in fields.items()]).alias("_mix"))
    same = [F.col(f"_mix.{k}") == F.col(f"_{k}") for k in LEVELS]
    joined = held.where("_mix.tokens > 0").join(chosen, same[0] & same[1] & same[2])
    place = order_of(F.col("doc_id"), F.col("_whole"), mix.seed)
    times = F.col("_whole") + F.when(place <= F.col("_cut"), 1).otherwise(0)
    out = joined.withColumn("_epoch", F.explode(F.when(times > 0, F.sequence(F.lit(0).cast("long"), times - 1))))
    return out.select(
        *[F.col(f"`{c}`") for c in docs.columns if c != "_mix"],
        F.struct("_mix.domain", "_mix.language", F.col("_mix.leaf_source").alias("source"), "_mix.tokens", F.col("_epoch").cast("int").alias("epoch")).alias("_mix"),
    )
