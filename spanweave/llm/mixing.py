"""Mixing sources to target weights by iterative proportional fitting.

Documents are cells of a table source x language x topic. Raking scales the cells' tokens until their
sums over each axis meet the targets, never above what a cell has; a document is then kept with
its cell's share of kept tokens as probability. The draw is a hash of the document, so it does not
depend on partitions or attempts.

Only cells are iterated on: one row for each combination in use. They stay in Spark, and every
round is cut off by a written table.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanweave.operators.lineage import materialize

#: Target share of a category: its share of tokens to this power, scaled to one; and the share of all
#: tokens to keep.
TEMPERATURE = 0.7
KEEP = 0.5
#: Rounds over all axes end when no sum is further than this from its target, relatively.
TOLERANCE = 1e-3
MAX_ROUNDS = 20
#: Word-length classes that stand for topics where no topic column is given, by mean characters a word.
TOPIC_BOUNDS = (4.0, 5.0, 6.0)


def n_words(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def style_topic(text: Column, words: Column) -> Column:
    """A topic for tables without one: how long the words are, as a coarse class of register."""
    mean = F.length(F.coalesce(text, F.lit(""))) / F.greatest(words, F.lit(1))
    topic = F.lit(f"words-{len(TOPIC_BOUNDS)}")
    for i in reversed(range(len(TOPIC_BOUNDS))):
        topic = F.when(mean < TOPIC_BOUNDS[i] + 1, F.lit(f"words-{i}")).otherwise(topic)
    return topic


def targets(
    cells: DataFrame, axis: str, keep: float = KEEP, temperature: float = TEMPERATURE, weights: DataFrame | None = None
) -> DataFrame:
    """``axis, target``: tokens to keep of each category.

    Proportional to ``weights`` (a table ``axis, weight``; of a category without a row there, null or 0, nothing is
    kept, and rows of one category add up), else to ``tokens ** temperature``. A category that has less than
    its target gives all it has and the others share the rest, until no target exceeds what there is.
    """
    sums = cells.groupBy(axis).agg(F.sum("tokens").cast("double").alias("have"))
    if weights is None:
        sums = sums.withColumn("part", F.pow("have", F.lit(temperature)))
    else:
        named = weights.groupBy(F.col(axis).cast("string").alias("_named")).agg(F.sum("weight").cast("double").alias("_part"))
        # A weight says nothing of a category without tokens.
        part = F.when(F.col("have") > 0, F.coalesce("_part", F.lit(0.0))).otherwise(0.0)
        sums = sums.join(named, sums[axis].eqNullSafe(named["_named"]), "left").select(axis, "have", part.alias("part"))
    sums = materialize(sums, "mix-targets")
    lowest = sums.agg(F.min("part")).first()[0]
    if lowest is not None and lowest < 0:
        raise ValueError(f"a target weight of {axis} is below zero")
    total = sums.agg(F.sum("have").alias("s")).first().s or 0.0
    power = F.col("part")
    scale = 0.0
    while total:
        full = power * scale >= F.col("have")
        row = sums.agg(
            F.sum(F.when(full & (F.lit(scale) > 0), F.col("have")).otherwise(0.0)).alias("full"),
            F.sum(F.when(full & (F.lit(scale) > 0), 0.0).otherwise(power)).alias("rest"),
        ).first()
        new = (keep * total - row.full) / row.rest if row.rest else scale
        if new <= scale * (1 + 1e-9):
            break
        scale = new
    return sums.select(axis, F.least("have", power * scale).alias("target"))


def rake(cells: DataFrame, goals: dict[str, DataFrame], rounds: int = MAX_ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """``cells`` (axes and ``tokens``) with ``weight``: the tokens to keep of each cell.

    Each step multiplies the cells of a category by target over sum and cuts at what the cell has; cut
    cells are made up for in later rounds. Targets that cannot be met together are approached, and a warning tells
    how far the worst sum is from its target after the last round.
    """
    axes = list(goals)
    weighted = cells
    for axis in axes:
        weighted = weighted.join(goals[axis].withColumnRenamed("target", f"_{axis}"), cells[axis].eqNullSafe(goals[axis][axis])).drop(goals[axis][axis])
    weighted = materialize(weighted.withColumn("weight", F.col("tokens").cast("double")), "mix-cells")
    worst = None
    for _ in range(rounds):
        for axis in axes:
            sums = weighted.groupBy(F.col(axis).alias("_axis")).agg(F.sum("weight").alias("_sum"), F.first(f"_{axis}").alias("_goal"))
            scale = F.when(F.col("_sum") > 0, F.col("_goal") / F.col("_sum")).otherwise(1.0)
            sums = sums.select("_axis", scale.alias("_scale"))
            weighted = materialize(
                weighted.join(sums, weighted[axis].eqNullSafe(sums["_axis"]))
                .withColumn("weight", F.least(F.col("weight") * F.col("_scale"), F.col("tokens").cast("double")))
                .withColumn(f"_off{axis}", F.abs(F.col("_scale") - 1))
                .drop("_axis", "_scale"),
                "mix-cells",
            )
        worst = weighted.agg(F.max(F.greatest(*[F.col(f"_off{axis}") for axis in axes]))).first()[0]
        if worst is None or worst <= tolerance:
            break
    if worst is not None and worst > tolerance:
        warnings.warn(f"raking ended after {rounds} rounds with a sum {worst:.2%} from its target", stacklevel=2)
    return weighted.select(*cells.columns, "weight")


def uniform(doc_id: Column, text: Column, seed: str) -> Column:
    """A number in [0, 1) that hangs on the document alone."""
    bits = F.xxhash64(F.lit(seed), doc_id.cast("string"), text)
    return F.shiftrightunsigned(bits, 11) / F.lit(float(1 << 53))


def mix(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    language: str = "lang",
    topic: Column | None = None,
    keep: float = KEEP,
    temperature: float = TEMPERATURE,
    seed: str = "mix",
    weights: dict[str, dict[str | None, float]] | None = None,
) -> DataFrame:
    """``df``'s rows with ``_source, _lang, _topic, n_words, probability`` and ``sampled``.

    ``weights`` states target weights of categories for any of ``source``, ``language`` and ``topic``; a category
    left out there is not kept. Axes without them follow ``temperature``. Both are relative: ``keep`` is the
    share of all tokens kept, as far as the stated categories have so many.

    Null sources, languages and topics are categories of their own. Texts of any length are counted whole. A text without words weighs nothing;
    its cell's probability is that of its tokens, or 1 in a cell without any. Rows with equal ids and
    texts share one draw. An empty table stays empty. Columns with the new names are replaced.
    """
    stated = {"_source": "source", "_lang": "language", "_topic": "topic"}
    unknown = set(weights or {}) - set(stated.values())
    if unknown:
        raise ValueError(f"no such axis: {', '.join(sorted(unknown))}")
    df = df.drop("_source", "_lang", "_topic", "n_words", "probability", "sampled")
    rows = df.withColumn("n_words", n_words(F.col(text)))
    rows = rows.withColumns(
        {
            "_source": F.col(source).cast("string"),
            "_lang": F.col(language).cast("string"),
            "_topic": (topic if topic is not None else style_topic(F.col(text), F.col("n_words"))).cast("string"),
        }
    )
    axes = ["_source", "_lang", "_topic"]
    cells = materialize(rows.groupBy(*axes).agg(F.sum("n_words").alias("tokens")), "mix-counts")

    def asked(axis: str) -> DataFrame | None:
        given = (weights or {}).get(stated[axis])
        if given is None:
            return None
        return df.sparkSession.createDataFrame([(k, float(w)) for k, w in given.items()], f"{axis} string, weight double")

    raked = rake(cells, {a: targets(cells, a, keep, temperature, asked(a)) for a in axes})
    share = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(1.0)
    odds = materialize(raked.select(*[F.col(a).alias(f"c{a}") for a in axes], share.alias("probability")), "mix-odds")
    same = [rows[a].eqNullSafe(odds[f"c{a}"]) for a in axes]
    return (
        rows.join(odds, same[0] & same[1] & same[2])
        .select(*[rows[c] for c in rows.columns], odds["probability"])
        .withColumn("sampled", uniform(F.col(doc_id), F.col(text), seed) < F.col("probability"))
    )
