"""Mixing sources to target weights, with DataFrame operations only.

Every document gets a hash-random key. Rows are range-sorted by source and key, sums per range give distributed prefix
sums of the word counts, and each source is cut at its exact budget: whole epochs first, then the documents below the
key at which the rest of the budget is used up. That key is one row per source, so documents are taken by a
projection over the table and their texts never meet a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heliogrid.llm.common import word_count
from heliogrid.session import broadcast_if_small, stage_table

MAX_EPOCHS = 3
WEIGHTS = (1, 2, 3)
SEED = "mix-1"


def hash_key(doc_id: Column, seed: str = SEED) -> Column:
    """60 random bits that depend on the identity and the seed alone; null is an identity of its own."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def prefix_sums(df: DataFrame, group: list[str], order: list[str], sums: dict[str, str], label: str) -> DataFrame:
    """Add, for each (result: column) of ``sums``, the sum over earlier rows of the group, the row itself excluded.

    Rows are sorted into ranges, sums of whole ranges are added up (one row per range and group), and only the rows of
    one range meet in a window, so a group of any size is spread over many tasks. ``group`` and ``order`` have no nulls.
    """
    ranged = stage_table(df.repartitionByRange(*group, *order).withColumn("range_no", F.spark_partition_id()), label)
    totals = ranged.groupBy(*group, "range_no").agg(*[F.sum(c).alias(r) for r, c in sums.items()])
    before = Window.partitionBy(*group).orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*group, "range_no", *[F.coalesce(F.sum(r).over(before), F.lit(0)).alias(f"start_{r}") for r in sums])
    starts, _ = broadcast_if_small(stage_table(starts, f"{label}-starts"))
    inside = Window.partitionBy(*group, "range_no").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = ranged.join(starts, [*group, "range_no"])
    return joined.withColumns({r: F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.col(f"start_{r}") for r, c in sums.items()}).drop("range_no", *[f"start_{r}" for r in sums])


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Add each source's target: its weight's share of all words, but at most ``max_epochs`` times its own.

    What the capped sources cannot take is shared by weight among the others, which may cap more of them. In the order
    of words per weight the capped sources come first, so one pass of prefix sums finds them all. ``sources`` has one
    row per source: no_source, source, source_size; sources go by code point, null last, and take the weights in turn.
    """
    placed = prefix_sums(sources.withColumn("one", F.lit(1).cast("long")), [], ["no_source", "source"], {"place": "one"}, "sources")
    choice = F.array(*[F.lit(w).cast("long") for w in weights])
    weighed = placed.select("no_source", "source", "source_size", F.element_at(choice, (F.col("place") % len(weights) + 1).cast("int")).alias("weight"))
    weighed = weighed.withColumns({"cap": F.col("source_size") * max_epochs, "ratio": F.col("source_size") / F.col("weight")})
    filled = stage_table(prefix_sums(weighed, [], ["ratio", "no_source", "source"], {"caps": "cap", "weights": "weight"}, "filled"), "filled")
    all_ = filled.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight")).first()
    words, weight = all_["words"] or 0, all_["weight"] or 0
    full = (F.lit(float(words)) - F.col("caps")) * F.col("weight") > F.col("cap").cast("double") * (F.lit(weight) - F.col("weights"))
    marked = filled.withColumn("full", full | (F.col("cap") == 0))
    used = marked.agg(F.sum(F.when(F.col("full"), F.col("cap"))).alias("cap"), F.sum(F.when(F.col("full"), F.col("weight"))).alias("weight")).first()
    rest_words, rest_weight = words - (used["cap"] or 0), weight - (used["weight"] or 0)
    share = F.lit(float(rest_words)) * F.col("weight") / F.lit(float(rest_weight or 1))
    return marked.select("no_source", "source", "source_size", "weight", F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.least(share, F.col("cap").cast("double"))).alias("target"))


def sized(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", seed: str = SEED) -> dict[str, Column]:
    """What decides on a document: its source (null apart), its words, its key."""
    return {
        "no_source": F.col(f"`{source}`").isNull(),
        "source": F.coalesce(F.col(f"`{source}`").cast("string"), F.lit("")),
        "size": word_count(F.col(f"`{text}`")),
        "key": hash_key(F.col(f"`{doc_id}`"), seed),
    }


def fit_mix(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: source_size, target, epochs taken whole, and the key at which one more epoch is cut.

    ``rows`` has the columns of :func:`sized`. ``left`` words are taken from the documents of the cut key, which hold
    ``cut_size`` words (rows that share an identity share a key).
    """
    by = ["no_source", "source"]
    keys = stage_table(rows.groupBy(*by, "key").agg(F.sum("size").alias("size")), "mix-keys")
    sources = targets(keys.groupBy(*by).agg(F.sum("size").alias("source_size")), weights, max_epochs)
    whole = F.floor("target").cast("long")
    has = F.col("source_size") > 0
    plan = sources.withColumns({"epochs": F.when(has, F.expr("CAST(floor(target) AS BIGINT) div nullif(source_size, 0)")).otherwise(0).cast("long")})
    plan = stage_table(plan.withColumn("rest", F.when(has, whole - F.col("epochs") * F.col("source_size")).otherwise(0).cast("long")), "mix-plan")
    small, _ = broadcast_if_small(plan.select(*by, "rest"))
    along = prefix_sums(keys, by, ["key"], {"before": "size"}, "mix-keys-sorted").join(small, by)
    cut = along.filter((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("size")))
    cut = cut.select(*by, F.col("key").alias("cut_key"), (F.col("rest") - F.col("before")).alias("left"), F.col("size").alias("cut_size"))
    return stage_table(plan.join(cut, by, "left"), "mix-cuts")


def taken() -> Column:
    """Words that the mix takes of a document, repeats counted, from its own columns and its source's cut."""
    part = F.when(F.col("key") < F.col("cut_key"), F.col("size")).when(F.col("key") == F.col("cut_key"), F.expr("CAST(`left` * size AS DECIMAL(38, 0)) div cut_size")).otherwise(0)
    return (F.col("epochs") * F.col("size") + F.coalesce(part, F.lit(0))).cast("long")


def mix_report(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target (both of its source) and taken.

    Sources go by code point, null last. Null and empty texts have size 0 and nothing taken; a source without words
    has target 0. Rows that share a doc_id share its key; at the cut they share what is left in proportion to their
    sizes, rounded down. An empty table gives an empty table. Only the columns named are read.
    """
    cols = sized(docs, text, source, doc_id)
    rows = stage_table(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), *[c.alias(n) for n, c in cols.items()]), "mix-rows")
    cuts, _ = broadcast_if_small(fit_mix(rows, weights))
    return rows.join(cuts, ["no_source", "source"]).select("doc_id", "size", "source_size", "target", taken().alias("taken"))


def mix(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """The mix itself: ``docs`` with a row for each epoch that takes the document, all columns kept.

    A document at its source's cut appears once more with its first words, joined by single spaces. Documents of which
    nothing is taken are left out. Ties, nulls and empty tables as in :func:`mix_report`. Columns that begin with
    ``mix_`` may not occur in ``docs``.
    """
    cols = sized(docs, text, source, doc_id)
    cuts, _ = broadcast_if_small(fit_mix(docs.select(*[c.alias(n) for n, c in cols.items()]), weights))
    cuts = cuts.select(*[F.col(c).alias(f"mix_{c}") for c in ("no_source", "source", "epochs", "cut_key", "left", "cut_size")])
    rows = docs.withColumns({f"mix_{n}": c for n, c in cols.items()}).join(cuts, ["mix_no_source", "mix_source"])
    size, key, cut = F.col("mix_size"), F.col("mix_key"), F.col("mix_cut_key")
    at_cut = F.expr("CAST(CAST(mix_left * mix_size AS DECIMAL(38, 0)) div mix_cut_size AS BIGINT)")
    last = F.coalesce(F.when(key < cut, size).when(key == cut, at_cut), F.lit(0))
    copies = F.concat(F.array_repeat(size, F.col("mix_epochs").cast("int")), F.when(last > 0, F.array(last)).otherwise(F.array().cast("array<bigint>")))
    each = rows.withColumn("mix_words", F.explode(copies)).filter("mix_words > 0")
    words = F.regexp_extract_all(F.col(f"`{text}`"), F.lit(r"([^\x20\x09-\x0D]+)"), 1)
    body = F.when(F.col("mix_words") < size, F.array_join(F.slice(words, F.lit(1), F.col("mix_words").cast("int")), " ")).otherwise(F.col(f"`{text}`"))
    return each.withColumn(text, body).select(*[F.col(f"`{c}`") for c in docs.columns])
