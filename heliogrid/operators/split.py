"""Exact train/test splits and folds.

"Random" means the order of ``md5(id-seed)``: fixed under a seed and the same on any cluster.
The table is never sorted or shuffled as a whole. Rows are counted per hash prefix (and class),
only the prefixes in which a cut falls are ordered, and every row is compared with the cuts.
Ids must be unique.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heliogrid.operators.order import SORT_ROWS, rank_cuts
from heliogrid.session import stage_table

ROWS_PER_PREFIX = 1000
MAX_DIGITS = 5  # at most 16**5 hash prefixes per class
BROADCAST_CUTS = 100_000  # (class, part) pairs, each a label and a hash


def hash_order(id_col: str, seed: int = 42) -> Column:
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"-{seed}")))


def _fold_ends(n: Column, folds: int) -> Column:
    """Running sizes of all folds but the last; the first n mod k folds get one row more."""
    return F.transform(F.sequence(F.lit(1), F.lit(folds - 1)), lambda i: F.floor(n / folds) * i + F.least(i.cast("long"), n % folds))


def _class_table(df: DataFrame, label: str) -> tuple[DataFrame, int, int, int]:
    """Stored (label, n) with the number of classes, of rows, and the smallest class."""
    classes = stage_table(df.groupBy(F.col(label).alias("_l")).agg(F.count(F.lit(1)).alias("n")), "classes")
    kinds, rows, smallest = classes.agg(F.count(F.lit(1)), F.sum("n"), F.min("n")).first()
    return classes, kinds, rows or 0, smallest or 0


def _digits(rows: int) -> int:
    return min(max(math.ceil(math.log(max(rows / ROWS_PER_PREFIX, 1), 16)), 1), MAX_DIGITS)


def _part_index(
    df: DataFrame, id_col: str, label: str, seed: int, sizes: DataFrame, kinds: int, rows: int, parts: int = 1
) -> DataFrame:
    """Add ``_part``: how many of the row's class cuts lie before it in hash order.

    ``sizes`` is the class table with ``ends``, the running sizes of ``parts`` parts.
    """
    digits = _digits(rows)
    few = kinds * parts <= BROADCAST_CUTS

    def side(d: DataFrame) -> DataFrame:
        return F.broadcast(d) if few else d

    keyed = df.withColumn("_h", hash_order(id_col, seed))
    hashed = keyed.select(F.col(label).alias("_l"), F.substring("_h", 1, digits).alias("_p"), "_h")
    counts = hashed.groupBy("_l", "_p").agg(F.count(F.lit(1)).alias("_n"))
    wanted = sizes.select(F.col("_l").alias("_w"), F.explode("ends").alias("_upto"))

    # Running counts over at most 16**digits prefixes per class.
    running = Window.partitionBy("_l").orderBy("_p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = counts.withColumn("_end", F.sum("_n").over(running))
    target = spans.join(side(wanted), F.col("_l").eqNullSafe(F.col("_w")))
    target = target.filter((F.col("_end") - F.col("_n") < F.col("_upto")) & (F.col("_upto") <= F.col("_end")))
    target = target.select("_w", F.col("_p").alias("_q"), "_upto", (F.col("_upto") - F.col("_end") + F.col("_n")).alias("_k"))

    near = hashed.join(side(target), F.col("_l").eqNullSafe(F.col("_w")) & (F.col("_p") == F.col("_q")))
    place = F.row_number().over(Window.partitionBy("_w", "_upto").orderBy("_h"))
    cuts = near.withColumn("_r", place).filter("_r = _k").select("_w", F.col("_h").alias("_cut"))
    # A part of no rows ends before every hash.
    cuts = cuts.unionAll(wanted.filter("_upto = 0").select("_w", F.lit("").alias("_cut")))
    cuts = cuts.groupBy("_w").agg(F.collect_list("_cut").alias("_cuts"))

    out = keyed.join(side(cuts), F.col(label).eqNullSafe(F.col("_w")), "left")
    part = F.expr("size(filter(_cuts, c -> c < _h))")
    return out.withColumn("_part", part).drop("_h", "_w", "_cuts")


def split_exact(df: DataFrame, id_col: str, test_share: float = 0.2, seed: int = 42, out: str = "is_test") -> DataFrame:
    """Mark exactly ceil(share * n) rows as test."""
    rows = df.count()
    wanted = math.ceil(rows * test_share)
    if wanted == 0:
        return df.withColumn(out, F.lit(False))
    prefix = F.substring("_h", 1, _digits(rows))
    hashed = df.select(hash_order(id_col, seed).alias("_h"))
    # At most 16**digits counts are summed up; the prefix that holds the last test row comes back.
    running = Window.partitionBy(F.lit(0)).orderBy("_p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = hashed.groupBy(prefix.alias("_p")).agg(F.count(F.lit(1)).alias("_n")).withColumn("_end", F.sum("_n").over(running))
    place = spans.filter((F.col("_end") - F.col("_n") < wanted) & (F.col("_end") >= wanted)).first()
    last = hashed.filter(prefix == place["_p"]).orderBy("_h").offset(wanted - place["_end"] + place["_n"] - 1).first()["_h"]
    return df.withColumn(out, hash_order(id_col, seed) <= last)


def class_quotas(classes: DataFrame, test_share: float) -> DataFrame:
    """Test rows per class: shares of ceil(share * n) rounded by largest remainder.

    The windows run over the class table, one row per class.
    """
    every = Window.partitionBy(F.lit(0))
    total = F.sum("n").over(every)
    df = classes.withColumn("_total", total).withColumn("_test", F.ceil(F.col("_total") * F.lit(test_share)))
    df = df.withColumn("_base", F.floor(F.col("n") * F.col("_test") / F.col("_total")))
    df = df.withColumn("_rest", F.col("n") * F.col("_test") - F.col("_base") * F.col("_total"))
    order = F.row_number().over(every.orderBy(F.desc("_rest"), F.asc("_l")))
    extra = F.when(order <= F.col("_test") - F.sum("_base").over(every), 1).otherwise(0)
    df = df.withColumn("ends", F.array((F.col("_base") + extra).cast("long")))
    return df.drop("_total", "_test", "_base", "_rest")


def split_stratified(
    df: DataFrame, id_col: str, label: str, test_share: float = 0.2, seed: int = 42, out: str = "is_test"
) -> DataFrame:
    """Mark test rows class by class; falls back to a plain split if a class has a single row."""
    classes, kinds, rows, smallest = _class_table(df, label)
    if smallest < 2:
        return split_exact(df, id_col, test_share, seed, out)
    marked = _part_index(df, id_col, label, seed, class_quotas(classes, test_share), kinds, rows)
    return marked.withColumn(out, F.col("_part") == 0).drop("_part")


def kfold_stratified(df: DataFrame, id_col: str, label: str, folds: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    """Shuffled folds 0..k-1 of nearly equal size within every class."""
    classes, kinds, rows, _ = _class_table(df, label)
    sizes = classes.withColumn("ends", _fold_ends(F.col("n"), folds))
    return _part_index(df, id_col, label, seed, sizes, kinds, rows, folds).withColumnRenamed("_part", out)


def kfold_contiguous(df: DataFrame, order_col: str, folds: int = 5, out: str = "fold", sort_rows: int = SORT_ROWS) -> DataFrame:
    """Unshuffled folds 0..k-1 along a unique numeric column; the first n mod k get one row more."""
    total = df.count()
    sizes = [total // folds + (1 if i < total % folds else 0) for i in range(folds)]
    lasts = [sum(sizes[: i + 1]) - 1 for i in range(folds - 1)]
    cuts = rank_cuts(df, order_col, [r for r in lasts if r >= 0], total, sort_rows)
    fold = sum(((F.col(order_col) > F.lit(c)).cast("int") for c in cuts), F.lit(0))
    return df.withColumn(out, fold)
