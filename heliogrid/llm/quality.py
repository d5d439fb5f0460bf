"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and one failure bit per rule, so a
policy, which is a versioned set of bits, is applied later without reading a text again, and an ablation (what
would change without one rule) is a bitwise aggregation over the few distinct masks.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from heliogrid.llm.common import SPACES, strings

SYMBOLS = "#*$%&|<>"

MEASURES = {
    "n_words": "words",
    "word_chars": "code points in words",
    "n_symbols": "characters of SYMBOLS",
    "n_lines": "lines with a word",
    "n_dup_lines": "lines with a word that equal an earlier line",
    "n_repeat_words": "words in 3-word windows that occur at least twice",
    "n_shouted": "words that end in two exclamation marks",
    "n_upper": "letters A-Z",
    "n_lower": "letters a-z",
}


@dataclass(frozen=True)
class Rule:
    """A document fails the rule where ``fails`` holds for its struct of measures."""

    name: str
    fails: Callable[[Column], Column]


# The position of a rule is its bit, so rules are only ever appended.
RULES = (
    Rule("few_words", lambda m: m.n_words < 50),
    Rule("repeated_windows", lambda m: 100 * m.n_repeat_words > 50 * m.n_words),
    Rule("repeated_lines", lambda m: 100 * m.n_dup_lines > 50 * m.n_lines),
    Rule("symbols", lambda m: 100 * m.n_symbols > 25 * m.n_words),
    Rule("short_words", lambda m: m.word_chars < 2 * m.n_words),
    Rule("long_words", lambda m: m.word_chars > 25 * m.n_words),
    Rule("shouting", lambda m: 100 * m.n_shouted > 30 * m.n_words),
    Rule("capitals", lambda m: (m.n_upper > 50) & (100 * m.n_upper > 70 * (m.n_upper + m.n_lower))),
)
BIT = {rule.name: 1 << i for i, rule in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """A named version of the rules that reject a document."""

    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BIT[r] for r in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_windows"))
STANDARD = Policy("standard", 1, tuple(BIT))


def _repeat_words(words: list[bytes]) -> int:
    windows = list(zip(words, words[1:], words[2:], strict=False))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    hit = np.fromiter((counts[w] > 1 for w in windows), dtype=bool, count=len(windows))
    covered = np.zeros(len(words), dtype=bool)
    for i in range(3):
        covered[i : i + len(hit)] |= hit
    return int(covered.sum())


def _measure(text: str) -> tuple[int, ...]:
    words = text.encode().split()
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    letters = text.encode("ascii", "ignore")
    upper = len(letters) - len(letters.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    lower = len(letters) - len(letters.translate(None, b"abcdefghijklmnopqrstuvwxyz"))
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        _repeat_words(words),
        sum(w.endswith(b"!!") for w in words) if "!!" in text else 0,
        upper,
        lower,
    )


@F.arrow_udf(StructType([StructField(m, LongType()) for m in MEASURES]))
def _measures(text: pa.Array) -> pa.Array:
    rows = np.array([_measure(x) for x in strings(text)], dtype=np.int64).reshape(-1, len(MEASURES))
    return pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in range(len(MEASURES))], list(MEASURES))


# Else Spark may evaluate it once for a filter and again for the projection above.
_measures = _measures.asNondeterministic()


def fail_bits(measures: Column) -> Column:
    """One bit for each failed rule."""
    return sum((F.when(rule.fails(measures), F.lit(BIT[rule.name])).otherwise(0).cast("long") for rule in RULES), F.lit(0).cast("long"))


def with_ledger(docs: DataFrame, text: str = "text", ledger: str = "ledger") -> DataFrame:
    """Add a struct with all measures and ``fail_bits``; every other column is untouched.

    Null and empty texts measure 0 everywhere and so fail ``few_words``. Repeated rows and null identities are
    ordinary rows, an empty table gives an empty table, and texts of any length are read whole. ``ledger`` must
    not be the name of a column of ``docs``.
    """
    if ledger in docs.columns:
        raise ValueError(f"column {ledger} exists, choose another name for the ledger")
    row = F.col(f"`{ledger}`")
    return docs.withColumn(ledger, _measures(F.col(f"`{text}`"))).withColumn(ledger, F.struct(*[row[m].alias(m) for m in MEASURES], fail_bits(row).alias("fail_bits")))


def passes(policy: Policy, ledger: str = "ledger") -> Column:
    """Whether the ledger row has none of the policy's failure bits."""
    return F.col(f"`{ledger}`.fail_bits").bitwiseAND(F.lit(policy.mask)) == 0


def ablation(ledgers: DataFrame, policies: tuple[Policy, ...], ledger: str = "ledger") -> DataFrame:
    """For each policy and rule: documents that fail the rule, and those that only this rule rejects.

    Rows are first counted by mask, so what the policies meet is at most one row per combination of failed rules.
    """
    masks = ledgers.groupBy(F.col(f"`{ledger}`.fail_bits").alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    cases = [F.struct(F.lit(p.name).alias("policy"), F.lit(p.version).alias("version"), F.lit(r).alias("rule"), F.lit(BIT[r]).cast("long").alias("bit"), F.lit(p.mask).cast("long").alias("mask")) for p in policies for r in p.rules]
    each = masks.withColumn("c", F.explode(F.array(*cases))).select("bits", "n", "c.*")
    hit = F.col("bits").bitwiseAND(F.col("mask"))
    return each.groupBy("policy", "version", "rule").agg(
        F.sum(F.when(hit.bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(hit == F.col("bit"), F.col("n")).otherwise(0)).alias("n_only"),
    )
