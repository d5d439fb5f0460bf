"""Personal data: direct identifiers by pattern, and the terms that disclose them by co-occurrence.

A term that stands near an identifier and hardly anywhere else gives the identifier away even where it has been masked.
How much is estimated from the whole corpus: with n_te documents where term t stands near identifier e, n_t documents
with t, n_e with e and n documents, the posterior is n_te / n_t and the information log2(n_te * n / (n_t * n_e)) bits.
Terms above the thresholds are removed, or generalised where the posterior is lower. Identifiers mostly occur once or
twice, so no number of texts is asked for; against chance stands the evidence, the likelihood ratio (in bits) of what
was seen to t and e being independent. As every term near an identifier is a test of its own, the evidence must exceed
its threshold by the logarithm of all pairs tested. One text gives the bits of a single meeting, which is what chance
gives to any rare word; a second text with the same pair mostly is enough.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from heliogrid.llm.common import refuse, slices, strings
from heliogrid.session import broadcast_if_small, stage_table

KINDS = ("email", "ip", "card", "phone")
TERM_KINDS = ("generalise", "remove")

# The part of an address behind the @; the part before it is read backwards, so that a long run without @ costs nothing.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match that fails at the first digit of a run fails at the others, so runs are tried once.
ADDRESS = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
SPACED = re.compile(r"\S+")
TERM = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Thresholds:
    """Words of context on either side; posterior, bits and bits of evidence beyond chance from which a term discloses."""

    window: int = 8
    generalise: float = 0.5
    remove: float = 0.8
    bits: float = 4.0
    evidence: float = 4.0


HELD_TERMS = 100_000  # different terms that a task counts before it hands the rarer half of them on


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL_CHARS:
            start -= 1
        found = DOMAIN.match(text, at) if start < at else None
        if found:
            end = found.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind as in KINDS, then start."""
    out = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    out += [("ip", m.start(), m.end()) for m in ADDRESS.finditer(text) if all(map(_small, m[0].split(".")))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and _luhn(digits):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


def _near(text: str, words: list[tuple[int, int]], start: int, end: int, window: int) -> set[str]:
    """Terms of the ``window`` words before and after a span, and of the rest of a word that it is a part of."""
    before, behind = bisect_left(words, (start,)), bisect_left(words, (end,))
    left = text[words[max(0, before - window)][0] : start] if before else ""
    right = text[end : words[min(len(words), behind + window) - 1][1]]
    return {w.lower() for part in (left, right) for w in TERM.findall(part)}


def _contexts(window: int):
    @F.arrow_udf(ArrayType(StructType([StructField("entity", StringType()), StructField("terms", ArrayType(StringType()))])))
    def run(text: pa.Array) -> pa.Array:
        out = []
        for t in strings(text):
            found: dict[str, set[str]] = {}
            spans = base_spans(t)
            words = [m.span() for m in SPACED.finditer(t)] if spans else []
            for kind, a, b in spans:
                value = t[a:b].lower() if kind in ("email", "ip") else "".join(filter(str.isdigit, t[a:b]))
                found.setdefault(f"{kind}:{value}", set()).update(_near(t, words, a, b, window))
            out.append([{"entity": e, "terms": sorted(w)} for e, w in found.items()])
        return pa.array(out, pa.list_(pa.struct([("entity", pa.string()), ("terms", pa.list_(pa.string()))])))

    return run


def _terms(text: str) -> set[str]:
    return {w.lower() for w in set(TERM.findall(text))}


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, n): texts of the task that contain each term, in parts."""
    counts: Counter[str] = Counter()

    def part(some: dict[str, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(some), pa.string()), pa.array(list(some.values()), pa.int64())], ["term", "n"])

    for batch in batches:
        for t in strings(batch.column(0)):
            counts.update(_terms(t))
            if len(counts) >= HELD_TERMS:
                often = Counter(dict(counts.most_common(HELD_TERMS // 2)))
                yield part({w: n for w, n in counts.items() if w not in often})
                counts = often
    yield part(counts)


def _count_documents(docs: DataFrame, text: str, terms: DataFrame) -> DataFrame:
    """(term, n_t): documents that contain each of the terms, counted in the tasks before they are added up."""
    wanted, _ = broadcast_if_small(terms)
    parts = docs.select(F.col(f"`{text}`")).mapInArrow(_counts, "term string, n bigint")
    # Added up before they meet the terms, as every task has its own row for a common term.
    return parts.groupBy("term").agg(F.sum("n").alias("n_t")).join(wanted, "term")


def disclosing_terms(docs: DataFrame, text: str = "text", thresholds: Thresholds = Thresholds()) -> DataFrame:
    """(term, entity, n_te, n_t, n_e, posterior, bits, action) of the terms above the thresholds.

    Exact copies of one text are evidence once; the other figures count documents.
    """
    body = F.col(f"`{text}`")
    found = stage_table(docs.select(F.xxhash64(body).alias("h"), _contexts(thresholds.window).asNondeterministic()(body).alias("c")), "contexts")
    n = found.count()
    # Copies of a text have the same contexts, so they are counted as one row with a weight.
    texts = found.filter(F.size("c") > 0).groupBy("h").agg(F.first("c").alias("c"), F.count(F.lit(1)).alias("copies"))
    each = texts.select("h", "copies", F.explode("c").alias("e")).select("h", "copies", "e.entity", "e.terms")
    each = stage_table(each, "entities")
    entities = each.groupBy("entity").agg(F.sum("copies").alias("n_e"))
    pairs = each.select("copies", "entity", F.explode("terms").alias("term")).groupBy("term", "entity").agg(F.count(F.lit(1)).alias("support"), F.sum("copies").alias("n_te"))
    pairs = stage_table(pairs, "pairs")
    n_t = stage_table(_count_documents(docs, text, stage_table(pairs.select("term").distinct(), "near")), "terms")
    judged = pairs.join(n_t, "term").join(entities, "entity")
    judged = judged.withColumn("posterior", F.col("n_te") / F.col("n_t")).withColumn("bits", F.log2(F.col("posterior") * F.lit(float(n)) / F.col("n_e")))
    # Where t also stands without e, that counts against; an identifier of all documents has no logarithm and no evidence.
    apart = F.col("n_t") - F.col("n_te")
    against = F.when(apart == 0, 0.0).otherwise(apart * (F.log2(apart / F.col("n_t")) - F.log2(1 - F.col("n_e") / F.lit(float(n)))))
    evidence = (F.col("n_te") * F.col("bits") + against) * F.col("support") / F.col("n_te")
    enough = thresholds.evidence + math.log2(max(pairs.count(), 1))
    judged = judged.filter((F.col("posterior") >= thresholds.generalise) & (F.col("bits") >= thresholds.bits) & (evidence >= enough))
    action = F.when(F.col("posterior") >= thresholds.remove, "remove").otherwise("generalise")
    return judged.select("term", "entity", "n_te", "n_t", "n_e", "posterior", "bits", action.alias("action"))


SPAN = ArrayType(StructType([StructField("kind", StringType()), StructField("start", LongType()), StructField("end", LongType())]))
ARROW_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


@F.arrow_udf(SPAN)
def _base(text: pa.Array) -> pa.Array:
    return pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in base_spans(t)] for t in strings(text)], ARROW_SPAN)


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, term): the terms of each text, by its hash."""
    for batch in slices(batches, 100):
        hashes, terms = [], []
        for h, t in zip(batch.column(0).to_pylist(), strings(batch.column(1)), strict=True):
            some = _terms(t)
            terms += some
            hashes += [h] * len(some)
        yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64()), pa.array(terms, pa.string())], ["_h", "term"])


@F.arrow_udf(SPAN)
def _term_spans(text: pa.Array, base: pa.Array, actions: pa.Array) -> pa.Array:
    """Spans of the given (term, action) that lie outside the base spans."""
    out = []
    for t, spans, some in zip(strings(text), base.to_pylist(), actions.to_pylist(), strict=True):
        found = []
        if some:
            known = {x["term"]: x["action"] for x in some}
            for m in TERM.finditer(t):
                action = known.get(m[0].lower())
                if action and not any(s["start"] < m.end() and m.start() < s["end"] for s in spans):
                    found.append({"kind": action, "start": m.start(), "end": m.end()})
        out.append(found)
    return pa.array(out, ARROW_SPAN)


def with_spans(docs: DataFrame, text: str = "text", spans: str = "spans", thresholds: Thresholds = Thresholds()) -> DataFrame:
    """Add an array of (kind, start, end): identifiers by KINDS, then terms by TERM_KINDS, each by start.

    Positions are code points of the whole text, the end excluded. Null and empty texts have none. Repeated rows are
    documents of their own in the counts, but not in the evidence. An empty table gives an empty table. Raises
    ValueError if ``spans``, _h, _actions or _base is a column of ``docs``.
    """
    refuse(docs, spans, "_h", "_actions", "_base")
    body = F.col(f"`{text}`")
    known, _ = broadcast_if_small(stage_table(disclosing_terms(docs, text, thresholds).groupBy("term").agg(F.max("action").alias("action")), "disclosing"))
    # Terms go back to the texts by the texts' hash. Texts that share one also share terms, which changes nothing.
    words = docs.select(F.xxhash64(body).alias("_h"), body.alias("t")).mapInArrow(_words, "_h bigint, term string").join(known, "term")
    found = stage_table(words.groupBy("_h").agg(F.collect_set(F.struct("term", "action")).alias("_actions")), "found")
    found, _ = broadcast_if_small(found)
    out = docs.withColumn("_h", F.xxhash64(body)).join(found, "_h", "left").withColumn("_base", _base.asNondeterministic()(body))
    term_spans = _term_spans.asNondeterministic()(body, F.col("_base"), F.col("_actions"))
    out = out.withColumn(spans, F.concat("_base", term_spans)).select(*[F.col(f"`{c}`") for c in (*docs.columns, spans)])
    order = F.array(*[F.lit(k) for k in (*KINDS, *TERM_KINDS)])
    sorted_ = F.array_sort(F.transform(F.col(f"`{spans}`"), lambda s: F.struct(F.array_position(order, s["kind"]).alias("o"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return out.withColumn(spans, F.transform(sorted_, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))))


def sanitise(docs: DataFrame, text: str = "text", thresholds: Thresholds = Thresholds()) -> DataFrame:
    """``docs`` with identifiers and generalised terms replaced by their kind in brackets and removed terms left out.

    Overlapping spans (an identifier may fit two kinds) are replaced as one, under the kind that comes first.
    """
    spans = "_spans"
    rows = with_spans(docs, text, spans, thresholds)

    @F.arrow_udf(StringType())
    def masked(body: pa.Array, found: pa.Array) -> pa.Array:
        out = []
        for t, some in zip(strings(body), found.to_pylist(), strict=True):
            parts, end = [], 0
            for s in sorted(some, key=lambda s: s["start"]):
                if s["start"] >= end:
                    parts += [t[end : s["start"]], "" if s["kind"] == "remove" else f"[{s['kind']}]"]
                end = max(end, s["end"])
            out.append("".join([*parts, t[end:]]))
        return pa.array(out, pa.string())

    clean = F.when(F.size(spans) > 0, masked.asNondeterministic()(F.col(f"`{text}`"), F.col(spans))).otherwise(F.col(f"`{text}`"))
    return rows.withColumn(text, clean).drop(spans)
