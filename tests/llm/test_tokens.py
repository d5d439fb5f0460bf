"""Token counts against the library."""

import random

import public_tokenizers
import pytest
import sentencepiece

from heliogrid.llm import tokens
from heliogrid.llm.queries import QUERIES
from tests.conftest import SF

ODD = ["", " ", "   ", "a", " a  b ", "\n", "a\n\nb", "\t", "▁", "a▁b", "▁▁ ▁", "<s>x</s> <unk>", "a\0b", "　x", "é 中文字 和", "é", "🙂🙂 ☃", "x" * 50_000, "the " * 60_000, "中" * 30_000]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(tokens.MODEL))


def mixed(r):
    return "".join(r.choice(["the", "of", " ", " ", "  ", "▁", "ing", "\n", "é", "中", "<s>", "🙂", ".", "x", "7"]) for _ in range(r.randrange(40)))


def test_counts_are_those_of_the_library(library):
    r = random.Random(3)
    texts = ODD + [mixed(r) for _ in range(3000)]
    counter = tokens.whole_tokens(None)
    assert counter.single and all(len(library.encode(p[1:])) == 1 for p in counter.single - {tokens.BLANK})
    assert counter.counts(texts) == [len(x) for x in library.encode(texts)]


def test_without_the_proof_the_library_counts_all(library):
    counter = tokens.WholeTokens()
    counter.single = None
    assert counter.counts(ODD) == [len(x) for x in library.encode(ODD)]


def test_table(spark, library):
    rows = [(None, None, "a"), (1, "", "b"), (1, "", "b"), *[(i, t, None) for i, t in enumerate(ODD)]]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    want = [(i, t, lang, len((t or "").encode()), n := len(library.encode(t or "")), n > 4096) for i, t, lang in rows]
    assert sorted(map(tuple, tokens.with_token_counts(df).collect()), key=repr) == sorted(want, key=repr)
    assert tokens.with_token_counts(df.limit(0)).collect() == []
    with pytest.raises(ValueError, match="n_bytes"):
        tokens.with_token_counts(df.withColumnRenamed("lang", "N_bytes"))


def test_query(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = QUERIES["op13_token_counts"](spark, SF).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in found) == sorted((i, len(t.encode()), n := len(library.encode(t)), n > 4096) for i, t in texts.items())
