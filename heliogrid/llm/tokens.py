"""Token counts with a whole-token shortcut.

A text is a sequence of pre-tokens: a run of blanks (the mark below) and the characters up to the next blank. Before any
text is read, two facts about the vocabulary are proved by looking at every entry of it:

- no entry holds a blank behind another character, so that no merge crosses from one pre-token to the next;
- which entries, given alone, come out as the one token that they are.

A pre-token of the second kind counts as one without being merged. What is left of a text goes to the tokenizer.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import filterfalse

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from heliogrid.llm.common import strings

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
BLANK = "▁"  # what the tokenizer puts in place of a space, and before every text that is not empty
PRE_TOKEN = regex.compile(f"{BLANK}+[^{BLANK}]*")


class WholeTokens:
    """The tokenizer of a file and the pre-tokens that are proved to be single tokens."""

    def __init__(self, path: str | None = None):
        import public_tokenizers
        import sentencepiece

        self.tokenizer = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path(MODEL))
        pieces = self.tokenizer.id_to_piece(list(range(self.tokenizer.get_piece_size())))
        self.single = frozenset(self._proved(pieces)) if self._independent(pieces) else None

    def _independent(self, pieces: list[str]) -> bool:
        """Whether pre-tokens never meet in a merge, and blanks are neither joined nor dropped."""
        crossing = regex.compile(f"[^{BLANK}]{BLANK}")
        kept = self.tokenizer.encode("  a  b ", out_type=str)
        return not any(map(crossing.search, pieces)) and "".join(kept) == BLANK * 3 + "a" + BLANK * 2 + "b" + BLANK and kept[-1] == BLANK

    def _proved(self, pieces: list[str]) -> Iterator[str]:
        """Entries that are a whole pre-token and encode as themselves. The tokenizer adds the first blank again.

        A blank alone can only end a text, and was seen to be a token there.
        """
        yield BLANK
        whole = [(i, p) for i, p in enumerate(pieces) if PRE_TOKEN.fullmatch(p)]
        for (i, p), ids in zip(whole, self.tokenizer.encode([p[1:] for _, p in whole], num_threads=1), strict=True):
            if ids == [i]:
                yield p

    def counts(self, texts: list[str]) -> list[int]:
        if self.single is None:
            return list(map(len, self.tokenizer.encode(texts, num_threads=1)))
        direct, rest = [], []
        for text in texts:
            parts = PRE_TOKEN.findall(BLANK + text.replace(" ", BLANK)) if text else []
            other = list(filterfalse(self.single.__contains__, parts))
            direct.append(len(parts) - len(other))
            # Pre-tokens don't meet in merges, so those that are left may stand side by side.
            rest.append("".join(other)[1:] if other else None)
        merged = iter(self.tokenizer.encode([r for r in rest if r is not None], num_threads=1))
        return [n if r is None else n + len(next(merged)) for n, r in zip(direct, rest, strict=True)]


@lru_cache(maxsize=2)
def whole_tokens(path: str | None) -> WholeTokens:
    """Proved once in a worker process, over the vocabulary alone."""
    return WholeTokens(path)


def with_token_counts(docs: DataFrame, text: str = "text", model: str | None = None, limit: int = LIMIT) -> DataFrame:
    """``docs`` with n_bytes (UTF-8), n_tokens and over_limit (n_tokens > ``limit``) of every whole text.

    Null and empty texts have no bytes and no tokens. Tokens are those of the library without begin, end or special
    ones; strings that look like special tokens are ordinary text. Texts of any length are counted whole, one at a time.
    Every row is counted for itself, repeated rows too; an empty table gives an empty table. ValueError if a column has
    one of the three names already. ``model`` is a file that every executor can open; the packaged one if not given.
    A vocabulary whose pre-tokens can meet in merges is counted by the library alone.
    """
    added = ("n_bytes", "n_tokens", "over_limit")
    taken = {c.lower() for c in docs.columns} & set(added)
    if taken:
        raise ValueError(f"columns exist already: {', '.join(sorted(taken))}")

    @F.arrow_udf(LongType())
    def count(column: pa.Array) -> pa.Array:
        counter, done = whole_tokens(model), []
        for start in range(0, len(column), 256):
            done += counter.counts(list(strings(column.slice(start, 256))))
        return pa.array(done, pa.int64())

    body = F.col(f"`{text}`").cast("string")
    # Else Spark may count once for each of the two columns.
    counted = docs.withColumn("n_tokens", count.asNondeterministic()(body))
    size = F.coalesce(F.octet_length(body), F.lit(0)).cast("long")
    return counted.select(*[F.col(f"`{c}`") for c in docs.columns], size.alias("n_bytes"), "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
