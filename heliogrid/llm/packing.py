"""Sum-of-squares packing of token ids into sequences of fixed length.

A document is cut into whole sequences and a rest. The rest goes to the fill level that makes the sum of the squared
counts of partially filled windows smallest; the counts are held in a level array. Every task packs the documents it
reads, with no shuffle. Windows still open at the end (or beyond OPEN_WINDOWS, which bounds a task's memory) are
topped up with pieces of the emptiest ones, and the last one is cut into lengths that are powers of two, so nothing
but these needs padding.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliogrid.llm.common import strings

LENGTH = 2048
END = 1  # id that ends every document
OPEN_WINDOWS = 1024
KNOWN_WORDS = 1_000_000  # about 200 MB
ID_BYTES = 4


MARK = "\x01"  # a token of its own between parts that are encoded together


class WordIds:
    """Ids of the parts of texts between blanks and line feeds.

    The tokenizer drops white space and no token spans a blank, so parts are encoded once and then looked up. Parts are
    remembered in two generations of at most ``limit`` each, plus those of the current texts.
    """

    def __init__(self, path: str | None, limit: int):
        import public_tokenizers
        from tokenizers import Tokenizer

        self.limit = limit
        self.tokenizer = Tokenizer.from_file(path or public_tokenizers.path("word_bpe_49k.json"))
        self.mark = np.array(self._encode([MARK])[0], dtype="<u4").tobytes()
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> None:
        """Encode words together with a mark between each two; words that hold the mark go alone."""
        alone = [w for w in words if MARK in w]
        for w, ids in zip(alone, self._encode(alone), strict=True):
            self.new[w] = np.array(ids, dtype="<u4").tobytes()
        words = [w for w in words if MARK not in w]
        mark = np.frombuffer(self.mark, dtype="<u4")
        for start in range(0, len(words), 256):
            some = words[start : start + 256]
            ids = np.array(self._encode([f" {MARK} ".join(some)])[0], dtype="<u4")
            raw, ends = ids.tobytes(), np.flatnonzero(ids == mark[0])
            starts = (np.r_[0, ends + len(mark)] * ID_BYTES).tolist()
            self.new.update(zip(some, [raw[a:b] for a, b in zip(starts, [*(ends * ID_BYTES).tolist(), len(raw)], strict=True)], strict=True))

    def look_up(self, parts: list[list[str]]) -> dict[str, bytes]:
        """A table that holds every part."""
        if len(self.new) > self.limit:
            self.old, self.new = self.new, {}
        missing = []
        for w in [w for w in set().union(*parts) if w not in self.new]:
            ids = self.old.get(w)
            if ids is None:
                missing.append(w)
            else:
                self.new[w] = ids
        self._learn(missing)
        return self.new


@lru_cache(maxsize=2)
def _word_ids(path: str | None, limit: int) -> WordIds:
    return WordIds(path, limit)


def token_bytes(texts: list[str], path: str | None = None, known_words: int = KNOWN_WORDS) -> list[bytes]:
    """Ids of each text and END, as little-endian 32-bit numbers."""
    parts = [t.replace("\n", " ").split(" ") for t in texts]
    known = _word_ids(path, known_words).look_up(parts)
    end = np.array([END], dtype="<u4").tobytes()
    return [b"".join(map(known.__getitem__, p)) + end for p in parts]


class Tokens(NamedTuple):
    """A document's ids from number ``base`` on, of ``total``."""

    doc_id: int | None
    total: int
    base: int
    ids: bytes

    def rest(self, start: int) -> Tokens:
        return Tokens(self.doc_id, self.total, start, self.ids[(start - self.base) * ID_BYTES :])

    def part(self, start: int, size: int) -> bytes:
        return self.ids[(start - self.base) * ID_BYTES : (start - self.base + size) * ID_BYTES]


class Packer:
    """Windows of one task. ``emit`` is called with the pieces (document, start, length) of each finished sequence."""

    def __init__(self, length: int, emit):
        self.length, self.emit = length, emit
        self.level = np.zeros(length + 1, dtype=np.int64)  # open windows by fill; 0 and full stay empty
        self.windows: dict[int, list[list]] = defaultdict(list)  # fill: windows, each a list of pieces
        self.open = 0

    def best_level(self, size: int) -> int:
        """The fill to add ``size`` to; 0 opens a window. Of equal choices the fullest."""
        level = self.level
        fits = np.flatnonzero(level[: self.length - size + 1])
        # Taking a window from level h and putting it on h + size changes the sum by this much.
        change = -2 * level[fits] + 1
        to = fits + size
        change += np.where(to < self.length, 2 * level[to] + 1, 0)
        alone = 2 * level[size] + 1
        if not len(fits):
            return 0
        i = len(fits) - 1 - int(np.argmin(change[::-1]))
        return int(fits[i]) if change[i] <= alone else 0

    def place(self, fill: int, piece: tuple) -> None:
        if fill:
            pieces = self.windows[fill].pop()
            self.level[fill] -= 1
            self.open -= 1
        else:
            pieces = []
        pieces.append(piece)
        self.keep(fill + piece[2], pieces)

    def keep(self, fill: int, pieces: list) -> None:
        if fill == self.length:
            self.emit(pieces)
        elif fill:
            self.windows[fill].append(pieces)
            self.level[fill] += 1
            self.open += 1

    def add(self, doc: Tokens) -> None:
        size = doc.total
        whole = size // self.length * self.length
        for start in range(0, whole, self.length):
            self.emit([(doc, start, self.length)])
        if size > whole:
            # An open window holds on to the rest only, not to the whole document.
            piece = (doc.rest(whole), whole, size - whole)
            self.place(self.best_level(piece[2]), piece)
            if self.open >= OPEN_WINDOWS:
                self.close(OPEN_WINDOWS // 2)

    def take(self, fill: int) -> list:
        self.level[fill] -= 1
        self.open -= 1
        return self.windows[fill].pop()

    def close(self, leave: int) -> None:
        """Top up the fullest windows with pieces of the emptiest until ``leave`` are open."""
        while self.open > max(1, leave):
            fills = np.flatnonzero(self.level)
            target, source = int(fills[-1]), int(fills[0])
            pieces, donor = self.take(target), self.take(source)
            room = self.length - target
            while room and donor:
                doc, start, size = donor.pop()
                moved = min(size, room)
                if moved < size:
                    donor.append((doc, start, size - moved))
                pieces.append((doc, start + size - moved, moved))
                room -= moved
            self.keep(self.length - room, pieces)
            self.keep(sum(p[2] for p in donor), donor)

    def finish(self) -> None:
        self.close(0)
        if not self.open:
            return
        fill = int(np.flatnonzero(self.level)[0])
        pieces = self.take(fill)
        while pieces:
            left, some = 1 << (sum(p[2] for p in pieces).bit_length() - 1), []
            while left:
                doc, start, size = pieces.pop(0)
                cut = min(size, left)
                some.append((doc, start, cut))
                if cut < size:
                    pieces.insert(0, (doc, start + cut, size - cut))
                left -= cut
            self.emit(some)


SCHEMA = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def pack(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = LENGTH, tokenizer: str | None = None, with_ids: bool = False, known_words: int = KNOWN_WORDS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset; with_ids adds the ids.

    Null and empty texts are the end id alone. Every row is a document of its own, so repeated rows are packed as
    often as they occur; a null doc_id stays null. An empty table gives an empty table. Sequence numbers hold the
    task's number in their upper bits, and offsets within a sequence have no gaps. Only the two columns named are
    read. ``tokenizer`` is a file that every executor can open; the packaged vocabulary if not given. ``known_words`` bounds the
    words whose ids a worker remembers (twice that many): more memory, less encoding.
    """
    columns = SCHEMA + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 33
        done: list[list] = []
        packer = Packer(length, done.append)
        count = 0

        def rows() -> pa.RecordBatch:
            nonlocal count
            out: list[tuple] = []
            ids: list[np.ndarray] = []
            for pieces in done:
                offset = 0
                for doc, start, size in pieces:
                    part = doc.part(start, size)
                    out.append((doc.doc_id, start, size, zlib.crc32(part), doc.total, first + count, offset))
                    if with_ids:
                        ids.append(np.frombuffer(part, dtype="<i4"))
                    offset += size
                count += 1
            done.clear()
            arrays = [pa.array(c, pa.int64()) for c in zip(*out, strict=True)] if out else [pa.array([], pa.int64())] * 7
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                values = np.concatenate(ids) if ids else np.array([], dtype=np.int32)
                arrays.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(values, pa.int32())))
                names.append("ids")
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            names = batch.column(0).to_pylist()
            body = batch.column(1)
            for a in range(0, len(names), 256):
                for name, tokens in zip(names[a : a + 256], token_bytes(list(strings(body.slice(a, 256))), tokenizer, known_words), strict=True):
                    packer.add(Tokens(name, len(tokens) // ID_BYTES, 0, tokens))
                if len(done) > 256:
                    yield rows()
        packer.finish()
        yield rows()

    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(run, columns)
