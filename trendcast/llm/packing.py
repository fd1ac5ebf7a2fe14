"""Operator 7: harmonic packing of token ids into fixed-length sequences.

A document's ids are cut into pieces whose lengths are reciprocal parts of the
capacity: whole sequences, then halves, quarters, ... down to ``GRAIN``, and a
tail shorter than that. A piece of length n is in class ``j = capacity // n``,
and a bin of class j takes exactly j pieces, so the power-of-two classes fill
their bins completely and a tail class j wastes less than 1 / (j + 1) of a bin.

Every task packs its own rows with one open bin per class: no shuffle, memory of
a few hundred kilobytes, and a lost task redoes only its own input split. When
the rows of a task end, the pieces of its unfinished bins are laid end to end
and cut at the capacity, so a task pads one sequence at most beyond the tails.

Sequence ids are ``task number * 2**33 + number within the task``; input splits
are a function of the files, so a rerun gives the same ids.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendcast.llm.common import table

CAPACITY = 1024
GRAIN = 64
VOCABULARY = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
END_ID = 0
_SPLIT_CHARS = 1 << 20

PIECES = ("doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, "
          "sequence_id bigint, offset bigint")

# Within these characters both tokenizer libraries split texts alike (their Unicode
# tables may be of different versions elsewhere), so the faster one may be used.
_COMMON = re.compile(r"[^\t\n\r\x20-\x7e¡-ɏ]|<\|")
_LONG_WORD = re.compile(r"(?<!\S)\S{4000}")
# A blank between letters always starts a token of this vocabulary.
_SAFE_CUT = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")


def byte_bpe(vocabulary: str = VOCABULARY, ranks: str | None = RANKS) -> Callable[[str], np.ndarray]:
    """Text -> ids of a public byte-level vocabulary, as ``tokenizers`` gives them: a special token's string is that token.

    ``ranks`` names the same vocabulary in the other library's format; texts of
    common characters go through it, about four times faster, with equal ids.
    """
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path(vocabulary))
    fast = None
    if ranks:
        import tiktoken

        with open(public_tokenizers.path(ranks), "rb") as lines:
            table_ = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table_, special_tokens={})

    def encode(text: str) -> np.ndarray:
        if fast is not None and not _COMMON.search(text) and not _LONG_WORD.search(text):
            return np.asarray(fast.encode_ordinary(text), dtype=np.uint32)
        return np.asarray(whole.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def in_parts(text: str) -> np.ndarray:
        if len(text) <= _SPLIT_CHARS:
            return encode(text)
        parts, at = [], 0
        while len(text) - at > _SPLIT_CHARS:
            cut = _SAFE_CUT.search(text, at + _SPLIT_CHARS)
            if cut is None:
                break
            parts.append(encode(text[at:cut.start()]))
            at = cut.start()
        parts.append(encode(text[at:]))
        return np.concatenate(parts)

    return in_parts


def cut_lengths(n: int, capacity: int = CAPACITY, grain: int = GRAIN) -> list[int]:
    """Piece lengths of a document of n ids: whole bins, binary parts, then the tail."""
    out = [capacity] * (n // capacity)
    rest, part = n % capacity, capacity // 2
    while part >= grain and rest >= grain:
        if rest >= part:
            out.append(part)
            rest -= part
        part //= 2
    return out + [rest] * (rest > 0)


class _Packer:
    """The open bins of one task."""

    def __init__(self, first: int, capacity: int, grain: int):
        self.next, self.capacity, self.grain = first, capacity, grain
        self.bins: dict[int, list[tuple]] = {}
        self.rows: list[tuple] = []

    def add(self, doc_id, ids: np.ndarray) -> None:
        start = 0
        for n in cut_lengths(len(ids), self.capacity, self.grain):
            members = self.bins.setdefault(self.capacity // n, [])
            members.append((doc_id, start, ids[start:start + n].copy(), len(ids)))
            start += n
            if len(members) == self.capacity // n:
                self._close(self.bins.pop(self.capacity // n))

    def _close(self, members: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, total in members:
            self.rows.append((doc_id, start, len(ids), ids.astype("<u4").tobytes(), total, self.next, offset))
            offset += len(ids)
        self.next += 1

    def finish(self) -> None:
        """Unfinished bins, end to end, cut where a sequence is full."""
        open_, room = [], self.capacity
        for j in sorted(self.bins):
            for doc_id, start, ids, total in self.bins[j]:
                while len(ids):
                    take = ids[:room]
                    open_.append((doc_id, start, take, total))
                    start, ids, room = start + len(take), ids[len(take):], room - len(take)
                    if not room:
                        self._close(open_)
                        open_, room = [], self.capacity
        if open_:
            self._close(open_)
        self.bins = {}

    def taken(self) -> pd.DataFrame:
        out = pd.DataFrame(self.rows, columns=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
        self.rows = []
        out["doc_id"] = out["doc_id"].astype("Int64")
        return out


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         encoder: Callable[[], Callable[[str], np.ndarray]] = byte_bpe,
         capacity: int = CAPACITY, grain: int = GRAIN, end_id: int = END_ID) -> DataFrame:
    """One row per piece (see ``PIECES``; ids as little-endian unsigned 32-bit integers).

    A null or empty text is a document of the end id alone; a null id stays
    null; repeated rows are packed as often as they occur; an empty table gives
    no pieces. Offsets are gapless from 0 in each sequence; what a sequence has
    less than ``capacity`` is padding for the reader to add.
    """
    if capacity & (capacity - 1) or not 0 < grain <= capacity:
        raise ValueError("capacity must be a power of two, grain within it")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder()
        packer = _Packer(TaskContext.get().partitionId() << 33, capacity, grain)
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = encode(text) if isinstance(text, str) and text else np.empty(0, np.uint32)
                packer.add(None if pd.isna(doc_id) else int(doc_id), np.append(ids, np.uint32(end_id)))
                if len(packer.rows) >= 20_000:
                    yield packer.taken()
        packer.finish()
        yield packer.taken()

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, PIECES)


def with_digest(pieces: DataFrame) -> DataFrame:
    """Pieces with ``ids_crc32`` in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op7_harmonic_packing(spark, sf_dir):
    """The pieces of every document, with a checksum in place of the ids."""
    return with_digest(pack(table(spark, sf_dir, "documents")))


def packed(spark, docs, sf_dir):
    """Pipeline stage: the pieces of all documents, ids included."""
    return pack(docs).withColumn("ids_crc32", F.crc32("ids"))
