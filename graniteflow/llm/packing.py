"""Bounded-space online best-fit packing of tokenised documents into sequences.

Documents are tokenised where they lie; only piece lengths are shuffled. A task takes its
pieces one by one, longest first, and puts each into the open sequence with the least
free space that still holds it. At most ``open_bins`` sequences are open; beyond that the
fullest is closed. Open sequences are found by a bitset over free space.
"""

from __future__ import annotations

import os
import re
import zlib
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from graniteflow.llm.batches import held, text_slices
from graniteflow.session import cut_lineage

END = 1
CAPACITY = 4096
#: Chunks that a Python worker caches: less memory with fewer, less work with more; the ids are the same.
CACHED_CHUNKS = 800_000
OPEN_BINS = 16_384
#: Pieces packed by one task; fewer tasks leave fewer open sequences at the end.
TASK_PIECES = 50_000


def tokenizer_path() -> str:
    """The public vocabulary for packing, looked up on the machine that asks."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class ChunkIds(dict):
    """Token ids of texts through a cache of chunks between ASCII white space.

    The tokenizer drops white space and neither its normalizer nor its pre-tokenizer looks
    across it, so the ids of a text are those of its chunks. A chunk of Latin letters with
    one mark behind is two pre-tokens, so words are encoded once whatever follows them, and
    many words in one call: each ends with the only token that carries the word end. The
    cache maps chunks to places in one array of ids and is emptied beyond ``limit`` chunks.
    """

    _WORD = re.compile(rb"((?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)([.,;:!?]?)")

    def __init__(self, path: str, limit: int = CACHED_CHUNKS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._reset()

    def _reset(self) -> None:
        self.clear()
        self.words: dict[str, int] = {}  # first id in the array, times 2^16, plus the number of ids
        self.fresh: list[bytes] = []
        self.flat, self.used = np.array([END] * 4096, np.uint32), 1
        self.starts, self.lens = np.zeros(4096, np.int64), np.ones(4096, np.int32)  # chunk 0 is the end of a document

    def __missing__(self, chunk: bytes) -> int:
        self.fresh.append(chunk)
        self[chunk] = number = len(self) + 1
        return number

    def _encode_all(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in found]

    def _encode_words(self, words: list[str]) -> dict[str, np.ndarray]:
        """Ids of words of letters, 500 in one call."""
        found: dict[str, np.ndarray] = {}
        for a in range(0, len(words), 500):
            some = words[a : a + 500]
            ids = self._encode_all([" ".join(some)])[0]
            parts = np.split(ids, np.flatnonzero(self.closes[ids])[:-1] + 1)
            found.update(zip(some, parts if len(parts) == len(some) else self._encode_all(some), strict=True))
        return found

    def _learn(self) -> None:
        """Ids of the chunks met for the first time."""
        split = [self._WORD.fullmatch(c) for c in self.fresh]
        words = [m[1].decode().lower() if m else "" for m in split]
        marks = [m[2].decode() if m else "" for m in split]
        known = self.words
        learned = self._encode_words([w for w in dict.fromkeys(words) if w and w not in known])
        ends = {m: self._encode_all([m])[0] for m in set(marks) if m}
        rest = iter(self._encode_all([c.decode() for c, m in zip(self.fresh, split, strict=True) if not m]))
        parts: list[np.ndarray] = []
        lens = np.empty(len(split), np.int64)
        at = self.used
        for i, (word, mark) in enumerate(zip(words, marks, strict=True)):
            if not word:
                part = next(rest)
            elif (spot := known.get(word)) is None:
                part = learned[word]
                if len(part) < 1 << 16:
                    known[word] = at << 16 | len(part)
            elif (start := spot >> 16) >= self.used:  # met in this very call
                part = learned[word]
            else:
                part = self.flat[start : start + (spot & 0xFFFF)]
            parts.append(part)
            lens[i] = len(part)
            if mark:
                parts.append(ends[mark])
                lens[i] += len(parts[-1])
            at += int(lens[i])
        self.fresh.clear()
        new = np.concatenate(parts)
        first, last, used = len(self) + 1 - len(lens), len(self) + 1, self.used + len(new)
        while used > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while last > len(self.starts):
            self.starts, self.lens = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.lens))
        self.flat[self.used : used] = new
        self.lens[first:last] = lens
        self.starts[first:last] = self.used + np.cumsum(lens) - lens
        self.used = used

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, each text followed by ``END``; length of each."""
        if len(self) > self.limit or self.used > 16 * self.limit:
            self._reset()
        split = [t.split() for t in texts]
        counts = np.fromiter(map(len, split), np.int64, len(split))
        numbers = np.fromiter(map(self.__getitem__, chain.from_iterable(split)), np.int64, int(counts.sum()))
        if self.fresh:
            self._learn()
        order = np.insert(numbers, np.cumsum(counts), 0)
        lens = self.lens[order].astype(np.int64)
        ends = np.cumsum(lens)
        shift = self.starts[order] - (ends - lens)
        ids = self.flat[np.repeat(shift, lens) + np.arange(ends[-1] if len(ends) else 0)]
        return ids, np.diff(ends[np.cumsum(counts + 1) - 1], prepend=0)


def chunk_ids(path: str, limit: int = CACHED_CHUNKS) -> ChunkIds:
    """The cache of a Python worker."""
    return held(f"chunks {limit} {path}", lambda: ChunkIds(path, limit))


def pieces(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, capacity: int = CAPACITY, cached: int = CACHED_CHUNKS,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32): documents cut into pieces of at most ``capacity`` ids.

    A document has the ids of its text (null: none) and one id 1, so every row has a piece.
    """
    source = df.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    kind = dict(source.dtypes)["_id"]
    schema = StructType.fromDDL(f"_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")

    def run(batches):
        chunks = chunk_ids(path or tokenizer_path(), cached)
        for batch in batches:
            for a, b, texts in text_slices(batch, 1):
                ids, lengths = chunks.encode(texts)
                raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
                row, piece, start, length, crc = [], [], [], [], []
                base = 0
                for i, n in enumerate(lengths.tolist()):
                    for k, s in enumerate(range(0, n, capacity)):
                        m = min(capacity, n - s)
                        row.append(i)
                        piece.append(k)
                        start.append(s)
                        length.append(m)
                        crc.append(zlib.crc32(raw[4 * (base + s) : 4 * (base + s + m)]))
                    base += n
                id_values = batch.column(0).slice(a, b - a).take(pa.array(row, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [id_values, pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))], names=schema.names
                )

    return source.mapInArrow(run, schema).withColumnRenamed("_id", id_col)


class BestFit:
    """Sequences of ``capacity`` ids, at most ``open_bins`` of them open."""

    def __init__(self, capacity: int = CAPACITY, open_bins: int = OPEN_BINS):
        self.capacity, self.open_bins = capacity, open_bins
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.bits = self.open = self.made = 0

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        number = bins.pop()
        if not bins:
            self.bits &= ~(1 << free)
        self.open -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """(sequence, offset) of a piece of 1 to ``capacity`` ids."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            free, number = self.capacity, self.made
            self.made += 1
        left = free - length
        if left:
            if self.open >= self.open_bins:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes first
            self.by_free[left].append(number)
            self.bits |= 1 << left
            self.open += 1
        return number, self.capacity - free


def pack(rows: DataFrame, id_col: str = "doc_id", capacity: int = CAPACITY, open_bins: int = OPEN_BINS) -> DataFrame:
    """Adds sequence_id and offset to ``pieces``.

    Pieces are dealt by a hash of id, piece and content, so a rerun of a task packs the
    same pieces; sequences never cross tasks, which leaves a few open ones per task. The
    pieces are stored once to be counted, and the number of tasks follows their count.
    """
    rows = cut_lineage(rows)
    tasks = max(1, -(-rows.count() // TASK_PIECES))
    dealt = rows.repartition(tasks, id_col, "piece", "ids_crc32").sortWithinPartitions(
        F.desc("length"), id_col, "piece", "ids_crc32"
    )
    schema = StructType([*rows.schema.fields, *StructType.fromDDL("sequence_id bigint, offset bigint").fields])

    def run(batches):
        first, bins = TaskContext.get().partitionId() << 40, BestFit(capacity, open_bins)
        for pdf in batches:
            spots = [bins.place(n) for n in pdf["length"].tolist()]
            yield pdf.assign(sequence_id=pd.Series([first + s for s, _ in spots], dtype="int64"), offset=pd.Series([o for _, o in spots], dtype="int64"))

    return dealt.mapInPandas(run, schema)


def pack_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, cached: int = CACHED_CHUNKS) -> DataFrame:
    """Pieces of all documents with their place: id, piece, start, length, ids_crc32, sequence_id, offset.

    Empty and null texts are a piece of one id; repeated rows are packed as often as they
    occur; other columns are not read; an empty table gives no rows.
    """
    return pack(pieces(df, id_col, text_col, path, cached=cached), id_col)
