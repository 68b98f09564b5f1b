"""Edit-aware token counts: a segment tree of pre-tokens per document.

Leaves hold short runs of pre-tokens with their token counts; inner nodes sum characters
and tokens. An edit finds its place from the sums, splits only the touched region and its
boundary context again, from two pre-tokens before it up to the first old boundary that
the new split meets again, and updates the sums above the changed leaves.
"""

from __future__ import annotations

import base64

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from graniteflow.llm.batches import held

LEAF = 64
#: Distinct pre-tokens whose counts a worker remembers.
REMEMBERED = 500_000


class Splitter:
    """Pre-tokens of a text and the token count of each, by a byte-pair vocabulary."""

    def __init__(self, ranks_path: str):
        import public_tokenizers
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("pairs", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.split = regex.compile(public_tokenizers.PATTERN).findall
        self.known: dict[str, int] = {}

    def counts(self, pieces: list[str]) -> list[int]:
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for piece in pieces:
            if piece not in known:
                known[piece] = len(self.encoding.encode_ordinary(piece))
        return [known[p] for p in pieces]


def splitter(path: str | None) -> Splitter:
    """One per Python worker; without a path, the public byte-level vocabulary."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return held(f"splitter {path}", lambda: Splitter(path))


class CountTree:
    """Token count of a text that can be edited."""

    def __init__(self, text: str, split: Splitter):
        self.by = split
        self.encoded = 0
        self._build(split.split(text))

    def _build(self, pieces: list[str]) -> None:
        self.encoded += sum(map(len, pieces))
        counts = self.by.counts(pieces)
        self._plant([(pieces[a : a + LEAF], counts[a : a + LEAF]) for a in range(0, len(pieces), LEAF)] or [([], [])])

    def _plant(self, leaves: list[tuple[list[str], list[int]]]) -> None:
        self.leaves = leaves
        self.width = 1 << max(0, len(leaves) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.width), [0] * (2 * self.width)
        for i, (pieces, counts) in enumerate(leaves):
            self.chars[self.width + i], self.tokens[self.width + i] = sum(map(len, pieces)), sum(counts)
        for i in range(self.width - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def __len__(self) -> int:
        return self.chars[1]

    @property
    def count(self) -> int:
        return self.tokens[1]

    def text(self) -> str:
        return "".join(p for pieces, _ in self.leaves for p in pieces)

    def _find(self, at: int) -> tuple[int, int, int]:
        """Leaf and number of the pre-token that holds character ``at`` (or ends the text), and its first character."""
        node, start = 1, 0
        while node < self.width:
            node *= 2
            if at - start >= self.chars[node] and self.chars[node + 1]:
                start += self.chars[node]
                node += 1
        leaf = node - self.width
        pieces = self.leaves[leaf][0]
        for i, piece in enumerate(pieces):
            if at - start < len(piece) or i == len(pieces) - 1 and start + len(piece) == self.chars[1]:
                return leaf, i, start
            start += len(piece)
        return leaf, len(pieces), start

    def _before(self, leaf: int, i: int, start: int, steps: int) -> tuple[int, int, int]:
        while steps:
            if i:
                i -= 1
            else:
                back = next((k for k in range(leaf - 1, -1, -1) if self.leaves[k][0]), None)
                if back is None:
                    break
                leaf, i = back, len(self.leaves[back][0]) - 1
            start -= len(self.leaves[leaf][0][i])
            steps -= 1
        return leaf, i, start

    def edit(self, start: int, end: int, text: str) -> None:
        """Replace the characters from ``start`` to ``end`` (clamped to the text) by ``text``."""
        size = len(self)
        start = min(max(0, start), size)
        end = min(max(start, end), size)
        leaf, i, left = self._before(*self._find(start), steps=2)
        first_leaf, first = leaf, i
        region: list[str] = []
        at, bounds = left, []  # old boundaries from ``end`` on, as (character, leaf, next piece)
        need = 8

        def more() -> bool:
            nonlocal leaf, i, at
            while leaf < len(self.leaves) and i >= len(self.leaves[leaf][0]):
                leaf, i = leaf + 1, 0
            if leaf >= len(self.leaves):
                return False
            region.append(self.leaves[leaf][0][i])
            at += len(region[-1])
            i += 1
            if at >= end:
                bounds.append((at, leaf, i))
            return True

        while True:
            open_ = True
            while len(bounds) < need and (open_ := more()):
                pass
            old = "".join(region)
            fresh = old[: start - left] + text + old[end - left :]
            shift = len(text) - (end - start)
            new = self.by.split(fresh)
            if not open_:  # the region reaches the end of the text
                last_leaf, last, pieces = len(self.leaves) - 1, len(self.leaves[-1][0]), new
                break
            marks = {at_ + shift - left: (leaf_, i_) for at_, leaf_, i_ in bounds}
            floor, spot, met = start - left + len(text), 0, None
            for k, piece in enumerate(new):
                spot += len(piece)
                if spot >= floor and spot < len(fresh) and spot in marks:
                    met = k + 1
                    break
            if met is not None:
                (last_leaf, last), pieces = marks[spot], new[:met]
                break
            need *= 2
        self.encoded += sum(map(len, pieces))
        counts = self.by.counts(pieces)
        head = tuple(x[:first] for x in self.leaves[first_leaf]) if self.leaves else ([], [])
        tail = tuple(x[last:] for x in self.leaves[last_leaf])
        merged = (head[0] + pieces + tail[0], head[1] + counts + tail[1])
        if len(merged[0]) > 4 * LEAF:
            cut = [(merged[0][a : a + LEAF], merged[1][a : a + LEAF]) for a in range(0, len(merged[0]), LEAF)]
            self._plant([x for x in [*self.leaves[:first_leaf], *cut, *self.leaves[last_leaf + 1 :]] if x[0]] or [([], [])])
            return
        for k in range(first_leaf, last_leaf + 1):
            self.leaves[k] = merged if k == first_leaf else ([], [])
            self._sum_up(k)

    def _sum_up(self, leaf: int) -> None:
        node = self.width + leaf
        pieces, counts = self.leaves[leaf]
        self.chars[node], self.tokens[node] = sum(map(len, pieces)), sum(counts)
        while node > 1:
            node //= 2
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]


def edited_counts(df: DataFrame, edits: Column, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """One row per row of ``df``: id, n_chars, n_tokens, edited_chars, edited_tokens, reencoded_chars.

    ``edits`` is an array of structs (start, end, text), in code points, made one after
    another; places beyond the text are clamped, null numbers are 0 and null texts empty.
    A null text counts as empty, a null array as no edit. ``reencoded_chars`` are the
    characters encoded for the edits. Rows are not moved; repeated rows give repeated rows.
    """
    source = df.select(
        F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
        F.transform(edits, lambda e: F.struct(
            F.coalesce(e["start"].cast("bigint"), F.lit(0)).alias("start"), F.coalesce(e["end"].cast("bigint"), F.lit(0)).alias("end"),
            F.coalesce(e["text"].cast("string"), F.lit("")).alias("text"),
        )).alias("_edits"),
    )
    numbers = ["n_chars", "n_tokens", "edited_chars", "edited_tokens", "reencoded_chars"]
    schema = StructType([*source.select("_id").schema.fields, *StructType.fromDDL(", ".join(f"{n} bigint" for n in numbers)).fields])

    def run(batches):
        by = splitter(path)
        for batch in batches:
            rows = []
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                for text, changes in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    tree = CountTree(text, by)
                    before = (len(tree), tree.count)
                    tree.encoded = 0
                    for change in changes or []:
                        tree.edit(change["start"], change["end"], change["text"])
                    rows.append((*before, len(tree), tree.count, tree.encoded))
            columns = list(zip(*rows, strict=True)) or [()] * len(numbers)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in columns)], names=schema.names)

    return source.mapInArrow(run, schema).withColumnRenamed("_id", id_col)


def document_edits(text: Column, source: Column, lang: Column) -> Column:
    """Two edits of a document: 20 characters from its first third on become its source and language, and
    the 30 characters before its second third (as it then is) are written there again."""
    n = F.length(F.coalesce(text, F.lit("")))
    third = F.floor(n / 3)
    label = F.concat_ws(" ", F.coalesce(source, F.lit("")), F.coalesce(lang, F.lit("")))
    again = 2 * third
    return F.array(
        F.struct(third.alias("start"), (third + 20).alias("end"), label.alias("text")),
        F.struct(again.alias("start"), again.alias("end"), F.substring(text, again - 29, F.lit(30)).alias("text")),
    )
