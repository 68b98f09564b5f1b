"""SimHash fingerprints of whole texts and the search for fingerprints within a Hamming radius.

A fingerprint has 128 bits. The terms of a text are its words, each with the word that
follows (the last word alone), weighted by how often they occur. Every term is hashed to
128 bits; each bit of each occurrence is a vote of +1 or -1, and a fingerprint bit is set
if its votes sum to more than zero. Texts without a word have the fingerprint of zeros.
Everything is built-in column functions; two 32-bit counters share one long sum.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graniteflow.llm.order import deal_by_order
from graniteflow.session import cut_lineage, partitions_for

BITS = 128
#: Radius at which texts count as near copies; README.md has the measured recall.
NEAR_RADIUS = 20
#: Numbers of blocks to choose from, and the work of a flipped key in comparisons.
BLOCKS, PROBE_WORK = (4, 6, 8, 16), 64
_LANES = 0x0000000100000001
_GAP = r"[\x20\x09-\x0D]+"
#: At the start of every word: the word and the one after it.
_PAIRS = r"(?<![^ ])(?=([^ ]+(?: [^ ]+)?))[^ ]"


def term_hashes(text: Column) -> Column:
    """Array of the terms of a text; null for null."""
    return F.regexp_extract_all(F.regexp_replace(text, _GAP, " "), F.lit(_PAIRS), F.lit(1))


def _vote(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, ``_hi``, ``_lo``): one fingerprint for each distinct ``keys``, in one aggregation."""
    terms = df.select(*keys, F.explode_outer(term_hashes(F.col(text))).alias("_term"))
    there = F.col("_term").isNotNull()
    hashed = terms.select(
        *keys,
        F.when(there, F.xxhash64("_term")).alias("_h0"),
        F.when(there, F.xxhash64(F.lit(2).cast("bigint"), F.col("_term"))).alias("_h1"),
    )
    sums = [
        F.sum(F.shiftrightunsigned(f"_h{w}", j).bitwiseAND(F.lit(_LANES))).alias(f"_s{w}_{j}")
        for w in (0, 1) for j in range(32)
    ]
    votes = hashed.groupBy(*keys).agg(F.count("_h0").alias("_n"), *sums)

    def word(w: int) -> Column:
        parts = []
        for j in range(32):
            lanes = F.coalesce(F.col(f"_s{w}_{j}"), F.lit(0).cast("bigint"))
            low, high = lanes.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(lanes, 32)
            for lane, bit in ((low, j), (high, j + 32)):
                value = (1 << bit) - (1 << 64 if bit == 63 else 0)
                parts.append(F.when(lane * 2 > F.col("_n"), F.lit(value).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
        out = parts[0]
        for p in parts[1:]:
            out = out.bitwiseOR(p)
        return out

    return votes.select(*keys, word(0).alias("_hi"), word(1).alias("_lo"))


def as_text(hi: Column, lo: Column) -> Column:
    """32 lower-case hexadecimal digits."""
    return F.lower(F.concat(F.lpad(F.hex(hi), 16, "0"), F.lpad(F.hex(lo), 16, "0")))


def distance(hi: Column, lo: Column, hi2: Column, lo2: Column) -> Column:
    """Hamming distance of two fingerprints."""
    return F.bit_count(hi.bitwiseXOR(hi2)) + F.bit_count(lo.bitwiseXOR(lo2))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (id, ``fingerprint``, ``_hi``, ``_lo``) for each distinct id and text.

    A null text counts as empty; an id with several texts has a row for each; other
    columns are not read.
    """
    texts = df.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    keyed = texts.select("_id", F.sha2("_text", 256).alias("_sha"), "_text")
    return _vote(keyed, ["_id", "_sha"], "_text").select(
        F.col("_id").alias(id_col), as_text(F.col("_hi"), F.col("_lo")).alias("fingerprint"), "_hi", "_lo"
    )


def _widths(blocks: int) -> list[int]:
    """Bits of each block; either half of a fingerprint has as many blocks."""
    each, more = divmod(BITS // 2, blocks // 2)
    return 2 * [each + (b < more) for b in range(blocks // 2)]


def _parts(hi: Column, lo: Column, blocks: int) -> list[Column]:
    """The blocks of a fingerprint, or of the difference of two."""
    widths, half = _widths(blocks), blocks // 2
    return [
        F.shiftrightunsigned(hi if b < half else lo, sum(widths[b // half * half : b])).bitwiseAND(F.lit((1 << widths[b]) - 1).cast("bigint"))
        for b in range(blocks)
    ]


def _tables(hi: Column, lo: Column, blocks: int, radius: int) -> Column:
    """Keys of all permuted block tables: every choice of ``blocks - radius`` blocks leads one table.

    Two fingerprints within the radius agree in at least that many blocks.
    """
    values = _parts(hi, lo, blocks)
    rows = [
        F.struct(F.lit(t).alias("_table"), F.xxhash64(*[values[b] for b in choice]).alias("_block"))
        for t, choice in enumerate(combinations(range(blocks), blocks - radius))
    ]
    return F.array(*rows)


def _reaches(blocks: int, radius: int) -> list[int]:
    """Bits by which each block may differ: two fingerprints within the radius keep to it in one block at least."""
    each, more = divmod(radius + 1, blocks)
    wide = sorted(range(blocks), key=lambda b: -_widths(blocks)[b])
    return [each - 1 + (b in wide[:more]) for b in range(blocks)]


def _masks(width: int, low: int, high: int) -> Column:
    """Every number of ``width`` bits with ``low`` to ``high`` of them set, as one constant array."""
    masks = [sum(1 << b for b in bits) for n in range(low, min(high, width) + 1) for bits in combinations(range(width), n)]
    return F.split(F.lit(",".join(map(str, masks))), ",").cast("array<bigint>")


def _flips(width: int, reach: int) -> Column:
    """Every number of ``width`` bits with up to ``reach`` of them set; above 16 bits, made of two parts by their bits."""
    if width <= 16:
        return _masks(width, 0, reach)

    def joined(bits: int) -> Column:
        upper = _masks(width - 16, 0, reach - bits)
        return F.flatten(F.transform(_masks(16, bits, bits), lambda m: F.transform(upper, lambda u: F.shiftleft(u, 16).bitwiseOR(m))))

    return F.concat(*[joined(bits) for bits in range(min(16, reach) + 1)])


def _probes(hi: Column, lo: Column, blocks: int, radius: int) -> Column:
    """Keys of every block with up to its reach of bits flipped, one table for each block."""

    def table(t: int, value: Column, width: int, reach: int) -> Column:
        return F.transform(_flips(width, reach), lambda m: F.struct(F.lit(t).alias("_table"), value.bitwiseXOR(m).alias("_block")))

    per_block = zip(_parts(hi, lo, blocks), _widths(blocks), _reaches(blocks, radius))
    return F.concat(*[table(t, *x) for t, x in enumerate(per_block)])


def probe_counts(blocks: int, radius: int) -> tuple[int, float]:
    """Flipped keys of a query, and the share of random fingerprints that it meets under them."""
    sizes = [(w, sum(comb(w, k) for k in range(r + 1))) for w, r in zip(_widths(blocks), _reaches(blocks, radius))]
    return sum(n for _, n in sizes), sum(n / 2**w for w, n in sizes)


def cheapest_blocks(n: int, radius: int) -> int:
    """The number of blocks with the least work for a query among ``n`` fingerprints; every choice finds all pairs.

    With wider blocks a query has more flips and meets fewer fingerprints. A flip, which is
    shuffled and sorted, counts as ``PROBE_WORK`` comparisons.
    """
    if radius < 4:
        return 4
    work = {}
    for blocks in BLOCKS:
        if blocks <= radius < 6 * blocks:
            flips, share = probe_counts(blocks, radius)
            work[blocks] = PROBE_WORK * flips + share * n
    return min(work, key=work.get)


def pairs_within(queries: DataFrame, prints: DataFrame, radius: int = 3, blocks: int = 4) -> DataFrame:
    """(``_hi``, ``_lo``, ``_hi2``, ``_lo2``, ``distance``, ``_copies``): all pairs of a distinct query and a
    distinct fingerprint of ``prints`` within ``radius`` bits, with the rows of ``prints`` that have it.

    Both inputs have ``_hi`` and ``_lo``. Equal fingerprints are counted together before
    the join, so a group of copies is one row. ``blocks`` is 4, 6, 8 or 16 (``cheapest_blocks``). Below ``blocks``
    bits, each table of the permuted blocks is an equality join on its leading blocks;
    from there on, each block is a table in which the queries are looked up with all flips
    of up to its reach of bits. A pair that meets in several tables counts in the first.
    """
    if blocks not in BLOCKS or not 0 <= radius < 6 * blocks:
        raise ValueError("blocks must be 4, 6, 8 or 16 and above a sixth of the radius")
    counted = prints.groupBy("_hi", "_lo").agg(F.count(F.lit(1)).alias("_copies"))
    # Few and small before their flips, the queries would all be in one task.
    left = queries.select("_hi", "_lo").distinct().repartition(partitions_for(prints), "_hi", "_lo")
    apart = [F.col(a).bitwiseXOR(F.col(b)) for a, b in (("_hi", "_hi2"), ("_lo", "_lo2"))]
    if radius < blocks:
        asked = kept = lambda a, b: _tables(F.col(a), F.col(b), blocks, radius)
        mine, theirs = asked("_hi", "_lo"), kept("_hi2", "_lo2")
        first = F.array_position(F.zip_with(mine, theirs, lambda a, b: a["_block"] == b["_block"]), F.lit(True)) - 1
    else:
        asked = lambda a, b: _probes(F.col(a), F.col(b), blocks, radius)
        kept = lambda a, b: F.array(*[
            F.struct(F.lit(t).alias("_table"), v.alias("_block")) for t, v in enumerate(_parts(F.col(a), F.col(b), blocks))
        ])
        met = [F.bit_count(x) <= reach for x, reach in zip(_parts(*apart, blocks), _reaches(blocks, radius))]
        first = F.coalesce(*[F.when(m, F.lit(t)) for t, m in enumerate(met)])
    q = left.select("_hi", "_lo", F.explode(asked("_hi", "_lo")).alias("_t")).select("_hi", "_lo", "_t.*")
    p = counted.select(F.col("_hi").alias("_hi2"), F.col("_lo").alias("_lo2"), "_copies", F.explode(kept("_hi", "_lo")).alias("_t"))
    p = p.select("_hi2", "_lo2", "_copies", "_t.*")
    bits = distance(F.col("_hi"), F.col("_lo"), F.col("_hi2"), F.col("_lo2"))
    # The size of exploded flips is underrated: without the hint they are broadcast.
    found = q.hint("merge").join(p, ["_table", "_block"]).where((bits <= radius) & (first == F.col("_table")))
    return found.select("_hi", "_lo", "_hi2", "_lo2", bits.alias("distance"), "_copies")


def within_radius(queries: DataFrame, prints: DataFrame, radius: int = 3, blocks: int = 4) -> DataFrame:
    """(``_hi``, ``_lo``, ``n_within``): rows of ``prints`` within ``radius`` bits of each distinct query, by ``pairs_within``."""
    return pairs_within(queries, prints, radius, blocks).groupBy("_hi", "_lo").agg(F.sum("_copies").alias("n_within"))


def edited_fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited text and of the next document's text.

    Documents are in ascending order of id (null first, then by text); the first follows
    the last. The edited text is the text with its last floor(n / 4) code points replaced
    by the first as many (or all) of the next document's text. Null texts are empty; repeated
    rows give repeated rows; a single document is its own next. Columns: id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next (share of equal
    bits), and ``_hi``, ``_lo``. One shuffle moves the texts, by ranges of the id.
    """
    text = F.coalesce(F.col(text_col), F.lit("")).alias("_text")
    dealt = deal_by_order(df, F.col(id_col), [F.col(id_col).alias("_id"), text])
    order = Window.partitionBy("_range").orderBy("_guest", "_key", "_text")
    placed = dealt.select(
        "_range", "_guest", "_id", "_text", F.lead("_text").over(order).alias("_next"), F.row_number().over(order).alias("_pos")
    )
    n = F.length("_text")
    cut = F.floor(n / 4).cast("int")
    edited = F.concat(F.col("_text").substr(F.lit(1), n - cut), F.coalesce(F.col("_next"), F.lit("")).substr(F.lit(1), cut))
    placed = placed.withColumn("_n_chars", n.cast("bigint")).withColumn("_edited", edited)
    placed = placed.withColumn("_sha", F.unhex(F.sha2("_edited", 256)))
    both = F.array(
        F.struct(F.lit(0).alias("_v"), F.col("_text").alias("_t")), F.struct(F.lit(1).alias("_v"), F.col("_edited").alias("_t"))
    )
    keys = ["_range", "_pos", "_guest", "_id", "_n_chars", "_sha"]
    texts = placed.select(*keys, F.explode(both).alias("_b")).select(*keys, "_b._v", "_b._t")
    votes = _vote(texts, [*keys, "_v"], "_t")
    pick = lambda c, v: F.max(F.when(F.col("_v") == v, F.col(c))).alias(f"{c}{v}")
    rows = votes.groupBy(*keys).agg(*[pick(c, v) for c in ("_hi", "_lo") for v in (0, 1)])
    after = Window.partitionBy("_range").orderBy("_pos")
    rows = rows.withColumns({"_hi2": F.lead("_hi0").over(after), "_lo2": F.lead("_lo0").over(after)}).where(~F.col("_guest"))
    near = lambda v: (1 - distance(F.col("_hi0"), F.col("_lo0"), F.col(f"_hi{v}"), F.col(f"_lo{v}")) / F.lit(float(BITS)))
    return rows.select(
        F.col("_id").alias(id_col), F.col("_n_chars").alias("n_chars"), F.lower(F.hex("_sha")).alias("edited_sha256"),
        as_text(F.col("_hi0"), F.col("_lo0")).alias("fingerprint"),
        as_text(F.col("_hi1"), F.col("_lo1")).alias("edited_fingerprint"),
        near(1).alias("near_edited"), near(2).alias("near_next"), F.col("_hi0").alias("_hi"), F.col("_lo0").alias("_lo"),
    )


def document_fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = 50, radius: int = 3, blocks: int | None = None) -> DataFrame:
    """``edited_fingerprints`` and ``n_within``: for each id divisible by ``every``, the number of
    documents (itself included) whose fingerprint is within ``radius`` bits; null for other ids. ``blocks`` is by default the cheapest number for the rows."""
    rows = cut_lineage(edited_fingerprints(df, id_col, text_col))
    blocks = blocks or cheapest_blocks(rows.count(), radius)
    asked = F.col(id_col) % every == 0
    found = within_radius(rows.where(asked), rows, radius, blocks)
    found = found.select(F.lit(True).alias("_asked"), F.col("_hi").alias("_fh"), F.col("_lo").alias("_fl"), "n_within")
    match = F.coalesce(asked, F.lit(False)) & (F.col("_hi") == F.col("_fh")) & (F.col("_lo") == F.col("_fl"))
    return rows.join(found, match, "left").drop("_hi", "_lo", "_fh", "_fl", "_asked")
