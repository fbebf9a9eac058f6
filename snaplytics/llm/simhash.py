"""SimHash near-duplicates by equal blocks of fingerprints.

A document's fingerprint takes the majority of each bit over the hashes of its word
shingles. Rows with equal fingerprints are one class from then on. A fingerprint is cut
into six blocks of ten or eleven bits. Of two fingerprints within 4 bits, at most four
blocks differ, so at least two are equal: every class enters one cell for each of the 15
pairs of blocks, named by the pair and the blocks' bits, and two such classes always
share a cell. Pairs that meet in a cell are verified by their exact bit distance inside
the join. A cell has some 21 bits, so by chance a class meets few others in it.

Cells with more than ``CELL_LIMIT`` classes (dense groups of near copies, or chance in an
extremely large corpus) make no pairs. Their classes go on among themselves with finer cells,
four equal blocks of eight (32 bits, 70 cells a class), and those of finer cells that are
crowded again take an exact way without pairs: each enters all bit patterns within 2 flips
of it. Two fingerprints within 4 bits share such a pattern, and any two that share one are
within 4 bits, so every member of a pattern is linked to its least member. The cost is
linear in the classes. No link is lost: a pair that shares only crowded cells has both
ends among the classes that go on.

Components come from ``graph.components``. Cases: null and empty texts have fingerprint
zero, linked like any other; a text of fewer words than a shingle is one shingle; a null
``doc_id`` never names a component that has another; rows that repeat ``doc_id`` and
fingerprint are ties, of which one stays; an empty table gives an empty result; extra
columns are kept by ``dedup`` as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SIDE_BYTES, broadcast_if_small, last_staged, only_kept, staged, table, unclash
from .graph import components

SHINGLE = 4
MAX_BITS = 4
CELL_LIMIT = 128
SEED = 42
CELLS = ((6, 2), (8, 4))  # blocks of a fingerprint, and how many of them make a cell: coarse, then finer


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The SimHash of a text with A-Z lower-cased, as an unsigned integer."""
    words = (text or "").encode().lower().split()  # bytes: ASCII case and white space only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    ones, total = np.zeros(64, np.int64), len(words) - shingle + 1
    for at in range(0, total, 1 << 16):
        until = min(total, at + (1 << 16))
        cuts = zip(starts[at:until].tolist(), ends[at + shingle - 1:until + shingle - 1].tolist())
        hashes = np.fromiter((xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in cuts), np.uint64, until - at)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(sum(1 << int(i) for i in np.flatnonzero(2 * ones > total)))


def with_fingerprint(docs: DataFrame, name: str, shingle: int = SHINGLE) -> DataFrame:
    """Append the fingerprint (as a signed long)."""
    at = docs.columns.index("text")
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.LongType(), False)])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column(at)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(marks.view(np.int64))], [*batch.schema.names, name])

    return docs.mapInArrow(mark, schema)


def block_cells(classes: DataFrame, blocks: int, equal: int) -> DataFrame:
    """(fp) -> (cell, fp) for each choice of ``equal`` of the blocks: the choice's number and the blocks' bits."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    cells = []
    for number, choice in enumerate(combinations(range(blocks), equal)):
        cell = F.lit(number).cast("long")
        for b in choice:
            bits = cuts[b + 1] - cuts[b]
            cell = F.shiftleft(cell, bits).bitwiseOR(F.shiftright("fp", cuts[b]).bitwiseAND(F.lit((1 << bits) - 1)))
        cells.append(cell)
    return classes.select(F.explode(F.array(*cells)).alias("cell"), "fp")


def flip_patterns(classes: DataFrame) -> DataFrame:
    """(fp) -> (pattern, fp) for all patterns within two flipped bits."""
    one = np.uint64(1) << np.arange(64, dtype=np.uint64)
    i, j = np.triu_indices(64, 1)
    flips = np.concatenate((np.zeros(1, np.uint64), one, one[i] ^ one[j]))

    def patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 32):
                fps = batch.column(0).slice(start, 32).to_numpy(zero_copy_only=False).view(np.uint64)
                near = (fps[:, None] ^ flips[None, :]).ravel().view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(near), pa.array(np.repeat(fps.view(np.int64), len(flips)))], ["pattern", "fp"])

    return classes.select("fp").mapInArrow(patterns, "pattern bigint, fp bigint")


def met_in_cells(cells: DataFrame, max_bits: int, cell_limit: int, name: str) -> tuple[DataFrame, DataFrame | None]:
    """The verified pairs (a, b) of ordinary cells, and the classes (fp) of crowded ones (None if none is)."""
    crowded = staged(cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
                     .filter(F.col("n") > cell_limit).select(F.col("cell").alias("full")), f"simhash-crowded-{name}")
    none, ordinary, dense = crowded.isEmpty(), cells, None
    if not none:
        side = broadcast_if_small(crowded, SIDE_BYTES)
        ordinary = cells.join(side, F.col("cell") == F.col("full"), "left_anti")
        dense = staged(cells.join(side, F.col("cell") == F.col("full"), "left_semi").select("fp").distinct(), f"simhash-dense-{name}")
    left, right = ordinary.toDF("cell", "a"), ordinary.toDF("cell_b", "b")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    return left.join(right.hint("merge"), (F.col("cell") == F.col("cell_b")) & (F.col("a") < F.col("b")) & near).select("a", "b"), dense


def links(classes: DataFrame, max_bits: int = MAX_BITS, cell_limit: int = CELL_LIMIT) -> DataFrame:
    """(fp), distinct -> edges (a, b) whose components are those of all links within
    ``max_bits``: every verified pair of ordinary cells, stars for the crowded ones."""
    if not 0 <= max_bits <= 4:
        raise ValueError("the cells cover up to 4 differing bits")
    edges, dense = None, classes
    for name, shape in zip(("coarse", "fine"), CELLS):
        pairs, dense = met_in_cells(block_cells(dense, *shape), max_bits, cell_limit, name)
        edges = pairs if edges is None else edges.unionByName(pairs)
        if dense is None:
            return edges
    if max_bits < 4:  # patterns say four bits or fewer; the exact distance decides
        raise ValueError("crowded cells need max_bits = 4")
    patterns = flip_patterns(dense)
    least = patterns.groupBy("pattern").agg(F.min("fp").alias("a"), F.max("fp").alias("most")).filter(F.col("a") < F.col("most"))
    star = patterns.join(least.select(F.col("pattern").alias("p"), "a"), F.col("pattern") == F.col("p")) \
        .select("a", F.col("fp").alias("b")).filter(F.col("a") != F.col("b")).distinct()
    return edges.unionByName(star)


def keepers(rows: DataFrame) -> DataFrame:
    """(doc_id, fp) -> (fp, keep: struct(missing, doc_id, fp) of the component's least row)."""
    least = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), F.col("doc_id").alias("doc_id"), F.col("fp").alias("fp")))
    with only_kept(rows.sparkSession) as kept:
        classes = staged(rows.groupBy("fp").agg(least.alias("least")), "simhash-classes")
        roots = components(links(classes.select("fp")))
        joined = classes.join(broadcast_if_small(staged(roots, "simhash-roots"), SIDE_BYTES), F.col("fp") == F.col("node"), "left")
        members = staged(joined.select("fp", "least", F.coalesce("root", "fp").alias("root")), "simhash-members")
        best = members.groupBy("root").agg(F.min("least").alias("keep"))
        best = staged(members.join(best, "root").select("fp", "keep"), "simhash-keepers")
        kept.append(last_staged())
    return best


def simhash_report(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row."""
    rows = staged(with_fingerprint(docs.select("doc_id", "text"), "fp", shingle).select("doc_id", "fp"), "simhash-rows")
    keep = keepers(rows).select(F.col("fp").alias("k_fp"), "keep")
    return rows.join(keep, F.col("fp") == F.col("k_fp")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("keep.doc_id").alias("component_id"))


def dedup(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One document of each component: the one with the least doc_id. Keeps the columns."""
    n = unclash(docs, "fp", "gone", "gone_fp")
    marked = staged(with_fingerprint(docs, n["fp"], shingle), "simhash-marked", "zstd")
    rows = marked.select("doc_id", F.col(n["fp"]).alias("fp"))
    with only_kept(docs.sparkSession) as kept:
        keep = keepers(rows).select(F.col("fp").alias("k_fp"), "keep")
        seen = rows.groupBy("doc_id", "fp").agg(F.count(F.lit(1)).alias("n")).join(keep, F.col("fp") == F.col("k_fp"))
        stays = F.col("doc_id").eqNullSafe(F.col("keep.doc_id")) & (F.col("fp") == F.col("keep.fp"))
        losers = staged(seen.filter(~stays).select(F.col("doc_id").alias(n["gone"]), F.col("fp").alias(n["gone_fp"])), "simhash-losers")
        kept.append(last_staged())
        ties = staged(seen.filter(stays & (F.col("n") > 1)).select(F.col("doc_id").alias(n["gone"]), F.col("fp").alias(n["gone_fp"])), "simhash-ties")
        kept.append(last_staged())
    losers = broadcast_if_small(losers, SIDE_BYTES)
    same = F.col("doc_id").eqNullSafe(F.col(n["gone"])) & (F.col(n["fp"]) == F.col(n["gone_fp"]))
    kept = marked.join(losers, same, "left_anti")
    if not ties.isEmpty():
        side = broadcast_if_small(ties, SIDE_BYTES)
        kept = kept.join(side, same, "left_anti").unionByName(
            kept.join(side, same, "left_semi").dropDuplicates(["doc_id", n["fp"]]))
    return kept.drop(n["fp"])


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_report(table(spark, sf_dir, "documents"))
