"""Exact deduplication by two-pass Bloom filtering.

Pass one puts the hash of each normalised text into a Bloom filter whose cells
saturate at two. A hash all of whose cells were hit twice may be repeated; any
other occurs once for certain. Pass two tests each row against the cells that
were hit twice: rows that cannot be repeated pass straight through, and only the
rest shuffle, 50 bytes each, to be grouped exactly.

The cells hit by a task travel as sorted 16-bit offsets per segment, so what is
shuffled grows with the rows and not with rows times tasks. The filter has 16
cells a row at every size. What is broadcast at once is at most `max_cells` bits
(32 MB): a larger filter is cut by ranges of the hash into slices, which are
filled and asked one after the other. The hashes are written in order within
each file, so that a slice reads only the pages of its range.

Defined results: a null text is the empty text; a null id counts as larger than
any other id; among rows with equal text and equal smallest id, one stays; an
empty table gives an empty result; other columns, whatever their names, pass
through keep_first() unchanged and play no part in group_members().
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.session import broadcast_up_to, drop, materialise, ship

WHITE_SPACE = r"[\x20\x09-\x0D]+"
HASHES = 4
SEGMENT_BITS = 16
CELLS_PER_ROW = 16
#: Cells of a slice of the filter, a bit each where it is broadcast.
MAX_CELLS = 1 << 28
#: Groups that go to every executor at most, 60 bytes each; more meet the rows that may be repeated in a shuffle.
BROADCAST_GROUPS = 500_000


def text_digest(text: Column) -> Column:
    """SHA-256, 32 bytes, of the text with each run of ASCII white space made one space."""
    return F.unhex(F.sha2(F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), WHITE_SPACE, " "), 256))


def cell_count(rows: int, max_cells: int = MAX_CELLS) -> int:
    cells = 1 << SEGMENT_BITS
    while cells < CELLS_PER_ROW * rows and cells < max_cells:
        cells *= 2
    return cells


def _cells(digests: pa.Array, cells: int) -> np.ndarray:
    """The HASHES cells of each digest, one row a digest; from its end, as its start says which slice it belongs to."""
    raw = b"".join(digests.to_pylist())
    words = np.frombuffer(raw, dtype="<u4").reshape(-1, 8)[:, -HASHES:]
    return words & np.uint32(cells - 1)


def _offsets(sorted_cells: np.ndarray) -> dict[int, bytes]:
    if not len(sorted_cells):
        return {}
    segments = sorted_cells >> SEGMENT_BITS
    starts = np.flatnonzero(np.r_[True, segments[1:] != segments[:-1]])
    ends = np.r_[starts[1:], len(segments)]
    low = (sorted_cells & np.uint32((1 << SEGMENT_BITS) - 1)).astype("<u2")
    return {int(segments[a]): low[a:b].tobytes() for a, b in zip(starts, ends, strict=True)}


def _hit(cells: int):
    """Per block of digests: the cells hit once, and those hit more often, by segment."""

    def run(batches):
        for batch in batches:
            found, counts = np.unique(_cells(batch.column(0), cells), return_counts=True)
            once, twice = _offsets(found), _offsets(found[counts > 1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(once), pa.int32()), pa.array(list(once.values()), pa.binary()), pa.array([twice.get(s, b"") for s in once], pa.binary())],
                names=["segment", "hit", "twice"],
            )

    return run


def _fold(batches):
    """Rows come sorted by segment: the offsets hit at least twice over all tasks."""
    current, seen, twice = None, None, None
    width = 1 << SEGMENT_BITS

    def row():
        found = np.flatnonzero(twice).astype("<u2").tobytes()
        return pa.RecordBatch.from_arrays([pa.array([current], pa.int32()), pa.array([found], pa.binary())], names=["segment", "twice"])

    for batch in batches:
        for segment, hit, more in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if segment != current:
                if current is not None and twice.any():
                    yield row()
                current, seen, twice = segment, np.zeros(width, bool), np.zeros(width, bool)
            at = np.frombuffer(hit, "<u2")
            twice[at[seen[at]]] = True
            seen[at] = True
            twice[np.frombuffer(more, "<u2")] = True
    if current is not None and twice.any():
        yield row()


def repeated_cells(digests: DataFrame, rows: int, max_cells: int = MAX_CELLS) -> tuple[int, bytes]:
    """Pass one over a table with a column `digest`: the number of cells, and a bit for each that was hit twice."""
    cells = cell_count(rows, max_cells)
    hits = digests.select("digest").mapInArrow(_hit(cells), "segment int, hit binary, twice binary")
    folded = hits.repartition("segment").sortWithinPartitions("segment").mapInArrow(_fold, "segment int, twice binary")
    bits = np.zeros(cells // 8, np.uint8)  # at most max_cells / 8 bytes, whatever the input
    for segment, twice in folded.toLocalIterator():
        at = np.frombuffer(twice, "<u2").astype(np.int64) + (segment << SEGMENT_BITS)
        np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
    return cells, bits.tobytes()


def _mark(shared: Broadcast, cells: int):
    def run(batches):
        table = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            at = _cells(batch.column("digest"), cells)
            hit = ((table[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hit, pa.bool_())], names=[*batch.schema.names, "suspect"])

    return run


def slices(digests: DataFrame, rows: int, max_cells: int = MAX_CELLS) -> list[DataFrame]:
    """The table cut by ranges of the digest, as many as let each have a filter of at most max_cells."""
    n = max(1, -(-CELLS_PER_ROW * rows // max_cells))
    starts = [bytearray((i * (1 << 32) // n).to_bytes(4, "big")) for i in range(n)]
    out = []
    for i, low in enumerate(starts):
        part = digests.filter(F.col("digest") >= F.lit(low)) if i else digests
        out.append(part.filter(F.col("digest") < F.lit(starts[i + 1])) if i + 1 < n else part)
    return out


def marked(digests: DataFrame, rows: int, max_cells: int = MAX_CELLS) -> DataFrame:
    """Both passes over a written table, slice by slice. suspect: the row's digest may occur twice; else it occurs once for certain."""
    spark, parts = digests.sparkSession, slices(digests, rows, max_cells)
    schema = T.StructType([*digests.schema.fields, T.StructField("suspect", T.BooleanType())])
    done = []
    for part in parts:
        cells, bits = repeated_cells(part, -(-rows // len(parts)), max_cells)
        shared = spark.sparkContext.broadcast(bits)
        done.append(materialise(part.mapInArrow(_mark(shared, cells), schema), "marked"))
        shared.destroy()
    return reduce(DataFrame.unionAll, done)


def _grouped(docs: DataFrame, id_col: str, text_col: str, max_cells: int):
    """Rows (id, digest, row_key) that occur once, those that may be repeated, and the groups of two or more rows."""
    ship(docs.sparkSession)
    own = docs.select(F.col(id_col).alias("id"), text_digest(F.col(text_col)).alias("digest")).withColumn("row_key", F.monotonically_increasing_id())
    table = materialise(own.sortWithinPartitions("digest"), "digests")
    rows = marked(table, table.count(), max_cells)
    drop(table)
    suspects = rows.filter("suspect").drop("suspect")
    groups = suspects.groupBy("digest").agg(
        F.count(F.lit(1)).alias("group_size"),
        F.min(F.struct(F.col("id").isNull().alias("no_id"), F.col("id"), F.col("row_key"))).alias("first"),
    )
    groups = groups.filter("group_size > 1").select("digest", "group_size", F.col("first.id").alias("keep_id"), F.col("first.row_key").alias("keep_key"))
    # written, so that the join below shuffles both its sides itself and the adaptive planner can split a hot group
    return rows.filter("not suspect").drop("suspect"), suspects, materialise(groups, "groups")


def group_members(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_cells: int = MAX_CELLS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    single, suspects, groups = _grouped(docs, id_col, text_col, max_cells)
    alone = single.select("id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest")
    joined = suspects.join(broadcast_up_to(groups, BROADCAST_GROUPS), "digest", "left")
    rest = joined.select(
        "id",
        F.when(F.col("keep_key").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("keep_key") == F.col("row_key"), F.lit(True)).alias("kept"),
        "digest",
    )
    return alone.union(rest).select(F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_cells: int = MAX_CELLS) -> DataFrame:
    """docs without the later copies of any text, all columns as they were. Rows to drop are known by id and digest, and broadcast up to BROADCAST_GROUPS of them."""
    _, suspects, groups = _grouped(docs, id_col, text_col, max_cells)
    members = materialise(suspects.join(broadcast_up_to(groups, BROADCAST_GROUPS), "digest").select("id", "digest", "row_key", "keep_id", "keep_key"), "members")
    is_first = F.col("id").eqNullSafe(F.col("keep_id"))
    gone = materialise(members.filter(~is_first).select("id", "digest").distinct(), "gone")
    again = materialise(members.filter(is_first & (F.col("row_key") != F.col("keep_key"))).select("id", "digest").distinct(), "again")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"), text_digest(F.col(text_col)).alias("digest"))

    def among(keys: DataFrame, how: str, left: DataFrame) -> DataFrame:
        other = broadcast_up_to(keys.withColumnsRenamed({"id": "other_id", "digest": "other_digest"}), BROADCAST_GROUPS)
        return left.join(other, left["id"].eqNullSafe(other["other_id"]) & (left["digest"] == other["other_digest"]), how)

    kept = among(gone, "left_anti", rows)
    if not again.isEmpty():  # rows equal in text and smallest id, of which one stays
        kept = among(again, "left_anti", kept).union(among(again, "left_semi", kept).dropDuplicates(["id", "digest"]))
    return kept.select("row.*")
