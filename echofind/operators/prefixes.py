"""Pairs of sets that share an element of their rarest-first prefixes, from packed names.

Names of elements leave a slice of documents once, sorted and packed by range, to be counted; what comes
back are the names that several documents have, so a document's prefix is known without a second look at
its set. Names whose documents have the same least one lead to one hub, where the many names that two
relatives share make one pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from echofind.sources.store import stored

#: Names of a slice of documents (of which each has one at least), and of a range of names, on average; a worker holds one of either.
SLICE_NAMES, RANGE_NAMES = 1_000_000, 2_000_000
#: Documents that a slice takes at a time.
SLICE_ROWS = 512
#: Prefix rows of a tile of a hub, rows that are worked on together and pairs that are looked at together.
TILE_ROWS, MEET_ROWS, MEET_PAIRS = 40_000, 200_000, 1_000_000
#: Prefix rows of a task, on average.
TASK_ROWS = 2_000_000


def _packed(values: np.ndarray) -> bytes:
    """All first bytes, then all second ones and so on: neighbours that share their high bytes compress."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes()


def _unpacked(column: pa.Array, kind: type) -> list[np.ndarray]:
    width = np.dtype(kind).itemsize
    return [np.ascontiguousarray(np.frombuffer(v.as_buffer(), np.uint8).reshape(width, -1).T).view(kind).ravel() for v in column]


def _runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of each value of ``key``, by which the batches are ordered."""
    held, last = [], None
    for batch in batches:
        value = batch.column(key).to_numpy()
        edge = [*np.flatnonzero(np.append(True, value[1:] != value[:-1])).tolist(), len(value)] if len(value) else []
        for a, b in zip(edge[:-1], edge[1:], strict=True):
            if held and value[a] != last:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            last = value[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _whole(batches: Iterator[pa.RecordBatch], key: str, least: int) -> Iterator[pa.Table]:
    """Tables of ``least`` rows or more (the last may have fewer) that part no value of ``key``, by which the batches are ordered."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= least:
            table = pa.Table.from_batches(held)
            value = table.column(key).to_numpy()
            cut = int(np.searchsorted(value, value[-1]))
            if cut:
                yield table.slice(0, cut)
                held, rows = table.slice(cut).to_batches(), rows - cut
    if rows:
        yield pa.Table.from_batches(held)


def prefix_rows(sets: DataFrame, threshold: float, slice_names: int = SLICE_NAMES, range_names: int = RANGE_NAMES) -> DataFrame:
    """``(doc_id, size, name, rank, hub)`` of the prefix elements that several documents have.

    ``sets`` is a stored table ``(doc_id, names)`` of sets with elements. ``rank`` is an element's place in its set, rarest first.
    Two sets that similar must share an element among the first ``|x| - ceil(t |x|) + 1`` of each.
    """
    spark = sets.sparkSession
    total = sets.agg(F.sum(F.size("names"))).first()[0] or 0
    slots = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    ranges = max(slots, -(-total // range_names))
    own = sets.schema["doc_id"].dataType
    ids = StructField("ids", ArrayType(own))
    binary = lambda *names: [StructField(c, BinaryType()) for c in names]
    sent = StructType([StructField("range", IntegerType()), StructField("slice", LongType()), *binary("names", "at"), ids, *binary("sizes")])
    back = StructType([StructField("slice", LongType()), *binary("names", "at", "df", "hubs"), ids, *binary("sizes")])
    done = StructType([sets.schema["doc_id"], *(StructField(c, LongType()) for c in ("size", "name", "rank", "hub"))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each slice and range of names; the first of a slice has its ids and sizes."""
        serial = TaskContext.get().partitionId() << 16

        def rows(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            size = np.concatenate([pc.list_value_length(b.column(1)).to_numpy() for b in held])
            name = np.concatenate([b.column(1).flatten().to_numpy() for b in held]).view(np.uint64)
            order = np.argsort(name, kind="stable")
            name, at = name[order], np.repeat(np.arange(len(size), dtype=np.uint32), size)[order]
            place = ((name >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
            edge = np.searchsorted(place, np.arange(ranges + 1))
            filled = np.flatnonzero(np.diff(edge))
            parts = [slice(edge[i], edge[i + 1]) for i in filled]
            empty = [None] * (len(filled) - 1)
            listed = [pa.concat_arrays([b.column(0) for b in held]).to_pylist(), *empty]
            columns = [filled, np.full(len(filled), serial), [_packed(name[p]) for p in parts], [_packed(at[p]) for p in parts], listed, [size.astype(np.uint32).tobytes(), *empty]]
            return _batch(columns, sent_schema)

        held, count = [], 0
        for whole in batches:
            for first in range(0, whole.num_rows, SLICE_ROWS):
                held.append(whole.slice(first, SLICE_ROWS))
                count += len(held[-1].column(1).flatten())
                if count >= slice_names:
                    yield rows(held)
                    held, count, serial = [], 0, serial + 1
        if count:
            yield rows(held)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each slice its names of a range that several documents have, in how many, and the least of those."""
        for table in _runs(batches, "range"):
            table = table.to_batches()[0]
            names, ats = _unpacked(table.column("names"), np.uint64), _unpacked(table.column("at"), np.uint32)
            slices = table.column("slice").to_numpy()
            doc = np.concatenate([(s << 22) | at.astype(np.int64) for s, at in zip(slices.tolist(), ats, strict=True)])
            every = np.concatenate(names)
            order = np.argsort(every, kind="stable")
            start = np.flatnonzero(np.append(True, every[order][1:] != every[order][:-1]))
            seen = np.diff(np.append(start, len(every)))
            df, hub = np.empty(len(every), np.uint32), np.empty(len(every), np.int64)
            df[order] = np.repeat(seen, seen)
            hub[order] = np.repeat(np.minimum.reduceat(doc[order], start), seen)
            edge = np.concatenate([[0], np.cumsum([len(n) for n in names])])
            several = [np.flatnonzero(df[a:b] > 1) for a, b in zip(edge[:-1], edge[1:], strict=True)]
            named = table.column("sizes").is_valid().to_pylist()
            kept = [k for k, s in enumerate(several) if len(s) or named[k]]
            packed = lambda values: [_packed(values(k)[several[k]]) for k in kept]
            columns = [
                slices[kept], packed(lambda k: names[k]), packed(lambda k: ats[k]), packed(lambda k: df[edge[k] : edge[k + 1]]), packed(lambda k: hub[edge[k] : edge[k + 1]]),
                table.column("ids").take(pa.array(kept, pa.int64())), table.column("sizes").take(pa.array(kept, pa.int64())),
            ]
            yield _batch(columns, back_schema)

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, "slice"):
            table = table.to_batches()[0]
            name, at, df, hub = (np.concatenate(_unpacked(table.column(c), kind)) for c, kind in (("names", np.uint64), ("at", np.uint32), ("df", np.uint32), ("hubs", np.int64)))
            listed = table.column("ids").drop_null().flatten()
            size = np.frombuffer(table.column("sizes").drop_null()[0].as_buffer(), np.uint32).astype(np.int64)
            order = np.lexsort((name, df, at))
            name, at, hub = name[order], at[order].astype(np.int64), hub[order]
            shared = np.bincount(at, minlength=len(size))
            # Elements of one document come first in its order and are in no other.
            rank = np.arange(len(at)) - (np.cumsum(shared) - shared)[at] + 1 + (size - shared)[at]
            # The margin keeps a product such as 0.6 * 5 = 3.0000000000000004 at 3.
            last = size - np.ceil(size * threshold - 1e-9).astype(np.int64) + 1
            kept = np.flatnonzero(rank <= last[at])
            yield _batch([listed.take(pa.array(at[kept])), size[at[kept]], name[kept].view(np.int64), rank[kept], hub[kept]], done_schema)

    sent_schema, back_schema, done_schema = map(to_arrow_schema, (sent, back, done))
    sliced = sets.select("doc_id", "names").mapInArrow(cut, sent)
    found = sliced.repartition(ranges, "range").sortWithinPartitions("range").mapInArrow(counted, back)
    return found.repartition(ranges, "slice").sortWithinPartitions("slice").mapInArrow(ranked, done)


def _batch(columns: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema.names)


def prefix_pairs(
    prefix: DataFrame, threshold: float, tile_rows: int = TILE_ROWS, meet_rows: int = MEET_ROWS, meet_pairs: int = MEET_PAIRS
) -> DataFrame:
    """``(id1, id2)`` of two documents that share a name of ``prefix``, a stored table, and may be similar by sizes and ranks.

    Hubs of many rows are cut into tiles by a hash of the id, and every two tiles meet once. Pairs are
    made distinct where they are met, and once more at the end.
    """
    spark = prefix.sparkSession
    sizes = prefix.groupBy("hub").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > tile_rows)
    sizes = stored(sizes.select("hub", F.ceil(F.col("n") / F.lit(float(tile_rows))).alias("_tiles")))
    tiled = prefix.join(sizes, "hub", "left").withColumn("_tiles", F.coalesce("_tiles", F.lit(1).cast("bigint")))
    tiled = tiled.withColumn("_tile", F.pmod(F.xxhash64("doc_id"), F.col("_tiles"))).withColumn("_other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_tiles") - 1)))
    side = F.when(F.col("_other") == F.col("_tile"), 2).when(F.col("_other") > F.col("_tile"), 0).otherwise(1)
    unit = F.xxhash64("hub", F.least("_tile", "_other"), F.greatest("_tile", "_other"))
    dealt = tiled.select(unit.alias("unit"), "name", side.alias("side"), "doc_id", "size", "rank")
    slots = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    parts = max(slots, -(-prefix.count() // TASK_ROWS))
    own = prefix.schema["doc_id"].dataType
    schema = StructType([StructField("id1", own), StructField("id2", own)])
    pairs_schema = to_arrow_schema(schema)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole(batches, "unit", meet_rows):
            unit, name, side, size, rank = (table.column(c).to_numpy() for c in ("unit", "name", "side", "size", "rank"))
            ids, doc = np.unique(table.column("doc_id").to_numpy(), return_inverse=True)
            start = np.flatnonzero(np.append(True, (unit[1:] != unit[:-1]) | (name[1:] != name[:-1])))
            length = np.diff(np.append(start, len(unit)))
            end = np.repeat(start + length, length)
            second = np.repeat(start + np.add.reduceat((side == 0).astype(np.int64), start), length)
            # In a tile with itself a row meets those after it, else the first tile's rows meet the second's.
            first = np.where(side == 2, np.arange(len(unit)) + 1, second)
            many = np.where(side == 1, 0, end - first)
            edge = np.concatenate([[0], np.cumsum(many)])
            found = np.zeros(0, np.int64)
            a = 0
            while a < len(many):
                b = max(a + 1, int(np.searchsorted(edge, edge[a] + meet_pairs, "right")) - 1)
                x = np.repeat(np.arange(a, b), many[a:b])
                y = first[x] + np.arange(edge[a], edge[b]) - edge[x]
                a = b
                sx, sy, rx, ry = size[x], size[y], rank[x], rank[y]
                # Elements before the shared one are lost to at least one side.
                overlap = np.minimum(rx, ry) + np.minimum(sx - rx, sy - ry)
                may = (np.minimum(sx, sy) >= np.maximum(sx, sy) * threshold - 1e-9) & (overlap * (1.0 + threshold) >= (sx + sy) * threshold - 1e-9) & (doc[x] != doc[y])
                low, high = np.minimum(doc[x[may]], doc[y[may]]), np.maximum(doc[x[may]], doc[y[may]])
                found = np.unique(np.concatenate([found, low.astype(np.int64) * len(ids) + high]))
                if len(found) >= meet_pairs or a == len(many):
                    yield _batch([ids[found // len(ids)], ids[found % len(ids)]], pairs_schema)
                    found = found[:0]

    ordered = dealt.repartition(parts, "unit").sortWithinPartitions("unit", "name", "side")
    return ordered.mapInArrow(meet, schema).distinct()
