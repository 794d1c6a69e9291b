"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rareseries.session import ensure_checkpoint_dir

#: Bytes of text that a numpy kernel takes at a time (its arrays need some 60 bytes for each).
KERNEL_BYTES = 1 << 19


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """As ``cut``, as a compressed table of which later reads take only the columns they need."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str) -> DataFrame:
    """As ``written``, in as many buckets of ``key`` as a shuffle has partitions: joins on ``key`` need not move the rows.

    The catalog entry that bucketing needs is dropped at once (the rows lie outside the warehouse and stay), so no name is left.
    """
    spark = df.sparkSession
    name = f"table_{uuid.uuid4().hex}"
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(buckets, key).write.bucketBy(buckets, key).option("compression", "zstd").option("path", path).saveAsTable(name)
    found = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return found


def files(root: str):
    """(file system, folder) of a URI, for tasks that write files of their own format.

    Local paths, ``file``, ``hdfs``, ``s3``, ``gs`` and ``abfs`` as pyarrow knows them; Hadoop's names ``s3a``, ``s3n``, ``abfss`` and ``wasbs``
    stand for the stores they name. Another scheme raises, on the driver already.
    """
    import pyarrow.fs as pafs

    scheme, rest = root.split(":", 1) if "://" in root else ("", root)
    stands_for = {"s3a": "s3", "s3n": "s3", "wasbs": "abfss"}
    return pafs.FileSystem.from_uri(f"{stands_for.get(scheme, scheme)}:{rest}" if scheme else root)


def _keep(batches: Iterator[pa.RecordBatch], root: str, keys: list[str], made) -> Iterator[pa.RecordBatch]:
    """Write one task's groups; rows arrive sorted by the keys. Attempts have files of their own, and only the attempt that ends is listed."""
    import numpy as np
    from pyspark import TaskContext

    fs, folder = files(root)
    name, at, places = f"groups-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}", 0, []
    with fs.open_output_stream(f"{folder}/{name}") as out:

        def end(key: tuple, group: list[pa.RecordBatch]) -> None:
            nonlocal at
            table, width = pa.Table.from_batches(group), None
            if made:
                table, width = made(key, table)
            table = table.combine_chunks()
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
                stream.write_table(table)
            size = out.write(sink.getvalue())
            places.append((*key, name, at, size, width))
            at += size

        now, group = None, []
        for batch in batches:
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in keys]
            new = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
            for a, b in zip([0, *new], [*new, batch.num_rows]) if batch.num_rows else []:
                key = tuple(int(c[a]) for c in columns)
                if key != now and group:
                    end(now, group)
                    group = []
                now = key
                group.append(batch.slice(a, b - a))
        if group:
            end(now, group)
    names = [*keys, "file", "at", "size", "width"]
    kinds = [{"file": pa.string(), "width": pa.float64()}.get(c, pa.int64()) for c in names]
    yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in places], kind) for i, kind in enumerate(kinds)], names)


def new_folder(spark: SparkSession) -> str:
    """A new folder (a URI) below the shared checkpoint folder, for files of groups."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/groups-{uuid.uuid4().hex}"
    fs, folder = files(root)
    fs.create_dir(folder, recursive=True)
    return root


def kept_groups(df: DataFrame, root: str, *keys: str, made=None) -> DataFrame:
    """Write each group of rows of equal ``keys`` (long, never null) as one piece of a file below ``root``; returns (keys, file, at, size, width).

    Tasks read the groups they need with ``read_group``, any number of times, and no copy of a row is written for it. A group
    must fit in a task. ``made``: (key, table) -> (table that is written in place of the group, its width).
    """
    dealt = df.repartition(*keys).sortWithinPartitions(*keys)
    return cut(dealt.mapInArrow(partial(_keep, root=root, keys=[*keys], made=made), f"{', '.join(f'{c} long' for c in keys)}, file string, at long, size long, width double"))


def read_group(fs, folder: str, file: str, at: int, size: int) -> pa.Table:
    with fs.open_input_file(f"{folder}/{file}") as f:
        f.seek(at)
        return pa.ipc.open_stream(f.read(size)).read_all()


#: Bits of a row's number within its partition in ``monotonically_increasing_id``.
_ROW_BITS = 33


def _meet_keys(batches: Iterator[pa.RecordBatch], root: str, places, row: str, missing: bool) -> Iterator[pa.RecordBatch]:
    import numpy as np

    fs, folder = files(root)
    part, found, known = None, None, None
    for batch in batches:
        rows = batch.column(row).to_numpy()
        parts = rows >> _ROW_BITS
        for p in np.unique(parts):
            at = np.flatnonzero(parts == p)
            if p != part:
                part, found = p, read_group(fs, folder, *places.value[p]) if p in places.value else None
                if found is not None:
                    found = found.sort_by(row)
                    known = found.column(row).to_numpy()
            if found is None:
                if missing:
                    yield batch.take(pa.array(at))
                continue
            place = np.minimum(np.searchsorted(known, rows[at]), len(known) - 1)
            hit = known[place] == rows[at]
            if missing:
                yield batch.take(pa.array(at[~hit]))
            else:
                kept, more = batch.take(pa.array(at[hit])), found.drop_columns(["_part", row]).take(pa.array(place[hit]))
                yield pa.RecordBatch.from_arrays([*kept.columns, *(c.combine_chunks() for c in more.columns)], [*kept.schema.names, *more.column_names])


def join_rows(written_rows: DataFrame, keys: DataFrame, row: str, missing: bool = False, then=None, schema: str | None = None) -> DataFrame:
    """Inner join (``missing``: anti join) on ``row`` in which the rows of a written table do not move.

    ``row`` is the table's ``monotonically_increasing_id`` as it was written, so that its rows lie in the file of their partition. ``keys``, one for
    a row at most, move to one group for each partition, which the task that reads the partition's file looks up. ``then`` takes the joined batches on to ``schema`` in the same step.
    """
    spark = keys.sparkSession
    root = new_folder(spark)
    kept = kept_groups(keys.withColumn("_part", F.shiftright(row, _ROW_BITS)), root, "_part")
    places = spark.sparkContext.broadcast({r["_part"]: (r["file"], r["at"], r["size"]) for r in kept.toLocalIterator()})
    more = [] if missing else [f for f in keys.schema.fields if f.name != row]
    meet = partial(_meet_keys, root=root, places=places, row=row, missing=missing)
    return written_rows.mapInArrow((lambda batches: then(meet(batches))) if then else meet, schema or StructType([*written_rows.schema.fields, *more]))


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = KERNEL_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of at most ``max_bytes`` of text (one row at least)."""
    import numpy as np
    import pyarrow.compute as pc

    if batch.num_rows == 0:
        return
    size = pc.fill_null(pc.binary_length(batch.column(column).cast(pa.large_string())), 0).to_numpy(zero_copy_only=False)
    end = np.cumsum(size, dtype=np.int64)
    i = 0
    while i < batch.num_rows:
        done = end[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(end, done + max_bytes, side="right")))
        yield batch.slice(i, j - i)
        i = j


def neighbours(places: list[tuple[int, int]], max_bytes: int) -> Iterator[tuple[int, int]]:
    """Runs [first, last) of records of a file, given as (offset, length) end to end, that one read takes: ``max_bytes``, or one record."""
    first = 0
    for i, (at, n) in enumerate(places):
        if i > first and at + n - places[first][0] > max_bytes:
            yield first, i
            first = i
    if places:
        yield first, len(places)


def forest(pairs: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (u, v) of a partition, batch by batch, as star edges (v, smallest vertex) with the same components."""
    import numpy as np

    for batch in pairs:
        u, v = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
        names, at = np.unique(np.concatenate([u, v]), return_inverse=True)
        label = local_components(at[: len(u)], at[len(u) :], len(names))
        far = label != np.arange(len(names))
        yield pa.RecordBatch.from_arrays([pa.array(names[far]), pa.array(names[label[far]])], ["u", "v"])


def local_components(u, v, n: int):
    """Smallest vertex number in the component of each of ``n`` vertices (numpy, min-label hooking)."""
    import numpy as np

    label = np.arange(n)
    while len(u):
        a, b = label[u], label[v]
        if (a == b).all():
            break
        low, high = np.minimum(a, b), np.maximum(a, b)
        np.minimum.at(label, high, low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
    return label


def components(edges: DataFrame) -> DataFrame:
    """(id, component_id) of every vertex of ``edges`` (u, v: long, never null); component_id: smallest reachable id.

    Large-star and small-star rounds (Kiveris et al. 2014). Each round takes a per-vertex minimum, which
    combines before its shuffle, and joins it back from a checkpointed table, so that a hub vertex
    is split by the skew join; no neighbour list is ever gathered.
    """
    edges = edges.where("u <> v").mapInArrow(forest, "u long, v long")  # v is the smaller end
    edges = cut(edges.dropDuplicates())
    while not _all_stars(edges):
        # large-star: every larger neighbour of u goes to the smallest vertex around u
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = cut(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small-star: every smaller neighbour of u, and u itself, goes to the smallest of them
        large = cut(large.where("u <> v").dropDuplicates())
        low = cut(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        edges = cut(small.where("u <> v").dropDuplicates())
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component_id")).union(edges.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct())


def _all_stars(edges: DataFrame) -> bool:
    """Whether every vertex has one smaller neighbour, which itself has none."""
    if edges.groupBy("u").count().where("count > 1").limit(1).collect():
        return False
    return not edges.join(edges.select(F.col("u").alias("v")), "v", "left_semi").limit(1).collect()
