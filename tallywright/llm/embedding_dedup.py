"""Near-duplicate vectors by small-world graphs, one for each shard."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.llm.common import components, tidy, written
from tallywright.llm.hnsw import Graph
from tallywright.session import fresh_folder

LEAST, BEAM, AUDIT, RECALL = 0.95, 16, 512, 0.99
SHARD_ROWS, MIN_SHARDS, BLOCK_ROWS = 65_536, 8, 8_192
#: A shard of longer vectors has fewer rows.
SHARD_DIMS = 64
#: Graphs are written in parts of so many bytes, so many parts a file.
CHUNK_BYTES, FILE_CHUNKS = 1 << 20, 8
GRAPHS = pa.schema([("dims", pa.int32()), ("shard", pa.int32()), ("part", pa.int32()), ("data", pa.binary())])


def _unit_vectors(rows: DataFrame) -> DataFrame:
    """``(vec_id, dims, vec)``: the vector as doubles of length 1, null where it links with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, dims = [], []
            for values in batch.column(1).to_pylist():
                vector = None
                if values and None not in values:
                    found = np.array(values, dtype=np.float64)
                    largest = np.abs(found).max()
                    if np.isfinite(largest) and largest > 0:
                        # Scaled first, so that squares neither overflow nor vanish.
                        found = found / largest
                        vector = (found / np.linalg.norm(found) + 0.0).tobytes()
                vectors.append(vector)
                dims.append(len(values) if values else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(dims, pa.int32()), pa.array(vectors, pa.binary())], ["vec_id", "dims", "vec"]
            )

    return rows.mapInArrow(tidy(run), "vec_id long, dims int, vec binary")


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Vectors of one length from their bytes."""
    wide = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    ends = np.frombuffer(column.buffers()[1], wide)[column.offset : column.offset + len(column) + 1]
    found = np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]]
    return np.array(found.view(np.float64).reshape(len(column), dims))


def _by_dims(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The rows of each vector length; ``dims`` is the first column."""
    dims = batch.column(0).to_numpy()
    lengths = np.unique(dims)
    for length in lengths.tolist():
        yield length, batch if len(lengths) == 1 else batch.take(pa.array(np.flatnonzero(dims == length)))


def _build(least: float, beam: int, audit: int, recall: float):
    """Graphs, pickled with their beams, nodes and weights, in parts of at most ``CHUNK_BYTES``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        place = None

        def made() -> Iterator[pa.RecordBatch]:
            nodes, weights, vectors = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            graph = Graph(vectors)
            del vectors
            data = pickle.dumps((graph.probed(least, beam, audit, recall), graph, nodes[graph.order], weights[graph.order]), protocol=5)
            del graph
            for part, at in enumerate(range(0, len(data), CHUNK_BYTES)):
                row = [*place, part, data[at : at + CHUNK_BYTES]]
                yield pa.RecordBatch.from_pylist([dict(zip(GRAPHS.names, row, strict=True))], schema=GRAPHS)

        # Rows come by length and shard.
        for batch in batches:
            for dims, part in _by_dims(batch):
                shards = part.column(1).to_numpy()
                for shard in np.unique(shards).tolist():
                    own = part.take(pa.array(np.flatnonzero(shards == shard)))
                    if held and place != (dims, shard):
                        yield from made()
                    place = dims, shard
                    held.append((own.column(2).to_numpy(), own.column(3).to_numpy(), _matrix(own.column(4), dims)))
        if held:
            yield from made()

    return tidy(run)


def _shared(index: DataFrame, shards: range) -> Broadcast:
    """The graphs of ``shards`` for all tasks: ``(dims, beam, graph, nodes, weights)``."""
    found = index.where((F.col("shard") >= shards.start) & (F.col("shard") < shards.stop)).toArrow()
    parts: dict[tuple[int, int], list[tuple[int, bytes]]] = {}
    for dims, shard, part, data in zip(*(found[name].to_pylist() for name in GRAPHS.names), strict=True):
        parts.setdefault((dims, shard), []).append((part, data))
    del found
    graphs = []
    for dims, shard in sorted(parts):
        data = b"".join(data for _, data in sorted(parts.pop((dims, shard))))
        graphs.append((dims, *pickle.loads(data)))
    return index.sparkSession.sparkContext.broadcast(graphs)


def _blocks(batches: Iterator[pa.RecordBatch], block_rows: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(dims, nodes, vectors)`` of some ``block_rows`` rows with ``dims``, ``node``, ``vec``."""
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    size = 0

    def full() -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        while held:
            dims, parts = held.popitem()
            yield dims, *(np.concatenate(x) for x in zip(*parts, strict=True))

    for batch in batches:
        for start in range(0, batch.num_rows, block_rows):
            some = batch.slice(start, block_rows)
            for dims, part in _by_dims(some):
                held.setdefault(dims, []).append((np.array(part.column(1).to_numpy()), _matrix(part.column(2), dims)))
            size += some.num_rows
            if size >= block_rows:
                yield from full()
                size = 0
    yield from full()


def _audit(graphs: Broadcast, least: float, beam: int, block_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dims, ids, vectors in _blocks(batches, block_rows):
            for _, _, graph, nodes, _ in (g for g in graphs.value if g[0] == dims):
                links, steps = graph.audit(vectors, ids, nodes, least, beam)
                none = np.zeros_like(links)
                for step, n, missed in [(0, links, none), *((step, none, missed) for step, missed in enumerate(steps))]:
                    own = (n > 0) | (missed > 0)
                    rows = [np.full(len(ids), dims, np.int32), ids, np.full(len(ids), step, np.int32), n, missed]
                    yield pa.RecordBatch.from_arrays([pa.array(x[own]) for x in rows], ["dims", "node", "step", "links", "missed"])

    return tidy(run)


def _join(root: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
    """Lead ``root`` of all that the edges join to the least of them; ``root`` is of such trees, with no path longer than 1."""
    while True:
        a, b = root[one], root[two]
        apart = a != b
        if not apart.any():
            return
        one, two, a, b = one[apart], two[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            low = root[root]
            if (low == root).all():
                break
            root[:] = low


def _search(graphs: Broadcast, steps: dict[int, int], least: float, beam: int, block_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dims, ids, vectors in _blocks(batches, block_rows):
            some = [g for g in graphs.value if g[0] == dims]
            names = np.unique(np.concatenate([ids, *(nodes for *_, nodes, _ in some)]))
            own = np.searchsorted(names, ids)
            # Edges to the smallest node of each local component say all that the pairs do.
            root, links = np.arange(len(names)), np.zeros(len(ids), np.int64)
            for _, least_beam, graph, nodes, weights in some:
                place = np.searchsorted(names, nodes)
                for q, i in graph.pairs(vectors, least, max(least_beam, beam << steps.get(dims, 0))):
                    other = ids[q] != nodes[i]
                    q, i = q[other], i[other]
                    links += np.bincount(q, weights=weights[i], minlength=len(ids)).astype(np.int64)
                    _join(root, own[q], place[i])
            met, led = links > 0, root != np.arange(len(names))
            counted = ids[met], links[met], ids[met]
            joined = names[led], np.zeros(led.sum(), np.int64), names[root[led]]
            for rows in (counted, joined):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in rows], ["a", "links", "b"])

    return tidy(run)


def _steps(audited: DataFrame, recall: float) -> DataFrame:
    """``(dims, step)``: how often the beam is to be doubled until queries on average find ``recall`` of their links.

    A query's links and misses are added over all shards first, and each query with links counts
    once. Vector lengths for which no doubling is needed are left out.
    """
    links = audited.groupBy("dims", "node").agg(F.sum("links").alias("links"))
    queries = links.groupBy("dims").agg(F.count("*").alias("queries"))
    missed = audited.where("missed > 0").groupBy("dims", "node", "step").agg(F.sum("missed").alias("missed"))
    share = missed.join(links, ["dims", "node"]).groupBy("dims", "step").agg(F.sum(F.col("missed") / F.col("links")).alias("share"))
    failed = share.join(queries, "dims").where(F.col("share") > (1 - recall) * F.col("queries") + 1e-9)
    return failed.groupBy("dims").agg((F.max("step") + 1).alias("step"))


def near_vectors(
    rows: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    least: float = LEAST,
    beam: int = BEAM,
    audit: int = AUDIT,
    recall: float = RECALL,
    shard_rows: int = SHARD_ROWS,
    min_shards: int = MIN_SHARDS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row; the smallest id of a component stays.

    Vectors are linked if their cosine in double precision is at least ``least``. Equal
    vectors (after scaling to length 1) are one node, with the number of its rows. Nodes are
    dealt to shards by a hash; a shard's graph is built in one task and written, and every
    node is held against every shard: tasks go through the nodes in blocks of ``block_rows``
    with the graphs of one shard, or of some small ones, at a time. Before, ``audit`` of each ``block_rows`` nodes
    (all of a smaller table) are compared with every vector of every shard, and the beam is
    doubled until on average ``recall`` of such a node's links, over all shards together,
    are found. A shard's beam is also doubled until it finds ``recall`` of ``audit`` links
    planted in it, so it is tested where the data have no links. Candidates are checked in
    double precision. Tasks return counts and the edges of a spanning forest, and add
    pairs to them as they are found, so dense groups are not held or written out as pairs.

    Null, empty and zero vectors and those with null or non-finite components link with
    nothing, and vectors of different lengths do not link. Rows that repeat an id and its
    vector count as copies; an id with several vectors links as any of them. Rows with a
    null id count in others' links but have no component. Other columns are not read. The
    size of a task's data is bounded by ``shard_rows`` (for vectors longer than
    ``SHARD_DIMS``, fewer) and ``block_rows``; the driver gets a task's graphs.
    """
    units = _unit_vectors(rows.select(rows[vec_id].cast("long").alias("vec_id"), rows[embedding].alias("embedding")))
    units = written(units.withColumn("key", F.md5("vec")), "vectors")
    usable = units.where("vec IS NOT NULL")
    classes = usable.groupBy("dims", "key").agg(F.min("vec_id").alias("node"), F.count("*").alias("weight"))
    classes = written(classes.select(F.col("key").alias("c_key"), F.col("dims").alias("c_dims"), "node", "weight"), "vector-classes")
    same = (F.col("key") == F.col("c_key")) & (F.col("dims") == F.col("c_dims"))
    nodes = (
        usable.join(classes.where("node IS NOT NULL"), same & (F.col("vec_id") == F.col("node")))
        .select("dims", "node", "key", "weight", "vec")
        .dropDuplicates(["node", "key"])
        .drop("key")
    )
    nodes = written(nodes, "vector-nodes")
    spark = nodes.sparkSession
    size = nodes.agg(F.count("*").alias("rows"), F.coalesce(F.sum("dims"), F.lit(0)).alias("numbers")).first()
    count, weight = size["rows"], max(size["rows"], ceil(size["numbers"] / SHARD_DIMS))
    shards = max(min_shards, ceil(weight / shard_rows))
    shard = F.pmod(F.xxhash64("node", F.lit(1)), F.lit(shards)).cast("int").alias("shard")
    # A task builds one shard's graphs.
    dealt = nodes.select("dims", shard, "node", "weight", "vec").repartitionById(shards, "shard")
    built = dealt.sortWithinPartitions("dims", "node", "vec").mapInArrow(
        _build(least, beam, audit, recall), "dims int, shard int, part int, data binary"
    )
    folder = fresh_folder(spark, "vector-graphs")
    built.write.partitionBy("shard").option("maxRecordsPerFile", FILE_CHUNKS).parquet(folder)
    index = spark.read.schema(built.schema).parquet(folder)
    # As many shards at once as one may be large.
    few = max(1, shard_rows // max(1, ceil(weight / shards)))

    def held_against(queries: DataFrame, run: Callable, schema: str, label: str) -> DataFrame:
        """``queries`` gone through once for some shards after the other, whose graphs every task holds."""
        path = fresh_folder(spark, label)
        for first in range(0, shards, few):
            graphs = _shared(index, range(first, min(shards, first + few)))
            queries.select("dims", "node", "vec").mapInArrow(run(graphs), schema).write.mode("append").parquet(path)
            graphs.destroy()
            del graphs
        return spark.read.schema(schema).parquet(path)

    # Of each block's rows enough for the audit.
    sampled = nodes.where(F.pmod(F.xxhash64("node", F.lit(3)), F.lit(max(1, min(block_rows, count)))) < audit)
    audited = held_against(
        sampled, lambda g: _audit(g, least, beam, block_rows), "dims int, node long, step int, links long, missed long", "vector-audit"
    )
    steps = {r["dims"]: r["step"] for r in _steps(audited, recall).collect()}
    found = held_against(nodes, lambda g: _search(g, steps, least, beam, block_rows), "a long, links long, b long", "vector-links")
    united = components(nodes.select("node"), found.select("a", "b"), "vectors")
    counts = found.groupBy(F.col("a").alias("l_node")).agg(F.sum("links").alias("links"))
    joined = united.join(counts, F.col("node") == F.col("l_node"), "left").select(
        F.col("node").alias("u_node"), "component", F.coalesce("links", F.lit(0)).alias("links")
    )
    known = classes.join(joined, F.col("node") == F.col("u_node"), "left")
    out = units.select("vec_id", "dims", "key").join(known, same, "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id"))
    return out.select(
        "vec_id",
        (F.coalesce("weight", F.lit(1)) - 1 + F.coalesce("links", F.lit(0))).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
