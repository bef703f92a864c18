"""Approximate nearest neighbours by NN-descent: a neighbour graph from joins of neighbours of neighbours.

Vectors with the same 16-bit form are one node, so copies, rescaled ones and those that differ by noise neither crowd
the graph nor hide each other; all of a node's vectors are scored for the queries that reach it. Nodes start with neighbours from
short runs in the order of random hyperplane signs. In each round a node gathers its neighbours and some of the
nodes it is a neighbour of, with their vectors, and tells each of them about the closest others; every node keeps
its best. Queries walk the graph greedily: the best nodes not yet opened give their neighbours, until the beam has
none left. Found vectors are scored again on the original numbers in double precision.

Every vector is indexed. The graph works on directions in 16-bit numbers, whose products are exact and the same
from both sides. `degree`, `hear` and `beam` bound what a node or a query holds; they set recall, not the rows.

Vectors that are null, empty, zero or hold null, NaN or infinite components take no part, neither do rows with a
null id, nor vectors of another length than most have (the smaller length on a tie). Of rows with the same id, the
one with the smallest vector counts. Ties go to the smaller id. Fewer candidates than asked for are all returned if the
graph reaches them; an empty table gives no row.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from traceops.llm.storage import checkpointed
from traceops.llm.text import picked

DEGREE = 24
HEAR = 20
TELL = 6
BEAM = 600
OPEN = 96
ROUNDS = 6
SEARCH_ROUNDS = 12
RUN = 128
STARTS = 4
SCALE = 8191


def _matrix(column: pa.Array, kind) -> np.ndarray:
    """Vectors of equal length, from lists or from bytes, as rows."""
    if len(column) == 0:
        return np.zeros((0, 1))
    if pa.types.is_binary(column.type):
        return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(len(column), -1)
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def valid_vectors(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """id, v: one vector of doubles for each id that takes part."""
    rows = picked(vectors, id=id_column, v=vector_column).select(F.col("id").cast("bigint").alias("id"), F.col("v").cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = rows.filter("id IS NOT NULL AND v IS NOT NULL AND size(v) > 0").filter(~F.coalesce(bad, F.lit(True)) & F.exists("v", lambda x: x != 0))
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    rows = rows.filter(F.size("v") == (lengths[0].n if lengths else 0))
    return rows.groupBy("id").agg(F.min("v").alias("v"))


def nodes_of(rows: DataFrame, copies: int) -> tuple[DataFrame, DataFrame]:
    """(nodes, members): node, q of each distinct 16-bit form; node, id, v, h of its vectors, of equal ones the `copies` smallest ids."""
    rows = rows.withColumn("h", F.md5(F.to_json("v").cast("binary")))
    # copies may be a third of all rows: their smallest ids are found in salted parts first
    parts = Window.partitionBy("h", F.pmod(F.xxhash64("id"), F.lit(64))).orderBy("id")
    few = rows.withColumn("_n", F.row_number().over(parts)).filter(F.col("_n") <= copies)
    few = few.withColumn("_n", F.row_number().over(Window.partitionBy("h").orderBy("id"))).filter(F.col("_n") <= copies)

    def quantise(batches):
        for batch in batches:
            v = _matrix(batch.column("v"), np.float64)
            v = v / np.abs(v).max(axis=1, keepdims=True)
            q = np.rint(v / np.linalg.norm(v, axis=1, keepdims=True) * SCALE).astype("<i2")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([x.tobytes() for x in q], pa.binary())], names=["id", "v", "h", "q"])

    coded = checkpointed(few.select("id", "v", "h").mapInArrow(quantise, "id BIGINT, v ARRAY<DOUBLE>, h STRING, q BINARY"))
    nodes = checkpointed(coded.groupBy("q").agg(F.min("id").alias("node")).select("node", "q"))
    return nodes, checkpointed(coded.join(nodes, "q").select("node", "id", "v", "h"))


def _best(edges: DataFrame, degree: int) -> DataFrame:
    """node, s, to: each node's best neighbours, as parallel lists."""
    # the complement turns the order of ids round, so ties go to the smaller one
    best = F.slice(F.sort_array(F.collect_set(F.struct("s", F.bitwise_not("to").alias("r"))), asc=False), 1, degree)
    lists = edges.groupBy("node").agg(best.alias("best"))
    return lists.select("node", F.transform("best", lambda x: x["s"]).alias("s"), F.transform("best", lambda x: F.bitwise_not(x["r"])).alias("to"))


def _edges(graph: DataFrame) -> DataFrame:
    return graph.select("node", F.explode(F.arrays_zip("s", "to")).alias("e")).select("node", "e.s", "e.to")


def start_edges(nodes: DataFrame, count: int, degree: int) -> DataFrame:
    """Neighbours inside short runs of nodes in the order of their hyperplane signs, for several sets of planes."""
    bits = max(1, math.ceil(math.log2(max(count / RUN, 2))))
    schema = pa.schema([("node", pa.int64()), ("s", pa.int64()), ("to", pa.int64())])

    def signs(batches):
        for batch in batches:
            q = _matrix(batch.column("q"), "<i2").astype(np.float64)
            codes = []
            for turn in range(STARTS):
                planes = np.random.default_rng(turn).normal(size=(q.shape[1], bits))
                codes.append(((q @ planes) > 0) @ (1 << np.arange(bits, dtype=np.int64)))
            turns = np.repeat(np.arange(STARTS), len(q))
            yield pa.RecordBatch.from_arrays(
                [pa.array(turns * (1 << bits) + np.concatenate(codes) if len(q) else turns),
                 pa.concat_arrays([batch.column("node")] * STARTS), pa.concat_arrays([batch.column("q")] * STARTS)], names=["code", "node", "q"])

    def inside(batches):
        def emit(ids, rows):
            q = np.frombuffer(b"".join(rows), "<i2").reshape(len(ids), -1).astype(np.float64)
            dot = (q @ q.T).astype(np.int64)
            np.fill_diagonal(dot, np.iinfo(np.int64).min)
            k = min(degree // 2, len(ids) - 1)
            at = np.argpartition(-dot, k - 1, axis=1)[:, :k]
            ids = np.array(ids)
            return pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, k)), pa.array(np.take_along_axis(dot, at, 1).ravel()), pa.array(ids[at].ravel())], schema=schema)

        ids, rows = [], []
        for batch in batches:
            for node, q in zip(batch.column("node").to_pylist(), batch.column("q").to_pylist()):
                ids.append(node)
                rows.append(q)
                if len(ids) == RUN:
                    yield emit(ids, rows)
                    # the next run begins in the middle of this one
                    ids, rows = ids[RUN // 2:], rows[RUN // 2:]
        if len(ids) > 1:
            yield emit(ids, rows)

    coded = checkpointed(nodes.mapInArrow(signs, "code BIGINT, node BIGINT, q BINARY"))
    # a part holds several runs, however many parts the session asks for
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(parts, STARTS * count // (8 * RUN)))
    ordered = coded.repartitionByRange(parts, "code", F.xxhash64("node")).sortWithinPartitions("code", F.xxhash64("node"))
    # a run may hold one node twice where two orders meet
    return ordered.mapInArrow(inside, "node BIGINT, s BIGINT, to BIGINT").filter("node != to")


def descend(graph: DataFrame, nodes: DataFrame, degree: int, hear: int, turn: int) -> DataFrame:
    """One round: the candidates that nodes hear of from a common neighbour, as edges no worse than their worst."""
    edges = _edges(graph).select("node", "to")
    known = edges.groupBy("to").agg(F.count("*").alias("n"))
    # a node that is a neighbour of many hears a sample of them
    share = F.lit(float(hear)) / F.col("n")
    chance = F.pmod(F.xxhash64("node", "to", F.lit(turn)), F.lit(1_000_003)) / F.lit(1_000_003.0)
    back = edges.join(known, "to").filter(chance < share).select(F.col("to").alias("node"), F.col("node").alias("to"))
    members = edges.union(back).distinct()
    worst = graph.select("node", F.when(F.size("s") >= degree, F.array_min("s")).alias("worst"))
    known = nodes.join(worst, "node", "left").select(F.col("node").alias("to"), "q", "worst")
    gathered = members.join(known, "to").groupBy("node").agg(F.collect_list(F.struct("to", "q", "worst")).alias("m"))
    schema = pa.schema([("node", pa.int64()), ("s", pa.int64()), ("to", pa.int64())])

    def tell(batches):
        for batch in batches:
            lists = batch.column("m")
            ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            flat = lists.flatten()
            to = flat.field("to").to_numpy(zero_copy_only=False)
            q = _matrix(flat.field("q"), "<i2").astype(np.float64)
            worst = flat.field("worst").fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
            out = []
            for a, b in zip(ends, ends[1:]):
                if b - a < 2:
                    continue
                dot = (q[a:b] @ q[a:b].T).astype(np.int64)
                np.fill_diagonal(dot, np.iinfo(np.int64).min)
                k = min(TELL, b - a - 1)
                at = np.argpartition(-dot, k - 1, axis=1)[:, :k]
                s = np.take_along_axis(dot, at, 1)
                row, column = np.nonzero((s >= worst[a:b, None]) & (s > np.iinfo(np.int64).min))  # not the node itself
                out.append(np.stack([to[a:b][row], s[row, column], to[a:b][at[row, column]]]))
            found = np.concatenate(out, axis=1) if out else np.zeros((3, 0), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], schema=schema)

    return gathered.mapInArrow(tell, "node BIGINT, s BIGINT, to BIGINT")


def neighbour_graph(nodes: DataFrame, degree=DEGREE, hear=HEAR, rounds=ROUNDS) -> DataFrame:
    """node, s, to: an approximate graph of nearest neighbours, checkpointed. Ends when few lists still change."""
    count = nodes.count()
    graph = checkpointed(_best(start_edges(nodes, count, degree), degree))
    for turn in range(rounds):
        old = graph
        graph = checkpointed(_best(_edges(old).union(descend(old, nodes, degree, hear, turn)), degree))
        after = graph.select(F.sum(F.aggregate("s", F.lit(0).cast("double"), lambda x, y: x + y))).first()[0] or 0.0
        before = old.select(F.sum(F.aggregate("s", F.lit(0).cast("double"), lambda x, y: x + y))).first()[0] or 0.0
        if after <= before * 1.002:
            break
    return graph


def greedy_search(queries: DataFrame, graph: DataFrame, nodes: DataFrame, beam=BEAM, opened=OPEN, rounds=SEARCH_ROUNDS) -> DataFrame:
    """node, found: for the nodes of `queries`, the nodes of the beam after the walk (the node itself is not among them)."""
    own = checkpointed(queries.join(nodes, "node").select(F.col("node").alias("query"), F.col("q").alias("qq")))
    schema = pa.schema([("query", pa.int64()), ("to", pa.int64()), ("s", pa.int64())])

    def score(batches):
        for batch in batches:
            a, b = _matrix(batch.column("qq"), "<i2").astype(np.float64), _matrix(batch.column("q"), "<i2").astype(np.float64)
            s = np.einsum("ij,ij->i", a, b).astype(np.int64) if len(batch.column("q")) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("query"), batch.column("to"), pa.array(s)], schema=schema)

    # a query without neighbours starts from fixed nodes
    entries = [r.node for r in nodes.select("node").orderBy(F.xxhash64("node"), "node").limit(DEGREE).collect()]
    lost = queries.join(graph, "node", "left_anti").select("node", F.explode(F.array(*map(F.lit, entries)).cast("array<bigint>")).alias("to"))
    lost = lost.filter("node != to").join(nodes.select(F.col("node").alias("to"), "q"), "to").join(own.withColumnRenamed("query", "node"), "node")
    lost = lost.select(F.col("node").alias("query"), "to", "q", "qq").mapInArrow(score, "query BIGINT, to BIGINT, s BIGINT")
    lost = _best(lost.withColumnRenamed("query", "node"), DEGREE)
    state = checkpointed(queries.join(graph, "node").select("node", "s", "to").union(lost).select(
        "node", F.transform(F.arrays_zip("s", "to"), lambda e: F.struct(e["s"].alias("s"), F.bitwise_not(e["to"]).alias("r"), F.lit(False).alias("done"))).alias("beam")))
    links = graph.select("node", "to")
    for _ in range(rounds):
        open_now = state.select("node", F.slice(F.filter("beam", lambda e: ~e["done"]), 1, opened).alias("now"))
        asked = checkpointed(open_now.filter(F.size("now") > 0).select(F.col("node").alias("query"), F.explode("now.r").alias("r")).select("query", F.bitwise_not("r").alias("node")))
        if not asked.limit(1).count():
            break
        near = asked.join(links, "node").select("query", F.explode("to").alias("to")).distinct().filter("query != to")
        held = state.select(F.col("node").alias("query"), F.transform("beam", lambda e: e["r"]).alias("held"))
        near = near.join(held, "query").filter(~F.array_contains("held", F.bitwise_not("to"))).drop("held")
        near = near.join(nodes.select(F.col("node").alias("to"), "q"), "to").join(own, "query")
        fresh = near.mapInArrow(score, "query BIGINT, to BIGINT, s BIGINT").groupBy(F.col("query").alias("node")).agg(
            F.collect_list(F.struct("s", F.bitwise_not("to").alias("r"), F.lit(False).alias("done"))).alias("fresh"))
        marks = open_now.select("node", F.transform("now", lambda e: e["r"]).alias("now"))
        marked = F.transform("beam", lambda e: F.struct(e["s"].alias("s"), e["r"].alias("r"), (e["done"] | F.array_contains("now", e["r"])).alias("done")))
        merged = F.slice(F.sort_array(F.concat(marked, F.coalesce("fresh", F.array().cast("array<struct<s: bigint, r: bigint, done: boolean>>"))), asc=False), 1, beam)
        state = checkpointed(state.join(marks, "node").join(fresh, "node", "left").select("node", merged.alias("beam")))
    return state.select("node", F.explode("beam.r").alias("r")).select("node", F.bitwise_not("r").alias("found"))


def nearest(vectors: DataFrame, queries_of, id_column="vec_id", vector_column="embedding", k=5, degree=DEGREE, hear=HEAR, rounds=ROUNDS,
            beam=BEAM) -> DataFrame:
    """query_id, rank, vec_id, score of the `k` nearest found for every id that `queries_of` (a function of the id
    column) chooses, nearest first."""
    rows = checkpointed(valid_vectors(vectors, id_column, vector_column))
    nodes, members = nodes_of(rows, k + 1)
    graph = neighbour_graph(nodes, degree, hear, rounds)
    asking = rows.filter(queries_of(F.col("id"))).withColumn("h", F.md5(F.to_json("v").cast("binary")))
    firsts = members.select("h", "node").distinct()
    asking = checkpointed(asking.join(firsts, "h").select(F.col("id").alias("query_id"), F.col("v").alias("qv"), "node"))
    found = greedy_search(asking.select("node").distinct(), graph, nodes, beam)
    # the vectors of the query's own node are candidates too
    found = found.union(asking.select("node", F.col("node").alias("found")).distinct())
    pairs = asking.join(found, "node").select("query_id", "qv", F.col("found").alias("node"))
    pairs = pairs.join(members.select("node", "id", "v"), "node").filter("id != query_id")
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def exact(batches):
        for batch in batches:
            a, b = _matrix(batch.column("qv"), np.float64), _matrix(batch.column("v"), np.float64)
            s = [float(np.dot(x, y) / (np.sqrt(np.dot(x, x)) * np.sqrt(np.dot(y, y)))) for x, y in zip(a, b)]
            yield pa.RecordBatch.from_arrays([batch.column("query_id"), batch.column("id"), pa.array(s, pa.float64())], schema=schema)

    scored = pairs.mapInArrow(exact, "query_id BIGINT, vec_id BIGINT, score DOUBLE")
    # a node may have any number of vectors: the best of salted parts first
    few = Window.partitionBy("query_id", F.pmod(F.xxhash64("vec_id"), F.lit(64))).orderBy(F.desc("score"), "vec_id")
    scored = scored.withColumn("rank", F.row_number().over(few)).filter(F.col("rank") <= k)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
