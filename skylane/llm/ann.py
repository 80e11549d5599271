"""Approximate nearest neighbours: NN-descent graph and greedy search.

Nearness is the largest inner product.  Equal vectors are one node.

1. Start: random hyperplane trees (medians from a bounded sample) deal the
   nodes into leaves; each leaf links its nodes to their nearest in the leaf.
2. NN-descent: in each round every node brings its neighbours, forward and
   reverse, together in one join with their vectors; each learns its nearest
   among the others, and every node keeps its ``NEIGHBOURS`` nearest.
3. Search: each query keeps a beam of the nearest nodes found; in each step the
   nearest ones not yet expanded are joined with the graph, whose rows hold the
   neighbours' vectors, until none is left.  The nearest of the beam, and all
   whose rounding could put them there, are measured again on the original
   vectors, in double precision.

In the graph, vectors have single precision, so that near copies stay apart.

Defined results: vectors that are NULL, zero, of another length than most, or
that hold a NULL or non-finite component take no part, nor do rows with a NULL
id; of rows with one id and several vectors the first in the vectors' order
counts; ties go to the smaller id; an empty table gives no rows.  Only the id
and the vector are read.  Components beyond 1e18 count as that in the graph
only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from skylane.llm.common import broadcast_if_small, join_counted, shared_table

NEIGHBOURS = 24
TREES, LEAF, PER_LEAF = 10, 1024, 12
#: Planes of one pass that deals a crowded leaf again.
PLANES = 8
ROUNDS = 2
BEAM, EXPANDED = 256, 96
SAMPLE = 4096
SEEDS = 32
#: Neighbours in a row of the graph, and rows that a search step handles at once.
PER_ROW, AT_ONCE = 8, 1024
#: Rows of queries' frontier (each under 1 kB at 64 components) to broadcast.
BROADCAST_ROWS = 150_000


def usable_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec array<double>) of the rows that take part, one per id."""
    vec = F.col(f"`{vec_col}`").cast("array<double>")
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), vec.alias("vec")).where(
        "id IS NOT NULL AND vec IS NOT NULL").where(
        F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
        & F.exists("vec", lambda x: x != 0))
    size = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    if size:
        rows = rows.where(F.size("vec") == size[0]["n"])
    return rows.groupBy("id").agg(F.min("vec").alias("vec"))


def distinct_vectors(rows: DataFrame, members: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nodes (node, vec, code), the ``members`` smallest ids of each node
    (node, id), and the node of every id (node, id)."""
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.clip(_matrix(batch["vec"]), -1e18, 1e18).astype("<f4")
            yield pa.record_batch([batch["node"], batch["vec"], batch["n"], pa.array([r.tobytes() for r in codes], pa.binary())],
                                  ["node", "vec", "n", "code"])
    nodes = rows.groupBy("vec").agg(F.min("id").alias("node"), F.count("*").alias("n"))
    nodes = shared_table(nodes.select("node", "vec", "n").mapInArrow(
        code, "node long, vec array<double>, n long, code binary"), "nodes")
    of_all = shared_table(join_counted(rows, nodes.select("node", "vec", "n"), ["vec"], "n").select("node", "id"), "node-ids")
    first = F.row_number().over(Window.partitionBy("node").orderBy("id"))  # limited before the shuffle
    return nodes, of_all.withColumn("_n", first).where(F.col("_n") <= members).select("node", "id"), of_all


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column without NULLs as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _decoded(codes: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(codes), "<f4").reshape(len(codes), -1) if codes else np.zeros((0, 0), np.float32)


def _nearest(vectors: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(u, v, sim): for each vector its ``k`` nearest others."""
    k = min(k, len(ids) - 1)
    if k < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)
    sims = vectors @ vectors.T
    np.fill_diagonal(sims, -np.inf)
    top = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    return np.repeat(ids, k), ids[top].ravel(), np.take_along_axis(sims, top, axis=1).ravel()


def _link_frame(u: np.ndarray, v: np.ndarray, sim: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"u": u, "v": v, "sim": sim.astype(np.float32)})


_LINK = "u long, v long, sim float"


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[pa.Table, list[tuple[int, int]]]]:
    """Of batches sorted by ``key``: tables of whole groups, and each group's
    rows [first, last)."""
    carried = None
    for batch in _and_end(batches):
        if batch is not None:
            table = pa.Table.from_batches([batch])
            if carried is not None:
                table = pa.concat_tables([carried, table])
            if not table.num_rows:
                continue
            keys = table[key].to_numpy()
            own = np.flatnonzero(keys != keys[-1])
            whole = int(own[-1]) + 1 if len(own) else 0  # the last group may go on
            carried, table, keys = table.slice(whole), table.slice(0, whole), keys[:whole]
        elif carried is not None:
            table, keys = carried, carried[key].to_numpy()
        else:
            return
        if table.num_rows:
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            yield table.combine_chunks(), list(zip(cuts[:-1], cuts[1:]))


def _and_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def best_links(links: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest neighbours of each u."""
    rank = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("sim"), "v"))
    return links.repartition("u").groupBy("u", "v").agg(F.max("sim").alias("sim")) \
        .withColumn("_n", rank).where(F.col("_n") <= k).drop("_n")


def tree_links(nodes: DataFrame, trees: int = TREES, leaf: int = LEAF, per_leaf: int = PER_LEAF,
               seed: int = 5) -> DataFrame:
    """Links within the leaves of random hyperplane trees."""
    n = nodes.count()
    depth = max(0, math.ceil(math.log2(max(1, n) / leaf)))
    share = min(1.0, SAMPLE / max(1, n))
    # about SAMPLE vectors; the limit bounds it
    sample = nodes.where(F.pmod(F.xxhash64("node", F.lit(seed)), F.lit(1 << 20)) <= share * (1 << 20)) \
        .select("code").limit(2 * SAMPLE).toArrow()["code"].to_pylist()
    if not sample:
        return nodes.sparkSession.createDataFrame([], _LINK)
    vectors = _decoded(sample)
    planes = np.random.default_rng(seed).normal(size=(trees, vectors.shape[1], max(1, depth))).astype(np.float32)
    medians = np.median(vectors @ planes, axis=1)

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = _decoded(batch["code"].to_pylist())
            for tree in range(trees):
                side = (v @ planes[tree] > medians[tree])[:, :depth]
                place = side @ (1 << np.arange(depth)) if depth else np.zeros(len(v), np.int64)
                yield pa.record_batch([pa.array(np.full(len(v), tree, np.int32)), pa.array(place.astype(np.int64)),
                                       batch["node"], batch["code"]], ["tree", "leaf", "node", "code"])
    dealt = nodes.select("node", "code").mapInArrow(leaves, "tree int, leaf long, node long, code binary")
    dealt = _crowds_dealt(dealt, leaf, vectors.shape[1], seed)
    # what its planes cannot tell apart is dealt into parts, so that no group outgrows a task
    parts = dealt.groupBy("tree", "leaf").agg(F.ceil(F.count("*") / (2 * leaf)).alias("parts"))
    dealt = dealt.join(broadcast_if_small(shared_table(parts, "leaves"), BROADCAST_ROWS), ["tree", "leaf"]) \
        .withColumn("part", F.pmod(F.xxhash64("node", "tree"), F.col("parts")))

    def link(group: pd.DataFrame) -> pd.DataFrame:
        return _link_frame(*_nearest(_decoded(group["code"].tolist()), group["node"].to_numpy(), per_leaf))
    return dealt.groupBy("tree", "leaf", "part").applyInPandas(link, _LINK)


def _crowds_dealt(dealt: DataFrame, leaf: int, dim: int, seed: int) -> DataFrame:
    """``dealt`` (tree, leaf, node, code) with each leaf of more than twice
    ``leaf`` nodes, as a dense region makes them, dealt again by planes at the
    medians of its own nodes, until the planes hardly split any more."""
    done, number = None, 0
    while True:
        dealt = shared_table(dealt, f"leaves-{number}")
        sizes = dealt.groupBy("tree", "leaf").agg(F.count("*").alias("n")).where(F.col("n") > 2 * leaf)
        sizes = shared_table(sizes, "crowded-leaves")
        largest = sizes.agg(F.max("n")).first()[0]  # one row
        if largest is None or number and largest > 0.9 * before:
            return dealt if done is None else done.unionByName(dealt)
        before, number = largest, number + 1
        depth = min(PLANES, math.ceil(math.log2(largest / leaf)))
        planes = np.random.default_rng((seed, number)).normal(size=(dim, depth)).astype(np.float32)

        def project(batches: Iterator[pa.RecordBatch], planes=planes) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                p = _decoded(batch["code"].to_pylist()) @ planes if batch.num_rows else np.zeros((0, planes.shape[1]))
                yield pa.record_batch([*batch.columns, *[pa.array(c.astype(np.float32)) for c in p.T]],
                                      [*batch.schema.names, *[f"p{i}" for i in range(p.shape[1])]])
        small = broadcast_if_small(sizes.drop("n"), BROADCAST_ROWS)
        calm = dealt.join(small, ["tree", "leaf"], "left_anti")
        done = calm if done is None else done.unionByName(calm)
        crowd = dealt.join(small, ["tree", "leaf"]).select("tree", "leaf", "node", "code").mapInArrow(
            project, "tree int, leaf long, node long, code binary, " + ", ".join(f"p{i} float" for i in range(depth)))
        medians = crowd.groupBy("tree", "leaf").agg(
            *[F.percentile_approx(f"p{i}", 0.5, 1000).alias(f"m{i}") for i in range(depth)])
        medians = broadcast_if_small(shared_table(medians, "leaf-medians"), BROADCAST_ROWS)
        # a leaf of n nodes is halved about log2(n / leaf) times
        halvings = medians.join(sizes, ["tree", "leaf"]).withColumn("d", F.ceil(F.log2(F.col("n") / leaf)))
        place = F.lit(0)
        for i in range(depth):
            place = place + F.when((F.col("d") > i) & (F.col(f"p{i}") > F.col(f"m{i}")), 1 << i).otherwise(0)
        dealt = crowd.join(broadcast_if_small(shared_table(halvings.drop("n"), "halvings"), BROADCAST_ROWS),
                           ["tree", "leaf"]).select(
            "tree", F.xxhash64("leaf", F.lit(number), place).alias("leaf"), "node", "code")


def both_ways(links: DataFrame, k: int) -> DataFrame:
    """(node, other): forward links and the ``k`` nearest reverse links."""
    back = best_links(links.select(F.col("v").alias("u"), F.col("u").alias("v"), "sim"), k)
    return links.select(F.col("u").alias("node"), F.col("v").alias("other")) \
        .unionByName(back.select(F.col("u").alias("node"), F.col("v").alias("other"))).distinct()


def descend(nodes: DataFrame, links: DataFrame, k: int = NEIGHBOURS, learned: int = 4) -> DataFrame:
    """One NN-descent round: neighbours of a node meet as candidates."""
    met = both_ways(links, k).join(nodes.select(F.col("node").alias("other"), "code"), "other")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, groups in whole_groups(batches, "node"):  # at most 2 * k rows each
            vectors, ids = _decoded(table["code"].to_pylist()), table["other"].to_numpy()
            parts = [_nearest(vectors[a:b], ids[a:b], learned) for a, b in groups]
            u, v, sim = (np.concatenate(c) for c in zip(*parts))
            yield pa.record_batch([pa.array(u), pa.array(v), pa.array(sim.astype(np.float32))], ["u", "v", "sim"])
    brought = met.select("node", "other", "code").repartition("node").sortWithinPartitions("node").mapInArrow(meet, _LINK)
    return best_links(brought.unionByName(links), k)


def neighbour_graph(nodes: DataFrame, k: int = NEIGHBOURS, rounds: int = ROUNDS) -> DataFrame:
    """(u, v, sim): the NN-descent graph."""
    links = shared_table(best_links(tree_links(nodes), k), "links-0")
    for number in range(rounds):
        links = shared_table(descend(nodes, links, k), f"links-{number + 1}")
    return links


def adjacency(nodes: DataFrame, links: DataFrame, k: int = NEIGHBOURS, per_row: int = PER_ROW) -> DataFrame:
    """(node, others, codes): neighbours with their vectors, at most 2 * k; at
    most ``per_row`` a row, so that batches of rows stay small."""
    met = both_ways(links, k).join(nodes.select(F.col("node").alias("other"), "code"), "other")
    rows = met.groupBy("node").agg(F.collect_list(F.struct("other", "code")).alias("o"))
    first = F.explode(F.sequence(F.lit(1), F.size("o"), F.lit(per_row))).alias("first")
    rows = rows.select("node", "o", first).select("node", F.slice("o", F.col("first"), F.lit(per_row)).alias("o"))
    return rows.select("node", F.col("o.other").alias("others"), F.col("o.code").alias("codes"))


_BEAM = "query long, code binary, ids array<long>, sims array<float>, done array<boolean>"


def greedy_search(nodes: DataFrame, graph: DataFrame, queries: DataFrame, beam: int = BEAM,
                  expanded: int = EXPANDED) -> DataFrame:
    """(query, node, sim): the beam of each query (query, code) at the end,
    when all of it is expanded (a node that left a beam never comes back).
    The search starts at a few nodes of the whole table and, if the query is a
    node itself, there."""
    seeds = nodes.orderBy(F.xxhash64("node"), "node").limit(SEEDS).select("node", "code").toArrow()
    seed_ids, seed_codes = seeds["node"].to_numpy(), seeds["code"].to_pylist()

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            if batch.num_rows:
                v = _decoded(batch["code"].to_pylist())
                sims = v @ _decoded(seed_codes).T
                for q, code, own, row in zip(batch["query"].to_pylist(), batch["code"].to_pylist(),
                                             (v * v).sum(axis=1).tolist(), sims):
                    held = dict(zip(seed_ids.tolist(), row.tolist())) | {q: own}
                    rows.append((q, code, list(held), list(held.values()), [False] * len(held)))
            yield _beam_batch(rows)
    beams = shared_table(queries.select("query", "code").mapInArrow(start, _BEAM), "beam-0")

    def frontier(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches, AT_ONCE // 8):
            sizes, ids, sims, done = _beam_arrays(batch)
            row, ends = np.repeat(np.arange(len(sizes)), sizes), np.cumsum(sizes)
            open_ = np.flatnonzero(~done)
            place = np.arange(len(open_)) - np.searchsorted(row[open_], row[open_])
            todo = open_[place < expanded]  # nearest first
            bound = np.where(sizes >= beam, sims[ends - 1], -np.inf).astype(np.float32)
            yield pa.record_batch([batch["query"].take(pa.array(row[todo])), batch["code"].take(pa.array(row[todo])),
                                   pa.array(ids[todo]), pa.array(bound[row[todo]])], ["query", "qcode", "node", "bound"])

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches, AT_ONCE):
            sizes = pc.list_value_length(batch["others"]).to_numpy()
            row = np.repeat(np.arange(len(sizes)), sizes)
            asked, codes = _codes(batch["qcode"]), _codes(batch["codes"].flatten())
            sims = np.einsum("ij,ij->i", codes, asked[row])
            near = np.flatnonzero(sims > batch["bound"].to_numpy()[row])
            # the expanded node leads, marked; the beam knows its similarity
            kept = np.bincount(row[near], minlength=len(sizes))
            first = np.cumsum(kept + 1) - kept - 1
            ids, found = np.zeros(len(near) + len(sizes), np.int64), np.full(len(near) + len(sizes), -np.inf, np.float32)
            done = np.zeros(len(ids), bool)
            done[first] = True
            ids[done], ids[~done] = batch["node"].to_numpy(), batch["others"].flatten().to_numpy()[near]
            found[~done] = sims[near]
            yield _beam_lists(batch["query"], pa.nulls(len(sizes), pa.binary()), kept + 1, ids, found, done)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, groups in whole_groups(few_rows(batches, AT_ONCE), "query"):
            whole = table.to_batches()[0]
            sizes, found, near, was = _beam_arrays(whole)
            begins = np.array([lo for lo, _ in groups])
            group = np.repeat(np.repeat(np.arange(len(groups)), [hi - lo for lo, hi in groups]), sizes)
            order = np.lexsort((~was, -near, found, group))  # of one node the known similarity first
            group, found, near, was = group[order], found[order], near[order], was[order]
            first = np.flatnonzero(np.concatenate(([True], (found[1:] != found[:-1]) | (group[1:] != group[:-1]))))
            was = np.logical_or.reduceat(was, first)
            group, found, near = group[first], found[first], near[first]
            order = np.lexsort((found, -near, group))
            order = order[np.arange(len(order)) - np.searchsorted(group, group) < beam]  # sorted by group before and after
            kept = np.bincount(group[order], minlength=len(groups))
            yield _beam_lists(whole["query"].take(pa.array(begins)), whole["code"].drop_null(), kept, found[order], near[order], was[order])
    for step in count():
        todo = shared_table(beams.mapInArrow(frontier, "query long, qcode binary, node long, bound float"), "frontier")
        if todo.isEmpty():
            break
        found = broadcast_if_small(todo, BROADCAST_ROWS).join(graph, "node") \
            .select("query", "qcode", "node", "bound", "others", "codes").mapInArrow(expand, _BEAM)
        # a node without neighbours has no row in the graph: mark it all the same
        lone = todo.join(graph.select("node"), "node", "left_anti").select(
            "query", F.lit(None).cast("binary").alias("code"), F.array("node").alias("ids"),
            F.array(F.lit(-math.inf).cast("float")).alias("sims"), F.array(F.lit(True)).alias("done"))
        beams = shared_table(beams.unionByName(found).unionByName(lone).repartition("query")
                             .sortWithinPartitions("query").mapInArrow(merge, _BEAM), f"beam-{step + 1}")
    return beams.select("query", F.explode(F.arrays_zip("ids", "sims")).alias("x")) \
        .select("query", F.col("x.ids").alias("node"), F.col("x.sims").alias("sim"))


def few_rows(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most so many rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _codes(column: pa.Array) -> np.ndarray:
    """The vectors of a binary column without NULLs, where they lie."""
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1]
    if not len(column):
        return np.zeros((0, 0), np.float32)
    return np.frombuffer(data, np.uint8)[ends[0]:ends[-1]].view("<f4").reshape(len(column), -1)


def _beam_arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """The lists' lengths, and ids, sims and done of all rows."""
    return (pc.list_value_length(batch["ids"]).to_numpy(), batch["ids"].flatten().to_numpy(), batch["sims"].flatten().to_numpy(),
            batch["done"].flatten().to_numpy(zero_copy_only=False))


def _beam_lists(query: pa.Array, code: pa.Array, sizes: np.ndarray, ids: np.ndarray, sims: np.ndarray, done: np.ndarray) -> pa.RecordBatch:
    ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
    lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (ids, sims.astype(np.float32), done)]
    return pa.record_batch([query, code, *lists], ["query", "code", "ids", "sims", "done"])


def _beam_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.float32()), pa.list_(pa.bool_()))
    return pa.record_batch([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * 5, kinds)],
                           ["query", "code", "ids", "sims", "done"])


def inner_product(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def nearest_neighbours(df: DataFrame, id_col: str, vec_col: str, is_query: Column, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row (``is_query`` over
    the column ``id``) its ``k`` nearest other rows found."""
    rows = shared_table(usable_vectors(df, id_col, vec_col), "vectors")
    nodes, members, of_all = distinct_vectors(rows, k + 1)
    graph = shared_table(adjacency(nodes, neighbour_graph(nodes)), "graph")
    asked = of_all.where(is_query).select("node", F.col("id").alias("query_id"))
    queries = asked.select("node").distinct().join(nodes.select("node", "code"), "node") \
        .select(F.col("node").alias("query"), "code")
    beams = greedy_search(nodes, graph, queries)
    ranked = Window.partitionBy("query").orderBy(F.desc("sim"), "node")
    # similarities of single precision differ from the true ones by less than ``slack`` each
    norm = nodes.agg(F.max(F.sqrt(inner_product(F.col("vec"), F.col("vec"))))
                     .alias("norm"), F.max(F.size("vec")).alias("dim")).first()  # one row
    slack = (norm["dim"] + 2) * 2.0 ** -23 * norm["norm"] ** 2 if norm["dim"] else 0.0
    last = F.max(F.when(F.col("_n") == k + 1, F.col("sim"))).over(Window.partitionBy("query"))
    near = beams.withColumn("_n", F.row_number().over(ranked)).withColumn("_last", last) \
        .where((F.col("_n") <= 2 * k) | (F.col("sim") >= F.col("_last") - 2 * slack)).select("query", "node")
    scored = near.join(nodes.select("node", "vec"), "node") \
        .join(nodes.select(F.col("node").alias("query"), F.col("vec").alias("_q")), "query") \
        .select("query", "node", inner_product(F.col("_q"), F.col("vec")).alias("score"))
    # each query node's first k + 1 ids, then for each query the first k others
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
    lists = scored.join(members, "node").withColumn("_n", place).where(F.col("_n") <= k + 1) \
        .groupBy("query").agg(F.array_sort(F.collect_list(F.struct("_n", "id", "score"))).alias("found"))
    others = F.slice(F.filter("found", lambda f: f["id"] != F.col("query_id")), 1, k)
    return asked.join(lists, asked["node"] == lists["query"]).select("query_id", F.posexplode(others).alias("at", "f")) \
        .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("f.id").alias("vec_id"), "f.score")


def op7_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every vector whose id 20 divides."""
    from skylane.llm.common import read_table
    return nearest_neighbours(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("id") % 20 == 0)
