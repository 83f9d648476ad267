"""Exact nearest neighbours by cosine.

Two plans give the same rows:

* the searched side fits a fixed byte bound: it is broadcast as one matrix and every Arrow batch
  of queries is multiplied with it, without a shuffle;
* otherwise items are written by cells around pivots, the centres of a bounded sample, in blocks of fixed size, and queries are
  dealt out in the order of their cells. A task holds some thousand queries with their k best so far and reads one block after another
  from the shared folder, their own cell first, which bounds the distance of the k-th neighbour; then only cells whose pivot distance minus
  radius lies within that bound for a query (triangle inequality), the nearest first. Inside a cell items stand in the
  order of their angle to the pivot, and a query meets only those whose angle differs from its own by no more than its
  bound (the same inequality for angles). Neither queries nor items are copied: both are moved once, and k rows per query come back.

With ``by`` both sides meet by group in a shuffle, cut into blocks, so a large group is many small tasks. No pair table exists.

Similarities are rounded to 10 digits before ordering, ties go to the lower id.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import as_bytes, as_matrix, chunks, from_bytes, unit
from ..session import discard, materialize, opened, scratch_path

BROADCAST_BYTES = 64 << 20
BROADCAST_ROWS = 1 << 17  # as many as fill that bound at 64 dimensions
BLOCK_BYTES = 16 << 20
LEAST_CELLS, CELL_ROWS = 16, 8192  # cells, and items of a cell on average
PIVOT_BYTES = 32 << 20
_CHUNK = 1 << 22  # similarities held at a time
_ROWS, _COLUMNS, _NARROW = 512, 2048, 512  # queries and items of one product, and items where angles are known
_LISTED = 256  # pairs listed per query; with more, all its similarities are computed
_PAIRS = 1 << 15  # pairs computed at a time
_QUERIES, _LEAST_QUERIES, _TASKS = 1 << 14, 1 << 10, 4  # queries a task holds at a time, of a task at least, tasks per core
_LEAST = np.float32(-2)  # below every similarity
_RESULT = "qid long, iid long, sim double"
_ARROW_RESULT = pa.schema([("qid", pa.int64()), ("iid", pa.int64()), ("sim", pa.float64())])
_SLACK = 1e-6
_SAMPLE, _ROUNDS = 1 << 12, 8  # least number of vectors that pivots are centred on, rounds of centring
_QUERY_BLOCKS = 2  # a block of queries is larger than one of items by this factor
_MOST_BLOCKS = 64


def _best_k(sims: np.ndarray, ids: np.ndarray, k: int, banned: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Positions and similarities of the k best columns per row; columns are in id order."""
    sims = np.round(sims, 10)
    if banned is not None:
        sims = np.where(banned[:, None] == ids[None, :], -np.inf, sims)
    k = min(k, sims.shape[1])
    if k == 1:
        place = sims.argmax(axis=1)[:, None]
    else:
        place = np.sort(np.argpartition(-sims, k - 1, axis=1)[:, :k], axis=1)
        chosen = np.take_along_axis(sims, place, axis=1)
        last = chosen.min(axis=1, keepdims=True)
        # rows with more columns tied at the k-th value than were chosen need a full stable sort
        tied = (sims == last).sum(axis=1) > (chosen == last).sum(axis=1)
        if tied.any():
            place[tied] = np.sort(np.argsort(-sims[tied], axis=1, kind="stable")[:, :k], axis=1)
            chosen = np.take_along_axis(sims, place, axis=1)
        place = np.take_along_axis(place, np.argsort(-chosen, axis=1, kind="stable"), axis=1)
    return place, np.take_along_axis(sims, place, axis=1)


def _likely(
    queries: np.ndarray, items: np.ndarray, k: int, low: np.ndarray, own: tuple[np.ndarray, np.ndarray, np.ndarray] | None,
    qgroup: np.ndarray | None, igroup: np.ndarray | None, angles: tuple[np.ndarray, np.ndarray] | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column) pairs that hold the k best columns of every row, and the rows with too many of them to list.

    Products are of single precision and every bound is lowered by more than their error, so no pair among the best is lost.
    ``low`` (raised in place) is a value that the k-th best reaches; ``own`` are, for each row, the begin and end of a run in a list of columns,
    and that list: a row must not take the columns of its run. ``angles`` are those of queries and items to one direction, the items' ascending:
    rows skip items whose angle differs from theirs by too much for ``low``.
    """
    slack = np.float32((queries.shape[1] + 8) * 2.0**-22)
    row, column, value = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.float32)]
    dense, held, most, every = np.zeros(len(queries), bool), 0, _LISTED * len(queries), np.arange(len(queries))

    def tighten() -> None:
        r, c, v = (np.concatenate(x) for x in (row, column, value))
        order = np.lexsort((-v, r))
        r, c, v = r[order], c[order], v[order]
        begin = np.searchsorted(r, np.arange(len(queries) + 1))
        last = begin[:-1] + k - 1
        full = np.flatnonzero(last < begin[1:])
        low[full] = np.maximum(low[full], v[last[full]] - slack)
        keep = v >= low[r]
        dense[np.bincount(r[keep], minlength=len(queries)) > max(_LISTED, 4 * k)] = True
        low[dense] = np.inf
        keep &= ~dense[r]
        row[:], column[:], value[:] = [r[keep]], [c[keep]], [v[keep]]

    columns = _COLUMNS if angles is None else _NARROW
    for start in range(0, len(items), columns):
        some = slice(start, start + columns)
        asked = every
        if angles is not None:
            apart = np.maximum(angles[1][some][0] - angles[0], angles[0] - angles[1][some][-1])
            asked = np.flatnonzero(np.cos(np.clip(apart - _SLACK, 0, np.pi)) >= low)
            if not len(asked):
                continue
        sims = queries[asked] @ items[some].T
        if igroup is not None:
            sims[qgroup[asked, None] != igroup[None, some]] = -np.inf
        if own is not None:
            begin, end, place = own[0][asked], own[1][asked], own[2]
            for more in range(int((end - begin).max(initial=0))):
                mine = np.flatnonzero(begin + more < end)
                at = place[begin[mine] + more] - start
                inside = (at >= 0) & (at < sims.shape[1])
                sims[mine[inside], at[inside]] = -np.inf
        fresh = np.flatnonzero(low[asked] <= _LEAST)
        if len(fresh) and sims.shape[1] > k:
            kth = np.partition(sims[fresh], sims.shape[1] - k, axis=1)[:, sims.shape[1] - k]
            low[asked[fresh]] = np.maximum(low[asked[fresh]], kth - slack)
        live = np.flatnonzero(sims.max(axis=1) >= low[asked])
        if not len(live):
            continue
        chosen = sims[live]
        hit = np.flatnonzero(chosen >= low[asked[live], None])
        row.append(asked[live[hit // sims.shape[1]]])
        column.append(hit % sims.shape[1] + start)
        value.append(chosen.ravel()[hit])
        held += len(hit)
        if held > most:
            tighten()
            held = len(row[0])
            most = max(_LISTED * len(queries), 2 * held)
    tighten()
    return row[0], column[0], np.flatnonzero(dense)


def _search_block(
    qids: np.ndarray, queries: np.ndarray, ids: np.ndarray, items: np.ndarray, k: int, exclude_self: bool,
    qgroup: np.ndarray | None = None, igroup: np.ndarray | None = None, floor: np.ndarray | None = None, pivot: np.ndarray | None = None,
) -> pa.RecordBatch:
    """``qid, iid, sim`` of the k best items per query, as ``_best_rows`` finds them."""
    row, iid, sim = _best_rows(qids, queries, ids, items, k, exclude_self, qgroup, igroup, floor, pivot)
    return pa.RecordBatch.from_arrays([pa.array(qids[row]), pa.array(iid), pa.array(sim)], schema=_ARROW_RESULT)


def _best_rows(
    qids: np.ndarray, queries: np.ndarray, ids: np.ndarray, items: np.ndarray, k: int, exclude_self: bool,
    qgroup: np.ndarray | None = None, igroup: np.ndarray | None = None, floor: np.ndarray | None = None, pivot: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row of the query, id of the item and similarity of the k best items per query (unit vectors): products of single precision leave few
    pairs, which are computed exactly.

    With ``floor`` pairs below that similarity may be left out; with ``pivot``, a unit vector, products that angles to it rule out are
    not computed. A query with many items at its k-th similarity, copies or a zero vector, meets all items in double precision.
    """
    order = np.argsort(ids, kind="stable")
    order = order[np.isfinite(items).all(axis=1)[order]]
    ids, items = ids[order], items[order]
    igroup = igroup[order] if igroup is not None else None
    asked = np.flatnonzero(np.isfinite(queries).all(axis=1)) if len(ids) else np.zeros(0, np.int64)
    turn, angles = np.arange(len(ids)), None
    if pivot is not None and len(asked):
        angles = [np.arccos(np.clip(side @ pivot, -1, 1)) for side in (queries[asked], items)]
        turn, near = np.argsort(angles[1], kind="stable"), np.argsort(angles[0], kind="stable")
        asked, angles = asked[near], (angles[0][near], angles[1][turn])
    place = np.empty_like(turn)
    place[turn] = np.arange(len(turn))
    own = [np.searchsorted(ids, qids, side) for side in ("left", "right")] if exclude_self else None
    small, parts = items[turn].astype(np.float32), []

    def add(rows: np.ndarray, columns: np.ndarray, sims: np.ndarray) -> None:
        parts.append((rows, ids[columns], sims))

    for start in range(0, len(asked), _ROWS):
        part = asked[start : start + _ROWS]
        low = np.full(len(part), _LEAST, np.float32)
        if floor is not None:
            low = np.maximum(low, floor[part].astype(np.float32) - np.float32((items.shape[1] + 8) * 2.0**-22))
        row, column, dense = _likely(
            queries[part].astype(np.float32), small, k, low, (own[0][part], own[1][part], place) if own else None,
            qgroup[part] if igroup is not None else None, igroup, (angles[0][start : start + _ROWS], angles[1]) if angles else None,
        )
        column = turn[column]
        if len(row):
            sims = np.concatenate([
                np.einsum("ij,ij->i", queries[part[row[i : i + _PAIRS]]], items[column[i : i + _PAIRS]]) for i in range(0, len(row), _PAIRS)
            ])
            sims = np.round(sims, 10)
            best = np.lexsort((column, -sims, row))
            row, column, sims = row[best], column[best], sims[best]
            keep = np.arange(len(row)) - np.searchsorted(row, row) < k
            add(part[row[keep]], column[keep], sims[keep])
        step = max(1, _CHUNK // max(1, len(ids)))
        for first in range(0, len(dense), step):
            rest = part[dense[first : first + step]]
            sims = queries[rest] @ items.T
            if igroup is not None:
                sims = np.where(qgroup[rest][:, None] == igroup[None, :], sims, -np.inf)
            found, best = _best_k(sims, ids, k, qids[rest] if exclude_self else None)
            keep = np.isfinite(best.ravel())
            add(np.repeat(rest, found.shape[1])[keep], found.ravel()[keep], best.ravel()[keep])
    parts.append((np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)))
    rows, found, sims = (np.concatenate(x) for x in zip(*parts))
    return rows, found, sims


def _broadcast_search(queries: DataFrame, items: DataFrame, k: int, exclude_self: bool) -> DataFrame:
    spark = queries.sparkSession
    table = items.select("id", "vec", "grp").toArrow()
    if table.num_rows == 0:
        return spark.createDataFrame([], _RESULT)
    groups = table.column("grp").combine_chunks().dictionary_encode()
    shared = spark.sparkContext.broadcast(
        (table.column("id").to_numpy(), unit(as_matrix(table.column("vec"))), groups.dictionary, np.asarray(groups.indices))
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, matrix, names, igroup = shared.value
        for batch in batches:
            qgroup = pc.fill_null(pc.index_in(batch.column("grp"), value_set=names.cast(batch.column("grp").type)), -1)
            batch = batch.filter(pc.not_equal(qgroup, -1))  # a group without items has no neighbours
            if batch.num_rows == 0:
                continue
            grouped = len(names) > 1
            yield _search_block(
                batch.column("id").to_numpy(), unit(as_matrix(batch.column("vec"))), known, matrix, k, exclude_self,
                np.asarray(qgroup.filter(pc.not_equal(qgroup, -1))) if grouped else None, igroup if grouped else None,
            )

    return queries.select("id", "vec", "grp").mapInArrow(search, _RESULT)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, vec, cell with unit vectors as bytes, which move faster than lists."""
    for batch in batches:
        if batch.num_rows:
            vectors = unit(as_matrix(batch.column("vec")))
            yield pa.RecordBatch.from_arrays([batch.column("id"), as_bytes(vectors), batch.column("cell")], names=["id", "vec", "cell"])


def _search_groups(asked: DataFrame, items: DataFrame, k: int, exclude_self: bool, rows: int) -> DataFrame:
    """Search the items of each query's own cell (id, vec, cell; unit vectors as bytes), cut into blocks of about ``rows`` rows, the queries into larger ones."""
    blocks = lambda size: F.greatest(F.lit(1), F.ceil(F.count("*") / F.lit(float(size)))).cast("int")
    sizes = items.groupBy("cell").agg(blocks(rows).alias("nblk")).join(asked.groupBy("cell").agg(blocks(_QUERY_BLOCKS * rows).alias("nsalt")), "cell")
    left = (
        asked.join(sizes, "cell")
        .withColumn("salt", F.pmod(F.xxhash64("id"), F.col("nsalt")).cast("int"))
        .withColumn("blk", F.explode(F.sequence(F.lit(0), F.col("nblk") - 1)))
        .select("cell", "blk", "salt", "id", "vec")
    )
    right = (
        items.join(sizes, "cell")
        .withColumn("blk", F.pmod(F.xxhash64("id"), F.col("nblk")).cast("int"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("nsalt") - 1)))
        .select("cell", "blk", "salt", "id", "vec")
    )

    def search(mine: pa.Table, known: pa.Table) -> pa.Table:
        if mine.num_rows == 0 or known.num_rows == 0:
            return _ARROW_RESULT.empty_table()
        sides = (x for t in (mine, known) for x in (t.column("id").to_numpy(), from_bytes(t.column("vec"))))
        return pa.Table.from_batches([_search_block(*sides, k, exclude_self)])

    keys = ["cell", "blk", "salt"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, _RESULT)
    return _merge(found, k)


def _merge(found: DataFrame, k: int) -> DataFrame:
    window = Window.partitionBy("qid").orderBy(F.desc("sim"), "iid")
    return found.withColumn("rn", F.row_number().over(window)).where(F.col("rn") <= k).drop("rn")


def _centres(sample: np.ndarray, cells: int) -> np.ndarray:
    """``cells`` unit vectors, each the mean direction of the sample's vectors nearest to it, after a few rounds from the first ones."""
    pivots = sample[:cells].copy()
    step = max(1, _CHUNK // max(cells, 1))
    for _ in range(_ROUNDS):
        near = np.concatenate([(sample[i : i + step] @ pivots.T).argmax(axis=1) for i in range(0, len(sample), step)])
        sums = np.zeros_like(pivots)
        np.add.at(sums, near, sample)
        pivots = np.where(sums.any(axis=1, keepdims=True), unit(sums), pivots)
    return pivots


def _sampled(items: DataFrame, cells: int, size: int, width: int) -> np.ndarray:
    """Unit vectors of about ``_SAMPLE`` items, or four a cell, within ``PIVOT_BYTES``, by the hash of their ids; pivots only decide what is pruned."""
    wanted = min(max(_SAMPLE, 4 * cells), max(cells, PIVOT_BYTES // width))
    share = min(1.0, wanted / size)
    drawn = items.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < F.lit(math.ceil(share * (1 << 20)))).limit(2 * wanted).select("vec").toArrow()
    if drawn.num_rows < cells:
        drawn = items.orderBy(F.xxhash64("id"), "id").limit(cells).select("vec").toArrow()
    vectors = unit(as_matrix(drawn.column("vec")))
    finite = vectors[np.isfinite(vectors).all(axis=1)]
    return finite if len(finite) else np.zeros((1, vectors.shape[1]))


def _pivot_search(queries: DataFrame, items: DataFrame, k: int, exclude_self: bool, rows: int, cells: int, size: int, width: int) -> DataFrame:
    spark = queries.sparkSession
    pivots = spark.sparkContext.broadcast(_centres(_sampled(items, cells, size, width), cells))
    step = max(1, _CHUNK // max(cells, 1))  # vectors whose distances to all pivots are held at a time

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            vectors = unit(as_matrix(batch.column("vec")))
            cell, own = np.zeros(len(vectors), np.int64), np.zeros(len(vectors))
            for start in range(0, len(vectors), step):
                distance = _distances(vectors[start : start + step], pivots.value)
                cell[start : start + step], own[start : start + step] = distance.argmin(axis=1), distance.min(axis=1)
            own[np.isnan(own)] = 0  # is no neighbour, and must not hide its cell
            own[~vectors.any(axis=1)] = np.inf  # a zero vector is similar to nothing: its cell is always visited
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), as_bytes(vectors), pa.array(cell.astype("int32")), pa.array(own)], names=["id", "vec", "cell", "own"]
            )

    schema = "id long, vec binary, cell int, own double"
    shelved = materialize(items.select("id", "vec").mapInArrow(assign, schema), "items")
    asked = materialize(queries.select("id", "vec").mapInArrow(assign, schema).drop("own"), "queries")
    return _merge(_search_cells(asked, shelved, k, exclude_self, rows, pivots), k)


def _search_cells(asked: DataFrame, items: DataFrame, k: int, exclude_self: bool, rows: int, pivots: Broadcast) -> DataFrame:
    """The k best items of each query; ``asked`` (id, vec, cell) and ``items`` (id, vec, cell, own) hold unit vectors as bytes, ``own`` is the distance to the pivot.

    Items are written by cell in blocks of about ``rows`` rows, one file each. A task keeps a chunk of queries in memory, with their k best,
    and one block at a time. A cell is the number of its pivot; the driver holds a row per cell and the names of the files.
    """
    spark = asked.sparkSession
    blocks = F.greatest(F.lit(1), F.ceil(F.count("*") / F.lit(float(rows)))).cast("int")
    sizes = materialize(items.groupBy("cell").agg(blocks.alias("nblk"), F.max("own").alias("radius")), "sizes")  # at most one row per pivot
    known = {r["cell"]: r["radius"] for r in sizes.collect()}
    placed = items.join(F.broadcast(sizes.select("cell", "nblk")), "cell").withColumn("blk", F.pmod(F.xxhash64("id"), F.col("nblk")).cast("int"))
    path = scratch_path(spark, "blocks")
    placed.select("id", "vec", "cell", "blk").repartition("cell", "blk").write.partitionBy("cell", "blk").parquet(path)
    discard(items)
    names: dict[int, list[str]] = {}
    for name in sorted(spark.read.schema("id long, vec binary, cell int, blk int").parquet(path).inputFiles()):
        names.setdefault(int(re.search(r"/cell=(\d+)/blk=\d+/", name)[1]), []).append(name)
    cells = np.array(sorted(names), np.int64)
    shared = spark.sparkContext.broadcast((cells, np.array([known[c] for c in cells.tolist()]), [names[c] for c in cells.tolist()]))
    width = 8 * pivots.value.shape[1]
    chunk = max(1, min(_QUERIES, _QUERY_BLOCKS * BLOCK_BYTES // width, 4 * _CHUNK // max(1, len(cells)), _CHUNK // k))
    size = asked.count()
    tasks = max(-(-size // chunk), min(_TASKS * spark.sparkContext.defaultParallelism, -(-size // _LEAST_QUERIES)), 1)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, chunk):
            ids, vectors, own = part.column("id").to_numpy(), from_bytes(part.column("vec")), part.column("cell").to_numpy()
            numbers, radius, files = shared.value
            least = np.empty((len(ids), len(numbers)), np.float32)  # distances to the nearest points that cells may hold, never too large
            for start in range(0, len(ids), 1024):
                far = _distances(vectors[start : start + 1024], pivots.value[numbers]) - radius
                least[start : start + 1024] = far - 4 * _SLACK
            least[own[:, None] == numbers] = -np.inf
            best = _Best(len(ids), k)
            # cells of the chunk's own first, then the ones that are nearest to all
            mine, near = np.isneginf(least).any(axis=0), np.where(np.isfinite(least), least, 0).mean(axis=0, dtype=np.float64)
            for at in np.lexsort((near, ~mine)):
                floor = best.floor()
                bound = np.where(vectors.any(axis=1), np.sqrt(np.maximum(0.0, 2 - 2 * np.maximum(floor, -1.0))), np.inf)
                bound[np.isneginf(floor)] = np.inf
                asking = np.flatnonzero(least[:, at] <= bound)
                for name in files[at] if len(asking) else ():
                    system, inner = opened(name)
                    block = pq.read_table(inner, filesystem=system, columns=["id", "vec"], partitioning=None)
                    row, iid, sim = _best_rows(
                        ids[asking], vectors[asking], block.column("id").to_numpy(), from_bytes(block.column("vec")), k, exclude_self,
                        floor=best.floor()[asking], pivot=pivots.value[numbers[at]],
                    )
                    best.add(asking[row], iid, sim)
            yield best.batch(ids)

    return asked.repartitionByRange(tasks, "cell", F.xxhash64("id")).sortWithinPartitions("cell").mapInArrow(search, _RESULT)


class _Best:
    """The k best items of each of ``n`` queries so far: similar ones first, ties by id."""

    def __init__(self, n: int, k: int):
        self.sim, self.iid, self.k = np.full((n, k), -np.inf), np.zeros((n, k), np.int64), k

    def floor(self) -> np.ndarray:
        """The k-th similarity, which an item must reach; -inf where fewer were found."""
        return self.sim[:, -1]

    def add(self, row: np.ndarray, iid: np.ndarray, sim: np.ndarray) -> None:
        if not len(row):
            return
        rows = np.unique(row)
        old = np.isfinite(self.sim[rows])
        row = np.concatenate([np.repeat(rows, old.sum(axis=1)), row])
        iid, sim = np.concatenate([self.iid[rows][old], iid]), np.concatenate([self.sim[rows][old], sim])
        order = np.lexsort((iid, -sim, row))
        row, iid, sim = row[order], iid[order], sim[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        keep = place < self.k
        self.sim[row[keep], place[keep]], self.iid[row[keep], place[keep]] = sim[keep], iid[keep]

    def batch(self, ids: np.ndarray) -> pa.RecordBatch:
        row, place = np.nonzero(np.isfinite(self.sim))
        return pa.RecordBatch.from_arrays([pa.array(ids[row]), pa.array(self.iid[row, place]), pa.array(self.sim[row, place])], schema=_ARROW_RESULT)


def _distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (vectors**2).sum(axis=1)[:, None] + (pivots**2).sum(axis=1)[None, :] - 2 * vectors @ pivots.T
    return np.sqrt(np.maximum(0.0, squares))


def nearest(
    queries: DataFrame,
    items: DataFrame,
    k: int,
    query_id: str = "doc_id",
    item_id: str = "doc_id",
    query_vec: str = "embedding",
    item_vec: str = "embedding",
    by: str | None = None,
    exclude_self: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
    block_bytes: int = BLOCK_BYTES,
    cells: int | None = None,
) -> DataFrame:
    """The ``k`` most similar items of each query: ``qid, iid, sim``; at least one item must exist.

    With ``by`` only items with the same value of that column are candidates. The number of cells follows the
    number of items unless ``cells`` names it; pivots take at most ``PIVOT_BYTES``. Blocks are of ``block_bytes``, but
    grow up to ``BLOCK_BYTES`` where the items would fill more than ``_MOST_BLOCKS``: every query may be copied to every block.
    Beyond ``BROADCAST_ROWS`` items are never broadcast: however narrow they are, cells spare most products.
    """
    group = F.col(by).cast("string") if by else F.lit("")
    shape = lambda df, i, v: df.where(F.col(v).isNotNull()).select(
        F.col(i).cast("long").alias("id"), F.col(v).cast("array<double>").alias("vec"), group.alias("grp")
    )
    asked, known = shape(queries, query_id, query_vec), shape(items, item_id, item_vec)
    size = known.agg(F.count("*").alias("n"), F.max(F.size("vec")).alias("d")).first()
    width = 8 * (size["d"] or 1)
    if size["n"] * width <= broadcast_bytes and (by or size["n"] <= BROADCAST_ROWS):
        return _broadcast_search(asked, known, k, exclude_self)
    rows = max(1, block_bytes // width)
    rows = max(rows, min(-(-size["n"] // _MOST_BLOCKS), BLOCK_BYTES // width))
    if by:
        cell = lambda df: df.withColumnRenamed("grp", "cell").mapInArrow(_packed, "id long, vec binary, cell string")
        return _search_groups(cell(asked), cell(known), k, exclude_self, rows)
    grown = min(max(LEAST_CELLS, -(-size["n"] // CELL_ROWS)), max(LEAST_CELLS, PIVOT_BYTES // width))
    return _pivot_search(asked, known, k, exclude_self, rows, min(cells or grown, size["n"]), size["n"], width)


def knn_cosine(
    emb: DataFrame, k: int, key: str = "doc_id", vec: str = "embedding", by: str | None = None, **options: int
) -> DataFrame:
    """``doc_id, neighbour_id, similarity, rank`` for the k nearest other documents, with ``by`` of the same slice."""
    found = nearest(emb, emb, k, key, key, vec, vec, by, exclude_self=True, **options)
    rank = F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("sim"), "iid"))
    return found.select(
        F.col("qid").alias(key), F.col("iid").alias("neighbour_id"), F.col("sim").alias("similarity"), rank.alias("rank")
    )
