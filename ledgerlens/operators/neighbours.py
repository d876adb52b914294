"""Exact k nearest neighbours of every row within one table, by pivot cells.

Rows go to the cell of their nearest pivot. Pivots are a hash-picked sample of the distinct rows, so
dense regions get more of them; with cells of about twice the square root of the rows, there are half as
many pivots as that root, and placing the rows costs n^1.5. A first round searches the home cell and gives
every row an upper bound for its k-th distance, its reach. Then cells are visited nearest first (by what the
triangle inequality says of them), a few more in each round, and the reach shrinks between rounds: far cells are
met with the small reach or not at all. The result is exact for any data; the bounds only save work. Inside a task
the distances are NumPy array operations over a bounded number of rows.

``approximate_neighbours`` is the hashed form, for a caller that asks for it by name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import hash32
from ..session import forget, materialize, scratch_path, store, stored_while


CELL_ROWS = 256  # rows of a cell at least
BATCH_CELLS = 1 << 21  # numbers of one distance table in a task: with more members or pivots it has fewer rows
SENT_BYTES = 1 << 30  # of rows that are on their way to hash buckets at once
VISITS = ((0, 3), (3, 15), (15, None))  # which of the other cells, nearest first, each round may visit

# Functions for the workers are made inside factories, so they are shipped by value.
_PAIRS = "id bigint, neighbour_id bigint, d2 double"


def _batch_rows(most: int, width: int) -> int:
    return max(1, min(most, BATCH_CELLS // max(width, 1)))


def _search_kernel(k: int, batch: int = 256):
    """cogroup function: the k best members for each query row, by (squared distance, id)."""

    def search(queries: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame(
            {"id": np.array([], "int64"), "neighbour_id": np.array([], "int64"), "d2": np.array([], "float64")}
        )
        if queries.empty or members.empty:
            return empty
        points, targets = np.stack(queries["x"].to_numpy()), np.stack(members["member_x"].to_numpy())
        ids, target_ids = queries["id"].to_numpy(), members["member_id"].to_numpy()
        norms = (targets * targets).sum(axis=1)
        found = []
        step = _batch_rows(batch, len(targets))
        for at in range(0, len(ids), step):
            x, own = points[at : at + step], ids[at : at + step]
            size = (x * x).sum(axis=1)
            rough = size[:, None] + norms[None, :] - 2.0 * (x @ targets.T)
            rough[own[:, None] == target_ids[None, :]] = np.inf
            # The product form is inexact: keep all that could be among the k best, then measure those.
            slack = 1e-10 * (1.0 + size + norms.max())
            if rough.shape[1] > k:
                bound = np.partition(rough, k - 1, axis=1)[:, k - 1] + slack
            else:
                bound = np.full(len(own), np.finfo(float).max)
            rows, cols = np.nonzero((rough <= bound[:, None]) & np.isfinite(rough))
            d2 = np.zeros(len(rows))
            for j in range(x.shape[1]):
                gap = x[rows, j] - targets[cols, j]
                d2 += gap * gap
            order = np.lexsort((target_ids[cols], d2, rows))
            rows, cols, d2 = rows[order], cols[order], d2[order]
            place = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left")
            best = place < k
            found.append(
                pd.DataFrame({"id": own[rows[best]], "neighbour_id": target_ids[cols[best]], "d2": d2[best]})
            )
        return pd.concat(found, ignore_index=True)

    return search


def _squared_distances():
    def measure(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        rough = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2.0 * (x @ y.T)
        return np.maximum(rough, 0.0)

    return measure


def _home_kernel(pivots: np.ndarray, batch: int = 1024):
    measure = _squared_distances()
    batch = _batch_rows(batch, len(pivots))

    def home(x: pd.Series) -> pd.DataFrame:
        points = np.stack(x.to_numpy())
        cell, gap = np.zeros(len(points), "int32"), np.zeros(len(points))
        for at in range(0, len(points), batch):
            part = points[at : at + batch]
            best = measure(part, pivots).argmin(axis=1)
            away = part - pivots[best]
            cell[at : at + batch] = best
            gap[at : at + batch] = np.sqrt((away * away).sum(axis=1))
        return pd.DataFrame({"cell": cell, "gap": gap})

    return home


def _visit_kernel(pivots: np.ndarray, radius: np.ndarray, begin: int, end: int | None, batch: int = 256):
    """``id, x, visit``: of the cells but the home cell, nearest first, those from ``begin`` to ``end`` that may hold a row
    within ``reach``; a row without any is left out. A batch of rows is given on before the next is looked at.

    Cells form groups around a few pivots. Rows are taken by the group of their home cell, and cells of groups that are out of
    reach of a batch are not measured; only cells in reach are put in order.
    """
    measure = _squared_distances()
    batch = _batch_rows(batch, len(pivots))
    spread = float(np.sqrt((pivots * pivots).sum(axis=1).max()))
    heads = pivots[: math.ceil(math.sqrt(len(pivots)))]
    group = np.concatenate([measure(pivots[at : at + 1024], heads).argmin(axis=1) for at in range(0, len(pivots), 1024)])
    # how far from its head a group may have a row
    wide = np.full(len(heads), nothing := -1e300)
    np.maximum.at(wide, group, np.where(radius < 0, nothing, np.sqrt(((pivots - heads[group]) ** 2).sum(axis=1)) + radius))

    def apart(h: np.ndarray, row: np.ndarray, place: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Distance of the home pivots of rows to the pivots of cells."""
        if 8 * len(row) > len(h) * len(cells):  # most of them
            return np.sqrt(measure(pivots[h], pivots[cells]))[row, place]
        out = np.empty(len(row))
        for at in range(0, len(row), 1 << 16):
            gap = pivots[h[row[at : at + (1 << 16)]]] - pivots[cells[place[at : at + (1 << 16)]]]
            out[at : at + (1 << 16)] = np.sqrt((gap * gap).sum(axis=1))
        return out

    def visit(tables: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ordered = (t.iloc[np.argsort(group[t["cell"].to_numpy()], kind="stable")] for t in tables)
        for rows in (t.iloc[at : at + batch] for t in ordered for at in range(0, len(t), batch)):
            part, h, r = np.stack(rows["x"].to_numpy()), rows["cell"].to_numpy(), rows["reach"].to_numpy()
            # The distances are rounded: a cell is skipped only when it is out of reach by a margin.
            scale = 1.0 + spread + np.sqrt((part * part).sum(axis=1))
            limit = r + 2e-6 * scale
            met = (np.sqrt(measure(part, heads)) <= limit[:, None] + wide[None, :]).any(axis=0)
            cells = np.flatnonzero(met[group] & (radius >= 0))
            d2 = measure(part, pivots[cells])
            # No row of a cell is nearer than the sphere around the pivot: most cells need no more than this.
            near = d2 <= (limit[:, None] + radius[None, cells]) ** 2
            near &= cells[None, :] != h[:, None]  # the home cell came first
            row, place = np.nonzero(near)
            # Nor nearer than the plane halfway to the pivot.
            away, between = d2[row, place], apart(h, row, place, cells)
            own = part - pivots[h]
            lead = away - (own * own).sum(axis=1)[row] - 1e-9 * scale[row] ** 2
            plane = np.divide(lead, 2.0 * between, out=np.zeros_like(lead), where=between > 0)
            least = np.maximum(np.maximum(np.sqrt(away) - radius[cells[place]], plane), 0.0)
            # In steps far wider than their rounding, so every round has the same order; equal ones by number. A cell in
            # reach comes before all that are not, so only those are put in order.
            step = 1e-7 * scale
            steps = np.rint(least / step[row])
            held = steps <= np.rint((r + 1e-6 * scale) / step)[row]
            row, cell, steps = row[held], cells[place[held]], steps[held]
            order = np.lexsort((steps, row))
            row, cell = row[order], cell[order]
            rank = np.arange(len(row)) - np.searchsorted(row, row, side="left")
            visited = (rank >= begin) & (rank < (len(pivots) if end is None else end))
            row, cell = row[visited], cell[visited].astype("int32")
            if len(row):
                some, first = np.unique(row, return_index=True)
                visits = pd.Series(np.split(cell, first[1:]))
                yield pd.DataFrame({"id": rows["id"].to_numpy()[some], "x": list(part[some]), "visit": visits})

    return visit


def _search(queries: DataFrame, members: DataFrame, sizes: dict[int, tuple[int, int]], k: int, query_chunk: int, member_chunk: int) -> DataFrame:
    """Search each query in its ``cell``; big cells are cut into bounded (query, member) chunks.

    ``sizes`` maps a cell to its number of (queries, members).
    """
    spark = queries.sparkSession
    keys = ["cell", "qc", "mc"]
    plan = [
        (int(c), max(1, math.ceil(q / query_chunk)), max(1, math.ceil(m / member_chunk)))
        for c, (q, m) in sizes.items()
        if q and m
    ]
    # One row per pivot cell at most, and the number of pivots is capped.
    chunks = F.broadcast(spark.createDataFrame(plan, "cell int, nq int, nm int"))
    own = F.pmod(F.xxhash64("id"), F.col("nq").cast("bigint")).cast("int")
    asked = (
        queries.select("id", "x", "cell")
        .join(chunks, "cell")
        .withColumn("qc", own)
        .withColumn("mc", F.explode(F.sequence(F.lit(0), F.col("nm") - 1)))
        .select(*keys, "id", "x")
    )
    part = F.pmod(F.xxhash64("id"), F.col("nm").cast("bigint")).cast("int")
    held = (
        members.select("id", "x", "cell")
        .join(chunks, "cell")
        .withColumn("mc", part)
        .withColumn("qc", F.explode(F.sequence(F.lit(0), F.col("nq") - 1)))
        # New names: both sides may stem from the same table.
        .select(*[F.col(c).alias(c) for c in keys], F.col("id").alias("member_id"), F.col("x").alias("member_x"))
    )
    return asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInPandas(_search_kernel(k), _PAIRS)


def _best(pairs: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("id").orderBy("d2", "neighbour_id")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest_neighbours(
    points: DataFrame,
    k: int = 5,
    cell_rows: int | None = None,
    query_chunk: int = 4096,
    member_chunk: int = 65536,
    seed: int = 42,
    pairs: list[int] | None = None,
) -> DataFrame:
    """``id, rank, neighbour_id, distance`` for ``points`` (``id bigint, x array<double>``).

    A row is never its own neighbour; equal distances are ordered by id. ``cell_rows`` is by default twice the square root
    of the rows, ``CELL_ROWS`` at least. ``pairs`` gets the number of measured pairs of each round.
    """
    total = points.count()
    if total <= k:
        raise ValueError(f"{k} neighbours need at least {k + 1} rows, got {total}")
    # Of identical rows only the k+1 smallest ids can be anyone's neighbour, and only these need a search.
    copies = Window.partitionBy("x").orderBy("id")
    numbered = points.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1)
    members = materialize(numbered, "members")
    held = members.count()
    size = cell_rows or max(CELL_ROWS, math.ceil(2 * math.sqrt(held)))
    result = _ranked(_search_members(members, held, k, size, query_chunk, member_chunk, seed, [] if pairs is None else pairs))
    return result if held == total else result.unionByName(_copies(points, members, k))


def _copies(points: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """Rows beyond the k+1 smallest ids of identical rows: their neighbours are the first k of those."""
    first = members.where(F.col("copy") <= k).groupBy("x").agg(
        F.sort_array(F.collect_list("id")).alias("near")  # k ids
    )
    rest = points.join(members.select("id"), "id", "left_anti")
    # The hot side of this join is split at run time; the other side has one row per key.
    listed = rest.join(first, "x").select("id", F.posexplode("near").alias("pos", "neighbour_id"))
    return listed.select("id", (F.col("pos") + 1).alias("rank"), "neighbour_id", F.lit(0.0).alias("distance"))


def _search_members(
    members: DataFrame,
    held: int,
    k: int,
    cell_rows: int,
    query_chunk: int,
    member_chunk: int,
    seed: int,
    pairs: list[int],
) -> DataFrame:
    pivot_count = math.ceil(held / cell_rows)
    if pivot_count == 1:
        rows = members.select("id", "x", F.lit(0).alias("cell"))
        pairs.append(held * held)
        return _best(_search(rows, rows, {0: (held, held)}, k, query_chunk, member_chunk), k)

    distinct = members.where("copy = 1")
    chosen = distinct.orderBy(hash32(f"{seed}:pivot", F.col("id")), "id").limit(pivot_count).select("x").collect()
    pivots = np.array([row.x for row in chosen])
    home = F.pandas_udf(_home_kernel(pivots), "cell int, gap double")
    placed = members.withColumn("_home", home("x")).select("id", "x", "_home.cell", "_home.gap")
    with stored_while(placed, "cells") as placed:
        return _search_cells(placed, pivots, k, query_chunk, member_chunk, pairs)


def _search_cells(placed: DataFrame, pivots: np.ndarray, k: int, query_chunk: int, member_chunk: int, pairs: list[int]) -> DataFrame:
    """The k best of each row of ``placed`` (id, x, cell, gap); tables of a round are deleted when the next one has its own."""
    spark = placed.sparkSession
    radius = np.full(len(pivots), -1.0)
    inside = {}
    # One row per pivot cell.
    for row in placed.groupBy("cell").agg(F.max("gap").alias("r"), F.count(F.lit(1)).alias("n")).collect():
        radius[row.cell], inside[row.cell] = row.r, row.n
    at_home = {c: (n, n) for c, n in inside.items()}
    pairs.append(sum(n * n for n in inside.values()))
    near = _best(_search(placed, placed, at_home, k, query_chunk, member_chunk), k)
    path = scratch_path(spark, "near")
    near = store(near, path)
    for begin, end in VISITS:
        if begin >= len(pivots) - 1:
            break
        reach = near.groupBy("id").agg(
            F.when(F.count(F.lit(1)) == k, F.sqrt(F.max("d2"))).otherwise(F.lit(math.inf)).alias("reach")
        )
        open_cells = _visit_kernel(pivots, radius, begin, end)
        # A row alone in its cell found nothing yet: no bound.
        bounded = placed.join(reach, "id", "left").fillna({"reach": math.inf})
        visits = bounded.select("id", "x", "cell", "reach").mapInPandas(open_cells, "id bigint, x array<double>, visit array<int>")
        with stored_while(visits, "visits") as stored:
            visits = stored.select("id", "x", F.explode("visit").alias("cell"))
            asked = visits.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()
            pairs.append(sum(r.n * inside[r.cell] for r in asked))
            if asked:
                visited = {r.cell: (r.n, inside[r.cell]) for r in asked}
                more = _search(visits, placed, visited, k, query_chunk, member_chunk)
                before, path = path, scratch_path(spark, "near")
                near = store(_best(near.select("id", "neighbour_id", "d2").unionByName(more), k), path)
                forget(spark, before)
    return near


def _ranked(best: DataFrame) -> DataFrame:
    return best.select("id", "rank", "neighbour_id", F.sqrt("d2").alias("distance"))


def approximate_neighbours(
    points: DataFrame, k: int = 5, tables: int = 12, width: float = 4.0, bits: int = 4, probes: int = 1, seed: int = 42, query_chunk: int = 4096, member_chunk: int = 65536
) -> DataFrame:
    """``id, rank, neighbour_id, distance`` by p-stable hashing: near rows share a bucket of some table with high chance.

    A bucket is ``bits`` projections on normal directions, in steps of ``width`` average standard deviations over the
    square root of the columns; each row is also looked up in the buckets next to its own for its ``probes`` projections
    that lie nearest to a step. Distances are measured, so only neighbours may be missing; ``neighbour_recall`` tells how many.
    Rows are sent for as many tables at once as ``SENT_BYTES`` allows.
    """
    size = len(points.first()["x"])
    spread = points.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.stddev_pop("v").alias("s"))
    scale = float(spread.agg(F.sqrt(F.avg(F.col("s") * F.col("s")))).first()[0] or 1.0)
    rng = np.random.default_rng(seed)
    directions = rng.normal(size=(tables, bits, size))
    step = width * max(scale, 1e-12)
    shifts = rng.uniform(0, step, size=(tables, bits))

    mix = np.random.default_rng(seed + 1).integers(0, 1 << 63, size=(tables, bits + 1), dtype=np.int64) | 1
    each = min(probes, bits) + 1  # buckets of a row in a table, its own first

    def place(x: pd.Series) -> pd.Series:
        at = (np.einsum("tbs,ns->ntb", directions, np.stack(x.to_numpy())) + shifts[None]) / step
        whole = np.floor(at)
        gap = at - whole
        keys = np.empty((len(x), tables, each), dtype=np.int64)
        whole = whole.astype(np.int64)
        keys[:, :, 0] = (whole * mix[None, :, :bits]).sum(axis=2) + mix[None, :, bits]
        # a step in one projection adds or takes its factor
        order = np.argsort(np.minimum(gap, 1 - gap), axis=2, kind="stable")[:, :, :probes]
        for i in range(order.shape[2]):
            b = order[:, :, i]
            moved = np.where(np.take_along_axis(gap, b[:, :, None], axis=2)[:, :, 0] > 0.5, 1, -1)
            keys[:, :, i + 1] = keys[:, :, 0] + moved * np.take_along_axis(mix[None], b[:, :, None], axis=2)[:, :, 0]
        return pd.Series(list(keys.reshape(len(x), -1)))

    spark = points.sparkSession
    placed = points.withColumn("keys", F.pandas_udf(place, "array<bigint>")("x")).select("id", "x", "keys")
    near, path = None, ""
    with stored_while(placed, "hashed") as placed:
        at_once = max(1, min(tables, SENT_BYTES // max(1, placed.count() * (8 * size + 32) * (each + 1))))
        for first in range(0, tables, at_once):
            some = F.slice("keys", first * each + 1, at_once * each)
            found = _met(placed.select("id", "x", some.alias("keys")), k, each, query_chunk, member_chunk)
            if near is not None:
                found = near.select("id", "neighbour_id", "d2").unionByName(found)
            before, path = path, scratch_path(spark, "near")
            near = store(_best(found.distinct(), k), path)
            if before:
                forget(spark, before)
    return _ranked(near)


def _met(placed: DataFrame, k: int, each: int, query_chunk: int, member_chunk: int) -> DataFrame:
    """The pairs of rows (id, x, keys) that share a bucket, the k best of each bucket; a row is held in every ``each``-th."""
    asked = placed.select("id", "x", F.explode("keys").alias("bucket"))
    own = F.filter("keys", lambda _, i: i % each == 0)
    held = placed.select("id", "x", F.explode(own).alias("bucket"))
    sizes = held.groupBy("bucket").agg(F.count(F.lit(1)).alias("m"))
    counts = materialize(asked.groupBy("bucket").agg(F.count(F.lit(1)).alias("q")).join(sizes, "bucket"), "bucket-sizes")
    # big buckets are cut into bounded chunks on both sides, as cells are
    cut = counts.select(
        "bucket", F.ceil(F.col("q") / query_chunk).cast("int").alias("nq"), F.ceil(F.col("m") / member_chunk).cast("int").alias("nm")
    )
    part = lambda n: F.pmod(F.xxhash64("id"), F.col(n).cast("bigint")).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    keys = ["bucket", "qc", "mc"]
    queries = asked.join(cut, "bucket").withColumn("qc", part("nq")).withColumn("mc", every("nm")).select(*keys, "id", "x")
    members = held.join(cut, "bucket").withColumn("mc", part("nm")).withColumn("qc", every("nq"))
    members = members.select(*[F.col(c).alias(c) for c in keys], F.col("id").alias("member_id"), F.col("x").alias("member_x"))
    return queries.groupBy(*keys).cogroup(members.groupBy(*keys)).applyInPandas(_search_kernel(k), _PAIRS)


def neighbour_recall(exact: DataFrame, found: DataFrame) -> DataFrame:
    """(wanted, met, recall): how many of the exact neighbours were found, or others at the same distance."""
    limit = exact.groupBy("id").agg(F.max("distance").alias("most"), F.count(F.lit(1)).alias("wanted"))
    met = found.join(limit, "id").where(F.col("distance") <= F.col("most") * (1 + 1e-12)).groupBy("id").agg(F.count(F.lit(1)).alias("met"))
    both = limit.join(met, "id", "left").agg(
        F.sum("wanted").alias("wanted"), F.sum(F.least(F.coalesce("met", F.lit(0)), F.col("wanted"))).alias("met")
    )
    return both.withColumn("recall", F.col("met") / F.col("wanted"))
