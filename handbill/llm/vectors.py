"""Embedding near-duplicates by a subspace pigeonhole join.

Unit vectors at cosine c are at squared distance 2 - 2c. After a rotation the coordinates are cut into blocks;
if two vectors are within the whole budget, then in some block they are within that block's
proportional share (else the shares would add up to more than the budget). So each block is
range-joined on its own under its share, and the union of what is found is verified by the cosine of
the original vectors in double precision. Nothing within the budget is missed.

The range join of a block is a grid over its first coordinates, three radii wide, with as many of them
as the number of vectors asks for. A vector goes to its own cell and, where it is within a radius of
an upper edge, to the next one, so two vectors within the radius share a cell; the cell that holds
the larger coordinates counts the pair, and of the blocks that find it the first one. Cells over
``capacity`` are compared block against block. Tasks give counts and a spanning forest of their
links, never pairs, so a group of many near copies costs comparisons but no rows.

Components keep their type: those of ``array<float>`` are sent as 32 bits, all others as 64. Equal vectors
are one class and are compared once. Vectors that are NULL, zero, or hold NULL or non-finite
components, and rows without id, link with nothing. Vectors of different lengths don't link. Rows
that share an id are vectors of their own; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .arrays import FOUND, FOUND_SCHEMA, weighted_links
from .common import linked, only, saved, split_groups
from .words import mix

CELLS_PER_SIDE = 2.2


@lru_cache(maxsize=8)
def rotation(dims: int) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(20240607).normal(size=(dims, dims)))[0]


def rotated(raw: np.ndarray) -> np.ndarray:
    """Unit vectors, rotated; a row's result does not depend on the rows around it."""
    unit = raw / np.sqrt((raw * raw).sum(1))[:, None]
    turn = rotation(raw.shape[1])
    out = np.empty_like(unit)
    for k in range(0, len(unit), 256):
        out[k: k + 256] = (unit[k: k + 256, None, :] * turn[None]).sum(-1)
    return out


def cut(dims: int, block: int) -> list[slice]:
    return [slice(k, min(k + block, dims)) for k in range(0, dims, block)]


def _grid(z: np.ndarray, own: slice, sides: int, budget: float) -> tuple[np.ndarray, float]:
    """Cells of each vector on the first coordinates of a block, and the radius."""
    radius = math.sqrt(budget * (own.stop - own.start) / z.shape[1]) + 1e-9
    used = z[:, own.start: min(own.start + sides, own.stop)]
    return np.floor(used / (3 * radius) + 0.5).astype(np.int64), radius


def _cell_key(block: int, cell: np.ndarray, dims: int) -> np.ndarray:
    key = np.full(len(cell), mix(np.array([block * 100_003 + dims], np.uint64))[0])
    for k in range(cell.shape[1]):
        key = mix(key + cell[:, k].astype(np.uint64))
    return key.view(np.int64)


def _scaled(raw: np.ndarray) -> np.ndarray:
    """Each vector times a power of two, so that squares stay finite; no digit of a cosine changes."""
    return np.ldexp(raw, -np.frexp(np.abs(raw).max(1, keepdims=True))[1])


def _matrix(column, dims: int, kind: str) -> np.ndarray:
    return _scaled(np.frombuffer(b"".join(column.to_pylist()), kind).astype(np.float64).reshape(-1, dims))


def _to_cells(block: int, sides: int, budget: float, kind: str):
    schema = pa.schema([("key", pa.int64()), ("block", pa.int32()), ("cid", pa.int64()),
                        ("size", pa.int64()), ("vector", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.asarray(batch["vector"].value_lengths())
            for dims in np.unique(lengths):
                part = batch.filter(pa.array(lengths == dims))
                flat = part["vector"].flatten().to_numpy(zero_copy_only=False).astype(kind)
                flat = flat.reshape(-1, int(dims))
                part = part.drop_columns(["vector"]).append_column(
                    "vector", pa.array([x.tobytes() for x in flat], pa.binary()))
                z = rotated(_scaled(flat.astype(np.float64)))
                for b, own in enumerate(cut(int(dims), block)):
                    cell, radius = _grid(z, own, sides, budget)
                    width = 3 * radius
                    used = z[:, own.start: own.start + cell.shape[1]]
                    near = used + radius >= (cell + 0.5) * width - 1e-12
                    for shift in itertools.product((0, 1), repeat=cell.shape[1]):
                        go = np.flatnonzero((near | (np.array(shift) == 0)).all(1))
                        if len(go):
                            some = part.take(pa.array(go))
                            yield pa.record_batch([
                                pa.array(_cell_key(b, cell[go] + np.array(shift, np.int64), int(dims))),
                                pa.array(np.full(len(go), b), pa.int32()),
                                some["cid"], some["size"], some["vector"]], schema=schema)

    return run


def _join_cell(block: int, sides: int, cosine: float, kind: str, tile: int = 1024):
    budget = 2 - 2 * cosine

    def run(table: pa.Table) -> pa.Table:
        dims = len(table["vector"][0].as_buffer()) // np.dtype(kind).itemsize
        raw = _matrix(table["vector"], dims, kind)
        z, norm = rotated(raw), np.sqrt((raw * raw).sum(1))
        b, key = table["block"][0].as_py(), table["key"][0].as_py()
        lo, hi = table["lo"][0].as_py(), table["hi"][0].as_py()
        blk = table["blk"].to_numpy()
        slices = cut(dims, block)
        own = slices[b]
        shares = [budget * (s.stop - s.start) / dims + 1e-9 for s in slices]
        order = np.argsort(z[:, own.stop - 1], kind="stable")
        zb = z[order, own].astype(np.float32)
        last, square, one = z[order, own.stop - 1], (zb * zb).sum(1), np.ones(len(zb), np.float32)
        # squared distances as one product
        rows, columns = np.column_stack((-2 * zb, square, one)), np.column_stack((zb, one, square))
        radius = math.sqrt(shares[b])
        left, right = [], []
        for k in range(0, len(order), tile):
            stop = min(k + tile, len(order))
            far = int(np.searchsorted(last, last[stop - 1] + radius, "right"))
            for m in range(k, far, tile):
                end = min(m + tile, far)
                hit = rows[k: stop] @ columns[m: end].T <= shares[b] + 1e-5
                if m == k:
                    hit = np.triu(hit, 1)
                if not hit.any():
                    continue
                i, j = np.nonzero(hit)
                i, j = i + k, j + m
                i, j = order[i], order[j]
                if lo != hi:
                    ok = blk[i] != blk[j]
                    i, j = i[ok], j[ok]
                for s in range(0, len(i), 1 << 16):
                    x, y = i[s: s + (1 << 16)], j[s: s + (1 << 16)]
                    ok = (raw[x] * raw[y]).sum(1) / (norm[x] * norm[y]) >= cosine
                    x, y = x[ok], y[ok]
                    gap = (z[x] - z[y]) ** 2
                    within = np.stack([gap[:, s].sum(1) <= share for s, share in zip(slices, shares)], 1)
                    ok = within.argmax(1) == b
                    x, y = x[ok], y[ok]
                    cells = np.maximum(_grid(z[x], own, sides, budget)[0], _grid(z[y], own, sides, budget)[0])
                    ok = _cell_key(b, cells, dims) == key
                    left.append(x[ok])
                    right.append(y[ok])
        if not left:
            return FOUND_SCHEMA.empty_table()
        return weighted_links(table["cid"].to_numpy(), table["size"].to_numpy(),
                              np.concatenate(left), np.concatenate(right))

    return run


def near_vectors(vectors: DataFrame, cosine: float = 0.95, block: int = 16, capacity: int = 16384) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    single = vectors.schema["embedding"].dataType.simpleString() == "array<float>"
    kind = "<f4" if single else "<f8"
    rows = only(vectors, "vec_id", F.col("embedding").cast("array<float>" if single else "array<double>").alias("vector"))
    sound = (
        F.col("vec_id").isNotNull() & F.coalesce(F.size("vector") > 0, F.lit(False))
        & F.coalesce(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x)
                              & (F.abs(x) < float("inf"))), F.lit(False))
        & F.coalesce(F.exists("vector", lambda x: x != 0), F.lit(False))
    )
    rows = rows.withColumn("sound", sound).withColumns({
        "one": F.when(F.col("sound"), F.xxhash64("vector")), "two": F.when(F.col("sound"), F.xxhash64(F.lit(1), "vector"))})
    classes = saved(
        rows.where("sound").groupBy("one", "two").agg(F.count("*").alias("size"), F.first("vector").alias("vector"))
        .withColumn("cid", F.monotonically_increasing_id()), "vector-classes")
    sides = max(0, min(block, math.ceil(math.log(max(1, classes.count()) / (2 * capacity)) / math.log(CELLS_PER_SIDE))))
    cells = saved(classes.select("cid", "size", "vector").mapInArrow(
        _to_cells(block, sides, 2 - 2 * cosine, kind),
        "key bigint, block int, cid bigint, size bigint, vector binary"), "vector-cells")
    found = saved(
        split_groups(cells, ["key"], "cid", capacity).groupBy("key", "lo", "hi")
        .applyInArrow(_join_cell(block, sides, cosine, kind), FOUND), "vector-links")
    placed = rows.select("vec_id", "one", "two").join(classes.drop("vector"), ["one", "two"], "left")
    return linked(placed.select("vec_id", "cid", "size"), found, "vec_id").select(
        "vec_id", "n_links", "component_id", "kept")
