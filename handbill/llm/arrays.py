"""Sorted arrays kept as files in the shared folder, and their binary columns on the way there."""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext


def store(folder: str, name: str, values: np.ndarray) -> None:
    """Write an array; a task that runs again replaces what its first attempt wrote."""
    final = f"{folder}/{name}.npy"
    own = f"{final}.{TaskContext.get().taskAttemptId()}"
    with open(own, "wb") as out:
        np.save(out, values)
    os.replace(own, final)


@lru_cache(maxsize=4096)
def mapped(folder: str, name: str) -> np.ndarray:
    return np.load(f"{folder}/{name}.npy", mmap_mode="r")


def planes(values: np.ndarray) -> bytes:
    """Bytes of sorted numbers, all first bytes, then all second ones: the high ones compress."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes()


def from_planes(columns, kind) -> np.ndarray:
    """The numbers of all binary values of a column that ``planes`` made."""
    size = np.dtype(kind).itemsize
    found = [np.ascontiguousarray(np.frombuffer(x.as_buffer(), np.uint8).reshape(size, -1).T)
             .reshape(-1).view(kind) for x in columns]
    return np.concatenate(found) if found else np.empty(0, kind)


def range_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """The part, of ``parts`` equal ranges of 64-bit values, that each value lies in."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, and for each the sums of values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    heads = np.flatnonzero(new)
    if not len(keys):
        return (keys, *values)
    return (keys[heads], *(np.add.reduceat(v[order], heads) for v in values))


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and how often each occurs."""
    keys = np.sort(keys)
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    heads = np.flatnonzero(new)
    return keys[heads], np.diff(np.append(heads, len(keys)))


def by_part(part: np.ndarray, parts: int, columns: list[np.ndarray], schema: pa.Schema) -> pa.RecordBatch:
    """A row for each part used: its number, then its share of each column, which ``part`` orders."""
    edges = np.searchsorted(part, np.arange(parts + 1))
    used = np.flatnonzero(np.diff(edges))
    return pa.record_batch([
        pa.array(used, schema.field(0).type),
        *(pa.array([planes(x[edges[k]: edges[k + 1]]) for k in used], pa.binary()) for x in columns),
    ], schema=schema)


def labels(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest number connected with each of ``n`` by links (i, j)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def weighted_links(cid: np.ndarray, size: np.ndarray, i: np.ndarray, j: np.ndarray) -> pa.Table:
    """(cid, other, links): sums of linked sizes, and for each linked row an edge to its first one."""
    n = len(cid)
    links = np.zeros(n, np.int64)
    np.add.at(links, i, size[j])
    np.add.at(links, j, size[i])
    own = np.flatnonzero(links)
    label = labels(n, i, j)
    edge = np.flatnonzero(label != np.arange(n))
    return pa.table({
        "cid": pa.array(np.concatenate((cid[own], cid[edge])), pa.int64()),
        "other": pa.array(np.concatenate((np.zeros(len(own), np.int64), cid[label[edge]])), pa.int64(),
                          mask=np.concatenate((np.ones(len(own), bool), np.zeros(len(edge), bool)))),
        "links": pa.array(np.concatenate((links[own], np.zeros(len(edge), np.int64))), pa.int64()),
    })


FOUND = "cid bigint, other bigint, links bigint"
FOUND_SCHEMA = pa.schema([(x, pa.int64()) for x in ("cid", "other", "links")])
