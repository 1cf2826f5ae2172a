"""N-gram Jaccard join: a MinHash LSH forest, then exact verification.

A document's shingles are its runs of ``n`` words (the whole text if it has fewer). Documents with the
same words are one class. Each class gets ``trees`` signatures of up to ``deepest`` minimum hashes, its
labels in the trees of a forest. A tree's trie is held as sorted prefixes: the longest prefix length
comes first and is shortened until two sets at the threshold share a prefix in some tree with at least
the target recall. Classes that share a prefix are a node.

In a node, members are compared by the share of equal minimum hashes over all trees: all with one, then those
left over with all the others and so on, so a node of near copies costs one comparison for each. Members
that may reach the threshold are joined to candidate groups, and groups are verified exactly: all pairs of
a group, block against block, by whole sets of shingles. Only counts and a spanning forest of the
verified links leave a task, never pairs.

Null and wordless texts and rows without id link with nothing. Repeated rows and copies are linked with
each other and with all that their class is linked with. An empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .arrays import FOUND, FOUND_SCHEMA, weighted_links
from .common import components, linked, only, pieces, saved, split_groups
from .words import blocks, in_doc_order, mix, span_hashes, word_spans


def prefix_length(threshold: float, trees: int, deepest: int, recall: float) -> int:
    """The longest prefix that still finds pairs at the threshold with the target recall."""
    for depth in range(deepest, 0, -1):
        if 1 - (1 - threshold ** depth) ** trees >= recall:
            return depth
    raise ValueError("too few trees for this recall")


def _multipliers(count: int) -> np.ndarray:
    return np.random.default_rng(77).integers(0, 1 << 62, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(hashes: np.ndarray, before: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of a block's texts, and where each text's start; empty texts have none."""
    words = np.diff(before)
    count = np.where(words >= n, words - n + 1, np.minimum(words, 1))
    heads = np.concatenate(([0], np.cumsum(count)))
    doc = np.repeat(np.arange(len(words)), count)
    at = before[doc] + np.arange(len(doc)) - heads[doc]
    out = np.empty(len(doc), np.uint64)
    runs = in_doc_order(hashes, n)
    long = words[doc] >= n
    out[long] = runs[at[long]]
    for k in np.flatnonzero(~long):  # one for each text shorter than a shingle
        own = hashes[before[doc[k]]: before[doc[k] + 1]]
        out[k] = in_doc_order(own, len(own), seed=100 + len(own))[0]
    return out, heads


def _identity(hashes: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each text's sequence of words."""
    words = np.diff(before)
    full = np.flatnonzero(words)
    place = (np.arange(len(hashes)) - np.repeat(before[:-1], words)).astype(np.uint64)
    out = []
    for seed in (0x51, 0x52):
        total = np.zeros(len(words), np.uint64)
        if len(full):
            total[full] = np.add.reduceat(mix(hashes + mix(place + np.uint64(seed << 32))), before[:-1][full])
        out.append(mix(total + words.astype(np.uint64)).view(np.int64))
    return out[0], out[1]


def _read(batch: pa.RecordBatch, column: str):
    for first, stop, data, offsets in blocks(batch[column]):
        starts, stops, before = word_spans(data, offsets)
        yield first, stop, span_hashes(data, starts, stops), before


def _sign(n: int, hashes: int):
    schema = pa.schema([("doc_id", pa.int64()), ("one", pa.int64()), ("two", pa.int64()), ("sign", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times = _multipliers(hashes)
        for batch in batches:
            for first, stop, h, before in _read(batch, "text"):
                found, heads = shingles(h, before, n)
                full = np.flatnonzero(np.diff(heads))
                least = np.empty((len(full), hashes), np.uint32)
                for k in range(hashes if len(full) else 0):
                    least[:, k] = np.minimum.reduceat(found * times[k], heads[:-1][full]) >> np.uint64(32)
                one, two = _identity(h, before)
                yield pa.record_batch([
                    batch["doc_id"].slice(first, stop - first).take(pa.array(full)),
                    pa.array(one[full]), pa.array(two[full]),
                    pa.array([row.tobytes() for row in least], pa.binary())], schema=schema)

    return run


def _to_nodes(depth: int, trees: int, deepest: int):
    """A class's node in each tree, with a byte of each of its minimum hashes."""
    schema = pa.schema([("key", pa.int64()), ("cid", pa.int64()), ("sign", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sign = np.frombuffer(b"".join(batch["sign"].to_pylist()), np.uint32).reshape(batch.num_rows, -1)
            short = mix(sign.astype(np.uint64)).astype(np.uint8)
            short = pa.array([row.tobytes() for row in short], pa.binary())
            for tree in range(trees):
                key = np.full(len(sign), tree, np.uint64)
                for k in range(depth):
                    key = mix(key + sign[:, tree * deepest + k].astype(np.uint64))
                yield pa.record_batch([pa.array(key.view(np.int64)), batch["cid"], short], schema=schema)

    return run


def _alike(a: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
    """Whether each row of ``b`` shares at least ``least`` equal bytes with some row of ``a``."""
    hit = np.zeros(len(b), bool)
    for k in range(0, len(b), 64):
        some = b[k: k + 64]
        for m in range(0, len(a), 256):
            hit[k: k + 64] |= ((some[:, None] == a[None, m: m + 256]).sum(-1) >= least).any(1)
    return hit


def _candidates(least: float):
    """Edges that join the members of each node that may be similar."""
    def run(table: pa.Table) -> pa.Table:
        key, cid = table["key"].to_numpy(), table["cid"].to_numpy()
        lo, hi = table["lo"].to_numpy(), table["hi"].to_numpy()
        sign = np.frombuffer(b"".join(table["sign"].to_pylist()), np.uint8).reshape(len(key), -1)
        order = np.lexsort((cid, hi, lo, key))
        key, cid, lo, hi, sign = key[order], cid[order], lo[order], hi[order], sign[order]
        new = np.append(True, (key[1:] != key[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1]))
        heads = np.flatnonzero(new)
        count = np.diff(np.append(heads, len(key)))
        goal = least * sign.shape[1]
        twos = heads[count == 2]
        ok = (sign[twos] == sign[twos + 1]).sum(1) >= goal
        left, right = [cid[twos[ok] + 1]], [cid[twos[ok]]]
        for head, n in zip(heads[count > 2], count[count > 2]):
            rest = np.arange(head, head + n)
            while len(rest) > 1:
                near = (sign[rest] == sign[rest[0]]).sum(1) >= goal
                near[0] = True
                own, rest, first = rest[near], rest[~near], rest[0]
                if len(rest) and len(own) > 1:
                    near = rest[_alike(sign[own[1:]], sign[rest], goal)]
                    left.append(cid[near])
                    right.append(np.full(len(near), cid[first]))
                left.append(cid[own[1:]])
                right.append(np.full(len(own) - 1, cid[first]))
        left, right = np.concatenate(left), np.concatenate(right)
        pair = np.unique(np.stack((left, right), 1), axis=0) if len(left) else np.empty((0, 2), np.int64)
        return pa.table({"u": pa.array(pair[:, 0], pa.int64()), "v": pa.array(pair[:, 1], pa.int64())})

    return run


def _sets(n: int):
    """The distinct shingles of each class in a candidate group."""
    schema = pa.schema([("cid", pa.int64()), ("root", pa.int64()), ("size", pa.int64()), ("found", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, stop, h, before in _read(batch, "text"):
                found, heads = shingles(h, before, n)
                one, two = _identity(h, before)
                part = batch.slice(first, stop - first)
                own = np.flatnonzero((one == part["one"].to_numpy()) & (two == part["two"].to_numpy()))
                some = part.take(pa.array(own))
                yield pa.record_batch([some["cid"], some["root"], some["size"], pa.array(
                    [np.unique(found[heads[k]: heads[k + 1]], return_counts=True)[0].tobytes() for k in own],
                    pa.binary())], schema=schema)

    return run


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """The number of common elements of every two sets."""
    n = len(sets)
    both = np.zeros((n, n), np.float32)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    heads = np.flatnonzero(np.append(True, flat[1:] != flat[:-1]))
    times = np.diff(np.append(heads, len(flat)))
    kept = np.repeat(times > 1, times)
    owner, code = owner[kept], np.repeat(np.arange((times > 1).sum()), times[times > 1])
    for k in range(0, int(code[-1]) + 1 if len(code) else 0, 2048):
        a, b = np.searchsorted(code, (k, k + 2048))
        dense = np.zeros((n, 2048), np.float32)
        dense[owner[a:b], code[a:b] - k] = 1
        both += dense @ dense.T
    return both


def _verify(threshold: float):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("root", "ascending"), ("lo", "ascending"), ("hi", "ascending"),
                               ("cid", "ascending")]).combine_chunks()
        root, cid, size = (table[x].to_numpy() for x in ("root", "cid", "size"))
        lo, hi, blk = (table[x].to_numpy() for x in ("lo", "hi", "blk"))
        new = np.append(True, (root[1:] != root[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1]))
        heads = np.append(np.flatnonzero(new), len(root))
        found = table["found"]
        out = [FOUND_SCHEMA.empty_table()]
        for head, stop in zip(heads[:-1], heads[1:]):
            _, once = np.unique(cid[head:stop], return_index=True)  # a class may have come twice
            own = head + once
            sets = [np.frombuffer(found[int(k)].as_buffer(), np.uint64) for k in own]
            both = _overlaps(sets)
            count = np.array([len(s) for s in sets])
            ok = both >= threshold * (count[:, None] + count[None] - both) - 1e-6
            if lo[head] != hi[head]:
                ok &= blk[own][:, None] != blk[own][None]
            i, j = np.nonzero(np.triu(ok, 1))
            if len(i):
                out.append(weighted_links(cid[own], size[own], i, j))
        return pa.concat_tables(out)

    return run


def similar_documents(docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.9999,
                      trees: int = 20, deepest: int = 8, margin: float = 0.22, capacity: int = 4096,
                      group: int = 512, node_rows: int = 200_000, set_rows: int = 1000) -> DataFrame:
    """One row per document: doc_id, class_id, n_links, component_id, kept.

    class_id: smallest id among documents with the same words; n_links: other documents linked directly;
    component_id: smallest id reachable by links. ``margin``: how far below the threshold the
    share of equal minimum hashes may lie for a pair to be verified.
    """
    docs = only(docs, F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    depth = prefix_length(threshold, trees, deepest, recall)
    signed = saved(docs.mapInArrow(
        _sign(n, trees * depth), "doc_id bigint, one bigint, two bigint, sign binary"), "signed")
    classes = saved(
        signed.where("doc_id IS NOT NULL").groupBy("one", "two")
        .agg(F.min("doc_id").alias("class_id"), F.count("*").alias("size"), F.first("sign").alias("sign"))
        .withColumn("cid", F.monotonically_increasing_id()), "jaccard-classes")
    nodes = classes.select("cid", "sign").mapInArrow(
        _to_nodes(depth, trees, depth), "key bigint, cid bigint, sign binary")
    bins = pieces(classes.count() * trees, node_rows)
    edges = (
        split_groups(nodes, ["key"], "cid", capacity)
        .withColumn("bin", F.pmod(F.xxhash64("key", "lo", "hi"), F.lit(bins)).cast("int"))
        .repartitionById(bins, "bin").groupBy("bin").applyInArrow(_candidates(threshold - margin), "u bigint, v bigint")
    )
    roots = saved(components(edges).withColumnRenamed("node", "cid"), "jaccard-groups")
    wanted = classes.drop("sign").join(roots, "cid").select(
        F.col("class_id").alias("_id"), "cid", "root", "size", "one", "two")
    sets = docs.join(wanted, F.col("doc_id") == F.col("_id")).select(
        "text", "cid", "root", "size", "one", "two").mapInArrow(
        _sets(n), "cid bigint, root bigint, size bigint, found binary")
    bins = pieces(roots.count(), set_rows)
    found = saved(
        split_groups(saved(sets, "jaccard-sets"), ["root"], "cid", group)
        .withColumn("bin", F.pmod(F.xxhash64("root", "lo", "hi"), F.lit(bins)).cast("int"))
        .repartitionById(bins, "bin").groupBy("bin").applyInArrow(_verify(threshold), FOUND), "jaccard-links")
    named = signed.select("doc_id", "one", "two").join(
        classes.select("one", "two", "cid", "class_id", "size"), ["one", "two"], "left")
    named = named.where("doc_id IS NOT NULL")
    result = linked(named.select("doc_id", "cid", "class_id", "size"), found, "doc_id").select(
        "doc_id", "class_id", "n_links", "component_id", "kept")
    wordless = F.col("doc_id").isNull() | ~F.coalesce(
        F.col("text").rlike("[^\\x20\\x09-\\x0D]"), F.lit(False))
    alone = docs.where(wordless).select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("bigint").alias("n_links"),
        F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    return result.union(alone)
