"""Token ids of whole texts, and flat binary token files with 64-bit document offsets.

Encoding. A tokenizer's split rule lets a text be cut, without changing a single id, before each
run of white space and between an ASCII letter and the ASCII character that ends the run of
letters. The distinct spans between cuts are gathered by Spark, encoded once each by the
tokenizers library, and kept in the shared folder as arrays sorted by a 64-bit hash. Workers
memory-map them and put ids together by array look-ups; the dictionary has a largest size, and spans beyond it, the
rarest, are encoded where they stand. Spans whose hashes collide are found when
the arrays are built (their bytes are compared there); texts with such a span go to the library.

File format, one set of files per range of ids, in ascending order of range and of id within it:
``part-N.bin`` flat unsigned ids (16 bits if every id fits, else 32), ``part-N.off.npy`` 64-bit
offsets of documents in it (one more than documents), ``part-N.doc.npy`` their ids. Where a part
starts in the whole is the prefix sum of the sizes of earlier parts.

Null texts are empty texts: just the end id. Null document ids come first. Rows with one id are
separate documents, in any order. Texts of any length are processed in blocks of whole texts.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .arrays import from_planes, planes, range_of, store
from .common import only, pieces, shared_folder, text_bytes_of
from .words import IS_BREAK, IS_LETTER, IS_SPACE, blocks, span_hashes

_BREAK = IS_BREAK.copy()
_BREAK[ord("|")] = False  # special tokens are spelt <|name|>; they must not be cut
FLAGGED = np.uint32(0xFFFFFFFF)
COLLIDED, MISSING = -1, -2


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=4)
def keeps_space(path: str) -> bool:
    """Whether white space can become part of a token."""
    return library(path).encode("a \n b", add_special_tokens=False).ids != library(path).encode(
        "a b", add_special_tokens=False).ids


def id_type(path: str) -> np.dtype:
    return np.dtype("<u2" if library(path).get_vocab_size() <= 1 << 16 else "<u4")


def _after_wide_space(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character before each place may be white space outside ASCII."""
    last, second, third = (data[np.maximum(at - k, 0)] for k in (1, 2, 3))
    two = (second == 0xC2) & ((last == 0x85) | (last == 0xA0))
    return two | ((third >= 0xE1) & (third <= 0xE3) & (last >= 0x80) & (last <= 0xAF))


def spans(data: np.ndarray, offsets: np.ndarray, space: bool) -> tuple[np.ndarray, np.ndarray]:
    """Start and stop of each span that can be encoded on its own; with ``space``, all bytes are in one."""
    blank = IS_SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = _BREAK[data[1:]] & IS_LETTER[data[:-1]]
    cut[offsets] = True
    if space:
        at = np.flatnonzero(blank[1:] & ~blank[:-1]) + 1
        cut[at[~_after_wide_space(data, at)]] = True
        edges = np.flatnonzero(cut)
        return edges[:-1], edges[1:]
    start = ~blank
    start[1:] &= blank[:-1] | cut[1:-1]
    stop = ~blank
    stop[:-1] &= blank[1:] | cut[1:-1]
    return np.flatnonzero(start), np.flatnonzero(stop) + 1


def _gather(data: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The spans of ``data`` one after another."""
    heads = np.cumsum(lens) - lens
    where = np.arange(int(lens.sum()), dtype=np.int64)
    where += np.repeat(starts.astype(np.int64) - heads, lens)
    return data[where]


def _first_of_each(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values and where each stands first."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    new = np.ones(len(values), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return ordered[new], order[new]


def _distinct_spans(space: bool, parts: int, flush: int = 1 << 21):
    schema = pa.schema([("part", pa.int32()), ("lens", pa.binary()), ("bytes", pa.binary())])

    def rows(hashes, lens, data):
        order = np.argsort(hashes)
        starts = np.cumsum(lens) - lens
        lens, starts = lens[order], starts[order]
        part = range_of(hashes[order], parts)
        edges = np.searchsorted(part, np.arange(parts + 1))
        used = np.flatnonzero(np.diff(edges))
        return pa.record_batch([
            pa.array(used, pa.int32()),
            pa.array([planes(lens[edges[k]: edges[k + 1]].astype(np.uint32)) for k in used], pa.binary()),
            pa.array([_gather(data, starts[edges[k]: edges[k + 1]], lens[edges[k]: edges[k + 1]])
                      .tobytes() for k in used], pa.binary()),
        ], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, kept = np.empty(0, np.uint64), []
        for batch in batches:
            for _, _, data, offsets in blocks(batch.column(0)):
                starts, stops = spans(data, offsets, space)
                hashes, first = _first_of_each(span_hashes(data, starts, stops))
                at = np.searchsorted(seen, hashes)
                new = np.ones(len(hashes), bool)
                if len(seen):
                    new = seen[np.minimum(at, len(seen) - 1)] != hashes
                hashes, first = hashes[new], first[new]
                lens = (stops - starts)[first]
                kept.append((hashes, lens, _gather(data, starts[first], lens)))
                seen = np.insert(seen, at[new], hashes)
                if len(seen) > flush:
                    yield rows(*map(np.concatenate, zip(*kept)))
                    seen, kept = np.empty(0, np.uint64), []
        if len(seen):
            yield rows(*map(np.concatenate, zip(*kept)))

    return run


def _encode_each(path: str, data: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many ids each span has, and all of them one after another."""
    raw, tool, ids, sizes = data.tobytes(), library(path), [], []
    for k in range(0, len(starts), 2048):
        some = [raw[s: s + n].decode("utf-8") for s, n in zip(starts[k: k + 2048], lens[k: k + 2048])]
        for one in tool.encode_batch_fast(some, add_special_tokens=False):
            own = one.ids
            ids.extend(own)
            sizes.append(len(own))
    return np.array(sizes, np.int64), np.array(ids, id_type(path))


def _encode_spans(path: str, parts: int, files: int, share: int):
    """Ids of the spans of one part that were met by most tasks, up to ``share`` bytes of them."""
    def run(table: pa.Table) -> pa.Table:
        part = table["part"][0].as_py()
        lens = from_planes(table["lens"], np.uint32).astype(np.int64)
        data = np.concatenate([np.frombuffer(x.as_buffer(), np.uint8) for x in table["bytes"]])
        ends = np.cumsum(lens)
        hashes = span_hashes(data, ends - lens, ends)
        order = np.argsort(hashes, kind="stable")
        starts = (np.cumsum(lens) - lens)[order]
        hashes, lens = hashes[order], lens[order]
        again = np.flatnonzero(hashes[1:] == hashes[:-1]) + 1
        differ = lens[again] != lens[again - 1]
        alike = again[~differ]
        unequal = _gather(data, starts[alike], lens[alike]) != _gather(data, starts[alike - 1], lens[alike])
        heads = np.cumsum(lens[alike]) - lens[alike]
        if len(alike):
            differ[~differ] = np.add.reduceat(unequal.astype(np.int64), heads) > 0
        collided = np.isin(hashes, hashes[again[differ]])
        new = np.ones(len(hashes), bool)
        new[again] = False
        met = np.diff(np.append(np.flatnonzero(new), len(hashes)))
        hashes, starts, lens, collided = hashes[new], starts[new], lens[new], collided[new]
        most = np.argsort(-met, kind="stable")
        keep = collided.copy()  # a hash of two spans must be known as one wherever it is met
        keep[most[np.cumsum(lens[most]) <= share]] = True
        hashes, starts, lens, collided = hashes[keep], starts[keep], lens[keep], collided[keep]
        sizes = np.full(len(hashes), FLAGGED)
        sizes[~collided], ids = _encode_each(path, data, starts[~collided], lens[~collided])
        return pa.table({
            "file": pa.array([part * files // parts], pa.int32()), "part": pa.array([part], pa.int32()),
            "hashes": pa.array([planes(hashes)], pa.binary()), "sizes": pa.array([planes(sizes)], pa.binary()),
            "ids": pa.array([ids.tobytes()], pa.binary())})

    return run


def _store_spans(path: str, folder: str):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")  # ranges of hashes, one after another
        file = table["file"][0].as_py()
        hashes, sizes = from_planes(table["hashes"], np.uint64), from_planes(table["sizes"], np.uint32)
        ids = np.concatenate([np.frombuffer(x.as_buffer(), id_type(path)) for x in table["ids"]])
        ends = np.cumsum(np.where(sizes == FLAGGED, 0, sizes), dtype=np.uint64)
        for name, values in (("hash", hashes), ("end", ends), ("size", sizes), ("ids", ids)):
            store(folder, f"{file}.{name}", values)
        return pa.table({"file": pa.array([file], pa.int32()), "n": pa.array([len(hashes)], pa.int64())})

    return run


class Encoder:
    """Ids of texts by look-up in a dictionary of spans; sent to workers by its folder's name.

    Spans are gathered in parts that grow in number with the text, but the dictionary has at most ``files``
    files of about ``file_bytes`` of spans, so a block of text opens no more of them however large the input is.
    Where distinct spans are more than that, those that fewest tasks met stay out, and blocks that
    hold them give them to the library.
    """

    def __init__(self, path: str, folder: str, parts: int, files: int):
        self.path, self.folder, self.parts, self.files = path, folder, parts, files

    @staticmethod
    def of(texts: DataFrame, path: str, part_bytes: int = 32 << 20, files: int = 64,
           file_bytes: int = 32 << 20) -> "Encoder":
        """Encode the distinct spans of ``texts`` (one column, text) into a new dictionary."""
        parts = pieces(text_bytes_of(texts), part_bytes)
        share = files * file_bytes // parts
        files = min(files, parts)
        folder = shared_folder(texts.sparkSession, "spans")
        found = texts.select("text").mapInArrow(
            _distinct_spans(keeps_space(path), parts),
            "part int, lens binary, bytes binary")
        encoded = found.groupBy("part").applyInArrow(
            _encode_spans(path, parts, files, share),
            "file int, part int, hashes binary, sizes binary, ids binary")
        encoded.groupBy("file").applyInArrow(_store_spans(path, folder), "file int, n bigint") \
            .agg(F.sum("n")).collect()
        return Encoder(path, folder, parts, files)

    def _mapped(self, file: int):
        return _open_part(self.folder, file)

    def _look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct hashes: sizes (or ``COLLIDED``, ``MISSING``), and their ids one after another."""
        file_of = range_of(hashes, self.parts) * self.files // self.parts
        edges = np.searchsorted(file_of, np.arange(self.files + 1))
        sizes, ids = np.full(len(hashes), MISSING), [np.empty(0, id_type(self.path))]
        for file in np.flatnonzero(np.diff(edges)):
            names, ends, held, values = self._mapped(int(file))
            if not len(names):
                continue
            own = hashes[edges[file]: edges[file + 1]]
            at = np.minimum(np.searchsorted(names, own), len(names) - 1)
            known = names[at] == own
            size = np.where(held[at] == FLAGGED, COLLIDED, held[at].astype(np.int64))
            sizes[edges[file]: edges[file + 1]] = np.where(known, size, MISSING)
            here = known & (size >= 0)
            ids.append(_gather(values, ends[at[here]].astype(np.int64) - size[here], size[here]))
        return sizes, np.concatenate(ids)

    def encode(self, data: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets of texts in them) of a block of texts, each followed by ``end``."""
        n = len(offsets) - 1
        starts, stops = spans(data, offsets, keeps_space(self.path)) if len(data) else (offsets[:0],) * 2
        hashes = span_hashes(data, starts, stops)
        order = np.argsort(hashes)
        new = np.ones(len(hashes), bool)
        new[1:] = hashes[order][1:] != hashes[order][:-1]
        first = order[new]
        sizes, ids = self._look_up(hashes[first])
        if (sizes == COLLIDED).any():
            return self._by_library(data, offsets, end)
        known = np.maximum(sizes, 0)
        heads = np.cumsum(known) - known
        missing = np.flatnonzero(sizes == MISSING)
        if len(missing):
            at = first[missing]
            size, more = _encode_each(self.path, data, starts[at], stops[at] - starts[at])
            sizes[missing], heads[missing] = size, len(ids) + np.cumsum(size) - size
            ids = np.concatenate((ids, more))
        which = np.empty(len(hashes), np.int64)
        which[order] = np.cumsum(new) - 1
        total = np.concatenate(([0], np.cumsum(sizes[which])))
        text_at = total[np.searchsorted(starts, offsets)] + np.arange(n + 1)
        out = np.empty(int(text_at[-1]), id_type(self.path))
        own = np.ones(len(out), bool)
        own[text_at[1:] - 1] = False
        out[own] = _gather(ids, heads[which], sizes[which])
        out[~own] = end
        return out, text_at

    def _by_library(self, data, offsets, end):
        raw, tool = data.tobytes(), library(self.path)
        ids = [tool.encode(raw[a:b].decode("utf-8"), add_special_tokens=False).ids + [end]
               for a, b in zip(offsets[:-1], offsets[1:])]
        at = np.concatenate(([0], np.cumsum([len(x) for x in ids])))
        return np.array([y for x in ids for y in x], id_type(self.path)), at


@lru_cache(maxsize=256)
def _open_part(folder: str, file: int):
    return tuple(np.load(f"{folder}/{file}.{name}.npy", mmap_mode="r")
                 for name in ("hash", "end", "size", "ids"))


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4"))


def _write_part(encoder: Encoder, folder: str, end: int):
    schema = pa.schema([("part", pa.int64()), ("docs", pa.int64()), ("tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        stem, own = f"{folder}/part-{task.partitionId()}", f".{task.taskAttemptId()}"
        at, names, sizes = 0, [], []
        with open(f"{stem}.bin{own}", "wb") as out:
            for batch in batches:
                names.append(batch.column(0))
                for _, _, data, offsets in blocks(batch.column(1)):
                    ids, text_at = encoder.encode(data, offsets, end)
                    ids.tofile(out)
                    sizes.append(np.diff(text_at))
                    at += len(ids)
        sizes = np.concatenate(sizes) if sizes else np.empty(0, np.int64)
        names = pa.chunked_array(names, pa.int64()).combine_chunks() if names else pa.array([], pa.int64())
        known = names.fill_null(0).to_numpy(zero_copy_only=False)
        files = {"off": np.concatenate(([0], np.cumsum(sizes))).astype(np.int64), "doc": known}
        if names.null_count:
            files["null"] = names.is_null().to_numpy(zero_copy_only=False)
        for name, values in files.items():
            with open(f"{stem}.{name}.npy{own}", "wb") as out:
                np.save(out, values)
            os.replace(f"{stem}.{name}.npy{own}", f"{stem}.{name}.npy")
        os.replace(f"{stem}.bin{own}", f"{stem}.bin")
        yield pa.record_batch([[task.partitionId()], [len(sizes)], [at]], schema=schema)

    return run


class TokenFiles:
    """A written set of token files: folder, type of id, where each part starts."""

    def __init__(self, folder: str, kind: np.dtype, bases: list[int]):
        self.folder, self.kind, self.bases = folder, kind, bases

    def part(self, number: int):
        """(ids, offsets, document ids, which are null or None) of a part, memory-mapped."""
        stem = f"{self.folder}/part-{number}"
        size = os.path.getsize(f"{stem}.bin")
        ids = np.memmap(f"{stem}.bin", self.kind, "r") if size else np.empty(0, self.kind)
        null = f"{stem}.null.npy"
        return (ids, *(np.load(f"{stem}.{x}.npy", mmap_mode="r") for x in ("off", "doc")),
                np.load(null) if os.path.exists(null) else None)

    def read(self, spark: SparkSession) -> DataFrame:
        """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                            ("ids_crc32", pa.int64())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for number in batch.column(0).to_pylist():
                    ids, offsets, names, null = self.part(number)
                    for k in range(0, len(names), 10_000):
                        at = np.asarray(offsets[k: k + 10_001])
                        yield pa.record_batch([
                            pa.array(names[k: k + 10_000], pa.int64(),
                                     mask=None if null is None else null[k: k + 10_000]),
                            pa.array(at[:-1] + self.bases[number]), pa.array(np.diff(at)),
                            pa.array([_crc(ids[a:b]) for a, b in zip(at[:-1], at[1:])], pa.int64()),
                        ], schema=schema)

        n = len(self.bases)
        return spark.range(0, n, 1, n).mapInArrow(
            run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def write_token_files(docs: DataFrame, path: str, end: int = 2, part_bytes: int = 32 << 20) -> TokenFiles:
    """Encode every text and write the token files of ``docs`` in ascending order of doc_id."""
    spark = docs.sparkSession
    docs = only(docs, F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    encoder = Encoder.of(docs, path)
    parts = pieces(text_bytes_of(docs), part_bytes)
    folder = shared_folder(spark, "tokens")
    written = (
        docs.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id")
        .mapInArrow(_write_part(encoder, folder, end), "part bigint, docs bigint, tokens bigint")
        .collect()  # one row per file
    )
    sizes = dict((r.part, r.tokens) for r in written)
    bases = [0]
    for number in range(max(sizes, default=-1)):
        bases.append(bases[-1] + sizes.get(number, 0))
    return TokenFiles(folder, id_type(path), bases if sizes else [])
