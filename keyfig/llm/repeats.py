"""Removal of byte strings that already are in an earlier document, by suffix arrays.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts in a document with a
smaller id.  Texts stay where they are: documents are written once, compressed, as blocks of a
few MB in the shared folder, and what is shuffled are hashes, candidate strings and verdicts.

1. Anchors.  The least hash of the ``GRAM``-byte strings within a window of ``LENGTH`` bytes
   depends on the window alone, so equal windows have equal anchors.  Blocks send each anchor
   once, as 32 bits to a bucket; buckets tell which anchors more than one document has.
2. Candidates.  Consecutive windows with the same such anchor make a segment.  Each different
   segment of a block goes, with its least document id, to the anchor's shard.  So all windows
   that are equal to one another meet in one shard.
3. Shards.  The different segments of a shard, put together, get a suffix array by induced
   sorting and permuted common prefixes; suffixes with ``LENGTH`` bytes in common are a group,
   whose least id goes back to the blocks.
4. Blocks remove the windows whose group has a smaller id than their document.

A block sends an anchor or a segment once however many of its documents hold it, so a passage in
a third of all documents is as many rows as there are blocks.  Hashes only choose candidates;
segments are compared byte by byte where they are merged.

Defined results: a null text is empty; ids are compared as numbers, a null id is smaller than any
other; equal ids are not smaller than one another, so repeated rows keep what no smaller id has;
each row has its own result.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from keyfig.llm.common import _BYTE, _powers, mix, shuffle_parts, steps, stored, text_bytes
from keyfig.llm.suffixes import permuted_prefixes, suffix_array
from keyfig.session import work_path

LENGTH, GRAM = 50, 20
#: Windows of a segment at most; a longer run of one anchor is several segments.
SEGMENT = 2048
BLOCK_BYTES = 4 << 20
#: Text bytes per bucket of anchors and shard of candidates.
BUCKET_BYTES = 4 << 20
#: Text bytes that a task works on, about.
TASK_BYTES = 16 << 20
_NULL = -2**63

POINTER = "block long, file string, at long, size long"


#: Windows worked on at a time, so that the arrays stay in the processor's cache.
_PART = 1 << 15


def segment_hashes(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each range of bytes."""
    out = np.zeros(len(start), np.uint64)
    up, _ = _powers(int(size.max()) if len(size) else 1)
    for k in range(0, len(start), 1 << 13):
        some = slice(k, k + (1 << 13))
        first = np.cumsum(size[some]) - size[some]
        place = np.arange(size[some].sum()) - np.repeat(first, size[some])
        out[some] = np.add.reduceat(_BYTE[data[place + np.repeat(start[some], size[some])]] * up[place], first)
    return mix(out) ^ size.astype(np.uint64)


def anchored_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, windows, anchor) of the runs of windows with one anchor, none across documents.

    A window's anchor is the least hash of the grams in it.
    """
    last = len(data) - LENGTH + 1
    starts, counts, anchors = [], [], []
    valid = np.ones(len(data), bool)  # where a window starts that ends in the same document
    tail = offsets[1:, None] - np.arange(1, LENGTH)
    valid[np.maximum(tail, offsets[:-1, None])[offsets[1:] > offsets[:-1]]] = False
    up, down = _powers(_PART + LENGTH)
    total = np.zeros(_PART + LENGTH, np.uint64)
    for a in range(0, last, _PART):
        b = min(a + _PART, last)
        v = valid[a:b]
        part = data[a:b + LENGTH - 1]
        n = len(part)
        np.cumsum(_BYTE[part] * up[:n], out=total[1:n + 1])
        m = mix((total[GRAM:n + 1] - total[:n + 1 - GRAM]) * down[:n + 1 - GRAM])
        width = 1
        while 2 * width <= LENGTH - GRAM + 1:  # the least of 2, 4, 8 ... grams
            m = np.minimum(m[:-width], m[width:])
            width *= 2
        if width < LENGTH - GRAM + 1:
            m = np.minimum(m[:-(LENGTH - GRAM + 1 - width)], m[LENGTH - GRAM + 1 - width:])
        new = v.copy()
        new[1:] &= ~v[:-1] | (m[1:] != m[:-1])
        end = v.copy()
        end[:-1] &= ~v[1:] | new[1:]
        first, stop = np.flatnonzero(new), np.flatnonzero(end) + 1
        starts.append(first + a), counts.append(stop - first), anchors.append(m[first])
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    start, count, anchor = map(np.concatenate, (starts, counts, anchors))
    pieces = -(-count // SEGMENT)
    nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    return np.repeat(start, pieces) + nth * SEGMENT, np.minimum(np.repeat(count, pieces) - nth * SEGMENT, SEGMENT), np.repeat(anchor, pieces)


class Block:
    """The segments of a block of documents and the anchors they hang on."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, buckets: int):
        self.data, self.offsets = data, offsets
        self.start, self.windows, anchor = anchored_runs(data, offsets)
        self.doc = np.searchsorted(offsets, self.start, side="right") - 1
        g = mix(anchor ^ np.uint64(0x5851F42D4C957F2D))
        bucket = (g >> np.uint64(32)) % np.uint64(buckets)
        self.anchors, self.anchor_of = np.unique((bucket << np.uint64(32)) | (g & np.uint64(0xFFFFFFFF)), return_inverse=True)

    def several(self) -> np.ndarray:
        """Which anchors more than one of the block's documents have."""
        low = np.full(len(self.anchors), np.iinfo(np.int64).max)
        high = np.full(len(self.anchors), -1)
        np.minimum.at(low, self.anchor_of, self.doc)
        np.maximum.at(high, self.anchor_of, self.doc)
        return low != high

    def candidates(self, shared: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(segments on shared anchors, the different one each is equal to, a place and the least id of each of these)."""
        some = np.flatnonzero(shared[self.anchor_of])
        key = np.empty(len(some), [("anchor", np.int64), ("content", np.uint64)])
        key["anchor"], key["content"] = self.anchor_of[some], segment_hashes(self.data, self.start[some], self.windows[some] + LENGTH - 1)
        order = np.lexsort((some, key["content"], key["anchor"]))
        new = np.ones(len(some), bool)
        new[1:] = key[order[1:]] != key[order[:-1]]
        group = np.cumsum(new) - 1
        # segments of one hash are compared with the first of them
        first = some[order[np.flatnonzero(new)]]
        unlike = ~_equal(self.data, self.start[some[order]], self.start[first[group]], self.windows[some[order]] + LENGTH - 1) if len(some) else new
        if unlike.any():
            raise ArithmeticError("two different segments of a block have one 64-bit hash")
        same = np.empty(len(some), np.int64)
        same[order] = group
        least = np.minimum.reduceat(ids[self.doc[some[order]]], np.flatnonzero(new)) if len(some) else np.zeros(0, np.int64)
        return some, same, first, least


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions of all ranges, one after another."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes - starts, sizes)


def _equal(data: np.ndarray, a: np.ndarray, b: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether ranges of the same size hold the same bytes."""
    out = np.ones(len(a), bool)
    differ = np.flatnonzero(a != b)
    for k in range(0, len(differ), 1 << 14):
        some = differ[k:k + (1 << 14)]
        agree = data[_spread(a[some], sizes[some])] == data[_spread(b[some], sizes[some])]
        out[some] = np.logical_and.reduceat(agree, np.cumsum(sizes[some]) - sizes[some])
    return out


def _write_block(stream, ids: np.ndarray, offsets: np.ndarray, data: np.ndarray) -> int:
    body = np.concatenate([np.array([len(ids)], np.int64), ids, offsets]).tobytes() + data.tobytes()
    packed = pa.Codec("zstd", compression_level=1).compress(body, asbytes=True)
    stream.write(len(body).to_bytes(8, "little") + packed)
    return 8 + len(packed)


def _read_block(file: str, at: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    from pyarrow import fs
    where, path = fs.FileSystem.from_uri(file)
    with where.open_input_file(path) as stream:
        stream.seek(at)
        raw = stream.read(size)
    body = pa.Codec("zstd").decompress(raw[8:], int.from_bytes(raw[:8], "little"))
    n = int(np.frombuffer(body, np.int64, 1)[0])
    numbers = np.frombuffer(body, np.int64, 2 * n + 1, 8)
    return numbers[:n], numbers[n:], np.frombuffer(body, np.uint8, offset=8 * (2 * n + 2))


def _rows(pointer: tuple, buckets: np.ndarray, kind: int, *payloads: list[bytes]) -> pa.RecordBatch:
    n, types = len(buckets), (pa.int64(), pa.string(), pa.int64(), pa.int64())
    columns = [pa.array([p] * n, t) for p, t in zip(pointer, types, strict=True)] + [pa.array([kind] * n, pa.int32()), pa.array(buckets, pa.int32())]
    return pa.RecordBatch.from_arrays(columns + [pa.array(p, pa.binary()) for p in payloads],
                                      names=["block", "file", "at", "size", "kind", "bucket", "a", "b", "c"][:6 + len(payloads)])


def _blocks(docs: DataFrame, folder: str, buckets: int) -> DataFrame:
    """Writes the blocks; rows: per block one with its pointer, and one per bucket of anchors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        task, n, stream, at, file = TaskContext.get().partitionId(), 0, None, 0, ""
        waiting: list[tuple[np.ndarray, pa.Array]] = []
        held = 0

        def done() -> Iterator[pa.RecordBatch]:
            nonlocal n, at
            ids = np.concatenate([w[0] for w in waiting])
            data, offsets = text_bytes(pa.chunked_array([w[1] for w in waiting]))
            size = _write_block(stream, ids, offsets, data)
            pointer = ((task << 32) + n, file, at, size)
            n, at = n + 1, at + size
            yield _rows(pointer, np.array([-1]), 0, [b""], [b""])
            block = Block(data, offsets, buckets)
            several = block.several()
            bucket = (block.anchors >> np.uint64(32)).astype(np.int64)
            keys = (block.anchors & np.uint64(0xFFFFFFFF)).astype("<u4")
            cuts = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
            pairs = list(zip(cuts[:-1], cuts[1:], strict=True))
            if pairs:
                yield _rows(pointer, bucket[cuts[:-1]], 1, [keys[a:b].tobytes() for a, b in pairs], [np.packbits(several[a:b]).tobytes() for a, b in pairs])

        for batch in batches:
            for a, b in steps(batch.column(1), BLOCK_BYTES):
                part = batch.slice(a, b - a)
                if stream is None:
                    where, path = fs.FileSystem.from_uri(folder)
                    where.create_dir(path, recursive=True)
                    name = f"blocks-{uuid.uuid4().hex}"
                    file, stream = f"{folder}/{name}", where.open_output_stream(f"{path}/{name}")
                text = part.column(1).cast(pa.large_string())
                size = text_bytes(text)[1][-1]
                if waiting and held + size > BLOCK_BYTES:
                    yield from done()
                    waiting, held = [], 0
                waiting.append((part.column(0).fill_null(_NULL).to_numpy(zero_copy_only=False), text.fill_null("")))
                held += size
        if waiting:
            yield from done()
        if stream is not None:
            stream.close()

    return docs.mapInArrow(run, f"{POINTER}, kind int, bucket int, a binary, b binary")


def _shared_anchors(table: pa.Table) -> pa.Table:
    """A bucket: per block, which of its anchors another document has as well (kind 1)."""
    keys = [np.frombuffer(x, "<u4") for x in table["a"].to_pylist()]
    flags = np.concatenate([np.unpackbits(np.frombuffer(f, np.uint8), count=len(k)) for k, f in zip(keys, table["b"].to_pylist(), strict=True)])
    every, inverse, count = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    shared = (count > 1) | (np.bincount(inverse, weights=flags, minlength=len(every)) > 0)
    masks, at = [], 0
    for k in keys:
        masks.append(np.packbits(shared[inverse[at:at + len(k)]]).tobytes())
        at += len(k)
    sizes = pa.array([len(k).to_bytes(8, "little") for k in keys], pa.binary())
    return table.select(["block", "file", "at", "size", "kind", "bucket"]).append_column("a", pa.array(masks, pa.binary())).append_column("b", sizes)


def _by_block(table: pa.Table, kind: int) -> list[dict]:
    return sorted((r for r in table.to_pylist() if r["kind"] == kind), key=lambda r: r["bucket"])


def _shared_mask(table: pa.Table) -> np.ndarray:
    parts = [np.unpackbits(np.frombuffer(r["a"], np.uint8), count=int.from_bytes(r["b"], "little")) for r in _by_block(table, 1)]
    return np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)


def _loaded(table: pa.Table, buckets: int):
    pointer = tuple(table[c][0].as_py() for c in ("block", "file", "at", "size"))
    ids, offsets, data = _read_block(*pointer[1:])
    block = Block(data, offsets, buckets)
    return pointer, ids, block, block.candidates(_shared_mask(table), ids)


def _segments(buckets: int) -> Callable[[pa.Table], pa.Table]:
    """A block: its different candidate segments, per shard (kind 2)."""
    def run(table: pa.Table) -> pa.Table:
        pointer, _, block, (_, _, first, least) = _loaded(table, buckets)
        shard = (block.anchors[block.anchor_of[first]] >> np.uint64(32)).astype(np.int64)
        cuts = np.append(np.flatnonzero(np.diff(shard, prepend=-1)), len(shard))
        rows: tuple[list[bytes], ...] = ([], [], [])
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            windows = block.windows[first[a:b]]
            rows[0].append(windows.astype("<u2").tobytes())
            rows[1].append(least[a:b].tobytes())
            rows[2].append(block.data[_spread(block.start[first[a:b]], windows + LENGTH - 1)].tobytes())
        return pa.Table.from_batches([_rows(pointer, shard[cuts[:-1]], 2, *rows)])
    return run


#: A byte that UTF-8 never has; it ends each segment, so that no window equals a string across two.
_END = np.uint8(0xFF)


def least_ids(segments: np.ndarray, windows: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For every window of segments put together, the least id of those that hold an equal one."""
    sizes = windows + LENGTH  # with the end mark
    ends = np.cumsum(sizes)
    text = np.full(ends[-1], _END)
    text[_spread(ends - sizes, sizes - 1)] = segments
    room = np.repeat(ends, sizes) - np.arange(len(text))
    order = suffix_array(text)
    common = permuted_prefixes(text, order, room)
    group = np.cumsum(common[order] < LENGTH)
    valid = room[order] > LENGTH
    at, group = order[valid], group[valid]
    owner = np.repeat(ids, sizes)[at]
    new = np.ones(len(at), bool)
    new[1:] = group[1:] != group[:-1]
    low = np.minimum.reduceat(owner, np.flatnonzero(new))
    out = np.empty(len(text), np.int64)
    out[at] = low[np.cumsum(new) - 1]
    return out[_spread(ends - sizes, windows)]


def _verdicts(table: pa.Table) -> pa.Table:
    """A shard: per block and segment, runs of windows and the least ids that hold them (kind 3)."""
    windows = [np.frombuffer(x, "<u2").astype(np.int64) for x in table["a"].to_pylist()]
    counts = np.array([len(w) for w in windows])
    windows = np.concatenate(windows)
    ids = np.frombuffer(b"".join(table["b"].to_pylist()), np.int64)
    text = np.frombuffer(b"".join(table["c"].to_pylist()), np.uint8)
    sizes = windows + LENGTH - 1
    start = np.cumsum(sizes) - sizes
    # blocks send equal segments: one of them is enough, with the least id
    content = segment_hashes(text, start, sizes)
    _, first, same = np.unique(content, return_index=True, return_inverse=True)
    if (windows != windows[first[same]]).any() or not _equal(text, start, start[first[same]], sizes).all():
        raise ArithmeticError("two different segments of a shard have one 64-bit hash")
    low = np.full(len(first), np.iinfo(np.int64).max)
    np.minimum.at(low, same, ids)
    width = windows[first]
    least = least_ids(text[_spread(start[first], sizes[first])], width, low)
    # runs of windows with one least id, per different segment
    stop = np.cumsum(width)
    new = np.ones(len(least), bool)
    new[1:] = least[1:] != least[:-1]
    new[stop[:-1]] = True
    at = np.flatnonzero(new)
    length, value = np.diff(np.append(at, len(least))), least[at]
    cut = np.searchsorted(at, np.append(stop - width, len(least)))
    runs, lowest = np.diff(cut), np.minimum.reduceat(value, cut[:-1])
    # a block is told of the segments that an id smaller than its own least one holds
    told = np.where(lowest[same] < ids, runs[same], 0)
    a, b, c, k = [], [], [], 0
    for n in counts:
        t, s = told[k:k + n], same[k:k + n]
        pick = _spread(cut[s], t)
        a.append(t.astype("<u2").tobytes()), b.append(length[pick].astype("<u2").tobytes()), c.append(value[pick].tobytes())
        k += n
    out = table.select(["block", "file", "at", "size", "kind", "bucket"]).set_column(4, "kind", pa.array([3] * len(counts), pa.int32()))
    for name, x in (("a", a), ("b", b), ("c", c)):
        out = out.append_column(name, pa.array(x, pa.binary()))
    return out


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _removed(buckets: int, with_kept: bool) -> Callable[[pa.Table], pa.Table]:
    """A block: the result of each of its documents."""
    def run(table: pa.Table) -> pa.Table:
        _, ids, block, (some, same, first, least) = _loaded(table, buckets)
        told = _by_block(table, 3)
        join = lambda c, kind: np.frombuffer(b"".join(r[c] for r in told), kind).astype(np.int64)
        n_runs, length, value = join("a", "<u2"), join("b", "<u2"), join("c", np.int64)
        # segments nobody spoke of: one run, with the block's own least id
        if len(n_runs) != len(first):
            raise ValueError(f"{len(n_runs)} verdicts for {len(first)} segments of a block")
        own = n_runs == 0
        width = np.maximum(n_runs, 1)
        cut = np.cumsum(width) - width
        run_length, run_value = np.zeros(width.sum(), np.int64), np.zeros(width.sum(), np.int64)
        run_length[cut[own]], run_value[cut[own]] = block.windows[first[own]], least[own]
        filled = _spread(cut[~own], n_runs[~own])
        run_length[filled], run_value[filled] = length, value
        # every occurrence of a segment, run by run
        pick = _spread(cut[same], width[same])
        owner = np.repeat(ids[block.doc[some]], width[same])
        size = run_length[pick]
        before = np.cumsum(size) - size
        base = np.repeat(before[np.cumsum(width[same]) - width[same]], width[same]) if len(some) else before
        start = np.repeat(block.start[some], width[same]) + before - base
        gone = run_value[pick] < owner
        change = np.zeros(len(block.data) + 1, np.int64)
        np.add.at(change, start[gone], 1)
        np.add.at(change, start[gone] + size[gone] + LENGTH - 1, -1)
        removed = np.cumsum(change[:-1]) > 0
        offsets = block.offsets
        begins = removed.copy()
        begins[1:] &= ~removed[:-1]
        edge = offsets[:-1][np.diff(offsets) > 0]
        begins[edge] = removed[edge]
        sums = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[offsets])
        n_removed, n_spans, n_bytes = sums(removed), sums(begins), np.diff(offsets)
        kept = block.data[~removed].tobytes()
        cuts = np.concatenate([[0], np.cumsum(n_bytes - n_removed)])
        parts = [kept[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        columns = [pa.array(ids, mask=ids == _NULL), pa.array(n_bytes), pa.array(n_removed), pa.array(n_spans),
                   pa.array([hashlib.sha256(p).hexdigest() for p in parts], pa.string())]
        if with_kept:
            columns.append(pa.array(parts, pa.binary()))
        return pa.table(columns, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][:len(columns)])
    return run


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", with_kept: bool = False) -> DataFrame:
    """Per document: bytes, removed bytes and runs, the digest of what is left (and that itself)."""
    spark = docs.sparkSession
    sent = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    size = sent.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = int(max(2 * shuffle_parts(spark), size // BUCKET_BYTES, 1))
    rows = f"{POINTER}, kind int, bucket int, a binary, b binary"
    anchors = _blocks(sent, work_path(spark, "llm", "blocks"), buckets)
    # a row per block, and which of its anchors are shared: 1 bit of an anchor
    heads = stored(anchors, "anchors")
    shared = stored(heads.where("kind = 1").groupBy("bucket").applyInArrow(_shared_anchors, rows).unionByName(heads.where("kind = 0")), "shared")
    wide = f"{rows}, c binary"
    # rows are small but stand for much work: a stated number of tasks, which AQE leaves alone
    tasks = int(max(shuffle_parts(spark), size // TASK_BYTES))
    segments = shared.repartition(tasks, "block").groupBy("block").applyInArrow(_segments(buckets), wide)
    verdicts = segments.repartition(tasks, "bucket").groupBy("bucket").applyInArrow(_verdicts, wide)
    known = shared.withColumn("c", F.lit(None).cast("binary")).unionByName(verdicts)
    return known.repartition(tasks, "block").groupBy("block").applyInArrow(_removed(buckets, with_kept), RESULT + (", kept binary" if with_kept else ""))


def brute_force(docs: list[tuple[int | None, str | None]], length: int = LENGTH) -> list[tuple]:
    """The result rows by a dictionary of all strings."""
    least: dict[bytes, int] = {}
    data = [(_NULL if i is None else i, (t or "").encode()) for i, t in docs]
    for i, b in data:
        for k in range(len(b) - length + 1):
            s = b[k:k + length]
            least[s] = min(i, least.get(s, i))
    out = []
    for (i, _), (key, b) in zip(docs, data, strict=True):
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if least[b[k:k + length]] < key:
                gone[k:k + length] = b"\x01" * length
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out
