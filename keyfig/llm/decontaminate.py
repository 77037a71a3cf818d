"""Benchmark decontamination by suffix arrays of the training words.

Every shard (a few MB of documents) gets a word-level suffix array of its training text.  Each
suffix of each test item is then binary-searched in it, one word deeper per round, which gives
the interval of all occurrences at the window's depth and the longest verbatim matches with
their locations.  Test items travel to the tasks in blocks of bounded size; the documents are
read once per block and never shuffled, so a passage that a third of all documents hold costs
nothing extra.

A training suffix can only match where the words that follow all occur in the test items, so
runs of fewer such words than the shortest window are left out of the array.

Defined results: a null or wordless text has 0 words and no hit; a null or wordless item has no
window; an item with a null id has none either, unless ``null_ids`` has it searched like any other,
without a place among the item ids;
items that repeat are found each; repeated documents each get their row; extra columns of any name pass through.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from keyfig.llm.common import annotate, text_bytes, word_hashes

#: Bytes of test items that are searched for at a time.
BLOCK_BYTES = 32 << 20

MATCH = "struct<item_id:string,item_start:long,start:long,length:long>"
RESULT = (f"struct<n_words:long,n_hit:long,hits:array<struct<start:long,stop:long>>,"
          f"items:array<string>,matches:array<{MATCH}>>")


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of ``text`` in the order of their first ``depth`` entries (prefix doubling)."""
    n = len(text)
    _, rank = np.unique(text, return_inverse=True)
    order, k = np.argsort(rank, kind="stable"), 1
    while k < depth:
        after = np.zeros(n, np.int64)
        after[:max(0, n - k)] = rank[k:] + 1
        key = rank.astype(np.int64) * (n + 2) + after
        order = np.argsort(key, kind="stable")
        key = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        k *= 2
        if rank[order[-1]] == n - 1:
            break
    return order


def _bound(text: np.ndarray, order: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: int,
           word: np.ndarray, right: bool) -> np.ndarray:
    """Binary search of ``word`` at ``depth`` within the intervals [lo, hi), all at once."""
    lo, hi, last = lo.copy(), hi.copy(), len(text) - 1
    while (open_ := np.flatnonzero(lo < hi)).size:
        mid = (lo[open_] + hi[open_]) >> 1
        there = text[np.minimum(order[mid] + depth, last)]
        less = there <= word[open_] if right else there < word[open_]
        lo[open_[less]] = mid[less] + 1
        hi[open_[~less]] = mid[~less]
    return lo


class TestItems:
    """The test items of a block: words as ids 1..V, windows, and the item of each suffix."""

    def __init__(self, ids: list[str | None], texts: list[str], window: int):
        words, offsets = word_hashes(*text_bytes(pa.array(texts, pa.large_string())))
        self.ids = ids
        self.vocabulary = np.unique(words)
        self.filter = np.zeros(1 << 20, bool)
        self.filter[(self.vocabulary >> np.uint64(44)).astype(np.int64)] = True
        self.words = np.searchsorted(self.vocabulary, words).astype(np.int32) + 1
        lengths = np.diff(offsets)
        self.item = np.repeat(np.arange(len(ids)), lengths)
        self.start = np.arange(len(words)) - np.repeat(offsets[:-1], lengths)
        self.room = np.repeat(offsets[1:], lengths) - np.arange(len(words))
        self.window = np.minimum(window, lengths)[self.item] if len(words) else np.zeros(0, np.int64)
        self.shortest = int(self.window.min()) if len(words) else 0
        self.longest = int(lengths.max()) if len(words) else 0

    def word_ids(self, words: np.ndarray) -> np.ndarray:
        """Ids of document words; 0: not a word of the test items."""
        out = np.zeros(len(words), np.int32)
        if len(self.vocabulary):
            at = np.flatnonzero(self.filter[(words >> np.uint64(44)).astype(np.int64)])
            place = np.searchsorted(self.vocabulary, words[at])
            place[place == len(self.vocabulary)] = 0
            out[at] = np.where(self.vocabulary[place] == words[at], place + 1, 0)
        return out

    def occurrences(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(test suffix, document word) of every occurrence of a window in a shard."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not len(ids) or not len(self.words):
            return none
        # runs of test words within a document, long enough for the shortest window
        known = ids > 0
        first, last = known.copy(), known.copy()
        first[1:] &= ~known[:-1]
        last[:-1] &= ~known[1:]
        edge = np.unique(offsets[(offsets > 0) & (offsets < len(ids))])
        first[edge] = known[edge]
        last[edge - 1] = known[edge - 1]
        a, b = np.flatnonzero(first), np.flatnonzero(last) + 1
        long = b - a >= self.shortest
        a, b = a[long], b[long]
        if not len(a):
            return none
        # the training text: these runs, each ended by a 0
        sizes = b - a + 1
        ends = np.cumsum(sizes)
        place = np.arange(ends[-1]) - np.repeat(ends - sizes - a, sizes)
        text = ids[np.minimum(place, len(ids) - 1)]
        text[ends - 1] = 0
        order = suffix_array(text, self.longest)
        # every test suffix, one word deeper per round, until its window's depth
        suffix = np.flatnonzero(self.room >= self.window)
        lo, hi = np.zeros(len(suffix), np.int64), np.full(len(suffix), len(text))
        done_s, done_lo, done_hi, depth = [], [], [], 0
        while len(suffix):
            word = self.words[suffix + depth]
            lo = _bound(text, order, lo, hi, depth, word, False)
            hi = _bound(text, order, lo, hi, depth, word, True)
            depth += 1
            found = lo < hi
            full = found & (self.window[suffix] == depth)
            done_s.append(suffix[full]), done_lo.append(lo[full]), done_hi.append(hi[full])
            on = found & ~full
            suffix, lo, hi = suffix[on], lo[on], hi[on]
        s, lo, hi = map(np.concatenate, (done_s, done_lo, done_hi))
        n = hi - lo
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - lo, n)
        return np.repeat(s, n), place[order[at]]

    def scan(self, column: pa.Array) -> pa.Array:
        words, offsets = word_hashes(*text_bytes(column))
        suffix, at = self.occurrences(self.word_ids(words), offsets)
        # longest verbatim matches: windows that follow one another in item and document
        item, diagonal = self.item[suffix] if len(suffix) else suffix, at - suffix
        order = np.lexsort((at, diagonal, item))
        item, diagonal, at, suffix = item[order], diagonal[order], at[order], suffix[order]
        doc = np.searchsorted(offsets, at, side="right") - 1
        new = np.ones(len(at), bool)
        new[1:] = (item[1:] != item[:-1]) | (diagonal[1:] != diagonal[:-1]) | (at[1:] != at[:-1] + 1) | (doc[1:] != doc[:-1])
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(at))[:len(head)] - 1
        width = self.window[suffix[tail]]
        by_doc = np.lexsort((item[head], at[head], doc[head]))
        head, stop, doc = head[by_doc], (at[tail] + width)[by_doc], doc[head][by_doc]
        cut = np.searchsorted(doc, np.arange(len(offsets)))
        rows = []
        for r in range(len(offsets) - 1):
            found, hits, names, n_hit = [], [], set(), 0
            for k in range(cut[r], cut[r + 1]):
                h = head[k]
                start, end = int(at[h] - offsets[r]), int(stop[k] - offsets[r])
                name = self.ids[item[h]]
                if name is not None:
                    names.add(name)
                found.append({"item_id": name, "item_start": int(self.start[suffix[h]]), "start": start, "length": end - start})
                if hits and start <= hits[-1]["stop"]:
                    hits[-1]["stop"] = max(hits[-1]["stop"], end)
                else:
                    hits.append({"start": start, "stop": end})
            n_hit = sum(h["stop"] - h["start"] for h in hits)
            rows.append({"n_words": int(offsets[r + 1] - offsets[r]), "n_hit": n_hit, "hits": hits,
                         "items": sorted(names), "matches": found})
        return pa.array(rows, ARROW)


ARROW = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()),
                   ("hits", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                   ("items", pa.list_(pa.string())),
                   ("matches", pa.list_(pa.struct([("item_id", pa.string()), ("item_start", pa.int64()),
                                                   ("start", pa.int64()), ("length", pa.int64())])))])


def find_matches(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
                 item_text: str = "text", window: int = 10, keep: list[str] | None = None,
                 block_bytes: int = BLOCK_BYTES, null_ids: bool = False) -> tuple[DataFrame, str]:
    """``docs`` with a struct column: words, hit words, hit ranges, item ids, longest matches.

    Offsets count words of the document (``start``) and of the item (``item_start``).
    """
    spark = docs.sparkSession
    items = items.select(F.col(f"`{item_id}`").cast("string").alias("i"), F.col(f"`{item_text}`").cast("string").alias("t")).where("t is not null" if null_ids else "i is not null and t is not null")
    total = items.select(F.sum(F.octet_length("t") + F.coalesce(F.octet_length("i"), F.lit(0))).alias("b")).first()["b"] or 0
    blocks = -(-total // block_bytes) or 1
    out, name = docs, ""
    for k in range(blocks):  # one block of bounded size at a time on the driver and in a task
        rows = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == k).collect() if blocks > 1 else items.collect()
        shared = spark.sparkContext.broadcast(TestItems([r["i"] for r in rows], [r["t"] for r in rows], window))
        last = k == blocks - 1
        kept = keep if last and blocks == 1 else None
        before = name
        out, name = annotate(out, lambda b=shared: b.value.scan, RESULT, text, kept, "found")
        if before:
            both = _merged(F.col(f"`{before}`"), F.col(f"`{name}`"))
            out = out.withColumn(name, both).drop(before)
    if keep is not None and blocks > 1:
        out = out.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{name}`"))
    return out, name


def _merged(a, b):
    """Results of two blocks of items for the same document."""
    spans = F.array_sort(F.concat(a["hits"], b["hits"]))
    empty = F.array().cast("array<struct<start:bigint,stop:bigint>>")
    hits = F.aggregate(spans, empty, lambda done, x: F.when(
        (F.size(done) > 0) & (F.element_at(done, -1)["stop"] >= x["start"]),
        F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
            F.element_at(done, -1)["start"].alias("start"),
            F.greatest(F.element_at(done, -1)["stop"], x["stop"]).alias("stop")))),
    ).otherwise(F.concat(done, F.array(x))))
    n_hit = F.aggregate(hits, F.lit(0).cast("bigint"), lambda n, x: n + x["stop"] - x["start"])
    return F.struct(a["n_words"].alias("n_words"), n_hit.alias("n_hit"), hits.alias("hits"),
                    F.array_sort(F.array_union(a["items"], b["items"])).alias("items"),
                    F.concat(a["matches"], b["matches"]).alias("matches"))


def clean(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that hold a window of a test item; columns unchanged."""
    found, name = find_matches(docs, items, text, **options)
    return found.where(F.col(f"`{name}`.n_hit") == 0).drop(name)


def brute_force(docs: list[tuple[int, str | None]], items: list[tuple[object, str | None]], window: int = 10) -> dict:
    """doc_id to (n_words, n_hit, n_items, items_sha256) by comparing lists of words."""
    import re
    lower = {c: c + 32 for c in range(65, 91)}
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(lower))
    windows: dict[tuple, set] = {}
    for item, t in items:
        w = split(t)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            windows.setdefault(tuple(w[k:k + window]), set()).add(str(item))
    sizes, out = sorted({len(w) for w in windows}), {}
    for doc, t in docs:
        w, hit, found = split(t), set(), set()
        for size in sizes:
            for k in range(len(w) - size + 1):
                if (g := tuple(w[k:k + size])) in windows:
                    hit.update(range(k, k + size))
                    found |= windows[g]
        out[doc] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest())
    return out
