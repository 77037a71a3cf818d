"""Best-fit packing of token sequences by a configuration linear program.

Documents become token ids and are cut into pieces of at most ``CAPACITY``.  The pieces' length
histogram (at most ``CAPACITY`` rows, whatever the corpus) goes to the driver, which solves the
fractional program "cover every length's count by configurations, as few as possible": weights
per length grow where coverage lags (multiplicative weights), and a bounded knapsack, each length
as often as it fits, prices the next configuration.  More than ``CLASSES`` lengths are put in classes,
each as long as its longest piece, so that configurations of rare lengths have whole copies too.
Scaled below the counts and rounded, the program's solution places pieces; it is solved anew for what
is left, and the last remainder goes best-fit, in descending length and by groups of equal bins, into
the rooms that are left and into new sequences.  The program is solved whatever the histogram.

Placing is arithmetic: the r-th piece of a length finds its interval in a table of (length, first
rank, copies, first sequence, offset).  Ranks are taken within (length, salt), so that a length
which a third of all pieces share is numbered by many tasks.

Defined results: a null or empty text is one piece of the end id alone; repeated rows are packed
each; an empty table gives no piece.  Tokenising needs words, not texts, to be encoded: white
space never is part of a token, so each distinct word is encoded once a task and the ids are
joined.
"""

from __future__ import annotations

import json
import os
import re
import sys
import zlib
from array import array
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from keyfig.llm.common import stored

CAPACITY, END_ID = 4096, 1
TOKENIZER = "word_bpe_49k.json"
#: Distinct words whose ids a task keeps at a time.
CACHE_WORDS = 600_000
#: Classes of lengths that the program tells apart, its pricing steps a round, and rounds.
CLASSES, STEPS, ROUNDS = 96, 500, 3
#: The share of all tokens whose pieces, the shortest, are kept for the rooms that the program leaves.
SPARED = 1 / 32
#: How fast a length's weight falls as it is covered.
RATE = 8.0
#: Pieces of one (length, salt) group aimed at.
GROUP = 50_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


#: How the tokenizer's file normalises and cuts a text.
_NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
#: Latin letters (of one code point, each with one lower-case form), then ASCII signs.
_PARTED = re.compile(r"([A-Za-z\u00C0-\u00D6\u00D8-\u00DE\u00E0-\u00F6\u00F8-\u00FE]+)([!-/:-@\[-`{-~]*)")
#: The character that stands for a byte: itself if it can be printed, else the next one from 256 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SHOWN = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in _PRINTED)}


def encoder(path: str) -> Callable[[list[str]], list[bytes]]:
    """A function from texts to their ids as little-endian 32-bit numbers, without the end id."""
    if sys.byteorder != "little" or array("I").itemsize != 4:
        raise NotImplementedError("ids are written as little-endian 32-bit numbers")
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    settings = json.loads(tokenizer.to_str())
    # where words are lowered and cut as stated above, lower-case words go to the model at once
    parted = _PARTED.fullmatch if (settings["normalizer"], settings["pre_tokenizer"]) == (_NORMALIZER, _PRE_TOKENIZER) else None
    model = tokenizer.model

    def word(letters: str) -> bytes:
        shown = letters if letters.isascii() else letters.encode().decode("latin-1").translate(_SHOWN)
        return array("I", [t.id for t in model.tokenize(shown)]).tobytes()

    core: dict[str, bytes] = {"": b""}  # the first words met, mostly the frequent ones, stay
    more: dict[str, bytes] = {}

    def encode(texts: list[str]) -> list[bytes]:
        # A-Z may be lowered here, unless that could make up the name of a special token
        texts = [t.lower() if t.isascii() and "<|" not in t else t for t in texts]
        # only blanks and line ends are cut at; any other white space is left to the tokenizer
        split = [t.replace("\n", " ").split(" ") for t in texts]
        if len(more) > CACHE_WORDS // 3:
            more.clear()
        new = list(set().union(*split).difference(core, more))
        into = core if len(core) < CACHE_WORDS else more
        plain = []
        for w in new:
            m = parted(w) if parted else None
            if m:  # letters, then signs: two pieces to the tokenizer, whatever surrounds them
                letters, signs = m[1].lower(), m[2]
                ids = into.get(letters) or core.get(letters)
                if ids is None:
                    into[letters] = ids = word(letters)
                if signs and signs not in core:
                    core[signs] = array("I", tokenizer.encode(signs, add_special_tokens=False).ids).tobytes()
                into[w] = ids + core[signs]
            else:
                plain.append(w)
        for a in range(0, len(plain), 5_000):
            part = plain[a:a + 5_000]
            for w, e in zip(part, tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                into[w] = array("I", e.ids).tobytes()
        if not more:
            return [b"".join(map(core.__getitem__, words)) for words in split]
        return [b"".join([core.get(w) or more.get(w, b"") for w in words]) for words in split]

    return encode


def tokenized(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
              capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: place in its document, length, checksum, and the ids if asked for."""
    schema = PIECES + (", ids binary" if with_ids else "")
    names = [x.split()[0] for x in schema.split(", ")]
    sent = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    end, width = int(end_id).to_bytes(4, "little"), 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                rows: list[tuple] = []
                for doc, ids in zip(part.column(0).to_pylist(), encode([t or "" for t in part.column(1).to_pylist()]), strict=True):
                    ids += end
                    for n, at in enumerate(range(0, len(ids), width)):
                        piece = ids[at:at + width]
                        rows.append((doc, n, at // 4, len(piece) // 4, zlib.crc32(piece), piece)[:len(names)])
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=False)], names=names)

    return sent.mapInArrow(run, schema)


class Configuration(NamedTuple):
    copies: int
    content: tuple[tuple[int, int], ...]  # (length, how many of it)


def _price(lengths: np.ndarray, values: np.ndarray, counts: np.ndarray, capacity: int) -> np.ndarray:
    """Lengths to take, each as often as it fits and is there, of greatest value within the capacity.

    A bounded knapsack: numbers of pieces are made up of 1, 2, 4, ... pieces and a rest.
    """
    lots = []
    for i, (n, c) in enumerate(zip(lengths.tolist(), counts.tolist(), strict=True)):
        most, k = min(capacity // n, max(1, int(c))), 1
        while most:
            k = min(k, most)
            lots.append((i, k))
            most -= k
            k *= 2
    best = np.zeros(capacity + 1)
    taken = np.zeros((len(lots), capacity + 1), bool)
    for row, (i, k) in enumerate(lots):
        n = k * int(lengths[i])
        with_it = best[:-n] + k * values[i]
        better = with_it > best[n:]
        taken[row, n:] = better
        np.copyto(best[n:], with_it, where=better)
    out, room = [], capacity
    for row in range(len(lots) - 1, -1, -1):
        if taken[row, room]:
            i, k = lots[row]
            out += [i] * k
            room -= k * int(lengths[i])
    return np.array(sorted(out))


def fractional(lengths: np.ndarray, counts: np.ndarray, capacity: int, steps: int = STEPS) -> list[tuple[float, np.ndarray]]:
    """Copies and (indices of) lengths of configurations that cover the counts evenly, at most whole.

    An index is there as often as the configuration holds its length.
    """
    covered, found = np.zeros(len(lengths)), {}
    for _ in range(steps):
        # a length's weight: its tokens, falling as its count is covered
        value = lengths * np.exp(-RATE * (covered - covered.min()))
        chosen = _price(lengths, value, counts, capacity)
        kinds, n = np.unique(chosen, return_counts=True)
        step = (counts[kinds] / n).min() / 16
        key = chosen.tobytes()
        copies, _ = found.get(key, (0.0, chosen))
        found[key] = (copies + step, chosen)
        covered[kinds] += step * n / counts[kinds]
        if covered.min() >= 1:
            break
    most = max(1e-12, covered.max())
    return [(copies / most, chosen) for copies, chosen in found.values()]


def best_fit(left: dict[int, int], capacity: int, begun: Sequence[Configuration] = ()) -> list[Configuration]:
    """Best fit in descending length, into the rooms of bins begun and new ones.

    Equal bins are one group, so work follows distinct lengths.
    """
    open_: dict[int, list[tuple[int, dict[int, int]]]] = {}
    done: list[tuple[int, dict[int, int]]] = []

    def put(copies: int, content: dict[int, int]) -> None:
        room = capacity - sum(n * k for n, k in content.items())
        (open_.setdefault(room, []) if room else done).append((copies, content))

    for c in begun:
        put(c.copies, dict(c.content))
    for length in sorted(left, reverse=True):
        n = left[length]
        while n:
            room = min((r for r in open_ if r >= length), default=None)
            if room is None:
                per = capacity // length
                if n >= per:
                    put(n // per, {length: per})
                if n % per:
                    put(1, {length: n % per})
                break
            groups = open_[room]
            copies, content = groups.pop()
            if not groups:
                del open_[room]
            per = room // length
            if n < per:
                if copies > 1:
                    put(copies - 1, content)
                put(1, content | {length: content.get(length, 0) + n})
                n = 0
            else:
                filled = min(copies, n // per)
                if copies > filled:
                    put(copies - filled, content)
                put(filled, content | {length: content.get(length, 0) + per})
                n -= filled * per
    return [Configuration(c, tuple(sorted(x.items(), reverse=True))) for c, x in [*done, *(g for gs in open_.values() for g in gs)]]


def solve(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Configuration]:
    """Configurations that hold exactly the histogram's pieces, in as few bins as found."""
    left, out = {k: n for k, n in histogram.items() if n}, []
    if full := left.pop(capacity, 0):
        out.append(Configuration(full, ((capacity, 1),)))
    least = -(-sum(k * n for k, n in left.items()) // capacity)
    bins = lambda c: sum(x.copies for x in c)
    found: list[list[Configuration]] = []
    # the program's full bins alone, or its solution as it is; best fit takes what these leave
    for fullest, spared in ((0.999, SPARED), (0.0, SPARED), (0.0, 0.0)):
        if not found or min(map(bins, found)) > least:
            placed, rest = _rounded(dict(left), capacity, fullest * capacity, spared)
            found.append(best_fit(rest, capacity, placed))
    return out + min(found, key=bins)


def classes(counts: np.ndarray, most: int = CLASSES) -> np.ndarray:
    """The class of each of ascending lengths: about as many pieces each, a frequent length alone."""
    if len(counts) <= most:
        return np.arange(len(counts))
    weight = counts.astype(np.float64)
    for _ in range(8):
        weight = np.minimum(counts, weight.sum() / most)
    part = np.floor((np.cumsum(weight) - weight / 2) / weight.sum() * most)
    alone = counts >= weight.sum() / most
    return np.concatenate([[0], np.cumsum((np.diff(part) > 0) | alone[1:] | alone[:-1])])


def _rounded(left: dict[int, int], capacity: int, full: float, spared: float) -> tuple[list[Configuration], dict[int, int]]:
    """The program's solution in whole bins, again for what is left; and the remainder.

    The program knows a class by its longest length, so any piece of a class fits where it says.  A
    bin's last place, the shortest, takes the longest piece that fits.  Copies are rounded as a
    running total.  Bins of fewer than ``full`` tokens, and the shortest pieces, with the share
    ``spared`` of all tokens, are left to best fit.
    """
    out: list[Configuration] = []
    tokens = np.cumsum([k * left[k] for k in sorted(left)])
    short = dict(sorted(left.items())[:int((tokens <= spared * tokens[-1]).sum())]) if left else {}
    left = {k: n for k, n in left.items() if k not in short}
    for _ in range(ROUNDS):
        lengths = sorted(left)
        counts = [left[k] for k in lengths]
        if not lengths:
            break
        of = classes(np.array(counts, np.int64)).tolist()
        first = [of.index(g) for g in range(of[-1] + 1)]
        longest = [*(a - 1 for a in first[1:]), len(of) - 1]
        there = [sum(counts[a:b + 1]) for a, b in zip(first, longest, strict=True)]
        ranked = np.array([lengths[k] for k in longest], np.int64)
        program = fractional(ranked, np.array(there, np.float64), capacity)
        total, placed = 0.0, 0
        for copies, chosen in sorted(program, key=lambda x: (-ranked[x[1]].sum(), -x[0])):
            total += copies
            need = Counter(chosen.tolist())
            while placed < int(total + 1e-6) and all(there[g] >= n for g, n in need.items()):
                content = _content(need, lengths, counts, longest, capacity)
                if sum(lengths[at] * n for at, n in content.items()) < full:
                    break
                equal = min(int(total + 1e-6) - placed, *(counts[at] // n for at, n in content.items()))
                for at, n in content.items():
                    counts[at] -= n * equal
                    there[of[at]] -= n * equal
                    while longest[of[at]] > first[of[at]] and not counts[longest[of[at]]]:
                        longest[of[at]] -= 1
                out.append(Configuration(equal, tuple(sorted(((lengths[at], n) for at, n in content.items()), reverse=True))))
                placed += equal
        left = {k: n for k, n in zip(lengths, counts, strict=True) if n}
        if not placed:
            break
    return out, left | short


def _content(need: Counter[int], lengths: list[int], counts: list[int], longest: list[int], capacity: int) -> Counter[int]:
    """Places of lengths, with how many of each, for a bin with so many pieces of each class."""
    content: Counter[int] = Counter()
    room, last = capacity, min(need)
    for g, n in sorted(need.items(), reverse=True):
        at, wanted = longest[g], n - (g == last)
        while wanted:
            if some := min(wanted, counts[at]):
                content[at] += some
                room -= some * lengths[at]
                wanted -= some
            at -= 1
    at = bisect_right(lengths, room) - 1
    while counts[at] <= content[at]:
        at -= 1
    content[at] += 1
    return content


class Places:
    """Which sequence and offset the r-th piece of a length has."""

    def __init__(self, plan: list[Configuration]):
        rows, sequence, used = [], 0, {}
        for copies, content in plan:
            offset = 0
            for length, n in content:
                first = used.get(length, 0)
                rows.append((length, first, n, sequence, offset))
                used[length] = first + n * copies
                offset += length * n
            sequence += copies
        self.sequences = sequence
        length, first, self.per, self.sequence, self.offset = (np.array(c, np.int64) for c in zip(*sorted(rows), strict=True)) if rows else np.zeros((5, 0), np.int64)
        self.first, self.key = first, length * _RANKS + first

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, length * _RANKS + rank, side="right") - 1
        r = rank - self.first[at]
        return self.sequence[at] + r // self.per[at], self.offset[at] + r % self.per[at] * length


#: More than the pieces of any length; 2 ** 13 lengths of as many fit a 64-bit number.
_RANKS = 1 << 50


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Stored ``pieces`` with sequence_id and offset."""
    spark, order = pieces.sparkSession, ["doc_id", "piece", "ids_crc32"]
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    salts = int(min(65_536, max(64, max(histogram.values(), default=0) // GROUP)))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    groups = (salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
              .select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")))
    rank = F.row_number().over(Window.partitionBy("length", "salt").orderBy(*order)) - 1
    ranked = salted.withColumn("nth", rank).join(groups, ["length", "salt"]).withColumn("rank", F.col("nth") + F.col("before"))
    shared = spark.sparkContext.broadcast(Places(solve(histogram, capacity)))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = shared.value.find(length.to_numpy(), rank.to_numpy())
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    return ranked.withColumn("place", place("length", "rank")).select(*pieces.columns, "place.sequence_id", "place.offset")


def pack_documents(docs: DataFrame, path: str | None = None, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Tokenises, cuts and packs ``docs``; the pieces are stored in the shared folder in between."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path(TOKENIZER)
    return pack(stored(tokenized(docs, path, doc_id, text, capacity), "pieces"), capacity)
