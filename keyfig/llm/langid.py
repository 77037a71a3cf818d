"""Language identification by prediction by partial matching.

Each language has a byte-level context tree of orders 3 to 0 with escape probabilities: a symbol
not seen in a context escapes to the next shorter one, the last one being uniform (escape
method D: half a count of each new symbol goes to the escape).  The statistics are frozen after
fitting, so the code length of a symbol depends on it and the three symbols before it alone.
That allows one table of exact code lengths, in 1/256 bit, over four-symbol strings.  It is kept
sparse (the strings seen, the escapes of their contexts, and all three-symbol strings) and laid out
for the strings of a step at a time; a text's code length under every language is a sum of its rows.

Symbols: bytes after folding A-Z to a-z, all of ASCII but letters being one symbol.  Languages are
put in groups whose frequent bytes are ``SYMBOLS`` - 2 at most together, one script each about;
these are symbols of their own there and the other bytes share one, to which the code length of
the byte among them is added, so that code lengths of different groups compare.  A run of
non-letters counts as one.

The model is fitted on all labelled rows, or on a bounded sample of about ``sample_docs`` whole
documents per language, chosen by a hash of the id.  Limits come from all labelled rows.  Every language has a model; they are fitted, and from more than
``MAX_LANGUAGES`` on scored, in blocks of that many, and a row's blocks are put together by its best
code length and the sum of its weights.  Prediction reads every whole text.

Defined results: ``und`` with score 0 for a null text or one without a letter; ties go to the
language that sorts first; repeated rows have a row each; without labelled rows all are ``und``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from keyfig.llm.common import annotate, fresh, steps, stored, text_bytes

SYMBOLS, ORDER = 48, 3
SAMPLE_DOCS = 2000
#: Code lengths are in 1/SCALE bit; the table holds at most LIMIT.
SCALE, LIMIT = 256, 65535
UNKNOWN = "und"
#: How sharply the score tells the best language from the others, per bit and symbol.
SHARPNESS = 12.0
#: Languages that are fitted and broadcast at a time, and the strings seen of those broadcast.
MAX_LANGUAGES, MAX_STRINGS = 64, 8_000_000
#: Strings that a task counts before it passes its counts on.
COUNTED = 2_000_000
#: Bins a unit in which values are counted to find a quantile.
BINS = 1024
#: Least share in a language's bytes of one that its group must have as a symbol.
FREQUENT = 1e-4
#: The quantile of a language's held-out texts, and how many times its excess a text may have.
QUANTILE, SLACK = 0.999, 3.0
#: Symbols from which on a text's length makes its code length per symbol no steadier.
STEADY = 256
RESULT = "struct<lang:string,score:double,bits:double,symbols:long>"
ARROW = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("bits", pa.float64()), ("symbols", pa.int64())])

_FOLD = np.zeros(256, np.uint8)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)
_LETTER = re.compile(r"[^\W\d_]")


def folded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded bytes with runs of non-letters as one 0, each text preceded by one 0; offsets."""
    f = _FOLD[data]
    keep = f != 0
    keep[1:] |= f[:-1] != 0
    begins = offsets[:-1][np.diff(offsets) > 0]
    keep[begins] = f[begins] != 0  # the 0 in front of a text stands for a leading run
    kept = np.flatnonzero(keep)
    at = np.searchsorted(kept, offsets)
    out = np.zeros(len(kept) + len(offsets) - 1, np.uint8)
    shift = np.repeat(np.arange(1, len(offsets)), np.diff(at))
    out[np.arange(len(kept)) + shift] = f[kept]
    return out, at + np.arange(len(offsets))


def codes(symbols: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For every position but the first of a text: the four symbols up to it as one number.

    Positions before a text's start count as symbol 0.
    """
    s = symbols.astype(np.int32)
    n = len(s)
    code, weight = s.copy(), SYMBOLS
    lead = np.zeros(n, np.int8)  # distance to the text's start, up to ORDER
    for k in range(ORDER):
        begins = offsets[:-1] + k
        begins = begins[begins < offsets[1:]]
        lead[begins] = k + 1
    for k in range(1, ORDER + 1):
        before = np.zeros(n, np.int32)
        before[k:] = s[:-k] if k < n else 0
        before[(lead > 0) & (lead <= k)] = 0
        code += before * weight
        weight *= SYMBOLS
    return code


class Statistics:
    """A language's frozen statistics: four-symbol strings seen, ascending, and how often."""

    def __init__(self, code: np.ndarray, n: np.ndarray):
        def bits(p: np.ndarray) -> np.ndarray:
            return (-np.log2(p) * SCALE).astype(np.float32)

        def level(c: np.ndarray, shorter: np.ndarray) -> np.ndarray:
            total, kinds = c.sum(axis=1, keepdims=True), (c > 0).sum(axis=1, keepdims=True)
            seen = np.where(c > 0, c - 0.5, 0.0) / np.maximum(total, 1)
            return seen + np.where(total > 0, kinds / 2 / np.maximum(total, 1), 1.0) * shorter

        probability = np.full((1, SYMBOLS), 1 / SYMBOLS)  # order -1
        for order in range(ORDER):
            # the contexts of this order are those of the last one with a symbol in front
            size = SYMBOLS ** (order + 1)
            c = np.bincount(code % size, weights=n, minlength=size).reshape(-1, SYMBOLS)
            probability = level(c, np.tile(probability, (len(c) // len(probability), 1)))
        shorter = probability.ravel()
        self.context, of, kinds = np.unique(code // SYMBOLS, return_inverse=True, return_counts=True)
        total = np.bincount(of, weights=n, minlength=len(kinds))
        escape = kinds / 2 / np.maximum(total, 1)
        self.code, self.shorter, self.escape = code.astype(np.int32), bits(shorter), bits(escape)
        self.seen = bits((n - 0.5) / total[of] + escape[of] * shorter[code % len(shorter)])

    def lengths(self, code: np.ndarray) -> np.ndarray:
        """Code length of each ascending string's last symbol after its first three, by escapes."""
        out = self.shorter[code % len(self.shorter)]
        for keys, values, wanted, add in ((self.context, self.escape, code // SYMBOLS, True), (self.code, self.seen, code, False)):
            if len(keys):
                at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                hit = keys[at] == wanted
                out[hit] = values[at[hit]] + (out[hit] if add else 0)
        return np.minimum(np.round(out), LIMIT).astype(np.uint16)


class Group:
    """Languages of one set of symbols: the symbol of each byte, statistics, costs of shared bytes."""

    def __init__(self, symbol: np.ndarray, counts: list[tuple[np.ndarray, np.ndarray]], shared: np.ndarray | None = None):
        """shared: per byte and language, the length to add where the byte has the last symbol."""
        self.symbol, self.shared = symbol, shared
        self.statistics = [Statistics(*c) for c in counts]

    def lengths(self, folded_: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Bits per row and language of folded texts."""
        n = len(self.statistics)
        bits = np.zeros((len(at) - 1, n))
        code = codes(self.symbol[folded_], at)
        place = np.empty(SYMBOLS ** (ORDER + 1), np.int32)
        step = (1 << 23) // max(8, n)
        for a in range(0, len(code), step):
            b = min(a + step, len(code))
            there = np.zeros(len(place), bool)
            there[code[a:b]] = True
            strings = np.flatnonzero(there).astype(np.int32)
            place[strings] = np.arange(len(strings), dtype=np.int32)
            table = np.empty((len(strings), n), np.uint16)
            for k, x in enumerate(self.statistics):
                table[:, k] = x.lengths(strings)
            cost = table[place[code[a:b]]]
            first = int(np.searchsorted(at, a, side="right")) - 1
            last = int(np.searchsorted(at, b, side="left"))
            cuts = np.maximum(at[first:last], a) - a  # every text has a symbol, so cuts ascend
            bits[first:last] += np.add.reduceat(cost, cuts, axis=0, dtype=np.uint64) / SCALE
            if self.shared is not None:
                rest = np.flatnonzero(self.symbol[folded_[a:b]] == SYMBOLS - 1)
                row = np.searchsorted(at, rest + a, side="right") - 1
                for k in range(n):
                    bits[:, k] += np.bincount(row, weights=self.shared[folded_[a:b][rest], k], minlength=len(bits)) / SCALE
        return bits


class Model:
    """Frozen statistics of languages, in groups of one set of symbols."""

    def __init__(self, languages: list[str], symbol: np.ndarray, counts: list[tuple[np.ndarray, np.ndarray]], shared: np.ndarray | None = None):
        """counts: per language, the four-symbol strings seen, ascending, and how often."""
        self.languages = languages
        self.groups = [(list(range(len(languages))), Group(symbol, counts, shared))] if languages else []

    @classmethod
    def joined(cls, models: list[Model]) -> Model:
        """One model of all the languages of several."""
        out = cls([], np.zeros(256, np.uint8), [])
        out.languages = sorted(x for m in models for x in m.languages)
        place = {x: k for k, x in enumerate(out.languages)}
        out.groups = [([place[m.languages[k]] for k in columns], g) for m in models for columns, g in m.groups]
        return out

    def blocks(self) -> list[Model]:
        """Models of ``MAX_LANGUAGES`` languages and ``MAX_STRINGS`` strings at most, or of one group that has more."""
        out: list[list] = []
        for columns, group in self.groups:
            some = [*out[-1], (columns, group)] if out else []
            if not out or sum(len(c) for c, _ in some) > MAX_LANGUAGES or sum(len(x.code) for _, g in some for x in g.statistics) > MAX_STRINGS:
                out.append([])
            out[-1].append((columns, group))
        made = []
        for some in out:
            m = Model([], np.zeros(256, np.uint8), [])
            kept = sorted(k for columns, _ in some for k in columns)
            m.languages = [self.languages[k] for k in kept]
            m.groups = [([kept.index(k) for k in columns], g) for columns, g in some]
            made.append(m)
        return made or [self]

    def lengths(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bits per row and language, symbols per row) of whole texts."""
        folded_, at = folded(data, offsets)
        bits = np.zeros((len(offsets) - 1, len(self.languages)))
        for columns, group in self.groups:
            bits[:, columns] = group.lengths(folded_, at)
        return bits, np.diff(at)

    def predict(self, column: pa.Array) -> pa.Array:
        n = len(column)
        # (\w also has signs like a superscript two, which are no letters)
        letters = np.fromiter((x is not None and any(m[0].isalpha() for m in _LETTER.finditer(x)) for x in column.to_pylist()), bool, n)
        if not self.languages:
            letters[:] = False
        names, score, best_bits = np.full(n, UNKNOWN, object), np.zeros(n), np.zeros(n)
        bits, total = self.lengths(*text_bytes(column))
        if self.languages and n:
            best = bits.argmin(axis=1)
            low = bits[np.arange(n), best]
            gap = np.exp(-SHARPNESS * (bits - low[:, None]) / total[:, None])
            names = np.where(letters, np.array(self.languages, object)[best], UNKNOWN)
            score = np.where(letters, 1 / gap.sum(axis=1), 0.0)
            best_bits = np.where(letters, low, 0.0)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(score), pa.array(best_bits), pa.array(total)], fields=list(ARROW))


def _code_lengths(code: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The dense table: code lengths of all four-symbol strings, from those seen and how often."""
    return Statistics(code, n).lengths(np.arange(SYMBOLS ** (ORDER + 1)))


def alphabets(frequency: np.ndarray) -> list[tuple[list[int], np.ndarray]]:
    """Groups of languages and the symbol of each byte there, from counts per language and byte."""
    groups: list[tuple[list[int], set[int], np.ndarray]] = []
    for k, c in enumerate(frequency):
        ranked = np.lexsort((np.arange(256), -c))[:SYMBOLS - 2]
        need = {int(x) for x in ranked if c[x] > FREQUENT * c.sum()}
        for members, own, total in groups:
            if len(own | need) <= SYMBOLS - 2:
                members.append(k)
                own |= need
                total += c
                break
        else:
            groups.append(([k], need, c.copy()))
    out = []
    for members, own, total in groups:
        # places that are left go to the most frequent of the other bytes
        more = [int(x) for x in np.lexsort((np.arange(256), -total)) if total[x] and int(x) not in own]
        chosen = sorted(own | set(more[:SYMBOLS - 2 - len(own)]))
        symbol = np.full(256, SYMBOLS - 1, np.uint8)
        symbol[0] = 0
        symbol[chosen] = np.arange(1, len(chosen) + 1)
        out.append((members, symbol))
    return out


def _shared(symbol: np.ndarray, frequency: np.ndarray) -> np.ndarray:
    """Per byte and language: code length of a byte among those that share the last symbol."""
    rest = np.flatnonzero((symbol == SYMBOLS - 1) & np.isin(np.arange(256), _FOLD))
    out = np.zeros((256, len(frequency)), np.uint16)
    c = frequency[:, rest] + 0.5
    out[rest] = np.round(-np.log2(c / c.sum(axis=1, keepdims=True)) * SCALE).T
    return out


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str | Column = "doc_id",
        sample_docs: int | None = SAMPLE_DOCS) -> Model:
    """A model from labelled rows (rows without text or language are none).

    All of them if ``sample_docs`` is None, else about so many a language; ``key`` decides, by its
    hash, which rows are in that sample.
    """
    key = F.col(f"`{key}`") if isinstance(key, str) else key
    rows = labelled.select(F.col(f"`{text}`").cast("string").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang"), key.alias("key")).where("text is not null and lang is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    blocks = [languages[a:a + MAX_LANGUAGES] for a in range(0, len(languages), MAX_LANGUAGES)]
    if len(blocks) > 1 and sample_docs is not None:  # the sample alone is read for each block
        rows = stored(_sample(rows, sizes, sample_docs), "language_sample")
    return Model.joined([_fit(_sample(rows, {x: sizes[x] for x in some}, sample_docs), some) for some in blocks])


def _sample(rows: DataFrame, sizes: dict[str, int], sample_docs: int | None) -> DataFrame:
    """Rows of the languages: all, or by the key's hash about so many each."""
    if sample_docs is None:
        return rows.where(F.col("lang").isin(list(sizes)))
    share = F.create_map(*(F.lit(x) for name, n in sizes.items() for x in (name, sample_docs / n)))
    return rows.where(F.pmod(F.xxhash64("key"), F.lit(1 << 20)) < F.try_element_at(share, F.col("lang")) * (1 << 20))


def _fit(sample: DataFrame, languages: list[str]) -> Model:
    """A model of the languages from the rows of a sample."""
    number = F.create_map(*(F.lit(x) for k, name in enumerate(languages) for x in (name, k)))
    sent = sample.select(F.try_element_at(number, F.col("lang")).cast("byte").alias("lang"), "text")

    def count(batches: Iterator[pa.RecordBatch], symbols: dict[int, np.ndarray] | None) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def added(k: int) -> tuple[np.ndarray, np.ndarray]:
            code, of = np.unique(np.concatenate([c for c, _ in sums[k]]), return_inverse=True)
            return code, np.bincount(of, weights=np.concatenate([n for _, n in sums[k]]), minlength=len(code)).astype(np.int64)

        def passed_on() -> Iterator[pa.RecordBatch]:
            for k in list(sums):
                code, n = added(k)
                del sums[k]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(code), k), pa.int8()), pa.array(code, pa.int32()), pa.array(n, pa.int64())], names=["lang", "code", "n"])

        for batch in batches:
            for a, b in steps(batch.column(1)):
                numbers = batch.column(0).slice(a, b - a).to_numpy(zero_copy_only=False)
                for k in np.unique(numbers).tolist():
                    data, offsets = folded(*text_bytes(batch.column(1).slice(a, b - a).filter(pa.array(numbers == k))))
                    sums.setdefault(k, []).append(np.unique(data if symbols is None else codes(symbols[k][data], offsets), return_counts=True))
                if sum(len(c) for x in sums.values() for c, _ in x) > COUNTED:
                    for k in sums:
                        sums[k] = [added(k)]
                    if sum(len(c) for x in sums.values() for c, _ in x) > COUNTED // 2:
                        yield from passed_on()
        yield from passed_on()

    def counted(symbols: dict[int, np.ndarray] | None) -> pa.Table:
        found = sent.mapInArrow(lambda b: count(b, symbols), "lang byte, code int, n long")
        return found.groupBy("lang", "code").agg(F.sum("n").alias("n")).toArrow()

    # bounded by 256 rows a language, and by the four-symbol strings there are
    by_byte = counted(None)
    frequency = np.zeros((len(languages), 256), np.int64)
    frequency[by_byte["lang"].to_numpy(), by_byte["code"].to_numpy()] = by_byte["n"].to_numpy()
    frequency[:, 0] = 0
    groups = alphabets(frequency)
    grams = counted({k: symbol for members, symbol in groups for k in members})
    numbers, at, n = (grams[x].to_numpy() for x in ("lang", "code", "n"))
    del grams
    models = []
    for members, symbol in groups:
        counts = []
        for k in members:
            some = np.flatnonzero(numbers == k)
            some = some[np.argsort(at[some])]
            counts.append((at[some].astype(np.int64), n[some]))
        models.append(Model([languages[k] for k in members], symbol, counts, _shared(symbol, frequency[members])))
    return Model.joined(models)


def predict(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """``docs`` with a struct column: language, score (0 to 1), code length, symbols."""
    context, blocks = docs.sparkSession.sparkContext, model.blocks()
    if len(blocks) == 1:
        shared = context.broadcast(model)
        return annotate(docs, lambda: shared.value.predict, RESULT, text, keep, "language")
    row, name = fresh(docs, "row"), fresh(docs, "language")
    # stored once, so that a row has one number in all blocks
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = []
    for block in blocks:
        shared = context.broadcast(block)
        part, one = annotate(numbered, lambda b=shared: b.value.predict, RESULT, text, [row], name)
        found.append(stored(part.select(F.col(f"`{row}`").alias("row"), F.col(f"`{one}`").alias("found")), "languages"))
        shared.destroy()
    parts = reduce(DataFrame.unionByName, found).groupBy("row").agg(F.collect_list("found").alias("parts"))
    best = F.array_min(F.transform("parts", lambda x: F.struct(x["bits"], x["lang"], x["symbols"])))
    parts = parts.select("row", "parts", best.alias("best"))
    weights = F.aggregate(F.array_sort("parts"), F.lit(0.0), lambda w, x: w + F.exp(
        (x["bits"] - F.col("best.bits")) * -SHARPNESS / F.col("best.symbols")) / x["score"])
    known = F.col("best.lang") != UNKNOWN
    score = F.when(known, 1 / weights).otherwise(0.0)
    made = parts.select(F.col("row").alias(f"{row}_"), F.struct(
        F.col("best.lang").alias("lang"), score.alias("score"), F.col("best.bits").alias("bits"), F.col("best.symbols").alias("symbols")).alias(name))
    wanted = docs.columns if keep is None else keep
    joined = numbered.select(*(F.col(f"`{c}`") for c in dict.fromkeys([*wanted, row]))).join(made.hint("merge"), F.col(f"`{row}`") == F.col(f"`{row}_`"))
    return joined.select(*(F.col(f"`{c}`") for c in wanted), F.col(f"`{name}`")), name


def _excess(bits: Column, symbols: Column, usual: Column) -> Column:
    """Bits a symbol above the usual, in units that shrink with a text's length up to ``STEADY``."""
    return (bits / symbols - usual) * F.sqrt(symbols / (1 + symbols / STEADY))


def quantile(rows: DataFrame, value: Column, q: float, name: str) -> DataFrame:
    """Per language, ``percentile`` of the rows' values, of which no task gets all.

    Values are counted in bins; only those of the bins that the quantile lies in are ordered.
    """
    valued = rows.select("lang", value.alias("value"), F.floor(value * BINS).alias("bin"))
    bins = valued.groupBy("lang", "bin").agg(F.count("*").alias("n"))
    own = Window.partitionBy("lang")
    bins = bins.select("lang", "bin", "n", (F.sum("n").over(own.orderBy("bin")) - F.col("n")).alias("before"), ((F.sum("n").over(own) - 1) * F.lit(q)).alias("at"))
    hit = bins.where((F.floor("at") < F.col("before") + F.col("n")) & (F.ceil("at") >= F.col("before"))).drop("n")
    some = valued.join(F.broadcast(hit), ["lang", "bin"]).groupBy("lang", "bin", "before", "at", "value").agg(F.count("*").alias("n"))
    upto = F.col("before") + F.sum("n").over(Window.partitionBy("lang", "bin").orderBy("value"))
    ends = some.withColumn("upto", upto).groupBy("lang", "at").agg(
        *(F.min(F.when(F.col("upto") > f("at"), F.col("value"))).alias(x) for x, f in (("low", F.floor), ("high", F.ceil))))
    between = (F.ceil("at") - F.col("at")) * F.col("low") + (F.col("at") - F.floor("at")) * F.col("high")
    return ends.select("lang", F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(between).alias(name))


def limits(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> dict[str, tuple[float, float]]:
    """Per language: the usual bits a symbol of its texts, and the excess above it that is too much.

    A model of one half of the labelled rows is held against the other half, all rows of both, so the
    limits do not depend on the other languages there are.  A language of which no text of the
    other half is recognised has no limit.
    """
    rows = labelled.select(F.col(f"`{text}`").cast("string").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{key}`").alias("key")).where("text is not null and lang is not null")
    half = F.pmod(F.xxhash64(F.lit(1), "key"), F.lit(2))
    model, held = fit(rows.where(half == 0), key="key", sample_docs=None), rows.where(half == 1)
    if not model.languages:
        return {}
    found, name = predict(held, model, keep=["lang"])
    own = stored(found.where(F.col(f"`{name}`.lang") == F.col("lang")).where(F.col(f"`{name}`.score") > 0)
                 .select("lang", F.col(f"`{name}`.bits").alias("bits"), F.col(f"`{name}`.symbols").alias("symbols")), "held_out")
    usual = {r["lang"]: r["usual"] for r in quantile(own, F.col("bits") / F.col("symbols"), 0.5, "usual").collect()}
    if not usual:
        return {}
    excess = _excess(F.col("bits"), F.col("symbols"), F.try_element_at(F.create_map(*(F.lit(x) for pair in usual.items() for x in pair)), F.col("lang")))
    return {r["lang"]: (usual[r["lang"]], SLACK * r["most"]) for r in quantile(own, excess, QUANTILE, "most").collect()}


def fits(found: Column, limits: dict[str, tuple[float, float]]) -> Column:
    """Whether a result's text is, by its code length, one of its language; ``und`` never is.

    A text that its language's model codes better than no model at all is one whatever the limit:
    so are texts of two languages, or with keys and addresses among the words.
    """
    known = found["lang"] != UNKNOWN
    if not limits:
        return known
    usual, most = (F.try_element_at(F.create_map(*(F.lit(x) for name, v in limits.items() for x in (name, v[k]))), found["lang"]) for k in range(2))
    better = found["bits"] < found["symbols"] * float(np.log2(SYMBOLS))
    return known & (better | F.coalesce(_excess(found["bits"], found["symbols"], usual) <= most, F.lit(True)))
