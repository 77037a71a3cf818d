"""Line deduplication by winnowing, in DataFrame operations only.

A run of lines counts as repeated if it has ``WINDOW`` lines or ``LONG_WORDS`` words or more.  The
lines that are not blank are hashed.  Windows are ``WINDOW`` such lines, and each shorter run that
has the words; the least hash of a window is its fingerprint, so any repeated run has a fingerprint
that was selected at each of its places.  Fingerprints found at one line only are dropped (all
windows that share a minimum have it at one place); positions are joined with the others.  From
there the matches are extended both ways, to all windows whose minimum that line is, and compared
by a 128-bit hash of the lines.  Each line of a window that also is at an earlier place (by id, then
line) is deleted; overlapping windows make up the maximal repeated run.

Hot lines: fingerprints and windows are aggregated before they are shuffled, and positions meet
them by :func:`keyfig.llm.common.lookup`, which never gathers a key's rows in one task.

Defined results: a null text stays null and an empty one empty; blank lines are neither compared
nor deleted; rows equal in id and text count as one document and share its result; among other
rows of one id, and null ids (which come first), the text's hash decides the order; texts of any
length are read whole (a row holds its lines' hashes); an empty table gives none; extra columns of
any name stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from keyfig.llm.common import fresh, lookup, stored

WINDOW, LONG_WORDS = 3, 50

_DOC = ["id", "t1", "t2"]


def _identity(doc_id: str, text: str) -> list[Column]:
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return [F.col(f"`{doc_id}`").alias("id"), F.xxhash64(t).alias("t1"), F.xxhash64(F.lit(1), t).alias("t2")]


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def windows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, long_words: int = LONG_WORDS) -> DataFrame:
    """Every window: document, line numbers, fingerprint (fp) and its line (m), 128-bit hash of the lines (k1, k2)."""
    lines = docs.select(*_identity(doc_id, text), _lines(F.col(f"`{text}`")).alias("lines"))
    words = lambda x: F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1
    hashed = lines.select(*_DOC, F.filter(
        F.transform("lines", lambda x, i: F.when(F.trim(x) != "", F.struct(
            i.alias("i"), F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"), words(x).alias("words")))),
        lambda x: x.isNotNull()).alias("h"))
    hashed = hashed.select(*_DOC, *(F.col(f"h.{c}").alias(c) for c in ("a", "b", "i", "words")))

    def cuts(size: int) -> Column:
        """The windows of ``size`` lines; of the shorter ones those with the words."""
        def cut(start: Column) -> Column:
            s, at = F.slice(F.col("a"), start, size), F.slice(F.col("i"), start, size)
            least = F.array_min(s)
            return F.struct(at.alias("at"), least.alias("fp"), F.get(at, (F.array_position(s, least) - 1).cast("int")).alias("m"),
                            F.xxhash64(s).alias("k1"), F.xxhash64(F.slice(F.col("b"), start, size)).alias("k2"))

        starts = F.sequence(F.lit(1), F.size("a") - size + 1)
        if size < window:
            many = lambda start: sum((F.get("words", start - 1 + k) for k in range(size)), F.lit(0)) >= long_words
            starts = F.filter(starts, many)
        return F.when(F.size("a") >= size, F.transform(starts, cut)).otherwise(F.array())

    return hashed.select(*_DOC, F.explode(F.concat(*map(cuts, range(window, 0, -1)))).alias("w")).select(*_DOC, "w.*")


def repeats(found: DataFrame) -> DataFrame:
    """Of stored windows: per document the line numbers to delete (doomed)."""
    # the place of the minimum: all windows that have it there are one place
    place = F.xxhash64(*_DOC, "m")
    twice = stored(found.groupBy("fp").agg(F.min(place).alias("p"), F.max(place).alias("q"), F.count("*").alias("n"))
                   .where("p != q").select("fp", "n", F.lit(True).alias("twice")), "fingerprints")
    extended = lookup(found, twice, ["fp"], "n").where("twice").select(*_DOC, "at", "k1", "k2")
    first = F.min(F.struct("id", "t1", "t2", F.col("at")[0].alias("i")))
    runs = stored(extended.groupBy("k1", "k2").agg(first.alias("first"), F.count("*").alias("n")).where("n > 1"), "runs")
    later = lookup(extended, runs, ["k1", "k2"], "n").where(
        F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.struct("id", "t1", "t2", F.col("at")[0].alias("i"))))
    # sets: rows equal in id and text, however many, add nothing to a document's windows
    return later.groupBy(*_DOC).agg(F.array_distinct(F.flatten(F.collect_set("at"))).alias("doomed"))


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW,
          long_words: int = LONG_WORDS) -> tuple[DataFrame, str]:
    """``docs`` with later repeated runs deleted from the text, and a struct column of counts.

    The struct has n_lines (blank ones included) and n_removed.
    """
    counts = fresh(docs, "line_counts")
    doomed = stored(repeats(stored(windows(docs, doc_id, text, window, long_words), "windows")), "doomed")
    # only names of the deletions clash, and these are given new ones
    taken = {n: f"__{n}" for n in (*_DOC, "doomed")}
    while any(v in docs.columns for v in taken.values()):
        taken = {n: f"_{v}" for n, v in taken.items()}
    named = doomed.select(*(F.col(n).alias(v) for n, v in taken.items()))
    same = [a.eqNullSafe(F.col(taken[n])) for a, n in zip(_identity(doc_id, text), _DOC, strict=True)]
    # a row per document on both sides; as many as documents, so never broadcast
    joined = docs.join(named.hint("merge"), same[0] & same[1] & same[2], "left")
    lines, gone = _lines(F.col(f"`{text}`")), F.col(taken["doomed"])
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone), lambda i: F.get(lines, i))
    clean = F.when(gone.isNull(), F.col(f"`{text}`")).otherwise(F.array_join(kept, "\n"))
    made = F.struct(F.size(lines).cast("long").alias("n_lines"), F.coalesce(F.size(gone), F.lit(0)).cast("long").alias("n_removed"))
    return joined.select(*(clean.alias(text) if c == text else F.col(f"`{c}`") for c in docs.columns), made.alias(counts)), counts
