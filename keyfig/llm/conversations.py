"""Repair of conversations' turn structure: Wagner-Fischer alignment with the alternating grammar.

The roles of a repaired conversation read ``(s?(ua)+)?`` by their initials.  Edits: keep a row
(cost 0), rerole it to user or assistant (2), delete it (3; blank rows and duplicates must go),
insert an empty turn (2); a truncated row that stays costs 1 more.

The rows are aligned with the target string of every feasible length.  All targets end alike
(``...uaua``), so one Wagner-Fischer table over rows and symbols counted *from the end* holds the
cost against every length, and a column apart holds the targets that start with ``s``.  The cost of
a plain left-to-right repair is the incumbent; a cell that lies further off the diagonal than the
incumbent pays for is never filled (Ukkonen's band).  Every length of least cost is traced back, the
least letter first, and the ASCII-least audit of them is taken.  Conversations of equal length are
worked on together, as arrays.  Where a single conversation's band has over ``CELLS`` cells, the
columns of equal symbol are folded into one each (the future of a cell depends on its symbol only),
which takes memory in proportion to the rows and gives the same cost and audit.

Spark moves the rows twice, by conversation and sorted by turn: first only a few bytes a row, from
which the audits are made; then the texts, behind the audit of their conversation, as a stream.  No
text is held: a conversation with a third of all rows takes a task some bytes a row for its audit,
and nothing but the stream for its texts.

Defined results: a null role or text is one space; null turns come first, ties of turns are ordered
by the MD5 of role and text, so equal rows are neighbours and all but the first are duplicates.  A
null id is a conversation like any other.  Empty texts are blank; long texts are read by SQL
functions.  A conversation without rows is listed with zeros, an empty table gives no rows.  Only
the four named columns are read, so others may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from keyfig.llm.common import shuffle_parts, stored

#: Cells of a table that one step fills; larger single conversations are folded.
CELLS = 1 << 22
#: Rows that a task gathers, in whole conversations, before it aligns them.
STEP_ROWS = 50_000

KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1
OTHER, SYSTEM, USER, ASSISTANT = range(4)
_FAR = 1 << 28
_SPACE = " \t\n\x0b\x0c\r"
STATS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_STATS = [x.split()[0] for x in STATS.split(", ")]


# -------------------------------------------------------------------------------- alignment

def incumbent(roles: np.ndarray, forced: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Cost of a plain repair from left to right, for conversations (rows) of one length."""
    n_conv, n = roles.shape
    cost = forced.sum(1) * DELETE + (cut & ~forced).sum(1) * CUT
    wants = np.full(n_conv, USER)
    started, paired = np.zeros(n_conv, bool), np.zeros(n_conv, bool)
    for i in range(n):
        live = ~forced[:, i]
        system = live & ~started & (roles[:, i] == SYSTEM)
        turn = live & ~system
        fits = turn & (roles[:, i] == wants)
        shifted = turn & ~fits & (roles[:, i] >= USER)  # insert the wanted turn, keep this one
        cost += (turn & ~fits) * INSERT
        wants = np.where(turn & ~shifted, USER + ASSISTANT - wants, wants)
        started |= live
        paired |= turn
    cost += (wants == ASSISTANT) * INSERT + (started & ~paired) * 2 * INSERT
    return np.minimum(cost, n * DELETE)


def align_banded(roles: np.ndarray, forced: np.ndarray, cut: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Least costs and audits of conversations (rows) of one length, none dearer than ``most``."""
    n_conv, n = roles.shape
    least = forced.sum(1) * DELETE + (cut & ~forced).sum(1) * CUT
    half = int((most - least).max(initial=0)) // 2 + 1  # a step off the diagonal costs 2 or more; 1 for the system turn
    width = 2 * half + 1
    off = np.arange(-half, half + 1)
    live = np.zeros((n + 1, n_conv), np.int64)  # rows that may stay, among the last i
    live[1:] = np.cumsum(~forced[:, ::-1], 1).T
    cost = np.full((n + 1, n_conv, width + 1), _FAR, np.int32)  # a column more, out of the band
    led = np.full((n + 1, n_conv, width + 1), _FAR, np.int32)  # the same, with a system turn before the symbols
    cost[0, :, :width] = np.where(off >= 0, INSERT * off, _FAR)
    ramp = (INSERT * np.arange(width)).astype(np.int32)

    def price(i: int) -> np.ndarray:
        """Of row i from the end against each symbol of the band."""
        k = live[i][:, None] + off
        role = roles[:, n - i][:, None]
        return np.where(k >= 1, np.where(role == np.where(k % 2, ASSISTANT, USER), KEEP, REROLE) + CUT * cut[:, n - i][:, None], _FAR)

    for i in range(1, n + 1):
        gone = forced[:, n - i][:, None]
        best = np.where(gone, cost[i - 1, :, :width], cost[i - 1, :, 1:]) + DELETE
        np.minimum(best, np.where(gone, _FAR, cost[i - 1, :, :width] + price(i)), out=best)
        best = np.where(live[i][:, None] + off >= 0, best, _FAR).astype(np.int32)
        np.minimum(np.minimum.accumulate(best - ramp, 1) + ramp, _FAR, out=cost[i, :, :width])
        system = (~gone) & (roles[:, n - i] == SYSTEM)[:, None]
        lead = np.where(gone, led[i - 1, :, :width], led[i - 1, :, 1:]) + DELETE
        np.minimum(lead, np.where(system, cost[i - 1, :, 1:] + CUT * cut[:, n - i][:, None], _FAR), out=lead)
        np.minimum(lead, _FAR, out=led[i, :, :width])
    k = live[n][:, None] + off
    plain = np.where((k >= 0) & (k % 2 == 0), cost[n, :, :width], _FAR)
    headed = np.where((k >= 2) & (k % 2 == 0), led[n, :, :width], _FAR)
    total = np.minimum(plain.min(1), headed.min(1))
    # every length of least cost, traced back from its first letter
    parts = [(*np.nonzero(x == total[:, None]), head) for x, head in ((plain, False), (headed, True))]
    conv = np.concatenate([p[0] for p in parts])
    w = np.concatenate([p[1] for p in parts])
    head = np.concatenate([np.full(len(p[0]), p[2]) for p in parts])
    i = np.full(len(conv), n)
    letters: list[np.ndarray] = []
    while True:
        symbols = live[i, conv] + w - half
        busy = (i > 0) | (symbols > 0)
        if not busy.any():
            break
        row = np.where(i > 0, n - i, 0)
        before = np.maximum(i - 1, 0)
        here = np.where(head, led[i, conv, w], cost[i, conv, w])
        gone = forced[conv, row] if n else np.zeros(len(conv), bool)
        down = w + ~gone
        has = busy & (i > 0)
        delete = has & (np.where(head, led[before, conv, down], cost[before, conv, down]) + DELETE == here)
        insert = busy & ~delete & ~head & (w > 0) & (symbols > 0)
        insert &= cost[i, conv, np.maximum(w - 1, 0)] + INSERT == here
        stay = busy & ~delete & ~insert
        kept = stay & (head | (roles[conv, row] == np.where(symbols % 2, ASSISTANT, USER))) if n else stay
        letters.append(np.select([delete, insert, kept, stay], [ord("D"), ord("I"), ord("K"), ord("R")], 0).astype(np.uint8))
        w = np.where(delete, down, np.where(insert, w - 1, np.where(stay & head, w + 1, w)))
        head = head & ~stay
        i = np.where(delete | stay, before, i)
    written = np.stack(letters, 1) if letters else np.zeros((len(conv), 0), np.uint8)
    audits: list[bytes | None] = [None] * n_conv
    for c, x in zip(conv.tolist(), written, strict=True):
        audit = x.tobytes().rstrip(b"\0")
        if audits[c] is None or audit < audits[c]:
            audits[c] = audit
    return total, audits


def align_folded(roles: np.ndarray, forced: np.ndarray, cut: np.ndarray) -> tuple[int, bytes]:
    """The same for one conversation of any length: columns of equal symbol are one.

    States: nothing yet, after the system turn, an assistant is due, a pair is complete.
    """
    n = len(roles)
    start, system, due, whole = range(4)
    left = np.zeros((n + 1, 4), np.int64)  # least cost of the rows from i on
    left[n] = 0, 2 * INSERT, INSERT, 0
    follows = {start: due, system: due, due: whole, whole: due}
    wants = {start: USER, system: USER, due: ASSISTANT, whole: USER}
    facts = list(zip(roles.tolist(), forced.tolist(), cut.tolist(), strict=True))
    for i in range(n - 1, -1, -1):
        role, gone, short = facts[i]
        then = left[i + 1].tolist()
        best = [x + DELETE for x in then]
        if not gone:
            for s in range(4):
                best[s] = min(best[s], then[follows[s]] + (KEEP if role == wants[s] else REROLE) + CUT * short)
            if role == SYSTEM:
                best[start] = min(best[start], then[system] + KEEP + CUT * short)
        best[due], best[whole] = min(best[due], best[whole] + INSERT), min(best[whole], best[due] + INSERT)
        best[start], best[system] = min(best[start], best[due] + INSERT), min(best[system], best[due] + INSERT)
        left[i] = best
    i, s, audit = 0, start, bytearray()
    while i < n or left[i, s]:
        here = left[i, s]
        if i < n and left[i + 1, s] + DELETE == here:
            audit += b"D"
            i += 1
        elif left[i, follows[s]] + INSERT == here:
            audit += b"I"
            s = follows[s]
        else:
            role, _, short = facts[i]
            if s == start and role == SYSTEM and left[i + 1, system] + KEEP + CUT * short == here:
                audit, s = audit + b"K", system
            else:
                audit += b"K" if role == wants[s] else b"R"
                s = follows[s]
            i += 1
    return int(left[0, start]), bytes(audit)


def align(lengths: np.ndarray, roles: np.ndarray, forced: np.ndarray, cut: np.ndarray, cells: int = CELLS) -> tuple[np.ndarray, list[bytes]]:
    """Least cost and audit of every conversation, whose rows lie one after the other."""
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64) if len(lengths) else np.zeros(0, np.int64)
    total, audits = np.zeros(len(lengths), np.int64), [b""] * len(lengths)
    for n in np.unique(lengths).tolist():
        of = np.flatnonzero(lengths == n)
        if not n:
            continue
        for a in range(0, len(of), max(1, cells // n)):
            some = of[a:a + max(1, cells // n)]
            at = first[some][:, None] + np.arange(n)
            most = incumbent(roles[at], forced[at], cut[at])
            slack = most - forced[at].sum(1) * DELETE - (cut[at] & ~forced[at]).sum(1) * CUT
            band = np.ceil(np.log2(slack + 2)).astype(int)
            for b in np.unique(band).tolist():
                alike = np.flatnonzero(band == b)
                size = (n + 1) * (2 * (int(slack[alike].max()) // 2 + 1) + 2)
                if size > cells:
                    for j in alike:
                        total[some[j]], audits[some[j]] = align_folded(roles[at[j]], forced[at[j]], cut[at[j]])
                    continue
                step = max(1, cells // size)
                for c in range(0, len(alike), step):
                    part = alike[c:c + step]
                    costs, found = align_banded(roles[at[part]], forced[at[part]], cut[at[part]], most[part])
                    total[some[part]] = costs
                    for j, x in zip(some[part].tolist(), found, strict=True):
                        audits[j] = x
    return total, audits


# ------------------------------------------------------------------------------------- Spark

def _prepared(rows: DataFrame, conv: str, turn: str, role: str, text: str, copies: str | None) -> DataFrame:
    """conv, turn, role, text, copies and the digest that orders ties."""
    value = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    out = rows.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"), value(role).alias("role"), value(text).alias("text"),
                      (F.col(f"`{copies}`").cast("int") if copies else F.lit(1)).alias("copies"))
    return out.withColumn("digest", F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"))))


def _whole(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.Table]:
    """Tables of whole conversations (equal values of column 0), of ``least`` rows or more if there are."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        codes = _codes(batch.column(0))
        cuts = np.flatnonzero(np.diff(codes)) + 1
        last = int(cuts[-1]) if len(cuts) else 0
        if held and not held[-1].column(0)[held[-1].num_rows - 1].equals(batch.column(0)[0]) and n >= least:
            yield pa.Table.from_batches(held)
            held, n = [], 0
        if last and n + last >= least:
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held, n = [batch.slice(last)], batch.num_rows - last
        else:
            held.append(batch)
            n += batch.num_rows
    if held:
        yield pa.Table.from_batches(held)


def _codes(column: pa.Array) -> np.ndarray:
    return column.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)


def _audit(table: pa.Table, cells: int) -> pa.RecordBatch:
    """Figures and audit of every conversation of a sorted table."""
    table = table.combine_chunks()
    column = lambda name: table.column(name).combine_chunks() if table.num_rows else table.column(name)
    conv = column("conv")
    new = np.concatenate([[True], np.diff(_codes(conv)) != 0])
    heads = np.flatnonzero(new)
    place = np.repeat(np.arange(table.num_rows), column("copies").to_numpy(zero_copy_only=False))
    of = (np.cumsum(new) - 1)[place]
    n_conv = len(heads)
    lengths = np.bincount(of, minlength=n_conv)
    take = lambda name: column(name).to_numpy(zero_copy_only=False)[place]
    roles, blank, ends = take("initial"), take("blank"), take("ends")
    digest = np.frombuffer(b"".join(column("digest").to_pylist()), "<u8").reshape(-1, 2)[place]
    first = np.concatenate([[True], of[1:] != of[:-1]]) if len(of) else np.zeros(0, bool)
    order = np.lexsort((np.arange(len(of)), digest[:, 1], digest[:, 0], of))
    same = np.zeros(len(of), bool)
    if len(of) > 1:
        a, b = order[:-1], order[1:]
        same[b] = (of[a] == of[b]) & (digest[a] == digest[b]).all(1)
    duplicate = same & ~blank
    cut = ~blank & ~duplicate & ~ends
    before = np.roll(roles, 1)
    legal = (before == SYSTEM) & (roles == USER) | (before == USER) & (roles == ASSISTANT) | (before == ASSISTANT) & (roles == USER)
    count = lambda x: np.bincount(of[x], minlength=n_conv).astype(np.int64)
    turns, known = column("turn").fill_null(0).to_numpy(zero_copy_only=False)[place], ~column("turn").is_null().to_numpy(zero_copy_only=False)[place]
    gaps = np.zeros(n_conv, np.int64)
    if known.any():
        t, c = turns[known], of[known]
        start = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
        stop = np.concatenate([start[1:], [len(c)]]) - 1
        change = np.concatenate([[True], (c[1:] != c[:-1]) | (t[1:] != t[:-1])])
        gaps[c[start]] = t[stop] - t[start] + 1 - np.add.reduceat(change.astype(np.int64), start)
    cost, audits = align(lengths, roles, blank | duplicate, cut, cells)
    figures = [gaps, count(blank), count(duplicate), count(cut), count(~first & ~legal), cost]
    return pa.RecordBatch.from_arrays([conv.take(pa.array(heads)), *(pa.array(x, pa.int64()) for x in figures), pa.array([x.decode() for x in audits], pa.string())],
                                      names=["conv", *_STATS])


def audits(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", copies: str | None = None, cells: int = CELLS) -> DataFrame:
    """Per conversation: ``conv``, its faults and the cheapest audit; stored.

    ``copies`` names a column that tells how often a row stands (0: the conversation is listed,
    the row is not there).
    """
    made = _prepared(rows, conv, turn, role, text, copies)
    spark, kind = rows.sparkSession, made.schema["conv"].dataType.simpleString()
    seen = F.rtrim(F.col("text"), F.lit(_SPACE))
    initial = F.substring("role", 1, 1)
    facts = made.select("conv", "turn", "digest", "copies", (seen == "").alias("blank"), F.substring(seen, -1, 1).isin(".", "!", "?").alias("ends"),
                        F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(OTHER).alias("initial"))
    dealt = facts.repartition(shuffle_parts(spark), "conv").sortWithinPartitions("conv", "turn", "digest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole(batches, STEP_ROWS):
            yield _audit(table, cells)

    return stored(dealt.mapInArrow(run, f"conv {kind}, {STATS}"), "audits")


def repaired(rows: DataFrame, found: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", copies: str | None = None) -> DataFrame:
    """The turns of the repaired conversations: conv, place (from 0), edit, role, text.

    ``found`` is what :func:`audits` made of the same rows.  A conversation's turns are rows one
    after the other of one partition, and are written while the originals stream by.
    """
    made = _prepared(rows, conv, turn, role, text, copies)
    spark, kind = rows.sparkSession, made.schema["conv"].dataType.simpleString()
    empty = lambda t, n: F.lit(None).cast(t).alias(n)
    both = (found.select("conv", F.lit(0).alias("kind"), empty("long", "turn"), empty("binary", "digest"), F.lit(0).alias("copies"), empty("string", "role"), F.col("audit").alias("text"))
            .unionByName(made.select("conv", F.lit(1).alias("kind"), "turn", "digest", "copies", "role", "text").where("copies > 0")))
    dealt = both.repartition(shuffle_parts(spark), "conv").sortWithinPartitions("conv", "kind", "turn", "digest").select("conv", "kind", "copies", "role", "text")
    return dealt.mapInArrow(_write, f"conv {kind}, place long, edit string, role string, text string")


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, audit, at, place, system = None, "", 0, 0, False

    def put(edit: str, role: str | None = None, text: str = "") -> None:
        nonlocal place, system
        name = "assistant" if (place - system) % 2 else "user"
        if edit == "K":
            system |= place == 0 and role[:1] == "s"
            name = role
        out.append((conv, place, edit, name, text))
        place += 1

    def insert() -> None:
        nonlocal at
        while audit[at:at + 1] == "I":
            put("I")
            at += 1

    for batch in batches:
        out: list[tuple] = []
        for key, kind, copies, role, text in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if kind == 0:
                insert()
                conv, audit, at, place, system = key, text, 0, 0, False
                continue
            for _ in range(copies):
                insert()
                if audit[at] != "D":
                    put(audit[at], role, text)
                at += 1
        yield _table(out, batch.schema.field(0).type)
    out = []
    insert()
    if out:
        yield _table(out, batch.schema.field(0).type)


def _table(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (kind, pa.int64(), pa.string(), pa.string(), pa.string()), strict=True)],
                                      names=["conv", "place", "edit", "role", "text"])


def hashed(turns: DataFrame) -> DataFrame:
    """conv and the SHA-256 of its ``role:text`` lines, from :func:`repaired` as it comes."""
    kind = turns.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest = None, None
        for batch in batches:
            done = []
            for key, place, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 4)), strict=True):
                if place == 0:
                    if digest is not None:
                        done.append((conv, digest.hexdigest()))
                    conv, digest = key, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], batch.schema.field(0).type), pa.array([d[1] for d in done])], names=["conv", "sha256"])
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], batch.schema.field(0).type), pa.array([digest.hexdigest()])], names=["conv", "sha256"])

    return turns.mapInArrow(run, f"conv {kind}, sha256 string")


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with the faults that a checksum of conversation and turn assigns, and their ``copies``."""
    value = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(value(conv), F.lit(":"), value(turn)).cast("binary")) % 20
    return rows.select(F.col(f"`{conv}`").alias("conv_id"), F.col(f"`{turn}`").alias("turn"), F.when(fault == 4, F.lit("user")).otherwise(value(role)).alias("role"),
                       F.when(fault == 1, F.lit("")).when(fault == 2, F.translate(value(text), ".!?", "")).otherwise(value(text)).alias("text"),
                       F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"))
