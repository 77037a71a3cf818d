"""Exact top-k search, conversation repair, Merkle manifest: plain Python beside them."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from keyfig.llm import conversations, merkle, topk

# ------------------------------------------------------------------------------- op 11


def plain_top_k(rows, k, asked):
    valid = [(i, [int(np.floor(64 * x)) for x in v]) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for at, (i, v) in enumerate(valid):
        if i is not None and asked(i):
            scores = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), 2**63 if j is None else j, j) for n, (j, w) in enumerate(valid) if n != at)
            out += [(i, r + 1, j, -s) for r, (s, _, j) in enumerate(scores[:k])]
    return sorted(out, key=str)


def search(spark, rows, k=5, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash")).withColumn("vector", F.lit(1))
    return sorted((tuple(r) for r in topk.top_k(df, F.col("vec_id") % 4 == 0, k, **options).collect()), key=str)


def test_top_k_equals_brute_force(spark):
    rnd = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in rnd.normal(size=6) * 0.3]) for i in range(120)]
    same = rows[7][1]
    rows += [(200 + i, same) for i in range(60)]  # a third of all rows hold one vector
    rows += [(8, same), (8, same), (None, same), (None, rows[3][1]), (300, None), (304, [1.0, None]), (308, [float("nan")] * 6), (312, [float("inf")] * 6),
             (316, []), (320, [0.5]), (324, [0.5] * 9), (328, [0.0] * 6)]
    want = plain_top_k(rows, 5, lambda i: i % 4 == 0)
    assert search(spark, rows) == want
    # many blocks of queries, few pivots: the same rows
    assert search(spark, rows, pivots=2, sample=3, block_bytes=2_000) == want


def test_top_k_of_few_and_no_rows(spark):
    rows = [(0, [1.0, 2.0]), (4, [1.0, 2.0]), (5, [-1.0, 0.0])]
    assert search(spark, rows, k=20) == plain_top_k(rows, 20, lambda i: i % 4 == 0)
    assert search(spark, [(0, [1.0])]) == [] and search(spark, []) == []
    # scores beyond 52 bits are exact, beyond 64 bits cut
    rows = [(0, [2e7, 3.0]), (1, [2e7, 1.0]), (2, [2e7, 2.0]), (3, [1e30, 0.0])]
    big = [int(np.floor(64 * float(np.float32(x)))) for x in (2e7, 3.0, 1.0, 2.0)]
    got = {(v, s) for _, _, v, s in search(spark, rows)}
    assert {(1, big[0] ** 2 + big[1] * big[2]), (2, big[0] ** 2 + big[1] * big[3]), (3, 2**63 - 1)} == got


def test_elimination_skips_far_clusters():
    rnd = np.random.default_rng(5)
    centres = rnd.normal(size=(20, 16)) * 400
    vectors = np.floor(np.repeat(centres, 200, 0) + rnd.normal(size=(4000, 16)) * 3)
    vectors = np.floor(vectors / np.linalg.norm(vectors, axis=1)[:, None] * 1000)
    pivots = topk.Pivots(vectors[::7], 16)
    places = pivots.places(pivots.distances(vectors), (vectors * vectors).sum(1))
    best = [topk.Best(10) for _ in range(40)]
    done = topk.search(vectors[::100], places[::100], best, vectors, places, [[i] for i in range(4000)])
    assert (places[::100] @ places.T - vectors[::100] @ vectors.T).min() > -1
    scores = vectors[::100] @ vectors.T
    for b, s in zip(best, scores, strict=True):
        assert [(-x, i) for x, i in b.found] == sorted(((int(x), i) for i, x in enumerate(s)), key=lambda t: (-t[0], t[1]))[:10]
    assert done < 40 * 4000 // 4


# ------------------------------------------------------------------------------- op 12

def cheapest(roles, forced, cut):
    """(cost, audit) by the states of the grammar, row by row."""
    follows, wants = {0: 2, 1: 2, 2: 3, 3: 2}, {0: 2, 1: 2, 2: 3, 3: 2}

    def close(at):
        for a, b in ((0, 2), (1, 2), (3, 2), (2, 3)):
            if a in at:
                at[b] = min(at.get(b, (1 << 40, b"")), (at[a][0] + 2, at[a][1] + b"I"))
        return at

    now = close({0: (0, b"")})
    for role, gone, short in zip(roles, forced, cut, strict=True):
        then = {}
        for s, (cost, audit) in now.items():
            moves = [(s, 3, b"D")]
            if not gone:
                moves.append((follows[s], (0 if role == wants[s] else 2) + short, b"K" if role == wants[s] else b"R"))
                moves += [(1, short, b"K")] * bool(s == 0 and role == 1)
            for t, c, letter in moves:
                then[t] = min(then.get(t, (1 << 40, b"")), (cost + c, audit + letter))
        now = close(then)
    return min(now[s] for s in (0, 3) if s in now)


@pytest.mark.parametrize("cells", [1 << 22, 300, 20])
def test_alignment_is_the_cheapest_and_least(cells):
    rnd = np.random.default_rng(cells)
    lengths = rnd.integers(0, 14, 600)
    roles = rnd.choice([0, 1, 2, 3], lengths.sum(), p=[.1, .15, .4, .35])
    forced = rnd.random(len(roles)) < .2
    cut = (rnd.random(len(roles)) < .2) & ~forced
    cost, audits = conversations.align(lengths, roles, forced, cut, cells)
    ends = np.cumsum(lengths)
    for c, (a, b) in enumerate(zip(ends - lengths, ends, strict=True)):
        assert (cost[c], audits[c]) == cheapest(roles[a:b], forced[a:b].tolist(), cut[a:b].tolist())


def test_a_long_conversation_is_folded_to_the_same():
    rnd = np.random.default_rng(9)
    roles = np.tile([2, 3], 400)
    roles[rnd.random(800) < .1] = 2
    forced = rnd.random(800) < .1
    args = np.array([800]), roles, forced, np.zeros(800, bool)
    banded, folded = conversations.align(*args, 1 << 24), conversations.align(*args, 100)
    assert banded[0][0] == folded[0][0] and banded[1] == folded[1]


def repaired(rows):
    """Plain repair of one conversation's (role, text), by the states of the grammar."""
    seen, faults = set(), []
    for role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    code = {"s": 1, "u": 2, "a": 3}
    cost, audit = cheapest([code.get(r[:1], 0) for r, _ in rows], [f in ("blank", "duplicate") for f in faults], [f == "truncated" for f in faults])
    out, i, head = [], 0, False
    for letter in audit.decode():
        name = ("user", "assistant")[(len(out) - head) % 2]
        if letter == "K":
            head |= not out and rows[i][0][:1] == "s"
            name = rows[i][0]
        if letter != "D":
            out.append(f"{name}:{'' if letter == 'I' else rows[i][1]}")
        i += letter != "I"
    return faults, cost, audit.decode(), "\n".join(out)


def test_conversations_are_repaired(spark):
    rnd = random.Random(4)
    texts = ["Yes.", "No", " \n", "", "Why?", "é" * 3000 + "!", "cut off"]
    rows = [(c, t, rnd.choice(["user", "assistant", "system", "tool", None]), rnd.choice([*texts, None])) for c in [*range(40), None] for t in range(rnd.randrange(1, 9)) for _ in range(1)]
    rows += [(50, None, "user", "First."), (50, 7, "assistant", "Last."), (50, 3, "user", "Mid"), (51, 1, "user", "Same."), (51, 1, "user", "Same."), (52, 5, "", "odd")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("audit", F.lit("clash")).withColumn("copies", F.lit(3)).repartition(5)
    found = conversations.audits(df, cells=500)
    turns = conversations.repaired(df, found)
    prints = {r["conv"]: r["sha256"] for r in conversations.hashed(turns).collect()}
    spoken = {}
    for r in turns.collect():
        spoken.setdefault(r["conv"], []).append((r["place"], f"{r['role']}:{r['text']}"))
    assert found.count() == len({r[0] for r in rows})
    for r in found.collect():
        own = sorted(((t is not None, t or 0, hashlib.md5(f"{len((o or ' ').encode() if o is not None else b' ')}:{' ' if o is None else o}{' ' if x is None else x}".encode()).digest(), " " if o is None else o, " " if x is None else x)
                      for c, t, o, x in rows if c == r["conv"]))
        faults, cost, audit, text = repaired([x[3:] for x in own])
        assert (r["cost"], r["audit"]) == (cost, audit)
        assert (r["blank"], r["duplicate"], r["truncated"]) == tuple(faults.count(x) for x in ("blank", "duplicate", "truncated"))
        assert "\n".join(x for _, x in sorted(spoken.get(r["conv"], []))) == text
        assert prints.get(r["conv"], hashlib.sha256(b"").hexdigest()) == hashlib.sha256(text.encode()).hexdigest()
        known = [x[1] for x in own if x[0]]
        assert r["gaps"] == (max(known) - min(known) + 1 - len(set(known)) if known else 0)
        initials = [x[3][:1] for x in own]
        assert r["illegal"] == sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))


def test_conversations_without_rows_are_listed(spark):
    rows = [(c, t, "user", "Hi.") for c in range(60) for t in range(1)]
    df = conversations.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    gone = {c for c in range(60) if zlib.crc32(f"{c}:0".encode()) % 20 == 0}
    found = {r["conv"]: r for r in conversations.audits(df, copies="copies").collect()}
    assert len(found) == 60 and gone
    assert all((found[c]["cost"], found[c]["audit"], found[c]["gaps"]) == (0, "", 0) for c in gone)
    none = df.limit(0)
    assert conversations.audits(none).count() == 0 and conversations.repaired(none, conversations.audits(none)).count() == 0


# ------------------------------------------------------------------------------- op 13

def H(*digests):
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def tree(leaves):
    """Root and each leaf's siblings, level by level."""
    paths, level, groups = [[] for _ in leaves], list(leaves), [[i] for i in range(len(leaves))]
    while len(level) > 1:
        after, merged = [], []
        for i in range(0, len(level), 2):
            pair = level[i:i + 2]
            for side, g in enumerate(groups[i:i + 2]):
                for x in g:
                    paths[x] += [pair[1 - side]] if len(pair) == 2 else []
            after.append(H(*pair))
            merged.append([x for g in groups[i:i + 2] for x in g])
        level, groups = after, merged
    return level[0], paths


@pytest.mark.parametrize("block", [4096, 4, 2])
def test_manifest_equals_plain_trees(spark, block):
    rnd = random.Random(block)
    rows = [(i, rnd.choice(["a", None, ""]), rnd.choice(["en", "en", "en", "zz", "é", None, ""]), rnd.choice([None, 3, -5]), rnd.choice([None, "", "text", "ü" * 5000]))
            for i in [*range(45), 7, 7, None, None]]
    rows += [rows[3]] * 20  # repeated rows
    rows.append((99, "only", "xx", 1, "lone"))
    names = ["doc_id", "source", "lang", "n_chars", "text"]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").withColumn("leaf", F.lit("clash")).withColumn("seq", F.lit(1)).repartition(7)
    enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, H(*map(enc, r))))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[2] for x in sorted(groups[g])]) for g in order}
    root, above = tree([trees[g][0] for g in order])
    want = []
    for k, g in enumerate(order):
        for (known, i, digest), path in zip(sorted(groups[g]), trees[g][1], strict=True):
            claimed = hashlib.sha256(b"false").hexdigest() if known and i % 2 else digest
            want.append((i if known else None, digest, trees[g][0], root, H(*path, *above[k]), claimed == digest))
    carry = {"claimed": F.when(F.col("doc_id") % 2 == 1, F.unhex(F.sha2(F.lit("false"), 256)))}
    found = merkle.manifest(df, "doc_id", [F.col(c) for c in names], "lang", carry, block)
    got = merkle.proved(found, "doc_id", "claimed").collect()
    assert sorted([(r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["verified"]) for r in got], key=str) == sorted(want, key=str)
    assert all(r["verified"] == (r["folded_root"] == root) for r in got)
    assert merkle.proved(merkle.manifest(df.limit(0), "doc_id", [F.col("text")], "lang", carry, block), "doc_id", "claimed").count() == 0


def test_witnesses_grow_as_siblings_complete():
    leaves = [hashlib.sha256(str(i).encode()).digest() for i in range(11)]
    tree_of = merkle.Frontier(16)
    for digest in leaves:
        tree_of.append(digest)
    assert [h for h, *_ in tree_of.open] == [3, 1, 0]
    root, siblings, steps = tree_of.close(False)
    assert steps[0] == "RRRR" and steps[10] == "NLNL"
    assert all(merkle.fold(d, s, t) == root for d, s, t in zip(leaves, siblings, steps, strict=True))
    assert merkle.fold(hashlib.sha256(b"other").digest(), siblings[4], steps[4]) != root
