"""N-gram Jaccard join: MinHash banding for candidates, then exact verification.

A document is its set of five-word shingles; documents with one set are copies and are one node.
There are ``TREES`` bands, called trees; a node's label in a tree is a sequence of minimum hashes.
One depth holds for all: the longest prefix, of ``DEPTH`` hashes at most, that pairs at the
threshold share in some tree with the target recall by the formula, whatever the data.  A prefix
of that depth that several nodes share is a hub of candidates.

Nodes that hubs connect are a candidate group.  Its nodes' sets meet in one task (groups too
large for one are cut into chunks, and each pair of chunks meets in one task), where all
intersections are counted by matrix products and compared with the threshold in whole numbers.
A task returns one row per node: the documents it is linked to there, and the least node it is
connected with.  Pairs are never written out.

Classes are the connected components of the links, named by their least document id.

Defined results: null texts and texts without words are in no pair (class: own id, 0 links); a
text of one to four words is a single shingle; repeated rows are copies of one another; a null id
counts as the least one and names its class null; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from keyfig.llm.common import annotate, fresh, lookup, shingle_hashes, shuffle_parts, stored, text_bytes, word_hashes

SHINGLE, NUMERATOR, DENOMINATOR = 5, 4, 5  # five words; Jaccard of 4/5 or more
TREES, DEPTH, RECALL = 24, 8, 0.9999
#: Nodes and bytes of sets that a chunk of a candidate group has at most (about).
CHUNK_NODES, CHUNK_BYTES = 1024, 16 << 20
_NULL = -2**63

_RNG = np.random.default_rng(77)
_XOR = _RNG.integers(0, 2**32, TREES * DEPTH, dtype=np.uint32)
_TIMES = _RNG.integers(0, 2**31, TREES * DEPTH, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def prefix_depth(trees: int = TREES, longest: int = DEPTH, recall: float = RECALL, threshold: float = NUMERATOR / DENOMINATOR) -> int:
    """The longest prefix that pairs at the threshold share in some tree with the target recall."""
    depth = longest
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def shingle_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The sorted different shingles of every row, and offsets."""
    shingles, at = shingle_hashes(*word_hashes(*text_bytes(column)), SHINGLE)
    if not len(shingles):
        return shingles, at
    parts = []
    for a, b in zip(at[:-1], at[1:], strict=True):
        part = np.sort(shingles[a:b])
        if len(part) > 1:
            part = part[np.append(True, part[1:] != part[:-1])]
        parts.append(part)
    return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


def branches(sets: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Per row and tree: a hash of the label's prefix (rows must not be empty)."""
    n = len(at) - 1
    out = np.empty((n, TREES), np.uint64)
    short = (sets >> np.uint64(32)).astype(np.uint32)
    a = 0
    while a < n:  # about 64k shingles at a time stay in the processor's cache
        b = max(a + 1, int(np.searchsorted(at, at[a] + 65_536)))
        b = min(b, n)
        part, cuts = short[at[a]:at[b]], at[a:b] - at[a]
        for tree in range(TREES):
            key = np.full(b - a, tree, np.uint64)
            for k in range(tree * DEPTH, tree * DEPTH + depth):
                least = np.minimum.reduceat((part ^ _XOR[k]) * _TIMES[k], cuts)
                key = (key ^ least) * np.uint64(0x9E3779B97F4A7C15)
                key ^= key >> np.uint64(29)
            out[a:b, tree] = key
        a = b
    return out


def _digests(sets: np.ndarray, at: np.ndarray) -> list[bytes | None]:
    return [hashlib.blake2b(sets[a:b], digest_size=16).digest() if b > a else None for a, b in zip(at[:-1], at[1:], strict=True)]


def _keyed() -> Callable[[pa.Array], pa.Array]:
    def work(column: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays([pa.array(_digests(*shingle_sets(column)), pa.binary())], names=["key"])
    return work


def _labelled(depth: int) -> Callable[[pa.Array], pa.Array]:
    kind = pa.struct([("key", pa.binary()), ("size", pa.int64()), ("branches", pa.list_(pa.int64()))])

    def work(column: pa.Array) -> pa.Array:
        sets, at = shingle_sets(column)
        size = np.diff(at)
        full = np.flatnonzero(size)
        found = branches(sets, np.append(at[full], at[-1]), depth).view(np.int64) if len(full) else np.zeros((0, TREES), np.int64)
        offsets = np.concatenate([[0], np.cumsum((size > 0) * TREES)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.ravel()))
        return pa.StructArray.from_arrays([pa.array(_digests(sets, at), pa.binary()), pa.array(size), lists], fields=list(kind))
    return work


def components(member: DataFrame) -> DataFrame:
    """Of (node, hub) rows: the least node that each node is connected with (node, label).

    Labels fall along hubs until none changes; every round is written to the shared folder.
    """
    state = member.select("node", "hub", F.col("node").alias("label"))
    while True:
        low = stored(state.groupBy("hub").agg(F.min("label").alias("low"), F.count("*").alias("n")), "hubs")
        met = lookup(state, low, ["hub"], "n")
        of_node = met.groupBy("node").agg(F.min("low").alias("new"), F.min("label").alias("old"))
        labels = stored(of_node, "labels")
        if labels.where("new != old").isEmpty():
            return labels.select("node", F.col("new").alias("label"))
        # a label has a label of its own: follow it at once
        further = labels.select(F.col("node").alias("new"), F.col("new").alias("newer"))
        hops = labels.join(further, "new", "left").select("node", F.least("new", F.coalesce("newer", "new")).alias("label"))
        state = stored(member.select("node", "hub").join(hops, "node"), "state")


def links_in(sets: list[np.ndarray], nodes: np.ndarray, copies: np.ndarray, side: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """(documents linked to, least node connected with) for nodes that meet in a task.

    ``side`` tells the two chunks of a pair apart; only pairs across them count.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), sizes)
    some = count[column] > 1
    row, column = row[some], column[some]
    number = np.cumsum(count > 1) - 1
    column = number[column]
    common = np.zeros((n, n), np.float32)  # counts below 2 ** 24 are exact
    total = int(number[-1]) + 1 if len(number) else 0
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    width = max(256, (8 << 20) // n)
    for a in range(0, total, width):
        i, j = np.searchsorted(column, [a, a + width])
        block = np.zeros((n, min(width, total - a)), np.float32)
        block[row[i:j], column[i:j] - a] = 1
        common += block @ block.T
    inter = common.astype(np.int64)
    # inter / (a + b - inter) >= p / q
    linked = (NUMERATOR + DENOMINATOR) * inter >= NUMERATOR * (sizes[:, None] + sizes[None, :])
    np.fill_diagonal(linked, False)
    if side is not None:
        linked &= side[:, None] != side[None, :]
    label = nodes.copy()
    while True:  # least labels spread along the links
        low = np.minimum(label, np.where(linked, label[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (low == label).all():
            return linked @ copies, label
        label = low


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group and chunk pair: one row per node that has links there."""
    held: list[dict] = []

    def done() -> pa.RecordBatch:
        sets = [np.frombuffer(r["shingles"], np.uint64) for r in held]
        nodes = np.array([r["node"] for r in held], np.int64)
        copies = np.array([r["copies"] for r in held], np.int64)
        side = np.array([r["chunk"] for r in held]) if held[0]["i"] != held[0]["j"] else None
        n, label = links_in(sets, nodes, copies, side)
        some = np.flatnonzero(n)
        hub = [int.from_bytes(hashlib.blake2b(f"{held[0]['group']} {held[0]['i']} {held[0]['j']} {x}".encode(), digest_size=8).digest(), "little", signed=True) for x in label[some].tolist()]
        return pa.RecordBatch.from_arrays([pa.array(nodes[some]), pa.array(n[some]), pa.array(hub, pa.int64())], names=["node", "n", "hub"])

    place = None
    for batch in batches:
        for r in batch.to_pylist():
            at = (r["group"], r["i"], r["j"])
            if held and at != place:
                if len(held) > 1:
                    yield done()
                held = []
            place = at
            held.append(r)
    if len(held) > 1:
        yield done()


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(a row per node: key, class_id, copies, n_links to other documents; a row per document: id, key)."""
    spark, parts = docs.sparkSession, shuffle_parts(docs.sparkSession)
    sent = docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(_NULL)).alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    depth = prefix_depth()
    made, name = annotate(sent, lambda: _labelled(depth), "struct<key:binary,size:long,branches:array<long>>", keep=["id"])
    labelled = stored(made.select("id", f"{name}.*"), "labelled")
    nodes = stored(labelled.where("key is not null").groupBy("key")
                   .agg(F.min("id").alias("id"), F.count("*").alias("copies"), F.first("size").alias("size"), F.first("branches").alias("branches"))
                   .withColumn("node", F.monotonically_increasing_id()), "nodes")

    # branches of the trie with several nodes
    member = nodes.select("node", F.posexplode("branches").alias("tree", "branch")).select("node", F.xxhash64("tree", "branch").alias("hub"))
    several = stored(member.groupBy("hub").agg(F.count("*").alias("n")).where("n > 1").withColumn("several", F.lit(True)), "several")
    member = stored(lookup(member, several, ["hub"], "n").where("several").select("node", "hub"), "member")
    groups = components(member).withColumnRenamed("label", "group")
    groups = groups.join(nodes.select("node", "key", "id", "copies", "size"), "node")
    groups = stored(groups, "groups")

    # chunks of a group: one if it is small
    total = groups.count()
    chunk_nodes = int(min(CHUNK_NODES, max(64, total // parts)))
    sizes = stored(groups.groupBy("group").agg(F.count("*").alias("n"), F.greatest(
        F.ceil(F.count("*") / chunk_nodes), F.ceil(F.sum("size") * 8 / CHUNK_BYTES)).cast("int").alias("chunks")), "sizes")
    placed = lookup(groups, sizes, ["group"], "n").withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    placed = stored(placed, "placed")

    # the sets of one document of each node, made again from its text
    # (one plan at every size: as many ids as there are candidates are never broadcast)
    again = sent.join(stored(placed.select("id").distinct(), "ids").hint("merge"), "id", "left_semi")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                found, at = shingle_sets(batch.column(0).slice(a, 500))
                yield pa.RecordBatch.from_arrays([pa.array(_digests(found, at), pa.binary()), pa.array(
                    [found[x:y].tobytes() for x, y in zip(at[:-1], at[1:], strict=True)], pa.binary())], names=["key", "shingles"])

    one = again.select("text").mapInArrow(sets, "key binary, shingles binary").where("key is not null")
    if _repeated(labelled):  # rows of one id and set would be one node twice
        one = one.dropDuplicates(["key"])
    wanted = one.join(placed, "key").select("node", "group", "copies", "chunk", "chunks", "shingles")
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    tiles = (wanted.withColumn("other", other)
             .withColumn("i", F.least("chunk", "other")).withColumn("j", F.greatest("chunk", "other"))
             # neighbouring chunk pairs of a group go to neighbouring partitions
             .withColumn("part", F.pmod(F.xxhash64("group") + F.col("i") * F.col("chunks") + F.col("j"), F.lit(parts)).cast("int")))
    dealt = tiles.select("part", "group", "i", "j", "chunk", "node", "copies", "shingles").repartitionById(parts, F.col("part"))
    verified = stored(dealt.sortWithinPartitions("group", "i", "j", "node").mapInArrow(_verified, "node long, n long, hub long"), "verified")
    label = components(verified.select("node", "hub").distinct())
    links = verified.groupBy("node").agg(F.sum("n").alias("n"))
    classes = (label.join(nodes.select("node", "id"), "node").groupBy("label").agg(F.min("id").alias("class_id")))
    linked = label.join(classes, "label").join(links, "node").select("node", "class_id", F.col("n").alias("others"))
    result = nodes.select("node", "key", "id", "copies").join(linked, "node", "left").select(
        "key", F.coalesce("class_id", "id").alias("class_id"), "copies",
        (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return stored(result, "classes"), labelled.select("id", "key")


def _repeated(labelled: DataFrame) -> bool:
    return not labelled.groupBy("id").count().where("count > 1").isEmpty()


def document_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, class_id and number of linked documents, for every document."""
    classes, rows = join(docs, doc_id, text)
    found = lookup(rows, classes, ["key"], "copies")
    back = lambda c: F.when(c != _NULL, c)
    return found.select(back(F.col("id")).alias("doc_id"), back(F.coalesce("class_id", "id")).alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each class, that of the least id; columns unchanged."""
    classes, _ = join(docs, doc_id, text)
    keyed, name = annotate(docs, _keyed, "struct<key:binary>", text, name="shingle_key")
    own = fresh(keyed, "class_of_document")
    row = classes.select(F.col("key").alias(own), F.struct("class_id", "n_links").alias(own + "_"), "copies")
    found = lookup(keyed.withColumn(own, F.col(f"`{name}`.key")), row, [own], "copies")
    got = F.col(own + "_")
    alone = F.coalesce(got["n_links"], F.lit(0)) == 0
    first = ~alone & (F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(_NULL)) == got["class_id"])
    marked = found.where(alone | first).withColumn(name, F.struct(alone.alias("alone"), got["class_id"].alias("class_id"))).drop(own, own + "_")
    # several rows of a class's least id: one of them
    many = marked.where(~F.col(f"`{name}`.alone")).withColumn(own, F.col(f"`{name}`.class_id")).dropDuplicates([own]).drop(own)
    return marked.where(F.col(f"`{name}`.alone")).unionByName(many).drop(name)
