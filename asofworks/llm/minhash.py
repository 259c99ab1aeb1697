"""Operator 9: near-duplicate documents by an LSH forest over MinHash signatures."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asofworks.llm.graph import components
from asofworks.llm.store import kept, read_table
from asofworks.llm.textbytes import blocks, shingles, words

#: Words in a shingle, and the share (in hundredths) of common shingles that links two documents.
WIDTH, SIMILAR = 5, 75
#: Orders of the forest, and MinHash values in the key of each.
TREES, DEPTH = 16, 6
#: Values that neighbours share at least.
LEAST_DEPTH = 3
#: Entries of a region up to which its pairs are listed; a larger region is cut into blocks of about BLOCK entries or BLOCK_SHINGLES shingles, and pairs of blocks are held against each other.
NEAR, BLOCK, BLOCK_SHINGLES = 24, 1024, 1 << 19
#: Candidates of an entry that are confirmed at once within a pair of blocks.
AT_ONCE = 16
#: Share of equal signature values below which a pair is not confirmed; at similarity 0.75 and 96 values that is five deviations away.
ESTIMATE = 0.53
#: Ids that are broadcast at most to pick their texts; more are joined by a shuffle.
BROADCAST_IDS = 1 << 20

_MULTIPLY = np.random.default_rng(17).integers(0, 1 << 64, TREES * DEPTH, np.uint64) | np.uint64(1)

SIGNED = "doc_id long, n_shingles long, set_a long, set_b long, signature binary"


def _sets(column: pa.Array, width: int) -> Iterator[list[np.ndarray]]:
    """For each block of texts, each text's distinct shingles in order."""
    for _, _, data, offsets in blocks(column):
        values, begin = shingles(*words(data, offsets), width)
        yield [np.unique(values[a:b]) for a, b in zip(begin[:-1], begin[1:], strict=True)]


def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) to set size, two 64-bit sums that name the set, and the MinHash signature."""
    for batch in batches:
        at = 0
        for sets in _sets(batch.column(1), WIDTH):
            size = np.array([len(s) for s in sets], np.int64)
            full = np.flatnonzero(size)
            flat = np.concatenate([sets[k] for k in full]) if len(full) else np.zeros(0, np.uint64)
            start = np.concatenate([[0], np.cumsum(size[full])[:-1]]).astype(np.int64)
            least = np.zeros((len(sets), len(_MULTIPLY)), np.uint32)
            sums = np.zeros((2, len(sets)), np.uint64)
            if len(full):
                with np.errstate(over="ignore"):
                    for k, times in enumerate(_MULTIPLY):
                        least[full, k] = np.minimum.reduceat(flat * times, start) >> np.uint64(32)
                    sums[0, full] = np.add.reduceat(flat, start)
                    sums[1, full] = np.add.reduceat((flat ^ (flat >> np.uint64(29))) * _MULTIPLY[0], start)
            yield pa.record_batch(
                [batch.column(0).slice(at, len(sets)), pa.array(size), pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64)), pa.array([row.tobytes() for row in least], pa.binary())],
                ["doc_id", "n_shingles", "set_a", "set_b", "signature"],
            )
            at += len(sets)


def shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) to (doc_id, shingles): the full set."""
    for batch in batches:
        at = 0
        for sets in _sets(batch.column(1), WIDTH):
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            flat = np.concatenate(sets).view(np.int64)
            yield pa.record_batch([batch.column(0).slice(at, len(sets)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], ["node", "shingles"])
            at += len(sets)


def neighbours(batches: Iterator[pa.RecordBatch], steps: int) -> Iterator[pa.RecordBatch]:
    """Rows (tree, region's head, node, known component, signature) in order to pairs of a region up to steps apart whose signatures agree well enough.

    Nodes known to be in one component need no pair.
    """
    size = TREES * DEPTH
    tail: tuple | None = None
    for batch in batches:
        tree, head, node, known = (batch.column(c).to_numpy() for c in range(4))
        sig = np.frombuffer(b"".join(batch.column(4).to_pylist()), np.uint32).reshape(-1, size)
        if tail:
            tree, head, node, known, sig = (np.concatenate(x) for x in zip(tail, (tree, head, node, known, sig), strict=True))
        n, old = len(tree), len(tail[0]) if tail else 0
        found_a, found_b = [], []
        for step in range(1, min(steps, n - 1) + 1):
            i = np.arange(max(0, old - step), n - step)
            i = i[(tree[i] == tree[i + step]) & (head[i] == head[i + step]) & (known[i] != known[i + step])]
            i = i[(sig[i] == sig[i + step]).mean(1) >= ESTIMATE] if len(i) else i
            found_a.append(np.minimum(node[i], node[i + step]))
            found_b.append(np.maximum(node[i], node[i + step]))
        if found_a:
            pairs = np.unique(np.stack([np.concatenate(found_a), np.concatenate(found_b)]), axis=1)
            yield pa.record_batch([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])
        tail = tuple(x[-steps:] for x in (tree, head, node, known, sig))


def _earlier(one: np.ndarray, others: np.ndarray, tree: int) -> np.ndarray:
    """Which of others share a region with one in a tree before tree, where the pair is looked at."""
    of = lambda sig: sig.reshape(*sig.shape[:-1], TREES, DEPTH)[..., :tree, :LEAST_DEPTH]
    return (of(others) == of(one)).all(-1).any(-1)


def across(table: pa.Table) -> pa.Table:
    """Two blocks of a region, or one, to links (a, b) that bring all their entries together that ought to be.

    Pairs of entries of different components whose signatures agree well enough
    are confirmed on the full sets, the most alike first; each link joins two
    components, so no pair of these is confirmed again.
    """
    node, known, block = (table[c].to_numpy() for c in ("node", "known", "block"))
    tree, one, two = (table[c][0].as_py() for c in ("tree", "one", "two"))
    sig = np.frombuffer(b"".join(table["signature"].to_pylist()), np.uint32).reshape(-1, TREES * DEPTH)
    lists = table["shingles"].combine_chunks()
    flat = lists.values.to_numpy().view(np.uint64)
    begin = lists.offsets.to_numpy().astype(np.int64)
    size = np.diff(begin)
    label = np.unique(known, return_inverse=True)[1]
    left, right = np.flatnonzero(block == one), np.flatnonzero(block == two)
    others = np.ascontiguousarray(sig[right])
    found: list[tuple[int, int]] = []
    for i in left.tolist():
        alike = (others == sig[i]).mean(1)
        some = np.flatnonzero((alike >= ESTIMATE) & (label[right] != label[i]) & ((right > i) if one == two else True))
        some = some[~_earlier(sig[i], others[some], tree)]
        todo = right[some[np.argsort(-alike[some], kind="stable")]]
        mine = flat[begin[i] : begin[i + 1]]
        while len(todo):
            now, todo = todo[:AT_ONCE], todo[AT_ONCE:]
            theirs = np.concatenate([flat[begin[j] : begin[j + 1]] for j in now.tolist()])
            at = np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)
            common = np.add.reduceat((mine[at] == theirs).astype(np.int64), np.cumsum(size[now]) - size[now])
            for j in now[100 * common >= SIMILAR * (size[i] + size[now] - common)].tolist():
                if label[j] != label[i]:
                    found.append((min(node[i], node[j]), max(node[i], node[j])))
                    label[label == label[j]] = label[i]
            todo = todo[label[todo] != label[i]]
    return pa.table([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], ["a", "b"])


def block_links(members: DataFrame, heads: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): links that join those of a region's known components that ought to be, from members (tree, head, node, known, n).

    A component that fills a block has blocks of its own, which are not held
    against each other; all others share blocks by the component's hash.
    """
    members = members.join(heads.select("node", "n_shingles"), "node")
    full = lambda n, shingles: F.greatest(F.ceil(n / BLOCK), F.ceil(shingles / BLOCK_SHINGLES))
    share = members.groupBy("tree", "head", "known").agg(full(F.count("*"), F.sum("n_shingles")).alias("s"))
    whole = members.groupBy("tree", "head").agg(full(F.count("*"), F.sum("n_shingles")).alias("w"))
    members = members.join(share, ["tree", "head", "known"]).join(whole, ["tree", "head"])
    own = F.when(F.col("s") > 1, F.col("known"))
    salt = F.when(F.col("s") > 1, F.pmod(F.xxhash64("node"), F.col("s"))).otherwise(F.pmod(F.xxhash64("known"), F.col("w")))
    members = kept(members.withColumn("own", own).withColumn("block", F.xxhash64(F.col("own").isNull(), "own", salt)).select("tree", "head", "own", "block", "node", "known"), "members")
    blocks = members.select("tree", "head", "own", "block").distinct()
    two = blocks.select("tree", "head", F.col("own").alias("its"), F.col("block").alias("two"))
    tiles = blocks.withColumnRenamed("block", "one").join(two, ["tree", "head"]).where((F.col("one") <= F.col("two")) & F.coalesce(F.col("own") != F.col("its"), F.lit(True)))
    tiles = tiles.select("tree", "head", "one", "two", F.explode(F.array_distinct(F.array("one", "two"))).alias("block"))
    rows = tiles.join(members.drop("own"), ["tree", "head", "block"]).join(heads.select("node", "signature"), "node").join(sets, "node")
    return rows.groupBy("tree", "head", "one", "two").applyInArrow(across, "a long, b long")


def near_links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(signed documents with their class, confirmed links between classes).

    Documents with equal shingle sets form a class, named by its smallest
    doc_id; only one of a class takes part in the search.  Every tree orders
    the classes by its part of the signature; entries whose first LEAST_DEPTH
    values are equal form a region, and only regions of two or more go on.
    Links are confirmed on the full sets, in two rounds: the first takes the
    nearest neighbours and each region's first entry, the second all pairs of a
    region, however large it is, that the first has not brought together.  Large
    regions are cut into pairs of blocks, which join components as they go, so a
    large group of near copies never makes all its pairs.
    """
    texts = docs.select("doc_id", "text")
    signed = kept(texts.mapInArrow(sign, SIGNED), "signed")
    classes = signed.where("n_shingles > 0 and doc_id is not null").groupBy("set_a", "set_b", "n_shingles").agg(F.min("doc_id").alias("node"))
    classes = kept(classes, "classes")
    heads = (
        signed.where("n_shingles > 0").join(classes.select("set_a", "set_b", "n_shingles", F.col("node").alias("doc_id")), ["set_a", "set_b", "n_shingles", "doc_id"])
        .dropDuplicates(["doc_id", "set_a", "set_b", "n_shingles"])
        .select(F.col("doc_id").alias("node"), "n_shingles", "signature")
    )
    heads = kept(heads, "heads")
    entries = heads.select("node", "signature", F.explode(F.array(*[F.lit(k) for k in range(TREES)])).alias("tree"))
    entries = entries.select("tree", "node", F.expr(f"substring(signature, 1 + 4 * tree * {DEPTH}, {4 * LEAST_DEPTH})").alias("region"))
    crowded = entries.groupBy("tree", "region").agg(F.count("*").alias("n"), F.min("node").alias("head")).where("n > 1")
    entries = kept(entries.join(crowded, ["tree", "region"]).select("tree", "node", "head", "n"), "regions")
    keyed = entries.select("tree", "head", "node").join(heads.select("node", "signature"), "node")
    keyed = keyed.withColumn("key", F.expr(f"substring(signature, 1 + 4 * tree * {DEPTH}, {4 * DEPTH})"))

    def candidates(ordered: DataFrame, steps: int) -> DataFrame:
        return ordered.select("tree", "head", "node", "known", "signature").mapInArrow(lambda b: neighbours(b, steps), "a long, b long")

    active = entries.select(F.col("node").alias("doc_id")).distinct()
    active = kept(active, "active")
    if active.count() <= BROADCAST_IDS:
        active = F.broadcast(active)
    sets = kept(texts.join(active, "doc_id", "left_semi").mapInArrow(shingle_sets, "node long, shingles array<long>"), "sets")

    def confirmed(pairs: DataFrame) -> DataFrame:
        both = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
        both = both.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b").withColumn("common", F.size(F.array_intersect("x", "y")))
        return kept(both.where(100 * F.col("common") >= SIMILAR * (F.size("x") + F.size("y") - F.col("common"))).select("a", "b"), "links")

    # first the nearest neighbours and each region's head; then all pairs of a region that these have not brought together
    to_head = entries.where("node <> head").select(F.col("head").alias("a"), F.col("node").alias("b"))
    nearest = keyed.withColumn("known", F.col("node")).repartitionByRange("tree", "key", "node").sortWithinPartitions("tree", "key", "node")
    first = confirmed(candidates(nearest, 1).unionAll(to_head).distinct())
    known = components(first).withColumnRenamed("component", "known")
    members = kept(entries.join(known, "node", "left").withColumn("known", F.coalesce("known", "node")), "members")
    apart = members.groupBy("tree", "head").agg(F.min("known").alias("x"), F.max("known").alias("y")).where("x <> y").select("tree", "head")
    members = kept(members.join(apart, ["tree", "head"]), "members")
    small = members.where(F.col("n") <= NEAR).join(heads.select("node", "signature"), "node").repartition("tree", "head").sortWithinPartitions("tree", "head", "node")
    crowded = kept(block_links(members.where(F.col("n") > NEAR), heads, sets).distinct(), "links")
    links = first.unionAll(crowded).unionAll(confirmed(candidates(small, NEAR).distinct()))
    return signed.join(classes, ["set_a", "set_b", "n_shingles"], "left"), links


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Two documents are linked if 100 * common >= 75 * united distinct 5-word
    shingles of their lower-cased (A-Z) whole texts; a text of fewer words is
    one shingle.  component_id is the smallest doc_id reachable; kept says
    whether it is the document's own.

    A null or empty text, or one without words, is linked with nothing and
    kept.  A null doc_id takes no part in the search and gets a null
    component_id and kept.  Rows that repeat a doc_id are one document with
    several texts: a link of one is a link of all.  Other columns are ignored.
    An empty table gives an empty result.
    """
    signed, links = near_links(docs)
    found = components(links)
    out = signed.join(found, "node", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node", "doc_id"))
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        (F.col("doc_id") == component).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The documents, all columns, less those that near_duplicates does not keep."""
    drop = near_duplicates(docs).where("not kept").select("doc_id").distinct()
    return docs.join(drop, "doc_id", "left_anti")


def op9_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))
