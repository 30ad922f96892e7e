"""SimHash near-duplicates found by Golay-code fuzzy hashing.

A fingerprint of 64 bits is read as segments of 23, 23 and 18 bits.  If two
fingerprints differ in at most 3 bits, then either one segment is equal and
another differs in at most one bit, or each of the three differs in one bit
(pigeonhole on the segment errors).  Every 23-bit word decodes to one codeword
of the perfect binary Golay code; a word y with d(x, y) <= 1 decodes to a
codeword within distance 4 of x, and x has at most six of these.  So each
fingerprint is indexed under a whole segment with every nearby codeword of
another (at most 36 keys of 30 to 35 bits) and under every nearby codeword of
all three (at most 216 keys of 36 bits), and probes with the seven keys it
decodes to: every pair within 3 bits meets, and is verified exactly by counting
the differing bits.

Equal fingerprints are grouped before anything is joined, so a group of exact
copies costs one row.  Links become classes by ``components.connected``.

``near_classes`` takes documents whose sets of five-word shingles have a Jaccard
similarity of 0.8 or more.  Their fingerprints differ in some 10 bits of 64, up
to 16, which no affordable number of Golay keys covers; so beside the links of
the fingerprints it takes as candidates the documents that share one of their
``SMALLEST`` smallest shingle hashes, each with the first one of its keys.  These
links make the first classes.  What they leave out is found exactly: in any
order of shingles that all documents share, similar sets share one of their
first ones, a fifth of the set (``prefix``).  Documents of different classes are
paired there, by keys of few documents first; documents with a key of many have
such keys put last in the order and meet again by what then stands in front.
Every candidate is verified by the exact similarity.

Defined results: a null or empty text has fingerprint zero and is linked like
any other; rows with equal ids are fingerprinted one by one; other columns
aren't read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache, partial, reduce
from itertools import combinations, permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, release, small_batches, table, written
from .components import connected

#: Generator polynomial of the binary Golay code (23, 12).
GENERATOR = 0b110001110101
#: Lengths of the segments, from the low end of the fingerprint.
SEGMENTS = ((0, 23), (23, 23), (46, 18))
#: Ids up to this number are broadcast (8 bytes each), more are shuffled.
BROADCAST_IDS = 1_000_000
#: Smallest shingle hashes by which documents of similar shingles meet.
SMALLEST = 6
#: Documents of a key that are paired before the key is put last in the order.
GROUP = 32
#: Orders of shingles tried; in the last one keys of any size are paired.
ORDERS = 4
#: Parts in which shingle sets are put in a new order, one after the other, and
#: the number of sets from which this is done.
PARTS, MANY_SETS = 4, 5_000
#: Shingles whose bits are counted at a time.
CHUNK = 1 << 15


def shingle_hashes(text: str | None, shingle: int, seed: int = 42) -> tuple[bytes, np.ndarray]:
    """The words of a whole text, joined, and the hashes of its shingles, repeats
    included; none for a text without words."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    whole = b" ".join(words)
    if not words:
        return whole, np.zeros(0, np.uint64)
    n = max(1, len(words) - shingle + 1)
    parts = map(b" ".join, zip(*[words[k:] for k in range(shingle)], strict=False)) if len(words) >= shingle else [whole]
    return whole, np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=seed), parts), np.uint64, n)


def fingerprint_of(h: np.ndarray) -> int:
    """The unsigned 64-bit fingerprint: the bits set in over half the hashes."""
    ones = np.zeros(64, np.int64)
    for k in range(0, len(h), CHUNK):
        bits = np.unpackbits(h[k : k + CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h), bitorder="little").tobytes(), "little")


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    return fingerprint_of(shingle_hashes(text, shingle, seed)[1])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """Every row's id and fingerprint, as a signed long of the same 64 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = np.array([fingerprint(t, shingle) for t in b.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got.view(np.int64))], names=["doc_id", "fp"])

    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long")


@cache
def _errors() -> np.ndarray:
    """For each syndrome the error patterns of at most 4 bits that lead to a
    codeword: first the one of at most 3 bits, then, if it has 3, the five of
    4 bits; -1 fills up."""
    bit = np.zeros(23, np.int64)
    for k in range(23):
        x = 1 << k
        for j in range(22, 10, -1):
            if x >> j & 1:
                x ^= GENERATOR << (j - 11)
        bit[k] = x
    found: list[list[int]] = [[] for _ in range(1 << 11)]
    for weight in range(5):
        for places in combinations(range(23), weight):
            syndrome = int(np.bitwise_xor.reduce(bit[list(places)])) if places else 0
            if weight < 4 or bin(found[syndrome][0]).count("1") == 3:
                found[syndrome].append(sum(1 << p for p in places))
    out = np.full((1 << 11, 6), -1, np.int64)
    for s, patterns in enumerate(found):
        out[s, : len(patterns)] = patterns
    return out


@cache
def _syndromes() -> np.ndarray:
    """The syndrome of every 23-bit word."""
    out = np.zeros(1, np.int16)
    for k in range(23):
        x = 1 << k
        for j in range(22, 10, -1):
            if x >> j & 1:
                x ^= GENERATOR << (j - 11)
        out = np.concatenate([out, out ^ np.int16(x)])
    return out


def _nearby(words: np.ndarray) -> np.ndarray:
    """The 12-bit indices of the codewords within distance 4 of each word, the
    decoded one first; -1 fills up."""
    errors = _errors()[_syndromes()[words]]
    return np.where(errors < 0, -1, (words[:, None] ^ errors) >> 11)


def golay_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(probe keys of each fingerprint, index keys, row of each index key)."""
    u = fp.view(np.uint64)
    words = [((u >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
    near = [_nearby(w) for w in words]
    probes, keys, rows = [], [], []

    def add(kind: int, all_keys: np.ndarray, there: np.ndarray) -> None:
        all_keys, there = (all_keys | kind << 36).reshape(len(fp), -1), there.reshape(len(fp), -1)
        probes.append(all_keys[:, 0])
        keys.append(all_keys[there])
        rows.append(np.nonzero(there)[0])

    for kind, (i, j) in enumerate(permutations(range(3), 2)):
        add(kind, words[i][:, None] << 12 | near[j], near[j] >= 0)
    a, b, c = near[0][:, :, None, None], near[1][:, None, :, None], near[2][:, None, None, :]
    add(6, a << 24 | b << 12 | c, (a >= 0) & (b >= 0) & (c >= 0))
    return np.stack(probes, 1), np.concatenate(keys), np.concatenate(rows)


def _keyed(fps: DataFrame, index: bool) -> DataFrame:
    name = "x" if index else "y"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            all_fp = b.column(0).to_numpy(zero_copy_only=False)
            for k in range(0, len(all_fp), 1024):
                fp = np.ascontiguousarray(all_fp[k : k + 1024])
                probes, keys, rows = golay_keys(fp)
                if not index:
                    keys, rows = probes.ravel(), np.repeat(np.arange(len(fp)), probes.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fp[rows])], names=["key", name])

    return fps.select("fp").mapInArrow(run, f"key long, {name} long")


def links(fps: DataFrame, radius: int = 3) -> DataFrame:
    """Pairs a < b of distinct fingerprints that differ in 1 to ``radius`` bits."""
    if not 0 <= radius <= 3:
        raise ValueError("three segments prove a radius of 3 at most")
    near = (F.col("x") < F.col("y")) & (F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= radius)
    met = _keyed(fps, True).join(_keyed(fps, False).hint("merge"), "key").filter(near)
    return met.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()


def classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """Every row's id, fp and component_id, the smallest id of its class."""
    fps = written(fingerprints(df, id_col, text_col, shingle), "fingerprints")
    distinct = written(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    roots = connected(links(distinct)).withColumnRenamed("node", "fp")
    rooted = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of_fp = rooted.select("fp", "root").join(least, "root").select("fp", "component_id")
    return fps.join(of_fp, "fp").select("doc_id", "fp", "component_id")


def _small(ids: DataFrame) -> DataFrame:
    """A table of ids, broadcast if it is small, else joined by a shuffle."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def prefix(size: int, similarity: float) -> int:
    """How many members of a set, first ones in an order that all sets share, hold
    one of those of any other set of at least that similarity."""
    return size - math.ceil(similarity * size - 1e-9) + 1 if size else 0


def sketches(df: DataFrame, id_col: str, text_col: str, shingle: int, similarity: float) -> DataFrame:
    """doc_id, node (hash of the words, equal for exact copies), fp, size (number of
    distinct shingle hashes) and keys (the ``prefix`` of these, smallest first) of
    every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in batches:
            node, fp, size, keys = [], [], [], []
            for text in b.column(1):
                whole, h = shingle_hashes(text.as_py(), shingle)
                node.append(xxhash.xxh64_intdigest(whole))
                fp.append(fingerprint_of(h))
                own = np.unique(h)
                size.append(len(own))
                keys.append(own[: prefix(len(own), similarity)].view(np.int64))
            signed = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), signed(node), signed(fp), pa.array(size, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "node", "fp", "size", "keys"])
            release()

    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, node long, fp long, size long, keys array<long>")


def shingle_sets(df: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """node and its distinct shingle hashes, of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for whole in batches:
            for at in range(0, whole.num_rows, 64):  # bounds the lists held at a time
                b = whole.slice(at, 64)
                got = [shingle_hashes(t.as_py(), shingle) for t in b.column(0)]
                node = np.array([xxhash.xxh64_intdigest(w) for w, _ in got], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array([np.unique(h).view(np.int64) for _, h in got], pa.list_(pa.int64()))], names=["node", "shingles"])
            release()

    return df.select(F.col(text_col).alias("text")).mapInArrow(run, "node long, shingles array<long>")


def _sets(df: DataFrame, nodes: DataFrame, wanted: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """The shingle sets of the nodes in ``wanted``, from one document each.  Where
    ids aren't repeated, these are the sets of the documents read, so nothing
    moves them."""
    first = written(wanted.distinct().join(nodes.select("node", "first"), "node").select("node", F.col("first").alias("_first")), "first-documents")
    texts = df.join(_small(first.select("_first").distinct()), df[id_col] == F.col("_first"), "left_semi")
    with small_batches(df.sparkSession):
        sets = written(shingle_sets(texts, id_col, text_col, shingle), "shingle-sets", dictionary=False)
    if sets.count() != first.count():  # of repeated ids
        every = sets
        sets = written(every.join(_small(first.select("node")), "node", "left_semi").dropDuplicates(["node"]), "shingle-sets", dictionary=False)
        dropped(every)
    dropped(first)
    return sets


def _similar(df: DataFrame, nodes: DataFrame, pairs: DataFrame, id_col: str, text_col: str, shingle: int, similarity: float) -> DataFrame:
    """The pairs a, b of at least that Jaccard similarity."""
    sets = _sets(df, nodes, pairs.select(F.explode(F.array("a", "b")).alias("node")), id_col, text_col, shingle)
    both = pairs.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
    common = F.size(F.array_intersect("set_a", "set_b"))
    # A quotient, since 0.8 times a number may be rounded up.
    out = written(both.filter(common / (F.size("set_a") + F.size("set_b") - common) >= F.lit(similarity)).select("a", "b"), "similar", dictionary=False)
    dropped(sets)
    return out


def _across(keyed: DataFrame, similarity: float) -> DataFrame:
    """Pairs a < b of nodes of different classes that can be of that similarity by
    their sizes and the keys they share.  A key's largest class is left out on one
    side, so no class meets itself there."""
    by_class = keyed.groupBy("key", "root").agg(F.count("*").alias("n"))
    largest = by_class.groupBy("key").agg(F.max_by("root", F.struct("n", "root")).alias("largest"))
    x = keyed.join(largest, "key").filter("root != largest").toDF("key", "node_x", "root_x", "size_x", "front_x", "largest")
    y = keyed.toDF("key", "node_y", "root_y", "size_y", "front_y")
    met = x.join(y.hint("merge"), "key").filter("root_x != root_y and (root_y = largest or node_x < node_y)")
    met = met.filter(F.least("size_x", "size_y") >= F.lit(similarity - 1e-9) * F.greatest("size_x", "size_y"))
    # What is common but not in both prefixes stands behind that which ends first.
    behind = F.greatest(F.col("size_x") - F.col("front_x"), F.col("size_y") - F.col("front_y"))
    least = F.lit(similarity / (1 + similarity)) * (F.col("size_x") + F.col("size_y")) - behind
    pairs = met.groupBy(F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b")).agg(F.count("*").alias("n"), F.first(least).alias("least"))
    return pairs.filter(F.col("n") >= F.col("least") - 1e-6).select("a", "b")


def _put_last(rooted: DataFrame, sets: DataFrame, holders: DataFrame, hot: DataFrame, similarity: float) -> list[DataFrame]:
    """The holders' prefixes in the order that has the hot keys last.  Only their
    sets are in the shuffle, of many a part at a time."""
    parts = PARTS if holders.count() >= MANY_SETS else 1
    holders, hot, out = _small(holders), _small(hot), []
    for k in range(parts):
        some = sets.filter(F.pmod(F.xxhash64("node"), F.lit(parts)) == k).join(holders, "node", "left_semi")
        last = some.select("node", F.explode("shingles").alias("key")).join(hot, "key", "left_semi")
        last = last.groupBy("node").agg(F.sort_array(F.collect_list("key")).alias("_last"))
        order = F.concat(F.array_except("shingles", "_last"), "_last")
        front = F.slice(order, F.lit(1), (F.col("size") - F.ceil(F.lit(similarity) * F.col("size") - 1e-9) + 1).cast("int"))
        out.append(written(rooted.select("node", "root", "size").join(last, "node").join(some, "node").select("node", "root", "size", front.alias("keys")), "prefixes", dictionary=False))
    return out


def _left_out(df: DataFrame, rooted: DataFrame, id_col: str, text_col: str, shingle: int, similarity: float) -> list[DataFrame]:
    """All pairs of at least that similarity between different classes.  rooted:
    node, root, first, size and keys.  A pair that shares a frequent key meets in a
    later order, so what others it shares needn't suffice in this one."""
    found: list[DataFrame] = []
    parts: list[DataFrame] = []
    rest, hot, sets = rooted, None, None
    for k in range(ORDERS):
        keyed = rest.select(F.explode("keys").alias("key"), "node", "root", "size", F.size("keys").alias("front"))
        several = written(keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "repeated-keys", dictionary=False)
        last = k == ORDERS - 1
        few = several if last else several.filter(F.col("n") <= GROUP)
        met = written(keyed.join(_small(few.select("key")), "key", "left_semi"), "shared-prefixes", dictionary=False)
        pairs = written(_across(met, similarity), "candidates-across", dictionary=False)
        dropped(met)
        if not pairs.isEmpty():
            found.append(_similar(df, rooted, pairs, id_col, text_col, shingle, similarity))
        dropped(pairs)
        many = keyed.join(_small(several.filter(F.col("n") > GROUP).select("key")), "key", "left_semi")
        many = many.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most")).filter("least < most")
        many = written(many.select("key"), "frequent-keys", dictionary=False)
        dropped(several)
        if last or many.isEmpty():
            break
        hot = many if hot is None else hot.unionByName(many)
        holders = written(keyed.join(_small(many), "key", "left_semi").select("node").distinct(), "holders-of-frequent-keys", dictionary=False)
        if sets is None:
            sets = _sets(df, rooted, holders, id_col, text_col, shingle)
        for part in parts:
            dropped(part)
        parts = _put_last(rooted, sets, holders, hot, similarity)
        dropped(holders)
        rest = reduce(DataFrame.unionByName, parts)
    for part in parts:
        dropped(part)
    if sets is not None:
        dropped(sets)
    return found


def near_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """Every row's id, node and component_id, the smallest id of its class."""
    if not 0 < similarity <= 1:
        raise ValueError("the similarity must be above 0 and at most 1")
    with small_batches(df.sparkSession):
        rows = written(sketches(df, id_col, text_col, shingle, similarity), "sketches", dictionary=False)
    nodes = written(rows.groupBy("node").agg(F.min("doc_id").alias("first"), *[F.first(c).alias(c) for c in ("fp", "size", "keys")]), "sketch-nodes", dictionary=False)
    ids = written(rows.select("doc_id", "node"), "sketched-ids", dictionary=False)
    dropped(rows)
    hubs = nodes.groupBy("fp").agg(F.min("node").alias("hub"))
    equal = nodes.join(hubs, "fp").select(F.col("hub").alias("a"), F.col("node").alias("b"))
    met = links(hubs.select("fp"))
    close = met.join(hubs.toDF("a", "hub_a"), "a").join(hubs.toDF("b", "hub_b"), "b").select(F.col("hub_a").alias("a"), F.col("hub_b").alias("b"))
    keyed = nodes.select("node", F.explode(F.slice("keys", 1, SMALLEST)).alias("key"))
    least = keyed.groupBy("key").agg(F.min("node").alias("a"))
    shared = keyed.join(least, "key").select("a", F.col("node").alias("b"))
    pairs = written(equal.unionByName(close).unionByName(shared).filter("a != b").distinct(), "candidates")

    def classed(some: DataFrame, edges: DataFrame) -> DataFrame:
        return some.join(connected(edges), "node", "left").withColumn("root", F.coalesce("root", "node"))

    near = _similar(df, nodes, pairs, id_col, text_col, shingle, similarity)
    rooted = written(classed(nodes, near), "first-classes", dictionary=False)
    for t in (nodes, pairs, near):
        dropped(t)
    more = _left_out(df, rooted, id_col, text_col, shingle, similarity)
    final = rooted.select("node", "first", "root")
    if more:
        edges = rooted.select(F.col("root").alias("a"), F.col("node").alias("b"))
        final = classed(rooted.select("node", "first"), reduce(DataFrame.unionByName, more, edges))
    least = final.groupBy("root").agg(F.min("first").alias("component_id"))
    out = written(ids.join(final.join(least, "root").select("node", "component_id"), "node").select("doc_id", "node", "component_id"), "near-classes", dictionary=False)
    for t in (ids, rooted, *more):
        dropped(t)
    return out


def filter_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of ``df`` whose id is the smallest of their near class, with all
    their columns.  Rows equal in id and text are one row; of rows with equal ids
    and different texts each that is the smallest stays; rows with a null id stay."""
    known = df.filter(F.col(id_col).isNotNull())
    of_row = near_classes(known, id_col, text_col, shingle, similarity)
    by_id = written(of_row.groupBy("doc_id").agg(F.max(F.col("doc_id") == F.col("component_id")).alias("stays"), F.count("*").alias("n")), "kept-ids")
    # Few ids go or are repeated, so these are what the texts are joined with.
    gone, again = (_small(by_id.filter(c).select(F.col("doc_id").alias("_id"))) for c in ("not stays", "stays and n > 1"))
    mine = lambda ids: df[id_col] == ids["_id"]
    once = known.join(gone, mine(gone), "left_anti").join(again, mine(again), "left_anti")
    repeated = known.join(again, mine(again), "left_semi").dropDuplicates([id_col, text_col])
    return once.unionByName(repeated).unionByName(df.filter(F.col(id_col).isNull()))


def op10_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    got = classes(table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
