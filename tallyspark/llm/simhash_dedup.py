"""SimHash near-duplicate groups, found with BK-trees over shards of fingerprints.

A document's fingerprint has 64 bits: a bit is 1 if it is set in over half of
the hashes (XXH64, seed 42) of the document's word shingles, repeats included.
Fingerprints link at ``radius`` or fewer differing bits; a group is all that
links reach.

Equal fingerprints are one point from the start. The 64 bits are cut into
``radius + 2`` blocks: two fingerprints within the radius agree on at least
two whole blocks, so every pair of blocks, with its value, names a *shard*,
and each link lies inside one. A shard's points form a BK-tree (children keyed
by the Hamming distance to their parent) and each point looks for neighbours
by following only edges within the radius of its own distance. The trees go
to the queries of their shard through the shuffle: broadcasting all of them
would send something that grows with the corpus to every executor.

A shard of more than ``tree_size`` points is dealt out to several trees; its
points then visit each of them, so a task never holds more than one tree of
that size plus one batch of queries. Each task returns, for every point, a
link to one point of its local group: a forest, never all pairs, with the same
groups. Groups are then joined up over all shards by alternating
large-star and small-star steps on the links, each written to the shared
folder.

Nulls: a null text has no words and fingerprint zero, as has an empty one;
both link like any other. A null ``doc_id`` keeps its row and never names a
group unless no member has one (then the group's id is null). Repeated rows
stay. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from tallyspark.llm.common import map_arrow, map_pandas, stored, utf8

SHINGLE = 3
RADIUS = 2
TREE_SIZE = 4096
_CHUNK = 1 << 16


def simhash(text: bytes, shingle: int = SHINGLE) -> int:
    """Fingerprint of a UTF-8 text."""
    words = text.lower().split()  # on bytes: A-Z, and the six ASCII white-space characters
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    width = min(shingle, len(words))
    starts, ends = starts[: len(words) - width + 1].tolist(), ends[width - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), _CHUNK):
        hashes = np.array([digest(joined[a:b], 42) for a, b in
                           zip(starts[at:at + _CHUNK], ends[at:at + _CHUNK], strict=True)], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(starts)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, keys: tuple = ("doc_id",)) -> DataFrame:
    """The long columns ``keys`` and the fingerprint as a signed long, per row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([simhash(x, shingle) for x in utf8(batch, "text")], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(found.view(np.int64))], [*keys, "fingerprint"])

    return (docs.select(*[F.col(k).cast("long").alias(k) for k in keys], F.col("text").cast("string"))
            .transform(map_arrow, run, ", ".join(f"{k} long" for k in keys) + ", fingerprint long"))


class BKTree:
    """Nodes in flat lists; each node's children by their distance to it."""

    def __init__(self) -> None:
        self.points: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, point: int) -> None:
        at = len(self.points)
        self.points.append(point)
        self.children.append({})
        node = 0
        while at:
            distance = (self.points[node] ^ point).bit_count()
            child = self.children[node].setdefault(distance, at)
            if child == at:
                return
            node = child

    def within(self, point: int, radius: int) -> list[int]:
        found, open_nodes = [], [0] if self.points else []
        while open_nodes:
            node = open_nodes.pop()
            distance = (self.points[node] ^ point).bit_count()
            if distance <= radius:
                found.append(node)
            below = self.children[node]
            if below:
                for edge in range(max(distance - radius, 0), distance + radius + 1):
                    if edge in below:
                        open_nodes.append(below[edge])
        return found


class Shard:
    """One tree and the links found in it. Tree points come first, then any
    number of visitors, of which nothing is kept."""

    def __init__(self, radius: int) -> None:
        self.tree, self.radius = BKTree(), radius
        self.parent: list[int] = []
        self.found: list[tuple[int, int]] = []

    def root(self, node: int) -> int:
        parent = self.parent
        while parent[node] != node:
            parent[node] = parent[parent[node]]
            node = parent[node]
        return node

    def _join(self, nodes: list[int]) -> int:
        roots = {self.root(n) for n in nodes}
        least = min(roots)
        for r in roots:
            self.parent[r] = least
        return least

    def add(self, point: int) -> None:
        near = self.tree.within(point, self.radius)
        self.parent.append(len(self.tree.points))
        self.tree.add(point)
        self._join([*near, len(self.parent) - 1])

    def visit(self, point: int) -> None:
        near = self.tree.within(point, self.radius)
        if near:
            self.found.append((point, self.tree.points[self._join(near)]))

    def close(self) -> list[tuple[int, int]]:
        points = self.tree.points
        return self.found + [(points[n], points[r]) for n in range(len(points))
                             if (r := self.root(n)) != n]


def shard_keys(fingerprint: Column, radius: int) -> Column:
    """An array with one (pair of blocks, their value) key per pair."""
    blocks = radius + 2
    cuts = [64 * i // blocks for i in range(blocks + 1)]

    def value(i: int) -> Column:
        width = cuts[i + 1] - cuts[i]
        return F.shiftrightunsigned(fingerprint, cuts[i]).bitwiseAND(F.lit((1 << width) - 1))

    return F.array(*[
        F.struct(F.lit(k).alias("pair"), value(i).alias("a"), value(j).alias("b"))
        for k, (i, j) in enumerate(combinations(range(blocks), 2))])


def links(points: DataFrame, radius: int = RADIUS, tree_size: int = TREE_SIZE) -> DataFrame:
    """(x, y): links whose connected components are those of all pairs of
    distinct fingerprints (column ``fingerprint``) within the radius."""
    shards = points.select(F.explode(shard_keys(F.col("fingerprint"), radius)).alias("shard"),
                           "fingerprint").select("shard.*", "fingerprint")
    sizes = stored(shards.groupBy("pair", "a", "b").count().where("count > 1")
                   .select("pair", "a", "b", F.ceil(F.col("count") / tree_size).alias("trees")),
                   "shards")
    own = F.pmod(F.xxhash64("fingerprint"), F.col("trees"))
    visits = (shards.join(sizes, ["pair", "a", "b"])
              .select("pair", "a", "b", "fingerprint", own.alias("own"),
                      F.explode(F.sequence(F.lit(0).cast("long"), F.col("trees") - 1)).alias("tree"))
              .select("pair", "a", "b", "tree", "fingerprint",
                      (F.col("own") != F.col("tree")).alias("visitor")))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, shard = None, Shard(radius)
        for pdf in batches:
            found = []
            columns = (pdf[c].tolist() for c in ("pair", "a", "b", "tree", "visitor", "fingerprint"))
            for *at, visitor, point in zip(*columns, strict=True):
                if at != key:
                    found += shard.close()
                    key, shard = at, Shard(radius)
                (shard.visit if visitor else shard.add)(point & (1 << 64) - 1)
            found += shard.found
            shard.found = []
            if found:
                yield _pairs(found)
        if found := shard.close():
            yield _pairs(found)

    keys = ["pair", "a", "b", "tree"]
    return (visits.repartition(*keys).sortWithinPartitions(*keys, "visitor")
            .transform(map_pandas, search, "x long, y long"))


def _pairs(found: list[tuple[int, int]]) -> pd.DataFrame:
    return pd.DataFrame(np.array(found, np.uint64).view(np.int64), columns=["x", "y"])


def components(edges: DataFrame, purpose: str = "groups") -> DataFrame:
    """(x, root): the least node of each node's connected component, for every
    node that has a link. Alternates large-star and small-star until nothing
    changes (logarithmically many rounds); each round is a stored table."""
    def least(e: DataFrame, grouped: str, other: str) -> DataFrame:
        # stored, so that the join with it is of two plain shuffles: a hot node can be split
        return stored(e.groupBy(grouped).agg(F.min(other).alias("m")), purpose)

    edges = stored(edges.where("x <> y").select(
        F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct(), purpose)
    before = None
    while True:
        # large star: neighbours above a node move to the least of its neighbourhood
        both = edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
        low = least(both, "x", "y").withColumn("m", F.least("x", "m"))
        large = (both.join(low, "x").where("y > x").select(F.col("y").alias("x"), F.col("m").alias("y"))
                 .where("x <> y").distinct())
        # small star: a node's lower neighbours, and itself, move to the least of them
        low = least(large, "x", "y")
        small = (large.join(low, "x")
                 .select(F.explode(F.array(F.struct(F.col("x"), F.col("m").alias("y")),
                                           F.struct(F.col("y").alias("x"), F.col("m").alias("y")))
                                   ).alias("e")).select("e.*").where("x <> y").distinct())
        edges = stored(small, purpose)
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))
                          ).first()
        if state == before:
            return edges.withColumnRenamed("y", "root")
        before = state


def _grouped(docs: DataFrame, keys: tuple, shingle: int, radius: int, tree_size: int) -> DataFrame:
    """keys, fingerprint, root (of its group) and the group's least doc_id, per row."""
    prints = stored(fingerprints(docs, shingle, keys), "fingerprints")
    points = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_doc"))
    groups = components(links(points.select("fingerprint"), radius, tree_size))
    linked = stored(
        points.join(groups, points.fingerprint == groups.x, "left")
        .select("fingerprint", "first_doc", F.coalesce("root", "fingerprint").alias("root")), "groups")
    # stored, as in components: a giant group's join can be split
    ids = stored(linked.groupBy("root").agg(F.min("first_doc").alias("component_id")), "group-ids")
    return prints.join(linked.join(ids, "root").select("fingerprint", "root", "component_id"),
                       "fingerprint")


def near_duplicate_groups(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS,
                          tree_size: int = TREE_SIZE) -> DataFrame:
    """(doc_id, fingerprint as 16 hexadecimal digits, component_id) per document."""
    return (_grouped(docs, ("doc_id",), shingle, radius, tree_size)
            .select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
                    "component_id"))


def hashable(schema: StructType, row: str) -> list[Column]:
    """The fields of a struct column, those that hold maps or variants as JSON
    text: nothing else hashes them."""
    def plain(kind: DataType) -> bool:
        if isinstance(kind, (MapType, VariantType)):
            return False
        if isinstance(kind, ArrayType):
            return plain(kind.elementType)
        return not isinstance(kind, StructType) or all(plain(f.dataType) for f in kind.fields)

    # by position: names may repeat but for their case, or hold dots
    names = [f"`{f.name.replace('`', '``')}`" for f in schema.fields]
    return [F.col(f"{row}.{n}") if plain(f.dataType) else F.to_json(F.struct(F.col(f"{row}.{n}").alias("x")))
            for n, f in zip(names, schema.fields, strict=True)]


def one_per_group(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS,
                  tree_size: int = TREE_SIZE) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each group the row with
    the least ``doc_id`` stays (of rows that share it, one; null ids come last)."""
    marked = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                         F.col("text").cast("string").alias("text"))
    marked = marked.withColumn("mark", F.xxhash64(*hashable(docs.schema, "row"))).withColumn(
        "place", F.coalesce("doc_id", F.lit((1 << 63) - 1)))
    winners = (_grouped(marked, ("doc_id", "mark"), shingle, radius, tree_size)
               .groupBy("root").agg(F.min(F.struct(
                   F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("place"), "mark")).alias("w"))
               .select("w.place", "w.mark"))
    return (marked.join(winners, ["place", "mark"], "left_semi").dropDuplicates(["place", "mark"])
            .select("row.*"))
