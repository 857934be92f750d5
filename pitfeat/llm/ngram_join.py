"""Similarity join on word n-grams through prefix trees.

Two texts are linked when the Jaccard similarity of their sets of five-word
shingles is at least 0.8. Only texts with a common shingle in their prefixes can
be: in a global order of shingles, rare ones first, the prefix of a set of n has
n - ceil(0.8 n) + 1 shingles.

1. Texts with equal sets form a class; one text stands for it from then on.
2. Prefix shingles lead to blocks. The classes with a prefix shingle, in order of
   size, are cut where sizes are too far apart for any link across; the first
   class of a part is its pivot. A block holds all classes that share such a part
   with one pivot, so two classes that can be linked meet in a block. Shingles in
   the bounded table of frequent ones get their pivot from a partial minimum and
   a broadcast, all others by a sort; no pairs within a shingle are formed.
3. A task stores the sets of a block in a prefix tree, most shared shingles
   first. A probe walks down the tree, adding up the overlap with shared parts
   once for all sets below, and leaves subtrees whose sets are too long, too
   short, or cannot reach the overlap with what remains of them or of the probe.
   Once sets are connected, all but those outside the largest component are
   spared. Tasks give out spanning links, never all pairs.
4. Blocks above a total size are cut into chunks. Links across chunks are looked
   for from the classes outside the block's largest component against every
   chunk, so a huge family of copies costs one round and a remainder.
5. Components of the links, and of classes, give the result.

Sets hold 64-bit hashes of shingles. The frequent table comes from a hashed
share of the texts; it changes the order, hence the work, but never a link.

Defined cases: a null or wordless text has 0 shingles and is its own component.
Fewer than five words make one shingle. Repeated rows are in one component. A
null id never becomes the smallest id unless the component has no other. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitfeat.checkpoints import cut_lineage
from pitfeat.llm.common import handing_back, most_frequent, sized_partitions, to_table
from pitfeat.llm.components import connected

N = 5
#: most shingles in the table of frequent ones (800 KB), the share of texts it is
#: taken from, and the count there from which a shingle is frequent
FREQUENT, FREQUENT_SHARE, FREQUENT_FROM = 100_000, 16, 2
#: shingles that a task compares at a time
BLOCK_SHINGLES = 2_000_000
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
                np.uint64)


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes of a text. ``bytes.split`` cuts at exactly
    the six ASCII spaces, ``bytes.lower`` changes A-Z only."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < N:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(words) - N + 1
    s = np.zeros(n, np.uint64)
    for k in range(N):
        s += h[k:k + n] * _MIX[k]
        s ^= s >> np.uint64(29)
        s *= _MIX[1]
    s ^= s >> np.uint64(32)
    return np.unique(s)


def prefix(s: np.ndarray, frequent: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """First shingles of a set in the global order: by hash, then frequent ones by rank."""
    n = len(s)
    if n < 2:
        return s[:0]  # a set of one is linked with its own class only
    size = n - (4 * n + 4) // 5 + 1
    if len(frequent):
        at = np.searchsorted(frequent, s)
        at[at == len(frequent)] = 0
        common = frequent[at] == s
        if common.any():
            late = s[common][np.argsort(rank[at[common]], kind="stable")]
            s = np.concatenate((s[~common], late))
    return s[:size]


class PrefixTree:
    """Sets of ranks in a trie whose chains are merged into segments.

    Nodes lie in arrays; a node has a segment of ranks, its parent, the smallest
    and largest full size of the sets below and the most ranks any of them has
    after the segment.
    """

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray):
        order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u4").tobytes())
        self.ranks, seg, parent, members = [], [], [], defaultdict(list)
        self.children: dict[int, list[int]] = defaultdict(list)
        # depth-first: the stack holds (node, depth where its segment ends)
        stack: list[tuple[int, int]] = []
        low, high, longest, begin = [], [], [], []

        def new(up: int, a: np.ndarray, at: int, end: int) -> int:
            node = len(parent)
            parent.append(up)
            seg.append(a[at:end])
            begin.append(at)
            return node

        root = new(-1, np.empty(0, np.uint32), 0, 0)
        stack.append((root, 0))
        last = np.empty(0, np.uint32)
        for i in order:
            a = sets[i]
            m = min(len(a), len(last))
            differ = np.flatnonzero(a[:m] != last[:m])
            shared = int(differ[0]) if len(differ) else m
            below = None
            while stack[-1][1] > shared:
                below = stack.pop()
            top, end = stack[-1]
            if below is not None and end < shared:
                # cut the segment of ``below`` where the new set leaves it
                node = below[0]
                upper = new(top, seg[node], 0, shared - end)
                begin[upper] = end
                seg[node] = seg[node][shared - end:]
                begin[node] = shared
                parent[node] = upper
                stack.append((upper, shared))
                top = upper
            if len(a) > shared:
                leaf = new(top, a, shared, len(a))
                stack.append((leaf, len(a)))
                top = leaf
            members[top].append(i)
            last = a
        count = len(parent)
        self.parent, self.members, self.sizes = parent, members, sizes
        low, high = np.full(count, 1 << 40), np.zeros(count, np.int64)
        deepest = np.zeros(count, np.int64)
        ends = [b + len(s) for b, s in zip(begin, seg)]
        for node, own in members.items():
            low[node], high[node] = min(sizes[i] for i in own), max(sizes[i] for i in own)
            deepest[node] = ends[node]
        for node in range(count):
            if parent[node] >= 0:
                self.children[parent[node]].append(node)
        for node in self._bottom_up():
            up = parent[node]
            if up >= 0:
                low[up], high[up] = min(low[up], low[node]), max(high[up], high[node])
                deepest[up] = max(deepest[up], deepest[node])
        self.low, self.high, self.rest = low, high, deepest - np.array(ends)
        self.seg = seg
        self.last = np.array([int(s[-1]) if len(s) else -1 for s in seg])
        self.start = np.concatenate(([0], np.cumsum([len(s) for s in seg])))
        self.flat = np.concatenate(seg) if seg else np.empty(0, np.uint32)

    def _bottom_up(self) -> list[int]:
        order, frontier = [], [0]
        while frontier:
            order += frontier
            frontier = [c for n in frontier for c in self.children[n]]
        return order[::-1]

    def similar(self, x: np.ndarray, size: int, mask: np.ndarray) -> list[int]:
        """Sets with similarity to x of 0.8 or more; ``mask`` is all False."""
        mask[x] = True
        # how many of x's ranks lie beyond a rank
        found, nodes, overlap = [], np.array([0]), np.array([0])
        while len(nodes):
            own = [i for n in nodes.tolist() for i in self.members.get(n, ())]
            if own:
                total = np.repeat(overlap, [len(self.members.get(n, ())) for n in nodes.tolist()])
                fits = 9 * total >= 4 * (size + self.sizes[own])
                found += [i for i, ok in zip(own, fits) if ok]
            kids = [self.children[n] for n in nodes.tolist()]
            after = np.array([c for k in kids for c in k], np.int64)
            if not len(after):
                break
            above = np.repeat(overlap, [len(k) for k in kids])
            lengths = self.start[after + 1] - self.start[after]
            place = np.repeat(self.start[after] - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
            hits = mask[self.flat[place + np.arange(lengths.sum())]]
            sums = np.add.reduceat(hits, np.concatenate(([0], np.cumsum(lengths)[:-1])), dtype=np.int64)
            now = above + sums
            remaining = len(x) - np.searchsorted(x, self.last[after], side="right")
            most = now + np.minimum(remaining, self.rest[after])
            alive = (9 * most >= 4 * (size + self.low[after])) & (5 * self.high[after] >= 4 * size) & (
                4 * self.low[after] <= 5 * size)
            nodes, overlap = after[alive], now[alive]
        mask[x] = False
        return found


def spanning_links(sets: list[np.ndarray], probes: list[int] | None = None) -> list[tuple[int, int]]:
    """Links that connect all sets similar to one another.

    Without ``probes``, every pair counts, and a set is spared once it is in the
    largest component and has not been asked yet. With ``probes``, only pairs
    with one of them count.
    """
    if len(sets) < 2:
        return []
    sizes = np.array([len(s) for s in sets])
    every, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    place = np.empty(len(every), np.uint32)
    place[np.argsort(-counts, kind="stable")] = np.arange(len(every), dtype=np.uint32)
    shared = counts[inverse] > 1
    cuts, ranked, at = np.cumsum(sizes), [], 0
    for end in cuts.tolist():
        own = place[inverse[at:end][shared[at:end]]]
        own.sort()
        ranked.append(own)
        at = end
    tree, mask = PrefixTree(ranked, sizes), np.zeros(len(every), bool)
    parent, weight, links = list(range(len(sets))), [1] * len(sets), []

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    largest = 0

    def probe(i: int):
        nonlocal largest
        for j in tree.similar(ranked[i], int(sizes[i]), mask):
            a, b = find(i), find(j)
            if a != b:
                if weight[a] < weight[b]:
                    a, b = b, a
                parent[b] = a
                weight[a] += weight[b]
                links.append((i, j))
                if weight[a] > weight[find(largest)]:
                    largest = a

    if probes is not None:
        for i in probes:
            probe(i)
        return links
    asked = [False] * len(sets)
    waiting = list(range(len(sets)))
    while waiting:
        spared = []
        for i in waiting:
            if weight[find(i)] > 1 and find(i) == find(largest):
                spared.append(i)
            else:
                asked[i] = True
                probe(i)
        # the largest component may have changed: then those spared for another are asked
        waiting = [i for i in spared if find(i) != find(largest)]
    return links


# ---- the join

def _frequent(texts: DataFrame, share: int, most: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles of a share of the texts, sorted, and their rank by count."""
    def run(batches):
        for b in batches:
            for t in b.column("_text"):
                yield pa.RecordBatch.from_arrays([pa.array(shingles(t.as_py()).view(np.int64))], ["s"])

    part = texts.where(F.pmod(F.xxhash64("_text"), F.lit(share)) == 0).select("_text")
    often = part.mapInArrow(run, "s long").groupBy("s").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    rows = to_table(most_frequent(cut_lineage(often), "n", most), [("n", "descending"), ("s", "ascending")])
    s = rows["s"].to_numpy().astype(np.int64).view(np.uint64)
    rank = np.arange(len(s), 0, -1)
    order = np.argsort(s)
    return s[order], rank[order]


def _sets(docs: DataFrame, frequent, kind: str) -> DataFrame:
    """doc_id, key, n, digest, v of every row, and the prefix once per class and task."""
    def run(batches):
        table, rank = frequent.value
        seen: set[bytes] = set()
        for b in batches:
            n, digests, short, prefixes = [], [], [], []
            for t in b.column("_text"):
                s = shingles(t.as_py())
                d = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                n.append(len(s))
                digests.append(d)
                short.append(int.from_bytes(d[:8], "little", signed=True))
                if d in seen or len(s) < 2:
                    prefixes.append(None)
                else:
                    seen.add(d)
                    prefixes.append(prefix(s, table, rank).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("key"), pa.array(n, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(short, pa.int64()), pa.array(prefixes, pa.list_(pa.int64()))],
                ["doc_id", "key", "n", "digest", "v", "prefix"])

    return docs.mapInArrow(handing_back(run), f"doc_id {kind}, key binary, n long, digest binary, v long, prefix array<long>")


def _blocks(sets: DataFrame, frequent: np.ndarray) -> DataFrame:
    """Distinct (p, v): pivot, and a class that shares a prefix shingle with it."""
    spark = sets.sparkSession
    rows = sets.where(F.col("prefix").isNotNull()).select("v", "n", F.explode("prefix").alias("s"))
    common = spark.createDataFrame(
        pa.table({"s": frequent.view(np.int64)}).to_pandas(), "s long") if len(frequent) else None

    def pivots(batches):
        """Runs of one shingle, sorted by size: the first class of a run is its pivot.

        A run also ends where the next size is too large to be linked with any
        before it, so what follows cannot be linked with what came.
        """
        shingle, pivot, size, last, pivot_size = None, 0, 0, None, 0
        for b in batches:
            s, v, n = (b.column(c).to_numpy() for c in ("s", "v", "n"))
            if not len(s):
                continue
            # the same class may come from several tasks
            fresh = np.concatenate(([s[0] != shingle or v[0] != last], (s[1:] != s[:-1]) | (v[1:] != v[:-1])))
            s, v, n = s[fresh], v[fresh], n[fresh]
            if not len(s):
                continue
            before = np.concatenate(([size], n[:-1]))
            first = np.concatenate(([s[0] != shingle], s[1:] != s[:-1])) | (4 * n > 5 * before)
            at = np.maximum.accumulate(np.where(first, np.arange(len(s)), -1))
            inside, of = at >= 0, np.maximum(at, 0)
            p, np_ = np.where(inside, v[of], pivot), np.where(inside, n[of], pivot_size)
            # parts of exactly two that lie inside the batch
            begin = np.flatnonzero(first)
            pair = begin[:-1][np.diff(begin) == 2] + 1
            two = np.zeros(len(s), bool)
            two[pair] = True
            shingle, pivot, size, last, pivot_size = s[-1], p[-1], n[-1], v[-1], np_[-1]
            keep = p != v
            yield pa.RecordBatch.from_arrays(
                [pa.array(p[keep]), pa.array(v[keep]), pa.array(np_[keep]), pa.array(n[keep]), pa.array(two[keep])],
                ["p", "v", "np", "nv", "two"])

    rare = rows if common is None else rows.join(F.broadcast(common), "s", "left_anti")
    dealt = rare.repartition(sized_partitions(sets), "s").sortWithinPartitions("s", "n", "v")
    met = dealt.mapInArrow(pivots, "p long, v long, np long, nv long, two boolean")
    counted = met.groupBy("p", "v").agg(
        F.count("*").alias("c"), F.min("two").alias("two"), F.max("np").alias("np"), F.max("nv").alias("nv"))
    # two classes that meet in parts of their own only have met c times: of the set whose
    # prefix ends first, at most c of the prefix and all the rest can be shared
    rest = lambda n: F.floor((4 * F.col(n) + 4) / 5) - 1
    needed = F.ceil(4 * (F.col("np") + F.col("nv")) / 9) - F.greatest(rest("np"), rest("nv"))
    pairs = counted.where(~F.col("two") | (F.col("c") >= needed)).select("p", "v")
    if common is not None:
        hot = rows.join(F.broadcast(common), "s")
        first = hot.groupBy("s").agg(F.min("v").alias("p"))
        pairs = pairs.unionByName(
            hot.join(F.broadcast(first), "s").where("p <> v").select("p", "v"))
    return pairs.distinct()


def _members(pairs: DataFrame, sets: DataFrame, most: int) -> DataFrame:
    """p, chunk, chunks, digest, doc_id, key, n: the classes of each block."""
    pairs = cut_lineage(pairs)
    blocks = pairs.unionByName(pairs.select("p", F.col("p").alias("v")).distinct())
    stand = sets.where("n > 1").groupBy("digest", "v").agg(
        F.min(F.struct("doc_id", "key")).alias("_r"), F.max("n").alias("n")).select(
        "digest", "v", "_r.doc_id", "_r.key", "n")
    named = cut_lineage(blocks.join(stand, "v"))
    sums = named.groupBy("p").agg(F.ceil(F.sum("n") / F.lit(most)).cast("int").alias("chunks"))
    cut = named.join(sums, "p")
    own = cut.withColumn("chunk", F.pmod(F.xxhash64("digest"), F.col("chunks")).cast("int"))
    # the pivot is in every chunk, which ties the parts of a family together
    pivots = cut.where("v = p and chunks > 1").withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return own.unionByName(pivots).distinct()


def _compare(rows: DataFrame, docs: DataFrame, by: list[str]) -> DataFrame:
    """Links (a, b: digests) inside the groups; ``probe`` marks sets to ask for, null asks all."""
    texts = docs.select(F.col("doc_id").alias("_d"), F.col("key").alias("_k"), "_text")
    full = rows.join(texts, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("key") == F.col("_k"))).select(
        *by, "digest", "probe", "_text")

    def run(batches):
        def links(group: dict[bytes, tuple[bool | None, np.ndarray]]):
            names = list(group)
            probes = [i for i, d in enumerate(names) if group[d][0]]
            ask = None if any(group[d][0] is None for d in names) else probes
            sets = [group[d][1] for d in names]
            group.clear()
            found = spanning_links(sets, ask)
            return [(names[i], names[j]) for i, j in found]

        at, group = None, {}
        for b in batches:
            out, keys = [], list(zip(*[b.column(c).to_pylist() for c in by]))
            for i, key in enumerate(keys):
                if key != at:
                    out += links(group)
                    at, group = key, {}
                d = b.column("digest")[i].as_py()
                probe = b.column("probe")[i].as_py()
                if d not in group or probe:
                    group[d] = (probe, shingles(b.column("_text")[i].as_py()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in out], pa.binary()), pa.array([y for _, y in out], pa.binary())], ["a", "b"])
        out = links(group)
        yield pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in out], pa.binary()), pa.array([y for _, y in out], pa.binary())], ["a", "b"])

    dealt = full.repartition(sized_partitions(rows), *by).sortWithinPartitions(*by)
    return dealt.mapInArrow(handing_back(run), "a binary, b binary")


def _across(members: DataFrame, roots: DataFrame, docs: DataFrame) -> DataFrame:
    """Links between chunks of one block, from outside its largest component."""
    big = members.where("chunks > 1").select("p", "chunk", "digest", "doc_id", "key", "n").join(
        roots.select(F.col("node").alias("digest"), "root"), "digest", "left").withColumn(
        "root", F.coalesce("root", "digest"))
    big = cut_lineage(big)
    sizes = big.groupBy("p", "root").agg(F.count_distinct("digest").alias("c"))
    largest = sizes.groupBy("p").agg(F.max(F.struct("c", "root")).alias("_m")).select("p", "_m.root")
    outside = big.join(largest, ["p", "root"], "left_anti").select(
        "p", F.col("chunk").alias("i"), "digest", "doc_id", "key").distinct()
    chunks = big.select("p", F.col("chunk").alias("j")).distinct()
    asking = outside.select("p", "i").distinct()
    probes = outside.join(chunks, "p").withColumn("probe", F.lit(True))
    others = big.select("p", F.col("chunk").alias("j"), "digest", "doc_id", "key").join(asking, "p").withColumn(
        "probe", F.lit(False))
    return _compare(probes.unionByName(others), docs, ["p", "i", "j"])


def similar_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK_SHINGLES,
    frequent_share: int = FREQUENT_SHARE, frequent_most: int = FREQUENT, frequent_from: int = FREQUENT_FROM,
) -> DataFrame:
    """doc_id, key (MD5 of the text), n_shingles, component_id, root of every row.

    ``root`` is the component's smallest class; rows without words have none.
    """
    spark = docs.sparkSession
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_text")).withColumn(
        "key", F.unhex(F.md5("_text")))
    frequent = _frequent(rows, frequent_share, frequent_most, frequent_from)
    sets = cut_lineage(_sets(rows, spark.sparkContext.broadcast(frequent), kind))
    members = cut_lineage(_members(_blocks(sets, frequent[0]), sets, block))
    asked = members.select("p", "chunk", "digest", "doc_id", "key", F.lit(None).cast("boolean").alias("probe"))
    links = cut_lineage(_compare(asked, rows, ["p", "chunk"]))
    roots = connected(links)
    if not members.where("chunks > 1").isEmpty():
        more = cut_lineage(_across(members, roots, rows))
        roots = connected(links.unionByName(more))
    classes = sets.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("_id"))
    rooted = classes.join(roots.select(F.col("node").alias("digest"), "root"), "digest", "left").withColumn(
        "root", F.coalesce("root", "digest"))
    smallest = rooted.groupBy("root").agg(F.min("_id").alias("component_id"))
    named = rooted.join(smallest, "root").select(F.col("digest").alias("_g"), "component_id", "root")
    return sets.join(named, F.col("digest") == F.col("_g"), "left").select(
        "doc_id", "key", F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"), "root")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """One row of each component, that with the smallest id; all rows without words."""
    found = similar_groups(docs, doc_id, text, **settings)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "key")).alias("m")
    kept = cut_lineage(found.where("n_shingles > 0").groupBy("root").agg(
        first, F.count("*").alias("rows")).select(F.col("m.doc_id").alias("_i"), F.col("m.key").alias("_k"), "rows"))
    wordless = found.where("n_shingles = 0").select(
        F.col("doc_id").alias("_i"), F.col("key").alias("_k"), F.lit(0).cast("long").alias("rows")).distinct()
    place = (docs[doc_id].eqNullSafe(F.col("_i"))) & (F.unhex(F.md5(F.coalesce(docs[text], F.lit("")))) == F.col("_k"))
    # rows of a kept document repeat only in components of several rows
    alone = docs.join(kept.where("rows = 1").unionByName(wordless), place, "left_semi")
    several = docs.join(kept.where("rows > 1"), place, "left_semi").dropDuplicates([doc_id, text])
    return alone.unionByName(several)
