"""SimHash near-duplicates: a self-join of binary tries under a Hamming budget.

Two fingerprints within ``budget`` bits agree on all but ``budget`` of any blocks. Each fingerprint
enters one trie for every choice of blocks that agree; in it these blocks lead, so that the tries' upper nodes,
which allow no error, are the keys that Spark deals out. Below them pairs of nodes are traversed together,
level by level: their differing bits add up and a pair beyond the budget is dropped with all below it.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ementario.llm.components import connected_components
from ementario.llm.runs import map_groups, roots
from ementario.session import materialize

SEED = 42
#: Keys with more fingerprints are split into pairs of trie nodes ``SPLIT_BITS`` levels down.
HOT = 20_000
SPLIT_BITS = 6


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """XXH64 of every shingle, repeats included; fewer words make one shingle, no words none."""
    words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    joined = memoryview(b" ".join(words))
    size = min(size, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - size + 1].tolist()
    digest = xxhash.xxh64_intdigest
    spans = zip(starts, ends[size - 1 :].tolist(), strict=True)
    return np.fromiter((digest(joined[i:j], SEED) for i, j in spans), np.uint64, len(starts))


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half the hashes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        part = hashes[at : at + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > len(hashes)).tolist())


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """doc_id and ``fp`` (64 bits as a long) of every whole text; null and empty texts have fingerprint zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([majority(shingle_hashes(t.as_py(), size)) for t in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(fps.view(np.int64))], ["doc_id", "fp"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fp long")


def _bits(fp: Column, start: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, start).bitwiseAND(F.lit((1 << width) - 1))


def tries(fps: DataFrame, budget: int, blocks: int, bits: int = 64) -> DataFrame:
    """Each fingerprint once per trie: ``trie``, ``lead`` (the agreeing blocks), ``rest`` (the bits below) and ``sub``.

    ``fps`` has node, fp (its low ``bits``) and seg, which numbers the fingerprints of a node. ``sub`` is -1, or for keys with
    more than ``HOT`` fingerprints a pair of nodes ``SPLIT_BITS`` levels down: their rows are copied to every pair that
    the budget allows, so no key stays whole in one task.
    """
    width = bits // blocks
    choices = list(combinations(range(blocks), blocks - budget))

    def gather(order: Iterable[int]) -> Column:
        out = F.lit(0).cast("long")
        for b in order:
            out = F.shiftleft(out, width).bitwiseOR(_bits(F.col("fp"), b * width, width))
        return out

    entries = [
        F.struct(
            (F.col("seg") * len(choices) + k).cast("int").alias("trie"), gather(agree).alias("lead"),
            gather(b for b in range(blocks) if b not in agree).alias("rest"),
        )
        for k, agree in enumerate(choices)
    ]
    entered = fps.select("node", F.explode(F.array(*entries)).alias("e")).select("node", "e.*")
    hot = entered.groupBy("trie", "lead").agg(F.count("*").alias("n")).where(F.col("n") > HOT)
    hot = materialize(hot.select("trie", "lead", F.lit(True).alias("hot")), "simhash-hot")
    near = [x for x in range(1 << SPLIT_BITS) if x.bit_count() <= budget]
    top = F.shiftright("rest", width * budget - SPLIT_BITS)
    other = F.transform(F.array(*map(F.lit, near)), lambda x: top.bitwiseXOR(x))
    pairs = F.transform(other, lambda o: (F.least(o, top) * (1 << SPLIT_BITS) + F.greatest(o, top)).cast("long"))
    subs = F.when(F.col("hot"), pairs).otherwise(F.array(F.lit(-1).cast("long")))
    return entered.join(hot, ["trie", "lead"], "left").select(
        "trie", "lead", "rest", "node", F.explode(subs).alias("sub")
    )


KEYS = ["trie", "lead", "sub"]
#: Pairs held at once.
PAIRS = 1_000_000


def _ranges(al: np.ndarray, ah: np.ndarray, bl: np.ndarray, bh: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs between positions of range a and of range b (equal ranges: each pair once), in bounded pieces."""
    # One row per position of a: it pairs with a run of positions of b.
    n = ah - al
    a = np.repeat(al - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
    start, end = np.repeat(bl, n), np.repeat(bh, n)
    start = np.where(np.repeat(al == bl, n), a + 1, start)
    size = end - start
    total = np.cumsum(size)
    at = 0
    while at < len(a):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS)))
        k = size[at:to]
        i = np.repeat(a[at:to], k)
        j = np.repeat(start[at:to] - np.concatenate(([0], np.cumsum(k)[:-1])), k) + np.arange(k.sum())
        if len(i):
            yield i, j
        at = to


def traverse(
    values: np.ndarray, bounds: np.ndarray, bits: int, budget: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of all pairs within ``budget`` bits, inside each of the groups that ``bounds`` sets apart, in pieces.

    ``values`` are sorted within a group, so a trie node is a range of positions, halved at each level by the count of
    set bits before it. A pair of nodes is (range, range, differing bits so far).
    """
    counts = [
        np.concatenate(([0], np.cumsum((values >> np.uint64(bits - 1 - d)) & np.uint64(1), dtype=np.int64)))
        for d in range(bits)
    ]
    lo, hi = bounds[:-1], bounds[1:]
    many = hi - lo > 1
    lo, hi = lo[many], hi[many]
    stack = [(0, lo, hi, lo, hi, np.zeros(len(lo), np.int64))]
    while stack:
        depth, al, ah, bl, bh, err = stack.pop()
        while depth < bits and len(al):
            if len(al) > PAIRS:  # bounded memory: one half waits
                half = len(al) // 2
                stack.append((depth, *(x[half:] for x in (al, ah, bl, bh, err))))
                al, ah, bl, bh, err = (x[:half] for x in (al, ah, bl, bh, err))
            c = counts[depth]
            am, bm = ah - (c[ah] - c[al]), bh - (c[bh] - c[bl])
            diff = al != bl
            parts = [
                (al, am, bl, bm, err),
                (am, ah, bm, bh, err),
                (al, am, bm, bh, err + 1),
                (am[diff], ah[diff], bl[diff], bm[diff], err[diff] + 1),
            ]
            al, ah, bl, bh, err = (np.concatenate(x) for x in zip(*parts, strict=True))
            alive = (ah > al) & (bh > bl) & (err <= budget) & ((al != bl) | (ah - al > 1))
            al, ah, bl, bh, err = (x[alive] for x in (al, ah, bl, bh, err))
            depth += 1
            alone = (ah - al == 1) & (bh - bl == 1)
            if alone.any():  # single paths to the end are compared at once
                a, b = al[alone], bl[alone]
                near = np.bitwise_count(values[a] ^ values[b]) <= budget
                yield a[near], b[near]
                al, ah, bl, bh, err = (x[~alone] for x in (al, ah, bl, bh, err))
        yield from _ranges(al, ah, bl, bh)


def forest(n: int, pairs: Iterable[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each of n positions the root of its tree, from links in pieces."""
    root = np.arange(n)
    for a, b in pairs:
        root = roots(n, np.concatenate((a, np.arange(n))), np.concatenate((b, root)))
    return root


def near_pairs(fps: DataFrame, budget: int = 2, blocks: int | None = None) -> DataFrame:
    """Links a-b between the ``node`` ids of fingerprints (columns fp and node) within ``budget`` bits.

    Of the links that a task finds in a key only a spanning forest is returned; no component is lost by that.
    """
    blocks = blocks or budget + 2
    bits = (64 // blocks) * budget

    def run(rows: pa.Table, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
        values = rows.column("rest").to_numpy().view(np.uint64)
        node = rows.column("node").to_numpy()
        root = forest(len(values), traverse(values, bounds, bits, budget))
        far = np.flatnonzero(root != np.arange(len(root)))
        yield pa.RecordBatch.from_arrays([pa.array(node[far]), pa.array(node[root[far]])], ["a", "b"])

    entered = tries(fps.withColumn("seg", F.lit(0)), budget, blocks)
    return map_groups(entered, KEYS, run, "a long, b long", order=("rest",))


def near_duplicates(docs: DataFrame, size: int = 3, budget: int = 2) -> DataFrame:
    """doc_id, fp and component_id (the smallest doc_id reachable) of every row.

    Equal fingerprints are one node, so any number of copies costs one row. Empty and null texts share the
    fingerprint zero and are linked like any other. Rows with a null doc_id are returned; a fingerprint that only such
    rows have is no node and its component_id is null. Repeated rows are returned each. Other columns are not read.
    """
    prints = materialize(fingerprints(docs, size), "simhash-prints")
    nodes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("node")), "simhash-nodes")
    known = nodes.where("node is not null")
    links = materialize(near_pairs(known, budget), "simhash-links")
    groups = connected_components(links)
    named = nodes.join(groups, "node", "left").select(
        F.col("fp").alias("fp_n"), F.coalesce("component", "node").alias("component_id")
    )
    # Written, so that the rows of a fingerprint with many copies can be split in the join.
    named = materialize(named, "simhash-components")
    return prints.join(named, F.col("fp") == F.col("fp_n"), "left").select("doc_id", "fp", "component_id")


# Similar texts: signatures of several fingerprints, for a Jaccard similarity well below that of near-identical texts.

#: 64-bit fingerprints in a signature; each gives two tries of 32 bits.
WORDS64 = 20
SEGMENT, SEGMENT_BUDGET, SEGMENT_BLOCKS = 32, 2, 4
#: Fixed odd numbers that make independent hashes of one.
MIX = np.array([(0x9E3779B97F4A7C15 * (2 * k + 1)) & (2**64 - 1) for k in range(1, WORDS64 + 1)], np.uint64)


def signature(hashes: np.ndarray) -> bytes:
    """``WORDS64`` fingerprints of the set of shingles, as little-endian bytes."""
    hashes = np.unique(hashes)
    ones = np.zeros((WORDS64, 64), np.int64)
    for at in range(0, len(hashes), 8192):
        h = hashes[at : at + 8192]
        for k in range(WORDS64):
            x = (h ^ (h >> np.uint64(29))) * MIX[k]
            x ^= x >> np.uint64(32)
            x *= np.uint64(0xD6E8FEB86659FD93)
            x ^= x >> np.uint64(32)
            ones[k] += np.unpackbits(x.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes), axis=1, bitorder="little").tobytes()


#: Sets of so few shingles are met by the shingles themselves.
SHORT = 20


def prefix(hashes: np.ndarray, similarity: float) -> list[int] | None:
    """Of a small set the shingles with the smallest hashes, so many that every set of this similarity shares one of its own.

    Sets that share none of their first n - ceil(similarity * n) + 1 shingles have too few in common.
    """
    h = np.unique(hashes)
    if not 0 < len(h) <= SHORT:
        return None
    return h[: len(h) - math.ceil(similarity * len(h) - 1e-9) + 1].view(np.int64).tolist()


def signatures(docs: DataFrame, size: int, similarity: float) -> DataFrame:
    """doc_id, t (a hash of the text as it stands), sig, prefix (of small sets), and node, a 64-bit hash of the words; texts
    without words have no signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sigs, nodes, firsts = [], [], []
            for text in batch.column("text"):
                h = shingle_hashes(text.as_py(), size)
                sigs.append(signature(h) if len(h) else None)
                firsts.append(prefix(h, similarity))
                nodes.append(words_hash(text.as_py()))
            columns = [batch.column("doc_id").cast(pa.int64()), batch.column("t"), pa.array(sigs, pa.binary()), pa.array(nodes, pa.int64())]
            columns.append(pa.array(firsts, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "t", "sig", "node", "prefix"])

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("t"))
    return rows.mapInArrow(run, "doc_id long, t long, sig binary, node long, prefix array<long>")


def words_hash(text: str | None) -> int:
    words = b" ".join((text or "").encode("utf-8", "replace").lower().split())
    return int(np.frombuffer(xxhash.xxh128_digest(words)[:8], "<i8")[0])


def most_bits(similarity: float) -> int:
    """Differing bits of two signatures whose sets of equal size have this Jaccard similarity, on average."""
    cosine = 2 * similarity / (1 + similarity)
    return math.floor(64 * WORDS64 * math.acos(cosine) / math.pi)


def _rows64(column: pa.ChunkedArray) -> np.ndarray:
    data = column.combine_chunks().cast(pa.binary(8 * WORDS64))
    return np.frombuffer(data.buffers()[1], "<u8", len(data) * WORDS64, data.offset * 8 * WORDS64).reshape(-1, WORDS64)


#: Nodes of a group of candidates that are compared with each other, and with as many others, at once.
COMPARED = 512


def similar_links(
    node: np.ndarray, sig: np.ndarray, sets: list[np.ndarray], label: np.ndarray, side: np.ndarray, limit: int, similarity: float
) -> list[tuple[int, int]]:
    """Links that join the labels of all pairs whose sets have this Jaccard similarity, among those within ``limit`` bits and
    those of small sets.

    ``sets`` have each hash once. Where there are two sides, only pairs of different sides count. A pair that ``label`` or
    earlier links connect is not compared.
    """
    sizes = np.array([len(x) for x in sets])
    short = sizes <= SHORT
    universe, flat = np.unique(np.concatenate(sets), return_inverse=True)
    parts = np.split(flat, np.cumsum(sizes)[:-1])
    mark = np.zeros(len(universe), bool)
    label = np.unique(label, return_inverse=True)[1]
    two_sides = side.min() != side.max()
    out = []
    for i in range(len(node) - 1):
        open_ = label[i + 1 :] != label[i]
        if two_sides:
            open_ &= side[i + 1 :] != side[i]
        js = np.flatnonzero(open_) + i + 1
        near = np.bitwise_count(sig[js] ^ sig[i]).sum(axis=1, dtype=np.int64) <= limit
        js = js[near | short[js]] if short[i] else js[near]
        if not len(js):
            continue
        mark[parts[i]] = True
        for j in js.tolist():
            if label[j] == label[i]:
                continue
            both = int(np.count_nonzero(mark[parts[j]]))
            if both >= similarity * (sizes[i] + sizes[j] - both) - 1e-9:
                out.append((int(node[i]), int(node[j])))
                label[label == label[j]] = label[i]
        mark[parts[i]] = False
    return out


def short_links(nodes: DataFrame) -> DataFrame:
    """a and b: each node with the smallest one that shares a shingle of its prefix. Candidates, not yet compared."""
    keyed = nodes.select("node", F.explode("prefix").alias("key"))
    hubs = keyed.groupBy("key").agg(F.min("node").alias("b"), F.count("*").alias("n")).where("n > 1").select("key", "b")
    # Written, so that the rows of a frequent shingle can be split in the join.
    return keyed.join(materialize(hubs, "similar-hubs"), "key").where("node <> b").select(F.col("node").alias("a"), "b")


def candidate_groups(nodes: DataFrame, limit: int) -> DataFrame:
    """node and component of the nodes (columns node, sig and prefix) that have a partner within ``limit`` bits, as far as the
    tries find it, or share a shingle of their prefixes: two signatures are met where they agree within ``SEGMENT_BUDGET``
    bits on one of the segments."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = _rows64(pa.chunked_array([batch.column("sig")]))
            halves = np.ascontiguousarray(words).view("<u4").astype(np.int64)
            n = halves.shape[1]
            columns = [np.repeat(batch.column("node").to_numpy(), n), np.tile(np.arange(n, dtype=np.int32), len(halves)), halves.ravel()]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["node", "seg", "fp"])

    bits = SEGMENT // SEGMENT_BLOCKS * SEGMENT_BUDGET

    def partnered(rows: pa.Table, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
        values = rows.column("rest").to_numpy().view(np.uint64)
        found = np.zeros(len(values), bool)
        for a, b in traverse(values, bounds, bits, SEGMENT_BUDGET):
            found[a] = True
            found[b] = True
        yield from rows.filter(pa.array(found)).select([*KEYS, "rest", "node"]).combine_chunks().to_batches()

    def near(rows: pa.Table, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
        values = rows.column("rest").to_numpy().view(np.uint64)
        node, sig = rows.column("node").to_numpy(), _rows64(rows.column("sig"))

        def close() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for a, b in traverse(values, bounds, bits, SEGMENT_BUDGET):
                near = np.zeros(len(a), bool)
                for at in range(0, len(a), 200_000):
                    x, y = a[at : at + 200_000], b[at : at + 200_000]
                    near[at : at + 200_000] = np.bitwise_count(sig[x] ^ sig[y]).sum(axis=1, dtype=np.int64) <= limit
                yield a[near], b[near]

        root = forest(len(values), close())
        far = np.flatnonzero(root != np.arange(len(root)))
        yield pa.RecordBatch.from_arrays([pa.array(node[far]), pa.array(node[root[far]])], ["a", "b"])

    segments = nodes.where("sig is not null").select("node", "sig").mapInArrow(cut, "node long, seg int, fp long")
    entered = tries(segments, SEGMENT_BUDGET, SEGMENT_BLOCKS, SEGMENT)
    schema = "trie int, lead long, sub long, rest long, node long"
    met = materialize(map_groups(entered, KEYS, partnered, schema, order=("rest",)), "similar-met")
    again = met.join(nodes.select("node", "sig"), "node")
    links = map_groups(again, KEYS, near, "a long, b long", order=("rest",)).union(short_links(nodes))
    return connected_components(materialize(links.distinct(), "similar-near"))


def _compare(rows: DataFrame, keys: list[str], limit: int, similarity: float) -> DataFrame:
    """a and b: links within the groups of ``keys``, by the rows' node, sig, set, label and side."""

    def run(table: pa.Table, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
        node, label, side = (table.column(c).to_numpy() for c in ("node", "label", "side"))
        sig, held = _rows64(table.column("sig")), table.column("set")
        found = []
        for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            _, at = np.unique(node[start:end], return_index=True)  # repeated rows
            at += start
            if len(at) > 1:
                arrays = [np.frombuffer(held[k].as_buffer(), "<u8") for k in at.tolist()]
                found += similar_links(node[at], sig[at], arrays, label[at], side[at], limit, similarity)
        ends = np.array(found, np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])

    return map_groups(rows.select(*keys, "node", "sig", "set", "label", "side"), keys, run, "a long, b long")


def _labelled(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """component, node and label (the smallest node that links reach) of nodes with a component."""
    found = connected_components(links).select(F.col("node").alias("node_l"), F.col("component").alias("reached"))
    joined = nodes.join(found, F.col("node") == F.col("node_l"), "left")
    return materialize(joined.select("component", "node", F.coalesce("reached", "node").alias("label")), "similar-labels")


def _large_groups(sets: DataFrame, limit: int, similarity: float) -> DataFrame:
    """Links within groups of more than ``COMPARED`` candidates.

    First each node is compared within one random block, then one node of each label with others of such: a group of texts
    that are alike becomes one label, and every row is sent once or twice. What is left are pairs of different labels;
    their nodes are dealt out as pairs of blocks, where a label of more than a block has blocks of its own, which are not
    compared with each other.
    """
    nodes = materialize(sets.select("component", "node").distinct(), "similar-nodes-large")
    labels, links = nodes.withColumn("label", F.col("node")), None
    for turn in range(2):
        # The smallest of a struct: one node of each label, another one in each turn.
        one = labels.groupBy("component", "label").agg(F.min(F.struct(F.xxhash64(F.lit(turn), "node").alias("h"), "node")).alias("o"))
        many = one.groupBy("component").agg(F.ceil(F.count("*") / COMPARED).cast("int").alias("blocks"))
        dealt = one.join(many, "component").select(F.col("o.node").alias("node_d"), "label", F.pmod("o.h", "blocks").alias("block"))
        rows = sets.join(materialize(dealt, "similar-dealt"), F.col("node") == F.col("node_d")).withColumn("side", F.lit(0))
        found = materialize(_compare(rows, ["component", "block"], limit, similarity), "similar-links")
        links = found if links is None else links.union(found)
        labels = _labelled(nodes, links)

    sizes = labels.groupBy("component", "label").agg(F.count("*").alias("n"))
    # The label of a block that holds nothing else; all small labels of a component share their blocks.
    whole = F.when(F.col("n") > COMPARED, F.col("label"))
    shared = sizes.select("component", "label", whole.alias("own"), "n")
    parts = shared.groupBy("component", "own").agg(F.ceil(F.sum("n") / COMPARED).cast("int").alias("parts"), F.count("*").alias("labels"))
    open_ = parts.groupBy("component").agg(F.sum("labels").alias("all")).where(F.col("all") > 1).select("component")
    parts = materialize(parts.join(open_, "component", "left_semi").drop("labels"), "similar-parts")

    def block_id(own: Column, k: Column) -> Column:
        return F.xxhash64("component", F.coalesce(own, F.lit(-1)), own.isNull(), k)

    blocks = parts.select("component", "own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("k"))
    blocks = blocks.select("component", "own", block_id(F.col("own"), F.col("k")).alias("block"))
    low, high = blocks.select("component", F.col("own").alias("own_lo"), F.col("block").alias("lo")), blocks.withColumnRenamed("block", "hi")
    pairs = low.join(high, "component").where((F.col("lo") <= F.col("hi")) & ~F.coalesce(F.col("own_lo") == F.col("own"), F.lit(False)))
    pairs = materialize(pairs.select("lo", "hi"), "similar-pairs")  # ids of blocks, a few hundred times fewer than texts
    ends = pairs.select("lo", "hi", F.col("lo").alias("at")).union(pairs.where("lo <> hi").select("lo", "hi", F.col("hi").alias("at")))
    placed = labels.join(shared.select("component", "label", "own"), ["component", "label"]).withColumnRenamed("own", "own_p")
    placed = placed.join(parts.withColumnRenamed("component", "component_p"), (F.col("component") == F.col("component_p")) & F.col("own_p").eqNullSafe(F.col("own")))
    k = F.pmod(F.xxhash64(F.when(F.col("own").isNull(), F.col("label")).otherwise(F.col("node"))), F.col("parts")).cast("int")
    placed = placed.select(F.col("node").alias("node_d"), "label", block_id(F.col("own"), k).alias("block"))
    rows = sets.join(materialize(placed, "similar-placed"), F.col("node") == F.col("node_d")).join(ends, F.col("block") == F.col("at"))
    rows = rows.withColumn("side", (F.col("block") == F.col("hi")).cast("int"))
    return links.union(materialize(_compare(rows, ["lo", "hi"], limit, similarity), "similar-links"))


def similar_rows(docs: DataFrame, size: int = 5, similarity: float = 0.8, slack: float = 0.1) -> DataFrame:
    """doc_id, t, node (equal for texts with the same words) and component (the smallest node reachable) of every row, by links
    between texts whose sets of shingles have this Jaccard similarity or more.

    A signature of 1,280 SimHash bits stands for a text while candidates are sought: a pair is one if it agrees within 2
    bits on one of 40 segments of 32 bits and within the bits of a Jaccard ``similarity`` less ``slack`` on the whole.
    Of pairs at 0.8 about 0.993 are met, of those at 0.85 all but one in ten thousand. Sets of at most ``SHORT``
    shingles, whose signatures are coarse, are met exactly, by the shingles of their prefixes. Texts that candidates connect form a
    group; in it the sets themselves are compared, so that a link never joins texts below the similarity. No pairs of
    texts leave a task, only spanning forests; how large groups are dealt out, ``_large_groups`` says.
    """
    prints = materialize(signatures(docs, size, similarity), "similar-prints")
    nodes = materialize(prints.groupBy("node").agg(
        F.first("sig").alias("sig"), F.first("prefix").alias("prefix"), F.min(F.struct("doc_id", "t")).alias("of")
    ), "similar-nodes")
    limit = most_bits(similarity - slack)
    groups = materialize(candidate_groups(nodes, limit), "similar-groups")
    members = groups.union(groups.select("component", "component").distinct())
    sizes = materialize(members.groupBy("component").agg(F.count("*").alias("n")), "similar-sizes")
    members = members.join(sizes, "component").join(nodes, "node").select("component", "n", "node", "sig", "of.doc_id", "of.t")
    members = materialize(members, "similar-members")

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.unique(shingle_hashes(t.as_py(), size)).astype("<u8").tobytes() for t in batch.column("text")]
            columns = [batch.column(c) for c in ("component", "n", "node", "sig")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sets, pa.binary())], ["component", "n", "node", "sig", "set"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id_d"), F.xxhash64("text").alias("t_d"), "text")
    same = F.col("doc_id").eqNullSafe(F.col("doc_id_d")) & (F.col("t") == F.col("t_d"))
    sets = texts.join(members, same).select("component", "n", "node", "sig", "text")
    sets = materialize(sets.mapInArrow(shingled, "component long, n long, node long, sig binary, set binary"), "similar-sets")
    small = sets.where(F.col("n") <= COMPARED).withColumn("label", F.col("node")).withColumn("side", F.lit(0))
    links = materialize(_compare(small, ["component"], limit, similarity), "similar-links")
    large = sets.where(F.col("n") > COMPARED).drop("n")
    if not large.isEmpty():
        links = links.union(_large_groups(large, limit, similarity))
    named = nodes.select("node").join(connected_components(links), "node", "left").select(
        "node", F.coalesce("component", "node").alias("component")
    )
    # Written, so that the rows of a node with many copies can be split in the join.
    return prints.drop("sig", "prefix").join(materialize(named, "similar-components"), "node", "left").select("doc_id", "t", "node", "component")


def similar_documents(docs: DataFrame, size: int = 5, similarity: float = 0.8) -> DataFrame:
    """doc_id and component_id (the smallest doc_id reachable) of every row; see ``similar_rows``.

    Texts without words are copies of each other. A null doc_id names no component: where no other row is reached it is null.
    """
    rows = materialize(similar_rows(docs, size, similarity), "similar-rows")
    least = materialize(rows.groupBy("component").agg(F.min("doc_id").alias("component_id")), "similar-least")
    return rows.join(least, "component", "left").select("doc_id", "component_id")
