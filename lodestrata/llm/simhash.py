"""SimHash near-duplicates by anchor-point covering.

A fingerprint has ten blocks of 13 bits. Two fingerprints at most ``THRESHOLD`` = 19 bits apart are
at most 19 // 10 = 1 bit apart in one block at least. The anchors of a block are the 2048 words of
the Hamming code of 15 bits (the block's value padded with zeros), which is perfect: each value lies
within the covering radius 1 of exactly one anchor, its home. Each fingerprint goes, for each block,
to every anchor within covering radius plus threshold (1 + 1); at an anchor, the fingerprints at home
there are compared to all that came. If s is at home at a and t is at most 1 bit from s in the block,
t is at most 2 from a, so no pair is missed; and as the pair is also found the other way round, a
fingerprint need only go to anchors not below its own home, which halves the copies (about 4 a block).

An anchor gives the stars of its connected components rather than all pairs, so thousands of copies
cost thousands of edges, not millions; equal fingerprints are one node. Components are then joined
by large-star and small-star rounds, each cut at the shared folder.

How many fingerprints an anchor has is counted first (there are 20,480 anchors, whatever the input). Those of an
anchor with more than ``ROWS`` are dealt to blocks, and each that is at home there goes to all blocks of its
group, so no task holds more than a block and a group, however many there are or lie close to each other.
"""

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.kernel import FOLD, mix, ragged, row_slices, rows_of, runs, span_hashes, utf8_view
from lodestrata.llm.scratch import cut, unused

BLOCKS, BITS, THRESHOLD = 10, 13, 19
RADIUS, BLOCK_THRESHOLD, PAIR_THRESHOLD = 1, THRESHOLD // BLOCKS, THRESHOLD // (BLOCKS // 2)
LENGTH, CHECKS, _GENERATOR = 15, 4, 0b10011
BYTES, WORDS = 2 * BLOCKS, BLOCKS // 2
#: Pairs compared in one vectorised step; fingerprints of an anchor's block, and blocks to a group of those at home.
STEP, ROWS, ASKED = 1 << 21, 1 << 15, 16
#: Rows beyond which those that answer are looked up by a block's value, so many asking and so many pairs at once.
FEW, PROBES, LOOKED = 1 << 13, 1 << 7, 1 << 17
ANCHORS = BLOCKS << LENGTH


def _remainder(w: np.ndarray) -> np.ndarray:
    w = w.astype(np.uint32)
    for k in range(LENGTH - 1, CHECKS - 1, -1):
        w = np.where(w >> k & 1, w ^ np.uint32(_GENERATOR << (k - CHECKS)), w)
    return w


@lru_cache(1)
def code() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The syndrome of each word; the error patterns of weight RADIUS + BLOCK_THRESHOLD at most, by
    syndrome and then weight; and where each syndrome's begin."""
    patterns = np.array([sum(1 << b for b in c) for k in range(RADIUS + BLOCK_THRESHOLD + 1) for c in combinations(range(LENGTH), k)], np.uint32)
    syndromes = _remainder(patterns)
    order = np.argsort(syndromes, kind="stable")
    return _remainder(np.arange(1 << LENGTH)), patterns[order], np.searchsorted(syndromes[order], np.arange((1 << CHECKS) + 1))


def anchors(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For block values: the index of the value, the anchor, and whether that's its home, for each anchor it goes to."""
    syndrome, patterns, begin = code()
    values = values.astype(np.uint32)
    s = syndrome[values]
    count = begin[s + 1] - begin[s]
    who = np.repeat(np.arange(len(values)), count)
    at = np.arange(len(who)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(begin[s], count)
    where = values[who] ^ patterns[at]
    home = values ^ patterns[begin[s]]
    go = where >= home[who]
    return who[go], where[go], where[go] == home[who[go]]


def fingerprints(texts: pa.Array) -> pa.Array:
    """20 bytes for each text, a 16-bit word to a block; null for a null text.

    The features are the set of all words (the whole text, if there is no word), folded to lower case
    where ASCII. A bit is the majority of the features' bits.
    """
    data, offsets = utf8_view(texts)
    n = len(offsets) - 1
    out = np.zeros((n, BLOCKS), np.uint16)
    wide_bytes = -(-BLOCKS * BITS // 8)
    weights = (1 << np.arange(BITS)).astype(np.int64)
    for i, j in row_slices(offsets):
        raw, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        folded = FOLD[raw]
        starts, ends = runs(folded != 0, at)
        row = rows_of(at, starts)
        none = np.flatnonzero(np.bincount(row, minlength=j - i) == 0)
        hashes = np.concatenate([span_hashes(folded, starts, ends), span_hashes(raw, at[none], at[none + 1])])
        key = np.unique(np.concatenate([row, none]).astype(np.uint64) << np.uint64(42) | hashes >> np.uint64(22))
        own, feature = (key >> np.uint64(42)).astype(np.int64), key & np.uint64((1 << 42) - 1)
        first = np.searchsorted(own, np.arange(j - i + 1))
        wide = np.stack([mix(feature * np.uint64(4) + np.uint64(k)) for k in range(-(-wide_bytes // 8))], 1).view(np.uint8)[:, :wide_bytes]
        for r in range(j - i):
            some = wide[first[r] : first[r + 1]]
            ones = sum(np.unpackbits(some[k : k + 255], axis=1).sum(0, dtype=np.uint8).astype(np.int64) for k in range(0, len(some), 255))
            out[i + r] = (2 * ones[: BLOCKS * BITS] > len(some)).reshape(BLOCKS, BITS) @ weights
    valid = texts.is_valid().to_pylist()
    return pa.array([x.tobytes() if v else None for x, v in zip(out, valid)], pa.binary())


def with_fingerprint(docs: DataFrame, name: str = "_fp") -> DataFrame:
    def fingerprint(texts: pa.Array) -> pa.Array:
        return fingerprints(texts)

    fingerprint.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return docs.withColumn(name, F.arrow_udf(fingerprint, "binary").asNondeterministic()(F.col("text").cast("string")))


def _bytes(values: pa.Array) -> np.ndarray:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    return np.frombuffer(b"".join(values.to_pylist()), np.uint8).reshape(-1, BYTES)


def blocks(fp: np.ndarray) -> np.ndarray:
    """The block values, one column each."""
    return np.ascontiguousarray(fp).view(np.uint16)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many fingerprints go to each anchor."""
    counts = np.zeros(ANCHORS, np.int64)
    for batch in batches:
        for k in range(0, batch.num_rows, 1 << 14):
            values = blocks(_bytes(batch.column(0).slice(k, 1 << 14)))
            for b in range(BLOCKS):
                counts += np.bincount(anchors(values[:, b])[1] | np.uint32(b << LENGTH), minlength=ANCHORS)
    some = np.flatnonzero(counts)
    yield pa.record_batch([pa.array(some, pa.int32()), pa.array(counts[some])], ["anchor", "n"])


def _replicate(many: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Copies of the fingerprints to their anchors, each of which has so ``many`` blocks."""
    for batch in batches:
        for k in range(0, batch.num_rows, 1 << 14):
            fp = _bytes(batch.column(0).slice(k, 1 << 14))
            values = blocks(fp)
            spread = (mix(fp[:, :8].copy().view(np.uint64).ravel() ^ fp[:, 8:16].copy().view(np.uint64).ravel()) >> np.uint64(20)).astype(np.int64)
            for b in range(BLOCKS):
                who, where, home = anchors(values[:, b])
                where = (where | np.uint32(b << LENGTH)).astype(np.int64)
                of, none = many[where], np.zeros(len(who), np.int64)
                yield _sent(fp, who, where, home, none == 0, none, none, np.flatnonzero(of == 1))
                if not (large := of > 1).any():
                    continue
                groups = -(-of // ASKED)
                # those at home ask in all blocks of one group; all answer from one block in all groups
                for asks, some, each, one in ((True, home & large, of, groups), (False, large, groups, of)):
                    at = np.repeat(np.flatnonzero(some), each[some])
                    nth = np.arange(len(at)) - np.repeat(np.cumsum(each[some]) - each[some], each[some])
                    mine = spread[who[at]] % one[at]
                    block, asked = (nth, mine) if asks else (mine, nth)
                    yield _sent(fp, who[at], where[at], none[at] == (not asks), none[at] == asks, block, asked, np.arange(len(at)))


def _sent(fp: np.ndarray, who: np.ndarray, where: np.ndarray, asks: np.ndarray, answers: np.ndarray, block: np.ndarray, asked: np.ndarray, go: np.ndarray) -> pa.RecordBatch:
    raw = pa.Array.from_buffers(pa.binary(BYTES), len(go), [None, pa.py_buffer(fp[who[go]].tobytes())]).cast(pa.binary())
    return pa.record_batch([pa.array(where[go], pa.int32()), pa.array(block[go], pa.int32()), pa.array(asked[go], pa.int32()), raw, pa.array(asks[go]), pa.array(answers[go])], ["anchor", "block", "asked", "fp", "asks", "answers"])


@lru_cache(1)
def changes() -> np.ndarray:
    """The differences of at most PAIR_THRESHOLD bits that a block's value can have."""
    every = np.arange(1 << BITS)
    return every[np.bitwise_count(every) <= PAIR_THRESHOLD]


def _within_pair(pair: np.ndarray, own: np.ndarray, to: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of ``own`` and ``to`` within PAIR_THRESHOLD in the pair of blocks, all of them looked at."""
    step = max(1, STEP // max(1, len(to)))
    for k in range(0, len(own), step):
        a = own[k : k + step]
        flat = np.flatnonzero(np.bitwise_count(pair[a, None] ^ pair[None, to]) <= PAIR_THRESHOLD)
        yield a[flat // len(to)], to[flat % len(to)]


def _looked_up(pair: np.ndarray, values: np.ndarray, own: np.ndarray, to: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same pairs, of which only those are looked at whose ``values`` (of the other block) are within it."""
    to = to[np.argsort(values[to], kind="stable")]
    there = np.ascontiguousarray(pair[to])
    first = np.searchsorted(values[to], np.arange((1 << BITS) + 1))
    size = np.diff(first)
    for k in range(0, len(own), PROBES):
        a = own[k : k + PROBES]
        who, at = np.repeat(a, len(changes())), (values[a, None] ^ changes()).ravel()
        total = np.concatenate([[0], np.cumsum(size[at])])
        n = 0
        while n < len(at):
            m = max(n + 1, int(np.searchsorted(total, total[n] + LOOKED, "right")) - 1)
            many = size[at[n:m]]
            asked, j = np.repeat(who[n:m], many), ragged(first[at[n:m]], many)
            near = np.flatnonzero(np.bitwise_count(pair[asked] ^ there[j]) <= PAIR_THRESHOLD)
            yield asked[near], to[j[near]]
            n = m


def near_pairs(fp: np.ndarray, asks: np.ndarray, answers: np.ndarray, block: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of the rows that ask and those that answer at one anchor that are within THRESHOLD.

    Blocks are paired: of fingerprints within 19 bits, one pair of blocks is within 3, and one of its
    two blocks then within 1. So what isn't within 3 in this block's pair is found at another anchor, and only
    the rest is compared in full. Where more than FEW answer, they are sorted by the pair's other block, and
    those within 3 bits in it (378 of its 8192 values) are looked up; the pairs are the same.
    """
    words = np.ascontiguousarray(fp).view(np.uint32)
    pair = np.ascontiguousarray(words[:, block // 2])
    own, to = np.flatnonzero(asks), np.flatnonzero(answers)
    found = _within_pair(pair, own, to) if len(to) <= FEW else _looked_up(pair, blocks(fp)[:, block ^ 1].astype(np.int64), own, to)
    for i, j in found:
        near = (np.bitwise_count(words[i] ^ words[j]).sum(1, dtype=np.int64) <= THRESHOLD) & (i != j)
        yield i[near], j[near]


def components(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The least index of each index's component."""
    label = np.arange(n)
    for i, j in pairs:
        while True:
            a, b = label[i], label[j]
            if not (differ := a != b).any():
                break
            i, j, a, b = i[differ], j[differ], a[differ], b[differ]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while (label[label] != label).any():
                label = label[label]
    return label


def _compare(group: pa.Table) -> pa.Table:
    fp, back = np.unique(_bytes(group.column("fp")).view(f"V{BYTES}").ravel(), return_inverse=True)
    fp = fp.view(np.uint8).reshape(-1, BYTES)
    asks, answers = (np.bincount(back, weights=group.column(c).to_numpy(), minlength=len(fp)) > 0 for c in ("asks", "answers"))
    label = components(len(fp), near_pairs(fp, asks, answers, int(group.column("anchor")[0].as_py()) >> LENGTH))
    who = np.flatnonzero(label != np.arange(len(fp)))
    return pa.table({"u": pa.array([bytes(x) for x in fp[who]], pa.binary()), "v": pa.array([bytes(x) for x in fp[label[who]]], pa.binary())})


def near_edges(fps: DataFrame, rows: int = ROWS) -> DataFrame:
    """Edges (u, v), v < u, that connect all fingerprints of ``fps`` (one column, distinct) within THRESHOLD."""
    many = np.ones(ANCHORS, np.int64)
    for r in fps.mapInArrow(_counts, "anchor int, n bigint").groupBy("anchor").agg(F.sum("n").alias("n")).filter(F.col("n") > rows).collect():
        many[r.anchor] = -(-r.n // rows)

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _replicate(many, batches)

    sent = fps.mapInArrow(replicate, "anchor int, block int, asked int, fp binary, asks boolean, answers boolean")
    return sent.groupBy("anchor", "block", "asked").applyInArrow(_compare, "u binary, v binary").distinct()


def connect(edges: DataFrame) -> DataFrame:
    """node and root, the least node of its component, for every node of edges (u, v).

    A node's least neighbour is found by partial sums and joined, so a node of any number of edges fills no task.
    """
    last = None
    edges = cut(edges.filter("u <> v"))
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u")
        joined = small.select("u", F.col("m").alias("v")).union(small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
        edges = cut(joined)
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now == last:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
        last = now


def grouped(prints: DataFrame, tell: list[str]) -> DataFrame:
    """_fp, _group (the least fingerprint of its group), _n (the group's rows) and _first (its first row by doc_id, nulls
    last, and then by ``tell``) for each fingerprint of ``prints``."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *tell)).alias("_first")
    each = cut(prints.filter("_fp is not null").groupBy("_fp").agg(F.count("*").alias("_n"), first))
    roots = connect(near_edges(each.select("_fp")))
    each = each.join(roots, each["_fp"] == roots["node"], "left").withColumn("_group", F.coalesce("root", "_fp")).drop("node", "root")
    groups = each.groupBy("_group").agg(F.sum("_n").alias("_n"), F.min("_first").alias("_first"))
    return each.select("_fp", "_group").join(groups, "_group")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row for each document: doc_id, group_id (the least doc_id of its group), group_size, keep.

    A group is a connected component of documents whose fingerprints are at most THRESHOLD bits
    apart; keep holds for one row of each, that of the least doc_id (nulls last). Of repeated rows one
    is kept. A null text is in no group: its group_id is its own doc_id and it is kept. Empty texts
    are copies of each other. An empty table gives no row; other columns, whatever their names, are left out.
    """
    prints = cut(with_fingerprint(docs.select("doc_id", "text")).select("doc_id", "_fp", F.monotonically_increasing_id().alias("_row")))
    g = grouped(prints, ["_row"]).withColumnRenamed("_fp", "_of")
    some = F.col("_of").isNotNull()
    return prints.join(g, prints["_fp"] == g["_of"], "left").select(
        "doc_id",
        F.when(some, F.col("_first.doc_id")).otherwise(F.col("doc_id")).alias("group_id"),
        F.coalesce("_n", F.lit(1).cast("bigint")).alias("group_size"),
        (~some | (F.col("_row") == F.col("_first._row"))).alias("keep"),
    )


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The documents that ``near_duplicates`` keeps, with their own columns, whatever their names.

    The texts are read again and told by their id and a hash, so a fingerprint is made once. Null texts are kept;
    of repeated rows, and of all empty texts, one is; an empty table stays empty.
    """
    i, n, h = unused(docs, "_id"), unused(docs, "_none"), unused(docs, "_hash")
    text = F.xxhash64(F.col("text").cast("string"))
    prints = cut(with_fingerprint(docs.select("doc_id", "text", text.alias("_hash"))).select("doc_id", "_hash", "_fp"))

    def keys(own: Column, of: Column) -> dict[str, Column]:
        # none of them is null, so that documents sent by them once, to meet repeated rows, aren't sent again to be joined
        return {i: F.coalesce(own, F.lit(0).cast(docs.schema["doc_id"].dataType)), n: own.isNull(), h: of}

    first = grouped(prints, ["_hash"]).select(*[c.alias(k) for k, c in keys(F.col("_first.doc_id"), F.col("_first._hash")).items()]).distinct()
    marked = docs.filter(F.col("text").isNotNull()).withColumns(keys(F.col("doc_id"), text)).dropDuplicates([i, n, h])
    kept = marked.join(first, [i, n, h], "left_semi").drop(i, n, h)
    return kept.unionByName(docs.filter(F.col("text").isNull()))
