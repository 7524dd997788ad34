"""Best-two-fit packing of documents into sequences of a fixed number of tokens.

A document longer than a sequence is cut into whole sequences and a rest. A bin is filled greedily
with the longest rest that fits, again and again; then its smallest is taken out again if two
unpacked ones fill the gap so widened more tightly (the two of the greatest sum; of several, the
most unequal two).

Only doc_id and length leave the tokenizer's stage. Bins are filled within shards of about
``SHARD_ROWS`` documents chosen by hash, so shards are packed at once and each wastes at most its
last bins: the share lost doesn't grow with the input. Rows of the same id and length are counted before they
are sent, and go to shards by ``COPIES`` at a time, so an id that holds a third of all rows fills no shard.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.scratch import cut
from lodestrata.llm.token_counts import VOCABULARY, with_tokens

CAPACITY, SHARD_ROWS, COPIES = 2048, 1 << 14, 256


def best_two_fit(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Bins of indices into ``lengths``, all from 1 to capacity; of equal lengths the earlier goes first."""
    stacks: dict[int, list[int]] = {}
    for k in range(len(lengths) - 1, -1, -1):
        stacks.setdefault(lengths[k], []).append(k)
    there = sum(1 << x for x in stacks)  # bit x: a document of x tokens is left
    mirrored = sum(1 << (capacity - x) for x in stacks)

    def take(x: int) -> int:
        nonlocal there, mirrored
        k = stacks[x].pop()
        if not stacks[x]:
            del stacks[x]
            there ^= 1 << x
            mirrored ^= 1 << (capacity - x)
        return k

    def put_back(x: int, k: int) -> None:
        nonlocal there, mirrored
        stacks.setdefault(x, []).append(k)
        there |= 1 << x
        mirrored |= 1 << (capacity - x)

    bins = []
    while there:
        gap, own = capacity, []
        while gap and (x := (there & ((1 << (gap + 1)) - 1)).bit_length() - 1) > 0:
            own.append((x, take(x)))
            gap -= x
        if gap and there:
            small, wide = own[-1][0], gap + own[-1][0]
            for total in range(wide, small, -1):
                both = there & (mirrored >> (capacity - total))  # bit x: x and total - x are left
                x = both.bit_length() - 1
                if x > 0 and (2 * x != total or len(stacks[x]) > 1):
                    last = own.pop()
                    own += [(x, take(x)), (total - x, take(total - x))]
                    put_back(*last)
                    break
        bins.append([k for _, k in own])
    return bins


def _pack(capacity: int, group: pa.Table) -> pa.Table:
    group = group.take(pa.array(np.repeat(np.arange(group.num_rows), group.column("copies").to_numpy())))
    group = group.sort_by([("n_tokens", "ascending"), ("doc_id", "ascending")])
    lengths, shard = group.column("n_tokens").to_numpy(), group.column("shard")[0].as_py() << 32
    whole, rest = lengths // capacity, lengths % capacity
    row = np.repeat(np.arange(len(lengths)), whole)
    piece = np.arange(len(row)) - np.repeat(np.cumsum(whole) - whole, whole)
    some = np.flatnonzero(rest)
    filled = best_two_fit(rest[some].tolist(), capacity)
    order = some[np.array([k for b in filled for k in b], np.int64)]
    sizes = np.array([len(b) for b in filled], np.int64)
    before = np.cumsum(rest[order]) - rest[order]
    first = np.cumsum(sizes) - sizes
    empty = np.flatnonzero(lengths == 0)
    rows = np.concatenate([row, order, empty])
    at = [len(row), len(row) + len(order)]
    number = np.concatenate([np.arange(len(row)), len(row) + np.repeat(np.arange(len(filled)), sizes), empty * 0]) + shard
    start = np.concatenate([piece, whole[order], empty * 0]) * capacity
    place = np.concatenate([row * 0, before - np.repeat(before[first], sizes) if len(order) else before, empty * 0])
    tokens = np.concatenate([row * 0 + capacity, rest[order], empty * 0])
    none = np.arange(len(rows)) >= at[1]
    return pa.table({"bin_id": pa.array(number, pa.int64(), mask=none), "place": pa.array(place, pa.int32(), mask=none), "doc_id": group.column("doc_id").take(pa.array(rows)), "start": pa.array(start, pa.int64()), "n_tokens": pa.array(tokens, pa.int32())})


def pack(lengths: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Bins of documents given as doc_id and n_tokens: bin_id, place (first token in the bin), doc_id,
    start (first token in the document) and n_tokens of each piece.

    A document without tokens (null, empty) has one row with a null bin. Repeated rows are packed each; of
    equal lengths the lower id goes first. An empty table gives no row; other columns are left out.
    """
    shards = max(1, -(-lengths.count() // SHARD_ROWS))
    sized = lengths.select("doc_id", F.coalesce("n_tokens", F.lit(0)).cast("bigint").alias("n_tokens"))
    kind = sized.schema["doc_id"].dataType.simpleString()
    # ids are sorted within a shard, so the packing doesn't depend on the order in which rows arrive

    def fill(group: pa.Table) -> pa.Table:
        return _pack(capacity, group)

    fill.__annotations__ = {"group": pa.Table, "return": pa.Table}
    many = sized.groupBy("doc_id", "n_tokens").agg(F.count("*").alias("n"))
    some = many.select("doc_id", "n_tokens", "n", F.explode(F.sequence(F.lit(0).cast("bigint"), (F.col("n") - 1).cast("bigint"), F.lit(COPIES).cast("bigint"))).alias("first"))
    return some.select("doc_id", "n_tokens", F.least(F.lit(COPIES), F.col("n") - F.col("first")).alias("copies"), F.pmod(F.xxhash64("doc_id", "n_tokens", "first"), F.lit(shards)).alias("shard")).groupBy("shard").applyInArrow(fill, f"bin_id bigint, place int, doc_id {kind}, start bigint, n_tokens int")


def packed(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """``pack`` of the documents' token counts; a null or empty text has no token."""
    return pack(cut(with_tokens(docs.select("doc_id", "text"), vocabulary).select("doc_id", "_tokens.n_tokens")), capacity)
