"""Token ids as patched frame-of-reference blocks.

The ids of a document are cut into blocks of 128. A block stores its minimum; the differences to it
are packed at the width that the ``PERCENTILE`` of them needs, and of the others (the exceptions) the
place and the bits above that width follow in a list. The byte at which each block begins is kept
beside the payload, so any block can be read by itself.

A block: minimum (4 bytes), width and number of exceptions (1 each), 2 zero bytes, 16 x width bytes
of packed differences (little-endian bits), a byte for each exception's place, 4 for its upper bits.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.kernel import ragged
from lodestrata.llm.token_counts import CHUNK, VOCABULARY, encode, encoding

BLOCK, HEAD, PERCENTILE = 128, 8, 90
#: Blocks packed in one vectorised step.
STEP = 1 << 12


def _widths(values: np.ndarray) -> np.ndarray:
    """The bits that each value needs."""
    return np.frexp(values.astype(np.float64))[1].astype(np.int64)


def _pack(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all blocks (rows of x, uint32) and where each begins."""
    least = x.min(1)
    x = x - least[:, None]
    width = _widths(np.partition(x, BLOCK * PERCENTILE // 100, axis=1)[:, BLOCK * PERCENTILE // 100])
    over = x >> np.minimum(width, 31)[:, None].astype(np.uint32)
    over[width > 31] = 0
    row, place = np.nonzero(over)
    count = np.bincount(row, minlength=len(x))
    size = HEAD + 16 * width + 5 * count
    start = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)
    out[start[:, None] + np.arange(4)] = least.astype("<u4").view(np.uint8).reshape(-1, 4)
    out[start + 4], out[start + 5] = width, count
    for w in np.unique(width).tolist():
        own = np.flatnonzero(width == w)
        if w:
            bits = (x[own][:, :, None] >> np.arange(w, dtype=np.uint32) & np.uint32(1)).astype(np.uint8)
            out[(start[own] + HEAD)[:, None] + np.arange(16 * w)] = np.packbits(bits.reshape(len(own), -1), axis=1, bitorder="little")
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    tail = (start + HEAD + 16 * width)[row]
    out[tail + nth] = place
    out[(tail + count[row] + 4 * nth)[:, None] + np.arange(4)] = over[row, place].astype("<u4").view(np.uint8).reshape(-1, 4)
    return out, start


def pack(ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For the ids of all rows and the number of each row's: all bytes, the number of each row's, and
    where in its row each block begins, and the number of each row's blocks."""
    blocks = -(-counts // BLOCK)
    first = np.cumsum(counts) - counts
    row = np.repeat(np.arange(len(counts)), blocks)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    begin = first[row] + nth * BLOCK
    last = (first + counts)[row] - 1
    parts, starts, at = [], [], 0
    for k in range(0, len(row), STEP):
        # a short block is filled up with its last id
        x = ids[np.minimum(begin[k : k + STEP, None] + np.arange(BLOCK), last[k : k + STEP, None])].astype(np.uint32)
        part, start = _pack(x)
        parts.append(part)
        starts.append(start + at)
        at += len(part)
    data = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
    start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    ends = np.append(start, at)[np.cumsum(blocks)]
    sizes = np.diff(np.concatenate([[0], ends]))
    return data, sizes, start - (ends - sizes)[row], blocks


def unpack(data: bytes, starts: np.ndarray) -> np.ndarray:
    """The blocks that begin at the given bytes, 128 ids a row."""
    raw, starts = np.frombuffer(data, np.uint8), np.asarray(starts, np.int64)
    out = np.zeros((len(starts), BLOCK), np.uint32)
    if not len(starts):
        return out
    least = np.ascontiguousarray(raw[starts[:, None] + np.arange(4)]).view("<u4")
    width, count = raw[starts + 4].astype(np.int64), raw[starts + 5].astype(np.int64)
    for w in np.unique(width).tolist():
        own = np.flatnonzero(width == w)
        if w:
            bits = np.unpackbits(raw[(starts[own] + HEAD)[:, None] + np.arange(16 * w)], axis=1, bitorder="little").reshape(len(own), BLOCK, w)
            out[own] = (bits.astype(np.uint32) << np.arange(w, dtype=np.uint32)).sum(2, dtype=np.uint32)
    tail = starts + HEAD + 16 * width
    row = np.repeat(np.arange(len(starts)), count)
    if len(row):
        nth = ragged(np.zeros(len(starts), np.int64), count)
        high = np.ascontiguousarray(raw[(tail[row] + count[row] + 4 * nth)[:, None] + np.arange(4)]).view("<u4").ravel()
        out[row, raw[tail[row] + nth]] |= high << width[row].astype(np.uint32)
    return out + least


def read_ids(payload: bytes, block_starts: list[int], n_tokens: int, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids of a document, of the blocks from ``first`` to before ``last`` if these are given."""
    ids = unpack(payload, np.array(block_starts[first:last], np.int64)).ravel()
    return ids[: max(0, n_tokens - first * BLOCK)]


def _binary(data: np.ndarray, sizes: np.ndarray, mask: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    out = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])
    return pc.if_else(pa.array(mask), pa.scalar(None, pa.large_binary()), out).cast(pa.binary())


def packed_ids(texts: pa.Array, path: str) -> pa.StructArray:
    encoder = encoding(path)[0]
    own = [np.zeros(0, np.uint32) if not t else np.array(encoder.encode_ordinary(t), np.uint32) if len(t) * 4 <= CHUNK else encode(t, path)[0] for t in texts.to_pylist()]
    counts = np.array([len(x) for x in own], np.int64)
    data, sizes, starts, blocks = pack(np.concatenate(own) if own else np.zeros(0, np.uint32), counts)
    mask = ~np.array(texts.is_valid().to_pylist(), bool)
    at = pa.array(np.concatenate([[0], np.cumsum(blocks)]), pa.int32(), mask=np.append(mask, False))
    return pa.StructArray.from_arrays([pa.array(counts, pa.int64(), mask=mask), _binary(data, sizes, mask), pa.ListArray.from_arrays(at, pa.array(starts, pa.int32()))], ["n_tokens", "payload", "block_starts"])


def token_blocks(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row for each document: doc_id, n_tokens, payload, block_starts (``read_ids`` gives the ids).

    All three are null for a null text; an empty one has no token, an empty payload and no block. Repeated
    rows are encoded each, alike; an empty table gives no row; other columns, whatever their names, are left out.
    """

    def run(texts: pa.Array) -> pa.Array:
        return packed_ids(texts, vocabulary)

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    udf = F.arrow_udf(run, "struct<n_tokens:bigint,payload:binary,block_starts:array<int>>").asNondeterministic()
    return docs.select("doc_id", udf(F.col("text").cast("string")).alias("_ids")).select("doc_id", "_ids.*")
