"""Token counts, with overlap resynchronisation for huge texts.

A text of more than ``CHUNK`` bytes is encoded in overlapping chunks, each by itself, with the byte
offset of every token. Two chunks are spliced where both begin a new pre-token (a piece that the
pattern cuts off before merging). Such a boundary is stable, which is proved as follows. Merging
never crosses a pre-token, and the pattern looks ahead but never back, so what it cuts off from a
boundary on doesn't depend on what came before. By induction the left chunk's boundaries are those
of the whole text from its own splice on, except the last two pre-tokens, which the end of the chunk
may have changed (the pattern looks no further than a run of one kind and the sign after it). From
the first boundary that the right chunk shares with those, its pre-tokens are therefore those of the
whole text too. If the overlap holds no shared boundary, it is widened: to the left chunk's last such
boundary, or to all that follows the last splice where it has none (within a huge unbroken run). Then the
next chunk is made as long as what had to be encoded again, so a run of any length costs a few times its
own length in all, and the result is always that of encoding the text in one go.
"""

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A file of a public byte-level BPE: a token in base64 and its rank on each line. It must be there on every executor.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CHUNK, OVERLAP = 1 << 15, 1 << 9
SPLIT = regex.compile(PATTERN)


@lru_cache(4)
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@lru_cache(4)
def encoding(path: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The encoder, and the bytes of each token."""
    own = ranks(path)
    lengths = np.zeros(max(own.values()) + 1, np.int64)
    for token, k in own.items():
        lengths[k] = len(token)
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=own, special_tokens={}), lengths


def _align(raw: bytes, at: int) -> int:
    """The beginning of the character at or before ``at``."""
    while 0 < at < len(raw) and raw[at] & 0xC0 == 0x80:
        at -= 1
    return at


class _Piece:
    def __init__(self, raw: bytes, start: int, end: int, path: str) -> None:
        encoder, lengths = encoding(path)
        self.start, self.end, self.text = start, end, raw[start:end].decode("utf-8")
        self.ids = np.array(encoder.encode_ordinary(self.text), np.uint32)
        self.ends = start + np.cumsum(lengths[self.ids])

    def boundaries(self, low: int, high: int) -> list[int]:
        """Where a new pre-token begins, from low to high, the ends of the chunk's last two left out."""
        at, out = self.start, []
        for word in SPLIT.findall(self.text):
            out.append(at)
            at += len(word.encode())
            if at > high:
                break
        else:
            out = out[:-1]
        return [x for x in out if low <= x <= high]

    def between(self, low: int, high: int) -> np.ndarray:
        i, j = np.searchsorted(self.ends, [low, high], "right")
        return self.ids[i:j]


def encode(text: str, path: str = VOCABULARY, chunk: int = CHUNK, overlap: int = OVERLAP) -> tuple[np.ndarray, int, int]:
    """Token ids of the whole text, the number of chunks, and how often an overlap was widened."""
    raw = text.encode("utf-8")
    if len(raw) <= chunk:
        return np.array(encoding(path)[0].encode_ordinary(text), np.uint32), 1, 0
    out, widened, chunks = [], 0, 1
    left, splice = _Piece(raw, 0, _align(raw, chunk), path), 0
    while left.end < len(raw):
        chunks += 1
        end, start = _align(raw, min(len(raw), left.end + max(chunk - overlap, left.end - splice - chunk))), max(splice, _align(raw, left.end - overlap))
        stable = left.boundaries(splice + 1, left.end)
        if not stable:
            # within an unbroken run: it begins at a stable boundary, so nothing of the left chunk is needed
            widened += start > splice
            left = _Piece(raw, splice, end, path)
            continue
        while True:
            right = _Piece(raw, start, end, path)
            near = [x for x in stable if x >= start]
            shared = sorted(set(near) & set(right.boundaries(start, left.end))) if near else []
            if shared:
                out.append(left.between(splice, shared[0]))
                left, splice = right, shared[0]
                break
            # at the latest, the right chunk begins at a boundary of the left one
            start = max(stable[0], min(stable[-1], _align(raw, 2 * start - left.end)))
            widened += 1
    out.append(left.between(splice, left.end))
    return np.concatenate(out), chunks, widened


def counted(texts: pa.Array, path: str) -> pa.StructArray:
    """Tokens, bytes, chunks and widened overlaps of each text."""
    encoder = encoding(path)[0]
    rows = []
    for t in texts.to_pylist():
        if t is None:
            rows.append((None, None, 0, 0))
        elif len(t) * 4 <= CHUNK:
            rows.append((len(encoder.encode_ordinary(t)), len(t.encode()), 1, 0))
        else:
            ids, chunks, widened = encode(t, path)
            rows.append((len(ids), len(t.encode()), chunks, widened))
    kinds = {"n_tokens": pa.int64(), "n_bytes": pa.int64(), "chunks": pa.int32(), "widened": pa.int32()}
    return pa.StructArray.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds.values())], list(kinds))


def with_tokens(docs: DataFrame, vocabulary: str = VOCABULARY, name: str = "_tokens") -> DataFrame:
    """``docs`` with a struct of n_tokens, n_bytes, chunks and widened.

    A null text has null counts and no chunk; an empty one has no token and one chunk.
    """

    def count(texts: pa.Array) -> pa.Array:
        return counted(texts, vocabulary)

    count.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    udf = F.arrow_udf(count, "struct<n_tokens:bigint,n_bytes:bigint,chunks:int,widened:int>").asNondeterministic()
    return docs.withColumn(name, udf(F.col("text").cast("string")))


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row for each document: doc_id, n_tokens, n_bytes, chunks, widened (how often an overlap was).

    A null text has null counts and no chunk, an empty one no token. Repeated rows are counted each; an empty
    table gives no row; other columns, whatever their names, are left out.
    """
    return with_tokens(docs.select("doc_id", "text"), vocabulary).select("doc_id", "_tokens.*")
