"""Byte-pair encoding by speculation and verification, and decoding.

Each distinct word (pre-token) of a slice is first cut greedily into the longest tokens, all words
at once along a trie. A sequence of tokens is what merging gives if and only if merging leaves each
adjacent pair as it is, so it suffices to check pairs: unmerge the two tokens in the reverse order
of their merges, and see whether at any moment a merge across their border would have come first.
These checks run over all pairs at once. Only words with a pair that fails are merged exactly.

Words of any length go this way. Where many short words are cut along the trie side by side, the places of a
long one are: the longest token from each of its places is found at once, and then only the jumps are followed.
"""

import hashlib
import heapq
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.kernel import ragged, row_slices, utf8_view
from lodestrata.llm.token_counts import SPLIT, VOCABULARY, ranks

#: Bytes of text whose distinct words are encoded together, of a word from which its places are matched side by
#: side, and of the places that are at once.
SLICE, LONG, WINDOW = 1 << 20, 128, 1 << 16
NEVER = np.int64(1 << 40)
#: Exact results kept by each worker for the words that failed, how many at most, and of how many bytes each.
_EXACT: dict[tuple[bytes, bytes] | None, list[int]] = {}
KEPT, KEPT_BYTES = 400_000, 128


@dataclass
class Tables:
    mark: bytes  # tells tables apart: a digest of all their tokens
    ranks: dict[bytes, int]
    flat: np.ndarray  # the bytes of all tokens, by rank
    starts: np.ndarray
    lengths: np.ndarray
    left: np.ndarray  # the two tokens that the last merge of each joins; itself for a byte or what merging can't make
    right: np.ndarray
    pairs: np.ndarray  # left * size + right, in order, and the token they make
    made: np.ndarray
    edges: np.ndarray  # trie node * 256 + byte, in order, the node they lead to, and the token that ends at each node
    nodes: np.ndarray
    ends: np.ndarray


def merge(word: bytes, own: dict[bytes, int], below: int = 1 << 40, least: int = 1) -> list[bytes]:
    """Exact merging: always the leftmost of the pairs of the lowest rank (under ``below``), to ``least`` parts."""
    part, after, before = [word[k : k + 1] for k in range(len(word))], list(range(1, len(word) + 1)), list(range(-1, len(word) - 1))
    heap = [(r, k) for k in range(len(word) - 1) if (r := own.get(word[k : k + 2], below)) < below]
    heapq.heapify(heap)
    left = len(word)
    while heap and left > least:
        r, k = heapq.heappop(heap)
        n = after[k]
        if not part[k] or n >= len(word) or own.get(part[k] + part[n]) != r:
            continue
        part[k] += part[n]
        part[n] = b""
        after[k] = after[n]
        if after[n] < len(word):
            before[after[n]] = k
        left -= 1
        for a, b in ((before[k], k), (k, after[k])):
            if a >= 0 and b < len(word) and (s := own.get(part[a] + part[b], below)) < below:
                heapq.heappush(heap, (s, a))
    return [p for p in part if p]


@lru_cache(2)
def tables(path: str = VOCABULARY) -> Tables:
    own = ranks(path)
    words = sorted(own, key=own.get)
    size = max(own.values()) + 1
    lengths = np.zeros(size, np.int64)
    left, right = np.arange(size), np.arange(size)
    children: dict[int, int] = {}
    ends = [-1]
    for w in words:
        t = own[w]
        lengths[t] = len(w)
        if len(w) > 1 and len(parts := merge(w, own, t, 2)) == 2:
            left[t], right[t] = own[parts[0]], own[parts[1]]
        node = 0
        for byte in w:
            key = node << 8 | byte
            if key not in children:
                children[key] = len(ends)
                ends.append(-1)
            node = children[key]
        ends[node] = t
    joined = np.flatnonzero(left != np.arange(size))
    order = np.argsort(left[joined] * size + right[joined])
    edges = np.array(sorted(children), np.int64)
    flat = np.zeros(int(lengths.sum()), np.uint8)
    starts = np.cumsum(lengths) - lengths
    for w, t in own.items():
        flat[starts[t] : starts[t] + len(w)] = np.frombuffer(w, np.uint8)
    return Tables(hashlib.blake2b(lengths.tobytes() + flat.tobytes(), digest_size=16).digest(), own, flat, starts, lengths, left, right, (left[joined] * size + right[joined])[order], joined[order], edges, np.array([children[k] for k in edges.tolist()], np.int64), np.array(ends, np.int64))


def _look(keys: np.ndarray, values: np.ndarray, at: np.ndarray, none: int) -> np.ndarray:
    k = np.minimum(np.searchsorted(keys, at), len(keys) - 1)
    return np.where(keys[k] == at, values[k], none)


def compatible(a: np.ndarray, b: np.ndarray, t: Tables) -> np.ndarray:
    """Whether merging the bytes of both tokens of each pair gives the two tokens again."""
    a, b = a.astype(np.int64), b.astype(np.int64)
    good, at, limit = np.ones(len(a), bool), np.arange(len(a)), np.full(len(a), NEVER)
    size = len(t.left)
    while len(at):
        early = _look(t.pairs, t.made, a * size + b, NEVER) < limit
        good[at[early]] = False
        stay = ~early
        a, b, at, limit = a[stay], b[stay], at[stay], limit[stay]
        ra, lb = t.right[a], t.left[b]
        open_a, open_b = ra != a, lb != b
        from_a = open_a & ((a > b) | ~open_b)
        from_b = open_b & ~from_a
        # what was merged later is unmerged first; a merge across must come before it, or at the same rank from the left
        limit = np.where(from_a, a, np.where(from_b, b + 1, limit))
        a, b = np.where(from_a, ra, a), np.where(from_b, lb, b)
        more = from_a | from_b
        a, b, at, limit = a[more], b[more], at[more], limit[more]
    return good


def longest(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, t: Tables) -> tuple[np.ndarray, np.ndarray]:
    """Words cut greedily into the longest tokens: the word and the token of each, in order."""
    words, tokens, at = [], [], starts.copy()
    open_ = np.flatnonzero(at < ends)
    while len(open_):
        who, place, node = open_, at[open_], np.zeros(len(open_), np.int64)
        best, far = np.full(len(at), -1), at.copy()
        while len(who):
            node = _look(t.edges, t.nodes, node << 8 | data[place], -1)
            on = node >= 0
            who, place, node = who[on], place[on] + 1, node[on]
            hit = t.ends[node]
            some = hit >= 0
            best[who[some]], far[who[some]] = hit[some], place[some]
            inside = place < ends[who]
            who, place, node = who[inside], place[inside], node[inside]
        words.append(open_)
        tokens.append(best[open_])
        at[open_] = far[open_]
        open_ = open_[at[open_] < ends[open_]]
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word, token = np.concatenate(words), np.concatenate(tokens)
    order = np.argsort(word, kind="stable")
    return word[order], token[order]


def longest_of_one(data: np.ndarray, t: Tables) -> np.ndarray:
    """One word cut greedily into the longest tokens."""
    out, at = [], 0
    for first in range(0, len(data), WINDOW):
        place = np.arange(first, min(len(data), first + WINDOW))
        who, node = place - first, np.zeros(len(place), np.int64)
        best = np.full(len(place), -1)
        while len(who):
            node = _look(t.edges, t.nodes, node << 8 | data[place], -1)
            on = node >= 0
            who, place, node = who[on], place[on] + 1, node[on]
            hit = t.ends[node]
            best[who[hit >= 0]] = hit[hit >= 0]
            inside = place < len(data)
            who, place, node = who[inside], place[inside], node[inside]
        token, size = best.tolist(), t.lengths[best].tolist()
        end = first + len(token)
        while at < end:
            out.append(token[at - first])
            at += size[at - first]
    return np.array(out, np.int64)


def encode_words(words: list[bytes], t: Tables) -> tuple[np.ndarray, np.ndarray, int]:
    """The tokens of all words one after the other, the number of each word's, and how many words were merged exactly."""
    lengths = np.array([len(w) for w in words], np.int64)
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    short, long = np.flatnonzero(lengths <= LONG), np.flatnonzero(lengths > LONG)
    word, token = longest(data, starts[short], ends[short], t)
    alone = [longest_of_one(data[starts[k] : ends[k]], t) for k in long.tolist()]
    word = np.concatenate([short[word], np.repeat(long, [len(x) for x in alone])])
    token = np.concatenate([token, *alone])
    pair = np.flatnonzero(word[1:] == word[:-1])
    distinct, back = np.unique(token[pair] * len(t.left) + token[pair + 1], return_inverse=True)
    ok = compatible(distinct // len(t.left), distinct % len(t.left), t)[back] if len(pair) else np.zeros(0, bool)
    failed = np.zeros(len(words), bool)
    failed[word[pair[~ok]]] = True
    # a token that merging can't make isn't what merging gives, even alone
    failed[word[(t.left[token] == token) & (t.lengths[token] > 1)]] = True
    keep = ~failed[word]
    if len(_EXACT) > KEPT:
        _EXACT.clear()
    exact = []
    for k in np.flatnonzero(failed).tolist():
        key = (t.mark, words[k]) if lengths[k] <= KEPT_BYTES else None
        if (own := _EXACT.get(key)) is None:
            own = [t.ranks[p] for p in merge(words[k], t.ranks)]
            if key:
                _EXACT[key] = own
        exact.append(own)
    word = np.concatenate([word[keep], np.repeat(np.flatnonzero(failed), [len(x) for x in exact])])
    token = np.concatenate([token[keep], np.array([x for own in exact for x in own], np.int64)])
    order = np.argsort(word, kind="stable")
    return token[order], np.bincount(word, minlength=len(words)), int(failed.sum())


def encode(texts: pa.Array, t: Tables) -> tuple[np.ndarray, np.ndarray]:
    """The token ids of all rows one after the other, and the number of each row's."""
    _, offsets = utf8_view(texts)
    ids, counts = [], np.zeros(len(texts), np.int64)
    for i, j in row_slices(offsets, SLICE):
        index: dict[str, int] = {}
        number, sizes = [], []
        for text in texts.slice(i, j - i).to_pylist():
            found = SPLIT.findall(text or "")
            sizes.append(len(found))
            number += [index.setdefault(w, len(index)) for w in found]
        token, each, _ = encode_words([w.encode() for w in index], t)
        word = np.array(number, np.int64)
        first = np.cumsum(each) - each
        ids.append(token[ragged(first[word], each[word])].astype(np.int32))
        counts[i:j] = np.bincount(np.repeat(np.arange(j - i), sizes), weights=each[word], minlength=j - i)
    return np.concatenate(ids) if ids else np.zeros(0, np.int32), counts


def decode(ids: np.ndarray, counts: np.ndarray, t: Tables) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows one after the other, and the n + 1 offsets between them."""
    lengths = t.lengths[ids]
    sums = np.concatenate([[0], np.cumsum(lengths)])
    return t.flat[ragged(t.starts[ids], lengths)], sums[np.concatenate([[0], np.cumsum(counts)])]


def _lists(ids: np.ndarray, counts: np.ndarray, valid: list[bool]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)])
    at = pa.array(offsets, pa.int32(), mask=np.array([not v for v in valid] + [False]))
    return pa.ListArray.from_arrays(at, pa.array(ids, pa.int32()))


def with_token_ids(docs: DataFrame, vocabulary: str = VOCABULARY, name: str = "_bpe") -> DataFrame:
    """``docs`` with a struct of token_ids, n_tokens and round_trip (decoding the ids gives the text's bytes).

    All three are null for a null text; an empty one has no token.
    """
    t = tables(vocabulary)

    def run(texts: pa.Array) -> pa.Array:
        ids, counts = encode(texts, t)
        data, offsets = utf8_view(texts)
        valid = texts.is_valid().to_pylist()
        first = np.concatenate([[0], np.cumsum(counts)])
        same = np.zeros(len(texts), bool)
        # decoded a slice at a time, as the places of its bytes take eight times their room
        for i, j in row_slices(offsets, SLICE):
            back, ends = decode(ids[first[i] : first[j]], counts[i:j], t)
            raw, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            if (ends == at).all():
                wrong = np.concatenate([[0], np.cumsum(back != raw)])
                same[i:j] = wrong[at[1:]] == wrong[at[:-1]]
            else:
                same[i:j] = [back[ends[k] : ends[k + 1]].tobytes() == raw[at[k] : at[k + 1]].tobytes() for k in range(j - i)]
        mask = np.array([not v for v in valid], bool)
        return pa.StructArray.from_arrays([_lists(ids, counts, valid), pa.array(counts, pa.int32(), mask=mask), pa.array(same, mask=mask)], ["token_ids", "n_tokens", "round_trip"])

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    udf = F.arrow_udf(run, "struct<token_ids:array<int>,n_tokens:int,round_trip:boolean>").asNondeterministic()
    return docs.withColumn(name, udf(F.col("text").cast("string")))


def with_decoded(rows: DataFrame, ids: str = "token_ids", vocabulary: str = VOCABULARY, name: str = "text") -> DataFrame:
    """``rows`` with the text of a column of token ids; null for null, U+FFFD for bytes that are no UTF-8."""
    t = tables(vocabulary)

    def run(values: pa.Array) -> pa.Array:
        out = []
        for x in values.to_pylist():
            out.append(None if x is None else decode(np.array(x, np.int64), np.array([len(x)]), t)[0].tobytes().decode("utf-8", "replace"))
        return pa.array(out, pa.string())

    run.__annotations__ = {"values": pa.Array, "return": pa.Array}
    return rows.withColumn(name, F.arrow_udf(run, "string")(F.col(ids)))


def byte_pairs(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row for each document: doc_id, token_ids, n_tokens, round_trip (decoding the ids gives the text's bytes).

    All are null for a null text; an empty one has no token. Repeated rows are encoded each, alike; an empty
    table gives no row; other columns, whatever their names, are left out.
    """
    return with_token_ids(docs.select("doc_id", "text"), vocabulary).select("doc_id", "_bpe.*")
