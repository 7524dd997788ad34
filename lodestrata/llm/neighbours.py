"""Approximate nearest neighbours by multi-index hashing.

Vectors become binary codes: signs of their projections on a learned rotation (iterative quantisation,
fitted in numpy to a bounded sample). A code is split into substrings, and each is an index of its own.
Two codes at most ``radius`` bits apart are at most ``radius // substrings`` bits apart in one substring at
least, so probing every index with all values within that many bits retrieves every code within the
radius (pigeonhole). What is retrieved is compared in full, then reranked by the floats.

The rows whose key is divisible by ``EVERY`` ask, and all rows answer. Equal vectors are one entry, with the
``k`` + 1 lowest of their keys (no more can be among anyone's nearest), and one question; they are told
apart again in the end. So a vector that a third of all rows share costs no more than any other.

The radius is calibrated to the data: the true neighbours of ``PROBES`` sampled vectors are found in
one exact pass over all vectors, and the radius is the least within which ``RECALL`` of them lie. The number
of substrings is the one of the least work for that radius and row count. A question with fewer than ``k`` others
within the radius (an outlying one, where most rows lie in tight clusters) is compared to all rows instead, in
blocks, so it has ``k`` neighbours if there are so many.

An entry goes to one cell (a substring and its value) for each substring, a question to every probed cell. Cells
are hashed to buckets of about ``BLOCK`` entries, within which entries and questions meet by their cell. A cell
of more than a block (their number is at most ``LARGE``) is cut into blocks of its own, and questions go to all
of them, so no task holds more than a block of entries and one of questions.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.llm.kernel import mix, ragged
from lodestrata.llm.scratch import cut

K, RECALL, PROBES, EVERY = 10, 0.95, 192, 100
#: Rows that the rotation is fitted to, and its rounds.
SAMPLE, ROUNDS, SEED = 4096, 40, 3
#: Bits of a code, entries of a block (more where else there would be more than LARGE large cells).
MAX_BITS, BLOCK, LARGE = 64, 8192, 1 << 18
#: Work of making, sending and sorting a copy of a row, in pairs compared.
COPY = 3000
#: Pairs compared in one vectorised step.
STEP = 1 << 20
#: Buckets of large cells are numbered from here; their blocks to a group of questions.
_OWN, ASKED = 1 << 40, 32


@dataclass
class Plan:
    mean: np.ndarray
    rotation: np.ndarray  # (dimension, bit)
    radius: int
    widths: list[int]  # bits of each substring
    slack: int  # bits by which a probe may differ
    block: int = BLOCK

    @property
    def shifts(self) -> list[int]:
        return np.concatenate([[0], np.cumsum(self.widths)[:-1]]).astype(int).tolist()


def matrix(values: pa.Array | pa.ChunkedArray, dimension: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of the usable rows, and which these are: not null, of the right length, all numbers finite
    and not all zero. ``dimension`` is by default the commonest length."""
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    at = values.offsets.to_numpy() if len(values) else np.zeros(1, np.int32)
    size = np.where(np.array(values.is_valid().to_pylist(), bool), np.diff(at), -1) if len(values) else np.zeros(0, int)
    if dimension is None:
        some = size[size > 0]
        dimension = int(np.bincount(some).argmax()) if len(some) else 0
    ok = np.flatnonzero((size == dimension) & (dimension > 0))
    flat = values.values.to_numpy(zero_copy_only=False).astype(np.float32) if len(values) else np.zeros(0, np.float32)
    x = flat[at[ok][:, None] + np.arange(dimension)].reshape(len(ok), dimension)
    with np.errstate(all="ignore"):
        x = x / np.abs(x).max(1, keepdims=True, initial=0)
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
    good = np.isfinite(x).all(1) & (dimension > 0)
    return x[good], ok[good]


def learned_rotation(x: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Mean and rotation (onto principal directions, then turned so that signs lose least)."""
    mean = x.mean(0)
    _, axes = np.linalg.eigh(np.cov((x - mean).T, bias=True).reshape(x.shape[1], -1))
    axes = axes[:, ::-1][:, :MAX_BITS]
    z = (x - mean) @ axes
    turn = np.linalg.qr(np.random.default_rng(SEED).normal(size=(axes.shape[1],) * 2))[0]
    for _ in range(rounds):
        u, _, v = np.linalg.svd(np.where(z @ turn >= 0, 1.0, -1.0).T @ z)
        turn = (u @ v).T
    return mean.astype(np.float32), (axes @ turn).astype(np.float32)


def codes(x: np.ndarray, mean: np.ndarray, rotation: np.ndarray) -> np.ndarray:
    bits = np.zeros((len(x), MAX_BITS), np.uint8)
    bits[:, : rotation.shape[1]] = (x - mean) @ rotation >= 0
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()


def split(bits: int, parts: int) -> list[int]:
    return [bits // parts + (k < bits % parts) for k in range(parts)]


def cheapest(radius: int, bits: int, entries: int, questions: int) -> tuple[list[int], int]:
    """Widths of the substrings and the slack of a probe, of the least work; all keep the pigeonhole promise."""
    best = None
    for parts in range(1, min(bits, radius + 1) + 1):
        slack, widths = radius // parts, split(bits, parts)
        probes = [sum(comb(w, k) for k in range(min(slack, w) + 1)) for w in widths]
        work = (entries * parts + questions * sum(probes)) * COPY + entries * questions * sum(p / (1 << w) for p, w in zip(probes, widths))
        if best is None or work < best[0]:
            best = work, widths, slack
    return best[1], best[2]


def within(width: int, slack: int) -> np.ndarray:
    """All patterns of at most ``slack`` bits."""
    out = [np.zeros(1, np.uint64)]
    for _ in range(min(slack, width)):
        # a further bit, above those that are set
        out.append(np.concatenate([out[-1][out[-1] < np.uint64(1 << k)] | np.uint64(1 << k) for k in range(width)]))
    return np.concatenate(out)


def _exact(queries: np.ndarray, dimension: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each batch (v, n, least), the nearest vectors to each query, K rows of them without the query's own."""
    best = None
    for batch in batches:
        x, at = matrix(batch.column(0), dimension)
        many, least = np.minimum(batch.column(1).to_numpy()[at], K + 1), batch.column(2).to_numpy()[at]
        s = np.round(queries @ x.T, 6)
        top = np.lexsort((np.broadcast_to(least, s.shape), -s))[:, : K + 1]
        new = [np.take_along_axis(s, top, 1), many[top], least[top], x[top] if len(x) else np.zeros((len(queries), 0, dimension), np.float32)]
        if best is not None:
            new = [np.concatenate(z, 1) for z in zip(best, new)]
            top = np.lexsort((new[2], -new[0]))[:, : K + 1]
            new = [np.take_along_axis(z, top[:, :, None] if z.ndim == 3 else top, 1) for z in new]
        best = new
    if best is not None and best[0].size:
        q = np.repeat(np.arange(len(queries)), best[0].shape[1])
        yield pa.record_batch([pa.array(q, pa.int32()), pa.array(best[0].ravel(), pa.float32()), pa.array(-best[2].ravel(), pa.int64()), pa.array(best[1].ravel(), pa.int64()), pa.array(list(best[3].reshape(-1, dimension)), pa.list_(pa.float32()))], ["query", "cosine", "first", "n", "v"])


def prepared(vectors: DataFrame, questions: int, k: int = K, recall: float = RECALL) -> Plan | None:
    """The rotation, radius and substrings for distinct ``vectors`` (v, n, least); None unless two rows are usable."""
    mark = F.pmod(F.xxhash64("v"), F.lit(1 << 30))
    total = vectors.count()
    sample = vectors.filter(mark <= int(min(1.0, SAMPLE / max(1, total)) * (1 << 30))).orderBy(mark, "v").limit(2 * SAMPLE).select("v", "n").toArrow()
    x, at = matrix(sample.column("v"))
    if not len(x) or (len(x) == 1 and sample.column("n")[int(at[0])].as_py() < 2):
        return None
    dimension = x.shape[1]
    mean, rotation = learned_rotation(x)
    queries = x[:PROBES]

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _exact(queries, dimension, batches)

    found = vectors.select("v", "n", "least").mapInArrow(exact, "query int, cosine float, first bigint, n bigint, v array<float>")
    top = found.groupBy("query").agg(F.slice(F.sort_array(F.collect_list(F.struct("cosine", "first", "n", "v")), False), 1, k + 1).alias("top")).collect()
    apart = [np.zeros(1, np.int64)]
    for t in top:
        # the query itself is left out, and its copies count as neighbours
        far = np.bitwise_count(codes(np.array([r.v for r in t.top], np.float32), mean, rotation) ^ codes(queries[t["query"]][None], mean, rotation))
        many = np.array([r.n for r in t.top])
        many[np.argmax(far == 0)] -= far.min() == 0
        many = np.minimum(many, np.maximum(0, k - (np.cumsum(many) - many)))
        apart.append(np.repeat(far.astype(np.int64), many))
    radius = int(np.quantile(np.concatenate(apart), recall, method="higher"))
    widths, slack = cheapest(radius, rotation.shape[1], total, questions)
    return Plan(mean, rotation, radius, widths, slack, max(BLOCK, total * len(widths) // LARGE))


def _value(code: np.ndarray, plan: Plan, part: int) -> np.ndarray:
    """The cell of each code for a substring: a hash of both, in which two cells of a bucket differ surely enough
    (where they don't, all of their pairs are compared, and those that aren't near are left out)."""
    own = code >> np.uint64(plan.shifts[part]) & np.uint64((1 << plan.widths[part]) - 1)
    return mix(own * np.uint64(64) + np.uint64(part) if plan.widths[part] < 58 else own ^ np.uint64(part)).view(np.int64)


def _raw(x: np.ndarray, code: np.ndarray) -> np.ndarray:
    return np.concatenate([code.view(np.uint8).reshape(-1, 8), np.ascontiguousarray(x, np.float32).view(np.uint8).reshape(len(x), -1)], 1)


def _binary(raw: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(raw.shape[1]), len(raw), [None, pa.py_buffer(np.ascontiguousarray(raw).tobytes())]).cast(pa.binary())


def _sizes(plan: Plan, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many entries of each batch lie in each cell."""
    for batch in batches:
        x, _ = matrix(batch.column(0), len(plan.mean))
        code = codes(x, plan.mean, plan.rotation)
        for part in range(len(plan.widths)):
            cell, n = np.unique(_value(code, plan, part), return_counts=True)
            yield pa.record_batch([pa.array(cell), pa.array(n.astype(np.int64))], ["cell", "n"])


def _send(plan: Plan, large: tuple[np.ndarray, np.ndarray], buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Copies of the vectors: to one bucket or block of its cell as an entry, and, if it asks, to all blocks of each probed cell."""
    cells, counts = large
    patterns = [within(w, plan.slack) for w in plan.widths]
    for batch in batches:
        for first in range(0, batch.num_rows, 1 << 12):
            piece = batch.slice(first, 1 << 12)
            x, at = matrix(piece.column(0), len(plan.mean))
            if not len(x):
                continue
            code = codes(x, plan.mean, plan.rotation)
            number, least = piece.column(1).to_numpy()[at], piece.column(3).to_numpy()[at]
            asks = np.flatnonzero(piece.column(2).to_numpy(zero_copy_only=False)[at])
            raw, spread = _raw(x, code), (mix(number.view(np.uint64)) >> np.uint64(24)).astype(np.int64)
            for part in range(len(plan.widths)):
                for ask, who, change in [(False, np.arange(len(code)), np.zeros(1, np.uint64)), (True, asks, patterns[part])]:
                    for p in range(0, len(change) if len(who) else 0, max(1, (1 << 14) // max(1, len(who)))):
                        some = change[p : p + max(1, (1 << 14) // max(1, len(who)))]
                        own = np.repeat(who, len(some))
                        cell = _value(code[own] ^ np.tile(some << np.uint64(plan.shifts[part]), len(who)), plan, part)
                        k = np.minimum(np.searchsorted(cells, cell), max(0, len(cells) - 1))
                        blocks = np.where(cells[k] == cell, counts[k], 1) if len(cells) else np.ones(len(cell), np.int64)
                        group = np.where(blocks > 1, k + _OWN, (cell.view(np.uint64) % np.uint64(buckets)).astype(np.int64))
                        # a question goes to all blocks of its group, an entry to one block of all groups
                        groups = -(-blocks // ASKED)
                        many, one = (blocks, groups) if ask else (groups, blocks)
                        each = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                        mine = np.repeat(spread[own] % one, many)
                        block, asked = (each, mine) if ask else (mine, each)
                        to = np.repeat(np.arange(len(own)), many)
                        yield pa.record_batch([pa.array(group[to]), pa.array(block, pa.int32()), pa.array(asked, pa.int32()), pa.array(cell[to]), pa.array(np.full(len(to), part), pa.int32()), pa.array(np.full(len(to), ask)), pa.array(number[own[to]]), pa.array(least[own[to]]), _binary(raw[own[to]])], ["bucket", "block", "asked", "cell", "part", "asks", "number", "least", "raw"])


def pairs_of(q: np.ndarray, e: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of questions and entries in the same cell (both sorted), about STEP at a time."""
    low, high = np.searchsorted(e, q, "left"), np.searchsorted(e, q, "right")
    total = np.concatenate([[0], np.cumsum(high - low)])
    a = 0
    while a < len(q):
        b = max(a + 1, int(np.searchsorted(total, total[a] + STEP, "right")) - 1)
        yield np.repeat(np.arange(a, b), (high - low)[a:b]), ragged(low[a:b], (high - low)[a:b])
        a = b


def nearest(query: np.ndarray, asks: np.ndarray, entry: np.ndarray, least: np.ndarray, plan: Plan, part: np.ndarray, cells: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each query the ``k`` + 1 nearest entries in its cell and within the radius, that no substring before its
    ``part`` retrieves: indices of both, and the cosine (6 digits), of equal ones those of the lower ``least``.
    Rows are a code and floats, as bytes; ``asks`` tells the queries apart."""
    order = [np.argsort(c, kind="stable") for c in cells]
    qc, ec = (np.ascontiguousarray(r[o][:, :8]).view(np.uint64).ravel() for r, o in zip((query, entry), order))
    qx, ex = (np.ascontiguousarray(r[o][:, 8:]).view(np.float32) for r, o in zip((query, entry), order))
    asks, least, part = asks[order[0]], least[order[1]], part[order[0]]
    masks = [(np.uint64(((1 << w) - 1) << s), min(plan.slack, w)) for w, s in zip(plan.widths, plan.shifts)]
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for i, j in pairs_of(cells[0][order[0]], cells[1][order[1]]):
        x = qc[i] ^ ec[j]
        near = np.flatnonzero(np.bitwise_count(x) <= plan.radius)
        i, j, x = i[near], j[near], x[near]
        for p, (mask, slack) in enumerate(masks[:-1]):
            late = (part[i] <= p) | (np.bitwise_count(x & mask) > slack)
            i, j, x = i[late], j[late], x[late]
        cosine = np.round(np.concatenate([np.zeros(0, np.float32), *[np.einsum("nd,nd->n", qx[i[z : z + 65536]], ex[j[z : z + 65536]]) for z in range(0, len(i), 65536)]]), 6)
        best = np.lexsort([least[j], -cosine, i])
        i = i[best]
        keep = np.arange(len(i)) - np.searchsorted(i, i) <= k
        out.append((i[keep], j[best][keep], cosine[best][keep]))
    if not out:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0, np.float32)
    # a query may be in several cells of a bucket
    i, j, cosine = (np.concatenate(z) for z in zip(*out))
    best = np.lexsort([least[j], -cosine, asks[i]])
    own = asks[i][best]
    keep = best[np.arange(len(own)) - np.searchsorted(own, own) <= k]
    return order[0][i[keep]], order[1][j[keep]], cosine[keep]


def _meet(plan: Plan, k: int, group: pa.Table) -> pa.Table:
    asks, number = group.column("asks").to_numpy(), group.column("number").to_numpy()
    cell, part, least = (group.column(c).to_numpy() for c in ("cell", "part", "least"))
    q, e = np.flatnonzero(asks), np.flatnonzero(~asks)
    if len(q) and len(e):
        raw = np.frombuffer(b"".join(group.column("raw").to_pylist()), np.uint8).reshape(len(asks), -1)
        i, j, cosine = nearest(raw[q], number[q], raw[e], least[e], plan, part[q], (cell[q], cell[e]), k)
    else:
        i, j, cosine = np.zeros(0, int), np.zeros(0, int), np.zeros(0, np.float32)
    return pa.table({"asks": pa.array(number[q[i]], pa.int64()), "answers": pa.array(number[e[j]], pa.int64()), "least": pa.array(least[e[j]], pa.int64()), "cosine": pa.array(cosine, pa.float32())})


RESULT = "asks bigint, answers bigint, least bigint, cosine float"


def _all_pairs(vectors: DataFrame, asking: DataFrame, plan: Plan, k: int) -> DataFrame:
    """Pairs of each question of ``asking`` (asks) and its nearest of all vectors: blocks of questions meet blocks of entries."""
    n, m = vectors.count(), asking.count()
    entries, groups = max(1, -(-n // BLOCK)), max(1, -(-m // BLOCK))
    every = Plan(plan.mean, plan.rotation, MAX_BITS, [MAX_BITS], MAX_BITS)
    spread = lambda count: F.pmod(F.xxhash64("number"), F.lit(count)).cast("int")
    each = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    asks = vectors.join(asking.select(F.col("asks").alias("number")), "number", "left_semi").select("number", "least", "v", spread(groups).alias("asked"), each(entries).alias("block"), F.lit(True).alias("asks"))
    answers = vectors.select("number", "least", "v", each(groups).alias("asked"), spread(entries).alias("block"), F.lit(False).alias("asks"))

    def meet(group: pa.Table) -> pa.Table:
        x, at = matrix(group.column("v"), len(plan.mean))
        none = pa.array(np.zeros(len(at), np.int64))
        raw = _binary(_raw(x, codes(x, plan.mean, plan.rotation))) if len(at) else pa.array([], pa.binary())
        return _meet(every, k, group.select(["number", "least", "asks"]).take(pa.array(at)).append_column("raw", raw).append_column("cell", none).append_column("part", none))

    meet.__annotations__ = {"group": pa.Table, "return": pa.Table}
    return asks.unionByName(answers).groupBy("block", "asked").applyInArrow(meet, RESULT)


def _top(pairs: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """asks, its k + 1 nearest keys of all rows (neighbour) and their cosine."""
    own = Window.partitionBy("asks").orderBy(F.desc("cosine"), "least", "answers")
    few = pairs.withColumn("rank", F.row_number().over(own)).filter(F.col("rank") <= k + 1)
    each = few.join(ids, F.col("answers") == F.col("number")).select("asks", F.explode("ids").alias("neighbour"), "cosine").groupBy("asks", "neighbour").agg(F.max("cosine").alias("cosine"))
    return each.withColumn("rank", F.row_number().over(Window.partitionBy("asks").orderBy(F.desc("cosine"), "neighbour"))).filter(F.col("rank") <= k + 1).drop("rank")


def entries_of(rows: DataFrame, k: int, asking: Column) -> DataFrame:
    """The distinct vectors of ``rows`` (id, v): v, number, least (its lowest key), ids (its k + 1 lowest), n (of these), asks."""
    # a key that is repeated counts once, and each task keeps but the lowest keys of a vector before it sends them
    lowest = Window.partitionBy("v").orderBy("id")
    few = rows.groupBy("v", "id").agg(F.lit(1).alias("one")).drop("one").withColumn("rank", F.row_number().over(lowest)).filter(F.col("rank") <= k + 1)
    asked = rows.filter(asking).select("v").distinct().withColumn("asks", F.lit(True))
    held = few.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids")).join(asked, "v", "left")
    return cut(held.select("v", F.monotonically_increasing_id().alias("number"), F.get("ids", F.lit(0)).cast("bigint").alias("least"), "ids", F.size("ids").cast("bigint").alias("n"), F.coalesce("asks", F.lit(False)).alias("asks")))


def neighbours(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", k: int = K, recall: float = RECALL, every: int = EVERY) -> DataFrame:
    """For every row whose key is divisible by ``every``, its ``k`` nearest others of all rows by cosine: key, neighbour,
    rank (from 1), cosine (6 digits).

    Of equal cosines the lower key comes first. A key that is repeated with the same vector counts once; one
    with several vectors is answered by the nearest of them, and is never its own neighbour. A row whose
    key or vector is null, or whose vector has another length than most, a number that isn't finite or only
    zeros, neither asks nor answers. Fewer than two usable rows give no row. Other columns, whatever their names,
    are left out. The search is approximate: neighbours beyond the radius, 1 - ``recall`` of them on the
    calibration sample, are missed, but a row that has fewer than ``k`` within it gets its exact neighbours.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(key).alias("id"), F.col(column).cast("array<float>").alias("v")).filter("id is not null and v is not null")
    kind = rows.schema["id"].dataType.simpleString()
    asking = F.col("id") % every == 0
    entries = entries_of(rows, k, asking)
    plan = prepared(entries, entries.filter("asks").count(), k, recall)
    if plan is None:
        return spark.createDataFrame([], f"{key} {kind}, neighbour {kind}, rank int, cosine double")

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _sizes(plan, batches)

    counted = entries.select("v").mapInArrow(sizes, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).filter(F.col("n") > plan.block).orderBy("cell").collect()
    large = np.array([r.cell for r in counted], np.int64), np.array([-(-r.n // plan.block) for r in counted], np.int64)
    buckets = max(1, entries.count() * len(plan.widths) // plan.block)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _send(plan, large, buckets, batches)

    def meet(group: pa.Table) -> pa.Table:
        return _meet(plan, k, group)

    meet.__annotations__ = {"group": pa.Table, "return": pa.Table}
    sent = entries.select("v", "number", "asks", "least").mapInArrow(send, "bucket bigint, block int, asked int, cell bigint, part int, asks boolean, number bigint, least bigint, raw binary")
    ids = entries.select("number", "ids")
    found = cut(_top(sent.groupBy("bucket", "block", "asked").applyInArrow(meet, RESULT), ids, k))
    full = found.groupBy("asks").agg(F.count("*").alias("n")).filter(F.col("n") > k).select("asks")
    short = cut(entries.filter("asks").select(F.col("number").alias("asks"), "v").join(full, "asks", "left_anti").select("asks"))
    if not short.isEmpty():
        found = found.join(full, "asks", "left_semi").unionByName(_top(_all_pairs(entries.select("number", "least", "v"), short, plan, k), ids, k))
    who = rows.filter(asking).distinct().join(entries.filter("asks").select("v", F.col("number").alias("asks")), "v").select(F.col("id").alias("_id"), "asks")
    each = who.join(found, "asks").filter("_id <> neighbour").groupBy("_id", "neighbour").agg(F.max("cosine").alias("cosine"))
    ranked = each.withColumn("rank", F.row_number().over(Window.partitionBy("_id").orderBy(F.desc("cosine"), "neighbour"))).filter(F.col("rank") <= k)
    return ranked.select(F.col("_id").alias(key), "neighbour", "rank", F.round(F.col("cosine").cast("double"), 6).alias("cosine"))
