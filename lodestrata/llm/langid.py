"""Language identification by averaged hashed subword embeddings.

Subwords are the byte n-grams of a word with its boundaries, hashed into a table of embeddings;
a document is the average of its subwords' embeddings, which a linear softmax classifies. Both are
trained by stochastic gradient descent in numpy on a bounded sample of the rows whose language is
stated: of each language the texts of the least hashes, copies counting once, ``SAMPLE_ROWS`` in all but
``LEAST_ROWS`` of each language at least. Their subwords are counted where they are read, so no text goes to the driver. As all is linear up to the softmax, embeddings and classes fold into one score for each
subword and language before scoring (while there are no more languages than dimensions).

Rejection is calibrated on rows kept out of training: a temperature is fitted to the softmax, and
a document goes if its confidence or the share of its subwords known from training is below what
all but ``REJECT_SHARE`` of those rows reach (and below ``SURE`` or ``KNOWN``, so that a model that
separates its languages well doesn't reject what it is fairly sure of).
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.llm.kernel import FOLD, row_slices, utf8_view
from lodestrata.llm.scratch import unused

SIZES, BUCKET_BITS, DIMENSIONS = (2, 3, 4), 17, 16
#: At most so many rows, over all languages, are fitted to and calibrated on, or so many of each language if that is more.
SAMPLE_ROWS, LEAST_ROWS, HELD_OUT = 2400, 8, 0.33
EPOCHS, RATE, SEED = 6, 4.0, 7
REJECT_SHARE, SURE, KNOWN = 0.002, 0.5, 0.6

_LETTER = FOLD.copy()
_LETTER[ord("0") : ord("9") + 1] = 0
_EDGE = 1


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # (scores or embedding, bucket)
    out: np.ndarray | None  # embedding to scores, where the table holds embeddings
    seen: np.ndarray
    temperature: float = 1.0
    least_sure: float = 0.0
    least_known: float = 0.0


def subwords(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all subwords, and the row of each."""
    n = len(offsets) - 1
    row = np.repeat(np.arange(n), np.diff(offsets))
    codes = np.full(len(data) + n + 1, _EDGE, np.uint32)
    where = np.arange(len(data)) + row + 1
    codes[where] = np.maximum(_LETTER[data], _EDGE)
    of = np.zeros(len(codes), np.int64)
    of[where] = row
    of[offsets[1:] + np.arange(1, n + 1)] = np.arange(n)
    of[0] = 0
    letter = codes != _EDGE
    buckets, rows = [], []
    for size in SIZES:
        if len(codes) < size:
            continue
        m = len(codes) - size + 1
        h = np.full(m, size, np.uint32)
        for k in range(size):
            h = h * np.uint32(0x01000193) ^ codes[k : k + m]
        ok = letter[:m] | letter[size - 1 :] if size == 2 else letter[1 : m + 1].copy()
        for k in range(2, size - 1):
            ok &= letter[k : k + m]
        at = np.flatnonzero(ok)
        h = h[at]
        h ^= h >> np.uint32(15)
        buckets.append((h * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - BUCKET_BITS))
        # a subword that begins with the edge before its word belongs to the row of its second code
        rows.append(of[np.minimum(at + 1, len(of) - 1)] if size > 2 else np.where(letter[at], of[at], of[at + 1]))
    return (np.concatenate(buckets), np.concatenate(rows)) if buckets else (np.zeros(0, np.uint32), np.zeros(0, np.int64))


def features(texts: pa.Array) -> pa.StructArray:
    """The buckets of each text and the share of its subwords in each."""
    data, offsets = utf8_view(texts)
    index, value, sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.float32)], [0]
    for i in range(len(texts)):
        own = data[offsets[i] : offsets[i + 1]]
        b, c = np.unique(subwords(own, np.array([0, len(own)]))[0], return_counts=True)
        index.append(b.astype(np.int64))
        value.append((c / max(1, c.sum())).astype(np.float32))
        sizes.append(len(b))
    at = pa.array(np.cumsum(sizes), pa.int32())
    return pa.StructArray.from_arrays([pa.ListArray.from_arrays(at, pa.array(np.concatenate(index), pa.int32())), pa.ListArray.from_arrays(at, pa.array(np.concatenate(value), pa.float32()))], ["index", "value"])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def train(features: list[tuple[np.ndarray, np.ndarray]], langs: list[str]) -> Model | None:
    """A model of the languages from rows' buckets and shares, calibrated on the rows kept out; None without a row."""
    names = sorted(set(langs))
    if not names:
        return None
    rng = np.random.default_rng(SEED)
    order = rng.permutation(len(features))
    held = set(order[: int(len(order) * HELD_OUT)].tolist())
    number = {x: k for k, x in enumerate(names)}
    y = np.array([number[x] for x in langs])
    embed = rng.normal(0, 0.05, (1 << BUCKET_BITS, DIMENSIONS)).astype(np.float32)
    out = rng.normal(0, 0.05, (DIMENSIONS, len(names))).astype(np.float32)
    seen = np.zeros(1 << BUCKET_BITS, bool)
    fit = [i for i in range(len(features)) if i not in held and len(features[i][0])]
    for i in fit:
        seen[features[i][0]] = True
    steps = max(1, EPOCHS * len(fit))
    step = 0
    for _ in range(EPOCHS):
        for i in rng.permutation(np.array(fit, int)).tolist():
            rate = RATE * (1 - step / steps)
            b, x = features[i]
            hidden = x @ embed[b]
            g = _softmax(hidden @ out)
            g[y[i]] -= 1
            back = out @ g
            out -= 0.1 * rate * np.outer(hidden, g)
            embed[b] -= rate * x[:, None] * back
            step += 1
    folded = len(names) <= DIMENSIONS
    model = Model(names, np.ascontiguousarray((embed @ out if folded else embed).T), None if folded else out, seen)
    test = [i for i in held if len(features[i][0])]
    if test:
        z = np.array([(features[i][1] @ embed[features[i][0]]) @ out for i in test])
        known = np.array([features[i][1][seen[features[i][0]]].sum() for i in test])
        grid = np.geomspace(0.05, 20, 61)
        losses = [-np.log(np.maximum(_softmax(z / t)[np.arange(len(test)), y[test]], 1e-12)).mean() for t in grid]
        model.temperature = float(grid[int(np.argmin(losses))])
        sure = _softmax(z / model.temperature).max(1)
        model.least_sure = float(min(SURE, np.quantile(sure, REJECT_SHARE)))
        model.least_known = float(min(KNOWN, np.quantile(known, REJECT_SHARE)))
    return model


def identified(texts: pa.Array, model: Model | None) -> pa.StructArray:
    data, offsets = utf8_view(texts)
    n = len(offsets) - 1
    if model is None:
        return pa.StructArray.from_arrays([pa.nulls(n, pa.string()), pa.nulls(n, pa.float64()), pa.nulls(n, pa.float64()), pa.array([True] * n, pa.bool_())], ["lang", "confidence", "known", "keep"])
    total, known = np.zeros(n), np.zeros(n)
    sums = np.zeros((n, len(model.table)))
    for i, j in row_slices(offsets):
        b, row = subwords(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        total[i:j] = np.bincount(row, minlength=j - i)
        known[i:j] = np.bincount(row[model.seen[b]], minlength=j - i)
        for k, scores in enumerate(model.table):
            sums[i:j, k] = np.bincount(row, weights=scores[b], minlength=j - i)
    mean = sums / np.maximum(total, 1)[:, None]
    p = _softmax((mean if model.out is None else mean @ model.out) / model.temperature)
    some = total > 0
    sure, share = p.max(1), known / np.maximum(total, 1)
    keep = some & (sure >= model.least_sure) & (share >= model.least_known)
    return pa.StructArray.from_arrays([pa.array(np.array(model.languages, object)[p.argmax(1)], pa.string(), mask=~keep), pa.array(sure, mask=~some), pa.array(share, mask=~some), pa.array(keep)], ["lang", "confidence", "known", "keep"])


def fit(docs: DataFrame) -> Model | None:
    """A model of all languages stated in ``docs``, from a bounded sample of its distinct texts, chosen by hash."""
    stated = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    stated = stated.withColumn("h", F.xxhash64("text"))
    counts = {r.lang: r.n for r in stated.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).orderBy("lang").collect()}
    if not counts:
        return None
    each = max(LEAST_ROWS, SAMPLE_ROWS // len(counts))
    # about twice what is wanted passes by its hash (all of a small language); copies, which do so together, meet before they are sent
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1 << 30, int(2 * (each + 8) / max(1, n) * (1 << 30))))])
    near = stated.filter(F.pmod(F.col("h"), F.lit(1 << 30)) <= F.try_element_at(share, F.col("lang"))).groupBy("lang", "h").agg(F.min("text").alias("text"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod(F.col("h"), F.lit(1 << 30)), "h"))

    def count(texts: pa.Array) -> pa.Array:
        return features(texts)

    count.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    udf = F.arrow_udf(count, "struct<index:array<int>,value:array<float>>").asNondeterministic()
    sample = near.withColumn("rank", rank).filter(F.col("rank") <= each).select("lang", "h", udf("text").alias("f")).select("lang", "h", "f.*").toArrow().sort_by([("h", "ascending"), ("lang", "ascending")])
    own = [[np.asarray(x.values) for x in sample.column(c)] for c in ("index", "value")]
    return train(list(zip(*own)), sample.column("lang").to_pylist())


def with_language(docs: DataFrame, name: str = "_language") -> DataFrame:
    """``docs`` with a struct of lang (null if rejected), confidence, known and keep.

    A null or empty text, or one without letters, has no subwords: confidence and known are null and
    it is rejected. Repeated rows get the same answer. Without a single row whose language is stated
    there is no model; then nothing is told and nothing rejected.
    """
    model = fit(docs)

    def identify(texts: pa.Array) -> pa.Array:
        return identified(texts, model)

    identify.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    udf = F.arrow_udf(identify, "struct<lang:string,confidence:double,known:double,keep:boolean>").asNondeterministic()
    return docs.withColumn(name, udf(F.col("text").cast("string")))


def language_id(docs: DataFrame) -> DataFrame:
    """One row for each document: doc_id, language, confidence, known, keep (of nulls, empty texts and repeated rows
    see ``with_language``). Of equally likely languages the first in order is told. An empty table gives no row;
    other columns, whatever their names, are left out."""
    r = "_language"
    return with_language(docs.select("doc_id", "text", "lang"), r).select("doc_id", F.col(f"{r}.lang").alias("language"), f"{r}.confidence", f"{r}.known", f"{r}.keep")


def reject_unknown_language(docs: DataFrame) -> DataFrame:
    """The documents whose language is told, with their own columns, whatever their names; null, empty and
    letterless texts go, repeated rows stay or go together, and an empty table stays empty."""
    r = unused(docs, "_language")
    return with_language(docs, r).filter(F.col(f"{r}.keep")).drop(r)
