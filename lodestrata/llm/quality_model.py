"""A quality classifier by co-training.

Two views of a document: its text (shares of trigrams of byte classes, and a few dense shares), and
its metadata (source, stated language, length, and the parts of its page's URL, if a page names the
document's number in its path). Each view has a logistic regression. In each of ``ROUNDS`` rounds both views
score all unlabelled documents, and each hands those that it is most confident of, ``PER_ROUND`` in all, to the
other view's training rows; confidence is calibrated, on labelled rows kept out of training, by Platt scaling,
so a view that knows little hands over nothing. In the end the calibrated logits of both views are combined,
by a logistic regression on the rows kept out, and score all documents.

The one sample is that of the labelled documents, at most ``LABELLED``, those of the least hashes. Features are
made on the executors, so no text goes to the driver. A round is one map over the texts; only ids, metadata
and the text's logit meet labels and URLs, and that once. Fitting is done in numpy on what was labelled or
handed over, whose number doesn't depend on that of the documents.
"""

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.llm.kernel import FOLD, mix, row_slices, rows_of, runs, span_hashes, utf8_view
from lodestrata.llm.scratch import cut

#: At most so many labelled documents (half of each class, where there are as many) are fitted to and calibrated on.
LABELLED, HELD_OUT = 3000, 0.3
#: Rounds, the documents that a view hands over in each at most, and the probability they need.
ROUNDS, PER_ROUND, CONFIDENT, PSEUDO_WEIGHT = 4, 400, 0.95, 0.5
#: Steps of the first fit, and of those that go on from the round before.
STEPS, MORE_STEPS, RATE, DECAY, SEED = 150, 40, 0.05, 1e-3, 5
#: A document is kept at this probability of quality or more.
KEEP = 0.5
KINDS, DENSE = 16, 8
TRIGRAMS = KINDS**3
META_BITS = 10

_KIND = np.full(256, 15, np.uint8)
_KIND[128:] = 5
for _k, _signs in enumerate([b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r", b"", b".", b",", b"!", b"?", b"|", b"*%$&#@^~+=<>", b"\"'`()[]{}", b"-_/\\", b";:"]):
    for _c in _signs:
        _KIND[_c] = _k


@dataclass
class View:
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def calibrated(self, x: np.ndarray) -> np.ndarray:
        return self.slope * (x @ self.weights + self.bias) + self.shift


@dataclass
class Model:
    text: View
    meta: View
    mix: np.ndarray  # weights of the calibrated logits of text and metadata, and the bias


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The trigram of byte classes at each byte but the last two of a row, and its row."""
    kind = _KIND[data].astype(np.uint16)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    if len(data) < 3:
        return np.zeros(0, np.uint16), np.zeros(0, np.int64)
    ok = row[:-2] == row[2:]
    return (kind[:-2] << 8 | kind[1:-1] << 4 | kind[2:])[ok], row[:-2][ok]


def dense(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each row: shares of upper-case letters, digits, line ends, other bytes than ASCII and signs, the
    share of words that repeat the word before, the mean word length (of 10) and log2 of the length (of 20)."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    row = np.repeat(np.arange(n), size)
    kinds = np.bincount(row * KINDS + _KIND[data], minlength=n * KINDS).reshape(n, KINDS) / np.maximum(size, 1)[:, None]
    starts, ends = runs(FOLD[data] != 0, offsets)
    own = rows_of(offsets, starts)
    h = span_hashes(FOLD[data], starts, ends)
    words = np.maximum(np.bincount(own, minlength=n), 1)
    again = np.zeros(len(own), bool)
    again[1:] = (h[1:] == h[:-1]) & (own[1:] == own[:-1])
    return np.stack([kinds[:, 1], kinds[:, 2], kinds[:, 4], kinds[:, 5], kinds[:, 6:].sum(1), np.bincount(own[again], minlength=n) / words, np.bincount(own, weights=ends - starts, minlength=n) / words / 10, np.log2(size + 1) / 20], 1)


def text_features(texts: pa.Array) -> pa.StructArray:
    """The trigrams of each text with their shares, and its dense features."""
    data, offsets = utf8_view(texts)
    n = len(offsets) - 1
    index, value, ends, flat = [], [], np.zeros(n + 1, np.int64), np.zeros((n, DENSE), np.float32)
    for i, j in row_slices(offsets):
        raw, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        t, row = trigrams(raw, at)
        key, count = np.unique(row * TRIGRAMS + t, return_counts=True)
        own = key // TRIGRAMS
        total = np.bincount(row, minlength=j - i)
        index.append(key % TRIGRAMS)
        value.append(count / total[own])
        ends[i + 1 : j + 1] = np.bincount(own, minlength=j - i)
        flat[i:j] = dense(raw, at)
    at = pa.array(np.cumsum(ends), pa.int32())
    some = lambda parts: np.concatenate(parts) if parts else np.zeros(0)
    return pa.StructArray.from_arrays([pa.ListArray.from_arrays(at, pa.array(some(index), pa.int32())), pa.ListArray.from_arrays(at, pa.array(some(value), pa.float32())), pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * DENSE, pa.int32()), pa.array(flat.ravel()))], ["index", "value", "dense"])


def _scaled(shares: np.ndarray) -> np.ndarray:
    """Square roots of shares, in which rare trigrams weigh more."""
    return np.sqrt(shares)


def text_logits(texts: pa.Array, view: View) -> np.ndarray:
    f = text_features(texts)
    at = f.field("index").offsets.to_numpy()
    index, value = f.field("index").flatten().to_numpy(), f.field("value").flatten().to_numpy()
    row = np.repeat(np.arange(len(texts)), np.diff(at))
    z = np.bincount(row, weights=view.weights[index] * _scaled(value), minlength=len(texts)) + f.field("dense").flatten().to_numpy().reshape(-1, DENSE) @ view.weights[TRIGRAMS:]
    return view.slope * (z + view.bias) + view.shift


def meta_tokens(source: str | None, lang: str | None, n_chars: int | None, url: str | None) -> list[str]:
    out = [f"source {source}", f"lang {lang}", f"length {'none' if n_chars is None else int(max(0, n_chars)).bit_length()}"]
    if url:
        scheme, _, rest = url.partition("://")
        host, _, path = rest.partition("/")
        parts = host.split(".")
        out += [f"scheme {scheme}", f"site {parts[0] if len(parts) > 3 else ''}", f"top {parts[-1]}", f"query {'?' in path}", f"anchor {'#' in path}", f"html {'.htm' in path}", f"depth {path.count('/')}"]
    return out


def meta_features(columns: list[pa.Array]) -> tuple[np.ndarray, np.ndarray]:
    """The hashed features of all rows, and the row of each."""
    rows, words = [], []
    for k, x in enumerate(zip(*[c.to_pylist() for c in columns])):
        own = meta_tokens(*x)
        words += own
        rows += [k] * len(own)
    seen: dict[str, int] = {}
    raw = [seen.setdefault(w, len(seen)) for w in words]
    codes = [np.frombuffer(w.encode(), np.uint8) for w in seen]
    data, ends = np.concatenate([np.zeros(0, np.uint8), *codes]), np.cumsum([len(c) for c in codes]).astype(np.int64)
    h = mix(span_hashes(data, ends - np.array([len(c) for c in codes], np.int64), ends)) >> np.uint64(64 - META_BITS)
    return h.astype(np.int64)[np.array(raw, np.int64)], np.array(rows, np.int64)


def _dense_meta(columns: list[pa.Array]) -> np.ndarray:
    x = np.zeros((len(columns[0]), 1 << META_BITS), np.float32)
    f, row = meta_features(columns)
    x[row, f] = 1
    return x


def _fit(x: np.ndarray, y: np.ndarray, w: np.ndarray, before: View | None) -> View:
    """Logistic regression with both classes weighing the same, by Adam on full batches, from ``before`` on."""
    for k in (0, 1):
        w = np.where(y == k, w / max(w[y == k].sum(), 1e-9) / 2, w)
    v = np.append(before.weights, before.bias).astype(np.float32) if before else np.zeros(x.shape[1] + 1, np.float32)
    m, s = np.zeros_like(v), np.zeros_like(v)
    w, y = w.astype(np.float32), y.astype(np.float32)
    for t in range(1, (MORE_STEPS if before else STEPS) + 1):
        g = w * (_sigmoid(x @ v[:-1] + v[-1]) - y)
        g = np.append(g @ x + np.float32(DECAY) * v[:-1], g.sum())
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
        v -= np.float32(RATE) * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)
    return View(v[:-1].astype(np.float64), float(v[-1]))


def _newton(z: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Weights and bias of a small logistic regression with a slight ridge."""
    x = np.column_stack([z, np.ones(len(z))])
    v = np.zeros(x.shape[1])
    for _ in range(30):
        p = _sigmoid(x @ v)
        h = (x * (w * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(v))
        v -= np.clip(np.linalg.solve(h, (w * (p - y)) @ x + 1e-3 * v), -5, 5)
    return v


def _calibrate(view: View, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> View:
    view.slope, view.shift = _newton((x @ view.weights + view.bias)[:, None], y, w).tolist()
    return view


#: The most confident unlabelled rows under both views: for each view, of each class at most so many of those not
#: given to the other yet, as keys, the other view's features of them, and their label.
Pool = Callable[[list[View], list[set], list[int]], list[tuple[list, np.ndarray, np.ndarray]]]


def co_train(text: np.ndarray, meta: np.ndarray, label: np.ndarray, weight: np.ndarray, pool: Pool) -> Model | None:
    """A model from labelled rows of both views and the ``pool`` of all others. ``weight`` undoes the sample's class
    balance in calibration. None unless both classes have a row to fit to and one kept out."""
    rng = np.random.default_rng(SEED)
    held = np.zeros(len(label), bool)
    for k in (0, 1):
        own = rng.permutation(np.flatnonzero(label == k))
        if len(own) < 2:
            return None
        held[own[: max(1, int(len(own) * HELD_OUT))]] = True
    test, base = np.flatnonzero(held), np.flatnonzero(~held)
    views = [text, meta]
    taken: list[set] = [set(), set()]
    given = [[(v[base], label[base], np.ones(len(base)))] for v in views]
    share = float((weight * label).sum() / weight.sum())
    most = [max(1, int(PER_ROUND * x)) for x in (1 - share, share)]

    def fitted(k: int, before: View | None = None) -> View:
        x, y, w = (np.concatenate(z) for z in zip(*given[k]))
        return _calibrate(_fit(x, y, w, before), views[k][test], label[test], weight[test])

    own = [fitted(0), fitted(1)]
    for _ in range(ROUNDS):
        new = pool(own, taken, most)
        for k, (keys, x, y) in enumerate(new):
            taken[1 - k].update(keys)
            given[1 - k].append((x, y, np.full(len(y), PSEUDO_WEIGHT)))
        if not any(len(keys) for keys, _, _ in new):
            break
        own = [fitted(0, own[0]), fitted(1, own[1])]
    both = np.column_stack([v.calibrated(x[test]) for v, x in zip(own, views)])
    return Model(own[0], own[1], _newton(both, label[test], weight[test]))


def _text_udf():
    def features(texts: pa.Array) -> pa.Array:
        return text_features(texts)

    features.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(features, "struct<index:array<int>,value:array<float>,dense:array<float>>").asNondeterministic()


def page_urls(pages: DataFrame) -> DataFrame:
    """The least URL whose path's first number is a document's, by that number (_url_id, _url)."""
    number = F.col("url").cast("string")
    return pages.select(F.regexp_extract(number, r"^[^:]+://[^/]+/(?:[^?#]*?/)?(\d{1,18})(?:[/.?#]|$)", 1).alias("n"), number.alias("u")).filter("n <> ''").groupBy(F.col("n").cast("bigint").alias("_url_id")).agg(F.min("u").alias("_url"))


def _metadata() -> list:
    return [F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), F.col("n_chars").cast("bigint").alias("n_chars")]


def _text_rows(rows: list) -> np.ndarray:
    x = np.zeros((len(rows), TRIGRAMS + DENSE), np.float32)
    for k, r in enumerate(rows):
        x[k, r["index"]] = _scaled(np.array(r.value, np.float32))
        x[k, TRIGRAMS:] = r.dense
    return x


def _meta_rows(rows: list) -> np.ndarray:
    return _dense_meta([pa.array([r[c] for r in rows], kind) for c, kind in (("source", pa.string()), ("lang", pa.string()), ("n_chars", pa.int64()), ("_url", pa.string()))])


def _text_logit(view: View) -> Column:
    def by_text(texts: pa.Array) -> pa.Array:
        return pa.array(text_logits(texts, view))

    by_text.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(by_text, "double").asNondeterministic()(F.col("text").cast("string"))


def _meta_logit(view: View) -> Column:
    def by_metadata(source: pa.Array, lang: pa.Array, n_chars: pa.Array, url: pa.Array) -> pa.Array:
        f, row = meta_features([source, lang, n_chars, url])
        key = np.unique(row * (1 << META_BITS) + f)
        z = np.bincount(key >> META_BITS, weights=view.weights[key & ((1 << META_BITS) - 1)], minlength=len(source))
        return pa.array(view.slope * (z + view.bias) + view.shift)

    by_metadata.__annotations__ = {"source": pa.Array, "lang": pa.Array, "n_chars": pa.Array, "url": pa.Array, "return": pa.Array}
    return F.arrow_udf(by_metadata, "double").asNondeterministic()("source", "lang", "n_chars", "_url")


def fit(docs: DataFrame, known: DataFrame) -> Model | None:
    """A model of documents (doc_id, text) and what is ``known`` of each doc_id (label, null if unlabelled, and metadata); None where a
    class has fewer than two labelled documents. Documents without an id are scored but not learnt from."""
    docs = docs.filter("doc_id is not null")
    counts = {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if min(counts.get(0, 0), counts.get(1, 0)) < 2:
        return None
    mark = F.xxhash64(F.col("doc_id").cast("bigint"))
    first = Window.partitionBy("label").orderBy(mark, "doc_id")
    sample = known.filter("label is not null").withColumn("_rank", F.row_number().over(first)).filter(F.col("_rank") <= LABELLED // 2).drop("_rank").collect()
    by = {r.doc_id: r for r in sample}

    def text_of(ids: list) -> dict:
        """The text's features of the documents given (so many are handed over at most), of the least text of an id."""
        if not ids:
            return {}
        own = docs.filter(F.col("doc_id").isin(ids)).groupBy("doc_id").agg(F.min(F.col("text").cast("string")).alias("text"))
        return {r.doc_id: r for r in own.select("doc_id", _text_udf()("text").alias("f")).select("doc_id", "f.*").collect()}

    texts = text_of(sorted(by))
    own = sorted(texts)
    label = np.array([by[i].label for i in own], np.int64)
    weight = np.array([counts[k] / min(counts[k], LABELLED // 2) for k in label.tolist()])

    def pool(views: list[View], taken: list[set], most: list[int]) -> list[tuple[list, np.ndarray, np.ndarray]]:
        # the least logit counts where an id has several texts
        logits = docs.select("doc_id", _text_logit(views[0]).alias("_t")).groupBy("doc_id").agg(F.min("_t").alias("_t"))
        scored = cut(known.filter("label is null").join(logits, "doc_id").withColumn("_m", _meta_logit(views[1])).select("doc_id", "_t", "_m"))
        out = []
        limit = float(np.log(CONFIDENT / (1 - CONFIDENT)))
        for k, c in enumerate(("_t", "_m")):
            rows = []
            for y, sure in ((1, F.col(c)), (0, -F.col(c))):
                new = scored.filter((sure >= limit) & ~F.col("doc_id").isin(sorted(taken[1 - k])))
                rows += [(r.doc_id, y) for r in new.orderBy(sure.desc(), "doc_id").limit(most[y]).collect()]
            ids = [i for i, _ in rows]
            if k == 0:
                meta = {r.doc_id: r for r in known.filter(F.col("doc_id").isin(ids)).collect()} if ids else {}
                x = _meta_rows([meta[i] for i in ids])
            else:
                handed = text_of(ids)
                x = _text_rows([handed[i] for i in ids])
            out.append((ids, x, np.array([y for _, y in rows], np.int64)))
        return out

    return co_train(_text_rows([texts[i] for i in own]), _meta_rows([by[i] for i in own]), label, weight / weight.mean(), pool)


def with_quality(docs: DataFrame, labels: DataFrame, pages: DataFrame) -> DataFrame:
    """One row for each document: doc_id, text_score, metadata_score (each view's calibrated probability of
    quality), score (of both) and keep.

    A null text counts as an empty one, of no trigram; null metadata are values of their own. Repeated
    rows get the same score. Of contrary labels of one document the lower counts; other labels than 0 and
    1, and labels of no document, are left out. With fewer than two labelled documents of a class there
    is no model: scores are null and all is kept. A document without an id is scored, but not learnt from; of
    one id's several texts, and of equally confident documents, the least counts in training. An empty table
    gives no row; other columns, whatever their names, are left out.
    """
    stated = labels.filter("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("quality").cast("int").alias("label"))
    urls = page_urls(pages)
    least = F.min(F.struct("source", "lang", "n_chars")).alias("m")
    known = docs.filter("doc_id is not null").select("doc_id", *_metadata()).groupBy("doc_id").agg(least).select("doc_id", "m.*")
    known = cut(known.join(stated, "doc_id", "left").join(urls, F.col("doc_id") == F.col("_url_id"), "left").drop("_url_id"))
    model = fit(docs.select("doc_id", "text"), known)
    if model is None:
        none = F.lit(None).cast("double")
        return docs.select("doc_id", none.alias("text_score"), none.alias("metadata_score"), none.alias("score"), F.lit(True).alias("keep"))
    scored = docs.select("doc_id", *_metadata(), _text_logit(model.text).alias("_t"))
    scored = scored.join(urls, F.col("doc_id") == F.col("_url_id"), "left").withColumn("_m", _meta_logit(model.meta))
    a, b, c = model.mix.tolist()
    p = lambda z: F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
    both = p(F.col("_t") * a + F.col("_m") * b + c)
    return scored.select("doc_id", p(F.col("_t")).alias("text_score"), p(F.col("_m")).alias("metadata_score"), both.alias("score"), (both >= KEEP).alias("keep"))
