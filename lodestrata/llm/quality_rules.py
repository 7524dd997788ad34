"""Quality rules by distribution divergence.

A document's character-class histogram and common-word histogram are compared to those of its
language by the Jensen-Shannon distance. The reference of a language is the mean of the
normalised histograms of all its documents that are long enough, so a huge document weighs no more
than another. A histogram of few items strays from its source by chance, which is allowed on top of
the limit; one of fewer items than its guard isn't judged at all. For classes the allowance is the mean
of the squared distance of ``n`` draws over ``k`` bins, (k - 1) / (8 n ln 2). For words, most of which
are rare, it is the ``QUANTILE`` of the squared distance of ``n`` words drawn from the reference itself,
and the histogram is judged a second time with the words expected less than once in ``n`` as one bin:
apart they tell nothing in a short text, but together that it has none.

The common words of the languages of ``COMMON_WORDS`` are listed; those of any other stated language
are the ``TOP`` words that most of its documents hold. A language with fewer than ``LEAST`` documents to
compare to has no such list and no reference, and nothing of it is rejected but what is blank.

The passes only map over the documents; what is gathered between them is one number for each
stated language and bin (and, before, the documents of each word of the languages that aren't listed).
"""

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.llm.kernel import row_slices, rows_of, runs, span_hashes, utf8_view
from lodestrata.llm.scratch import unused

CLASSES = ("lower", "upper", "letter", "number", "space", "punctuation", "symbol", "other")
COMMON_WORDS = {
    "de": "aber als am an auch auf aus bei bin das dass dem den der des die durch ein eine einem einen einer er es für hat ich im in ist mit nach nicht noch nur oder sich sie sind so um und uns von war wie wir wird zu zum zur über".split(),
    "en": "a all an and are as at be been but by can for from had has have he her his i if in is it its more not of on one or she so that the their there they this to was we were which who will with would you".split(),
    "es": "al como con de del el ella en entre era es esta este fue ha hay la las le lo los me mi muy más no nos o para pero por porque que se ser si sin sobre son su sus también te tiene un una y ya yo".split(),
    "fr": "a au aux avec ce ces cette comme dans de des du elle en est et il ils je la le les leur lui mais me même ne nous on ou par pas plus pour qu que qui sa se ses si son sont sur tout un une vous y à été".split(),
}
#: Limits of the two distances, and the least letters and words by which a histogram is judged.
MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE, MIN_CHARS, MIN_WORDS = 0.21, 0.2, 200, 20
#: Of the distances of words drawn from a reference, and the draws by which it is found, at lengths that grow by STEP.
QUANTILE, DRAWS, STEP, LONGEST = 0.95, 1000, 1.2, 20_000
#: Common words of a language that isn't listed, and the documents from which they can be told.
TOP, LEAST = 60, 30
#: Histograms are summed as integers of this unit, so that the sums don't depend on their order.
UNIT = 1e9

_WHITE = {9, 10, 11, 12, 13, 32}
_KIND = {"Ll": 0, "Lu": 1, "Lt": 2, "Lm": 2, "Lo": 2, "N": 3, "P": 5, "S": 6}


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """The class and the lower-case form of every code point."""
    kinds, lower = np.full(0x110000, 7, np.uint8), np.arange(0x110000, dtype=np.uint32)
    for c in range(0x110000):
        name = unicodedata.category(x := chr(c))
        kinds[c] = 4 if c in _WHITE else _KIND.get(name, _KIND.get(name[0], 7))
        if name == "Lu" and len(x.lower()) == 1:
            lower[c] = ord(x.lower())
    return kinds, lower


@lru_cache(1)
def _vocabulary() -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """Sorted hashes of all common words, the column of each, and the columns of each language."""
    words = sorted({w for own in COMMON_WORDS.values() for w in own})
    codes = np.array([ord(c) for w in words for c in w], np.uint64)
    ends = np.cumsum([len(w) for w in words])
    hashes = span_hashes(codes, ends - [len(w) for w in words], ends)
    order = np.argsort(hashes)
    return hashes[order], order, {k: np.array([words.index(w) for w in own]) for k, own in COMMON_WORDS.items()}


def histograms(texts: pa.Array, own_words: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row the counts of character classes, the number of words, and the counts of common words:
    those of ``COMMON_WORDS``, or of the sorted hashes ``own_words``."""
    data, offsets = utf8_view(texts)
    kinds, lower = _tables()
    hashes, column = _vocabulary()[:2] if own_words is None else (own_words, np.arange(len(own_words)))
    n = len(offsets) - 1
    classes, words, common = np.zeros((n, len(CLASSES)), np.int64), np.zeros(n, np.int64), np.zeros((n, len(hashes)), np.int64)
    for i, j in row_slices(offsets):
        raw = data[offsets[i] : offsets[j]]
        first = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        at = first[offsets[i : j + 1] - offsets[i]]
        codes = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        kind = kinds[codes]
        row = np.repeat(np.arange(j - i), np.diff(at))
        classes[i:j] = np.bincount(row * 8 + kind, minlength=8 * (j - i)).reshape(-1, 8)
        starts, ends = runs(kind <= 2, at)
        own = rows_of(at, starts)
        words[i:j] = np.bincount(own, minlength=j - i)
        h = span_hashes(lower[codes], starts, ends)
        k = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
        hit = hashes[k] == h
        common[i:j] = np.bincount(own[hit] * len(hashes) + column[k[hit]], minlength=len(hashes) * (j - i)).reshape(-1, len(hashes))
    return classes, words, common


def _own(words: np.ndarray, common: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """The common-word histogram of one language, the last bin holding all other words."""
    counts = common[:, columns]
    return np.concatenate([counts, (words - counts.sum(1))[:, None]], 1)


def _distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each batch and language the hashes of words, and how many documents hold them."""
    kinds, lower = _tables()
    for batch in batches:
        names, number = np.unique(np.array(batch.column(1).to_pylist(), str), return_inverse=True)
        data, offsets = utf8_view(batch.column(0))
        for i, j in row_slices(offsets):
            raw = data[offsets[i] : offsets[j]]
            first = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
            at = first[offsets[i : j + 1] - offsets[i]]
            codes = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
            starts, ends = runs(kinds[codes] <= 2, at)
            row, many = rows_of(at, starts), np.bincount(rows_of(at, starts), minlength=j - i)
            ok = many[row] >= MIN_WORDS
            pair = np.unique(np.stack([row[ok].astype(np.uint64), span_hashes(lower[codes], starts[ok], ends[ok])], 1), axis=0)
            held, n = np.unique(np.stack([number[i + pair[:, 0].astype(np.int64)].astype(np.uint64), pair[:, 1]], 1), axis=0, return_counts=True)
            yield pa.record_batch([pa.array(names[held[:, 0].astype(np.int64)].tolist(), pa.string()), pa.array(held[:, 1].copy().view(np.int64)), pa.array(n)], ["lang", "word", "n"])


def found_words(texts: DataFrame) -> dict[str, np.ndarray]:
    """By stated language that isn't listed, the sorted hashes of its TOP commonest words, counted over all documents."""
    others = texts.filter(F.col("lang").isNotNull() & ~F.col("lang").isin(*COMMON_WORDS))
    if others.select("lang").isEmpty():
        return {}
    counts = others.mapInArrow(_distinct_words, "lang string, word bigint, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    out: dict[str, list[int]] = {}
    for r in counts.withColumn("rank", rank).filter(F.col("rank") <= TOP).collect():
        out.setdefault(r.lang, []).append(r.word)
    return {k: np.sort(np.array(v, np.int64).view(np.uint64)) for k, v in sorted(out.items())}


def _share(counts: np.ndarray) -> np.ndarray:
    return counts / np.maximum(counts.sum(1, keepdims=True), 1)


def _counts(texts: pa.Array, rows: np.ndarray, name: str, found: dict[str, np.ndarray], listed: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The rows' common-word histograms of one language; ``listed`` has all rows' words and listed common words."""
    if name in COMMON_WORDS:
        return _own(listed[0][rows], listed[1][rows], _vocabulary()[2][name])
    own = found.get(name, np.zeros(0, np.uint64))
    if not len(own):
        return listed[0][rows][:, None]
    _, words, common = histograms(texts.take(pa.array(np.flatnonzero(rows))), own)
    return _own(words, common, np.arange(len(own)))


def _partial(found: dict[str, np.ndarray], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[tuple[str, str, int], int] = {}
    for batch in batches:
        classes, words, common = histograms(batch.column(0))
        lang = np.array(batch.column(1).to_pylist(), object)
        for name in sorted({x for x in lang.tolist() if x is not None}):
            mine = lang == name
            for kind, counts, least in (("class", classes[mine], MIN_CHARS), ("word", _counts(batch.column(0), mine, name, found, (words, common)), MIN_WORDS)):
                ok = counts.sum(1) >= least
                for k, v in enumerate(np.rint(_share(counts[ok]) * UNIT).astype(np.int64).sum(0).tolist()):
                    sums[name, kind, k] = sums.get((name, kind, k), 0) + v
                sums[name, kind, -1] = sums.get((name, kind, -1), 0) + int(ok.sum())
    keys = list(sums)
    yield pa.record_batch([pa.array([x[0] for x in keys], pa.string()), pa.array([x[1] for x in keys], pa.string()), pa.array([x[2] for x in keys], pa.int32()), pa.array([sums[x] for x in keys], pa.int64())], ["lang", "kind", "bin", "total"])


def references(docs: DataFrame, words: dict[str, np.ndarray] | None = None) -> dict[str, dict[str, np.ndarray]]:
    """By language and kind (class, word) the mean histogram; a language without long enough documents has none.
    ``words`` are the common words of the languages that aren't listed."""
    texts = docs.select(F.col("text").cast("string"), F.col("lang").cast("string"))
    words = found_words(texts) if words is None else words

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _partial(words, batches)

    found: dict[str, dict[str, dict[int, int]]] = {}
    for r in texts.mapInArrow(partial, "lang string, kind string, bin int, total bigint").groupBy("lang", "kind", "bin").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect():
        found.setdefault(r.kind, {}).setdefault(r.lang, {})[r.bin] = int(r.total)
    return {kind: {k: np.array([v[b] for b in range(len(v) - 1)]) / UNIT / v[-1] for k, v in sorted(by.items()) if v[-1] >= (1 if k in COMMON_WORDS else LEAST)} for kind, by in found.items()}


@lru_cache(1)
def _lengths() -> np.ndarray:
    """The numbers of words for which the allowance is drawn."""
    return np.unique((MIN_WORDS * STEP ** np.arange(np.log(LONGEST / MIN_WORDS) / np.log(STEP) + 1)).astype(int))


def merged(counts: np.ndarray, reference: np.ndarray, n: int) -> np.ndarray:
    """The histograms with the words expected less than once in ``n`` as one bin."""
    rare = reference * n < 1
    rare[-1] = False
    return np.concatenate([counts[:, ~rare], counts[:, rare].sum(1, keepdims=True)], 1)


def chance(reference: np.ndarray) -> np.ndarray:
    """For each of the lengths the QUANTILE of the squared distance of words drawn from the reference, of all bins and merged."""
    rng, out = np.random.default_rng(1), []
    for n in _lengths().tolist():
        counts = rng.multinomial(n, reference / reference.sum(), DRAWS)
        both = distances(counts, reference), distances(merged(counts, reference, n), merged(reference[None], reference, n)[0])
        out.append([np.quantile(d**2, QUANTILE) for d in both])
    return np.array(out)


def strays(counts: np.ndarray, distance: np.ndarray, reference: np.ndarray, allowed: np.ndarray) -> np.ndarray:
    """Whether each row's words are beyond the limit and the allowance, by all bins or merged."""
    at = np.maximum(np.searchsorted(_lengths(), counts.sum(1), "right") - 1, 0)
    out = distance**2 > MAX_WORD_DISTANCE**2 + allowed[at, 0]
    for k in np.unique(at).tolist():
        own, n = at == k, int(_lengths()[k])
        out[own] |= distances(merged(counts[own], reference, n), merged(reference[None], reference, n)[0]) ** 2 > MAX_WORD_DISTANCE**2 + allowed[k, 1]
    return out


def distances(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distances (base 2, from 0 to 1) of each row's histogram to the reference."""
    p = _share(counts)
    m = (p + reference) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        a = np.where(p > 0, p * np.log2(p / m), 0).sum(1)
        b = np.where(reference > 0, reference * np.log2(reference / m), 0).sum(1)
    return np.sqrt(np.maximum(0, (a + b) / 2))


def judged(texts: pa.Array, langs: pa.Array, refs: dict[str, dict[str, np.ndarray]], allowed: dict[str, np.ndarray], found: dict[str, np.ndarray]) -> pa.StructArray:
    classes, words, common = histograms(texts)
    lang = np.array(langs.to_pylist(), object)
    unstated = np.array([x is None for x in lang.tolist()], bool)
    out, over = {}, {}
    for kind, least, limit in (("class", MIN_CHARS, MAX_CLASS_DISTANCE), ("word", MIN_WORDS, MAX_WORD_DISTANCE)):
        own = refs.get(kind, {})
        total = classes.sum(1) if kind == "class" else words
        best, beyond = np.full(len(lang), np.inf), np.zeros(len(lang), bool)
        for k, reference in own.items():
            mine = (lang == k) | unstated
            if not mine.any():
                continue
            counts = classes[mine] if kind == "class" else _counts(texts, mine, k, found, (words, common))
            d = np.full(len(lang), np.inf)
            d[mine] = distances(counts, reference)
            far = np.zeros(len(lang), bool)
            far[mine] = strays(counts, d[mine], reference, allowed[k]) if kind == "word" else d[mine] ** 2 > limit**2 + (len(reference) - 1) / (8 * np.maximum(total[mine], 1) * np.log(2))
            beyond = np.where(d < best, far, beyond)
            best = np.minimum(best, d)
        ok = (total >= least) & np.isfinite(best)
        out[kind] = np.where(ok, best, np.nan)
        over[kind] = ok & beyond
    blank = classes.sum(1) == classes[:, 4]
    reason = np.select([blank, over["class"], over["word"]], ["blank", "classes", "words"], "")
    mask = {k: np.isnan(v) for k, v in out.items()}
    return pa.StructArray.from_arrays([pa.array(classes.sum(1)), pa.array(words), pa.array(out["class"], mask=mask["class"]), pa.array(out["word"], mask=mask["word"]), pa.array(reason == ""), pa.array(reason.tolist(), pa.string())], ["chars", "words", "class_distance", "word_distance", "keep", "reason"])


def with_verdict(docs: DataFrame, name: str = "_quality") -> DataFrame:
    """``docs`` with a struct of chars, words, class_distance, word_distance, keep and reason.

    A null, empty or blank text is rejected (``blank``). A distance is null where its guard isn't met
    and then rejects nothing. A document whose language is null is compared to every reference, the
    nearest counting; one of a language without a reference to none. Repeated rows are judged alike.
    """
    found = found_words(docs.select(F.col("text").cast("string"), F.col("lang").cast("string")))
    refs = references(docs, found)
    allowed = {k: chance(v) for k, v in refs.get("word", {}).items()}

    def judge(texts: pa.Array, langs: pa.Array) -> pa.Array:
        return judged(texts, langs, refs, allowed, found)

    judge.__annotations__ = {"texts": pa.Array, "langs": pa.Array, "return": pa.Array}
    udf = F.arrow_udf(judge, "struct<chars:bigint,words:bigint,class_distance:double,word_distance:double,keep:boolean,reason:string>").asNondeterministic()
    return docs.withColumn(name, udf(F.col("text").cast("string"), F.col("lang").cast("string")))


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row for each document: doc_id, chars, words, the two distances (6 digits), keep, reason (of nulls, empty
    texts and repeated rows see ``with_verdict``). An empty table gives no row; other columns, whatever their
    names, are left out."""
    r = "_quality"
    return with_verdict(docs.select("doc_id", "text", "lang"), r).select("doc_id", f"{r}.chars", f"{r}.words", F.round(f"{r}.class_distance", 6).alias("class_distance"), F.round(f"{r}.word_distance", 6).alias("word_distance"), f"{r}.keep", f"{r}.reason")


def reject_low_quality(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with their own columns, whatever their names; null, empty and blank
    texts go, repeated rows stay or go together, and an empty table stays empty."""
    r = unused(docs, "_quality")
    return with_verdict(docs, r).filter(F.col(f"{r}.keep")).drop(r)
