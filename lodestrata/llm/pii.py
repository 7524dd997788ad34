"""Personal data by a semi-Markov conditional random field.

A text is cut into tokens (words, single signs, runs of white space) and segmented: a segment is
one token labelled O, or up to ``MAX_TOKENS`` tokens labelled as an entity. Features belong to the
whole segment (its shape, checksums, the words before it, what it touches) and not to its tokens; a
first-order weight joins neighbouring labels. Dynamic programming over the bounded segments chooses
boundaries and types together; the weights are fitted by gradient ascent on the log-likelihood,
with forward-backward over the same segments, on sentences made here (:func:`made_sentences`).

A segment can be an entity only if one of ``SHAPES`` matches all of it, and every shape holds a
digit, an @, a ::, the beginning of a known kind of key, or a value that a keyword sets by =, : or is.
Elsewhere O is the only label and costs the same on every path, so only the islands around such signs are
segmented; between islands there is always an O.

The bound on a segment is one of tokens, not of the text: what may be a whole entity of more signs than that (a
key, a value set by a keyword, an address) is a single token, however long, so it is redacted as a whole.
Finding islands and tokens takes time in proportion to the text, also in an unbroken run of any length.
"""

import random
import re
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.scratch import unused

LABELS = ("O", "EMAIL", "PHONE", "IP", "CARD", "SSN", "IBAN", "SECRET")
MAX_TOKENS, MAX_CHARS, CONTEXT = 32, 512, 28
SENTENCES, EPOCHS, RATE, DECAY, KEPT = 420, 7, 0.5, 1e-4, 50_000

TOKEN = re.compile(r"\w+|\s+|[^\w\s]")
_KEYWORD = r"(?:pass(?:word|wd|phrase|wort)?|pwd|secret|token|credential|(?:api|access|private|auth)?[_\- ]?key)"
_SET = r"[\"']?\s{0,2}(=|:|\bis\b)\s{0,2}[\"']?"
SIGN, RUN, NEXT = re.compile(r"[0-9@=]|::"), re.compile(r"\S*"), re.compile(r"\s{1,3}\S+")
KEYED = re.compile(rf"(?i:{_KEYWORD}){_SET}(?=\S)")
PREFIX = re.compile(r"\b(?:AKIA|gh[opsu]_|sk[-_]|xox[abp]-|eyJ|AIza|glpat-)")
#: Without one of these a text holds no keyword, or no such beginning of a key.
_WORDS, _BEGINS = ("pass", "pwd", "secret", "token", "credential", "key"), ("AKIA", "gho_", "ghp_", "ghs_", "ghu_", "sk-", "sk_", "xox", "eyJ", "AIza", "glpat-")
#: Signs from which a key or a set value is one token: with fewer it has no more than MAX_TOKENS tokens.
WHOLE = MAX_TOKENS + 1
_LONG_KEY, _LONG_VALUE = re.compile(rf"[A-Za-z0-9_\-]{{{WHOLE},}}"), re.compile(rf"[^\s\"'<>,;=]{{{WHOLE},}}={{0,2}}")
GAP, _BEHIND = 3, "\"'<>,;=.!?:)]}"
SHAPES = {
    "email": re.compile(r"[\w.%+\-]+@\w[\w\-]*(?:\.\w[\w\-]*)+"),
    "phone+": re.compile(r"\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)[ .\-]?)?\d{2,4}(?:[ .\-]?\d{2,4}){1,4}"),
    "phone": re.compile(r"(?:\(\d{3}\) ?|\d{3}[ .\-])\d{3}[ .\-]\d{4}"),
    "phone0": re.compile(r"(?:\(0\d{1,5}\) ?|0\d{1,5}[ .\-/])\d{2,8}(?:[ .\-]\d{2,6}){0,4}|0\d{8,11}"),
    "ip": re.compile(r"(?:\d{1,3}\.){3}\d{1,3}|(?:[0-9A-Fa-f]{1,4}:){4,7}[0-9A-Fa-f]{1,4}|(?=:*[0-9A-Fa-f])(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?"),
    "card": re.compile(r"\d{13,19}|\d{4}([ \-])\d{4}\1\d{4}\1\d{1,7}|\d{4}([ \-])\d{6}\2\d{4,5}"),
    "ssn": re.compile(r"\d{3}-\d{2}-\d{4}"),
    "iban": re.compile(r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?"),
    "key": re.compile(r"[A-Za-z0-9_\-]{16,}"),
    "set": re.compile(r"[^\s\"'<>,;=]{6,}={0,2}"),
}
_NEAR = {"secret": re.compile(_KEYWORD + _SET + "$", re.I), "phone": re.compile(r"(?:phone|tel|call|mobile|fax)\W", re.I), "card": re.compile(r"(?:card|visa|credit|payment)\W", re.I), "ssn": re.compile(r"(?:ssn|social)\W", re.I), "bank": re.compile(r"(?:iban|account|bank)\W", re.I), "host": re.compile(r"(?:ip|host|server|address)\W", re.I), "version": re.compile(r"(?:version|release|\bv)\W{0,2}$", re.I), "hash": re.compile(r"(?:commit|sha\d*|md5|hash|digest|id|order|isbn|ref)\W{0,3}$", re.I)}


@dataclass
class Crf:
    features: dict[str, int]
    weights: np.ndarray  # (feature, label)
    steps: np.ndarray  # (label before, label)
    kept: dict = field(default_factory=dict)  # scores of segments and words that came before, KEPT at most
    words: dict = field(default_factory=dict)


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _touch(c: str) -> str:
    return "end" if not c else "digit" if c.isdigit() else "letter" if c.isalpha() else "space" if c.isspace() else c if c in "\"'.-_/@+:()" else "sign"


def span_features(text: str, start: int, end: int, shapes: list[str]) -> list[str]:
    """The features of the whole segment text[start:end]."""
    span, before = text[start:end], text[max(0, start - CONTEXT) : start]
    digits = re.sub(r"[^0-9]", "", span)
    letters = sum(c.isalpha() for c in span)
    out = ["entity", *(f"shape {s}" for s in shapes), f"digits {min(len(digits), 20)}", f"left {_touch(text[start - 1 : start])}", f"right {_touch(text[end : end + 1])}"]
    near = {k: m for k, rx in _NEAR.items() if (m := rx.search(before))}
    out += [f"near {k}" for k in near]
    out += [f"right {_touch(text[end : end + 1])} then {_touch(text[end + 1 : end + 2])}"]
    if "card" in shapes and digits.isascii():
        out.append(f"luhn {_luhn(digits)}")
    if "ip" in shapes and "." in span:
        out.append(f"octets {all(int(x) < 256 for x in span.split('.'))}")
    if "iban" in shapes:
        flat = span.replace(" ", "")
        out.append(f"mod97 {int(''.join(str(int(c, 36)) for c in flat[4:] + flat[:4])) % 97 == 1}")
    if "key" in shapes or "set" in shapes:
        secret = near["secret"].group(1).lower() if "secret" in near else ""
        then = text[end : end + 1]
        # whether what stands behind it could belong to the value too
        out += [f"cut {bool(then) and not then.isspace() and then not in _BEHIND} {bool(secret)}"]
        out += [f"letters {min(len(span), 23) // 4} {secret}"] if letters == len(span) else []
        out += [f"hex {bool(re.fullmatch('[0-9a-fA-F]{20,}', span))} {secret}", f"mixed {bool(digits) and letters > 0} {secret}", f"words {not digits} {secret}", f"prefix {bool(PREFIX.match(span))}", f"long {len(span) >= 16} {secret}"]
    return out


def token_features(token: str) -> list[str]:
    return ["O", *(["O digit"] if any(c.isdigit() for c in token) else []), *(["O @"] if token == "@" else []), *(["O long"] if len(token) >= 16 else [])]


def _left(text: str, at: int, floor: int, stop: str = "") -> int:
    """Where the run without white space (or, with ``stop``, of word signs and those) begins that ends at ``at``."""
    if stop:
        while at > floor and (text[at - 1].isalnum() or text[at - 1] in stop):
            at -= 1
        return at
    while at > floor and not text[at - 1].isspace():
        piece = text[max(floor, at - 256) : at]
        at -= len(piece.rsplit(None, 1)[-1])
    return at


def islands(text: str) -> list[tuple[int, int]]:
    """Spans outside of which no segment can be an entity; neighbours are more than GAP white spaces or a word apart."""
    spans, end = [], 0
    while m := SIGN.search(text, end):
        start, end = _left(text, m.start(), end), RUN.match(text, m.end()).end()
        if text[end - 1] in "=:" and (then := NEXT.match(text, end)):
            end = then.end()
        spans.append((start, end))
    low = text.lower()
    if any(w in low for w in _WORDS):
        end = 0
        for m in KEYED.finditer(text):
            if m.end() >= end:
                end = RUN.match(text, m.end()).end()
            spans.append((m.start(), end))
    if any(w in text for w in _BEGINS):
        end = 0
        while m := PREFIX.search(text, end):
            start, end = _left(text, m.start(), end), RUN.match(text, m.end()).end()
            spans.append((start, end))
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and (a <= out[-1][1] or (a - out[-1][1] <= GAP and text[out[-1][1] : a].isspace())):
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def tokens_of(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """Words, signs and white space; a long key, set value or address is one token."""
    whole, done = [], start
    for m in KEYED.finditer(text, max(0, start - CONTEXT), end):
        if m.end() >= max(start, done) and (v := _LONG_VALUE.match(text, m.end(), end)):
            done = v.end()
            whole.append((v.start(), v.start() + len(v.group().rstrip(".!?:)]}"))))
    whole += [m.span() for m in _LONG_KEY.finditer(text, start, end)]
    at = floor = start
    while (at := text.find("@", at, end)) >= 0:
        a, b = _left(text, at, floor, "_.%+-"), at + 1
        while b < end and (text[b].isalnum() or text[b] in "_.-"):
            b += 1
        b = at + 1 + len(text[at + 1 : b].rstrip(".-"))
        if b - a >= WHOLE and SHAPES["email"].fullmatch(text, a, b) and sum(1 for _ in TOKEN.finditer(text, a, b)) > MAX_TOKENS:
            whole.append((a, b))
        at = floor = max(b, at + 1)
    out, at = [], start
    # of overlapping ones the first begun counts, and of those begun at one place the longest
    for a, b in [*sorted(whole, key=lambda s: (s[0], -s[1])), (end, end)]:
        if a >= at:
            out += [m.span() for m in TOKEN.finditer(text, at, a)]
            out += [(a, b)] * (b > a)
            at = b
    return out


def lattice(text: str, start: int, end: int) -> tuple[list[tuple[int, int]], dict[tuple[int, int], list[str]]]:
    """The island's tokens, and the shapes of each segment (token from, token to) that can be an entity."""
    tokens = tokens_of(text, start, end)
    found: dict[tuple[int, int], list[str]] = {}
    for k, (a, e) in enumerate(tokens):
        if text[a].isspace():
            continue
        far = tokens[min(len(tokens), k + MAX_TOKENS) - 1][1]
        far = min(far, max(e, a + MAX_CHARS))
        for name, rx in SHAPES.items():
            if not rx.match(text, a, far):
                continue
            if name == "set" and not _NEAR["secret"].search(text[max(0, a - CONTEXT) : a]):
                continue
            for j in range(min(len(tokens), k + MAX_TOKENS), k, -1):
                if tokens[j - 1][1] <= far and rx.fullmatch(text, a, tokens[j - 1][1]):
                    found.setdefault((k, j), []).append(name)
    return tokens, found


def emissions(text: str, tokens: list[tuple[int, int]], found: dict[tuple[int, int], list[str]], model: Crf) -> tuple[list[tuple[int, int]], list[list[int]], np.ndarray]:
    """All segments by their end, the ids of their features, and their score for each label (-inf where not allowed)."""
    ids = model.features
    segments = sorted([(k, k + 1, None) for k in range(len(tokens))] + [(i, j, s) for (i, j), s in found.items()], key=lambda x: (x[1], x[0], x[2] is not None))
    features = [[ids[f] for f in (token_features(text[tokens[i][0] : tokens[i][1]]) if s is None else span_features(text, tokens[i][0], tokens[j - 1][1], s)) if f in ids] for i, j, s in segments]
    scores = np.full((len(segments), len(LABELS)), -np.inf)
    for k, (_, _, s) in enumerate(segments):
        own = model.weights[features[k]].sum(0)
        if s is None:
            scores[k, 0] = own[0]
        else:
            scores[k, 1:] = own[1:]
    return [(i, j) for i, j, _ in segments], features, scores


def _score(text: str, start: int, end: int, shapes: list[str], model: Crf) -> np.ndarray:
    """The segment's score for each entity label, kept for what stands in the same place of the same words."""
    before = max(0, start - CONTEXT)
    key = (text[before : end + 2], start - before, end - before, tuple(shapes))
    if (own := model.kept.get(key)) is None:
        ids = model.features
        own = model.weights[[ids[f] for f in span_features(text, start, end, shapes) if f in ids]].sum(0)[1:]
        if len(model.kept) >= KEPT:
            model.kept.clear()
        if end - start <= MAX_CHARS:
            model.kept[key] = own
    return own


def decode(text: str, start: int, end: int, model: Crf) -> list[tuple[str, int, int]]:
    """The entities (label, start, end) of the island's best segmentation."""
    tokens, found = lattice(text, start, end)
    out: list[tuple[str, int, int]] = []
    # where two tokens labelled O follow each other whatever is chosen, what comes before doesn't matter to what comes
    # after, so each stretch that candidates cover is decoded by itself, between one O and another
    for a, b, own in stretches(len(tokens), found):
        out += _best(text, tokens[a:b], {(i - a, j - a): found[i, j] for i, j in own}, model)
    return out


def stretches(n: int, found: dict[tuple[int, int], list[str]]) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """Runs of tokens that candidates cover, with a token on either side that is surely O, where there is one, and
    their candidates; runs that share it are one."""
    out: list[tuple[int, int, list[tuple[int, int]]]] = []
    for i, j in sorted(found):
        a, b = max(0, i - 1), min(n, j + 1)
        if out and a < out[-1][1]:
            out[-1][2].append((i, j))
            out[-1] = (out[-1][0], max(out[-1][1], b), out[-1][2])
        else:
            out.append((a, b, [(i, j)]))
    return out


def _best(text: str, tokens: list[tuple[int, int]], found: dict[tuple[int, int], list[str]], model: Crf) -> list[tuple[str, int, int]]:
    into: dict[int, list[tuple[int, list[str]]]] = {}
    for (i, j), shapes in found.items():
        into.setdefault(j, []).append((i, shapes))
    best = np.full((len(tokens) + 1, len(LABELS)), -np.inf)
    back: dict[tuple[int, int], tuple[int, int]] = {}
    best[0, 0] = 0
    for j in range(1, len(tokens) + 1):
        word = text[slice(*tokens[j - 1])]
        if word not in model.words:
            if len(model.words) >= KEPT:
                model.words.clear()
            model.words[word] = float(sum(model.weights[model.features[f], 0] for f in token_features(word) if f in model.features))
        who = best[j - 1] + model.steps[:, 0]
        best[j, 0], back[j, 0] = who.max() + model.words[word], (j - 1, int(who.argmax()))
        for i, shapes in sorted(into.get(j, [])):
            who = best[i][:, None] + model.steps[:, 1:]
            total = who.max(0) + _score(text, tokens[i][0], tokens[j - 1][1], shapes, model)
            for label in np.flatnonzero(total > best[j, 1:]).tolist():
                best[j, label + 1] = total[label]
                back[j, label + 1] = (i, int(who[:, label].argmax()))
    out, at, label = [], len(tokens), int(best[-1].argmax())
    while at:
        i, before = back[at, label]
        if label:
            out.append((LABELS[label], tokens[i][0], tokens[at - 1][1]))
        at, label = i, before
    return out[::-1]


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = np.maximum(x.max(axis, keepdims=True), -1e300)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


def expectations(n: int, segments: list[tuple[int, int]], scores: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Each segment's probability for each label, the expected steps between labels, and log Z."""
    alpha, beta = np.full((n + 1, len(LABELS)), -1e300), np.full((n + 1, len(LABELS)), -1e300)
    alpha[0], beta[n] = -1e300, 0
    alpha[0, 0] = 0
    with np.errstate(all="ignore"):
        for (i, j), own in zip(segments, scores):
            alpha[j] = np.logaddexp(alpha[j], _lse(alpha[i][:, None] + steps, 0) + own)
        for (i, j), own in sorted(zip(segments, scores), key=lambda x: -x[0][0]):
            beta[i] = np.logaddexp(beta[i], _lse(steps + (own + beta[j])[None, :], 1))
        z = float(_lse(alpha[n], 0))
        each, moves = np.zeros(scores.shape), np.zeros(steps.shape)
        for k, ((i, j), own) in enumerate(zip(segments, scores)):
            p = np.exp(alpha[i][:, None] + steps + (own + beta[j])[None, :] - z)
            moves += p
            each[k] = p.sum(0)
    return each, moves, z


def made_sentences(n: int, seed: int = 11) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """Sentences with their entities (label, start, end), and as many lookalikes that are none."""
    rng = random.Random(seed)
    d = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    word = lambda: "".join(rng.choice("abcdefghijklmnoprstuvwéäñ") for _ in range(rng.randint(2, 9)))
    some = lambda alphabet, k: "".join(rng.choice(alphabet) for _ in range(k))
    b64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"

    def valid(k: int) -> str:
        body = d(k - 1)
        return body + next(c for c in "0123456789" if _luhn(body + c))

    def iban() -> str:
        land, body = rng.choice(["DE", "FR", "ES", "GB"]), d(18)
        check = 98 - int("".join(str(int(c, 36)) for c in body + land + "00")) % 97
        flat = f"{land}{check:02d}{body}"
        return flat if rng.random() < 0.5 else " ".join(flat[k : k + 4] for k in range(0, len(flat), 4))

    octet = lambda: str(rng.randint(0, 255))
    quote = lambda x: rng.choice(['"{}"', "'{}'", "{}", '"{}"']).format(x)
    key = lambda: rng.choice([some("0123456789abcdef", rng.choice([24, 32, 48, 56, 64, 96])), some("0123456789ABCDEF", 32), some(b64, rng.randint(18, 60)), "AKIA" + some(b64[:26] if rng.random() < 0.5 else b64.upper(), 16), rng.choice(["ghp_", "gho_"]) + some(b64, 36), "sk-" + some(b64, 32), "-".join(some(b64.lower(), rng.randint(4, 8)) for _ in range(rng.randint(4, 9)))])
    plain = "required incorrect important missing invalid expired necessary available different something protected understanding communication everything responsible needed already stored changed somewhere".split()
    makers = {
        "EMAIL": lambda: ("", rng.choice([f"{word()}.{word()}@{word()}.com", f"{word()}{d(4)}@{word()}-{word()}.de", f"{word()}@{word()}.org", f"{word()}@{word()}.{word()}.info", f"{word()}_{word()}+{word()}@{word()}.co.uk", f"{d(3)}{word()}@x{d(2)}.net"])),
        "PHONE": lambda: (rng.choice(["", "", "call ", "tel: "]), rng.choice([f"+49 ({d(2)}) {d(4)} {d(3)}", f"+44 {d(2)} {d(4)} {d(4)}", f"+33 {d(1)} {d(2)} {d(2)} {d(2)} {d(2)}", f"+49-{d(2)}-{d(4)}-{d(3)}", f"+{rng.choice(['33', '49', '34', '1', '44'])} {d(3)} {d(3)} {d(4)}", f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}-{d(3)}-{d(4)}", f"{d(3)}.{d(3)}.{d(4)}", f"+49{d(3)}{d(4)}{d(3)}"] + [f"01{d(2)} {d(7)}", f"0{rng.randint(1, 9)} {d(2)} {d(2)} {d(2)} {d(2)}", f"0{d(2)}/{d(7)}", f"(0{d(3)}) {d(6)}", f"0{d(3)}-{d(6)}", f"0{rng.randint(1, 9)}.{d(2)}.{d(2)}.{d(2)}.{d(2)}"])),
        "IP": lambda: (rng.choice(["", "", "host ", "ip: "]), rng.choice([".".join(octet() for _ in range(4))] * 4 + [":".join(some("0123456789abcdef", 4) for _ in range(8)), f"fe80::{some('0123456789abcdef', rng.randint(1, 4))}", f"2001:db8::{d(1)}", f"2001:{some('0123456789abcdef', 3)}:{some('0123456789abcdef', 4)}::{some('0123456789abcdef', 2)}"])),
        "CARD": lambda: (rng.choice(["", "", "card ", "visa: "]), rng.choice([d(16), d(16), valid(16), valid(15), " ".join(d(4) for _ in range(4)), "-".join(d(4) for _ in range(4)), f"3{d(3)} {d(6)} {d(5)}", f"3{d(3)}-{d(6)}-{d(5)}"])),
        "SSN": lambda: (rng.choice(["", "ssn ", "social security "]), f"{d(3)}-{d(2)}-{d(4)}"),
        "IBAN": lambda: (rng.choice(["", "iban ", "account: "]), iban()),
    }

    def lookalike() -> str:
        return rng.choice([f"0{rng.randint(1, 9)}.0{rng.randint(1, 9)}.20{d(2)}", f"0{rng.randint(1, 9)}/1{rng.randint(0, 2)}/20{d(2)}", f"0{rng.randint(1, 9)}-1{rng.randint(0, 2)}-20{d(2)}", f"{word()}::{word()}", f"20{d(2)}-0{rng.randint(1, 9)}-1{d(1)}", f"{rng.randint(10, 23)}:{rng.randint(10, 59)}", f"version {rng.randint(1, 9)}.{d(1)}.{d(1)}.{d(1)}", f"v{d(1)}.{d(2)}.{d(1)}", f"${d(3)}.{d(2)}", f"order {d(9)}", f"id {d(12)}", f"n = {d(3)}", f"ratio: {d(1)}.{d(4)}", f"{d(24)}", f"isbn 978-{d(1)}-{d(4)}-{d(4)}-{d(1)}", f"{d(4)}", f"{d(2)}%", f"commit {some('0123456789abcdef', 40)}", f"{word()}@{word()}", f"@{word()}{d(2)}", f"x = {word()}", f"{word()}-{word()}-{word()}-{d(2)}", f"+{d(1)}", f"{d(3)}.{d(3)}.{d(3)}", f"key: {rng.choice(['the', 'a', 'to'])} {word()}", f"{rng.choice(['password', 'the key', 'token', 'secret'])} {rng.choice(['is', 'is', ':'])} {rng.choice(plain)}", f"{rng.choice(['password', 'key', 'token'])} is {rng.choice(plain)}", "".join(rng.choice("abcdefghiklmnoprstuw") for _ in range(rng.randint(16, 30))) + f" {d(2)}", f"{rng.randint(300, 999)}.{rng.randint(300, 999)}.{d(3)}.{d(2)}"])

    out = []
    for _ in range(n):
        text, gold = "", []
        for _ in range(rng.randint(2, 5)):
            text += " ".join(word() for _ in range(rng.randint(1, 3))) + rng.choice([" ", " ", ", ", ". ", ": ", "\n"])
            if rng.random() < 0.35:
                text += lookalike()
            else:
                label = rng.choice([*makers, "SECRET"])
                if label == "SECRET" and rng.random() < 0.25:
                    # the beginnings of known kinds of keys tell them without a keyword
                    value = rng.choice(["AKIA" + some(b64[:26] if rng.random() < 0.5 else b64[:26] + b64[-10:], 16), rng.choice(["ghp_", "gho_"]) + some(b64, 36), "sk-" + some(b64, 32), "xoxb-" + d(11) + "-" + some(b64, 24)])
                    gold.append((label, len(text), len(text) + len(value)))
                    text += value
                elif label == "SECRET":
                    value = rng.choice([key(), key(), some(b64 + "!#%", rng.randint(8, 14)), word() + d(3) + "!", "".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(15, 24))), "".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(15, 24)))])
                    shown = quote(value)
                    value_at = shown.index(value)
                    text += rng.choice(["auth_key", "password", "api_key", "secret", "access key", "passphrase", "PASSWORD", "pwd", "credential"]) + rng.choice([" = ", "=", ": ", " is ", " is ", ":"])
                    gold.append((label, len(text) + value_at, len(text) + value_at + len(value)))
                    text += shown
                else:
                    before, value = makers[label]()
                    if rng.random() < 0.15:
                        before, value = before.upper(), value.upper()
                    gold.append((label, len(text) + len(before), len(text) + len(before) + len(value)))
                    text += before + value
            text += rng.choice([" ", " ", ", ", ". ", "!! ", "\n", ") "])
        out.append((text + word(), gold))
    return out


@lru_cache(1)
def trained() -> Crf:
    """The field fitted to ``SENTENCES`` made sentences."""
    ids: dict[str, int] = {}
    number = count()
    cases = []
    for text, gold in made_sentences(SENTENCES):
        for a, b in islands(text):
            tokens, found = lattice(text, a, b)
            own = {(s, e): k for k, s, e in gold if s >= a and e <= b}
            for (i, j), shapes in found.items():
                for f in span_features(text, tokens[i][0], tokens[j - 1][1], shapes):
                    if f not in ids:
                        ids[f] = next(number)
            for s, e in tokens:
                for f in token_features(text[s:e]):
                    if f not in ids:
                        ids[f] = next(number)
            truth, at = {}, 0
            while at < len(tokens):
                to = next((j for (i, j) in found if i == at and (tokens[i][0], tokens[j - 1][1]) in own), None)
                truth[at, to or at + 1] = LABELS.index(own[tokens[at][0], tokens[to - 1][1]]) if to else 0
                at = to or at + 1
            if found:
                cases.append((text, tokens, found, truth))
    model = Crf(ids, np.zeros((len(ids), len(LABELS))), np.zeros((len(LABELS), len(LABELS))))
    gw, gs = np.full(model.weights.shape, 1e-2), np.full(model.steps.shape, 1e-2)
    order = random.Random(3)
    for _ in range(EPOCHS):
        order.shuffle(cases)
        for text, tokens, found, truth in cases:
            segments, features, scores = emissions(text, tokens, found, model)
            each, moves, _ = expectations(len(tokens), segments, scores, model.steps)
            dw, ds, before = {}, -moves, 0
            entity = [not np.isfinite(s[0]) for s in scores]
            for k, (i, j) in enumerate(segments):
                g = -each[k]
                label = truth.get((i, j))
                if label is not None and (label > 0) == entity[k]:
                    g[label] += 1
                    ds[before, label] += 1
                    before = label
                for f in features[k]:
                    dw[f] = dw[f] + g if f in dw else g
            rows = np.array(list(dw))
            g = np.stack(list(dw.values())) - DECAY * model.weights[rows]
            gw[rows] += g * g
            model.weights[rows] += RATE * g / np.sqrt(gw[rows])
            gs += ds * ds
            model.steps += RATE * ds / np.sqrt(gs)
    return model


def entities(text: str, model: Crf) -> list[tuple[str, int, int]]:
    """The entities (label, start, end) of a text, in order."""
    return [x for a, b in islands(text) for x in decode(text, a, b, model)]


def redacted(texts: pa.Array, model: Crf) -> pa.StructArray:
    """Each text with its entities replaced by their type in brackets, and the entities' places in the text as it was."""
    out, found = texts.to_pylist(), [[] for _ in range(len(texts))]
    for r, text in enumerate(out):
        if text is None or not (own := entities(text, model)):
            continue
        parts, at = [], 0
        for label, a, b in own:
            parts += [text[at:a], f"[{label}]"]
            at = b
        out[r] = "".join(parts) + text[at:]
        found[r] = [{"type": k, "start": a, "length": b - a} for k, a, b in own]
    kind = pa.list_(pa.struct([("type", pa.string()), ("start", pa.int32()), ("length", pa.int32())]))
    return pa.StructArray.from_arrays([pa.array(out, pa.string()), pa.array(found, kind)], ["text", "entities"])


def with_redaction(docs: DataFrame, name: str = "_pii") -> DataFrame:
    """``docs`` with a struct of text (redacted) and entities (type, start, length in characters).

    A null text stays null with no entity, an empty one empty. Repeated rows get the same answer; of equally
    likely segmentations the one of the earlier labels and longer segments before counts.
    """
    model = trained()

    def redact(texts: pa.Array) -> pa.Array:
        return redacted(texts, model)

    redact.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    udf = F.arrow_udf(redact, "struct<text:string,entities:array<struct<type:string,start:int,length:int>>>").asNondeterministic()
    return docs.withColumn(name, udf(F.col("text").cast("string")))


def personal_data(docs: DataFrame) -> DataFrame:
    """One row for each document: doc_id, text (redacted), entities (of nulls, empty texts and repeated rows see
    ``with_redaction``). An empty table gives no row; other columns, whatever their names, are left out."""
    return with_redaction(docs.select("doc_id", "text"), "_pii").select("doc_id", "_pii.text", "_pii.entities")


def redact_personal_data(docs: DataFrame) -> DataFrame:
    """The documents with redacted texts, and n_chars to match; other columns as they are, whatever their names, and
    no row goes."""
    r = unused(docs, "_pii")
    marked = with_redaction(docs, r)
    new = {"text": F.col(f"{r}.text"), "n_chars": F.char_length(f"{r}.text").cast("bigint")}
    return marked.select(*[new[c].alias(c) if c in new else marked[f"`{c}`"] for c in docs.columns])
