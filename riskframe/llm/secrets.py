"""Secret scan: fixed patterns, and character Markov models of random strings and ordinary identifiers.

Both models are first-order over the characters of candidate tokens. They are trained from labelled
samples: random strings drawn from a seeded generator over the usual alphabets, against plain numbers and identifiers made of the
words of all documents. A token is a secret when its
log-likelihood ratio exceeds the prior odds against one (``PRIOR``).

Defined results: a null text is empty and has no spans. Offsets are code points, ends exclusive. Of a
token that touches patterns' spans, each part outside them that is long enough for a token is scored by itself. Repeated rows give repeated results. Texts are
scanned whole. With no words to learn from, the identifier model is uniform and patterns still work.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

# fixed values: pattern kinds in their order, and the least number of characters each needs
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # the maximal runs of 24 or more characters
KINDS = ("assign", "access", "hex", "random")
_KEYWORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")

PRIOR = 1e-4
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_LEAST = 16  # characters of a candidate
_WORD = re.compile(r"[A-Za-z]{3,24}")
_TOKENS = 100_000  # tokens counted at a time
_SIZE = len(_ALPHABET)
_START = _SIZE  # the state before the first character
_CODES = np.full(128, -1, dtype=np.int64)
_CODES[[ord(c) for c in _ALPHABET]] = np.arange(_SIZE)


@dataclass(frozen=True)
class MarkovPair:
    """Log ratio of the two models' transition probabilities, and the ratio above which a token is a secret."""

    ratio: np.ndarray
    threshold: float

    def score(self, token: str) -> float:
        """The token's log-likelihood ratio; all its characters must be of the alphabet."""
        codes = _CODES[np.frombuffer(token.encode("ascii"), dtype=np.uint8)]
        return float(self.ratio[_START, codes[0]] + self.ratio[codes[:-1], codes[1:]].sum()) if len(codes) else 0.0


def _transitions(tokens: list[str]) -> np.ndarray:
    counts = np.zeros((_SIZE + 1) * _SIZE, dtype=np.int64)
    for lo in range(0, len(tokens), _TOKENS):
        text = "\n" + "\n".join(tokens[lo:lo + _TOKENS])
        codes = _CODES[np.frombuffer(text.encode("ascii"), dtype=np.uint8)]
        before = np.where(codes[:-1] < 0, _START, codes[:-1])
        counts += np.bincount((before * _SIZE + codes[1:])[codes[1:] >= 0], minlength=len(counts))
    return counts.reshape(_SIZE + 1, _SIZE)


def random_strings(n: int = 6_000, seed: int = 7) -> list[str]:
    """Labelled samples of random strings: hexadecimal, capital keys, and mixed alphabets."""
    rng = random.Random(seed)
    alphabets = ("0123456789abcdef", _ALPHABET[:26] + "0123456789", _ALPHABET[:62], _ALPHABET)
    return ["".join(rng.choices(alphabets[i % len(alphabets)], k=rng.randint(16, 48))) for i in range(n)]


def plain_numbers(n: int = 6_000, seed: int = 11) -> list[str]:
    """Labelled samples of ordinary numbers: dates, counts, order and account numbers are no secrets."""
    rng = random.Random(seed)
    return ["".join(rng.choices("0123456789", k=rng.randint(1, 20))) for _ in range(n)]


def identifiers(text: str) -> list[str]:
    """Labelled samples of ordinary identifiers: words as they stand, and joined as programs and links join them."""
    words = _WORD.findall(text)
    out = list(words)
    for i, (a, b) in enumerate(zip(words[::8], words[1::8], strict=False)):
        out.append((f"{a}_{b}", f"{a}{b.capitalize()}", f"{a}-{b}", f"{a}{b}", f"{a}/{b}", f"{a}{i % 100}",
                    f"{a.upper()}_{b.upper()}", f"{a}={b}")[i % 8])
    return out


def train(docs: DataFrame, text: str = "text", prior: float = PRIOR) -> MarkovPair:
    """Fits both models; transitions of all documents are counted in tasks, so at most
    (alphabet + 1) x alphabet rows reach the driver."""
    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros((_SIZE + 1, _SIZE), dtype=np.int64)
        for f in frames:
            for t in f["text"].dropna():
                counts += _transitions(identifiers(t))
        a, b = np.nonzero(counts)
        yield pd.DataFrame({"a": a, "b": b, "n": counts[a, b]})

    rows = docs.select(docs[text].alias("text")).mapInPandas(count, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n")).collect()
    ordinary = np.zeros((_SIZE + 1, _SIZE))
    for r in rows:
        ordinary[r["a"], r["b"]] = r["n"]
    return fit(_transitions(random_strings()), ordinary + _transitions(plain_numbers()), prior)


def fit(random_counts: np.ndarray, ordinary_counts: np.ndarray, prior: float = PRIOR) -> MarkovPair:
    """Add-one estimates of both transition tables."""
    p = lambda c: np.log((c + 1.0) / (c + 1.0).sum(axis=1, keepdims=True))
    return MarkovPair(p(random_counts) - p(ordinary_counts), float(np.log((1 - prior) / prior)))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Pattern matches that are long enough, by start, then kind."""
    out = []
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def find_spans(text: str, model: MarkovPair | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Pattern spans, and all spans; both by start, then kind."""
    base = base_spans(text)
    if model is None:
        return base, base
    more = []
    for m in _CANDIDATE.finditer(text):
        at = m.start()
        for s, e in [*((s, e) for _, s, e in base if s < m.end() and m.start() < e), (m.end(), m.end())]:
            if s - at >= _LEAST and model.score(text[at:s]) > model.threshold:
                more.append(("random", at, s))
            at = max(at, e)
    return base, sorted(base + more, key=lambda s: (s[1], KINDS.index(s[0])))


_SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                   T.StructField("end", T.LongType())]))


def scan(docs: DataFrame, model: MarkovPair | None, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The ``keep`` columns, ``base_spans`` and ``spans`` of every whole text."""
    rows = docs.select(F.struct(*[docs[c] for c in keep]).alias("row"), docs[text].alias("text"))
    spans = F.pandas_udf(_scanner(model), T.StructType([T.StructField("base_spans", _SPANS), T.StructField("spans", _SPANS)]))
    return rows.withColumn("found", spans("text")).select("row.*", "found.base_spans", "found.spans")


def _scanner(model: MarkovPair | None):
    def run(texts: pd.Series) -> pd.DataFrame:
        as_rows = lambda spans: [{"kind": k, "start": s, "end": e} for k, s, e in spans]
        found = [find_spans(t or "", model) for t in texts]
        return pd.DataFrame({"base_spans": [as_rows(b) for b, _ in found], "spans": [as_rows(a) for _, a in found]})
    return run


def masked(text: str | None, model: MarkovPair | None) -> str | None:
    """The text with each span replaced by its kind in brackets; spans that overlap are replaced together."""
    if text is None:
        return None
    out, at = [], 0
    for kind, s, e in find_spans(text, model)[1]:
        if s >= at:
            out += [text[at:s], f"[{kind}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def mask(docs: DataFrame, model: MarkovPair | None, text: str = "text", length: str | None = None) -> DataFrame:
    """``docs`` with secrets masked; rows and columns stay. ``length`` names a column that counts the text's characters."""
    run = F.pandas_udf(lambda texts: texts.map(lambda t: masked(t, model), na_action="ignore"), "string")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), run(docs[text]).alias("new"))
    new = {text: F.col("new")}
    if length is not None:
        new[length] = F.when(F.col("new") == F.col("row")[text], F.col("row")[length]).otherwise(
            F.char_length("new").cast(docs.schema[length].dataType))
    return rows.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def digest(spans: list[tuple[str, int, int]]) -> str:
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()
