"""Quality classifier: a linear-chain conditional random field over the lines of a document.

Every line with a word gets features of itself and of its neighbours; the chain has the labels good and bad.
A document's quality is the mean, weighted by line length, of the forward-backward marginals of "good",
carried through a monotone calibration to the document labels.

Fitting uses at most ``TRAIN_DOCS`` labelled documents, the first by hash, and of each at most ``TRAIN_LINES``
lines in evenly spaced runs. Line labels are not given: lines of good documents count as good; a first model
without chain is fitted with the document's label on every line, and lines of bad documents that it holds for
good count as good. Scoring reads every line of every whole text.

Defined results: a null or empty text (or one of white space) counts as one empty line. Labels that are null
are not used; a document labelled twice counts with its lowest label, one in several rows is learned once. With no usable labels every score is
0.5. Repeated rows give repeated results. Extra columns are ignored unless named in ``keep``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from riskframe.llm.quality_rules import stop_forms

TRAIN_DOCS = 4_000
TRAIN_LINES = 256
_RUN = 64  # lines of one training sequence
_STOP = frozenset(stop_forms())
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_DIGITS = b"0123456789"
_SYMBOLS = b"#*$%&|<>@~^{}[]\\=_+"
_LIMIT = 30.0
FEATURES = ("bias", "length", "capitals", "digits", "symbols", "bangs", "bars", "stop_words", "repeats", "word_length",
            "few_words", "sentence_end", "has_bars", "many_bangs", "mostly_capitals", "many_symbols", "many_repeats",
            "long_without_stop_words")


def lines_of(text: str | None) -> list[str]:
    """Lines with a word; one empty line if there are none."""
    return [x for x in (text or "").split("\n") if x and not x.isspace()] or [""]


def line_features(line: str) -> tuple[float, ...]:
    words, raw = line.split(), line.encode()
    n, k = len(raw) or 1, len(words) or 1
    without = lambda signs: (len(raw) - len(raw.translate(None, signs))) / n
    capitals, digits, symbols = without(_UPPER), without(_DIGITS), without(_SYMBOLS)
    bars, bangs = raw.count(b"|") / k, raw.count(b"!") / k
    stops, repeats = sum(map(_STOP.__contains__, words)) / k, sum(map(eq, words, words[1:])) / k
    return (1.0, math.log1p(len(raw)) / 8, capitals, digits, symbols, bangs, bars, stops, repeats, min(len(raw) / k / 10, 5.0),
            float(k < 4), float(raw.rstrip()[-1:] in (b".", b"?", b":", b",", b";")), float(bars > 0.2), float(bangs > 0.5),
            float(capitals > 0.4), float(symbols > 0.1), float(repeats > 0.2), float(stops == 0 and k >= 12))


@dataclass(frozen=True)
class LineCrf:
    """weights: features x (own, previous, next); start, chain: log weights (bad, good); slope and shift calibrate."""

    weights: np.ndarray
    start: np.ndarray
    chain: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def emissions(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Log odds of good from the features of each line and its neighbours; first marks a document's first line."""
        a = x @ self.weights
        out = a[:, 0].copy()
        inner = ~first[1:]
        out[1:] += a[:-1, 1] * inner
        out[:-1] += a[1:, 2] * inner
        return np.clip(out, -_LIMIT, _LIMIT)

    def marginals(self, e: Sequence[float]) -> list[float]:
        """P(good) of each line of one document, by the forward and backward odds of good against bad."""
        (bb, bg), (gb, gg) = np.exp(self.chain).tolist()
        odds = [math.exp(v) for v in e]
        f, forward = math.exp(float(self.start[1] - self.start[0])) * odds[0], []
        forward.append(f)
        for o in odds[1:]:
            f = o * (f * gg + bg) / (f * gb + bb)
            forward.append(f)
        r, out = 1.0, [0.0] * len(odds)
        for i in range(len(odds) - 1, -1, -1):
            z = forward[i] * r
            out[i] = z / (1.0 + z)
            s = odds[i] * r
            r = (gg * s + gb) / (bg * s + bb)
        return out

    def share(self, sizes: Sequence[int], p: Sequence[float]) -> float:
        return sum(s * v for s, v in zip(sizes, p, strict=True)) / sum(sizes)

    def calibrated(self, share: float) -> float:
        share = min(max(share, 1e-6), 1 - 1e-6)
        z = self.slope * math.log(share / (1 - share)) + self.shift
        return 1 / (1 + math.exp(-min(max(z, -700.0), 700.0)))

    def score_texts(self, texts: Sequence[str | None]) -> Iterator[tuple[float, list[str], list[float]]]:
        """Per text: score, lines, P(good) of each line; few texts are held at a time."""
        for lo in range(0, len(texts), 200):
            docs = [lines_of(t) for t in texts[lo:lo + 200]]
            x = np.array([line_features(v) for d in docs for v in d])
            first, at = np.zeros(len(x), dtype=bool), 0
            for d in docs:
                first[at] = True
                at += len(d)
            e, at = self.emissions(x, first).tolist(), 0
            for d in docs:
                p = self.marginals(e[at:at + len(d)])
                yield self.calibrated(self.share([len(v) or 1 for v in d], p)), d, p
                at += len(d)


NEUTRAL = LineCrf(np.zeros((len(FEATURES), 3)), np.zeros(2), np.zeros((2, 2)))


def _logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-3, steps: int = 40) -> np.ndarray:
    """Newton steps with a ridge; classes weigh the same."""
    w = np.zeros(x.shape[1])
    weight = np.where(y > 0.5, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -_LIMIT, _LIMIT)))
        g = x.T @ (weight * (p - y)) / len(y) + l2 * w
        h = (x * (weight * p * (1 - p))[:, None]).T @ x / len(y) + l2 * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _chain_gradient(e: np.ndarray, y: np.ndarray, live: np.ndarray, start: np.ndarray, chain: np.ndarray):
    """Gradients of the log-likelihood of padded sequences: expected minus observed, per emission, start and chain."""
    n, steps = e.shape
    score = np.stack([np.zeros_like(e), e], axis=2)
    lse = np.logaddexp
    alpha = np.empty((n, steps, 2))
    alpha[:, 0] = start + score[:, 0]
    for t in range(1, steps):
        a = alpha[:, t - 1]
        nxt = score[:, t] + lse(a[:, :1] + chain[0], a[:, 1:] + chain[1])
        alpha[:, t] = np.where(live[:, t, None], nxt, a)
    beta = np.zeros((n, steps, 2))
    for t in range(steps - 2, -1, -1):
        b = beta[:, t + 1] + score[:, t + 1]
        prev = np.stack([lse(chain[s, 0] + b[:, 0], chain[s, 1] + b[:, 1]) for s in (0, 1)], axis=1)
        beta[:, t] = np.where(live[:, t + 1, None], prev, 0.0)
    z = lse(alpha[:, -1, 0], alpha[:, -1, 1])[:, None]
    p = np.exp(alpha + beta - z[:, :, None])
    d_e = np.where(live, p[:, :, 1] - y, 0.0)
    d_start = np.array([(p[:, 0, s] - (y[:, 0] == s)).sum() for s in (0, 1)])
    d_chain = np.zeros((2, 2))
    both = live[:, 1:]
    for s in (0, 1):
        for v in (0, 1):
            pair = np.exp(alpha[:, :-1, s] + chain[s, v] + score[:, 1:, v] + beta[:, 1:, v] - z)
            d_chain[s, v] = (np.where(both, pair, 0.0)).sum() - (both & (y[:, :-1] == s) & (y[:, 1:] == v)).sum()
    return d_e, d_start, d_chain


def fit_chain(docs: list[np.ndarray], labels: list[np.ndarray], steps: int = 250, l2: float = 1e-3,
              starts: Sequence[Sequence[int]] | None = None) -> LineCrf:
    """Maximum conditional likelihood by Adam over all sequences; docs: features per line, labels: 0 or 1 per line.

    ``starts`` gives the first line of each run of a document whose lines do not all follow each other."""
    runs = []
    for x, y, first in zip(docs, labels, starts if starts is not None else [[0]] * len(docs), strict=True):
        for a, b in zip(first, [*first[1:], len(x)], strict=True):
            runs += [(x[i:min(i + _RUN, b)], y[i:min(i + _RUN, b)], x[i - 1] if i > a else None, x[i + _RUN] if i + _RUN < b else None)
                     for i in range(a, b, _RUN)]
    width, k = max(len(r[0]) for r in runs), len(FEATURES)
    x = np.zeros((len(runs), width, 3 * k))
    y, live = np.zeros((len(runs), width)), np.zeros((len(runs), width), dtype=bool)
    for i, (own, lab, before, after) in enumerate(runs):
        m = len(own)
        x[i, :m, :k] = own
        x[i, 1:m, k:2 * k] = own[:-1]
        x[i, :m - 1, 2 * k:] = own[1:]
        if before is not None:
            x[i, 0, k:2 * k] = before
        if after is not None:
            x[i, m - 1, 2 * k:] = after
        y[i, :m], live[i, :m] = lab, True
    total = live.sum()
    params = [np.zeros(3 * k), np.zeros(2), np.zeros((2, 2))]
    m1, m2 = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        e = np.clip(x @ params[0], -_LIMIT, _LIMIT)
        d_e, d_start, d_chain = _chain_gradient(e, y, live, params[1], params[2])
        grads = [np.einsum("st,stf->f", d_e, x), d_start, d_chain]
        for j, g in enumerate(grads):
            g = g / total + l2 * params[j]
            m1[j] = 0.9 * m1[j] + 0.1 * g
            m2[j] = 0.999 * m2[j] + 0.001 * g * g
            params[j] = params[j] - 0.1 * (m1[j] / (1 - 0.9**step)) / (np.sqrt(m2[j] / (1 - 0.999**step)) + 1e-8)
    return LineCrf(params[0].reshape(3, k).T.copy(), params[1], params[2])


def training_rows(text: str | None, max_lines: int) -> tuple[list[tuple[float, ...]], list[int], list[int]]:
    """Features and length of a document's lines, or of evenly spaced runs of them, and where the runs start."""
    lines = lines_of(text)
    if len(lines) <= max_lines:
        runs = [lines]
    else:
        n = max(1, max_lines // _RUN)
        step = len(lines) / n
        runs = [lines[int(r * step):int(r * step) + min(_RUN, max_lines)] for r in range(n)]
    starts = np.cumsum([0, *map(len, runs)])[:-1].tolist()
    return [line_features(v) for run in runs for v in run], [len(v) or 1 for run in runs for v in run], starts


def fit(texts: Sequence[list[str]], labels: Sequence[int]) -> LineCrf:
    """A model from the lines of labelled documents."""
    return fit_rows([np.array([line_features(v) for v in lines]) for lines in texts], [[len(v) or 1 for v in lines] for lines in texts],
                    [[0]] * len(texts), labels)


def fit_rows(features: Sequence[np.ndarray], sizes: Sequence[Sequence[int]], starts: Sequence[Sequence[int]], labels: Sequence[int]) -> LineCrf:
    """A model from the ``training_rows`` of labelled documents."""
    if not len(features) or len(set(labels)) < 2:
        return NEUTRAL
    of_doc = [np.full(len(x), float(y)) for x, y in zip(features, labels, strict=True)]
    single = _logistic(np.concatenate(features), np.concatenate(of_doc))
    refined = []
    for x, y in zip(features, of_doc, strict=True):
        if y[0] == 0:
            z = x @ single
            y = (z > 0).astype(float)
            y[z.argmin()] = 0.0  # a bad document has a bad line
        refined.append(y)
    model = fit_chain(list(features), refined, starts=starts)
    shares = []
    for x, size, begin in zip(features, sizes, starts, strict=True):
        first = np.zeros(len(x), dtype=bool)
        first[begin] = True
        e = model.emissions(x, first).tolist()
        p = [v for a, b in zip(begin, [*begin[1:], len(x)], strict=True) for v in model.marginals(e[a:b])]
        shares.append(model.share(size, p))
    s = np.clip(np.array(shares), 1e-6, 1 - 1e-6)
    slope, shift = _logistic(np.stack([np.log(s / (1 - s)), np.ones(len(s))], axis=1), np.array(labels, dtype=float))
    if slope <= 0:
        slope, shift = 1.0, 0.0
    return LineCrf(model.weights, model.start, model.chain, float(slope), float(shift))


def train(docs: DataFrame, labels: DataFrame, max_docs: int = TRAIN_DOCS, max_lines: int = TRAIN_LINES) -> LineCrf:
    """Fits on documents (doc_id, text) and labels (doc_id, quality); the bounded sample is fitted on the driver.

    What reaches the driver is at most ``max_docs`` x ``max_lines`` rows of features; texts stay in the tasks."""
    known = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)

    def take(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for d, y, t in zip(f["doc_id"], f["quality"], f["text"], strict=True):
                x, sizes, starts = training_rows(t, max_lines)
                yield pd.DataFrame({"doc_id": [d], "quality": [y], "x": [[v for row in x for v in row]], "sizes": [sizes], "starts": [starts]})

    got = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").mapInPandas(
        take, "doc_id long, quality int, x array<double>, sizes array<int>, starts array<int>")
    # a document in several rows counts once, with its least features
    got = got.groupBy("doc_id").agg(F.min(F.struct("x", "sizes", "starts", "quality")).alias("m")).select("doc_id", "m.*").collect()
    got = sorted(got, key=lambda r: r["doc_id"])
    return fit_rows([np.array(r["x"]).reshape(-1, len(FEATURES)) for r in got], [r["sizes"] for r in got], [r["starts"] for r in got],
                    [int(r["quality"] > 0) for r in got])


def score(docs: DataFrame, model: LineCrf, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """The ``keep`` columns and score of every row."""
    run = F.pandas_udf(lambda texts: pd.Series([s for s, _, _ in model.score_texts(texts.tolist())], dtype="float64"), "double")
    return docs.select(*[docs[c] for c in keep], run(docs[text]).alias("score"))


def keep_good(docs: DataFrame, model: LineCrf, least: float = 0.5, text: str = "text") -> DataFrame:
    """The rows whose score is at least ``least``, with their own columns."""
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    return score(rows.select("row", F.col("row")[text].alias("text")), model, ["row"]).where(F.col("score") >= least).select("row.*")


def label_lines(docs: DataFrame, model: LineCrf, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """One row per line with a word: the ``keep`` columns, line (its text), p_good and good."""
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"line": v, "p_good": q} for v, q in zip(d, p, strict=True)] for _, d, p in model.score_texts(texts.tolist())])

    found = F.pandas_udf(run, "array<struct<line:string,p_good:double>>")
    rows = docs.select(*[docs[c] for c in keep], F.explode(found(docs[text])).alias("_l"))
    return rows.select(*[F.col(f"`{c}`") for c in keep], "_l.line", "_l.p_good", (F.col("_l.p_good") >= 0.5).alias("good"))
