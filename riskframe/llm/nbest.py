"""N-best segmentation with the pieces and scores of a SentencePiece model, and decoding.

A forward Viterbi pass over the piece lattice gives, for every place, the score of the best way to get there.
Those scores are the exact remaining cost of a search backwards from the end, so A-star takes the segmentations out
in order of score and expands nothing that is not part of one. No piece goes from another sign to a word
mark or over a line end, so the lattice falls apart there; the forward pass runs once per part and task (a
bounded store, many parts at once) and gives the loss of each part's second best; the parts that lose least are searched, and
the best combinations of their alternatives are enumerated in order of what they lose.

A sign without a piece of its own is spelled in byte pieces and costs ``_UNKNOWN`` more than the lowest score.
Equal scores: inside a part in the order found, across parts the change that comes first in the text first.

Defined results: a null text is empty; the empty text has one segmentation without pieces. A text with fewer than n
segmentations gives as many rows as it has. Word marks (U+2581) in a text decode as blanks. Repeated rows give repeated
results. Extra columns are ignored. Texts are segmented whole.
"""

from __future__ import annotations

import bisect
import functools
import heapq
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

N_BEST = 4
MARK = "▁"
_UNKNOWN = 10.0
_STORE = 400_000  # parts a task keeps
_SHORT = 32  # signs of a part that is searched together with others
_PART = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")


@dataclass(frozen=True)
class Pieces:
    """ids and scores of the pieces, ids of the byte pieces, the longest piece, and the score of a spelled sign."""

    known: dict[str, tuple[tuple[int, ...], float]]
    spelled: tuple[int, ...]
    longest: int
    unknown: float

    def lattice(self, text: str) -> tuple[list[float], list[list[tuple[int, tuple[int, ...], float]]]]:
        """Viterbi score of every place, and the edges (start, ids, score) that end there."""
        known, longest, best, into = self.known, self.longest, [0.0], [[]]
        for end in range(1, len(text) + 1):
            found, top = [], float("-inf")
            for start in range(end - longest if end > longest else 0, end):
                hit = known.get(text[start:end])
                if hit is not None:
                    found.append((start, *hit))
                    value = best[start] + hit[1]
                    if value > top:
                        top = value
            if text[end - 1] not in known:
                found.append((end - 1, tuple([self.spelled[b] for b in text[end - 1].encode("utf-8", "surrogatepass")]), self.unknown))
                top = max(top, best[end - 1] + self.unknown)
            best.append(top)
            into.append(found)
        return best, into

    def n_best(self, text: str, n: int) -> list[tuple[tuple[int, ...], float]]:
        """The n best segmentations of a part, best first.

        A hypothesis is a way from some place to the end; its bound is exact, so each open one stands for a
        segmentation of its own, and only as many as are still wanted need to stay open.
        """
        best, into = self.lattice(text)
        open_: list[tuple] = [(-best[-1], len(text), 0, 0.0, None)]
        count, out = 1, []
        while open_ and len(out) < n:
            _, at, _, done, path = open_.pop(0)
            if at == 0:
                ids: list[int] = []
                while path is not None:
                    ids += path[0]
                    path = path[1]
                out.append((tuple(ids), done))
                continue
            wanted = n - len(out)
            for start, ids_, score in into[at]:
                total = score + done
                bound = -(best[start] + total)
                if len(open_) < wanted or bound < open_[-1][0]:
                    bisect.insort(open_, (bound, start, count, total, (ids_, path)))
                    count += 1
                    if len(open_) > wanted:
                        open_.pop()
        return out


@functools.lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [i for i in range(model.get_piece_size())
             if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    known = {model.id_to_piece(i): ((i,), float(model.get_score(i))) for i in plain}
    if any(MARK in p.lstrip(MARK) or (len(p) > 1 and "\n" in p) for p in known):
        raise ValueError("a piece of this model crosses the places where texts are parted")
    spelled = tuple(model.piece_to_id(f"<0x{b:02X}>") for b in range(256))
    return Pieces(known, spelled, max(map(len, known)), min(s for _, s in known.values() if s > -1e8) - _UNKNOWN)


class _Slots:
    """Piece ids and scores by 64-bit hash, for arrays of hashes."""

    def __init__(self, table: Pieces):
        names = list(table.known)
        keys = np.array([int(_hashes(np.array([[ord(c) for c in p]], dtype=np.uint64), len(p))[-1][0, 0]) for p in names], dtype=np.uint64)
        self.bits = np.uint64((1 << 20) - 1)
        self.at = np.zeros((2, 1 << 20), dtype=np.int32)  # 1 + number of the piece, at either place of its hash
        for i, k in enumerate(keys.tolist()):
            for half in (0, 1):
                slot = int(self.places(np.array([k], dtype=np.uint64))[half][0])
                if self.at[half, slot] == 0:
                    self.at[half, slot] = i + 1
                    break
            else:
                raise ValueError("pieces collide")
        self.keys = np.concatenate([np.zeros(1, dtype=np.uint64), keys])
        self.ids = np.array([-1] + [table.known[p][0][0] for p in names], dtype=np.int64)
        self.scores = np.array([-np.inf] + [table.known[p][1] for p in names])

    def places(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        z = h * np.uint64(0xD6E8FEB86659FD93)
        return (z >> np.uint64(44)).view(np.int64), ((z >> np.uint64(24)) & self.bits).view(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Numbers of the pieces, 0 where there is none."""
        a, b = (table[place] for table, place in zip(self.at, self.places(h), strict=True))
        return np.where(self.keys[a] == h, a, np.where(self.keys[b] == h, b, 0))


def _hashes(codes: np.ndarray, longest: int) -> list[np.ndarray]:
    """Hashes of the 1, 2, ... longest signs from each place; codes: a row per part, padded by longest - 1 zeros."""
    n = codes.shape[1] - longest + 1
    out, h = [], np.full((len(codes), n), 0xCBF29CE484222325, dtype=np.uint64)
    for k in range(longest):
        h = (h ^ codes[:, k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        out.append(h)
    return out


@functools.lru_cache(maxsize=2)
def _slots(path: str) -> _Slots:
    return _Slots(pieces(path))


def viterbi(parts: list[str], path: str) -> list[tuple[bytes, float, float]]:
    """(ids, score, loss of the second best) of many parts at once; none may hold an unknown sign."""
    slots, size = _slots(path), np.array([len(p) for p in parts])
    width = int(size.max())
    longest = min(width, pieces(path).longest)
    codes = np.zeros((len(parts), width + longest - 1), dtype=np.uint64)
    codes[np.repeat(np.arange(len(parts)), size), np.concatenate([np.arange(n) for n in size])] = np.frombuffer(
        "".join(parts).encode("utf-32-le"), dtype="<u4")
    found = [slots.find(h) for h in _hashes(codes, longest)]
    n = len(parts)
    best, second = np.full((n, width + 1), -np.inf), np.full((n, width + 1), -np.inf)
    back = np.zeros((n, width + 1), dtype=np.int64)
    best[:, 0] = 0.0
    rows = np.arange(n)
    for end in range(1, width + 1):
        reach = min(longest, end)
        score = np.stack([slots.scores[found[k - 1][:, end - k]] for k in range(1, reach + 1)], axis=1)
        one = score + best[:, end - reach:end][:, ::-1]
        two = score + second[:, end - reach:end][:, ::-1]
        pick = one.argmax(axis=1)
        best[:, end], back[:, end] = one[rows, pick], pick + 1
        one[rows, pick] = two[rows, pick]
        second[:, end] = one.max(axis=1)
    at, steps = size.copy(), []
    while (live := at > 0).any():
        k = np.where(live, back[rows, at], 0)
        at = at - k
        number = np.zeros(n, dtype=np.int64)
        for length in np.unique(k[live]):
            here = live & (k == length)
            number[here] = found[length - 1][here, at[here]]
        steps.append(np.where(live, slots.ids[number], -1))
    ids = np.stack(steps[::-1], axis=1)
    top, loss = best[rows, size], best[rows, size] - second[rows, size]
    return [(r[r >= 0].astype("<u4").tobytes(), s, d) for r, s, d in zip(ids, top.tolist(), loss.tolist(), strict=True)]


class _Store:
    """Part -> (ids as bytes, score, loss of its second best), bounded; further segmentations are searched when asked for."""

    def __init__(self, path: str, n: int):
        self.path, self.table, self.n = path, pieces(path), n
        self.kept: dict[str, tuple[bytes, float, float]] = {}
        self.signs = frozenset(p for p in self.table.known if len(p) == 1)

    def search(self, part: str) -> list[tuple[bytes, float]]:
        return [(np.array(ids, dtype="<u4").tobytes(), score) for ids, score in self.table.n_best(part, self.n)]

    def get(self, parts: list[str]) -> dict[str, tuple[bytes, float, float]]:
        """Entries of all parts."""
        new = list(dict.fromkeys([p for p in parts if p not in self.kept]))
        made: dict[str, tuple[bytes, float, float]] = {}
        plain = sorted([p for p in new if len(p) <= _SHORT and self.signs.issuperset(p)], key=len)
        for lo in range(0, len(plain), 2000):
            block = plain[lo:lo + 2000]
            made.update(zip(block, viterbi(block, self.path), strict=True))
        for p in new:
            if p not in made:
                found = self.search(p)
                made[p] = (*found[0], found[0][1] - found[1][1] if len(found) > 1 else np.inf)
        if len(self.kept) + len(made) <= _STORE:
            self.kept.update(made)
            return self.kept
        return {p: made.get(p) or self.kept[p] for p in set(parts)}


def parts_of(text: str | None) -> list[str]:
    return _PART.findall(MARK + text.replace(" ", MARK)) if text else []


def segmentations(parts: list[str], entries: dict[str, tuple[bytes, float, float]], store: _Store, n: int) -> list[tuple[bytes, float]]:
    """The n best (ids, score) of a whole text, given its parts and their entries."""
    held = [entries[p] for p in parts]
    ids, score, loss = [e[0] for e in held], sum([e[1] for e in held]), [e[2] for e in held]
    few = [i for i in heapq.nsmallest(n - 1, range(len(loss)), key=loss.__getitem__) if loss[i] < np.inf]  # equal losses: first in the text
    found = [store.search(parts[i]) for i in few]
    for i, f in zip(few, found, strict=True):
        ids[i] = f[0][0]
    out = [(b"".join(ids), float(score))]
    lost = lambda j, r: found[j][0][1] - found[j][r][1]
    # combinations of changes in order of loss: raise the last change, add the next part's, or go on to it instead
    heap = [(lost(0, 1), ((0, 1),))] if few else []
    while heap and len(out) < n:
        total, changes = heapq.heappop(heap)
        changed = ids.copy()
        for j, r in changes:
            changed[few[j]] = found[j][r][0]
        out.append((b"".join(changed), float(score - total)))
        j, r = changes[-1]
        if r + 1 < len(found[j]):
            heapq.heappush(heap, (total + lost(j, r + 1) - lost(j, r), (*changes[:-1], (j, r + 1))))
        if j + 1 < len(few):
            heapq.heappush(heap, (total + lost(j + 1, 1), (*changes, (j + 1, 1))))
            if r == 1:
                heapq.heappush(heap, (total - lost(j, 1) + lost(j + 1, 1), (*changes[:-1], (j + 1, 1))))
    return out


def of_texts(texts: list[str | None], store: _Store, n: int) -> list[list[tuple[bytes, float]]]:
    parts = [parts_of(t) for t in texts]
    entries = store.get([p for ps in parts for p in ps])
    return [segmentations(ps, entries, store, n) for ps in parts]


def decode(ids: list[int], path: str) -> str:
    """The text of a segmentation."""
    table = pieces(path)
    names = {i: p.replace(MARK, " ").encode() for p, ((i,), _) in table.known.items()} | {i: bytes([b]) for b, i in enumerate(table.spelled)}
    text = b"".join(names[i] for i in ids).decode("utf-8", "replace")
    return text[1:] if text.startswith(" ") else text


def n_best(docs: DataFrame, path: str, n: int = N_BEST, doc_id: str = "doc_id", text: str = "text", with_ids: bool = True) -> DataFrame:
    """One row per document and segmentation: doc_id, rank (from 1), n_pieces, score, ids_crc32 and, if wanted, ids
    (little-endian unsigned 32-bit)."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = _Store(path, n)
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                block = batch.slice(lo, 200)
                rows = [(i, r + 1, len(b) // 4, s, zlib.crc32(b), b) for i, found in enumerate(of_texts(block.column("text").to_pylist(), store, n))
                        for r, (b, s) in enumerate(found)]
                at, rank, size, score, crc, ids = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [block.column("doc_id").take(pa.array(at)), pa.array(rank, pa.int32()), pa.array(size, pa.int64()),
                     pa.array(score, pa.float64()), pa.array(crc, pa.int64()), *([pa.array(ids, pa.binary())] if with_ids else [])], names=names)

    schema = f"doc_id {kind}, rank int, n_pieces long, score double, ids_crc32 long" + (", ids binary" if with_ids else "")
    names = [c.split()[0] for c in schema.split(", ")]
    return docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")).mapInArrow(run, schema)
