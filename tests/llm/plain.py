"""Plain versions of the operators, written from their definitions, and the awkward rows all of them must take."""

import re
from collections import defaultdict

from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = "Lorem ipsum dolor sit amet nine ten. " * 9_000
EDGES = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, LONG), (6, "the same words twice in a row here now"),
         (6, "the same words twice in a row here now"), (None, "an id that is null but with enough words to count here"), (8, "Zoë ☃ 中文 line\nline\nline")]
CLASHES = ["row", "spans", "base_spans", "score", "cid", "key", "shard", "n_words", "kept", "ids", "start", "_row", "_m", "rid", "component_id"]


def edge_docs(spark, rows=EDGES):
    """doc_id and text with columns whose names clash with those the operators use."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           *[T.StructField(c, T.StringType()) for c in CLASHES]])
    return spark.createDataFrame([(*r, *["x"] * len(CLASHES)) for r in rows], schema)


def shingles(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def component_ids(rows):
    """doc_id -> smallest doc_id reachable by links, comparing all pairs that share a shingle."""
    sets, holders = [shingles(t) for _, t in rows], defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            holders[g].append(i)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in enumerate(sets):
        for j in {j for g in s for j in holders[g] if j < i}:
            both = len(s & sets[j])
            if 100 * both >= 75 * len(s | sets[j]):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(i)
    return [min((rows[j][0] for j in groups[find(i)] if rows[j][0] is not None), default=None) for i in range(len(rows))]


def rule_counts(text, stops):
    words, lines = WORD.findall(text or ""), [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = defaultdict(list)
    for i in range(len(words) - 4):
        windows[tuple(words[i:i + 5])].append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)}
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": len(lines),
            "n_stop_words": sum(w in stops for w in words), "n_capitals": len(re.findall("[A-Z]", text or ""))}


def secret_spans(text):
    """The base spans straight from their patterns."""
    out = []
    kinds = (("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
              r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
             ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20), ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24))
    for rank, (kind, pattern, ok) in enumerate(kinds):
        out += [(m.start(), rank, kind, m.end()) for m in re.finditer(pattern, text or "") if ok(m)]
    return [(k, s, e) for s, _, k, e in sorted(out)]
