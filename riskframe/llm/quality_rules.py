"""Quality rules: a threshold table compiled into one projection of built-in functions.

Counts are taken from the whole text. Words are runs of characters other than space and U+0009 to
U+000D; lines are split at ``\\n``. A rule compares an integer count with a percentage of another
count, so verdicts are exact and the same in every engine.

Defined results: a null or empty text has no words, all counts are 0 and it is not kept. Repeated
rows give repeated results. Extra columns of the input are ignored by ``measure`` and kept by
``apply_rules`` (a column named like a measure is replaced).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from riskframe.llm.common import let

WINDOW = 5
_OTHER_SPACE = "\t\n\x0b\x0c\r"
# fixed values: frequent function words of English, French, German and Spanish; they count in small
# letters, capitalised and in capitals
STOP_WORDS = ("the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "was", "on", "with", "as", "be", "by",
              "le", "la", "les", "de", "des", "du", "et", "en", "un", "une", "que", "qui", "dans", "pour", "est", "sur",
              "der", "die", "das", "den", "dem", "und", "von", "zu", "mit", "ist", "ein", "eine", "nicht", "auf",
              "el", "los", "las", "y", "por", "con", "una", "se", "no", "para")


@dataclass(frozen=True)
class Rule:
    """Fails when 100 * count lies above ``at_most`` (below ``at_least``) times ``of``; texts under ``min_words`` pass."""

    name: str
    count: str
    of: str
    at_least: int | None = None
    at_most: int | None = None
    min_words: int = 0

    def holds(self) -> str:
        """The condition as SQL text; Spark and other engines read it alike."""
        parts = [f"100 * {self.count} >= {self.at_least} * {self.of}"] if self.at_least is not None else []
        parts += [f"100 * {self.count} <= {self.at_most} * {self.of}"] if self.at_most is not None else []
        return f"(n_words < {self.min_words} OR ({' AND '.join(parts)}))"


RULES = (
    Rule("word_length", "word_chars", "n_words", at_least=200, at_most=1500),
    Rule("symbols", "n_symbols", "word_chars", at_most=8),
    Rule("capitals", "n_capitals", "word_chars", at_most=40),
    Rule("stop_words", "n_stop_words", "n_words", at_least=1, min_words=100),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", at_most=30),
)
BASE_FAILED = "(n_words < 10 OR 100 * n_repeat_words > 20 * n_words)"


def stop_forms(stop_words: Sequence[str] = STOP_WORDS) -> list[str]:
    return sorted({f for w in stop_words for f in (w.lower(), w.capitalize(), w.upper())})


def words_of(text: Column) -> Column:
    """The words; other space becomes a blank first, because splitting at one character needs no pattern."""
    for c in _OTHER_SPACE:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.filter(F.split(text, " ", -1), lambda x: x != "")


def _repeated(words: Column) -> Column:
    """Words that lie in a window found at least twice.

    Window hashes that are all different end the work; otherwise the positions of equal windows are
    brought together by sorting, and covered words are counted from the sorted positions.
    """
    def covered(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        hit = lambda s: F.transform(
            F.filter(F.transform(s, lambda x, k: F.struct(
                x["i"].alias("i"),
                (F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False))
                 | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))).alias("r"))), lambda x: x["r"]),
            lambda x: x["i"])
        reach = lambda p: F.aggregate(
            F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)))),
            F.lit(0).cast("long"), lambda a, x: a + x)
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(
            let(ordered, lambda s: let(F.sort_array(hit(s)), reach)))

    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW),
                         lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))
    return F.when(F.size(words) < WINDOW + 1, F.lit(0).cast("long")).otherwise(let(hashes, covered))


def measures(text: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """All counts of one text as a struct."""
    text = F.coalesce(text, F.lit(""))
    seen = F.split(text, "\n", -1)
    of_words = lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.char_length(x)).alias("word_chars"),
        F.size(F.filter(w, lambda x: x.isin(*stop_forms(stop_words)))).cast("long").alias("n_stop_words"),
        _repeated(w).alias("n_repeat_words"))
    of_lines = lambda ls: F.struct(
        F.size(ls).cast("long").alias("n_lines"),
        (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"))
    return F.struct(
        let(words_of(text), of_words).alias("w"),
        let(F.filter(seen, lambda x: x.rlike(r"[^\x20\x09-\x0D]")), of_lines).alias("l"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit(r"[A-Z]")).cast("long").alias("n_capitals"))


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words",
            "n_capitals")


def measure(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """The ``keep`` columns and every measure; one projection, no shuffle."""
    m = docs.select(*[docs[c] for c in keep], measures(docs[text]).alias("_m"))
    where = {"n_lines": "l", "n_dup_lines": "l", "n_symbols": None, "n_capitals": None}
    field = lambda n: F.col("_m")[p][n] if (p := where.get(n, "w")) else F.col("_m")[n]
    return m.select(*[F.col(f"`{c}`") for c in keep], *[field(n).alias(n) for n in MEASURES])


def judge(measured: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Adds ``base_failed``, one boolean per rule (``ok_<name>``) and ``kept``."""
    out = measured.withColumn("base_failed", F.expr(BASE_FAILED))
    out = out.withColumns({f"ok_{r.name}": F.expr(r.holds()) for r in rules})
    verdict = ~F.col("base_failed")
    for r in rules:
        verdict &= F.col(f"ok_{r.name}")
    return out.withColumn("kept", verdict)


def apply_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns only."""
    names = docs.columns
    held = docs.select(F.struct(*[docs[c] for c in names]).alias("_row"))
    inner = held.select("_row", held["_row"][text].alias("text"))
    return judge(measure(inner, keep=("_row",)), rules).where("kept").select("_row.*")
