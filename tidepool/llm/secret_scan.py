"""Secret scan: fixed patterns, and character Markov models compared by log-likelihood ratio.

Patterns find ``assign`` (a keyword, a sign, a value), ``access`` (access key ids) and
``hex`` (long hexadecimal runs); see ``PATTERNS``. On top, every token of
``TOKEN_CHARS`` or more key characters is scored by two first-order character
models: one of random strings, one of ordinary identifiers and words. Both are trained
from labelled samples in the corpus: the strings that the patterns caught are the
random ones (mixed with uniform strings, so that keys of other alphabets than those
caught look random too), all other text the ordinary one. A token is reported as ``markov`` if its
log-likelihood ratio is at least ``LEAST_RATIO`` in all and ``LEAST_MEAN`` per
transition (``LEAST_MEAN_LETTERS`` for a token without digits, which names in mixed case
come near to), it has letters, and it doesn't overlap a pattern's match.

Transitions are counted over whole texts of all documents in a distributed pass; what
reaches the driver are two square matrices of fixed size. Spans are code-point offsets,
end exclusive. Prefilters (a keyword, a long blank-free run) only skip work that cannot
find anything.

Defined results: null and empty texts have no spans; equal rows get equal spans; spans are
sorted by start, then by kind in the order listed; columns beside the text are not
looked at; with an empty table the ordinary model is uniform as well.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_batches

#: Kind, pattern, fewest characters, and the group they are counted in.
PATTERNS = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 6, 2),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 20, 0),
    ("hex", re.compile(r"[0-9a-f]+"), 24, 0),
)
KINDS = [kind for kind, *_ in PATTERNS] + ["markov"]
#: One of these is part of every keyword.
KEYWORD_PARTS = ("passw", "secret", "token", "api")

#: Characters of key material, in this order the states of the models; 0 is anything else.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
STATES = len(ALPHABET) + 1
TOKEN_CHARS = 20
LEAST_RATIO = 30.0
LEAST_MEAN = 1.8
LEAST_MEAN_LETTERS = 2.5
#: Share of uniform strings in the random model; the rest is what the patterns caught.
UNIFORM = 0.5

_LONG_HEX = re.compile(r"[0-9a-f]{24,}")
_LONG_RUN = re.compile(rf"[^\x20\x09-\x0D]{{{TOKEN_CHARS},}}")
_TOKEN = re.compile(r"[A-Za-z0-9+/_=-]+")
_STATE = np.zeros(256, "int64")
_STATE[[ord(c) for c in ALPHABET]] = np.arange(1, STATES)

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each pattern that are long enough: (start, kind's number, end)."""
    found = []
    lower = text.lower()
    if any(k in lower for k in KEYWORD_PARTS):
        _, pattern, least, group = PATTERNS[0]
        found += [(m.start(), 0, m.end()) for m in pattern.finditer(text) if len(m[group]) >= least]
    if "AKIA" in text:
        _, pattern, least, _ = PATTERNS[1]
        found += [(m.start(), 1, m.end()) for m in pattern.finditer(text) if len(m[0]) >= least]
    # a run is either long enough as a whole or dropped, so short ones need not be matched
    found += [(m.start(), 2, m.end()) for run in _LONG_RUN.finditer(text) for m in _LONG_HEX.finditer(text, run.start(), run.end())]
    return sorted(found)


def _transitions(text: str) -> np.ndarray:
    at = _STATE[np.frombuffer(text.encode("latin-1", "replace"), "uint8")]
    return at[:-1] * STATES + at[1:]


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Transition counts inside this task: what the patterns caught (random), everything (all)."""
    size = STATES * STATES
    random, every = np.zeros(size, "int64"), np.zeros(size, "int64")
    for batch in batches:
        for text in batch["text"]:
            if not text:
                continue
            every += np.bincount(_transitions(text), minlength=size)
            reached = 0   # matches of different kinds can overlap; each transition counts once
            for start, kind, end in base_spans(text):
                if kind == 0:   # the value, without its keyword
                    start = PATTERNS[0][1].match(text, start).start(2)
                if end > max(start, reached):
                    random += np.bincount(_transitions(text[max(start, reached):end]), minlength=size)
                    reached = end
    at = np.flatnonzero(every)
    yield pd.DataFrame({"k": at, "random": random[at], "every": every[at]})


def train(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Log-likelihood ratio of every transition, random over ordinary."""
    text_batches(docs.sparkSession)
    counted = (docs.select(F.col(text).alias("text")).mapInPandas(_count, "k int, random long, every long")
               .groupBy("k").agg(F.sum("random").alias("random"), F.sum("every").alias("every")).collect())
    random, every = np.zeros(STATES * STATES), np.zeros(STATES * STATES)
    for r in counted:   # at most STATES squared
        random[r["k"]], every[r["k"]] = r["random"], r["every"]
    share = []
    for counts in (random, every - random):
        own = counts.reshape(STATES, STATES)[1:, 1:] + 1.0
        share.append(own / own.sum(1, keepdims=True))
    ratio = np.zeros((STATES, STATES))
    ratio[1:, 1:] = np.log(UNIFORM / len(ALPHABET) + (1 - UNIFORM) * share[0]) - np.log(share[1])
    return ratio.ravel()


def spans(text: str | None, ratio: np.ndarray) -> list[Span]:
    """All spans of a text: the patterns', and tokens that look random."""
    if not text:
        return []
    found = base_spans(text)
    taken: list[list[int]] = []   # apart and in order
    for start, _, end in found:
        if taken and start <= taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], end)
        else:
            taken.append([start, end])
    more, at = [], 0
    for run in _LONG_RUN.finditer(text):
        for m in _TOKEN.finditer(text, run.start(), run.end()):
            token = m[0]
            if len(token) < TOKEN_CHARS or not any(c.isalpha() for c in token):
                continue
            while at < len(taken) and taken[at][1] <= m.start():   # tokens come in order, too
                at += 1
            if at < len(taken) and taken[at][0] < m.end():
                continue
            own = ratio[_transitions(token)]
            least = LEAST_MEAN if any(c.isdigit() for c in token) else LEAST_MEAN_LETTERS
            if own.sum() >= LEAST_RATIO and own.mean() >= least:
                more.append((m.start(), len(PATTERNS), m.end()))
    return sorted(found + more)


def scan(docs: DataFrame, ratio: np.ndarray, text: str = "text", keep: list[Column] | None = None) -> DataFrame:
    """Columns ``keep`` and spans: array of (kind, start, end), sorted, for every row of ``docs``."""
    text_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    @F.pandas_udf("array<struct<kind:string,start:long,end:long>>")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans(t, shared.value)] for t in batch], dtype=object)

    return docs.select(*(keep or []), found(F.col(text)).alias("spans"))
