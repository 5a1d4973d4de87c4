"""Secrets in texts: fixed patterns, and values next to words like *password* that are hard to guess.

The guess cost of a value is the least sum, over all ways to cut it into spans, of the bits of its spans and of
``KIND_BITS`` for each span:

* a word of the word list: the logarithm of its rank, and a bit for a capital or for all capitals, or one bit a letter
  for any other mix of cases;
* a date: year, day and month in the usual orders, with or without separators;
* a repeat: a unit of up to ``UNIT`` signs as often as it follows itself: the unit's bits and the logarithm of the times;
* a keyboard walk: at least three neighbouring keys, or signs of the alphabet or digits in order: the first key, the
  logarithm of the length and ``TURN_BITS`` for each turn; as far as it goes;
* brute force: any other signs, by the size of their class.

The cost grows linearly with the length of a value. The word list is a bounded file (the tokens of a byte-level
tokenizer that are words, whose ids fall with their frequency); nothing is learnt from the texts.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from math import log2

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hindcast.llm.kernels import slices

KIND_BITS, TURN_BITS, UNIT = log2(5), log2(6), 8
#: A value that takes so many guesses is a secret.
MIN_BITS = log2(10**10)

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]+")
KINDS = ["assign", "access", "hex", "guess"]
#: A credential's name, a separator, and what stands there up to white space, a quote or a bracket.
CONTEXT = re.compile(r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|bearer|(?:api|access|private|auth|secret)[_-]?key)["']?(?:\x20*(?::=|=>|[:=])\x20*|\x20is\x20)["']?([^\s"'`<>(){}|,;]+)""", re.I | re.A)
#: Texts without a match have none of the above.
MAYBE = r"(?i:pass|pwd|secret|token|credential|bearer|key)|AKIA[A-Z0-9]{12}|[0-9a-f]{32}"

# The keys of a keyboard by rows, and signs in order.
KEYS = ["1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm"]
IN_ORDER = ["abcdefghijklmnopqrstuvwxyz", "0123456789"]


@lru_cache(maxsize=1)
def _steps() -> dict[str, int]:
    """The direction from one sign to the next, for neighbouring keys (each row lies half a key further right) and
    signs in order; the latter come first."""
    out = {}
    at = {c: (r, k) for r, row in enumerate(KEYS) for k, c in enumerate(row)}
    places = {v: c for c, v in at.items()}
    for c, (r, k) in at.items():
        for way, (dr, dk) in enumerate([(0, 1), (0, -1), (1, 0), (1, -1), (-1, 0), (-1, 1)], 3):
            if (r + dr, k + dk) in places:
                out[c + places[r + dr, k + dk]] = way
    for signs in IN_ORDER:
        for a, b in zip(signs, signs[1:]):  # noqa: B905
            out[a + b], out[b + a] = 1, 2
    return out


def _sign_bits(c: str) -> float:
    if c.isascii():
        return log2(10) if c.isdigit() else log2(26) if c.isalpha() else log2(33)
    return log2(100)


_YEAR = "(?:19|20)[0-9]{2}"
_DAY, _MONTH = "(?:0[1-9]|[12][0-9]|3[01])", "(?:0[1-9]|1[0-2])"
#: Dates by length: their bits and form.
_DATES = {
    4: (log2(200), re.compile(_YEAR)),
    6: (log2(100 * 366), re.compile(f"{_DAY}{_MONTH}[0-9]{{2}}|{_MONTH}{_DAY}[0-9]{{2}}|[0-9]{{2}}{_MONTH}{_DAY}")),
    8: (log2(200 * 366), re.compile(f"{_YEAR}{_MONTH}{_DAY}|{_DAY}{_MONTH}{_YEAR}|{_MONTH}{_DAY}{_YEAR}")),
    10: (log2(200 * 366 * 4), re.compile(f"{_YEAR}([-/._]){_MONTH}\\1{_DAY}|{_DAY}([-/._]){_MONTH}\\2{_YEAR}|{_MONTH}([-/._]){_DAY}\\3{_YEAR}")),
}


class Guesser:
    """Guess costs of values by a list of words, most frequent first."""

    def __init__(self, words: list[str]):
        self.bits = {w: log2(rank) for rank, w in reversed(list(enumerate(words, 1)))}
        self.longest = max(map(len, words), default=0)
        self.cached = lru_cache(maxsize=50_000)(self.cost)

    def word_bits(self, word: str) -> float | None:
        bits = self.bits.get(word.lower())
        if bits is None or word.islower():
            return bits
        return bits + (1 if word.isupper() or word[1:].islower() and word[0].isupper() else len(word))

    def cost(self, value: str) -> float:
        """Bits of the cheapest segmentation of ``value``; 0 for an empty one."""
        n = len(value)
        low = value.lower() if len(value.lower()) == n else value
        sign = [_sign_bits(c) for c in value]
        before = [0.0] * (n + 1)  # sums of bits of signs
        for k, b in enumerate(sign):
            before[k + 1] = before[k] + b
        way = [_steps().get(low[k : k + 2], 0) for k in range(n - 1)]
        stop, turns = [n - 1] * n, [0] * n  # where a walk from here ends, and its turns
        for k in range(n - 2, -1, -1):
            if not way[k]:
                stop[k] = k
            else:
                stop[k] = stop[k + 1]
                turns[k] = turns[k + 1] + (k + 2 < n and way[k + 1] > 0 and way[k + 1] != way[k])
        again = []  # by unit: how many signs from here equal those one unit on
        for u in range(1, min(UNIT, n // 2) + 1):
            run = [0] * (n + 1)
            for k in range(n - u - 1, -1, -1):
                run[k] = run[k + 1] + 1 if value[k] == value[k + u] else 0
            again.append(run)

        infinite = float("inf")
        best, brute = [infinite] * (n + 1), [infinite] * (n + 1)  # of what ends here; with brute force last
        best[0] = 0.0
        for i in range(n):
            here = best[i] + KIND_BITS
            forced = min(brute[i], here) + sign[i]
            if forced < brute[i + 1]:
                brute[i + 1] = forced
                best[i + 1] = min(best[i + 1], forced)
            for end in range(i + 3, min(n, i + self.longest) + 1):
                if low[i:end] in self.bits:
                    best[end] = min(best[end], here + self.word_bits(value[i:end]))
            if value[i].isdigit():
                for length, (bits, form) in _DATES.items():
                    if form.fullmatch(value, i, min(n, i + length)) and i + length <= n:
                        best[i + length] = min(best[i + length], here + bits)
            for u, run in enumerate(again, 1):
                times = 1 + run[i] // u
                if times >= (3 if u == 1 else 2):
                    end = i + times * u
                    best[end] = min(best[end], here + before[i + u] - before[i] + log2(times))
            end = stop[i] + 1
            if end - i >= 3:
                best[end] = min(best[end], here + log2(47) + log2(end - i) + TURN_BITS * turns[i])
        return best[n]


@lru_cache(maxsize=2)
def guesser(words_path: str) -> Guesser:
    """The words of three letters and more among the tokens of a tokenizer file that start a word, by their ids."""
    with open(words_path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    found = (t[1:].lower() for t in sorted(vocabulary, key=vocabulary.get) if t[0] == "Ġ" and t[1:].isascii() and t[1:].isalpha() and len(t) > 3)
    return Guesser(list(dict.fromkeys(found)))


def find(text: str, costs: Guesser, min_bits: float = MIN_BITS) -> list[tuple[str, int, int, float]]:
    """``(kind, start, end, bits)`` by start, then kind, in code points: whole matches of the fixed patterns, and values of
    ``CONTEXT`` (without stops at their end) outside of them that are not letters alone and cost ``min_bits``."""
    out = [("assign", *m.span(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [("access", *m.span(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    out += [("hex", *m.span(), m[0]) for m in HEX.finditer(text) if len(m[0]) >= 32]
    scored = [(kind, a, b, costs.cached(value) if len(value) < 1000 else costs.cost(value)) for kind, a, b, value in out]
    spans = sorted((a, b) for _, a, b, _ in scored)
    reach, k = -1, 0
    for m in CONTEXT.finditer(text):
        value = m[1].rstrip(".:!?*")
        a = m.start(1)
        b = a + len(value)
        while k < len(spans) and spans[k][0] < b:
            reach, k = max(reach, spans[k][1]), k + 1
        if reach > a or value.isalpha() or not value:
            continue
        bits = costs.cached(value) if len(value) < 1000 else costs.cost(value)
        if bits >= min_bits:
            scored.append(("guess", a, b, bits))
    return sorted(scored, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


FOUND = "array<struct<kind:string,start:int,end:int,guess_bits:double>>"
_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("guess_bits", pa.float64())]))


def scan(docs: DataFrame, words_path: str, min_bits: float = MIN_BITS) -> DataFrame:
    """``(doc_id, secrets)`` for each row of ``docs(doc_id, text)``: what ``find`` finds in the whole text, an array.

    Null and empty texts have an empty array, null and repeated ids and repeated rows pass through, an empty table gives
    an empty result. A very long text is read whole; the time of all parts is linear in its length. Other columns are
    left out."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs = guesser(words_path)
        for batch in batches:
            for part in slices(batch, "text"):
                text = pc.fill_null(part.column("text"), "")
                found: list[list] = [[] for _ in range(part.num_rows)]
                for k in np.flatnonzero(pc.match_substring_regex(text, MAYBE).to_numpy(zero_copy_only=False)).tolist():
                    found[k] = [dict(zip(("kind", "start", "end", "guess_bits"), x, strict=True)) for x in find(text[k].as_py(), costs, min_bits)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), pa.array(found, _TYPE)], ["doc_id", "secrets"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id bigint, secrets {FOUND}")


def listed(secrets: Column) -> Column:
    """``kind:start:end`` of each secret, joined by commas."""
    return F.array_join(F.transform(secrets, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
