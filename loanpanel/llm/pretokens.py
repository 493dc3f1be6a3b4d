"""Splitting texts into the units that a BPE vocabulary merges within.

The two vocabularies split texts by patterns over letters (L), numbers (N),
white space (S) and the rest (O). Here whole batches of texts are split at
once: characters are classed by a table, units begin where the class changes,
and the few special cases of the patterns (contractions, the space that joins
the next unit) move single borders.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Regex
from tokenizers.pre_tokenizers import Split

LETTER, NUMBER, SPACE, OTHER = range(4)
#: Endings that a lone apostrophe pulls from the letters after it.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
#: Characters that are split in one go; bounds the memory of a step.
STEP_CHARS = 400_000

_BASE = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(1)
def char_classes() -> np.ndarray:
    """The class of every code point, as the tokenizers library sees it.
    Beyond the first four planes and the tags there are no letters, numbers or
    white space."""
    points = [*range(0xD800), *range(0xE000, 0x40000), *range(0xE0000, 0xE1000)]
    text, at = "".join(map(chr, points)), np.array(points)
    table = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((SPACE, r"\s+"), (NUMBER, r"\p{N}+"), (LETTER, r"\p{L}+")):
        runs = Split(Regex(pattern), "removed", invert=True).pre_tokenize_str(text)
        for _, (begin, end) in runs:
            table[at[begin:end]] = kind
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser over an array of unsigned integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted different numbers; np.unique hashes before it sorts, ten times as long."""
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


@lru_cache(1)
def _char_values() -> tuple[np.ndarray, np.ndarray]:
    points = np.arange(1, 0x110001, dtype=np.uint64)
    return mix(points * _BASE), mix(points * np.uint64(0xD1342543DE82EF95))


@lru_cache(1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    base = np.uint64(0x5851F42D4C957F2D)
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    up, down = np.ones(size, np.uint64), np.ones(size, np.uint64)
    up[1:], down[1:] = base, inverse
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


@dataclass
class Units:
    """Units of a batch of texts: unit k is text[starts[k]:ends[k]]; the units
    of document d are those from first[d] up to first[d + 1]."""

    text: str
    points: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def __getitem__(self, k: int) -> str:
        return self.text[self.starts[k] : self.ends[k]]

    def _hashes(self, values: np.ndarray, ends: np.ndarray, ordered: bool) -> np.ndarray:
        n = len(self.points)
        sums = np.zeros(n + 1, np.uint64)
        if not ordered:
            np.cumsum(values[self.points], out=sums[1:])
            return sums[ends] - sums[self.starts]
        up, down = _powers(1 << max(int(n).bit_length(), 19))
        np.cumsum(values[self.points] * up[:n], out=sums[1:])
        return (sums[ends] - sums[self.starts]) * down[self.starts]

    def keys(self, letters: int | None = None) -> np.ndarray:
        """A hash of every unit, or of its first `letters` characters."""
        ends = self.ends if letters is None else np.minimum(self.ends, self.starts + letters)
        return mix(self._hashes(_char_values()[0], ends, True) + np.uint64(letters or 0))

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Key and one position of every distinct unit, and for each unit its
        place among them. Two independent hashes tell units apart; a clash of
        the first that the second shows is settled by the strings."""
        value, other = _char_values()
        key, check = self._hashes(value, self.ends, True), self._hashes(other, self.ends, False)
        keys, at, place = np.unique(key, return_index=True, return_inverse=True)
        if (check != check[at[place]]).any():
            seen: dict[str, int] = {}
            place = np.array([seen.setdefault(self[k], len(seen)) for k in range(len(key))], np.int64)
            at = np.zeros(len(seen), np.int64)
            at[place[::-1]] = np.arange(len(key))[::-1]
            keys = mix(key[at] ^ check[at])
        return keys, at, place


def split(texts: list[str], specials: tuple[str, ...] = (), leading_space: bool = True) -> Units:
    """Units of the texts. leading_space: a space joins the unit after it and
    numbers stay together (byte-level vocabularies); otherwise white space is
    dropped and every digit stands alone."""
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=bounds[1:])
    text = "".join(texts)
    n = len(text)
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    kind = char_classes()[points]
    starts = np.ones(n + 1, bool)
    starts[1:n] = kind[1:] != kind[:-1]
    if not leading_space:
        starts[:n] |= kind == NUMBER
    border = np.zeros(n + 1, bool)  # between texts, and around special tokens
    border[bounds] = True
    whole: list[tuple[int, int]] = []
    if specials and any(s in text for s in specials):
        pattern = re.compile("|".join(map(re.escape, specials)))
        for t, begin in zip(texts, bounds):
            whole += [(begin + m.start(), begin + m.end()) for m in pattern.finditer(t)]
        border[[i for pair in whole for i in pair]] = True
    starts |= border
    _contractions(points, starts, border, leading_space)
    if leading_space:
        after = np.flatnonzero((kind[1:] != SPACE) & (kind[:-1] == SPACE) & ~border[1:n]) + 1 if n else np.zeros(0, int)
        starts[after - 1] = True
        starts[after[points[after - 1] == 0x20]] = False
    for a, b in whole:
        starts[a + 1 : b] = False
        starts[a] = starts[b] = True
    begin = np.flatnonzero(starts[:n])
    end = np.append(begin[1:], n)[: len(begin)]
    if not leading_space:
        kept = kind[begin] != SPACE
        begin, end = begin[kept], end[kept]
    return Units(text, points, begin, end, np.searchsorted(begin, bounds))


def _contractions(points: np.ndarray, starts: np.ndarray, border: np.ndarray, leading_space: bool) -> None:
    n = len(points)
    quotes = np.flatnonzero(points == 0x27)
    if not len(quotes):
        return
    alone = quotes[starts[quotes] & starts[quotes + 1] & ~border[quotes + 1]]
    for q in alone.tolist():
        if leading_space and q and points[q - 1] == 0x20 and not border[q]:
            continue
        tail = "".join(map(chr, points[q + 1 : min(q + 3, n)].tolist()))
        for c in CONTRACTIONS:
            if tail.startswith(c) and not border[q + 2 : q + 1 + len(c)].any():
                starts[q + 1] = False
                starts[q + 1 + len(c)] = True
                break


def text_runs(column: pa.Array, most: int = STEP_CHARS) -> Iterator[tuple[slice, list[str]]]:
    """Runs of a column of texts as Python strings, null as empty. Only one
    run at a time leaves the batch, so memory follows `most`, not the batch."""
    lengths = pc.fill_null(pc.utf8_length(column), 0).to_pylist()
    for run in steps(lengths, most):
        yield run, [t or "" for t in column.slice(run.start, run.stop - run.start).to_pylist()]


def steps(lengths: list[int], most: int = STEP_CHARS) -> list[slice]:
    """Runs of texts of about `most` characters; a longer text is its own run."""
    out, begin, size = [], 0, 0
    for i, length in enumerate(lengths):
        if size and size + length > most:
            out.append(slice(begin, i))
            begin, size = i, 0
        size += length
    return [*out, slice(begin, len(lengths))] if begin < len(lengths) else out


@lru_cache(1)
def stand_ins() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level
    vocabularies: itself where printable, the rest from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


def unit_ids(model, units: list[str]) -> list[list[int]]:
    """Ids of units by a byte-level model, past the steps that split texts."""
    table = stand_ins()
    plain = [u.encode().decode("latin-1").translate(table) for u in units]
    return [[t.id for t in model.tokenize(p)] for p in plain]
