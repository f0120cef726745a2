"""Words and marks of many texts at once, as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

SPACE, WORD, MARK = 0, 1, 2
UPPER, LOWER, DIGIT = 1, 2, 4
#: Characters that are hashed at a time, and about as many of the texts that are worked on at once.
CHARACTERS = 1 << 19
#: Beyond this code point no character is a letter, a number or white space.
LAST_ASSIGNED = 0x40000
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_MIX = np.uint64(0xD6E8FEB86659FD93)


@lru_cache(1)
def character_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each code point: whether it is white space, part of a word (letters, numbers, ``_``) or a mark; its case and whether it is a digit; and its lower case, itself where that is several characters."""
    kind, traits, lower = np.full(0x110000, MARK, np.uint8), np.zeros(0x110000, np.uint8), np.arange(0x110000, dtype=np.uint32)
    for cp in range(LAST_ASSIGNED):
        c = chr(cp)
        if c.isspace():
            kind[cp] = SPACE
        elif c.isalnum() or c == "_":
            kind[cp] = WORD
            traits[cp] = UPPER * c.isupper() | LOWER * c.islower() | DIGIT * c.isdigit()
            if len(small := c.lower()) == 1:
                lower[cp] = ord(small)
    return kind, traits, lower


@lru_cache(1)
def letters() -> np.ndarray:
    """Each letter's lower case, and a blank for all that isn't a letter."""
    lower = character_tables()[2]
    out = np.full(0x110000, 0x20, np.uint32)
    alphabetic = [cp for cp in range(LAST_ASSIGNED) if chr(cp).isalpha()]
    out[alphabetic] = lower[alphabetic]
    return out


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


@lru_cache(4)
def _powers(n: int, which: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of an odd number and of its inverse, modulo 2 ** 64."""
    both = []
    for base in (_BASES[which], pow(_BASES[which], -1, 1 << 64)):
        steps = np.full(n, base, np.uint64)
        steps[:1] = 1
        both.append(np.multiply.accumulate(steps))
    return both[0], both[1]


def stretches(starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of ascending spans that lie within CHARACTERS, one span at least."""
    a = 0
    while a < len(starts):
        z = max(a + 1, int(np.searchsorted(ends, starts[a] + CHARACTERS, side="right")))
        yield a, z
        a = z


def hashed_spans(cps: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """A hash of each span of code points, from the differences of running sums over powers of an odd number; there are two such hashes."""
    up, down = _powers(max(CHARACTERS, 1 << max(0, len(cps) - 1).bit_length()), which)
    sums = np.zeros(len(cps) + 1, np.uint64)
    np.cumsum((cps + np.uint32(1)) * up[: len(cps)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    return (h ^ h >> np.uint64(32)) * _MIX


@dataclass
class Tokens:
    """A row for each token, in order: its text's number, whether it is a word, a hash of its lower case, what its characters are, its first and last character and its length."""

    owner: np.ndarray
    word: np.ndarray
    hashed: np.ndarray
    traits: np.ndarray
    first: np.ndarray
    last: np.ndarray
    size: np.ndarray


def tokens(texts: list[str | None]) -> Tokens:
    """The tokens of whole texts: runs of word characters and runs of marks; none for null and blank texts."""
    kind_of, traits_of, lower = character_tables()
    cps = code_points("\n".join(t or "" for t in texts))
    ends_of = np.cumsum([len(t or "") + 1 for t in texts])
    kind = kind_of[cps]
    change = np.flatnonzero(kind[1:] != kind[:-1]) + 1
    edges = np.concatenate([[0], change, [len(cps)]]).astype(np.int64)
    filled = kind[edges[:-1]] != SPACE if len(cps) else np.zeros(1, bool)
    starts, ends = edges[:-1][filled], edges[1:][filled]
    hashed, traits = np.empty(len(starts), np.uint64), np.empty(len(starts), np.uint8)
    for a, z in stretches(starts, ends):
        begin = int(starts[a])
        own = cps[begin : int(ends[z - 1])]
        s, e = starts[a:z] - begin, ends[a:z] - begin
        hashed[a:z] = hashed_spans(lower[own], s, e)
        traits[a:z] = np.bitwise_or.reduceat(traits_of[own], s)
    return Tokens(np.searchsorted(ends_of, starts, side="right"), kind[starts] == WORD, hashed, traits, cps[starts], cps[ends - 1], ends - starts)


def groups(texts: list[str | None], characters: int = CHARACTERS) -> Iterator[tuple[int, list[str | None]]]:
    """Runs of whole texts of about so many characters, each with its first text's number."""
    at, held = 0, 0
    for k, t in enumerate(texts):
        held += len(t or "")
        if held >= characters:
            yield at, texts[at : k + 1]
            at, held = k + 1, 0
    if at < len(texts):
        yield at, texts[at:]


def split_by_owner(owner: np.ndarray, values: np.ndarray, n: int) -> list[np.ndarray]:
    """The values of each of ``n`` owners; ``owner`` is ascending."""
    return np.split(values, np.searchsorted(owner, np.arange(1, n))) if n else []
