"""Short sequences near given ones, found inside a row by pieces that must agree exactly."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_CODE = np.full(256, 4, np.uint8)
for _i, _b in enumerate(b"acgt"):
    _CODE[_b] = _CODE[_b - 32] = _i
#: Windows compared at a time, which bounds what a task holds for it to some 50 MB.
BLOCK = 1 << 18


def coded(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bases as 0 to 3, and whether a letter is none of A, C, G and T."""
    code = _CODE[text]
    return np.where(code < 4, code, 0).astype(np.uint64), code > 3


def packed(code: np.ndarray, odd: np.ndarray, starts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """``k`` bases from each start, two bits a base, and a bit at the odd ones."""
    value, mark = np.zeros(len(starts), np.uint64), np.zeros(len(starts), np.uint64)
    for i in range(k):
        value = value << np.uint64(2) | code[starts + i]
        mark = mark << np.uint64(2) | odd[starts + i]
    return value, mark


class Near:
    """Sequences of ``k`` letters, at most 31, that others may differ from in ``distance`` places.

    Of ``distance`` + 1 pieces one must agree, so the pieces' values give the candidates, and their differing places are
    counted. A letter other than A, C, G and T differs from every letter.
    """

    def __init__(self, sequences: list[str], names: list[int], k: int, distance: int):
        if not distance < k <= 31:
            raise ValueError("k must lie between distance + 1 and 31")
        self.k, self.distance = k, distance
        text = np.frombuffer("".join(sequences).encode("ascii", "replace"), np.uint8)
        self.value, self.mark = packed(*coded(text), np.arange(len(sequences)) * k, k)
        self.names = np.array(names, np.int64)
        cuts = [k * i // (distance + 1) for i in range(distance + 2)]
        self.pieces = []
        for first, end in zip(cuts, cuts[1:], strict=False):
            shift, mask = np.uint64(2 * (k - end)), np.uint64((1 << 2 * (end - first)) - 1)
            own = self.value >> shift & mask
            order = np.argsort(own, kind="stable")
            values, begin = np.unique(own[order], return_index=True)
            self.pieces.append((shift, mask, values, np.append(begin, len(own)), order))

    def matches(self, value: np.ndarray, mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, name) of windows near a sequence; a pair may come more than once."""
        found: list[tuple[np.ndarray, np.ndarray]] = []
        low = np.uint64(0x5555555555555555)
        for shift, mask, values, begin, order in self.pieces:
            if not len(values):
                continue
            own = value >> shift & mask
            at = np.minimum(np.searchsorted(values, own), len(values) - 1)
            window = np.flatnonzero(values[at] == own)
            many = begin[at[window] + 1] - begin[at[window]]
            window, first = np.repeat(window, many), np.repeat(begin[at[window]] - np.cumsum(many) + many, many)
            which = order[first + np.arange(len(window))]
            x = value[window] ^ self.value[which]
            differ = np.bitwise_count((x | x >> np.uint64(1)) & low | mark[window] | self.mark[which])
            near = differ <= self.distance
            found.append((window[near], self.names[which[near]]))
        return (np.concatenate([w for w, _ in found]), np.concatenate([n for _, n in found])) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All letters of a column, a byte each, and where each row begins; nulls are empty."""
    data = [(x or "").encode("ascii", "replace") for x in column.to_pylist()]
    return np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)])


def first_near(column: pa.Array, near: Near) -> tuple[np.ndarray, np.ndarray]:
    """Of each row the first place where a window is near a sequence, and the least name there; -1 where none is."""
    text, begin = _bytes(column)
    code, odd = coded(text)
    place, name = np.full(len(column), -1), np.full(len(column), -1)
    size = np.diff(begin) - near.k + 1
    many = np.maximum(size, 0)
    total = np.cumsum(many)
    first = 0
    while first < len(many):
        end = max(first + 1, int(np.searchsorted(total, (total[first - 1] if first else 0) + BLOCK, "right")))
        own = many[first:end]
        row = np.repeat(np.arange(first, end), own)
        offset = np.arange(len(row)) - np.repeat(np.cumsum(own) - own, own)
        window, found = near.matches(*packed(code, odd, begin[row] + offset, near.k))
        order = np.lexsort((found, offset[window], row[window]))
        r = row[window][order]
        lead = np.flatnonzero(np.append(True, r[1:] != r[:-1])) if len(r) else order
        place[r[lead]], name[r[lead]] = offset[window][order][lead], found[order][lead]
        first = end
    return place, name


def tips_near(column: pa.Array, tips: list[Near]) -> tuple[np.ndarray, np.ndarray]:
    """Of each row the longest end that is near a sequence of that length, and the least name for it; 0 and -1 where none is."""
    text, begin = _bytes(column)
    code, odd = coded(text)
    size, name = np.zeros(len(column), np.int64), np.full(len(column), -1)
    for near in sorted(tips, key=lambda x: -x.k):
        row = np.flatnonzero((np.diff(begin) >= near.k) & (size == 0))
        for i in range(0, len(row), BLOCK):
            part = row[i : i + BLOCK]
            window, found = near.matches(*packed(code, odd, begin[part + 1] - near.k, near.k))
            order = np.lexsort((found, window))
            w = window[order]
            lead = np.flatnonzero(np.append(True, w[1:] != w[:-1])) if len(w) else order
            size[part[w[lead]]], name[part[w[lead]]] = near.k, found[order][lead]
    return size, name


def _letters_of(column: pa.Array, complement: bool) -> tuple[np.ndarray, np.ndarray]:
    """A row's bases as codes (or their complements') in a padded matrix, and lengths. Other letters and padding match nothing."""
    text, begin = _bytes(column)
    code, odd = coded(text)
    own = (3 - code if complement else code).astype(np.int8)
    own[odd] = 5 if complement else 4
    size = np.diff(begin)
    out = np.full((len(size), int(size.max(initial=0))), 7 if complement else 6, np.int8)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(text)) - begin[row]] = own
    return out, size


def insert_lengths(one: pa.Array, other: pa.Array, penalty: int, least: int) -> np.ndarray:
    """Length of the fragment that two mates were read from, by the offset with most votes; -1 where none has enough.

    If it is n, base i of the one faces base n - 1 - i of the other. Each pair of facing bases that are complements is a vote, each
    other pair costs ``penalty``; the highest sum counts if it is ``least`` or more, and of equal ones the longest fragment.
    """
    a, la = _letters_of(one, False)
    b, lb = _letters_of(other, True)
    best, found = np.full(len(la), least), np.full(len(la), -1)
    for n in range(1, a.shape[1] + b.shape[1]):
        first, end = max(0, n - b.shape[1]), min(a.shape[1], n)
        same = (a[:, first:end] == b[:, n - end : n - first][:, ::-1]).sum(1)
        faced = np.maximum(np.minimum(la, n) - np.maximum(0, n - lb), 0)
        votes = same - penalty * (faced - same)
        better = (votes >= best) & (faced > 0)
        best[better], found[better] = votes[better], n
    return found
