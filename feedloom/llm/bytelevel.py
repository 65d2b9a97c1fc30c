"""Byte-level pre-tokenization as a finite-state transducer over code points.

The split ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+`` is a
deterministic transducer with eight states once each code point carries a label that looks at the next
two (does a contraction follow? does the white space go on?). Every transition says whether a piece
starts there. Texts are cut into equal chunks that step side by side: the first pass carries *all*
states through each chunk (its state map), a parallel prefix scan composes the maps, and the second
pass, now knowing each chunk's first state, writes the piece starts.
"""

from __future__ import annotations

import functools
import unicodedata

import numpy as np
import regex
from tokenizers.pre_tokenizers import ByteLevel

# States after a code point.
DONE, LETTERS, NUMBERS, SIGNS, SPACES, PREFIX, ONE_LEFT, TWO_LEFT = range(8)
N_STATES = 8
# Labels of a code point; + N_LABELS for the first of a text.
L, N, P, APOS1, APOS2, BLANK_LAST, SPACE_LAST, SPACE_MORE = range(8)
N_LABELS = 8
# Classes of a code point before looking at its neighbours.
C_LETTER, C_NUMBER, C_SIGN, C_APOS, C_BLANK, C_SPACE = range(6)


@functools.cache
def classes() -> np.ndarray:
    """The class of every code point as the tokenizers library sees it.

    Libraries follow different Unicode versions. Where two of Python's agree the class is taken from
    them; the code points on which they differ are put to the library's own splitter.
    """
    table = np.full(0x110000, C_SIGN, np.uint8)
    points = np.r_[0:0xD800, 0xE000:0x110000]
    every = points.astype("<u4").tobytes().decode("utf-32-le")
    for pattern, value in ((r"\p{L}+", C_LETTER), (r"\p{N}+", C_NUMBER), (r"\p{White_Space}+", C_SPACE)):
        for m in regex.finditer(pattern, every):
            table[points[m.start():m.end()]] = value
    known = {"L": C_LETTER, "N": C_NUMBER}
    unsure = [c for c in np.flatnonzero((table == C_LETTER) | (table == C_NUMBER)).tolist()
              if known.get(unicodedata.category(chr(c))[0]) != table[c]]
    split = ByteLevel(add_prefix_space=False).pre_tokenize_str
    for k in range(0, len(unsure), 4000):
        part = np.array(unsure[k:k + 4000])
        begins = np.zeros(5 * len(part), bool)
        begins[[span[0] for _, span in split("".join(f"A{chr(c)}1{chr(c)}\n" for c in part))]] = True
        grid = begins.reshape(-1, 5)
        table[part] = np.where(~grid[:, 1], C_LETTER, np.where(~grid[:, 3], C_NUMBER, C_SIGN))
    table[ord("'")], table[ord(" ")] = C_APOS, C_BLANK
    return table


@functools.cache
def machine() -> tuple[np.ndarray, np.ndarray]:
    """next[label, state] and starts[label, state]."""
    to = np.zeros((2 * N_LABELS, N_STATES), np.uint8)
    starts = np.ones((2 * N_LABELS, N_STATES), bool)
    fresh = {L: LETTERS, N: NUMBERS, P: SIGNS, APOS1: ONE_LEFT, APOS2: TWO_LEFT,
             BLANK_LAST: PREFIX, SPACE_LAST: DONE, SPACE_MORE: SPACES}
    joins = {L: ((LETTERS, LETTERS), (PREFIX, LETTERS)), N: ((NUMBERS, NUMBERS), (PREFIX, NUMBERS)),
             SPACE_MORE: ((SPACES, SPACES),)}
    joins |= dict.fromkeys((P, APOS1, APOS2), ((SIGNS, SIGNS), (PREFIX, SIGNS)))
    for label, state in fresh.items():
        to[[label, label + N_LABELS]] = state
        for before, after in joins.get(label, ()):
            to[label, before], starts[label, before] = after, False
    for label in (L, N, P):  # inside a contraction
        to[label, TWO_LEFT], to[label, ONE_LEFT] = ONE_LEFT, DONE
        starts[label, [TWO_LEFT, ONE_LEFT]] = False
    return to, starts


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of valid UTF-8, and the byte at which each begins."""
    if not len(data) or data.max() < 0x80:
        return data.astype(np.uint32), np.arange(len(data))
    at = np.flatnonzero((data & 0xC0) != 0x80)
    points = data[at].astype(np.uint32)
    wide = np.flatnonzero(points >= 0x80)
    lead, padded = points[wide], np.concatenate([data, np.zeros(3, np.uint8)])
    c1, c2, c3 = (padded[at[wide] + k].astype(np.uint32) & 0x3F for k in (1, 2, 3))
    points[wide] = np.where(lead < 0xE0, (lead & 0x1F) << 6 | c1, np.where(
        lead < 0xF0, (lead & 0x0F) << 12 | c1 << 6 | c2, (lead & 0x07) << 18 | c1 << 12 | c2 << 6 | c3))
    return points, at


def labels(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The label of each code point; ``first``: indexes at which a text begins."""
    kind = classes()[points]
    n = len(points)
    ends = np.zeros(n, bool)  # the last of its text
    ends[first[1:] - 1] = True
    ends[n - 1] = True
    space = kind >= C_BLANK
    more = np.ones(n, bool)
    more[:-1] = space[1:]
    more |= ends
    out = np.array([L, N, P, P, BLANK_LAST, SPACE_LAST], np.uint8)[kind]
    out[space & more] = SPACE_MORE
    apos = np.flatnonzero((kind == C_APOS) & ~ends)
    ahead = np.concatenate([points, np.zeros(2, points.dtype)])
    one, two = ahead[apos + 1], ahead[apos + 2]
    out[apos[np.isin(one, _ONE)]] = APOS1
    pair = np.isin(one.astype(np.int64) << 32 | two, _TWO) & ~ends[np.minimum(apos + 1, n - 1)]
    out[apos[pair]] = APOS2
    out[first] += N_LABELS
    return out


_ONE = [ord(c) for c in "stmd"]
_TWO = [ord(a) << 32 | ord(b) for a, b in ("re", "ve", "ll")]


def scan(maps: np.ndarray) -> np.ndarray:
    """The state before each chunk: an inclusive parallel prefix scan of state maps [chunk, state], shifted by one."""
    total, step = maps.copy(), 1
    while step < len(total):
        total[step:] = np.take_along_axis(total[step:], total[:-step], axis=1)
        step *= 2
    return np.concatenate([[DONE], total[:-1, DONE]])


def piece_starts(data: np.ndarray, offsets: np.ndarray, chunk: int = 256) -> np.ndarray:
    """Byte offsets at which the pieces of the texts begin. ``offsets``: of the texts in ``data`` (texts + 1)."""
    if not len(data):
        return np.zeros(0, np.int64)
    points, at = code_points(data)
    first = np.searchsorted(at, np.unique(offsets[:-1][offsets[:-1] < offsets[1:]]))
    marks = labels(points, first)
    to, starts = machine()
    n = len(marks)
    lanes = -(-n // chunk)
    grid = np.full(lanes * chunk, P, np.uint8)
    grid[:n] = marks
    grid = np.ascontiguousarray(grid.reshape(lanes, chunk).T)
    flat = to.ravel()
    # Most labels lead to one state whatever came before, so nearly all maps are soon constant: only lanes
    # whose map is not yet constant keep stepping with every state.
    single = np.zeros(lanes, np.uint8)
    open_, maps = np.arange(lanes), np.broadcast_to(np.arange(N_STATES, dtype=np.uint8), (lanes, N_STATES))
    for k, row in enumerate(grid):
        single = flat[row.astype(np.intp) * N_STATES + single]
        if len(open_):
            maps = flat[(row[open_].astype(np.intp) * N_STATES)[:, None] + maps]
            if k % 8 == 7:
                varied = (maps != maps[:, :1]).any(axis=1)
                open_, maps = open_[varied], maps[varied]
    whole = np.repeat(single[:, None], N_STATES, axis=1)
    whole[open_] = maps
    maps = whole
    state = scan(maps)
    begin, flat_starts = np.empty((chunk, lanes), bool), starts.ravel()
    for k, row in enumerate(grid):
        key = row.astype(np.intp) * N_STATES + state
        begin[k] = flat_starts[key]
        state = flat[key]
    return at[np.flatnonzero(begin.T.ravel()[:n])]
