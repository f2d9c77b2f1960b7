"""Anchors in texts: positions picked by what stands around them, so equal passages bear equal anchors.

A window of `WINDOW` bytes has as its anchor the place of the least hash of 8 bytes in it, the last of
equals. Every text of at least WINDOW + 7 bytes is thus cut into phrases of at most `WINDOW` bytes, and
text that stands in two places is cut alike but for its edges.
"""

from __future__ import annotations

import numpy as np

from rivulet.llm.bytetext import mixed

WINDOW = 128
GRAM = 8
# Bytes of text whose numbers are worked on at a time: eight bytes for each stay in a core's cache.
BLOCK = 1 << 16


def _shifted(x: np.ndarray, by: int, fill) -> np.ndarray:
    out = np.full_like(x, fill)
    out[: max(len(x) - by, 0)] = x[by:]
    return out


def window_anchors(data: np.ndarray) -> np.ndarray:
    """For each position the anchor of the window that begins there. Windows that run over the end of
    a text mean nothing."""
    grams = data.astype(np.uint64)
    for width in (1, 2, 4):
        grams |= _shifted(grams, width, 0) << np.uint64(8 * width)
    low = np.uint64(0xFFFFFFFF)
    keys = (mixed(grams) & ~low) | (low - np.arange(len(data), dtype=np.uint64))
    least = np.empty_like(keys)
    width = 1
    while width < min(WINDOW, len(data)):
        np.minimum(keys[:-width], keys[width:], out=least[:-width])
        least[-width:] = keys[-width:]
        keys, least = least, keys
        width *= 2
    return (low - (keys & low)).astype(np.int64)


def _anchors_of_block(data: np.ndarray, offsets: np.ndarray):
    n = len(data)
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    whole = np.arange(n) + (WINDOW + GRAM - 1) <= offsets[rows + 1]
    starts = np.flatnonzero(whole)
    at = window_anchors(data)[starts]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (rows[starts[1:]] != rows[starts[:-1]])
    first = np.flatnonzero(new)
    place, row = at[first], rows[starts[first]]
    last = np.append(first[1:], len(at))[: len(first)]
    following = np.full(len(place), -1)
    same = row[1:] == row[:-1]
    following[:-1][same] = place[1:][same]
    return row, place, following, starts[first], starts[last - 1] + 1


def anchors(data: np.ndarray, offsets: np.ndarray):
    """(row, position, next position or -1, first start, last start + 1) of the anchors of some texts. The
    starts are those of the windows that have the anchor, as far as the window lies in its text. Texts are
    taken by blocks; a longer one is a block of its own."""
    found, first, n = [], 0, len(offsets) - 1
    while first < n or not found:
        last = int(np.searchsorted(offsets, offsets[first] + BLOCK, side="right")) - 1
        last = min(max(last, first + 1), n)
        begin = offsets[first]
        row, place, following, start, stop = _anchors_of_block(
            data[begin : offsets[last]], offsets[first : last + 1] - begin
        )
        following = np.where(following < 0, -1, following + begin)
        found.append((row + first, place + begin, following, start + begin, stop + begin))
        first = last
    return tuple(map(np.concatenate, zip(*found)))
