"""Ratcliff-Obershelp similarity and the exact bounds that save calls to it."""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def match_ratio(a: Column, b: Column) -> Column:
    """Ratio of two strings, equal strings 1.0; argument order matters."""
    return F.pandas_udf(_ratios, T.DoubleType())(a, b)


def _ratios(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for left, right in pairs:
        matcher, seen = SequenceMatcher(), None
        out = np.empty(len(left))
        for i, (a, b) in enumerate(zip(left, right)):
            if a == b:
                out[i] = 1.0
                continue
            if b != seen:
                matcher.set_seq2(b)
                seen = b
            matcher.set_seq1(a)
            out[i] = matcher.ratio()
        yield pd.Series(out)


def length_bound(a: Column, b: Column) -> Column:
    """The ratio never exceeds 2*min/(la+lb)."""
    return 2.0 * F.least(F.length(a), F.length(b)) / F.greatest(F.length(a) + F.length(b), F.lit(1))


def shared_letters_bound(a: Column, b: Column) -> Column:
    """Weaker than a multiset bound but cheap: letters of the shorter side that occur in the other."""
    chars_a = F.regexp_extract_all(a, F.lit("(?s)."), F.lit(0))
    chars_b = F.regexp_extract_all(b, F.lit("(?s)."), F.lit(0))
    in_b = F.size(F.filter(chars_a, lambda c: F.contains(b, c)))
    in_a = F.size(F.filter(chars_b, lambda c: F.contains(a, c)))
    return 2.0 * F.least(in_b, in_a) / F.greatest(F.length(a) + F.length(b), F.lit(1))


def char_counts(texts: list[str]) -> np.ndarray:
    """One row per text, one column per character of the collection."""
    lens = np.array([len(t) for t in texts], dtype=np.int64)
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    chars, column = np.unique(codes, return_inverse=True)
    width = max(len(chars), 1)
    cells = np.repeat(np.arange(len(texts)), lens) * width + column
    return np.bincount(cells, minlength=len(texts) * width).reshape(len(texts), width).astype(np.int32)


def letter_places(text: str) -> dict[str, int]:
    """Per character the bits of its places in ``text``."""
    places: dict[str, int] = {}
    for k, c in enumerate(text):
        places[c] = places.get(c, 0) | 1 << k
    return places


def common_order(text: str, places: dict[str, int], length: int) -> int:
    """Length of the longest common subsequence with the text of ``length`` characters behind ``places``.

    A row of the usual table is one integer: a zero bit is a place where the subsequence grows (Hyyro 2004). What the ratio
    counts is a common subsequence, so twice this over both lengths bounds it, at a small part of the matcher's cost.
    """
    full = row = (1 << length) - 1
    for c in text:
        if c in places:
            met = row & places[c]
            row = (row + met) | (row - met)
    return length - (row & full).bit_count()


def tile_edges(
    texts: list[str],
    first: np.ndarray,
    last: np.ndarray,
    side: np.ndarray,
    threshold: float,
    forest: bool,
    known: np.ndarray | None = None,
) -> list[tuple[int, int]]:
    """Index pairs of similar texts inside one tile.

    ``first``/``last`` are the first and last positions of each text in input order: an earlier
    text is always the left argument, and both orders count when occurrences interleave.
    ``side`` is 0/1 for a tile made of two chunks (only cross pairs are compared), or all 0
    (all pairs). With ``forest`` pairs that are already connected are skipped, which keeps
    the connected components while emitting at most n-1 edges; ``known`` has the components to start from.
    """
    n = len(texts)
    cross = bool(side.any())
    counts = char_counts(texts)
    lengths = counts.sum(axis=1)
    label = np.arange(n) if known is None else known.copy()
    others = np.flatnonzero(side == 0) if cross else None

    edges: list[tuple[int, int]] = []
    for j in np.flatnonzero(side == 1) if cross else range(1, n):
        cand = others if cross else np.arange(j)
        if forest:
            cand = cand[label[cand] != label[j]]
        if not len(cand):
            continue
        overlap = np.minimum(counts[cand], counts[j]).sum(axis=1)
        total = np.maximum(lengths[cand] + lengths[j], 1)
        bound = 2.0 * overlap / total
        close = bound >= threshold - 1e-9
        # likely matches first: one hit removes its whole component from the list
        keep = cand[close][np.argsort(-bound[close], kind="stable")]
        if not len(keep):
            continue
        as_right, places = None, letter_places(texts[j])
        while len(keep):
            i, keep = int(keep[0]), keep[1:]
            if 2.0 * common_order(texts[i], places, len(texts[j])) / max(len(texts[i]) + len(texts[j]), 1) < threshold - 1e-9:
                continue
            if as_right is None:
                as_right = SequenceMatcher(None, "", texts[j])
            hit = False
            if first[i] < last[j]:
                as_right.set_seq1(texts[i])
                hit = as_right.ratio() >= threshold
            if not hit and first[j] < last[i]:
                hit = SequenceMatcher(None, texts[j], texts[i]).ratio() >= threshold
            if hit:
                edges.append((i, int(j)))
                if forest:
                    label[label == label[i]] = label[j]
                    keep = keep[label[keep] != label[j]]
    return edges
