"""Periodic runs of words by repeated k-gram masking and Main-Lorentz.

A run is a stretch with smallest period q and at least max(6, 4 q) words. It shares with itself, q words on, at least five
words (the minimum overlap over all q), so each of its k-grams of five words comes again within the stretch, at a distance
of a quarter of its length at most. Words outside such k-grams join no run: k-grams are hashed (a collision only leaves a
word in), each keeps its nearest repetition, and stretches shrink until none changes. Main and Lorentz's halving is then
applied to what survives: at each middle, the periods whose repetition crosses it come from how far the words on both
sides agree; these lengths are taken for all middles of a level at once from ranks of blocks of 1, 2, 4, ... words.

Cases: null and empty texts have no words and no runs; a null identifier leaves a text as it is; ties go to the smallest start,
then period; repeated rows stay repeated; an empty table gives an empty table; other columns take no part. Texts of any
length are one unit of work, of n log^2 n steps in the words that survive.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Least words of a run, and least whole periods of it.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Words of a block of texts that is handled at once; a longer text is a block of its own.
BLOCK_WORDS = 1 << 19


def minimum_overlap(words: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> int:
    """Least words that a run shares with itself one period on: max(words, periods * q) - q over all q."""
    return min(max(words, periods * q) - q for q in range(1, words + 1))


def surviving(words: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First words and ends of the stretches in which runs may lie, of words numbered by what they are and text of each."""
    k = minimum_overlap()
    if len(words) < LEAST_WORDS:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    odd = np.array([0x9E3779B97F4A7C15 * (2 * j + 3) % (1 << 64) | 1 for j in range(k + 1)], np.uint64)
    n = len(words) - k + 1
    start = np.flatnonzero(text[:n] == text[k - 1 :])  # k-grams that lie in one text
    mixed = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    gram = text[:n].astype(np.uint64) * odd[k]
    for j in range(k):
        gram = gram + mixed[j : j + n] * odd[j]
    gram = gram[start]
    while len(start):
        # stretches of starts that follow one another; a k-gram's next repetition must lie within a quarter of the stretch
        fresh = np.append(True, (np.diff(start) > 1) | (text[start[1:]] != text[start[:-1]]))
        stretch = np.cumsum(fresh) - 1
        length = np.bincount(stretch) + k - 1
        order = np.argsort(gram, kind="stable")
        same = (gram[order[1:]] == gram[order[:-1]]) & (stretch[order[1:]] == stretch[order[:-1]])
        gap = np.where(same, start[order[1:]] - start[order[:-1]], 1 << 60)
        nearest = np.full(len(start), 1 << 60, np.int64)
        nearest[order[1:]] = gap
        nearest[order[:-1]] = np.minimum(nearest[order[:-1]], gap)
        keep = (nearest * LEAST_PERIODS <= length[stretch]) & (length[stretch] >= LEAST_WORDS)
        if keep.all():
            first = start[fresh]
            return first, first + length
        start, gram = start[keep], gram[keep]
    return np.zeros(0, np.int64), np.zeros(0, np.int64)


class Agreement:
    """How many words agree from two positions on, forwards and backwards, from exact ranks of blocks of 1, 2, 4, ... words."""

    def __init__(self, words: np.ndarray, longest: int):
        self.ranks = [np.unique(words, return_inverse=True)[1]]
        size = 1
        while size * 2 <= longest:
            now = self.ranks[-1]
            self.ranks.append(np.unique(now[:-size] * (int(now.max()) + 1) + now[size:], return_inverse=True)[1])
            size *= 2
        self.n = len(words)

    def forwards(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that agree from a and from b on (a < b)."""
        out = np.zeros(len(a), np.int64)
        for level in range(len(self.ranks) - 1, -1, -1):
            rank, top = self.ranks[level], len(self.ranks[level]) - 1
            for _ in range(2 if level == len(self.ranks) - 1 else 1):
                fits = b + out <= top
                out += (fits & (rank[np.minimum(a + out, top)] == rank[np.minimum(b + out, top)])).astype(np.int64) << level
        return out

    def backwards(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that agree up to a and up to b, both included (a < b)."""
        out = np.zeros(len(a), np.int64)
        for level in range(len(self.ranks) - 1, -1, -1):
            rank = self.ranks[level]
            for _ in range(2 if level == len(self.ranks) - 1 else 1):
                i, j = a - out - (1 << level) + 1, b - out - (1 << level) + 1
                out += ((i >= 0) & (rank[np.maximum(i, 0)] == rank[np.maximum(j, 0)])).astype(np.int64) << level
        return out


def main_lorentz(words: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Rows (start, end, period) of the runs in stretches of words; no run leaves its stretch."""
    size = end - first
    # the stretches one after another, each followed by a word of its own
    offset = np.cumsum(size + 1) - (size + 1)
    flat = np.zeros(int((size + 1).sum()), np.int64)
    inside = np.arange(len(flat)) - np.repeat(offset, size + 1)
    own = np.repeat(size, size + 1)
    flat[inside < own] = words[(np.repeat(first, size + 1) + inside)[inside < own]]
    flat[inside == own] = -1 - np.arange(len(size))
    agree = Agreement(flat, int(size.max()))
    found = []
    low, high, least, most = offset, offset + size, offset, offset + size  # nodes, and the stretch each is of
    while len(low):
        wide = high - low >= 2
        low, high, least, most = low[wide], high[wide], least[wide], most[wide]
        middle = (low + high) // 2
        longest = np.maximum((most - least) // LEAST_PERIODS, 1)  # no period is longer
        for right in (True, False):
            # each period up to the half's length: two positions that far apart, one of them at the middle
            reach = np.minimum(high - middle if right else middle - low, longest)
            node = np.repeat(np.arange(len(low)), reach)
            period = np.arange(len(node)) - np.repeat(np.cumsum(reach) - reach, reach) + 1
            m = middle[node]
            a, b = (m, m + period) if right else (m - period, m)
            # a run that crosses the middle has two periods on one side of it
            near = (flat[np.minimum(b, len(flat) - 1)] == flat[a]) | (flat[np.maximum(b - 1, 0)] == flat[np.maximum(a - 1, 0)])
            a, b, period = a[near], b[near], period[near]
            after, before = agree.forwards(a, b), agree.backwards(a - 1, b - 1)
            run = after + before + period
            is_run = run >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
            found.append(np.stack([a - before, b + after, period], 1)[is_run])
        low, high, least, most = np.append(low, middle), np.append(middle, high), np.append(least, least), np.append(most, most)
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    runs = runs[np.append(True, (np.diff(runs[:, :2], axis=0) != 0).any(axis=1))] if len(runs) else runs  # the smallest period of each stretch
    which = np.searchsorted(offset, runs[:, 0], side="right") - 1
    runs[:, :2] += (first - offset)[which][:, None]
    return runs


def found_runs(words: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Rows (start, end, period) of all runs of texts that lie one after another, in order of start and period."""
    first, end = surviving(words, text)
    if not len(first):
        return np.zeros((0, 3), np.int64)
    runs = main_lorentz(words, first, end)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def rewritten(n: int, doc_id: int | None) -> tuple[int, int] | None:
    """Where a planted period begins in a text of n words, and the period; None where there is none."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    at = g % n
    return (at, 1 + (n - at) // (3 + g % 8)) if h % 10 == 0 else None


def described(words: list[bytes], runs: np.ndarray, offset: int) -> tuple:
    """n_runs, the best run's columns and the two digests of a text's words."""
    rows = [(s - offset, e - s, q) for s, e, q in runs.tolist()]
    best = (None, None, None, None)
    if rows:
        ratio = (runs[:, 1] - runs[:, 0]) / runs[:, 2]
        close = [rows[i] for i in np.flatnonzero(ratio >= ratio.max() * (1 - 1e-9))]
        s, n, q = min(close, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
        best = (s, n, q, 1000 * n // q)
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, runs[:, 0] + runs[:, 2] - offset, 1)
        np.add.at(change, runs[:, 1] - offset, -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in rows)
    return len(rows), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(words)).hexdigest()


def block_rows(ids: list[int | None], texts: list[list[bytes]], planted: bool) -> list[tuple]:
    """The result's rows of some texts, whose words are searched together."""
    number: dict[bytes, int] = {}
    parts, cuts = [], [0]
    for i, (doc_id, words) in enumerate(zip(ids, texts)):
        cut = rewritten(len(words), doc_id) if planted else None
        if cut:
            at, period = cut
            texts[i] = words = words[:at] + [words[at + j % period] for j in range(len(words) - at)]
        parts.append(np.array([number.setdefault(w, len(number)) for w in words], np.int64))
        cuts.append(cuts[-1] + len(words))
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    runs = found_runs(flat, np.repeat(np.arange(len(texts)), np.diff(cuts)))
    bounds = np.searchsorted(runs[:, 0], cuts)
    return [described(words, runs[a:b], at) for words, a, b, at in zip(texts, bounds[:-1], bounds[1:], cuts)]


def periodic_runs(docs: DataFrame, planted: bool = False) -> DataFrame:
    """doc_id, n_runs, the run of the greatest exponent (start, length, period, exponent_milli) and two digests of each
    document of docs(doc_id, text). With planted, every tenth document (by its identifier's checksum) repeats a part of itself
    first. Rows never move."""
    kinds = [pa.int64()] * 5 + [pa.string()] * 2
    names = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]

    def batches(of: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in of:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            rows, block, size, at = [], [], 0, 0
            for i in range(batch.num_rows):
                block.append((texts[i].as_py() or "").encode().split())
                size += len(block[-1])
                if size >= BLOCK_WORDS or i + 1 == batch.num_rows:
                    rows += block_rows(ids[at : i + 1], block, planted)
                    block, size, at = [], 0, i + 1
            cols = [pa.array([r[j] for r in rows], kind) for j, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *cols], ["doc_id", *names])

    schema = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(batches, schema)
