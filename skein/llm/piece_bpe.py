"""SentencePiece BPE with byte fallback by vectorised merge rounds, and its inverse.

A text becomes a mark, then its characters with blanks as marks. No piece has a mark behind another character, so a text
is a list of segments: marks and what follows up to the next mark. The segments of a block that are new lie in one flat
numpy array of symbols. A round finds each segment's best pair (segmented minimum of ranks), joins all its occurrences at
once, leftmost first, and compacts the array; finished segments leave it, and rounds end when none is left. Where a join
makes a pair that is as good as the one joined, or better, only the segment's leftmost occurrence is joined in that round:
the order of joins is that of the library's queue in every case.

Cases: null and empty texts have no identifiers and decode to nothing; strings of control pieces are ordinary text; a mark
(U+2581) in a text is a blank, as in the library, and decodes to one; repeated rows stay repeated; an empty table gives an
empty table; other columns take no part. A segment of n characters without a blank costs up to n rounds, or one for each
rank that it uses; it is cut first where no piece holds two neighbouring characters.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: The mark that stands for a blank and the replacement of bytes that are no character (fixed values).
MARK, UNREADABLE = "▁", "�"
#: Kinds of a piece in a model file (fixed values).
NORMAL, UNKNOWN, BYTE = 1, 2, 6
#: Cached segments in a worker and the longest that is cached: some 100 MB.
CACHED, CACHED_CHARS = 400_000, 48
#: A block ends with the text that brings it to so many characters.
BLOCK_CHARS = 1 << 20
#: No pair.
NEVER = np.int64(1) << 40


def varint(raw: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        value |= (raw[at] & 127) << shift
        shift += 7
        at += 1
        if raw[at - 1] < 128:
            return value, at


def fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of a message in protocol buffers' wire format."""
    at = 0
    while at < len(raw):
        key, at = varint(raw, at)
        if key & 7 == 0:
            value, at = varint(raw, at)
        else:
            size, at = {1: (8, at), 5: (4, at)}.get(key & 7) or varint(raw, at)
            value, at = raw[at : at + size], at + size
        yield key >> 3, value


def read_model(raw: bytes) -> tuple[list[tuple[str, float, int]], dict[int, int | bytes], dict[int, int | bytes]]:
    """Pieces (text, score, kind), the trainer's and the normalizer's settings of a model file."""
    pieces, settings = [], {2: {}, 3: {}}
    for number, value in fields(raw):
        if number == 1:
            piece = dict(fields(value))
            score = float(np.frombuffer(piece[2], "<f4")[0]) if 2 in piece else 0.0
            pieces.append((piece[1].decode(), score, piece.get(3, NORMAL)))
        elif number in settings:
            settings[number] = dict(fields(value))
    return pieces, settings[2], settings[3]


class PieceCodec:
    def __init__(self, model: bytes):
        pieces, trainer, normalizer = read_model(model)
        plain = normalizer.get(2, b"") == b"" and normalizer.get(3, 1) == 1 and normalizer.get(4, 1) == 0 and normalizer.get(5, 1) == 1
        if trainer.get(3, 1) != 2 or not trainer.get(35, 0) or not plain or {k for _, _, k in pieces} - {1, 2, 3, 6}:
            raise ValueError("a BPE model with byte fallback, a leading mark and no rewriting of characters is asked for")
        normal = {text: i for i, (text, _, kind) in enumerate(pieces) if kind == NORMAL}
        if any(MARK in text.lstrip(MARK) for text in normal):
            raise ValueError("a piece has a mark behind another character")
        self.size = len(pieces)
        self.bytes_of = [b" \xe2\x81\x87 " if kind == UNKNOWN else b"" if kind not in (NORMAL, BYTE) else text.replace(MARK, " ").encode() for text, _, kind in pieces]
        self.is_byte = [kind == BYTE for _, _, kind in pieces]
        self.of_byte = np.zeros(256, np.int64)
        for i, (text, _, kind) in enumerate(pieces):
            if kind == BYTE:
                self.of_byte[int(text[3:5], 16)] = i
                self.bytes_of[i] = bytes([int(text[3:5], 16)])
        self.decimal = [str(i) for i in range(self.size)]
        # symbols: pieces, and behind them characters that occur in pieces only
        symbol = dict(normal)
        for c in sorted({c for text in normal for c in text} - normal.keys()):
            symbol[c] = self.size + len(symbol) - len(normal)
        self.symbols = self.size + len(symbol) - len(normal)
        chars = sorted((ord(text), i) for text, i in symbol.items() if len(text) == 1)
        self.char, self.char_symbol = (np.array(x, np.int64) for x in zip(*chars))
        best_first = sorted({-score for text, score, kind in pieces if kind == NORMAL})
        rank_of = {score: i for i, score in enumerate(best_first)}
        pairs, neighbours = {}, set()
        for text, i in normal.items():
            rank = rank_of[-pieces[i][1]]
            for cut in range(1, len(text)):
                left, right = symbol.get(text[:cut]), symbol.get(text[cut:])
                if left is not None and right is not None:
                    pairs[left * self.symbols + right] = rank << 20 | i
                neighbours.add(ord(text[cut - 1]) << 21 | ord(text[cut]))
        self.pair = np.array(sorted(pairs), np.int64)
        self.pair_value = np.array([pairs[k] for k in self.pair.tolist()], np.int64)
        self.neighbours = np.array(sorted(neighbours), np.int64)
        # pieces of marks alone, where they join last and all at one rank: then runs of marks need no rounds
        blank = {text: pieces[i][1] for text, i in normal.items() if set(text) == {MARK} and len(text) > 1}
        least = min((pieces[i][1] for text, i in normal.items() if set(text) != {MARK} and len(text) > 1), default=0.0)
        last = len(set(blank.values())) <= 1 and all(s < least for s in blank.values())
        self.marks = {n: normal[MARK * n] for n in {1, *map(len, blank)}} if last and MARK in normal else None
        held = {c for text in normal if len(text) > 1 for c in text}
        alone = re.escape("".join(chr(c) for c in range(128) if chr(c) not in held))
        self.split = re.compile(f"{MARK}+[^{MARK}{alone}]*|[{alone}]|[^{MARK}{alone}]+").findall
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def value(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """rank << 20 | piece of each pair of symbols, NEVER where they make none."""
        key = np.where((left < 0) | (right < 0), -1, left * self.symbols + right)
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where(self.pair[at] == key, self.pair_value[at], NEVER)

    def rounds(self, words: list[str]) -> list[bytes]:
        """Identifiers of each word (no marks but one at its start), as little-endian 32-bit integers."""
        flat = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        starts = np.cumsum([0, *map(len, words)])
        if not len(flat):
            return [b""] * len(words)
        at = np.minimum(np.searchsorted(self.char, flat), len(self.char) - 1)
        symbol = np.where(self.char[at] == flat, self.char_symbol[at], -1 - flat)  # a character of no piece: its code point below 0
        # a segment ends with its word and where no piece holds both characters
        both = flat[:-1] << 21 | flat[1:]
        near = np.minimum(np.searchsorted(self.neighbours, both), len(self.neighbours) - 1)
        first = np.append(True, self.neighbours[near] != both)
        first[starts[:-1][np.diff(starts) > 0]] = True
        made = np.full(len(flat), np.iinfo(np.int64).min)
        place = np.arange(len(flat))
        last = np.append(first[1:], True)
        pair = np.where(last, NEVER, self.value(symbol, np.append(symbol[1:], -1)))
        while len(symbol):
            begin = np.flatnonzero(first)
            length = np.diff(np.append(begin, len(symbol)))
            best = np.minimum.reduceat(pair >> 20, begin)
            open_ = np.repeat(best < NEVER >> 20, length)
            made[place[~open_]] = symbol[~open_]
            symbol, place, first, pair = symbol[open_], place[open_], first[open_], pair[open_]
            if not len(symbol):
                break
            ours = np.repeat(best, length)[open_]
            segment = np.cumsum(first) - 1
            hit = pair >> 20 == ours
            # of occurrences that overlap every second one is joined, from the left
            nth = np.arange(len(hit))
            run = np.maximum.accumulate(np.where(hit & ~np.append(False, hit[:-1]), nth, -1))
            join = hit & ((nth - run) % 2 == 0)
            for again in (False, True):
                gone = np.append(False, join[:-1])
                kept = np.flatnonzero(~gone)
                s = np.where(join, pair & 0xFFFFF, symbol)[kept]
                f, p = first[kept], pair[kept].copy()
                new = join[kept]
                ends = np.append(f[1:], True)
                touched = np.flatnonzero((new | np.append(new[1:], False)))
                p[touched] = np.where(ends[touched], NEVER, self.value(s[touched], s[np.minimum(touched + 1, len(s) - 1)]))
                if again:
                    break
                early = segment[kept[touched[p[touched] >> 20 <= ours[kept[touched]]]]]
                # and what a join makes with its right neighbour before that is joined too
                two = np.flatnonzero(join[:-2] & join[2:] & (segment[:-2] == segment[2:]))
                early = np.unique(np.append(early, segment[two[self.value(pair[two] & 0xFFFFF, symbol[two + 2]) >> 20 <= ours[two]]]))
                if not len(early):
                    break
                # there a new pair comes before the other occurrences: the leftmost alone is joined
                stay = join & np.isin(segment, early)
                where = np.flatnonzero(stay)
                leftmost = where[np.append(True, segment[where[1:]] != segment[where[:-1]])] if len(where) else where
                if len(leftmost) == len(where):
                    break
                join = join & ~stay
                join[leftmost] = True
            symbol, place, first, pair = s, place[kept], f, p
        there = np.flatnonzero(made > np.iinfo(np.int64).min)
        ids = made[there]
        count = np.append(0, np.cumsum(np.bincount(there, minlength=len(flat))))
        outside = np.flatnonzero((ids < 0) | (ids >= self.size))
        if len(outside):  # bytes instead
            spread: list[list[int]] = [[i] for i in ids.tolist()]
            sizes = np.ones(len(ids), np.int64)
            for i in outside.tolist():
                spread[i] = self.of_byte[list(chr(flat[there[i]]).encode())].tolist()
                sizes[i] = len(spread[i])
            ids = np.array([x for part in spread for x in part], np.int64)
            count = np.append(0, np.cumsum(sizes))[count]
        whole, cuts = ids.astype("<i4").tobytes(), (count[starts] * 4).tolist()
        return [whole[i:j] for i, j in zip(cuts[:-1], cuts[1:])]

    def learn(self, segments: list[str]) -> list[bytes]:
        if self.marks is None:
            return self.rounds(segments)
        bare = [s.lstrip(MARK) for s in segments]
        blanks = [len(s) - len(b) for s, b in zip(segments, bare)]
        found = self.rounds([MARK + b if n else b for b, n in zip(bare, blanks)])
        one = np.array([self.marks[1]], "<i4").tobytes()
        out = []
        for ids, n in zip(found, blanks):
            if n > 1:
                alone = ids[:4] == one  # the last mark joined nothing
                ids = self.run_of_marks(n if alone else n - 1) + (ids[4:] if alone else ids)
            out.append(ids)
        return out

    def run_of_marks(self, n: int) -> bytes:
        """Identifiers of n marks: of the pairs that make a piece the leftmost is joined, until there is none."""
        done: list[int] = []
        for _ in range(n):
            done.append(1)
            while len(done) > 1 and done[-2] + done[-1] in self.marks:
                done[-2:] = [done[-2] + done[-1]]
        return np.array([self.marks[k] for k in done], "<i4").tobytes()

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Identifiers of each text as little-endian 32-bit integers, block by block."""
        block: list[str] = []
        chars = 0
        for text in texts:
            block.append(text or "")
            chars += len(text or "")
            if chars >= BLOCK_CHARS:
                yield from self.encode_block(block)
                block, chars = [], 0
        yield from self.encode_block(block)

    def encode_block(self, texts: list[str]) -> list[bytes]:
        split = [self.split(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        if len(self.known) > CACHED // 2:  # what the last blocks used is kept, the rest is learnt again if it comes back
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        new = set().union(*split) - known.keys()
        for w in new & older.keys():
            known[w] = older[w]
        new = list(new - older.keys())
        known.update(zip(new, self.learn(new)))
        out = [b"".join([known[w] for w in words]) for words in split]
        for w in new:
            if len(w) > CACHED_CHARS:
                del known[w]
        return out

    def decode(self, ids: list[int]) -> bytes:
        """The text of the identifiers in UTF-8: one leading blank goes, bytes that make no character are marked one by one."""
        bytes_of = self.bytes_of
        start = 0
        while start < len(ids) and not bytes_of[ids[start]]:
            start += 1
        whole = b"".join([bytes_of[i] for i in ids])
        if start < len(ids) and not self.is_byte[ids[start]] and whole[:1] == b" " and bytes_of[ids[start]] != b" \xe2\x81\x87 ":
            whole = whole[1:]
        try:
            whole.decode()
            return whole
        except UnicodeDecodeError:
            text = whole.decode("utf-8", "surrogateescape")  # each byte that is part of no character becomes one of U+DC80 to U+DCFF
            return re.sub("[\udc80-\udcff]", UNREADABLE, text).encode()


_codecs: dict[tuple, PieceCodec] = {}


def codec(model: bytes) -> PieceCodec:
    key = (len(model), hash(model))
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = PieceCodec(model)
    return _codecs[key]


def encode_decode(docs: DataFrame, model_path: str, keep_ids: bool = False) -> DataFrame:
    """Encodes every whole text of docs(doc_id, text) and decodes the identifiers again.

    doc_id, n_tokens, ids_sha256, decoded_sha256; with keep_ids also ids (array of int) and decoded (string). The model
    file (fixed, under 1 MB) is read by the driver and broadcast; rows never move.
    """
    with open(model_path, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids", "decoded"] * keep_ids

    def batches(of: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model.value)
        for whole in of:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                n, sha, back, kept, plain = [], [], [], [], []
                for raw in c.encode_all(batch.column("text").to_pylist()):
                    ids = np.frombuffer(raw, "<i4").tolist()
                    decoded = c.decode(ids)
                    n.append(len(ids))
                    sha.append(hashlib.sha256(",".join([c.decimal[i] for i in ids]).encode()).hexdigest())
                    back.append(hashlib.sha256(decoded).hexdigest())
                    if keep_ids:
                        kept.append(np.array(ids, "i4"))
                        plain.append(decoded.decode())
                cols = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array(back, pa.string())]
                if keep_ids:
                    cols += [pa.array(kept, pa.list_(pa.int32())), pa.array(plain, pa.string())]
                yield pa.RecordBatch.from_arrays(cols, names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * keep_ids
    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(batches, schema)
