"""Byte-level BPE by merge replay over a block of the corpus, and its inverse.

The distinct pre-tokens of a block of texts form one array of symbols. An inverted index from token pair to positions
says where each merge applies; merges are replayed in rank order over all words at once, and each touches only the
neighbours of the positions it joins. The identifiers of a pre-token depend on nothing but itself, so blocks (Arrow
batches of a task) need not meet, no word table of the whole corpus is shuffled, and what a block has learnt is kept.

Cases: null and empty texts have no identifiers and decode to nothing; strings of special tokens are ordinary text;
repeated rows stay repeated; an empty table gives an empty table; other columns take no part.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import Splitter

#: Cached pre-tokens in a worker and the longest that is cached: some 100 MB.
CACHED, CACHED_CHARS = 400_000, 48
#: A block ends with the text that brings it to so many characters.
BLOCK_CHARS = 1 << 20
#: New pre-tokens whose merges are replayed together: as many as stay in a processor's cache.
TOGETHER = 1600


class ReplayCodec:
    def __init__(self, ranks_file: bytes, pattern: str):
        self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks_file.splitlines() if line)}
        self.bytes_of = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token
        self.of_byte = [self.ranks[bytes([b])] for b in range(256)]
        # \s of the regex module also has U+001C to U+001F, which are not white space in Unicode's sense
        blank = r"\t\n\x0b\x0c\r \x85\xa0  -     　"
        own = pattern.replace(r"[^\s", f"[^{blank}").replace(r"\s", f"[{blank}]").replace(r"\S", f"[^{blank}]")
        self.split = Splitter(own)
        # by the left token: the rank of what it and each right token make together; some 20 MB
        self.rights: list[dict[int, int] | None] = [None] * len(self.bytes_of)
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                left, right = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if left is not None and right is not None:
                    self.rights[left] = self.rights[left] or {}
                    self.rights[left][right] = rank
        none: dict[int, int] = {}
        self.rights = [none if d is None else d for d in self.rights]
        self.of_bytes = np.array([[self.rights[a].get(b, -1) for b in self.of_byte] for a in self.of_byte], np.int64).ravel()
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def replay(self, words: list[bytes]) -> list[bytes]:
        """Identifiers of each word, every merge applied to all words at once, in order of rank."""
        if not words:
            return []
        rights = self.rights
        flat = np.frombuffer(b"\0".join(words) + b"\0", np.uint8)
        starts = np.cumsum([0, *[len(w) + 1 for w in words]])
        ids = np.array(self.of_byte, np.int64)[flat]
        ids[starts[1:] - 1] = -1  # no pair crosses a word's end
        symbol = ids.tolist()
        after, before = list(range(1, len(symbol) + 1)), list(range(-1, len(symbol) - 1))
        # what the pair at each position makes, and the inverted index: positions by that rank
        made = np.append(self.of_bytes[flat[:-1].astype(np.int64) << 8 | flat[1:]], -1)
        made[(ids < 0) | np.append(ids[1:] < 0, True)] = -1
        at = np.flatnonzero(made >= 0)
        at = at[np.argsort(made[at], kind="stable")]
        first = np.flatnonzero(np.diff(made[at], prepend=-1))
        where = {int(made[at[i]]): part.tolist() for i, part in zip(first, np.split(at, first[1:]))} if len(at) else {}
        makes = made.tolist()
        order = list(where)
        heapq.heapify(order)
        pop, push, listed = heapq.heappop, heapq.heappush, where.get
        while order:
            r = pop(order)
            here = where.pop(r)
            if len(here) > 1:
                here.sort()
            of_r = rights[r].get
            for i in here:
                if makes[i] != r:
                    continue  # one of the two went into another merge
                j = after[i]
                symbol[i] = r
                symbol[j] = makes[j] = -2
                j = after[i] = after[j]
                before[j] = i
                b = symbol[j]
                new = of_r(b, -1) if b >= 0 else -1
                makes[i] = new
                if new >= 0:
                    found = listed(new)
                    if found is None:
                        where[new] = [i]
                        push(order, new)
                    else:
                        found.append(i)
                h = before[i]
                if h >= 0 and (a := symbol[h]) >= 0:
                    new = rights[a].get(r, -1)
                    makes[h] = new
                    if new >= 0:
                        found = listed(new)
                        if found is None:
                            where[new] = [h]
                            push(order, new)
                        else:
                            found.append(h)
        left = np.array(symbol, np.int64)
        kept = left >= 0
        count = np.concatenate([[0], np.cumsum(kept)])[starts] * 4
        whole = left[kept].astype("<u4").tobytes()
        return [whole[i:j] for i, j in zip(count[:-1].tolist(), count[1:].tolist())]

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Identifiers of each text as little-endian unsigned 32-bit integers, block by block."""
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
        split = [self.split(text) for text in texts]
        if len(self.known) > CACHED // 2:  # what the last blocks used is kept, the rest is learnt again if it comes back
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        new = set().union(*split) - known.keys()
        for w in new & older.keys():
            known[w] = older[w]
        new = sorted(new - older.keys())
        for i in range(0, len(new), TOGETHER):
            some = new[i : i + TOGETHER]
            known.update(zip(some, self.replay([w.encode() for w in some])))
        out = [b"".join([known[w] for w in words]) for words in split]
        for w in new:
            if len(w) > CACHED_CHARS:
                del known[w]
        return out

    def decode(self, ids: bytes) -> bytes:
        bytes_of = self.bytes_of
        return b"".join([bytes_of[i] for i in np.frombuffer(ids, "<u4").tolist()])


_codecs: dict[tuple, ReplayCodec] = {}


def codec(ranks_file: bytes, pattern: str) -> ReplayCodec:
    key = (len(ranks_file), hash(ranks_file), pattern)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = ReplayCodec(ranks_file, pattern)
    return _codecs[key]


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, keep_ids: bool = False) -> DataFrame:
    """Encodes every whole text of docs(doc_id, text) and decodes the identifiers again.

    doc_id, n_tokens, ids_sha256, decoded_sha256; with keep_ids also ids (array of int) and decoded (string). The rank
    file (fixed, under 1 MB) is read by the driver and broadcast; rows never move.
    """
    with open(ranks_path, "rb") as f:
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids", "decoded"] * keep_ids

    def batches(of: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks.value, pattern)
        for whole in of:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                texts = batch.column("text").to_pylist()
                n, sha, back, kept, plain = [], [], [], [], []
                for ids in c.encode_all(texts):
                    decoded = c.decode(ids)
                    n.append(len(ids) // 4)
                    sha.append(hashlib.sha256(ids).hexdigest())
                    back.append(hashlib.sha256(decoded).hexdigest())
                    if keep_ids:
                        kept.append(np.frombuffer(ids, "<u4").astype("i4"))
                        plain.append(decoded.decode("utf-8", "replace"))
                cols = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array(back, pa.string())]
                if keep_ids:
                    cols += [pa.array(kept, pa.list_(pa.int32())), pa.array(plain, pa.string())]
                yield pa.RecordBatch.from_arrays(cols, names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * keep_ids
    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(batches, schema)
