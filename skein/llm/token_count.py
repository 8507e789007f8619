"""Token counts by heap and linked list: symbols minus merges, and no identifier is ever made.

Cases: null and empty texts have 0 tokens; strings of special tokens inside a text count as one token each, as the
library does by default; repeated rows stay repeated rows; an empty table gives an empty table; a word of any length
costs n log n. Columns of the input other than doc_id and text take no part.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import Splitter

#: Cached pieces of text in a worker, and the longest that is cached: some 150 MB at most.
CACHED, CACHED_CHARS = 600_000, 40
#: White space as Unicode defines it (str.split() also splits at U+001C to U+001F).
BLANK = "\t\n\x0b\x0c\r \x85\xa0  -     　"

#: Lower case of letters that the library knows and Python's Unicode 15.1 does not (fixed values).
LOWER = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
LOWER |= {c: c + 0x20 for c in range(0x10D50, 0x10D66)} | {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable bytes stand for themselves."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class HeapCounter:
    """Counts tokens of a vocabulary of kind BPE with a suffix for word ends, as its json file states it."""

    def __init__(self, spec: str):
        stated = json.loads(spec)
        model = stated["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        pairs = (tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"])
        self.rank = {pair: i for i, pair in enumerate(pairs)}
        self.letters = byte_letters()
        special = [t["content"] for t in stated["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        split = next(p["pattern"]["Regex"] for p in stated["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = Splitter(split.replace(r"\s", BLANK))
        self.blanks = re.compile(f"[{BLANK}]+").split
        self.odd_blanks = re.compile("[\x1c-\x1f]").search
        self.of_word: dict[str, int] = {}
        self.of_chunk: dict[str, int] = {}

    def merged(self, word: str) -> int:
        """Tokens of one word: pop the lowest-rank adjacent pair, join it in the linked list, until none is left."""
        letters = self.letters
        symbols = [letters[b] for b in word.encode("utf-8", "replace")]
        if not symbols:
            return 0
        symbols[-1] += self.suffix
        n = left = len(symbols)
        if n == 1:
            return 1
        rank = self.rank.get
        heap = [(r, i) for i, pair in enumerate(zip(symbols, symbols[1:])) if (r := rank(pair)) is not None]
        if not heap:
            return n
        heapq.heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            r, i = pop(heap)
            j = after[i] if symbols[i] is not None else n
            if j >= n or rank((symbols[i], symbols[j])) != r:
                continue  # one of the two has been merged since
            symbols[i] += symbols[j]
            symbols[j] = None
            left -= 1
            j = after[i] = after[j]
            if j < n:
                before[j] = i
                if (r := rank((symbols[i], symbols[j]))) is not None:
                    push(heap, (r, i))
            h = before[i]
            if h >= 0 and (r := rank((symbols[h], symbols[i]))) is not None:
                push(heap, (r, h))
        return left

    def chunk(self, chunk: str) -> int:
        """Tokens of a run without white space or special tokens."""
        lower = unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()
        if not lower.isascii():
            lower = lower.translate(LOWER)
        total, known = 0, self.of_word
        for word in self.pieces(lower):
            k = known.get(word)
            if k is None:
                k = self.merged(word)
                if len(word) <= CACHED_CHARS:
                    known[word] = k
            total += k
        if len(chunk) <= CACHED_CHARS:
            self.of_chunk[chunk] = total
        return total

    def plain(self, text: str) -> int:
        chunks = self.blanks(text) if self.odd_blanks(text) else text.split()
        known, slow = self.of_chunk, self.chunk
        total = 0
        for chunk in chunks:
            k = known.get(chunk)
            total += slow(chunk) if k is None else k
        if len(known) > CACHED:
            known.clear()
        if len(self.of_word) > CACHED:
            self.of_word.clear()
        return total

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.special is None or "<" not in text:
            return self.plain(text)
        found = self.special.findall(text)
        return len(found) + sum(map(self.plain, self.special.split(text))) if found else self.plain(text)


_counters: dict[str, HeapCounter] = {}


def counter(spec: str) -> HeapCounter:
    key = f"{len(spec)}:{hash(spec)}"
    if key not in _counters:
        _counters.clear()
        _counters[key] = HeapCounter(spec)
    return _counters[key]


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every whole text of docs(doc_id, text).

    The vocabulary (a fixed file of about 2 MB) is read by the driver and broadcast; rows never move.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def batches(of: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(spec.value).count
        for batch in of:
            n = [count(t.as_py()) for t in batch.column("text")]
            tokens = pa.array(n, pa.int64())
            over = pa.array([k > limit for k in n], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), tokens, over], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.selectExpr("cast(doc_id as long) doc_id", "text", "cast(coalesce(octet_length(text), 0) as long) n_bytes")
    return rows.mapInArrow(batches, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
