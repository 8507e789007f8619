"""Language identification by a bidirectional gated recurrent network over bytes.

A text's UTF-8 bytes are cut into windows; in each, one network reads forwards and one backwards, and the two states at
a byte give probabilities of its language. A document's probabilities are the means over all of its bytes. The network is
trained in numpy by backpropagation through time on windows of a bounded sample of labelled rows.

Cases: a null text and one without a letter are `und` with score 0; so is everything where nothing could be learnt; rows
without a language are not learnt from; repeated rows are labelled alike; an empty table gives an empty table; other
columns take no part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .quality_model import fold

#: Units in each direction; bytes of a window; the symbol after a text's end.
UNITS, WINDOW, END = 8, 128, 256
#: Distinct texts of the sample for each language and in all, at most (one of each language at least), read whole; bytes of a window
#: to learn from.
SAMPLE_ROWS, SAMPLE_ALL, LEARN = 400, 40_000, 64
#: Languages up to which their counts are broadcast, so that no language's rows meet in one task.
BROADCAST_LANGUAGES = 100_000
#: Windows that a network is trained on, for each language and in all; rounds of training at least, windows of a round, and
#: windows of each language that are seen at least, on average, however many languages there are.
TRAIN, TRAIN_ALL, ROUNDS, BATCH, SEEN = 4000, 400_000, 240, 96, 1200
#: Windows that a worker runs at a time, and probabilities that it holds.
TOGETHER, HELD = 1024, 1 << 23


class Network:
    """Parameters by name; tanh gives both gates: sigmoid(x) is (1 + tanh(x / 2)) / 2 with the half in the weights."""

    def __init__(self, languages: list[str], units: int = UNITS, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.languages, self.units = languages, units
        self.p: dict[str, np.ndarray] = {}
        for d in "fb":
            self.p["E" + d] = rng.normal(0, 0.3, (3 * units, 257)).astype("f4")
            self.p["U" + d] = rng.normal(0, 0.5 / np.sqrt(units), (3 * units, units)).astype("f4")
            self.p["V" + d] = rng.normal(0, 0.3, (len(languages), units)).astype("f4")
        self.p["c"] = np.zeros((len(languages), 1), "f4")

    def states(self, d: str, x: np.ndarray, keep: bool = False):
        """States after each byte of x(steps, windows) in one direction; with keep also what the way back needs."""
        n, (steps, wide) = self.units, x.shape
        e, u = self.p["E" + d], self.p["U" + d]
        h = np.zeros((n, wide), e.dtype)
        out, kept = np.empty((steps, n, wide), e.dtype), []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            a = e.take(x[t], axis=1)
            r = u @ h
            gates = a[: 2 * n]
            gates += r[: 2 * n]
            np.tanh(gates, gates)
            gates += 1
            gates *= 0.5
            reset, update, past = gates[:n], gates[n:], r[2 * n :]
            new = np.tanh(a[2 * n :] + reset * past)
            if keep:
                kept.append((t, h, reset, update, past, new))
            h = new + update * (h - new)
            out[t] = h
        return (out, kept) if keep else out

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """Probabilities (steps, languages, windows) of each byte's language."""
        z = np.matmul(self.p["Vf"], self.states("f", x))
        z += np.matmul(self.p["Vb"], self.states("b", x))
        z += self.p["c"]
        z -= z.max(axis=1, keepdims=True)
        np.exp(z, z)
        z /= z.sum(axis=1, keepdims=True)
        return z

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss over all bytes that are in a text, and its gradient, by backpropagation through time."""
        n, steps = self.units, len(x)
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        (hf, kf), (hb, kb) = self.states("f", x, True), self.states("b", x, True)
        z = np.matmul(self.p["Vf"], hf) + np.matmul(self.p["Vb"], hb) + self.p["c"]
        z -= z.max(axis=1, keepdims=True)
        p = np.exp(z)
        p /= p.sum(axis=1, keepdims=True)
        inside = (x != END).astype(p.dtype)
        total = max(float(inside.sum()), 1.0)
        own = p[np.arange(steps)[:, None], y[None, :], np.arange(x.shape[1])[None, :]]
        loss = float(-(np.log(np.maximum(own, 1e-12)) * inside).sum() / total)
        p[np.arange(steps)[:, None], y[None, :], np.arange(x.shape[1])[None, :]] -= 1
        dz = p * inside[:, None, :] / np.asarray(total, p.dtype)
        g["c"][:, 0] = dz.sum(axis=(0, 2))
        for d, h, kept in (("f", hf, kf), ("b", hb, kb)):
            u, v = self.p["U" + d], self.p["V" + d]
            g["V" + d] += np.einsum("tlw,tnw->ln", dz, h)
            dh = np.zeros_like(h[0])
            for t, h0, reset, update, past, new in reversed(kept):
                dh = dh + v.T @ dz[t]
                dnew = dh * (1 - update) * (1 - new * new)
                dr = np.concatenate([dnew * past * 2 * reset * (1 - reset), dh * (h0 - new) * 2 * update * (1 - update)])
                back = np.concatenate([dr, dnew * reset])  # what reaches U h
                da = np.concatenate([dr, dnew])  # what reaches E x
                g["U" + d] += back @ h0.T
                np.add.at(g["E" + d].T, x[t], da.T)
                dh = dh * update + u.T @ back
        return loss, g

    def train(self, x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, batch: int = BATCH, rate: float = 0.02, seed: int = 9) -> float:
        """Adam over random batches of windows x(windows, steps); the loss of the last ones."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        losses = []
        for i in range(1, rounds + 1):
            pick = rng.integers(0, len(x), batch)
            loss, g = self.gradients(np.ascontiguousarray(x[pick].T).astype(np.int64), y[pick])
            size = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
            now = rate * (1 - 0.9 * i / rounds)
            for k in self.p:
                d = g[k] * min(1.0, 1.0 / max(size, 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * d
                s[k] = 0.99 * s[k] + 0.01 * d * d
                self.p[k] -= now * (m[k] / (1 - 0.9**i)) / (np.sqrt(s[k] / (1 - 0.99**i)) + 1e-7)
            losses.append(loss)
        return float(np.mean(losses[-20:])) if losses else 0.0


def windows(texts: list[bytes], steps: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Symbols (windows, steps) of all texts one after the other, and the number of windows of each text."""
    count = np.array([-(-len(t) // steps) for t in texts], np.int64)
    x = np.full((int(count.sum()), steps), END, np.int16)
    flat, at = x.reshape(-1), 0
    for t, c in zip(texts, count):
        flat[at : at + len(t)] = np.frombuffer(t, np.uint8)
        at += int(c) * steps
    return x, count


def pooled(net: Network, texts: list[bytes]) -> np.ndarray:
    """Mean probabilities (texts, languages) over all bytes of each text; zeros for a text without bytes."""
    x, count = windows(texts)
    sums = np.zeros((len(x), len(net.languages)))
    together = max(1, min(TOGETHER, HELD // (WINDOW * len(net.languages))))
    for at in range(0, len(x), together):
        part = np.ascontiguousarray(x[at : at + together].T)
        inside = part != END
        p = net.probabilities(part)
        if not inside[-1].all():
            p *= inside[:, None, :]
        sums[at : at + together] = p.sum(axis=0).T
    ends = count.cumsum()
    total = np.vstack([np.zeros((1, sums.shape[1])), sums.cumsum(axis=0)])
    mean = total[ends] - total[ends - count]
    return mean / np.maximum([[len(t)] for t in texts], 1)


def learned(docs: DataFrame, rows: int = SAMPLE_ROWS) -> Network | None:
    """A network for all languages of docs, from a bounded sample of up to `rows` distinct texts of each language outside fold 2."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    texts = texts.where(F.col("lang").isNotNull() & (fold(F.col("doc_id")) != 2) & (F.octet_length("text") > 0))
    texts = texts.withColumn("h", F.pmod(F.xxhash64("lang", "text"), F.lit(1 << 40)))
    # copies of a text are one: the distinct ones are counted (to some hundredths), and chosen among
    counts = texts.groupBy(F.col("lang").alias("of")).agg(F.approx_count_distinct("h", 0.02).alias("n"))
    languages = counts.count()
    each = max(1, min(rows, SAMPLE_ALL // max(1, languages)))
    # a part of the hash range that holds some more rows than wanted, and of these exactly the first
    part = texts.select("lang", "h").join(F.broadcast(counts) if languages <= BROADCAST_LANGUAGES else counts, F.col("lang") == F.col("of"))
    part = part.where(F.col("h") < (1 << 40) * ((2.0 * each + 32) / F.col("n"))).select("lang", "h").distinct()
    chosen = part.withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("nth") <= each).drop("nth")

    def cut(of: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in of:
            for i in range(batch.num_rows):
                text, h = batch.column("text")[i].as_py().encode(), batch.column("h")[i].as_py()
                starts = range(0, len(text), LEARN)
                kinds = pa.array([batch.column("lang")[i].as_py()] * len(starts), pa.string())
                yield pa.RecordBatch.from_arrays([kinds, pa.array(places(h, len(starts))), pa.array([text[j : j + LEARN] for j in starts], pa.binary())], ["lang", "place", "bytes"])

    # every window of the chosen rows' whole texts, in an order drawn by hash; the first of each language
    whole = texts.join(F.broadcast(chosen), ["lang", "h"]).select("lang", "h", "text").dropDuplicates(["lang", "h"])
    drawn = whole.mapInArrow(cut, "lang string, place long, bytes binary")
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("place", "bytes"))
    sample = drawn.withColumn("nth", nth).where(F.col("nth") <= max(1, min(TRAIN, TRAIN_ALL // max(1, languages)))).drop("nth")
    sample = sample.toArrow().sort_by([("lang", "ascending"), ("place", "ascending"), ("bytes", "ascending")])
    return fitted([(t.as_py(), v.as_py()) for t, v in zip(sample.column("bytes"), sample.column("lang"))])


def places(h: int, n: int) -> np.ndarray:
    """Places of n windows of a text of hash h among all: 62 bits that look drawn at random."""
    x = np.array([h], np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)
    for shift, odd in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(odd)
    return (x >> np.uint64(2)).astype(np.int64)


def rounds_for(languages: int) -> int:
    return max(ROUNDS, -(-SEEN * languages // BATCH))


def fitted(rows: list[tuple[bytes, str]], rounds: int | None = None) -> Network | None:
    """A network for the languages of rows (text or window of one, language); all windows of longer texts are used."""
    languages = sorted({lang for _, lang in rows})
    if not languages:
        return None
    net, number = Network(languages), {lang: i for i, lang in enumerate(languages)}
    x, count = windows([t for t, _ in rows], LEARN)
    y = np.repeat(np.array([number[lang] for _, lang in rows]), count)
    # languages weigh the same: windows are drawn with repetition from each
    rng = np.random.default_rng(1)
    each = max(1, min(TRAIN, TRAIN_ALL // len(languages)))
    order = np.argsort(y, kind="stable")
    ends = np.searchsorted(y[order], np.arange(len(languages) + 1))
    pick = np.concatenate([rng.choice(order[i:j], each) for i, j in zip(ends[:-1], ends[1:])])
    net.train(x[pick], y[pick], rounds=rounds_for(len(languages)) if rounds is None else rounds)
    return net


def labelled(docs: DataFrame, net: Network | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every whole text of docs(doc_id, text); the network (some kB) is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def batches(of: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for whole in of:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                texts = batch.column("text").to_pylist()
                worth = [net is not None and bool(t) and any(map(str.isalpha, t)) for t in texts]
                lang, score = ["und"] * len(texts), [0.0] * len(texts)
                some = [i for i, w in enumerate(worth) if w]
                if some:
                    p = pooled(net, [texts[i].encode() for i in some])
                    for i, best, row in zip(some, p.argmax(axis=1), p):
                        lang[i], score[i] = net.languages[best], min(1.0, float(row[best]))
                held = [zlib.crc32(str(i if i is not None else "").encode()) % 4 == 2 for i in batch.column("doc_id").to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(held, pa.bool_()), pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(batches, "doc_id long, held_out boolean, lang_pred string, score double")
