"""Language identification with a byte convolutional network.

The network reads fixed-length windows of UTF-8 bytes. Filters of several
widths slide over the bytes (one weight per byte value, place and filter), the
largest response of each filter over the window is kept, and a softmax over
these features gives the languages. It is trained in numpy by gradient descent
(Adam) on a bounded sample of labelled texts; the filter ``drop_unknown`` refines
it on every window of all of them, shard by shard. Prediction tiles every text whole
into overlapping windows and averages the window probabilities by bytes.

Defined cases: a null text or one without a letter is ``und`` with score 0;
texts shorter than a window are padded with zero bytes; an empty training
sample gives a model without languages, for which every text is ``und``; ties go
to the first language in sorted order; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Collection, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siglake.llm.common import (chunked, has_letter, hash_threshold, staged, string_buffers, text_hash, value_at,
                                without)

WIDTHS = (2, 3, 4)
FILTERS = 16            # per width
POSITIONS = 512         # filter positions of a window
WINDOW = POSITIONS + max(WIDTHS) - 1
STEP = 16                # windows worked on at once: their responses stay in cache
PER_LANGUAGE = 400      # bound on sampled texts of each language
WINDOWS_PER_TEXT = 4    # bound on training windows of each sampled text
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}").search


@dataclass
class ByteConvNet:
    labels: list[str]
    taps: dict[int, np.ndarray]     # width -> (width, 256, FILTERS)
    dense: np.ndarray               # (features, labels)
    bias: np.ndarray

    # -- training ---------------------------------------------------------
    def _responses(self, x: np.ndarray, w: int) -> np.ndarray:
        taps = self.taps[w]
        out = taps[0].take(x[:, :POSITIONS], axis=0)
        for k in range(1, w):
            out += taps[k].take(x[:, k:k + POSITIONS], axis=0)
        return out

    def params(self) -> list[np.ndarray]:
        return [*self.taps.values(), self.dense, self.bias]

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 5, rate: float = 0.02, batch: int = 64,
            seed: int = 7, moments: dict | None = None) -> "ByteConvNet":
        """Adam over the windows ``x``; ``moments`` carries its state from one call to the next."""
        rng = np.random.default_rng(seed)
        params = self.params()
        state = {} if moments is None else moments
        if not state:
            state.update(m=[np.zeros_like(p) for p in params], v=[np.zeros_like(p) for p in params], step=0)
        m, v, step = state["m"], state["v"], state["step"]
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), batch):
                rows = order[at:at + batch]
                xb, yb = x[rows], y[rows]
                places, feats = {}, []
                for w in WIDTHS:
                    r = self._responses(xb, w)
                    places[w] = r.argmax(1)                                   # (rows, FILTERS)
                    feats.append(np.take_along_axis(r, places[w][:, None], 1)[:, 0])
                f = np.concatenate(feats, 1)
                act = np.maximum(f, 0)
                logits = act @ self.dense + self.bias
                p = np.exp(logits - logits.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                p[np.arange(len(yb)), yb] -= 1
                p /= len(yb)
                grad_f = (p @ self.dense.T) * (f > 0)
                grads = []
                for i, w in enumerate(WIDTHS):
                    g = np.zeros_like(self.taps[w])
                    gf = grad_f[:, i * FILTERS:(i + 1) * FILTERS]
                    cols = np.broadcast_to(np.arange(FILTERS), gf.shape)
                    for k in range(w):
                        np.add.at(g[k], (np.take_along_axis(xb, places[w] + k, 1), cols), gf)
                    grads.append(g)
                grads += [act.T @ p, p.sum(0)]
                step += 1
                for q, g, a, b in zip(params, grads, m, v):
                    a += 0.1 * (g - a)
                    b += 0.001 * (g * g - b)
                    q -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
        state["step"] = step
        return self

    # -- prediction -------------------------------------------------------
    def pair_tables(self) -> dict[tuple[int, int], np.ndarray]:
        """Responses to each pair of neighbouring bytes, so that a position takes one or two look-ups."""
        out = {}
        for w in WIDTHS:
            t = self.taps[w].astype(np.float32)
            for k in range(0, w - 1, 2):
                out[w, k] = np.ascontiguousarray((t[k][:, None] + t[k + 1][None, :]).reshape(65536, FILTERS))
            if w % 2:
                out[w, w - 1] = t[w - 1]
        return out

    def probabilities(self, x: np.ndarray, tables: dict) -> np.ndarray:
        """Class probabilities of each window; ``x`` is (windows, WINDOW) of bytes."""
        pair = x[:, :-1].astype(np.int32) * 256 + x[:, 1:]
        feats = []
        for w in WIDTHS:
            r = None
            for k in range(0, w, 2):
                part = (tables[w, k].take(pair[:, k:k + POSITIONS], axis=0) if k + 1 < w
                        else tables[w, k].take(x[:, k:k + POSITIONS], axis=0))
                r = part if r is None else np.add(r, part, out=r)
            n = POSITIONS
            while n > 1:                      # pairwise halves: long contiguous maxima
                n //= 2
                r = np.maximum(r[:, :n], r[:, n:2 * n])
            feats.append(r[:, 0])
        logits = np.maximum(np.concatenate(feats, 1), 0) @ self.dense + self.bias
        p = np.exp(logits - logits.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)


def _lettered(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Rows that hold a letter of any script; most show an ASCII one."""
    plain = np.zeros(256, bool)
    plain[65:91] = plain[97:123] = True
    seen = np.concatenate([[0], np.cumsum(plain[data])])
    out = np.diff(seen[off]) > 0
    for i in np.flatnonzero(~out).tolist():
        out[i] = _LETTER(data[off[i]:off[i + 1]].tobytes().decode()) is not None
    return out


def _tile(off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows covering every row whole: (row, first byte, end byte of the row)."""
    size = np.diff(off)
    n = np.maximum(1, -(-np.maximum(size - (WINDOW - POSITIONS), 1) // POSITIONS))
    row = np.repeat(np.arange(len(size)), n)
    rank = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    return row, off[:-1][row] + rank * POSITIONS, off[1:][row]


def _cut(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    at = start[:, None] + np.arange(WINDOW)
    inside = at < end[:, None]
    if not len(data):
        return np.zeros(at.shape, np.uint8)
    return np.where(inside, data[np.minimum(at, len(data) - 1)], 0).astype(np.uint8)


def training_windows(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
                     per_label: int = PER_LANGUAGE) -> list[tuple[str, bytes]]:
    """Windows of at most ``per_label`` texts of each label, chosen by a hash of the id over the whole table."""
    rows = labelled.select(F.xxhash64(F.col(id_col)).alias("h"), F.col(text_col).alias("text"),
                           F.col(label_col).cast("string").alias("label")).where("text is not null and label is not null")
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if not counts:
        return []
    # a hash threshold per label, a little above the bound so that few texts travel
    least = F.lit(None).cast("bigint")
    for label, n in counts.items():
        least = F.when(F.col("label") == label, F.lit(hash_threshold(per_label, n))).otherwise(least)
    chosen = rows.where(F.col("h") <= least)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunked(batches, 1 << 20):
            data, off = string_buffers(b.column(1))
            row, start, end = _tile(off)
            hashes, labels = b.column(0).to_pylist(), b.column(2).to_pylist()
            by_row = np.searchsorted(row, np.arange(len(hashes) + 1))
            take = []
            for i, h in enumerate(hashes):
                lo, hi = by_row[i], by_row[i + 1]
                picks = sorted({lo + zlib.crc32(f"{h} {j}".encode()) % (hi - lo) for j in range(WINDOWS_PER_TEXT)})
                take += picks
            take = np.array(take, np.int64)
            x = _cut(data, start[take], end[take])
            yield pa.RecordBatch.from_arrays(
                [pa.array([hashes[row[t]] for t in take], pa.int64()), pa.array([labels[row[t]] for t in take]),
                 pa.array([r.tobytes() for r in x], pa.binary())], names=["h", "label", "window"])

    got = sorted((r["label"], r["h"], bytes(r["window"]))
                 for r in chosen.mapInArrow(cut, "h bigint, label string, window binary").collect())
    out, texts = [], {}
    for label, h, window in got:
        seen = texts.setdefault(label, set())
        if h in seen or len(seen) < per_label:
            seen.add(h)
            out.append((label, window))
    return out


#: First and last letters of scripts that noise is drawn from where no training text uses them.
SCRIPTS = ((0x391, 0x3C9), (0x410, 0x44F), (0x5D0, 0x5EA), (0x627, 0x64A), (0x905, 0x939), (0xE01, 0xE2E),
           (0x3041, 0x3096), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3))


def noise_windows(count: int, free: list[tuple[int, int]], rng: np.random.Generator) -> list[bytes]:
    """Windows of no language: random ASCII, and letters of the scripts ``free`` that no training text uses."""
    out = []
    for i in range(count):
        if i % 2 == 0 or not free:
            points = rng.integers(33, 127, WINDOW)
            points[rng.random(WINDOW) < rng.uniform(0, 0.3)] = 32
            raw = bytes(points.tolist())
        else:
            a, b = free[int(rng.integers(len(free)))]
            points = rng.integers(a, b + 1, WINDOW)
            points[rng.random(WINDOW) < 0.15] = 32
            raw = "".join(map(chr, points.tolist())).encode()[:WINDOW]
        out.append(raw.ljust(WINDOW, b"\0"))
    return out


def _with_short(x: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Half of the windows also appear cut short, as short texts do."""
    short = rng.permutation(len(x))[: len(x) // 2]
    cut = x[short].copy()
    for r, n in zip(cut, np.exp(rng.uniform(np.log(12), np.log(WINDOW), len(cut))).astype(int)):
        r[n:] = 0
    return np.concatenate([x, cut]), np.concatenate([y, y[short]])


def _fitted(windows: list[tuple[str, bytes]], labels: list[str], seed: int) -> ByteConvNet:
    rng = np.random.default_rng(seed)
    net = ByteConvNet(labels, {w: rng.normal(0, 0.1, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS},
                      rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(labels))).astype(np.float32),
                      np.zeros(len(labels), np.float32))
    if not windows:
        return net
    x = np.frombuffer(b"".join(w for _, w in windows), np.uint8).reshape(-1, WINDOW).copy()
    y = np.array([labels.index(label) for label, _ in windows])
    return net.fit(*_with_short(x, y, rng))


def train(labelled: DataFrame, seed: int = 7, **sample) -> ByteConvNet:
    """Fit the network on a bounded sample of ``labelled`` (doc_id, text, lang)."""
    windows = training_windows(labelled, **sample)
    return _fitted(windows, sorted({label for label, _ in windows}), seed)


#: Text bytes of a shard, the part of the training texts that one task learns from, and the windows it cuts at once.
SHARD_BYTES = 8 << 20
CUT = 512
BLOCK = 128             # parameters that are averaged together


def _scripts_of(data: np.ndarray) -> int:
    """Bits of the SCRIPTS that have letters in the UTF-8 bytes."""
    bits = 0
    if (data > 127).any():
        points = np.frombuffer(data.tobytes().decode(errors="ignore").encode("utf-32-le"), np.uint32)
        points = points[points > 127]
        for i, (a, b) in enumerate(SCRIPTS):
            bits |= int(((points >= a) & (points <= b)).any()) << i
    return bits


def train_whole(labelled: DataFrame, seed: int = 7) -> ByteConvNet:
    """Fit the network, with a class UNKNOWN for noise, on every window of every text of ``labelled``.

    It starts from a fit on a bounded sample. Then the texts are dealt over shards by a hash of
    id and text, each shard refines the start on all its windows, and the mean of the shards'
    parameters, weighted by their windows, is the network. Languages and scripts come from all texts too.
    """
    rows = labelled.select(F.xxhash64("doc_id", "text").alias("h"), "text", F.col("lang").cast("string").alias("label")
                           ).where("text is not null and label is not null")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunked(batches, 1 << 20):
            data, _ = string_buffers(b.column(0))
            labels = b.column(1).unique()
            yield pa.RecordBatch.from_arrays(
                [labels, pa.array([_scripts_of(data)] * len(labels), pa.int64()),
                 pa.array([len(data) * (not i) for i in range(len(labels))], pa.int64())], names=["label", "scripts", "size"])

    found = (rows.select("text", "label").mapInArrow(scan, "label string, scripts bigint, size bigint").groupBy("label")
             .agg(F.bit_or("scripts").alias("scripts"), F.sum("size").alias("size")).collect())
    if not found:
        return _fitted([], [], seed)
    languages = {r["label"] for r in found}
    used = 0
    for r in found:
        used |= r["scripts"]
    free = [s for i, s in enumerate(SCRIPTS) if not used >> i & 1]
    windows = training_windows(labelled)
    noise = noise_windows(max(1, len(windows) // len(languages)), free, np.random.default_rng(seed + 1))
    start = _fitted(windows + [(UNKNOWN, w) for w in noise], sorted(languages | {UNKNOWN}), seed)
    shards = -(-sum(r["size"] for r in found) // SHARD_BYTES) or 1
    dealt = rows.repartition(shards, "h").sortWithinPartitions("h", "label")
    return _refined(dealt, start, free, len(languages), seed)


def _refined(dealt: DataFrame, start: ByteConvNet, free: list[tuple[int, int]], languages: int, seed: int) -> ByteConvNet:
    """``start`` after a pass over all windows of ``dealt`` (h, text, label), averaged over its partitions."""
    place = {label: i for i, label in enumerate(start.labels)}

    def refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, seen, moments = TaskContext.get().partitionId(), 0, {}
        rng = np.random.default_rng([seed, shard])
        net = ByteConvNet(start.labels, {w: t.copy() for w, t in start.taps.items()}, start.dense.copy(), start.bias.copy())
        for b in batches:
            data, off = string_buffers(b.column(1))
            row, first, end = _tile(off)
            y = np.array([place[label] for label in b.column(2).to_pylist()], np.int64)[row]
            order = rng.permutation(len(row))
            for at in range(0, len(order), CUT):
                s = order[at:at + CUT]
                x = _cut(data, first[s], end[s])
                noise = noise_windows(-(-len(s) // languages), free, rng)
                x = np.concatenate([x, np.frombuffer(b"".join(noise), np.uint8).reshape(-1, WINDOW)])
                x, at_y = _with_short(x, np.concatenate([y[s], np.full(len(noise), place[UNKNOWN])]), rng)
                net.fit(x, at_y, epochs=1, seed=int(rng.integers(1 << 31)), moments=moments)
                seen += len(s)
        if seen:
            flat = np.concatenate([p.ravel() for p in net.params()]).astype(np.float32)
            blocks = [flat[i:i + BLOCK].tobytes() for i in range(0, len(flat), BLOCK)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(blocks)), pa.int32()), pa.array([shard] * len(blocks), pa.int32()),
                 pa.array([seen] * len(blocks), pa.int64()), pa.array(blocks, pa.binary())],
                names=["block", "shard", "windows", "part"])

    def mean(table: pa.Table) -> pa.Table:
        order = table["shard"].to_numpy().argsort()
        parts = np.stack([np.frombuffer(p, np.float32) for p in table["part"].to_pylist()])[order]
        weights = table["windows"].to_numpy()[order]
        part = np.average(parts.astype(np.float64), axis=0, weights=weights).astype(np.float32)
        return pa.table({"block": table["block"][:1], "windows": pa.array([int(weights.sum())], pa.int64()),
                         "part": pa.array([part.tobytes()], pa.binary())})

    refined = dealt.mapInArrow(refine, "block int, shard int, windows bigint, part binary")
    blocks = (refined.groupBy("block").applyInArrow(mean, "block int, windows bigint, part binary")
              .orderBy("block").collect())
    flat = np.frombuffer(b"".join(bytes(r["part"]) for r in blocks), np.float32)
    shapes, at, parts = [p.shape for p in start.params()], 0, []
    for shape in shapes:
        n = int(np.prod(shape))
        parts.append(flat[at:at + n].reshape(shape).copy())
        at += n
    return ByteConvNet(start.labels, dict(zip(WIDTHS, parts)), parts[-2], parts[-1])


def predict(docs: DataFrame, net: ByteConvNet, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every row of ``docs``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = net.pair_tables()
        for b in chunked(batches, 1 << 20):
            data, off = string_buffers(b.column(1))
            letters = _lettered(data, off)
            total = np.zeros((b.num_rows, max(1, len(net.labels))))
            if net.labels:
                row, start, end = _tile(off)
                weight = np.minimum(end - start, WINDOW).clip(1)
                for at in range(0, len(row), STEP):
                    s = slice(at, at + STEP)
                    p = net.probabilities(_cut(data, start[s], end[s]), tables)
                    np.add.at(total, row[s], p * weight[s, None])
            total /= np.maximum(total.sum(1, keepdims=True), 1e-9)
            known = letters & bool(net.labels)
            best = total.argmax(1)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([net.labels[i] if k else UNKNOWN for i, k in zip(best, known)], pa.string()),
                 pa.array(np.where(known, np.minimum(total.max(1), 1.0), 0.0))], names=["doc_id", "lang_pred", "score"])

    return rows.mapInArrow(apply, f"doc_id {id_type}, lang_pred string, score double")


def held_out(id_col: str = "doc_id"):
    """Rows kept apart from training: crc32 of the id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def label_languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score; trained on the rows that are not held out and have a language."""
    net = train(docs.where(~held_out() & F.col("lang").isNotNull()))
    return predict(docs, net).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


#: Least score that the filter ever asks for; a guess between four languages alone scores 0.25.
LEAST_SCORE = 0.3
LOST = 0.001             # share of the held-out texts recognised rightly that the threshold may lose
NOISE_SCORE = 0.9        # score from which a text recognised as noise goes


def least_score(scored: DataFrame, lost: float = LOST) -> float:
    """The ``lost`` quantile of the scores of all held-out texts recognised rightly, LEAST_SCORE at least.

    ``scored`` is staged and holds ``known``, the language of a held-out text (null for other rows),
    ``lang_pred`` and ``score``. Too few texts to tell that share give LEAST_SCORE.
    """
    right = scored.where(F.col("known") == F.col("lang_pred"))
    n = right.count()
    if n * lost < 1:
        return LEAST_SCORE
    place = (n - 1) * lost
    low = value_at(right, "score", int(place))
    high = value_at(right, "score", min(int(place) + 1, n - 1))
    return max(LEAST_SCORE, low + (high - low) * (place - int(place)))


def drop_unknown(docs: DataFrame, least: float | None = None, languages: Collection[str] | None = None) -> DataFrame:
    """``docs`` without those of no known language, or of none of ``languages``; all columns stay.

    A text goes if it has no letter, is recognised as noise with a score of
    NOISE_SCORE (the network of this filter has a class for it) or as a language with
    one below ``least``, which is ``least_score`` unless given. Learns from all documents given that have a language
    and are not held out (``train_whole``); if there are none, nothing is known and only texts without a letter go.
    Rows are told apart by id and text; the verdict is the same for those that repeat both.
    """
    net = train_whole(docs.where(~held_out() & F.col("lang").isNotNull()))
    if not net.labels:
        return docs.where(has_letter(F.col("text")))
    known = F.when(held_out() & F.col("text").isNotNull(), F.col("lang").cast("string"))
    keyed = docs.select(F.struct("doc_id", text_hash("text").alias("h"), known.alias("known")).alias("doc_id"), "text")
    verdict = staged(predict(keyed, net).select("doc_id.*", "lang_pred", "score"), "languages")
    least = least_score(verdict) if least is None else least
    noise, score = F.col("lang_pred") == UNKNOWN, F.col("score")
    bad = (noise & ((score == 0) | (score >= NOISE_SCORE))) | (~noise & (score < least))
    if languages is not None:
        bad = bad | ~F.col("lang_pred").isin(list(languages))
    return without(docs, staged(verdict.where(bad).select("doc_id", "h").distinct(), "unknown"))
