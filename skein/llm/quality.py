"""Quality classifier: attention-based multiple-instance learning over passages."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace

PASSAGE_WORDS = 48
#: The classifier is fitted on at most so many labelled documents, the first in the order of a hash of their ids, and on
#: at most so many passages of each, evenly spaced. Scores are of all passages of all documents.
FIT_DOCUMENTS, FIT_PASSAGES = 4000, 256
HIDDEN, EPOCHS, RATE, DECAY, SEED = 16, 200, 0.02, 1e-3, 7
#: Character classes: upper, lower, digit, white space, sentence mark, pipe or bullet, other symbol, other.
CLASSES = 8
STATISTICS = CLASSES + 5
#: Hashed words, pairs of words and three characters in a row; each has a learned vector.
WORDS, PAIRS, TRIPLES = 2048, 1024, 1024
BUCKETS, VECTOR, VECTOR_EPOCHS, VECTOR_DECAY = WORDS + PAIRS + TRIPLES, 16, 80, 1e-4
FEATURES = STATISTICS + VECTOR
#: Texts are encoded together up to about so many passages at a time, longer ones in pieces of so many.
PIECE = 480


def _class_table() -> np.ndarray:
    t = np.full(65536, 7, np.uint8)
    for c in range(65536):
        s = chr(c)
        if s.isspace():
            t[c] = 3
        elif s.isupper():
            t[c] = 0
        elif s.isalpha():
            t[c] = 1
        elif s.isdigit():
            t[c] = 2
        elif s in ".,;:'\"()-":
            t[c] = 4
        elif s in "|•·>":
            t[c] = 5
        elif c < 0x2100:
            t[c] = 6
    return t


_TABLE = None
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.cumprod(np.full(64, 0x100000001B3, np.uint64))


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _FACTOR
    return ((h >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)


def _encoded(pieces: list[list[str]], table: np.ndarray | None) -> np.ndarray:
    """Statistics of each passage of the pieces, which are runs of words, and its n-grams: shares by bucket, or with the
    table of vectors their weighted mean.

    A passage's row depends on its own words alone, whatever is encoded beside it.
    """
    global _TABLE
    if _TABLE is None:
        _TABLE = _class_table()
    sizes = np.array([len(p) for p in pieces])
    parts = -(-sizes // PASSAGE_WORDS)
    n = int(parts.sum())
    # each word follows a space; that and the word's characters count for its passage
    codes = np.frombuffer("".join([" " + " ".join(p) for p in pieces]).encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.flatnonzero(codes == 32)
    within = np.arange(len(starts)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    passage = np.repeat(np.cumsum(parts) - parts, sizes) + within // PASSAGE_WORDS
    lengths = np.diff([*starts, len(codes)])
    at = np.repeat(passage, lengths)
    counts = np.bincount(at * CLASSES + _TABLE[np.minimum(codes, 65535)], minlength=n * CLASSES).reshape(n, CLASSES)
    chars, words = counts.sum(axis=1), np.bincount(passage, minlength=n)

    wide = codes.astype(np.uint64)
    place = np.arange(len(codes)) - np.repeat(starts, lengths)
    word = np.add.reduceat((wide + np.uint64(7)) * _POWERS[place & 63], starts)
    beside = passage[1:] == passage[:-1]
    distinct = np.unique(np.stack([passage.astype(np.uint64), word]), axis=1)[0] if len(word) else np.empty(0)
    out = np.empty((n, STATISTICS), np.float32)
    out[:, :CLASSES] = counts / np.maximum(chars, 1)[:, None]
    out[:, CLASSES] = np.bincount(distinct.astype(np.int64), minlength=n) / words
    out[:, CLASSES + 1] = np.bincount(passage[1:][beside & (word[1:] == word[:-1])], minlength=n) / words
    out[:, CLASSES + 2] = np.log1p(words) / 4
    out[:, CLASSES + 3] = np.minimum(chars / words, 30) / 10

    grams = np.zeros((n, BUCKETS if table is None else VECTOR), np.float32)
    pair = word[:-1] * _FACTOR + word[1:]
    triple = (wide[:-2] * np.uint64(0x2545F491) + wide[1:-1]) * np.uint64(0x2545F491) + wide[2:]
    inner = at[:-2] == at[2:]
    for first, buckets, rows, hashed in ((0, WORDS, passage, word), (WORDS, PAIRS, passage[1:][beside], pair[beside]), (WORDS + PAIRS, TRIPLES, at[2:][inner], triple[inner])):
        bucket, many = _bucket(hashed, buckets), np.maximum(np.bincount(rows, minlength=n), 1)[:, None]
        if table is None:
            grams[:, first : first + buckets] = np.bincount(rows * buckets + bucket, minlength=n * buckets).reshape(n, buckets) / many
        elif len(rows):
            begin = np.concatenate([[0], np.flatnonzero(np.diff(rows)) + 1])
            grams[rows[begin]] += np.add.reduceat(table[first + bucket], begin) / many[rows[begin]]
    return np.hstack([out, grams])


def encode(texts: list[str | None], table: np.ndarray | None = None) -> Iterator[np.ndarray]:
    """For each text one row for each run of 48 words (see _encoded). The whole text is covered.

    A blank text is one passage of zeros. Memory is bounded, however long a text is.
    """
    waiting: list[tuple[int, list[str]]] = []
    done: dict[int, list[np.ndarray]] = {}
    total: dict[int, int] = {}

    held = ready = 0

    def flush() -> None:
        nonlocal held
        held = 0
        if waiting:
            rows, at = _encoded([p for _, p in waiting], table), 0
            for i, p in waiting:
                n = -(-len(p) // PASSAGE_WORDS)
                done.setdefault(i, []).append(rows[at : at + n])
                at += n
            waiting.clear()

    def result(i: int) -> np.ndarray:
        if not total[i]:
            return np.zeros((1, STATISTICS + (BUCKETS if table is None else VECTOR)), np.float32)
        out = np.concatenate(done.pop(i)).astype(np.float32)
        out[:, STATISTICS - 1] = np.log1p(total[i]) / 10
        return out

    for i, text in enumerate(texts):
        words = (text or "").split()
        total[i] = len(words)
        for at in range(0, len(words), PIECE * PASSAGE_WORDS):
            waiting.append((i, words[at : at + PIECE * PASSAGE_WORDS]))
            held += -(-len(waiting[-1][1]) // PASSAGE_WORDS)
            if held >= PIECE:
                flush()
        if not waiting:
            while ready <= i:
                yield result(ready)
                ready += 1
    flush()
    while ready < len(texts):
        yield result(ready)
        ready += 1


@dataclass
class Attention:
    """encoder x = statistics and the mean of the n-grams' vectors, h = tanh(x W + b); weights a = softmax over a document's passages of (tanh(h V) * sigmoid(h U)) w;
    score = sigmoid(sum(a h) c + d)."""

    table: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    p: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        p, x = self.p, (x - self.mean) / self.scale
        h = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        s = (t * g) @ p["w"]
        sizes = np.diff([*starts, len(x)])
        e = np.exp(s - np.repeat(np.maximum.reduceat(s, starts), sizes))
        a = e / np.repeat(np.add.reduceat(e, starts), sizes)
        z = np.add.reduceat(a[:, None] * h, starts)
        return {"x": x, "h": h, "t": t, "g": g, "a": a, "z": z, "sizes": sizes, "score": 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -40, 40)))}

    def bags(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        return encode(texts, self.table)

    def score(self, texts: list[str | None]) -> list[float]:
        out: list[float] = []
        for bag in self.bags(texts):
            out.append(float(self.forward(bag.astype(np.float64), np.array([0]))["score"][0]))
        return out


def _adam(p: dict[str, np.ndarray], epochs: int, gradient) -> None:
    m1, m2 = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    for step in range(1, epochs + 1):
        for k, g in gradient(p).items():
            m1[k] = 0.9 * m1[k] + 0.1 * g
            m2[k] = 0.999 * m2[k] + 0.001 * g * g
            p[k] -= RATE * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.999**step)) + 1e-8)


def fit_vectors(shares: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The vectors of the n-gram buckets: those whose weighted mean over a document tells its label."""
    rng = np.random.default_rng(SEED)
    p = {"E": rng.normal(0, 0.1, (BUCKETS, VECTOR)).astype(np.float32), "c": rng.normal(0, 1, VECTOR).astype(np.float32), "d": np.zeros(1, np.float32)}

    def gradient(p):
        z = shares @ p["E"]
        off = ((1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -40, 40))) - y) / len(y)).astype(np.float32)
        return {"E": shares.T @ off[:, None] * p["c"] + VECTOR_DECAY * p["E"], "c": z.T @ off, "d": off.sum(keepdims=True)}

    _adam(p, VECTOR_EPOCHS, gradient)
    return p["E"]


def fit(table: np.ndarray, bags: list[np.ndarray], y: np.ndarray) -> Attention:
    """Adam on the mean cross-entropy of the documents' labels; deterministic."""
    x, starts = np.concatenate(bags).astype(np.float64), np.cumsum([0, *map(len, bags[:-1])])
    rng = np.random.default_rng(SEED)
    draw = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s)
    p = {"W": draw(FEATURES, HIDDEN), "b": np.zeros(HIDDEN), "V": draw(HIDDEN, HIDDEN), "U": draw(HIDDEN, HIDDEN), "w": draw(HIDDEN), "c": draw(HIDDEN), "d": np.zeros(1)}
    net = Attention(table, x.mean(axis=0), x.std(axis=0) + 1e-3, p)

    def gradient(p):
        f = net.forward(x, starts)
        dz_out = (f["score"] - y) / len(y)
        dz = np.repeat(dz_out[:, None] * p["c"], f["sizes"], axis=0)
        da = (dz * f["h"]).sum(axis=1)
        ds = f["a"] * (da - np.repeat(np.add.reduceat(f["a"] * da, starts), f["sizes"]))
        dt, dg = ds[:, None] * p["w"] * f["g"] * (1 - f["t"] ** 2), ds[:, None] * p["w"] * f["t"] * f["g"] * (1 - f["g"])
        dh = (f["a"][:, None] * dz + dt @ p["V"].T + dg @ p["U"].T) * (1 - f["h"] ** 2)
        grad = {"W": f["x"].T @ dh, "b": dh.sum(axis=0), "V": f["h"].T @ dt, "U": f["h"].T @ dg, "w": (f["t"] * f["g"]).T @ ds, "c": f["z"].T @ dz_out, "d": dz_out.sum(keepdims=True)}
        return {k: g + DECAY * p[k] / len(p) if p[k].ndim == 2 else g for k, g in grad.items()}

    _adam(p, EPOCHS, gradient)
    return net


def _shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The n-gram shares of whole documents, in half precision."""
    for b in batches:
        means = [bag[:, STATISTICS:].mean(axis=0).astype(np.float16).tobytes() for bag in encode(b.column("_text").to_pylist())]
        yield pa.RecordBatch.from_arrays([b.column("_id"), b.column("_y"), pa.array(means, pa.binary())], ["_id", "_y", "_rows"])


def _bags(table: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bags = []
            for bag in encode(b.column("_text").to_pylist(), table):
                spaced = np.linspace(0, len(bag) - 1, min(len(bag), FIT_PASSAGES)).round().astype(int)
                bags.append(bag[spaced].tobytes())
            yield pa.RecordBatch.from_arrays([b.column("_id"), b.column("_y"), pa.array(bags, pa.binary())], ["_id", "_y", "_rows"])

    return run


def _scorer(net: Attention):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("_id"), pa.array(net.score(b.column("_text").to_pylist()), pa.float64())], ["_id", "score"])

    return run


def held_out(id_col: str):
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3)) == 1


def _fit_rows(texts: DataFrame, chosen: list[tuple], schema, encoder) -> list:
    """What the encoder makes of the chosen documents, the smallest of those that share an id, in a fixed order.

    Each document is encoded where it lies; only rows of bounded size move.
    """
    kind = texts.schema["_id"].dataType.simpleString()
    ids = F.broadcast(texts.sparkSession.createDataFrame(chosen, schema))  # at most FIT_DOCUMENTS rows
    rows = texts.join(ids, "_id").select("_id", "_y", "_text").mapInArrow(encoder, f"_id {kind}, _y double, _rows binary")
    return rows.groupBy("_id", "_y").agg(F.min("_rows").alias("_rows")).orderBy(F.xxhash64("_id"), "_id").collect()


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Attention | float:
    """Fits on labelled documents that aren't held out, at most FIT_DOCUMENTS of them, and FIT_PASSAGES passages of each.

    Every second one teaches the n-gram vectors, the others the attention: vectors look better than they are on the
    documents that made them. Of several labels of a document the smallest counts. Without labels of both kinds in
    both halves the mean label (0.5 if there is none) is the score of every document.
    """
    y = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("double").alias("_y")).dropna().filter(~held_out("_id")).groupBy("_id").agg(F.min("_y").alias("_y"))
    first = y.orderBy(F.xxhash64("_id"), "_id").limit(2 * FIT_DOCUMENTS)  # some may have no document
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    # at most 2 * FIT_DOCUMENTS rows of 16 bytes are broadcast
    present = texts.select("_id").join(F.broadcast(first), "_id").select("_id", "_y").distinct().orderBy(F.xxhash64("_id"), "_id").limit(FIT_DOCUMENTS)
    chosen = [(r["_id"], r["_y"]) for r in present.collect()]
    one, two = chosen[::2], chosen[1::2]
    if len({y for _, y in one}) < 2 or len({y for _, y in two}) < 2:
        return sum(y for _, y in chosen) / len(chosen) if chosen else 0.5
    got = _fit_rows(texts, one, first.schema, _shares)
    shares = np.array([np.frombuffer(bytes(r["_rows"]), np.float16) for r in got]).astype(np.float32)
    table = fit_vectors(shares, np.array([r["_y"] for r in got], np.float32))
    got = _fit_rows(texts, two, first.schema, _bags(table))
    bags = [np.frombuffer(bytes(r["_rows"]), np.float32).reshape(-1, FEATURES) for r in got]
    return fit(table, bags, np.array([r["_y"] for r in got]))


def score_quality(docs: DataFrame, net: Attention | float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row; a null text scores like an empty one.

    A null id isn't held out. Repeated rows are scored alike. Other columns are never read.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    if isinstance(net, float):
        out = rows.select("_id", F.lit(net).alias("score"))
    else:
        out = rows.mapInArrow(_scorer(net), f"_id {kind}, score double")
    return out.select(F.col("_id").alias(id_col), F.coalesce(held_out("_id"), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(ws: Workspace, docs: DataFrame, labels: DataFrame, text_col: str = "text") -> DataFrame:
    """docs without those that the classifier rejects; ids that are null or repeated are judged by their rows."""
    net = train(docs, labels, text_col=text_col)
    return docs if isinstance(net, float) else docs.mapInArrow(_keeper(net, text_col), docs.schema)


def _keeper(net: Attention, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([s >= 0.5 for s in net.score(b.column(text_col).to_pylist())], pa.bool_()))

    return run
