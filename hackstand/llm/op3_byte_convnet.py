"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded; beside them stands one input that tells whether the last four bytes stood a few bytes earlier. Filters
of eight bytes slide over the whole text in steps of four; their activations are averaged over overlapping chunks of 256
bytes; learned chunk filters follow, are max-pooled over all chunks of the document, and one logistic unit combines them.
Training is Adam on a bounded sample of labelled rows on the driver; the weights (under 50 kB) go to the workers.

* Null or empty text: one chunk of padding is scored like any other.
* Label 1 is good. Rows with a null id or label are not learned from; of several labels for one id the smallest counts.
* No labelled row, or one class only: every score is the share of good labels (0.5 without labels).
* Repeated rows and ids: each row gets its score. A null id counts as not held out. An empty table gives an empty table.
* Other columns are not carried by ``score``; ``keep_good`` keeps all columns.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hackstand.llm.common import crc_fold, forget, narrow, small_batches, text_slices
from hackstand.llm.words import raw_bytes

#: Labelled rows and bytes that training takes at most, in the order of a hash of the id, half of each class; an id whose text doesn't fit is passed over.
SAMPLE_ROWS, SAMPLE_BYTES = 2600, 10 << 20
EPOCHS, BATCH, RATE = 9, 64, 0.006
EMBED, FILTERS, CHUNK_FILTERS = 8, 24, 16
STEP, HALF = 4, 128
LAGS = range(3, 25)
PASS_BYTES = 1 << 20


def layout(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts padded with zero bytes to whole half chunks (two at least, and four spare bytes); and each text's first half chunk."""
    sizes = np.diff(offsets)
    halves = np.maximum(2, -(-(sizes + STEP) // HALF))
    first = np.append(0, np.cumsum(halves))
    out = np.zeros(int(first[-1]) * HALF, np.uint8)
    out[np.repeat(first[:-1] * HALF - offsets[:-1], sizes) + np.arange(len(raw))] = raw
    return out, first


def echoes(raw: np.ndarray) -> np.ndarray:
    """1 where the last four bytes (no padding) stood ``LAGS`` bytes earlier too."""
    quad = np.zeros(len(raw), np.uint32)
    for k in range(4):
        quad[3:] |= raw[3 - k : len(raw) - k].astype(np.uint32) << np.uint32(8 * k)
    found = np.zeros(len(raw), bool)
    for lag in LAGS:
        found[lag:] |= quad[lag:] == quad[:-lag]
    return found & (raw > 0)


class Net:
    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        wide = STEP * (EMBED + 1)
        self.p = {
            "embed": rng.normal(0, 0.5, (256, EMBED)), "conv": rng.normal(0, 1 / np.sqrt(2 * wide), (wide, 2 * FILTERS)), "bias": np.zeros(FILTERS),
            "chunk": rng.normal(0, 1 / np.sqrt(FILTERS), (FILTERS, CHUNK_FILTERS)), "chunk_bias": np.full(CHUNK_FILTERS, 0.1), "out": rng.normal(0, 0.3, CHUNK_FILTERS), "out_bias": np.zeros(1)}
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        self.shift = 0.0

    def forward(self, raw: np.ndarray, first: np.ndarray) -> dict:
        p = self.p
        x = np.empty((len(raw), EMBED + 1), np.float32)
        x[:, :EMBED] = p["embed"][raw]
        x[:, EMBED] = echoes(raw)
        x = x.reshape(len(raw) // STEP, -1)
        y = x @ p["conv"]
        a = y[:, :FILTERS] + p["bias"]
        a[:-1] += y[1:, FILTERS:]
        per = HALF // STEP
        a[first[1:] * per - 1] = 0  # the last place of a text would look into the next one
        np.maximum(a, 0, out=a)
        half = a.reshape(-1, per, FILTERS).sum(1)
        c = np.zeros_like(half)
        c[:-1] = (half[:-1] + half[1:]) / (2 * per)
        z = np.maximum(c @ p["chunk"] + p["chunk_bias"], 0)
        z[first[1:] - 1] = 0  # a text's last half begins no chunk
        m = np.maximum.reduceat(z, first[:-1], axis=0)
        return {"x": x, "a": a, "c": c, "z": z, "m": m, "logit": m @ p["out"] + p["out_bias"][0] + np.float32(self.shift)}

    def backward(self, raw: np.ndarray, first: np.ndarray, f: dict, d: np.ndarray) -> dict:
        """Gradients for the given derivatives by logit."""
        p, g, per = self.p, {}, HALF // STEP
        g["out"], g["out_bias"] = f["m"].T @ d, d.sum(keepdims=True)
        owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
        top = f["z"] == f["m"][owner]
        at = np.maximum.reduceat(np.where(top, np.arange(len(top))[:, None], -1), first[:-1], axis=0)
        dz = np.zeros_like(f["z"])
        np.put_along_axis(dz, at, (d[:, None] * p["out"]) * (f["m"] > 0), 0)
        g["chunk"], g["chunk_bias"] = f["c"].T @ dz, dz.sum(0)
        dc = dz @ p["chunk"].T / (2 * per)
        dh = dc.copy()
        dh[1:] += dc[:-1]
        da = np.repeat(dh, per, 0) * (f["a"] > 0)
        dy = np.zeros((len(da), 2 * FILTERS), np.float32)
        dy[:, :FILTERS] = da
        dy[1:, FILTERS:] = da[:-1]
        g["conv"], g["bias"] = f["x"].T @ dy, da.sum(0)
        dx = (dy @ p["conv"].T).reshape(len(raw), -1)
        g["embed"] = np.stack([np.bincount(raw, dx[:, k], 256) for k in range(EMBED)], 1)
        return g

    def score(self, texts: pa.Array) -> np.ndarray:
        raw, first = layout(*raw_bytes(texts))
        return 1 / (1 + np.exp(-self.forward(raw, first)["logit"].astype(np.float64)))


def train(texts: list[str], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Net:
    net, rng = Net(seed), np.random.default_rng(seed)
    parts = [raw_bytes(pa.array([t], pa.string())) for t in texts]
    mean = {k: np.zeros_like(v) for k, v in net.p.items()}
    square = {k: np.zeros_like(v) for k, v in net.p.items()}
    weight = np.where(labels == 1, 0.5 / max(labels.mean(), 1e-9), 0.5 / max(1 - labels.mean(), 1e-9)).astype(np.float32)
    step, steps = 0, epochs * -(-len(texts) // BATCH)
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for k in range(0, len(order), BATCH):
            own = order[k : k + BATCH]
            sizes = [len(parts[i][0]) for i in own]
            raw, first = layout(np.concatenate([parts[i][0] for i in own]), np.append(0, np.cumsum(sizes)))
            f = net.forward(raw, first)
            d = (1 / (1 + np.exp(-f["logit"])) - labels[own]).astype(np.float32) * weight[own] / len(own)
            step += 1
            rate = RATE * (1 - step / (steps + 1))
            for name, g in net.backward(raw, first, f, d).items():
                g = g.astype(np.float32)
                mean[name] += 0.1 * (g - mean[name])
                square[name] += 0.001 * (g * g - square[name])
                net.p[name] -= rate * (mean[name] / (1 - 0.9**step)) / (np.sqrt(square[name] / (1 - 0.999**step)) + 1e-8)
    return net


def fitting(sizes, room: int) -> list[bool]:
    """Which sizes are taken, in order; one that doesn't fit in what is left is passed over."""
    taken = []
    for n in sizes:
        taken.append(n <= room)
        room -= n if taken[-1] else 0
    return taken


def fit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = SAMPLE_ROWS, size: int = SAMPLE_BYTES) -> Net | float:
    """The network, or the constant score where there is nothing to tell apart."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y"))
             .where("doc_id is not null and y in (0, 1)").groupBy("doc_id").agg(F.min("y").alias("y")).where(F.pmod(crc_fold(), F.lit(3)) != 1))
    share = known.agg(F.avg("y")).first()[0]
    if share is None or share in (0.0, 1.0):
        return 0.5 if share is None else float(share)
    order = F.xxhash64(F.lit(3), "doc_id")
    chosen = known.where("y = 0").orderBy(order).limit(rows // 2).union(known.where("y = 1").orderBy(order).limit(rows // 2))
    docs = narrow(df, id_col, text_col).join(F.broadcast(chosen), "doc_id").select("doc_id", "y", F.coalesce("text", F.lit("")).alias("text"))
    sizes = docs.groupBy("doc_id", "y").agg(F.sum(F.octet_length("text")).alias("n")).orderBy(F.xxhash64(F.lit(3), "doc_id")).toPandas()
    sizes = sizes[sizes.groupby("y")["n"].transform(lambda n: fitting(n, size // 2)).astype(bool)]
    if sizes["y"].nunique() < 2:
        return float(share)
    ids = df.sparkSession.createDataFrame([(int(x),) for x in sizes["doc_id"].unique()], "doc_id long")
    sample = docs.join(F.broadcast(ids), "doc_id").toPandas().sort_values(["doc_id", "text"])
    net = train(sample["text"].tolist(), sample["y"].to_numpy(np.float32))
    net.shift = float(np.log(share / (1 - share)))  # trained on classes of equal weight
    return net


def _scores(model):
    def run(batches):
        net = model.value
        for batch in batches:
            for piece in text_slices(batch, budget=PASS_BYTES):
                score = np.full(piece.num_rows, net) if isinstance(net, float) else net.score(piece.column("text"))
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    return run


def score(df: DataFrame, net: Net | float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of every row."""
    model = df.sparkSession.sparkContext.broadcast(net)
    return narrow(df, id_col, text_col).mapInArrow(_scores(model), "doc_id long, score double")


def _good(model, at: int, least: float):
    def run(batches):
        forget()
        net = model.value
        for batch in batches:
            texts = pa.RecordBatch.from_arrays([batch.column(at)], ["text"])
            good = [np.full(piece.num_rows, net) if isinstance(net, float) else net.score(piece.column("text")) for piece in text_slices(texts, budget=PASS_BYTES)]
            yield batch.filter(pa.array(np.concatenate([*good, np.zeros(0)]) >= least))

    return run


def keep_good(df: DataFrame, net: Net | float, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows that score ``least`` or more, with all their columns. Rows stay in Arrow batches; only slices of texts are scored at a time."""
    small_batches(df.sparkSession)
    model = df.sparkSession.sparkContext.broadcast(net)
    return df.mapInArrow(_good(model, df.columns.index(text_col), least), df.schema)


def digest(df: DataFrame, labels: DataFrame) -> DataFrame:
    out = score(df, fit(df, labels))
    return out.select("doc_id", F.coalesce(F.pmod(crc_fold(), F.lit(3)) == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
