"""Quality classifier: supervised subword embeddings.

Features of a text are its words and the 3- and 4-byte n-grams of the words (with the
blank after them), hashed into ``BUCKETS``.  Each run of ``AGAIN`` words that stands earlier
in the text too is one more feature, the same whatever the words: the mean holds the share
of repetition.  Each bucket has a learned vector; a document is the mean of its features'
vectors, a softmax over two outputs gives the score.  Vectors and outputs are trained by stochastic gradient descent in numpy, in
one task, on a bounded sample: of each label the ``SAMPLE`` rows with the smallest hash.

The output is linear in the mean, so for scoring a bucket's vector and the
output weights fold into one number: the model that is broadcast is ``BUCKETS``
floats, whatever the size of the corpus.

Defined results: NULL or empty text has no feature: its score is the model's bias; NULL
labels are not used, several labels of a document all count; rows with the same doc_id are
scored one by one; with no labels every score is 0.5; an empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velostat.llm.common import SPACE_SEPARATED, RollingHash, byte_values, documents_of, find_words, mix64, spark_schema, text_blocks, word_parts

BUCKETS = 1 << 17
DIM = 8
SAMPLE = 1_500
EPOCHS = 6
RATE = 0.2
GRAMS = (3, 4)
AGAIN = (3,)

_SEED, _BASE = 17, 0x9E3779B97F4A7C15
_SCORES = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])
_FEATURES = pa.schema(
    [("place", pa.int64()), ("label", pa.int32()), ("ids", pa.list_(pa.int32())), ("share", pa.list_(pa.float32()))]
)


def features(block, buckets: int):
    """(bucket, text) of every feature of a block, words first, then each n-gram size, then the
    runs that were there before; of a very long text in parts."""
    again = [([], []) for _ in AGAIN]
    pick = np.uint64(buckets - 1)
    for part, own in word_parts(block, SPACE_SEPARATED, max(AGAIN) - 1):
        starts, ends = find_words(part.data, SPACE_SEPARATED)
        data = np.where(SPACE_SEPARATED[part.data], part.data, np.uint8(32))
        rolling = RollingHash(_BASE)
        prefix = rolling.prefix(byte_values(_SEED)[data])
        text = np.searchsorted(part.starts, starts, side="right") - 1
        mine = len(starts) if part is block else int(np.searchsorted(starts, own))
        for (hashes, owners), n in zip(again, AGAIN):
            first = np.flatnonzero(text[n - 1 :] == text[: max(len(text) - n + 1, 0)])
            first = first[first < mine]
            hashes.append(mix64(rolling.spans(prefix, starts[first], ends[first + n - 1]) + text[first].astype(np.uint64)))
            owners.append(text[first])
        starts, ends, text = starts[:mine], ends[:mine], text[:mine]
        yield (mix64(rolling.spans(prefix, starts, ends)) & pick).astype(np.int64), text
        for n in GRAMS:
            count = np.maximum(ends - starts + 2 - n, 0)  # the blank after the word belongs to its last n-gram
            at = np.repeat(starts - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
            h = mix64(rolling.spans(prefix, at, at + n) + np.uint64(n))
            yield (h & pick).astype(np.int64), np.repeat(text, count)
    for (hashes, owners), n in zip(again, AGAIN):
        h, text = np.concatenate(hashes), np.concatenate(owners)
        order = np.argsort(h, kind="stable")
        seen = order[1:][h[order[1:]] == h[order[:-1]]]
        bucket = int(mix64(np.array([_SEED + n], dtype=np.uint64))[0]) & (buckets - 1)
        yield np.full(len(seen), bucket, dtype=np.int64), text[seen]


def feature_counts(block, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, count) of the distinct features of each text."""
    if len(block.starts) == 1:
        counts = sum(np.bincount(ids, minlength=buckets) for ids, _ in features(block, buckets))
        ids = np.flatnonzero(counts)
        return np.zeros(len(ids), dtype=np.int64), ids, counts[ids]
    parts = list(features(block, buckets))
    both = np.concatenate([p[1] for p in parts]) * buckets + np.concatenate([p[0] for p in parts])
    both, counts = np.unique(both, return_counts=True)
    return both // buckets, both % buckets, counts


def _sample_features(rows: DataFrame, buckets: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for block in text_blocks(batch.column("text")):
                owner, ids, counts = feature_counts(block, buckets)
                total = np.bincount(owner, weights=counts, minlength=len(block.starts))
                cuts = np.searchsorted(owner, np.arange(len(block.starts) + 1)).astype(np.int32)
                share = (counts / total[owner]).astype(np.float32)
                rows = slice(block.first, block.last)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("place")[rows],
                        batch.column("label")[rows],
                        pa.ListArray.from_arrays(cuts, pa.array(ids.astype(np.int32))),
                        pa.ListArray.from_arrays(cuts, pa.array(share)),
                    ],
                    schema=_FEATURES,
                )

    return rows.mapInArrow(run, spark_schema(_FEATURES))


def train(examples, buckets: int, dim: int, epochs: int, rate: float, seed: int = 1) -> np.ndarray:
    """SGD on (label, ids, share) examples; returns bucket weights, then the bias."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (buckets, dim)).astype(np.float32)
    out, bias = np.zeros((2, dim), dtype=np.float32), np.zeros(2, dtype=np.float32)
    steps, done = max(1, epochs * len(examples)), 0
    for _ in range(epochs):
        for k in rng.permutation(len(examples)):
            label, ids, share = examples[k]
            step = np.float32(rate * (1 - done / steps))
            done += 1
            hidden = share @ vectors[ids]
            z = out @ hidden + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label] -= 1  # gradient of the loss at the outputs
            back = p @ out
            out -= step * np.outer(p, hidden)
            bias -= np.float32(0.01) * step * p
            # a feature's share of the mean scales its step; sizes are evened out by the number of features
            vectors[ids] -= (step * np.sqrt(np.float32(len(ids)))) * share[:, None] * back[None, :]
    weights = vectors @ (out[1] - out[0])
    return np.append(weights, bias[1] - bias[0]).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, buckets=BUCKETS, dim=DIM, sample=SAMPLE, epochs=EPOCHS, rate=RATE) -> np.ndarray:
    """Model weights from ``labels`` (doc_id, label 0 or 1) of ``docs``."""
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("label").cast("int").alias("label"))
    known = known.where("doc_id is not null and label in (0, 1)").distinct()
    place = F.xxhash64("doc_id").alias("place")
    chosen = [known.where(F.col("label") == v).select("*", place).orderBy("place", "doc_id").limit(sample) for v in (0, 1)]
    rows = documents_of(docs).join(F.broadcast(chosen[0].union(chosen[1])), "doc_id").select("place", "label", "text")
    # 2 * sample rows meet in one task; a shuffle, so that the scan before it stays parallel
    examples = _sample_features(rows, buckets).repartition(1)
    schema = pa.schema([("weights", pa.binary())])

    def run(batches):
        held = []
        for batch in batches:
            place, label = batch.column("place").to_pylist(), batch.column("label").to_pylist()
            ids, share = batch.column("ids"), batch.column("share")
            held += [
                (place[i], label[i], ids[i].values.to_numpy(), share[i].values.to_numpy()) for i in range(batch.num_rows)
            ]
        held.sort(key=lambda x: (x[0], x[1], len(x[2])))
        weights = train([x[1:] for x in held if len(x[2])], buckets, dim, epochs, rate)
        yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()], type=pa.binary())], schema=schema)

    found = examples.mapInArrow(run, spark_schema(schema)).collect()  # one row of bounded size
    return np.frombuffer(found[0][0], dtype=np.float32) if found else np.zeros(buckets + 1, dtype=np.float32)


def score(docs: DataFrame, model: np.ndarray) -> DataFrame:
    """doc_id and score of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    buckets = len(model) - 1

    def run(batches):
        weights, bias = shared.value[:-1].astype(np.float64), float(shared.value[-1])
        for batch in batches:
            for block in text_blocks(batch.column("text")):
                n = len(block.starts)
                total, count = np.zeros(n), np.zeros(n)
                for ids, owner in features(block, buckets):
                    total += np.bincount(owner, weights=weights[ids], minlength=n)
                    count += np.bincount(owner, minlength=n)
                z = np.clip(total / np.maximum(count, 1) + bias, -40, 40)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[block.first : block.last], pa.array(1 / (1 + np.exp(-z)))], schema=_SCORES
                )

    return documents_of(docs).mapInArrow(run, spark_schema(_SCORES))


def held_out(doc_id: Column) -> Column:
    """The third of the documents that no label is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted; learned from the rows that are not held out."""
    model = fit(docs, labels.where(~held_out(F.col("doc_id"))))
    return score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
