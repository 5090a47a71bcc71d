"""Language-model scores: a log-bilinear model trained by noise-contrastive estimation, and an add-one unigram base."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from orrery.llm import words as T
from orrery.sources.storage import written

CLASSES = 1024  # words the model tells apart, among them the end and "any other word"
OTHER, END = 0, 1
SIZE = 16  # numbers that describe a word
TOP = 1 << 18  # counts of at most so many words go to the tasks (4 MB); those of the others are joined
BATCH, NOISE, RATE = 1024, 32, 0.05
SEED = 5
END_HASH = np.uint64(0x8000000000000001)  # stands for the end token
STEPS = 8  # counts per power of two are told apart in steps of this number


class Model(NamedTuple):
    """Scores of a word after two words: `(near * r[previous] + far * r[before]) . q[word] + b[word]`."""

    r: np.ndarray  # context words; row CLASSES stands before the text
    q: np.ndarray
    b: np.ndarray
    far: np.ndarray
    near: np.ndarray

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self]).astype(np.float64)

    @staticmethod
    def of(flat: np.ndarray) -> Model:
        shapes = [(CLASSES + 1, SIZE), (CLASSES, SIZE), (CLASSES,), (SIZE,), (SIZE,)]
        ends = np.cumsum([0, *(int(np.prod(s)) for s in shapes)])
        return Model(*(flat[a:b].reshape(s).astype(np.float32) for a, b, s in zip(ends, ends[1:], shapes)))


def fresh_model(share: np.ndarray) -> Model:
    """Before training the model is the unigram distribution over classes."""
    rng = np.random.default_rng(SEED)
    return Model(
        rng.normal(0, 0.1, (CLASSES + 1, SIZE)).astype(np.float32), rng.normal(0, 0.1, (CLASSES, SIZE)).astype(np.float32),
        np.log(share).astype(np.float32), np.ones(SIZE, np.float32), np.ones(SIZE, np.float32),
    )


class Tables(NamedTuple):
    """The model multiplied out: log P(w | before, previous) = far[before, w] + near[previous, w] - norm[before, previous]."""

    far: np.ndarray
    near: np.ndarray
    norm: np.ndarray


def multiplied(m: Model) -> Tables:
    """Scores are a sum over the two context words, so all normalisers are one product of two matrices."""
    far, near = (m.far * m.r) @ m.q.T, (m.near * m.r) @ m.q.T + m.b
    a, b = far.max(axis=1, keepdims=True), near.max(axis=1, keepdims=True)
    return Tables(far, near, np.log(np.exp(far - a) @ np.exp(near - b).T) + a + b.T)


def train(model: Model, share: np.ndarray, stream: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[Model, int]:
    """One pass of noise-contrastive estimation over `(before, previous, word)` batches with adaptive steps.

    The noise words of a batch are shared by its tokens, so their scores are one matrix product."""
    rng = np.random.default_rng(SEED + 1)
    r, q, b, far, near = (x.copy() for x in model)
    seen = [np.full_like(x, 1e-6) for x in (r, q, b, far, near)]
    extra = np.log(NOISE * share).astype(np.float32)
    upto = np.cumsum(share)
    n = 0
    width = np.arange(SIZE)

    def scatter(rows: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
        at = (rows[:, None] * SIZE + width).ravel()
        return np.bincount(at, weights=values.ravel(), minlength=size * SIZE).reshape(size, SIZE).astype(np.float32)

    for before, previous, word in stream:
        noise = np.minimum(np.searchsorted(upto, rng.random(NOISE)), CLASSES - 1)
        h = far * r[before] + near * r[previous]
        true = np.einsum("ij,ij->i", h, q[word]) + b[word] - extra[word]
        false = h @ q[noise].T + b[noise] - extra[noise]
        g = 1 / (1 + np.exp(np.clip(true, -30, 30)))
        gn = -1 / (1 + np.exp(-np.clip(false, -30, 30)))
        dh = g[:, None] * q[word] + gn @ q[noise]
        dq = scatter(word, g[:, None] * h, CLASSES)
        np.add.at(dq, noise, gn.T @ h)
        db = np.bincount(word, weights=g, minlength=CLASSES).astype(np.float32)
        np.add.at(db, noise, gn.sum(axis=0))
        dr = scatter(before, far * dh, CLASSES + 1) + scatter(previous, near * dh, CLASSES + 1)
        steps = (dr, dq, db, np.einsum("ij,ij->j", r[before], dh), np.einsum("ij,ij->j", r[previous], dh))
        for value, total, step in zip((r, q, b, far, near), seen, steps):
            total += step * step
            value += RATE * step / np.sqrt(total)
        n += len(word)
    return Model(r, q, b, far, near), n


class Vocabulary(NamedTuple):
    """Counts over the training texts. `hashes` (sorted) and `counts` hold the frequent words, `classes` their class."""

    hashes: np.ndarray
    counts: np.ndarray
    classes: np.ndarray
    tokens: int
    distinct: int
    end: int
    other: int  # tokens and distinct words outside the classes
    others: int

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each hash is, and whether it is there."""
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return at, self.hashes[at] == hashes


def _contexts(w: T.Words, v: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Class of each token (the words and an end per text), of the two before it, and where each text's tokens start."""
    at, known = v.find(w.hash)
    own = np.where(known, v.classes[at] if len(v.classes) else OTHER, OTHER)
    first = w.first + np.arange(len(w.first))
    word = np.full(first[-1], END, np.int64)
    inside = np.ones(first[-1], bool)
    inside[first[1:] - 1] = False
    word[inside] = own
    before, previous = np.full(len(word), CLASSES), np.full(len(word), CLASSES)
    previous[1:] = word[:-1]
    before[2:] = word[:-2]
    previous[first[:-1]] = CLASSES
    before[first[:-1]] = CLASSES
    second = first[:-1] + 1
    before[second[second < first[1:]]] = CLASSES
    return before, previous, word, first


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in T.slices(batches, "text", 4 << 20):
        w = T.words(part.column("text"), T.SPACES)
        hashes, n = np.unique(w.hash, return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(hashes, END_HASH).view(np.int64)), pa.array(np.append(n, part.num_rows))], ["hash", "n"]
        )


def _trainer(vocabulary, start, share):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def stream():
            for part in T.slices(batches, "text"):
                before, previous, word, _ = _contexts(T.words(part.column("text"), T.SPACES), vocabulary.value)
                for i in range(0, len(word), BATCH):
                    yield before[i : i + BATCH], previous[i : i + BATCH], word[i : i + BATCH]

        model, n = train(Model.of(start.value), share.value, stream())
        if n:
            flat = model.flat()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(flat))), pa.array(flat * n), pa.array(np.full(len(flat), n))], ["place", "value", "n"]
            )

    return run


def _scorer(vocabulary, parameters):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v: Vocabulary = vocabulary.value
        t = multiplied(Model.of(parameters.value))
        for part in T.slices(batches, "text"):
            w = T.words(part.column("text"), T.SPACES)
            before, previous, word, first = _contexts(w, v)
            score = t.far[before, word] + t.near[previous, word] - t.norm[before, previous]
            at, known = v.find(w.hash)
            gain = np.where(known, np.log10(v.counts[at] + 1.0) if len(v.counts) else 0.0, 0.0)
            own = np.where(known, v.classes[at] if len(v.classes) else OTHER, OTHER) != OTHER
            upto = lambda x, ends: np.diff(np.concatenate([[0.0], np.cumsum(x, dtype=np.float64)])[ends])
            rest, tf, ends = [], [], [0]
            for i in range(part.num_rows):
                here = slice(w.first[i], w.first[i + 1])
                h, n = np.unique(w.hash[here][~known[here]], return_counts=True)
                rest.append(h)
                tf.append(n)
                ends.append(ends[-1] + len(h))
            offsets = pa.array(np.array(ends, np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), part.column("held_out"), pa.array(w.counts() + 1),
                    pa.array(upto(known, w.first).astype(np.int64) + int(v.end > 0)),
                    pa.array(upto(gain, w.first) + np.log10(v.end + 1.0)), pa.array(upto(np.where(own, 0.0, gain), w.first)),
                    pa.array(upto(~own, w.first).astype(np.int64)), pa.array(upto(score, first) / np.log(10)),
                    T.list_array(np.concatenate(rest), np.array(ends)), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(tf))),
                ],
                ["doc_id", "held_out", "n_tokens", "n_known", "gain", "other_gain", "n_other", "model", "rest", "times"],
            )

    return run


def _vocabulary(counts: DataFrame, top: int) -> Vocabulary:
    """The frequent words: the largest counts, cut where a step of a logarithmic histogram would make more than `top`."""
    step = F.floor(F.log2("n") * STEPS).cast("int")
    words = counts.where(F.col("hash") != int(END_HASH.view(np.int64)))
    sizes = words.groupBy(step.alias("s")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("s")).collect()  # at most 64 * STEPS rows
    least, have = None, 0
    for row in sizes:
        have += row["n"]
        if have > top:
            break
        least = row["s"]
    frequent = words.where(step >= least).select("hash", "n").toArrow() if least is not None else None  # at most `top` rows
    hashes = frequent.column("hash").to_numpy().view(np.uint64) if frequent else np.zeros(0, np.uint64)
    n = frequent.column("n").to_numpy() if frequent else np.zeros(0, np.int64)
    order = np.argsort(hashes)
    hashes, n = hashes[order], n[order]
    classes = np.full(len(hashes), OTHER, np.int64)
    best = np.lexsort((hashes, -n))[: CLASSES - 2]
    classes[best] = np.arange(len(best)) + 2
    total = counts.agg(F.sum("n").alias("t"), F.count(F.lit(1)).alias("v"), F.sum(F.when(F.col("hash") == int(END_HASH.view(np.int64)), F.col("n"))).alias("e")).first()
    tokens, distinct, end = total["t"] or 0, total["v"], total["e"] or 0
    inside = int(n[best].sum())
    return Vocabulary(hashes, n, classes, tokens, distinct, end, tokens - end - inside, distinct - int(end > 0) - len(best))


def lm_scores(docs: DataFrame, held_out=None, top: int = TOP, rounds: int = 1) -> DataFrame:
    """One row per row of `docs (doc_id, text)`: `doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`.

    Tokens are lower-cased (A-Z) runs without white space, then one end per text; a null text is only an end. Rows with `held_out`
    (default: crc32 of doc_id modulo 7 is 2; a null doc_id is not) are scored but not learned from.

    - Base: log10 of add-one unigram probabilities, from exact counts over all training texts.
    - Model: log-bilinear over the two words before, on the `CLASSES - 2` most frequent words, the end and "any other
      word"; that class's probability is shared out by add-one counts. Every training token is learned from in each of `rounds` rounds: each
      task makes one pass over its texts from the same start, and the models are averaged by tokens. Scores are exactly normalised.

    Texts are read to count, for each round and to score, and never shuffled. What moves are counts per task, one set of
    parameters per task (summed per parameter), and the words of a document that are not among the `top` most frequent, to
    look up their counts. The driver holds the frequent words and the parameters, both of bounded size. Without
    training texts the model is uniform."""
    sc = docs.sparkSession.sparkContext
    if held_out is None:
        held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    training = rows.where(~F.col("held_out")).select("text")
    counts = written(training.mapInArrow(_count, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n")), "counts")
    v = _vocabulary(counts, top)
    share = np.full(CLASSES, 0.1)
    share[OTHER] += v.other
    share[END] += v.end
    share[v.classes[v.classes != OTHER]] += v.counts[v.classes != OTHER]
    share /= share.sum()
    vocabulary, shares = sc.broadcast(v), sc.broadcast(share)
    flat = fresh_model(share).flat()
    for _ in range(rounds):
        learned = training.mapInArrow(_trainer(vocabulary, sc.broadcast(flat), shares), "place long, value double, n long")
        mean = learned.groupBy("place").agg((F.sum("value") / F.sum("n")).alias("value")).toArrow()  # one row per parameter
        flat = flat.copy()
        flat[mean.column("place").to_numpy()] = mean.column("value").to_numpy()

    scored = written(
        rows.mapInArrow(
            _scorer(vocabulary, sc.broadcast(flat)),
            "doc_id long, held_out boolean, n_tokens long, n_known long, gain double, other_gain double, n_other long, "
            "model double, rest array<long>, times array<long>",
        ).withColumn("row", F.monotonically_increasing_id()),
        "scored",
    )
    rest = scored.select("row", F.inline(F.arrays_zip("rest", "times")).alias("hash", "times"))
    found = rest.join(counts, "hash").groupBy("row").agg(
        F.sum("times").alias("more_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more")
    )
    more = F.coalesce("more", F.lit(0.0))
    base = F.col("gain") + more - F.col("n_tokens") * F.lit(float(np.log10(v.tokens + v.distinct + 1)))
    score = F.col("model") + F.col("other_gain") + more - F.col("n_other") * F.lit(float(np.log10(v.other + v.others + 1)))
    return scored.join(found, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(v.tokens).cast("long").alias("train_tokens"), base.alias("base_score"), score.alias("score"),
    )
