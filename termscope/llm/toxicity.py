"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams and itself, hashed into a table of
embeddings.  A window of a few words is the mean of its bags, and a linear
softmax over two classes reads that mean.  Training takes a document as toxic if
any of its windows is, P = 1 - prod(1 - p_window), so that embeddings and softmax
are learned from document labels alone, and a misspelt word shares most
n-grams with the word it hides.

A score reads all windows of the whole text: E = sum of -log(1 - p_window) over its
different windows is the evidence; a window that comes again is no new evidence.  ``level`` is what a window of nine in ten clean training texts has on
average at most; the score is logistic in the log of the excess max(E - n level, 0)
and the log of the number of windows n, with coefficients fitted on the training
sample.  So every window counts, and a long clean text does not add up.

Training runs in numpy on a bounded sample of the labelled rows
(``Settings.sample_rows``, the rows with the smallest seeded hashes of each
class); scoring reads every whole text in Arrow batches with a per-worker
memory of words.  The model is a fixed-size table (2^18 numbers for scoring),
which is what travels with the tasks.

Defined results: a null or wordless text scores as one empty window, that is
by the bias alone; labels that are null or without a document are not used; a
document with several labels counts once per label.  Without both classes the model scores 0.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termscope.llm.columns import fresh

_WORD = re.compile(r"\w+")
_CACHE_WORDS = 1 << 18
_LEAST = 3e-3  # added to the excess before its logarithm


@dataclass(frozen=True)
class Settings:
    """Parameters of sample, model and training."""

    sample_rows: int = 2500  # labelled rows per class that training reads
    sample_chars: int = 16 << 20  # of both classes together; rows beyond it are left out whole
    grams: tuple[int, ...] = (3, 4, 5)
    buckets: int = 1 << 18
    dim: int = 8
    window: int = 6
    epochs: int = 6
    steps: int = 500  # at least; a small sample is read more often
    rate: float = 0.1
    floor: float = 1e-4  # of a bucket's summed squared gradients
    batch: int = 48
    seed: int = 7


@dataclass
class Model:
    """``weight[b]`` is what bucket b adds to the difference of the two logits, before averaging."""

    settings: Settings
    weight: np.ndarray
    bias: float
    level: float = 0.0
    shape: np.ndarray = field(default_factory=lambda: np.array([0.0, 0.0, -30.0]))  # of log excess, log windows, constant
    known: dict[str, int] = field(default_factory=dict)  # words seen by this worker
    sums: list[np.ndarray] = field(default_factory=list)  # their weights' sum and number, by chunks of words

    def __getstate__(self) -> dict:
        return self.__dict__ | {"known": {}, "sums": []}

    def forget(self) -> None:
        self.known.clear()
        self.sums.clear()

    def _places(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Place in ``sums`` of every word of the texts in a row, and the sums."""
        if len(self.known) > _CACHE_WORDS:
            self.forget()
        new = [w for w in dict.fromkeys(w for words in texts for w in words) if w not in self.known]
        if new:
            bucket, word = grams(new, self.settings)
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
            self.sums.append(np.stack([np.bincount(word, self.weight[bucket], len(new)), np.bincount(word, minlength=len(new))], 1))
            if len(self.sums) > 64:
                self.sums[:] = [np.concatenate(self.sums)]
        known = self.known
        places = np.fromiter((known[w] for words in texts for w in words), np.int64, sum(map(len, texts)))
        return places, np.concatenate(self.sums) if self.sums else np.zeros((0, 2))

    def evidence(self, texts: list[str]) -> np.ndarray:
        """Per text: evidence of its different windows, and their number."""
        worded = [_WORD.findall(t.lower()) for t in texts]
        places, sums = self._places(worded)
        first, last, of = windows([len(w) for w in worded], self.settings.window)
        total = np.concatenate([np.zeros((1, 2)), np.cumsum(sums[places], axis=0)])
        part = total[last] - total[first]
        logit = part[:, 0] / np.maximum(part[:, 1], 1) + self.bias
        own = once(places, first, last, of, self.settings.window)
        of = of[own]
        clean = np.bincount(of, np.logaddexp(0, logit[own]), len(texts))  # -log(1 - p_window), added up
        return np.stack([clean, np.bincount(of, minlength=len(texts))], axis=1)

    def read(self, evidence: np.ndarray) -> np.ndarray:
        """Per text: log of the excess, log of the number of windows, 1."""
        total, n = evidence.T
        return np.stack([np.log(np.maximum(total - n * self.level, 0) + _LEAST), np.log(n), np.ones(len(n))], axis=1)

    def scores(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.read(self.evidence(texts)) @ self.shape, -60, 60)))


def fit_shape(read: np.ndarray, labels: np.ndarray, ridge: float = 1e-2, steps: int = 80) -> np.ndarray:
    """Logistic regression by Newton's steps, with a small penalty on all but the constant."""
    shape, penalty = np.zeros(read.shape[1]), np.array([ridge, ridge, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(read @ shape, -30, 30)))
        slope = read.T @ (p - labels) + penalty * shape
        curve = (read * (p * (1 - p))[:, None]).T @ read + ridge * np.eye(len(shape))
        shape = shape - np.linalg.solve(curve, slope)
    return shape


def grams(words: list[str], settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, place of the word) for each word itself and each of its n-grams with marked ends."""
    sizes = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    chars = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    word = np.repeat(np.arange(len(words)), sizes)
    start = np.cumsum(sizes) - sizes
    spread = np.uint64(0x9E3779B97F4A7C15)
    within = (np.arange(len(chars)) - np.repeat(start, sizes)).astype(np.uint64)
    letters = chars * spread
    whole = np.add.reduceat((letters ^ (letters >> np.uint64(29))) * (within * np.uint64(2) + np.uint64(3)) ** np.uint64(5), start)
    hashes, owners = [whole + np.uint64(1)], [np.arange(len(words))]
    for n in settings.grams:
        if len(chars) < n:
            continue
        h = np.full(len(chars) - n + 1, n, np.uint64)
        for k in range(n):
            h = (h ^ chars[k : len(chars) - n + 1 + k]) * spread
            h ^= h >> np.uint64(31)
        inside = word[: len(h)] == word[n - 1 :]
        hashes.append(h[inside])
        owners.append(word[: len(h)][inside])
    mixed = np.concatenate(hashes) * spread
    return ((mixed >> np.uint64(33)) % np.uint64(settings.buckets)).astype(np.int64), np.concatenate(owners)


def bags(words: list[str], settings: Settings, chunk: int = 1 << 15) -> tuple[np.ndarray, np.ndarray]:
    """Buckets word by word, and where each word's begin (with the end)."""
    buckets, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    for k in range(0, len(words), chunk):
        some = words[k : k + chunk]
        bucket, owner = grams(some, settings)
        buckets.append(bucket[np.argsort(owner, kind="stable")].astype(np.int32))
        sizes.append(np.bincount(owner, minlength=len(some)))
    return np.concatenate(buckets), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])


def windows(lengths: list[int], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, end word and text of each window, for texts whose words stand in a row.

    Windows overlap by half and cover all words; a text without words has one empty window.
    """
    n, step = np.asarray(lengths, np.int64), max(size // 2, 1)
    each = np.maximum(-(-(n - step) // step), 1)
    of = np.repeat(np.arange(len(n)), each)
    inner = (np.arange(len(of)) - np.repeat(np.cumsum(each) - each, each)) * step
    start = np.cumsum(n) - n
    return start[of] + inner, start[of] + np.minimum(inner + size, n[of]), of


def once(words: np.ndarray, first: np.ndarray, last: np.ndarray, of: np.ndarray, size: int) -> np.ndarray:
    """Places of the windows without those that have the words of an earlier one of their text (by 64-bit hash)."""
    key = of.astype(np.uint64)
    padded = np.concatenate([words.astype(np.uint64) + np.uint64(1), np.zeros(size, np.uint64)])
    for k in range(size):
        key = key * np.uint64(0x9E3779B97F4A7C15) + np.where(first + k < last, padded[first + k], np.uint64(0))
        key ^= key >> np.uint64(29)
    return np.unique(key, return_index=True)[1]


def fit(texts: list[str], labels: list[int], settings: Settings) -> Model:
    """Train embeddings and softmax jointly by mini-batches with Adagrad."""
    if len(set(labels)) < 2:
        return Model(settings, np.zeros(settings.buckets), -30.0)
    draw = np.random.default_rng(settings.seed)
    emb = draw.normal(0, 0.05, (settings.buckets, settings.dim))
    top = draw.normal(0, 0.5, (settings.dim, 2))
    bias = np.array([2.5, -2.5])
    words: dict[str, int] = {}
    docs = [np.array([words.setdefault(w, len(words)) for w in _WORD.findall(t.lower())], np.int32) for t in texts]
    ids, at = bags(list(words), settings)
    truth = np.array(labels, float)
    emb_sq, top_sq, bias_sq = np.full(settings.buckets, settings.floor), np.full(top.shape, 1e-2), np.full(2, 1e-2)
    for _ in range(max(settings.epochs, -(-settings.steps * settings.batch // len(docs)))):
        order = draw.permutation(len(docs))
        for start in range(0, len(order), settings.batch):
            some = order[start : start + settings.batch]
            uniq, inverse = np.unique(np.concatenate([docs[d] for d in some]), return_inverse=True)
            if not len(uniq):
                continue
            sizes = at[uniq + 1] - at[uniq]
            begin = np.cumsum(sizes) - sizes
            flat = ids[np.repeat(at[uniq] - begin, sizes) + np.arange(sizes.sum())]
            word_sum = np.add.reduceat(emb[flat], begin, axis=0)
            a, b, of = windows([len(docs[d]) for d in some], settings.window)
            total = np.concatenate([np.zeros((1, settings.dim)), np.cumsum(word_sum[inverse], axis=0)])
            count = np.concatenate([[0], np.cumsum(sizes[inverse])])
            n = np.maximum(count[b] - count[a], 1)[:, None]
            mean = (total[b] - total[a]) / n
            logit = mean @ top + bias
            z = logit[:, 1] - logit[:, 0]
            p_window = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            p = np.clip(-np.expm1(-np.bincount(of, np.logaddexp(0, z), len(some))), 1e-6, 1)
            # d loss / d z for loss = -[t log P + (1 - t) log(1 - P)], P = 1 - prod(1 - p_window)
            g = np.where(truth[some] > 0, -(1 - p) / p, 1.0)[of] * p_window
            g_logit = np.stack([-g, g], axis=1)
            g_mean = (g_logit @ top.T) / n
            g_top, g_bias = mean.T @ g_logit / len(some), g_logit.sum(0) / len(some)
            used, of_used = np.unique(flat, return_inverse=True)
            g_emb = np.empty((len(used), settings.dim))
            for j in range(settings.dim):
                edge = np.bincount(a, g_mean[:, j], len(inverse) + 1) - np.bincount(b, g_mean[:, j], len(inverse) + 1)
                g_word = np.bincount(inverse, np.cumsum(edge)[:-1], len(uniq))
                g_emb[:, j] = np.bincount(of_used, np.repeat(g_word, sizes), len(used))
            emb_sq[used] += (g_emb**2).mean(1)
            emb[used] -= settings.rate * g_emb / np.sqrt(emb_sq[used])[:, None]
            top_sq += g_top**2
            top -= settings.rate * g_top / np.sqrt(top_sq)
            bias_sq += g_bias**2
            bias -= settings.rate * g_bias / np.sqrt(bias_sq)
    model = Model(settings, emb @ (top[:, 1] - top[:, 0]), float(bias[1] - bias[0]))
    parts = [model.evidence(texts[k : k + 200]) for k in range(0, len(texts), 200)]
    evidence = np.concatenate(parts)
    clean = evidence[truth == 0]
    model.level = float(np.quantile(clean[:, 0] / clean[:, 1], 0.9))
    model.shape = fit_shape(model.read(evidence), truth)
    model.forget()
    return model


def train(
    docs: DataFrame, labels: DataFrame, usable: Column | None = None, settings: Settings = Settings(),
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
) -> Model:
    """Fit on a bounded sample of the labelled documents; ``usable`` filters labels by ``id_col``."""
    marked = labels if usable is None else labels.where(usable)
    marked = marked.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label")).where(
        "_id is not null and _label in (0, 1)")
    place = F.xxhash64(F.lit(settings.seed), "_id")
    # At most sample_rows ids per class reach the driver, and at most their texts.
    picked = [marked.where(F.col("_label") == k).orderBy(place, "_id").limit(settings.sample_rows) for k in (0, 1)]
    wanted = F.broadcast(picked[0].unionByName(picked[1]))  # bounded by sample_rows
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")).join(wanted, "_id")
    texts, classes, chars = [], [], 0
    for row in rows.orderBy(place, "_label", "_text").toLocalIterator():
        chars += len(row["_text"])
        if chars <= settings.sample_chars:
            texts.append(row["_text"])
            classes.append(row["_label"])
        else:
            chars -= len(row["_text"])
    return fit(texts, classes, settings)


def slices(texts: pa.Array, chars: int = 1 << 20) -> Iterator[list[str]]:
    """The batch's texts in lists of about ``chars`` characters, so that memory does not follow the batch size."""
    some, size = [], 0
    for text in texts:
        some.append(text.as_py())
        size += len(some[-1])
        if size >= chars:
            yield some
            some, size = [], 0
    if some:
        yield some


def with_score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """Add ``score_col``, the probability that the whole text is toxic (an old column of that name is replaced)."""
    kept = [c for c in docs.columns if c != score_col]
    read = F.coalesce(F.col(text_col), F.lit("")).alias(fresh(docs.columns, "_scored_text"))
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], read)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            parts = [model.scores(x) for x in slices(texts)]
            scores = pa.array(np.concatenate(parts) if parts else [], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], scores], names=[*kept, score_col])
        model.forget()  # the worker goes on with other operators

    from pyspark.sql.types import DoubleType, StructField, StructType

    fields = [f for f in docs.schema.fields if f.name != score_col]
    return rows.mapInArrow(run, StructType([*fields, StructField(score_col, DoubleType())]))


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The documents that score below ``threshold``, with their own columns."""
    name = fresh(docs.columns, "_toxicity")
    return with_score(docs, model, text_col, name).where(F.col(name) < threshold).drop(name)
