"""Toxicity by a convolutional text classifier, trained with numpy.

A word is the sum of hashed embeddings: of itself and of its first 3, 4 and 5 letters (a stem stands for its forms).  Filters of several
widths slide over the words of a whole text, each keeps its maximum, and a logistic layer turns the maxima into a score.  The first
embedding dimension starts from the class log-odds of its bucket, smoothed so that rare words start near 0; all weights are then trained
by Adam on minibatches.  Thresholds are calibrated by language on a fifth of the labelled texts that training doesn't see; they decide
``toxic`` and are no input of the score.

Training reads every labelled text.  Texts are cut into words once and written as word numbers, in parts of about ``PART_TEXTS`` texts by
hash, so the parts don't depend on partitioning.  Log-odds are counted by Spark.  Every pass trains a copy of the model on each part and
takes their mean, weighted by texts; what reaches the driver is the model (``BUCKETS`` x ``DIM`` numbers) and, for thresholds, counts of
scores in steps of 1 / ``STEPS``.  The model is broadcast; scoring reads every text once, in full, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.llm.common import SMALL_KEYS, Memo, adds, beside_text, blocks, quoted
from lamina.session import cut_lineage

BUCKETS = 1 << 17
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 6  # of each width
PREFIXES = (3, 4, 5)
SMOOTHING = 10.0
EPOCHS = 6  # passes over a single part
PASSES = 3  # over several parts, each of which takes as many steps a pass as the single one
PART_TEXTS = 4000
BATCH_WORDS = 400_000  # a minibatch ends here, however long its texts are
STEPS = 10_000  # of a score, for thresholds
RATE, EMBEDDING_RATE = 0.01, 0.0005
TOKEN = regex.compile(r"[\p{L}\p{M}\p{N}]+")
FALLBACK = ""  # the language of texts whose own has no threshold


def features(word: str) -> bytes:
    """Buckets of a word, packed: itself and its prefixes (marked, so a prefix isn't the word)."""
    names = [word, *("^" + word[:n] for n in PREFIXES)]
    return np.array([xxhash.xxh3_64_intdigest(x) % BUCKETS for x in names], dtype=np.int32).tobytes()


class Reader:
    """Texts to local word numbers: each distinct word of a block is looked up once."""

    def __init__(self, room: int = 400_000):
        self.memo = Memo(features, room=room)

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(buckets of each distinct word, word number at each place, length of each text); a text without words is one empty word."""
        numbers: dict[str, int] = {}
        flat, lengths = [], []
        for text in texts:
            words = TOKEN.findall(text.lower()) if text else []
            ids = [numbers.setdefault(w, len(numbers)) for w in words or [""]]
            flat.append(np.array(ids, dtype=np.int32))
            lengths.append(len(ids))
        buckets = np.frombuffer(b"".join(map(self.memo.__getitem__, numbers)), dtype=np.int32).reshape(len(numbers), -1)
        return buckets, np.concatenate(flat), np.array(lengths)


@dataclass
class Model:
    """embedding: BUCKETS x DIM; filters: for each width, width x DIM x FILTERS; bias and out: one number per filter; base: of the score."""

    embedding: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    base: float

    @staticmethod
    def fresh(log_odds: np.ndarray, seed: int = 7) -> Model:
        rng = np.random.default_rng(seed)
        e = rng.normal(0, 0.05, (BUCKETS, DIM)).astype(np.float32)
        e[:, 0] = log_odds
        filters = []
        for w in WIDTHS:
            k = rng.normal(0, 0.1, (w, DIM, FILTERS)).astype(np.float32)
            k[:, 0, : FILTERS // 2] = np.abs(k[:, 0, : FILTERS // 2]) + 1.0 / w
            filters.append(k)
        n = FILTERS * len(WIDTHS)
        return Model(e, filters, np.zeros(n, np.float32), np.full(n, 0.1, np.float32), -2.0)

    def pooled(self, buckets: np.ndarray, flat: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(maxima, places of the maxima) of every filter for every text; a filter wider than the text reaches into zeros."""
        words = self.embedding[buckets].sum(axis=1)
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        ends = np.cumsum(lengths)
        out, where = [], []
        for w, k in zip(WIDTHS, self.filters):
            # one table of products per offset, then sums of gathered rows
            value = (words @ k[0])[flat]
            for o in range(1, w):
                shifted = np.zeros_like(value)
                shifted[:-o or None] = (words @ k[o])[flat[o:]]
                for b in range(1, o + 1):  # places whose offset lies behind their text
                    at = ends - b
                    shifted[at[lengths >= b]] = 0
                value += shifted
            top = np.maximum.reduceat(value, starts, axis=0)
            out.append(top)
            where.append((starts, value))
        return np.concatenate(out, axis=1) + self.bias, where

    def score(self, buckets: np.ndarray, flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        top, _ = self.pooled(buckets, flat, lengths)
        return _logistic(np.maximum(top, 0) @ self.out + self.base)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def log_odds(buckets: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Smoothed log-odds of each bucket from the texts it occurs in."""
    n = np.zeros((2, BUCKETS), dtype=np.float32)
    for b, y in zip(buckets, labels):
        n[int(y), np.unique(b)] += 1
    return _odds(n, float(labels.mean()))


def _odds(n: np.ndarray, share: float) -> np.ndarray:
    share = max(1e-3, min(1 - 1e-3, share))
    return np.log((n[1] + SMOOTHING * share) / (n[0] + SMOOTHING * (1 - share)) * (1 - share) / share).astype(np.float32)


class Adam:
    """Steps of plain Adam for a list of arrays (changed in place) at a rate each; a gradient may be (rows, values)."""

    def __init__(self, arrays: list[np.ndarray], rates: list[float]):
        self.arrays, self.rates, self.t = arrays, rates, 0
        self.m = [np.zeros_like(a) for a in arrays]
        self.v = [np.zeros_like(a) for a in arrays]

    def step(self, gradients: list) -> None:
        self.t += 1
        fix = np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
        for a, rate, m, v, g in zip(self.arrays, self.rates, self.m, self.v, gradients):
            rows, g = g if isinstance(g, tuple) else (slice(None), g)
            m[rows] = 0.9 * m[rows] + 0.1 * g
            v[rows] = 0.999 * v[rows] + 0.001 * g * g
            a[rows] -= rate * fix * m[rows] / (np.sqrt(v[rows]) + 1e-7)


def fit(read: list[tuple[np.ndarray, np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 7, batch: int = 32) -> Model:
    """Train on texts in memory, each as a ``Reader`` gives it."""
    model = Model.fresh(log_odds([b.ravel() for b, _, _ in read], labels), seed)
    base = np.array([_base(float(labels.mean()))], np.float32)
    adam = _adam(model, base)
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for at in np.array_split(rng.permutation(len(read)), max(1, len(read) // batch)):
            _train(model, adam, base, [read[i] for i in at], labels[at].astype(np.float32))
    model.base = float(base[0])
    return model


def _base(share: float) -> float:
    return float(np.log((share + 1e-3) / (1 - share + 1e-3)))


def _adam(model: Model, base: np.ndarray) -> Adam:
    # embeddings move slowly: rare words of few texts would be learnt by heart
    return Adam([model.embedding, *model.filters, model.bias, model.out, base], [EMBEDDING_RATE] + [RATE] * (len(WIDTHS) + 3))


def _train(model: Model, adam: Adam, base: np.ndarray, read: list, labels: np.ndarray) -> None:
    offset, buckets, flat, lengths = 0, [], [], []
    for b, f, n in read:
        buckets.append(b)
        flat.append(f + offset)
        lengths.append(n[0])
        offset += len(b)
    buckets, flat, lengths = np.concatenate(buckets), np.concatenate(flat), np.array(lengths)
    top, where = model.pooled(buckets, flat, lengths)
    ends = np.cumsum(lengths)
    on = np.maximum(top, 0)
    p = _logistic(on @ model.out + base[0])
    d = (p - labels) / len(labels)
    g_out, g_top = on.T @ d, np.outer(d, model.out) * (top > 0)
    rows, grads, g_filters = [], [], []
    for j, (w, k) in enumerate(zip(WIDTHS, model.filters)):
        starts, value = where[j]
        g_k = np.zeros_like(k)
        for i, (s, e) in enumerate(zip(starts, ends)):
            g = g_top[i, j * FILTERS : (j + 1) * FILTERS]
            if not g.any():
                continue
            places = s + value[s:e].argmax(axis=0)
            for o in range(w):
                inside = places + o < e
                ids = buckets[flat[np.minimum(places + o, e - 1)]]
                x = model.embedding[ids].sum(axis=1) * inside[:, None]
                g_k[o] += x.T * g
                gx = (k[o] * g).T * inside[:, None]  # FILTERS x DIM
                rows.append(ids.ravel())
                grads.append(np.repeat(gx, ids.shape[1], axis=0))
        g_filters.append(g_k)
    if rows:
        touched, back = np.unique(np.concatenate(rows), return_inverse=True)
        g_e = np.zeros((len(touched), DIM), np.float32)
        np.add.at(g_e, back, np.concatenate(grads))
    else:
        touched, g_e = np.empty(0, np.int64), np.zeros((0, DIM), np.float32)
    adam.step([(touched, g_e), *g_filters, g_top.sum(axis=0), g_out, np.array([d.sum()], np.float32)])


def best_threshold(scores: np.ndarray, labels: np.ndarray, prior: float = 0.3, weight: float = 2.0, counts: np.ndarray | None = None) -> float:
    """The threshold with the fewest errors, nearest to ``prior`` among equals; ``weight`` texts scored at ``prior`` steady small samples.

    A score stands for as many texts as ``counts`` says, if given.
    """
    if not len(scores) or labels.all() or not labels.any():
        return prior
    cuts = np.unique(np.concatenate([np.sort(scores), [prior, 1.0]]))
    middle = np.concatenate([[prior], (cuts[1:] + cuts[:-1]) / 2])
    middle = middle[(middle >= 0.02) & (middle <= 0.98)]
    order = np.argsort(scores, kind="stable")
    n = (np.ones(len(scores), np.int64) if counts is None else counts)[order]
    toxic = np.concatenate([[0], np.cumsum(n * labels[order])])
    clean = np.concatenate([[0], np.cumsum(n * ~labels[order])])
    below = np.searchsorted(scores[order], middle, side="left")
    errors = toxic[below] + clean[-1] - clean[below] + weight * np.abs(middle - prior)
    return float(middle[errors.argmin()])


@dataclass
class Classifier:
    model: Model
    thresholds: dict[str, float]


def train(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", label: str = "toxic", use: Column | None = None,
          max_toxic: int | None = None, max_clean: int | None = None, max_words: int | None = None) -> Classifier:
    """Fit on all labelled rows of ``docs`` (those with ``use``, if given).

    Null labels and null texts are left out.  Without texts of both classes the model scores every text alike, by their share.
    A caller who gives any of ``max_toxic``, ``max_clean`` (texts) and ``max_words`` (of a class) asks for a trial on a sample of that
    size instead, trained on the driver.
    """
    known = labels.where(F.col(quoted([label])[0]).isin(0, 1)).select(F.col(quoted([id])[0]).alias("__id"), F.col(quoted([label])[0]).cast("int").alias("y"))
    t, language = F.col(quoted([text])[0]).cast("string"), F.col(quoted([lang])[0]) if lang in docs.columns else F.lit(None)
    rows = docs.where(use) if use is not None else docs
    rows = rows.select(F.col(quoted([id])[0]).alias("__id"), t.alias("t"), language.cast("string").alias("lang")).where("t IS NOT NULL")
    most = (max_toxic, max_clean, max_words)
    return _train_on_all(known.distinct(), rows) if most == (None, None, None) else _train_on_some(known, rows, *most)


def _flat(share: float) -> Classifier:
    flat = Model.fresh(np.zeros(BUCKETS, np.float32))
    flat.out[:] = 0
    flat.base = _base(share)
    return Classifier(flat, {FALLBACK: 0.3})


def _train_on_all(known: DataFrame, rows: DataFrame) -> Classifier:
    labelled = rows.join(F.broadcast(known) if known.count() <= SMALL_KEYS else known, "__id")
    parts = max(1, labelled.count() // PART_TEXTS)
    texts = labelled.select("y", "lang", "t", F.xxhash64("__id", "t").alias("h")).mapInArrow(_read, "y int, lang string, held boolean, h long, buckets binary, words binary")
    # the hash is also the order of training
    read = cut_lineage(texts.withColumn("part", F.expr(f"CAST(pmod(h, {parts}) AS int)")).repartition("part").sortWithinPartitions("part", "h", "y"))
    sizes = {(r["y"], r["held"]): r["count"] for r in read.groupBy("y", "held").count().collect()}  # at most four
    n = {held: np.array([sizes.get((y, held), 0) for y in (0, 1)]) for held in (False, True)}
    both = n[False] + n[True]
    if not both.all():
        return _flat(float(both[1] / both.sum()) if both.sum() else 0.0)
    apart = bool(n[False].all() and n[True].any())
    seen, size = (read.where("NOT held"), n[False]) if apart else (read, both)
    share = float(size[1] / size.sum())
    counts = np.zeros((2, BUCKETS), np.float32)
    found = seen.select("y", "buckets").mapInArrow(_count, "y int, bucket int, n long").groupBy("y", "bucket").agg(F.sum("n").alias("n")).toArrow()
    counts[found["y"].to_numpy(), found["bucket"].to_numpy()] = found["n"].to_numpy()
    model = Model.fresh(_odds(counts, share))
    model.base = _base(share)
    for _ in range(EPOCHS if parts == 1 else PASSES):
        _pass(seen.select("part", "y", "buckets", "words"), model, int(size.sum()))
    return Classifier(model, _thresholds(read.where("held"), model) if apart else {FALLBACK: 0.3})


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as word numbers, and whether they are held back for thresholds."""
    reader = Reader(room=100_000)
    for batch in batches:
        for part, texts in blocks(batch, "t", 1_000_000):
            read = [reader([t]) for t in texts]
            held = [xxhash.xxh3_64_intdigest(t) % 5 == 0 for t in texts]
            own = [pa.array([r[i].tobytes() for r in read], pa.binary()) for i in (0, 1)]
            y, lang, h = (part.column(part.schema.get_field_index(c)) for c in ("y", "lang", "h"))
            yield pa.RecordBatch.from_arrays([y, lang, pa.array(held), h, *own], names=["y", "lang", "held", "h", "buckets", "words"])


def _buckets(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, np.int32).reshape(-1, len(PREFIXES) + 1)


def _columns(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    """Values row by row; binary columns one value at a time."""
    return zip(*((v.as_py() for v in batch.column(batch.schema.get_field_index(c))) for c in names))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(y, bucket, n): texts with a bucket, by class."""
    n = np.zeros((2, BUCKETS), np.int64)
    for batch in batches:
        for y, b in _columns(batch, "y", "buckets"):
            n[y, np.unique(_buckets(b))] += 1
    for y in (0, 1):
        at = np.flatnonzero(n[y])
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), y, np.int32)), pa.array(at.astype(np.int32)), pa.array(n[y, at])], names=["y", "bucket", "n"])


def _dense(model: Model) -> list[np.ndarray]:
    return [*model.filters, model.bias, model.out]


def _pass(seen: DataFrame, model: Model, size: int) -> None:
    """One pass: ``model`` moves by the mean of the moves of its copies, each trained on one part, weighted by texts."""
    spark = seen.sparkSession
    shared = spark.sparkContext.broadcast((model.embedding, model.filters, model.bias, model.out, model.base))
    names = [f"d{i}" for i in range(DIM)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        copy = None
        for batch in batches:
            for part, y, b, w in _columns(batch, "part", "y", "buckets", "words"):
                if copy is None or copy.part != part:
                    if copy is not None:
                        yield copy.moved(names)
                    copy = _Copy(shared.value, part)
                copy.add(y, _buckets(b), np.frombuffer(w, np.int32))
        if copy is not None:
            yield copy.moved(names)

    moves = seen.mapInArrow(run, "at int, " + ", ".join(f"{d} double" for d in names)).groupBy("at").agg(*(F.sum(d).alias(d) for d in names)).toArrow()
    at, by = moves["at"].to_numpy(), np.stack([moves[d].to_numpy() for d in names], axis=1) / size
    model.embedding[at[at >= 0]] += by[at >= 0].astype(np.float32)
    dense = np.zeros((-min(0, int(at.min())), DIM))
    dense[-1 - at[at < 0]] = by[at < 0]
    rest = dense.ravel()
    for a in _dense(model):
        a += rest[: a.size].reshape(a.shape).astype(np.float32)
        rest = rest[a.size :]
    model.base += float(rest[0])
    shared.unpersist()


class _Copy:
    """A copy of a model that is trained on one part."""

    def __init__(self, given: tuple, part: int):
        self.given, self.part, self.n, self.words, self.read, self.labels = given, part, 0, 0, [], []
        embedding, filters, bias, out, base = given
        self.model = Model(embedding.copy(), [k.copy() for k in filters], bias.copy(), out.copy(), base)
        self.base = np.array([base], np.float32)
        self.adam = _adam(self.model, self.base)

    def add(self, y: int, buckets: np.ndarray, words: np.ndarray, batch: int = 32) -> None:
        self.read.append((buckets, words, [len(words)]))
        self.labels.append(y)
        self.words += len(words)
        if len(self.read) == batch or self.words >= BATCH_WORDS:
            self.step()

    def step(self) -> None:
        if self.read:
            _train(self.model, self.adam, self.base, self.read, np.array(self.labels, np.float32))
        self.n, self.words, self.read, self.labels = self.n + len(self.read), 0, [], []

    def moved(self, names: list[str]) -> pa.RecordBatch:
        """Rows (at, moves): buckets from 0, the other weights in rows from -1 down, times the texts of the part."""
        self.step()
        embedding, filters, bias, out, base = self.given
        change = self.model.embedding.astype(np.float64) - embedding
        at = np.flatnonzero(change.any(axis=1))
        before = [*filters, bias, out, np.array([base], np.float32)]
        rest = np.concatenate([(a.astype(np.float64) - b).ravel() for a, b in zip([*_dense(self.model), self.base], before)])
        rest = np.pad(rest, (0, -len(rest) % DIM)).reshape(-1, DIM)
        moves = np.concatenate([change[at], rest]) * self.n
        places = np.concatenate([at, -1 - np.arange(len(rest))]).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(places), *(pa.array(moves[:, i].copy()) for i in range(DIM))], names=["at", *names])


def _thresholds(held: DataFrame, model: Model) -> dict[str, float]:
    """The general threshold and one a language, from counts of the scores of all texts held back."""
    shared = held.sparkSession.sparkContext.broadcast((model.embedding, model.filters, model.bias, model.out, model.base))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            scores = [own.score(_buckets(b), np.frombuffer(w, np.int32), np.array([len(w) // 4]))[0] for b, w in _columns(batch, "buckets", "words")]
            steps = pa.array(np.round(np.array(scores, np.float64) * STEPS).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in ("lang", "y")), steps], names=["lang", "y", "step"])

    counts = cut_lineage(held.select("lang", "y", "buckets", "words").mapInArrow(run, "lang string, y int, step int").groupBy("lang", "y", "step").agg(F.count(F.lit(1)).alias("n")))
    every = counts.groupBy("y", "step").agg(F.sum("n").alias("n")).toPandas()  # at most two for each step
    general = best_threshold(every["step"].to_numpy() / STEPS, every["y"].to_numpy() == 1, counts=every["n"].to_numpy())

    def own(rows: pa.Table) -> pa.Table:
        cut = best_threshold(rows["step"].to_numpy() / STEPS, rows["y"].to_numpy() == 1, general, counts=rows["n"].to_numpy())
        return pa.table({"lang": rows["lang"].slice(0, 1), "cut": pa.array([cut], type=pa.float64())})

    by = counts.where("lang IS NOT NULL").groupBy("lang").applyInArrow(own, "lang string, cut double").collect()
    return {FALLBACK: general, **{r["lang"]: r["cut"] for r in sorted(by, key=lambda r: r["lang"])}}


def _train_on_some(known: DataFrame, rows: DataFrame, max_toxic: int | None, max_clean: int | None, max_words: int | None) -> Classifier:
    # the sample is chosen from ids alone, those with the smallest hashes; its texts then come by a broadcast of as many ids
    labelled = known.join(rows.select("__id"), "__id", "left_semi").distinct().withColumn("h", F.xxhash64("__id"))
    reader = Reader(room=20_000)
    read, ys, langs, held = [], [], [], []
    for y, most in ((1, 2000 if max_toxic is None else max_toxic), (0, 4000 if max_clean is None else max_clean)):
        chosen = F.broadcast(labelled.where(F.col("y") == y).orderBy("h", "__id").limit(most))
        size = 0
        for r in rows.join(chosen, "__id").orderBy("h", "__id", "t").limit(most).toLocalIterator():
            one = reader([r["t"]])
            if size + int(one[2][0]) > (6_000_000 if max_words is None else max_words):
                continue  # a later text may fit
            size += int(one[2][0])
            read.append(one)
            ys.append(y)
            langs.append(r["lang"])
            held.append(xxhash.xxh3_64_intdigest(r["t"]) % 5 == 0)
    y = np.array(ys, dtype=np.int64)
    if len(set(ys)) < 2:
        return _flat(float(y.mean()) if len(y) else 0.0)
    held = np.array(held)
    if len(set(y[~held])) < 2 or not held.any():
        held[:] = False
    rest, at = np.flatnonzero(~held), np.flatnonzero(held)
    model = fit([read[i] for i in rest], y[rest])
    thresholds = {FALLBACK: 0.3}
    if len(at):
        scores = np.array([model.score(*read[i])[0] for i in at])
        thresholds[FALLBACK] = best_threshold(scores, y[at] == 1)
        for code in sorted({langs[i] for i in at if langs[i] is not None}):
            own = np.array([langs[i] == code for i in at])
            thresholds[code] = best_threshold(scores[own], y[at][own] == 1, thresholds[FALLBACK])
    return Classifier(model, thresholds)


def score(df: DataFrame, classifier: Classifier, text: str = "text", lang: str = "lang") -> DataFrame:
    """``df`` with double ``score`` (0 to 1), double ``threshold`` (of the row's language) and boolean ``toxic``.

    Null and empty texts, and those without words, get the score of no words; whole texts of any length are scored; repeated rows stay;
    columns with the added names give way; without a language column the general threshold holds.
    """
    m = classifier.model
    shared = df.sparkSession.sparkContext.broadcast((m.embedding, m.filters, m.bias, m.out, m.base))
    kept = adds(df, "score", "threshold", "toxic")
    given, own_text = beside_text(df, kept, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, reader = Model(*shared.value), Reader()
        for batch in batches:
            for part, texts in blocks(batch, own_text, 1_000_000):
                values = pa.array(model.score(*reader(texts)).astype(np.float64))
                yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in kept), values], names=[*kept, "score"])

    scored = given.mapInArrow(run, T.StructType([*(df.schema[c] for c in kept), T.StructField("score", T.DoubleType())]))
    general = F.lit(classifier.thresholds[FALLBACK])
    own = F.lit(None).cast("double")
    if lang.lower() in [c.lower() for c in kept]:
        for code, cut in classifier.thresholds.items():
            own = F.when(F.col(quoted([lang])[0]) == code, cut).otherwise(own) if code != FALLBACK else own
    return scored.withColumn("threshold", F.coalesce(own, general)).withColumn("toxic", F.col("score") >= F.col("threshold"))
