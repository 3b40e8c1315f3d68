"""Toxicity: a convolutional text classifier trained in numpy.

A word's embedding is the sum of hashed embeddings of the word and of its
prefixes, so that unseen words of a seen stem are recognised.  Filters of
widths 1, 2 and 3 slide over the words of the whole text, each keeps its
maximum, and a linear layer over the rectified maxima gives a logit.  The
first embedding coordinate starts as the shrunken log odds of the feature
among labelled texts (from one part of the sample), the others at random; all
weights are then trained by Adam on a second part.

The thresholds, one per language, come from all labelled rows that are not
held out, at the true rate of toxic texts: Spark scores them and counts them
per language and logit (steps of ``1 / STEPS``), and the driver reads these
counts.  A language with fewer than ``LEAST`` rows of either label takes the
threshold of all rows.

The language of a text is guessed from its function words, never read from a
column.  The score is the logistic of the logit shifted so that the language's
threshold falls on ``CUT``; it only depends on the text.

The weights are fitted on the driver from at most ``MAX_TOXIC`` + ``MAX_CLEAN``
labelled rows (hash-ordered, so runs agree); ``classify`` scores all documents
in one pass and only shuffles the labelled rows' ids and logits.  A worker remembers the filter responses of up
to ``REMEMBER`` words, which changes no score.

Defined results: a null or empty text gets the score of a text without words;
repeated rows are scored each; without labels of both kinds every score is 0;
an empty table gives an empty table; only doc_id and text are read for scores.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

CUT = 0.7
MAX_TOXIC, MAX_CLEAN = 3000, 6000     # rows of each label that the weights are fitted on
STEPS, FAR, LEAST = 64, 64, 10        # of the logits' histogram: steps a unit, its end, rows of either label for a language's own threshold
BUCKETS, DIM, FILTERS, WIDTHS = 1 << 18, 12, 8, (1, 2, 3)
PREFIXES = (3, 4, 5, 6)
SHRINK = 10.0
EPOCHS, RATE, SEED = 3, 0.01, 3
REMEMBER = 150_000
TOKEN = re.compile(r"\w+")

# Function words that tell the languages apart.
LANGUAGES = {
    "en": "the of and to in is that for it with as was on are be this by from at or".split(),
    "de": "der die und zu den das von mit nicht ist ein eine auf für als auch im des dem sich".split(),
    "fr": "le les et des un une du qui dans pour pas est au sur par ce avec elle sont cette".split(),
    "es": "el los las y en por para con se del una que lo como más pero sus es al su".split(),
}


def tokens(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


def features(word: str) -> list[int]:
    """Hash buckets of a word and its prefixes (a fixed number, repeated prefixes point to bucket 0)."""
    out = [1 + zlib.crc32(("w" + word).encode()) % (BUCKETS - 1)]
    for k in PREFIXES:
        out.append(1 + zlib.crc32(f"{k}{word[:k]}".encode()) % (BUCKETS - 1) if len(word) >= k else 0)
    return out


@dataclass
class Model:
    embedding: np.ndarray
    filters: list[np.ndarray]                 # per width: (width, DIM, FILTERS)
    bias: np.ndarray                          # one per filter
    out: np.ndarray
    out_bias: float
    cuts: dict[str, float] = field(default_factory=dict)
    fitted: bool = False

    def projection(self) -> np.ndarray:
        """(DIM, responses): all filters' weights side by side, offset by offset."""
        return np.concatenate([f[k] for f in self.filters for k in range(f.shape[0])], axis=1)


def language(hits: np.ndarray) -> str:
    return list(LANGUAGES)[int(hits.argmax())] if hits.any() else "other"


class Scorer:
    """Logits and languages of texts with remembered word responses."""

    def __init__(self, model: Model):
        self.m, self.proj = model, model.projection()
        self.words: dict[str, int] = {}
        self.rows = np.zeros((0, self.proj.shape[1] + len(LANGUAGES)), np.float32)
        self.sets = [frozenset(w) for w in LANGUAGES.values()]

    def _learn(self, new: list[str]) -> None:
        if len(self.words) + len(new) > REMEMBER:
            self.words, self.rows = {}, self.rows[:0]
        f = np.array([features(w) for w in new])
        x = self.m.embedding[f].sum(axis=1)
        lang = np.array([[w in s for s in self.sets] for w in new], np.float32)
        at = len(self.words)
        self.words.update((w, at + k) for k, w in enumerate(new))
        self.rows = np.concatenate([self.rows[:at], np.concatenate([x @ self.proj, lang], axis=1).astype(np.float32)])

    def __call__(self, texts: list[str]) -> list[tuple[float, str]]:
        cut = [tokens(t) for t in texts]
        every = set().union(*cut)
        new = [w for w in every if w not in self.words]
        if new:
            if len(self.words) + len(new) > REMEMBER:     # start over with what this batch needs
                self.words = {}
                self.rows = self.rows[:0]
                new = list(every)
            self._learn(new)
        return [self._one(np.fromiter(map(self.words.__getitem__, c), np.int64, len(c))) for c in cut]

    def _one(self, idx: np.ndarray) -> tuple[float, str]:
        n_resp = self.proj.shape[1]
        rows = self.rows[idx]
        lang = language(rows[:, n_resp:].sum(axis=0)) if len(idx) else "other"
        if len(rows) < max(WIDTHS):
            rows = np.concatenate([rows, np.zeros((max(WIDTHS) - len(rows), self.rows.shape[1]), np.float32)])
        best, col = [], 0
        for w in WIDTHS:
            n = len(rows) - w + 1
            acc = rows[:n, col:col + FILTERS]
            for k in range(1, w):
                acc = acc + rows[k:k + n, col + k * FILTERS:col + (k + 1) * FILTERS]
            best.append(acc.max(axis=0))
            col += w * FILTERS
        h = np.maximum(np.concatenate(best) + self.m.bias, 0)
        return float(h @ self.m.out + self.m.out_bias), lang


class _Coded:
    """Texts as arrays of word numbers, with the feature buckets of every word."""

    def __init__(self, texts: list[str]):
        number: dict[str, int] = {}
        self.docs = [np.array([number.setdefault(w, len(number)) for w in tokens(t)], np.int32) for t in texts]
        self.features = np.array([features(w) for w in number] or [[0] * (1 + len(PREFIXES))], np.int32)


def _log_odds(coded: _Coded, rows: np.ndarray, y: np.ndarray) -> np.ndarray:
    n = np.zeros((2, BUCKETS))
    for k, label in zip(rows, y):
        n[label, np.unique(coded.features[np.unique(coded.docs[k])])] += 1
    base = y.mean()
    p = (n[1] + SHRINK * base) / (n.sum(axis=0) + SHRINK)
    out = np.log(p / (1 - p)) - np.log(base / (1 - base))
    out[0] = 0
    return out


def fit(texts: list[str], labels: list[int]) -> Model:
    """The model of labelled texts, without thresholds (see the module's text)."""
    rng = np.random.default_rng(SEED)
    y = np.array(labels, np.int64)
    shape = dict(embedding=rng.normal(0, 0.05, (BUCKETS, DIM)).astype(np.float32),
                 filters=[rng.normal(0, 0.2, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS],
                 bias=np.zeros(FILTERS * len(WIDTHS)), out=rng.normal(0, 0.1, FILTERS * len(WIDTHS)), out_bias=0.0)
    m = Model(**shape)
    if not 0 < y.sum() < len(y):
        return m
    part = rng.permutation(len(y))
    coded = _Coded(texts)
    stats, train = np.split(part, [int(0.55 * len(y))])
    for p in (stats, train):                  # tiny samples: every part needs both labels
        if not 0 < y[p].sum() < len(p):
            stats = train = part
            break
    m.embedding[:, 0] = _log_odds(coded, stats, y[stats]) / 5
    m.embedding[0] = 0
    for j, w in enumerate(WIDTHS):
        m.filters[j][:, 0, :FILTERS // 2] = 1 / w
        m.out[j * FILTERS:j * FILTERS + FILTERS // 2] = 0.3
    m.fitted = True
    _train(m, coded, train, y[train], rng)
    return m


def _train(m: Model, coded: _Coded, rows_of: np.ndarray, y: np.ndarray, rng) -> None:
    idx, feats = [coded.docs[k] for k in rows_of], coded.features
    weight = np.where(y == 1, len(y) / (2 * max(1, y.sum())), len(y) / (2 * max(1, (1 - y).sum())))
    params = [*m.filters, m.bias, m.out]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    grads, held = [np.zeros_like(p) for p in params], 0
    n_w = max(WIDTHS)
    for _ in range(EPOCHS):
        for d in rng.permutation(len(idx)):
            f = feats[idx[d]]
            if len(f) < n_w:
                f = np.concatenate([f, np.zeros((n_w - len(f), feats.shape[1]), np.int32)])
            x = m.embedding[f].sum(axis=1)
            z, at = [], []
            for fil in m.filters:
                n = len(x) - fil.shape[0] + 1
                c = sum(x[k:k + n] @ fil[k] for k in range(fil.shape[0]))
                a = c.argmax(axis=0)
                at.append(a)
                z.append(c[a, np.arange(FILTERS)])
            z = np.concatenate(z) + m.bias
            h = np.maximum(z, 0)
            p = 1 / (1 + np.exp(-np.clip(h @ m.out + m.out_bias, -30, 30)))
            g = weight[d] * (p - y[d])
            dz = g * m.out * (z > 0)
            grads[-1] += g * h
            grads[-2] += dz
            m.out_bias -= RATE * g / 8
            for j, fil in enumerate(m.filters):
                dj = dz[j * FILTERS:(j + 1) * FILTERS]
                for k in range(fil.shape[0]):
                    rows = at[j] + k
                    grads[j][k] += x[rows].T * dj
                    back = (fil[k] * dj).T                     # gradient of the words at those places
                    np.add.at(m.embedding, f[rows], -RATE * 0.2 * back[:, None, :])
            m.embedding[0] = 0
            held += 1
            if held == 8:
                step += 1
                for q, (par, gr) in enumerate(zip(params, grads)):
                    gr /= held
                    first[q] = 0.9 * first[q] + 0.1 * gr
                    second[q] = 0.999 * second[q] + 0.001 * gr * gr
                    par -= RATE * (first[q] / (1 - 0.9 ** step)) / (np.sqrt(second[q] / (1 - 0.999 ** step)) + 1e-8)
                    gr[:] = 0
                held = 0


def _best_cut(bins: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> float:
    """The middle of the widest range of thresholds of the best F1 over a histogram of logits."""
    order = np.argsort(-bins)
    s, t, n = bins[order].astype(float), toxic[order], (toxic + clean)[order]
    f1 = 2 * np.cumsum(t) / (np.cumsum(n) + t.sum())
    gap = s - np.r_[s[1:], s[-1] - 2 * STEPS]
    best = np.flatnonzero(f1 >= f1.max() - 1e-12)
    k = best[gap[best].argmax()]
    return float(s[k] - (gap[k] - 1) / 2) / STEPS


def calibrate(m: Model, rows: DataFrame, known: DataFrame) -> None:
    """Thresholds from all rows (of ``logits``) that have a label in ``known``."""
    if not m.fitted:
        return
    step = F.floor(F.greatest(F.least(F.col("logit"), F.lit(float(FAR))), F.lit(float(-FAR))) * STEPS)
    per = rows.filter(~held_out()).groupBy("doc_id", "lang", step.alias("bin")).agg(F.count("*").alias("n")).join(known, "doc_id")
    counts = per.groupBy("lang", "bin").agg(F.sum(F.col("toxic") * F.col("n")).alias("toxic"),
                                            F.sum((1 - F.col("toxic")) * F.col("n")).alias("clean")).toPandas()
    total = counts.groupby("bin", as_index=False)[["toxic", "clean"]].sum()
    m.cuts = {"*": _best_cut(*(total[c].to_numpy() for c in ("bin", "toxic", "clean")))}
    for g, h in counts.groupby("lang"):
        if min(h["toxic"].sum(), h["clean"].sum()) >= LEAST:
            m.cuts[g] = _best_cut(*(h[c].to_numpy() for c in ("bin", "toxic", "clean")))


def score_of(m: Model, logit: Column, lang: Column) -> Column:
    if not m.fitted:
        return F.lit(0.0)
    cut = F.lit(m.cuts["*"])
    for g, c in sorted(m.cuts.items()):
        cut = F.when(lang == g, F.lit(c)).otherwise(cut)
    shifted = logit - cut + float(np.log(CUT / (1 - CUT)))
    return 1 / (1 + F.exp(-F.greatest(F.least(shifted, F.lit(30.0)), F.lit(-30.0))))


def held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1


def _known(labels: DataFrame) -> DataFrame:
    """doc_id, toxic: the labels that are not held out, one of each doc_id."""
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter(F.col("toxic").isin(0, 1) & ~held_out())
    return known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))


def _fitted(docs: DataFrame, known: DataFrame) -> Model:
    """Fit the weights on the labelled rows, up to the bounds of the module."""
    order = F.xxhash64("doc_id")
    chosen = known.filter("toxic = 1").orderBy(order, "doc_id").limit(MAX_TOXIC).unionByName(
        known.filter("toxic = 0").orderBy(order, "doc_id").limit(MAX_CLEAN))
    # One text per doc_id, combined map-side: rows that repeat an id stay within the bound.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(
        F.min("text").alias("text"), F.max("toxic").alias("toxic")).toPandas().sort_values("doc_id")
    return fit([t or "" for t in rows["text"]], rows["toxic"].astype(int).tolist())


def logits(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, logit and lang (the guessed language) of every row."""
    def run(batches):
        scorer = Scorer(model)
        for b in batches:
            for at in range(0, b.num_rows, 200):
                part = b.slice(at, 200)
                got = scorer([t or "" for t in part.column("text").to_pylist()])
                yield pa.record_batch({"doc_id": part.column("doc_id"), "logit": pa.array([x for x, _ in got], pa.float64()),
                                       "lang": pa.array([g for _, g in got], pa.string())})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, logit double, lang string")


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """The weights from a sample, the thresholds from all labelled rows, without the held-out ones."""
    known = _known(labels)
    model = _fitted(docs, known)
    if model.fitted:
        calibrate(model, logits(docs.filter(~held_out()), model), known)
    return model


def _scores(rows: DataFrame, model: Model) -> DataFrame:
    out = rows.select("doc_id", held_out().alias("held_out"), score_of(model, F.col("logit"), F.col("lang")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    return _scores(logits(docs, model), model)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``score`` by the model of ``train``, with one pass over the texts for both."""
    known = _known(labels)
    model = _fitted(docs, known)
    rows = written(logits(docs, model), "logits")
    calibrate(model, rows, known)
    return _scores(rows, model)
