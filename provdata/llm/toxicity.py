"""Toxicity: a convolutional text classifier.

Each word is the sum of hashed embeddings of itself and of its leading 3, 4 and 5 letters, so that
inflected forms share what their stem has learnt. Filters of several widths run over the words, each
filter keeps its maximum over the whole text, and a logistic unit weighs the maxima. All of it is
trained in numpy on a bounded, hash-chosen sample of the labelled rows outside the held-out fold;
the last part of the sample sets the logit's scale and shift, and one threshold per language.

The score reads the text alone. The language only chooses the threshold of the ``toxic`` verdict, and
languages with few labelled rows share the common one.

Scoring is a map over the documents: no shuffle, and one small model per task. Whole texts are
scored in slices of bounded size; a longer text is a slice of its own.

Defined results: null or empty texts get the score of a text without words; a null language has the
common threshold; a document labelled more than once is toxic if any label says so, and null ids or
labels teach nothing; with labels of one class only, or none, every score is the share of toxic ones
(0 without labels); an empty table gives an empty result; equal texts get equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provdata.llm.arrays import slices, words


@dataclass(frozen=True)
class Params:
    buckets: int = 1 << 16
    dims: int = 12
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 6
    #: Bounds of the training sample, in documents.
    most_toxic: int = 2000
    most_clean: int = 4000
    #: Share of the sample that sets scale and thresholds rather than weights.
    calibrate: float = 0.2
    epochs: int = 6
    batch: int = 32
    rate: float = 0.08
    decay: float = 2e-4
    #: A language has its own threshold from so many calibration rows of either class on.
    least_per_language: int = 15
    seed: int = 7


@dataclass
class Model:
    params: Params
    table: np.ndarray | None = None
    kernel: np.ndarray | None = None
    bias: np.ndarray | None = None
    weight: np.ndarray | None = None
    shift: float = 0.0
    scale: float = 1.0
    constant: float = 0.0
    threshold: float = 0.5
    by_language: dict[str, float] = field(default_factory=dict)


def _pieces(dictionary: pa.Array, buckets: int) -> np.ndarray:
    """Buckets of each word and of its 3-, 4- and 5-letter beginnings; the last row is the padding's."""
    plain = pc.replace_substring_regex(pc.utf8_lower(dictionary), r"[^\pL\pN]+", "")
    out = np.zeros((len(dictionary) + 1, 4), np.int64)
    for k, cut in enumerate((None, 3, 4, 5)):
        column = plain if cut is None else pc.utf8_slice_codeunits(plain, 0, cut)
        coded = column.dictionary_encode()
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w, k) % (buckets - 1) + 1
                              for w in coded.dictionary.cast(pa.binary()).to_pylist()), np.int64, len(coded.dictionary))
        out[:-1, k] = hashes[coded.indices.to_numpy()]
    return out


@dataclass
class _Batch:
    """Texts as padded runs of codes: one pad before each text, enough for the widest filter behind it."""

    codes: np.ndarray
    starts: np.ndarray
    tail: np.ndarray


def _layout(offsets: np.ndarray, codes: np.ndarray, pad: int, params: Params) -> _Batch:
    lengths, pads = np.diff(offsets), max(params.widths) - 1
    starts = offsets[:-1] + np.arange(len(lengths)) * (1 + pads)
    padded = np.full(len(codes) + len(lengths) * (1 + pads), pad, np.int64)
    padded[np.arange(len(codes)) + np.repeat(np.arange(len(lengths)) * (1 + pads) + 1, lengths)] = codes
    return _Batch(padded, starts, ((starts + lengths + 1)[:, None] + np.arange(pads)).ravel())


def _responses(batch: _Batch, projected: np.ndarray, params: Params) -> list[np.ndarray]:
    """Of each width, every filter's response at each place; places that reach past a text's pads are out."""
    out, at, n = [], 0, len(batch.codes)
    for width in params.widths:
        response = np.zeros((n, params.filters), np.float32)
        for k in range(width):
            response[:n - k] += projected[batch.codes[k:], at:at + params.filters]
            at += params.filters
        response[batch.tail] = -np.inf
        out.append(response)
    return out


class _Scorer:
    """Logits of texts; keeps what the filters make of the words it has met, up to a fixed number."""

    most = 100_000

    def __init__(self, model: Model):
        self.model, self.places = model, {}
        self.rows = np.zeros((1, model.kernel.shape[1]), np.float32)  # row 0: padding

    def _places(self, dictionary: pa.Array) -> np.ndarray:
        if len(self.places) > self.most:
            self.__init__(self.model)
        plain = dictionary.to_pylist()
        fresh = [w for w in plain if w not in self.places]
        if fresh:
            pieces = _pieces(pa.array(fresh, pa.string()), self.model.params.buckets)[:-1]
            self.places.update(zip(fresh, range(len(self.rows), len(self.rows) + len(fresh))))
            self.rows = np.concatenate([self.rows, self.model.table[pieces].sum(axis=1) @ self.model.kernel])
        return np.fromiter(map(self.places.__getitem__, plain), np.int64, len(plain))

    def logits(self, texts: pa.Array) -> np.ndarray:
        found = words(texts)
        places = self._places(found.dictionary)
        batch = _layout(found.offsets, places[found.codes] if len(places) else found.codes, 0, self.model.params)
        top = np.concatenate([np.maximum.reduceat(r, batch.starts, axis=0)
                              for r in _responses(batch, self.rows, self.model.params)], axis=1)
        return np.maximum(top + self.model.bias, 0) @ self.model.weight[:-1] + self.model.weight[-1]

    def scores(self, texts: pa.Array) -> np.ndarray:
        return _sigmoid((self.logits(texts) * self.model.scale + self.model.shift).astype(np.float64))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def scores(texts: pa.Array, model: Model) -> np.ndarray:
    if model.table is None or not len(texts):
        return np.full(len(texts), model.constant)
    return _Scorer(model).scores(texts)


class _Adagrad:
    def __init__(self, value: np.ndarray, rate: float, decay: float):
        self.value, self.rate, self.decay, self.seen = value, rate, decay, np.full(value.shape, 1e-2, np.float32)

    def step(self, grad: np.ndarray, rows: np.ndarray | slice = slice(None)) -> None:
        grad = grad + self.decay * self.value[rows]
        self.seen[rows] += grad * grad
        self.value[rows] -= self.rate * grad / np.sqrt(self.seen[rows])


def _train_weights(texts: pa.Array, labels: np.ndarray, params: Params) -> Model:
    rng = np.random.default_rng(params.seed)
    spread = params.filters * sum(params.widths)
    total = params.filters * len(params.widths)
    table = rng.normal(0, 0.1, (params.buckets, params.dims)).astype(np.float32)
    table[0] = 0
    model = Model(params, table, rng.normal(0, 0.3, (params.dims, spread)).astype(np.float32), np.zeros(total, np.float32),
                  np.append(rng.normal(0, 0.3, total), 0).astype(np.float32))
    tuned = [_Adagrad(v, params.rate, params.decay) for v in (table, model.kernel, model.bias, model.weight)]
    columns = [(w, f) for w in range(len(params.widths)) for f in range(params.filters)]
    firsts = np.concatenate(([0], np.cumsum([params.filters * w for w in params.widths])))
    found = words(texts)
    pieces = _pieces(found.dictionary, params.buckets)
    for _ in range(params.epochs):
        order = rng.permutation(len(labels))
        for a in range(0, len(order), params.batch):
            pick = order[a:a + params.batch]
            y = labels[pick]
            lengths = found.offsets[pick + 1] - found.offsets[pick]
            own = np.concatenate([found.codes[found.offsets[d]:found.offsets[d + 1]] for d in pick])
            used, codes = np.unique(np.append(own, len(found.dictionary)), return_inverse=True)
            batch = _layout(np.concatenate(([0], np.cumsum(lengths))), codes[:-1], len(used) - 1, params)
            local = pieces[used]
            responses = _responses(batch, table[local].sum(axis=1) @ model.kernel, params)
            ends = np.append(batch.starts[1:], len(batch.codes))
            best = np.stack([np.concatenate([r[s:e].argmax(axis=0) for r in responses]) + s
                             for s, e in zip(batch.starts, ends)])
            top = np.stack([[responses[w][best[d, j], f] for j, (w, f) in enumerate(columns)] for d in range(len(pick))])
            hidden = np.maximum(top + model.bias, 0)
            error = (_sigmoid(hidden @ model.weight[:-1] + model.weight[-1]) - y).astype(np.float32) / len(pick) * 8
            back = error[:, None] * model.weight[:-1] * (hidden > 0)
            kernel_grad, rows, grads = np.zeros_like(model.kernel), [], []
            for j, (w, f) in enumerate(columns):
                live = np.flatnonzero(back[:, j])
                for k in range(params.widths[w] if len(live) else 0):
                    met = local[batch.codes[best[live, j] + k]]
                    column = firsts[w] + k * params.filters + f
                    kernel_grad[:, column] += back[live, j] @ table[met].sum(axis=1)
                    rows.append(met.ravel())
                    grads.append(np.repeat(back[live, j], 4)[:, None] * model.kernel[:, column])
            tuned[3].step(np.append(error @ hidden, error.sum()).astype(np.float32))
            tuned[2].step(back.sum(axis=0))
            tuned[1].step(kernel_grad)
            if rows:
                touched, place = np.unique(np.concatenate(rows), return_inverse=True)
                summed = np.zeros((len(touched), params.dims), np.float32)
                np.add.at(summed, place, np.concatenate(grads))
                tuned[0].step(summed[touched > 0], touched[touched > 0])
    return model


def _platt(logits: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Scale and shift of the logits by weighted logistic regression on smoothed labels, the scale positive."""
    n1, n0 = labels.sum(), (1 - labels).sum()
    target = np.where(labels > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    scale, shift = 1.0, 0.0
    for _ in range(200):
        p = _sigmoid(scale * logits + shift)
        g = weights * (p - target)
        h = np.maximum(weights * p * (1 - p), 1e-9)
        a11, a12, a22 = (h * logits * logits).sum() + 1e-3, (h * logits).sum(), h.sum() + 1e-3
        g1, g2 = (g * logits).sum() + 1e-3 * (scale - 1), g.sum()
        det = a11 * a22 - a12 * a12
        scale = max(0.05, scale - (a22 * g1 - a12 * g2) / det)
        shift -= (a11 * g2 - a12 * g1) / det
    return float(scale), float(shift)


def _best_threshold(found: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> float:
    """The middle of the widest run of thresholds with the least weighted errors."""
    cuts = np.unique(np.concatenate(([0.0, 1.0], found)))
    middles = (cuts[1:] + cuts[:-1]) / 2
    errors = np.array([(weights * ((found >= m) != labels)).sum() for m in middles])
    least = np.flatnonzero(errors <= errors.min() + 1e-9)
    widest = least[np.argmax(cuts[least + 1] - cuts[least])]
    return float(np.clip(middles[widest], 0.05, 0.95))


def train(texts: list[str | None], labels: list[int], languages: list[str | None], params: Params = Params(),
          toxic_share: float | None = None) -> Model:
    """A model of the labelled texts, in the order given; ``toxic_share`` is that of all labels, if the sample is uneven."""
    y = np.array(labels, np.int64)
    share = float(y.mean()) if toxic_share is None and len(y) else toxic_share or 0.0
    if len(set(labels)) < 2:
        return Model(params, constant=share)
    rng = np.random.default_rng(params.seed)
    held = np.zeros(len(y), bool)
    for label in (0, 1):
        own = np.flatnonzero(y == label)
        held[rng.permutation(own)[:int(len(own) * params.calibrate)]] = True
    array = pa.array(texts, pa.string())
    model = _train_weights(array.filter(pa.array(~held)), y[~held].astype(np.float32), params)
    if not 0 < y[held].sum() < held.sum():
        return model
    late = array.filter(pa.array(held))
    scorer = _Scorer(model)
    logits = np.concatenate([scorer.logits(late.slice(k, 64)) for k in range(0, len(late), 64)])
    truth = y[held]
    weights = np.where(truth == 1, share / truth.mean(), (1 - share) / (1 - truth.mean()))
    model.scale, model.shift = _platt(logits.astype(np.float64), truth, weights)
    # The logit is moved so that the common threshold, the one with the fewest errors, is a score of 0.5.
    common = _best_threshold(_sigmoid(model.scale * logits + model.shift), truth, weights)
    model.shift -= float(np.log(common / (1 - common)))
    found = _sigmoid(model.scale * logits + model.shift)
    for lang in sorted({x for x in languages if x is not None}):
        own = np.array([x == lang for x in languages])[held]
        if min(truth[own].sum(), (1 - truth[own]).sum()) >= params.least_per_language:
            model.by_language[lang] = _best_threshold(found[own], truth[own], weights[own])
    return model


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """The fold that labels are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == 0, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, params: Params = Params(), folds: int = 5) -> tuple[list, float]:
    """(text, toxic, lang) of the sample, and the share of toxic labels outside the held-out fold.

    At most ``most_toxic + most_clean`` ids are taken, lowest hash first, before any text is read.
    """
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"), folds))
             .groupBy(F.col("doc_id").cast("long").alias("s_id")).agg(F.max(F.col("toxic").cast("int")).alias("s_toxic")))
    share = known.agg(F.avg("s_toxic")).first()[0] or 0.0
    order = [F.xxhash64(F.lit(params.seed), "s_id"), F.col("s_id")]
    ids = (known.where("s_toxic = 1").orderBy(*order).limit(params.most_toxic)
           .union(known.where("s_toxic = 0").orderBy(*order).limit(params.most_clean)))
    found = (docs.select(F.col("doc_id").alias("t_id"), F.col("text").alias("t_text"), F.col("lang").alias("t_lang"))
             .join(F.broadcast(ids), F.col("t_id") == F.col("s_id")))  # the ids are bounded by parameters
    rows = found.select("s_id", "t_text", "s_toxic", "t_lang").collect()
    rows.sort(key=lambda r: (r["s_id"], r["t_text"] or "", r["t_lang"] or ""))
    return [(r["t_text"], r["s_toxic"], r["t_lang"]) for r in rows], float(share)


def fit(docs: DataFrame, labels: DataFrame, params: Params = Params(), folds: int = 5) -> Model:
    rows, share = training_sample(docs, labels, params, folds)
    if not rows:
        return Model(params, constant=share)
    return train(*map(list, zip(*rows)), params=params, toxic_share=share)


def _score_rows(model: Model, at: int, schema: pa.Schema):
    def run(batches) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(model) if model.table is not None else None
        for batch in slices(batches, "__text", 1 << 20):
            found = scorer.scores(batch["__text"]) if scorer else np.full(batch.num_rows, model.constant)
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(found)], schema=schema)
    return run


def verdict(model: Model, lang: Column, score: Column) -> Column:
    """Whether the score reaches its language's threshold."""
    cut = F.lit(model.threshold)
    for name, value in model.by_language.items():
        cut = F.when(lang == name, F.lit(value)).otherwise(cut)
    return score >= cut


def score_documents(df: DataFrame, model: Model) -> DataFrame:
    """One row per input row: doc_id, lang, score, predicted (score >= 0.5), toxic (by the language's threshold)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    slim = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                     F.col("text").alias("__text"))
    out = slim.drop("__text").withColumn("score", F.lit(0.0)).schema
    for f in out.fields:
        f.nullable = True
    return (slim.mapInArrow(_score_rows(model, 2, to_arrow_schema(out)), out)
            .withColumns({"predicted": (F.col("score") >= 0.5).cast("int"),
                          "toxic": verdict(model, F.col("lang"), F.col("score"))}))


def drop_toxic(df: DataFrame, model: Model) -> DataFrame:
    """The rows of ``df`` below their language's threshold, with all their columns."""
    from pyspark.sql.pandas.types import to_arrow_schema

    renamed = df.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(df.columns)],
                        F.col("text").alias("__text"))
    out = renamed.drop("__text").withColumn("score", F.lit(0.0)).schema
    for f in out.fields:
        f.nullable = True
    lang = F.col(f"c{df.columns.index('lang')}")
    return (renamed.mapInArrow(_score_rows(model, len(df.columns), to_arrow_schema(out)), out)
            .where(~F.coalesce(verdict(model, lang, F.col("score")), F.lit(False)))
            .select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(df.columns)]))
