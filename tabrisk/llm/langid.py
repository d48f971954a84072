"""Language identification of code-switched text by a linear-chain conditional random field.

Every word of a text is labelled: emission scores come from affixes, character
n-grams and a lexicon of learned words, transition scores between neighbouring
words are learned too, and forward-backward gives each word's label
probabilities. A document's language is the one with the largest expected share
of words; that share is the score.

Fitting uses a bounded sample (``DOCS_PER_LANG`` documents and
``SEQS_PER_LANG`` word sequences a language, chosen by hash); prediction runs
over every word of every text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import append, broadcast_if_small, crc_mod, cut_lineage, release, slices

UNKNOWN = "und"
#: Bounds of the training sample.
DOCS_PER_LANG = 300
SEQS_PER_LANG = 500
SEQ_WORDS = 40
#: Words whose forward-backward runs at once; bounds the memory of a task.
FLUSH_WORDS = 200_000
CACHE_WORDS = 200_000
WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """Lower-cased runs of letters; none if the text has no letter (number signs such as a superscript two are not letters)."""
    found = WORD.findall(text.lower())
    return found if any(map(str.isalpha, found)) else []


def features(word: str) -> list[str]:
    """Lexicon entry, prefixes and suffixes up to three letters, and character bigrams and trigrams with word ends."""
    s = f"^{word}$"
    n = len(s)
    out = ["*", "=" + word if n < 34 else "=long", "<" + word[:3], ">" + word[-3:], "<" + word[:2], ">" + word[-2:]]
    out += [s[i : i + 2] for i in range(n - 1)]
    out += [s[i : i + 3] for i in range(n - 2)]
    return out


class Model:
    """Labels, feature weights (row 0 is for unknown features) and transition scores."""

    def __init__(self, labels: list[str], index: dict[str, int], weights: np.ndarray, trans: np.ndarray, start: np.ndarray):
        self.labels, self.index, self.weights, self.trans, self.start = labels, index, weights, trans, start

    def emissions(self, words: list[str]) -> np.ndarray:
        """Emission scores, one row a word."""
        get = self.index.get
        flat: list[int] = []
        ends = np.zeros(len(words), np.int64)
        for k, w in enumerate(words):
            ends[k] = len(flat)
            flat += [get(f, 0) for f in features(w)]
        return np.add.reduceat(self.weights[np.array(flat)], ends, axis=0) if words else np.zeros((0, len(self.labels)))


def forward_backward(e: np.ndarray, lengths: np.ndarray, trans: np.ndarray, start: np.ndarray, pairs: bool = False):
    """Label marginals of sequences laid end to end, longest first; with ``pairs`` also the expected transition counts.

    Probabilities are scaled at each step, so any length is stable.
    """
    e = np.exp(e - e.max(1, keepdims=True))
    a, at = np.exp(trans), np.concatenate(([0], np.cumsum(lengths)[:-1]))
    alive = [int(k) for k in np.searchsorted(-lengths, -np.arange(lengths[0]), "left")] if len(lengths) else []
    alpha, beta = np.empty_like(e), np.ones_like(e)
    cur = np.exp(start)[None, :] * e[at]
    for t, n in enumerate(alive):
        if t:
            cur = (cur[:n] @ a) * e[at[:n] + t]
        cur /= cur.sum(1, keepdims=True)
        alpha[at[:n] + t] = cur
    counts = np.zeros_like(a)
    for t in range(len(alive) - 2, -1, -1):
        n = alive[t + 1]
        i = at[:n] + t
        right = e[i + 1] * beta[i + 1]
        if pairs:
            x = alpha[i][:, :, None] * a[None] * right[:, None, :]
            counts += (x / x.sum((1, 2), keepdims=True)).sum(0)
        b = right @ a.T
        beta[i] = b / b.sum(1, keepdims=True)
    g = alpha * beta
    g /= g.sum(1, keepdims=True)
    return (g, counts) if pairs else g


def sample(docs: DataFrame, text: str, lang: str, key: str, per_lang: int = DOCS_PER_LANG) -> DataFrame:
    """``per_lang`` labelled texts of each language, or all where there are fewer, the smallest by hash; rows that repeat a key and its text are one.

    The distinct texts of a language are counted first (a sketch, good to about a
    twentieth, whose size is fixed); rows then pass only if their hash is in the
    part of the range that holds about eight times the sample, so that just a few
    texts are moved and ordered at any size.
    """
    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.xxhash64(F.col(key), F.col(text)).alias("h")).where("lang is not null and text is not null")
    counts = cut_lineage(rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")))
    rank = F.shiftrightunsigned("h", 11) / float(1 << 53)  # evenly spread over [0, 1)
    few = rows.join(broadcast_if_small(counts), "lang").where(rank < F.lit(8.0 * per_lang) / F.col("n")).select("lang", "h", "text").distinct()
    w = Window.partitionBy("lang").orderBy(rank, "h", "text")
    return few.withColumn("r", F.row_number().over(w)).where(F.col("r") <= per_lang).select("lang", "text")


def _sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
            w = words_of(text)
            seqs = [" ".join(w[i : i + SEQ_WORDS]) for i in range(0, len(w), SEQ_WORDS)]
            if seqs:
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(seqs)), pa.array(seqs)], ["lang", "seq"])


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", epochs: int = 4, rate: float = 0.3, seed: int = 7) -> Model:
    """Fit on labelled rows. No usable row gives a model without labels, which predicts ``und``.

    Each document's words carry its label; half of the training sequences are
    spliced from two languages, so that transitions are learned from switches too.
    """
    few = sample(docs, text, lang, key).mapInArrow(_sequences, "lang string, seq string")
    w = Window.partitionBy("lang").orderBy(F.xxhash64("seq"), "seq")
    got = few.withColumn("r", F.row_number().over(w)).where(F.col("r") <= SEQS_PER_LANG).select("lang", "seq").collect()
    got = sorted((r["lang"], r["seq"]) for r in got)
    labels = sorted({x for x, _ in got})
    if not labels:
        return Model([], {}, np.zeros((1, 0)), np.zeros((0, 0)), np.zeros(0))
    rng = np.random.default_rng(seed)
    seqs = [(s.split(" "), [labels.index(x)] * (s.count(" ") + 1)) for x, s in got]
    order = rng.permutation(len(seqs))
    for i, j in zip(order[0::4], order[1::4]):
        (wi, yi), (wj, yj) = seqs[i], seqs[j]
        a, b = len(wi) // 2, len(wj) // 2
        seqs[i], seqs[j] = (wi[:a] + wj[b:], yi[:a] + yj[b:]), (wj[:b] + wi[a:], yj[:b] + yi[a:])
    seen = Counter(f for ws, _ in seqs for w in ws for f in features(w))
    index = {f: k for k, f in enumerate(sorted(f for f, n in seen.items() if n > 1), 1)}
    model = Model(labels, index, np.zeros((len(index) + 1, len(labels))), np.zeros((len(labels),) * 2), np.zeros(len(labels)))
    ids = {w: np.array([index.get(f, 0) for f in features(w)]) for ws, _ in seqs for w in ws}
    k = len(labels)
    grads = [np.full_like(x, 1e-2) for x in (model.weights, model.trans, model.start)]  # sums of squares, for step sizes
    for _ in range(epochs):
        order = rng.permutation(len(seqs))
        for at in range(0, len(order), 64):
            part = sorted((seqs[i] for i in order[at : at + 64]), key=lambda x: -len(x[0]))
            lengths = np.array([len(x) for x, _ in part])
            words, y = [w for x, _ in part for w in x], np.array([v for _, x in part for v in x])
            feats = [ids[w] for w in words]
            flat, starts = np.concatenate(feats), np.concatenate(([0], np.cumsum([len(f) for f in feats])[:-1]))
            e = np.add.reduceat(model.weights[flat], starts, axis=0)
            g, pairs = forward_backward(e, lengths, model.trans, model.start, pairs=True)
            gold = np.zeros_like(g)
            gold[np.arange(len(y)), y] = 1
            first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
            inner = np.setdiff1d(np.arange(1, len(y)), first)
            np.add.at(pairs := -pairs, (y[inner - 1], y[inner]), 1)
            de = gold - g
            touched, where = np.unique(flat, return_inverse=True)
            dw = np.zeros((len(touched), k))
            np.add.at(dw, where, np.repeat(de, [len(f) for f in feats], axis=0))
            dw -= 1e-3 * model.weights[touched]
            grads[0][touched] += dw**2
            model.weights[touched] += rate * dw / np.sqrt(grads[0][touched])
            for x, d, s in ((model.trans, pairs - 1e-3 * model.trans, grads[1]), (model.start, de[first].sum(0), grads[2])):
                s += d**2
                x += rate * d / np.sqrt(s)
    model.weights[0] = 0
    return model


def _labeller(shared):
    """A task's function: texts to (label, score)."""
    model: Model = shared.value
    k = len(model.labels)
    cache: dict[str, int] = {}
    rows = np.zeros((0, k))

    def flush(texts: list[list[str]], out: np.ndarray, at: list[int]) -> None:
        nonlocal rows, cache
        if len(cache) > CACHE_WORDS:
            cache, rows = {}, np.zeros((0, k))
        new = list({w for ws in texts for w in ws if w not in cache})
        for i in range(0, len(new), 20_000):
            part = new[i : i + 20_000]
            cache.update(zip(part, range(len(rows), len(rows) + len(part))))
            rows = np.concatenate([rows, model.emissions(part)])
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        lengths = np.array([len(texts[i]) for i in order])
        ids = np.fromiter((cache[w] for i in order for w in texts[i]), np.int64, lengths.sum())
        g = forward_backward(rows[ids], lengths, model.trans, model.start)
        share = np.add.reduceat(g, np.concatenate(([0], np.cumsum(lengths)[:-1])), axis=0) / lengths[:, None]
        out[[at[i] for i in order]] = share

    def batch(texts: list) -> list[pa.Array]:
        out = np.zeros((len(texts), max(k, 1)))
        part, at, n = [], [], 0
        for i, t in enumerate(texts):
            ws = words_of(t.decode("utf-8", "replace")) if t and k else []
            if ws:
                part.append(ws)
                at.append(i)
                n += len(ws)
            if part and (n >= FLUSH_WORDS or i + 1 == len(texts)):
                flush(part, out, at)
                part, at, n = [], [], 0
        if part:
            flush(part, out, at)
        score = out.max(1)
        return [pa.array([model.labels[j] if s > 0 else UNKNOWN for j, s in zip(out.argmax(1), score)], pa.string()), pa.array(np.minimum(score, 1.0))]

    return batch


def predict(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """``keep``, lang_pred and score for each row, whatever its length.

    Null texts and texts without a letter are ``und`` with score 0. Nothing but
    the text enters a prediction. Repeated rows are labelled each; languages that
    hold equal shares give the smallest label; an empty table stays empty. The model (bounded by the training sample) is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return append(docs, keep, text, "lang_pred string, score double", lambda: _labeller(shared))


def held_out(key: str = "doc_id"):
    """Rows kept from learning: crc32 of the id's text modulo 4 is 2 (a null id is not held out)."""
    return F.coalesce(crc_mod(key, 4) == 2, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Learn from the labelled rows that are not held out and label every row: id, held_out, lang_pred, score."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    model = fit(rows.where(~held_out()))
    return predict(rows.withColumn("held_out", held_out()), model, ["doc_id", "held_out"]).withColumnRenamed("doc_id", id_col)


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` (all columns) in which one language holds at least ``least`` of the words.

    Texts that are null or have no letter go.
    """
    model = fit(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang")).where(~held_out()))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label = _labeller(shared)
        for b in (part for whole in batches for part in slices(whole)):
            lang_pred, score = label(b.column(at).cast(pa.binary()).to_pylist())
            ok = [x != UNKNOWN and s >= least for x, s in zip(lang_pred.to_pylist(), score.to_pylist())]
            yield b.filter(pa.array(ok, pa.bool_()))
        del label
        release()

    return docs.mapInArrow(run, docs.schema)
