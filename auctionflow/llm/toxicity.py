"""Toxic spans by a linear-chain conditional random field.

Labels are given for documents.  Words of toxic training documents become labelled tokens where one of their features
(the word, or its first 3 to 9 letters) is tied to the toxic label beyond chance; all other tokens are clean.  A CRF with
two states learns emission weights of the features and the transitions from these sequences.  Forward-backward gives
each token's marginal; the marginals add up to document scores (by a logistic fit on the training documents) and the
tokens at one half or more are the offending spans.

The recursions run over whole batches at once: the texts are one long chain that forgets its state where a document
begins, cut into blocks that advance side by side.
"""

from __future__ import annotations

import math
import pickle
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auctionflow.llm.minhash import band_keys, shingle_set, sketches
from auctionflow.llm.shared import texts, tidy

_TOKEN = re.compile(r"[^\W\d_]+")
PREFIXES = (3, 4, 5, 6, 7, 8, 9)
#: Labelled training documents at most, chosen by hash of the id whatever their label (the labels' shares are part of the
#: evidence).  All of them but copies fit the CRF, in groups of documents of about so many tokens, which bounds its memory.
TRAIN_DOCS = 6000
GROUP_TOKENS = 200_000
#: Texts of this Jaccard similarity of three-word shingles are copies.
COPY = 0.8
#: How much more frequent a telling feature is in toxic documents.
LIFT = 5
#: Words whose emission a worker remembers.
MOST_WORDS = 150_000


def tokens(text: str) -> list[str]:
    return [w.lower() for w in _TOKEN.findall(text)]


def features(word: str) -> list[str]:
    return [f"={word}", *(word[:k] for k in PREFIXES if len(word) >= k)]


# --- forward-backward ------------------------------------------------------------


def marginals(emission: np.ndarray, first: np.ndarray, start: np.ndarray, trans: np.ndarray, pairs: bool = False):
    """P(toxic) of every token; with ``pairs`` also the expected transitions (2 x 2) within documents.

    ``emission`` is the toxic state's log weight (the clean state's is 0), ``first`` marks tokens that begin a document,
    ``start`` and ``trans`` (from, to) are weights, not logs.
    """
    n = len(emission)
    if not n:
        return (np.empty(0), np.zeros((2, 2))) if pairs else np.empty(0)
    length = max(1, int(math.sqrt(n)))
    blocks = -(-n // length)
    pad = blocks * length - n
    cut = lambda x, fill: np.concatenate([x, np.full(pad, fill, dtype=x.dtype)]).reshape(blocks, length).T.copy()
    new = cut(first, True)
    psi = np.exp(np.clip(cut(emission, 0.0), -30, 30))
    # step matrix of a token: [from][to]; a first token's doesn't depend on where it comes from
    step = [[np.where(new, start[j], trans[i, j]) * (psi if j else 1.0) for j in (0, 1)] for i in (0, 1)]

    p00, p01, p10, p11 = np.ones(blocks), np.zeros(blocks), np.zeros(blocks), np.ones(blocks)
    for t in range(length):
        a, b, c, d = step[0][0][t], step[0][1][t], step[1][0][t], step[1][1][t]
        p00, p01, p10, p11 = p00 * a + p01 * c, p00 * b + p01 * d, p10 * a + p11 * c, p10 * b + p11 * d
        if t % 8 == 7 or t == length - 1:
            total = p00 + p01 + p10 + p11
            p00, p01, p10, p11 = p00 / total, p01 / total, p10 / total, p11 / total
    into, back = np.empty((blocks, 2)), np.empty((blocks, 2))
    v0, v1 = start
    whole = list(zip(p00.tolist(), p01.tolist(), p10.tolist(), p11.tolist()))
    for k, (a, b, c, d) in enumerate(whole):
        into[k] = v0, v1
        v0, v1 = v0 * a + v1 * c, v0 * b + v1 * d
        total = v0 + v1
        v0, v1 = v0 / total, v1 / total
    v0 = v1 = 1.0
    for k in range(blocks - 1, -1, -1):
        back[k] = v0, v1
        a, b, c, d = whole[k]
        v0, v1 = a * v0 + b * v1, c * v0 + d * v1
        total = v0 + v1
        v0, v1 = v0 / total, v1 / total

    alpha0, alpha1 = np.empty((length, blocks)), np.empty((length, blocks))
    f0, f1 = into.T
    for t in range(length):
        f0, f1 = f0 * step[0][0][t] + f1 * step[1][0][t], f0 * step[0][1][t] + f1 * step[1][1][t]
        total = f0 + f1
        f0, f1 = f0 / total, f1 / total
        alpha0[t], alpha1[t] = f0, f1
    out = np.empty((length, blocks))
    beta = np.empty((2, length, blocks)) if pairs else None
    b0, b1 = back.T
    for t in range(length - 1, -1, -1):
        if pairs:
            beta[0, t], beta[1, t] = b0, b1
        toxic = alpha1[t] * b1
        out[t] = toxic / (toxic + alpha0[t] * b0)
        b0, b1 = step[0][0][t] * b0 + step[0][1][t] * b1, step[1][0][t] * b0 + step[1][1][t] * b1
        total = b0 + b1
        b0, b1 = b0 / total, b1 / total
    flat = out.T.reshape(-1)[:n]
    if not pairs:
        return flat
    before = [np.concatenate([x, a.T.reshape(-1)[:-1]]) for x, a in ((np.zeros(1), alpha0), (np.zeros(1), alpha1))]
    joint = np.array([[before[i] * step[i][j].T.reshape(-1) * beta[j].T.reshape(-1) for j in (0, 1)] for i in (0, 1)])[:, :, :n]
    joint = joint[:, :, ~first]
    return flat, (joint / np.maximum(joint.sum(axis=(0, 1)), 1e-300)).sum(axis=2)


# --- the model -------------------------------------------------------------------


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -8.0
    start: tuple[float, float] = (0.5, 0.5)
    trans: tuple[tuple[float, float], tuple[float, float]] = ((0.5, 0.5), (0.5, 0.5))
    logistic: tuple[float, ...] = (-6.0, 0.0, 0.0, 0.0)

    def emission(self, word: str) -> float:
        return self.bias + sum(self.weights.get(f, 0.0) for f in features(word))

    def marginals(self, emission: np.ndarray, first: np.ndarray) -> np.ndarray:
        return marginals(emission, first, np.array(self.start), np.array(self.trans))

    def score(self, aggregates: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(np.column_stack([np.ones(len(aggregates)), aggregates]) @ np.array(self.logistic), -500, 500)))


def aggregated(p: np.ndarray, owner: np.ndarray, docs: int) -> np.ndarray:
    """Per document: log(1 + expected toxic tokens), the log of their smoothed rate and the largest marginal."""
    total = np.bincount(owner, weights=p, minlength=docs)
    size = np.bincount(owner, minlength=docs)
    most = np.zeros(docs)
    np.maximum.at(most, owner, p)
    return np.column_stack([np.log1p(total), np.log((total + 0.2) / (size + 50)) + 5, most])


def telling(docs: list[list[str]], labels: np.ndarray) -> set[str]:
    """Features tied to the toxic label: they are ``LIFT`` times as frequent in toxic documents as in clean ones, at
    least a third of their occurrences are there, and the likelihood ratio of their documents against chance is beyond
    2 log(number of features tried).  A document with n occurrences counts 1 + log(n) times there."""
    base = float(np.clip(labels.mean(), 1e-6, 1 - 1e-6))
    found: dict[int, tuple[Counter, Counter]] = {1: (Counter(), Counter()), 0: (Counter(), Counter())}  # documents' weight, occurrences
    seen: Counter = Counter()
    tried: set[str] = set()
    for label in (1, 0):
        in_docs, in_all = found[label]
        for words, own in zip(docs, labels):
            if own == label:
                here: Counter = Counter()
                for word, n in Counter(words).items():
                    for f in features(word):
                        if label or f in tried:
                            here[f] += n
                in_all.update(here)
                in_docs.update({f: 1 + math.log(n) for f, n in here.items()})
                if label:
                    seen.update(here.keys())
        if label:
            tried = {f for f, n in seen.items() if n >= 3}
    least = 2 * math.log(len(tried) + 2)
    chosen = set()
    for f in tried:
        k, n = found[1][0][f], found[1][0][f] + found[0][0][f]
        rate = k / n
        toxic, clean = found[1][1][f], found[0][1][f]
        if rate <= base or 2 * toxic < clean or toxic * (1 - base) < LIFT * clean * base:
            continue
        gain = 2 * (k * math.log(rate / base) + ((n - k) * math.log((1 - rate) / (1 - base)) if k < n else 0.0))
        if gain >= least:
            chosen.add(f)
    return chosen


def without_copies(rows: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """The texts that are not alike (``COPY``) an earlier one that was kept: copies are no further evidence.

    Ten bands of four find the candidates (99.5 percent of the pairs at 0.8); their whole shingle sets decide.
    """
    holders: dict[int, list[int]] = {}
    kept: list[np.ndarray] = []
    out = []
    for start in range(0, len(rows), 500):
        part = rows[start:start + 500]
        sets = [shingle_set(text, 3) for text, _ in part]
        for row, own, keys in zip(part, sets, band_keys(sketches(sets, 40), 4).tolist()):
            if len(own):
                alike = {i for k in keys for i in holders.get(k, ())}
                if any(_alike(own, kept[i]) for i in alike):
                    continue
                for k in keys:
                    holders.setdefault(k, []).append(len(kept))
                kept.append(own)
            out.append(row)
    return out


def _alike(a: np.ndarray, b: np.ndarray) -> bool:
    if min(len(a), len(b)) < COPY * max(len(a), len(b)):
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared >= COPY * (len(a) + len(b) - shared)


def fit(rows: list[tuple[str, int]], steps: int = 40, ridge: float = 1e-3) -> Model:
    """The model of labelled texts (text, 0 or 1).  Without both labels nothing can be learned: every score is low."""
    rows = without_copies(rows)
    labels = np.array([int(bool(y)) for _, y in rows], dtype=np.int64)
    if not len(rows) or labels.min() == labels.max():
        return Model()
    same: dict[str, str] = {}
    docs = [[same.setdefault(w, w) for w in tokens(text)] for text, _ in rows]
    chosen = telling(docs, labels)
    if not chosen:
        return Model()
    names = sorted(chosen)
    index = {f: i for i, f in enumerate(names)}
    vocab: dict[str, int] = {}
    sequence = np.fromiter((vocab.setdefault(w, len(vocab)) for words in docs for w in words), dtype=np.int32)
    sizes = [len(words) for words in docs if words]
    begins = np.cumsum([0, *sizes[:-1]])
    first = np.zeros(len(sequence), dtype=bool)
    first[begins] = True
    cuts = [*begins[np.append(True, np.diff(begins // GROUP_TOKENS) > 0)].tolist(), len(sequence)]
    groups = [slice(lo, hi) for lo, hi in zip(cuts[:-1], cuts[1:])]
    rows_of, columns = [], []
    for word, v in vocab.items():
        for f in features(word):
            if f in index:
                rows_of.append(v)
                columns.append(index[f])
    rows_of, columns = np.array(rows_of, dtype=np.int64), np.array(columns, dtype=np.int64)
    marked = np.zeros(len(vocab), dtype=bool)
    marked[rows_of] = True
    y = marked[sequence] & np.repeat(labels.astype(bool), [len(words) for words in docs])
    inner = ~first[1:]
    observed = np.array([[(inner & (y[:-1] == i) & (y[1:] == j)).sum() for j in (False, True)] for i in (False, True)], dtype=float)
    weights, bias = np.zeros(len(names) + 1), -4.0
    weights[-1] = bias
    logs = np.log((observed + 1) / (observed + 1).sum(axis=1, keepdims=True))
    begin = np.array([(~y[first]).sum() + 1.0, y[first].sum() + 1.0])
    begin /= begin.sum()
    m1, m2 = np.zeros(len(weights) + 4), np.zeros(len(weights) + 4)
    for k in range(1, steps + 1):
        by_word = np.bincount(rows_of, weights=weights[columns], minlength=len(vocab)) + weights[-1]
        off, expected = np.zeros(len(vocab)), np.zeros((2, 2))
        for own in groups:
            p, pairs = marginals(by_word[sequence[own]], first[own], begin, np.exp(logs), pairs=True)
            off += np.bincount(sequence[own], weights=y[own] - p, minlength=len(vocab))
            expected += pairs
        gradient = np.concatenate([np.bincount(columns, weights=off[rows_of], minlength=len(names)), [off.sum()], (observed - expected).reshape(-1)])
        gradient -= ridge * np.concatenate([weights, logs.reshape(-1)])
        m1, m2 = 0.9 * m1 + 0.1 * gradient, 0.99 * m2 + 0.01 * gradient ** 2
        move = 0.3 * (m1 / (1 - 0.9 ** k)) / (np.sqrt(m2 / (1 - 0.99 ** k)) + 1e-8)
        weights = np.clip(weights + move[:len(weights)], -12, 12)
        logs = np.clip(logs + move[len(weights):].reshape(2, 2) * 0.3, -12, 12)
    model = Model(dict(zip(names, weights[:-1].tolist())), float(weights[-1]), tuple(begin.tolist()), tuple(tuple(r) for r in np.exp(logs).tolist()))
    x = np.concatenate([_scored(model, docs[i:i + 500])[1] for i in range(0, len(docs), 500)])
    model.logistic = tuple(_logistic(x, labels))
    return model


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, steps: int = 50) -> np.ndarray:
    """Ridge logistic regression by Newton's method; the first coefficient is the constant."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (y - p) - ridge * w
        move = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), gradient)
        w += np.clip(move, -3, 3)
        if np.abs(move).max() < 1e-8:
            break
    return w


class _Emissions(dict):
    def __init__(self, model: Model):
        self.model = model

    def __missing__(self, word: str) -> float:
        if len(self) >= MOST_WORDS:
            self.clear()
        value = self[word] = self.model.emission(word.lower())
        return value


def _scored(model: Model, docs: list[list[str]], emissions: dict | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marginals of all tokens, aggregates of all documents, and each token's document."""
    emissions = _Emissions(model) if emissions is None else emissions
    sizes = np.array([len(d) for d in docs], dtype=np.int64)
    emission = np.fromiter((e for d in docs for e in map(emissions.__getitem__, d)), dtype=float, count=int(sizes.sum()))
    owner = np.repeat(np.arange(len(docs)), sizes)
    first = np.append(True, owner[1:] != owner[:-1]) if len(owner) else np.empty(0, bool)
    p = model.marginals(emission, first)
    return p, aggregated(p, owner, len(docs)), owner


# --- Spark -----------------------------------------------------------------------


def held_out(doc: str = "doc_id"):
    """Rows that no label is learned from: crc32 of the id as text, modulo 4, is 2.  Null ids are not held out."""
    return F.coalesce(F.crc32(F.col(doc).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS) -> Model:
    """Fit on labelled documents that are not held out: at most ``most``, chosen by hash of the id.

    The bound keeps the memory of the one task that fits the model fixed; it is a parameter.  Rows of ``labels`` with
    null id or label don't count; an id labelled twice takes the larger label.  The model comes back as a few hundred
    weights.
    """
    known = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    chosen = known.where(~held_out()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)  # ``most`` narrow rows
    of = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = of.join(F.broadcast(chosen), "doc_id").select(F.xxhash64("doc_id").alias("h"), "doc_id", "text", "toxic")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, before = [], None
        for batch in batches:
            for doc, text, label in zip(batch.column(1).to_pylist(), texts(batch.column(2)), batch.column(3).to_pylist()):
                if doc != before:  # rows that share an id are one document
                    rows.append((text, label))
                before = doc
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(rows))], pa.binary())], names=["model"])

    learned = found.repartition(1).sortWithinPartitions("h", "doc_id", "text").mapInArrow(tidy(learn), "model binary").collect()
    return pickle.loads(bytes(learned[0]["model"])) if learned else Model()


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, n_toxic (tokens at one half or more) and spans (start, end in code points, p) of every row.

    Null and empty texts have no tokens and get the score of a text without signs of toxicity.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("n_toxic", pa.int64()),
                        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emissions = _Emissions(model)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                rows = list(texts(part.column(1)))
                p, aggregates, owner = _scored(model, [_TOKEN.findall(t) for t in rows], emissions)
                hits = np.flatnonzero(p >= 0.5)
                begins = np.searchsorted(owner, np.arange(len(rows)))
                spans: list[list] = [[] for _ in rows]
                for doc in np.unique(owner[hits]):
                    places = [m.span() for m in _TOKEN.finditer(rows[doc])]
                    for at in hits[owner[hits] == doc]:
                        s, e = places[at - begins[doc]]
                        spans[doc].append({"start": s, "end": e, "p": float(p[at])})
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(model.score(aggregates)), pa.array([len(s) for s in spans], pa.int64()),
                                                  pa.array(spans, schema.field("spans").type)], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(tidy(run), "doc_id long, score double, n_toxic long, spans array<struct<start:long,end:long,p:double>>")


def scored_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``score`` by a model trained on ``labels``, with held_out and predicted (1 from ``threshold`` on)."""
    rows = score(docs, train(docs, labels))
    return rows.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "n_toxic", "spans")


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs``, columns as they are, whose score is below ``threshold``."""
    model = train(docs, labels)
    schema = docs.schema
    at = docs.columns.index("text")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emissions = _Emissions(model)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                _, aggregates, _ = _scored(model, [_TOKEN.findall(t) for t in texts(part.column(at))], emissions)
                yield part.filter(pa.array(model.score(aggregates) < threshold))

    return docs.mapInArrow(tidy(clean), schema)
