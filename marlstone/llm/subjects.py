"""Subject areas of each document.

Complement naive Bayes learns from the labelled documents; expectation-
maximisation over the sentences of all documents refines it: a sentence is
about one subject or about none, the document's own mix is its prior, and in
a labelled document only the document's subjects are open. In every round a
feature speaks for a subject by its log probability there and, at the weight
``against``, by its rarity in the complement, all other sentences. The share of
a document's sentences with a subject that are about it gives that subject's
posterior by a curve calibrated on the labelled documents, one a subject and
each for itself; a document deals with the subjects of a posterior of one half
or more.

The model is a table of hashed words and word pairs by class, so its size is
fixed whatever the corpus. Each round is one pass over the sentences; tasks
add up expected counts, Spark sums them by feature.

Defined results in odd cases
- null, empty and blank texts, and texts without a sentence of three words,
  have no subject;
- labels of unknown documents or subjects are left out; without any label
  nothing can be told and no document gets a subject;
- any number of subjects; a null subject is none;
- equal rows get equal results, one each; an empty table gives no rows;
- texts are processed whole; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from marlstone.llm.text import sentences
from marlstone.session import materialise


@dataclass(frozen=True)
class SubjectRules:
    """buckets: hashed features; rounds: of expectation-maximisation; temper:
    weight of the (overlapping) features; against: weight of the complement's
    evidence; mix: prior sentences a class in a document; share: of the
    sentences with a subject that makes a case; steps: bins of the calibration;
    faith: labelled documents a bin for which the definition (share) counts."""

    buckets: int = 1 << 17
    rounds: int = 3
    temper: float = 0.4
    against: float = 0.5
    mix: float = 0.3
    share: float = 0.2
    steps: int = 20
    faith: float = 5.0


def features(words: list[str], buckets: int, known: dict[str, tuple[int, int, bytes]] | None = None) -> list[int]:
    """Hashed words and word pairs of a sentence, once each; numbers are alike.

    A pair's checksum goes on from its first word's; ``known`` keeps the words'.
    """
    known = {} if known is None else known
    out, last, crc32 = set(), None, zlib.crc32
    for w in words:
        hit = known.get(w)
        if hit is None:
            raw = b"#" if w[0].isdigit() else w.encode()
            crc = crc32(raw)
            hit = known[w] = (crc % buckets, crc, b" " + raw)
        out.add(hit[0])
        if last is not None:
            out.add(crc32(hit[2], last) % buckets)
        last = hit[1]
    return list(out)


def sentence_table(docs: DataFrame, labels: DataFrame, subjects: list[str], rules: SubjectRules) -> DataFrame:
    """doc_id, marks (indexes of the labelled subjects; none: unlabelled), feats (of all sentences in turn), lens (features a sentence).

    The labels meet the features, never the texts.
    """
    index = F.array_position(F.array(*(F.lit(s) for s in subjects)), F.col("subject")) - 1
    marks = labels.select("doc_id", index.cast("int").alias("k")).where("k >= 0").groupBy("doc_id").agg(F.sort_array(F.collect_set("k")).alias("marks"))  # at most the subjects
    buckets = rules.buckets

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[int, int, bytes]] = {}
        for batch in batches:
            if len(known) > 500_000:
                known.clear()
            feats: list[int] = []
            lens: list[int] = []
            f_at, l_at = [0], [0]
            for text in batch.column("text").to_pylist():
                for w in sentences(text or ""):
                    one = features(w, buckets, known)
                    feats += one
                    lens.append(len(one))
                f_at.append(len(feats))
                l_at.append(len(lens))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), _lists(feats, f_at), _lists(lens, l_at)], names=["doc_id", "feats", "lens"])

    table = docs.select("doc_id", "text").mapInArrow(cut, "doc_id bigint, feats array<int>, lens array<int>").where(F.size("lens") > 0)
    return table.join(marks, "doc_id", "left").select("doc_id", F.coalesce("marks", F.array().cast("array<int>")).alias("marks"), "feats", "lens")


# ---------------------------------------------------------------- one block of documents


def _lists(values: list[int] | np.ndarray, at: list[int] | np.ndarray, kind: type = np.int32) -> pa.ListArray:
    """A list column from its values in turn and the places where the rows end."""
    return pa.ListArray.from_arrays(pa.array(np.asarray(at, np.int32)), pa.array(np.asarray(values, kind)))


def _rows(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column in turn, and the places where the rows end, from 0."""
    at = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False)[at[0] : at[-1]], at - at[0]


@dataclass
class Block:
    """Sentences of some documents: flat features, features a sentence, document of a sentence, labelled subjects in turn and their number by document."""

    flat: np.ndarray
    lens: np.ndarray
    owner: np.ndarray
    docs: int
    marks: np.ndarray
    marked: np.ndarray

    def labelled(self, k: int) -> np.ndarray:
        out = np.zeros((self.docs, k), bool)
        out[np.repeat(np.arange(self.docs), self.marked), self.marks] = True
        return out


def blocks(batch: pa.RecordBatch, most: int = 150_000) -> Iterator[tuple[slice, Block]]:
    """Runs of documents with about ``most`` features each; a document is never cut."""
    feats, f_at = _rows(batch.column("feats"))
    lens, l_at = _rows(batch.column("lens"))
    marks, m_at = _rows(batch.column("marks"))
    start = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(f_at, f_at[start] + most, "right")) - 1)
        part = lambda v, at: v[at[start] : at[end]]  # noqa: B023, E731
        count = lambda at: np.diff(at[start : end + 1])  # noqa: B023, E731
        yield slice(start, end), Block(part(feats, f_at), part(lens, l_at), np.repeat(np.arange(end - start), count(l_at)), end - start, part(marks, m_at), count(m_at))
        start = end


def doc_sums(values: np.ndarray, b: Block) -> np.ndarray:
    out = np.zeros((b.docs, values.shape[1]))
    np.add.at(out, b.owner, values)
    return out


def scores(weights: np.ndarray, b: Block) -> np.ndarray:
    return np.add.reduceat(weights[b.flat], np.r_[0, np.cumsum(b.lens)[:-1]], axis=0)


def _normal(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def open_classes(b: Block, k: int, masked: bool) -> np.ndarray:
    """Documents by classes: which are open; the last, no subject, always is."""
    free = np.ones((b.docs, k + 1), bool)
    if masked:
        named = b.labelled(k)
        known = named.any(1)
        free[known, :k] = named[known]
    return free


def sentence_posteriors(weights: np.ndarray, prior: np.ndarray, b: Block, masked: bool, rules: SubjectRules) -> np.ndarray:
    k = weights.shape[1] - 1
    z = scores(weights, b) * rules.temper + prior
    shut = ~open_classes(b, k, masked)[b.owner]
    z[shut] = -1e9
    p = _normal(z)
    for _ in range(2):
        mix = doc_sums(p, b) + rules.mix
        own = np.log(mix / mix.sum(1, keepdims=True))[b.owner]
        y = z - prior + own
        y[:, k] = z[:, k]  # having no subject is not a trait of the document
        y[shut] = -1e9
        p = _normal(y)
    return p


def first_posteriors(weights: np.ndarray, b: Block) -> np.ndarray:
    """From the complement weights alone; no subject scores zero."""
    k = weights.shape[1]
    z = np.c_[scores(weights, b), np.zeros(len(b.lens))]
    z[~open_classes(b, k, True)[b.owner]] = -1e9
    return _normal(z)


# ---------------------------------------------------------------- rounds


def _expected_counts(table: DataFrame, k: int, buckets: int, weigh) -> tuple[np.ndarray, np.ndarray]:
    """Features by classes, and classes: sums of weigh(block) (sentences by classes) over all documents; at most a row a bucket reaches the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, mass = np.zeros((k, buckets)), np.zeros(k)
        for batch in batches:
            for _, b in blocks(batch):
                p = np.ascontiguousarray(weigh(b).T)
                mass += p.sum(1)
                for c in range(k):
                    if p[c].any():
                        total[c] += np.bincount(b.flat, weights=np.repeat(p[c], b.lens), minlength=buckets)
        hit = np.flatnonzero(total.any(0))
        cols = [np.r_[total[c, hit], mass[c]] for c in range(k)]  # the last row is the classes' own
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[hit, -1].astype(np.int32)), *(pa.array(x) for x in cols)], names=["f", *(f"c{c}" for c in range(k))])

    schema = "f int, " + ", ".join(f"c{c} double" for c in range(k))
    # no more tasks than run at once: each gives a table of the buckets
    table = table.coalesce(max(1, table.sparkSession.sparkContext.defaultParallelism))
    rows = table.select("marks", "feats", "lens").mapInArrow(add, schema).groupBy("f").agg(*(F.sum(f"c{c}").alias(f"c{c}") for c in range(k))).toPandas()
    counts, mass = np.zeros((buckets, k)), np.zeros(k)
    at = rows["f"].to_numpy()
    values = rows.drop(columns="f").to_numpy(np.float64)
    counts[at[at >= 0]] = values[at >= 0]
    mass = values[at < 0].sum(0) if (at < 0).any() else mass
    return counts, mass


def complement_weights(counts: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    """Complement naive Bayes: a feature speaks for a class by its rarity in all others; centred over the classes."""
    other = counts.sum(1, keepdims=True) - counts + smooth
    w = -np.log(other / other.sum(0))
    return w - w.mean(1, keepdims=True)


def class_weights(counts: np.ndarray, against: float) -> np.ndarray:
    """Log probability of the features in a class, less ``against`` times that in its complement; both smoothed by the feature's own frequency."""
    k = counts.shape[1] - 1
    whole = counts.sum(1, keepdims=True)
    prior = 0.5 * k * whole / max(whole.sum(), 1e-9) + 1e-3
    own = np.log((counts + prior) / (counts + prior).sum(0))
    other = whole - counts + prior
    rare = -np.log(other / other.sum(0))
    return own + against * (rare - rare.mean(1, keepdims=True))


@dataclass
class Model:
    subjects: list[str]
    weights: np.ndarray
    prior: np.ndarray
    rules: SubjectRules


def train(table: DataFrame, subjects: list[str], rules: SubjectRules = SubjectRules()) -> Model | None:
    """Model from a (written) sentence table; None without a labelled document."""
    k, buckets = len(subjects), rules.buckets

    def labelled(b: Block) -> np.ndarray:
        share = b.labelled(k).astype(float)
        return (share / np.maximum(share.sum(1, keepdims=True), 1))[b.owner]

    counts, mass = _expected_counts(table.where("size(marks) > 0"), k, buckets, labelled)
    if not mass.sum():
        return None
    sc = table.sparkSession.sparkContext
    start = sc.broadcast(complement_weights(counts).astype(np.float32))  # buckets x classes: a fixed size
    counts, mass = _expected_counts(table, k + 1, buckets, lambda b: first_posteriors(start.value, b))
    for n in range(rules.rounds):
        weights, prior = class_weights(counts, rules.against), np.log((mass + 1) / (mass + 1).sum())
        if n < rules.rounds - 1:
            held = sc.broadcast(weights.astype(np.float32))
            counts, mass = _expected_counts(table, k + 1, buckets, lambda b, held=held, prior=prior: sentence_posteriors(held.value, prior, b, True, rules))
            held.unpersist()
    start.unpersist()
    return Model(subjects, weights.astype(np.float32), prior, rules)


def subject_counts(table: DataFrame, model: Model) -> DataFrame:
    """doc_id, marks, counts (sentences by subject). Labels are not used here: some are wrong."""
    held = table.sparkSession.sparkContext.broadcast((model.weights, model.prior))
    rules, k = model.rules, len(model.subjects)

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, prior = held.value
        for batch in batches:
            for at, b in blocks(batch):
                best = sentence_posteriors(weights, prior, b, False, rules).argmax(1)
                n = np.bincount(b.owner * (k + 1) + best, minlength=b.docs * (k + 1)).reshape(b.docs, k + 1)
                part = batch.slice(at.start, at.stop - at.start)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("marks"), _lists(n[:, :k].ravel(), np.arange(b.docs + 1) * k, np.int64)], names=["doc_id", "marks", "counts"])

    return table.mapInArrow(tell, "doc_id bigint, marks array<int>, counts array<bigint>")


def subject_shares(counts: DataFrame, subjects: list[str]) -> DataFrame:
    """doc_id, subject, bit, n, share of the sentences with a subject; subjects with a sentence only."""
    total = F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, x: a + x)
    names = F.array(*(F.lit(s) for s in subjects))
    each = F.posexplode("counts").alias("bit", "n")
    return counts.select("doc_id", total.alias("total"), each).where("n > 0").select("doc_id", F.element_at(names, F.col("bit") + 1).alias("subject"), "bit", "n", (F.col("n") / F.col("total")).alias("share"))


def _bin(share, steps: int):
    return F.least(F.floor(share * steps + 1e-9), F.lit(steps)).cast("int")


def calibrate(shares: DataFrame, counts: DataFrame, subjects: list[str], rules: SubjectRules) -> DataFrame:
    """shares with ``posterior``: P(the document has the subject), a rising curve of the share for each subject.

    Isotonic regression on the labelled documents, in ``steps`` bins of the
    share; each bin starts with ``faith`` documents that follow the definition.
    What reaches the driver is subjects x bins rows.
    """
    k, steps = len(subjects), rules.steps
    total = F.greatest(F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, x: a + x), F.lit(1))
    cells = counts.where("size(marks) > 0").select("marks", total.alias("total"), F.posexplode("counts").alias("bit", "n"))
    yes = F.array_contains("marks", F.col("bit")).cast("int")
    rows = cells.groupBy("bit", _bin(F.col("n") / F.col("total"), steps).alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.sum(yes).alias("yes")).collect()
    n = np.full((k, steps + 1), rules.faith)
    y = n * (np.arange(steps + 1) >= rules.share * steps - 1e-9)
    for r in rows:
        n[r["bit"], r["bin"]] += r["n"]
        y[r["bit"], r["bin"]] += r["yes"]
    curves = F.array(*(F.array(*(F.lit(float(v)) for v in rising(y[s] / n[s], n[s]))) for s in range(k)))
    return shares.withColumn("posterior", F.element_at(F.element_at(curves, F.col("bit") + 1), _bin(F.col("share"), steps) + 1))


def rising(rate: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted isotonic regression by pooling neighbours that fall."""
    pools: list[list[float]] = []
    for r, w in zip(rate, weight):
        pools.append([r, w, 1])
        while len(pools) > 1 and pools[-2][0] > pools[-1][0]:
            b, a = pools.pop(), pools.pop()
            pools.append([(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2] + b[2]])
    return np.concatenate([np.full(int(m), r) for r, _, m in pools])


def classify(docs: DataFrame, labels: DataFrame, subjects: DataFrame, rules: SubjectRules = SubjectRules()) -> DataFrame:
    """doc_id, subject, n, share, posterior of every subject a document has a sentence on."""
    names = sorted(r[0] for r in subjects.select("subject").where("subject is not null").distinct().collect())  # a class each
    table = materialise(sentence_table(docs, labels, names, rules))
    model = train(table, names, rules) if names else None
    if model is None:
        return docs.sparkSession.createDataFrame([], "doc_id bigint, subject string, n bigint, share double, posterior double")
    counts = materialise(subject_counts(table, model))
    return calibrate(subject_shares(counts, names), counts, names, rules).select("doc_id", "subject", "n", "share", "posterior")
