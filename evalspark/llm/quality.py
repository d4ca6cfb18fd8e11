"""Quality classifier by co-training of a text view and a page-metadata view.

Two logistic classifiers see the same documents apart from each other: one the
bytes of the text (hashed byte pairs and shape statistics), one the metadata
(language, source, size). Each learns from the labelled rows; in every round
both score all documents, each labels those that it is most sure of (PER_ROUND
of them, as many of each kind as the labels have), and these pseudo-labels go
to the other one's training set. Documents with equal views are one. In the end each view is calibrated on labelled
rows that no view has learned from (Platt scaling), and the calibrated log odds
are added, less the prior that both contain. All documents are scored.

The fit sees at most LABELLED labelled rows, drawn by hash of the id, and
ROUNDS * 2 * PER_ROUND pseudo-labels; these bounds are parameters, and what is
broadcast and collected is bounded by them. A task tells its own best candidates
only, so a round writes at most 2 * PER_ROUND rows a task.

Defined cases: null or unknown labels are ignored and of several labels of one
document the smallest counts (of several rows of a labelled document the smallest view); a null text is the empty text, null metadata a
value of their own; without labels of both kinds to fit and to calibrate with
(two of each) every document is accepted, with the prior as score; a null
doc_id is scored like all others; repeated rows get a row each; empty tables
give an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from evalspark.llm.common import dropped, in_batches, slices, span_hashes, utf8_column, written
from evalspark.llm.shingles import word_spans

LABELLED, ROUNDS = 4000, 5
PAIRS, META = 512, 128
CONFIDENT, PER_ROUND = 0.95, 200
PART_BYTES = 1 << 20
HELD_OUT = 4
#: A document is accepted from this probability of quality on.
ACCEPT = 0.4

_PAIR = ((np.arange(1 << 16, dtype=np.uint32) * np.uint32(40503) >> np.uint32(5)) % np.uint32(PAIRS)).astype(np.int64)
_UPPER, _LOWER, _DIGIT = ((np.arange(256) >= a) & (np.arange(256) <= b) for a, b in ((65, 90), (97, 122), (48, 57)))
_HIGH = np.arange(256) >= 128
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_SIGN = ~(_UPPER | _LOWER | _DIGIT | _HIGH | _BLANK)
_KINDS = np.stack([_UPPER, _LOWER, _DIGIT, _HIGH, _BLANK, _SIGN]).T.astype(np.float64)
TEXT_WIDTH = PAIRS + _KINDS.shape[1] + 7


def text_view(column: pa.Array) -> np.ndarray:
    """One row per text: root shares of hashed byte pairs, shares of byte kinds, and the shape of its words."""
    data, offsets = utf8_column(column)
    out = np.zeros((len(offsets) - 1, TEXT_WIDTH), np.float32)
    if not len(data):
        return out
    starts, ends, first = word_spans(data, offsets)
    words = span_hashes(data, starts, ends)
    again = np.zeros(len(words) + 1, np.int64)
    np.cumsum(words[1:] == words[:-1], out=again[1 : len(words)])
    pairs = _PAIR[data[:-1].astype(np.int64) * 256 + data[1:]]
    for i, (a, b, u, v) in enumerate(zip(*(x.tolist() for x in (offsets[:-1], offsets[1:], first[:-1], first[1:])), strict=True)):
        if a == b:
            continue
        n, m = b - a, max(1, v - u)
        kinds = np.bincount(data[a:b], minlength=256) @ _KINDS / n
        out[i, :PAIRS] = np.sqrt(np.bincount(pairs[a : b - 1], minlength=PAIRS) / n)
        out[i, PAIRS : PAIRS + len(kinds)] = kinds
        sizes = ends[u:v] - starts[u:v]
        repeats = (again[v - 1] - again[u]) / m if v > u else 0
        longest = min(1.0, int(sizes.max(initial=0)) / 50)
        out[i, PAIRS + len(kinds) :] = np.log1p(n) / 10, n < 100, v - u < 10, sizes.sum() / m / 10, longest, 4 * repeats, len(np.unique(words[u:v])) / m
    return out


def metadata_view(lang: list, source: list, n_chars: list) -> np.ndarray:
    """One row per document: hashed indicators of language, source, their pair, and size class."""
    out = np.zeros((len(lang), META), np.float32)
    for i, (x, y, n) in enumerate(zip(lang, source, n_chars, strict=True)):
        size = "none" if n is None else str(max(0, int(n)).bit_length())
        for field in (f"l{x}", f"s{y}", f"p{x}/{y}", f"n{size}"):
            out[i, zlib.crc32(field.encode()) % META] += 1
    return out


@dataclass
class Logistic:
    """L2-regularised logistic regression by Newton's method."""

    ridge: float = 1.0
    weights: np.ndarray | None = None

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, rounds: int = 10) -> Logistic:
        x = np.hstack([np.asarray(x, np.float64), np.ones((len(x), 1))])
        weight = np.ones(len(x)) if weight is None else weight
        w = np.zeros(x.shape[1])
        ridge = np.full(len(w), self.ridge)
        ridge[-1] = 1e-6
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            slope = x.T @ (weight * (p - y)) + ridge * w
            curve = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x
            step = np.linalg.solve(curve + np.diag(ridge), slope)
            w = w - step
            if np.abs(step).max() < 1e-6:
                break
        self.weights = w
        return self

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return np.asarray(x, np.float64) @ self.weights[:-1] + self.weights[-1]


@dataclass
class CoTrained:
    """Two calibrated views. ``exchanged`` counts the pseudo-labels that each round handed over, by view."""

    views: tuple[Logistic, Logistic] | None
    scales: list[tuple[float, float]]
    prior: float
    exchanged: list[tuple[int, int]]

    def log_odds(self, views: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Calibrated log odds of quality: both views' added, less the prior that each contains."""
        if self.views is None:
            return np.full(len(views[0]), self.prior)
        parts = [a * m.log_odds(x) + b for m, (a, b), x in zip(self.views, self.scales, views, strict=True)]
        return parts[0] + parts[1] - self.prior

    def probability(self, views: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(views), -30, 30)))


#: A pseudo-label: the view that is sure, the kind, how sure, the document's key and its features.
Candidate = tuple[int, int, float, int, np.ndarray]


def confident(models: list[Logistic], features: np.ndarray, taken: list[np.ndarray], most: tuple[int, int]) -> list[Candidate]:
    """Of some documents those that each view is most sure of, ``most`` of a kind, without those whose keys the other view has."""
    keys = np.array([xxhash.xxh3_64_intdigest(r.tobytes()) for r in features], np.uint64).view(np.int64)
    out: list[Candidate] = []
    for v in (0, 1):
        odds = models[v].log_odds(features[:, :TEXT_WIDTH] if v == 0 else features[:, TEXT_WIDTH:])
        free = ~np.isin(keys, taken[1 - v])
        for kind in (0, 1):
            sure = 1 / (1 + np.exp(-np.clip(odds if kind else -odds, -30, 30)))
            at = np.flatnonzero(free & (sure >= CONFIDENT))
            at = at[np.unique(keys[at], return_index=True)[1]]
            out += [(v, kind, float(sure[i]), int(keys[i]), features[i]) for i in at[np.lexsort((keys[at], -sure[at]))][: most[kind]].tolist()]
    return out


def best(found: list[Candidate], most: tuple[int, int]) -> list[Candidate]:
    """The surest of each view and kind, each key once."""
    out: list[Candidate] = []
    for v, kind in ((v, kind) for v in (0, 1) for kind in (0, 1)):
        own = {c[3]: c for c in found if c[:2] == (v, kind)}
        out += sorted(own.values(), key=lambda c: (-c[2], c[3]))[: most[kind]]
    return out


def co_train(labelled: np.ndarray, y: np.ndarray, held: np.ndarray, candidates: Callable[..., list[Candidate]], rounds: int = ROUNDS) -> CoTrained:
    """Fits both views. ``held`` marks the labelled rows that only calibrate; ``candidates(models, taken, most)`` finds pseudo-labels."""
    share = (y.sum() + 1) / (len(y) + 2)
    prior = float(np.log(share / (1 - share)))
    if min((y[~held] == 1).sum(), (y[~held] == 0).sum(), (y[held] == 1).sum(), (y[held] == 0).sum()) == 0:
        return CoTrained(None, [], prior, [])
    view = lambda x, v: x[:, :TEXT_WIDTH] if v == 0 else x[:, TEXT_WIDTH:]
    sets = [[(view(labelled, v)[~held], y[~held], np.ones(int((~held).sum())))] for v in (0, 1)]
    own = np.array([xxhash.xxh3_64_intdigest(r.tobytes()) for r in labelled], np.uint64).view(np.int64)
    taken = [own, own]
    exchanged: list[tuple[int, int]] = []
    models = [Logistic(), Logistic()]
    # as many of each kind as the labels have
    most = max(1, round(PER_ROUND * (1 - share))), max(1, round(PER_ROUND * share))
    for turn in range(rounds + 1):
        for v in (0, 1):
            models[v].fit(*(np.concatenate([s[k] for s in sets[v]]) for k in range(3)))
        if turn == rounds or not (found := candidates(models, taken, most)):
            break
        for v in (0, 1):
            given = [c for c in found if c[0] == v]
            if given:
                sets[1 - v].append((view(np.stack([c[4] for c in given]), 1 - v), np.array([c[1] for c in given]), np.full(len(given), 0.5)))
                taken[1 - v] = np.append(taken[1 - v], [c[3] for c in given])
        exchanged.append((sum(c[0] == 0 for c in found), sum(c[0] == 1 for c in found)))
    scales = []
    for v in (0, 1):
        raw = models[v].log_odds(view(labelled, v)[held])
        spread = max(float(raw.std()), 1e-9)
        platt = Logistic(1e-2).fit((raw / spread)[:, None], y[held]).weights
        # a view that ranks the held-out rows the wrong way round says nothing
        scales.append((float(platt[0]) / spread, float(platt[1])) if platt[0] > 0 else (0.0, prior))
    return CoTrained((models[0], models[1]), scales, prior, exchanged)


def _features(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return text_view(batch.column("text")), metadata_view(*(batch.column(c).to_pylist() for c in ("lang", "source", "n_chars")))


VIEW = {"text": "string", "lang": "string", "source": "string", "n_chars": "long"}


def _viewed(docs: DataFrame) -> list[Column]:
    """The columns that the views read, null where the table lacks one."""
    return [(F.col(c) if c in docs.columns else F.lit(None)).cast(k).alias(c) for c, k in VIEW.items()]


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", labelled: int = LABELLED, rounds: int = ROUNDS) -> CoTrained:
    """The model from a bounded sample of labelled documents, and from what both views say of all documents."""
    together = lambda some: np.hstack(_features(some))

    def featured(batches):
        for batch in batches:
            for some in slices(batch, "text", PART_BYTES):
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), some.column("label"), pa.array([r.tobytes() for r in together(some)], pa.binary())], ["doc_id", "label", "features"])

    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(label).cast("int").alias("label"))
    known = known.orderBy(F.xxhash64(F.lit(label), "doc_id"), "doc_id").limit(labelled)
    texts = in_batches(docs).select("doc_id", *_viewed(docs))
    found = texts.join(F.broadcast(known), "doc_id").mapInArrow(featured, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, label int, features binary")
    rows = found.groupBy("doc_id").agg(F.min("label").alias("label"), F.min("features").alias("features")).orderBy("doc_id").collect()
    x = np.stack([np.frombuffer(r["features"], np.float32) for r in rows]) if rows else np.zeros((0, TEXT_WIDTH + META), np.float32)
    y = np.array([r["label"] for r in rows], np.int64)
    # every HELD_OUT-th labelled row, of each kind, calibrates
    held = np.zeros(len(rows), bool)
    for kind in (0, 1):
        held[np.flatnonzero(y == kind)[::HELD_OUT]] = True

    def candidates(models: list[Logistic], taken: list[np.ndarray], most: tuple[int, int]) -> list[Candidate]:
        shared = docs.sparkSession.sparkContext.broadcast((models, taken, most))

        def surest(batches):
            own: list[Candidate] = []
            for batch in batches:
                for some in slices(batch, "text", PART_BYTES):
                    own = best(own + confident(shared.value[0], together(some), *shared.value[1:]), most)
            columns = [pa.array([c[k] for c in own], kind) for k, kind in enumerate((pa.int32(), pa.int32(), pa.float64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([c[4].tobytes() for c in own], pa.binary())], ["view", "kind", "sure", "key", "features"])

        told = written(texts.drop("doc_id").mapInArrow(surest, "view int, kind int, sure double, key long, features binary"), "candidates")
        # the surest of all tasks are found by keys alone, and the features of these are fetched
        keys = told.select("view", "kind", "sure", "key").distinct().withColumn("at", F.row_number().over(Window.partitionBy("view", "kind").orderBy(F.desc("sure"), "key")))
        # the constant bound lets every task of the window's input keep its own surest only
        keys = keys.where(F.col("at") <= max(most)).where(F.col("at") <= F.when(F.col("kind") == 1, most[1]).otherwise(most[0])).select("view", "kind", "key")
        out = told.join(F.broadcast(keys), ["view", "kind", "key"]).dropDuplicates(["view", "kind", "key"]).select("view", "kind", "sure", "key", "features").collect()
        dropped(told)
        return best([(*r[:4], np.frombuffer(r["features"], np.float32)) for r in out], most)

    return co_train(x, y, held, candidates, rounds)


def score(docs: DataFrame, model: CoTrained, accept: float = ACCEPT, into: tuple[str, str] = ("quality", "accepted")) -> DataFrame:
    """Adds a calibrated probability and whether it is ``accept`` or more to all documents; no shuffle.

    A model without views accepts all.

    A table's own columns of the two names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    # the documents' own columns pass through as they are, whatever their names
    read = in_batches(docs).select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in into]).alias("_row"), *_viewed(docs))

    def scored(batches):
        for batch in batches:
            for some in slices(batch, "text", PART_BYTES):
                p = shared.value.probability(_features(some))
                yield pa.RecordBatch.from_arrays([some.column("_row"), pa.array(p), pa.array((p >= accept) | (shared.value.views is None))], ["_row", "_quality", "_accepted"])

    out = read.mapInArrow(scored, f"_row {read.schema['_row'].dataType.simpleString()}, _quality double, _accepted boolean")
    return out.select("_row.*", F.col("_quality").alias(into[0]), F.col("_accepted").alias(into[1]))
