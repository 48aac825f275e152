"""Quality classifier: a linear support-vector machine on n-grams scaled by naive Bayes ratios.

A text becomes the set of its n-grams: byte trigrams, and one, two or three consecutive word shapes (a
shape: classes of the first and last byte, upper or mixed case, length, whether the word repeats its
predecessor). n-grams are hashed into a fixed number of features, and a feature is on or off. Each is
scaled by the log ratio of its smoothed shares in the two classes, rows get unit length, and a hinge-loss
model is fitted by dual coordinate descent. A logistic curve, fitted on rows kept aside, turns margins
into probabilities.

The model is fitted on at most ``MAX_TRAIN`` labelled rows, those with the smallest hash of the id; that
is the only bound, and scoring reads every text whole. Labels of one id that disagree count as 1 if any
does; null labels, labels other than 0 and 1, and labels without a document are ignored and take no places. Without labels the score is 0.5, with labels
of one class only it is that class's smoothed share. Null and empty texts have no features and get the
score of the bias. Repeated rows get equal scores. Extra columns are kept by ``scored``, and columns named
like the results are replaced. An empty table gives an empty table.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import mix, text_chunks, word_spans

MAX_TRAIN = 6000
CHUNK = 1 << 20  # bytes of text at a time; every byte takes part in several arrays of numbers
FEATURE_BITS = 16  # half of the features for byte trigrams, half for word shapes
FEATURES = 1 << FEATURE_BITS
SMOOTHING = 1.0
COST = 1.0
PASSES = 12
THRESHOLD = 0.3
FOLDS = 5

_HALF = FEATURES >> 1


def held_out(doc_id):
    """Column: the row belongs to the fifth that is never learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == 0


def _byte_kinds() -> np.ndarray:
    """0 other, 1 lower case, 2 upper case, 3 digit, 4 beyond ASCII."""
    kinds = np.zeros(256, np.int64)
    kinds[ord("a") : ord("z") + 1] = 1
    kinds[ord("A") : ord("Z") + 1] = 2
    kinds[ord("0") : ord("9") + 1] = 3
    kinds[128:] = 4
    return kinds


_KINDS = _byte_kinds()


def _word_shapes(buf: np.ndarray, offsets: np.ndarray):
    """(row, shape) of every word."""
    start, end, row = word_spans(buf, offsets)
    if not len(start):
        return row, np.empty(0, np.int64)
    kinds = _KINDS[buf]
    upper = np.concatenate([[0], np.cumsum(kinds == 2)])
    lower = np.concatenate([[0], np.cumsum(kinds == 1)])
    ups, lows = upper[end] - upper[start], lower[end] - lower[start]
    case = np.where(ups == 0, 0, np.where(lows == 0, 2, 1))
    length = np.digitize(end - start, [2, 4, 7, 11, 20])
    # equal to the word before: same length, same bytes at four places (enough for a feature)
    same = np.zeros(len(start), np.int64)
    if len(start) > 1:
        a, b, n = start[:-1], start[1:], (end - start)[1:]
        equal = ((end - start)[:-1] == n) & (row[1:] == row[:-1])
        for share in (0, 1, 2, 3):
            at = (n - 1) * share // 3
            equal &= buf[np.minimum(a + at, len(buf) - 1)] == buf[b + at]
        same[1:] = equal
    shape = kinds[start] + 5 * kinds[end - 1] + 25 * case + 75 * length + 450 * same
    return row, shape


def feature_rows(buf: np.ndarray, offsets: np.ndarray):
    """For each row the sorted distinct features that are on."""
    n = len(offsets) - 1
    flags = np.zeros(FEATURES, bool)
    if len(buf) >= 3:
        wide = buf.astype(np.uint32)
        grams = (wide[:-2] << 16) | (wide[1:-1] << 8) | wide[2:]
        grams = ((grams * np.uint32(2654435761)) >> np.uint32(32 - FEATURE_BITS + 1)).astype(np.int64)
    else:
        grams = np.empty(0, np.int64)
    row, shape = _word_shapes(buf, offsets)
    word_at = np.searchsorted(row, np.arange(n + 1))
    runs = []
    for size in (1, 2, 3):
        key = np.zeros(max(0, len(shape) - size + 1), np.uint64)
        for i in range(size):
            key = key * np.uint64(1024) + (shape[i : i + len(key)] + 1).astype(np.uint64)
        runs.append((mix(key) >> np.uint64(65 - FEATURE_BITS)).astype(np.int64) + _HALF)
    for i in range(n):
        flags[grams[offsets[i] : max(offsets[i], offsets[i + 1] - 2)]] = True
        for size, values in zip((1, 2, 3), runs, strict=True):
            flags[values[word_at[i] : max(word_at[i], word_at[i + 1] - size + 1)]] = True
        on = np.flatnonzero(flags)
        flags[on] = False
        yield on


@dataclass
class Model:
    """Score of a set of features: 1 / (1 + exp(-(slope x margin + offset)))."""

    weights: np.ndarray
    norms: np.ndarray
    bias: float
    slope: float
    offset: float

    def margin(self, on: np.ndarray) -> float:
        length = float(np.sqrt(self.norms[on].sum()))
        return float(self.weights[on].sum()) / length + self.bias if length > 0 else self.bias

    def score(self, on: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(on) + self.offset, -500, 500))))


def constant_model(share: float) -> Model:
    nothing = np.zeros(FEATURES)
    return Model(nothing, nothing, 0.0, 0.0, float(np.log(share / (1 - share))))


def _hinge(rows: list[np.ndarray], values: list[np.ndarray], signs: np.ndarray, costs: np.ndarray):
    """Weights and bias of the L2-regularised hinge-loss model, by dual coordinate descent.

    One dual variable per row, bounded by the row's cost; each step solves for one of them exactly while
    the weights follow. The bias is one more feature, always 1.
    """
    weights, bias, dual = np.zeros(FEATURES), 0.0, np.zeros(len(rows))
    own = np.array([float((v * v).sum()) for v in values]) + 1.0
    order = np.random.default_rng(0)
    for _ in range(PASSES):
        for i in order.permutation(len(rows)):
            on, value, sign = rows[i], values[i], signs[i]
            slack = sign * (float(weights[on] @ value) + bias) - 1.0
            fresh = min(max(dual[i] - slack / own[i], 0.0), costs[i])
            if fresh != dual[i]:
                step = (fresh - dual[i]) * sign
                weights[on] += step * value
                bias += step
                dual[i] = fresh
    return weights, bias


class _Scaled:
    """Values of the rows' features, unit length, made when asked for: the driver holds no more than the features."""

    def __init__(self, rows: list[np.ndarray], ratio: np.ndarray):
        self.rows, self.ratio = rows, ratio

    def __getitem__(self, i: int) -> np.ndarray:
        value = self.ratio[self.rows[i]]
        length = np.sqrt((value * value).sum())
        return value / length if length > 0 else value


def _logistic(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton steps, with a slight pull towards slope 1."""
    slope, offset = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + offset, -500, 500)))
        w = p * (1 - p)
        g = np.array([((p - labels) * margins).sum() + 0.01 * (slope - 1), (p - labels).sum() + 0.01 * offset])
        h = np.array([[(w * margins**2).sum() + 0.01, (w * margins).sum()], [(w * margins).sum(), w.sum() + 0.01]])
        step = np.linalg.solve(h, g)
        slope, offset = slope - step[0], offset - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(slope), float(offset)


def fit_rows(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    """Fit on sets of features with labels 0 and 1."""
    positive = int(labels.sum())
    if not len(rows) or positive in (0, len(rows)):
        return constant_model((positive + 1) / (len(rows) + 2))
    aside = np.arange(len(rows)) % FOLDS == FOLDS - 1
    if len({*labels[aside]}) < 2 or len({*labels[~aside]}) < 2:
        aside[:] = False
    learn = np.flatnonzero(~aside)
    counts = np.full((2, FEATURES), SMOOTHING)
    for i in learn:
        counts[labels[i], rows[i]] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    learnt = [rows[i] for i in learn]
    signs = np.where(labels[learn] == 1, 1.0, -1.0)
    # both classes weigh the same; the logistic curve restores their shares
    share = np.where(signs > 0, (signs > 0).mean(), (signs < 0).mean())
    weights, bias = _hinge(learnt, _Scaled(learnt, ratio), signs, COST * 0.5 / share)
    model = Model(weights * ratio, ratio * ratio, bias, 1.0, 0.0)
    check = np.flatnonzero(aside) if aside.any() else learn
    margins = np.array([model.margin(rows[i]) for i in check])
    model.slope, model.offset = _logistic(margins, labels[check].astype(float))
    return model


def _features(batches):
    for batch in batches:
        for first, last, buf, offsets in text_chunks(batch.column("_ul_body"), CHUNK):
            cut = batch.slice(first, last - first)
            packed = [on.astype(np.uint16).tobytes() for on in feature_rows(buf, offsets)]
            yield pa.RecordBatch.from_arrays(
                [cut.column("rank"), cut.column("label"), pa.array(packed, pa.binary())], ["rank", "label", "packed"]
            )


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = MAX_TRAIN) -> Model:
    """Fit on at most ``most`` labelled documents that are not held out.

    The chosen labels are at most ``most`` rows, hence broadcast; their documents' features, again at most
    ``most`` rows, come to the driver.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    known = known.groupBy(F.col("doc_id").alias("_ul_id")).agg(F.max(label).cast("int").alias("label"))
    known = known.withColumn("rank", F.xxhash64("_ul_id")).orderBy("rank", "_ul_id").limit(most)
    texts = docs.select("doc_id", F.col("text").alias("_ul_body"))
    chosen = texts.join(F.broadcast(known), F.col("doc_id") == F.col("_ul_id")).select("rank", "label", "_ul_body")
    rows = chosen.mapInArrow(_features, "rank bigint, label int, packed binary")
    # an id that is repeated in the documents could bring more rows than labels
    rows = rows.orderBy("rank", F.crc32("packed")).limit(most).collect()
    sets = [np.frombuffer(r["packed"], np.uint16) for r in rows]
    return fit_rows(sets, np.array([r["label"] for r in rows], np.int64))


def _scorer(model: Model, names: list[str]):
    def run(batches):
        for batch in batches:
            scores = np.empty(batch.num_rows)
            for first, last, buf, offsets in text_chunks(batch.column("_ul_body"), CHUNK):
                scores[first:last] = [model.score(on) for on in feature_rows(buf, offsets)]
            columns = [batch.column(name) for name in names] + [pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, [*names, "score"])

    return run


def scored(rows: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows with score and predicted; one pass, no shuffle. Needs no column but the text."""
    rows = rows.drop("score", "predicted")
    names = rows.columns
    given = rows.withColumn("_ul_body", F.col(text_col))
    schema = ", ".join(f"`{name}` {kind}" for name, kind in rows.dtypes)
    out = given.mapInArrow(_scorer(model, names), f"{schema}, score double")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Digest of all documents: doc_id, held_out, score, predicted."""
    model = fit(docs, labels)
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return scored(rows, model).select("doc_id", "held_out", "score", "predicted")


def _keeper(model: Model, names: list[str], threshold: float):
    def run(batches):
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for first, last, buf, offsets in text_chunks(batch.column("_ul_body"), CHUNK):
                keep[first:last] = [model.score(on) >= threshold for on in feature_rows(buf, offsets)]
            yield batch.select(names).filter(pa.array(keep))

    return run


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier keeps, with all their columns; no shuffle."""
    schema = ", ".join(f"`{name}` {kind}" for name, kind in docs.dtypes)
    model = fit(docs, labels)
    return docs.withColumn("_ul_body", F.col("text")).mapInArrow(_keeper(model, docs.columns, threshold), schema)
