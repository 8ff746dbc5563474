"""Language identification: averaged hashed subword embeddings with a linear softmax, and calibrated rejection.

A text is the mean of the embeddings of its subwords, the runs of ``SIZES`` characters of every word with a
space on either side, hashed into ``BUCKETS``. Embeddings and the softmax above them are trained together by
stochastic gradient descent in NumPy on a bounded sample of the labelled rows (``SAMPLE``, shared evenly by
the languages, whole texts). Of the five folds of doc_id, 0 is held out, ``CALIBRATION`` of the others is
kept from training: it sets the temperature of the softmax, and the confidence below which a prediction is
rejected, so that accepted ones err at most ``RISK`` of the time, by an upper bound at 95%.

Defined cases: a null text or one without a letter gets ``und`` with score 0 and is rejected; so does every
text if no row has a language to learn. A null doc_id belongs to no fold and is not learned from. Rows of equal
doc_id are separate rows. An empty table gives no rows. Columns beside those named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from flowops.llm.common import packed, stored

FOLDS = 5
CALIBRATION = 4
# Rows that the model is fitted on and rows that calibrate it, at most, whatever the size of the corpus; with more
# languages than rows each language keeps one.
SAMPLE = 4096
BUCKETS = 1 << 14
DIMENSIONS = 16
SIZES = (2, 3, 4)
# Minibatches of training, so that few rows are gone through more often.
STEPS = 1280
BATCH = 32
RATE = 40.0
RISK = 0.01
UNKNOWN = "und"
# Characters worked on at once, and texts whose bucket counts are held at once.
SLICE = 1 << 16
TEXTS = 64
SPREAD = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)


def fold(doc_id: Column) -> Column:
    """0 to 4, null for a null id; rows of fold 0 are held out."""
    return (F.crc32(doc_id.cast("string").cast("binary")) % FOLDS).cast("int")


def _letters(codes: np.ndarray) -> np.ndarray:
    """Letters of lower-cased text: a-z and what lies beyond ASCII but for its signs and punctuation."""
    ascii_ = (codes >= 0x61) & (codes <= 0x7A)
    signs = (codes >= 0x2000) & (codes < 0x2070) | (codes >= 0x3000) & (codes < 0x3040)
    return ascii_ | (codes >= 0xC0) & (codes != 0xD7) & (codes != 0xF7) & ~signs


def _subwords(text: str, starts: np.ndarray, known: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of the text, bucket) of the subwords of texts that begin at ``starts`` of a slice, each behind a space.

    Runs that end before character ``known`` were counted with the slice before.
    """
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters(codes)
    codes = np.where(letter, codes, np.uint32(0x20))
    owner = np.zeros(len(codes), np.int64)
    owner[starts[1:]] = 1
    owner = np.cumsum(owner)
    docs, found = [], []
    total = np.zeros(len(codes), np.uint32)
    inner = letter.copy()
    for size in range(1, max(SIZES) + 1):
        n = len(codes) - size + 1
        if n <= 0:
            break
        total = total[:n] + codes[size - 1 :] * np.uint32(SPREAD[(size - 1) % 4])
        if size > 2:
            # All but the first and the last character have to be letters.
            inner = letter[1 : n + 1].copy() if size == 3 else inner[:n] & letter[size - 2 : n + size - 2]
        whole = letter[:n] | letter[size - 1 :] if size <= 2 else inner
        if size not in SIZES:
            continue
        at = np.flatnonzero(whole)
        at = at[at + size > known]
        mixed = total[at] ^ np.uint32(size * 0x9E3779B1 & 0xFFFFFFFF)
        mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        found.append(((mixed ^ (mixed >> np.uint32(12))) & np.uint32(BUCKETS - 1)).astype(np.int64))
        docs.append(owner[at])
    return (np.concatenate(docs), np.concatenate(found)) if docs else (np.zeros(0, np.int64),) * 2


def shares(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(first text, share of every bucket among the subwords of each text) for slices of the texts."""
    held: list[str] = []
    first = size = 0

    def mean(counts: np.ndarray) -> np.ndarray:
        counts = counts.astype(np.float32)
        return counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)

    def counted(parts: list[str], known: int = 0) -> np.ndarray:
        lengths = np.array([len(p) + 1 for p in parts])
        doc, bucket = _subwords(" " + " ".join(parts) + " ", np.cumsum(lengths) - lengths, known)
        return np.bincount(doc * BUCKETS + bucket, minlength=len(parts) * BUCKETS).reshape(len(parts), BUCKETS)

    for i, value in enumerate(texts):
        text = (value.as_py() or "").lower()
        if held and (len(held) == TEXTS or size + len(text) > SLICE):
            yield first, mean(counted(held))
            held, size, first = [], 0, i
        if len(text) <= SLICE:
            held.append(text)
            size += len(text)
            continue
        # Slices of a long text share their last characters, so that no run is lost or counted twice.
        overlap = max(SIZES) - 1
        total = np.zeros((1, BUCKETS), np.int64)
        for at in range(0, len(text), SLICE):
            begin = max(0, at - overlap)
            part = text[begin : at + SLICE]
            if at + SLICE < len(text):
                doc, bucket = _subwords(" " * (at == 0) + part, np.array([0]), at - begin + (at == 0) if at else 0)
            else:
                doc, bucket = _subwords(part + " ", np.array([0]), at - begin)
            total += np.bincount(bucket, minlength=BUCKETS)[None]
        yield i, mean(total)
        first = i + 1
    if held:
        yield first, mean(counted(held))


@dataclass
class Model:
    """Languages, embeddings of the buckets, softmax weights and offsets, temperature, least accepted confidence."""

    languages: list[str]
    embeddings: np.ndarray
    weights: np.ndarray
    offsets: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return (x @ self.embeddings) @ self.weights + self.offsets

    def chances(self, x: np.ndarray) -> np.ndarray:
        return softmax(self.logits(x) / self.temperature)


def softmax(logits: np.ndarray) -> np.ndarray:
    powers = np.exp(logits - logits.max(axis=1, keepdims=True))
    return powers / powers.sum(axis=1, keepdims=True)


@dataclass
class Rows:
    """Shares of buckets as sparse rows, with the number of the language of each."""

    starts: np.ndarray
    buckets: np.ndarray
    values: np.ndarray
    languages: np.ndarray

    def dense(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros((len(rows), BUCKETS), np.float32)
        for i, r in enumerate(rows.tolist()):
            own = slice(self.starts[r], self.starts[r + 1])
            out[i, self.buckets[own]] = self.values[own]
        return out


def trained(rows: Rows, languages: list[str], seed: int = 0) -> Model:
    """Minibatch descent on the cross-entropy, the rate falling to 0 in a straight line; equal for equal rows."""
    rng = np.random.default_rng(seed)
    n, k = len(rows.languages), len(languages)
    model = Model(
        languages,
        rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32),
        np.zeros((DIMENSIONS, k), np.float32),
        np.zeros(k, np.float32),
    )
    order = np.zeros(0, np.int64)
    for step in range(STEPS):
        if len(order) < BATCH:
            order = np.concatenate([order, *(rng.permutation(n) for _ in range(-(-BATCH // n)))])
        own, order = order[:BATCH], order[BATCH:]
        rate = np.float32(RATE * (1 - step / STEPS))
        x = rows.dense(own)
        hidden = x @ model.embeddings
        error = softmax(hidden @ model.weights + model.offsets)
        error[np.arange(len(own)), rows.languages[own]] -= 1
        error /= len(own)
        back = error @ model.weights.T
        model.weights -= np.float32(rate / RATE) * (hidden.T @ error)
        model.offsets -= np.float32(rate / RATE * 0.1) * error.sum(axis=0)
        used = np.flatnonzero(x.any(axis=0))
        model.embeddings[used] -= rate * (x[:, used].T @ back)
    return model


def calibrated(model: Model, rows: Rows, risk: float = RISK) -> Model:
    """The model with the temperature of least loss on ``rows`` and the confidence that keeps errors below ``risk``.

    The error rate above a confidence is bounded by the upper end of its score interval; without calibration rows
    or where no confidence will do (so with fewer than about 270 rows at a risk of 0.01), nothing is accepted.
    """
    n = len(rows.languages)
    if not n:
        model.threshold = 2.0
        return model
    logits = np.concatenate([model.logits(rows.dense(np.arange(a, min(a + 64, n)))) for a in range(0, n, 64)])
    truth = rows.languages
    # Truth is held a little below 1, as n rows cannot show more; else rows without errors would give certainty.
    doubt = 1 / (n + 2)
    loss = {}
    for t in np.exp(np.linspace(np.log(0.05), np.log(20), 61)).tolist():
        logs = np.log(np.maximum(softmax(logits / t), 1e-30))
        loss[t] = -float(((1 - doubt) * logs[np.arange(n), truth] + doubt * logs.mean(axis=1)).mean())
    model.temperature = min(loss, key=loss.get)
    chance = softmax(logits / model.temperature)
    top, wrong = chance.max(axis=1), chance.argmax(axis=1) != truth
    order = np.argsort(-top, kind="stable")
    count = np.arange(1, n + 1)
    errors = np.cumsum(wrong[order])
    rate = errors / count
    # Upper end of a score interval for a share, one-sided at 95%.
    z2 = 1.645**2
    upper = (rate + z2 / (2 * count) + 1.645 * np.sqrt(rate * (1 - rate) / count + z2 / (4 * count**2))) / (1 + z2 / count)
    fits = np.flatnonzero(upper <= risk)
    model.threshold = float(top[order][fits[-1]]) if len(fits) else 2.0
    return model


def sample(docs: DataFrame, rows: int = SAMPLE) -> tuple[list[str], Rows, Rows]:
    """Languages, training rows and calibration rows: a bounded share of each language, chosen by a digest."""
    key = F.xxhash64(F.lit("langid"), "doc_id", "text")
    part = fold(F.col("doc_id"))
    named = docs.select("doc_id", "text", "lang", part.alias("fold"), (part == CALIBRATION).alias("late"))
    known = named.where("lang IS NOT NULL AND fold <> 0 AND text IS NOT NULL")
    counts = {}
    for lang, late, n in known.groupBy("lang", "late").count().collect():
        counts.setdefault(lang, {})[late] = n
    languages = sorted(counts)
    if not languages:
        none = Rows(np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32), np.zeros(0, np.int64))
        return [], none, none
    quota = max(1, rows // len(languages))
    # A hash below the language's share leaves somewhat more than the quota, ranks cut it exactly.
    rate = F.create_map(*[F.lit(v) for lang in languages for v in (lang, min(1.0, 1.3 * quota / max(1, min(counts[lang].values()))))])
    spread = F.pmod(key, F.lit(1 << 20)) / float(1 << 20)
    some = known.withColumn("key", key).where(spread < F.try_element_at(rate, F.col("lang")))
    best = Window.partitionBy("lang", "late").orderBy("key", "doc_id")
    chosen = some.withColumn("n", F.row_number().over(best)).where(F.col("n") <= quota)

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = []
            for _, x in shares(batch.column("text")):
                for row in x:
                    own = np.flatnonzero(row)
                    held.append((own.astype(np.int32).tobytes(), row[own].tobytes()))
            columns = [pa.array([h[i] for h in held], pa.binary()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*map(batch.column, ("lang", "late", "key", "doc_id")), *columns], names=kind.names)

    kind = T.StructType([
        T.StructField("lang", T.StringType()), T.StructField("late", T.BooleanType()), T.StructField("key", T.LongType()),
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("buckets", T.BinaryType()), T.StructField("values", T.BinaryType()),
    ])
    found = chosen.select("lang", "late", "key", "doc_id", "text").mapInArrow(sparse, kind).collect()
    number = {lang: i for i, lang in enumerate(languages)}
    parts = []
    for late in (False, True):
        own = sorted((r for r in found if r["late"] == late and len(r["buckets"])), key=lambda r: (r["key"], r["doc_id"], r["lang"]))
        buckets = [np.frombuffer(r["buckets"], np.int32) for r in own]
        values = [np.frombuffer(r["values"], np.float32) for r in own]
        empty = np.zeros(0, np.float32)
        parts.append(Rows(
            np.concatenate([[0], np.cumsum([len(b) for b in buckets])]).astype(np.int64),
            np.concatenate(buckets or [empty.astype(np.int32)]), np.concatenate(values or [empty]),
            np.array([number[r["lang"]] for r in own], np.int64),
        ))
    return languages, *parts


def fit(docs: DataFrame, rows: int = SAMPLE, risk: float = RISK) -> Model | None:
    """The model learned from doc_id, text and lang; None if no row can be learned from."""
    languages, train, held = sample(docs, rows)
    if not len(train.languages):
        return None
    seen = np.unique(train.languages)
    if len(seen) < len(languages):
        # A language of calibration rows only cannot be predicted; its rows count as errors there.
        rank = np.full(len(languages), len(seen), np.int64)
        rank[seen] = np.arange(len(seen))
        train.languages, held.languages = rank[train.languages], rank[held.languages]
        keep = held.languages < len(seen)
        languages = [languages[i] for i in seen]
        held = Rows(*_only(held, keep))
    return calibrated(trained(train, languages), held, risk)


def _only(rows: Rows, keep: np.ndarray) -> tuple:
    sizes = np.diff(rows.starts)
    inside = np.repeat(keep, sizes)
    return np.concatenate([[0], np.cumsum(sizes[keep])]), rows.buckets[inside], rows.values[inside], rows.languages[keep]


def identified(docs: DataFrame, model: Model | None) -> DataFrame:
    """``row`` (the whole input row), lang_pred, score and accepted for every document."""
    rows = packed(docs)
    lettered = F.coalesce(F.col("row.text").rlike(r"\p{L}"), F.lit(False))
    if model is None:
        return rows.select("row", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("accepted"))
    shape = "struct<lang_pred:string,score:double,accepted:boolean>"

    @F.arrow_udf(shape)
    def predict(texts: pa.Array) -> pa.Array:
        best, score = np.zeros(len(texts), np.int64), np.zeros(len(texts))
        for first, x in shares(texts):
            chance = model.chances(x)
            best[first : first + len(x)] = chance.argmax(axis=1)
            score[first : first + len(x)] = chance.max(axis=1)
        languages = pa.array(model.languages).take(pa.array(best))
        return pa.StructArray.from_arrays([languages, pa.array(score), pa.array(score >= model.threshold)], ["lang_pred", "score", "accepted"])

    said = rows.select("row", lettered.alias("lettered"), predict(F.coalesce(F.col("row.text"), F.lit(""))).alias("said"))
    return said.select(
        "row",
        F.when(F.col("lettered"), F.col("said.lang_pred")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(F.col("lettered"), F.col("said.score")).otherwise(0.0).alias("score"),
        (F.col("lettered") & F.col("said.accepted")).alias("accepted"),
    )
