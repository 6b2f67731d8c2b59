"""Toxicity by compression distance.

One zstandard dictionary is trained on ordinary text, one on passages of toxic text around
words that toxic texts hold significantly more often, and one on windows of the toxic texts
that hold no such word: all of them where samples are few or words are not set apart by
blanks. A window is compressed with the ordinary dictionary alone and with either toxic one
before it: text like the toxic samples gets shorter by the second. What windows save is
calibrated to a probability on labelled rows that the dictionaries have not seen.
"""

from __future__ import annotations

import math
import pickle
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType

from fleetlens.llm.common import text_of

#: Rows the model is fitted on at most, and the longest text among them.
SAMPLE_ROWS, SAMPLE_BYTES = 8000, 1 << 16
WINDOW = 256
LEVEL = 6
ORDINARY_BYTES, TOXIC_BYTES, UNMARKED_BYTES = 32768, 2048, 16384
#: Where a fifth of the rows holds fewer toxic ones, each fifth calibrates in turn.
FEW = 40
#: Log-likelihood ratio from which a word marks toxic passages, and bytes around it.
SIGNIFICANT, AROUND = 25.0, 10
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
#: Words longer than this, in scripts of more than ASCII, count as their runs of three
#: characters: a sentence without blanks is no word.
LONG_WORD = 32
_RUN = re.compile(rb"(?=((?:[\xc0-\xff][\x80-\xbf]+){3}))")


@dataclass(frozen=True)
class ToxicityModel:
    ordinary: bytes
    toxic: bytes
    unmarked: bytes
    weights: tuple[float, ...]  # of 1 and of the features
    prior: float  # score where there was nothing to learn from


def _windows(text: bytes) -> list[bytes]:
    return [text[i:i + WINDOW] for i in range(0, len(text), WINDOW)]


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    d.precompute_compress(LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False,
                                    write_checksum=False, write_dict_id=False)


class Scorer:
    """Scores texts with a model; holds the prepared dictionaries."""

    def __init__(self, model: ToxicityModel):
        self.model = model
        either = model.toxic or model.unmarked
        self._alone = _compressor(model.ordinary) if either else None
        # Ordinary content last: its offsets are the same in all.
        self._both = [_compressor(t + model.ordinary) if t else None
                      for t in (model.toxic, model.unmarked)]

    def features(self, text: bytes) -> tuple[float, ...]:
        """Bytes saved: most in a window, mean, mean of the three best, share of windows
        that save three or more; for each toxic dictionary, 0 where it is not there."""
        windows = _windows(text.lower())
        if not windows or self._alone is None:
            return (0.0,) * 8
        alone = [len(self._alone.compress(w)) for w in windows]
        out: tuple[float, ...] = ()
        for both in self._both:
            if both is None:
                out += (0.0,) * 4
                continue
            saved = sorted((a - len(both.compress(w)) for a, w in zip(alone, windows)), reverse=True)
            top = saved[:3]
            out += (float(saved[0]), sum(saved) / len(saved), sum(top) / len(top),
                    sum(s >= 3 for s in saved) / len(saved))
        return out

    def score(self, text: str | None) -> float:
        if self._alone is None:
            return self.model.prior
        z = self.model.weights[0] + sum(
            w * f for w, f in zip(self.model.weights[1:], self.features((text or "").encode())))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _ratio(a: int, n: int, b: int, m: int) -> float:
    """Log-likelihood ratio of a of n against b of m."""
    def part(k: int, of: int, p: float) -> float:
        return (k * math.log(p) if k else 0) + ((of - k) * math.log(1 - p) if of > k else 0)

    p = (a + b) / (n + m)
    return 2 * (part(a, n, a / n) + part(b, m, b / m) - part(a, n, p) - part(b, m, p))


def _trained(size: int, samples: list[bytes], k: int) -> bytes:
    try:
        return zstandard.train_dictionary(size, samples, k=k, d=6).as_bytes()
    except zstandard.ZstdError:  # too few samples to choose from: all of them
        return b"".join(samples)[-size:]


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    mean, spread = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - mean) / spread])
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hessian = (z * (p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(len(w))
        w += np.linalg.solve(hessian, z.T @ (y - p) - 1e-2 * w)
    w[1:] /= spread
    w[0] -= w[1:] @ mean
    return w


def _words(text: bytes) -> Iterator[tuple[int, int, bytes]]:
    """Start, end and bytes of each word."""
    for word in _WORD.finditer(text):
        if word.end() - word.start() <= LONG_WORD or word.group().isascii():
            yield *word.span(), word.group()
        else:
            for run in _RUN.finditer(text, *word.span()):
                yield *run.span(1), run.group(1)


def _pieces(text: bytes) -> list[bytes]:
    return [text[i:i + 128] for i in range(0, len(text), 128)]


def _dictionaries(fit: list[tuple[bytes, int]]) -> tuple[bytes, bytes, bytes]:
    """Of ordinary text, of passages around marks, and of toxic texts without marks."""
    toxic, ordinary = [t for t, y in fit if y], [t for t, y in fit if not y]
    held = [Counter(w for t in side for w in {w for _, _, w in _words(t)}) for side in (toxic, ordinary)]
    n, m = len(toxic), len(ordinary)
    marks = {w for w, c in held[0].items() if c / n > held[1][w] / m
             and _ratio(c, n, held[1][w], m) >= SIGNIFICANT}
    passages, unmarked = [], []
    for t in toxic:
        around = [t[max(0, a - AROUND):b + AROUND] for a, b, w in _words(t) if w in marks]
        passages += around
        unmarked += [] if around else _pieces(t)
    plain = [w for t in ordinary for w in _pieces(t)]
    random = np.random.Generator(np.random.PCG64(8))
    random.shuffle(plain)
    random.shuffle(unmarked)
    return (_trained(ORDINARY_BYTES, [bytes(p) for p in plain[:20000]], 32),
            _trained(TOXIC_BYTES, passages, 16) if passages else b"",
            _trained(UNMARKED_BYTES, [bytes(p) for p in unmarked[:20000]], 16) if unmarked else b"")


def learn(texts: list[str], labels: list[int]) -> ToxicityModel:
    """Fit on labelled texts; of equal texts with one label, one counts. Every fifth one
    calibrates; where that leaves few toxic ones, each fifth does in turn, scored by
    dictionaries of the others. With only one label, scores are the share of 1."""
    rows = sorted({(t.encode().lower(), int(y)) for t, y in zip(texts, labels)})
    np.random.Generator(np.random.PCG64(7)).shuffle(rows)
    rows = [(bytes(t), int(y)) for t, y in rows]
    prior = sum(y for _, y in rows) / len(rows) if rows else 0.0
    if len({y for _, y in rows}) < 2:
        return ToxicityModel(b"", b"", b"", (), prior)
    few = sum(y for _, y in rows[::5]) < FEW
    features, seen = [], []
    for part in range(5 if few else 1):
        fit = [r for i, r in enumerate(rows) if i % 5 != part]
        if len({y for _, y in fit}) == 2:
            scorer = Scorer(ToxicityModel(*_dictionaries(fit), (), prior))
            features += [scorer.features(t) for t, _ in rows[part::5]]
            seen += [y for _, y in rows[part::5]]
    if len(set(seen)) < 2:  # one row of a label
        scorer = Scorer(ToxicityModel(*_dictionaries(rows), (), prior))
        features, seen = [scorer.features(t) for t, _ in rows], [y for _, y in rows]
    model = _dictionaries(rows) if few else _dictionaries(fit)
    weights = _logistic(np.array(features), np.array(seen, float))
    return ToxicityModel(*model, tuple(map(float, weights)), prior)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that no label is learnt from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> ToxicityModel:
    """A model of the rows labelled 0 or 1 that are not held out: of ``sample_rows`` of
    them, chosen by a hash of the id, those with texts of up to ``SAMPLE_BYTES``.

    Labels of one id that disagree count by majority, 1 if even. Null ids, labels and texts
    are left out, as are labels without a document. The sample is bounded by these
    parameters and so may be fitted on the driver.
    """
    chosen = (labels.where(~held_out(id_col) & F.col(id_col).isNotNull()
                           & F.col(label_col).isin(0, 1))
              .groupBy(F.col(id_col).alias("_id"))
              .agg((F.avg(label_col) >= 0.5).cast("int").alias("_label"))
              .orderBy(F.xxhash64("_id"), "_id").limit(sample_rows))
    texts = docs.where(F.octet_length(text_col) <= SAMPLE_BYTES).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sample = (texts.join(F.broadcast(chosen), F.col("id") == F.col("_id"))
              .select("text", F.col("_label").alias("label"))).toPandas()
    return learn(sample["text"].tolist(), sample["label"].tolist())


@lru_cache(maxsize=2)
def _scorer(packed: bytes) -> Scorer:
    return Scorer(pickle.loads(packed))


def toxicity(model: ToxicityModel, text_col: str | Column = "text") -> Column:
    """Probability that the label is 1, from the whole text and nothing else. Null texts
    count as empty."""
    packed = pickle.dumps(model)

    @F.pandas_udf(DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        one = _scorer(packed).score
        return pd.Series([one(t) for t in texts], dtype="float64")

    return score(text_of(text_col))
