"""Language identification with a blended-spectrum string kernel.

A text is the set of its character n-grams of one to three letters, case folded,
with everything that is no letter as one class, a to z as 26, and all other letters, of
whatever script, hashed to 37. The kernel of two texts is the
size of their common set over the geometric mean of their sizes. Landmarks, a
few texts of each language, span the Nystroem approximation; one-versus-rest
ridge regression on it gives a weight for each landmark and language. A block
of texts is scored by two matrix products: presence by landmarks, kernels by
weights.

Training looks at a bounded sample: ``SAMPLE`` labelled texts shared among the
languages (the ``LANGUAGES`` most frequent ones; of equally frequent ones the
first by code point), drawn by a hash of the id, none longer than ``LONGEST`` bytes.
Prediction sees whole texts, and the text alone.

Defined results: a null text, or one without a letter, is ``und`` with score 0;
with nothing to learn from all texts are; ties go to the first language by code
point; a null id is in no fold (held_out false, not learned from); other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowhaul.llm.words import pieces

SAMPLE = 640
LANDMARKS = 64
LONGEST = 20_000
RIDGE = 0.05
UNKNOWN = "und"
#: Languages learned at most, the most frequent ones.
LANGUAGES = 64
_CLASSES = 64
_POINTS = 0x110000
_WIDTH = _CLASSES + _CLASSES**2 + _CLASSES**3


def _letter_classes() -> np.ndarray:
    """Class of each code point: 0 for what is no letter, a to z 1 to 26, other letters spread over the rest."""
    out = np.zeros(_POINTS, np.int8)
    for point in range(_POINTS):
        letter = chr(point)
        if letter.isalpha():
            low = ord(letter.lower()[0])
            out[point] = low - 96 if 97 <= low <= 122 else 27 + low * 2654435761 % (1 << 32) % (_CLASSES - 27)
    return out


_TABLE: list[np.ndarray] = []


def grams(text: str) -> np.ndarray:
    """Numbers of the n-grams that a text holds, ascending."""
    if not _TABLE:
        _TABLE.append(_letter_classes())
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    codes = _TABLE[0][points].astype(np.int64)
    held = np.zeros(_WIDTH, bool)
    held[codes] = True
    pairs = codes[:-1] * _CLASSES + codes[1:]
    held[_CLASSES + pairs] = True
    held[_CLASSES + _CLASSES**2 + pairs[:-1] * _CLASSES + codes[2:]] = True
    held[[0, _CLASSES, _CLASSES + _CLASSES**2]] = False
    return np.flatnonzero(held)


def has_letter(text: str | None, held: np.ndarray) -> bool:
    return bool(text) and (bool(len(held) and held[0] < _CLASSES) or any(c.isalpha() for c in text))


class Model:
    """Landmarks and weights, small enough to travel with the tasks."""

    def __init__(self, texts: list[str], langs: list[str]):
        self.langs = sorted(set(langs))
        sets, y = [grams(t) for t in texts], np.array([self.langs.index(x) for x in langs])
        chosen = [i for c in range(len(self.langs)) for i in np.flatnonzero(y == c)[: max(2, LANDMARKS // len(self.langs))]]
        self.grams = np.unique(np.concatenate([sets[i] for i in chosen]))
        self.landmarks = np.zeros((len(self.grams), len(chosen)), np.float32)
        for k, i in enumerate(chosen):
            self.landmarks[np.searchsorted(self.grams, sets[i]), k] = 1 / np.sqrt(max(1, len(sets[i])))
        kernel = self.kernel(sets).astype(np.float64)
        values, vectors = np.linalg.eigh(kernel[chosen])
        root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-6))) @ vectors.T
        features = kernel @ root
        goal = np.where(y[:, None] == np.arange(len(self.langs)), 1.0, -1.0)
        share = 1 / np.bincount(y, minlength=len(self.langs))[y]
        normal = features.T @ (features * share[:, None]) + RIDGE * np.eye(len(chosen)) / len(chosen)
        self.weights = root @ np.linalg.solve(normal, features.T @ (goal * share[:, None]))

    def kernel(self, sets: list[np.ndarray]) -> np.ndarray:
        held = np.zeros((len(sets), len(self.grams)), np.float32)
        for i, s in enumerate(sets):
            at = np.minimum(np.searchsorted(self.grams, s), len(self.grams) - 1)
            held[i, at[self.grams[at] == s]] = 1 / np.sqrt(max(1, len(s)))
        return held @ self.landmarks

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        sets = [grams(t or "") for t in texts]
        scores = self.kernel(sets).astype(np.float64) @ self.weights
        best = scores.argmax(axis=1) if len(texts) else np.zeros(0, int)
        known = np.array([has_letter(t, s) for t, s in zip(texts, sets)], bool)
        score = np.clip((scores[np.arange(len(texts)), best] + 1) / 2, 0, 1)
        return [self.langs[b] if k else UNKNOWN for b, k in zip(best, known)], np.where(known, score, 0.0)


def learn(labelled: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Model | None:
    """A model of the labelled texts; of each language an equal, bounded sample is drawn."""
    usable = labelled.where(F.col(lang).isNotNull() & (F.octet_length(text) <= LONGEST) & (F.length(text) > 0))
    frequent = usable.groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES)
    counts = {r.lang: r.n for r in frequent.collect()}
    if not counts:
        return None
    each = max(4, sample // len(counts))
    draw = F.pmod(F.xxhash64(F.lit("language"), F.col(doc_id)), F.lit(1 << 30))
    share = F.create_map(*(x for name, n in counts.items() for x in (F.lit(name), F.lit(int(min(1.0, 1.5 * each / n) * (1 << 30))))))
    drawn = usable.where(draw < F.element_at(share, F.col(lang))).select(F.col(lang).alias("lang"), F.col(text).alias("text"), draw.alias("draw"))
    rows = sorted(drawn.orderBy("draw").limit(2 * each * len(counts)).collect(), key=lambda r: (r.draw, r.text))
    taken: dict[str, list[str]] = {}
    for row in rows:
        if len(taken.setdefault(row.lang, [])) < each:
            taken[row.lang].append(row.text)
    pairs = [(t, name) for name, ts in sorted(taken.items()) for t in ts]
    return Model([t for t, _ in pairs], [name for _, name in pairs]) if pairs else None


def identify(df: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text", block: int = 256) -> DataFrame:
    """One row for each document: doc_id, lang_pred, score."""

    def run(batches):
        for batch in pieces(batches):
            for at in range(0, batch.num_rows, block):
                part = batch.slice(at, block)
                texts = part.column(1).to_pylist()
                names, scores = model.predict(texts) if model else ([UNKNOWN] * len(texts), np.zeros(len(texts)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, f"doc_id {df.schema[doc_id].dataType.simpleString()}, lang_pred string, score double")
