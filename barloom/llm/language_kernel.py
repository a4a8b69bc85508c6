"""Language identification with a string kernel.

Two texts are as alike as the byte n-grams of one to three bytes that they
share: the blended-spectrum presence kernel |a & b| / sqrt(|a| |b|) over the
sets of n-grams of the lower-cased text. Kernel ridge regression, one language
against the rest, is fitted through Nystroem features of landmark texts. The
presence kernel is an inner product, so landmarks and ridge weights multiply
into one matrix over the landmarks' n-grams, and a batch of whole documents is
scored by one product of its presence matrix with it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from barloom.llm.common import map_batches, remainder, slices, table, whole_row

#: Labelled documents per language that the model is fitted on (chosen by hash of the id), at most.
PER_LANGUAGE = 500
#: Of these, landmarks per language.
LANDMARKS = 80
RIDGE = 1e-3
HELD_OUT = (4, 2)
#: An n-gram is known in a language when this share of its texts fitted on holds it, and two of them.
KNOWN_SHARE = 0.02
#: A text is not accepted in its best language when its share of known n-grams, two standard errors up, is below
#: this part of the share that all but the fraction USUAL of the texts fitted on reach (each judged by the others).
ACCEPT, USUAL = 0.7, 0.01
_ROWS = 128


def spectrum(text: str) -> np.ndarray:
    """Sorted codes of the distinct byte n-grams (n = 1, 2, 3) of the lower-cased, blank-padded text."""
    a = np.frombuffer((" " + text.lower() + " ").encode("utf-8", "replace"), np.uint8).astype(np.int32)
    two = a[:-1] << 8 | a[1:]
    three = two[:-1] << 8 | a[2:]
    return np.concatenate([np.unique(a), np.unique(two) + (1 << 8), np.unique(three) + (1 << 17)])


_WORDY = np.array([c == 32 or c >= 128 or chr(c).isalpha() for c in range(256)])


def wordy(s: np.ndarray) -> np.ndarray:
    """The n-grams of a spectrum without digits and punctuation: numbers and tokens are of no language."""
    size = np.searchsorted(s, [1 << 8, 1 << 17])
    one, two, three = s[:size[0]], s[size[0]:size[1]] - (1 << 8), s[size[1]:] - (1 << 17)
    return s[np.concatenate([_WORDY[one], _WORDY[two >> 8] & _WORDY[two & 255],
                             _WORDY[three >> 16] & _WORDY[three >> 8 & 255] & _WORDY[three & 255]])]


@dataclass
class KernelModel:
    languages: list[str]
    grams: np.ndarray       # sorted n-gram codes of the landmarks
    weights: np.ndarray     # (n-grams + 1, languages); the last row is the bias
    known: list[np.ndarray]     # per language, sorted n-gram codes known in it
    least: list[float]          # per language, the share of known n-grams that its texts usually reach

    def accepts(self, s: np.ndarray, language: int, accept: float) -> bool:
        """Whether a text's n-grams are those of a language; other languages have no say in it."""
        s = wordy(s)
        p = float(np.isin(s, self.known[language], assume_unique=True).mean()) if len(s) else 1.0
        return p + 2 * np.sqrt(p * (1 - p) / max(len(s), 1)) >= accept * self.least[language]

    def margins(self, spectra: list[np.ndarray]) -> np.ndarray:
        presence = np.zeros((len(spectra), len(self.grams) + 1), np.float32)
        for row, s in zip(presence, spectra):
            at = np.minimum(np.searchsorted(self.grams, s), len(self.grams) - 1)
            row[at[self.grams[at] == s]] = 1 / np.sqrt(len(s))
        presence[:, -1] = 1
        return presence @ self.weights


def fit(spectra: list[np.ndarray], labels: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> KernelModel | None:
    """Nystroem kernel ridge regression; None without labelled texts."""
    languages = sorted(set(labels))
    if not languages:
        return None
    y = np.array([languages.index(c) for c in labels])
    marks = np.concatenate([np.flatnonzero(y == c)[:landmarks] for c in range(len(languages))])
    grams = np.unique(np.concatenate([spectra[i] for i in marks]))

    def presence(rows: np.ndarray) -> np.ndarray:
        out = np.zeros((len(rows), len(grams)), np.float32)
        for row, i in zip(out, rows):
            at = np.minimum(np.searchsorted(grams, spectra[i]), len(grams) - 1)
            row[at[grams[at] == spectra[i]]] = 1 / np.sqrt(len(spectra[i]))
        return out

    z = presence(marks)
    values, vectors = np.linalg.eigh((z @ z.T).astype(float))
    keep = values > 1e-6 * values[-1]
    root = vectors[:, keep] / np.sqrt(values[keep])                     # K_mm^(-1/2)
    psi = np.concatenate([presence(part) @ z.T for part in np.array_split(np.arange(len(y)), len(y) // 500 + 1)]) @ root
    psi = np.hstack([psi, np.ones((len(psi), 1))])
    share = np.bincount(y, minlength=len(languages)) / len(y)
    goal = np.where(y[:, None] == np.arange(len(languages)), 1.0, -1.0)
    w = (1 / (len(languages) * share[y]))[:, None]                      # languages weigh the same
    lhs = psi.T @ (w * psi) + ridge * len(y) * np.eye(psi.shape[1])
    ridge_weights = np.linalg.solve(lhs, psi.T @ (w * goal))
    known, least = [], []
    for c in range(len(languages)):
        found, texts = np.unique(np.concatenate([spectra[i] for i in np.flatnonzero(y == c)]), return_counts=True)
        enough = max(2, KNOWN_SHARE * np.sum(y == c))
        known.append(found[texts >= enough])
        others = found[texts >= enough + 1]                             # known without the text that is judged
        shares = [float(np.isin(g, others).mean()) for g in (wordy(spectra[i]) for i in np.flatnonzero(y == c)) if len(g)]
        least.append(float(np.quantile(shares, USUAL)) if shares else 0.0)
    return KernelModel(languages, grams, np.vstack([z.T @ (root @ ridge_weights[:-1]), ridge_weights[-1:]]).astype(np.float32),
                       known, least)


def training_set(docs: DataFrame, per_language: int = PER_LANGUAGE) -> tuple[list[np.ndarray], list[str]]:
    """Spectra and languages of a bounded sample, whole texts, spread over languages."""
    parts, out = HELD_OUT
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (remainder(F.col("doc_id"), parts) != out))
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not counts:
        return [], []
    draw = F.pmod(F.xxhash64(F.lit("languages"), F.col("doc_id")), F.lit(1_000_000))
    wanted = [F.when((F.col("lang") == c) & (draw < min(1.0, 2 * per_language / n) * 1_000_000), True) for c, n in counts.items()]

    def spectra(batches):
        for b in slices(batches):
            found = [spectrum(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("lang"), pa.array([s.tobytes() for s in found], pa.binary())],
                ["doc_id", "lang", "spectrum"])

    learned = known.where(F.coalesce(*wanted)).select(F.col("doc_id").cast("long"), "lang", "text")
    rows = (map_batches(learned, spectra, "doc_id long, lang string, spectrum binary")
            .orderBy(F.xxhash64(F.lit("order"), "doc_id"), "spectrum").limit(4 * per_language * len(counts)).toArrow())
    spectra_, labels, taken = [], [], dict.fromkeys(counts, 0)
    for lang, raw in zip(rows.column("lang").to_pylist(), rows.column("spectrum").to_pylist()):
        if taken[lang] < per_language:
            taken[lang] += 1
            spectra_.append(np.frombuffer(raw, np.int32))
            labels.append(lang)
    return spectra_, labels


def identify(docs: DataFrame, model: KernelModel | None, accept: float | None = None) -> DataFrame:
    """``docs`` with lang_pred and score (0 to 1) for the whole text of every row.
    With ``accept``, a text whose n-grams are not those of its best language is ``und``.

    A NULL text or one without a letter is ``und`` with score 0, and so is
    everything without a model. Repeated rows get the same result, NULL ids and
    other columns (whatever their names) stay as they are.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)    # landmarks bound its size

    def score(batches):
        model = shared.value
        for b in slices(batches):
            texts = b.column(0).to_pylist()
            lang, best = ["und"] * len(texts), [0.0] * len(texts)
            rows = [i for i, t in enumerate(texts) if model and t and any(map(str.isalpha, t))]
            for part in (rows[i:i + _ROWS] for i in range(0, len(rows), _ROWS)):
                found = [spectrum(texts[i]) for i in part]
                share = np.clip((model.margins(found) + 1) / 2, 1e-6, 1).astype(float)
                share /= share.sum(axis=1, keepdims=True)
                for i, s, c, p in zip(part, found, share.argmax(axis=1), share.max(axis=1)):
                    if accept is None or model.accepts(s, c, accept):
                        lang[i], best[i] = model.languages[c], float(p)
            yield pa.RecordBatch.from_arrays(
                [pa.array(lang), pa.array(best, pa.float64()), b.column(1)], ["lang_pred", "score", "row"])

    rows = docs.select(F.col("text").cast("string").alias("text"), whole_row(docs))
    schema = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType()), rows.schema["row"]])
    return map_batches(rows, score, schema)


def predict(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """Fit on the learning part of ``docs`` and identify all of them: doc_id, held_out, lang_pred, score."""
    model = fit(*training_set(docs, per_language))
    parts, out = HELD_OUT
    slim = docs.select("doc_id", "text")
    return identify(slim, model).select(
        "row.doc_id", F.coalesce(remainder(F.col("row.doc_id"), parts) == out, F.lit(False)).alias("held_out"),
        "lang_pred", "score")


def keep_identified(docs: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """Rows of ``docs`` whose text is in a learned language, judged by its n-grams in that language alone; all columns."""
    model = fit(*training_set(docs))
    return identify(docs, model, accept).where(F.col("lang_pred") != "und").select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    return predict(table(spark, sf_dir, "documents"))
