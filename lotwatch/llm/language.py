"""Language identification with a string kernel.

Texts are compared by a blended-spectrum presence kernel: the number of letter n-grams (n = 1
to 4) that two texts share, over the geometric mean of how many each has. Nystroem landmarks
stand for the kernel's rows, and one-versus-rest kernel ridge regression learns a score per
language. The kernel is a product of presence vectors, so landmarks and weights fold into one
matrix, and a batch is scored by a matrix product.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwatch.llm.common import map_slices, texts
from lotwatch.llm.words import mix

UNKNOWN = "und"
LONGEST = 4
#: Presence vectors have this many places; n-grams are hashed to them.
PLACES = 1 << 15
#: Texts in one matrix product.
GROUP = 64

_letters: list[np.ndarray] = []


@dataclass(frozen=True)
class LanguageParams:
    """``rows``: training texts per language at most, spread over all ids by hash;
    ``landmarks``: of these, texts per language that serve as landmarks; ``languages``: the most
    frequent languages that are learned; ``ridge``: regularisation per training row;
    ``reject_below``: a text whose best score is lower is in no learned language."""

    rows: int = 192
    landmarks: int = 48
    languages: int = 64
    ridge: float = 1e-3
    reject_below: float = 0.3


def letters() -> np.ndarray:
    """Lower-case code point of every letter, a space for everything else."""
    if not _letters:
        out = np.full(0x110000, 32, np.uint32)
        for c in range(0x110000):
            if chr(c).isalpha():
                low = chr(c).lower()
                out[c] = ord(low) if len(low) == 1 else c
        _letters.append(out)
    return _letters[0]


def presence(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A row of PLACES booleans per text, and whether the text has a letter."""
    data, _ = texts(column)
    code = letters()[np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)]
    size = pc.fill_null(pc.utf8_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(size)), size)
    lettered = np.zeros(len(size), bool)
    lettered[row[code != 32]] = True
    # Runs of other signs count as one space.
    keep = np.ones(len(code), bool)
    keep[1:] = (code[1:] != 32) | (code[:-1] != 32) | (row[1:] != row[:-1])
    code, row = code[keep].astype(np.uint64), row[keep]
    seen = np.zeros(len(size) * PLACES, bool)
    value = np.zeros(len(code), np.uint64)
    for n in range(1, min(LONGEST, len(code)) + 1):
        value = value[:len(code) - n + 1] * np.uint64(0x110001) + code[n - 1:] + np.uint64(1)
        place = (mix(value + np.uint64(n)) & np.uint64(PLACES - 1)).astype(np.int64)
        inside = row[:len(row) - n + 1] == row[n - 1:]
        seen[row[:len(row) - n + 1][inside] * PLACES + place[inside]] = True
    seen = seen.reshape(len(size), PLACES)
    seen[~lettered] = False
    return seen, lettered


@dataclass(frozen=True)
class LanguageModel:
    names: list[str]
    weights: np.ndarray
    reject_below: float = 0.3

    def predict(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language of each text, its score from 0 to 1, and whether it is accepted."""
        pred, score, accepted = [], [], []
        for at in range(0, len(column), GROUP):
            seen, lettered = presence(column.slice(at, GROUP))
            if not self.names:
                lettered[:] = False
            known = np.zeros((len(seen), max(1, len(self.names))), np.float32)
            if self.names:
                norm = np.sqrt(np.maximum(seen.sum(1), 1)).astype(np.float32)
                known = (seen.astype(np.float32) @ self.weights) / norm[:, None]
            best = known.argmax(1)
            top = known[np.arange(len(best)), best]
            pred += [self.names[b] if ok else UNKNOWN for b, ok in zip(best, lettered)]
            score.append(np.where(lettered, np.clip((top.astype(float) + 1) / 2, 0, 1), 0.0))
            accepted.append(lettered & ((top + 1) / 2 >= self.reject_below))
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        return np.array(pred, object), join(score, float), join(accepted, bool)


def solve(seen: np.ndarray, lang: list[str], params: LanguageParams) -> LanguageModel:
    """Kernel ridge regression on landmarks, folded into one weight per place and language."""
    names = sorted(set(lang))
    if not names:
        return LanguageModel([], np.zeros((PLACES, 0), np.float32), params.reject_below)
    lang = np.array(lang, object)
    x = seen.astype(np.float32)
    x /= np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))
    marks = np.concatenate([np.flatnonzero(lang == n)[:params.landmarks] for n in names])
    among, across = ((y @ x[marks].T).astype(float) for y in (x[marks], x))
    target = np.where(lang[:, None] == np.array(names, object)[None, :], 1.0, -1.0)
    alpha = np.linalg.solve(across.T @ across + params.ridge * len(x) * among + 1e-8 * np.eye(len(marks)),
                            across.T @ target)
    return LanguageModel(names, x[marks].T @ alpha.astype(np.float32), params.reject_below)


def fit(docs: DataFrame, params: LanguageParams = LanguageParams(), text: str = "text",
        lang: str = "lang", key: str = "doc_id") -> LanguageModel:
    """Learn from a bounded sample of ``docs``: ``params.rows`` texts per language.

    One row per (language, hash class of the key) is chosen by its least hash, so the choice is
    the same in every run and no language is held in one task. Rows whose language or text is
    null, or whose text has no letter, teach nothing. Without rows every text gets ``und``.
    """
    rows = docs.select(F.col(lang).alias("_lang"), F.xxhash64(F.col(key).cast("string")).alias("_at"),
                       F.col(text).alias("_text")).where("_lang is not null")
    langs = rows.groupBy("_lang").count().orderBy(F.desc("count"), "_lang").limit(params.languages)
    chosen = (rows.where("_text is not null").join(F.broadcast(langs.select("_lang")), "_lang")
              .groupBy("_lang", F.pmod("_at", F.lit(params.rows)).alias("_class")).agg(F.min("_at").alias("_at")))
    picked = rows.join(F.broadcast(chosen.select("_lang", "_at")), ["_lang", "_at"])

    def bits(batch: pa.RecordBatch) -> pa.RecordBatch:
        packed, ok = [], []
        for at in range(0, batch.num_rows, GROUP):
            seen, lettered = presence(batch.column("_text").slice(at, GROUP))
            packed += [np.packbits(s).tobytes() for s in seen]
            ok += lettered.tolist()
        return pa.RecordBatch.from_arrays([batch.column("_lang"), batch.column("_at"),
                                           pa.array(packed, pa.binary())], ["lang", "at", "bits"]).filter(pa.array(ok))

    sample = map_slices(picked, bits, "lang string, at long, bits binary", "_text").dropDuplicates(["lang", "at"])
    sample = sorted((r.lang, r.at, bytes(r.bits)) for r in sample.collect())
    seen = np.unpackbits(np.frombuffer(b"".join(s[2] for s in sample), np.uint8)).reshape(-1, PLACES)
    return solve(seen, [s[0] for s in sample], params)


def classify(docs: DataFrame, model: LanguageModel, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, ``lang_pred``, ``score`` (0 to 1) and ``accepted`` for every row of ``docs``.

    A text that is null, empty or without a letter gets ``und`` and score 0. Equal scores go to
    the first language by name. Only the text is looked at; other columns are ignored.
    """
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        pred, score, accepted = model.predict(batch.column("_text"))
        return pa.RecordBatch.from_arrays([batch.column("_key"), pa.array(pred, pa.string()),
                                           pa.array(score), pa.array(accepted)], [key, "lang_pred", "score", "accepted"])

    narrow = docs.select(docs[key].alias("_key"), docs[text].alias("_text"))
    kind = narrow.schema["_key"].dataType.simpleString()
    return map_slices(narrow, run, f"`{key}` {kind}, lang_pred string, score double, accepted boolean", "_text")


def keep_identified(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text is in a learned language.

    Rejected are texts without a letter (null and empty ones too) and texts whose best score is
    below the model's ``reject_below``.
    """
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(model.predict(batch.column(text))[2]))

    return map_slices(docs, run, docs.schema, text)
