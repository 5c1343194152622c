"""Language identification by mixture inference.

Learning: letter trigrams of all learnable texts, hashed to ``BUCKETS``, counted
by language; at most languages x BUCKETS sums come to the driver. Predicting:
each text is a mixture of languages; expectation-maximisation finds the
proportions that make its trigrams likeliest. The language set is grown from
the likeliest single language, in order of proportion, while the likelihood
gain is above a penalty for each language; the largest part of the set is the
language, its proportion the score.

Edge cases: a null text or one without a letter gives ``und`` with score 0; no
learnable row at all gives ``und`` for every text; repeated rows stay; an empty
table gives an empty result. Ties go to the first language by code point.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import common

BUCKETS = 1 << 14
STEPS = 8
#: Characters of a text taken at once.
PIECE = 1 << 20
#: What one more language must gain: so many times the logarithm of the trigram count.
PENALTY = 6.0
UNKNOWN = "und"


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)], bool)


def trigrams(text: str | None) -> Iterator[np.ndarray]:
    """Buckets of the trigrams of a text's letters, all else one space, piece by piece; none if there is no letter."""
    text, found, last = text or "", False, np.array([32], np.uint64)
    at = 0
    while at < len(text):
        to = len(text) if len(text) - at <= PIECE else at + PIECE
        # A piece ends at a space where there is one, as lower case depends on the letters around.
        if to < len(text) and (space := text.rfind(" ", at, to)) > at:
            to = space
        codes = np.frombuffer(text[at:to].lower().encode("utf-32-le", "replace"), "<u4")
        at = to
        is_letter = letters()[codes]
        found |= bool(is_letter.any())
        codes = np.where(is_letter, codes, 32).astype(np.uint64)
        codes = np.concatenate([last, codes, np.array([32], np.uint64)] if at == len(text) else [last, codes])
        codes = codes[np.r_[True, (codes[1:] != 32) | (codes[:-1] != 32)]]
        if found and len(codes) > 2:
            mix = codes[:-2] * np.uint64(0x9E3779B1) + codes[1:-1] * np.uint64(0x85EBCA77) + codes[2:] * np.uint64(0xC2B2AE3D)
            mix ^= mix >> np.uint64(15)
            yield ((mix * np.uint64(0x27D4EB2F)) >> np.uint64(12)).astype(np.int64) & (BUCKETS - 1)
        last = codes[-2:]


def gram_counts(text: str | None) -> np.ndarray:
    """Number of a text's trigrams by bucket."""
    total = np.zeros(BUCKETS, np.int64)
    for grams in trigrams(text):
        total += np.bincount(grams, minlength=BUCKETS)
    return total


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


class Model:
    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        self.chance = np.ascontiguousarray(((counts + 0.5) / (counts + 0.5).sum(axis=0)).astype(np.float64))
        self.log = np.log(self.chance)

    def fit(self, chance: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
        """Proportions by expectation-maximisation, and the log-likelihood."""
        k = chance.shape[1]
        part, total = np.full(k, 1 / k), weight.sum()
        for _ in range(STEPS):
            part = part * ((weight / (chance @ part)) @ chance) / total
        return part, float(weight @ np.log(chance @ part))

    def predict(self, text: str | None) -> tuple[str, float]:
        total = gram_counts(text) if self.languages and text else np.zeros(0, np.int64)
        seen = np.flatnonzero(total)
        if not len(seen):
            return UNKNOWN, 0.0
        weight = total[seen].astype(np.float64)
        chance = self.chance[seen]
        single = weight @ self.log[seen]
        first = int(np.argmax(single))
        part, _ = self.fit(chance, weight)
        order = [first, *[int(k) for k in np.argsort(-part, kind="stable") if k != first]]
        chosen, share, best = [first], np.ones(1), float(single[first])
        penalty = PENALTY * np.log(weight.sum() + 1)
        for k in order[1:]:
            if part[k] < 0.02:
                break
            more, gained = self.fit(chance[:, [*chosen, k]], weight)
            if gained - best < penalty:
                break
            chosen, share, best = [*chosen, k], more, gained
        top = min(range(len(chosen)), key=lambda c: (-share[c], self.languages[chosen[c]]))
        return self.languages[chosen[top]], float(min(1.0, share[top]))


def learn(rows: DataFrame) -> Model:
    """The model of rows (text, lang) with both known."""

    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for b in common.rows_of(batches):
            for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if lang not in sums:
                    sums[lang] = np.zeros(BUCKETS, np.int64)
                sums[lang] += gram_counts(text)
        for lang, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(total[at])], ["lang", "bucket", "n"])

    found = rows.select(common.col("text"), common.col("lang")).where("text IS NOT NULL AND lang IS NOT NULL").mapInArrow(common.tidied(run), "lang string, bucket int, n long")
    table = found.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names, at = np.unique(np.array(table["lang"].to_pylist(), dtype=object), return_inverse=True) if table.num_rows else ([], [])
    counts = np.zeros((BUCKETS, len(names)))
    counts[table["bucket"].to_numpy(), at] = table["n"].to_numpy()
    return Model([str(x) for x in names], counts)


def predict(docs: DataFrame, model: Model, text_col: str = "text", carry: tuple[str, ...] = (), lang_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """(*carry, lang_pred, score) of every row, from its text alone; carried columns may have any names."""
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.chance))

    def run(batches):
        own = Model.__new__(Model)
        own.languages, own.chance = shared.value
        own.log = np.log(own.chance)
        for b in common.rows_of(batches):
            found = [own.predict(t) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], [*b.schema.names[1:], common.private("lang"), common.private("score")])

    names = {c: common.private(f"carry_{k}") for k, c in enumerate(carry)}
    rows = docs.select(common.col(text_col).alias(common.private("text")), *(common.col(c).alias(x) for c, x in names.items()))
    kind = T.StructType([*rows.schema.fields[1:], T.StructField(common.private("lang"), T.StringType()), T.StructField(common.private("score"), T.DoubleType())])
    found = rows.mapInArrow(common.tidied(run), kind)
    return found.select(*(F.col(x).alias(c) for c, x in names.items()), F.col(common.private("lang")).alias(lang_col), F.col(common.private("score")).alias(score_col))


def identified(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): learned from rows not held out, predicted for all."""
    rows = docs.select("doc_id", "text", "lang").withColumn("held_out", held_out(F.col("doc_id")))
    model = learn(rows.where("NOT held_out"))
    return predict(rows, model, carry=("doc_id", "held_out")).select("doc_id", "held_out", "lang_pred", "score")
