"""Language identification with hyperdimensional profiles.

Every letter has a fixed random vector of +1 and -1; a letter n-gram is the product of its letters'
vectors, each rotated by its place in the n-gram; a text is the sum of its n-grams' vectors, and a language the sum
of its texts. The language of a text is the one whose prototype has the highest cosine with it.

A letter is a character of Unicode category L, lower-cased; n-grams do not span other characters but
one blank, which stands for any stretch of them and counts as a letter.

Learning bundles on the executors: sums of +1 and -1 are integers, so prototypes do not depend on the order of
rows, and DIMENSIONS numbers per language reach the driver. Letters beyond the class table share classes by code point.

Null texts and texts without a letter are `und` with score 0; so is every text when nothing was learned. Ties go
to the first language in order. Repeated rows count as often as they are there, in learning, and come back as
often; whole texts count, whatever their length; an empty table gives no rows; `columns` may be called
anything but `lang_pred` and `score`, which are added.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.llm.common import batches, bound_batches

DIMENSIONS, GRAM, SEED, PART = 1024, 3, 20, 2048
BUCKETS, LATIN, BLANK, CODES = 96, 60, 0, 0x32400


@lru_cache(maxsize=1)
def letter_classes() -> np.ndarray:
    """Class of every code point below CODES: 0 for all but letters, which are lower-cased first.

    a-z and the lower-case letters of Latin-1 have a class each, other letters share the rest.
    """
    classes = np.zeros(CODES, np.uint8)
    for code in range(CODES):
        char = chr(code)
        if unicodedata.category(char)[0] == "L":
            low = ord(char.lower()[0])
            latin = low - 96 if 97 <= low <= 122 else low - 196 if 223 <= low <= 255 else 0
            classes[code] = latin or LATIN + low % (BUCKETS - LATIN)
    return classes


@lru_cache(maxsize=1)
def letter_vectors() -> np.ndarray:
    return np.random.default_rng(SEED).choice(np.array([-1, 1], np.int8), (BUCKETS, DIMENSIONS))


def gram_vectors(grams: np.ndarray) -> np.ndarray:
    """One row of +1 and -1 per n-gram number."""
    letters, out = letter_vectors(), None
    for place in range(GRAM):
        own = np.roll(letters, GRAM - 1 - place, axis=1)[(grams // BUCKETS ** (GRAM - 1 - place)) % BUCKETS]
        out = own if out is None else out * own
    return out


def text_grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the n-grams of a text and how often each occurs; nothing for texts without a letter."""
    none = np.zeros(0, np.int64)
    if not text:
        return none, none
    codes = np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = letter_classes()[np.where(codes < CODES, codes, 0)]
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != BLANK) | (codes[:-1] != BLANK)
    codes = codes[keep].astype(np.int64)
    if len(codes) < GRAM:
        return none, none
    return np.unique(codes[:-2] * BUCKETS**2 + codes[1:-1] * BUCKETS + codes[2:], return_counts=True)


def text_gram_lists(texts: list[str | None]):
    """Grams, counts and bounds of many texts."""
    found = [text_grams(t) for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(g) for g, _ in found])]).astype(np.int64)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *[g for g, _ in found]]), np.concatenate([none, *[c for _, c in found]]), bounds


class Prototypes(NamedTuple):
    languages: list[str]
    vectors: np.ndarray  # unit rows

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        grams, counts, bounds = text_gram_lists(texts)
        names, scores = ["und"] * len(texts), [0.0] * len(texts)
        if not self.languages:
            return names, scores
        known, place = np.unique(grams, return_inverse=True)
        table = gram_vectors(known).astype(np.float32)
        for i in range(len(texts)):
            own = slice(bounds[i], bounds[i + 1])
            if own.start == own.stop:
                continue
            bundle = counts[own].astype(np.float32) @ table[place[own]]
            cosines = self.vectors @ bundle / max(float(np.sqrt(bundle @ bundle)), 1e-9)
            best = int(cosines.argmax())
            names[i], scores[i] = self.languages[best], float(min(1.0, max(0.0, (1 + cosines[best]) / 2)))
        return names, scores


def learned(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Prototypes:
    """Prototypes from rows (text, lang); rows without either are left out."""
    bound_batches(labelled.sparkSession)

    def bundle(it):
        sums: dict[str, np.ndarray] = {}
        for batch in batches(it):
            grams, counts, bounds = text_gram_lists(batch.column(0).to_pylist())
            spoken = batch.column(1).to_pylist()
            text = np.repeat(np.arange(len(spoken)), np.diff(bounds))
            names = sorted(set(spoken))
            speech = np.array([names.index(s) for s in spoken])[text]
            cells, place = np.unique(speech * BUCKETS**GRAM + grams, return_inverse=True)
            total = np.bincount(place, counts, len(cells))
            for at in range(0, len(cells), PART):
                own, vectors = cells[at : at + PART], gram_vectors(cells[at : at + PART] % BUCKETS**GRAM)
                for i in np.unique(own // BUCKETS**GRAM):
                    of = own // BUCKETS**GRAM == i
                    known = sums.setdefault(names[i], np.zeros(DIMENSIONS, np.int64))
                    known += (total[at : at + PART][of] @ vectors[of].astype(float)).astype(np.int64)
        for lang, total in sums.items():
            columns = [pa.array([lang] * DIMENSIONS, pa.string()), pa.array(np.arange(DIMENSIONS)), pa.array(total)]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "place", "n"])

    rows = labelled.select(F.col(text_col).cast("string"), F.col(lang_col).cast("string").alias("lang")).na.drop()
    sums = rows.mapInArrow(bundle, "lang string, place long, n long").groupBy("lang", "place").agg(F.sum("n").alias("n"))
    found: dict[str, np.ndarray] = {}
    for row in sums.toLocalIterator():
        found.setdefault(row["lang"], np.zeros(DIMENSIONS))[row["place"]] = row["n"]
    found = {lang: found[lang] for lang in sorted(found) if found[lang].any()}
    vectors = [v / np.linalg.norm(v) for v in found.values()]
    return Prototypes(list(found), np.array(vectors, np.float32).reshape(len(found), DIMENSIONS))


def identified(docs: DataFrame, model: Prototypes, columns: list[str], text_col: str = "text") -> DataFrame:
    """`columns` of every row with lang_pred and score."""
    bound_batches(docs.sparkSession)
    schema = docs.select(*columns).schema.add("lang_pred", T.StringType()).add("score", T.DoubleType())
    names = schema.names

    def predict(it):
        for batch in batches(it):
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                langs, scores = model.predict(part.column(part.num_columns - 1).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=names)

    rows = docs.select(*columns, F.col(text_col).cast("string").alias("__text"))
    return rows.mapInArrow(predict, schema)
