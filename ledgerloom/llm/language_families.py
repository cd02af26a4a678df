"""Language identification in two levels.

1. A text becomes the square roots of its relative counts of letter sequences (one to four bytes of lower-cased letters and word
   boundaries, hashed into ``BINS``): a unit vector, whatever the length. Counts are summed over the whole text, piece by piece.
2. A logistic model over all families (``FAMILIES``) predicts the language family.
3. Within the family, linear support vector machines - one for every two of its languages - vote; they are fitted on texts
   of these two languages alone, so they weigh what tells close relatives apart. A language's vote is the mean of its machines'
   sigmoids. The score is the probability of the family times the winner's vote.

Models are fitted on a bounded sample of labelled rows: ``TRAIN_ROWS`` in equal parts for the languages, at most ``LANGUAGES`` of them
(the most frequent), each text as a whole and as a few of its words, so that short texts are known too. All rows are then
predicted where they are, without a shuffle. A hot language takes no larger part of the sample than others.

NULL texts and texts without a letter are ``und`` with score 0. Without any labelled text all are. With one learned language
every text with letters gets it. Rows without a language or without letters teach nothing. Predictions depend on the text alone, so equal
texts get equal ones, and ids, repeated rows and extra columns don't matter; working columns take free names. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded, free_name, read, seeded_hash, unit_interval

# Language codes by family. Languages that stand nowhere share the family "other".
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fo", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "baltic": ("lt", "lv"),
    "celtic": ("br", "cy", "ga", "gd"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "ky", "tk", "tr", "uz"),
    "indo-iranian": ("bn", "fa", "gu", "hi", "ku", "mr", "ne", "pa", "ps", "si", "ur"),
    "semitic": ("am", "ar", "he", "mt"),
    "dravidian": ("kn", "ml", "ta", "te"),
    "austronesian": ("id", "jv", "mg", "ms", "su", "tl"),
}
UNKNOWN = "und"

BINS = 4096
#: Longest sequence, in bytes.
GRAM = 4
TRAIN_ROWS = 3000
LANGUAGES = 64
#: Words of the short piece that a training text adds.
PIECE_WORDS = 6
#: Rows of a language that compete for its part of the sample, as a multiple of that part.
CANDIDATES = 4
ROUNDS = 300
DECAY = 1e-4
#: How fast a margin becomes a vote of 0 or 1.
SLOPE = 4.0
#: Bytes of a text that are counted at a time.
CHUNK = 1 << 20

# Letters and bytes of letters beyond ASCII stay, all else is a boundary.
_CLEAN = np.array([b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256)], np.uint8)
_MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)
_TOP_BITS = np.uint32(32 - int(np.log2(BINS)))


def family(language: str) -> str:
    base = language.lower().replace("_", "-").split("-")[0]
    return next((name for name, codes in FAMILIES.items() if base in codes), "other")


def letters(text: str) -> np.ndarray:
    """Lower-cased letters as bytes, with single spaces between and around words."""
    raw = _CLEAN[np.frombuffer(f" {text.lower()} ".encode("utf-8", "surrogatepass"), np.uint8)]
    keep = raw != 32
    keep[1:] |= raw[:-1] != 32
    keep[0] = True
    return raw[keep]


def counted(data: np.ndarray) -> np.ndarray:
    """How often each bin's sequences occur in ``letters``, over all of them."""
    counts = np.zeros(BINS, np.int64)
    for at in range(0, len(data), CHUNK):
        # A sequence belongs to the piece in which it starts.
        piece = data[at : at + CHUNK + GRAM - 1].astype(np.uint32)
        starts = min(CHUNK, len(data) - at)
        hashed = np.zeros(len(piece), np.uint32)
        for k in range(GRAM):
            whole = len(piece) - k
            if whole <= 0:
                break
            hashed = (hashed[:whole] * np.uint32(0x01000193)) ^ (piece[k:] * _MIX[k])
            mixed = (hashed[:starts] ^ (hashed[:starts] >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            counts += np.bincount(mixed >> _TOP_BITS, minlength=BINS)
    return counts


def features(text: str) -> np.ndarray:
    """A unit vector; zero for a text without letters."""
    counts = counted(letters(text))
    return np.sqrt(counts / max(counts.sum(), 1)).astype(np.float32)


def short_piece(text: str) -> str:
    """Some words in the middle of a text."""
    words = text.split()
    at = max(0, (len(words) - PIECE_WORDS) // 2)
    return " ".join(words[at : at + PIECE_WORDS])


def descended(gradient: Callable[[np.ndarray], np.ndarray], start: np.ndarray, rate: float, rounds: int) -> np.ndarray:
    """Minimum of a smooth convex function by accelerated descent."""
    now, ahead = start, start
    for k in range(rounds):
        after = ahead - rate * gradient(ahead)
        ahead = after + (k / (k + 3)) * (after - now)
        now = after
    return now


def with_one(rows: np.ndarray) -> np.ndarray:
    """Rows with a constant, for the offset."""
    return np.hstack([rows, np.ones((len(rows), 1), rows.dtype)])


def fit_logistic(rows: np.ndarray, classes: np.ndarray, count: int) -> np.ndarray:
    """Weights (columns are classes) of a logistic model; classes weigh the same."""
    x, y = with_one(rows), np.eye(count, dtype=np.float32)[classes]
    weight = (1 / np.maximum(y.sum(axis=0), 1))[classes][:, None] / count

    def gradient(w: np.ndarray) -> np.ndarray:
        z = x @ w
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return x.T @ (weight * (z / z.sum(axis=1, keepdims=True) - y)) + DECAY * w

    return descended(gradient, np.zeros((x.shape[1], count), np.float32), 1.0, ROUNDS)


def fit_machine(rows: np.ndarray, sign: np.ndarray) -> np.ndarray:
    """Weights of a linear support vector machine with squared hinge loss; ``sign`` is 1 or -1, and both sides weigh the same."""
    x = with_one(rows)
    weight = np.where(sign > 0, 0.5 / max((sign > 0).sum(), 1), 0.5 / max((sign < 0).sum(), 1)).astype(np.float32)

    def gradient(w: np.ndarray) -> np.ndarray:
        missing = np.maximum(0, 1 - sign * (x @ w))
        return -2 * (x.T @ (weight * sign * missing)) + DECAY * w

    return descended(gradient, np.zeros(x.shape[1], np.float32), 0.24, ROUNDS)


@dataclass(frozen=True)
class Model:
    families: list[str]
    family_weights: np.ndarray  # BINS + 1 rows
    languages: dict[str, list[str]]  # by family
    machines: dict[str, np.ndarray]  # by family: BINS + 1 rows, a column for every two languages in order

    def predict(self, rows: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and score of feature rows."""
        x = with_one(rows)
        z = x @ self.family_weights
        z = np.exp(z - z.max(axis=1, keepdims=True))
        z /= z.sum(axis=1, keepdims=True)
        chosen, score = z.argmax(axis=1), z.max(axis=1).astype(np.float64)
        names = [""] * len(rows)
        for f in np.unique(chosen):
            here = np.flatnonzero(chosen == f)
            languages = self.languages[self.families[f]]
            votes = np.zeros((len(here), len(languages)))
            pairs = list(combinations(range(len(languages)), 2))
            if pairs:
                sure = 1 / (1 + np.exp(-SLOPE * (x[here] @ self.machines[self.families[f]])))
                for k, (a, b) in enumerate(pairs):
                    votes[:, a] += sure[:, k] / (len(languages) - 1)
                    votes[:, b] += (1 - sure[:, k]) / (len(languages) - 1)
                score[here] *= votes.max(axis=1)
            for row, language in zip(here.tolist(), votes.argmax(axis=1).tolist(), strict=True):
                names[row] = languages[language]
        return names, np.clip(score, 0, 1)


def fit(rows: np.ndarray, labels: Sequence[str]) -> Model | None:
    """Both levels from feature rows and their languages; None without rows."""
    if not len(labels):
        return None
    spoken = np.array(labels)
    kin = np.array([family(language) for language in labels])
    families = sorted(set(kin))
    languages = {f: sorted(set(spoken[kin == f])) for f in families}
    family_weights = fit_logistic(rows, np.searchsorted(families, kin), len(families))
    machines = {}
    for f, names in languages.items():
        columns = []
        for a, b in combinations(names, 2):
            two = (spoken == a) | (spoken == b)
            columns.append(fit_machine(rows[two], np.where(spoken[two] == a, 1, -1).astype(np.float32)))
        machines[f] = np.stack(columns, axis=1) if columns else np.zeros((rows.shape[1] + 1, 0), np.float32)
    return Model(families, family_weights, languages, machines)


def has_letters(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def training_rows(df: DataFrame, row_id: str, text: str, language: str, rows: int = TRAIN_ROWS, languages: int = LANGUAGES) -> tuple[np.ndarray, list[str]]:
    """Features and languages of the sample: whole texts and short pieces of them.

    Of each language the rows with the lowest digests of id and text are drawn. Its row count says below which digest they lie, so
    about ``CANDIDATES`` times as many rows as wanted are sent on, however many a language has.
    """
    df = df.select(F.col(row_id).alias("id"), F.col(text).alias("text"), F.col(language).cast("string").alias("lang"))
    usable = df.where(F.col("lang").isNotNull() & has_letters(F.col("text")))
    frequent = usable.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(languages).collect()
    each = max(1, rows // max(1, len(frequent)))
    highest = F.lit(None).cast("double")
    for r in frequent:
        highest = F.when(F.col("lang") == r.lang, F.lit(CANDIDATES * each / r.n)).otherwise(highest)
    digest = seeded_hash("language", F.concat_ws(":", F.col("id").cast("string"), F.md5(F.col("text").cast("binary"))))
    keyed = usable.withColumn("key", digest).where(unit_interval(F.col("key")) <= highest)
    place = F.row_number().over(Window.partitionBy("lang").orderBy("key"))

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spoken, found = [], []
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for part in (value, short_piece(value)):
                    spoken.append(name)
                    found.append(features(part).astype(np.float16).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(spoken, pa.string()), pa.array(found, pa.binary())], ["lang", "found"])

    drawn = keyed.withColumn("place", place).where(F.col("place") <= each).select("lang", "text")
    taught = drawn.mapInArrow(extracted, "lang string, found binary").collect()
    taught.sort(key=lambda r: (r.lang, bytes(r.found)))  # so that the order of tasks doesn't matter
    matrix = np.frombuffer(b"".join(bytes(r.found) for r in taught), np.float16).reshape(-1, BINS).astype(np.float32)
    return matrix, [r.lang for r in taught]


def _predicted(model: Model | None):
    @F.arrow_udf("struct<language:string,score:double>")
    def predicted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            names: list[str | None] = [UNKNOWN] * len(batch)
            scores = np.zeros(len(batch))
            texts = [(k, t) for k, t in enumerate(batch.to_pylist()) if t is not None]
            if model and texts:
                found, score = model.predict(np.stack([features(t) for _, t in texts]))
                for (k, _), name, value in zip(texts, found, score.tolist(), strict=True):
                    names[k], scores[k] = name, value
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores)], ["language", "score"])

    return predicted


def with_language(df: DataFrame, model: Model | None, text: str = "text", language: str = "lang_pred", score: str = "score") -> DataFrame:
    """``df`` with the predicted language of each text and its score."""
    both = free_name(df, "_language")
    # Texts without letters reach no model.
    spoken = F.when(has_letters(F.col(text)), F.col(text))
    found = bounded(df).withColumn(both, _predicted(model)(spoken))
    return found.withColumns({language: F.col(both)["language"], score: F.col(both)["score"]}).drop(both)


def op12_language_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    # Rows without an id are not held out.
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = fit(*training_rows(bounded(documents).where(~held_out), "doc_id", "text", "lang"))
    return with_language(documents.select("doc_id", held_out.alias("held_out"), "text"), model).drop("text")
