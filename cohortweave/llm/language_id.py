"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Buckets of the hashed n-grams; lengths of the n-grams, in code points.
BUCKET_BITS = 15
ORDERS = (2, 3)
#: Added to every count.
SMOOTHING = 0.5
#: Code points that are scored together in a task.
CHARS_AT_ONCE = 1 << 20
#: What is broadcast is one float per language and bucket; more than this is an error.
MODEL_BYTES = 256 << 20
UNKNOWN = "und"

_LETTER = np.array([chr(i).isalpha() for i in range(1 << 16)])


def _letters(text: str) -> np.ndarray:
    """Lower-case code points with everything that is no letter as a space."""
    codes = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    letter = _LETTER[np.minimum(codes, 0xFFFF)]
    for i in np.flatnonzero(codes > 0xFFFF):
        letter[i] = chr(codes[i]).isalpha()
    return np.where(letter, codes, np.uint32(32))


def ngram_buckets(codes: np.ndarray) -> np.ndarray:
    """The buckets of all n-grams that hold a letter, of text with a space before and after."""
    padded = np.r_[np.uint32(32), codes, np.uint32(32)].astype(np.uint32)
    out = []
    for n in ORDERS:
        count = max(0, len(padded) - n + 1)
        total, blank = np.full(count, n, np.uint32), np.ones(count, bool)
        for i in range(n):
            part = padded[i : i + count]
            total = (total ^ part) * np.uint32(0x9E3779B1)
            total ^= total >> np.uint32(15)
            blank &= part == 32
        out.append((total[~blank] >> np.uint32(32 - BUCKET_BITS)).astype(np.int64))
    return np.concatenate(out)


def pieces_of(text: str | None) -> Iterator[np.ndarray]:
    """The text's n-gram buckets, piece by piece, so that a very long text needs little memory.

    Pieces overlap by the longest n-gram less one; the few n-grams that this counts twice are
    one in a hundred thousand.
    """
    text, most = text or "", max(ORDERS) - 1
    for at in range(0, len(text), CHARS_AT_ONCE):
        codes = _letters(text[max(0, at - most) : at + CHARS_AT_ONCE])
        if (codes != 32).any():
            yield ngram_buckets(codes)


def held_out() -> F.Column:
    """A quarter of the documents, by the CRC-32 of doc_id as text; a null doc_id is learned from."""
    text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 4 == 2


def ngram_counts(docs: DataFrame, langs: list[str]) -> DataFrame:
    """(lang index, bucket, n) summed over all of docs; each task sends one row per cell it met."""
    index = {lang: i for i, lang in enumerate(langs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(index), 1 << BUCKET_BITS), np.int64)
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for buckets in pieces_of(text):
                    total[index[lang]] += np.bincount(buckets, minlength=1 << BUCKET_BITS)
        at, bucket = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), pa.array(bucket.astype(np.int32)), pa.array(total[at, bucket])], names=["lang", "bucket", "n"]
        )

    rows = docs.select("text", "lang").mapInArrow(run, "lang int, bucket int, n long")
    return rows.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """(languages, log probabilities and, last, log priors) from (text, lang) with lang not null."""
    counted = docs.where(F.col("lang").isNotNull()).groupBy("lang").count().orderBy("lang").collect()
    langs = [r["lang"] for r in counted]
    if len(langs) << (BUCKET_BITS + 3) > MODEL_BYTES:
        raise ValueError(f"{len(langs)} languages: the model would be larger than is broadcast")
    counts = np.full((len(langs), (1 << BUCKET_BITS) + 1), SMOOTHING)
    if langs:
        for lang, bucket, n in ngram_counts(docs.where(F.col("lang").isNotNull()), langs).collect():
            counts[lang, bucket] += n
    model = np.log(counts / np.maximum(counts.sum(1, keepdims=True), 1e-300))
    model[:, -1] = np.log([r["count"] for r in counted]) if langs else 0
    return langs, model


def identify(docs: DataFrame, langs: list[str], model: np.ndarray) -> DataFrame:
    """docs' columns, lang_pred and score: the posterior probability of the prediction.

    Only the text is used. A text that is null or has no letter is `und` with a score of 0,
    as is every text if no language was learned. Equal posteriors go to the first language in
    order. lang_pred and score must be free names in docs.
    """
    sent = docs.sparkSession.sparkContext.broadcast((langs, model))
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, model = sent.value
        cells = np.ascontiguousarray(model[:, :-1])
        for batch in batches:
            predicted, scores = [], []
            for text in batch.column("text").to_pylist():
                total, seen = model[:, -1].copy(), False
                for buckets in pieces_of(text):
                    seen = True
                    total += [row[buckets].sum() for row in cells]
                if not seen or not langs:
                    predicted.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                best = int(total.argmax())
                predicted.append(langs[best])
                scores.append(float(1 / np.exp(total - total[best]).sum()))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(predicted, pa.string()), pa.array(scores, pa.float64())],
                names=[*names, "lang_pred", "score"],
            )

    from pyspark.sql import types as T

    added = T.StructType().add("lang_pred", "string").add("score", "double")
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *added.fields]))


def identify_held_out(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of docs, learned from the other three quarters.

    The model comes from text and non-null lang of documents that are not held out.
    """
    marked = docs.select("doc_id", "text", "lang", held_out().alias("held_out"))
    langs, model = train(marked.where(~F.col("held_out")).select("text", "lang"))
    return identify(marked.select("doc_id", "held_out", "text"), langs, model).drop("text")
