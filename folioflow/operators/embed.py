"""Embedding of texts by a replaceable encoder, and pooling of vectors.

An encoder is given as a factory: `factory() -> encode(texts: list[str]) -> array[n, d]`.
It is loaded on the executors, once per worker process, which keeps it for later tasks and
queries with the same factory. A call has to give one row per text; any other result
counts as a failed call. Texts of one Arrow batch are handed over in the order of their
length, so that an encoder which pads a call to its longest text pads little.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow import schemas
from folioflow.functions.text import (
    MAX_TEXT_BYTES, MAX_TEXT_CHARS, encoder_input, strip_for_encoder, truncate_bytes,
)
from folioflow.functions.vectors import NORM_FLOOR
from folioflow.operators.quality import response_reason, text_reason

TEXTS_PER_CALL = 256
#: Encoders that a worker process keeps loaded.
LOADED = 2

EncoderFactory = Callable[[], Callable[[list[str]], np.ndarray]]

# The error classes with their messages.
VALIDATION_ERROR = "VALIDATION_ERROR"
MODEL_LOAD_ERROR = ("MODEL_LOAD_ERROR", "Model temporarily unavailable")
EMBEDDING_ERROR = ("EMBEDDING_ERROR", "Failed to generate embedding")
RESPONSE_ERROR = "INVALID_RESPONSE"


_loaded: dict[str, Callable[[list[str]], np.ndarray]] = {}


def _load(key: str, factory: EncoderFactory) -> Callable[[list[str]], np.ndarray]:
    """The encoder of a factory, from this worker process if it is there. One that fails to load is tried again."""
    if key not in _loaded:
        encode = factory()
        while len(_loaded) >= LOADED:
            _loaded.pop(next(iter(_loaded)))
        _loaded[key] = encode
    return _loaded[key]


def letter_counts(letters: str = "abcdefghijklmnopqrstuvwxyz") -> Callable[[list[str]], np.ndarray]:
    """Stand-in encoder for tests: counts of some ASCII letters. It is not a language model."""
    codes = np.frombuffer(letters.encode("ascii"), np.uint8)

    def encode(texts: list[str]) -> np.ndarray:
        rows = [np.bincount(np.frombuffer(t.encode("utf-8"), np.uint8), minlength=256)[codes] for t in texts]
        return np.array(rows, dtype=np.float64)

    return encode


def _normalized(vectors: np.ndarray) -> np.ndarray:
    norms = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    return vectors / np.maximum(norms, NORM_FLOOR)


def _encode_chunk(encode: Callable, texts: list[str]) -> list[np.ndarray | None]:
    """Vectors of some texts; when the call fails the texts are tried one by one."""
    try:
        vectors = np.asarray(encode(texts), dtype=np.float64)
        if vectors.ndim != 2 or len(vectors) != len(texts):
            raise ValueError(f"{vectors.shape} for {len(texts)} texts")
        return list(vectors)
    except Exception:
        if len(texts) == 1:
            return [None]
        return [v for t in texts for v in _encode_chunk(encode, [t])]


def _pieces(text: str, max_bytes: int, max_chars: int) -> list[str]:
    """The text itself where it fits, else pieces that fit whatever their characters."""
    if len(text) <= max_chars and len(text.encode("utf-8")) <= max_bytes:
        return [text]
    size = min(max_chars, max_bytes // 4)
    return [text[i:i + size] for i in range(0, len(text), size)]


def _encode_rows(
    encode: Callable, texts: list[str], normalize: bool, max_bytes: int, max_chars: int
) -> list[np.ndarray | None]:
    """One vector per text: the mean over its pieces, weighted by their length. A failed piece fails its text."""
    cut = [_pieces(t, max_bytes, max_chars) for t in texts]
    flat = [piece for pieces in cut for piece in pieces]
    by_length = sorted(range(len(flat)), key=lambda i: len(flat[i]))
    vectors_of: list[np.ndarray | None] = [None] * len(flat)
    for i in range(0, len(flat), TEXTS_PER_CALL):
        call = by_length[i:i + TEXTS_PER_CALL]
        for place, vector in zip(call, _encode_chunk(encode, [flat[k] for k in call])):
            vectors_of[place] = vector
    found = iter(vectors_of)
    rows: list[np.ndarray | None] = []
    for pieces in cut:
        vectors = [next(found) for _ in pieces]
        if any(v is None or len(v) != len(vectors[0]) for v in vectors):
            rows.append(None)
            continue
        pooled = vectors[0] if len(pieces) == 1 else np.average(vectors, axis=0, weights=[len(p) for p in pieces])
        rows.append(_normalized(pooled[None, :])[0] if normalize else pooled)
    return rows


def _embedder(factory: EncoderFactory, model_version: str, normalize: bool, max_bytes: int, max_chars: int):
    """Iterator Arrow UDF from encoder inputs (null = not usable) to embedding results."""
    key = hashlib.sha256(cloudpickle.dumps(factory)).hexdigest()

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode, load_failed = None, False
        for inputs in batches:
            if encode is None and not load_failed:
                try:
                    encode = _load(key, factory)
                except Exception:
                    load_failed = True
            started = time.perf_counter()
            texts = inputs.drop_null().to_pylist()
            found = iter([None] * len(texts) if load_failed else _encode_rows(encode, texts, normalize, max_bytes, max_chars))
            error = MODEL_LOAD_ERROR if load_failed else EMBEDDING_ERROR
            usable = inputs.is_valid().to_pylist()
            vectors = [next(found) if ok else None for ok in usable]
            errors = [error if ok and v is None else (None, None) for ok, v in zip(usable, vectors)]
            share_ms = int((time.perf_counter() - started) * 1000 / max(len(vectors), 1))
            columns = [
                pa.array(vectors, pa.list_(pa.float64()), from_pandas=False),
                pa.array([None if v is None else model_version for v in vectors], pa.string()),
                pa.array([None if v is None else len(v) for v in vectors], pa.int32()),
                pa.array([share_ms] * len(vectors), pa.int64()),
                pa.array([code for code, _ in errors], pa.string()),
                pa.array([message for _, message in errors], pa.string()),
            ]
            yield pa.StructArray.from_arrays(columns, names=schemas.EMBEDDING_RESULT.fieldNames())

    # Not deterministic in the optimizer's sense: it must be run once per row and not be
    # copied into the expressions above it. Arrow keeps NaN apart from null, pandas does not.
    return F.arrow_udf(run, schemas.EMBEDDING_RESULT).asNondeterministic()


def embed_texts(
    texts: DataFrame, factory: EncoderFactory = letter_counts, model_version: str = "letter-counts",
    normalize: bool = True, text: str = "text", tasks: int | None = None,
    max_bytes: int = MAX_TEXT_BYTES, max_chars: int = MAX_TEXT_CHARS, truncate: bool = False,
) -> DataFrame:
    """Add embedding, model_version, dimension, processing_time_ms, error_code, error_message.

    A text above the limits is cut into pieces, and their vectors are averaged by length and
    then normalized. With `truncate` only what the limits leave of a text is embedded.
    Validation and stripping are built-in expressions; only the encoder input goes to Python, all other columns stay behind. A row that fails does not stop the others, and
    an encoder that cannot be loaded marks the rows and not the job. Partitions are sized
    by bytes, which are few where an encoder is slow: `tasks` spreads the texts wider.
    """
    texts = texts if tasks is None else texts.repartition(tasks)
    reason = text_reason(truncate_bytes(F.col(text), max_bytes) if truncate else F.col(text))
    usable = encoder_input(F.col(text), max_bytes, max_chars) if truncate else strip_for_encoder(F.col(text))
    encoded = texts.withColumns({
        "_reason": reason, "_input": F.when(reason.isNull(), usable),
    }).withColumn("_r", _embedder(factory, model_version, normalize, max_bytes, max_chars)("_input"))
    return encoded.select(
        *texts.columns, "_r.embedding", "_r.model_version", "_r.dimension", "_r.processing_time_ms",
        F.when(F.col("_reason").isNotNull(), VALIDATION_ERROR).otherwise(F.col("_r.error_code")).alias("error_code"),
        F.coalesce("_reason", "_r.error_message").alias("error_message"),
    )


def check_responses(embedded: DataFrame) -> DataFrame:
    """Turn successful rows whose response is not valid into failed ones."""
    reason = F.when(
        F.col("error_code").isNull(),
        response_reason(F.col("embedding"), F.col("dimension"), F.col("model_version")),
    )
    return embedded.withColumn("_bad", reason).withColumns({
        "error_code": F.when(F.col("_bad").isNotNull(), RESPONSE_ERROR).otherwise(F.col("error_code")),
        "error_message": F.coalesce("_bad", "error_message"),
    }).drop("_bad")


def mean_pool(vectors: DataFrame, key: str, vector: str = "embedding") -> DataFrame:
    """Mean vector per key. Partial sums are kept per task, the vectors are not exploded."""
    dense = array_to_vector(F.col(vector).cast("array<double>"))
    return vectors.groupBy(key).agg(vector_to_array(Summarizer.mean(dense)).alias(vector))
