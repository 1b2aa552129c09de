"""Texts for embedding, and embedding by a callable that the user brings.

An embedder maps a list of texts to a list of vectors. It is built once per task by ``factory``, takes batches of BATCH
texts, and a batch that fails gives zero vectors, which never match anything, and the reason beside them.
"""

from __future__ import annotations

import hashlib
import re
import time
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from innkeep.functions import occupancy
from innkeep.functions.columns import settled
from innkeep.sources import shared

BATCH = 32


def _first(*cols: str) -> Column:
    return F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in cols], F.lit(""))


def plain_texts(rooms: DataFrame) -> DataFrame:
    """text_for_embedding: the normalized code description, or the normalized description. Rooms without text go."""
    return rooms.withColumn("text_for_embedding", _first("normalized_code_description", "normalized_description")).where("text_for_embedding <> ''")


def described_texts(rooms: DataFrame, provider: str) -> DataFrame:
    """base_description, occupancy_text and text_for_embedding, in lower case. Rooms without hotel code or text go."""
    cols = ("normalized_code_description", "code_description") if provider == "hotelbeds" else ("normalized_description", "room_description", "room_name")
    out = settled(rooms.where("hotel_code <> ''"), "occupancy").withColumn("base_description", F.lower(_first(*cols))).withColumn("occupancy_text", F.coalesce(occupancy.describe(F.col("occupancy")), F.lit("")))
    out = settled(out, "base_description", "occupancy_text")
    text = F.when(F.col("occupancy_text") != "", F.concat("base_description", F.lit(". "), "occupancy_text")).otherwise(F.col("base_description"))
    return out.withColumn("text_for_embedding", text).where("text_for_embedding <> ''")


def hotel_texts(hotels: DataFrame, lower: bool = False) -> DataFrame:
    return hotels.withColumn("text_for_embedding", F.lower("hotel_name") if lower else F.col("normalized_hotel_name"))


class HashEmbedder:
    """Signed feature hashing of letter trigrams: a deterministic stand-in where no model is at hand."""

    def __init__(self, size: int = 256):
        self.size = size

    def __call__(self, texts: list[str]) -> list[list[float]]:
        out = []
        for t in texts:
            v = [0.0] * self.size
            s = f"  {t.lower()} "
            for i in range(len(s) - 2):
                h = int.from_bytes(hashlib.blake2b(s[i : i + 3].encode(), digest_size=8).digest(), "little")
                v[h % self.size] += 1.0 if h >> 63 else -1.0
            out.append(v)
        return out


class RemoteError(Exception):
    """A remote call that failed for good, after its retries."""


class RemoteEmbedder:
    """An embedder that calls a remote service: paced by a token bucket, with growing pauses between retries.

    call: a list of texts to a list of vectors. At most ``rate`` calls a second (none: no limit) after a burst of ``burst``, for
    each task; errors of the kinds ``transient`` are tried again ``retries`` times, after ``pause`` seconds, twice that, and so on up to
    ``longest``. Other errors are not of the service and go through.
    """

    def __init__(self, call: Callable[[list[str]], list], rate: float | None = None, burst: int = 1, retries: int = 4, pause: float = 0.5, longest: float = 30.0, transient: tuple = (ConnectionError, TimeoutError), clock=time.monotonic, sleep=time.sleep):
        self.call, self.rate, self.burst, self.retries, self.pause, self.longest, self.transient = call, rate, burst, retries, pause, longest, transient
        self.clock, self.sleep = clock, sleep
        self.tokens, self.filled = float(burst), clock()

    def _take(self) -> None:
        """Wait for a token."""
        if self.rate is None:
            return
        while True:
            now = self.clock()
            self.tokens, self.filled = min(float(self.burst), self.tokens + (now - self.filled) * self.rate), now
            if self.tokens >= 1:
                self.tokens -= 1
                return
            self.sleep((1 - self.tokens) / self.rate)

    def __call__(self, texts: list[str]) -> list:
        for attempt in range(self.retries + 1):
            self._take()
            try:
                return self.call(texts)
            except self.transient as e:
                if attempt == self.retries:
                    raise RemoteError(f"{attempt + 1} attempts: {type(e).__name__}: {e}") from e
                self.sleep(min(self.longest, self.pause * 2**attempt))
        raise AssertionError  # not reached


#: Errors of an embedder's code, not of its service or its texts.
_BUGS = (TypeError, NameError, AttributeError, ImportError, AssertionError)


def _embedded(texts: DataFrame, factory: Callable[[], Callable[[list[str]], list]], size: int, batch: int, pause: float) -> DataFrame:
    """text_for_embedding, embedding, embedding_error of distinct texts. A batch that fails has zeros and says why."""

    def work(frames):
        model = factory()
        for f in frames:
            vectors, errors = [], []
            texts = f["text_for_embedding"].tolist()
            for i in range(0, len(texts), batch):
                if pause and vectors:
                    time.sleep(pause)
                part, said = texts[i : i + batch], None
                try:
                    got = [[float(x) for x in v] for v in model(part)]
                    if [len(v) for v in got] != [size] * len(part):
                        raise ValueError(f"{len(part)} vectors of {size} numbers were expected")
                except _BUGS:
                    raise
                except Exception as e:
                    got, said = [[0.0] * size for _ in part], f"{type(e).__name__}: {e}"[:1000]
                vectors += got
                errors += [said] * len(part)
            yield pd.DataFrame({"text_for_embedding": texts, "embedding": vectors, "embedding_error": pd.Series(errors, dtype=object)})

    return texts.mapInPandas(work, "text_for_embedding string, embedding array<double>, embedding_error string")


@dataclass(frozen=True)
class Cache:
    """Vectors that earlier runs worked out, in a table at ``path``, by text, model and size.

    The table is a folder per generation: new vectors are appended to the newest one; ``compact`` writes the next one, with
    a row per key and few files, and removes those before it.
    """

    path: str
    model: str

    def _generations(self, spark: SparkSession) -> list[int]:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            return []
        found = (re.fullmatch(r"generation-(\d+)", f.getPath().getName()) for f in fs.listStatus(folder))
        done = lambda n: fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/generation-{n}/_SUCCESS"))
        return sorted(n for m in found if m and done(n := int(m[1])))

    def key(self, text: Column, size: int) -> Column:
        return F.sha2(F.concat_ws("|", F.lit(self.model), F.lit(str(size)), text), 256)

    def read(self, spark: SparkSession) -> DataFrame | None:
        """key and embedding (a key may come twice if runs met), or None if there is nothing."""
        have = self._generations(spark)
        return spark.read.schema("key string, embedding array<double>").parquet(f"{self.path}/generation-{have[-1]}") if have else None

    def append(self, rows: DataFrame) -> None:
        have = self._generations(rows.sparkSession)
        rows.select("key", "embedding").write.mode("append").parquet(f"{self.path}/generation-{have[-1] if have else 0}")

    def compact(self, spark: SparkSession) -> None:
        have = self._generations(spark)
        if have:
            rows = self.read(spark).groupBy("key").agg(F.first("embedding").alias("embedding"))
            rows.write.mode("overwrite").parquet(f"{self.path}/generation-{have[-1] + 1}")
            shared.remove(spark, *[f"{self.path}/generation-{n}" for n in have])


def embed(rows: DataFrame, factory: Callable[[], Callable[[list[str]], list]], size: int, batch: int = BATCH, pause: float = 0.0, cache: Cache | None = None) -> DataFrame:
    """rows with ``embedding`` of their text_for_embedding, and embedding_error: why it is zeros, else null.

    Equal texts are embedded once; ``pause`` seconds between batches throttle a remote service. With a cache only texts that
    it lacks are embedded, and their vectors are added to it; failed ones are not, so they are tried again next time.
    Errors of the embedder's own code end the run.
    """
    texts = rows.select("text_for_embedding").distinct()
    if cache is None:
        return rows.join(_embedded(texts, factory, size, batch, pause), "text_for_embedding")
    spark = rows.sparkSession
    keyed = texts.select("text_for_embedding", cache.key(F.col("text_for_embedding"), size).alias("key"))
    have = cache.read(spark)
    missing = keyed if have is None else keyed.join(have.select("key"), "key", "left_anti")
    new = shared.cut(_embedded(missing.select("text_for_embedding"), factory, size, batch, pause), "new-embeddings")
    cache.append(new.where("embedding_error is null").withColumn("key", cache.key(F.col("text_for_embedding"), size)))
    known = cache.read(spark).groupBy("key").agg(F.first("embedding").alias("embedding"))
    failed = new.where("embedding_error is not null")
    found = keyed.join(known, "key").select("text_for_embedding", "embedding", F.lit(None).cast("string").alias("embedding_error"))
    return rows.join(found.unionByName(failed), "text_for_embedding")
