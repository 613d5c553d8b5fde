"""Language identification by character-trigram naive Bayes (after Cavnar & Trenkle 1994).

Weights are whole micro-nats, so sums do not depend on the order of counting.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.strings import strip

WINDOW, MIN_CHARS, SCALE = 500, 20, 1_000_000


@dataclass(frozen=True)
class Profiles:
    """A trained model: sorted trigram codes, per trigram and language the gain over an unseen one, and the weight of
    an unseen trigram per language. Its size is that of the languages' trigrams, not of the texts; pass
    ``profile_size`` in training to bound it."""
    languages: tuple[str, ...]
    codes: np.ndarray
    gains: np.ndarray
    unseen: np.ndarray

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(int(c), [int(x) for x in g]) for c, g in zip(self.codes, self.gains)]
        rows.append((-1, [int(x) for x in self.unseen]))
        named = spark.createDataFrame(rows, "code long, weights array<long>").withColumn("languages", F.array(*map(F.lit, self.languages)).cast("array<string>"))
        named.write.mode("error").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Profiles:
        table = spark.read.parquet(path).orderBy("code").toPandas()
        names = tuple(table["languages"].iloc[0])
        weights = np.array(table["weights"].tolist(), np.int64).reshape(len(table), len(names))
        return Profiles(names, table["code"].to_numpy(np.int64)[1:], weights[1:], weights[0])

    def label(self, head: str) -> str | None:
        return likeliest(head, self.languages, self.codes, self.gains, self.unseen)


def trigram_codes(head: str) -> np.ndarray:
    """All three-character windows of a text as numbers that sort as their characters do."""
    p = np.frombuffer(head.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    return p[:-2] << 42 | p[1:-1] << 21 | p[2:]


def likeliest(head: str, languages: tuple[str, ...], codes: np.ndarray, gains: np.ndarray, unseen: np.ndarray) -> str | None:
    """The language of a lower-cased text, the first by name of equal ones; None without trigrams."""
    code = trigram_codes(head)
    if not len(code) or not languages:
        return None
    total = unseen * len(code)
    if len(codes):
        at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
        total = total + gains[at[codes[at] == code]].sum(axis=0)
    return languages[int(np.argmax(total))]


def head_of(text: Column) -> Column:
    """The lower-cased first characters, which decide."""
    return F.lower(F.substring(text, 1, WINDOW))


# So many texts are counted at once: their codes, not those of a whole Arrow batch, wait in a worker.
COUNTED_ROWS = 1024


def count_trigrams(df: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """How often each trigram is in the lower-cased first characters of each language's texts: lang, code, n.

    Only these characters visit Python, which counts the texts of a language together; what it counts is added up by
    one shuffle of (language, trigram).
    """
    heads = df.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), head_of(F.col(text)).alias("head"))
    schema = T.StructType([heads.schema["lang"], T.StructField("code", T.LongType()), T.StructField("n", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, COUNTED_ROWS):
                part = batch.slice(lo, COUNTED_ROWS)
                langs, found = part.column(0).dictionary_encode(), {}
                for place, head in zip(langs.indices.to_pylist(), part.column(1).to_pylist()):
                    found.setdefault(place, []).append(trigram_codes(head or ""))
                for place, codes in found.items():
                    code, n = np.unique(np.concatenate(codes), return_counts=True)
                    name = langs.dictionary.take(pa.array(np.full(len(code), place)))
                    yield pa.RecordBatch.from_arrays([name, pa.array(code, pa.int64()), pa.array(n, pa.int64())], names=["lang", "code", "n"])

    return heads.mapInArrow(count, schema).groupBy("lang", "code").agg(F.sum("n").alias("n"))


def train_language_profiles(df: DataFrame, text: str = "text", lang: str = "lang",
                            profile_size: int | None = None) -> Profiles:
    """Profiles from labelled texts: the log probabilities of each language's trigrams, with one added to every count.

    One shuffle of partial counts by (language, trigram); the driver gets one number for each. All trigrams count,
    unless the caller bounds them: ``profile_size`` keeps the most frequent ones of each language.
    """
    counts = count_trigrams(df, text, lang)
    if profile_size is not None:
        rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
        counts = counts.withColumn("r", rank).where(F.col("r") <= profile_size).drop("r")
    table = counts.toPandas()
    names = tuple(sorted(table["lang"].unique()))
    codes, column = np.unique(table["code"].to_numpy(np.int64)), {n: i for i, n in enumerate(names)}
    n = np.zeros((len(codes), len(names)))
    n[np.searchsorted(codes, table["code"].to_numpy(np.int64)), [column[x] for x in table["lang"]]] = table["n"]
    total = n.sum(axis=0) + len(codes)
    unseen = np.round(np.log(1 / total) * SCALE).astype(np.int64)
    gains = np.where(n > 0, np.round(np.log((n + 1) / total) * SCALE).astype(np.int64) - unseen, 0)
    return Profiles(names, codes, gains, unseen)


def detect_language(df: DataFrame, profiles: Profiles, text: str = "text") -> DataFrame:
    """Add ``language``; a stripped text of under 20 characters or without trigrams is ``unknown``.

    A row is decided where it lies: only its first characters visit Python, nothing is shuffled or joined.
    """
    # A tuple of arrays: a class would be looked up in the package, which workers need not have.
    shared = df.sparkSession.sparkContext.broadcast((profiles.languages, profiles.codes, profiles.gains, profiles.unseen))

    @F.pandas_udf("string")
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for heads in batches:
            yield heads.map(lambda h: None if h is None else likeliest(h, *shared.value)).astype(object)

    # The first characters of the stripped text tell, however long it is.
    long_enough = F.char_length(F.substring(strip(F.col(text)), 1, MIN_CHARS)) >= MIN_CHARS
    return df.withColumn("language", F.coalesce(label(F.when(long_enough, head_of(F.col(text)))), F.lit("unknown")))
