"""Token counts of whole texts: batches of Arrow rows go in, lengths come out."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import texts_of
from .encoding import encoder, public_path

LIMIT = 2048


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = LIMIT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_bytes, n_tokens, over_limit, in the rows' own partitions; nothing is shuffled.

    Ids are counted as the tokenizer file's library gives them, without added special tokens; strings of special
    tokens inside a text count as that library's default has it. Texts are grouped to about a million characters a
    call, longer ones are cut where white space begins. NULL and empty texts have 0 tokens, NULL keys stay NULL,
    repeated rows are counted each, an empty table gives an empty result, other columns are not read.
    """
    path = path or public_path("word_bpe_49k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = encoder(path)
        for batch in batches:
            texts = texts_of(batch.column(1))
            n = counter.count(texts)
            sizes = np.array([len(t.encode("utf-8", "surrogatepass")) for t in texts], np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes), pa.array(n), pa.array(n > limit)],
                                             names=[key, "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col(key), F.col(text).cast("string").alias("text"))
    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean"
    return rows.mapInArrow(run, schema)
