"""Token counts of whole texts, by rank-synchronous merging of ragged symbol arrays."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlink.llm.common import per_text, sums_by_text
from ledgerlink.llm.wordbpe import WordBpe, word_bpe


def chunk_counts(model: WordBpe, new: list[bytes]) -> np.ndarray:
    """Tokens of each chunk."""
    out = np.zeros(len(new), np.int64)
    plain, odd = model.plain(new)
    if plain:
        lines, per_chunk = model.plain_pretokens([new[i] for i in plain])
        out[plain] = sums_by_text(model.counts(lines), per_chunk)
    for i in odd:
        parts = model.pretokens(new[i])
        texts = [p for p in parts if type(p) is bytes]
        out[i] = len(parts) - len(texts) + sum(int(model.counts(t)[0]) for t in texts)
    return out


def token_counts(
    docs: DataFrame, tokenizer: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row.

    ``tokenizer`` is the path of a word-end BPE file, read by the driver and sent to the tasks
    (a vocabulary has a fixed size). Null and empty texts have no tokens; repeated rows are counted each;
    a null id stays null; columns beside the two named ones are not looked at. Texts of any
    length are worked on whole: by distinct chunks between white space, in blocks of
    half a million symbols, and through a heap where one chunk is very long.
    """
    with open(tokenizer, "rb") as f:
        blob = docs.sparkSession.sparkContext.broadcast(f.read())

    def columns(texts: list[bytes]):
        model = word_bpe(blob.value)
        per_text, n, _ = model.words(texts, lambda new: (chunk_counts(model, new), None))
        return [len(t) for t in texts], sums_by_text(n, per_text)

    fields = [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]
    counted = per_text(docs, id_col, text_col, fields, columns)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
