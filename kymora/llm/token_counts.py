"""Token counts: batches of about equal bytes, long texts cut at safe boundaries, only lengths returned.

A boundary is safe where the tokenizer starts a new word whatever stands on either side (see ``chunks``);
each piece between two boundaries is encoded once, and a text's count is the sum over its pieces.

Defined cases: null and empty texts have 0 bytes and 0 tokens; repeated rows give repeated results; a null
doc_id stays null; other columns are ignored; an empty table gives no rows. A text is held in one task, with some 40
bytes a byte; a stretch without a safe boundary is one piece, and what is remembered of pieces is bounded by bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from kymora.llm.chunks import encoder
from kymora.llm.common import batch_of, slices, texts, tidy


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 512) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row; ``tokenizer`` is the path of its file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])
        for batch in slices(batches, "raw"):
            raw = batch.column("raw")
            n = encoder(tokenizer).counts(raw).astype(np.int64)
            yield batch_of({"doc_id": batch.column("doc_id"), "n_bytes": pc.binary_length(raw).cast(pa.int64()), "n_tokens": n, "over_limit": n > limit}, schema)

    return texts(docs).mapInArrow(tidy(run), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
