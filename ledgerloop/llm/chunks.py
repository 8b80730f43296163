"""Questions of chunks of documents to the whole corpus, and the answers.

Some operators must know of every small thing in a document (a word, a run of words) what the
whole corpus says of it.  A row per thing and document would be many times the input.  Instead:

* documents are packed into chunks of a few megabytes, one row each, with whatever is needed to
  finish them; the table of chunks is written;
* a chunk asks once for each distinct thing it holds, in one list per bucket of the things' hashes,
  so a thing that a third of all documents hold costs one entry per chunk;
* a bucket sees all lists for its things, and answers each chunk with a list in the same order.

The number of buckets follows the size of the corpus, so that a bucket has a bounded share of it.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloop.llm.common import Workspace, shuffle_width

#: Characters of text in a chunk, unless one document alone has more.
CHUNK_CHARS = 4_000_000
#: Bytes of text for each bucket of questions.
BUCKET_BYTES = 12_000_000

PAYLOAD = -1
CHUNK_SCHEMA = "chunk long, bucket int, content binary, kind int"


def pack(value: Any) -> bytes:
    """Pickled and compressed: tables and shuffles of chunks are mostly numbers below their type's
    range."""
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(value, protocol=5))


def unpack(content: bytes) -> Any:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(content))


def bucket_count(docs: DataFrame) -> int:
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(2 * shuffle_width(docs.sparkSession), -(-size // BUCKET_BYTES))


def write_chunks(
    docs: DataFrame,
    ws: Workspace,
    name: str,
    build: Callable[[list, list], tuple[Any, dict[int, Any]]],
) -> tuple[DataFrame, DataFrame]:
    """Packs documents (doc_id, text) into chunks.

    `build` gets the ids and texts of a chunk and gives its payload and, by bucket, its questions.
    Returns the written tables of payloads (chunk, content) and questions (chunk, bucket,
    content).
    """

    def run(batches: Iterator) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        ids: list = []
        texts: list = []
        size, number = 0, 0

        def finished() -> pa.RecordBatch:
            payload, questions = build(ids, texts)
            buckets = [PAYLOAD, *questions]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part << 32 | number] * len(buckets), pa.int64()),
                    pa.array(buckets, pa.int32()),
                    pa.array([pack(x) for x in (payload, *questions.values())], pa.binary()),
                    pa.array([int(b != PAYLOAD) for b in buckets], pa.int32()),
                ],
                names=["chunk", "bucket", "content", "kind"],
            )

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "text")]
            for doc_id, text in zip(*columns):
                if ids and size + len(text or "") > CHUNK_CHARS:
                    yield finished()
                    ids, texts, size, number = [], [], 0, number + 1
                ids.append(doc_id)
                texts.append(text)
                size += len(text or "")
        if ids:
            yield finished()

    packed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, CHUNK_SCHEMA
    )
    path = ws.new_path(name)
    packed.write.partitionBy("kind").parquet(path)
    read = docs.sparkSession.read.schema(CHUNK_SCHEMA).option("basePath", path).parquet(path)
    return (
        read.filter("kind = 0").select("chunk", "content"),
        read.filter("kind = 1").select("chunk", "bucket", "content"),
    )


def per_bucket(
    questions: DataFrame,
    handle: Callable[[int, list[int], list[Any]], Iterator[tuple]],
    schema: pa.Schema,
    kind: str,
) -> DataFrame:
    """`handle` gets a bucket's number, the chunks that ask and their lists, and gives rows."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("chunk")
        lists = [unpack(c) for c in group["content"]]
        rows = handle(int(group["bucket"].iloc[0]), group["chunk"].tolist(), lists)
        return pd.DataFrame(list(rows), columns=schema.names)

    return questions.groupBy("bucket").applyInPandas(run, kind)


def finish_chunks(
    payloads: DataFrame,
    answers: DataFrame,
    finish: Callable[[Any, list[Any]], pd.DataFrame],
    kind: str,
) -> DataFrame:
    """`finish` gets a chunk's payload and its answers in the order of their buckets.  answers:
    (chunk, bucket, content)."""

    def run(own: pd.DataFrame, answered: pd.DataFrame) -> pd.DataFrame:
        if not len(own):
            return pd.DataFrame()
        ordered = answered.sort_values("bucket")["content"] if len(answered) else []
        return finish(unpack(own["content"].iloc[0]), [unpack(c) for c in ordered])

    return (
        payloads.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(run, kind)
    )
