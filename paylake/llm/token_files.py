"""Token-ID output: documents encoded, written as token files in ascending
doc_id order, and read back.

Documents are put in order by a range partitioning, each partition is sorted
and written as one or more files of bounded size by the task that holds it;
``pfor.py`` has the format. A file gets its final name when it is complete,
and its content depends on its documents alone, so a task that is run again
leaves the same files. The job returns a manifest, one row per file, from
which the files' order and first positions follow; only the manifest's counts
are looked at beyond the tasks.

NULL and empty texts have no ids but the end id; very long texts are encoded
whole, alone in their batch; NULL doc_id comes first;
rows that share a doc_id are documents of their own, next to each other; an
empty table writes no file. Other columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from paylake.llm.common import row_key, staged, text_of
from paylake.llm.encoding import IdEncoder, encoder, read_vocabulary, slices
from paylake.llm.pfor import TokenFile, TokenFileWriter
from paylake.session import scratch_path

END_ID = 2
# A file is closed at the first document after so many ids; bytes of text encoded at once.
FILE_IDS = 64_000_000
BATCH_BYTES = 2_000_000

_MANIFEST = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("part", T.LongType()), T.StructField("seq", T.LongType()),
    T.StructField("n_docs", T.LongType()), T.StructField("n_ids", T.LongType())])
_DOCUMENT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()),
    T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())])


def open_store(path: str):
    """File system and path in it, for any store that Arrow can open."""
    from pyarrow import fs
    if path.startswith("file:/") and not path.startswith("file://"):
        path = path[len("file:"):]
    return fs.FileSystem.from_uri(path)


def _writer(folder: str, vocabulary, end_id: int, file_ids: int, plain_special: bool):
    def run(batches):
        store, root = open_store(folder)
        store.create_dir(root, recursive=True)
        codec, end = encoder(IdEncoder, vocabulary.value, plain_special), end_id.to_bytes(4, "little")
        part, seq, now = TaskContext.get().partitionId(), 0, None

        def closed():
            writer, stream, tmp, final = now
            writer.close()
            stream.close()
            store.move(tmp, f"{root}/{final}")
            return pa.RecordBatch.from_pylist([{"file": final, "part": part, "seq": seq, "n_docs": len(writer.doc_ids),
                                                "n_ids": writer.n_ids}])
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            for i, j in slices(pc.binary_length(texts).to_pylist(), BATCH_BYTES):
                tokens, sizes = codec.encode_batch(texts.slice(i, j - i))
                raw, ends = tokens.tobytes(), (4 * np.cumsum(sizes)).tolist()
                for doc_id, x, y in zip(ids[i:j], [0, *ends], ends):
                    data = raw[x:y]
                    if now is None:
                        final = f"tokens-{part:06d}-{seq:04d}.pfor"
                        tmp = f"{root}/.{final}.{uuid.uuid4().hex}"
                        stream = store.open_output_stream(tmp)
                        now = TokenFileWriter(stream), stream, tmp, final
                    now[0].add(doc_id, data + end)
                    if now[0].n_ids >= file_ids:
                        yield closed()
                        seq, now = seq + 1, None
        if now is not None:
            yield closed()
    return run


def write_tokens(docs: DataFrame, folder: str, vocabulary: str | None = None, end_id: int = END_ID,
                 file_ids: int = FILE_IDS, plain_special: bool = True) -> DataFrame:
    """Writes ``docs`` as token files below ``folder``; the manifest, with the
    position ``base`` of each file's first id among all ids. Strings of special
    tokens are ordinary text, or with ``plain_special`` off their tokens."""
    vocab = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    text = text_of("text")
    order = [F.col("doc_id").asc_nulls_first(), F.col("key").asc()]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), row_key(text).alias("key"))
    manifest = staged(rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
                      .mapInArrow(_writer(folder, vocab, end_id, file_ids, plain_special), _MANIFEST), "token-manifest")
    before = W.orderBy("part", "seq").rowsBetween(W.unboundedPreceding, -1)  # one row per file
    return manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _reader(folder: str):
    def run(batches):
        store, root = open_store(folder)
        for batch in batches:
            for row in batch.to_pylist():
                path = f"{root}/{row['file']}"
                with store.open_input_file(path) as f:
                    tokens, out = TokenFile(f, f.size()), []
                    for doc_id, start, ids in tokens.documents():
                        out.append((doc_id, row["base"] + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        if len(out) == 10_000:
                            yield _batch(out)
                            out = []
                    yield _batch(out)
    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                      names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_tokens(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files."""
    manifest = staged(manifest, "token-files")
    files = max(1, manifest.count())
    return manifest.repartition(min(files, 10_000), "file").mapInArrow(_reader(folder), _DOCUMENT)


def new_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "llm-tokens")


def op5_token_output(docs: DataFrame) -> DataFrame:
    """Encoded as the tokenizer does by default: the string of a special token is that token."""
    folder = new_folder(docs.sparkSession)
    return read_tokens(write_tokens(docs, folder, plain_special=False), folder)
