"""Alignment of two tokenizers over the same bytes, by diagonal run skipping.

A text, with a space before it, is encoded by a byte-level BPE tokenizer (A)
and by a piece tokenizer (B, which puts that space there itself). Both give an
array of byte ends. Where tokens of both end at the same byte they are linked,
and these bytes cut the tokens into groups.

The two arrays are compared at the current shift between their indexes:
stretches that agree are jumped by probing 4, 8, 16, ... ends at once and
halving back to the first that differs. There the side that is behind is moved
on until both ends meet, which closes an irregular group and sets the shift
for the next stretch. A batch of texts is one pair of arrays, since every
text's last ends meet.

``align`` gives the groups and linked ids per document, ``pair_counts`` how
often each pair of ids is linked in the whole corpus and whether that is the
most for its B id; ``op12_token_align`` adds these up per document.

NULL and empty texts, and texts that the tokens of A or B do not spell (such as
texts with U+2581, which B reads as a space), have no tokens. Strings of special
tokens are ordinary text. Very long texts are encoded and aligned whole, alone
in their batch. NULL doc_id is passed through, equal rows count each on their
own, other columns are not looked at, an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.llm.common import broadcast_if_small, staged, text_of
from paylake.llm.encoding import IdEncoder, IdTable, Pieces, encoder, read_vocabulary, slices
from paylake.llm.pfor import ranges_of

# Bytes of text encoded and aligned at once.
BATCH_BYTES = 1_000_000
# Pieces a worker remembers of either tokenizer.
MEMO_PIECES = 200_000
# Rows up to which the pair counts (three numbers each) are broadcast; beyond, a shuffle joins them.
PAIR_ROWS = 1_000_000
# Ends compared by the first probe of a stretch.
FIRST_PROBE = 4
SPACE = "▁"


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def letter_bytes() -> dict[str, int]:
    """The letter of every byte in byte-level vocabularies: printable Latin-1
    characters stand for themselves, the other bytes for letters from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b < 127 or 161 <= b and b != 173]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class ByteEncoder(IdEncoder):
    """The byte-level tokenizer, with the bytes of its tokens."""

    memo_pieces = MEMO_PIECES

    def __init__(self, vocabulary: str, plain_special: bool = True):
        super().__init__(vocabulary, plain_special)
        byte = letter_bytes()
        vocab = self.tokenizer.get_vocab()
        self.token_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()


class PieceModel(IdTable):
    """The piece tokenizer. It never merges across a space that follows another
    character unless its vocabulary has such a piece, so texts are encoded by
    pieces between spaces; texts with runs of spaces are encoded whole. ``text``
    here has the space before it that the model itself puts there."""

    memo_pieces = MEMO_PIECES

    def __init__(self, model: bytes):
        super().__init__()
        from sentencepiece import SentencePieceProcessor
        self.model = SentencePieceProcessor(model_proto=model)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        self.token_bytes = [bytes([int(p[1:-1], 16)]) if self.model.is_byte(i) else p.replace(SPACE, " ").encode()
                            for i, p in enumerate(pieces)]
        self.cuttable = not any(SPACE in p.lstrip(SPACE) for p in pieces)

    def whole(self, texts):
        return [np.array(ids, "<u4").tobytes() for ids in self.model.encode([t[1:] for t in texts], num_threads=1)]

    def leading(self, pieces):  # a text begins with a space: its first piece is empty
        self.store(self.first, ["", *{*pieces} - {""}], np.empty(0, "<u4"), np.array([0] + [-1] * len({*pieces} - {""})))

    def following(self, pieces):
        if not self.cuttable:
            self.store(self.after, pieces, np.empty(0, "<u4"), np.full(len(pieces), -1))
            return
        lists = self.model.encode(pieces, num_threads=1)
        length = np.fromiter(map(len, lists), np.int64, len(lists))
        if "" in pieces:  # two spaces together
            length[pieces.index("")] = -1
        ids = np.fromiter(chain.from_iterable(lists), "<u4", int(np.maximum(length, 0).sum()))
        self.store(self.after, pieces, ids, length)


def common_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the entries that two ascending arrays with the same last entry share."""
    a, b = a.astype("<i8"), b.astype("<i8")
    x, y, ends_a, ends_b = a.tobytes(), b.tobytes(), a.tolist(), b.tolist()
    n, m, i, j = len(x), len(y), 0, 0  # positions in bytes, eight for an end
    runs = []
    while i < n:
        left = min(n - i, m - j)
        k, step = 0, 8 * FIRST_PROBE
        while k + step <= left and x[i + k:i + k + step] == y[j + k:j + k + step]:
            k += step
            step *= 2
        while step > 8:
            step //= 2
            if k + step <= left and x[i + k:i + k + step] == y[j + k:j + k + step]:
                k += step
        if k:
            runs.append((i, j, k))
            i, j = i + k, j + k
            if i >= n:
                break
        p, q = i >> 3, j >> 3
        u, v = ends_a[p], ends_b[q]
        while u != v:
            if u < v:
                p += 1
                u = ends_a[p]
            else:
                q += 1
                v = ends_b[q]
        i, j = p << 3, q << 3  # both end here: the next stretch begins with this pair
    at = np.array(runs, np.int64).reshape(-1, 3) >> 3
    return ranges_of(at[:, 0], at[:, 2]), ranges_of(at[:, 1], at[:, 2])


def _labels(n_a: int, n_b: int) -> list[bytes]:
    """What a token adds to the text of its groups: for A ``id,`` and, last of
    its group, ``id|``; for B ``id,`` and ``id;``."""
    return [f"{i}{end}".encode() for n, ends in ((n_a, ",|"), (n_b, ",;")) for i in range(n) for end in ends]


class Aligner:
    def __init__(self, vocabulary: str, model: bytes):
        self.a, self.b = encoder(ByteEncoder, vocabulary), PieceModel(model)
        self.len_a = np.array(list(map(len, self.a.token_bytes)), np.int64)
        self.len_b = np.array(list(map(len, self.b.token_bytes)), np.int64)
        self.labels = _labels(len(self.len_a), len(self.len_b))

    def align(self, texts: pa.Array, digest: bool) -> list:
        """Per text: tokens of A, tokens of B, groups, the groups' text (or its
        hash), the linked pairs (a * size of B's vocabulary + b) and how often each."""
        n, texts = len(texts), texts.cast(pa.large_string())
        spaced = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts, pa.scalar(" ", pa.large_string()))
        pieces = Pieces(spaced)
        ids_a, n_a, ok_a = self.a.encode_checked(pieces)
        ids_b, n_b, ok_b = self.b.encode_checked(pieces)
        ok = ok_a & ok_b & (pc.binary_length(texts).to_numpy() > 0)
        if not ok.all():
            ids_a, ids_b = ids_a[np.repeat(ok, n_a)], ids_b[np.repeat(ok, n_b)]
            n_a, n_b = n_a * ok, n_b * ok
        i, j = common_ends(np.cumsum(self.len_a[ids_a]), np.cumsum(self.len_b[ids_b]))
        upto_a, upto_b = np.cumsum(n_a), np.cumsum(n_b)
        doc = np.searchsorted(upto_a, i, side="right")
        groups = np.bincount(doc, minlength=n)
        # the groups' tokens in order: those of A, then those of B
        own_a, own_b = np.diff(i, prepend=-1), np.diff(j, prepend=-1)
        at_a = np.arange(len(ids_a)) + np.repeat(j - own_b + 1, own_a)
        at_b = np.arange(len(ids_b)) + np.repeat(i + 1, own_b)
        label = np.empty(len(ids_a) + len(ids_b), np.int64)
        label[at_a] = 2 * ids_a.astype(np.int64)
        label[at_b] = 2 * (ids_b.astype(np.int64) + len(self.len_a))
        label[at_a[i]] += 1
        label[at_b[j]] += 1
        words = list(map(self.labels.__getitem__, label.tolist()))
        ends = (upto_a + upto_b).tolist()
        said = [b"".join(words[x:y])[:-1] for x, y in zip([0, *ends], ends)]
        said = [hashlib.sha256(s).hexdigest() if s and digest else s.decode() for s in said]
        pair = ids_a[i].astype(np.int64) * len(self.len_b) + ids_b[j]
        order = np.lexsort((pair, doc))
        doc, pair = doc[order], pair[order]
        new = np.ones(len(pair), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (pair[1:] != pair[:-1])
        first = np.flatnonzero(new)
        times = np.diff(first, append=len(pair))
        bounds = np.concatenate([[0], np.cumsum(np.bincount(doc[first], minlength=n))]).astype(np.int32)
        return [pa.array(n_a), pa.array(n_b), pa.array(groups), pa.array(said, pa.string()),
                pa.ListArray.from_arrays(pa.array(bounds), pa.array(pair[first])),
                pa.ListArray.from_arrays(pa.array(bounds), pa.array(times.astype(np.int32)))]


_FOUND = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_a", T.LongType()), T.StructField("n_b", T.LongType()),
    T.StructField("n_groups", T.LongType()), T.StructField("groups", T.StringType()),
    T.StructField("pairs", T.ArrayType(T.LongType())), T.StructField("times", T.ArrayType(T.IntegerType()))])
_ALIGNERS: dict[str, Aligner] = {}


def aligner(vocabulary: str, model: bytes) -> Aligner:
    """The worker's aligner, made once."""
    key = hashlib.md5(vocabulary.encode() + model).hexdigest()
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(vocabulary, model)
    return _ALIGNERS[key]


def align(docs: DataFrame, vocabulary: str | None = None, model: str | None = None, digest: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, tokens of A and B, number of groups, the
    groups as text (``a1,a2|b1;a3|b2,b3``; with ``digest`` its SHA-256), and the
    linked pairs with how often each is linked. A pair is a * (size of B's
    vocabulary) + b; :func:`pair_counts` splits it."""
    with open(model or default_model(), "rb") as f:
        files = docs.sparkSession.sparkContext.broadcast((read_vocabulary(vocabulary), f.read()))

    def run(batches):
        codec = aligner(*files.value)
        for batch in batches:
            texts = batch.column("text")
            for i, j in slices(pc.binary_length(texts).to_pylist(), BATCH_BYTES):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i),
                                                  *codec.align(texts.slice(i, j - i), digest)], names=_FOUND.names)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text")).mapInArrow(run, _FOUND)


def model_size(model: str | None = None) -> int:
    from sentencepiece import SentencePieceProcessor
    return SentencePieceProcessor(model_file=model or default_model()).vocab_size()


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """(pair, a, b, count, best) of all linked pairs: in how many links of the
    whole corpus, and whether no pair of the same B id has more."""
    found = staged(aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("l"))
                   .groupBy(F.col("l.pairs").alias("pair")).agg(F.sum("l.times").alias("count"))
                   .select("pair", F.expr(f"pair div {size_b}").alias("a"), (F.col("pair") % size_b).alias("b"), "count"),
                   "align-counts")
    most = found.groupBy(F.col("b").alias("of")).agg(F.max("count").alias("most"))  # at most the vocabulary
    return found.join(most, F.col("b") == F.col("of")).select("pair", "a", "b", "count",
                                                              (F.col("count") == F.col("most")).alias("best"))


def op12_token_align(docs: DataFrame, pair_rows: int = PAIR_ROWS) -> DataFrame:
    found = staged(align(docs, digest=True).withColumn("row", F.monotonically_increasing_id()), "align-documents")
    counts = staged(pair_counts(found, model_size()).select("pair", "count", "best"), "align-pairs")
    links = found.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select("row", "l.pairs", "l.times")
    sums = (links.join(broadcast_if_small(counts, pair_rows), F.col("pairs") == F.col("pair")).groupBy("row")
            .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                 F.sum(F.col("times") * F.col("count")).alias("count_sum")).withColumnRenamed("row", "of"))
    none = F.lit(0).cast("long")
    return found.join(sums, F.col("row") == F.col("of"), "left").select(
        "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), F.coalesce("n_best", none).alias("n_best"),
        F.coalesce("count_sum", none).alias("count_sum"), F.col("groups").alias("groups_sha256"))
