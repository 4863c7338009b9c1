"""Token counts by section with offset-mapped attribution.

A document is encoded once, as a whole; every token has a span of characters.
The spans are interval-joined to the document's sections (by default its
lines, each with its line break), and a token counts for the section that
holds it. A token that crosses a boundary counts for the section that holds
most of its characters, the earlier one on a tie; a token outside all sections
counts for none. Counts add up to the document's tokens where the sections
cover the text.

Per document, without a shuffle; memory is one batch of texts, or one very long
text, which is encoded whole. NULL and empty
texts have one empty line and no tokens; repeated rows are counted each on
their own; other columns are passed through; an empty table gives an empty
result.
"""

from __future__ import annotations

from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.llm.common import fresh, text_of
from paylake.llm.encoding import PieceEncoder, encoder, read_vocabulary, slices

BATCH_CHARS = 2_000_000


class SpanEncoder(PieceEncoder):
    """Texts to the character spans of their tokens, an (n, 2) array."""

    def batch(self, texts):
        return self.tokenizer.encode_batch(texts, add_special_tokens=False)

    def record(self, encoding) -> bytes:
        return array("i", chain.from_iterable(encoding.offsets)).tobytes()

    def closed(self, record, chars, mark):
        return record + array("i", [chars, chars + 1]).tobytes()  # the space counts too

    def spans(self, texts: list[str]) -> list[np.ndarray]:
        out = []
        for t, records in zip(texts, self.pieces(texts)):
            if records is None:
                out.append(np.frombuffer(self.record(self.batch([t])[0]), "<i4").reshape(-1, 2))
                continue
            spans = np.frombuffer(b"".join(records), "<i4").reshape(-1, 2)
            n = np.fromiter(map(len, records), np.int64, len(records)) // 8
            length = np.fromiter(map(len, t.split(" ")), np.int64, len(records)) + 1
            start = np.cumsum(length) - length - 1  # of the space before a piece
            start[0] = 0
            out.append(spans + np.repeat(start, n)[:, None])
        return out


def line_bounds(text: str) -> np.ndarray:
    """Start of every line and the end of the text: each line with its break."""
    breaks = [i + 1 for i, c in enumerate(text) if c == "\n"] if text.count("\n") > 50 else _breaks(text)
    return np.array([0, *breaks, len(text)], np.int64)


def _breaks(text: str) -> list[int]:
    out, at = [], text.find("\n")
    while at >= 0:
        out.append(at + 1)
        at = text.find("\n", at + 1)
    return out


def attribute(spans: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, int]:
    """Tokens of each section (disjoint, ascending) and how many cross a boundary."""
    counts = np.zeros(len(starts), np.int64)
    if not len(spans) or not len(starts):
        return counts, 0
    # sections that a token can touch: first whose end is after its start, last whose start is before its end
    first = np.searchsorted(ends, spans[:, 0], side="right")
    last = np.searchsorted(starts, np.maximum(spans[:, 1], spans[:, 0] + 1), side="left") - 1
    inside = first == last
    counts += np.bincount(first[inside], minlength=len(starts))
    crossing = np.flatnonzero(first < last)
    for i in crossing.tolist():
        s = np.arange(first[i], last[i] + 1)
        held = np.minimum(ends[s], spans[i, 1]) - np.maximum(starts[s], spans[i, 0])
        counts[s[np.argmax(held)]] += 1
    return counts, len(crossing)


_COUNTS = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("n_crossing", T.LongType()),
                        T.StructField("section_tokens", T.ArrayType(T.LongType()))])
_ARROW = pa.struct([("n_tokens", pa.int64()), ("n_crossing", pa.int64()), ("section_tokens", pa.list_(pa.int64()))])


def _counter(vocabulary, with_sections: bool, plain_special: bool):
    def rows(texts, sections):
        codec = encoder(SpanEncoder, vocabulary.value, plain_special)
        for i, j in slices(list(map(len, texts)), BATCH_CHARS):
            for t, spans, own in zip(texts[i:j], codec.spans(texts[i:j]), sections[i:j]):
                if own is None:
                    bounds = line_bounds(t)
                    starts, ends = bounds[:-1], bounds[1:]
                else:
                    starts = np.array([s["start"] for s in own], np.int64)
                    ends = np.array([s["end"] for s in own], np.int64)
                counts, crossing = attribute(spans, starts, ends)
                yield {"n_tokens": len(spans), "n_crossing": crossing, "section_tokens": counts}
    if with_sections:
        @F.arrow_udf(_COUNTS)
        def run(texts: pa.Array, sections: pa.Array) -> pa.Array:
            return pa.array(list(rows(texts.to_pylist(), [s or [] for s in sections.to_pylist()])), _ARROW)
        return run

    @F.arrow_udf(_COUNTS)
    def run_lines(texts: pa.Array) -> pa.Array:
        return pa.array(list(rows(texts.to_pylist(), [None] * len(texts))), _ARROW)
    return run_lines


def count_tokens(docs: DataFrame, sections: str | None = None, vocabulary: str | None = None,
                 counts: str | None = None, plain_special: bool = False) -> DataFrame:
    """``docs`` with a struct: n_tokens, n_crossing and section_tokens. ``sections``
    names a column of disjoint ascending structs (start, end) in characters;
    without it the lines of the text are the sections. The string of a special
    token is that token, as in the token files; with ``plain_special`` it is
    ordinary text."""
    vocab = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    run = _counter(vocab, sections is not None, plain_special)
    cols = [text_of("text")] + ([F.col(sections)] if sections else [])
    return docs.withColumn(counts or fresh(docs, "counts"), run(*cols))


def op10_token_counts(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: its tokens, lines, tokens crossing a line boundary, and tokens per line."""
    out = count_tokens(docs.select("doc_id", "text"), counts="counts").select("doc_id", "counts.*")
    return out.select("doc_id", "n_tokens", F.size("section_tokens").cast("long").alias("n_sections"), "n_crossing",
                      F.array_join("section_tokens", ",").alias("section_tokens"))
