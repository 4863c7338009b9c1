"""Byte-level BPE encoding in tasks, with a memo of pieces.

The tokenizer splits text by its pre-tokenisation pattern before any merge, and
that pattern always cuts where a character that is not white space is followed
by a space. Between two such cuts nothing depends on the surroundings, so a
text is split at its spaces and every distinct piece is encoded once per
worker by the tokenizers library. Where a piece is empty or has white space
at an end (runs of spaces, spaces beside line breaks), the whole text is
encoded in one call instead. So is a text that holds the string of an added
token, which the tokenizer looks for before any cut; with ``plain_special``
the strings of special tokens are ordinary text.

The vocabulary is a file named by a parameter; the driver reads it and ships
its content, a megabyte or two, to the tasks.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Pieces in one generation of a worker's memo, and the longest piece worth remembering.
MEMO_PIECES = 800_000
MEMO_CHARS = 64
# A closing mark after a Latin letter is a pre-token of its own.
MARKS = ",.;:!?"
LATIN_END = "\u0250"


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def read_vocabulary(path: str | None = None) -> str:
    with open(path or default_vocabulary(), encoding="utf-8") as f:
        return f.read()


class PieceEncoder:
    """Remembers what ``record`` makes of a piece's Encoding.

    The memo has two generations: when the young one is full it becomes the
    old one, and pieces seen again move back to the young one, so frequent
    pieces stay and memory is bounded.
    """

    def __init__(self, vocabulary: str, plain_special: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.encode_special_tokens = plain_special
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()
                 if t.content and not (plain_special and t.special)]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.marks = dict(zip(MARKS, map(self.record, self.batch(list(MARKS)))))

    def batch(self, texts: list[str]):
        raise NotImplementedError

    def record(self, encoding) -> bytes:
        raise NotImplementedError

    def closed(self, record: bytes, chars: int, mark: bytes) -> bytes:
        """The record of a piece of ``chars`` characters and a closing mark."""
        raise NotImplementedError

    def holds_added(self, text: str) -> bool:
        return self.added is not None and self.added.search(text) is not None

    def pieces(self, texts: list[str]) -> list[list[bytes] | None]:
        """Records of the pieces of every text; None where the text has to be
        encoded whole. Pieces after the first keep the space before them."""
        # an empty head has no record
        split = [[""] if self.holds_added(t) else t.split(" ") for t in texts]
        heads = [p.pop(0) for p in split]
        first = dict(self._encoded(set(heads), ""))
        if len(self.young) > MEMO_PIECES:
            self.young, self.old = {}, self.young
        self._remember(set(chain.from_iterable(split)).difference(self.young))
        known, out = self.young.__getitem__, []
        for head, parts in zip(heads, split):
            try:
                out.append([first[head], *map(known, parts)])
            except KeyError:
                out.append(None)
        for p in [p for p in self.long if p in self.young]:
            del self.young[p]
        return out

    def _remember(self, pieces: set[str]) -> None:
        young, old = self.young, self.old
        again = pieces & old.keys()
        young.update((p, old[p]) for p in again)
        pieces -= again
        ends = {p for p in pieces if len(p) > 1 and p[-1] in self.marks and p[-2] < LATIN_END and p[-2].isalpha()
                and not p[0].isspace()}
        bases = {p[:-1] for p in ends}
        moved = (bases & old.keys()) - young.keys()
        young.update((p, old[p]) for p in moved)
        young.update(self._encoded((pieces - ends) | (bases - young.keys()), " "))
        young.update((p, self.closed(young[p[:-1]], len(p), self.marks[p[-1]])) for p in ends)
        self.long = [p for p in chain(pieces, bases) if len(p) > MEMO_CHARS]

    def _encoded(self, pieces: set[str], before: str):
        """(piece, record) of the pieces that do not depend on their neighbours."""
        todo = [p for p in pieces if p and not p[0].isspace() and not p[-1].isspace()]
        return zip(todo, map(self.record, self.batch([before + p for p in todo])))


def ragged(values: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """``values[start:start + length]`` of every entry, one after the other."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.arange(total) + np.repeat(start - (ends - length), length)]


def _strings(pieces: pa.Array) -> list[str]:
    """The pieces, which have no space, as Python strings."""
    one = pa.ListArray.from_arrays(pa.array([0, len(pieces)], pa.int32()), pieces)
    joined = pc.binary_join(one, pa.scalar(" ", pieces.type))
    return joined[0].as_py().split(" ")


class Pieces:
    """Texts (no NULLs) cut at their spaces, every distinct piece numbered."""

    def __init__(self, texts: pa.Array):
        self.texts = texts
        lists = pc.split_pattern(texts.cast(pa.large_string()), " ")
        found = lists.flatten().dictionary_encode()
        bounds = lists.offsets.to_numpy().astype(np.int64)
        self.bounds = bounds - bounds[0]
        self.distinct, self.number = _strings(found.dictionary), found.indices.to_numpy()
        self.heads = [self.distinct[i] for i in self.number[self.bounds[:-1]].tolist()]


class IdTable:
    """Texts to token ids, every distinct piece between spaces encoded once.

    The pieces of a batch are found and numbered by Arrow, so that Python sees
    each distinct piece once; ids are gathered by number. The ids of known
    pieces lie in one array, which is begun anew when it holds too many. A
    piece without a record, and a text that ``unsplit`` names, is encoded whole.
    """

    def __init__(self):
        self._clear()

    def _clear(self) -> None:
        # numbers of pieces after a space, and of texts' first pieces
        self.after: dict[str, int] = {}
        self.first: dict[str, int] = {}
        self.ids = np.empty(0, "<u4")
        self.start, self.length = np.empty(0, np.int64), np.empty(0, np.int64)  # length -1: not a piece
        self.right = np.empty(0, bool)

    def following(self, pieces: list[str]) -> None:
        """Stores the ids of new pieces that come after a space, with that space."""
        raise NotImplementedError

    def leading(self, pieces: list[str]) -> None:
        """Stores the ids of new first pieces of a text."""
        raise NotImplementedError

    def whole(self, texts: list[str]) -> list[bytes]:
        raise NotImplementedError

    def unsplit(self, texts: pa.Array) -> np.ndarray:
        return np.zeros(len(texts), bool)

    memo_pieces = MEMO_PIECES
    # The bytes of every token, if texts are to be compared with their tokens.
    token_bytes: list[bytes] | None = None

    def spells(self, ids: np.ndarray, text: str) -> bool:
        return b"".join(map(self.token_bytes.__getitem__, ids.tolist())) == text.encode()

    def store(self, known: dict[str, int], pieces: list[str], ids: np.ndarray, length: np.ndarray) -> None:
        """Numbers ``pieces``; their ids follow one another. Length -1: has to be encoded with its text."""
        held, at = np.maximum(length, 0), len(self.start)
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(held) - held])
        self.length = np.concatenate([self.length, length])
        self.ids = np.concatenate([self.ids, ids])
        known.update(zip(pieces, range(at, at + len(pieces))))
        if self.token_bytes is not None:
            before = " " if known is self.after else ""
            right = length >= 0
            if not self.spells(ids, "".join(before + p for p, ok in zip(pieces, right.tolist()) if ok)):
                ends = np.cumsum(held)
                right = np.array([n < 0 or self.spells(ids[e - n:e], before + p)
                                  for p, n, e in zip(pieces, length.tolist(), ends.tolist())], bool)
            self.right = np.concatenate([self.right, right | (length < 0)])

    def _numbers(self, known: dict[str, int], pieces: list[str], learn) -> np.ndarray:
        new = [p for p in pieces if p not in known]
        if new:
            learn(new)
        return np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))

    def encode_checked(self, pieces: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all texts in one array, how many each text has, and,
        with ``token_bytes``, whether its tokens, joined, are the text."""
        texts, bounds = pieces.texts, pieces.bounds
        if len(self.start) > self.memo_pieces:
            self._clear()
        number = self._numbers(self.after, pieces.distinct, self.following)[pieces.number]
        number[bounds[:-1]] = self._numbers(self.first, pieces.heads, self.leading)
        start, length = self.start[number], self.length[number]
        right = np.ones(len(texts), bool) if self.token_bytes is None else np.logical_and.reduceat(
            self.right[number], bounds[:-1])
        whole = np.logical_or.reduceat(length < 0, bounds[:-1]) | self.unsplit(texts)
        ids = self.ids
        if whole.any():
            length[np.repeat(whole, np.diff(bounds))] = 0
            own = texts.filter(pa.array(whole)).to_pylist()
            extra = self.whole(own)
            sizes = np.array([len(e) // 4 for e in extra], np.int64)
            at = bounds[:-1][whole]
            start[at], length[at] = len(ids) + np.cumsum(sizes) - sizes, sizes
            ids = np.concatenate([ids, np.frombuffer(b"".join(extra), "<u4")])
            if self.token_bytes is not None:
                right[whole] = [self.spells(np.frombuffer(e, "<u4"), t) for e, t in zip(extra, own)]
        return ragged(ids, start, length), np.add.reduceat(length, bounds[:-1]), right

    def encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (no NULLs) in one array, and how many each text has."""
        if len(texts) == 0:
            return np.empty(0, "<u4"), np.empty(0, np.int64)
        return self.encode_checked(Pieces(texts))[:2]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of every text."""
        ids, sizes = self.encode_batch(pa.array(texts, pa.large_string()))
        raw, ends = ids.tobytes(), (4 * np.cumsum(sizes)).tolist()
        return [raw[x:y] for x, y in zip([0, *ends], ends)]


class IdEncoder(IdTable, PieceEncoder):
    """Ids by the byte-level tokenizer. New pieces are encoded some thousand at
    a time as one text: a piece begins at every token that begins with a space,
    as there are no other spaces in it."""

    def __init__(self, vocabulary: str, plain_special: bool = True):
        PieceEncoder.__init__(self, vocabulary, plain_special)
        IdTable.__init__(self)
        vocab = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(vocab.values()) + 1, bool)
        self.opens[[i for token, i in vocab.items() if token.startswith("\u0120")]] = True  # a space's byte
        self.added_tokens = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()
                             if t.content and not (plain_special and t.special)]
        self.mark_ids = {m: np.frombuffer(r, "<u4")[0] for m, r in self.marks.items() if len(r) == 4}

    def batch(self, texts):
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)

    def record(self, encoding) -> bytes:
        return array("I", encoding.ids).tobytes()

    def whole(self, texts):
        return list(map(self.record, self.batch(texts)))

    def unsplit(self, texts):
        found = np.zeros(len(texts), bool)
        for token in self.added_tokens:
            found |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        return found

    def leading(self, pieces):
        pieces = list(dict.fromkeys(pieces))
        found = {"": b"", **dict(self._encoded(pieces, ""))}
        rows = [found.get(p) for p in pieces]
        self.store(self.first, pieces, np.frombuffer(b"".join(r for r in rows if r), "<u4"),
                   np.array([-1 if r is None else len(r) // 4 for r in rows], np.int64))

    def following(self, pieces):
        marks, known = self.mark_ids, self.after
        plain, closed, loose = [], [], []
        for p in pieces:
            if not p or p[0].isspace() or p[-1].isspace():
                loose.append(p)
            elif p[-1] in marks and len(p) > 1 and p[-2] < LATIN_END and p[-2].isalpha():
                closed.append(p)
            else:
                plain.append(p)
        bases = [p[:-1] for p in closed]
        plain = list(dict.fromkeys([*plain, *[b for b in bases if b not in known]]))
        self.store(known, plain, *self._together(plain))
        self.store(known, loose, np.empty(0, "<u4"), np.full(len(loose), -1))
        if closed:  # the base's ids and the mark's
            number = np.fromiter(map(known.__getitem__, bases), np.int64, len(bases))
            length = self.length[number] + 1
            last = np.zeros(int(length.sum()), bool)
            last[np.cumsum(length) - 1] = True
            ids = np.empty(len(last), "<u4")
            ids[last] = [marks[p[-1]] for p in closed]
            ids[~last] = ragged(self.ids, self.start[number], length - 1)
            self.store(known, closed, ids, length)

    def _together(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces after a space, and how many each has."""
        out, sizes = [np.empty(0, "<u4")], [np.empty(0, np.int64)]
        for i in range(0, len(pieces), 4096):
            part = pieces[i:i + 4096]
            ids = np.array(self.batch([" " + " ".join(part)])[0].ids, "<u4")
            starts = np.flatnonzero(self.opens[ids])
            # a vocabulary that merges across these cuts, or an added token with a space in it
            if len(starts) != len(part) or self.holds_added(" ".join(part)):
                lists = [np.array(e.ids, "<u4") for e in self.batch([" " + p for p in part])]
                ids, starts = np.concatenate(lists), np.cumsum([0, *map(len, lists[:-1])])
            out.append(ids)
            sizes.append(np.diff(starts, append=len(ids)))
        return np.concatenate(out), np.concatenate(sizes)


_ENCODERS: dict[tuple, PieceEncoder] = {}


def encoder(kind: type[PieceEncoder], vocabulary: str, plain_special: bool = True) -> PieceEncoder:
    """The worker's encoder for a vocabulary, made once."""
    key = (kind.__name__, plain_special, hashlib.md5(vocabulary.encode()).hexdigest())
    if key not in _ENCODERS:
        _ENCODERS[key] = kind(vocabulary, plain_special)
    return _ENCODERS[key]


def slices(sizes: list[int], limit: int):
    """Index ranges of consecutive items of at most ``limit`` in total (or one item)."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)
