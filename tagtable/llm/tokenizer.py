"""Public tokenizers inside tasks: loaded once per Python worker from a path that every machine has."""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np

from tagtable.llm.words import NOT_BLANK, Texts, Words

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs the tasks in parallel


class Pieces:
    """A sentencepiece model that counts tokens of whole texts."""

    PART_CHARS = 1 << 16

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        space = "▁"
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        # A text may be cut at a lone blank if no piece goes over it and if blanks are kept as they are.
        self.splits = (
            all(space not in p.lstrip(space) for p in pieces)
            and self.model.encode("a  b", out_type=str)[:2] == [space + "a", space]
            and self._count(["a b", "b"]) == [self._count(["a"])[0] + self._count(["b"])[0], self._count(["b"])[0]]
        )

    def _count(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.model.encode(texts, num_threads=1)]

    def parts(self, text: str) -> list[str]:
        """A long text in parts, whose tokens together are the text's; a text without a safe place stays whole."""
        if len(text) <= self.PART_CHARS or not self.splits:
            return [text]
        out, first = [], 0
        while len(text) - first > self.PART_CHARS:
            cut = safe_cut(text, first + self.PART_CHARS)
            if cut < 0:
                break
            out.append(text[first:cut])
            first = cut + 1
        return [*out, text[first:]]

    def counts(self, texts: list[str]) -> list[int]:
        parts = [self.parts(text) for text in texts]
        counted = iter(self._count([p for own in parts for p in own]))
        return [sum(next(counted) for _ in own) for own in parts]


def safe_cut(text: str, near: int) -> int:
    """The first place from ``near`` on of a blank between two characters that are no blanks, or -1."""
    cut = text.find(" ", near)
    while cut >= 0 and not (cut + 1 < len(text) and not text[cut - 1].isspace() and not text[cut + 1].isspace()):
        cut = text.find(" ", cut + 1)
    return cut


class Vocabulary:
    """A file of the tokenizers library; encodes whole texts, each different piece once as far as memory allows.

    Where blanks part words for good and ASCII words fall into runs of letters, single digits and runs of other
    signs, as in ``word_bpe_49k``, a text's ids are those of these pieces one after the other. The loaded file is
    tried on examples for that; if they fail, texts are encoded whole. Ids of pieces are kept by a 64-bit hash,
    of ``KEPT`` pieces at most at a time. Words with other than printable ASCII, or with an apostrophe, are one
    piece. Texts beside one that holds a special token's string are encoded whole.
    """

    KEPT = 1 << 21
    BATCH = 100
    MARK = b"|"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        added = self.model.get_added_tokens_decoder().values()
        self.special = [token.content.lower().encode() for token in added]
        self.by_piece = False
        examples = ["Ab cd's", "x.\n.y", "9 9", "aB12c!?3", "é 's", " z\t \r z\x0b\x0c", "a|B | ||", "A_b-C..d $$a1", "''a b"]
        if self._whole_ids(self.MARK.decode()) and len(self._whole_ids(self.MARK.decode())) == 1:
            self.mark = self._whole_ids(self.MARK.decode())[0]
            self._forget()
            self.by_piece = True
            for example in examples:
                data = np.frombuffer(example.encode(), dtype=np.uint8)
                ids, _ = self.encode(Texts(data, np.array([0, len(data)])))
                self.by_piece = self.by_piece and ids.tolist() == self._whole_ids(example)
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, dtype=np.uint64)  # sorted
        self.first = np.zeros(0, dtype=np.int64)
        self.size = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.int32)

    def _whole_ids(self, text: str) -> list[int]:
        return self.model.encode(text, add_special_tokens=False).ids

    def encode(self, texts: Texts, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and each text's bounds in them; every text closes with ``end`` if that is given."""
        lower = texts.lower()
        joined = lower.data.tobytes()
        if not self.by_piece or any(s in joined for s in self.special):
            return self._plainly(texts, end)
        pieces, plain = self._pieces(texts, lower)
        hashes, back = np.unique(pieces.hashes(), return_inverse=True)
        self._learn(hashes, back, pieces, plain)
        at = np.searchsorted(self.known, hashes)
        first, size = self.first[at][back], self.size[at][back]
        bounds, ids = pieces.bounds, self.ids
        if end is not None:
            first = np.insert(first, bounds[1:], len(ids))
            size = np.insert(size, bounds[1:], 1)
            bounds = bounds + np.arange(len(bounds))
            ids = np.append(ids, np.int32(end))
        total = np.zeros(len(size) + 1, dtype=np.int64)
        np.cumsum(size, out=total[1:])
        take = np.repeat(first - total[:-1], size) + np.arange(total[-1])
        return ids[take], total[bounds]

    def _plainly(self, texts: Texts, end: int | None) -> tuple[np.ndarray, np.ndarray]:
        data, close = texts.data.tobytes(), [] if end is None else [end]
        bounds, parts = [0], []
        for a, b in zip(texts.offsets[:-1].tolist(), texts.offsets[1:].tolist(), strict=True):
            parts.append(np.array(self._whole_ids(data[a:b].decode()) + close, dtype=np.int32))
            bounds.append(bounds[-1] + len(parts[-1]))
        return np.concatenate(parts), np.array(bounds)

    @staticmethod
    def _pieces(texts: Texts, lower: Texts) -> tuple[Words, np.ndarray]:
        """Pieces of the texts, and which of them are plain ASCII; only such words are in lower case."""
        words = texts.words(NOT_BLANK)
        odd = np.zeros(len(texts.data) + 1, dtype=np.int64)
        np.cumsum(_OPAQUE[texts.data], out=odd[1:])
        opaque = odd[words.ends] > odd[words.starts]
        kind = _KIND[lower.data]
        inside = np.zeros(len(kind) + 1, dtype=np.int8)
        np.add.at(inside, words.starts[opaque], 1)
        np.subtract.at(inside, words.ends[opaque], 1)
        within = np.cumsum(inside[:-1]) > 0
        kind = np.where(within, np.uint8(4), kind)
        begins = np.zeros(len(kind), dtype=bool)
        begins[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        begins[words.starts] = True
        begins &= kind > 0
        starts = np.flatnonzero(begins)
        last = np.zeros(len(kind) + 1, dtype=bool)
        last[words.ends] = True
        last[starts] = True
        stops = np.flatnonzero(last)
        ends = stops[np.searchsorted(stops, starts, side="right")] if len(starts) else starts
        data = np.where(within, texts.data, lower.data)
        pieces = Words(Texts(data, texts.offsets), starts, ends, np.searchsorted(starts, texts.offsets))
        return pieces, kind[starts] != 4

    def _learn(self, hashes: np.ndarray, back: np.ndarray, pieces: Words, plain: np.ndarray) -> None:
        at = np.searchsorted(self.known, hashes)
        new = np.ones(len(hashes), dtype=bool)
        inside = at < len(self.known)
        new[inside] = self.known[at[inside]] != hashes[inside]
        if not new.any():
            return
        if len(self.known) + int(new.sum()) > self.KEPT and len(self.known):
            self._forget()
            return self._learn(hashes, back, pieces, plain)
        some = np.zeros(len(hashes), dtype=np.int64)
        some[back] = np.arange(len(back))  # a piece of each hash
        fresh = np.flatnonzero(new)
        chosen = some[fresh]
        data = pieces.texts.data.tobytes()
        spelled = [data[a:b].decode() for a, b in zip(pieces.starts[chosen].tolist(), pieces.ends[chosen].tolist(), strict=True)]
        found: list = [None] * len(spelled)
        tokenize = self.model.model.tokenize
        hard = []
        for i, (text, easy) in enumerate(zip(spelled, plain[chosen].tolist(), strict=True)):
            if easy:
                found[i] = [token.id for token in tokenize(text)]
            else:
                hard.append(i)
        for i, ids in zip(hard, self._encode_many([spelled[i] for i in hard]), strict=True):
            found[i] = ids
        size = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        first = np.zeros(len(size) + 1, dtype=np.int64)
        np.cumsum(size, out=first[1:])
        ids = np.fromiter((x for own in found for x in own), dtype=np.int32, count=int(first[-1]))
        place = at[fresh]
        self.known = np.insert(self.known, place, hashes[fresh])
        self.first = np.insert(self.first, place, first[:-1] + len(self.ids))
        self.size = np.insert(self.size, place, size)
        self.ids = np.concatenate([self.ids, ids])

    def _encode_many(self, words: list[str]) -> list:
        """Ids of words, many of them in one text with a mark after each; words that hold the mark go alone."""
        mark = self.MARK.decode()
        out: list = [self._whole_ids(w) if mark in w else None for w in words]
        rest = [i for i, ids in enumerate(out) if ids is None]
        groups = [rest[i : i + self.BATCH] for i in range(0, len(rest), self.BATCH)]
        texts = [f" {mark} ".join([*(words[i] for i in group), ""]) for group in groups]
        for group, encoded in zip(groups, self.model.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            ids = np.array(encoded.ids, dtype=np.int32)
            marks = np.flatnonzero(ids == self.mark)
            for i, a, b in zip(group, [0, *(marks[:-1] + 1).tolist()], marks.tolist(), strict=True):
                out[i] = ids[a:b].tolist()
        return out


_KIND = np.full(256, 3, dtype=np.uint8)  # 0 blank, 1 letter, 2 digit, 3 another sign, 4 part of an opaque word
_KIND[~NOT_BLANK] = 0
_KIND[0x61:0x7B] = 1
_KIND[0x30:0x3A] = 2
_OPAQUE = np.zeros(256, dtype=bool)
_OPAQUE[0x7F:] = _OPAQUE[0x27] = _OPAQUE[:0x20] = True


@lru_cache(maxsize=4)
def pieces(path: str) -> Pieces:
    return Pieces(path)


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def public_path(name: str) -> str:
    """The place of a public tokenizer's file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
