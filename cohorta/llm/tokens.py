"""Token ids of whole texts with the tokenizers library, each distinct word of a batch encoded once."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import CharDelimiterSplit

#: Fixed value: the id that ends a document.
END_ID = 2
#: Pieces whose ids a worker keeps; once there are more, the memory is emptied and filled anew.
KEPT_PIECES = 400_000
#: Text handled at once within an Arrow batch.
SLICE_BYTES = 4 << 20

# Words that the tokenizer cuts into runs of letters, digits or signs, and single line feeds. The
# apostrophe, which has rules of its own, and everything beyond these letters are left to the tokenizer.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_SIGNS = r"!-&(-/:-@\[-`{-~"
_PIECE = re.compile(rf"[{_LETTERS}]+|[0-9]+|[{_SIGNS}]+|\n")
_PLAIN = re.compile(rf"(?:[{_LETTERS}]+|[0-9]+|[{_SIGNS}]+|\n(?!\n))+")
_ENDS = frozenset(".,;:!?)]\"-")


def _pieces(word: str) -> list[str] | None:
    """The pieces of a word that is made of them alone."""
    if word.isascii():  # a run of letters, or one with a sign after it, needs no pattern
        if word.isalpha():
            return [word]
        if word[:-1].isalpha() and word[-1] in _ENDS:
            return [word[:-1], word[-1]]
    return _PIECE.findall(word) if _PLAIN.fullmatch(word) else None


def default_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[int, str]:
    """The public byte-level alphabet: printable bytes stand for themselves, the others follow from U+0100."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class Encoder:
    """encode(texts): the ids of all texts end to end, and where each text's begin.

    A byte-level tokenizer cuts a text before each blank that stands alone between two other characters, so the ids
    of a text are those of "word", " word", " word", ... joined. Each distinct word of a batch is encoded once, from
    pieces that the worker remembers. A text in which a blank touches other white space, or a special token's string
    occurs, is given to the tokenizer whole.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.bare = Tokenizer(self.tokenizer.model)  # for pieces that are already cut
        self.bare.pre_tokenizer = CharDelimiterSplit(" ")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.largest = max(self.tokenizer.get_vocab(with_added_tokens=True).values())
        self.letters = _byte_letters()
        self.known: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
        return np.asarray(found.ids, "<u4").tobytes()

    def _learn(self, pieces: set[str]) -> None:
        """Remember the ids of pieces, all encoded in one call."""
        if len(self.known) > KEPT_PIECES:
            self.known.clear()
        if not pieces:
            return
        new = list(pieces)
        line = " ".join(p.encode().decode("latin-1").translate(self.letters) for p in new)
        found = self.bare.encode(line, add_special_tokens=False)
        counts = np.bincount(np.asarray(found.word_ids, np.int64), minlength=len(new))
        raw, ends = np.asarray(found.ids, "<u4").tobytes(), (4 * np.cumsum(counts)).tolist()
        self.known.update((p, raw[i:j]) for p, i, j in zip(new, [0, *ends], ends))

    def words(self, words: list[str], before: str) -> list[bytes | None]:
        """The ids of before + word for each; None for a word that must not be taken apart from its neighbours."""
        known = self.known
        out = list(map(known.get, [before + w for w in words]))
        new = [k for k, raw in enumerate(out) if raw is None]
        if not new:
            return out
        every = "\0".join([words[k] for k in new])
        special = [s for s in self.special if s in every]
        for at in range(0, len(new), 20_000):
            part = new[at:at + 20_000]
            if special:
                part = [k for k in part if not any(s in words[k] for s in special)]
            cut, learn = [], set()
            for k in part:
                w = words[k]
                c = _pieces(w)
                if c:
                    c[0] = before + c[0]
                    learn.update(c)
                elif not w or w[0].isspace() or w[-1].isspace():
                    c = None
                cut.append(c)
            self._learn(learn.difference(known))
            for k, c in zip(part, cut):
                if c and len(c) == 1:
                    out[k] = known.get(c[0])
                elif c and None not in (raws := list(map(known.get, c))):
                    out[k] = b"".join(raws)
                if c is not None and out[k] is None:
                    # No piece, or a memory emptied in between: the tokenizer itself is always there.
                    out[k] = self.whole(before + words[k])
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        n = len(texts)
        lists = pc.split_pattern(texts, " ")
        offsets = np.asarray(lists.offsets, np.int64) - lists.offsets[0].as_py() if n else np.zeros(1, np.int64)
        flat = lists.flatten().dictionary_encode()
        codes = np.array(flat.indices, np.int64)
        words = flat.dictionary.to_numpy(zero_copy_only=False).tolist()
        later = self.words(words, " ")
        heads = self.words([words[c] for c in codes[offsets[:-1]]], "")
        # A text is whole if one of its words must not be taken apart.
        loose = np.array([x is None for x in later] or [False], bool)[codes] if len(codes) else np.zeros(0, bool)
        loose[offsets[:-1]] = [h is None for h in heads]
        bad = np.add.reduceat(loose, offsets[:-1]) > 0 if n else np.zeros(0, bool)
        if any(" " in s for s in self.special):
            bad |= np.array([any(s in t for s in self.special) for t in texts.to_pylist()], bool)
        for k in np.flatnonzero(bad):
            text = texts[int(k)].as_py()
            heads[k] = self.whole(text) if text else b""
        codes[offsets[:-1]] = len(later) + np.arange(n)
        counts = np.diff(offsets)
        keep = ~np.repeat(bad, counts)
        keep[offsets[:-1]] = True
        table = [x or b"" for x in later] + heads
        sizes = np.array([len(x) // 4 for x in table] or [0], np.int64)
        starts = np.cumsum(sizes) - sizes
        size = np.where(keep, sizes[codes] if len(codes) else 0, 0)
        ends = np.cumsum(size)
        pool = np.frombuffer(b"".join(table), "<u4")
        at = np.repeat((starts[codes] if len(codes) else codes) - (ends - size), size)
        at += np.arange(len(at))
        return pool[at], np.concatenate(([0], ends[offsets[1:] - 1])) if n else np.zeros(1, np.int64)


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs [i, j) of an array with about `limit` bytes of text each, at least one row."""
    sizes = np.asarray(pc.binary_length(texts), np.int64)
    total, at = np.cumsum(sizes), 0
    while at < len(texts):
        before = total[at] - sizes[at]
        end = max(at + 1, int(np.searchsorted(total, before + limit, "right")))
        yield at, end
        at = end


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder: it outlives the task, so that later tasks find the pieces of earlier ones."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encoded(texts: pa.Array, path: str) -> Iterator[tuple[int, np.ndarray]]:
    """(row, ids) of each text of an Arrow array without nulls."""
    own = encoder(path)
    for i, j in slices(texts):
        ids, offsets = own.encode(texts.slice(i, j - i))
        for k, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            yield i + k, ids[a:b]
