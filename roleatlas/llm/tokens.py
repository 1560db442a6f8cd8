"""Token ids of whole texts, with each distinct word encoded once."""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import kept
from .words import distinct_words, text_bytes

# Fixed values.  A word of these characters only is lower-cased and split here by the
# pre-tokenizer's own pattern; any other goes to the tokenizer as it is, for whoever normalizes
# rare characters otherwise than the tokenizer must not do it in its place.
RARE = re.compile(r"[^!-~¡-įı-ſ]|<\|")
LETTERS = "a-zªµºß-öø-ſ"
NUMBERS = "0-9²³¹¼-¾"
PIECES = re.compile(f"'(?:[stmd]|re|ve|ll)|[{LETTERS}]+|[{NUMBERS}]|[^{LETTERS}{NUMBERS}]+")
# Pieces that a worker remembers, and the most ids of one.
KNOWN_MOST = 300_000
LONG = 64
WORD_END = "</w>"
# What a character is, by its code, and its lower case.  ODD ones need the pattern or the tokenizer;
# the last row is for all codes beyond.
ODD, LETTER, NUMBER, OTHER = range(4)
KINDS = np.zeros(0x181, np.uint8)
FOLDED = np.arange(0x181, dtype="<u4")
for _code in range(0x180):
    if not RARE.match(chr(_code)) and chr(_code) != "'":
        FOLDED[_code] = ord(chr(_code).lower())
        _kinds = (LETTERS, LETTER), (NUMBERS, NUMBER), ("", OTHER)
        KINDS[_code] = next(k for c, k in _kinds if not c or re.match(f"[{c}]", chr(FOLDED[_code])))


def runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions of runs that begin at ``starts``, one run after the other."""
    ends = np.cumsum(sizes)
    n = int(ends[-1]) if len(ends) else 0
    most = max(n, int(starts.max()) if len(starts) else 0)
    kind = np.int32 if most < 1 << 31 else np.int64
    return np.arange(n, dtype=kind) + np.repeat((starts - ends + sizes).astype(kind), sizes)


def take_apart(words: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The lower-cased pieces of distinct words, and each word's first piece and number of pieces.

    All words are split at once by the kinds of their characters.  Those with an odd
    character are split by :func:`pieces_of`; what only the tokenizer itself should
    split is one piece.
    """
    data, offsets = text_bytes(words)
    begins = offsets - np.searchsorted(np.flatnonzero((data & 0xC0) == 0x80), offsets)
    codes = np.minimum(np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4"), len(KINDS) - 1)
    kind = KINDS[codes]
    strange = kind == ODD
    strange[:-1] |= (codes[:-1] == ord("<")) & (codes[1:] == ord("|"))
    odd = np.zeros(len(words), bool)
    odd[np.searchsorted(begins, np.flatnonzero(strange), "right") - 1] = True
    if odd.any():
        inside = np.repeat(~odd, np.diff(begins))
        codes, kind = codes[inside], kind[inside]
        begins = np.append(0, np.cumsum(np.diff(begins)[~odd]))
    head = kind == NUMBER
    head[1:] |= kind[1:] != kind[:-1]
    head[begins[:-1]] = True
    heads = np.append(np.flatnonzero(head), len(head))
    folded = FOLDED[codes]
    stops = heads + np.searchsorted(np.flatnonzero(folded >= 0x80), heads)  # two bytes each
    text = folded.tobytes().decode("utf-32-le").encode()
    even = pa.LargeStringArray.from_buffers(len(heads) - 1, pa.py_buffer(stops), pa.py_buffer(text))
    count = np.zeros(len(words), np.int64)
    count[~odd] = np.diff(np.searchsorted(heads, begins))
    first = np.cumsum(count) - count
    rest: list[str] = []
    for k in np.flatnonzero(odd).tolist():
        word = words[k].as_py().decode()
        parts = pieces_of(word) or [word]
        first[k], count[k] = len(even) + len(rest), len(parts)
        rest += parts
    return pa.concat_arrays([even, pa.array(rest, pa.large_string())]), first, count


class Encoder:
    """Ids of a tokenizer that lowers case, drops white space and marks word ends."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        ends = [i for t, i in self.tokenizer.get_vocab().items() if t.endswith(WORD_END)]
        self.is_end = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.is_end[ends] = True
        # The same model for pieces between blanks, which need not be normalized and split again.
        self.plain = Tokenizer(self.tokenizer.model)
        split, spell = pre_tokenizers.CharDelimiterSplit(" "), pre_tokenizers.ByteLevel(False, use_regex=False)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([split, spell])
        # Pieces met before, the latest first, and their ids, one after the other.
        self.known = pa.array([], pa.large_string())
        self.ids, self.sizes = np.zeros(0, "<u4"), np.zeros(0, np.int64)

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def learn(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of new pieces, where each piece's begin, and how many it has.

        All pieces but those of rare characters end with the one id that marks a word's end.
        """
        rare = [k for k, piece in enumerate(pieces) if RARE.search(piece)]
        plain = np.delete(np.arange(len(pieces)), rare).tolist()
        parts = [plain[at:at + 100] for at in range(0, len(plain), 100)]
        texts = [" ".join([pieces[k] for k in part]) for part in parts]
        order, ids, sizes = [], [np.zeros(0, "<u4")], [np.zeros(0, np.int64)]
        for part, encoding in zip(parts, self.plain.encode_batch_fast(texts, add_special_tokens=False)):
            found = np.array(encoding.ids, "<u4")
            stops = np.flatnonzero(self.is_end[found]) + 1
            if len(stops) == len(part):
                order += part
                ids.append(found)
                sizes.append(np.diff(stops, prepend=0))
            else:
                rare += part
        for k in rare:
            ids.append(np.frombuffer(self.whole(pieces[k]), "<u4"))
            sizes.append(np.array([len(ids[-1])]))
        place = np.argsort(np.array(order + rare, np.int64))
        size = np.concatenate(sizes)
        return np.concatenate(ids), (np.cumsum(size) - size)[place], size[place]

    def find(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids that hold those of distinct pieces, where each piece's begin, and how many it has.

        Pieces are told apart by all their bytes.  Those of this call are the first to
        be known in the next one.
        """
        at = pc.index_in(pieces, value_set=self.known)
        new = at.is_null()
        fresh = pieces.filter(new)
        more, places, counts = self.learn(fresh.to_pylist())
        ids, sizes = np.append(self.ids, more), np.append(self.sizes, counts)
        starts = np.append(np.cumsum(self.sizes) - self.sizes, len(self.ids) + places)
        number = at.fill_null(0).to_numpy().astype(np.int64)
        number[new.to_numpy(zero_copy_only=False)] = len(self.known) + np.arange(len(fresh))
        unmet = np.ones(len(sizes), bool)
        unmet[number] = False
        keep = np.concatenate([number, np.flatnonzero(unmet)])
        keep = keep[sizes[keep] <= LONG][:KNOWN_MOST]
        self.known = pa.concat_arrays([self.known, fresh]).take(pa.array(keep))
        self.ids, self.sizes = ids[runs(starts[keep], sizes[keep])], sizes[keep]
        return ids, starts[number], sizes[number]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in one array, and where each text's begin.

        White space never joins or splits otherwise than between words, so a text's
        ids are those of its words in order, and a word's those of its pieces.
        """
        number, counts, words = distinct_words(texts)
        pieces, first, count = take_apart(words)
        pieces = pieces.dictionary_encode()
        ids, starts, sizes = self.find(pieces.dictionary)
        piece = pieces.indices.to_numpy()[runs(first, count)]
        ids = ids[runs(starts[piece], sizes[piece])]
        ends = np.append(0, np.cumsum(sizes[piece]))[np.append(0, np.cumsum(count))]
        starts, sizes = ends[:-1], np.diff(ends)
        ends = np.append(0, np.cumsum(sizes[number]))
        return ids[runs(starts[number], sizes[number])], ends[np.append(0, np.cumsum(counts))]


def pieces_of(word: str) -> list[str] | None:
    """The pieces of a word, or none if only the tokenizer itself should split it."""
    return None if RARE.search(word) else PIECES.findall(word.lower())


def encoder(path: str) -> Encoder:
    """One encoder per worker and tokenizer file; workers are reused between tasks."""
    return kept(f"encoder {path}", lambda: Encoder(path))
