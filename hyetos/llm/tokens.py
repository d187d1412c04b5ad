"""Token ids of whole texts with the ``tokenizers`` library, each new word encoded once.

A byte-level BPE vocabulary splits a text before every single space that stands between
two characters that are not white space, and no merge crosses such a place. So a text is
cut there, and pieces seen before are looked up: invented or rare words are the costly
part, and they are encoded many at a time. Texts with runs of white space, special tokens
or other odd places are cut with more care or encoded whole; all ways give the same ids.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MAX_CACHED = 400_000
GROUP = 100  # simple words encoded as one
_SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Most simple words: what ``_simple`` accepts, of letters a-z and A-Z.
_PLAIN = rf"^[A-Za-z]+[{re.escape(_MARKS)}]*(\n[A-Za-z]+[{re.escape(_MARKS)}]*)?$"
_coders: dict[str, WordCoder] = {}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself if it can be seen, else one from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def _simple(word: str) -> bool:
    """Letters, then marks; perhaps a second time after one line feed."""
    if word.rstrip(_MARKS).isalpha():
        return True
    first, feed, second = word.partition("\n")
    return feed != "" and first.rstrip(_MARKS).isalpha() and second.rstrip(_MARKS).isalpha()


def _crosses(token: str) -> bool:
    """Whether a token has a letter, or part of one, beside a mark, or a space inside."""
    for a, b in zip(token, token[1:], strict=False):
        letters = [c.isalpha() or "\udc80" <= c <= "\udcff" for c in (a, b)]
        marks = [c in _MARKS or c == "\n" for c in (a, b)]
        if letters[0] and marks[1] or marks[0] and letters[1]:
            return True
        if "\n" in (a, b) and (a in _MARKS or b in _MARKS):
            return True
        if b == " " and a not in " \xa0":
            return True
    return False


def _joined(held: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The stretches of ``held`` one after the other."""
    ends = np.cumsum(length)
    return held[np.repeat(begin - ends + length, length) + np.arange(ends[-1] if len(ends) else 0)]


class WordCoder:
    """Ids of texts as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.special = [
            t.content for t in self.whole.get_added_tokens_decoder().values()
        ]
        vocabulary = self.whole.get_vocab(with_added_tokens=False)
        vocabulary = {t: n for t, n in vocabulary.items() if t not in self.special}
        self.bare = Tokenizer(self.whole.model)  # cuts nothing: for simple words only
        self.letters = _byte_letters()
        self.starts = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, number in vocabulary.items():
            self.starts[number] = token.startswith("Ġ")
        byte_of = {letter: byte for byte, letter in self.letters.items()}
        #: whether no token of the vocabulary crosses the parts of simple words
        self.joinable = not any(
            _crosses(bytes(map(byte_of.__getitem__, t)).decode(errors="surrogateescape"))
            for t in vocabulary
        )
        self.cache: dict[str, bytes] = {}
        self._forget()

    def _forget(self) -> None:
        """Drop the pieces that ``encode`` knows, with the place and number of their ids."""
        self.known = pa.array([], pa.large_string())
        self.begin, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.held = np.zeros(0, np.uint32)

    def _coded(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of pieces, each with the space before it: their order, all ids, ids of each."""
        words = pieces.to_pylist()
        fits = np.zeros(len(words), bool)
        if self.joinable:
            fits = pc.match_substring_regex(pieces, _PLAIN).to_numpy(zero_copy_only=False)
            fits = fits.astype(bool)
            for i in np.flatnonzero(~fits).tolist():
                fits[i] = _simple(words[i])
        order = np.concatenate([np.flatnonzero(fits), np.flatnonzero(~fits)])
        simple = list(compress(words, fits.tolist()))
        rest = list(compress(words, (~fits).tolist()))
        ids: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        for at in range(0, len(simple), 8000):
            part = simple[at : at + 8000]
            groups = []
            for i in range(0, len(part), GROUP):
                shown = " " + " ".join(part[i : i + GROUP])
                groups.append(shown.encode().decode("latin-1").translate(self.letters))
            encoded = self.bare.encode_batch_fast(groups, add_special_tokens=False)
            ids.append(np.concatenate([np.array(e.ids, "<u4") for e in encoded]))
            cuts = np.flatnonzero(self.starts[ids[-1]])
            if len(cuts) != len(part):
                raise ValueError("the vocabulary joins words")
            sizes.append(np.diff(cuts, append=len(ids[-1])))
        for at in range(0, len(rest), 8000):
            encoded = self.whole.encode_batch_fast(
                [" " + w for w in rest[at : at + 8000]], add_special_tokens=False
            )
            ids += [np.array(e.ids, "<u4") for e in encoded]
            sizes.append(np.array([len(e.ids) for e in encoded], np.int64))
        nothing = np.zeros(0, "<u4")
        return (
            order,
            np.concatenate([nothing, *ids]),
            np.concatenate([nothing.astype(np.int64), *sizes]),
        )

    def _learn(self, words: list[str]) -> None:
        """Put the ids of pieces into ``cache``, as bytes."""
        order, ids, sizes = self._coded(pa.array(words, pa.large_string()))
        raw, at = ids.tobytes(), 0
        for i, size in zip(order.tolist(), sizes.tolist(), strict=True):
            self.cache[words[i]] = raw[4 * at : 4 * (at + size)]
            at += size

    def _pieces(self, text: str) -> list[str]:
        if len(text.split()) - 1 == text.count(" ") + text.count("\n"):
            return text.split(" ")
        return _SAFE_CUT.split(text)

    def _cut(self, texts: list[str]) -> tuple[list[str], pa.Array, np.ndarray]:
        """First pieces, all other pieces in order of texts, and how many each text has."""
        heads, tails, odd = [], [], {}
        for i, text in enumerate(texts):
            tail = None
            if any(s in text for s in self.special):
                head = text
            elif len(text.split()) - 1 == text.count(" ") + text.count("\n"):
                head, space, rest = text.partition(" ")
                tail = rest if space else None
            else:
                head, *odd[i] = _SAFE_CUT.split(text)
            heads.append(head)
            tails.append(tail)
        pieces = pc.split_pattern(pa.array(tails, pa.large_string()), " ")
        counts = pc.fill_null(pc.list_value_length(pieces), 0).to_numpy().astype(np.int64)
        flat = [pieces.flatten()]
        if odd:
            ends, flat, last = np.cumsum(counts), [], 0
            for i, own in odd.items():
                flat += [pieces.flatten()[last : ends[i]], pa.array(own, pa.large_string())]
                last, counts[i] = ends[i], len(own)
            flat.append(pieces.flatten()[last:])
        return heads, pa.concat_arrays(flat), counts

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """Ids of every text.

        Each different piece of the texts is encoded once; those met twice stay known, for
        most others are invented or rare.
        """
        heads, pieces, counts = self._cut(list(texts))
        if len(self.known) > MAX_CACHED:
            self._forget()
        coded = pieces.dictionary_encode()
        each = coded.indices.to_numpy()
        at = pc.fill_null(pc.index_in(coded.dictionary, value_set=self.known), -1).to_numpy()
        fresh = np.flatnonzero(at < 0)
        order, ids, sizes = self._coded(coded.dictionary.take(pa.array(fresh)))
        held = np.concatenate([self.held, ids])
        begin, length = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        old = np.flatnonzero(at >= 0)
        begin[old], length[old] = self.begin[at[old]], self.length[at[old]]
        begin[fresh[order]] = len(self.held) + np.cumsum(sizes) - sizes
        length[fresh[order]] = sizes
        ends = np.concatenate([[0], np.cumsum(length[each])])
        raw = memoryview(_joined(held, begin[each], length[each]).tobytes())
        stops = 4 * ends[np.concatenate([[0], np.cumsum(counts)])]
        twice = fresh[np.bincount(each, minlength=len(at))[fresh] > 1]
        self.known = pa.concat_arrays([self.known, coded.dictionary.take(pa.array(twice))])
        kept = np.cumsum(length[twice])
        self.begin = np.concatenate([self.begin, len(self.held) + kept - length[twice]])
        self.length = np.concatenate([self.length, length[twice]])
        self.held = np.concatenate([self.held, _joined(held, begin[twice], length[twice])])
        encoded = self.whole.encode_batch_fast(heads, add_special_tokens=False)
        return [
            np.array(head.ids, "<u4").tobytes() + raw[a:b]
            for head, a, b in zip(encoded, stops[:-1].tolist(), stops[1:].tolist(), strict=True)
        ]


def coder(path: str) -> WordCoder:
    """The coder of this worker process, kept between tasks."""
    if path not in _coders:
        _coders[path] = WordCoder(path)
    return _coders[path]
