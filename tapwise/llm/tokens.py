"""Token ids by the tokenizers library, with a bounded cache of pieces of text in each worker."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Pieces kept by a worker; what goes beyond is encoded again when it comes again.
CACHED_PIECES = 300_000
CACHED_BYTES = 40
# Words are looked up for so many bytes of text at once, and ids put together for so many words.
SLICE_BYTES = 4_000_000
GATHER_WORDS = 100_000
# New runs of letters are encoded so many at once, with a stop behind each.
JOINED_PIECES = 256
STOP = "."

# Letters that stay one letter when composed and lower-cased (İ becomes two characters).
_LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ɏ"
# Runs of letters and runs of the rest, each with the single space before it.
_PIECES = re.compile(f" ?[{_LETTERS}]+| ?[^{_LETTERS} ]+")
_LETTER_RUN = rf"^ ?[{_LETTERS}]+$"
# Where tokens may reach over the ends of such runs: other letters, contractions, rows of white space.
_OPEN = re.compile(rf"[^\x00-\x7f{_LETTERS}]|'|\s\s|(?<=[\s\S]) | $")
# A space alone between two words.
_GAP = re.compile(r"(?<=\S)(?= \S)")
# The same as Arrow's regular expressions have it; the mark stands behind every piece.
_MARK = "\x01"
_WHITE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_ODD_TEXT = rf"^ | $|{_WHITE} | {_WHITE}|{_MARK}"
_OPEN_WORD = rf"[^\x00-\x7f{_LETTERS}]|'|{_WHITE}{_WHITE}"

_encoders: dict[str, Encoder] = {}


class Encoder:
    """Encodes texts word by word.

    Both kinds of vocabulary used here (byte-level, and word ends with white space dropped) begin a new
    token at a single space between two words, and between a letter and what is none. So a
    text's ids are those of its words in turn, a word's those of its runs of letters and of the rest, and
    what is frequent needs to be encoded only once. Where more than that is at stake, a word is
    encoded as it is, and a text is cut at no other spaces.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Control strings in a text are ordinary text.
        self.tokenizer.encode_special_tokens = True
        self.stop = self.tokenizer.encode(STOP, add_special_tokens=False).ids
        # Known pieces, their ids in turn, and where each one's ids begin and the last one's end.
        self.known = pa.array([], pa.string())
        self.ids = np.empty(0, np.uint32)
        self.edges = np.zeros(1, np.int64)

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers; a null text is empty."""
        texts = pc.fill_null(texts, "")
        size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < len(texts):
            before = size[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(size, before + SLICE_BYTES, "right")))
            yield from self._slice(texts.slice(at, end - at))
            at = end
        # Else Arrow's pool keeps the most that any slice has needed.
        pa.default_memory_pool().release_unused()

    def _slice(self, texts: pa.Array) -> Iterator[bytes]:
        is_odd = pc.match_substring_regex(texts, _ODD_TEXT)
        spaced = pc.split_pattern(pc.if_else(is_odd, "", texts), " ")
        bounds = spaced.offsets.to_numpy() - spaced.offsets[0].as_py()
        coded = spaced.flatten().dictionary_encode()
        # A text's first word has no space before it; each is a word of its own.
        heads = coded.take(pa.array(bounds[:-1])).dictionary_decode()
        number = coded.indices.to_numpy(zero_copy_only=False).copy()
        number[bounds[:-1]] = len(coded.dictionary) + np.arange(len(heads))
        tails = pc.binary_join_element_wise(" ", coded.dictionary, "")
        ids, edges = self._words(pa.concat_arrays([tails, heads]))
        odd = is_odd.to_numpy(zero_copy_only=False)
        del spaced, coded, tails, heads
        first = 0
        while first < len(odd):
            last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + GATHER_WORDS, "right")) - 1)
            flat, ends = _gather(ids, edges, number[bounds[first] : bounds[last]])
            ends = ends[bounds[first : last + 1] - bounds[first]]
            for i, a, b in zip(range(first, last), ends, ends[1:]):
                yield self._odd(texts[i].as_py()) if odd[i] else flat[a:b].tobytes()
            first = last

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in turn, and where each word's begin and the last one's end."""
        whole = pc.binary_join_element_wise(words, _MARK, "")
        mixed = pc.invert(pc.match_substring_regex(words, f"{_LETTER_RUN}|{_OPEN_WORD}"))
        pieces = pc.replace_substring_regex(words.filter(mixed), f"({_PIECES.pattern})", rf"\1{_MARK}")
        cut = pc.split_pattern(pc.replace_with_mask(whole, mixed, pieces), _MARK)
        coded = cut.flatten().dictionary_encode()
        ids, edges = self._pieces(coded.dictionary)
        ids, edges = _gather(ids, edges, coded.indices.to_numpy(zero_copy_only=False))
        return ids, edges[cut.offsets.to_numpy() - cut.offsets[0].as_py()]

    def _odd(self, text: str) -> bytes:
        words = _GAP.split(text)
        cut = [[word] if _OPEN.search(word) else _PIECES.findall(word) for word in words]
        coded = pa.array([piece for own in cut for piece in own], pa.string()).dictionary_encode()
        ids, edges = self._pieces(coded.dictionary)
        return _gather(ids, edges, coded.indices.to_numpy(zero_copy_only=False))[0].tobytes()

    def _pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all `pieces`, each of which is there once, and their bounds."""
        place = pc.index_in(pieces, value_set=self.known)
        rare = pieces.filter(pc.is_null(place))
        own, bounds = self._rare(rare)
        ids = np.append(self.ids, own)
        edges = np.append(self.edges, self.edges[-1] + bounds[1:])
        known = place.to_numpy(zero_copy_only=False)
        missing = np.isnan(known) if known.dtype.kind == "f" else np.zeros(len(known), bool)
        number = np.where(missing, len(self.known) + np.cumsum(missing) - 1, np.nan_to_num(known)).astype(np.int64)
        found = _gather(ids, edges, number)
        short = pc.less_equal(pc.binary_length(rare), CACHED_BYTES).to_numpy(zero_copy_only=False)
        kept = np.flatnonzero(short)[: CACHED_PIECES - len(self.known)]
        if len(kept):
            more, ends = _gather(ids, edges, len(self.known) + kept)
            self.known = pa.concat_arrays([self.known, rare.take(pa.array(kept))])
            self.ids = np.append(self.ids, more)
            self.edges = np.append(self.edges, self.edges[-1] + ends[1:])
        return found

    def _rare(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all `pieces` in turn, and their bounds, by the tokenizer.

        Nearly all are runs of letters, of which no token reaches into a stop behind them or has its id.
        """
        if len(self.stop) != 1:
            return self._encoded(pieces.to_pylist())
        joins = pc.match_substring_regex(pieces, _LETTER_RUN)
        runs = pieces.filter(joins).to_pylist()
        parts = (runs[at : at + JOINED_PIECES] for at in range(0, len(runs), JOINED_PIECES))
        flat, _ = self._encoded([STOP.join(part) + STOP for part in parts])
        stops = np.flatnonzero(flat == self.stop[0])
        if len(stops) != len(runs):
            return self._encoded(pieces.to_pylist())
        ids, sizes = self._encoded(pieces.filter(pc.invert(joins)).to_pylist())
        joined = joins.to_numpy(zero_copy_only=False)
        number = np.where(joined, np.cumsum(joined), len(runs) + np.cumsum(~joined)) - 1
        edges = np.append(stops - np.arange(len(stops)), len(flat) - len(stops) + sizes[1:])
        return _gather(np.append(np.delete(flat, stops), ids), np.append(0, edges), number)

    def _encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        own = [encoding.ids for encoding in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        bounds = np.append(0, np.cumsum([len(one) for one in own], dtype=np.int64))
        return np.fromiter(chain.from_iterable(own), np.uint32, int(bounds[-1])), bounds


def _gather(ids: np.ndarray, edges: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the parts `number` of `ids` in turn, and where each begins; `edges` bounds the parts."""
    each = np.diff(edges)[number]
    ends = np.append(0, np.cumsum(each))
    place = np.repeat(edges[number] - ends[:-1], each)
    place += np.arange(len(place))
    return ids[place], ends


def encoder(path: str) -> Encoder:
    """This worker's encoder for the vocabulary file at `path`."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
