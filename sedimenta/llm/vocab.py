"""Encoding texts with a tokenizer file, every distinct piece of a block once."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from sedimenta.llm.common import ragged_rows, take_ragged, words_of

_LOADED: dict[str, object] = {}
_SEEN: dict[int, SeenWords] = {}
# Bytes that the words a worker keeps, and their ids, take; words longer than the second are not kept.
KEPT_BYTES, KEPT_WORD = 96 << 20, 64
# Bytes of text whose words are encoded together: the more, the fewer words are encoded again.
TEXT_BYTES = 16 << 20
# Pieces handed to the tokenizer at a time: its result objects are large.
PIECES = 20_000
LONE_SPACE = re.compile(r" (?<=\S )(?=\S)")
# All characters that are white space for any pattern here; one of them beside a space.
_WHITE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
SPACE_IN_RUN = f" {_WHITE}|{_WHITE} "


def load_tokenizer(path: str):
    """The tokenizer of a file, loaded once for each worker process. A special token written out in a text is that token."""
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _LOADED[path] = Tokenizer.from_file(path)
    return _LOADED[path]


def encode_strings(tokenizer, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of every string, as a ragged array."""
    flats, lengths = [np.zeros(0, np.uint32)], [np.zeros(1, np.int64)]
    for first in range(0, len(strings), PIECES):
        ids = [e.ids for e in tokenizer.encode_batch_fast(strings[first:first + PIECES], add_special_tokens=False)]
        lengths.append(np.fromiter(map(len, ids), np.int64, len(ids)))
        flats.append(np.fromiter(chain.from_iterable(ids), np.uint32))
    return np.concatenate(flats), np.cumsum(np.concatenate(lengths))


class SeenWords:
    """Short words a worker has encoded, with their ids, for the next block or task; started anew beyond ``kept_bytes``."""

    def __init__(self, kept_bytes: int | None = None):
        self.kept_bytes = KEPT_BYTES if kept_bytes is None else kept_bytes
        self.words = pa.array([], pa.large_string())
        self.flat, self.starts = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def encode(self, tokenizer, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids as a ragged array, and the row of it that each word has."""
        known = pc.index_in(words, value_set=self.words)
        new = words.filter(pc.is_null(known))
        flat, starts = encode_strings(tokenizer, new.to_pylist())
        row = pc.fill_null(known, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        row[row < 0] = np.arange(len(self.words), len(self.words) + len(new))
        every = np.concatenate([self.flat, flat]), np.concatenate([self.starts, starts[1:] + len(self.flat)]), row
        short = np.flatnonzero(pc.less_equal(pc.binary_length(new), KEPT_WORD).to_numpy(zero_copy_only=False))
        self.keep(new.take(pa.array(short)), *take_ragged(flat, starts, short))
        return every

    def keep(self, words: pa.Array, flat: np.ndarray, starts: np.ndarray) -> None:
        if self.words.nbytes + words.nbytes + self.flat.nbytes + flat.nbytes + self.starts.nbytes + starts.nbytes > self.kept_bytes:
            self.__init__(self.kept_bytes)
        if words.nbytes + flat.nbytes + starts.nbytes <= self.kept_bytes:
            self.words = pa.concat_arrays([self.words, words])
            self.starts = np.concatenate([self.starts, starts[1:] + len(self.flat)])
            self.flat = np.concatenate([self.flat, flat])


def seen_words(tokenizer, kept_bytes: int | None = None) -> SeenWords:
    """What this worker keeps for a tokenizer, within the bound its present task names."""
    seen = _SEEN.setdefault(id(tokenizer), SeenWords(kept_bytes))
    seen.kept_bytes = KEPT_BYTES if kept_bytes is None else kept_bytes
    return seen


def encode_by_words(tokenizer, texts: pa.Array, kept_bytes: int | None = None) -> Iterator[np.ndarray]:
    """The ids of every text. For a tokenizer that drops white space and never joins across it.

    No word and no special token crosses a space or a line feed, so the words between
    them are encoded once each and their ids put together.
    """
    spaced = pc.replace_substring(texts, "\n", " ")
    codes, words, offsets = words_of(spaced)
    flat, starts, row = seen_words(tokenizer, kept_bytes).encode(tokenizer, words)
    return ragged_rows(flat, starts, row[codes], offsets)


def encode_by_spaced_words(tokenizer, texts: pa.Array) -> Iterator[np.ndarray]:
    """The ids of every text. For a byte-level tokenizer whose words carry the space before them.

    Texts are cut as ``spaced_pieces`` says, and each distinct piece is encoded once.
    """
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    codes, pieces, offsets = spaced_pieces(texts, special)
    flat, starts, row = seen_words(tokenizer).encode(tokenizer, pieces)
    return ragged_rows(flat, starts, row[codes], offsets)


def spaced_pieces(texts: pa.Array, special: Sequence[str] = ()) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Codes, distinct pieces and row offsets of texts cut before single spaces.

    A space between two characters other than white space always starts a new word. Where white
    space of any kind stands beside a space, both are one run, whose last character alone may go with the word after it, so a
    text with such a run is cut only at the spaces that have none beside them; and so is one that holds a
    ``special`` token, as a run may end at one.
    """
    careful = pc.match_substring_regex(texts, SPACE_IN_RUN)
    for token in special:
        careful = pc.or_(careful, pc.match_substring(texts, token))
    if pc.any(careful).as_py():
        rows = [LONE_SPACE.split(t) if c else t.split(" ")
                for t, c in zip(texts.to_pylist(), careful.to_pylist(), strict=True)]
        split = pa.array(rows, pa.list_(pa.large_string()))
    else:
        split = pc.split_pattern(texts, " ")
    offsets = np.asarray(split.offsets.to_numpy(zero_copy_only=False), np.int64)
    offsets = offsets - offsets[0]
    pieces = split.flatten()
    first = np.zeros(len(pieces), bool)
    first[offsets[:-1]] = True
    prefix = pc.if_else(pa.array(first), pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string()))
    spaced = pc.binary_join_element_wise(prefix, pieces, pa.scalar("", pa.large_string())).dictionary_encode()
    return np.asarray(spaced.indices), spaced.dictionary, offsets
