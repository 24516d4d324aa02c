"""Token ids by the tokenizers library, each distinct piece of text encoded once per worker.

Both vocabularies split a text into words before merging, so the ids of a text are those of its words in a row.  A batch of texts
is cut into pieces of whole words by Arrow's kernels, its distinct pieces are looked up in a cache of pieces and their ids, pieces
not met before go to the library, and numpy gathers the ids of the batch.  Pieces begin at spaces and, where the marks around them
cannot join with their neighbours, at commas, full stops and line ends.  A text that cannot be cut so goes to the library whole.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from .shared import keep_only, worker_cache

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# Fixed value: the byte-level vocabulary's word pattern.
BYTE_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Stands before a piece that has no space before it.
GLUE = "\x1d"
_SPACE = r"[\x09-\x0d\x1c-\x20\x{85}\p{Z}]"
#: Characters that are white space to some definitions only, the glue among them.
_ODD_SEPARATOR = r"[\x1c-\x1f\x{85}]"
#: A space within or at the end of a run of white space does not begin a word.
_ODD_SPACE = rf"{_SPACE} (?:{_SPACE}|\z)|\A (?:{_SPACE}|\z)"
#: Marks that do not follow a letter or digit, and line ends beside white space, may belong to the word before or after.
_ODD_MARK = rf"[^\p{{L}}\p{{N}}][,.]|{_SPACE}\n|\n{_SPACE}"
_ODD_LOWER_MARK = r"[^\p{L}\p{N}\sİ][,.]|İ[,.]"
#: Latin letters: words to every Unicode version, composed, and lower-cased one by one (U+0130 is not).
_LETTERS = r"[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{12f}\x{131}-\x{24f}]+\z"
_WORKER: dict[tuple[str, bool, bool], "WordEncoder"] = worker_cache()


def _byte_alphabet() -> dict[int, int]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for code points from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return {b: 256 + i for i, b in enumerate(others)}


_ALPHABET = _byte_alphabet()


def gather(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """flat[starts[i] : starts[i] + counts[i]] for every i, in a row."""
    ends = np.cumsum(counts)
    kind = np.int32 if max(len(flat), ends[-1] if len(ends) else 0) < 1 << 31 else np.int64
    at = np.repeat((starts - (ends - counts)).astype(kind), counts)
    at += np.arange(len(at), dtype=kind)
    return flat[at]


class WordEncoder:
    """Encodes batches of texts.

    keeps_space: a word's token carries the space before it (byte-level vocabularies); else text is lower-cased and white space dropped.
    special_as_text: special tokens' strings in a text are ordinary text; else, as is the library's way, they give their ids.
    The cache holds at most max_words pieces, or those of one batch.
    """

    def __init__(self, path: str, keeps_space: bool, special_as_text: bool = False, max_words: int = 500_000):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = special_as_text
        self.merge = self.tok.model.tokenize
        special = [] if special_as_text else [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.whole = "|".join([_ODD_SEPARATOR, *map(re.escape, special)])
        self.keeps_space, self.max_words = keeps_space, max_words
        self.known = pa.array([], pa.string())
        self.starts, self.counts, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def encode(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, each with the end id if there is one, and how many each text has.  Null is an empty text."""
        texts = pc.fill_null(texts, "")
        whole = pc.match_substring_regex(texts, self.whole)
        odd = pc.match_substring_regex(texts, _ODD_MARK if self.keeps_space else _ODD_LOWER_MARK)
        spaces = pc.match_substring_regex(texts, _ODD_SPACE) if self.keeps_space else pa.array([False]).take(pa.array(np.zeros(len(texts), np.int64)))
        kind = np.where(whole, 3, np.where(spaces, 2, np.where(odd, 1, 0)))
        ids, sizes, place = [], [], []
        for k, way in enumerate((self._marked, self._spaced, self._matched, self._library)):
            rows = np.flatnonzero(kind == k)
            if len(rows):
                found = way(texts if len(rows) == len(texts) else texts.take(pa.array(rows)))
                ids.append(found[0])
                sizes.append(found[1])
                place.append(rows)
        if not place:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        flat, size = (ids[0], sizes[0]) if len(ids) == 1 else (np.concatenate(ids), np.concatenate(sizes))
        if len(ids) > 1:
            order = np.argsort(np.concatenate(place))
            flat, size = gather(flat, (np.cumsum(size) - size)[order], size[order]), size[order]
        if end_id is not None:
            flat, size = np.insert(flat, np.cumsum(size), np.uint32(end_id)), size + 1
        return flat, size

    def _marked(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Pieces begin at spaces and marks."""
        for mark in (",", "."):
            texts = pc.replace_substring(texts, mark, f" {GLUE}{mark}" if self.keeps_space else f" {mark}")
        if self.keeps_space:
            texts = pc.replace_substring(texts, "\n", f" {GLUE}\n {GLUE}")
        return self._spaced(texts)

    def _spaced(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Pieces begin at spaces."""
        if self.keeps_space:
            texts = pc.binary_join_element_wise(GLUE, texts, "")
        return self._pieces(pc.split_pattern(texts, " "))

    def _matched(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Pieces are the word pattern's matches."""
        return self._pieces(pa.array([[w[1:] if w[0] == " " else GLUE + w for w in BYTE_WORDS.findall(t)] for t in texts.to_pylist()], pa.list_(pa.string())))

    def _library(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return self._singly([GLUE + t for t in texts.to_pylist()])

    def _pieces(self, lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of lists of pieces."""
        coded = pc.dictionary_encode(lists.flatten())
        at = self._lookup(coded.dictionary)[coded.indices.to_numpy()] if len(coded) else np.zeros(0, np.int64)
        counts = self.counts[at]
        sums = np.concatenate(([0], np.cumsum(counts)))
        ends = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))
        return gather(self.flat, self.starts[at], counts), np.diff(sums[ends])

    def _lookup(self, pieces: pa.Array) -> np.ndarray:
        """Places of distinct pieces in the cache, which takes in the new ones and, if it is full, lets go of those not among them."""
        at = pc.index_in(pieces, value_set=self.known).fill_null(-1).to_numpy().astype(np.int64)
        new = np.flatnonzero(at < 0)
        if len(new):
            if len(self.known) + len(new) > self.max_words:
                kept = np.flatnonzero(at >= 0)
                counts = self.counts[at[kept]]
                self.flat, self.counts, self.starts = gather(self.flat, self.starts[at[kept]], counts), counts, np.cumsum(counts) - counts
                self.known, at[kept] = pieces.take(pa.array(kept)), np.arange(len(kept))
            missing = pieces.take(pa.array(new))
            ids, counts = self._ids_of(missing)
            at[new] = len(self.known) + np.arange(len(new))
            self.starts = np.concatenate((self.starts, len(self.flat) + np.cumsum(counts) - counts))
            self.counts = np.concatenate((self.counts, counts))
            self.flat = np.concatenate((self.flat, ids))
            self.known = pa.concat_arrays([self.known, missing])
        return at

    def _ids_of(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces in a row and how many each has.  A word of plain letters goes to the library's merging at once, others through its splitting."""
        words = pc.match_substring_regex(pieces, rf"\A{GLUE}?" + _LETTERS).to_numpy(zero_copy_only=False)
        found = [(np.flatnonzero(m), *way(pieces.filter(pa.array(m)).to_pylist())) for m, way in ((words, self._words), (~words, self._singly))]
        place, ids, counts = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(place)
        return gather(ids, (np.cumsum(counts) - counts)[order], counts[order]), counts[order]

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        merge, space, ids, counts = self.merge, chr(_ALPHABET[0x20]) if self.keeps_space else "", [], []
        for w in words:
            first, w = ("", w[1:]) if w[0] == GLUE else (space, w)
            if not self.keeps_space:
                w = w.lower()
            if not w.isascii():
                w = w.encode().decode("latin-1").translate(_ALPHABET)
            found = merge(first + w)
            ids += [t.id for t in found]
            counts.append(len(found))
        return np.array(ids, np.uint32), np.array(counts, np.int64)

    def _singly(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        texts = [p[1:] if p[:1] == GLUE else " " + p if self.keeps_space else p for p in pieces]
        found = [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
        return np.array([i for ids in found for i in ids], np.uint32), np.array([len(ids) for ids in found], np.int64)


def encoder(path: str, keeps_space: bool, special_as_text: bool = False) -> WordEncoder:
    """One per worker process, kept between tasks."""
    keep_only(_WORKER)
    key = (path, keeps_space, special_as_text)
    if key not in _WORKER:
        _WORKER[key] = WordEncoder(path, keeps_space, special_as_text)
    return _WORKER[key]
