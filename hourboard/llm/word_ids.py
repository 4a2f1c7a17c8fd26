"""Ids of whole texts by a word-level BPE vocabulary, for tokenizers that never join across white space."""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Rows whose words are held at once.
SLICE_ROWS = 4096
#: Bytes of texts that are cut into words at once; a longer text is by itself.
BLOCK_BYTES = 4 << 20
#: Words whose ids a worker has at hand; beyond that it starts over, with those that it meets again out of the last ones.
MAX_WORDS = 250_000
#: Words given to the library, and words whose ids are put on end, at once.
WORDS_A_CALL = 5000
#: What often follows a word; such words share the ids of the word alone.
MARKS = (".", ",")


class Words:
    """The ids of distinct words, on end in one pool."""

    def __init__(self):
        self.places: dict[str, int] = {}
        self.pool = np.zeros(1 << 16, np.uint32)
        self.used = 0
        self.starts = np.zeros(1 << 14, np.int64)
        self.lengths = np.zeros(1 << 14, np.int64)
        self.keep([""], np.zeros(0, np.uint32), np.zeros(1, np.int64))

    def keep(self, words: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        place = len(self.places)
        self.pool = roomy(self.pool, self.used + len(ids))
        self.starts, self.lengths = roomy(self.starts, place + len(words)), roomy(self.lengths, place + len(words))
        self.pool[self.used : self.used + len(ids)] = ids
        self.starts[place : place + len(words)] = self.used + np.cumsum(counts) - counts
        self.lengths[place : place + len(words)] = counts
        self.places.update(zip(words, range(place, place + len(words)), strict=True))
        self.used += len(ids)

    def ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of ``words``, all of them kept, on end, and how many each has."""
        at = np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))
        return gathered(self.pool, self.starts, self.lengths, at)


class WordEncoder:
    """Encodes texts with the tokenizers library, and words that return with ids it remembers.

    The vocabulary's pre-tokenizer drops white space and its tokens end with ``</w>``, so the ids
    of a text are those of its words in turn. Words are cut at ASCII white space and A-Z are
    lowered first, which the normalizer does anyway; texts with combining marks, where the order
    of lowering and composing could matter, are given to the library whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks share the cores already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        vocabulary = self.tokenizer.get_vocab()
        self.size = max(vocabulary.values()) + 1
        self.ends = np.zeros(self.size, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.words, self.last = Words(), Words()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all ``texts`` on end, and how many each text has; null counts as empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        blocks = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)) // BLOCK_BYTES
        edges = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(texts)]
        ids, counts = zip(*(self._of_texts(texts[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)), strict=True)
        pa.default_memory_pool().release_unused()  # it keeps what it held at the most, for as long as the worker lives
        return np.concatenate(ids), np.concatenate(counts)

    def _of_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        marked = pc.match_substring_regex(texts, r"\p{M}").to_numpy(zero_copy_only=False)
        words = pc.ascii_split_whitespace(pc.ascii_lower(pc.if_else(pa.array(marked), "", texts)))
        flat = words.flatten().dictionary_encode()
        if isinstance(flat, pa.ChunkedArray):
            flat = flat.combine_chunks()
        ids, counts = self._of_words(flat)
        bounds = np.concatenate([[0], np.cumsum(counts)])
        edges = bounds[words.offsets.to_numpy() - words.offsets[0].as_py()]
        if not marked.any():
            return ids, np.diff(edges)
        parts = [
            np.array(self.tokenizer.encode(texts[i].as_py(), add_special_tokens=False).ids, np.uint32)
            if marked[i]
            else ids[edges[i] : edges[i + 1]]
            for i in range(len(texts))
        ]
        return np.concatenate(parts), np.array([len(x) for x in parts], np.int64)

    def _of_words(self, flat: pa.DictionaryArray) -> tuple[np.ndarray, np.ndarray]:
        stems = []  # each word without its mark, and the mark
        for word in flat.dictionary.to_pylist():
            if word[-1:] in MARKS and word[:-1].isalpha():
                stems += word[:-1], word[-1]
            else:
                stems += word, ""
        self._know({*stems, *MARKS})
        own, counts = self.words.ids(stems)
        counts = counts.reshape(-1, 2).sum(1)
        return gathered(own, np.cumsum(counts) - counts, counts, flat.indices.to_numpy())

    def _know(self, words: set[str]) -> None:
        """Has the ids of all ``words`` at hand."""
        new = [w for w in words if w not in self.words.places]
        if len(self.words.places) + len(new) > MAX_WORDS:
            self.last, self.words = self.words, Words()
            new = [w for w in words if w not in self.words.places]
        again = [w for w in new if w in self.last.places]
        self.words.keep(again, *self.last.ids(again))
        self._learn([w for w in new if w not in self.last.places])

    def _learn(self, words: list[str]) -> None:
        self._learn_whole([w for w in words if w.isalpha()])
        rest = [w for w in words if not w.isalpha()]
        for at in range(0, len(rest), WORDS_A_CALL):
            self.words.keep(rest[at : at + WORDS_A_CALL], *self._each(rest[at : at + WORDS_A_CALL]))

    def _each(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [x.ids for x in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        return np.array([i for x in found for i in x], np.uint32), np.array(list(map(len, found)), np.int64)

    def _learn_whole(self, words: list[str]) -> None:
        """Words of letters only are one pre-token each: the last id of each of these words is the one that ends with ``</w>``."""
        for at in range(0, len(words), WORDS_A_CALL):
            some = words[at : at + WORDS_A_CALL]
            ids = np.array(self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids, np.uint32)
            counts = np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)
            if len(counts) != len(some):  # some letter of Python's is none of the library's
                ids, counts = self._each(some)
            self.words.keep(some, ids, counts)


def gathered(pool: np.ndarray, starts: np.ndarray, counts: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches ``at`` of ``pool``, on end, and their lengths."""
    lengths = counts[at]
    found = np.empty(int(lengths.sum()), pool.dtype)
    filled = 0
    for some in range(0, len(at), WORDS_A_CALL):
        n = lengths[some : some + WORDS_A_CALL]
        ends = np.cumsum(n)
        total = int(ends[-1])
        found[filled : filled + total] = pool[np.repeat(starts[at[some : some + WORDS_A_CALL]] - ends + n, n) + np.arange(total)]
        filled += total
    return found, lengths


def roomy(values: np.ndarray, size: int) -> np.ndarray:
    """``values`` with room for ``size``, and some more."""
    return values if size <= len(values) else np.concatenate([values, np.zeros(size, values.dtype)[: size + size // 2 - len(values)]])


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The encoder of this worker for the vocabulary at ``path``."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def slices(batches):
    """Record batches of at most SLICE_ROWS rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)


def with_end(ids: np.ndarray, counts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """``ids`` and ``counts`` with ``end`` after each text."""
    return np.insert(ids, np.cumsum(counts), end), counts + 1
