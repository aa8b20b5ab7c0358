"""Token ids of whole texts, with a cache of the words that come again.

Words that the cache lacks are encoded many at a time as one text: a vocabulary of this kind
cuts before a blank and around a line feed, so the ids of each word can be told apart again.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from orderloom.llm.words import rest as release

# Words held, some 40 bytes each, and bytes of text cut at once: workers live on after a task, so both stay small.
CACHED = 500_000
# Words encoded as one text.
JOINED = 200
TEXT_BYTES = 4 << 20
# Pieces put together at once: places in 64 bits for each of their ids are held only that long.
STEP = 1 << 15
# White space that is neither blank nor line feed; texts with it are not cut.
_OTHER_SPACE = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"
_WIDE_SPACE = "     　" + "".join(map(chr, range(0x2000, 0x200B)))
_loaded: dict[str, Encoder] = {}


def _taken(ids: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the pieces ``which``, in that order, and where those of each end."""
    lengths = sizes[which]
    starts, ends = np.cumsum(sizes) - sizes, np.cumsum(lengths)
    out = np.empty(ends[-1] if len(ends) else 0, ids.dtype)
    for at in range(0, len(which), STEP):
        some, last = lengths[at : at + STEP], ends[at : at + STEP]
        begin, end = last[0] - some[0], last[-1]
        shift = starts[which[at : at + STEP]] - last + some
        out[begin:end] = ids[np.arange(begin, end) + np.repeat(shift, some)]
    return out, ends


class _Cache:
    """Ids of distinct pieces, as 32-bit numbers: words with the blank or line feed before them."""

    def __init__(self):
        self.pieces, self.ids = pa.array([], pa.large_string()), np.zeros(0, np.uint32)
        self.sizes, self.uses = np.zeros(0, np.int32), np.zeros(0, np.int32)

    def add(self, pieces: pa.LargeStringArray, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.pieces = pa.concat_arrays([self.pieces, pieces])
        self.ids, self.sizes = np.concatenate([self.ids, ids]), np.concatenate([self.sizes, sizes.astype(np.int32)])
        self.uses = np.concatenate([self.uses, np.zeros(len(pieces), np.int32)])

    def shrink(self) -> None:
        """Keep what came in most batches, half of what may be held."""
        often = np.sort(np.argsort(-self.uses, kind="stable")[: CACHED // 2])
        self.ids, _ = _taken(self.ids, self.sizes, often)
        self.pieces, self.sizes, self.uses = self.pieces.take(pa.array(often)), self.sizes[often], self.uses[often]


class Encoder:
    """Encodes with a vocabulary file of the tokenizers library, without special tokens.

    A byte-level BPE splits texts before single blanks and around single line feeds. Texts
    are cut there, and the library encodes each piece that the cache does not hold. Texts
    with any other white space go to the library as they are.
    """

    def __init__(self, path: str):
        import tokenizers

        self.library = tokenizers.Tokenizer.from_file(path)
        self.cache = _Cache()
        self.feed = self._encode(["\n"])[0]
        self.feed_id = int(np.frombuffer(self.feed, np.uint32)[0])
        # Byte-level vocabularies write a blank as this letter.
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.blank = np.zeros(max(vocabulary.values()) + 1, bool)
        self.blank[[number for token, number in vocabulary.items() if token.startswith("\u0120")]] = True

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, np.uint32).tobytes() for x in found]

    def _alone(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``_many``, piece by piece."""
        found = self._encode([piece.removeprefix("\n") for piece in pieces])
        found = [self.feed + ids if piece[0] == "\n" else ids for piece, ids in zip(pieces, found)]
        return np.frombuffer(b"".join(found), np.uint32), np.array([len(ids) // 4 for ids in found], np.int64)

    def _many(self, pieces: pa.LargeStringArray, line_starts: bool) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all ``pieces`` in a row, and how many each has.

        A piece's first id is the only one that starts with a blank, or is a line feed's.
        """
        out: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.uint32), np.zeros(0, np.int64))]
        for at in range(0, len(pieces), JOINED):
            some = pieces[at : at + JOINED].to_pylist()
            found = self.library.encode_batch_fast(["".join(some)], add_special_tokens=False)[0]
            ids = np.array(found.ids, np.uint32)
            starts = np.flatnonzero(ids == self.feed_id if line_starts else self.blank[ids])
            if len(starts) == len(some):
                out.append((ids, np.diff(starts, append=len(ids))))
            else:  # never seen; such words are encoded one by one
                out.append(self._alone(some))
        return np.concatenate([ids for ids, _ in out]), np.concatenate([sizes for _, sizes in out])

    def _look_up(self, pieces: pa.LargeStringArray) -> np.ndarray:
        """Where each of the distinct ``pieces`` is in the cache; what was learned before may go if it is much."""
        cache = self.cache
        if len(cache.pieces) > CACHED:
            cache.shrink()
        places = pc.index_in(pieces, value_set=cache.pieces).fill_null(-1).to_numpy(zero_copy_only=False).copy()
        lacking = np.flatnonzero(places < 0)
        line_starts = pc.starts_with(pieces.take(pa.array(lacking)), "\n").to_numpy(zero_copy_only=False)
        for new, first in (lacking[line_starts], True), (lacking[~line_starts], False):
            places[new] = np.arange(len(cache.pieces), len(cache.pieces) + len(new))
            some = pieces.take(pa.array(new))
            cache.add(some, *self._many(some, first))
        cache.uses[places] += 1
        return places

    def _can_be_cut(self, text: str) -> bool:
        if not text or text[0] in " \n" or text[-1] in " \n" or "<|" in text:
            return False
        if "  " in text or " \n" in text or "\n " in text or "\n\n" in text:
            return False
        others = _OTHER_SPACE if text.isascii() else _OTHER_SPACE + _WIDE_SPACE
        return not any(c in text for c in others)

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers."""
        texts = list(texts)
        cut = [self._can_be_cut(t) for t in texts]
        whole = iter(self._encode([t for t, can in zip(texts, cut) if not can]))
        joined = iter(self._joined([t for t, can in zip(texts, cut) if can]))
        return [next(joined if can else whole) for can in cut]

    def _joined(self, texts: list[str]) -> list[bytes]:
        """Texts that can be cut, put together from their distinct pieces."""
        if not texts:
            return []
        # A line feed before every text: each piece then begins with its separator.
        encoded = [t.encode() for t in texts]
        data = np.frombuffer(b"\n" + b"\n".join(encoded), np.uint8)
        begins = np.append(np.flatnonzero((data == 32) | (data == 10)), len(data))
        words = pa.LargeStringArray.from_buffers(len(begins) - 1, pa.py_buffer(begins), pa.py_buffer(data)).dictionary_encode()
        # The number of each text's first piece; the bytes are then no longer held.
        firsts = np.searchsorted(begins, np.cumsum([0, *(len(e) + 1 for e in encoded)]))
        del encoded, data, begins
        which = self._look_up(words.dictionary)[words.indices.to_numpy()]
        del words
        found, ends = _taken(self.cache.ids, self.cache.sizes, which)
        edges = np.append(0, ends)[firsts].tolist()
        return [found[a + 1 : b].tobytes() for a, b in zip(edges, edges[1:])]


def encoder(path: str) -> Encoder:
    """One encoder per worker and file."""
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


def rest(path: str) -> None:
    """After a task: keep the vocabulary and what the cache may hold, as the worker may live on for other work."""
    if path in _loaded and len(_loaded[path].cache.pieces) > CACHED:
        _loaded[path].cache.shrink()
    release()


def byte_bpe_path() -> str:
    """The public vocabulary that the registered queries use; it lies on every worker."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
