"""Batch encoding with a byte-level BPE file of the ``tokenizers`` library.

Byte-level pre-tokenisation starts a new piece at every space or line break that follows
a non-space character, and at a comma or full stop that follows a letter.  A text is the
concatenation of such pieces and each can be encoded alone.  A batch of texts is therefore
encoded by its *distinct* pieces (each once) and the ids are gathered back with numpy;
natural text repeats its pieces, which makes this several times cheaper than encoding
every text.  Texts in which a space or line break follows white space
or that hold the string of a special token are encoded whole.
"""

from __future__ import annotations

import ctypes
import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# a separator after white space, or the mark that stands for a line break below
_WHOLE = "[\\s\\x{0b}\\x{1c}-\\x{1f}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}][ \n]|\\x{02}"
_MARK = "\x02"                      # leads pieces that begin with a line break
_ALONE = "[\\s\\x{0b}\\x{1c}-\\x{1f}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]$|^$|<\\|"
_GROUP = 50                        # distinct pieces encoded as one string
_KEEP = 1_000_000                  # pieces remembered between batches


def default_tokenizer() -> str:
    """Path of the public byte-level BPE file (a parameter everywhere)."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def ragged(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Positions begin[i] .. begin[i] + size[i] - 1 for every i, one after another."""
    ends = np.cumsum(size, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    most = max(total, int(begin.max()) if len(begin) else 0)
    kind = np.int32 if most < 1 << 30 else np.int64
    return np.arange(total, dtype=kind) + np.repeat((begin - (ends - size)).astype(kind), size)


class BatchEncoder:
    """Encodes batches of texts; ids equal ``Tokenizer.encode(text, add_special_tokens=False)``.
    A text that holds the string of a special token is encoded whole."""

    _open: dict[str, BatchEncoder] = {}

    @classmethod
    def of(cls, path: str) -> BatchEncoder:
        """One encoder per Python worker and file."""
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tk = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tk.get_added_tokens_decoder().values()]
        vocab = self.tk.get_vocab(with_added_tokens=True)
        self.dtype = np.dtype("<u2") if max(vocab.values()) < 65536 else np.dtype("<u4")
        self.lead = {" ": np.zeros(max(vocab.values()) + 1, bool), "\n": np.zeros(max(vocab.values()) + 1, bool)}
        for token, i in vocab.items():
            self.lead[" "][i] = token.startswith("Ġ")
            self.lead["\n"][i] = token.startswith("Ċ")
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.store = np.empty(0, self.dtype)
        self.begin, self.size = np.empty(0, np.int64), np.empty(0, np.int64)

    def _each(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.dtype)
                for k in range(0, len(texts), 64)
                for e in self.tk.encode_batch_fast(texts[k:k + 64], add_special_tokens=False)]

    def _learn(self, pieces: list[str]) -> None:
        """Encodes pieces that aren't known yet."""
        parts, sizes, order = [self.store], [self.size], []
        alone = pc.match_substring_regex(pa.array(pieces, pa.large_string()), _ALONE)
        alone = [pieces[i] for i in np.flatnonzero(alone.to_numpy(zero_copy_only=False))]
        skip = set(alone)
        for lead in (" ", "\n"):
            of = [p for p in pieces if p not in skip and (p[0] == _MARK) == (lead == "\n")]
            groups = [of[k:k + _GROUP] for k in range(0, len(of), _GROUP)]
            cut = 1 if lead == "\n" else 0
            for g, ids in zip(groups, self._each([lead + lead.join([p[cut:] for p in g]) for g in groups])):
                at = np.flatnonzero(self.lead[lead][ids])
                if len(at) != len(g):                               # never seen; stay exact
                    alone.extend(g)
                    continue
                order.extend(g)
                parts.append(ids)
                sizes.append(np.diff(np.append(at, len(ids))))
        for p, ids in zip(alone, self._each(["\n" + p[1:] if p[:1] == _MARK else " " + p for p in alone])):
            order.append(p)
            parts.append(ids)
            sizes.append(np.array([len(ids)]))
        self.known.update(zip(order, range(len(self.known), len(self.known) + len(order))))
        self.store, self.size = np.concatenate(parts), np.concatenate(sizes)
        self.begin = np.cumsum(self.size) - self.size

    def _lookup(self, pieces: list[str]) -> np.ndarray:
        if len(self.known) > _KEEP:
            self._forget()
        self._learn([p for p in pieces if p not in self.known])
        return np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, offsets): text i has ids[offsets[i]:offsets[i + 1]].  Null texts are empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        n = len(texts)
        if n == 0:
            return np.empty(0, self.dtype), np.zeros(1, np.int64)
        whole = pc.match_substring_regex(texts, _WHOLE)
        for token in self.added:
            whole = pc.or_(whole, pc.match_substring(texts, token))
        whole = whole.to_numpy(zero_copy_only=False)
        cut = pc.replace_substring(pc.if_else(pa.array(whole), "", texts), "\n", " " + _MARK)
        parts = pc.split_pattern(cut, " ")
        bounds = parts.offsets.to_numpy().astype(np.int64)
        bounds -= bounds[0]
        flat = parts.flatten()
        first = np.zeros(len(flat), bool)                           # pieces that nothing leads
        first[bounds[:-1]] = True
        coded = flat.filter(pa.array(~first)).dictionary_encode()
        # distinct pieces without the comma or full stop that ends a word
        stop = pc.match_substring_regex(coded.dictionary, "\\p{L}[,.]$").to_numpy(zero_copy_only=False)
        dot = pc.ends_with(coded.dictionary, ".").to_numpy(zero_copy_only=False)
        stems = pc.if_else(pa.array(stop), pc.utf8_slice_codeunits(coded.dictionary, 0, -1),
                           coded.dictionary).dictionary_encode()
        known = self._lookup(stems.dictionary.to_numpy(zero_copy_only=False).tolist())[stems.indices.to_numpy()]

        heads = flat.filter(pa.array(first)).to_numpy(zero_copy_only=False).tolist()
        for i, t in zip(np.flatnonzero(whole), texts.filter(pa.array(whole)).to_pylist()):
            heads[i] = t
        tails = self._each([",", "."]) + self._each(heads)
        store = np.concatenate([self.store, *tails])
        tail_size = np.fromiter(map(len, tails), np.int64, len(tails))
        begin = np.concatenate([self.begin, len(self.store) + np.cumsum(tail_size) - tail_size])
        size = np.concatenate([self.size, tail_size])
        k = len(self.size)                                          # "," is k, "." is k + 1, then the heads

        # every distinct piece is a stem and perhaps a stop: its ids are put together once
        table = np.full((len(known) + n, 2), -1, np.int64)
        table[:len(known), 0] = known
        table[:len(known), 1] = np.where(stop, np.where(dot, k + 1, k), -1)
        table[len(known):, 0] = k + 2 + np.arange(n)
        own_size = size[table[:, 0]] + np.where(table[:, 1] >= 0, size[table[:, 1]], 0)
        own_begin = np.cumsum(own_size) - own_size
        seq = table.reshape(-1)
        seq = seq[seq >= 0]
        own = store[ragged(begin[seq], size[seq])]
        # and gathered for the pieces in the texts
        row = np.empty(len(flat), np.int32)
        row[~first] = coded.indices.to_numpy()
        row[first] = len(known) + np.arange(n)
        per_piece = own_size[row]
        offsets = np.concatenate([[0], np.cumsum(per_piece)])[bounds]
        return own[ragged(own_begin[row], per_piece)], offsets


def text_batches(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Merges or cuts record batches so that each holds about ``max_bytes`` of text (one row at least)."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths)
        at = 0
        while at < batch.num_rows:
            done = int(ends[at - 1]) if at else 0
            upto = max(int(np.searchsorted(ends, done + max_bytes - size, side="right")), at + (not held))
            if upto > at:
                held.append(batch.slice(at, upto - at))
                size += int(ends[upto - 1]) - done
            if upto < batch.num_rows:
                yield merged(held)
                held, size = [], 0
            at = upto
    if held:
        yield merged(held)
    # worker processes serve other tasks and stages next: freed pages go back to the machine
    held = []
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):                               # not the GNU C library
        pass


def merged(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(batches) == 1:
        return batches[0]
    t = pa.Table.from_batches(batches).combine_chunks()
    return t.to_batches()[0] if t.num_rows else batches[0]
