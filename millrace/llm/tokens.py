"""Token ids of whole texts, and the words that they make up."""

from __future__ import annotations

import json
import os
import re
from functools import cached_property
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import mix

#: Pieces whose characters map one to one under the tokenizer's normaliser and aren't part of a special token's name.
_PLAIN = re.compile(r"[\x21-\x3b\x3d-\x7eÀ-ÿ]+")
_ALL_PLAIN = re.compile(r"[\n\x21-\x3b\x3d-\x7eÀ-ÿ]*")
#: The tokenizer's own cut of lower-cased plain pieces, a fixed pattern, with the line feed that ends a piece.
_CUT = re.compile(r"(?:'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+)\n?|\n")


def _fast_bpe(model: dict):
    """The same merges in a faster encoder of words that end with \\x01, and the id of each of its ranks; None unless byte-level BPE with word ends.

    It merges what forms a known token where the tokenizer asks for the listed
    pair, which comes to the same where every token has one pair of its own; tests compare both on many words.
    """
    if model["type"] != "BPE" or model.get("end_of_word_suffix") != "</w>" or model.get("continuing_subword_prefix"):
        return None
    import tiktoken

    # the byte-level alphabet: printable Latin-1 stands for itself, other bytes follow from U+0100 in order
    own = {b: chr(b) for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174}
    own |= {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in own)}
    byte = {c: b for b, c in own.items()}

    def of(name: str) -> bytes:
        return bytes(byte[c] for c in name.removesuffix("</w>")) + b"\x01" * name.endswith("</w>")

    names = [*own.values(), *(own[b] + "</w>" for b in range(256) if b != 1)]
    names += ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    ranks = {of(name): k for k, name in enumerate(names)}
    if len(ranks) < len(names):
        return None
    return tiktoken.Encoding("own", pat_str=r"[^\x01]+\x01", mergeable_ranks=ranks, special_tokens={}), np.array([model["vocab"].get(n, 0) for n in names])


def spread(begin: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Positions begin, begin + 1, ... of each run, run after run."""
    return np.repeat(begin - (np.cumsum(long) - long), long) + np.arange(int(long.sum()))


def binary_of(ids: np.ndarray, long: np.ndarray) -> pa.Array:
    """Runs of ids as an array of bytes."""
    edge = np.append(0, np.cumsum(long)) * ids.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(long), [None, pa.py_buffer(edge.astype(np.int64).tobytes()), pa.py_buffer(ids.tobytes())])


class WordTokenizer:
    """Token ids of whole texts by way of a bounded table of ids by word.

    For tokenizers that split at white space and drop it, whose normaliser
    doesn't look across it.  Each distinct piece of a batch is cut into words
    once, each word is encoded once while the table holds it, and ids are put
    together from the table in one gather.  Pieces with characters beyond
    Latin-1 are words of their own.  A full table starts anew.
    """

    def __init__(self, path: str, table_size: int = 300_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # each task has its core
        with open(path, encoding="utf-8") as f:
            whole = json.load(f)
        names = whole["model"]["vocab"]
        names = names if isinstance(names, dict) else {name: i for i, (name, _) in enumerate(names)}
        names |= {t["content"]: t["id"] for t in whole.get("added_tokens") or ()}
        most = max(names.values(), default=0)
        self.path, self.table_size, self.dtype = path, table_size, np.dtype("<u2" if most < 1 << 16 else "<u4")
        self.fast = _fast_bpe(whole["model"])
        self.final = np.zeros(most + 1, dtype=bool)
        self.final[[i for name, i in names.items() if name.endswith("</w>")]] = True
        if not self.final.any():  # no mark of word ends: every id is a word
            self.final[:] = True
        self._start()

    def forget(self) -> None:
        """Drops the words met so far, whose room a task that encodes nothing has a use for."""
        self._start()

    @cached_property
    def tokenizer(self):
        """The library's tokenizer, loaded when a word needs it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _start(self) -> None:
        self.place, self.begin, self.long, self.ends = {"\n": 0}, np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64), np.ones(1 << 12, bool)
        self.store, self.stored = np.zeros(1 << 14, self.dtype), 0

    def _ids(self, words: list[str], plain: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words and the number of each word's."""
        if not plain:
            found = [e.ids for e in self.tokenizer.encode_batch(words, add_special_tokens=False)]
            return np.array(sum(found, []), self.dtype), np.array([len(x) for x in found], np.int64)
        if self.fast:
            encoder, id_of = self.fast
            ids = id_of[encoder.encode_ordinary("\x01".join(words) + "\x01")]
            return ids.astype(self.dtype), np.diff(np.flatnonzero(self.final[ids]) + 1, prepend=0)
        e = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
        return np.array(e.ids, self.dtype), np.bincount(np.array(e.word_ids, np.int64), minlength=len(words))

    def _learn(self, words: list[str], plain: bool) -> None:
        new, long = self._ids("\n".join(words).replace("\n\n", "\n").removesuffix("\n").split("\n") if plain else words, plain)
        n, m = len(self.place), len(self.place) + len(words)
        while self.stored + len(new) > len(self.store):
            self.store = np.append(self.store, np.zeros_like(self.store))
        while m > len(self.long):
            self.begin, self.long, self.ends = (np.append(x, np.zeros_like(x)) for x in (self.begin, self.long, self.ends))
        self.store[self.stored : self.stored + len(new)] = new
        self.long[n:m] = long
        self.begin[n:m] = self.stored + np.cumsum(long) - long
        self.ends[n:m] = [w[-1] == "\n" for w in words] if plain else True
        self.stored += len(new)
        self.place.update(zip(words, range(n, m)))

    def _places(self, words: list[str], plain: bool = True) -> np.ndarray:
        out = np.fromiter(map(self.place.get, words, repeat(-1)), np.int64, len(words))
        if (missing := out < 0).any():
            missed = list(compress(words, missing.tolist()))
            self._learn(list(dict.fromkeys(missed)), plain)
            out[missing] = np.fromiter(map(self.place.__getitem__, missed), np.int64, len(missed))
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and each text's number of ids."""
        if len(self.place) > self.table_size:
            self._start()
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        n = len(coded.dictionary)
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), coded.dictionary.cast(pa.string())), "\n")[0].as_py() + "\n" * (n > 0)
        odd: list[tuple[int, str]] = []
        if not _ALL_PLAIN.fullmatch(joined):
            pieces = joined[:-1].split("\n")
            plain = [p if p == "" or _PLAIN.fullmatch(p) else "" for p in pieces]
            odd = [(i, p) for i, (p, q) in enumerate(zip(pieces, plain)) if p != q]
            joined = "\n".join(plain) + "\n"
        place = self._places(_CUT.findall(joined.lower()))
        ends = self.ends[place]
        of_piece = np.cumsum(ends) - ends
        if odd:  # they have no plain words
            place = np.append(place, self._places([p for _, p in odd], plain=False))
            of_piece = np.append(of_piece, [i for i, _ in odd])
            order = np.argsort(of_piece, kind="stable")
            place, of_piece = place[order], of_piece[order]
        long = self.long[place]
        ids_of_pieces = binary_of(self.store[spread(self.begin[place], long)], np.bincount(of_piece, long, n).astype(np.int64))
        taken = ids_of_pieces.take(coded.indices)
        edge = np.frombuffer(taken.buffers()[1], np.int64, len(taken) + 1) // self.dtype.itemsize
        ids = np.frombuffer(taken.buffers()[2] or b"", self.dtype, int(edge[-1]))
        return ids, np.diff(edge[np.append(0, np.cumsum(split.value_lengths().to_numpy().astype(np.int64)))])


_tokenizers: dict[str, WordTokenizer] = {}


def tokenizer_at(path: str) -> WordTokenizer:
    """One tokenizer for each worker process, so its table serves all of its tasks."""
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


_POW = mix(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)


def word_terms(ids: np.ndarray, long: np.ndarray, final: np.ndarray, step: int = 1 << 19) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of documents given as token ids, and each document's number of words."""
    edge = np.append(0, np.cumsum(long))
    end = final[ids]
    end[edge[1:][long > 0] - 1] = True  # no word goes on in the next document
    stop = np.flatnonzero(end)
    out = np.empty(len(stop), dtype=np.uint64)
    done = 0
    while done < len(stop):  # a part at a time, which stays in the processor's cache
        first = int(stop[done - 1]) + 1 if done else 0
        to = max(done + 1, int(np.searchsorted(stop, first + step)))
        part, last = ids[first : int(stop[to - 1]) + 1], stop[done:to] - first
        start = np.append(0, last[:-1] + 1)
        at = np.arange(len(part)) - np.repeat(start, last + 1 - start)
        out[done:to] = mix(np.add.reduceat(mix(part.astype(np.uint64) + np.uint64(1)) * _POW[np.minimum(at, 255)], start))
        done = to
    return out, np.diff(np.searchsorted(stop, edge))
