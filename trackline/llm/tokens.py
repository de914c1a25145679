"""Batch encoding with the ``tokenizers`` library, with each distinct chunk of text encoded once.

A text is cut at single spaces that stand between two other characters.  The
pre-tokenizers of the two vocabularies always break there, so the ids of a text
are the ids of its chunks in order (tested against whole-text encoding).
Distinct chunks go through the library; repeats are gathered with numpy.
"""

from __future__ import annotations

import json
import re
from array import array
from operator import attrgetter
from struct import Struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_LETTERS, _MARKS = "A-Za-zÀ-ÖØ-öø-ÿ", ".,;:!?%$&*#|)"
#: Latin letters, then perhaps ASCII marks other than the apostrophe: one or two
#: pre-tokens in either vocabulary, so the model can be asked directly.
_PLAIN = f"^ ?[{_LETTERS}]+[{_MARKS}]*$"
#: Two plain chunks with one line break between them.
_LINES = re.compile(f"( ?[{_LETTERS}]+)([{_MARKS}]*)\n([{_LETTERS}]+)([{_MARKS}]*)")
#: Empty, or white space (as ``str.isspace`` has it) at either end.
_SPACES = r"[\s\x0b\x1c-\x1f\x{85}\pZ]"
_ID, _ID_OF = Struct("=I"), attrgetter("id")
_EDGE_SPACE = f"^{_SPACES}|{_SPACES}$|^$"
#: Memory bound of the cache of a worker (entries; about 150 bytes each).
CACHE_ENTRIES = 300_000


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in a byte-level vocabulary."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in kept}
    for b in range(256):
        if b not in table:
            table[b] = chr(256 + len(table) - len(kept))
    return table


def _listed(strings: pa.Array) -> list[str]:
    """Strings as a list, by way of numpy, which is several times as fast as ``to_pylist``."""
    return strings.to_numpy(zero_copy_only=False).tolist()


class BatchEncoder:
    """Encodes lists of texts with one tokenizer file; ids come as flat arrays.

    Strings of special tokens inside a text are ordinary text.
    """

    def __init__(self, path: str, cache_entries: int = CACHE_ENTRIES):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path) as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"]
        self.spaces_kept = pre["type"] == "ByteLevel"  # else white space is dropped
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.cache: dict[str, bytes] = {}
        self.cache_entries = cache_entries

    def _words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of pre-tokens, from the cache or the library's model."""
        cache = self.cache
        if len(cache) > self.cache_entries:
            cache.clear()
        new = list(dict.fromkeys([w for w in words if w not in cache]))
        if new:
            shown = "\n".join(new if self.spaces_kept else [w.lower() for w in new])
            mapped = shown.encode().decode("latin-1").translate(self.letters).split(self.letters[10])
            ask = self.model.tokenize
            cache.update(zip(new, [_ID.pack(found[0].id) if len(found := ask(w)) == 1 else array("I", list(map(_ID_OF, found))).tobytes() for w in mapped]))
        return cache

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of each chunk, as packed unsigned 32-bit integers."""
        given = pa.array(chunks, pa.large_string())
        plain = pc.match_substring_regex(given, _PLAIN).to_numpy(zero_copy_only=False)
        heads = pc.utf8_rtrim(given, _MARKS)
        bare = plain & pc.equal(given, heads).to_numpy(zero_copy_only=False)
        bare_at, marked_at = np.flatnonzero(bare).tolist(), np.flatnonzero(plain & ~bare)
        bare_words = [chunks[i] for i in bare_at]
        marked = _listed(heads.take(pa.array(marked_at)))
        marked_at = marked_at.tolist()
        marks = [chunks[i][len(h):] for i, h in zip(marked_at, marked)]
        parts: dict[int, tuple[str, ...]] = {}
        hard = []
        for i in np.flatnonzero(~plain).tolist():
            m = _LINES.fullmatch(chunks[i])
            if m is None:
                hard.append(i)
            else:
                a, b, c, d = m.groups()
                parts[i] = tuple(x for x in (a, b, "\n" if self.spaces_kept else "", c, d) if x)
        wanted = set(marked)
        own = {"\n": array("I", [t.id for t in self.model.tokenize(self.letters[10])]).tobytes(), "": b""}
        for m in {x for p in parts.values() for x in p} | set(marks):
            if m.strip(_MARKS):
                wanted.add(m)
            elif m not in own:
                own[m] = array("I", [t.id for t in self.model.tokenize(m)]).tobytes()
        have = self._words(bare_words + list(wanted - own.keys()))
        out = [b""] * len(chunks)
        for i, ids in zip(bare_at, map(have.__getitem__, bare_words)):
            out[i] = ids
        for i, h, m in zip(marked_at, marked, marks):
            out[i] = have[h] + own[m]
        for i, p in parts.items():
            out[i] = b"".join([own[x] if x in own else have[x] for x in p])
        for i, e in zip(hard, self.tokenizer.encode_batch_fast([chunks[i] for i in hard], add_special_tokens=False)):
            out[i] = array("I", e.ids).tobytes()
        return out

    def encode(self, texts: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, offsets)``: ids of all texts with ``end_id`` after each; text i is ids[offsets[i]:offsets[i+1]]."""
        n = len(texts)
        if not n:
            return np.empty(0, np.uint32), np.zeros(1, np.int64)
        lists = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        bounds = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.values.dictionary_encode()
        words = _listed(coded.dictionary)
        codes = coded.indices.to_numpy()
        # every text's first chunk has no space before it: such chunks get codes of their own
        if self.spaces_kept:
            odd = pc.match_substring_regex(coded.dictionary, _EDGE_SPACE).to_numpy(zero_copy_only=False)
            whole = np.logical_or.reduceat(odd[codes], bounds[:-1])
            firsts, code_of_first = np.unique(codes[bounds[:-1]], return_inverse=True)
            chunks = [" " + w for w in words] + [words[i] for i in firsts]
            codes = codes.copy()
            codes[bounds[:-1]] = len(words) + code_of_first
            used = np.zeros(len(chunks), bool)
            used[codes] = True
            for i in np.flatnonzero(~used).tolist():
                chunks[i] = ""
        else:
            whole = np.zeros(n, bool)
            chunks = words
        base = len(chunks)
        if whole.any():  # white space next to a cut: the whole text goes to the library
            where = np.flatnonzero(whole)
            drop = np.repeat(whole, np.diff(bounds))
            keep_counts = np.where(whole, 1, np.diff(bounds))
            starts = np.concatenate([[0], np.cumsum(keep_counts)])
            merged = np.empty(starts[-1], codes.dtype)
            merged[np.repeat(~whole, keep_counts)] = codes[~drop]
            merged[starts[:-1][whole]] = base + np.arange(len(where))
            codes, bounds = merged, starts
        else:
            where = np.empty(0, np.int64)
        packed = self._chunks(chunks)
        if len(where):
            packed += [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(
                [texts[i] for i in where], add_special_tokens=False)]
        packed.append(array("I", [end_id]).tobytes())
        pool = np.frombuffer(b"".join(packed), np.uint32)
        lens = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        at = np.cumsum(lens) - lens
        codes = np.insert(codes, bounds[1:], len(packed) - 1)
        bounds = bounds + np.arange(n + 1)
        took = lens[codes]
        out_at = np.cumsum(took) - took
        total = int(took.sum())
        place = np.int32 if max(total, len(pool)) < 2 ** 31 else np.int64
        ids = pool[np.repeat((at[codes] - out_at).astype(place), took) + np.arange(total, dtype=place)]
        offsets = np.concatenate([out_at, [len(ids)]])[bounds]
        return ids, offsets


_ENCODERS: dict[str, BatchEncoder] = {}


def encoder(path: str) -> BatchEncoder:
    """The encoder of a file, kept for the life of a Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = BatchEncoder(path)
    return _ENCODERS[path]
