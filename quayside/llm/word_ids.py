"""Ids of whole texts by a public word-level BPE file, with the ids of known words kept as arrays."""

from __future__ import annotations

import os
from unicodedata import normalize

import numpy as np

from quayside.llm.texts import word_places

#: Words whose ids a worker keeps; beyond it, it forgets them all and starts anew.
KEPT = 700_000
#: Words whose ids are put together at a time.
STEP = 1 << 18
#: Signs at the edges of a word that form runs of their own. An apostrophe does not, beside letters.
_SIGNS = ",.!?;:()[]\"%&*#$|-"
_encoders: dict[str, WordEncoder] = {}


class WordEncoder:
    """Little-endian unsigned 32-bit ids of texts, as ``tokenizers`` gives them without added tokens.

    Holds for files that lower-case, drop white space, keep letters and signs apart, and mark the end
    of a word. A text's ids are then those of its words, one after another, whatever the case of A-Z;
    words are known by 64-bit hashes. Texts in which an added token occurs go to the library whole.
    """

    kept = KEPT

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[k for token, k in vocabulary.items() if token.endswith("</w>")]] = True
        self.added = [token.content.lower().encode() for token in self.tokenizer.get_added_tokens_decoder().values()]
        self._forget()

    def _forget(self) -> None:
        self.keys = np.empty(0, np.uint64)
        #: Place and number of each known word's ids in the pool.
        self.first, self.count = np.empty(0, np.int64), np.empty(0, np.int32)
        self.pool, self.used = np.empty(1 << 16, np.uint32), 0

    def _places(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return word_places(data, offsets)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        hashes, starts, ends = self._places(data, offsets)
        unique, example, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) + len(unique) > self.kept:
            self._forget()
        at = np.searchsorted(self.keys, unique)
        new = np.ones(len(unique), bool)
        inside = at < len(self.keys)
        new[inside] = self.keys[at[inside]] != unique[inside]
        if new.any():
            example = example[new]
            spans = zip(starts[example].tolist(), ends[example].tolist(), strict=True)
            raw = data.tobytes()
            self._learn(unique[new], [raw[a:b].decode("utf-8", "replace") for a, b in spans])
            at = np.searchsorted(self.keys, unique)
        first, count = self.first[at], self.count[at]
        parts, totals = [], np.zeros(len(hashes) + 1, np.int64)
        np.cumsum(count[which], out=totals[1:])
        for begin in range(0, len(hashes), STEP):
            of = which[begin : begin + STEP]
            sizes = count[of]
            shift = first[of] - (totals[begin : begin + len(of)] - totals[begin])
            parts.append(self.pool[np.repeat(shift, sizes) + np.arange(sizes.sum())])
        ids = np.concatenate([np.empty(0, np.uint32), *parts]).astype("<u4").tobytes()
        bounds = (4 * totals[np.searchsorted(starts, offsets)]).tolist()
        found = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        lower = data.tobytes().lower()
        if any(token in lower for token in self.added):
            for k in range(len(found)):
                if any(token in lower[offsets[k] : offsets[k + 1]] for token in self.added):
                    text = data[offsets[k] : offsets[k + 1]].tobytes().decode("utf-8", "replace")
                    found[k] = self._whole(text)
        return found

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        found = self._ids(words)
        raw = np.frombuffer(b"".join(found), "<u4")
        while self.used + len(raw) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.empty_like(self.pool)])
        self.pool[self.used : self.used + len(raw)] = raw
        count = np.array([len(x) // 4 for x in found], np.int32)
        first = self.used + np.cumsum(count, dtype=np.int64) - count
        self.used += len(raw)
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.first, self.count = np.insert(self.first, at, first), np.insert(self.count, at, count)

    def _ids(self, words: list[str]) -> list[bytes]:
        """Ids of words; their letters are sent to the library together, and told apart by word ends."""
        known: dict[str, bytes] = {"": b""}
        parts: dict[str, tuple[str, str, str]] = {}
        letters, other = set(), set()
        for word in words:
            core = word.strip(_SIGNS)
            if core.isalpha() and (core.isascii() or normalize("NFC", core).lower().isalpha()):
                at = word.index(core)
                parts[word] = (word[:at], core, word[at + len(core) :])
                letters.add(core)
                other.update((parts[word][0], parts[word][2]))
            else:
                other.add(word)
        pure = list(letters)
        for begin in range(0, len(pure), 512):
            some = pure[begin : begin + 512]
            ids = np.array(self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids, "<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != len(some):  # letters to one library and not to the other
                other.update(some)
                continue
            raw, at = ids.tobytes(), 0
            for word, end in zip(some, (4 * ends).tolist(), strict=True):
                known[word] = raw[at:end]
                at = end
        rest = [word for word in other if word not in known]
        for begin in range(0, len(rest), 4096):
            some = rest[begin : begin + 4096]
            for word, ids in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False), strict=True):
                known[word] = np.array(ids.ids, "<u4").tobytes()
        return [b"".join(known[x] for x in parts.get(word, (word,))) for word in words]


def word_encoder(path: str) -> WordEncoder:
    """The encoder of a file, made once per worker."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]
