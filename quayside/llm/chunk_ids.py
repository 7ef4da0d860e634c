"""Ids of whole texts by a public byte-level BPE file, with the ids of known chunks kept as arrays."""

from __future__ import annotations

import numpy as np

from quayside.llm.texts import CASED, span_hashes
from quayside.llm.word_ids import WordEncoder

#: Chunks that go to the library as one text.
TOGETHER = 512
_encoders: dict[str, ChunkEncoder] = {}


class ChunkEncoder(WordEncoder):
    """As ``WordEncoder``, for byte-level files whose pieces never reach from a sign or letter into white space.

    A chunk begins at a blank or line feed behind a printable ASCII sign or a two-byte letter, so it holds
    the white space before a word and the word. Its ids are the same wherever it stands.
    """

    #: Chunks keep their case and the signs beside words, so there are more of them.
    kept = 2_000_000

    def __init__(self, path: str):
        super().__init__(path)
        #: Ids that begin with a blank.
        self.opens = np.zeros(len(self.ends), bool)
        self.opens[[k for token, k in self.tokenizer.get_vocab().items() if token.startswith("Ġ")]] = True

    def _places(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        opens = np.zeros(len(data) + 1, bool)
        if len(data) > 1:
            blank = (data[1:] == 0x20) | (data[1:] == 0x0A)
            before = data[:-1]
            solid = (before > 0x20) & (before < 0x7F)
            # The last byte of a letter of two bytes; no white space has these leads.
            solid[1:] |= (before[1:] >= 0x80) & (before[1:] < 0xC0) & (before[:-1] >= 0xC3) & (before[:-1] < 0xE0)
            opens[1:-1] = blank & solid
        opens[offsets] = True
        opens[len(data)] = False
        starts = np.flatnonzero(opens)
        ends = np.append(starts[1:], len(data)) if len(starts) else starts
        return span_hashes(data, starts, ends, CASED), starts, ends

    def _ids(self, words: list[str]) -> list[bytes]:
        """Ids of chunks; those of one blank and a word go to the library together, told apart by their blanks."""
        known: dict[str, bytes] = {}
        pure, rest = [], []
        for word in words:
            (pure if word[:1] == " " and word[1:].split() == [word[1:]] else rest).append(word)
        for begin in range(0, len(pure), TOGETHER):
            some = pure[begin : begin + TOGETHER]
            ids = np.array(self.tokenizer.encode("".join(some), add_special_tokens=False).ids, "<u4")
            at = np.flatnonzero(self.opens[ids])
            if len(at) != len(some):
                rest.extend(some)
                continue
            raw, cuts = ids.tobytes(), (4 * np.append(at, len(ids))).tolist()
            known.update(zip(some, [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)], strict=True))
        for begin in range(0, len(rest), 4096):
            some = rest[begin : begin + 4096]
            for word, ids in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False), strict=True):
                known[word] = np.array(ids.ids, "<u4").tobytes()
        return [known[word] for word in words]


def chunk_encoder(path: str) -> ChunkEncoder:
    """The encoder of a file, made once per worker."""
    if path not in _encoders:
        _encoders[path] = ChunkEncoder(path)
    return _encoders[path]
