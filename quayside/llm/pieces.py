"""A public merge-type piece vocabulary: merge order, last merges of pieces, and compatible pairs.

The vocabulary is read by the sentencepiece library; all encoding is done here. Merges join the two
adjacent symbols whose joint piece has the highest score, the leftmost of equal ones. A sequence of
pieces is the encoding of its text exactly if each two neighbours are compatible: if the encoding of
their joint text is those two pieces.
"""

from __future__ import annotations

from itertools import pairwise

import numpy as np

from quayside.llm.texts import BLOCK, mix

#: The sign that stands for a blank.
BLANK = "▁"
#: Compatibility tests whose results are kept.
PAIRS = 600_000
_VALUES = np.random.default_rng(20_262).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0xD1342543DE82EF95)


def _powers(base: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(BLOCK, base, np.uint64)]), dtype=np.uint64)


_UP, _DOWN = _powers(int(_BASE)), _powers(pow(int(_BASE), -1, 1 << 64))
_tables: dict[str, PieceTable] = {}


class PieceTable:
    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.texts: list[str] = [model.id_to_piece(k) for k in range(model.get_piece_size())]
        special = [model.is_control(k) or model.is_unknown(k) or model.is_byte(k) or model.is_unused(k) for k in range(len(self.texts))]
        self.ids = {text: k for k, text in enumerate(self.texts) if not special[k]}
        self.byte_ids = [model.piece_to_id(f"<0x{byte:02X}>") for byte in range(256)]
        #: What each id stands for in a text.
        self.bytes_of = [text.replace(BLANK, " ").encode() for text in self.texts]
        for byte, k in enumerate(self.byte_ids):
            self.bytes_of[k] = bytes([byte])
        for k, text in enumerate(self.texts):
            if special[k] and k not in set(self.byte_ids):
                self.bytes_of[k] = b"" if model.is_control(k) else " ⁇ ".encode()
        # Equal scores have equal ranks; single characters come before all merges.
        scores = {k: model.get_score(k) for k in self.ids.values()}
        order = {score: rank for rank, score in enumerate(sorted(set(scores.values()), reverse=True))}
        self.rank = {text: order[scores[k]] for text, k in self.ids.items()}
        self.chars = {text for text in self.ids if len(text) == 1}
        #: Rank of the merge that makes a piece; -1 for a character.
        self.made = [-1] * len(self.texts)
        for text, k in self.ids.items():
            if len(text) > 1:
                self.made[k] = self.rank[text]
        inner = any(BLANK in text.lstrip(BLANK) for text in self.ids)
        if inner or "\n" in self.chars or not model.encode(" ") or model.encode("a") != model.encode("▁a")[1:]:
            raise ValueError("the vocabulary must put a blank before a text, keep blanks first in pieces, and have no line break")
        self._splits: dict[int, tuple[int, int] | None] = {}
        self._pairs: dict[int, bool] = {}

    def merged(self, text: str) -> tuple[list[str], tuple[str, str] | None]:
        """The symbols left when nothing can be merged, and the last merge; by plain repetition."""
        symbols, last = list(text), None
        while True:
            found = [(self.rank[a + b], k) for k, (a, b) in enumerate(pairwise(symbols)) if a + b in self.rank]
            if not found:
                return symbols, last
            k = min(found)[1]
            last = (symbols[k], symbols[k + 1])
            symbols[k : k + 2] = [symbols[k] + symbols[k + 1]]

    def split(self, piece: int) -> tuple[int, int] | None:
        """The two pieces whose merge makes a piece; None if its text is encoded otherwise."""
        if piece not in self._splits:
            symbols, last = self.merged(self.texts[piece])
            self._splits[piece] = (self.ids[last[0]], self.ids[last[1]]) if len(symbols) == 1 and last else None
        return self._splits[piece]

    def whole(self, piece: int) -> bool:
        """Whether the encoding of a piece's text is that piece."""
        return self.made[piece] < 0 or self.split(piece) is not None

    def compatible(self, left: int, right: int) -> bool:
        key = left * len(self.texts) + right
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) > PAIRS:
                self._pairs.clear()
            known = self._pairs[key] = self.whole(right) and self._compatible(left, right)
        return known

    def _compatible(self, left: int, right: int) -> bool:
        """Undo the later of the two last merges, again and again; none may come after a merge across."""
        limit = len(self.texts) + 1
        while True:
            across = self.rank.get(self.texts[left] + self.texts[right])
            if across is not None and across < limit:
                return False
            if self.made[left] > self.made[right]:
                limit = self.made[left]
                left = self.split(left)[1]
            elif self.made[right] >= 0:
                limit = self.made[right] + 1  # of equal merges the left one, across, comes first
                right = self.split(right)[0]
            else:
                return True

    def runs(self, text: str) -> list[str]:
        """Parts of known characters and single unknown ones, in order."""
        if self.chars.issuperset(text):
            return [text] if text else []
        parts, begin = [], 0
        for k, char in enumerate(text):
            if char not in self.chars:
                parts += [text[begin:k]] * (k > begin) + [char]
                begin = k + 1
        return parts + [text[begin:]] * (begin < len(text))


def piece_table(path: str) -> PieceTable:
    """The table of a file, made once per worker."""
    if path not in _tables:
        _tables[path] = PieceTable(path)
    return _tables[path]


def spaced(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with blanks for BLANK, and one blank more before each that is not empty."""
    if BLANK.encode() in (raw := data.tobytes()):
        texts = [raw[a:b].replace(BLANK.encode(), b" ") for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        data = np.frombuffer(b"".join(texts), np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(text) for text in texts], dtype=np.int64)])
    filled = np.diff(offsets) > 0
    data = np.insert(data, offsets[:-1][filled], 32)
    return data, offsets + np.concatenate([[0], np.cumsum(filled)])


def segments(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """First bytes of the segments of spaced texts: no piece reaches from one into the next.

    A segment is a line break, or blanks and what follows them; it begins where a text does.
    """
    line, blank = data == 10, data == 32
    opens = line.copy()
    opens[1:] |= line[:-1] | (blank[1:] & ~blank[:-1])
    opens[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(opens)


def segment_hashes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes from each start to the next."""
    ends = np.append(starts[1:], len(data))
    hashes = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):  # as many segments as fit a block, or one longer one, by parts
        stop = max(int(np.searchsorted(ends, starts[at] + BLOCK, "right")), at + 1)
        low, high = int(starts[at]), int(ends[stop - 1])
        if high - low > BLOCK:
            value = np.zeros(1, np.uint64)
            for begin in range(low, high, BLOCK):
                part = data[begin : min(begin + BLOCK, high)]
                value = mix(value + (_VALUES[part] * _UP[: len(part)]).sum(dtype=np.uint64))
            hashes[at] = value[0]
        else:
            sums = np.zeros(high - low + 1, np.uint64)
            np.cumsum(_VALUES[data[low:high]] * _UP[: high - low], out=sums[1:])
            begin = starts[at:stop] - low
            hashes[at:stop] = (sums[ends[at:stop] - low] - sums[begin]) * _DOWN[begin]
        at = stop
    return mix(hashes ^ ((ends - starts).astype(np.uint64) << np.uint64(48)))


def segment_texts(data: np.ndarray, starts: np.ndarray, which: np.ndarray) -> list[str]:
    """Some segments as text, blanks as BLANK."""
    raw, ends = data.tobytes(), np.append(starts[1:], len(data))
    spans = zip(starts[which].tolist(), ends[which].tolist(), strict=True)
    return [raw[a:b].decode("utf-8", "replace").replace(" ", BLANK) for a, b in spans]
