"""Token counts of whole texts; huge texts in overlapping chunks that are joined where it is proven to be safe."""

from __future__ import annotations

import functools

import sentencepiece
from pyspark.sql import DataFrame

from .common import map_texts

#: Code points of a chunk, which is also the longest text that is encoded in one go, and of an overlap at first.
CHUNK, OVERLAP = 32_768, 256
LIMIT = 4096
_BLANK = "▁"


class Pieces:
    """A piece vocabulary and the pairs of neighbouring characters that occur inside its pieces."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.joined: set[str] = set()
        for i in range(self.model.get_piece_size()):
            if not (self.model.is_control(i) or self.model.is_byte(i) or self.model.is_unknown(i)):
                piece = self.model.id_to_piece(i)
                self.joined.update(piece[n : n + 2] for n in range(len(piece) - 1))

    def stable(self, text: str, at: int) -> bool:
        """Whether a token always ends at ``at``: tokens grow by merging into pieces, and none holds this pair."""
        return text[at - 1 : at + 1].replace(" ", _BLANK) not in self.joined

    def ends(self, text: str) -> list[int]:
        """Where each token of a text ends, in code points, in order; all but the last byte of a character end before it."""
        return [end for _, end in self.model.encode(text, return_type="offset_mapping")["offsets"]]

    def count(self, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
        """Number of tokens of a whole text.

        Chunk after chunk is encoded with its offsets, each beginning ``overlap`` before the end of the one
        before. The two are joined at a place in the overlap where both end a token and which is stable: what
        lies left and right of it does not depend on the other side, so the sum is the whole text's. Without
        such a place the overlap is doubled to the left; once it has reached the beginning of the chunk before,
        the two become one chunk of twice the length, up to the whole text.
        """
        if len(text) <= chunk:
            return len(self.model.encode(text))
        total, joint, begin, end = 0, -1, 0, chunk
        ends = self.ends(text[:end])
        while end < len(text):
            following, width = min(len(text), end + max(chunk, end - begin)), overlap
            while True:
                start = max(begin, end - width)
                after = [start + e for e in self.ends(text[start:following])]
                place = self._joint(text, set(ends), after, max(start, joint) + 1, end)
                if place or start == begin:
                    break
                width *= 2
            if place:
                total += sum(joint < e <= place for e in ends)
                joint = place
            begin, end, ends = start, following, after
        return total + sum(joint < e for e in ends)

    def _joint(self, text: str, before: set[int], after: list[int], low: int, high: int) -> int:
        """The last stable place from ``low`` to before ``high`` at which a token ends in both; 0 without one."""
        return next((e for e in reversed(after) if low <= e < high and e in before and self.stable(text, e)), 0)


@functools.lru_cache(maxsize=2)
def load(path: str) -> Pieces:
    return Pieces(path)


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row.

    A null or empty text has no bytes and no tokens. Each row is counted by itself; other columns are not read.
    """

    def work(texts: list[str]) -> dict[str, list]:
        pieces = load(path)
        counts = [pieces.count(t) for t in texts]
        return {"n_bytes": [len(t.encode()) for t in texts], "n_tokens": counts, "over_limit": [c > limit for c in counts]}

    return map_texts(docs, "n_bytes long, n_tokens long, over_limit boolean", work, id_col, text_col)
