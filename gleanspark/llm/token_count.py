"""Token counts with a whole-token shortcut.

A piece vocabulary is examined once in each worker. Two neighbouring characters that stand next to
each other in no piece can never be merged, so a text may be cut between them and its parts counted
apart. Of the parts, those proven to encode alone as one token need no merging; any other distinct
part is merged once by the library and remembered.

Edge cases: a null text counts as empty (no bytes, no tokens); repeated rows give repeated results;
an empty table gives an empty result; extra columns are ignored. The memory of parts is cleared at
MEMO_PARTS, so that very varied texts cannot exhaust a worker.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from gleanspark.llm.arrowmap import map_texts

SPACE = "▁"
MEMO_PARTS = 300_000
_PARTS = re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+")
#: Ahead of a part: a token of its own after the library's own leading space.
_GUARD = "\n"


class PieceCounter:
    def __init__(self, model_file: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        ids = [i for i in range(self.library.get_piece_size()) if not (self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_byte(i))]
        pieces = [self.library.id_to_piece(i) for i in ids]
        #: Whether the cuts of _PARTS fall only where no piece can reach across.
        self.splits = not any("\n" in p or (SPACE in p and p.lstrip(SPACE).find(SPACE) >= 0) for p in pieces)
        self.splits = self.splits and self.library.encode(_GUARD + "a b") [2:] == self.library.encode(_GUARD + "a")[2:] + self.library.encode("b")
        self.memo: dict[str, int] = {}
        self.single = frozenset(self._proven(ids, pieces)) if self.splits else frozenset()
        self.guard = len(self.library.encode(_GUARD))

    def _proven(self, ids: list[int], pieces: list[str]):
        """Vocabulary strings that, standing alone as a part, come out as their own single token."""
        for at in range(0, len(pieces), 4096):
            made = self.library.encode([_GUARD + p for p in pieces[at : at + 4096]], num_threads=1)
            for i, piece, tokens in zip(ids[at : at + 4096], pieces[at : at + 4096], made, strict=True):
                if tokens[-1:] == [i] and len(tokens) == 3 and _PARTS.fullmatch(piece):
                    yield piece

    def __call__(self, texts: list[str]) -> list[int]:
        if not self.splits:
            return list(map(len, self.library.encode(texts, num_threads=1)))
        split = [_PARTS.findall(f"{SPACE}{t}".replace(" ", SPACE)) if t else [] for t in texts]
        if len(self.memo) > MEMO_PARTS or not self.memo:
            self.memo = dict.fromkeys(self.single, 1)
        new = list(set().union(*split) - self.memo.keys())
        for at in range(0, len(new), 20_000):
            some = new[at : at + 20_000]
            for part, tokens in zip(some, self.library.encode([_GUARD + p for p in some], num_threads=1), strict=True):
                self.memo[part] = len(tokens) - self.guard
        count = self.memo.__getitem__
        return [sum(map(count, parts)) + t.count("\n") for t, parts in zip(texts, split, strict=True)]


@lru_cache(maxsize=2)
def counter(model_file: str) -> PieceCounter:
    return PieceCounter(model_file)


def count_tokens(docs: DataFrame, model_file: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, n_tokens and over_limit of each row; map-only."""

    def start():
        count = counter(model_file)

        def work(texts):
            texts = [t or "" for t in texts]
            tokens = pa.array(count(texts), pa.int64())
            sizes = pc.cast(pc.binary_length(pa.array(texts, pa.string())), pa.int64())
            return {"n_bytes": sizes, "n_tokens": tokens, "over_limit": pc.greater(tokens, limit)}

        return work

    kind = dict(docs.dtypes)[id_col]
    return map_texts(docs, [id_col], text_col, f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean", start)
