"""Token counts by the whole-token shortcut.

No vocabulary string has the space mark after another character, so the library's merges never cross from a
character to a following space: the text falls into pre-tokens, each a run of spaces and what follows it.
Which vocabulary strings encode alone as one token is proved once, by encoding all of them; a pre-token that is
such a string counts 1 by table, and only the others are merged, by the library.
"""

from __future__ import annotations

import functools
import re

from pyspark.sql import DataFrame

from millrace.llm._common import EMPTIED, PieceCache, map_steps, text_of

MARK = "▁"  # how the vocabulary writes a space
LIMIT = 4096


def pre_tokens(text: str) -> list[str]:
    """The pre-tokens, without the one space each begins with (the library puts one before the text)."""
    text = text.replace(MARK, " ")
    if "  " in text or text[:1] == " " or text[-1:] == " ":
        return [x[1:] for x in re.findall(" +[^ ]*", " " + text)]
    return text.split(" ") if text else []


class TokenCounter:
    """Counts by one SentencePiece BPE model file, as the library encodes: no begin, end or added tokens, control strings as plain text."""

    def __init__(self, model: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model)
        lib = self.library
        strings = [(i, lib.id_to_piece(i)) for i in range(lib.get_piece_size()) if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i))]
        if any(MARK in s.lstrip(MARK) for _, s in strings):
            raise ValueError("a vocabulary string has a space inside: pre-tokens can't be counted apart")
        self.single = self.prove(strings)
        self.cache = PieceCache(self.count_many)

    def prove(self, strings: list[tuple[int, str]]) -> frozenset[str]:
        """The strings, without their first space, that the library encodes alone as exactly their own one token."""
        own = [(i, s[1:].replace(MARK, " ")) for i, s in strings if s.startswith(MARK) and s != MARK]
        return frozenset(s for (i, s), ids in zip(own, self.library.encode([s for _, s in own], num_threads=1), strict=True) if ids == [i])

    def count_many(self, pieces: list[str]) -> list[int]:
        rest = [p for p in pieces if p not in self.single]
        merged = dict(zip(rest, map(len, self.library.encode(rest, num_threads=1)), strict=True)) if rest else {}
        if "" in merged:  # a space alone, at the end of a text; the library gives an empty text no token
            merged[""] = 1
        return [merged.get(p, 1) for p in pieces]

    def counts(self, texts: list[str]) -> list[int]:
        return list(map(sum, self.cache.values([pre_tokens(t) for t in texts])))


@functools.lru_cache(1)
def counter(model: str) -> TokenCounter:
    return TokenCounter(model)


EMPTIED[__name__] = counter.cache_clear


def count_tokens(docs: DataFrame, model: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes (UTF-8), n_tokens, over_limit for every row of docs; model: path of the vocabulary on every machine.

    A null text counts as empty: 0 bytes, 0 tokens. A null id stays null. Repeated rows give repeated results.
    Other columns of docs are not read, whatever their names. An empty table gives an empty result.
    """

    def make(part):
        texts = part.column(text_col).to_pylist()
        counts = counter(model).counts(texts)
        return part.column(id_col), [len(t.encode()) for t in texts], counts, [n > limit for n in counts]

    return map_steps(text_of(docs, id_col, text_col), text_col, make, f"`{id_col}` long, n_bytes long, n_tokens long, over_limit boolean")
