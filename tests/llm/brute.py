"""Plain versions of the operators, for small fixtures."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers as P

ASSIGN = re.compile(r"""(?ia)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def secrets(text: str) -> list[tuple[str, int, int]]:
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def tiktoken_encoding():
    import tiktoken

    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def bpe_row(encoding, text: str) -> tuple[int, str, str]:
    ids = encoding.encode_ordinary(text)
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


def sstable_rows(rows: list[tuple[int, str]]) -> list[tuple[int, int, int, int]]:
    from tokenizers import Tokenizer

    t, start, out = Tokenizer.from_file(P.path("word_bpe_49k.json")), 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        ids = t.encode(text, add_special_tokens=False).ids + [1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def edit_distance(a, b) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[len(b)]


def substring_distance(item: str, doc: str) -> int:
    """Edits of the best alignment of the whole item with any stretch of doc."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for y in doc:
        last, row[0] = row[0], 0
        for i, x in enumerate(item, 1):
            last, row[i] = row[i], min(row[i] + 1, row[i - 1] + 1, last + (x != y))
        best = min(best, row[-1])
    return best


def classes(texts: dict[int, str]) -> dict[int, int]:
    """Connected components of all pairs with an edit similarity of words of 0.8 or more."""
    words = {i: re.findall(r"\w+", t.lower()) for i, t in texts.items()}
    top = {i: i for i in texts}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            longest = max(len(words[a]), len(words[b]))
            if words[a] == words[b] or longest >= 5 and abs(len(words[a]) - len(words[b])) <= 0.2 * longest and edit_distance(words[a], words[b]) <= 0.2 * longest + 1e-9:
                p, q = find(a), find(b)
                top[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}
