"""Secret scans: an Aho-Corasick keyword automaton finds places, anchored patterns match only there, embedded checksums confirm.

Base kinds: assign, access, hex. Hex runs have no keyword: their pattern reads every text. The method adds: github and npm tokens, whose last six characters are the
CRC-32 of the rest in base 62; jwt, whose head must decode to a JSON object with an algorithm; card, digit runs
beside a card keyword that hold Luhn's check digit.
"""

from __future__ import annotations

import base64
import binascii
import functools
import json
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm._common import map_steps, text_of

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # the maximal runs of hex digits that are long enough
GITHUB = re.compile(r"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])")
NPM = re.compile(r"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])")
RUN = re.compile(r"[A-Za-z0-9_-]*")
CARD = re.compile(r"card[a-z]{0,8}[ :#=]{1,4}([0-9](?:[ -]?[0-9]){12,18})(?![0-9])", re.I | re.A)
KINDS = ("assign", "access", "hex", "github", "npm", "jwt", "card")
BASE = KINDS[:3]
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def base62(n: int) -> str:
    s = ""
    while n:
        n, r = divmod(n, 62)
        s = BASE62[r] + s
    return s.rjust(6, "0")


def crc_holds(token: str) -> bool:
    """The last six characters are the CRC-32 of the 30 that follow the prefix."""
    body = token[4:]
    return base62(zlib.crc32(body[:-6].encode())) == body[-6:]


def jwt_holds(text: str, at: int, end: int) -> bool:
    """The head decodes to a JSON object that names an algorithm. A long head is tried by its beginning first: one that is no JSON there is none at all."""
    for size in (64, 4096, end - at):
        part = text[at : min(at + size, end)]
        whole = at + len(part) == end
        try:
            read = base64.urlsafe_b64decode(part + "=" * (-len(part) % 4)).decode("utf-8", "strict" if whole else "replace")
            found = json.loads(read)
        except json.JSONDecodeError as e:
            if not whole and (e.pos >= len(read) - 8 or e.msg.startswith("Unterminated string")):
                continue
            return False
        except (ValueError, binascii.Error, RecursionError):
            return False
        return whole and isinstance(found, dict) and isinstance(found.get("alg"), str)
    return False


def jwt_ends(text: str, at: int) -> tuple[int, int | None]:
    """Where the run of characters ends in which a head stands here, and where the token ends; None if no two parts follow the run."""
    ends = [RUN.match(text, at).end()]
    for _ in range(2):
        if text[ends[-1] : ends[-1] + 1] != "." or (next_end := RUN.match(text, ends[-1] + 1).end()) == ends[-1] + 1:
            return ends[0], None
        ends.append(next_end)
    return ends[0], ends[2]


def luhn_holds(digits: str) -> bool:
    d = [int(c) for c in digits if c.isdigit()][::-1]
    return len(set(d)) > 1 and (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


#: keyword in lower case: kind
KEYWORDS = {"password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "apikey": "assign", "api_key": "assign", "akia": "access", **{f"gh{c}_": "github" for c in "pousr"}, "npm_": "npm", "eyj": "jwt", "card": "card"}


@functools.lru_cache(1)
def automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        a.add_word(word, (len(word), kind))
    a.make_automaton()
    return a


def lowered(text: str) -> str:
    """The text in lower case, place for place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c if len(x := c.lower()) > 1 else x for c in text)


def find(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every secret, in code points, end exclusive, by start, then kind as listed in KINDS."""
    spans = [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    free = dict.fromkeys(KINDS, 0)  # where the next match of a kind may begin
    run: tuple[int, int | None] = (0, None)  # the last run in which a head was looked for
    for last, (n, kind) in automaton().iter(lowered(text)):
        at = last - n + 1
        if at < free[kind]:
            continue
        if kind == "assign":
            if m := ASSIGN.match(text, at):
                free[kind] = m.end()
                if len(m[2]) >= 6:
                    spans.append((kind, at, m.end()))
        elif kind == "access":
            if m := ACCESS.match(text, at):
                free[kind] = m.end()
                if len(m[0]) >= 20:
                    spans.append((kind, at, m.end()))
        elif kind == "card":
            if (m := CARD.match(text, at)) and luhn_holds(m[1]):
                free[kind] = m.end()
                spans.append((kind, m.start(1), m.end(1)))
        elif kind == "jwt":
            if at >= run[0]:
                run = jwt_ends(text, at)
            end, whole = run
            if whole is None:  # nor for any head that begins later in this run
                free[kind] = end
            elif text.startswith("eyJ", at) and at + 3 < end and jwt_holds(text, at, end):
                free[kind] = whole
                spans.append((kind, at, whole))
        elif (m := {"github": GITHUB, "npm": NPM}[kind].match(text, at)) and crc_holds(m[0]):
            free[kind] = m.end()
            spans.append((kind, at, m.end()))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def written(spans) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


def redact(text: str, spans) -> str:
    """The text with every stretch that spans cover replaced by a mark."""
    out, at = [], 0
    for kind, a, b in spans:
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], f"[{kind}]"]
        at = b
    return "".join([*out, text[at:]])


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, secrets (array of kind, start, end) for every row of docs.

    A null text is an empty one and has none. A null id stays null; repeated rows give repeated results; other
    columns of docs are not read, whatever their names; an empty table gives an empty result.
    """
    return map_steps(text_of(docs, id_col, text_col), text_col, lambda part: (part.column(id_col), [[dict(zip(("kind", "start", "end"), s)) for s in find(t)] for t in part.column(text_col).to_pylist()]), f"`{id_col}` long, secrets array<struct<kind:string,start:long,end:long>>")


def redacted(text_col: str = "text"):
    """Column: the text with its secrets replaced; null stays null."""

    @F.arrow_udf("string")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([t if t is None else redact(t, find(t)) for t in texts.to_pylist()], pa.string())

    return run(F.col(text_col))
