"""Operator 7: token counts by a compiled finite-state transducer.

The tokenizer (lower case, pre-tokens, merges with word ends) is compiled, state
by state as texts need it, into a deterministic transducer over the characters
of normalised text.  A state knows the pre-token it is in and, for every
beginning of a piece that could still grow, the last piece before it and how
many tokens that path is ahead; a transition is annotated with the change of the
token count, and each state with the tokens that closing the pre-token adds.

Texts are cut into chunks at any place.  A chunk's state map sends an entry
state to an exit state and a count: only what stands before its first white
space depends on the entry state, the rest is evaluated once.  The maps are
composed pairwise, level by level (a parallel prefix scan), and the composed
map is applied to the start state.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import read_table, text_of, worker_cached
from .merges import MergeTable
from .token_files import byte_chars

CHUNK = 16384
MEMO_FIELDS = 600_000  # of each of two generations
MEMO_FIELD_CHARS = 64
MOST_STATES = 120_000
MOST_STEPS = 20_000
FIELD_BREAK = re.compile(r"[\x20\x09-\x0D]")
# fixed values of the tokenizer: the pre-tokens that a quotation mark begins
SHORT_ENDS = {"s", "t", "m", "d"}
LONG_ENDS = {"r": "e", "v": "e", "l": "l"}
SHORT_LIMIT = 4096  # kinds of characters remembered


class Compiled:
    """The transducer; states are numbers, built on demand.

    ``step[q]`` maps a character to ``(next state, tokens)``, ``close[q]`` is
    the number of tokens that ending the text in ``q`` adds.
    """

    START = 0

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        if model.get("end_of_word_suffix") != "</w>" or model.get("continuing_subword_prefix") or model.get("ignore_merges"):
            raise ValueError("needs a merge-order model with word ends")
        # a word end is one more symbol property: "c</w>" merges as a symbol of its own
        self.table = MergeTable({p: r for r, p in enumerate(pairs)})
        if len(self.table.last) != len(pairs):
            raise ValueError("a piece has two merges")
        self.end = "</w>"
        self.prefixes = {p[:k] for p in self.table.last for k in range(1, len(p.removesuffix(self.end)) + 1)}
        self.bytes = byte_chars()
        self.pieces = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.kinds: dict[str, str] = {}
        self._reset()

    def _reset(self) -> None:
        self.number: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.step: list[dict[str, tuple[int, int]]] = []
        self.close: list[int] = []
        self.bpe: dict[tuple, tuple] = {}
        self._state(("none", ()))

    # ------------------------------------------------------ one pre-token
    # A path is ((beginning, last piece before it, tokens ahead), ...), longest
    # beginning first; the empty beginning is always there.  "" as last piece
    # says that the pre-token starts there.
    FRESH = (("", "", 0),)

    def _bytes(self, path: tuple, char: str) -> tuple[tuple, int, int]:
        """Path after a character, tokens added, tokens to close behind it."""
        key = (path, char)
        if key in self.bpe:
            return self.bpe[key]
        added = close = 0
        for b in char.encode("utf-8"):
            path, gained, close = self._byte(path, self.bytes[b])
            added += gained
        if len(self.bpe) < MOST_STEPS:
            self.bpe[key] = path, added, close
        return path, added, close

    def _byte(self, path: tuple, symbol: str) -> tuple[tuple, int, int]:
        last, apart = self.table.last, self.table.apart
        found = closing = None
        for begin, before, ahead in path:
            piece = begin + symbol
            if found is None and (not begin or piece in last) and (not before or apart(before, piece)):
                found = (piece, ahead + 1)
            ended = piece + self.end
            if closing is None and (not begin or ended in last) and (not before or apart(before, ended)):
                closing = ahead + 1
        piece, gained = found
        grown = tuple((begin + symbol, before, ahead - gained) for begin, before, ahead in path
                      if begin + symbol in self.prefixes)
        return (*grown, ("", piece, 0)), gained, closing - gained

    # ------------------------------------------------------------- states
    def _state(self, state: tuple) -> int:
        q = self.number.get(state)
        if q is None:
            q = self.number[state] = len(self.states)
            self.states.append(state)
            self.step.append({})
            kind, path = state[:2]
            self.close.append(0 if kind == "none" else state[2] if kind != "quote" else self._quote(state))
        return q

    def _quote(self, state: tuple) -> int:
        """Tokens of a held back quotation mark and letter as plain pre-tokens."""
        tokens = 0
        for c in state[1]:
            _, added, close = self._bytes(self.FRESH, c)
            tokens += added + close
        return tokens

    def kind(self, c: str) -> str:
        """Class of a character, by what the library does with it: its tables of
        Unicode are its own, and newer than Python's."""
        k = self.kinds.get(c)
        if k is None:
            beside = self.pieces("a" + c)  # a letter joins, white space vanishes
            if len(beside) == 1:
                k = "letter" if beside[0][1][1] == 2 else "space"
            else:
                k = "number" if len(self.pieces(c + c)) == 2 else "mark"
            if len(self.kinds) < SHORT_LIMIT:
                self.kinds[c] = k
        return k

    def _word(self, text: str) -> int:
        path, tokens, close = self.FRESH, 0, 0
        for c in text:
            path, added, close = self._bytes(path, c)
            tokens += added
        return tokens + close

    def compile(self, q: int, c: str) -> tuple[int, int]:
        """The transition of state ``q`` on ``c``, entered into the table."""
        mode, path = self.states[q][:2]
        kind = self.kind(c)
        if mode == "quote":  # path holds "'" or "'" and a letter that may begin a long end
            held, tokens = path, None
            if len(held) == 1 and c in SHORT_ENDS:
                tokens, state = self._word(held + c), ("none", ())
            elif len(held) == 1 and c in LONG_ENDS:
                tokens, state = 0, ("quote", held + c)
            elif len(held) == 2 and LONG_ENDS[held[1]] == c:
                tokens, state = self._word(held + c), ("none", ())
            else:  # the mark was a plain one; go on from where that leads
                tokens, at = 0, None
                for x in held:
                    k = self.kind(x)
                    if at is None or at[0] != k:
                        tokens += 0 if at is None else at[2]
                        at = (k, self.FRESH, 0)
                    p, added, close = self._bytes(at[1], x)
                    tokens, at = tokens + added, (k, p, close)
                nxt, more = self._go(self._state(at), c)
                self.step[q][c] = nxt, tokens + more
                return nxt, tokens + more
        elif kind == mode and kind in ("letter", "mark"):
            p, tokens, close = self._bytes(path, c)
            state = (kind, p, close)
        else:
            tokens = self.close[q]
            if kind == "space":
                state = ("none", ())
            elif kind == "number":
                tokens, state = tokens + self._word(c), ("none", ())
            elif c == "'":
                state = ("quote", c)
            else:
                p, added, close = self._bytes(self.FRESH, c)
                tokens, state = tokens + added, (kind, p, close)
        nxt = self._state(state)
        self.step[q][c] = nxt, tokens
        return nxt, tokens

    def _go(self, q: int, c: str) -> tuple[int, int]:
        return self.step[q].get(c) or self.compile(q, c)

    def run(self, q: int, text: str) -> tuple[int, int]:
        """Exit state and tokens of normalised ``text`` entered in ``q``."""
        step, total = self.step, 0
        for c in text:
            nxt = step[q].get(c)
            if nxt is None:
                nxt = self.compile(q, c)
            q, tokens = nxt
            total += tokens
        return q, total


@dataclass
class StateMap:
    """``head``: normalised text whose count depends on the entry state.
    ``exit`` None: the head is all there is; else the tokens between and the
    exit state, which do not depend on it.  ``head`` ends in white space then."""

    head: str
    tokens: int = 0
    exit: int | None = None


class Counter(dict):
    """Token counts of texts; remembers the counts of white-space separated
    fields from the start state: when ``limit`` are held they become the older
    generation, whose fields come back as they are met again."""

    def __init__(self, path: str, chunk: int = CHUNK, limit: int = MEMO_FIELDS):
        super().__init__()
        self.fst, self.chunk, self.limit = Compiled(path), chunk, limit
        self.older: dict[bytes, int] = {}
        tok = Tokenizer.from_file(path)
        self.normalize = tok.normalizer.normalize_str
        with open(path, encoding="utf-8") as f:
            added = [t["content"] for t in json.load(f)["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.first = sorted({a[:2] for a in added})
        self.longest = max(map(len, added), default=0)

    def _normal(self, text: str) -> str:
        return text.lower() if text.isascii() else self.normalize(text)

    def __missing__(self, field: bytes) -> int:
        tokens = self.older.get(field)
        if tokens is None:
            q, tokens = self.fst.run(self.fst.START, self._normal(field.decode()))
            tokens += self.fst.close[q]
        if len(field) <= MEMO_FIELD_CHARS:
            if len(self) >= self.limit:
                self.older = dict(self)
                self.clear()
            self[field] = tokens
        return tokens

    # ------------------------------------------------------------- chunks
    def cuts(self, text: str) -> list[int]:
        """Places to cut at: between two ASCII characters, where normalising
        one side does not depend on the other."""
        out, at = [0], self.chunk
        while at < len(text):
            while at < len(text) and not (text[at - 1] < "\x80" and text[at] < "\x80"):
                at += 1
            if at < len(text):
                out.append(at)
            at += self.chunk
        return [*out, len(text)]

    def state_map(self, chunk: str) -> StateMap:
        first = FIELD_BREAK.search(chunk)
        if first is None:
            return StateMap(self._normal(chunk))
        raw = chunk.encode("utf-8", "replace")
        tail_at = max(raw.rfind(s) for s in b" \t\n\r\x0b\x0c")
        head, tail = chunk[:first.start()], raw[tail_at + 1:].decode()
        tokens = sum(map(self.__getitem__, raw[len(head.encode("utf-8", "replace")):tail_at].split()))
        q, more = self.fst.run(self.fst.START, self._normal(tail))
        return StateMap(self._normal(head) + " ", tokens + more, q)

    def then(self, a: StateMap, b: StateMap) -> StateMap:
        """The map of chunk ``a`` followed by chunk ``b``."""
        if a.exit is None:
            return StateMap(a.head + b.head, b.tokens, b.exit)
        q, tokens = self.fst.run(a.exit, b.head)
        return StateMap(a.head, a.tokens + tokens + b.tokens, q if b.exit is None else b.exit)

    def scan(self, maps: list[StateMap]) -> StateMap:
        while len(maps) > 1:
            maps = [self.then(*maps[i:i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        return maps[0]

    def _plain(self, text: str) -> int:
        cuts = self.cuts(text)
        m = self.scan([self.state_map(text[a:b]) for a, b in zip(cuts, cuts[1:])])
        q, tokens = self.fst.run(self.fst.START, m.head)
        return tokens + (self.fst.close[q] if m.exit is None else m.tokens + self.fst.close[m.exit])

    def count(self, text: str) -> int:
        if len(self.fst.states) > MOST_STATES:  # between texts no state number is held
            self.fst._reset()
        if self.special is None or not any(f in text for f in self.first):
            return self._plain(text) if text else 0
        parts = self.special.split(text)
        return len(parts) - 1 + sum(self._plain(p) for p in parts if p)


def token_counts(docs: DataFrame, tokenizer: str, chunk: int = CHUNK) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens)`` of every row of ``docs``.

    Null and empty texts have 0 of both; null and repeated ids each give their
    row; an empty table gives none; other columns are not read.  Special
    strings in a text count as one token each, as the library has them.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = worker_cached(("token-counts", tokenizer, chunk), lambda: Counter(tokenizer, chunk))
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "n_bytes": pdf["n_bytes"],
                                "n_tokens": [counter.count(t) for t in pdf["text"]]})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text_of()).cast("long").alias("n_bytes"),
                       text_of().alias("text")).mapInPandas(run, "doc_id long, n_bytes long, n_tokens long")


LIMIT = 2048


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > LIMIT)
